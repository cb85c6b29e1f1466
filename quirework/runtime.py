"""Session set-up, lineage cuts in the shared folder and size-checked broadcasts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest number of rows a side may have to be broadcast by :func:`broadcast_if_small`.
BROADCAST_ROWS = 200_000


def session(app: str = "quirework", cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Local session for tests and benchmarks; on a cluster the caller brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only a local session (tests) may leave it unset and gets one of its own: on a
    cluster other machines could not read it, so there the setting is asked for."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if not known:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if held.isDefined():
            return held.get()
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
        known = tempfile.mkdtemp(prefix="quirework-")
        atexit.register(shutil.rmtree, known, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(known)
    return known


_WRITTEN: list[tuple[SparkSession, str]] = []


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` as parquet into the shared folder and read it back.

    Every executor can read the files again, so a lost executor costs at most a re-read. The files are
    columnar and compressed, unlike those of ``DataFrame.checkpoint``. :func:`release` removes them, at the
    latest when the driver ends.
    """
    spark = df.sparkSession
    if not _WRITTEN:
        atexit.register(release)
    path = f"{shared_folder(spark).rstrip('/')}/quirework-{uuid.uuid4().hex}"
    schema = df.schema
    _WRITTEN.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def release() -> None:
    """Remove what :func:`materialize` wrote, on any file system, once no frame needs it any more."""
    while _WRITTEN:
        spark, path = _WRITTEN.pop()
        try:
            jvm = spark.sparkContext._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # the session may be gone: what is left is local or the cluster's to expire
            if path.startswith(("/", "file:")):
                shutil.rmtree(path.removeprefix("file://").removeprefix("file:"), ignore_errors=True)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows, else as it is (a shuffle join).

    Meant for materialized frames: the check is a count over files that exist already.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
