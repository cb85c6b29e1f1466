"""Sources: files with their digest, the replay table, templates and page selections."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


@F.pandas_udf(DoubleType())
def ink_ratio(pixels: pd.Series, width: pd.Series) -> pd.Series:
    """Share of dark pixels (grey below 110) of raw 8-bit pages, a border of 4 % left aside; null without pixels."""

    def one(raw, w) -> float | None:
        if not raw or not w or len(raw) < w:
            return None
        grey = np.frombuffer(raw, np.uint8)[: len(raw) // int(w) * int(w)].reshape(-1, int(w))
        dy, dx = int(grey.shape[0] * 0.04), int(grey.shape[1] * 0.04)
        return float((grey[dy : grey.shape[0] - dy, dx : grey.shape[1] - dx] < 110).mean())

    return pd.Series([one(a, b) for a, b in zip(pixels, width)], dtype="float64")


def read_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``path``, ``length``, ``digest`` (SHA-256 of the bytes) and ``content`` of files, any format."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return df.select("path", "length", F.sha2(F.col("content"), 256).alias("digest"), "content")


def read_templates(spark: SparkSession, path: str) -> DataFrame:
    """``template_id``, ``doc_type``, ``key`` of stored template files; unreadable files are skipped."""
    raw = spark.read.schema("doc_type string, title string, entries map<string, array<string>>, _corrupt_record string").option("mode", "PERMISSIVE").option("multiLine", True).json(path)
    name = F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1)
    return raw.withColumn("template_id", name).where("_corrupt_record IS NULL AND doc_type IS NOT NULL").select("template_id", "doc_type", "title", F.explode("entries").alias("key", "decision"))


def page_range(pages: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """Pages from ``first`` to ``last``, both included; a bound that is missing is open."""
    if first is not None and last is not None and first > last:
        raise ValueError("the first page lies behind the last")
    if first is not None:
        pages = pages.where(F.col("page") >= first)
    return pages if last is None else pages.where(F.col("page") <= last)


def text_layer(fragments: DataFrame, by: list[str]) -> DataFrame:
    """Text of a page from positioned fragments (``box`` ``[y, x, ...]``, ``text``), sorted by rounded y, then x."""
    at = F.struct(F.round(F.element_at("box", 1)).alias("y"), F.round(F.element_at("box", 2)).alias("x"), F.col("text").alias("t"))
    rows = fragments.where("trim(text) <> ''").groupBy(*by).agg(F.array_sort(F.collect_list(at)).alias("_l"))
    return rows.select(*by, F.array_join(F.transform("_l", lambda x: x["t"]), "\n").alias("text"))


def build_blocks(raw: DataFrame, by: list[str]) -> DataFrame:
    """Blocks of raw reads: ids from the original position, ``idx`` compacted over blocks with a text or number; boxes of other
    than four numbers become null. ``raw``: by (with page), pos, kind, number, text, box."""
    from pyspark.sql import Window as W

    kept = raw.where("trim(coalesce(text, '')) <> '' OR trim(coalesce(number, '')) <> ''")
    idx = F.row_number().over(W.partitionBy(*by).orderBy("pos")) - 1
    return kept.withColumn("block_id", F.format_string("p%04d_b%03d", "page", "pos")).withColumn("idx", idx).withColumn("box", F.when(F.size("box") == 4, F.col("box")))
