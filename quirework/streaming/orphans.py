"""Orphans kept up to date from a stream of deltas.

The state of a key are the running sums of its signed deltas, by the function that the batch query uses. Late
deltas are ordinary ones, so no watermark is needed and no state may expire.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quirework.operators import references


def read(spark: SparkSession, path: str) -> DataFrame:
    """Deltas that arrive as parquet files of :data:`quirework.operators.references.DELTAS`."""
    return spark.readStream.schema(references.DELTAS).parquet(path)


def current(deltas: DataFrame) -> DataFrame:
    """Counts per key, for update or complete output; those of :data:`quirework.operators.references.ORPHAN` are orphans."""
    return references.signed_counts(deltas)
