"""Ordered windows over groups of any size.

A group is cut into blocks by the value of an integer that its order begins with (pages, say). A window runs
within each block, a second one over one row per block, and a join brings what is carried into the block to its
rows. So one task never holds more than a block and a row for each other block, however large the group is. Rows
whose integer is null are a block of their own, before all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SIZE = 4096  #: pages of a block


def _block(at: str, size: int) -> Column:
    return F.floor(F.coalesce(F.col(at), F.lit(-size)) / size).cast("long")


def _carry(rows: DataFrame, blocks: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """``rows`` with the columns ``names`` of their block."""
    same = [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in (*by, "_b")]
    return rows.alias("x").join(blocks.alias("y"), same, "left").select("x.*", *(F.col(f"y.{n}").alias(n) for n in names))


def running_sum(rows: DataFrame, by: list[str], order: list[str], value: Column, name: str, size: int = SIZE) -> DataFrame:
    """``rows`` with the sum of ``value`` up to each row as ``name``; the order begins with an integer column and is total."""
    cut = rows.withColumn("_b", _block(order[0], size)).withColumn("_v", value)
    own = F.sum("_v").over(W.partitionBy(*by, "_b").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    before = F.sum("_t").over(W.partitionBy(*by).orderBy("_b").rowsBetween(W.unboundedPreceding, -1))
    blocks = cut.groupBy(*by, "_b").agg(F.sum("_v").alias("_t")).withColumn("_c", before)
    out = _carry(cut.withColumn("_o", own), blocks, by, ["_c"])
    return out.withColumn(name, F.col("_o") + F.coalesce("_c", F.lit(0))).drop("_b", "_v", "_o", "_c")


def around(rows: DataFrame, by: list[str], at: str, number: str, before: dict[str, Column] = {}, after: dict[str, Column] = {}, size: int = SIZE) -> DataFrame:  # noqa: B006
    """``rows`` with their ``number`` in the order of the integer ``at``, from 1, and for each name in ``before`` and ``after`` the nearest
    value that is not null before or after the row: ``struct(v, no)``, the value and the number of its row, or null. One join
    brings all of them. ``at`` is unique within a group."""
    cut = rows.withColumn("_b", _block(at, size))
    cut = cut.withColumn("_n", F.row_number().over(W.partitionBy(*by, "_b").orderBy(at)).cast("long"))
    place = F.coalesce(F.col(at), F.lit(-size))
    ways = [(n, c, F.asc, F.max_by) for n, c in before.items()] + [(n, c, F.desc, F.min_by) for n, c in after.items()]
    nearest = lambda c, keys, order: F.last(c, ignorenulls=True).over(W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1))
    aggs = [F.count("*").alias("_k")]
    for name, value, towards, best in ways:
        s = F.when(value.isNotNull(), F.struct(value.alias("v"), F.col("_n").alias("no")))
        aggs.append(best(s, F.when(value.isNotNull(), place)).alias(f"_t_{name}"))
        cut = cut.withColumn(f"_o_{name}", nearest(s, [*by, "_b"], towards(at)))
    blocks = cut.groupBy(*by, "_b").agg(*aggs)
    blocks = blocks.withColumn("_off", F.coalesce(F.sum("_k").over(W.partitionBy(*by).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    moved = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.col(f"{c}.v").alias("v"), (F.col(f"{c}.no") + F.col("_off")).alias("no")))
    for name, _, towards, _ in ways:
        blocks = blocks.withColumn(f"_c_{name}", nearest(moved(f"_t_{name}"), by, towards("_b")))
    out = _carry(cut, blocks, by, ["_off", *(f"_c_{name}" for name, *_ in ways)])
    own = [F.coalesce(moved(f"_o_{name}"), F.col(f"_c_{name}")).alias(name) for name, *_ in ways]
    return out.select(*(F.col(c) for c in rows.columns), (F.col("_n") + F.col("_off")).alias(number), *own)


def previous(rows: DataFrame, by: list[str], at: str, value: Column, name: str, size: int = SIZE) -> DataFrame:
    """``rows`` with the last ``value`` that is not null before each row, as ``name``; see :func:`around`."""
    return around(rows, by, at, "_no", before={name: value}, size=size).withColumn(name, F.col(f"{name}.v")).drop("_no")


def following(rows: DataFrame, by: list[str], at: str, value: Column, name: str, size: int = SIZE) -> DataFrame:
    """``rows`` with the first ``value`` that is not null after each row, as ``name``; see :func:`around`."""
    return around(rows, by, at, "_no", after={name: value}, size=size).withColumn(name, F.col(f"{name}.v")).drop("_no")
