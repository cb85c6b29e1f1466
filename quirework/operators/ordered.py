"""Checks on ordered rows: gaps, labels, runs, budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quirework.functions.numbering import between, depth_hint, leading_marker, normalize_marker, parse_label
from quirework.operators.spread import running_sum


def sibling_gaps(rows: DataFrame, by: list[str], order: list[str], marker: str, max_gap: int = 4) -> DataFrame:
    """``by``, ``prev_marker``, ``missing``, ``next_marker`` of the markers missing between neighbours."""
    w = W.partitionBy(*by).orderBy(*order)
    key = normalize_marker(F.col(marker))
    r = rows.withColumn("_k", key).withColumn("_pk", F.lag("_k").over(w)).withColumn("_pm", F.lag(marker).over(w))
    r = r.where("_k IS NOT NULL AND _pk IS NOT NULL")
    return r.select(*by, F.coalesce("_pm", "_pk").alias("prev_marker"), F.explode(between(F.col("_pk"), F.col("_k"), max_gap)).alias("missing"), F.coalesce(marker, "_k").alias("next_marker"))


def sibling_groups(kept: DataFrame, by: list[str], order: list[str], level: str, max_level: int = 8) -> DataFrame:
    """``parent_pos`` and the group of each kept candidate: its nearest open row of a lower level, levels not clamped.

    A row of level l closes all open rows of level l or more, so the row of level k is open if no row of a
    level of k or less came after it.
    """
    w = W.partitionBy(*by).orderBy(*order)
    rows = kept.withColumn("pos", F.row_number().over(w))
    before = w.rowsBetween(W.unboundedPreceding, -1)
    last = [F.last(F.when(F.col(level) <= k, F.struct(F.col("pos").alias("p"), F.col(level).alias("l"))), ignorenulls=True).over(before) for k in range(1, max_level)]
    # the parent of a row of level l is the last row of a level of l - 1 or less
    parent = F.lit(None).cast("int")
    for k, x in enumerate(last, 1):
        parent = F.when(F.col(level) == k + 1, x["p"]).otherwise(parent)
    rows = rows.withColumn("parent_pos", parent)
    return rows.withColumn("group_key", F.concat(F.coalesce(F.col("parent_pos").cast("string"), F.lit("root")), F.lit("@"), F.col(level).cast("string")))


def label_findings(pages: DataFrame, by: list[str]) -> DataFrame:
    """``by``, ``page``, ``code`` of printed labels that go backwards or jump against the labelled page before, whose prefix they share."""
    w = W.partitionBy(*by).orderBy("page")
    r = pages.withColumn("_l", parse_label(F.col("printed_label"))).where("_l IS NOT NULL")
    r = r.withColumn("_p", F.lag("_l").over(w)).withColumn("_pp", F.lag("page").over(w))
    r = r.where(F.col("_p.prefix") == F.col("_l.prefix"))
    v, p = F.col("_l.value"), F.col("_p.value")
    code = F.when(v < p, "label_backwards").when((v > p + (F.col("page") - F.col("_pp"))) & (v > p + 1), "label_jump")
    return r.select(*by, "page", p.alias("prev_value"), v.alias("value"), code.alias("code")).where("code IS NOT NULL")


def series_gaps(keys: DataFrame, by: list[str], most: int = 5) -> DataFrame:
    """Gaps in numbered attachments per kind: ``by``, ``kind``, ``prev_idx``, ``idx`` where more than 1 and at most ``most`` lie between.

    ``keys``: ``by``, ``kind``, ``idx`` (int); repeated rows count once.
    """
    w = W.partitionBy(*by, "kind").orderBy("idx")
    r = keys.where("idx IS NOT NULL").select(*by, "kind", "idx").distinct().withColumn("prev_idx", F.lag("idx").over(w))
    return r.where((F.col("idx") - F.col("prev_idx")).between(2, most)).select(*by, "kind", "prev_idx", "idx")


def fallback_level(number: Column, text: Column, kind: Column, prev_level: Column, deepest: int = 5) -> Column:
    """Level by numbering: dotted depth, 1 for headings, else one below the row before; within 1 to ``deepest``."""
    hint = depth_hint(F.coalesce(number, leading_marker(text)))
    dots = F.regexp_extract(hint, r"^dotted-(\d+)$", 1)
    level = F.when(dots != "", dots.cast("int")).when(kind == "heading", 1).otherwise(prev_level + 1)
    return F.greatest(F.lit(1), F.least(level, F.lit(deepest)))


def fallback_levels(rows: DataFrame, by: list[str], order: list[str], deepest: int = 5, decided: Column | None = None) -> DataFrame:
    """:func:`fallback_level` down a sequence: rows without a level of their own count on from the last that has one. ``decided``:
    levels known already, null elsewhere; they may be deeper than ``deepest``."""
    w = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    hint = depth_hint(F.coalesce("number", leading_marker(F.col("text"))))
    dots = F.regexp_extract(hint, r"^dotted-(\d+)$", 1)
    own = F.when(F.col("_dots") != "", F.greatest(F.lit(1), F.least(F.col("_dots").cast("int"), F.lit(deepest)))).when(F.col("kind") == "heading", 1)
    own = own if decided is None else F.coalesce(decided, own)
    r = rows.withColumn("_dots", dots).withColumn("_own", own).withColumn("_run", F.count("_own").over(w))
    within = W.partitionBy(*by, "_run").orderBy(*order)
    start = F.first("_own").over(within.rowsBetween(W.unboundedPreceding, 0))
    since = F.row_number().over(within) - F.when(start.isNotNull(), 1).otherwise(0)
    level = F.least(F.coalesce(start, F.lit(1)) + since, F.lit(deepest))
    return r.withColumn("level", F.coalesce("_own", level)).drop("_dots", "_own", "_run")


def capped_disputes(disputes: DataFrame, by: list[str], most: int = 10) -> DataFrame:
    """Disputes in order of weight (markers, labels, other marked ones, the rest), with ``taken`` for the first ``most`` of each page."""
    weight = F.when(F.col("type") == "marker_mismatch", 0).when(F.col("type") == "label", 1).when(F.col("marked"), 2).otherwise(3)
    rank = F.row_number().over(W.partitionBy(*by).orderBy(weight, "ord"))
    return disputes.withColumn("rank", rank).withColumn("taken", F.col("rank") <= most)


def text_budget(units: DataFrame, by: list[str], order: list[str], size: Column, budget: int = 90_000) -> DataFrame:
    """The units before the first that overflows the budget, in order; the one that overflows counts towards the sum. The order
    begins with an integer column."""
    return running_sum(units, by, order, size, "running").where(F.col("running") <= budget)


def first_success(attempts: DataFrame, by: list[str], rung: str, ok: Column, order: list[str]) -> DataFrame:
    """The successful attempt of the lowest rung per key, with the number of attempts made up to it."""
    w = W.partitionBy(*by).orderBy(rung, *order)
    r = attempts.withColumn("n_attempts", F.row_number().over(w)).where(ok)
    return r.withColumn("_r", F.row_number().over(W.partitionBy(*by).orderBy("n_attempts"))).where("_r = 1").drop("_r")


def ladder(attempts: DataFrame, by: list[str], rung: str, mode: str, outcome: str, order: list[str]) -> DataFrame:
    """:func:`first_success` of reads by rungs; after a truncated one the whole page is not read again, so those attempts don't count."""
    before = W.partitionBy(*by).orderBy(rung, *order).rowsBetween(W.unboundedPreceding, -1)
    cut = F.coalesce(F.max((F.col(outcome) == "truncated").cast("int")).over(before), F.lit(0))
    rows = attempts.withColumn("_cut", cut).where(~((F.col(mode) == "full") & (F.col("_cut") == 1))).drop("_cut")
    return first_success(rows, by, rung, F.col(outcome) == "ok", order)


def decided_levels(rows: DataFrame, decisions: DataFrame, by: list[str], order: list[str], id_: str, deepest: int = 5) -> DataFrame:
    """Candidates with the ``level``, ``number``, ``title`` and ``source`` of their decisions; those without one get a level by numbering.

    ``decisions``: by, ``<id_>``, keep, level, number, title, source; ids that no candidate has are left aside, of
    several for one id that of the least level counts. Candidates that are not kept, or decided to lie deeper than
    ``deepest``, are no nodes and come no more; the deeper ones still count for the level of what follows them.
    A level of less than 1 is 1; a number or title that is decided replaces that of the candidate.
    """
    d = decisions.groupBy(*by, id_).agg(F.min(F.struct("level", "keep", F.trim("number").alias("number"), F.trim("title").alias("title"), "source")).alias("_d"))
    kept = rows.join(d, [*by, id_], "left").where("_d IS NULL OR _d.keep")
    own = F.when(F.col("_d.level").isNotNull(), F.greatest(F.lit(1), F.col("_d.level")))
    r = fallback_levels(kept, by, order, deepest, own).where(F.col("level") <= deepest)
    one = lambda c: F.coalesce(F.when(F.col(f"_d.{c}") != "", F.col(f"_d.{c}")), F.col(c))
    return r.withColumn("number", one("number")).withColumn("title", one("title")).withColumn("source", F.coalesce("_d.source", F.lit("fallback"))).drop("_d")


def seam_duplicates(blocks: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Blocks of two half reads without exact repeats of the block kept before (kind, marker and text)."""
    w = W.partitionBy(*by).orderBy(*order)
    same = F.col("kind").eqNullSafe(F.lag("kind").over(w)) & F.col("marker").eqNullSafe(F.lag("marker").over(w)) & F.trim("text").eqNullSafe(F.lag(F.trim("text")).over(w)) & (F.row_number().over(w) > 1)
    return blocks.withColumn("_same", same).where(~F.col("_same")).drop("_same")


def remap_box(box: Column, bottom: Column) -> Column:
    """Box ``[ymin, xmin, ymax, xmax]`` of a half page on the whole page; boxes without four numbers become null."""
    y = lambda i: F.least(F.lit(1000), F.round(F.element_at(box, i) * 0.55 + F.when(bottom, 450).otherwise(0)).cast("int"))
    return F.when(F.size(box) == 4, F.array(y(1), F.element_at(box, 2), y(3), F.element_at(box, 4)))
