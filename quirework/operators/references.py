"""References by name to records that do not exist, as signed counts.

References and records become deltas of two counts per key: a record adds 1 to the existence count when it is
created and takes it away when it is deleted, a reference does so with the reference count when it is made (for
a page: checked) and withdrawn. A key with a positive reference count and no existence is an orphan. The counts
up to now are sums of the deltas, in batch or as the state of a stream (:func:`signed_counts`); those at the time
of each delta are running sums (:func:`states`), formed in two steps, over days and within a day, so that a key
with very many deltas is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Kinds of targets and their spellings.
KINDS = "annexure|annex|schedule|appendix|form|exhibit|clauses|clause|cl"
INDEX = r"[0-9]+(?:\s*\.\s*[0-9]+)*|[ivx]+|[a-h]"
NAMED = rf"(?:^|[^a-z0-9])({KINDS})(?:[\s:.‐-―-]|\bno\b|\bnos\b|\bnumber\b)*(?<![a-z0-9])({INDEX})(?![a-z0-9])"
BARE = r"^\s*([0-9]+(?:\s*\.\s*[0-9]+)*)\s*\.?\s*$"


def _count(c: Column, what: str) -> Column:
    return F.length(c) - F.length(F.regexp_replace(c, what, ""))


def index_value(raw: Column) -> Column:
    """Canonical index: dotted numbers without leading zeros and a trailing ``.0``, I/V/X as numbers, A-H as letters."""
    raw = F.lower(F.regexp_replace(raw, r"\s", ""))
    roman = 10 * _count(raw, "x") + 5 * _count(raw, "v") + _count(raw, "i") - F.length(F.regexp_replace(raw, "[^i]|i(?![vx])", "")) * 2
    number = F.regexp_replace(F.regexp_replace(raw, r"(^|\.)0+(?=[0-9])", "$1"), r"\.0$", "")
    return F.when(raw == "", None).when(raw.rlike("^[ivx]+$"), roman.cast("string")).otherwise(number)


def target(text: Column, bare_is_clause: bool = False) -> Column:
    """``struct(kind, idx)`` that a reference or marker names, or null if it names no numbered target."""
    low = F.lower(text)
    kind, idx = F.regexp_extract(low, NAMED, 1), F.regexp_extract(low, NAMED, 2)
    kind = F.when(kind == "annex", "annexure").when(kind.isin("clauses", "cl"), "clause").otherwise(kind)
    named = F.when(idx != "", F.struct(kind.alias("kind"), index_value(idx).alias("idx")))
    if not bare_is_clause:
        return named
    bare = F.regexp_extract(low, BARE, 1)
    return F.when(bare != "", F.struct(F.lit("clause").alias("kind"), index_value(bare).alias("idx"))).otherwise(named)


def page_references(pages: DataFrame) -> DataFrame:
    """``(page_id, ref_pos, bundle_id, kind, idx, at)``: entries of cross_references that name a numbered target.

    Entries are counted from 1 with all others; null, empty and unnumbered ones give no row.
    """
    rows = pages.select("page_id", "bundle_id", F.col("checked_at").alias("at"), F.posexplode("cross_references").alias("p", "entry"))
    rows = rows.withColumn("t", target(F.col("entry"))).where("t IS NOT NULL")
    return rows.select("page_id", (F.col("p") + 1).alias("ref_pos"), "bundle_id", "t.kind", "t.idx", "at").distinct()


def clause_deltas(clauses: DataFrame) -> DataFrame:
    """``(bundle_id, kind, idx, at, delta)``: +1 at creation and -1 at deletion of each clause with a marker.

    A clause without a creation time, or deleted before it was created, never exists. Rows sent twice raise
    both counts alike, so they need no removal.
    """
    rows = clauses.select("bundle_id", target(F.col("marker"), True).alias("t"), "created_at", "deleted_at")
    rows = rows.where("t IS NOT NULL AND created_at IS NOT NULL AND (deleted_at IS NULL OR deleted_at > created_at)")
    pair = F.array(F.struct(F.col("created_at").alias("at"), F.lit(1).alias("delta")), F.struct(F.col("deleted_at").alias("at"), F.lit(-1).alias("delta")))
    return rows.select("bundle_id", "t.kind", "t.idx", F.explode(pair).alias("d")).select("bundle_id", "kind", "idx", "d.at", "d.delta").where("at IS NOT NULL")


KEY = ["bundle_id", "kind", "idx"]
DELTAS = "bundle_id string, kind string, idx string, at timestamp, refs bigint, existing bigint"


def changes(refs: DataFrame, deltas: DataFrame) -> DataFrame:
    """Deltas of both counts, :data:`DELTAS` and what else ``refs`` has (null for records).

    ``refs``: key, ``at`` and, if references can be withdrawn, ``withdrawn_at``; ``deltas`` as of :func:`clause_deltas`.
    The withdrawal of a reference is a delta of its own, of which the other columns are null.
    """
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    cols = [c for c in refs.columns if c not in (*KEY, "at", "withdrawn_at")]
    none = [F.lit(None).cast(refs.schema[c].dataType).alias(c) for c in cols]
    out = refs.select(*KEY, "at", one.alias("refs"), zero.alias("existing"), *cols)
    if "withdrawn_at" in refs.columns:
        out = out.unionByName(refs.where("withdrawn_at IS NOT NULL").select(*KEY, F.col("withdrawn_at").alias("at"), (-one).alias("refs"), zero.alias("existing"), *none))
    return out.unionByName(deltas.groupBy(*KEY, "at").agg(F.sum("delta").alias("existing")).select(*KEY, "at", zero.alias("refs"), "existing", *none))


def states(changed: DataFrame) -> DataFrame:
    """``changed`` with ``n_refs`` and ``n_existing``: the counts of each delta's key at its time, all deltas of that time included.

    Deltas without a time or a bundle change nothing and have the counts 0. Nulls in the rest of a key are a value of their own.
    """
    rows = changed.withColumn("day", F.to_date("at"))
    known = F.col("at").isNotNull() & F.col("bundle_id").isNotNull()
    within = W.partitionBy(*KEY, "day").orderBy("at").rangeBetween(W.unboundedPreceding, 0)
    days = rows.where(known).groupBy(*KEY, "day").agg(F.sum("refs").alias("r"), F.sum("existing").alias("e"))
    up_to = W.partitionBy(*KEY).orderBy("day").rowsBetween(W.unboundedPreceding, 0)
    before = days.select(*KEY, "day", (F.sum("r").over(up_to) - F.col("r")).alias("_r"), (F.sum("e").over(up_to) - F.col("e")).alias("_e"))
    rows = rows.where(known).withColumn("n_refs", F.sum("refs").over(within)).withColumn("n_existing", F.sum("existing").over(within))
    # null-safe also because a plain join would have the long expressions of the keys tested for null in every scan
    same = [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in (*KEY, "day")]
    rows = rows.alias("x").join(before.alias("y"), same).select(*(F.col(f"x.{c}") for c in changed.columns), (F.col("n_refs") + F.col("_r")).alias("n_refs"), (F.col("n_existing") + F.col("_e")).alias("n_existing"))
    zero = F.lit(0).cast("long")
    lost = changed.where(~known).withColumn("n_refs", zero).withColumn("n_existing", zero)
    return rows.unionByName(lost)


ORPHAN = "n_refs > 0 AND n_existing <= 0"  #: references, but no record


def made(pages: DataFrame, clauses: DataFrame) -> DataFrame:
    """Each reference with the counts of its key when it was made, and ``dangling``: it then was an orphan, or its time is not known."""
    rows = states(changes(page_references(pages), clause_deltas(clauses))).where("refs > 0")
    return rows.withColumn("dangling", F.expr(ORPHAN) | F.col("at").isNull() | F.col("bundle_id").isNull())


def dangling(pages: DataFrame, clauses: DataFrame) -> DataFrame:
    """``(page_id, ref_pos, bundle_id, kind, idx, at)`` of the references whose target does not exist when checked."""
    return made(pages, clauses).where("dangling").select("page_id", "ref_pos", *KEY, "at")


def dangling_report(pages: DataFrame, clauses: DataFrame) -> DataFrame:
    """Per kind of target and month of the check: references, dangling ones and their share."""
    table = F.when(F.col("kind") == "clause", "clauses").otherwise("attachments")
    bad = F.sum(F.col("dangling").cast("long"))
    return made(pages, clauses).groupBy(table.alias("table_name"), "kind", F.date_format("at", "yyyy-MM").alias("month")).agg(F.count("*").alias("n_references"), bad.alias("n_dangling"), (bad / F.count("*")).alias("share"))


def signed_counts(changed: DataFrame) -> DataFrame:
    """Per key the reference and existence counts after all deltas; see :data:`ORPHAN`.

    Sums of signed deltas: further ones can be added to a stored result, and the same plan runs on a stream.
    """
    return changed.groupBy(*KEY).agg(F.sum("refs").alias("n_refs"), F.sum("existing").alias("n_existing"))
