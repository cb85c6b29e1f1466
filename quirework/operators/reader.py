"""The reader layer: calls of an external page reader come as a replay table keyed by content hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PAGE_READ = "page_type string, blocks int, languages array<string>"


def cache_key(*parts: Column) -> Column:
    """Hash of everything that determines a call's answer."""
    return F.substring(F.sha2(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256), 1, 24)


def tolerant_json(text: Column) -> Column:
    """The JSON text of a response: as it is, without code fences, or its outermost braces; null if none parses."""
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)```", 1)
    braces = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    ok = lambda c: F.when(F.try_parse_json(c).isNotNull(), c)
    return F.coalesce(ok(text), ok(F.when(fenced != "", fenced)), ok(F.when(braces != "", braces)))


def calls(replay: DataFrame) -> DataFrame:
    """One row per key: the latest of the calls that were sent twice."""
    w = W.partitionBy("cache_key").orderBy(F.desc("called_at"), "response_json")
    return replay.where("cache_key IS NOT NULL").withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def outcomes(replay: DataFrame) -> DataFrame:
    """``outcome`` per call: truncated, blocked, invalid, empty or ok, in this order; ``parsed`` only where ok.

    A truncated answer is never parsed.
    """
    r = calls(replay).withColumn("_j", tolerant_json(F.col("response_json")))
    outcome = (
        F.when(F.col("finish_reason") == "MAX_TOKENS", "truncated")
        .when(F.col("finish_reason").isin("SAFETY", "RECITATION", "OTHER"), "blocked")
        .when(F.col("response_json").isNull() | (F.trim("response_json") == ""), "empty")
        .when(F.col("_j").isNull(), "invalid")
        .otherwise("ok")
    )
    return r.withColumn("outcome", outcome).withColumn("parsed", F.when(F.col("outcome") == "ok", F.from_json("_j", PAGE_READ))).drop("_j")


def page_diagnosis(pages: DataFrame, blank_below: float = 0.0003) -> DataFrame:
    """``diagnosis`` of each page read (``outcome``, ``ink_ratio``, ``n_blocks``): blank pages aside, a failed call says why; an inked page without blocks is suspect."""
    d = (
        F.when(F.col("ink_ratio") < blank_below, "blank")
        .when(F.col("outcome").isin("truncated", "blocked", "invalid", "empty"), F.col("outcome"))
        .when(F.col("degenerate"), "degenerate")
        .when((F.col("n_blocks") == 0) & (F.col("ink_ratio") > 4 * blank_below), "empty_for_inked")
        .otherwise("ok")
    )
    return pages.withColumn("diagnosis", d)


def recovery_plan(failures: DataFrame) -> DataFrame:
    """The order of recovery of each failure, as ``steps``: split first on overflow, never on recitation, text layer last."""
    plan = lambda *xs: F.array(*map(F.lit, xs))
    return failures.withColumn("steps", F.when(F.col("reason").contains("MAX_TOKENS"), plan("split", "text_layer")).when(F.col("reason").contains("RECITATION"), plan("sentinel", "reread", "text_layer")).otherwise(plan("reread", "split", "text_layer")))


def hunt_eligible(gaps: DataFrame, most: int = 8) -> DataFrame:
    """Gaps whose pages (``page_from`` to ``page_to``) are few enough to be looked for; the others are only reported."""
    return gaps.withColumn("hunted", F.col("page_to") - F.col("page_from") + 1 <= most)


def confirmed(hits: DataFrame, scans: DataFrame) -> DataFrame:
    """Hunt results with what becomes of them: not found, obscured, unconfirmed by the second reader, or recovered.

    ``hits``: bundle_id, missing, page, found, obscured; ``scans``: bundle_id, page, marker (canonical).
    """
    seen = scans.select("bundle_id", "page", F.col("marker").alias("missing")).distinct().withColumn("_seen", F.lit(True))
    rows = hits.join(seen, ["bundle_id", "page", "missing"], "left")
    return rows.withColumn("outcome", F.when(~F.coalesce("found", F.lit(False)) | F.col("page").isNull(), "numbering_gap").when(F.col("obscured"), "gap_found_obscured").when(F.col("_seen").isNull(), "gap_found_unconfirmed").otherwise("gap_recovered")).drop("_seen")


def arbitration(disputes: DataFrame) -> DataFrame:
    """``resolution`` of each dispute from the re-read line (``reread_marker``, ``reread_score``, ``obscured``) against both reads.

    The re-read decides for the read whose marker it shows; a line that it does not find stays unconfirmed.
    """
    m = F.col("reread_marker")
    r = (
        F.when(F.col("obscured"), "obscured")
        .when(F.col("reread_score").isNull() | (F.col("reread_score") < 0.6), "not_confirmed")
        .when(m.eqNullSafe(F.col("a_marker")), "confirmed_first")
        .when(m.eqNullSafe(F.col("b_marker")), "corrected_by_arbitration")
        .otherwise("marker_uncertain")
    )
    return disputes.withColumn("resolution", r)


def judged(candidates: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Candidates after verdicts by echoed id: dropped only where a verdict says so, renamed and revalued where it does, else as they are."""
    from quirework.functions.dates import valid_iso

    v = verdicts.select("id", "keep", F.col("name").alias("_n"), F.col("iso_value").alias("_v"))
    rows = candidates.join(v, "id", "left").where("keep IS NULL OR keep")
    return rows.withColumn("name", F.coalesce(F.when(F.trim("_n") != "", F.trim("_n")), "name")).withColumn("iso_value", F.coalesce(valid_iso(F.col("_v")), "iso_value")).drop("keep", "_n", "_v")
