"""Texts cut off by a field limit or in transfer.

Lengths of texts are counted per source, in characters and in bytes, apart for those with and without a proper
end. A length that far more unended texts have than the lengths around it is a limit of the source. The lengths
off the limits tell the source's habit: whether its whole texts end properly. A text is cut if it has a sign of
omission, if it has no end at a limit of its source, or if it has no end off the limits where the source's whole
texts have one. Everything is native SQL; counts are made before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Signs of omission, ends of complete texts and abbreviations that end in a full stop.
SIGN = r"(?:…|\.\.\.|�|\[(?:\.\.\.|…)\])\s*$"
END = r"[.!?:|][\"')\]’”]*\s*$"
ITEM_END = r";[\"')\]’”]*\s*$|;\s*(?:and|or)\s*$"
ITEM = r"(?m)^\s*(?:[-•*]|\(?[0-9A-Za-z]{1,5}[.)])\s"
ABBREVIATION = r"(?:^|[\s(])(?:Cl|Cls|No|Nos|Fig|Figs|cf|Art|Sec|viz|approx|resp|M/s|Messrs|Ref)\.\s*$"


def has_sign(text: Column) -> Column:
    return text.rlike(SIGN)


def table_is_open(text: Column) -> Column:
    """A markdown table whose last row has fewer cells than its first."""
    bars = lambda c: F.length(c) - F.length(F.replace(c, F.lit("|"), F.lit("")))
    rows = F.split(F.rtrim(text), r"\n")
    return text.rlike(r"^\s*\|") & (bars(F.element_at(rows, -1)) < bars(F.element_at(rows, 1)))


def has_end(text: Column, item: Column | None = None) -> Column:
    """The text ends as a sentence, heading of a list or table row does, or, if it is a list item, as those do.

    ``item``: whether it is one; else a line of it must begin like one.
    """
    item = text.rlike(ITEM) if item is None else item
    ends = text.rlike(END) | (item & text.rlike(ITEM_END))
    return ends & ~text.rlike(ABBREVIATION) & ~has_sign(text) & ~table_is_open(text)


MEASURES = ["n_chars", "n_bytes", "signed", "ended"]


def measured(texts: DataFrame) -> DataFrame:
    """``texts`` with what the tests need in place of the text: ``n_chars``, ``n_bytes`` (0 for null and blank texts), ``signed`` and
    ``ended``. Rows stay narrow in every later join. A column ``is_item`` says which are list items (see :func:`has_end`)."""
    t = F.when(F.trim("text") != "", F.col("text"))
    ended = has_end(t, F.coalesce("is_item", F.lit(False)) if "is_item" in texts.columns else None)
    zero = lambda c: F.coalesce(c, F.lit(0))
    return texts.select(*(c for c in texts.columns if c not in ("text", "is_item", *MEASURES)), zero(F.length(t)).alias("n_chars"), zero(F.octet_length(t)).alias("n_bytes"), F.coalesce(has_sign(t), F.lit(False)).alias("signed"), F.coalesce(ended, F.lit(False)).alias("ended"))


def histograms(rows: DataFrame) -> DataFrame:
    """``(source, unit, length, n_unended, n_ended)``: texts by their length in ``chars`` and ``bytes``. ``rows``: ``source`` and the
    columns of :func:`measured`; null and blank texts are no part of it."""
    unit = F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("n_chars").alias("length")), F.struct(F.lit("bytes").alias("unit"), F.col("n_bytes").alias("length"))))
    counts = rows.where("n_chars > 0").groupBy("source", "n_chars", "n_bytes").agg(F.sum((~F.col("ended")).cast("long")).alias("u"), F.sum(F.col("ended").cast("long")).alias("e"))
    return counts.select("source", unit.alias("x"), "u", "e").groupBy("source", "x.unit", "x.length").agg(F.sum("u").alias("n_unended"), F.sum("e").alias("n_ended"))


def limits(counts: DataFrame, least: int = 5, around: int = 12, sigmas: float = 6.0) -> DataFrame:
    """``(source, unit, length, n, expected)``: lengths at which a source cuts texts off, from its :func:`histograms`.

    A length is a limit if at least ``least`` unended texts have it and their number exceeds the mean of the lengths
    within ``around`` of it (itself left out, lengths without a text counting as 0) by ``sigmas`` standard
    deviations of a Poisson count.
    """
    near = W.partitionBy("source", "unit").orderBy("length").rangeBetween(-around, around)
    counts = counts.where("n_unended > 0").select("source", "unit", "length", F.col("n_unended").alias("n"))
    counts = counts.withColumn("expected", (F.sum("n").over(near) - F.col("n")) / (2 * around))
    return counts.where((F.col("n") >= least) & (F.col("n") > F.col("expected") + sigmas * F.sqrt(F.greatest(F.col("expected"), F.lit(0.25)))))


def habits(counts: DataFrame, limits_of: DataFrame, usual: float = 0.5, enough: int = 20) -> DataFrame:
    """``(source, open_share, ends_usual)``: the share of unended texts off the source's limits, and whether whole texts of the
    source end properly: false only if the share is above ``usual`` among at least ``enough`` texts."""
    off = counts.where("unit = 'chars'").join(limits_of.where("unit = 'chars'").select(F.col("source").alias("_s"), F.col("length").alias("_l")), F.col("source").eqNullSafe(F.col("_s")) & (F.col("length") == F.col("_l")), "left_anti")
    n = F.sum(F.col("n_unended") + F.col("n_ended"))
    sums = off.groupBy("source").agg(F.sum("n_unended").alias("_u"), n.alias("_n"))
    return sums.select("source", (F.col("_u") / F.col("_n")).alias("open_share"), ((F.col("_n") < enough) | (F.col("_u") <= usual * F.col("_n"))).alias("ends_usual"))


def cut_texts(rows: DataFrame, limits_of: DataFrame, habits_of: DataFrame) -> DataFrame:
    """``rows`` with ``cut``, ``reason`` (``sign``, ``limit``, ``open`` or null) and ``at_limit`` in place of the measures.

    ``rows`` has ``source``, the columns of :func:`measured` and any others. Null and blank texts are not cut. Without
    an end a text is cut at a limit of its source (``limit``), and off the limits if the source's whole texts end
    properly (``open``). ``limits_of`` and ``habits_of`` are aggregated (a few rows per source) and joined by source.
    """
    side = lambda unit, s, n, flag: limits_of.where(F.col("unit") == unit).select(F.col("source").alias(s), F.col("length").alias(n), F.lit(True).alias(flag))
    df = rows.join(side("chars", "_s1", "_l1", "_c"), F.col("source").eqNullSafe(F.col("_s1")) & (F.col("n_chars") == F.col("_l1")), "left")
    df = df.join(side("bytes", "_s2", "_l2", "_b"), F.col("source").eqNullSafe(F.col("_s2")) & (F.col("n_bytes") == F.col("_l2")), "left")
    df = df.join(habits_of.select(F.col("source").alias("_s3"), F.col("ends_usual").alias("_u")), F.col("source").eqNullSafe(F.col("_s3")), "left")
    there = F.col("n_chars") > 0
    limit = F.coalesce("_c", F.lit(False)) | F.coalesce("_b", F.lit(False))
    reason = F.when(~there, None).when(F.col("signed"), "sign").when(F.col("ended"), None).when(limit, "limit").when(F.coalesce("_u", F.lit(True)), "open")
    df = df.withColumn("reason", reason).withColumn("at_limit", there & limit)
    return df.withColumn("cut", F.col("reason").isNotNull()).drop(*MEASURES, "_s1", "_l1", "_c", "_s2", "_l2", "_b", "_s3", "_u")


def detected(rows: DataFrame) -> DataFrame:
    """:func:`cut_texts` by the limits and habits of ``rows`` themselves (best written before: they are read several times)."""
    counts = histograms(rows)
    found = limits(counts)
    return cut_texts(rows, found, habits(counts, found))


def continued(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """``(bundle_id, page, idx)`` of the last block of each page whose next page begins with its continuation."""
    last = blocks.groupBy("bundle_id", "page").agg(F.max("idx").alias("idx"))
    goes = pages.where("first_continues").select("bundle_id", (F.col("page") - 1).alias("page")).distinct()
    return last.join(goes, ["bundle_id", "page"])


def with_calls(blocks: DataFrame, replay: DataFrame, key: str = "call_key") -> DataFrame:
    """``blocks`` with ``model`` and ``finish_reason`` of their call, of the latest one where a key was called again; null where the
    call is unknown. Blocks without a key are kept out of the join."""
    latest = F.max(F.struct("called_at", "model", "finish_reason"))
    calls = replay.where("cache_key IS NOT NULL").groupBy("cache_key").agg(latest.alias("_c")).select("cache_key", "_c.model", "_c.finish_reason")
    known = blocks.where(F.col(key).isNotNull()).join(calls, F.col(key) == F.col("cache_key"), "left").drop("cache_key")
    none = F.lit(None).cast("string")
    return known.unionByName(blocks.where(F.col(key).isNull()).select("*", none.alias("model"), none.alias("finish_reason")))


def report(found: DataFrame, by: list[str]) -> DataFrame:
    """Records, cut ones, those at a limit and the share of cut ones per group."""
    n, cut = F.count("*"), F.sum(F.col("cut").cast("long"))
    return found.groupBy(*by).agg(n.alias("n_records"), cut.alias("n_cut"), F.sum((F.col("cut") & F.col("at_limit")).cast("long")).alias("n_at_limit"), (cut / n).alias("share_cut"))
