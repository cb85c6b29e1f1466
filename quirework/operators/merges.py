"""Roll-ups, precedence merges and argmax choices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quirework.functions.dates import canonical_name

# Which division's date governs, and whose parties are taken.
DATE_RANK = {"CONTRACT_AGREEMENT": 3, "SCC": 3, "LETTER_OF_AWARD": 2, "LETTER_OF_INTENT": 2, "GCC": 1}
PARTY_RANK = {"CONTRACT_AGREEMENT": 3, "RECITALS": 3, "LETTER_OF_AWARD": 2, "LETTER_OF_INTENT": 2}
LEGIBILITY = {"clear": 0, "partial": 1, "illegible": 2}


def ranked(c: Column, table: dict[str, int], other: int = 0) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), F.upper(c)), F.lit(other))


def counts(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("n"))


def cost_rollup(calls: DataFrame, prices: DataFrame, by: list[str]) -> DataFrame:
    """Calls, tokens and USD per group. ``prices``: ``(model, usd_in, usd_out)`` per million tokens, few rows; thinking counts as output. Unknown models cost nothing."""
    p = calls.join(F.broadcast(prices), "model", "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    usd = F.sum(z("input_tokens") / 1e6 * z("usd_in") + (z("output_tokens") + z("thinking_tokens")) / 1e6 * z("usd_out"))
    return p.groupBy(*by).agg(F.count("*").alias("n_calls"), F.sum(z("input_tokens")).alias("input_tokens"), F.sum(z("output_tokens") + z("thinking_tokens")).alias("output_tokens"), F.round(usd, 4).alias("usd"))


def worst_legibility(rows: DataFrame, by: list[str]) -> DataFrame:
    """The worst legibility per group; null counts as clear."""
    worst = F.max(F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in LEGIBILITY.items() for x in kv]), F.col("legibility")), F.lit(0)))
    return rows.groupBy(*by).agg(F.element_at(F.array(*map(F.lit, LEGIBILITY)), worst + 1).alias("legibility"))


def date_merge(rows: DataFrame, by: list[str]) -> DataFrame:
    """One value per group: none if no row has one, the only one, the one that the highest division's rows agree on, else the
    earliest, provisionally. Columns: ``iso_value``, ``n_values``, ``note``. ``rows``: by, iso_value, division_type."""
    r = rows.withColumn("_rank", F.when(F.col("iso_value").isNotNull(), ranked(F.col("division_type"), DATE_RANK)))
    r = r.withColumn("_top", F.max("_rank").over(W.partitionBy(*by)))
    top = F.when(F.col("_rank") == F.col("_top"), F.col("iso_value"))
    g = r.groupBy(*by).agg(F.min("iso_value").alias("_least"), F.countDistinct("iso_value").alias("n_values"), F.max("_top").alias("_top"), F.countDistinct(top).alias("_nt"), F.min(top).alias("_tv"))
    governs = (F.col("_top") > 0) & (F.col("_nt") == 1)
    value = F.when(F.col("n_values") <= 1, F.col("_least")).when(governs, F.col("_tv")).otherwise(F.col("_least"))
    note = F.when(F.col("n_values") == 0, "no value").when(F.col("n_values") == 1, "single value").when(governs, "precedence").otherwise("conflict")
    return g.select(*by, value.alias("iso_value"), "n_values", note.alias("note"))


def display_names(names: DataFrame, by: list[str], name: str) -> DataFrame:
    """The cleanest spelling per group: not all upper-case, no parentheses, fewest lower-case words, shortest; ties by the text."""
    n = F.trim(F.col(name))
    letters = F.regexp_replace(n, r"[^A-Za-z]", "")
    upper = (letters != "") & (n == F.upper(n))
    lower_words = F.size(F.filter(F.split(n, r"\s+"), lambda w: w.rlike("^[a-z]")))
    rank = F.struct(upper.cast("int").alias("a"), n.rlike(r"[()]").cast("int").alias("b"), lower_words.alias("c"), F.length(n).alias("d"), n.alias("e"))
    best = names.where(n != "").groupBy(*by).agg(F.min(rank).alias("_r"))
    shown = F.col("_r.e")
    return best.select(*by, F.when((F.col("_r.a") == 1) & (F.length(shown) > 5), F.initcap(F.lower(shown))).otherwise(shown).alias("display_name"))


def registry(rows: DataFrame, by: list[str]) -> DataFrame:
    """One entry per canonical name: its cleanest spelling and its value, a value before none. ``rows``: by, name, iso_value."""
    keyed = rows.withColumn("name_key", canonical_name(F.col("name"))).where("name_key <> ''")
    value = keyed.groupBy(*by, "name_key").agg(F.min("iso_value").alias("iso_value"))
    return display_names(keyed, [*by, "name_key"], "name").join(value, [*by, "name_key"])


def pick_parties(parties: DataFrame, by: list[str], source: str, order: list[str]) -> DataFrame:
    """One client and one contractor per group, from the source of the highest rank times ten plus completeness; the first
    source and row win ties. Where that source names no side, its first two parties. ``parties`` has side, name and division_type."""
    named = parties.where("name IS NOT NULL AND name <> ''")
    both = F.when(F.countDistinct(F.when(F.col("side").isin("CLIENT", "CONTRACTOR"), F.col("side"))) == 2, 2).otherwise(F.count("*"))
    score = named.groupBy(*by, source).agg((F.max(ranked(F.col("division_type"), PARTY_RANK)) * 10 + both).alias("_score"))
    best = score.withColumn("_r", F.row_number().over(W.partitionBy(*by).orderBy(F.desc("_score"), source))).where("_r = 1").select(*by, source)
    sided = F.coalesce(F.col("side").isin("CLIENT", "CONTRACTOR"), F.lit(False))
    rows = named.join(best, [*by, source]).withColumn("_s", sided).withColumn("_any", F.max("_s").over(W.partitionBy(*by)))
    rows = rows.withColumn("_r", F.row_number().over(W.partitionBy(*by, "_s", F.when(F.col("_any"), F.col("side"))).orderBy(*order)))
    return rows.where("_s AND _r = 1 OR NOT _any AND _r <= 2").drop("_r", "_s", "_any")


def run_status(pages: DataFrame, clauses: DataFrame, by: list[str]) -> DataFrame:
    """Failed pages and clauses per group; ``INCOMPLETE`` only with failures and no clause."""
    p = pages.groupBy(*by).agg(F.count("*").alias("n_pages"), F.sum((F.col("status") == "failed").cast("int")).alias("n_failed"))
    c = clauses.groupBy(*by).agg(F.count("*").alias("n_clauses"))
    rows = p.join(c, by, "left").na.fill(0, ["n_clauses"])
    return rows.withColumn("status", F.when((F.col("n_failed") > 0) & (F.col("n_clauses") == 0), "INCOMPLETE").otherwise("COMPLETE"))


def reason_counts(rows: DataFrame, reason: str) -> DataFrame:
    """Counts by what stands before the first colon."""
    return rows.where(F.col(reason).isNotNull()).groupBy(F.trim(F.substring_index(reason, ":", 1)).alias("reason")).agg(F.count("*").alias("n"))


def distinct_sorted(rows: DataFrame, by: list[str], arrays: str) -> DataFrame:
    """Sorted distinct entries of an array column over a group."""
    return rows.select(*by, F.explode(arrays).alias("_x")).where("_x IS NOT NULL").groupBy(*by).agg(F.array_sort(F.collect_set("_x")).alias(arrays))
