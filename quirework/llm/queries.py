"""Queries of the operators of this package over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm import chunking, leakage, mixing, namelinks, neardup, scanrepair, subjects, truncation
from quirework.runtime import materialize, table


def _clauses(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "clauses").select(F.col("clause_id").alias("id"), "title", "text")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = neardup.edited_pairs(_clauses(spark, d))
    return pairs.select(F.col("id_a").alias("clause_id_a"), F.col("id_b").alias("clause_id_b"))


def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.copy_groups(_clauses(spark, d)).withColumnRenamed("id", "clause_id")


def p1_runs(spark: SparkSession, d: str) -> DataFrame:
    return neardup.join_runs(_clauses(spark, d))


def _pieces(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "clauses").where("length(text) > 2000 OR length(full_text) > 2000")
    field = lambda name: F.struct(F.lit(name).alias("field_name"), F.col(name).alias("value"))
    long = c.select("clause_id", F.explode(F.array(field("text"), field("full_text"))).alias("f")).select("clause_id", "f.*").where("length(value) > 2000")
    return chunking.pieces(long, ["clause_id", "field_name"], "value", limit=2000, overlap=200)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _pieces(spark, d).where("n_pieces > 1").select("clause_id", "field_name").distinct()


def p2_pieces(spark: SparkSession, d: str) -> DataFrame:
    return _pieces(spark, d).distinct()


def _scanned(spark: SparkSession, d: str) -> DataFrame:
    """The texts of problem 3 with their repair."""
    blocks = table(spark, d, "blocks")
    body = blocks.where(F.col("kind").isin(*scanrepair.Params().kinds)).select(F.lit("blocks").alias("table_name"), F.col("block_key").alias("row_id"), "text")
    texts = body.union(table(spark, d, "clauses").select(F.lit("clauses"), "clause_id", "text")).union(table(spark, d, "subclauses").select(F.lit("subclauses"), "subclause_id", "text"))
    return scanrepair.repaired(texts, blocks.where("kind IN ('header', 'footer', 'page_number')").select("text"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _scanned(spark, d).where("broken_word OR misread_word OR furniture").select("table_name", "row_id").distinct()


def p3_repaired(spark: SparkSession, d: str) -> DataFrame:
    return _scanned(spark, d).distinct()


def _linked(spark: SparkSession, d: str) -> DataFrame:
    parties, pages = table(spark, d, "parties"), table(spark, d, "pages").where("stamp_paper IS NOT NULL")
    own = parties.select(F.concat(F.lit("p:"), F.col("party_id").cast("string")).alias("mention"), "bundle_id", "name")
    stamp = lambda n, c: pages.select(F.concat(F.lit("s:"), F.col("page_id").cast("string"), F.lit(f":{n}")), "bundle_id", F.col(f"stamp_paper.{c}"))
    mentions = own.union(stamp(1, "first_party")).union(stamp(2, "second_party")).where("name IS NOT NULL")
    return namelinks.link(mentions, parties.select("bundle_id", F.explode("aliases").alias("alias"), "name"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return namelinks.entity_pairs(materialize(_linked(spark, d)))


def p5_entities(spark: SparkSession, d: str) -> DataFrame:
    return namelinks.with_links(materialize(_linked(spark, d)))


def _block_cuts(spark: SparkSession, d: str) -> DataFrame:
    blocks = table(spark, d, "blocks").where(F.col("kind").isin(*scanrepair.Params().kinds))
    blocks = truncation.measured(blocks.select("block_key", "bundle_id", "page", "idx", "call_key", "text")).dropDuplicates(["block_key"])
    rows = materialize(truncation.with_calls(blocks, table(spark, d, "replay")).withColumn("source", F.col("model")))
    blocks = rows.select("bundle_id", "page", "idx")
    rows = truncation.detected(rows)
    goes = truncation.continued(blocks, table(spark, d, "pages")).withColumn("_goes", F.lit(True))
    rows = rows.join(goes, ["bundle_id", "page", "idx"], "left")
    return rows.withColumn("cut", F.col("cut") & F.col("_goes").isNull()).drop("_goes")


def _subclause_texts(spark: SparkSession, d: str) -> DataFrame:
    """Sub-clauses are list items, whose markers stand in a column of their own."""
    return truncation.measured(table(spark, d, "subclauses").select("subclause_id", "source", "text", F.lit(True).alias("is_item"))).dropDuplicates(["subclause_id"])


def _subclause_cuts(spark: SparkSession, d: str) -> DataFrame:
    return truncation.detected(materialize(_subclause_texts(spark, d)))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    blocks = _block_cuts(spark, d).where("cut").select(F.lit("blocks").alias("table_name"), F.col("block_key").alias("row_id"))
    return blocks.union(_subclause_cuts(spark, d).where("cut").select(F.lit("subclauses"), "subclause_id"))


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    none = F.lit(None).cast("string")
    blocks = truncation.report(_block_cuts(spark, d), ["model", "finish_reason"]).withColumn("table_name", F.lit("blocks")).withColumn("source", none)
    subs = truncation.report(_subclause_cuts(spark, d), ["source"]).withColumn("table_name", F.lit("subclauses")).withColumn("model", none).withColumn("finish_reason", none)
    return blocks.unionByName(subs)


def p6_limits(spark: SparkSession, d: str) -> DataFrame:
    return truncation.limits(truncation.histograms(_subclause_texts(spark, d)))


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).select("doc_id", "item_id").distinct()


def p8_spans(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).select("doc_id", "item_id", F.explode("spans").alias("s")).select("doc_id", "item_id", F.col("s.begin").alias("begin_char"), F.col("s.end").alias("end_char"))


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_items(_leaks(spark, d))


def _mix(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    sizes = mixing.token_counts(table(spark, d, "documents"), ["doc_id", "source"], "text")
    return mixing.mixed(sizes, table(spark, d, "mix_targets"))


def p9_selection(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[1]


def _subjects(spark: SparkSession, d: str) -> DataFrame:
    return subjects.assigned(table(spark, d, "documents"), table(spark, d, "subject_labels"), table(spark, d, "subject_areas"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return _subjects(spark, d).where(F.col("probability") >= subjects.Params().posterior).select("doc_id", "subject_id").distinct()


def p10_shares(spark: SparkSession, d: str) -> DataFrame:
    return subjects.shares(p10_found(spark, d), table(spark, d, "documents"), table(spark, d, "subject_areas"))


QUERIES = {q.__name__: q for q in (p1_found, p1_groups, p1_runs, p2_found, p2_pieces, p3_found, p3_repaired, p5_found, p5_entities, p6_found, p6_report, p6_limits, p8_found, p8_spans, p8_items, p9_selection, p9_shares, p10_found, p10_shares)}

_ITEM = r"(?m)^\s*(?:[-•*]|\(?[0-9A-Za-z]{1,5}[.)])\s"
_SIGN = r"(?:…|\.\.\.|�|\[(?:\.\.\.|…)\])\s*$"
_BARS = "length({0}) - length(replace({0}, '|', ''))"
_OPEN = f"""regexp_matches(text, '^\\s*\\|') AND {_BARS.format("string_split(rtrim(text), chr(10))[-1]")} < {_BARS.format("string_split(rtrim(text), chr(10))[1]")}"""
_ENDED = rf"""(regexp_matches(text, '[.!?:|]["'')\]’”]*\s*$') OR (is_item AND regexp_matches(text, ';["'')\]’”]*\s*$|;\s*(?:and|or)\s*$')))
  AND NOT regexp_matches(text, '(?:^|[\s(])(?:Cl|Cls|No|Nos|Fig|Figs|cf|Art|Sec|viz|approx|resp|M/s|Messrs|Ref)\.\s*$') AND NOT regexp_matches(text, '{_SIGN}') AND NOT ({_OPEN})"""
_SUB = "s AS (SELECT DISTINCT subclause_id, source, text, true AS is_item FROM subclauses)"

_PHRASES = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(regexp_replace(text, '[-‐‑\x{ad}¬][ \t]*\r?\n\s*|\x{ad}', '', 'g')), '[\p{L}\p{N}]+') AS w FROM documents),
dg AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM d),
p AS (SELECT item_id, regexp_extract_all(lower(passage), '[\p{L}\p{N}]+') AS w FROM eval_items),
pg AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM p),
n AS (SELECT item_id, count(*) AS n FROM pg GROUP BY item_id)
"""
_PAIRS = """WITH w AS (SELECT DISTINCT clause_id AS id, regexp_extract_all(lower(coalesce(title, '') || ' ' || coalesce(text, '')), '[a-z0-9]+') AS w FROM clauses WHERE clause_id IS NOT NULL AND len(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+')) >= 25),
g AS (SELECT DISTINCT id, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS g FROM w), n AS (SELECT id, count(*) AS n FROM g GROUP BY 1),
j AS (SELECT x.id AS a, y.id AS b, count(*) AS c FROM g x JOIN g y ON x.g = y.g AND x.id < y.id GROUP BY 1, 2), pairs AS (SELECT a, b FROM j JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE c * 2 >= x.n + y.n - c)
"""

ORACLES = {
    "p6_found": f"""WITH b AS (SELECT DISTINCT block_key, bundle_id, page, idx, text, regexp_matches(text, '{_ITEM}') AS is_item FROM blocks WHERE kind IN ('clause', 'paragraph', 'recital', 'table')), {_SUB},
 g AS (SELECT l.bundle_id, l.page, l.idx FROM (SELECT bundle_id, page, max(idx) AS idx FROM b GROUP BY 1, 2) l SEMI JOIN (SELECT bundle_id, page - 1 AS page FROM pages WHERE first_continues) p USING (bundle_id, page))
 SELECT 'blocks' AS table_name, block_key AS row_id FROM b ANTI JOIN g USING (bundle_id, page, idx) WHERE text IS NOT NULL AND trim(text) <> '' AND NOT ({_ENDED}) UNION ALL SELECT 'subclauses', subclause_id FROM s WHERE text IS NOT NULL AND trim(text) <> '' AND NOT ({_ENDED})""",
    "p6_report": f"""WITH k AS (SELECT DISTINCT ON (cache_key) cache_key, model, finish_reason FROM replay WHERE cache_key IS NOT NULL ORDER BY cache_key, called_at DESC NULLS LAST, model DESC, finish_reason DESC NULLS LAST),
 b0 AS (SELECT DISTINCT block_key, bundle_id, page, idx, call_key, text, regexp_matches(text, '{_ITEM}') AS is_item FROM blocks WHERE kind IN ('clause', 'paragraph', 'recital', 'table')), {_SUB},
 g AS (SELECT l.bundle_id, l.page, l.idx FROM (SELECT bundle_id, page, max(idx) AS idx FROM b0 GROUP BY 1, 2) l SEMI JOIN (SELECT bundle_id, page - 1 AS page FROM pages WHERE first_continues) p USING (bundle_id, page)),
 r0 AS (SELECT 'blocks' AS table_name, model AS source, model, finish_reason, text, is_item, g.idx IS NOT NULL AS goes FROM b0 LEFT JOIN k ON call_key = cache_key LEFT JOIN g USING (bundle_id, page, idx) UNION ALL SELECT 'subclauses', source, NULL, NULL, text, is_item, false FROM s),
 r AS (SELECT *, coalesce(text IS NOT NULL AND trim(text) <> '', false) AS filled, coalesce(regexp_matches(text, '{_SIGN}'), false) AS signed, coalesce({_ENDED}, false) AS ended FROM r0),
 u AS (SELECT table_name, source, 'chars' AS unit, length(text)::int AS length, ended FROM r WHERE filled UNION ALL SELECT table_name, source, 'bytes', strlen(text)::int, ended FROM r WHERE filled),
 c AS (SELECT table_name, source, unit, length, sum((NOT ended)::int) AS n, sum(ended::int) AS e FROM u GROUP BY ALL),
 l AS (SELECT * FROM (SELECT *, (sum(n) OVER (PARTITION BY table_name, source, unit ORDER BY length RANGE BETWEEN 12 PRECEDING AND 12 FOLLOWING) - n) / 24 AS x FROM c WHERE n > 0) WHERE n >= 5 AND n > x + 6 * sqrt(greatest(x, 0.25))),
 h AS (SELECT c.table_name, c.source, sum(c.n + c.e) < 20 OR sum(c.n) <= 0.5 * sum(c.n + c.e) AS usual FROM c WHERE unit = 'chars' AND NOT EXISTS (SELECT 1 FROM l WHERE l.table_name = c.table_name AND l.source IS NOT DISTINCT FROM c.source AND l.unit = 'chars' AND l.length = c.length) GROUP BY 1, 2),
 f AS (SELECT r.*, filled AND EXISTS (SELECT 1 FROM l WHERE l.table_name = r.table_name AND l.source IS NOT DISTINCT FROM r.source AND l.length = CASE l.unit WHEN 'chars' THEN length(text) ELSE strlen(text) END) AS lim, coalesce(h.usual, true) AS usual FROM r LEFT JOIN h ON h.table_name = r.table_name AND h.source IS NOT DISTINCT FROM r.source),
 o AS (SELECT table_name, CASE WHEN table_name = 'subclauses' THEN source END AS source, model, finish_reason, filled AND NOT goes AND (signed OR (NOT ended AND (lim OR usual))) AS cut, lim FROM f)
 SELECT table_name, source, model, finish_reason, count(*) AS n_records, sum(cut::int)::bigint AS n_cut, sum((cut AND lim)::int)::bigint AS n_at_limit, sum(cut::int) / count(*) AS share_cut FROM o GROUP BY 1, 2, 3, 4""",
    "p6_limits": f"""WITH {_SUB}, t AS (SELECT source, text FROM s WHERE text IS NOT NULL AND text <> '' AND NOT ({_ENDED})), u AS (SELECT source, 'chars' AS unit, length(text)::int AS length FROM t UNION ALL SELECT source, 'bytes', strlen(text)::int FROM t), c AS (SELECT source, unit, length, count(*) AS n FROM u GROUP BY 1, 2, 3),
 e AS (SELECT *, (sum(n) OVER (PARTITION BY source, unit ORDER BY length RANGE BETWEEN 12 PRECEDING AND 12 FOLLOWING) - n) / 24 AS expected FROM c) SELECT source, unit, length, n, expected FROM e WHERE n >= 5 AND n > expected + 6 * sqrt(greatest(expected, 0.25))""",
    "p1_found": _PAIRS + "SELECT least(a, b) AS clause_id_a, greatest(a, b) AS clause_id_b FROM pairs",
    "p1_groups": _PAIRS.replace("WITH ", "WITH RECURSIVE ", 1) + """, own AS (SELECT id, md5(list_sort(list(g))::varchar) AS h FROM g GROUP BY id), sides AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
 reach(id, to_id) AS (SELECT id, id FROM own UNION SELECT r.id, sides.b FROM reach r JOIN sides ON sides.a = r.to_id), grp AS (SELECT id, min(to_id) AS least FROM reach GROUP BY 1),
 links AS (SELECT x.id, count(DISTINCT CASE WHEN z.h <> x.h THEN z.h END) + count(DISTINCT CASE WHEN z.h = x.h THEN z.id END) AS n FROM own x JOIN sides ON sides.a = x.id JOIN own z ON z.id = sides.b GROUP BY 1)
 SELECT c.clause_id, coalesce(least, c.clause_id) AS group_id, coalesce(n, 0)::bigint AS n_links FROM (SELECT DISTINCT clause_id FROM clauses WHERE clause_id IS NOT NULL) c LEFT JOIN grp ON grp.id = c.clause_id LEFT JOIN links ON links.id = c.clause_id""",
    "p8_items": _PHRASES + "SELECT item_id, count(*) AS n_documents, max(f / n) AS largest_share FROM (SELECT doc_id, item_id, n, count(*) AS f FROM dg JOIN pg USING (g) JOIN n USING (item_id) GROUP BY doc_id, item_id, n HAVING count(*) * 3 >= n) GROUP BY 1",
    "p2_found": "SELECT DISTINCT clause_id, 'text' AS field_name FROM clauses WHERE length(text) > 2000 UNION SELECT DISTINCT clause_id, 'full_text' FROM clauses WHERE length(full_text) > 2000",
    "p8_found": _PHRASES + "SELECT doc_id, item_id FROM dg JOIN pg USING (g) JOIN n USING (item_id) GROUP BY doc_id, item_id, n HAVING count(*) * 3 >= n",
}
