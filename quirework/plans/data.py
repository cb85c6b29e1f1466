"""Queries of the data-processing operators in the core: nested records and dangling references."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.operators import nested, references
from quirework.runtime import materialize, shared_folder, table
from quirework.streaming import orphans


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.links(table(spark, d, "contracts"))


def _flat(spark: SparkSession, d: str, name: str) -> DataFrame:
    records = nested.latest(table(spark, d, "contracts").where("contract_id IS NOT NULL"), "contract_id", "payload", "received_at")
    return nested.flat_tables(records, only=[name])[name].drop("node_key", "parent_key")


def p4_contracts(spark: SparkSession, d: str) -> DataFrame:
    return _flat(spark, d, "contracts")


def p4_divisions(spark: SparkSession, d: str) -> DataFrame:
    return _flat(spark, d, "divisions")


def p4_units(spark: SparkSession, d: str) -> DataFrame:
    return _flat(spark, d, "units")


def p4_children(spark: SparkSession, d: str) -> DataFrame:
    return _flat(spark, d, "children")


def p4_parties(spark: SparkSession, d: str) -> DataFrame:
    """A list that no letter stands for: it is found in the merged schema."""
    return _flat(spark, d, "parties")


def p4_keys(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the tables and those among them whose parent key is the key of a row: all but the contracts'."""
    records = nested.latest(table(spark, d, "contracts").where("contract_id IS NOT NULL"), "contract_id", "payload", "received_at")
    tables = nested.flat_tables(records)
    every = None
    for name, df in tables.items():
        rows = df.select(F.lit(name).alias("table_name"), "node_key", "parent_key")
        every = rows if every is None else every.unionByName(rows)
    every = materialize(every)
    known = every.select(F.col("node_key").alias("parent_key"), F.lit(1).alias("_k")).distinct()
    return every.join(known, "parent_key", "left").groupBy("table_name").agg(F.count("*").alias("n_rows"), F.count("_k").alias("n_linked"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return references.dangling(table(spark, d, "pages"), table(spark, d, "clauses")).select("page_id", "ref_pos").distinct()


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return references.dangling_report(table(spark, d, "pages"), table(spark, d, "clauses"))


def p7_current(spark: SparkSession, d: str) -> DataFrame:
    refs, deltas = references.page_references(table(spark, d, "pages")), references.clause_deltas(table(spark, d, "clauses"))
    return references.signed_counts(references.changes(refs, deltas)).where(references.ORPHAN)


def p7_streamed(spark: SparkSession, d: str) -> DataFrame:
    """The orphans of p7_current as the state of a stream: the deltas arrive as files, and a streaming query adds them up."""
    folder = f"{shared_folder(spark).rstrip('/')}/quirework-{uuid.uuid4().hex}"
    refs, deltas = references.page_references(table(spark, d, "pages")), references.clause_deltas(table(spark, d, "clauses"))
    references.changes(refs, deltas).select(*references.KEY, "at", "refs", "existing").write.parquet(f"{folder}/deltas")
    counts = orphans.current(orphans.read(spark, f"{folder}/deltas"))
    name = f"orphans_{uuid.uuid4().hex}"

    def keep(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/{name}")

    counts.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/{name}").where(references.ORPHAN)


QUERIES = {q.__name__: q for q in (p4_found, p4_contracts, p4_divisions, p4_units, p4_children, p4_parties, p4_keys, p7_found, p7_report, p7_current, p7_streamed)}

_TREE = """
WITH RECURSIVE n(contract_id, parent_path, node_path, node) AS (
  SELECT contract_id, '', '', CASE WHEN json_type(payload, '$.contract') = 'OBJECT' THEN json_extract(payload, '$.contract') ELSE payload::json END
  FROM (SELECT DISTINCT ON (contract_id) contract_id, payload FROM contracts WHERE contract_id IS NOT NULL ORDER BY contract_id, received_at DESC NULLS LAST, payload DESC NULLS LAST) WHERE json_valid(payload)
  UNION ALL
  SELECT contract_id, CASE WHEN node_path = '' THEN 'root' ELSE node_path END, CASE WHEN node_path = '' THEN '' ELSE node_path || '/' END || letter || pos::varchar, child
  FROM (
    SELECT p.contract_id, p.node_path, p.letter, unnest(p.list) AS child, unnest(range(1, len(p.list) + 1)) AS pos
    FROM (
      SELECT contract_id, node_path, letter, list_filter(CASE json_type(v) WHEN 'ARRAY' THEN json_extract(v, '$[*]') WHEN 'OBJECT' THEN [v] ELSE []::json[] END, lambda x: json_type(x) = 'OBJECT') AS list
      FROM (
        SELECT contract_id, node_path, f.letter, CASE WHEN json_type(json_extract(node, '$.' || f.field)) = 'VARCHAR' THEN CASE WHEN json_valid(json_extract_string(node, '$.' || f.field)) THEN json_extract_string(node, '$.' || f.field)::json END ELSE json_extract(node, '$.' || f.field) END AS v
        FROM n, (VALUES ('divisions', 'd'), ('documents', 'd'), ('units', 'u'), ('children', 'c')) f(field, letter)
      ) WHERE v IS NOT NULL
    ) p
  )
)
"""
_P4 = _TREE + "SELECT DISTINCT contract_id, parent_path, node_path FROM n WHERE node_path <> ''"


def _node_table(letter: str, texts: list[str], numbers: list[str] = []) -> str:  # noqa: B006
    """SQL of a table of nodes: the fields are named here, the operator finds them."""
    cols = [f"json_extract_string(node, '$.{c}') AS {c}" for c in texts] + [f"try_cast(json_extract_string(node, '$.{c}') AS bigint) AS {c}" for c in numbers]
    kind = "CASE WHEN parent_path = 'root' THEN 'contract' ELSE CASE left(string_split(parent_path, '/')[-1], 1) WHEN 'd' THEN 'division' WHEN 'u' THEN 'unit' ELSE 'child' END END"
    return _TREE + f"SELECT contract_id, parent_path, node_path, {kind} AS parent_kind, substr(string_split(node_path, '/')[-1], 2)::int AS ordinal, {', '.join(cols)} FROM n WHERE node_path <> '' AND left(string_split(node_path, '/')[-1], 1) = '{letter}'"


_INDEX = r"""CASE WHEN regexp_matches(i, '^[ivx]+$') THEN (10 * (length(i) - length(replace(i, 'x', ''))) + 5 * (length(i) - length(replace(i, 'v', ''))) + (length(i) - length(replace(i, 'i', '')))
  - 2 * ((length(i) - length(replace(replace(i, 'iv', ''), 'ix', ''))) // 2))::varchar ELSE regexp_replace(regexp_replace(i, '(^|\.)0+([0-9])', '\1\2', 'g'), '\.0$', '') END"""
_NAMED = r"(^|[^a-z0-9])(annexure|annex|schedule|appendix|form|exhibit|clauses|clause|cl)((?:[\s:.‐-―-]|\bno\b|\bnos\b|\bnumber\b)*)([0-9]+(?:\s*\.\s*[0-9]+)*|[ivx]+|[a-h])([^a-z0-9]|$)"
_REFS = rf"""
refs AS (
  SELECT DISTINCT page_id, ref_pos, bundle_id, CASE kind WHEN 'annex' THEN 'annexure' WHEN 'clauses' THEN 'clause' WHEN 'cl' THEN 'clause' ELSE kind END AS kind, {_INDEX} AS idx, asked
  FROM (SELECT page_id, ref_pos, bundle_id, asked, regexp_extract(e, '{_NAMED}', 2) AS kind, regexp_replace(regexp_extract(e, '{_NAMED}', 4), '\s', '', 'g') AS i
    FROM (SELECT page_id, bundle_id, checked_at AS asked, lower(unnest(cross_references)) AS e, unnest(range(1, len(cross_references) + 1))::int AS ref_pos FROM pages)) WHERE i <> ''),
marks AS (
  SELECT bundle_id, created_at, deleted_at, CASE WHEN bare <> '' OR kind IN ('cl', 'clauses') THEN 'clause' WHEN kind = 'annex' THEN 'annexure' ELSE kind END AS kind, {_INDEX} AS idx
  FROM (SELECT bundle_id, created_at, deleted_at, bare, kind, CASE WHEN bare <> '' THEN bare ELSE named END AS i
    FROM (SELECT bundle_id, created_at, deleted_at, regexp_replace(regexp_extract(m, '^\s*([0-9]+(\s*\.\s*[0-9]+)*)\s*\.?\s*$', 1), '\s', '', 'g') AS bare, regexp_extract(m, '{_NAMED}', 2) AS kind, regexp_replace(regexp_extract(m, '{_NAMED}', 4), '\s', '', 'g') AS named
      FROM (SELECT bundle_id, created_at, deleted_at, lower(marker) AS m FROM (SELECT DISTINCT clause_id, bundle_id, marker, created_at, deleted_at FROM clauses)))) WHERE i <> ''),
states AS (SELECT r.*, NOT EXISTS (SELECT 1 FROM marks m WHERE m.bundle_id = r.bundle_id AND m.kind = r.kind AND m.idx = r.idx AND m.created_at <= r.asked AND (m.deleted_at IS NULL OR m.deleted_at > r.asked)) AS dangles FROM refs r)
"""

_CURRENT = f"WITH {_REFS} SELECT bundle_id, kind, idx, count(*) AS n_refs, 0::bigint AS n_existing FROM refs r WHERE NOT EXISTS (SELECT 1 FROM marks m WHERE m.bundle_id = r.bundle_id AND m.kind = r.kind AND m.idx = r.idx AND m.created_at IS NOT NULL AND m.deleted_at IS NULL) GROUP BY 1, 2, 3"

ORACLES = {
    "p7_current": _CURRENT,
    "p7_streamed": _CURRENT,
    "p4_found": _P4,
    "p4_contracts": _TREE + "SELECT contract_id, NULL::varchar AS parent_path, 'root' AS node_path, NULL::varchar AS parent_kind, NULL::int AS ordinal, json_extract_string(node, '$.source') AS source, json_extract_string(node, '$.status') AS status FROM n WHERE node_path = ''",
    "p4_divisions": _node_table("d", ["division_id", "division_type", "running_header", "title"], ["start_page", "end_page"]),
    "p4_units": _node_table("u", ["flags", "kind", "marker", "page_start", "risk_level", "text", "title", "unit_id"]),
    "p4_children": _node_table("c", ["marker", "text", "title"]),
    "p4_parties": _TREE + """, p AS (SELECT contract_id, unnest(json_extract(node, '$.parties[*]')) AS node, generate_subscripts(json_extract(node, '$.parties[*]'), 1) AS i FROM n WHERE node_path = '')
SELECT contract_id, 'root' AS parent_path, 'parties:' || i::varchar AS node_path, 'contract' AS parent_kind, i::int AS ordinal, json_extract_string(node, '$.aliases') AS aliases, json_extract_string(node, '$.side') AS side FROM p""",
    "p4_keys": _TREE + """SELECT 'contracts' AS table_name, count(*) AS n_rows, 0::bigint AS n_linked FROM n WHERE node_path = ''
UNION ALL SELECT 'parties', sum(json_array_length(node, '$.parties'))::bigint, sum(json_array_length(node, '$.parties'))::bigint FROM n WHERE node_path = ''
UNION ALL SELECT CASE left(string_split(node_path, '/')[-1], 1) WHEN 'd' THEN 'divisions' WHEN 'u' THEN 'units' ELSE 'children' END, count(*), count(*) FROM n WHERE node_path <> '' GROUP BY 1""",
    "p7_found": f"WITH {_REFS} SELECT DISTINCT page_id, ref_pos FROM states WHERE dangles",
    "p7_report": f"WITH {_REFS} SELECT CASE WHEN kind = 'clause' THEN 'clauses' ELSE 'attachments' END AS table_name, kind, strftime(asked, '%Y-%m') AS month, count(*) AS n_references, sum(dangles::bigint)::bigint AS n_dangling, sum(dangles::bigint) / count(*) AS share FROM states GROUP BY ALL",
}
