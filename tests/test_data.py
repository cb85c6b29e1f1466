import json
from datetime import datetime

import duckdb
import pytest

import __spark_entry__ as entry
from quirework.operators import nested, references
from quirework.operators.components import components
from quirework.streaming import orphans
from tools.compare import KNOWN, plain


def walk(key, node, path, out):
    for field, letter in nested.LISTS.items():
        v = node.get(field)
        if isinstance(v, str):
            try:
                v = json.loads(v)
            except ValueError:
                v = None
        v = [v] if isinstance(v, dict) else v
        for n, x in enumerate((x for x in v if isinstance(x, dict)) if isinstance(v, list) else (), 1):
            p = f"{path}/{letter}{n}" if path else f"{letter}{n}"
            out.add((key, path or "root", p))
            walk(key, x, p, out)


def test_nested_against_brute_force(spark):
    child = {"children": [{"x": 1, "children": {"y": 2}}, None, 3, {"children": json.dumps([{"z": 1}])}]}
    docs = [{"divisions": [child, None, {"units": child}], "units": json.dumps([{"a": 1}])}, {"contract": {"documents": {"children": [child]}}}, {"divisions": "not json"}, {"divisions": 5}, {}]
    rows = [(i, json.dumps(d)) for i, d in enumerate(docs)] + [(90, None), (91, ""), (92, "{broken"), (93, "[1, 2]"), (None, "{}"), (0, json.dumps(docs[0]))]
    df = spark.createDataFrame(rows, "contract_id bigint, payload string")
    want: set = set()
    for i, d in enumerate(docs):
        walk(i, d.get("contract", d), "", want)
    assert {tuple(r) for r in nested.links(df.selectExpr("contract_id", "payload", "'x' path", "1 key", "2 node")).collect()} == want
    t = nested.flat_tables(df)
    n = {n: sum(p.rpartition("/")[2][0] == n[0] for _, _, p in want) for n in ("divisions", "units", "children")}
    assert {k: v.count() for k, v in t.items()} == n | {"contracts": len(docs)}
    assert nested.links(df.where("false")).count() == 0
    deep: dict = {"leaf": 1}
    for _ in range(30):
        deep = {"children": [deep]}
    assert nested.links(spark.createDataFrame([(1, json.dumps(deep))], "contract_id bigint, payload string")).count() == 30


def test_lists_of_objects_come_from_the_schema(spark):
    docs = [
        {"no": 7, "parties": [{"name": "A", "aliases": ["x", "y"], "people": [{"n": 1}, {"n": 2}]}, None, {"name": "B", "node_key": 5}], "divisions": [{"title": "t", "parties": {"name": "C"}, "flags": ["f"]}], "ma'rk": 1},
        {"no": "8", "parties": json.dumps([{"name": "D"}]), "divisions": {"parties": [], "units": [{"parties": [{"name": 5}]}]}},
        {"parties": 3}, {},
    ]
    df = spark.createDataFrame([(i, json.dumps(d), 1) for i, d in enumerate(docs)] + [(0, json.dumps({"no": 1}), 0)], "contract_id bigint, payload string, at int")
    t = nested.flat_tables(nested.latest(df, "contract_id", "payload", "at"))
    assert set(t) == {"contracts", "divisions", "units", "children", "parties", "people"}
    rows = {name: x.collect() for name, x in t.items()}
    got = {(r.contract_id, r.node_path): (r.name, r.parent_kind, r.ordinal) for r in rows["parties"]}
    assert got == {(0, "parties:1"): ("A", "contract", 1), (0, "parties:2"): ("B", "contract", 2), (0, "d1/parties:1"): ("C", "division", 1), (1, "parties:1"): ("D", "contract", 1), (1, "d1/u1/parties:1"): ("5", "unit", 1)}
    assert {(r.node_path, r.n, r.parent_kind) for r in rows["people"]} == {("parties:1/people:1", 1, "parties"), ("parties:1/people:2", 2, "parties")}
    assert {r.aliases for r in rows["parties"]} == {'["x","y"]', None} and "field_node_key" in t["parties"].columns and "people" not in t["parties"].columns
    assert {r.contract_id: r.no for r in rows["contracts"]} == {0: "7", 1: "8", 2: None, 3: None}
    keys = {r.node_key for x in rows.values() for r in x}
    assert len(keys) == sum(map(len, rows.values())) and all(r.parent_key in keys for n, x in rows.items() if n != "contracts" for r in x)
    assert {k: v.count() for k, v in nested.flat_tables(df.where("false")).items()} == {"contracts": 0, "divisions": 0, "units": 0, "children": 0}


def test_dangling_references(spark):
    t = lambda day: datetime(2024, 1, day)
    clauses = [(1, "B", "Annexure - III", t(1), None), (1, "B", "Annexure - III", t(1), None), (2, "B", "7.0", t(5), t(9)), (3, "B", "2 . 1", t(1), t(3)), (4, "B", "Schedule-A", t(9), None), (5, "B", None, t(1), None), (6, "B", "Form 5", t(8), t(2)), (7, "B", "Form 6", None, None)]
    c = spark.createDataFrame(clauses, "clause_id bigint, bundle_id string, marker string, created_at timestamp, deleted_at timestamp")
    refs = ["annex 3", "Cl. 7", "clause 2.1", "SCHEDULE–A", None, "", "the Drawings", "Clause No. 07.0", "Form No. V", "Form-6"]
    p = spark.createDataFrame([(1, "B", t(6), refs), (2, "B", t(9), refs), (3, "C", t(6), ["Annexure 3"]), (4, "B", t(6), None), (5, "B", t(6), [])], "page_id bigint, bundle_id string, checked_at timestamp, cross_references array<string>")
    got = {(r.page_id, r.ref_pos) for r in references.dangling(p, c).collect()}
    assert got == {(1, 3), (1, 4), (1, 9), (1, 10), (2, 2), (2, 3), (2, 8), (2, 9), (2, 10), (3, 1)}
    assert references.dangling(p, c.where("false")).count() == references.page_references(p).count()
    assert references.dangling(p.where("false"), c).count() == 0


def test_orphans_by_query_state_and_stream_agree(spark, tmp_path):
    """As of the last delta, the running states, the summed counts and the stream give the same orphans; a withdrawn reference counts no more."""
    t = lambda day: datetime(2024, 1, day)
    refs = [(1, "B", "clause", "1", t(3), None), (2, "B", "clause", "1", t(4), t(6)), (3, "B", "clause", "2", t(3), t(5)), (4, "B", "form", "1", t(2), None), (5, "B", "form", "2", t(9), None), (6, None, "form", "2", t(9), None), (7, "B", "form", "3", None, None)]
    deltas = [("B", "clause", "1", t(1), 1), ("B", "clause", "1", t(7), -1), ("B", "form", "1", t(1), 1), ("B", "form", "2", t(9), 1), ("B", "form", "2", t(9), 1)]
    r = spark.createDataFrame(refs, "page_id long, bundle_id string, kind string, idx string, at timestamp, withdrawn_at timestamp")
    changed = references.changes(r, spark.createDataFrame(deltas, "bundle_id string, kind string, idx string, at timestamp, delta int"))
    now = {(x.bundle_id, x.kind, x.idx): (x.n_refs, x.n_existing) for x in references.signed_counts(changed.where("at IS NOT NULL AND bundle_id IS NOT NULL")).collect()}
    assert now == {("B", "clause", "1"): (1, 0), ("B", "clause", "2"): (0, 0), ("B", "form", "1"): (1, 1), ("B", "form", "2"): (1, 2)}
    got = references.states(changed).collect()
    last: dict = {}
    for x in sorted((x for x in got if x.at and x.bundle_id), key=lambda x: x.at):
        last[x.bundle_id, x.kind, x.idx] = (x.n_refs, x.n_existing)
    assert last == now and len(got) == changed.count()
    assert {x.page_id: (x.n_refs, x.n_existing) for x in got if x.refs > 0} == {1: (1, 1), 2: (2, 1), 3: (1, 0), 4: (1, 1), 5: (1, 2), 6: (0, 0), 7: (0, 0)}
    src = str(tmp_path / "deltas")
    changed.select(*references.KEY, "at", "refs", "existing").where("at IS NOT NULL AND bundle_id IS NOT NULL").write.parquet(src)
    q = orphans.current(orphans.read(spark, src)).writeStream.outputMode("complete").format("memory").queryName("orphans").start()
    q.processAllAvailable()
    q.stop()
    assert {(x.bundle_id, x.kind, x.idx): (x.n_refs, x.n_existing) for x in spark.sql("SELECT * FROM orphans").collect()} == now


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 4), (9, 9), (None, 1), (7, 8), (8, 6), (6, 3), (20, 21)], "a bigint, b bigint")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 6: 1, 7: 1, 8: 1, 4: 4, 5: 4, 20: 20, 21: 20}
    chain = spark.range(300).selectExpr("id a", "id + 1 b")
    assert components(chain).select("root").distinct().count() == 1


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if not n.startswith("p") or n.startswith(("p4", "p7", "page", "pick", "plain", "prev"))))
def test_query_against_sql(spark, small, name):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in KNOWN:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    df = entry.queries()[name](spark, small)
    cols = sorted(df.columns)
    cur = con.execute(entry.oracle_sql()[name])
    theirs = [c[0] for c in cur.description]
    assert sorted(theirs) == cols
    key = lambda rows: sorted(map(repr, rows))
    assert key(tuple(plain(r[c]) for c in cols) for r in df.collect()) == key(tuple(plain(dict(zip(theirs, r))[c]) for c in cols) for r in cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
