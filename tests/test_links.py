"""Operators that link one step of the structure with the next, and the reader layer, against loops that restate them."""

import json
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from quirework.functions.text import _norm
from quirework.operators import boundaries, checks, merges, ordered, reader, recovery, tree
from quirework.sinks import files as sinks
from quirework.sources import files as sources
from tests.test_structure import bundle

CAND = "bundle_id string, page int, idx int, block_id string, kind string, number string, title string, text string"


def test_decisions_against_a_loop(spark):
    rng = random.Random(31)
    rows, decisions = [], []
    for b in ("A", "B"):
        for i in range(60):
            rows.append((b, 1 + i // 5, i % 5, f"b{i}", rng.choice(["heading", "clause"]), rng.choice([None, "1", "2.1", "3.1.2", "(a)"]), rng.choice([None, "T"]), "text"))
            if rng.random() < 0.6:
                decisions.append((b, f"b{i}", rng.random() < 0.8, rng.choice([-1, 1, 2, 3, 7]), rng.choice([None, " 9 "]), rng.choice([None, "", "N"]), rng.choice(["llm", "template"])))
    decisions += [("A", "unknown", True, 1, None, None, "llm"), ("C", "b1", True, 1, None, None, "llm")]
    cand = spark.createDataFrame(rows, CAND)
    dec = spark.createDataFrame(decisions, "bundle_id string, block_id string, keep boolean, level int, number string, title string, source string")
    got = {(r.bundle_id, r.block_id): (r.level, r.number, r.title, r.source) for r in ordered.decided_levels(cand, dec, ["bundle_id"], ["page", "idx"], "block_id").collect()}
    by = {(d[0], d[1]): d for d in decisions}
    want = {}
    for b in ("A", "B"):
        before = 1
        for r in (x for x in rows if x[0] == b):
            d = by.get((b, r[3]))
            if d is None:
                dots = {"1": 1, "2.1": 2, "3.1.2": 3}.get(r[5])
                before = min(5, dots or (1 if r[4] == "heading" else before + 1))
                want[b, r[3]] = (before, r[5], r[6], "fallback")
            elif d[2]:
                before = max(1, d[3])
                if before <= 5:
                    want[b, r[3]] = (before, (d[4] or "").strip() or r[5], d[5] or r[6], d[6])
    assert got == want
    assert ordered.decided_levels(cand, dec.where("false"), ["bundle_id"], ["page", "idx"], "block_id").count() == len(rows)
    assert ordered.decided_levels(cand.where("false"), dec, ["bundle_id"], ["page", "idx"], "block_id").count() == 0


def test_roles_against_a_loop(spark):
    rng = random.Random(32)
    kinds = ["heading", "paragraph", "recital", "clause", "stamp_or_seal"]
    rows = [(g, i, rng.choice(kinds), rng.choice(["Contract Agreement", "contract  agrement", "Other words", None]), rng.random() < 0.12) for g in range(25) for i in range(9)]
    df = spark.createDataFrame(rows, "g int, i int, kind string, text string, opens boolean").withColumn("title", F.lit("Contract Agreement"))
    got = {(r.g, r.i): (r.owner_pos, r.role) for r in tree.roles(df, ["g"], ["i"], F.col("opens"), F.col("title")).collect()}
    want = {}
    for g in range(25):
        owner, said = 0, False
        for _, i, kind, text, opens in (x for x in rows if x[0] == g):
            if opens:
                owner += 1
                role = "node"
            elif kind == "heading" and owner == 0 and not said and SequenceMatcher(None, _norm(text), _norm("Contract Agreement")).ratio() >= 0.85:
                role = "title"
            elif kind == "stamp_or_seal":
                role = "annotation"
            elif kind == "recital" and owner == 0:
                role = "recital"
            else:
                role, said = "text", said or owner == 0
            want[g, i] = (owner, role)
    assert got == want and {r for _, r in want.values()} == {"node", "title", "annotation", "recital", "text"}


def test_bundle_from_pages_to_tree(spark):
    """Eleven pages, the last a copy: segments, decisions, levels, paths, owners and last pages from end to end."""
    p = bundle(spark)
    dup = spark.createDataFrame([("B", 11, 10)], "bundle_id string, later int, duplicate_of int")
    p = checks.mark_duplicates(p.withColumn("is_document_start", F.col("is_document_start") | (F.col("page") == 11)), dup)
    assert {r.page: r.duplicate_of for r in p.collect() if r.duplicate_of} == {11: 10}
    seg = boundaries.segments(boundaries.heuristic_starts(p), p)
    assert [(r.segment_id, r.start_page, r.end_page) for r in seg.orderBy("start_page").collect()] == [("D01", 1, 1), ("D02", 2, 3), ("D03", 4, 4), ("D04", 5, 8), ("D05", 9, 9), ("D06", 10, 11)]
    rows = [("B", 5, 0, "p5_0", "heading", None, None, "General Conditions"), ("B", 5, 1, "p5_1", "clause", "1", "Scope", "The works"), ("B", 6, 0, "p6_0", "clause", "1.1", None, "Sub"), ("B", 6, 1, "p6_1", "paragraph", None, None, "more"), ("B", 7, 0, "p7_0", "clause", "9", None, "Not a heading"), ("B", 7, 1, "p7_1", "clause", "2", None, "Last")]
    at = spark.createDataFrame(rows, CAND).join(checks.pages_of_ranges(seg, ["bundle_id", "segment_id"], "start_page", "end_page"), ["bundle_id", "page"])
    dec = spark.createDataFrame([("B", "p5_0", False, 1, None, None, "llm"), ("B", "p7_0", False, 1, None, None, "llm"), ("B", "p5_1", True, 1, None, "Scope of Work", "llm"), ("B", "nowhere", True, 1, None, None, "llm")], "bundle_id string, block_id string, keep boolean, level int, number string, title string, source string")
    by = ["bundle_id", "segment_id"]
    nodes = ordered.decided_levels(at.where("kind IN ('heading', 'clause')"), dec.join(seg.select("bundle_id", "segment_id"), "bundle_id"), by, ["page", "idx"], "block_id")
    t = tree.tree(nodes.withColumnRenamed("level", "wanted"), by, ["page", "idx"], "wanted")
    placed = tree.roles(at.join(nodes.select("bundle_id", "block_id", F.lit(True).alias("node")), ["bundle_id", "block_id"], "left"), by, ["page", "idx"], F.coalesce("node", F.lit(False)), F.lit("General conditions"))
    assert {r.block_id: (r.owner_pos, r.role) for r in placed.collect()} == {"p5_0": (0, "title"), "p5_1": (1, "node"), "p6_0": (2, "node"), "p6_1": (2, "text"), "p7_0": (2, "text"), "p7_1": (3, "node")}
    own = placed.groupBy(*by, F.col("owner_pos").alias("pos")).agg(F.max("page").alias("last"))
    ends = tree.page_ends(t.join(own, [*by, "pos"]), by, "last").collect()
    assert {r.block_id: (r.path, r.title, r.page_end) for r in ends} == {"p5_1": ([1], "Scope of Work", 7), "p6_0": ([1, 1], None, 7), "p7_1": ([2], None, 7)}
    label = tree.node_label(F.col("number"), F.col("title"), F.col("text"))
    assert tree.outline(t.withColumn("label", label), by, "label").first().outline == "1 Scope of Work\n  1.1 Sub\n2 Last"
    trees = json.loads(sinks.nested_tree(t, by, ["block_id", "level"]).first().tree)
    assert [(x["block_id"], [y["block_id"] for y in x.get("children", [])]) for x in trees] == [("p5_1", ["p6_0"]), ("p7_1", [])]
    lines = sinks.clause_lines(t.withColumn("has_children", F.lit(False))).count()
    marks = sinks.bookmarks(t.withColumn("label", label).withColumn("page_start", F.col("page")), "label").orderBy("pos").collect()
    assert lines == 3 and [tuple(m) for m in marks] == [(1, 1, "1 Scope of Work", 5), (2, 2, "1.1 Sub", 6), (3, 1, "2 Last", 7)]


def test_ladder_skips_whole_reads_after_truncation(spark):
    rows = [("a", 0, "full", "truncated", "k1"), ("a", 1, "full", "ok", "k2"), ("a", 2, "half", "ok", "k3"), ("b", 0, "full", "invalid", "k4"), ("b", 1, "full", "ok", "k5"), ("c", 0, "half", "truncated", "k6"), ("c", 1, "full", "ok", "k7"), ("d", 0, "full", None, "k8")]
    df = spark.createDataFrame(rows, "p string, rung int, mode string, outcome string, k string")
    got = {r.p: (r.k, r.n_attempts) for r in ordered.ladder(df, ["p"], "rung", "mode", "outcome", ["k"]).collect()}
    assert got == {"a": ("k3", 2), "b": ("k5", 2)}


def test_starts_units_and_chunks(spark):
    p = bundle(spark)
    starts = spark.createDataFrame([("B", 4, "x", "t", 0.9)], "bundle_id string, start_page int, doc_type string, title string, confidence double")
    assert [(r.start_page, r.title, r.confidence) for r in boundaries.ensure_first(starts, p).orderBy("start_page").collect()] == [(1, "[stamp_paper]", 0.5), (4, "t", 0.9)]
    kinds = spark.createDataFrame([("drawing", 9), ("other", 1), ("other", 2), ("general_conditions", 1), ("general_conditions", 0), (None, 1)], "k string, n int")
    assert [r[0] for r in kinds.select(boundaries.needs_tree(F.col("k"), F.col("n"))).collect()] == [False, False, True, True, False, True]
    c = spark.createDataFrame([("B", i, i % 3 == 0) for i in range(20)], "b string, i int, decided boolean")
    rows = boundaries.decision_chunks(c, ["b"], ["i"], size=4, context=2).orderBy("i").collect()
    undecided, want = 0, []
    for i in range(20):
        undecided += i % 3 != 0
        want.append(max(undecided - 1, 0) // 4)
    assert [r.chunk for r in rows] == want and all(r.context_from == max(1, want.index(r.chunk) + 1 - 2) for r in rows)
    u = spark.createDataFrame([("B", "D", "U1", "clause", "1", None, 1, 4, False), ("B", "D", "U2", "clause", "4", None, 5, 9, False)], "bundle_id string, division_id string, unit_id string, kind string, marker string, title string, page_start int, page_end int, shares_start_page boolean")
    r = spark.createDataFrame([("B", "D", "U1", "2", "two", 3), ("B", "D", "U1", "3", "three", 99)], "bundle_id string, division_id string, after_unit string, marker string, title string, page int")
    got = [(x.unit_id, x.page_start, x.page_end) for x in boundaries.insert_recovered(u, r).orderBy("page_start", "unit_id").collect()]
    assert got == [("U1", 1, 2), ("U1R", 3, 4), ("U1RR", 5, 5), ("U2", 5, 9)]


def test_disputes_seams_and_boxes(spark):
    d = spark.createDataFrame([("p", i, t, m) for i, (t, m) in enumerate([("x", False), ("label", False), ("x", True), ("marker_mismatch", False), ("x", False)])], "p string, ord int, type string, marked boolean")
    got = {r.ord: (r.rank, r.taken) for r in ordered.capped_disputes(d, ["p"], most=3).collect()}
    assert got == {3: (1, True), 1: (2, True), 2: (3, True), 0: (4, False), 4: (5, False)}
    b = spark.createDataFrame([("p", 0, "clause", "1", "a"), ("p", 1, "clause", "1", " a "), ("p", 2, "clause", "2", "a"), ("p", 3, "clause", None, None), ("p", 4, "clause", None, None)], "p string, i int, kind string, marker string, text string")
    assert sorted(r.i for r in ordered.seam_duplicates(b, ["p"], ["i"]).collect()) == [0, 2, 3]
    x = spark.createDataFrame([([100, 5, 1000, 900], True), ([100, 5, 1000, 900], False), ([1, 2], True), (None, False)], "b array<int>, low boolean")
    assert [r[0] for r in x.select(ordered.remap_box(F.col("b"), F.col("low"))).collect()] == [[505, 5, 1000, 900], [55, 5, 550, 900], None, None]


def test_sub_clauses_and_best_lines(spark):
    b = spark.createDataFrame([("u", i, m, t, p) for i, (m, t, p) in enumerate([("5", "head", "5"), ("5.1", "a", "5"), (None, "b", "5"), ("6.1", "c", "5"), ("5.2", "d", "5")])] + [("v", 0, "5.1", "x", "(a)")], "u string, i int, marker string, text string, parent string")
    got = {(r.u, r.i): r.child_no for r in tree.split_children(b, ["u"], ["i"], F.col("marker"), F.col("parent")).collect()}
    assert got == {("u", 0): 0, ("u", 1): 1, ("u", 2): 1, ("u", 3): 1, ("u", 4): 2, ("v", 0): 0}
    s = spark.createDataFrame([("u", i, m, t) for i, (m, t) in enumerate([(None, "intro"), ("1", "SECTION 1 x"), ("1.", "first"), ("1.1", "sub"), (" 2 ", "second"), ("3", None)])], "u string, i int, marker string, text string")
    assert [r.clause_no for r in recovery.section_clauses(s, ["u"], ["i"], F.col("marker")).orderBy("i").collect()] == [0, 0, 1, 1, 2, 3]
    probes = spark.createDataFrame([("g", "4.2 Payment terms of the works"), ("h", "x")], "g string, probe string")
    lines = spark.createDataFrame([("g", 0, "Something else"), ("g", 1, "4.2 Payment terms"), ("g", 2, "of the works")], "g string, ord int, text string")
    r = checks.best_lines(probes, lines, ["g"]).collect()
    assert len(r) == 1 and r[0].line.startswith("4.2 Payment terms") and r[0].score == 1.0
    sug = spark.createDataFrame([("g", "Payment Term"), ("g", "Force Majeure"), ("z", "Alone")], "g string, suggestion string")
    titles = spark.createDataFrame([("g", "Payment terms"), ("g", "Insurance")], "g string, title string")
    assert sorted(r.suggestion for r in checks.suggestions_missing(sug, titles, ["g"]).collect()) == ["Alone", "Force Majeure"]


def test_reader_layer(spark):
    r = spark.createDataFrame([("1: MAX_TOKENS",), ("RECITATION",), ("SAFETY",)], "reason string")
    assert [x.steps for x in reader.recovery_plan(r).collect()] == [["split", "text_layer"], ["sentinel", "reread", "text_layer"], ["reread", "split", "text_layer"]]
    g = spark.createDataFrame([(1, 8), (1, 9)], "page_from int, page_to int")
    assert [x.hunted for x in reader.hunt_eligible(g).collect()] == [True, False]
    hits = spark.createDataFrame([("B", "7.2", 3, True, False), ("B", "7.3", 3, True, True), ("B", "7.4", 3, True, False), ("B", "7.5", None, True, False), ("B", "7.6", 3, None, None)], "bundle_id string, missing string, page int, found boolean, obscured boolean")
    scans = spark.createDataFrame([("B", 3, "7.2"), ("B", 3, "7.2")], "bundle_id string, page int, marker string")
    assert {x.missing: x.outcome for x in reader.confirmed(hits, scans).collect()} == {"7.2": "gap_recovered", "7.3": "gap_found_obscured", "7.4": "gap_found_unconfirmed", "7.5": "numbering_gap", "7.6": "numbering_gap"}
    d = spark.createDataFrame([("1", "2", "1", 0.9, False), ("1", "2", "2", 0.9, False), ("1", "2", "3", 0.9, False), ("1", "2", "1", 0.5, False), ("1", "2", "1", 0.9, True)], "a_marker string, b_marker string, reread_marker string, reread_score double, obscured boolean")
    assert [x.resolution for x in reader.arbitration(d).collect()] == ["confirmed_first", "corrected_by_arbitration", "marker_uncertain", "not_confirmed", "obscured"]
    c = spark.createDataFrame([(1, "a", "2020-01-01"), (2, "b", None), (3, "c", None)], "id int, name string, iso_value string")
    v = spark.createDataFrame([(1, False, None, None), (2, True, " B ", "2021-02-03"), (9, True, "x", None)], "id int, keep boolean, name string, iso_value string")
    assert sorted(tuple(x) for x in reader.judged(c, v).collect()) == [(2, "B", "2021-02-03"), (3, "c", None)]
    k = spark.createDataFrame([("a", 1), ("a", 1), ("a", None)], "x string, y int").select(reader.cache_key(F.col("x"), F.col("y"))).collect()
    assert k[0] == k[1] != k[2] and len(k[0][0]) == 24
    m = spark.createDataFrame([("dup: x",), ("dup: y",), ("other",), (None,)], "r string")
    assert {x.reason: x.n for x in merges.reason_counts(m, "r").collect()} == {"dup": 2, "other": 1}
    a = spark.createDataFrame([("g", ["en", "de"]), ("g", ["en", None]), ("h", None)], "g string, l array<string>")
    assert [tuple(x) for x in merges.distinct_sorted(a, ["g"], "l").collect()] == [("g", ["de", "en"])]


def test_sources_and_sinks(spark, tmp_path):
    import hashlib

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.bin").write_bytes(b"abc")
    r = sources.read_files(spark, str(tmp_path / "in"), "*.bin").first()
    assert (r.length, r.digest) == (3, hashlib.sha256(b"abc").hexdigest())
    (tmp_path / "t").mkdir()
    (tmp_path / "t/gcc_1.json").write_text(json.dumps({"doc_type": "gcc", "title": "T", "entries": {"1|scope": ["true", "1"], "2|x": ["false", "2"]}}))
    (tmp_path / "t/bad.json").write_text("{broken")
    t = sources.read_templates(spark, str(tmp_path / "t")).orderBy("key").collect()
    assert [(x.template_id, x.doc_type, x.key) for x in t] == [("gcc_1", "gcc", "1|scope"), ("gcc_1", "gcc", "2|x")]
    p = spark.createDataFrame([(i,) for i in range(1, 9)], "page int")
    assert [r.page for r in sources.page_range(p, 3, 5).collect()] == [3, 4, 5] and sources.page_range(p, None, 2).count() == 2 and sources.page_range(p).count() == 8
    with pytest.raises(ValueError):
        sources.page_range(p, 5, 3)
    f = spark.createDataFrame([(1, [10.2, 50.0], "b"), (1, [10.4, 5.0], "a"), (1, [2.0, 1.0], "top"), (1, [3.0, 1.0], " ")], "page int, box array<double>, text string")
    assert sources.text_layer(f, ["page"]).first().text == "top\na\nb"
    raw = spark.createDataFrame([("B", 1, 0, "clause", None, " ", [1, 2, 3, 4]), ("B", 1, 1, "clause", "1", None, [1, 2]), ("B", 1, 2, "clause", None, "x", [1, 2, 3, 4])], "bundle_id string, page int, pos int, kind string, number string, text string, box array<int>")
    b = sources.build_blocks(raw, ["bundle_id", "page"]).orderBy("idx").collect()
    assert [(x.block_id, x.idx, x.box) for x in b] == [("p0001_b001", 0, None), ("p0001_b002", 1, [1, 2, 3, 4])]
    sinks.write_jsonl(p, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 8
    sinks.write_tables({"pages": p}, str(tmp_path / "db"))
    sinks.write_tables({"pages": p}, str(tmp_path / "db"))
    assert spark.read.parquet(str(tmp_path / "db/pages")).count() == 16
    assert sinks.async_url("postgresql://h/d") == "postgresql+asyncpg://h/d" and sinks.async_url("x://") == "x://"
