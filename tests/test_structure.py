import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quirework.operators import assemble, boundaries, checks, merges, ordered, tree


def test_windows_cover_every_page_once(spark):
    df = spark.range(1, 500).select(F.col("id").cast("int").alias("n"))
    rows = df.select("n", F.explode(boundaries.windows_in(F.lit(1), F.col("n"), 15, 14)).alias("w")).select("n", "w.*")
    got = rows.groupBy("n").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum((F.col("hi") == F.col("n")).cast("int")).alias("ends"))
    assert got.where("lo <> 1 OR hi <> n OR ends <> 1").count() == 0
    w = df.select("n", F.explode(boundaries.segmentation_windows(F.lit(1), F.col("n"))).alias("w")).select("n", "w.*")
    p = w.withColumn("p", F.explode(F.sequence("lo", "hi"))).where(boundaries.within_edges(F.col("p"), F.col("lo"), F.col("hi"), F.lit(1), F.col("n")))
    seen = p.groupBy("n", "p").count()
    assert seen.groupBy("n").count().where("n <> count").count() == 0  # each page's start is some window's to give


PAGES = "bundle_id string, page int, page_type string, is_document_start boolean, document_title string, printed_label string, running_header string, first_continues boolean, status string, duplicate_of int"


def bundle(spark):
    rows = [
        ("B", 1, "stamp_paper", True, None, None, None, False, "ok", None), ("B", 2, "contract_agreement", True, "Agreement", "1", None, False, "ok", None), ("B", 3, "contract_agreement", False, None, "2", None, True, "ok", None),
        ("B", 4, "letter_of_award", True, None, None, None, False, "ok", None), ("B", 5, "general_conditions", True, None, "GCC-1", "GCC", False, "ok", None), ("B", 6, "general_conditions", False, None, "GCC-2", "GCC", False, "ok", None),
        ("B", 7, "general_conditions", False, None, "GCC-3", "GCC", True, "ok", None), ("B", 8, "blank", False, None, None, None, False, "blank", None), ("B", 9, "annexure", True, None, None, None, False, "ok", None),
        ("B", 10, "annexure", True, None, None, None, False, "ok", None), ("B", 11, "annexure", False, None, None, None, False, "ok", 10),
    ]
    return spark.createDataFrame(rows, PAGES)


def test_segments_of_a_bundle(spark):
    p = bundle(spark)
    starts = boundaries.heuristic_starts(p)
    seg = boundaries.segments(starts, p)
    assert [(r.start_page, r.end_page) for r in seg.orderBy("start_page").collect()] == [(1, 1), (2, 3), (4, 4), (5, 8), (9, 9), (10, 11)]
    assert boundaries.coverage_violations(seg, p).count() == 0
    assert boundaries.coverage_violations(seg.where("start_page <> 4"), p).count() == 1
    begin = spark.createDataFrame([("B", 8, "x"), ("B", 5, "y")], "bundle_id string, start_page int, k string")
    assert sorted(r.start_page for r in boundaries.shift_blank_starts(begin, p).collect()) == [5, 9]
    v = spark.createDataFrame([("B", 9, "continuation", None, None), ("B", 7, "new_document", "annexure", "T"), ("B", 4, "unclear", None, None)], "bundle_id string, page int, verdict string, new_type string, new_title string")
    got = {r.start_page: r.boundary_verified for r in boundaries.apply_verdicts(starts, v, p).collect()}
    assert got == {1: None, 2: None, 4: False, 5: None, 7: True, 10: None}
    empty = p.where("false")
    assert boundaries.segments(boundaries.heuristic_starts(empty), empty).count() == 0


def stack_tree(depths):
    out, stack, prev, counts = [], [], 0, {}
    for i, d in enumerate(depths, 1):
        level = max(1, min(d, prev + 1))
        prev = level
        while stack and stack[-1][0] >= level:
            stack.pop()
        parent = stack[-1][1] if stack else None
        counts[parent] = counts.get(parent, 0) + 1
        path = (stack[-1][2] if stack else ()) + (counts[parent],)
        stack.append((level, i, path))
        out.append((level, parent, path))
    return out


def test_tree_equals_a_stack(spark):
    random.seed(7)
    docs = {f"d{k}": [random.randint(0, 5) for _ in range(random.randint(1, 60))] for k in range(25)}
    rows = [(k, i, v) for k, ds in docs.items() for i, v in enumerate(ds)]
    df = spark.createDataFrame(rows, "doc string, i int, d int")
    got = {}
    for r in tree.tree(df, ["doc"], ["i"], "d").orderBy("doc", "pos").collect():
        got.setdefault(r.doc, []).append((r.level, r.parent_pos, tuple(r.path)))
    assert got == {k: stack_tree(v) for k, v in docs.items()}


def test_rollups_and_sinks(spark):
    from quirework.sinks import files as sinks

    df = spark.createDataFrame([("d", 1, 1, 2, "A", "x"), ("d", 2, 2, 3, "", "y"), ("d", 3, 2, 9, "C", ""), ("d", 4, 1, 4, "D", "z")], "doc string, i int, depth int, last int, head string, body string")
    n = tree.tree(df, ["doc"], ["i"], "depth")
    assert {r.pos: r.page_end for r in tree.page_ends(n, ["doc"], "last").collect()} == {1: 9, 2: 3, 3: 9, 4: 4}
    assert {r.pos: r.full_text for r in tree.full_texts(n, ["doc"], "head", "body").collect()}[1] == "A\n\nx\n\ny\n\nC"
    assert {r.pos: r.path_titles for r in tree.path_titles(n, ["doc"], "head").collect()}[3] == "A > C"
    import json

    got = json.loads(sinks.nested_tree(n, ["doc"], ["pos", "head"]).first().tree)
    assert [x["pos"] for x in got] == [1, 4] and [x["pos"] for x in got[0]["children"]] == [2, 3]
    assert sinks.async_url("postgresql://h/d") == "postgresql+asyncpg://h/d" and sinks.async_url("other://x") == "other://x"


def fold(divs):
    out = []
    for t, header in divs:
        if t == "INDEX_OR_TOC" and out:
            pt, ph = out[-1]
            clash = header and ph and header.lower() not in ph.lower() and ph.lower() not in header.lower()
            if pt in boundaries.FOLDABLE and not clash:
                continue
        out.append((t, header))
    return out


def test_folding_equals_a_loop(spark):
    random.seed(3)
    data = {f"b{k}": [(random.choice(["INDEX_OR_TOC", "INDEX_OR_TOC", "GCC", "OTHER"]), random.choice([None, "Vol I", "Vol II"])) for _ in range(random.randint(1, 14))] for k in range(40)}
    rows = [(b, i + 1, i + 1, t, h, f"t{i}") for b, ds in data.items() for i, (t, h) in enumerate(ds)]
    df = spark.createDataFrame(rows, "bundle_id string, start_page int, end_page int, division_type string, running_header string, title string")
    got = {}
    for r in boundaries.fold_tocs(df).orderBy("bundle_id", "start_page").collect():
        got.setdefault(r.bundle_id, []).append((r.division_type, r.running_header))
    assert got == {b: fold(ds) for b, ds in data.items()}


def test_units_cover_their_division(spark):
    divs = spark.createDataFrame([("B", "D1", 1, 9), ("B", "D2", 10, 12)], "bundle_id string, division_id string, start_page int, end_page int")
    anc = spark.createDataFrame([("B", "D1", "clause", f"c{m}", p, str(m), "t") for m, p in [(1, 3), (2, 3), (3, 7)]], "bundle_id string, division_id string, kind string, anchor_key string, page int, marker string, title string")
    u = boundaries.build_units(anc, divs)
    got = [(r.kind, r.page_start, r.page_end) for r in u.orderBy("division_id", "unit_id").collect()]
    assert got == [("preamble", 1, 2), ("clause", 3, 3), ("clause", 3, 6), ("clause", 7, 9), ("whole", 10, 12)]
    rec = spark.createDataFrame([("B", "D1", "D1-U03", "2A", None, 5)], "bundle_id string, division_id string, after_unit string, marker string, title string, page int")
    got = {r.unit_id: (r.page_start, r.page_end) for r in boundaries.insert_recovered(u, rec).where("division_id = 'D1'").collect()}
    assert got["D1-U03R"] == (5, 6) and got["D1-U03"] == (3, 4)


def test_checks(spark):
    p = spark.createDataFrame([("B", i, lab) for i, lab in enumerate(["GCC-1", "GCC-2", None, "GCC-9", "GCC-3"], 1)], "bundle_id string, page int, printed_label string")
    assert [(r.page, r.code) for r in ordered.label_findings(p, ["bundle_id"]).orderBy("page").collect()] == [(4, "label_jump"), (5, "label_backwards")]
    refs = spark.createDataFrame([("B", 4, "annexure", "1"), ("B", 2, "annexure", "1"), ("B", 3, "form", "2")], "bundle_id string, page int, kind string, idx string")
    found = spark.createDataFrame([("B", "form", "2", 9), ("B", "schedule", "a", 8)], "bundle_id string, kind string, idx string, page int")
    got = {(r.code, r.kind, r.idx): r.pages for r in checks.reference_findings(refs, found, ["bundle_id"]).collect()}
    assert got == {("reference_not_found", "annexure", "1"): [2, 4], ("attachment_not_referenced", "schedule", "a"): [8]}
    listed = spark.createDataFrame([("B", "Annexure 1"), ("B", "General Conditions of Contract"), ("B", "Quality Manual"), ("B", "Quality Plans"), ("B", None)], "bundle_id string, name string")
    docs = spark.createDataFrame([("B", "general_conditions", "GCC"), ("B", "other", "Quality Plan")], "bundle_id string, doc_type string, title string")
    assert sorted(r.name for r in checks.listed_missing(listed, docs, ["bundle_id"]).collect()) == ["Annexure 1", "Quality Manual"]


def test_near_duplicate_pages_against_brute_force(spark):
    random.seed(5)
    words = [f"w{i}" for i in range(300)]
    base = [[random.choice(words) for _ in range(80)] for _ in range(12)]
    texts = []
    for k in range(40):
        t = list(random.choice(base))
        for _ in range(random.choice([0, 0, 1, 8])):
            t[random.randrange(len(t))] = random.choice(words)
        texts.append(" ".join(t))
    df = spark.createDataFrame([("B", i, t) for i, t in enumerate(texts)] + [("B", 98, None), ("B", 99, "")], "g string, k int, text string")
    sets = [{" ".join(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    want = {(a, b) for a in range(40) for b in range(a + 1, 40) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.9}
    pairs = checks.duplicate_pairs(df, ["g"], "k")
    assert {(r.earlier, r.later) for r in pairs.collect()} == want
    dup, first = {}, {}
    for b in range(40):
        for a in range(b):
            if (a, b) in want and a not in dup:
                dup[b] = a
                break
    assert {r.later: r.duplicate_of for r in checks.duplicate_of(pairs, ["g"]).collect()} == dup


def test_alignment(spark):
    cols = "b string, page int, pos int, marker string, text string"
    a = spark.createDataFrame([("B", 1, 0, "2.4", "The supplier shall deliver"), ("B", 1, 1, None, "Only here in the first")], cols)
    b = spark.createDataFrame([("B", 1, 0, "2.5", "The supplier shall deliver"), ("B", 1, 1, None, "Something else entirely")], cols)
    got = {(r.a_pos, r.b_pos): r.outcome for r in checks.aligned(a, b, "b").collect()}
    assert got == {(0, 0): "marker_mismatch", (1, None): "a_only", (None, 1): "b_only"}


def block(kind, text, marker=None, page=1, continues=False):
    return {"kind": kind, "text": text, "marker": marker, "page": page, "continues": continues}


def test_joining_blocks():
    assert assemble.join_blocks([block("paragraph", "the con-"), block("paragraph", "tractor shall", continues=True)]) == "the contractor shall"
    assert assemble.join_blocks([block("paragraph", "one"), block("paragraph", "two", continues=True), block("paragraph", "three")]) == "one two\n\nthree"
    t = assemble.join_blocks([block("table", "| A |\n|---|\n| 1 |"), block("table", "| A |\n|---|\n| 2 |", continues=True)])
    assert t == "| A |\n|---|\n| 1 |\n| 2 |"
    assert assemble.join_blocks([block("handwritten", " ok "), block("paragraph", None)]) == "[Handwritten: ok]"


def plain_key(m):
    return (m or "").strip("(). ").lower() or None


def unit(kind, marker, start, end=None):
    return {"kind": kind, "marker": marker, "title": None, "page_start": start, "page_end": end or start, "key": plain_key(marker)}


def keyed(blocks):
    return [b | {"key": plain_key(b["marker"])} for b in blocks]


def test_distributing_blocks():
    us = [unit("clause", str(i), 26) for i in range(1, 5)]
    bs = keyed([block("paragraph", "BANNER", page=26), *(block("list_item", f"item {i}", str(i), 26) for i in range(1, 5))])
    assert assemble.distribute(us, bs) == [[1], [2], [3], [4]]  # the banner is front matter
    us = [unit("preamble", None, 1), unit("clause", "1", 2, 3)]
    bs = keyed([block("paragraph", "WHEREAS", page=1), block("list_item", "recital", "1", 2), block("clause", "Scope", "1", 2), block("paragraph", "more", page=3)])
    assert assemble.distribute(us, bs) == [[0, 1], [2, 3]]
    us = [unit("clause", "4", 7), unit("clause", "5", 8)]
    bs = keyed([block("clause", "4 x", "4", 7), block("paragraph", "tail", page=8), block("clause", "5 y", "5", 8)])
    assert assemble.distribute(us, bs) == [[0, 1], [2]]
    # a heading on a later page than the unit's first gives all before it back
    us = [unit("clause", "4", 7), unit("clause", "5", 8, 9)]
    bs = keyed([block("clause", "4 x", "4", 7), block("paragraph", "tail", page=8), block("paragraph", "tail", page=9), block("recital", "5 y", "5", 9)])
    assert assemble.distribute(us, bs) == [[0, 1, 2], [3]]
    # a sub-clause on a page of a later clause goes to its own, with what follows it, unless it is far away
    us = [unit("clause", "9", 4), unit("clause", "10", 5), unit("clause", "12", 30)]
    bs = keyed([block("clause", "9 a", "9", 4), block("clause", "10 b", "10", 5), block("clause", "c", "9.1", 5), block("paragraph", "d", page=5), block("clause", "e", "10.1", 5), block("clause", "12 f", "12", 30), block("clause", "g", "10.2", 30)])
    assert assemble.distribute(us, bs) == [[0, 2, 3], [1, 4], [5, 6]]
    assert assemble.distribute(us, bs, "section") == [[0], [1, 2, 3, 4], [5, 6]]
    assert assemble.distribute([], bs) == [] and assemble.distribute(us, []) == [[], [], []]


def test_section_numbers():
    got = [assemble.section_number(x) for x in ["SECTION 6 - LABOUR", "SECTION-6 LABOUR", "Part No. II", "section: 06", "Part A", "PARTY 1", "Clause 6", "", None]]
    assert got == ["6", "6", "ii", "6", "a", None, None, None, None]
    us = [unit("section", "SECTION 5", 1), unit("section", "Section - 6", 2)]
    bs = keyed([block("heading", "SECTION 5 LAW", None, 1), block("paragraph", "tail", None, 2), block("heading", "SECTION-6 LABOUR", None, 2)])
    assert assemble.distribute(us, bs, "section") == [[0, 1], [2]]


def test_unit_texts(spark):
    u = spark.createDataFrame([("D", "U1", "clause", "1", None, 1, 1), ("D", "U2", "clause", "2", None, 5, 5)], "d string, unit_id string, kind string, marker string, title string, page_start int, page_end int")
    b = spark.createDataFrame([("D", 1, 0, "paragraph", None, "Dear Sir", False), ("D", 1, 1, "clause", "1.0", "1. Scope", False), ("D", 1, 2, "signature_block", None, "sign", False), ("E", 1, 2, "clause", "1", "x", False)], "d string, page int, idx int, kind string, marker string, text string, continues boolean")
    r = {x.unit_id: x for x in assemble.unit_texts(u, b, ["d"]).collect()}
    assert (r["U1"].text, r["U1"].n_blocks, r["U1"].first_page, r["U1"].empty) == ("1.0 1. Scope", 1, 1, False)
    assert (r["U2"].text, r["U2"].n_blocks, r["U2"].last_page, r["U2"].empty) == ("", 0, None, True)
    assert assemble.unit_texts(u, b.where("false"), ["d"]).count() == 2 and assemble.unit_texts(u.where("false"), b, ["d"]).count() == 0


def restated_missing(entries, titles):
    from difflib import SequenceMatcher

    from quirework.functions.text import _norm

    out = set()
    for g, e in entries:
        ne = _norm(e)
        if len(ne) >= 6 and ne not in checks.INDEX_WORDS and not any(SequenceMatcher(None, ne, _norm(t)).ratio() >= 0.8 or (len(ne) > 12 and ne in _norm(t)) for h, t in titles if h == g):
            out.add((g, e))
    return out


def test_index_entries_against_a_loop(spark):
    rng = random.Random(12)
    words = "time for completion of the works payment retention money notice defects liability insurance claims variation".split()
    titles = [(g, " ".join(rng.choice(words) for _ in range(rng.randint(1, 6)))) for g in "AB" for _ in range(60)] + [("A", "tme for completion of"), ("A", "payment"), ("A", ""), ("A", "Schedule of payment of retention moneys due"), (None, "x")]
    entries = [("A", "time for completion of workss"), ("A", "payment of retention moneys"), ("A", "payment of unknown things"), ("A", "Contents"), ("A", "abc"), ("C", "no titles at all"), ("A", ""), ("A", None)]
    for g, t in titles[:110]:
        x = list(t or "x")
        for _ in range(rng.randint(0, 9)):
            x[rng.randrange(len(x))] = rng.choice("abcdefgh ")
        entries.append((g, "".join(x).strip()))
    e = spark.createDataFrame(entries, "g string, entry string").withColumn("_t", F.lit("clash"))
    t = spark.createDataFrame(titles, "g string, title string").withColumn("_e", F.lit("clash"))
    want = restated_missing([x for x in entries if x[1] is not None], titles)
    assert ("A", "time for completion of workss") not in want and ("A", "payment of unknown things") in want and len(want) > 20
    assert {tuple(r) for r in checks.index_missing(e, t, ["g"]).collect()} == want
    q = e.select("g", "entry")
    small, large = ({tuple(r) for r in checks.similar_in_blocks(q, "entry", t, "title", ["g"], 0.8, 12, block=n).collect()} for n in (7, 1000))
    assert small == large and len(large) > 20
    assert checks.index_missing(e.where("false"), t, ["g"]).count() == 0
    assert checks.index_missing(e, t.where("false"), ["g"]).count() == len({x for x in entries if x[1] and len(x[1]) >= 6 and x[1] != "Contents"})


def test_parties_without_a_side(spark):
    rows = [(1, "B", 10, None, "X", "CONTRACT_AGREEMENT"), (2, "B", 10, "OTHER", "Y", "CONTRACT_AGREEMENT"), (3, "B", 10, None, "Z", "CONTRACT_AGREEMENT"), (4, "B", 11, "CLIENT", "W", None), (5, "C", 12, "CLIENT", "V", None), (6, "C", 12, None, "U", None), (7, "C", 12, "CLIENT", "T", None), (8, "D", 13, "CLIENT", None, None)]
    df = spark.createDataFrame(rows, "party_id int, bundle_id string, contract_id int, side string, name string, division_type string")
    assert sorted(r.party_id for r in merges.pick_parties(df, ["bundle_id"], "contract_id", ["party_id"]).collect()) == [1, 2, 5]


def test_persisted_tables_keep_their_links(spark):
    from quirework.sinks import files

    doc = spark.createDataFrame([("B", "t\x00x")], "bundle_id string, title string")
    div = spark.createDataFrame([("B", "D1"), ("B", "D2")], "bundle_id string, division_id string")
    cl = spark.createDataFrame([("B", "D1", 1), ("B", "D2", 2)], "bundle_id string, division_id string, clause_id long")
    sub = spark.createDataFrame([(1, 100, "a\x00"), (2, 101, None), (9, 102, "lost")], "clause_id long, subclause_id long, text string")
    t = {k: v.collect() for k, v in files.relational(doc, div, cl, sub).items()}
    assert t["document"][0].title == "tx" and {r.document_key for r in t["division"]} == {t["document"][0].document_key}
    assert {r.division_key for r in t["clause"]} == {r.division_key for r in t["division"]}
    key = {r.clause_id: r.clause_key for r in t["clause"]}
    assert {r.subclause_id: r.clause_key for r in t["subclause"]} == {100: key[1], 101: key[2], 102: None}
    assert len({r.subclause_key for r in t["subclause"]}) == 3


def test_merges(spark):
    rows = [("a", None, "GCC"), ("b", "2024-01-01", None), ("c", "2024-01-01", "GCC"), ("c", "2024-02-01", "SCC"), ("d", "2024-02-01", None), ("d", "2024-01-01", None)]
    df = spark.createDataFrame(rows, "k string, iso_value string, division_type string")
    assert {r.k: (r.iso_value, r.note) for r in merges.date_merge(df, ["k"]).collect()} == {"a": (None, "no value"), "b": ("2024-01-01", "single value"), "c": ("2024-02-01", "precedence"), "d": ("2024-01-01", "conflict")}
    names = spark.createDataFrame([("LETTER OF AWARD",), ("Letter of Award (LOA)",), ("Letter of Award",)], "name string").selectExpr("'k' k", "name")
    assert merges.display_names(names, ["k"], "name").first().display_name == "Letter of Award"
    leg = spark.createDataFrame([("x", "clear"), ("x", "partial"), ("y", None)], "k string, legibility string")
    assert {r.k: r.legibility for r in merges.worst_legibility(leg, ["k"]).collect()} == {"x": "partial", "y": "clear"}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["p", "q"]), max_size=6), st.lists(st.sampled_from(["p", "q"]), max_size=6))
def test_half_merge_never_loses_a_block(top, bottom):
    out = assemble.merge_halves([{"text": x} for x in top], [{"text": x} for x in bottom])
    assert [x["text"] for x in out[: len(top)]] == top
    assert {x["text"] for x in out} == set(top) | set(bottom)


def test_putting_headings_in(spark):
    from quirework.operators import recovery

    bs = [{"kind": "paragraph", "text": "First text here", "y": 10}, {"kind": "paragraph", "text": "Some words. 2.2 Payment terms of the works", "y": 300}]
    got, how = recovery.put_heading(bs, "First text here", 12)
    assert how == "promoted" and [b["kind"] for b in got] == ["heading", "paragraph"]
    got, how = recovery.put_heading(bs, "2.2 Payment terms", 310)
    assert how == "split" and [b["text"] for b in got] == ["First text here", "Some words.", "2.2 Payment terms of the works"]
    got, how = recovery.put_heading(bs, "2.1 Quite another", 100)
    assert how == "inserted" and [b["idx"] for b in got] == [0, 1, 2] and got[1]["text"] == "2.1 Quite another"
    assert recovery.put_heading([], "Alone", None)[1] == "inserted"


def test_ink(spark):
    from quirework.sources import files

    page = bytearray([255] * 10_000)
    page[5050:5060] = bytes(10)
    df = spark.createDataFrame([(bytearray(page), 100), (None, 100), (bytearray(b""), 0)], "p binary, w int")
    got = [r[0] for r in df.select(files.ink_ratio("p", "w")).collect()]
    assert abs(got[0] - 10 / (92 * 92)) < 1e-9 and got[1:] == [None, None]


def test_windows_spread_over_blocks(spark):
    from quirework.operators import spread

    rng = random.Random(21)
    rows = [(g, n, rng.choice([None, n * 10]), rng.randint(-3, 3)) for g in ("a", "b", None) for n in rng.sample(range(1, 400), 60)] + [("a", None, 7, 1)]
    df = spark.createDataFrame(rows, "g string, n int, v int, w int")
    key = lambda n: -1 if n is None else n
    got = spread.running_sum(spread.following(spread.previous(df, ["g"], "n", F.col("v"), "p", 16), ["g"], "n", F.col("v"), "f", 16), ["g"], ["n"], F.col("w"), "s", 16).collect()
    assert len(got) == len(rows)
    for r in got:
        same = [x for x in rows if x[0] == r.g]
        before = [x for x in same if key(x[1]) < key(r.n) and x[2] is not None]
        after = [x for x in same if key(x[1]) > key(r.n) and x[2] is not None]
        assert r.p == (max(before, key=lambda x: key(x[1]))[2] if before else None)
        assert r.f == (min(after, key=lambda x: key(x[1]))[2] if after else None)
        assert r.s == sum(x[3] for x in same if key(x[1]) <= key(r.n))
    assert spread.previous(df.where("false"), ["g"], "n", F.col("v"), "p").count() == 0
