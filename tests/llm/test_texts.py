import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quirework.llm import chunking, leakage, scanrepair, truncation


def test_pieces_round_trip(spark):
    rng = random.Random(2)
    texts = ["", None, "short", "x" * 9000, "word " * 1500, "Sentence one is here. " * 400, "para text here\n\n" * 300, "(a) item;\n" * 700, "é野\U00020bb7 " * 900, "a\n\n\n\n" * 900, "ab " * 667]
    texts += ["".join(rng.choice("ab .\n;A(") for _ in range(rng.randint(1900, 7000))) for _ in range(25)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").withColumn("piece", F.lit("clash")).withColumn("_b", F.lit(1))
    rows = {}
    for r in chunking.pieces(df, ["id"], "t").orderBy("id", "piece_no").collect():
        rows.setdefault(r.id, []).append(r)
    for i, t in enumerate(texts):
        ps = rows.get(i, [])
        assert "".join(p.piece[p.overlap_chars :] for p in ps) == (t or "")
        assert all(0 < len(p.piece) <= 2000 for p in ps) and [p.piece_no for p in ps] == list(range(1, len(ps) + 1))
        for a, b in zip(ps, ps[1:]):
            assert b.piece[: b.overlap_chars] == "" or a.piece.endswith(b.piece[: b.overlap_chars])
            assert t[b.start_pos - 1 :].startswith(b.piece[b.overlap_chars :])
        if len(t or "") <= 2000:
            assert len(ps) == (1 if t else 0)
    ends = [p.piece for p in rows[6]][:-1]
    assert all(e.endswith("\n\n") for e in ends)
    assert all(p.piece.endswith(". ") for p in rows[5][:-1])
    assert chunking.pieces(df.where("false"), ["id"], "t").count() == 0


CLEAN = [
    "The contractor shall give notice of the delay before the works begin. The engineer shall certify the amount in writing.",
    "The following are included:\n(a) the bank guarantee, at its own cost;\n(b) the site diary, in three copies; and\n(c) the bonus, if agreed.",
    "| Item | Description | Qty |\n|---|---|---|\n| 1 | the crane | 12 |",
    "GOVERNING LAW\n\nThe contractor shall not assign the guarantee before the engineer shall certify the works.",
    "Grade M25, fe-500 bars; see § 4.\n\nThe engineer shall certify the works.",
]


def scan_corpus():
    rows = [("t", i, t) for i in range(0, 400) for t in [CLEAN[i % len(CLEAN)]]]
    noisy = {
        1000: ("The contractor shall give\nnotice of the de-\nlay before the works begin.", "The contractor shall give notice of the delay before the works begin.", (True, False, False)),
        1001: ("The c0ntractor sha1l give notice.", "The contractor shall give notice.", (False, True, False)),
        1002: ("The contractor shall give\n\nPage 3 of 12\n\nnotice of the delay.", "The contractor shall give notice of the delay.", (False, False, True)),
        1003: ("The engineer shall cer¬\nGCC-7\ntify the amount in writing.", "The engineer shall certify the amount in writing.", (True, False, True)),
        1004: ("The c0ntr-\nGCC-7\nactor shall give notice.", "The contractor shall give notice.", (True, True, True)),
        1005: ("The works are off-\nshore works, and the well-\nknown engineer shall certify.", "The works are off-shore works, and the well-known engineer shall certify.", (False, False, False)),
        1007: ("The works are in\nwriting, block 0F and code A/0f/B-1n.", "The works are in writing, block 0F and code A/0f/B-1n.", (False, False, False)),
        1006: ("0f the contractor, and 1n the works.", "Of the contractor, and in the works.", (False, True, False)),
    }
    rows += [("t", k, v[0]) for k, v in noisy.items()]
    rows += [("t", 1500, "The off-shore works, with a well-known engineer, and a state-of-the-art crane.")]  # once each: rare compounds count too
    rows += [("t", 1600 + i, "The end of the works in writing, in time and of use.") for i in range(12)]
    rows += [("t", 2000 + i, f"The engineer shall certify the\n{f}\namount in writing.") for i, f in enumerate([f"GCC-{n}" for n in range(30)] + [f"Page {n} of 99" for n in range(30)] + [f"- {n} -" for n in range(30)])]
    return rows + [("t", 5000, None), ("t", 5001, ""), ("t", 5001, "")], noisy


def test_scan_repair(spark):
    rows, noisy = scan_corpus()
    df = spark.createDataFrame(rows, "table_name string, row_id bigint, text string").withColumn("_fix", F.lit("clash"))
    furniture = spark.createDataFrame([("Page 3 of 9",), ("- 4 -",), (None,)], "text string")
    p = scanrepair.Params(least=5)
    got = {r.row_id: r for r in scanrepair.repaired(df, furniture, p).collect()}
    for k, (_, want, flags) in noisy.items():
        assert (got[k].text, (got[k].broken_word, got[k].misread_word, got[k].furniture)) == (want, flags)
    for _, i, t in rows[:400]:
        assert got[i].text == t and not (got[i].broken_word or got[i].misread_word or got[i].furniture)
    assert got[5000].text is None and got[5001].text == ""
    # corrections that are too many to hold come by a join, with the same result
    other = {r.row_id: r for r in scanrepair.repaired(df, furniture, scanrepair.Params(least=5, map_entries=0)).collect()}
    assert other == got
    assert scanrepair.repaired(df.where("false"), furniture.where("false")).count() == 0


def test_confusions():
    assert {"shall", "modern", "would"} <= scanrepair.meant("sha1l") | scanrepair.meant("modem") | scanrepair.meant("vvou1d")
    assert "before" in scanrepair.meant("bcforc")
    assert "eeeeeeeex" in scanrepair.meant("eeeeecccx") and "eeeexeeeee" in scanrepair.meant("cccccxcccc".replace("ccccc", "eeeec", 1).replace("cccc", "ceeee")) | scanrepair.meant("eeeexeeeec")
    assert "of" in scanrepair.meant("0f") and "telecommunicationsinfrastructure" in scanrepair.meant("te1ecommunicationsinfrastructure")


def test_truncation(spark):
    rng = random.Random(4)
    full = ["The works shall begin at once.", "(a) to hand over the plan;", "- the crane, if agreed; and ", "| a | b |\n|---|---|\n| 1 | 2 |", "He said so.”", "Is it?", "", None, "  "]
    cut = ["The works shall beg", "The works shall", "The works […]", "The works shall…", "The works sha�", "The works...", "| a | b |\n|---|---|\n| 1 |", "according to Cl.", "The works, ", "The term applies at once;"]
    df = spark.createDataFrame([("s", t, True) for t in cut] + [("s", t, False) for t in full], "source string, text string, want boolean").withColumn("length", F.lit(1)).withColumn("unit", F.lit("x"))
    none = spark.createDataFrame([], "source string, unit string, length int, n bigint, expected double")
    habit = spark.createDataFrame([], "source string, open_share double, ends_usual boolean")
    bad = truncation.cut_texts(truncation.measured(df), none, habit).where("cut <> want").collect()
    assert bad == []
    long = ["".join(rng.choice("abc ") for _ in range(200)) + "x" for _ in range(30)]
    rows = [("lim", t[:100]) for t in long] + [("lim", t[: rng.randint(20, 190)]) for t in long] + [("free", t[: rng.randint(20, 190)]) for t in long] + [(None, "x")]
    found = truncation.limits(truncation.histograms(truncation.measured(spark.createDataFrame(rows, "source string, text string")))).collect()
    assert {(r.source, r.unit, r.length) for r in found} == {("lim", "chars", 100), ("lim", "bytes", 100)}
    empty = truncation.measured(df.where("false"))
    assert truncation.limits(truncation.histograms(empty)).count() == 0 and truncation.detected(empty).count() == 0


def test_limits_and_habits_decide_what_is_cut(spark):
    """A source that ends no text properly has cut texts at its limit alone; without the limit it has none."""
    rng = random.Random(5)
    line = lambda n: "".join(rng.choice("abc ") for _ in range(n - 1)) + "x"
    notes = [line(100) for _ in range(40)] + [line(rng.randint(20, 98)) for _ in range(60)]
    prose = [line(rng.randint(30, 190)) + "." for _ in range(60)] + [line(rng.randint(30, 190)) for _ in range(9)] + [line(80) for _ in range(20)]
    df = spark.createDataFrame([("notes", t) for t in notes] + [("prose", t) for t in prose] + [(None, "cut of")], "source string, text string")
    rows = truncation.measured(df.withColumn("n_ended", F.lit(0)))
    got = truncation.detected(rows).groupBy("source", "reason").count().collect()
    assert {(r.source, r.reason): r["count"] for r in got} == {("notes", "limit"): 40, ("notes", None): 60, ("prose", None): 60, ("prose", "open"): 9, ("prose", "limit"): 20, (None, "open"): 1}
    counts = truncation.histograms(rows)
    without = truncation.cut_texts(rows, truncation.limits(counts).where("false"), truncation.habits(counts, truncation.limits(counts)))
    assert without.where("source = 'notes' AND cut").count() == 0


def phrases_of(t, n=5):
    w = leakage.words(t or "")
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def test_leaks_against_brute_force(spark):
    rng = random.Random(6)
    vocab = [f"v{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(3, 40)))) for i in range(12)] + [(50, None), (51, ""), (52, "Straße, über alles hinweg, ja wohl")]
    docs = []
    for d in range(60):
        w = [rng.choice(vocab + ["zz"]) for _ in range(rng.randint(0, 80))]
        if d % 3 == 0:
            p = leakage.words(items[rng.randrange(12)][1])
            at = rng.randrange(len(w) + 1)
            w[at:at] = p[: rng.randint(1, len(p))]
        text = " ".join(w).upper() if d % 5 == 0 else " ".join(w)
        docs.append((d, text.replace("v1 ", "v1, ", 3)))
    docs += [(90, None), (91, ""), (92, "so STRAßE über al-\n les hin\xadweg ja wohl"), (93, " ".join(f"v{i}" for i in range(60)) * 50)]
    want = {(d, i) for d, t in docs for i, s in items if (g := phrases_of(s)) and len(g & phrases_of(t)) * 3 >= len(g)}
    dd, ii = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("item_id", F.lit(1)), spark.createDataFrame(items + items[:2], "item_id bigint, passage string")
    for p in (leakage.Params(), leakage.Params(shard_words=200, sample=3, block_phrases=40)):
        got = leakage.leaks(dd, ii, p).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want
    text = dict(docs)
    for r in got:
        assert r.spans and all(1 <= s.begin <= s.end <= len(text[r.doc_id]) for s in r.spans)
    assert text[92][[r for r in got if r.doc_id == 92][0].spans[0].begin - 1 :].startswith("STRAßE")
    assert leakage.leaks(dd.where("false"), ii).count() == 0 and leakage.leaks(dd, ii.where("false")).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=120), st.lists(st.integers(2, 4), min_size=2, max_size=2))
def test_index_finds_every_occurrence(seq, phrase):
    import numpy as np

    index = leakage.FMIndex(np.array(seq, np.int64), 5, 4)
    lo, hi = index.search(np.array([phrase], np.int64))
    at = sorted(index.locate(np.arange(lo[0], max(lo[0], hi[0]))).tolist())
    assert at == [i for i in range(len(seq) - 1) if seq[i : i + 2] == phrase]


@pytest.mark.parametrize("query", ["p2_found", "p8_found"])
def test_query_against_sql(spark, small, query):
    import duckdb

    from quirework.llm import queries

    con = duckdb.connect()
    for t in ("clauses", "documents", "eval_items"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    want = {tuple(r) for r in con.execute(queries.ORACLES[query]).fetchall()}
    assert {tuple(r) for r in queries.QUERIES[query](spark, small).collect()} == want
