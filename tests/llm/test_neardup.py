import random
import re
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from quirework.llm import neardup as nd

WORDS = [f"w{i}x" for i in range(400)]


def corpus(n=140, seed=1):
    rng = random.Random(seed)
    base = [[rng.choice(WORDS) for _ in range(rng.randint(30, 80))] for _ in range(n // 5)]
    rows = []
    for i in range(n):
        t = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 2, 5, 9])):
            t[rng.randrange(len(t))] = rng.choice(WORDS)
        if rng.random() < 0.2:
            t = t[5:] + t[:5]
        rows.append((i, "Title" if i % 3 else None, " ".join(t)))
    return rows


def sets(rows, p):
    out = {}
    for i, title, text in rows:
        if text and len(re.findall("[a-z0-9]+", text.lower())) >= p.min_words:
            w = re.findall("[a-z0-9]+", f"{title or ''} {text}".lower())
            out[i] = {tuple(w[k : k + p.k]) for k in range(len(w) - p.k + 1)}
    return out


def brute(rows, p):
    s = sets(rows, p)
    ids = sorted(s)
    return {(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if len(s[a] & s[b]) / len(s[a] | s[b]) >= p.similarity}


SCHEMA = "id bigint, title string, text string"


def test_pairs_against_brute_force(spark):
    p = nd.Params()
    rows = corpus()
    got = {tuple(r) for r in nd.edited_pairs(spark.createDataFrame(rows, SCHEMA), p).collect()}
    want = brute(rows, p)
    assert got <= want
    assert len(got) >= 0.97 * len(want)


def test_large_buckets_are_split_or_compared_in_blocks(spark):
    p = replace(nd.Params(), bucket=4, runs=4)
    rng = random.Random(3)
    base = [rng.choice(WORDS) for _ in range(60)]
    rows = []
    for i in range(60):  # one group far larger than a bucket
        t = list(base)
        t[rng.randrange(60)] = rng.choice(WORDS)
        rows.append((i, None, " ".join(t)))
    got = {tuple(r) for r in nd.edited_pairs(spark.createDataFrame(rows, SCHEMA), p).collect()}
    assert got == brute(rows, p)


def family(n, edits, seed):
    """Edited copies of one text, by words of their own."""
    rng = random.Random(seed)
    base = [rng.choice(WORDS) for _ in range(150)]
    rows = []
    for i in range(n):
        t = list(base)
        for at in rng.sample(range(150), edits):
            t[at] = f"own{i}x{at}"
        rows.append((i, None, " ".join(t)))
    return rows


def test_pairs_of_a_large_bucket_are_not_parted(spark):
    df = spark.createDataFrame(family(150, 8, 5), SCHEMA)  # most pairs are little above the threshold
    small, large = ({tuple(r) for r in nd.edited_pairs(df, replace(nd.Params(), bucket=b, runs=2, depth=1)).collect()} for b in (8, 1000))
    assert small == large and len(large) > 5000


def test_blocks_compare_all_rows_of_a_bucket(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(-(2**62), 2**62, 2)
    bits = [(k, 100, *(int(b ^ (1 << int(rng.integers(62)))) for b in base)) for k in range(70)]  # 4 bits apart at most
    sig = spark.createDataFrame(bits, "h long, n int, s1 long, s2 long")
    rows = spark.createDataFrame([(key, h) for key in (7, -9) for h in range(70 if key == 7 else 30)], "key long, h long")
    got = [(r.a, r.b) for r in nd._blocks(rows, sig, nd.Params(), size=16).collect()]
    assert sorted(got) == sorted([(a, b) for m in (70, 30) for a in range(m) for b in range(a + 1, m)])


def test_a_family_of_a_third_of_the_rows_is_met():
    """Its members share frequent shingles and have rare ones of their own, which other rows hold too."""
    p = nd.Params()
    rows = family(400, 9, 6)
    grams, begin = nd.shingle_sets([t for *_, t in rows], p.k)
    cells = np.zeros(p.counters + 1, np.int64)
    cells[(grams % np.uint64(p.counters)).astype(np.int64)] = 20  # as in a large table
    cells[:-1] = np.maximum(cells[:-1], np.bincount((grams % np.uint64(p.counters)).astype(np.int64), minlength=p.counters))
    cells[-1] = 1200
    keys, owner = nd.path_ends(grams, begin, cells, p)
    ends = [set(keys[owner == i].tolist()) for i in range(400)]
    s = sets(rows, p)
    near = [(a, b) for a in range(0, 400, 7) for b in range(a + 1, 400) if 0.5 <= len(s[a] & s[b]) / len(s[a] | s[b]) <= 0.55]
    assert len(near) > 300
    assert sum(bool(ends[a] & ends[b]) for a, b in near) >= 0.95 * len(near)


def test_further_rounds_where_the_runs_disagree(spark):
    df = spark.createDataFrame(family(150, 8, 5), SCHEMA)
    p = replace(nd.Params(), runs=2, branch=1, depth=2, bucket=8)
    want = brute(family(150, 8, 5), p)
    one, all_ = (len({tuple(r) for r in nd.edited_pairs(df, replace(p, rounds=k)).collect()} & want) / len(want) for k in (1, 8))
    assert one < 0.97 < all_


def test_rounds_and_their_recall_are_reported(spark):
    df = spark.createDataFrame(family(150, 8, 5), SCHEMA)
    p = replace(nd.Params(), runs=2, branch=1, depth=2, bucket=8)
    rows = nd.join_runs(df, p).collect()
    want = len(brute(family(150, 8, 5), p))
    assert [r.n_runs for r in rows] == [2 * (k + 1) for k in range(len(rows))] and rows[-1].n_links >= 0.95 * want
    assert all(r.recall < p.recall for r in rows[:-1]) and (rows[-1].recall >= p.recall or len(rows) == p.rounds)
    assert all(abs(r.recall - r.n_links / want) < 0.1 for r in rows)
    assert [tuple(r) for r in nd.join_runs(df.where("false"), p).collect()] == [(2, 0, 1.0)]


def test_edges(spark):
    text = " ".join(WORDS[:40])
    rows = [(1, "T", text), (1, "T", text), (2, "T", text), (3, None, None), (4, "x", ""), (5, "t", "too short"), (None, "T", text), (6, None, text), (7, "T", text.upper().replace(" ", "\n- ")), (8, "T", "q" * 5000 + " " + text)]
    df = spark.createDataFrame(rows, SCHEMA).select("*", F.lit(1).alias("h"), F.lit("x").alias("keys"), F.lit(2).alias("a"))
    got = {tuple(r) for r in nd.edited_pairs(df).collect()}
    assert got == {(a, b) for a in (1, 2, 6, 7, 8) for b in (1, 2, 6, 7, 8) if a < b}
    g = {r.id: (r.group_id, r.n_links) for r in nd.copy_groups(df).collect()}
    assert g[1][0] == g[2][0] == g[6][0] == g[7][0] == g[8][0] == 1 and g[3] == (3, 0) and g[5] == (5, 0)
    assert nd.edited_pairs(df.where("false")).count() == 0 and nd.copy_groups(df.where("false")).count() == 0


def test_words_and_sketches():
    texts = ["Ab1 c-d é f", "", "x" * 100 + " y", "ab1 C d F"]
    h, of = nd.word_hashes(texts)
    assert np.bincount(of, minlength=4).tolist() == [4, 0, 2, 4] and h[:4].tolist() == h[-4:].tolist()
    g, begin = nd.shingle_sets(texts, 3)
    assert np.diff(begin).tolist() == [2, 0, 0, 2] and g[:2].tolist() == g[2:].tolist()
    assert nd.word_hashes(["ab1 zz"])[0][0] == h[0] == nd.word_hashes(["x" * 100 + " ab1"])[0][-1]


@pytest.mark.parametrize("batch", [["ab cd ef"], ["ab cd ef", "y" * 80]])
def test_a_word_has_one_hash_whatever_stands_beside_it(batch):
    assert nd.word_hashes(batch)[0][:3].tolist() == nd.word_hashes(["ab cd ef"])[0].tolist()
