import random

import numpy as np
import pytest

from quirework.llm import mixing, namelinks, subjects


def lev(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def test_distances():
    rng = random.Random(1)
    a = ["".join(rng.choice("abcd") for _ in range(rng.randint(0, 70))) for _ in range(40)]
    b = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 64))) for _ in range(20)]
    d = namelinks.distances_to(a, b)
    assert all(d[i, j] == lev(x, y) for i, x in enumerate(a) for j, y in enumerate(b))
    assert namelinks.edit_distances(["ca", "abcd", "", "ab"], ["abc", "acbd", "x", "ab"]).tolist() == [2, 1, 1, 0]


def test_radius_join_against_brute_force(spark):
    rng = random.Random(2)
    s = {"".join(rng.choice("abc") for _ in range(rng.randint(3, 9))) for _ in range(250)}
    df = spark.createDataFrame([(x,) for x in s] + [(None,), ("",), ("abc",), ("abc",)], "s string")
    s.add("abc")
    got = {(r.a, r.b): r.d for r in namelinks.radius_pairs(df, 2, pivots=9, per_cell=8).collect()}
    assert got == {(a, b): d for a in s for b in s if a < b and (d := lev(a, b)) <= 2}
    assert namelinks.radius_pairs(df.where("false")).count() == 0


def test_entities(spark):
    m = [
        ("a", "B", "Polpolris Tirombufos Electricals Limited"), ("b", "B", "M/s. Tirombufos  Polpolris Elec. (P) Ltd"), ("c", "B", "POLPOLRIS TIROMBUUFOS ELECTRICALS LTD & its successors"), ("d", "B", "Polpolristirombufos Electricals"), ("e", "B", "PTEL"),
        ("f", "C", "Polpolris Tirombufos Steel Industries Limited"), ("g", "C", "Steel Ind of Polpolris-Tirombufos"), ("h", "C", "PTEL"), ("i", "C", "Polpolris Tirombufos Ltd"),
        ("j", "B", "Richard H. Yanstoris-Lumskaikel"), ("k", "B", "YANSTORIS LUMSKAIKEL, Rick"), ("l", "B", "R. Yanstoris Lumskaiekl"), ("m", "B", None), ("n", "B", "  "), ("o", "B", "Zorvor Kelqua Electricity Board"), ("p", "B", "Elec. Bd of Zorvor Kelqua"), ("a", "B", "Polpolris Tirombufos Electricals Limited"),
    ]
    df = spark.createDataFrame(m, "mention string, bundle_id string, name string").selectExpr("*", "'x' entity", "'y' family")
    al = spark.createDataFrame([("B", "PTEL", "Polpolris Tirombufos Electricals Limited"), ("B", "the Employer", "Zorvor Kelqua Electricity Board"), (None, None, None)], "bundle_id string, alias string, name string")
    got = {r.mention: r.entity for r in namelinks.link(df, al).collect()}
    groups = {frozenset(k for k in got if got[k] == e) for e in got.values()}
    assert groups == {frozenset("abcde"), frozenset("fgi"), frozenset("h"), frozenset("jkl"), frozenset("op")}
    pairs = {tuple(r) for r in namelinks.entity_pairs(namelinks.link(df, al)).collect()}
    assert ("a", "e") in pairs and len(pairs) == 10 + 3 + 3 + 1
    assert namelinks.link(df.where("false"), al.where("false")).count() == 0


def test_short_names_with_a_typing_error(spark):
    names = ["Sharma Steel Ltd", "Sharma Steel Limited", "Shrama Steel Ltd", "Tata Power Ltd", "Tatta Power Ltd", "Mehta Steel Ltd"]
    df = spark.createDataFrame([(str(i), "B", n) for i, n in enumerate(names)], "mention string, bundle_id string, name string")
    al = spark.createDataFrame([], "bundle_id string, alias string, name string")
    e = {r.mention: r.entity for r in namelinks.link(df, al).collect()}
    assert e["0"] == e["1"] == e["2"] and e["3"] == e["4"] and len({e["0"], e["3"], e["5"]}) == 3


def test_orders_of_words_and_firms_with_given_names(spark):
    names = ["Alvora Bexmund Cortell Steel Ltd", "Cortell Bexmund Alvora Steel Limited", "Bexmund Alvoar Cortell Steel", "Thomas Steel Ltd", "M/s Thomas Steel Limited", "J. K. Power Ltd", "JK Power Limited", "J K Power", "Kate Mendelhorst", "Catharina Mendelhorst", "Robert Mendelhorst"]
    df = spark.createDataFrame([(str(i), "B", n) for i, n in enumerate(names)], "mention string, bundle_id string, name string")
    al = spark.createDataFrame([], "bundle_id string, alias string, name string")
    rows = namelinks.with_links(namelinks.link(df, al)).collect()
    e = {r.mention: r.entity for r in rows}
    groups = {frozenset(k for k in e if e[k] == x) for x in e.values()}
    assert groups == {frozenset("012"), frozenset("34"), frozenset("567"), frozenset("89"), frozenset(["10"])}
    assert {r.mention: r.n_links for r in rows}["1"] == 2


def test_mixing(spark):
    rng = random.Random(5)
    rows = [(i, s, rng.randint(50, 400)) for i, s in enumerate(["big"] * 3000 + ["mid"] * 600 + ["small"] * 60 + ["other"] * 10)] + [(9001, None, 10), (9002, "big", 0)]
    sizes = spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 3), ("small", 0.15, 3), ("absent", 0.05, 2), ("big", 0.5, 1)], "source string, target_share double, max_repeats int")
    sel, shares = mixing.mixed(sizes, targets)
    sh = {r.source: r for r in shares.collect()}
    assert sh["absent"].reached_share == 0 and not sh["absent"].in_reach and not sh["small"].in_reach
    for s in ("big", "mid"):
        assert sh[s].share_of_total == pytest.approx(sh[s].target_share, rel=0.01)
    per = {}
    for r in sel.collect():
        per.setdefault(r.doc_id, []).append(r.copy_no)
    cap = {"big": 1, "mid": 3, "small": 3}
    src = {i: s for i, s, _ in rows}
    assert all(sorted(c) == list(range(1, len(c) + 1)) and len(c) <= cap[src[d]] for d, c in per.items())
    assert sum(len(c) for d, c in per.items() if src[d] == "small") == 180
    assert sel.count() == sum(r.n_copies for r in sh.values())
    none, report = mixing.mixed(sizes.where("false"), targets)
    assert none.count() == 0 and {r.drawn_tokens for r in report.collect()} == {0}
    assert mixing.cdf(1.5, 3) == pytest.approx(np.cumsum([np.exp(-1.5), 1.5 * np.exp(-1.5), 1.125 * np.exp(-1.5)]).tolist())


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "hello world", "x"), (2, None, "y"), (3, "", "z")], "doc_id bigint, text string, n_tokens string")
    assert {r.doc_id: r.n_tokens for r in mixing.token_counts(df, ["doc_id"], "text").collect()} == {1: 2, 2: 0, 3: 0}


def test_sections():
    head, paras = subjects.sections("Court\n12 May 2020\n\nHeadnote: x\n\n[1] One thing.\n\nCT page 2\n\n[2] Two.\n\nDone.")
    assert "Headnote" in head and paras == ["One thing.", "Two."]
    assert subjects.sections("no numbers") == ("no numbers", [])
    assert subjects.sections("") == ("", [])


@pytest.mark.parametrize("mark, gap", [("({})", "\n\n"), ("[{}]", "\n"), ("{}.", "\n\n"), ("{}", "\n")])
@pytest.mark.parametrize("caption", ["01 June 2023\nA Ltd v B", "1 Smith v Jones", "1. Mai 2020\n1 Smith v Jones", "Headnote: x"])
def test_a_caption_with_a_date_is_no_paragraph(mark, gap, caption):
    paras = ["The tenancy deposit.", "The ground rent in\n1 June 2020\nwas due.", "The boundary wall."]
    text = f"Court CT-017\nZ 2021/00-11\n{caption}{gap}" + gap.join(f"{mark.format(i)} {p}" for i, p in enumerate(paras, 1))
    head, got = subjects.sections(text)
    assert [p.rstrip() for p in got] == paras
    assert head.rstrip().endswith(caption)


def test_paragraphs_are_whole_and_numbers_may_be_missing():
    text = "Court\n\n[1] One.\n\nMore of one, see\npage 4 of the record.\n\nCT-017 | Z 2021/00-11 | 3\n\n[2] Two.\n\n[4] Four.\n\n- CT-017 Z 2021/00-11 - 4 -\n\nMore.\n\n[S] Five.\n\n[6] Six.\n\nIt is so ordered."
    got = [p.split() for p in subjects.sections(text)[1]]
    assert got == [x.split() for x in ("One. More of one, see page 4 of the record.", "Two.", "Four. More. [S] Five.", "Six.")]


def decisions(n=400, seed=8):
    rng = random.Random(seed)
    terms = {1: ["the overtime ledger", "the shift roster", "the works council"], 2: ["the refund claim", "the customs tariff", "the tax assessment"], 3: ["the tenancy deposit", "the boundary wall", "the ground rent"]}
    docs, truth = [], {}
    for d in range(n):
        subj = rng.sample([1, 2, 3], rng.choice([1, 1, 2]))
        paras = [f"The finding on {rng.choice(terms[s])} was open to the judge." for s in subj for _ in range(rng.randint(2, 3))] + ["The appeal lies only on a point of law."]
        other = rng.choice([s for s in (1, 2, 3) if s not in subj])
        paras.append(f"Counsel drew an analogy with {rng.choice(terms[other])}, which did not assist.")
        rng.shuffle(paras)
        docs.append((d, "Court\n\n" + "\n\n".join(f"{i} {p}" for i, p in enumerate(paras, 1)), f"Z 20/{d}", "s"))
        truth[d] = set(subj)
    return docs, truth


def test_subjects_on_held_out_documents(spark):
    docs, truth = decisions()
    rng = random.Random(9)
    labels = [(d, s) for d in range(200) for s in (truth[d] if rng.random() > 0.03 else {rng.choice([1, 2, 3])})]
    df = spark.createDataFrame(docs + [(900, None, None, None), (901, "", "", "")], "doc_id bigint, text string, docket string, source string").selectExpr("*", "1 subject_id", "'x' probability")
    areas = spark.createDataFrame([(1, "labour"), (2, "tax"), (3, "property")], "subject_id int, subject_name string")
    lab = spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id bigint, subject_id int")
    got = {(r.doc_id, r.subject_id) for r in subjects.assigned(df, lab, areas).where("probability >= 0.5").collect()}
    want = {(d, s) for d in range(200, 400) for s in truth[d]}
    held = {x for x in got if 200 <= x[0] < 400}
    assert len(held & want) >= 0.98 * len(want) and len(held & want) >= 0.98 * len(held)
    assert subjects.assigned(df, lab.where("false"), areas).count() == 0
    assert subjects.assigned(df.where("false"), lab, areas).count() == 0
    share = subjects.shares(subjects.assigned(df, lab, areas).where("probability >= 0.5"), df, areas).collect()
    assert len(share) == 3 and all(0 < r.share < 1 for r in share)
