from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from quirework.functions import dates, numbering, text



@pytest.fixture(autouse=True)
def column(spark):
    """Columns can only be made once there is a session."""
    global C
    C = F.col("x")


def one(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.select("i", expr.alias("y")).orderBy("i").select("y").collect()]


def test_markers(spark):
    values = ["14 .1", "14.1.", "Clause 7", "(a)", "iv)", "Annexure - III", "Schedule C", "l4.1", "7.0", "Clause 7.0", "Annexure No. 04", "", None, "b"]
    want = ["14.1", "14.1", "7", "(a)", "(iv)", "annexure:3", "schedule:c", "14.1", "7", "7.0", "annexure:4", None, None, "(b)"]
    assert one(spark, values, numbering.normalize_marker(C)) == want
    assert one(spark, ["1.2.3", "(4)", "(iv)", "(b)", "Annexure 2", "foo", None], numbering.depth_hint(C)) == ["dotted-3", "paren-number", "roman-or-alpha", "alpha", "annexure", "named", "-"]


def test_roman_round_trip(spark):
    df = spark.range(1, 400)
    bad = df.where(numbering.roman_to_int(numbering.int_to_roman(F.col("id"))) != F.col("id")).count()
    assert bad == 0
    assert one(spark, ["iiii", "xz", "", None, "cccc"], numbering.roman_to_int(C)) == [4, None, None, None, None]


def test_gaps(spark):
    pairs = [("7.2", "7.4"), ("(a)", "(d)"), ("(ii)", "(v)"), ("(v)", "(x)"), ("7.1", "8.1"), ("1", "9"), ("1", "1"), (None, "2")]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    got = [r[0] for r in df.orderBy("i").select(numbering.between(F.col("a"), F.col("b"), 4)).collect()]
    assert got == [["7.3"], ["(b)", "(c)"], ["(iii)", "(iv)"], ["(w)"], [], [], [], []]


def test_labels_and_keys(spark):
    got = one(spark, ["Page 3 of 112", "GCC-14", "iii", "- 7 -", "", None], numbering.parse_label(C))
    assert [tuple(x) if x else None for x in got] == [("", 3), ("gcc", 14), ("roman", 3), ("", 7), None, None]
    got = one(spark, ["see ANNEXURE-III: x", "annex 3", "Form of bond", "Form F-3", None], numbering.attachment_key(C))
    assert [tuple(x) if x else None for x in got] == [("annexure", "3"), ("annexure", "3"), None, ("form", "f"), None]
    assert one(spark, ["(a) x", "12. y", "Clause 3 z", "no"], numbering.leading_marker(C)) == ["(a)", "12.", "Clause 3", None]


def test_dates(spark):
    values = ["15 March 2024", "1st April, 2023", "March 15, 2024", "15/03/24", "2024-03-05", "31.02.2024", "none", None]
    assert one(spark, values, dates.parse_snippet(C)) == ["2024-03-15", "2023-04-01", "2024-03-15", "2024-03-15", "2024-03-05", None, None, None]
    assert one(spark, ["2024-02-29", "2023-02-29", "1989-01-01", "2024-1-1", None], dates.valid_iso(C)) == ["2024-02-29", None, None, None, None]
    assert one(spark, ["effective date is 01/02/2021", "far"], dates.near_hits(C, 50)) == [1, 0]
    assert one(spark, ["12 May 2020", "LOI/12", "Contract Period", "Completion Date", ""], dates.bad_name(C)) == [True, True, True, False, True]
    df = spark.createDataFrame([("2024-01-02", "2 January 2024", "high"), ("2024-01-02", "3 January 2024", "high"), ("2024-01-02", None, "high")], "a string, b string, c string")
    assert [tuple(r[0]) for r in df.select(dates.grounded(F.col("a"), F.col("b"), F.col("c"))).collect()] == [("2024-01-02", "high"), ("2024-01-03", "low"), (None, "low")]


def test_text(spark):
    assert one(spark, ["a  –b  c", None, "ﬁx"], text.clean_udf(C)) == ["a -b c", "", "fix"]
    assert one(spark, ["Straße (x), [illegible] y!", None], text.norm_text(C)) == ["strasse (x) y", ""]
    assert one(spark, ["same line here\n" * 6, "same line here\nx\n" * 6, "ab\n" * 9, None], text.looks_degenerate(C)) == [True, True, False, False]
    assert one(spark, ["a b c d e f", "a b", None], F.size(text.shingles(C, 5))) == [2, 0, 0]
    assert one(spark, ["GENERAL CONDITIONS OF GCC", "Mixed Case"], text.pretty(C)) == ["General Conditions Of GCC", "Mixed Case"]
    assert one(spark, ["a [[BRK]] b\x00 \nc"], text.strip_marks(C)) == ["a b\nc"]
    got = one(spark, ["hello world"], text.similarity_udf(C, F.lit("hello there")))
    assert got == [pytest.approx(SequenceMatcher(None, "hello world", "hello there").ratio())]


def test_glued_sections_and_heading_titles(spark):
    values = ["Section F - General Conditions of ContractSection 1 - Definitions", "General Conditions of Contract SECTION-2", "Conditions of Supply Section C Notes", "Section 4 - Payment", "Short Section 1", "", None]
    want = ["Section F - General Conditions of Contract", "General Conditions of Contract", "Conditions of Supply Section C Notes", "Section 4 - Payment", "Short Section 1", "", None]
    assert one(spark, values, text.trim_embedded_section(C)) == want
    long = "word " * 30
    values = ["4.1 Payment: the rest. More", "4.1) Payment terms\nsecond line", long, "a. b", "", None]
    assert one(spark, values, text.heading_title(C, F.lit("4.1"))) == ["Payment:", "Payment terms", long[:90].strip(), "a.", None, None]
    assert one(spark, ["4.1 Payment"], text.heading_title(C)) == ["4.1 Payment"]


def test_terms_near_dates_against_a_loop(spark):
    import random
    import re

    rng = random.Random(3)
    terms = ["Signing Date", "site handing over", "w.e.f.", "possession date", "date of this agreement", "mobilisation date", "key dates", "LOA", "The Completion Date means", "work order"]
    texts = ["".join(rng.choice([*(t + " " for t in terms), "15 March 2024 ", "01/02/2021, ", "2020-01-01; ", "x" * rng.randint(1, 160) + " "]) for _ in range(rng.randint(0, 14))) for _ in range(60)] + ["", None]
    at = lambda p, t: [m.start() for m in re.finditer(p, t)]
    want = [None if t is None else sum(abs(a - b) <= 200 for a in at(dates.TERMS, t) for b in at(dates.LITERAL, t)) for t in texts]
    assert sum(x or 0 for x in want) > 100
    got = one(spark, texts, dates.near_hits(C))
    assert got[:-1] == want[:-1] and not got[-1]
