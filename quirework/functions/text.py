"""Scalar functions on text. Native expressions unless the name ends in ``_udf``; UDFs are vectorised over Arrow."""

from __future__ import annotations

import re
import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

# Characters that stand for a hyphen or a straight quote.
DASHES = "‐‑‒–—―−"
QUOTES_FROM, QUOTES_TO = "‘’“”", "''\"\""
#: Word characters in any script; engines disagree on \w.
WORDLIKE = r"\p{L}\p{M}\p{N}_"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def clean(c: Column) -> Column:
    """Dashes and quotes made plain, white space collapsed; null becomes empty. Compatibility forms need :func:`clean_udf`."""
    c = F.translate(F.coalesce(c, F.lit("")), DASHES + QUOTES_FROM, "-" * len(DASHES) + QUOTES_TO)
    return F.trim(F.regexp_replace(c, r"[\s\x{a0}\x{85}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+", " "))


def _clean(s: str | None) -> str:
    if not s:
        return ""
    table = {ord(d): "-" for d in DASHES} | dict(zip(map(ord, QUOTES_FROM), QUOTES_TO))
    return " ".join(unicodedata.normalize("NFKC", s).translate(table).split())


@F.pandas_udf(StringType())
def _clean_udf(s: pd.Series) -> pd.Series:
    return s.map(_clean)


def clean_udf(c: Column) -> Column:
    """:func:`clean` after compatibility normalisation; plain ASCII takes the native way."""
    c = F.coalesce(c, F.lit(""))
    return F.when(c.rlike(r"^[\x00-\x7f]*$"), clean(c)).otherwise(_clean_udf(c))


def norm_lower(c: Column) -> Column:
    """Comparison form with ``lower`` for case folding: no ``[illegible]``, only words and ``.()-``, spaces collapsed."""
    c = F.regexp_replace(F.lower(clean(c)), r"\[illegible\]", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(c, rf"[^{WORDLIKE}\s.()-]", " "), r"\s+", " "))


def _norm(s: str | None) -> str:
    s = re.sub(r"\[illegible\]", " ", _clean(s).casefold())
    return " ".join(re.sub(r"[^\w\s.()-]", " ", s).split())


@F.pandas_udf(StringType())
def _norm_udf(s: pd.Series) -> pd.Series:
    return s.map(_norm)


def norm_text(c: Column) -> Column:
    """Comparison form with full case folding; plain ASCII takes the native way."""
    c = F.coalesce(c, F.lit(""))
    return F.when(c.rlike(r"^[\x00-\x7f]*$"), norm_lower(c)).otherwise(_norm_udf(c))


def ratio(a: str, b: str) -> float:
    """Ratcliff-Obershelp similarity of two comparison forms; 0 if either is empty."""
    return SequenceMatcher(None, a, b).ratio() if a and b else 0.0


def prefix_ratio(a: str, b: str, most: int = 120) -> float:
    n = min(len(a), len(b), most)
    return ratio(a[:n], b[:n])


@F.pandas_udf(DoubleType())
def similarity_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity of the common-length prefix, 120 characters at most, of two raw texts."""
    return pd.Series([prefix_ratio(_norm(x), _norm(y)) for x, y in zip(a, b)])


@F.pandas_udf(DoubleType())
def full_similarity_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity of two whole raw texts."""
    return pd.Series([ratio(_norm(x), _norm(y)) for x, y in zip(a, b)])


def shingles(text: Column, k: int = 5) -> Column:
    """Distinct runs of ``k`` words of the comparison form; empty where there are fewer words."""
    none = F.expr("cast(array() as array<string>)")

    def runs(words: Column) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.size(words) - (k - 1)), lambda i: F.array_join(F.slice(words, i, k), " "))
        return F.when(F.size(words) >= k, F.array_distinct(each)).otherwise(none)

    return let(F.filter(F.split(norm_lower(text), " "), lambda w: w != ""), runs)


def jaccard(a: Column, b: Column) -> Column:
    """Shared share of two sets; 0 if either is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def looks_degenerate(text: Column, repeats: int = 6, shorter: int = 8) -> Column:
    """A line comes ``repeats`` times in a row, lines of at most ``shorter`` characters left aside."""
    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n|[\n\r]"), F.trim), lambda x: F.length(x) > shorter)
    start = F.expr("named_struct('last', cast(null as string), 'run', 0, 'most', 0)")

    def step(s, x):
        run = F.when(x == s["last"], s["run"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(s["most"], run).alias("most"))

    return F.aggregate(lines, start, step)["most"] >= repeats


def strip_marks(c: Column) -> Column:
    """Drop break marks and control characters, close the gaps they leave, keep lines."""
    c = F.regexp_replace(c, r"\[\[BRK\]\]", "")
    c = F.regexp_replace(F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", ""), r"[ \t]{2,}", " ")
    return F.trim(F.regexp_replace(c, r"[ \t]+\n", "\n"))


def strip_nul(c: Column) -> Column:
    """Drop NUL characters, which databases refuse."""
    return F.regexp_replace(c, r"\x00", "")


def snippet(c: Column, n: int = 70) -> Column:
    """The text, cut after ``n`` characters with three dots."""
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def quoted(c: Column, n: int) -> Column:
    """Clean text with single quotes, at most ``n`` characters, for one-line digests."""
    return F.substring(F.translate(clean(c), '"', "'"), 1, n)


# Words that stay upper-case in titles.
ACRONYMS = ["GCC", "SCC", "BOQ", "LOI", "LOA", "NIT", "ITB", "ITT", "EHS", "NSC", "RCC", "PHE", "HVAC", "FF", "CCTV", "PVC", "MEP", "SLA", "VAT", "GST", "TDS", "EPC", "PDF"]


def pretty(c: Column) -> Column:
    """Title case where more than 70 % of the letters are upper-case, acronyms kept."""
    letters = F.length(F.regexp_replace(c, r"[^\p{L}]", ""))
    upper = F.length(F.regexp_replace(c, r"[^\p{Lu}]", ""))
    words = F.transform(F.split(c, " "), lambda w: F.when(F.upper(F.regexp_replace(w, r"[^A-Za-z0-9]", "")).isin(*ACRONYMS), F.upper(w)).otherwise(F.initcap(F.lower(w))))
    return F.when((letters > 0) & (upper > 0.7 * letters), F.array_join(words, " ")).otherwise(c)


def display_number(marker: Column, title: Column, most: int = 160) -> Column:
    """``marker (title)``, or whichever there is; a title that repeats the marker counts for nothing."""
    m, t = clean(marker), F.substring(pretty(clean(title)), 1, most)
    both = (m != "") & (t != "") & (F.lower(m) != F.lower(t))
    return F.when(both, F.concat(m, F.lit(" ("), t, F.lit(")"))).when(m != "", m).when(t != "", t).otherwise("Untitled")


def trim_embedded_section(c: Column, least: int = 10) -> Column:
    """The text before a ``SECTION`` with a digit that stands behind at least ``least`` characters, even without a space before it.

    A title that begins with its own section number keeps it.
    """
    cut = F.regexp_replace(c, r"(?is)(?<=\S)\s*section\s*-?\s*\d.*$", "")
    before = F.trim(cut)
    return F.when((F.length(before) >= least) & (F.length(cut) < F.length(c)), before).otherwise(c)


def heading_title(text: Column, marker: Column | None = None, most: int = 90) -> Column:
    """Display title of a heading block: its first line without its marker, up to the first ``.``, ``:`` or ``;`` before a space, that
    mark included. If that is longer than ``most`` characters the line is cut there. Null for no text."""
    line = clean(F.element_at(F.split(F.trim(F.coalesce(text, F.lit(""))), r"\r\n|[\n\r]"), 1))
    if marker is not None:
        m = clean(marker)
        bare = F.regexp_replace(F.substring(line, F.length(m) + 1, F.length(line)), r"^[ .:)-]+", "")
        line = F.when((m != "") & F.startswith(F.lower(line), F.lower(m)), bare).otherwise(line)
    sentence = F.regexp_extract(line, r"^(.*?[.:;])\s", 1)
    head = F.when(sentence == "", line).otherwise(sentence)
    title = F.trim(F.when(F.length(head) <= most, head).otherwise(F.substring(line, 1, most)))
    return F.when(title != "", title)


def is_heading(text: Column) -> Column:
    """At most 80 characters and 10 words."""
    t = clean(text)
    return (t != "") & (F.length(t) <= 80) & (F.size(F.split(t, " ")) <= 10)
