"""Repair of text from scanned pages.

The first pass counts words, hyphenated words, words formed over line ends and the skeletons of short lines over
all records. From the counts come, by joins of any size, the words that a far more frequent word was misread as,
by confusions of shapes that scanners make, and the hyphenated words that keep their hyphen at a line end. The
second pass labels the lines of each text with a hidden Markov model over layout features (header, body, blank),
drops headers, labels the ends of the lines that stay with a second chain (splits a word, goes on, breaks), joins
them accordingly, and puts misread words right. A text without a finding is returned as it is.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.runtime import materialize

# Shapes that scanners take for one another, as (read, meant).
CONFUSIONS = [
    ("0", "o"), ("1", "l"), ("1", "i"), ("!", "i"), ("!", "l"), ("|", "l"), ("|", "i"), ("5", "s"), ("8", "b"), ("6", "b"), ("9", "g"), ("$", "s"),
    ("c", "e"), ("e", "c"), ("f", "t"), ("t", "f"), ("l", "i"), ("i", "l"), ("b", "h"), ("h", "b"), ("q", "g"), ("g", "q"), ("n", "u"), ("u", "n"),
    ("rn", "m"), ("m", "rn"), ("cl", "d"), ("d", "cl"), ("vv", "w"), ("w", "vv"), ("ii", "u"), ("u", "ii"), ("ri", "n"), ("n", "ri"), ("li", "h"), ("h", "li"), ("nn", "m"), ("iii", "m"), ("tl", "d"), ("ti", "h"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff"), ("ﬃ", "ffi"),
]
#: Ends of a line that break a word.
HYPHENS = "-‐‑\xad¬"
WORD = re.compile(r"[A-Za-zÀ-ɏﬀ-ﬆ0-9!|$]*[A-Za-zÀ-ɏﬀ-ﬆ][A-Za-zÀ-ɏﬀ-ﬆ0-9!|$]*")
_LETTER = "A-Za-zÀ-ɏﬀ-ﬆ"
BROKEN = re.compile(rf"(?:(?<=[{_LETTER}])|(?<=[{_LETTER}][0-9!|$]))[{HYPHENS}] ?$")
#: A line that may begin with the rest of a word, its first character perhaps misread.
REST = re.compile(r"[a-zß-öø-ɏﬀ-ﬆ]|[0-9!|$][a-z]")
REJOIN = re.compile(rf"(?:(?<=[{_LETTER}])|(?<=[{_LETTER}][0-9!|$]))[{HYPHENS}] ?\n\s*(?=[a-zß-öø-ɏﬀ-ﬆ]|[0-9!|$][a-z])")
#: Two words joined by a hyphen within a line; those of longer chains overlap.
COMPOUND = re.compile(r"(?<![a-zß-öø-ɏ])(?=([a-zß-öø-ɏ]+-[a-zß-öø-ɏ]+))")
LAST, FIRST = re.compile(r"[A-Za-zÀ-ɏ]*$"), re.compile(r"[A-Za-zÀ-ɏ]*")
LIST = re.compile(r"\s*(?:[-•*|]|\(?(?:[0-9]{1,3}|[a-z]|[ivx]{1,5})[.)](?:\s|$)|[0-9]+(?:\.[0-9]+)+\.?(?:\s|$))")
#: What stands before the first word of a sentence.
SENTENCE = re.compile(r"(?:\A|[.!?]\s|\n\n)\s*\Z")
_NUMBER = r"(?:page\s*)?\d+(?:\s*(?:of|/)\s*\d+)?"
NUMERIC = re.compile(rf"(?:{_NUMBER}|[-–—]\s*{_NUMBER}\s*[-–—]|\[\s*{_NUMBER}\s*\])\s*$", re.I)
CODE = re.compile(r"\S*[A-Z]\S*[-/]\S*\d+\S*$")
ODD = re.compile(r"\S {2,}\S|\w \| \w")
STATES = ("header", "body", "blank")


@dataclass
class Params:
    ratio: float = 50.0  # how many times more frequent the meant word must be
    least: int = 12  # and how frequent at least; a word seen once needs no more
    sample: int = 20_000  # lines of furniture blocks, and texts of several lines, to fit the chains on
    cells: int = 1 << 18  # counters of line skeletons
    seed: int = 3
    map_entries: int = 500_000  # entries of the lexicon held by each worker; of a larger one each text gets its own by joins, with the same result
    kinds: tuple[str, ...] = field(default=("clause", "paragraph", "recital", "table"))


def broken(line: str) -> bool:
    """The line ends with the mark of a broken word."""
    return any(c in HYPHENS for c in line[-2:]) and BROKEN.search(line) is not None


def terminal(text: str) -> bool:
    """The text ends with a mark that ends a sentence, item or row, closing quotes and brackets aside, or as a list item does."""
    text = text.rstrip()
    return text.rstrip("\"')]")[-1:] in (".", ";", ":", "!", "?", "|") or text.endswith(("; and", "; or"))


def skeleton(line: str) -> str:
    return re.sub(r"\d+", "#", re.sub(r"\s+", " ", line.strip()))


def cell(line: str, cells: int) -> int:
    return crc32(skeleton(line).encode("utf-8", "replace")) % cells


def joined_lines(text: str, formed: Counter) -> str:
    """The text with words rejoined over line ends, to count words by; ``formed`` counts the joints as hyphenated words."""
    parts = REJOIN.split(text)
    for left, right in zip(parts, parts[1:]):
        formed[(LAST.search(left)[0] + "-" + FIRST.match(right)[0]).lower()] += 1
    return "".join(parts)


def _interior(lines: list[str]) -> Iterator[str]:
    for line in lines[1:-1]:
        if line and len(line) <= 80 and not line[0].islower() and not terminal(line) and not LIST.match(line):
            yield line


def census(texts: DataFrame, p: Params) -> tuple[DataFrame, DataFrame, DataFrame, np.ndarray]:
    """Counts over all texts: words ``(word, n)``, hyphenated words within lines and joints over line ends alike, and the
    counters of line skeletons (last: texts of several lines)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, compounds, formed = Counter(), Counter(), Counter()
        lines = np.zeros(p.cells + 1, np.int64)

        def out():
            tagged = [(0, words), (1, compounds), (2, formed)]
            kinds = np.repeat([k for k, _ in tagged], [len(c) for _, c in tagged]).astype(np.int8)
            keys, ns = [w for _, c in tagged for w in c], [n for _, c in tagged for n in c.values()]
            for _, c in tagged:
                c.clear()
            return pa.record_batch([pa.array(kinds), pa.array(keys, pa.string()), pa.array(ns, pa.int64())], names=["kind", "word", "n"])

        for batch in batches:
            for t in batch.column("text").to_pylist():
                if not t:
                    continue
                if "\n" in t:
                    lines[-1] += 1
                    for line in _interior(t.split("\n")):
                        lines[cell(line, p.cells)] += 1
                    t = joined_lines(t, formed)
                t = t.lower()
                words.update(WORD.findall(t))
                if "-" in t:
                    compounds.update(COMPOUND.findall(t))
            if len(words) + len(compounds) + len(formed) > 500_000:
                yield out()
        yield out()
        at = np.flatnonzero(lines)
        yield pa.record_batch([pa.array(np.full(len(at), 3, np.int8)), pa.array([str(i) for i in at], pa.string()), pa.array(lines[at])], names=["kind", "word", "n"])

    rows = materialize(texts.select("text").mapInArrow(count, "kind byte, word string, n long").groupBy("kind", "word").agg(F.sum("n").alias("n")))
    got = rows.where("kind = 3").toArrow()  # at most p.cells + 1 rows
    lines = np.zeros(p.cells + 1, np.int64)
    lines[[int(w) for w in got.column("word").to_pylist()]] = got.column("n").to_pylist()
    words, compounds, formed = (rows.where(f"kind = {k}").select("word", "n") for k in range(3))
    return words, compounds, formed, lines


def kept_hyphens(words: DataFrame, compounds: DataFrame, formed: DataFrame) -> DataFrame:
    """``(wrong, right)`` of the joints over line ends that are hyphenated words: these stand within lines at least as often
    as the word without a hyphen does. ``right`` is the joint itself."""
    glued = lambda c: F.regexp_replace(c, "-", "")
    joints = formed.select(F.col("word").alias("wrong"), glued(F.col("word")).alias("_g"), F.col("n").alias("_formed"))
    # a word formed over line ends is no evidence for itself, whichever joint formed it
    own = joints.groupBy("_g").agg(F.sum("_formed").alias("_formed"))
    whole = own.join(words.select(F.col("word").alias("_g"), F.col("n").alias("_n")), "_g", "left").select("_g", (F.coalesce("_n", F.lit(0)) - F.col("_formed")).alias("_within"))
    found = joints.join(compounds.select(F.col("word").alias("wrong"), F.col("n").alias("_c")), "wrong").join(whole, "_g")
    return found.where("_c >= _within").select("wrong", F.col("wrong").alias("right"))


def _drawn(rows: DataFrame, key: str, total: int, most: int, seed: int) -> DataFrame:
    """About ``most`` of the ``total`` rows, by the hash of their key: a filter, so nothing is sorted or sent to one place."""
    share = min(1.0, most / max(1, total))
    return rows.where(F.xxhash64(key, F.lit(seed)).bitwiseAND(F.lit((1 << 40) - 1)) < int(share * (1 << 40)))


@lru_cache(maxsize=4096)
def _places(n: int, most: int) -> tuple[tuple[int, ...], ...]:
    """Choices of up to ``most`` of ``n`` places, fewer at once in words with many places, and all of them."""
    most = min(most if n <= 12 else 2 if n <= 40 else 1, n)
    return tuple(x for k in range(1, most + 1) for x in combinations(range(n), k)) + ((tuple(range(n)),) if n > most else ())


def _one_kind(word: str, most: int = 3) -> set[str]:
    out = set()
    for read, right in CONFUSIONS:
        i = word.find(read)
        if i < 0:
            continue
        at = []
        while i >= 0:
            at.append(i)
            i = word.find(read, i + 1)
        width = len(read)
        if len(at) == 1:
            out.add(word[: at[0]] + right + word[at[0] + width :])
            continue
        for chosen in _places(len(at), most):
            new, end = "", 0
            for j in chosen:
                if at[j] >= end:
                    new += word[end : at[j]] + right
                    end = at[j] + width
            out.add(new + word[end:])
    return out


def meant(word: str) -> set[str]:
    """Words that may have been read as ``word``: one confusion at up to three places or everywhere, or two confusions, each at
    up to two places or everywhere (in words of 5 to 40 characters). Of words with many places of a confusion, see :func:`_places`."""
    out = _one_kind(word)
    if 5 <= len(word) <= 40:
        out |= {w for x in list(out) for w in _one_kind(x, 2)}
    out.discard(word)
    return out


def corrections(words: DataFrame, p: Params) -> DataFrame:
    """``(wrong, right)``: words that a far more frequent word was misread as; joins on words, so of any size.

    Words of two letters are too often abbreviations: they count only with a digit or sign inside (and see :func:`free`).
    """

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, n, b = [], [], []
            for w, k in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                if len(w) > 2 or len(w) == 2 and not w.isalpha():
                    for c in meant(w):
                        a.append(w), n.append(k), b.append(c)
            yield pa.record_batch([pa.array(a, pa.string()), pa.array(n, pa.int64()), pa.array(b, pa.string())], names=["wrong", "n_wrong", "right"])

    spread = words.repartition(words.sparkSession.sparkContext.defaultParallelism)  # few bytes, much work for each word
    pairs = spread.mapInArrow(candidates, "wrong string, n_wrong long, right string")
    known = words.where(F.col("n") >= p.least).where("word RLIKE '^[a-zà-ɏ]+$'").select(F.col("word").alias("right"), F.col("n").alias("n_right"))
    odd = F.col("wrong").rlike(r"[0-9!|$ﬀ-ﬆ]")
    good = pairs.join(known, "right").where(odd & (F.col("n_right") > F.col("n_wrong")) | (F.col("n_right") >= p.ratio * (F.col("n_wrong") - 1) + p.least))
    return good.groupBy("wrong").agg(F.max_by("right", F.struct("n_right", "right")).alias("right"))


def features(lines: list[str], counters: np.ndarray, cells: int) -> list[tuple]:
    """Layout of each line, as discrete values for the first chain."""
    n, total = len(lines), max(1, int(counters[-1]))
    body = [i for i, x in enumerate(lines) if x.strip()]
    widest = max((len(lines[i]) for i in body), default=1)
    pos = {i: j for j, i in enumerate(body)}
    out = []
    for i in range(n):
        x = lines[i].strip()
        if not x:
            out.append(())
            continue
        j = pos[i]
        before = lines[body[j - 1]].rstrip() if j else None
        after = lines[body[j + 1]].lstrip() if j + 1 < len(body) else None
        cut = before is not None and not terminal(before)
        goes = after is not None and after[:1].islower()
        shape = "number" if NUMERIC.match(x) else "code" if CODE.match(x) else "caps" if x.isupper() else "lower" if x[0].islower() else "digit" if x[-1].isdigit() else "mixed"
        words = len(x.split())
        count = int(counters[cell(x, cells)]) if len(x) <= 80 else 0
        rep = 0 if count < 3 else 1 if count < 3e-4 * total else 2 if count < 3e-3 * total else 3
        out.append((
            shape,
            min(words, 3) if words < 4 else 4 if words < 9 else 5,
            len(x) < 0.6 * widest,
            terminal(x),
            (cut, goes),
            (rep, shape == "lower"),
            bool(LIST.match(x)) and shape != "number",
            x[0] == "[" or "__" in x or ("  " in x or " | " in x) and bool(ODD.search(x)),
            before is None or after is None,
        ))
    return out


class Chain:
    """A hidden Markov model with independent discrete features per state and Laplace smoothing."""

    def __init__(self, states: tuple[str, ...]):
        self.states, self.emit, self.seen = states, [dict() for _ in states], [Counter() for _ in states]
        self.move = np.ones((len(states) + 1, len(states)))

    def fit(self, sequences: list[tuple[list[tuple], list[int]]]) -> Chain:
        counts = [Counter() for _ in self.states]
        totals = np.ones(len(self.states))
        self.move = np.ones((len(self.states) + 1, len(self.states)))
        values: set = set()
        for feats, labels in sequences:
            last = len(self.states)
            for f, s in zip(feats, labels):
                self.move[last, s] += 1
                last = s
                totals[s] += 1
                for k, v in enumerate(f):
                    counts[s][k, v] += 1
                    values.add((k, v))
        self.emit = [{kv: math.log((counts[s][kv] + 0.5) / (totals[s] + 2)) for kv in values} for s in range(len(self.states))]
        self.none = [math.log(0.5 / (t + 2)) for t in totals]
        self.logmove = np.log(self.move / self.move.sum(1, keepdims=True)).tolist()
        return self

    def score(self, f: tuple, s: int) -> float:
        e, none = self.emit[s], self.none[s]
        return sum(e.get((k, v), none) for k, v in enumerate(f))

    def viterbi(self, feats: list[tuple], allowed: list[tuple[int, ...]]) -> list[int]:
        best, back = {}, []
        start = self.logmove[len(self.states)]
        for s in allowed[0]:
            best[s] = start[s] + self.score(feats[0], s)
        for f, can in zip(feats[1:], allowed[1:]):
            now, ptr = {}, {}
            for s in can:
                r = max(best, key=lambda q: best[q] + self.logmove[q][s])
                now[s], ptr[s] = best[r] + self.logmove[r][s] + (self.score(f, s) if len(can) > 1 else 0.0), r
            back.append(ptr)
            best = now
        s = max(best, key=best.get)
        path = [s]
        for ptr in reversed(back):
            s = ptr[s]
            path.append(s)
        return path[::-1]


def _seed_header(f: tuple) -> bool:
    shape, _, short, terminal, (cut, goes), (rep, lower), listed, odd, edge = f
    if terminal or listed or lower or edge:
        return False
    return cut and (goes or shape in ("number", "code")) and (rep >= 2 or shape in ("number", "code") or odd) and (short or shape in ("number", "code"))


def possible(f: tuple) -> tuple[int, ...]:
    """States of a line. One that starts a sentence, by going on in the next line or by its look, is no header."""
    if not f:
        return (2,)
    cut, goes = f[4]
    starts = not cut and f[0] not in ("number", "code") and (goes or (f[0] == "mixed" and not f[7]))
    return (1,) if starts else (0, 1)


def label_lines(lines: list[str], chain: Chain, counters: np.ndarray, cells: int) -> list[int]:
    feats = features(lines, counters, cells)
    return chain.viterbi(feats, [possible(f) for f in feats])


def fit_lines(texts: list[str], furniture: list[str], counters: np.ndarray, p: Params) -> Chain:
    """The chain of line labels: seeded from layout and furniture blocks, then three rounds of Viterbi training."""
    seqs = [t.split("\n") for t in texts]
    feats = [features(x, counters, p.cells) for x in seqs]
    known = {skeleton(x) for x in furniture}
    labels = [[2 if not f else 0 if _seed_header(f) or (f[4][0] and not f[8] and skeleton(x) in known) else 1 for x, f in zip(s, fs)] for s, fs in zip(seqs, feats)]
    chain = Chain(STATES).fit(list(zip(feats, labels)))
    for _ in range(3):
        labels = [chain.viterbi(fs, [possible(f) for f in fs]) if len(fs) > 1 else [1 if f else 2 for f in fs] for fs in feats]
        labels = [[1 if s == 0 and f and f[8] and f[0] not in ("number",) else s for s, f in zip(ls, fs)] for ls, fs in zip(labels, feats)]
        chain.fit(list(zip(feats, labels)))
    return chain


def join_features(lines: list[str], gap: list[bool], dropped: list[bool]) -> list[tuple]:
    """Layout of each kept line for the second chain; gap: a blank follows, dropped: a header was taken out after it."""
    widest = max((len(x) for x in lines), default=1)
    out = []
    for i, x in enumerate(lines):
        after = lines[i + 1].lstrip() if i + 1 < len(lines) else ""
        out.append((terminal(x), bool(REST.match(after)), bool(LIST.match(after)), (gap[i], dropped[i]), len(x) >= 0.7 * widest, x.lstrip().startswith("|"), not after, broken(x)))
    return out


ENDS = ("splits", "goes", "breaks")


def _seed_end(f: tuple) -> int:
    """State of a line's end before any training: 0 splits a word, 1 goes on, 2 breaks."""
    terminal, lower, listed, (gap, dropped), long, table, last, broken = f
    if last or table:
        return 2
    if broken and lower:
        return 0
    if gap and not dropped or listed:
        return 2
    return 1 if (not terminal) and (lower or dropped or long) else 2


def possible_ends(f: tuple) -> tuple[int, ...]:
    """Where a hyphen ends the line and the next may begin with the rest of a word, a line that goes on splits a word; no other does."""
    return (0, 2) if f[7] and f[1] else (1, 2)


def keep(lines: list[str], labels: list[int]) -> tuple[list[str], list[bool], list[bool]]:
    kept, gap, dropped = [], [], []
    for x, s in zip(lines, labels):
        if s == 1:
            kept.append(x), gap.append(False), dropped.append(False)
        elif kept:
            if s == 0:
                dropped[-1] = True
            else:
                gap[-1] = True
    return kept, gap, dropped


def fit_joins(texts: list[str], lines: Chain, counters: np.ndarray, p: Params) -> Chain:
    data = []
    for t in texts:
        x = t.split("\n")
        kept = keep(x, label_lines(x, lines, counters, p.cells))
        if kept[0]:
            data.append(join_features(*kept))
    chain = Chain(ENDS).fit([(fs, [_seed_end(f) for f in fs]) for fs in data])
    for _ in range(2):
        chain.fit([(fs, chain.viterbi(fs, [possible_ends(f) for f in fs])) for fs in data])
    return chain


@dataclass
class Model:
    lines: Chain
    joins: Chain
    counters: np.ndarray
    cells: int


class Relined(NamedTuple):
    """A text after its lines were joined: ``pieces`` between the joints of split words, each joint's hyphenated word (empty where
    the mark is no hyphen), whether furniture was dropped, and whether any line was joined."""

    pieces: list[str]
    joints: list[str]
    furniture: bool
    wrapped: bool

    def text(self, lexicon: dict[str, str]) -> tuple[str, bool]:
        """The text, with hyphens kept where the lexicon has the joint, and whether a word was broken."""
        out, broken = [], False
        for piece, joint in zip(self.pieces, [*self.joints, None]):
            if joint is not None and joint not in lexicon:
                piece, broken = BROKEN.sub("", piece), True
            out.append(piece)
        return "".join(out), broken


def relined(text: str, model: Model) -> Relined:
    if "\n" not in text:
        return Relined([text], [], False, False)
    lines = text.split("\n")
    labels = label_lines(lines, model.lines, model.counters, model.cells)
    kept, gap, dropped = keep(lines, labels)
    furniture = 0 in labels
    hyphen = any(broken(x) for x in kept[:-1])
    wrapped = any(not terminal(x) and not x.isupper() and y[:1].islower() for x, y in zip(kept, kept[1:]))
    if not (furniture or hyphen or wrapped):
        return Relined([text], [], False, False)
    feats = join_features(kept, gap, dropped)
    ways = model.joins.viterbi(feats, [possible_ends(f) for f in feats]) if feats else []
    pieces, joints, held, open_ = [], [], "", True
    for i, (x, w, f) in enumerate(zip(kept, ways, feats)):
        x = x.lstrip() if i and open_ else x  # what goes on begins without an indent
        if i + 1 == len(kept):
            held += x
        elif w == 0:
            hyphened = x.rstrip()[-1] in "-‐‑"
            x = x.rstrip() if hyphened else x
            joints.append((LAST.search(BROKEN.sub("", x))[0] + "-" + FIRST.match(kept[i + 1].lstrip())[0]).lower() if hyphened else "")
            pieces.append(held + x)
            held, open_ = "", True
        elif (w == 1 and not x.isupper()) or (dropped[i] and not f[0]):
            held, open_ = held + x.rstrip() + " ", True
        else:
            held, open_ = held + x + ("\n\n" if gap[i] and not (dropped[i] and not f[0]) else "\n"), False
    return Relined([*pieces, held], joints, furniture, wrapped)


def free(m: re.Match) -> bool:
    """A word of two letters in small letters that stands between blanks, not in a code."""
    before, after = m.string[max(0, m.start() - 1) : m.start()], m.string[m.end() : m.end() + 1]
    return m[0].islower() and (not before or before.isspace()) and (not after or after.isspace() or after in ".,;:)")


def repair(text: str, model: Model, lexicon: dict[str, str]) -> tuple[str, bool, bool, bool]:
    """``(text, broken word, misread word, furniture inside)``; the text itself if nothing was found."""
    lined = relined(text, model)
    new, hyphen = lined.text(lexicon)
    misread = False
    if not lexicon.keys().isdisjoint(WORD.findall(new.lower())):
        last = None if terminal(new) else next(iter(WORD.findall(new)[-1:]), None)
        # the last word of a text that stops short may be a part of a word
        cut = new.rfind(last) if last and last.isalpha() and new.rstrip(" .\u2026\ufffd[]").endswith(last) else None

        def right(m: re.Match) -> str:
            nonlocal misread
            w = m[0]
            r = lexicon.get(w.lower())
            if r is None or m.start() == cut or len(w) == 2 and not free(m):
                return w
            misread = True
            capital = w[0].isupper() or not w[0].isalpha() and SENTENCE.search(m.string, max(0, m.start() - 9), m.start()) is not None
            return r.upper() if w.isupper() and len(w) > 1 and not re.search(r"\d", w) else r[0].upper() + r[1:] if capital else r

        new = WORD.sub(right, new)
    if not (hyphen or misread or lined.furniture or lined.wrapped):
        new = text
    return new, hyphen, misread, lined.furniture


OUT = "table_name string, row_id long, text string, broken_word boolean, misread_word boolean, furniture boolean"


def prepare(texts: DataFrame, furniture: DataFrame, p: Params = Params()) -> tuple[Model, DataFrame]:
    """The fitted model and the lexicon ``(wrong, right)`` of a corpus: misread words, and joints that keep their hyphen."""
    words, compounds, formed, counters = census(texts, p)
    lexicon = materialize(corrections(words, p).union(kept_hyphens(words, compounds, formed)))
    # bounded samples to fit the chains on: about p.sample / 4 texts and p.sample lines
    drawn = _drawn(texts.where("text LIKE '%\n%'").where("length(text) < 20000"), "row_id", int(counters[-1]), p.sample // 4, p.seed)
    several = [r[0] for r in drawn.select("text").collect()]
    known = materialize(furniture.where("text IS NOT NULL").select("text").distinct())
    lines = [r[0] for r in _drawn(known, "text", known.count(), p.sample, p.seed).collect()]
    chain = fit_lines(several, lines, counters, p)
    return Model(chain, fit_joins(several, chain, counters, p), counters, p.cells), lexicon


def _own(texts: DataFrame, lexicon: DataFrame, keys, name: str) -> DataFrame:
    """``(_h, <name>)``: the entries of the lexicon, as an array of pairs, that each text can need; ``keys`` names them from
    the text and what is known of it (``_joints``). Texts are named by their hash; texts that need none have no row."""
    cols = ["_h", "text", *(c for c in texts.columns if c == "_joints")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(h, k) for h, *given in zip(*(batch.column(c).to_pylist() for c in cols)) for k in keys(*given)]
            h, k = zip(*rows) if rows else ((), ())
            yield pa.record_batch([pa.array(h, pa.int64()), pa.array(k, pa.string())], names=["_h", "wrong"])

    needed = texts.select(*cols).dropDuplicates(["_h"]).mapInArrow(run, "_h long, wrong string")
    return materialize(needed.join(lexicon, "wrong").groupBy("_h").agg(F.collect_set(F.struct("wrong", "right")).alias(name)))


def _pairs(entries: list | None) -> dict[str, str]:
    return {e["wrong"]: e["right"] for e in entries or ()}


def repaired(texts: DataFrame, furniture: DataFrame, p: Params = Params()) -> DataFrame:
    """Every record with its repaired text and what was found.

    ``texts``: ``(table_name string, row_id long, text string)``. ``furniture``: a column ``text`` with known
    headers, footers and page numbers, may be empty. Null and empty texts come out as they are, without a
    finding. Repeated rows come out repeated. The lexicon is held by each worker if it has at most
    ``p.map_entries`` entries; else each text gets the entries that it can need by two joins, first those of its
    joints, then those of the words that its lines then make.
    """
    spark = texts.sparkSession
    texts = texts.select("table_name", F.col("row_id").cast("long").alias("row_id"), "text")
    model, lexicon = prepare(texts, furniture, p)
    held = spark.sparkContext.broadcast(model)
    if lexicon.count() <= p.map_entries:
        all_b = spark.sparkContext.broadcast({r[0]: r[1] for r in lexicon.collect()})  # p.map_entries at most
        rows = texts
    else:
        all_b = None
        rows = texts.withColumn("_h", F.xxhash64("text"))
        filled = rows.where("text <> ''")
        joints = _own(filled.where("text LIKE '%\n%'"), lexicon, lambda t: {j for j in relined(t, held.value).joints if j}, "_joints")
        words = _own(filled.join(joints, "_h", "left"), lexicon, lambda t, j: {w.lower() for w in WORD.findall(relined(t, held.value).text(_pairs(j))[0])}, "_words")
        rows = rows.join(joints, "_h", "left").join(words, "_h", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            own = [all_b.value] * len(texts) if all_b is not None else [_pairs(j) | _pairs(w) for j, w in zip(batch.column("_joints").to_pylist(), batch.column("_words").to_pylist())]
            done = [repair(t, model, lexicon) if t else (t, False, False, False) for t, lexicon in zip(texts, own)]
            cols = list(zip(*done)) if done else [(), (), (), ()]
            yield pa.record_batch([batch.column("table_name"), batch.column("row_id"), pa.array(cols[0], pa.string()), *(pa.array(c, pa.bool_()) for c in cols[1:])], names=["table_name", "row_id", "text", "broken_word", "misread_word", "furniture"])

    return rows.mapInArrow(run, OUT)
