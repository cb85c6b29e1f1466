"""Test passages in training documents, found with an FM-index of each shard.

The documents of a shard become one sequence of word numbers. Words that no test phrase contains are breaks,
and stretches too short to hold a phrase are left out, so the index covers exactly what can match. Phrases
are searched backwards through rank queries on a wavelet matrix of the Burrows-Wheeler transform; their
occurrences are located by walking to sampled suffix positions, and merged into spans of the document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.runtime import materialize

WORD = re.compile(r"[^\W_]+")
#: A word broken over a line end, by the marks that break words.
BROKEN = re.compile(r"(?<=\w)[-‐‑\xad¬][ \t]*\r?\n\s*(?=\w)|\xad")


@dataclass(frozen=True)
class Params:
    n: int = 5  # words of a phrase
    share: float = 1 / 3  # of a passage's phrases that make it leaked
    shard_words: int = 1_000_000  # indexed words of a shard
    sample: int = 16  # every so many positions of the text are kept in the suffix array
    block_phrases: int = 200_000  # phrases searched at once; more test items are taken in further passes


def words(text: str) -> list[str]:
    return WORD.findall(BROKEN.sub("", text).lower() if "\n" in text or "\xad" in text else text.lower())


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array of a sequence of small numbers whose last one is its least and unique (prefix doubling)."""
    n = len(s)
    rank = np.unique(s, return_inverse=True)[1].astype(np.int64)
    k = 1
    while True:
        second = np.zeros(n, np.int64)
        second[: n - k] = rank[k:] + 1
        key = rank * (n + 1) + second
        sa = np.argsort(key, kind="stable")
        ordered = key[sa]
        rank = np.empty(n, np.int64)
        rank[sa] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1])))
        if rank[sa[-1]] == n - 1 or k >= n:
            return sa
        k *= 2


class WaveletMatrix:
    """Rank of any symbol before any position: one bit vector with running counts per bit of the symbols."""

    def __init__(self, s: np.ndarray, symbols: int):
        self.bits = max(1, int(symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        for b in reversed(range(self.bits)):
            bit = (s >> b) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit))).astype(np.int64))
            self.zeros.append(int(len(s) - bit.sum()))
            s = np.concatenate((s[bit == 0], s[bit == 1]))

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``c`` occurs before ``i``, for arrays of both."""
        lo = np.zeros_like(i)
        for level, b in enumerate(reversed(range(self.bits))):
            ones, zeros = self.ones[level], self.zeros[level]
            up = ((c >> b) & 1).astype(bool)
            a, z = ones[lo], ones[i]
            lo, i = np.where(up, zeros + a, lo - a), np.where(up, zeros + z, i - z)
        return i - lo

    def symbol(self, i: np.ndarray) -> np.ndarray:
        c = np.zeros_like(i)
        for level in range(self.bits):
            ones, zeros = self.ones[level], self.zeros[level]
            bit = ones[i + 1] - ones[i]
            c = c * 2 + bit
            i = np.where(bit == 1, zeros + ones[i], i - ones[i])
        return c


class FMIndex:
    def __init__(self, s: np.ndarray, symbols: int, sample: int):
        """``s``: symbols from 1, 1 being a break; a 0 is put at the end."""
        s = np.append(s, 0)
        sa = suffix_array(s)
        self.n = len(s)
        bwt = s[sa - 1]
        self.tree = WaveletMatrix(bwt, symbols)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(s, minlength=symbols))))
        self.sampled = sa % sample == 0
        self.rank_sampled = np.concatenate(([0], np.cumsum(self.sampled)))
        self.positions = sa[self.sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the suffix array ``[lo, hi)`` of each phrase (rows of an array of symbols)."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for j in reversed(range(phrases.shape[1])):
            c = phrases[:, j]
            lo, hi = self.before[c] + self.tree.rank(c, lo), self.before[c] + self.tree.rank(c, hi)
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: steps back to a sampled position."""
        at, steps = rows.copy(), np.zeros_like(rows)
        while True:
            open_ = ~self.sampled[at]
            if not open_.any():
                break
            i = at[open_]
            c = self.tree.symbol(i)
            at[open_] = self.before[c] + self.tree.rank(c, i)
            steps[open_] += 1
        return self.positions[self.rank_sampled[at]] + steps


@dataclass
class Phrases:
    """Test phrases as rows of word numbers (from 2; 1 is a break), and which items have each."""

    numbers: dict[str, int]
    rows: np.ndarray
    items: list[list[int]]  # item positions of each phrase
    ids: list[int]
    size: list[int]  # distinct phrases of each item


def phrases(items: list[tuple[int, str]], n: int) -> Phrases:
    numbers: dict[str, int] = {}
    at: dict[tuple, int] = {}
    owners: list[list[int]] = []
    ids, size = [], []
    for item, passage in items:
        w = [numbers.setdefault(x, len(numbers) + 2) for x in words(passage or "")]
        own = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
        for g in own:
            k = at.setdefault(g, len(at))
            if k == len(owners):
                owners.append([])
            owners[k].append(len(ids))
        ids.append(item), size.append(len(own))
    return Phrases(numbers, np.array(list(at), np.int64).reshape(-1, n), owners, ids, size)


def _spans(text: str, starts: list[int], n: int) -> list[dict]:
    """Character spans of the phrases that begin at the given words of the text, merged."""
    hidden = list(BROKEN.finditer(text)) if "\n" in text or "\xad" in text else []
    clean = BROKEN.sub("", text) if hidden else text
    at = [(m.start(), m.end()) for m in WORD.finditer(clean.lower())]
    cuts, shift = [], 0
    for m in hidden:
        cuts.append((m.start() - shift, m.end() - m.start()))
        shift += m.end() - m.start()

    def back(pos: int) -> int:
        return pos + sum(size for where, size in cuts if where < pos)

    out: list[list[int]] = []
    for i in sorted(starts):
        a, b = back(at[i][0]), back(at[i + n - 1][1])
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [{"begin": a + 1, "end": b} for a, b in out]


def search_shard(docs: list[tuple], seqs: list[list[tuple[int, list[int]]]], ph: Phrases, p: Params) -> Iterator[tuple]:
    """``(doc id, item id, phrases found, phrases of the item, spans)`` for one shard."""
    stretches = [(d, start, w) for d, runs in enumerate(seqs) for start, w in runs]
    if not stretches:
        return
    parts, where = [], []
    at = 0
    for d, start, w in stretches:
        parts += [w, [1]]
        where.append((at, d, start))
        at += len(w) + 1
    s = np.concatenate([np.asarray(x, np.int64) for x in parts])
    index = FMIndex(s, len(ph.numbers) + 2, p.sample)
    lo, hi = index.search(ph.rows)
    hit = np.flatnonzero(hi > lo)
    counts = (hi - lo)[hit]
    rows = np.repeat(lo[hit] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
    position = index.locate(rows)
    phrase = np.repeat(hit, counts)
    begin = np.array([x[0] for x in where])
    k = np.searchsorted(begin, position, side="right") - 1
    found: dict[tuple[int, int], dict[int, list[int]]] = {}
    for q, pos, st in zip(phrase.tolist(), position.tolist(), k.tolist()):
        b, d, start = where[st]
        for item in ph.items[q]:
            found.setdefault((d, item), {}).setdefault(q, []).append(start + pos - b)
    for (d, item), by in found.items():
        if len(by) >= p.share * ph.size[item] - 1e-9:
            yield docs[d][0], ph.ids[item], len(by), ph.size[item], _spans(docs[d][1], sorted({i for x in by.values() for i in x}), p.n)


def _runs(w: list[int], n: int) -> list[tuple[int, list[int]]]:
    """Stretches of at least n words that phrases have, with the number of their first word."""
    a = np.asarray(w, np.int64)
    edge = np.diff(np.concatenate(([0], (a > 0).view(np.int8), [0])))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return [(int(i), w[i:j]) for i, j in zip(start, end) if j - i >= n]


OUT = "doc_id long, item_id long, n_found int, n_phrases int, spans array<struct<begin:int,end:int>>"


def leaks(documents: DataFrame, items: DataFrame, p: Params = Params()) -> DataFrame:
    """``(doc_id, item_id, n_found, n_phrases, spans)``: documents that hold at least ``p.share`` of a passage's phrases.

    ``documents``: ``(doc_id, text)``, ``items``: ``(item_id, passage)``. spans are character ranges of the text,
    from 1 and inclusive, to be removed. Passages of fewer than ``p.n`` words have no phrases and are never
    found; null texts and passages are empty. The items are read in blocks of bounded size, each searched
    against all documents; every document is indexed whole within one shard, so nothing is shuffled.
    """
    spark = documents.sparkSession
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("passage").cast("string").alias("passage")).where("item_id IS NOT NULL AND passage IS NOT NULL").distinct()
    out = spark.createDataFrame([], OUT)
    for block in _blocks(items, p):
        held = spark.sparkContext.broadcast(phrases(block, p.n))
        out = out.union(documents.mapInArrow(_searcher(held, p), OUT))
    return out


def _blocks(items: DataFrame, p: Params) -> Iterator[list[tuple[int, str]]]:
    block, size = [], 0
    for r in items.orderBy("item_id").toLocalIterator():
        n = len(words(r.passage))
        if block and size + n > p.block_phrases:
            yield block
            block, size = [], 0
        block.append((r.item_id, r.passage))
        size += n
    if block:
        yield block


def _searcher(held, p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ph = held.value
        get = ph.numbers.get
        docs: list[tuple] = []
        seqs: list = []
        size = 0

        def out() -> pa.RecordBatch:
            rows = list(search_shard(docs, seqs, ph, p))
            cols = list(zip(*rows)) if rows else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))]
            return pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "item_id", "n_found", "n_phrases", "spans"])

        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                runs = _runs([get(w, 0) for w in words(text)], p.n)
                if runs:
                    docs.append((i, text)), seqs.append(runs)
                    size += sum(len(w) + 1 for _, w in runs)
                    if size >= p.shard_words:
                        yield out()
                        docs.clear(), seqs.clear()
                        size = 0
        if docs:
            yield out()

    return run


def leaked_items(found: DataFrame) -> DataFrame:
    """Per item: documents that leak it and the largest share of its phrases in one of them."""
    found = materialize(found)
    return found.groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_documents"), F.max(F.col("n_found") / F.col("n_phrases")).alias("largest_share"))
