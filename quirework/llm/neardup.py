"""Edited copies: a chosen-path similarity join over word shingles.

Every record becomes the set of its ``k``-word shingles. In each of ``runs`` independent runs a set starts a
path with ``branch`` of its shingles, chosen by a hash that all sets share, so that two sets with common
shingles choose common ones. A path ends once a bucket of it is expected to be small; else it goes on with
further shingles of the same set. All shingles that can be shared are equally likely to be chosen, so that the
chance of two sets to meet depends on their similarity alone, not on how many more sets hold what they share.
Frequencies come from a count sketch of fixed size over all records. Records that end in the same bucket are
compared within the bucket by a bit sketch, then once by a wider one, and what is left is checked exactly from
the texts. Buckets that turn out larger than ``bucket`` are compared block by block: no pair that met in a
bucket is parted again. The links that the even and the odd runs find show the recall (capture and recapture,
by bands of similarity); runs are repeated until it reaches the target.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.operators.components import components
from quirework.runtime import broadcast_if_small, materialize

M1, M2, M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
STEP = 0x100000001B3
STEP_INV = pow(STEP, -1, 1 << 64)


@dataclass(frozen=True)
class Params:
    k: int = 3
    similarity: float = 0.5
    min_words: int = 25
    runs: int = 6  # of a round
    recall: float = 0.99  # further rounds follow until this share of the links is found, as the runs estimate it
    rounds: int = 8  # at most
    branch: int = 2
    depth: int = 4
    bucket: int = 512
    sketch_bits: int = 128
    deviations: float = 3.0  # of a sketch below what the similarity lets expect, which still pass
    counters: int = 1 << 19
    seed: int = 20


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = x + M3
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of a-z and 0-9 of the lower-cased texts, and the number of each word's text.

    All texts are hashed at once: a prefix polynomial modulo 2**64 gives each word's hash as a difference.
    """
    raw = [t.lower().encode("utf-8", "replace") for t in texts]
    sizes = np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw))
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    inside = ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57))
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    power, inverse = _powers(len(data))
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data * inverse, out=prefix[1:])
    out = (prefix[end] - prefix[start]) * power[end - 1]
    return mix(out + (end - start).astype(np.uint64)), np.searchsorted(np.cumsum(sizes), start, side="right")


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse modulo 2**64, kept by each worker."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(20, (n - 1).bit_length())
        _POWERS[:] = [np.cumprod(np.full(size, STEP, np.uint64)), np.cumprod(np.full(size, STEP_INV, np.uint64))]
    return _POWERS[0][:n], _POWERS[1][:n]


GRAM = np.uint64((1 << 52) - 1)  # shingles are named by 52 bits, so that a slice is sorted by text and shingle as one number


def _grams(words: np.ndarray, of: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of fewer than 4,096 texts, by text."""
    if len(words) < k:
        return np.empty(0, np.uint64), np.zeros(n + 1, np.int64)
    grams = words[: len(words) - k + 1].copy()
    for j in range(1, k):
        grams = mix(grams * np.uint64(STEP) + words[j : len(words) - k + 1 + j])
    whole = of[: len(of) - k + 1] == of[k - 1 :]
    both = (of[: len(of) - k + 1][whole].astype(np.uint64) << np.uint64(52)) | (grams[whole] & GRAM)
    both.sort()
    fresh = np.ones(len(both), bool)
    fresh[1:] = both[1:] != both[:-1]
    both = both[fresh]
    return both & GRAM, np.searchsorted(both >> np.uint64(52), np.arange(n + 1, dtype=np.uint64))


def shingle_sets(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``k``-word shingles of each text as sorted hashes, and where each text's begin (len + 1)."""
    return _grams(*word_hashes(texts), len(texts), k)


def _texts(titles: list, texts: list) -> list[str]:
    return [f"{a or ''} {b or ''}" for a, b in zip(titles, texts)]


ROWS = 4000  # rows handled at once: what a worker holds doesn't grow with the Arrow batch


def _prepared(batches: Iterator[pa.RecordBatch], p: Params) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of the batches with the numbers of the rows that count and their shingles."""
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            title, text = batch.column("title").to_pylist(), batch.column("text").to_pylist()
            words, of = word_hashes(_texts(title, text))
            n = batch.num_rows
            # a blank stands between, so the words of both are those of the title and those of the text
            own = np.bincount(of, minlength=n) - np.bincount(word_hashes([t or "" for t in title])[1], minlength=n)
            enough = own >= p.min_words
            kept = enough[of]
            rows = np.flatnonzero(enough)
            grams, begin = _grams(words[kept], (np.cumsum(enough) - 1)[of[kept]], len(rows), p.k)
            yield batch, rows, grams, begin


def gram_counters(records: DataFrame, p: Params) -> np.ndarray:
    """Counters of shingles over all records: ``p.counters`` cells, whatever the size of the input."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, n = np.zeros(p.counters, np.int64), 0
        for _, rows, grams, _ in _prepared(batches, p):
            cells += np.bincount((grams % np.uint64(p.counters)).astype(np.int64), minlength=p.counters)
            n += len(rows)
        at = np.flatnonzero(cells)
        yield pa.record_batch([np.append(at, -1), np.append(cells[at], n)], names=["cell", "n"])

    rows = records.select("title", "text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    got = rows.toArrow()  # at most p.counters + 1 rows
    cells = np.zeros(p.counters + 1, np.int64)
    cells[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    return cells  # the last one holds the number of records


HELD = 1 << 17  # shingles handled at once
NONE = np.uint32(0xFFFFFFFF)


def _tiles(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, int, int]]:
    """Sets of about the same size, with the least and the greatest size: few cells of a tile are padding."""
    order = np.argsort(sizes, kind="stable")
    order = order[sizes[order] > 0]
    ordered, at = sizes[order], 0
    while at < len(order):
        least = int(ordered[at])
        end = int(np.searchsorted(ordered, least + least // 8 + 4, side="right"))
        end = min(end, at + max(1, HELD // int(ordered[end - 1])))
        yield order[at:end], least, int(ordered[end - 1])
        at = end


def _tile(values: np.ndarray, begin: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and values of the sets that begin at ``begin`` as a matrix; a short set repeats its last one."""
    at = begin[:, None] + np.minimum(np.arange(width), sizes[:, None] - 1)
    return at, values[at]


def _short(grams: np.ndarray) -> np.ndarray:
    return (grams ^ (grams >> np.uint64(32))).astype(np.uint32)


def sketch(grams: np.ndarray, begin: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Of ``bits`` minwise minima per set one bit each, packed into 64-bit words (words x sets), and four bits each, as bytes (sets x bits / 2)."""
    low, sizes = _short(grams), np.diff(begin)
    rng = np.random.default_rng(7)
    factors = rng.integers(1, 2**32, (bits, 2)).astype(np.uint32)
    minima = np.zeros((bits, len(sizes)), np.uint32)
    for rows, _, width in _tiles(sizes):
        _, m = _tile(low, begin[rows], sizes[rows], width)
        h, least = np.empty_like(m), np.empty(len(rows), np.uint32)
        for j, (a, b) in enumerate(factors):
            np.multiply(m, a | np.uint32(1), out=h)
            np.bitwise_xor(h, b, out=h)
            minima[j, rows] = h.min(1, out=least)
    minima ^= minima >> np.uint32(16)
    minima *= np.uint32(0x85EBCA6B)
    minima ^= minima >> np.uint32(13)
    out = np.zeros((bits // 64, len(sizes)), np.uint64)
    for j in range(bits):
        out[j // 64] |= (minima[j] & np.uint32(1)).astype(np.uint64) << np.uint64(j % 64)
    four = ((minima >> np.uint32(8)) & np.uint32(15)).astype(np.uint8)
    return out, np.ascontiguousarray((four[0::2] | (four[1::2] << 4)).T)


def path_ends(grams: np.ndarray, begin: np.ndarray, cells: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """The ends of the paths of each set: bucket keys, odd in every other run, and the number of each key's set."""
    n = max(2, int(cells[-1]))
    df = np.minimum(cells[(grams % np.uint64(p.counters)).astype(np.int64)], n)
    # all that other sets can hold, whatever the frequency: to prefer rare shingles loses pairs whose common ones are frequent
    shared = df > 1
    begin = np.concatenate(([0], np.cumsum(shared)))[begin]
    grams, df = grams[shared], df[shared]
    low, sizes = _short(grams), np.diff(begin)
    keys, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for rows, least, width in _tiles(sizes):
        at, m = _tile(low, begin[rows], sizes[rows], width)
        pad = np.where(np.arange(least, width) >= sizes[rows][:, None], NONE, np.uint32(0))
        step = max(1, HELD // width)
        for run in range(p.runs):
            # one entry per path; left: records still expected in its bucket
            path = np.full(len(rows), mix(np.array([p.seed * 1000 + run], np.uint64))[0])
            own, left = np.arange(len(rows)), np.full(len(rows), float(n))
            for depth in range(p.depth):
                on = []
                for i in range(0, len(own), step):
                    x, o, expected = path[i : i + step], own[i : i + step], left[i : i + step]
                    h = m[o]
                    h ^= (x >> np.uint64(32)).astype(np.uint32)[:, None]
                    h *= np.uint32(0x9E3779B1)
                    h ^= h >> np.uint32(15)
                    h *= np.uint32(0x85EBCA6B)
                    h[:, least:] |= pad[o]
                    line = np.arange(len(o))
                    for _ in range(p.branch):
                        best = h.argmin(1)
                        there = h[line, best] != NONE
                        h[line, best] = NONE
                        hit = at[o, best]
                        child, rest = mix(x * np.uint64(STEP) + grams[hit]), expected * df[hit] / n
                        ends = there & ((rest <= p.bucket / 4) | (depth + 1 >= p.depth))
                        keys.append((child[ends] & ~np.uint64(1)) | np.uint64(run & 1))
                        owners.append(rows[o[ends]])
                        goes = there & ~ends
                        on.append((child[goes], o[goes], rest[goes]))
                path, own, left = (np.concatenate(c) for c in zip(*on))
                if not len(own):
                    break
    return np.concatenate(keys), np.concatenate(owners)


def _set_hash(grams: np.ndarray, begin: np.ndarray) -> np.ndarray:
    return mix(np.add.reduceat(mix(grams), begin[:-1]) ^ np.diff(begin).astype(np.uint64))


SIGNED = "id long, h long, n int, s1 long, s2 long, more binary, keys array<long>"


def signatures(records: DataFrame, cells_b, p: Params) -> DataFrame:
    """``(id, h, n, s1, s2, more, keys)``: hash of the set, its size, its sketches and its bucket keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = cells_b.value
        for batch, rows, grams, begin in _prepared(batches, p):
            full = np.flatnonzero(np.diff(begin) > 0)
            if not len(full):
                continue
            rows, begin = rows[full], np.append(begin[full], begin[-1])
            bits, more = sketch(grams, begin, p.sketch_bits)
            keys, owner = path_ends(grams, begin, cells, p)
            order = np.lexsort((keys, owner))
            keys, owner = keys[order], owner[order]
            fresh = np.ones(len(keys), bool)
            fresh[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
            keys, owner = keys[fresh], owner[fresh]
            lists = pa.ListArray.from_arrays(np.searchsorted(owner, np.arange(len(rows) + 1)).astype(np.int32), keys.view(np.int64))
            ids = batch.column("id").take(pa.array(rows))
            wide = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer((np.arange(len(rows) + 1) * more.shape[1]).astype(np.int32)), pa.py_buffer(more)])
            b1, b2 = bits.view(np.int64)
            yield pa.record_batch([ids, _set_hash(grams, begin).view(np.int64), np.diff(begin).astype(np.int32), b1, b2, wide, lists], names=["id", "h", "n", "s1", "s2", "more", "keys"])

    return records.mapInArrow(run, SIGNED)


def _least(p: Params, values: int) -> float:
    """Minima, of which each keeps one of ``values`` values, that sets of the least similarity agree in, less the deviations allowed."""
    share = p.similarity + (1 - p.similarity) / values
    return p.sketch_bits * share - p.deviations * math.sqrt(p.sketch_bits * share * (1 - share))


def _split(keyed: DataFrame, p: Params) -> DataFrame:
    """Pairs of similar sketches within each bucket, and the rows of buckets that are too large.

    ``keyed`` ``(key, h, n, s1, s2)`` is partitioned and sorted by key; a bucket passes through as consecutive
    rows, of which at most ``p.bucket`` are held, so a bucket of any size needs bounded memory. Output
    ``(key, a, b)``: b is null for the rows of large buckets.
    """
    least, share = _least(p, 2), p.similarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "h", "n", "s1", "s2"]
        held = [np.empty(0, np.int64) for _ in names]
        large = None  # key of a large bucket whose first rows are out already

        def work(c: list[np.ndarray], final: bool):
            nonlocal large, held
            key = c[0]
            if not len(key):
                return
            begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            size = np.diff(np.append(begin, len(key)))
            big = size > p.bucket
            if large is not None and key[0] == large:
                big[0] = True
            if not final and not big[-1]:  # the last bucket may go on
                held = [x[begin[-1] :] for x in c]
                c, key = [x[: begin[-1]] for x in c], key[: begin[-1]]
                begin, size, big = begin[:-1], size[:-1], big[:-1]
            else:
                held = [x[:0] for x in c]
                large = key[-1] if len(big) and big[-1] else None
            rows = np.repeat(big, size)
            out = [(key[rows], c[1][rows], None)] if rows.any() else []
            h, n, s1, s2 = c[1:]
            for many in np.unique(size[~big & (size > 1)]):  # buckets of the same size at once, in slices
                x, y = np.triu_indices(many, 1)
                of = begin[(size == many) & ~big]
                for k in range(0, len(of), max(1, HELD // len(x))):
                    first = of[k : k + max(1, HELD // len(x)), None]
                    i, j = (first + x).ravel(), (first + y).ravel()
                    ok = (np.minimum(n[i], n[j]) >= share * np.maximum(n[i], n[j])) & (h[i] != h[j])
                    i, j = i[ok], j[ok]
                    differ = np.bitwise_count((s1[i] ^ s1[j]).view(np.uint64)).astype(np.int16) + np.bitwise_count((s2[i] ^ s2[j]).view(np.uint64))
                    ok = p.sketch_bits - differ >= least
                    i, j = i[ok], j[ok]
                    if len(i):
                        out.append((key[i], np.minimum(h[i], h[j]), np.maximum(h[i], h[j])))
            for k, a, b in out:
                yield pa.record_batch([pa.array(k), pa.array(a), pa.nulls(len(k), pa.int64()) if b is None else pa.array(b)], names=["key", "a", "b"])

        for batch in batches:
            new = [batch.column(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in names]
            yield from work([np.concatenate(x) for x in zip(held, new)], False)
        yield from work(held, True)

    parts = keyed.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return keyed.repartition(int(parts), "key").sortWithinPartitions("key", "h").mapInArrow(run, "key long, a long, b long")


def _blocks(rows: DataFrame, sig: DataFrame, p: Params, size: int = 2000) -> DataFrame:
    """Pairs of similar sketches within large buckets: all rows of a bucket against all, as cells of two blocks spread over tasks.

    A task holds the rows of one cell, about twice ``size`` at most, whatever the size of the bucket.
    """
    least, share = _least(p, 2), p.similarity
    sizes = rows.groupBy("key").agg(F.ceil(F.count("*") / size).cast("int").alias("blocks"))
    bits = sig.select("h", "n", "s1", "s2").dropDuplicates(["h"])
    r = rows.join(sizes, "key").join(bits, "h").withColumn("block", F.pmod(F.xxhash64("h"), F.col("blocks")).cast("int"))
    r = r.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    r = r.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).cast("int").alias("side"), "h", "n", "s1", "s2")
    names = ["key", "i", "j", "side", "h", "n", "s1", "s2"]

    def pairs(odd: bool, one: bool, side: np.ndarray, h: np.ndarray, n: np.ndarray, s1: np.ndarray, s2: np.ndarray) -> Iterator[pa.RecordBatch]:
        left, right = (np.arange(len(h)),) * 2 if one else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
        for at in range(0, len(left), 256):
            i = left[at : at + 256, None]
            bits = np.bitwise_count((s1[i] ^ s1[right]).view(np.uint64)).astype(np.int16) + np.bitwise_count((s2[i] ^ s2[right]).view(np.uint64))
            ok = (p.sketch_bits - bits >= least) & (np.minimum(n[i], n[right]) >= share * np.maximum(n[i], n[right]))
            x, y = np.nonzero(ok & (h[i] < h[right]) if one else ok)
            a, b = h[i[x, 0]], h[right[y]]
            yield pa.record_batch([np.minimum(a, b), np.maximum(a, b), np.full(len(a), odd)], names=["a", "b", "odd"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []  # the cell that may go on

        def done() -> Iterator[pa.RecordBatch]:
            c = [np.concatenate(x) for x in zip(*held)]
            held.clear()
            yield from pairs(bool(c[0][0] & 1), bool(c[1][0] == c[2][0]), *c[3:])

        for batch in batches:
            c = [batch.column(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in names]
            if not len(c[0]):
                continue
            edges = np.flatnonzero((c[0][1:] != c[0][:-1]) | (c[1][1:] != c[1][:-1]) | (c[2][1:] != c[2][:-1])) + 1
            for x, y in zip([0, *edges], [*edges, len(c[0])]):
                if held and any(held[-1][k][-1] != c[k][x] for k in range(3)):
                    yield from done()
                held.append([v[x:y] for v in c])
        if held:
            yield from done()

    parts = rows.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return r.repartition(int(parts), "key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(run, "a long, b long, odd boolean")


class Join(NamedTuple):
    """``links (a, b, similarity)`` between different sets, ``members (id, h)`` and the state after each round of runs."""

    links: DataFrame
    members: DataFrame
    rounds: list[tuple[int, int, float]]  #: runs so far, links found, estimated recall


def similar_sets(records: DataFrame, p: Params = Params()) -> Join:
    """The similarity join of the shingle sets of ``records``.

    ``records``: ``(id long, title string, text string)``; other columns are ignored. A null title or text is
    empty; records with fewer than ``min_words`` words in text are no members. Rows that repeat an id with the
    same content count once. Sets are named by their 64-bit hash ``h``; records with equal sets share it, so
    copies never multiply within a bucket. Every link is checked exactly on the texts. Runs are repeated, with
    other random choices, until the estimated recall is that of ``p``.
    """
    spark = records.sparkSession
    records = records.select(F.col("id").cast("long").alias("id"), F.col("title").cast("string").alias("title"), F.col("text").cast("string").alias("text")).where("id IS NOT NULL")
    cells = spark.sparkContext.broadcast(gram_counters(records, p).astype(np.int64))
    sig = materialize(signatures(records, cells, p))
    members = sig.select("id", "h").distinct()
    met = _met(sig, p)
    links = _exact(_wider(met, sig, p), sig, records, p)
    rounds: list[tuple[int, int, float]] = []
    while True:
        n, recall = _recall(met.join(links, ["a", "b"]), p)
        rounds.append((p.runs * (len(rounds) + 1), n, recall))
        if recall >= p.recall or len(rounds) >= p.rounds:
            return Join(links, members, rounds)
        again = replace(p, seed=p.seed + 7919 * len(rounds))
        further = _met(materialize(signatures(records, cells, again)), again)
        links = materialize(links.union(_exact(_wider(further.join(met, ["a", "b"], "left_anti"), sig, p), sig, records, p)))
        met = materialize(met.union(further).groupBy("a", "b").agg(F.max("odd").alias("odd"), F.max("even").alias("even")))


def _met(sig: DataFrame, p: Params) -> DataFrame:
    """``(a, b, odd, even)``: candidates of one round of runs and whether odd and even runs have them."""
    sets = sig.dropDuplicates(["h"])  # equal sets have equal keys
    found = materialize(_split(sets.select(F.explode("keys").alias("key"), "h", "n", "s1", "s2"), p))
    odd = (F.col("key").bitwiseAND(F.lit(1)) == 1).alias("odd")
    pairs = found.where("b IS NOT NULL").select("a", "b", odd)
    rest = found.where("b IS NULL").select("key", F.col("a").alias("h"))
    if not rest.isEmpty():
        pairs = pairs.union(_blocks(rest, sig, p))
    return materialize(pairs.groupBy("a", "b").agg(F.max("odd").alias("odd"), F.max(~F.col("odd")).alias("even")))


def _wider(met: DataFrame, sig: DataFrame, p: Params) -> DataFrame:
    """``(a, b)`` of the candidates whose wider sketches are similar too, so that few texts are compared."""
    least = _least(p, 16)
    sets = materialize(sig.select("h", "more").dropDuplicates(["h"]))
    side = lambda s: broadcast_if_small(sets.select(F.col("h").alias(s), F.col("more").alias(f"more_{s}")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("more_a", "more_b"))
                differ = x ^ y
                same = ((differ & 15) == 0).sum(1) + ((differ >> 4) == 0).sum(1)
                yield batch.select(["a", "b"]).filter(pa.array(same >= least))

    return materialize(met.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "more_a", "more_b").mapInArrow(run, "a long, b long"))


LINKS = 50  # of a band of similarity from which its own recall counts


def _recall(links: DataFrame, p: Params) -> tuple[int, float]:
    """Links found, and the share of all links that they are: two samples, odd and even runs, and what they have in common
    tell the size of the whole (Chapman's estimator), in bands of similarity, since less similar sets meet less often.
    The lowest of the shares of all links and of each band with enough of them."""
    yes = lambda c: F.sum(F.expr(c).cast("long"))
    band = F.floor((F.col("similarity") - p.similarity) / 0.1 + 1e-9).alias("band")
    shares, found, total = [1.0], 0, 0.0
    for r in links.groupBy(band).agg(F.count("*").alias("n"), yes("odd").alias("odd"), yes("even").alias("even"), yes("odd AND even").alias("both")).collect():
        every = max(r.n, (r.odd + 1) * (r.even + 1) / (r.both + 1) - 1)
        found, total = found + r.n, total + every
        if r.n >= LINKS:
            shares.append(r.n / every)
    if total:
        shares.append(found / total)
    return found, min(shares)


def _exact(pairs: DataFrame, sig: DataFrame, records: DataFrame, p: Params) -> DataFrame:
    """Candidates with their exact similarity, from the texts of one member of each set."""
    needed = materialize(pairs.select(F.col("a").alias("h")).union(pairs.select("b")).distinct())
    ids = materialize(sig.join(broadcast_if_small(needed), "h").groupBy("h").agg(F.min("id").alias("id")))
    texts = materialize(records.join(broadcast_if_small(ids), "id").dropDuplicates(["h"]).select("h", "title", "text"))
    side = lambda s: texts.select(F.col("h").alias(s), F.col("title").alias(f"title_{s}"), F.col("text").alias(f"text_{s}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, ROWS // 2) for whole in batches for at in range(0, whole.num_rows, ROWS // 2)):
            col = {c: batch.column(c).to_pylist() for c in ("title_a", "text_a", "title_b", "text_b")}
            n = batch.num_rows
            both = _texts(col["title_a"], col["text_a"]) + _texts(col["title_b"], col["text_b"])
            grams, begin = shingle_sets(both, p.k)
            size = np.diff(begin)
            owner = np.repeat(np.arange(2 * n) % n, size)
            both = (owner.astype(np.uint64) << np.uint64(52)) | grams
            both.sort()
            common = np.bincount((both[1:][both[1:] == both[:-1]] >> np.uint64(52)).astype(np.int64), minlength=n)
            j = common / np.maximum(1, size[:n] + size[n:] - common)
            keep = np.flatnonzero(j >= p.similarity)
            yield pa.record_batch([batch.column("a").take(pa.array(keep)), batch.column("b").take(pa.array(keep)), j[keep]], names=["a", "b", "similarity"])

    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return materialize(joined.mapInArrow(run, "a long, b long, similarity double"))


def edited_pairs(records: DataFrame, p: Params = Params()) -> DataFrame:
    """``(id_a, id_b)``, smaller first: every pair of records that are edited copies, equal sets included."""
    links, members, _ = similar_sets(records, p)
    a, b = members.select(F.col("id").alias("id_a"), F.col("h").alias("a")), members.select(F.col("id").alias("id_b"), F.col("h").alias("b"))
    linked = links.join(a, "a").join(b, "b").select("id_a", "id_b")
    equal = members.groupBy("h").count().where("count > 1").select("h").join(members, "h")
    same = equal.select("h", F.col("id").alias("id_a")).join(equal.select("h", F.col("id").alias("id_b")), "h").where("id_a < id_b").select("id_a", "id_b")
    return linked.union(same).select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b")).where("id_a <> id_b").distinct()


def copy_groups(records: DataFrame, p: Params = Params()) -> DataFrame:
    """One row per record: ``(id, group_id, n_links)``.

    group_id is the least id of the group of edited copies (a record of its own group names itself). n_links
    counts the records' sets that the record's own set is linked with, plus its exact copies. Records that are
    too short are not compared and form their own group.
    """
    links, members, _ = similar_sets(records, p)
    every = records.select(F.col("id").cast("long").alias("id")).where("id IS NOT NULL").distinct()
    degree = links.select(F.col("a").alias("h")).union(links.select(F.col("b").alias("h"))).groupBy("h").agg(F.count("*").alias("n"))
    per = members.groupBy("h").agg(F.min("id").alias("least"), (F.count("*") - 1).alias("copies"))
    roots = components(links).select(F.col("node").alias("h"), "root")
    per = per.join(roots, "h", "left").join(degree, "h", "left").withColumn("root", F.coalesce("root", "h"))
    group = per.groupBy("root").agg(F.min("least").alias("group_id"))
    named = per.join(group, "root").select("h", "group_id", (F.coalesce("n", F.lit(0)) + F.col("copies")).alias("n_links"))
    return every.join(members.join(named, "h").select("id", "group_id", "n_links"), "id", "left").select("id", F.coalesce("group_id", "id").alias("group_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def join_runs(records: DataFrame, p: Params = Params()) -> DataFrame:
    """``(n_runs, n_links, recall)`` after each round: runs so far, links between different sets, estimated recall of them."""
    return records.sparkSession.createDataFrame(similar_sets(records, p).rounds, "n_runs int, n_links long, recall double")
