"""Sources mixed to target shares of tokens, by Poisson replication.

A document is used N times, N being the value of a Poisson distribution that a hash of its key picks by
inversion, cut off at the cap of its source. For a fixed hash N grows with the mean, so the mean of each
source is calibrated on the tokens that it really gives: each pass over the sizes tries a grid of means and
narrows it down. Copies are shuffled globally by another hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.runtime import materialize

# Fixed value: the public splitting pattern of the byte-level vocabulary.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass(frozen=True)
class Params:
    tokenizer: str = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    seed: int = 11
    grid: int = 24
    passes: int = 4


def token_counts(documents: DataFrame, keys: list[str], text: str, p: Params = Params()) -> DataFrame:
    """``keys`` and ``n_tokens`` of each text; a null text has 0."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in documents.select(*keys).schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import base64

        import tiktoken

        with open(p.tokenizer, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("sizes", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in batch.column("_text").to_pylist()]
            yield pa.record_batch([*(batch.column(k) for k in keys), pa.array(n, pa.int64())], names=[*keys, "n_tokens"])

    return documents.select(*keys, F.col(text).cast("string").alias("_text")).mapInArrow(run, f"{schema}, n_tokens long")


def cdf(mean: float, cap: int) -> list[float]:
    """P(N <= k) for k below the cap of a Poisson distribution."""
    term, total, out = math.exp(-mean), 0.0, []
    for k in range(cap):
        total += term
        out.append(total)
        term *= mean / (k + 1)
    return out


def _uses(u, steps):
    """Inversion: how many values of the distribution function are at most u."""
    return F.size(F.filter(steps, lambda c: u >= c))


def mixed(sizes: DataFrame, targets: DataFrame, total_tokens: int | None = None, p: Params = Params()) -> tuple[DataFrame, DataFrame]:
    """``selection (doc_id, source, n_tokens, copy_no, shuffle_key)`` and ``shares`` per source.

    ``sizes``: ``(doc_id, source, n_tokens)``. ``targets``: ``(source, target_share, max_repeats)``, few rows, one per
    source. total_tokens is the size aimed at, the size of all sources with a target where it is not given. A
    source whose cap keeps it below its target is used up to the cap throughout and reported with ``in_reach``
    false. Sources without a target, null sources and empty documents give no rows; a target without
    documents gives a share of 0. Copies of a document are numbered from 1; the selection is ordered by
    shuffle_key within range partitions, so reading it in order is a global shuffle.
    """
    spark = sizes.sparkSession
    goals = {r.source: (float(r.target_share), int(r.max_repeats)) for r in targets.where("source IS NOT NULL AND target_share > 0 AND max_repeats > 0").distinct().collect()}
    u = ((F.xxhash64(F.col("doc_id"), F.lit(p.seed)).bitwiseAND(F.lit((1 << 52) - 1))).cast("double") + 0.5) / float(1 << 52)
    sizes = materialize(sizes.where(F.col("n_tokens") > 0).where(F.col("source").isin(*goals)).select("doc_id", "source", "n_tokens", u.alias("u")))
    have = {r.source: r.n for r in sizes.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    total = total_tokens if total_tokens is not None else sum(have.values())
    low, high = {}, {}
    for s, (share, cap) in goals.items():
        low[s], high[s] = 0.0, 4.0 * cap + 20.0
    want = {s: goals[s][0] * total for s in goals}
    live = [s for s in goals if have.get(s, 0) * goals[s][1] > want[s]]
    for _ in range(p.passes if live else 0):
        tries = [(s, k, low[s] + (high[s] - low[s]) * k / p.grid) for s in live for k in range(1, p.grid)]
        table = spark.createDataFrame([(s, k, cdf(m, goals[s][1])) for s, k, m in tries], "source string, k int, steps array<double>")
        got = sizes.join(F.broadcast(table), "source").groupBy("source", "k").agg(F.sum(F.col("n_tokens") * _uses(F.col("u"), F.col("steps"))).alias("n"))
        given = {(r.source, r.k): r.n for r in got.collect()}
        for s in live:
            step = (high[s] - low[s]) / p.grid
            k = max([0, *(k for k in range(1, p.grid) if given[s, k] <= want[s])])
            low[s], high[s] = low[s] + step * k, low[s] + step * (k + 1)
    means = spark.createDataFrame([(s, cdf(low[s], goals[s][1]) if s in live else [0.0] * goals[s][1]) for s in goals], "source string, steps array<double>")
    drawn = sizes.join(F.broadcast(means), "source").withColumn("n", _uses(F.col("u"), F.col("steps"))).where("n > 0").drop("steps", "u")
    copies = drawn.select("doc_id", "source", "n_tokens", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy_no"))
    selection = copies.withColumn("shuffle_key", F.xxhash64("doc_id", "copy_no", F.lit(p.seed + 1))).repartitionByRange("shuffle_key").sortWithinPartitions("shuffle_key", "doc_id", "copy_no")
    used = drawn.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("n")).alias("drawn_tokens"), F.count("*").alias("n_documents"), F.sum("n").alias("n_copies"), F.max("n").alias("most_uses"))
    wide = spark.createDataFrame([(s, share, cap, have.get(s, 0), have.get(s, 0) * cap >= want[s]) for s, (share, cap) in goals.items()], "source string, target_share double, max_repeats int, source_tokens long, in_reach boolean")
    shares = wide.join(used, "source", "left").na.fill(0, ["drawn_tokens", "n_documents", "n_copies", "most_uses"])
    whole = used.agg(F.sum("drawn_tokens").alias("_all"))
    shares = shares.crossJoin(F.broadcast(whole))  # one row
    shares = shares.select("source", "target_share", (F.col("drawn_tokens") / F.col("_all")).alias("reached_share"), (F.col("drawn_tokens") / F.lit(float(max(total, 1)))).alias("share_of_total"), "in_reach", "max_repeats", "most_uses", "n_documents", "n_copies", "source_tokens", "drawn_tokens")
    return selection, shares
