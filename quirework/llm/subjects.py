"""Subject areas of documents, from weak votes whose accuracies are learned.

A lexicon of terms per subject and the frames in which a term is only mentioned in passing are counted on
documents with set labels. Labelling functions then vote on every document and subject: by the numbered
paragraphs that hold a term (lexicon), by the headnote (section), by the docket's register (address) and by
the source. A latent model with one accuracy table per
function is fitted on the counts of vote patterns, and the posterior probability assigns the subjects.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.runtime import materialize

NUMBERED = re.compile(r"(?m)^[ \t]*(?:\[(\d{1,4})\]|\((\d{1,4})\)|(\d{1,4})\.?)[ \t]+(?=\S)")
#: A line that is a date: a day, a month by its name or number, a year.
DATE = re.compile(r"[ \t]*\d{1,2}(?:st|nd|rd|th)?\.?[ \t]+(?:(?:day[ \t]+)?of[ \t]+)?(?:[^\W\d_]+\.?|\d{1,2}\.?),?[ \t]+\d{4}\.?[ \t]*$", re.M)
JUMP = 9  # numbers that may be missing between two paragraphs
#: Lines that are page headers: capitalised words or numbers with "page 3", bars with a last number, or dashes around both.
HEADER = re.compile(r"(?m)^[ \t]*(?:(?:[A-Z0-9]\S*[ \t]+){0,4}[Pp]age[ \t]+\d+|[^\n|]{1,40}\|[^\n|]{1,40}\|[ \t]*\d+|-[ \t][^\n]{1,60}[ \t]-[ \t]*\d+[ \t]*-)[ \t]*$")
#: The closing formula, a line of its own at the end.
CLOSING = re.compile(r"(?:\A|\n)[ \t]*(?:It is so ordered|Appeal (?:allowed|dismissed)(?: in part)?|Remitted for a fresh hearing|Die (?:Revision|Berufung) wird (?:zugelassen|zurückgewiesen)|Done)\.\s*\Z")
WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"(?<=[.;:!?])\s+")
#: Words, and the marks that end a sentence or part of one.
TOKEN = re.compile(r"[^\W\d_]+|[.;:!?](?=\s)")
ENDS = frozenset(".;:!?")


ALL = -(2**31)  #: stands for all documents beside the subjects' ids


@dataclass(frozen=True)
class Params:
    labelled: int = 50_000  # about so many documents with labels, at most, are what lexicon and frames are counted on
    longest: int = 3  # words of a term
    precision: float = 0.65  # share of a term's labelled documents that have its subject
    chance: float = 1e-5  # probability that a term that has nothing to do with a subject looks as tied to it
    frame_support: int = 5
    rounds: int = 30
    posterior: float = 0.5
    seed: int = 9


def _chain(text: str) -> list[re.Match]:
    """The starts of the numbered paragraphs, numbered 1, 2, 3 ... in one style; up to ``JUMP`` numbers may be missing or misread.

    A 1 that another 1 of its style follows before any 2 is none (a date or a name in the caption), unless only it stands after a blank
    line. Lines that are dates are none either.
    """
    marks = [(m, m.lastindex, int(m[m.lastindex]), text[max(0, m.start() - 2) : m.start()] in ("", "\n\n")) for m in NUMBERED.finditer(text) if not DATE.match(text, m.start())]
    after: list[int | None] = [None] * len(marks)  # the next mark of the chain
    length = [1] * len(marks)
    last: dict[tuple, int] = {}
    for i in range(len(marks) - 1, -1, -1):
        _, style, n, _ = marks[i]
        steps = [j for k in range(1, JUMP + 2) if (j := last.get((style, n + k))) is not None]
        after[i] = max(steps, key=lambda j: length[j], default=None)  # of equally long chains the one of the next number
        length[i] = 1 + (length[after[i]] if steps else 0)
        if (style, n) not in last or length[i] >= length[last[style, n]]:
            last[style, n] = i
    ones = [i for i, x in enumerate(marks) if x[2] == 1]
    if not ones:
        return []
    for k, i in enumerate(ones):
        if after[i] is not None and not any(marks[j][1] == marks[i][1] and j < after[i] and marks[j][3] >= marks[i][3] for j in ones[k + 1 :]):
            break
    else:  # a single paragraph
        i = max(ones, key=lambda j: (marks[j][3], j))
    at = []
    while i is not None:
        at.append(marks[i][0])
        i = after[i]
    return at


def sections(text: str) -> tuple[str, list[str]]:
    """What stands before the first numbered paragraph, and the numbered paragraphs: all up to the next number, without page headers
    and the closing formula."""
    at = _chain(text)
    if not at:
        return text, []
    ends = [m.start() for m in at[1:]] + [len(text)]
    paras = [HEADER.sub("", text[m.end() : e]).rstrip() for m, e in zip(at, ends)]
    paras[-1] = CLOSING.sub("", paras[-1]).rstrip()
    return text[: at[0].start()], paras


def _grams(words: list[str], longest: int) -> set[str]:
    out = set(words)
    for k in range(2, longest + 1):
        out.update(map(" ".join, zip(*(words[i:] for i in range(k)))))
    return out


def lexicon(labelled: DataFrame, p: Params) -> dict[tuple, int]:
    """Terms that a subject's documents have: ``labelled`` has ``text`` and ``subjects`` (an array)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, Counter] = {ALL: Counter()}
        for batch in batches:
            for text, subjects in zip(batch.column("text").to_pylist(), batch.column("subjects").to_pylist()):
                _, paras = sections(text or "")
                grams: set[str] = set()
                for para in paras:
                    for s in SENTENCE.split(para.lower()):
                        grams |= _grams(WORD.findall(s), p.longest)
                for s in {ALL, *subjects}:
                    seen.setdefault(s, Counter()).update(grams)
        for s, n in seen.items():
            yield pa.record_batch([pa.array(list(n), pa.string()), pa.array([s] * len(n), pa.int32()), pa.array(list(n.values()), pa.int64())], names=["term", "subject_id", "n"])

    n = labelled.select("text", "subjects").mapInArrow(count, "term string, subject_id int, n long").groupBy("term", "subject_id").agg(F.sum("n").alias("n"))
    n = materialize(n)
    docs = max(1, labelled.count())
    prior = labelled.select(F.explode("subjects").alias("subject_id")).groupBy("subject_id").agg((F.count("*") / docs).alias("prior"))
    whole = n.where(F.col("subject_id") == ALL).select("term", F.col("n").alias("all"))
    best = n.where(F.col("subject_id") != ALL).join(whole, "term").join(F.broadcast(prior), "subject_id")  # one row per subject
    q = F.col("n") / F.col("all")
    # Chernoff bound of the binomial tail: all * KL(q || prior)
    kl = q * F.log(q / F.col("prior")) + F.when(q < 1, (1 - q) * F.log((1 - q) / (1 - F.col("prior")))).otherwise(0.0)
    best = best.where((q >= p.precision) & (q > F.col("prior")) & (F.col("all") * kl >= -math.log(p.chance)))
    found = {tuple(r.term.split(" ")): r.subject_id for r in best.groupBy("term").agg(F.max_by("subject_id", "n").alias("subject_id")).collect()}
    parts = lambda t: (t[i : i + k] for k in range(1, len(t)) for i in range(len(t) - k + 1))
    return {t: s for t, s in found.items() if not any(found.get(x) == s for x in parts(t))}


def _index(lex: dict[tuple, int]) -> dict[str, list[tuple[tuple, int]]]:
    out: dict = {}
    for t, s in lex.items():
        out.setdefault(t[0], []).append((t, s))
    return {k: sorted(v, key=lambda x: -len(x[0])) for k, v in out.items()}


def mentions(text: str, index: dict) -> Iterator[tuple[int, str, str]]:
    """``(subject, words before, words after)`` of each term in a passage; the longest term counts where several begin."""
    w = TOKEN.findall(text.lower())
    free = 0
    for i in [i for i, x in enumerate(w) if x in index]:
        if i < free:
            continue  # inside the term before
        for t, subject in index[w[i]]:
            if tuple(w[i : i + len(t)]) == t:
                free = i + len(t)
                left, right = w[max(0, i - 3) : i], w[free : free + 3]
                for k in range(len(left) - 1, -1, -1):
                    if left[k] in ENDS:
                        left = left[k + 1 :]
                        break
                for k, x in enumerate(right):
                    if x in ENDS:
                        right = right[:k]
                        break
                yield subject, " ".join(left), " ".join(right)
                break


def passing_frames(labelled: DataFrame, lex: dict[tuple, int], p: Params) -> set[tuple[str, str]]:
    """Words around terms whose subject the labels mostly don't have."""
    held = labelled.sparkSession.sparkContext.broadcast(_index(lex))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text, subjects in zip(batch.column("text").to_pylist(), batch.column("subjects").to_pylist()):
                for para in sections(text or "")[1]:
                    for s, left, right in mentions(para, held.value):
                        good = s in subjects
                        for side, frame in (("l", left), ("r", right)):
                            if frame.count(" ") == 2:
                                seen[side, frame, good] += 1
        keys = list(seen)
        yield pa.record_batch([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([k[2] for k in keys], pa.bool_()), pa.array([seen[k] for k in keys], pa.int64())], names=["side", "frame", "good", "n"])

    n = labelled.select("text", "subjects").mapInArrow(count, "side string, frame string, good boolean, n long")
    n = n.groupBy("side", "frame").agg(F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"), F.sum("n").alias("n"))
    return {(r.side, r.frame) for r in n.where((F.col("n") >= p.frame_support) & (F.col("good") < 0.5 * F.col("n"))).collect()}


VOTES = ("lexicon", "section", "address", "source")


def votes(documents: DataFrame, lex: dict[tuple, int], frames: set, priors: tuple[dict, dict], subjects: list[int]) -> DataFrame:
    """``(doc_id, subject_id, lexicon, section, address, source)``: one row per document and subject with a vote of the text.

    lexicon: numbered paragraphs with a term, 3 at most; section: 1 if the headnote has a term; address and source:
    +1 or -1 where the labels of the docket's register or the source prefer or avoid the subject, else 0.
    """
    held = documents.sparkSession.sparkContext.broadcast((_index(lex), frames, priors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, passing, (by_address, by_source) = held.value
        for batch in batches:
            out: list[tuple] = []
            for doc, text, docket, source in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "docket", "source"))):
                head, paras = sections(text or "")
                per: dict[int, set[int]] = {}
                for k, para in enumerate(paras):
                    for s, left, right in mentions(para, index):
                        if ("l", left) not in passing and ("r", right) not in passing:
                            per.setdefault(s, set()).add(k)
                noted = {s for s, *_ in mentions(head, index)}
                address = (docket or "").split(" ")[0]
                for s in per.keys() | noted:
                    ks = per.get(s, set())
                    out.append((doc, s, min(3, len(ks)), int(s in noted), by_address.get((address, s), 0), by_source.get((source, s), 0)))
            cols = list(zip(*out)) if out else [()] * 6
            yield pa.record_batch([pa.array(c, pa.int64() if i == 0 else pa.int32()) for i, c in enumerate(cols)], names=["doc_id", "subject_id", *VOTES])

    return documents.select("doc_id", "text", "docket", "source").mapInArrow(run, "doc_id long, subject_id int, " + ", ".join(f"{v} int" for v in VOTES))


def label_model(patterns: dict[tuple, int], known: dict[tuple, tuple[int, int]], rounds: int) -> dict[tuple, float]:
    """Posterior probability of each vote pattern, by EM over the accuracy tables of the functions.

    patterns: how many documents have each; known: of those with labels, how many lack and have the subject. The
    latent truth is started from the lexicon and held to the labels where there are any; together the labelled
    documents weigh four times what the others do, so that the functions' dependence on each other doesn't carry
    the truth away from the labels.
    """
    labelled = sum(a + b for a, b in known.values())
    weight = max(1.0, 4 * (sum(patterns.values()) - labelled) / labelled) if labelled else 1.0
    post = {v: 0.95 if v[0] >= 2 else 0.05 for v in patterns}
    sizes = [len({v[j] for v in patterns}) for j in range(len(VOTES))]
    for _ in range(rounds):
        total = [1.0, 1.0]
        table = [[Counter(), Counter()] for _ in VOTES]
        for v, n in patterns.items():
            no, yes = known.get(v, (0, 0))
            rest = max(0, n - no - yes)
            for y, w in ((1, weight * yes + post[v] * rest), (0, weight * no + (1 - post[v]) * rest)):
                total[y] += w
                for j, x in enumerate(v):
                    table[j][y][x] += w
        for v in patterns:
            score = math.log(total[1] / total[0])
            for j, x in enumerate(v):
                score += math.log((table[j][1][x] + 0.5) / (total[1] + 0.5 * sizes[j])) - math.log((table[j][0][x] + 0.5) / (total[0] + 0.5 * sizes[j]))
            post[v] = 1 / (1 + math.exp(-max(-50.0, min(50.0, score))))
    return post


def _preference(labelled: DataFrame, by, subjects: list[int], least: int = 30) -> dict[tuple, int]:
    """Groups whose labelled documents have a subject clearly more or less often than all have. Groups of fewer than ``least``
    labelled documents say nothing, so at most the size of the sample divided by ``least`` of them reach the driver."""
    rows = labelled.withColumn("g", by).where("g IS NOT NULL")
    per = materialize(rows.groupBy("g").agg(F.count("*").alias("n")))
    size = {r.g: r.n for r in per.where(F.col("n") >= least).collect()}
    each = rows.select("g", F.explode("subjects").alias("s"))
    n = {(r.g, r.s): r.n for r in each.join(per.where(F.col("n") >= least).select("g"), "g").groupBy("g", "s").agg(F.count("*").alias("n")).collect()}
    every = {r.s: r.n for r in each.groupBy("s").agg(F.count("*").alias("n")).collect()}
    total = max(1, per.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    out = {}
    for s in subjects:
        base = every.get(s, 0) / total
        for g, m in size.items():
            z = (n.get((g, s), 0) - m * base) / math.sqrt(max(1e-9, m * base * (1 - base)))
            if abs(z) > 3:
                out[g, s] = 1 if z > 0 else -1
    return out


def assigned(documents: DataFrame, labels: DataFrame, areas: DataFrame, p: Params = Params()) -> DataFrame:
    """``(doc_id, subject_id, probability, n_paragraphs)`` for each document and subject with a vote.

    ``documents``: ``(doc_id, text, docket, source)``; ``labels``: ``(doc_id, subject_id)``; ``areas``: the fixed table of
    subjects. Null texts have no votes; without labels there is no lexicon and nothing is assigned. n_paragraphs
    is capped at 3.
    """
    spark = documents.sparkSession
    documents = documents.select("doc_id", "text", "docket", "source").where("doc_id IS NOT NULL")
    subjects = [r[0] for r in areas.select("subject_id").where("subject_id IS NOT NULL").distinct().collect()]
    known = labels.where("doc_id IS NOT NULL AND subject_id IS NOT NULL").groupBy("doc_id").agg(F.collect_set("subject_id").alias("subjects"))
    # a bounded sample, by a filter on the hash of the key
    share = min(1.0, p.labelled / max(1, labels.select("doc_id").distinct().count()))
    known = known.where(F.xxhash64("doc_id", F.lit(p.seed)).bitwiseAND(F.lit((1 << 40) - 1)) < int(share * (1 << 40)))
    labelled = materialize(documents.join(known, "doc_id").repartition(max(2, spark.sparkContext.defaultParallelism)))
    lex = lexicon(labelled, p)
    frames = passing_frames(labelled, lex, p)
    priors = (_preference(labelled, F.split("docket", " ")[0], subjects), _preference(labelled, F.col("source"), subjects))
    rows = materialize(votes(documents, lex, frames, priors, subjects))
    patterns = {tuple(r[v] for v in VOTES): r["n"] for r in rows.groupBy(*VOTES).agg(F.count("*").alias("n")).collect()}  # at most 4*2*3*3 of them
    seen = rows.join(labelled.select("doc_id", "subjects"), "doc_id").groupBy(*VOTES).agg(F.count("*").alias("n"), F.sum(F.array_contains("subjects", F.col("subject_id")).cast("int")).alias("yes"))
    known = {tuple(r[v] for v in VOTES): (r.n - r.yes, r.yes) for r in seen.collect()}
    post = label_model(patterns, known, p.rounds) if patterns else {}
    table = spark.createDataFrame([(*v, q) for v, q in post.items()], ", ".join(f"{v} int" for v in VOTES) + ", probability double")
    return rows.join(F.broadcast(table), list(VOTES)).select("doc_id", "subject_id", "probability", F.col("lexicon").alias("n_paragraphs"))


def shares(found: DataFrame, documents: DataFrame, areas: DataFrame) -> DataFrame:
    """Per subject its documents and their share of all documents."""
    n = documents.select("doc_id").distinct().agg(F.count("*").alias("_n"))
    per = found.groupBy("subject_id").agg(F.countDistinct("doc_id").alias("n_documents"))
    out = areas.select("subject_id", "subject_name").distinct().join(per, "subject_id", "left").na.fill(0, ["n_documents"]).crossJoin(F.broadcast(n))  # one row
    return out.select("subject_id", "subject_name", "n_documents", (F.col("n_documents") / F.col("_n")).alias("share"))
