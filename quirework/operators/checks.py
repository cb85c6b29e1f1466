"""Joins and anti-joins of the review: pages and ranges, references, listed documents, near-duplicate pages."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quirework.functions.numbering import attachment_key, normalize_marker
from quirework.operators.components import components
from quirework.runtime import materialize
from quirework.functions.text import _norm, clean, norm_lower, prefix_ratio, shingles

# Words by which a listed document without a number is known.
KEYWORDS = {
    "letter of award": "letter_of_award", "loa": "letter_of_award", "letter of acceptance": "letter_of_award",
    "letter of intent": "letter_of_intent", "loi": "letter_of_intent",
    "notification of award": "notification_of_award", "notice of award": "notification_of_award",
    "general conditions": "general_conditions", "gcc": "general_conditions",
    "special conditions": "special_conditions", "scc": "special_conditions", "particular conditions": "special_conditions",
    "technical specification": "technical_specification", "specification": "technical_specification",
    "scope of work": "scope_of_work",
    "bill of quantities": "boq_or_price_schedule", "boq": "boq_or_price_schedule", "price schedule": "boq_or_price_schedule", "schedule of rates": "boq_or_price_schedule",
    "integrity pact": "integrity_pact", "minutes": "minutes_of_meeting",
    "amendment": "amendment_or_corrigendum", "corrigendum": "amendment_or_corrigendum", "addendum": "amendment_or_corrigendum",
    "instructions to bidders": "tender_notice_or_itb", "notice inviting tender": "tender_notice_or_itb", "nit": "tender_notice_or_itb",
    "bank guarantee": "bank_guarantee", "power of attorney": "power_of_attorney", "agreement": "contract_agreement", "deviation": "deviation_list",
}
#: Lines of an index that are no entries.
INDEX_WORDS = ["contents", "index", "table of contents", "clause", "page", "title"]


def pages_of_ranges(ranges: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """One row per page of each range: an equi-join key in place of a range join. Ranges that end before they begin have none."""
    return ranges.where(F.col(end) >= F.col(start)).select(*keys, F.explode(F.sequence(start, end)).alias("page"))


def reference_findings(refs: DataFrame, found: DataFrame, by: list[str]) -> DataFrame:
    """``by``, ``kind``, ``idx``, ``code``, ``pages``: keys referred to but not found, and found but not referred to.

    ``refs``: by, page, kind, idx; ``found``: by, kind, idx, page. pages are distinct and sorted, the first eight of
    references, the first three of what is found.
    """
    key = [*by, "kind", "idx"]

    def side(a: DataFrame, b: DataFrame, code: str, most: int) -> DataFrame:
        lone = a.join(b.select(*key).distinct(), key, "left_anti").groupBy(*key)
        return lone.agg(F.slice(F.array_sort(F.collect_set("page")), 1, most).alias("pages")).withColumn("code", F.lit(code))

    return side(refs, found, "reference_not_found", 8).unionByName(side(found, refs, "attachment_not_referenced", 3))


def found_attachments(titled: DataFrame, by: list[str], title: str) -> DataFrame:
    """Attachment keys that titles begin with or name: ``by``, ``kind``, ``idx``, ``page``."""
    return titled.withColumn("_k", attachment_key(F.col(title))).where("_k IS NOT NULL").select(*by, "_k.kind", "_k.idx", "page").distinct()


def keyword_types(name: Column) -> Column:
    """Document types that a listed name may stand for by its words, as an array."""
    low = F.lower(clean(name))
    return F.array_distinct(F.array_compact(F.array(*(F.when(low.rlike(rf"\b{word}\b"), kind) for word, kind in KEYWORDS.items()))))


def listed_missing(listed: DataFrame, documents: DataFrame, by: list[str], similar: float = 0.8) -> DataFrame:
    """Listed documents that no document of the bundle is: by number where there is one, else by type or similar title.

    ``listed``: by, name; ``documents``: by, doc_type, title.
    """
    names = listed.where("trim(name) <> ''").select(*by, "name").distinct().withColumn("_k", attachment_key(F.col("name")))
    docs = documents.select(*by, "doc_type", "title").distinct().withColumn("_dk", attachment_key(F.col("title")))
    numbered = names.where("_k IS NOT NULL").join(docs.where("_dk IS NOT NULL").select(*by, F.col("_dk").alias("_k")).distinct(), [*by, "_k"], "left_anti")
    plain = names.where("_k IS NULL")
    typed = plain.select(*by, "name", F.explode(keyword_types(F.col("name"))).alias("doc_type")).join(docs.select(*by, "doc_type").distinct(), [*by, "doc_type"])
    plain = plain.join(typed.select(*by, "name").distinct(), [*by, "name"], "left_anti").select(*by, "name")
    near = similar_in_blocks(plain, "name", docs, "title", by, similar)
    return numbered.select(*by, "name").unionByName(plain.join(near, [*by, "name"], "left_anti"))


def index_missing(entries: DataFrame, titles: DataFrame, by: list[str], similar: float = 0.8) -> DataFrame:
    """Index entries that no node title is: similar as a whole, or contained in one if longer than 12 characters."""
    e = entries.select(*by, "entry").distinct().withColumn("_e", norm_lower(F.col("entry"))).where((F.length("_e") >= 6) & ~F.col("_e").isin(*INDEX_WORDS))
    t = titles.select(*by, F.col("title").alias("_t")).distinct()
    # equal forms need no comparison
    rest = e.join(t.select(*by, norm_lower(F.col("_t")).alias("_e")).distinct(), [*by, "_e"], "left_anti").select(*by, "entry")
    hit = similar_in_blocks(rest, "entry", t, "_t", by, similar, contained=12)
    return rest.join(hit, [*by, "entry"], "left_anti")


def similar_in_blocks(queries: DataFrame, query: str, rows: DataFrame, value: str, by: list[str], similar: float, contained: int | None = None, block: int = 1000) -> DataFrame:
    """``by`` and ``query`` of the queries that any value of their group is similar to, by the ratio of comparison forms, or that
    stand within one if longer than ``contained`` characters.

    The queries and values of a group are cut into blocks; a cell of one block of each goes through a task as
    consecutive rows, so a group of any size is spread over tasks of bounded memory, and no pair is ever a row.
    Lengths and letters in common bound the ratio, so few pairs are compared in full.
    """
    group = F.xxhash64(*by)
    q = queries.select(*by, query).where(F.col(query).isNotNull()).distinct()
    v = rows.select(group.alias("_g"), F.col(value).alias("_s")).where("_s IS NOT NULL").distinct()
    key = q.select(group.alias("_g"), F.col(query).alias("_s"))
    sizes = key.groupBy("_g").agg(F.ceil(F.count("*") / block).cast("int").alias("_nq")).join(v.groupBy("_g").agg(F.ceil(F.count("*") / block).cast("int").alias("_nv")), "_g")
    side = lambda df, own, other, at, across, kind: df.join(sizes, "_g").select("_g", F.pmod(F.xxhash64("_s"), F.col(own)).cast("int").alias(at), F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(across), F.lit(kind).alias("_k"), "_s")
    cells = side(key, "_nq", "_nv", "_a", "_b", 0).unionByName(side(v, "_nv", "_nq", "_b", "_a", 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[str]] = {0: [], 1: []}
        cell = None

        def done() -> Iterator[pa.RecordBatch]:
            hit = _similar(held[0], held[1], similar, contained)
            if hit:
                yield pa.record_batch([pa.array([cell[0]] * len(hit), pa.int64()), pa.array(hit, pa.string())], names=["_g", "_s"])

        for batch in batches:
            for g, a, b, k, s in zip(*(batch.column(c).to_pylist() for c in ("_g", "_a", "_b", "_k", "_s"))):
                if (g, a, b) != cell:
                    if cell is not None:
                        yield from done()
                    cell, held = (g, a, b), {0: [], 1: []}
                held[k].append(s)
        if cell is not None:
            yield from done()

    parts = int(q.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = cells.repartition(parts, "_g", "_a", "_b").sortWithinPartitions("_g", "_a", "_b").mapInArrow(run, "_g long, _s string").distinct()
    return q.withColumn("_g", group).join(found.withColumnRenamed("_s", query), ["_g", query], "left_semi").select(*by, query)


def _letters(forms: list[str]) -> np.ndarray:
    """Counts of characters, by code modulo 64: two texts have at most the sum of the lesser counts in common."""
    out = np.zeros((len(forms), 64), np.int16)
    for i, x in enumerate(forms):
        out[i] = np.bincount(np.frombuffer(x.encode("utf-32-le"), np.uint32) & 63, minlength=64)
    return out


def _similar(queries: list[str], values: list[str], similar: float, contained: int | None) -> list[str]:
    forms = sorted({_norm(v) for v in values} - {""})
    every = "\n".join(forms)
    known = set(forms)
    size, letters = np.array([len(x) for x in forms], np.int64), _letters(forms)
    out = []
    for raw in queries:
        q = _norm(raw)
        if q in known or q and contained is not None and len(q) > contained and q in every:
            out.append(raw)
            continue
        if not q or not forms:
            continue
        total = size + len(q)
        near = np.flatnonzero(2 * np.minimum(size, len(q)) >= similar * total)
        near = near[2 * np.minimum(letters[near], _letters([q])[0]).sum(1) >= similar * total[near]]
        for i in near:
            # the ratio depends on the order of the texts: query first, as where it is asked
            if SequenceMatcher(None, q, forms[i]).ratio() >= similar:
                out.append(raw)
                break
    return out


def clean_entry(c: Column) -> Column:
    """Index entry without dot leaders and page numbers."""
    return F.trim(F.regexp_replace(F.regexp_replace(clean(c), r"[.\s]{4,}\S*\s*$", ""), r"\s+\d{1,4}$", ""))


def duplicate_pairs(texts: DataFrame, by: list[str], key: str, least: int = 30, similarity: float = 0.9, k: int = 5) -> DataFrame:
    """``by``, ``earlier``, ``later``, ``jaccard``: texts of a group whose shingle sets are similar, exactly.

    The later text needs ``least`` shingles and a size ratio within 0.7 to 1.43. Only the rarest shingles of each
    set are joined, as many as sets of this similarity must share one of (prefix filtering), so words that
    every page has are never paired.
    """
    hashed = materialize(texts.select(*by, key, F.transform(shingles(F.col("text"), k), lambda g: F.xxhash64(g)).alias("_h"))).where(F.size("_h") > 0)
    grams = hashed.select(*by, key, F.size("_h").alias("_n"), F.explode("_h").alias("_g"))
    df = grams.groupBy(*by, "_g").agg(F.count("*").alias("_df"))
    rank = F.row_number().over(W.partitionBy(*by, key).orderBy("_df", "_g"))
    prefix = materialize(grams.join(df, [*by, "_g"]).withColumn("_r", rank).where(F.col("_r") <= F.col("_n") - F.ceil(F.col("_n") * similarity) + 1).select(*by, key, "_n", "_g"))
    a = prefix.select(*by, F.col(key).alias("earlier"), F.col("_n").alias("_na"), "_g")
    b = prefix.where(F.col("_n") >= least).select(*by, F.col(key).alias("later"), F.col("_n").alias("_nb"), "_g")
    sized = (F.col("_na") / F.col("_nb") > 0.7) & (F.col("_na") / F.col("_nb") < 1.43) & (F.least("_na", "_nb") >= similarity * F.greatest("_na", "_nb"))
    pairs = materialize(a.join(b, [*by, "_g"]).where((F.col("earlier") < F.col("later")) & sized).select(*by, "earlier", "later").distinct())
    # candidates are few; their shingles are formed again as texts, so that equal hashes of different ones count for nothing
    one = lambda n, s: texts.select(*by, F.col(key).alias(n), F.col("text").alias(s))
    full = pairs.join(one("earlier", "_ta"), [*by, "earlier"]).join(one("later", "_tb"), [*by, "later"])
    full = full.select(*by, "earlier", "later", shingles(F.col("_ta"), k).alias("_sa"), shingles(F.col("_tb"), k).alias("_sb"))
    j = F.size(F.array_intersect("_sa", "_sb")) / F.size(F.array_union("_sa", "_sb"))
    return full.select(*by, "earlier", "later", j.alias("jaccard")).where(F.col("jaccard") >= similarity)


def duplicate_of(pairs: DataFrame, by: list[str]) -> DataFrame:
    """``by``, ``later``, ``duplicate_of``: the earliest similar page that is no duplicate itself, decided page by page in order.

    The pairs of one component are few; each is worked through in one task, whatever the size of the group.
    """

    key = F.xxhash64(*by)
    edges = pairs.select(F.concat_ws("|", key.cast("string"), "earlier").alias("a"), F.concat_ws("|", key.cast("string"), "later").alias("b"))
    roots = components(edges)
    rows = pairs.withColumn("node", F.concat_ws("|", key.cast("string"), "later")).join(roots, "node")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.select(*by, "later", F.col("earlier").alias("duplicate_of")).schema.fields)

    def greedy(pdf: pd.DataFrame) -> pd.DataFrame:
        taken: set = set()
        out = []
        for later, g in pdf.sort_values(["later", "earlier"]).groupby("later", sort=True):
            hit = next((e for e in g["earlier"] if e not in taken), None)
            if hit is not None:
                taken.add(later)
                out.append((*g.iloc[0][by], later, hit))
        return pd.DataFrame(out, columns=[*by, "later", "duplicate_of"])

    return rows.groupBy("root").applyInPandas(greedy, schema)


def mark_duplicates(pages: DataFrame, duplicates: DataFrame) -> DataFrame:
    """``pages`` with ``duplicate_of`` from :func:`duplicate_of` (by bundle_id): such pages start nothing, hold no candidates and are
    no content page before another."""
    found = duplicates.select("bundle_id", F.col("later").alias("page"), F.col("duplicate_of").cast("int").alias("duplicate_of")).dropDuplicates(["bundle_id", "page"])
    return pages.drop("duplicate_of").join(found, ["bundle_id", "page"], "left")


ALIGNED = "page int, a_pos int, b_pos int, score double, outcome string"


def aligned(first: DataFrame, second: DataFrame, by: str, accept: float = 0.75) -> DataFrame:
    """Two reads of a page matched line by line: ``ALIGNED`` rows after ``by``; outcome ``match``, ``marker_mismatch``, ``a_only`` or ``b_only``.

    For each line of the first read, in order, lines of the second are tried from behind the last match on and
    then from the start; the best score wins, the first one among equals. Equal markers lift a score. Both have
    ``by``, page, pos, marker, text.
    """
    both = first.select(by, "page", F.lit("a").alias("side"), "pos", normalize_marker(F.col("marker")).alias("marker"), F.substring(clean(F.col("text")), 1, 160).alias("text"))
    both = both.unionByName(second.select(by, "page", F.lit("b").alias("side"), "pos", normalize_marker(F.col("marker")).alias("marker"), clean(F.col("text")).alias("text")))

    def match(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = (pdf[pdf["side"] == s].sort_values("pos").to_dict("records") for s in "ab")
        texts = [_norm(x["text"]) for x in b]
        free, last, out = set(range(len(b))), -1, []
        for x in a:
            tx = _norm(x["text"])
            best, score = None, 0.0
            for j in [*range(last + 1, len(b)), *range(0, last + 1)]:
                if j in free:
                    s = prefix_ratio(tx, texts[j])
                    if x["marker"] and x["marker"] == b[j]["marker"]:
                        s = max(s, 0.5 + 0.5 * s)
                    if s > score:
                        best, score = j, s
            if best is not None and score >= accept:
                free.discard(best)
                last = best
                differ = x["marker"] and b[best]["marker"] and x["marker"] != b[best]["marker"]
                out.append((x["pos"], b[best]["pos"], score, "marker_mismatch" if differ else "match"))
            else:
                out.append((x["pos"], None, score, "a_only"))
        out += [(None, b[j]["pos"], 0.0, "b_only") for j in sorted(free)]
        rows = pd.DataFrame(out, columns=["a_pos", "b_pos", "score", "outcome"])
        rows.insert(0, "page", pdf["page"].iloc[0])
        rows.insert(0, by, pdf[by].iloc[0])
        return rows.astype({"a_pos": "Int32", "b_pos": "Int32"})

    kind = both.schema[by].dataType.simpleString()
    return both.groupBy(by, "page").applyInPandas(match, f"{by} {kind}, {ALIGNED}")


def best_lines(probes: DataFrame, lines: DataFrame, by: list[str]) -> DataFrame:
    """The most similar line, or two neighbouring lines, of each probe: ``by``, ``probe``, ``line``, ``score``."""
    from quirework.functions.text import similarity_udf

    w = W.partitionBy(*by).orderBy("ord")
    pairs = lines.withColumn("_n", F.lead("text").over(w))
    cand = pairs.select(*by, "ord", F.explode(F.array_compact(F.array("text", F.when(F.col("_n").isNotNull(), F.concat_ws(" ", "text", "_n"))))).alias("line"))
    scored = probes.join(cand, by).withColumn("score", similarity_udf(F.col("probe"), F.col("line")))
    return scored.groupBy(*by, "probe").agg(F.max_by("line", F.struct("score", -F.col("ord"), -F.length("line"))).alias("line"), F.max("score").alias("score"))


def suggestions_missing(suggestions: DataFrame, titles: DataFrame, by: list[str], similar: float = 0.85) -> DataFrame:
    """Suggested headings that no title of the outline is similar to as a whole."""
    rows = suggestions.select(*by, "suggestion")
    return rows.join(similar_in_blocks(rows, "suggestion", titles, "title", by, similar), [*by, "suggestion"], "left_anti")
