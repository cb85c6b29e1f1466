"""Page-range windows, document starts, segments, divisions and units.

Tables carry ``bundle_id`` and page numbers from 1; every rule is a projection, join or window per bundle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quirework.functions.numbering import attachment_index, normalize_marker, parse_label
from quirework.functions.text import clean, norm_lower
from quirework.operators.spread import around, following, running_sum

# Division types that a table of contents folds into.
FOLDABLE = ["RECITALS", "CONTRACT_AGREEMENT", "LETTER_OF_AWARD", "LETTER_OF_INTENT", "PRE_BID_MINUTES", "TENDER_NOTICE", "INSTRUCTIONS_TO_TENDERERS", "FORM_OF_TENDER", "GCC", "SCC", "TECHNICAL_SPECS", "SCOPE_OF_WORK", "SCHEDULE", "ANNEXURE", "APPENDIX", "BOQ", "DRAWINGS", "BANK_GUARANTEE", "PROFORMA_OR_FORM"]
# Document types without a clause tree, and those with one only if they are structured.
FLAT = ["stamp_paper", "boq_or_price_schedule", "drawing", "blank", "separator_sheet"]
TREE_IF_STRUCTURED = ["letter_of_intent", "letter_of_award", "notification_of_award", "correspondence", "bank_guarantee", "power_of_attorney", "board_resolution", "certificate_or_affidavit", "form_or_format", "index_or_contents", "other"]


def windows_in(lo: Column, hi: Column, size: int, stride: int) -> Column:
    """Windows of ``size`` pages every ``stride`` pages over ``lo`` to ``hi``, as ``array<struct<lo, hi>>``; the first that reaches ``hi`` is the last."""
    total = hi - lo + 1
    n = F.when(total <= size, 1).otherwise(F.ceil((total - size) / stride).cast("int") + 1)
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct((lo + i * stride).alias("lo"), F.least(lo + i * stride + size - 1, hi).alias("hi")))


def segmentation_windows(first: Column, last: Column, size: int = 220, overlap: int = 20) -> Column:
    """One window if the pages fit, else windows that overlap; a start beyond ``last - overlap`` opens none."""
    many = F.filter(F.sequence(first, last, F.lit(size - overlap)), lambda x: (x <= last - overlap) | (x == first))
    starts = F.when(last - first + 1 <= size, F.array(first)).otherwise(many)
    return F.transform(starts, lambda x: F.struct(x.alias("lo"), F.when(last - first + 1 <= size, last).otherwise(F.least(last, x + size - 1)).alias("hi")))


def within_edges(start: Column, lo: Column, hi: Column, first: Column, last: Column, margin: int = 10) -> Column:
    """A start that is the window's to give: not within ``margin`` pages of an edge that a neighbour shares."""
    return start.between(lo, hi) & ~((lo != first) & (start < lo + margin)) & ~((hi != last) & (start > hi - margin))


def best_starts(proposals: DataFrame) -> DataFrame:
    """The proposal of the highest confidence per start page; the earliest window and position wins ties."""
    w = W.partitionBy("bundle_id", "start_page").orderBy(F.desc("confidence"), "window_lo", "ord")
    return proposals.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def shift_blank_starts(starts: DataFrame, pages: DataFrame) -> DataFrame:
    """Starts on blank pages move to the next page that is not blank, unless that one starts already or none is left.

    Of several that move to the same page the first one stays. The bundle's first page may stay blank.
    """
    first = pages.groupBy("bundle_id").agg(F.min("page").alias("_first"))
    info = following(pages.select("bundle_id", "page", "status"), ["bundle_id"], "page", F.when(F.col("status") != "blank", F.col("page")), "_to").join(first, "bundle_id")
    rows = starts.join(info, (starts["bundle_id"] == info["bundle_id"]) & (starts["start_page"] == info["page"])).select(*(starts[c] for c in starts.columns), "status", "_to", "_first")
    stay = (F.col("status") != "blank") | (F.col("start_page") == F.col("_first"))
    kept = rows.where(stay).select(*starts.columns)
    moved = rows.where(~stay & F.col("_to").isNotNull())
    moved = moved.withColumn("_r", F.row_number().over(W.partitionBy("bundle_id", "_to").orderBy("start_page"))).where("_r = 1")
    moved = moved.withColumn("start_page", F.col("_to")).select(*starts.columns)
    return kept.unionByName(moved.join(kept.select("bundle_id", "start_page"), ["bundle_id", "start_page"], "left_anti"))


def ensure_first(starts: DataFrame, pages: DataFrame) -> DataFrame:
    """A start of confidence 0.5 on the first page of each bundle that has none there. ``starts``: bundle_id, start_page, doc_type, title, confidence."""
    w = W.partitionBy("bundle_id").orderBy("page")
    first = pages.withColumn("_r", F.row_number().over(w)).where("_r = 1")
    first = first.select("bundle_id", F.col("page").alias("start_page"), F.col("page_type").alias("doc_type"), F.coalesce("document_title", F.concat(F.lit("["), "page_type", F.lit("]"))).alias("title"), F.lit(0.5).alias("confidence"))
    missing = first.join(starts.select("bundle_id", "start_page"), ["bundle_id", "start_page"], "left_anti")
    return starts.select(*first.columns).unionByName(missing)


def segments(starts: DataFrame, pages: DataFrame) -> DataFrame:
    """Contiguous segments: each ends before the next start, the last with the bundle. Ids are ``D01``, ``D02`` and on."""
    last = pages.groupBy("bundle_id").agg(F.max("page").alias("_last"))
    rows = around(starts, ["bundle_id"], "start_page", "_no", after={"_next": F.col("start_page")}).join(last, "bundle_id")
    return rows.withColumn("end_page", F.coalesce(F.col("_next.v") - 1, F.col("_last"))).withColumn("segment_id", F.format_string("D%02d", F.col("_no"))).drop("_last", "_next", "_no")


def coverage_violations(parts: DataFrame, pages: DataFrame, shared: bool = False, by: list[str] | None = None, start: str = "start_page", end: str = "end_page") -> DataFrame:
    """Ranges that do not follow on: a start other than the end before plus one (or, if ``shared``, the end itself), an
    end before its start, or ends that are not those of the pages. None where the coverage holds."""
    by = by or ["bundle_id"]
    w = W.partitionBy(*by).orderBy(start, end)
    span = pages.groupBy(*by).agg(F.min("page").alias("_lo"), F.max("page").alias("_hi"))
    rows = parts.join(span, by).withColumn("expected_start", F.coalesce(F.lag(end).over(w) + 1, F.col("_lo"))).withColumn("_next", F.lead(start).over(w))
    ok = (F.col(start) == F.col("expected_start")) | (F.lit(shared) & (F.col(start) == F.col("expected_start") - 1) & (F.col("expected_start") != F.col("_lo")))
    bad = ~ok | (F.col(end) < F.col(start)) | (F.col("_next").isNull() & (F.col(end) != F.col("_hi")))
    return rows.where(bad).drop("_lo", "_hi", "_next")


def prev_content(pages: DataFrame, cols: list[str]) -> DataFrame:
    """``pages`` with ``prev_<col>`` of the nearest page before that is neither blank, failed nor a duplicate, and ``page_no`` from 1.

    A page number missing from the bundle ends the walk back, so each run of consecutive pages stands alone.
    """
    content = ~F.col("status").isin("blank", "failed") & F.col("duplicate_of").isNull()
    # the whole row is taken as one value, so that nulls of a content page stay nulls; pages and their numbers grow alike within a run
    rows = around(pages, ["bundle_id"], "page", "page_no", before={"_p": F.when(content, F.struct("page", *cols))})
    same = F.col("page") - F.col("_p.v.page") == F.col("page_no") - F.col("_p.no")
    return rows.select("*", *(F.when(same, F.col(f"_p.v.{c}")).alias(f"prev_{c}") for c in ["page", *cols])).drop("_p")


def label_continues(prev: Column, cur: Column) -> Column:
    a, b = parse_label(prev), parse_label(cur)
    return F.coalesce((a["prefix"] == b["prefix"]) & (b["value"] == a["value"] + 1), F.lit(False))


def heuristic_starts(pages: DataFrame) -> DataFrame:
    """Starts by title, label reset or header change: ``(bundle_id, start_page, doc_type, title, confidence, evidence)``. Blank and duplicate pages never start."""
    p = prev_content(pages, ["printed_label", "running_header"])
    label = parse_label(F.col("printed_label"))
    reset = F.coalesce(label["value"] == 1, F.lit(False)) & ~label_continues(F.col("prev_printed_label"), F.col("printed_label"))
    a, b = clean(F.col("running_header")), clean(F.col("prev_running_header"))
    change = (a != "") & (b != "") & (F.lower(a) != F.lower(b))
    first = F.col("page_no") == 1
    rows = p.withColumn("_reset", reset).withColumn("_change", change).withColumn("_first", first)
    rows = rows.where((F.col("status") != "blank") & F.col("duplicate_of").isNull() & (F.col("_first") | F.col("is_document_start") | F.col("_reset") | F.col("_change")))
    evidence = F.array_join(F.array_compact(F.array(F.when(F.col("is_document_start"), "title"), F.when(F.col("_reset"), "label reset"), F.when(F.col("_change"), "header change"))), ", ")
    title = F.coalesce("document_title", F.concat(F.lit("["), F.translate("page_type", "_", " "), F.lit("]")))
    return rows.select("bundle_id", F.col("page").alias("start_page"), F.col("page_type").alias("doc_type"), title.alias("title"), F.lit(0.5).alias("confidence"), evidence.alias("evidence"))


def boundary_checks(starts: DataFrame, pages: DataFrame, threshold: float = 0.9, most: int = 120) -> DataFrame:
    """Pages whose boundary is to be checked, with ``rank``; beyond ``most`` per bundle they are reported, not checked (``checked`` false).

    Checked are starts of low confidence or in conflict with the page, and unlisted pages that look like starts.
    """
    p = prev_content(pages, ["printed_label"])
    s = starts.select("bundle_id", F.col("start_page").alias("page"), "confidence", F.lit(True).alias("_start"))
    rows = p.join(s, ["bundle_id", "page"], "left")
    conflict = ~F.col("is_document_start") | label_continues(F.col("prev_printed_label"), F.col("printed_label"))
    listed = F.col("_start").isNotNull() & ((F.col("confidence") < threshold) | conflict)
    unlisted = F.col("_start").isNull() & (F.col("status") == "ok") & F.col("duplicate_of").isNull() & F.col("is_document_start")
    rows = rows.where((F.col("page_no") != 1) & (listed | unlisted)).select("bundle_id", "page", F.col("prev_page").alias("against_page"), F.col("_start").isNotNull().alias("listed"))
    rows = running_sum(rows, ["bundle_id"], ["page"], F.lit(1), "rank")
    return rows.withColumn("rank", F.col("rank").cast("int")).withColumn("checked", F.col("rank") <= most)


def apply_verdicts(starts: DataFrame, verdicts: DataFrame, pages: DataFrame) -> DataFrame:
    """Starts after the checks, with ``boundary_verified`` (null: not checked). ``verdicts``: bundle_id, page, verdict, new_type, new_title.

    ``new_document`` confirms or adds a start, ``continuation`` removes one, anything else leaves it unverified.
    """
    v = verdicts.select("bundle_id", F.col("page").alias("start_page"), "verdict", "new_type", "new_title")
    base = starts.select("bundle_id", "start_page", "doc_type", "title", "confidence")
    kept = base.join(v, ["bundle_id", "start_page"], "left").where("verdict IS NULL OR verdict <> 'continuation'")
    kept = kept.select(*base.columns, (F.col("verdict") == "new_document").alias("boundary_verified"))
    new = v.where("verdict = 'new_document'").join(base, ["bundle_id", "start_page"], "left_anti").join(pages.select("bundle_id", F.col("page").alias("start_page"), "page_type", "document_title"), ["bundle_id", "start_page"])
    kind = F.coalesce("new_type", "page_type")
    new = new.select("bundle_id", "start_page", kind.alias("doc_type"), F.coalesce("new_title", "document_title", F.concat(F.lit("["), kind, F.lit("]"))).alias("title"), F.lit(0.85).alias("confidence"), F.lit(True).alias("boundary_verified"))
    return kept.unionByName(new)


def stitch_divisions(items: DataFrame, totals: DataFrame) -> DataFrame:
    """A gap-free division map. ``items``: bundle_id, page, division_type, title, running_header, mid_page, is_cover, ord; ``totals``: bundle_id, total.

    Per page the item with the longest clean title stays (the first wins ties); front matter is put at page 1 if
    nothing starts there. Flags: mid_page_start, cover_sheet, possible_overlap_split (the next division has the
    same type and starts within two pages).
    """
    pick = W.partitionBy("bundle_id", "page").orderBy(F.desc(F.length(clean(F.col("title")))), "ord")
    rows = items.withColumn("_r", F.row_number().over(pick)).where("_r = 1").drop("_r", "ord")
    bare = totals.select("bundle_id", F.lit(1).alias("page"), F.lit("RECITALS").alias("division_type"), F.lit("Front matter").alias("title"), F.lit(None).cast("string").alias("running_header"), F.lit(False).alias("mid_page"), F.lit(False).alias("is_cover"))
    rows = rows.unionByName(bare.join(rows.where("page = 1").select("bundle_id"), "bundle_id", "left_anti")).join(totals, "bundle_id")
    w = W.partitionBy("bundle_id").orderBy("page")
    split = (F.lead("division_type").over(w) == F.col("division_type")) & (F.lead("page").over(w) - F.col("page") <= 2)
    flags = F.array_compact(F.array(F.when(F.col("mid_page"), "mid_page_start"), F.when(F.col("is_cover"), "cover_sheet"), F.when(split, "possible_overlap_split")))
    number = F.row_number().over(w)
    return rows.select("bundle_id", F.format_string("DIV-%02d", number).alias("division_id"), "division_type", clean(F.col("title")).alias("title"), "running_header", F.col("page").alias("start_page"), F.coalesce(F.lead("page").over(w) - 1, F.col("total")).alias("end_page"), number.alias("position"), flags.alias("flags"))


def headers_conflict(a: Column, b: Column) -> Column:
    """Both there and neither contains the other."""
    x, y = F.lower(clean(a)), F.lower(clean(b))
    return (x != "") & (y != "") & ~F.contains(x, y) & ~F.contains(y, x)


def fold_tocs(divisions: DataFrame, toc: str = "INDEX_OR_TOC", foldable: list[str] = FOLDABLE) -> DataFrame:
    """Tables of contents become part of the division before them; ids are given anew.

    A TOC folds if the division kept before it has a foldable type and no conflicting header. A TOC that stands
    is itself the division before, of a type that does not fold, so later ones of the same run stand too: a
    running minimum over the run.
    """
    w = W.partitionBy("bundle_id").orderBy("start_page")
    is_toc = F.col("division_type") == toc
    rows = divisions.withColumn("_run", F.sum(F.when(is_toc, 0).otherwise(1)).over(w.rowsBetween(W.unboundedPreceding, 0)))
    run = W.partitionBy("bundle_id", "_run").orderBy("start_page")
    head = lambda c: F.first(F.when(~is_toc, F.struct(F.col(c).alias("v"))), ignorenulls=True).over(run.rowsBetween(W.unboundedPreceding, 0))["v"]
    can = F.coalesce(head("division_type").isin(*foldable) & ~headers_conflict(F.col("running_header"), head("running_header")), F.lit(False))
    rows = rows.withColumn("_can", F.when(is_toc, can.cast("int")).otherwise(1))
    rows = rows.withColumn("_folds", is_toc & (F.min("_can").over(run.rowsBetween(W.unboundedPreceding, 0)) == 1))
    rows = rows.withColumn("_group", F.sum(F.when(F.col("_folds"), 0).otherwise(1)).over(w.rowsBetween(W.unboundedPreceding, 0)))
    out = rows.groupBy("bundle_id", "_group").agg(F.min_by("division_type", "start_page").alias("division_type"), F.min_by("title", "start_page").alias("title"), F.min_by("running_header", "start_page").alias("running_header"), F.min("start_page").alias("start_page"), F.max("end_page").alias("end_page"), F.sum(F.col("_folds").cast("int")).alias("n_folded"))
    return out.withColumn("division_id", F.format_string("DIV-%02d", F.row_number().over(w))).drop("_group")


def collect_anchors(anchors: DataFrame, by: list[str]) -> DataFrame:
    """Anchors seen in several windows as one: by kind and marker the first page and the longest title, with ``ambiguous`` if pages differ."""
    key = F.concat_ws(":", "kind", F.coalesce(normalize_marker(F.col("marker")), norm_lower(F.col("title"))))
    rows = anchors.withColumn("anchor_key", key).withColumn("_t", clean(F.col("title")))
    return rows.groupBy(*by, "kind", "anchor_key").agg(F.min("page").alias("page"), F.min_by("marker", F.struct("page", "marker")).alias("marker"), F.max_by("_t", F.struct(F.length("_t"), "_t")).alias("title"), (F.countDistinct("page") > 1).alias("ambiguous"))


def leaf_level(n_sections: Column, n_clauses: Column, least: int = 2) -> Column:
    """Level of a division's leaves: section if there are enough and not fewer than clauses, else clause, section or whole."""
    return F.when((n_sections >= least) & (n_sections >= n_clauses), "section").when(n_clauses > 0, "clause").when(n_sections > 0, "section").otherwise("whole")


def main_clauses(anchors: DataFrame, by: list[str]) -> DataFrame:
    """Anchors of main clauses: markers ``5`` or ``(5)``; where a division has none, all of them."""
    plain = F.coalesce(normalize_marker(F.col("marker")), F.lit("")).rlike(r"^\(?\d+\)?$")
    rows = anchors.withColumn("_p", plain).withColumn("_any", F.max("_p").over(W.partitionBy(*by)))
    return rows.where("_p OR NOT _any").drop("_p", "_any")


def build_units(anchors: DataFrame, divisions: DataFrame) -> DataFrame:
    """Units of each division: its anchors, each to the page before the next (or its own page, shared), a preamble before
    the first, or the whole division where there is no anchor. Keys: bundle_id, division_id."""
    by = ["bundle_id", "division_id"]
    d = divisions.select(*by, "start_page", "end_page")
    w = W.partitionBy(*by).orderBy("page", "anchor_key")
    a = anchors.join(d, by)
    following = F.lead("page").over(w)
    end = F.when(following.isNull(), F.col("end_page")).otherwise(F.greatest(F.col("page"), following - 1))
    units = a.select(*by, "kind", "marker", "title", F.col("page").alias("page_start"), end.alias("page_end"), F.coalesce(following == F.col("page"), F.lit(False)).alias("shares_start_page"))
    first = a.groupBy(*by).agg(F.min("page").alias("_first"))
    none = F.lit(None).cast("string")
    lead_in = d.join(first, by, "left")
    front = lead_in.where("_first > start_page").select(*by, F.lit("preamble").alias("kind"), none.alias("marker"), none.alias("title"), F.col("start_page").alias("page_start"), (F.col("_first") - 1).alias("page_end"), F.lit(False).alias("shares_start_page"))
    whole = lead_in.where("_first IS NULL").select(*by, F.lit("whole").alias("kind"), none.alias("marker"), none.alias("title"), F.col("start_page").alias("page_start"), F.col("end_page").alias("page_end"), F.lit(False).alias("shares_start_page"))
    rows = units.unionByName(front).unionByName(whole)
    order = W.partitionBy(*by).orderBy("page_start", F.col("marker").asc_nulls_first())
    return rows.withColumn("unit_id", F.format_string("%s-U%02d", "division_id", F.row_number().over(order)))


def insert_recovered(units: DataFrame, recovered: DataFrame) -> DataFrame:
    """Recovered units put in after the unit named by ``after_unit``, clamped to the pages around, and ends formed anew.

    ``recovered``: bundle_id, division_id, after_unit, marker, title, page. Ids are those of the unit before with an
    ``R`` for each one inserted there.
    """
    by = ["bundle_id", "division_id"]
    w = W.partitionBy(*by).orderBy("page_start", "unit_id")
    base = units.withColumn("_next", F.lead("page_start").over(w)).withColumn("_end", F.max("page_end").over(W.partitionBy(*by)))
    r = recovered.withColumn("_k", F.row_number().over(W.partitionBy(*by, "after_unit").orderBy("page", "marker")))
    r = r.join(base.select(*by, F.col("unit_id").alias("after_unit"), F.col("page_start").alias("_from"), "_next", "_end"), [*by, "after_unit"])
    page = F.greatest("_from", F.least("page", F.coalesce("_next", "_end")))
    new = r.select(*by, F.lit("clause").alias("kind"), "marker", "title", page.alias("page_start"), F.lit(False).alias("shares_start_page"), F.concat("after_unit", F.expr("repeat('R', _k)")).alias("unit_id"))
    rows = base.select(*new.columns).unionByName(new).join(base.groupBy(*by).agg(F.max("_end").alias("_end")), by)
    following = F.lead("page_start").over(w)
    return rows.withColumn("page_end", F.when(following.isNull(), F.col("_end")).otherwise(F.greatest(F.col("page_start"), following - 1))).drop("_end")


def page_contexts(units: DataFrame) -> DataFrame:
    """A one-line hint per page of the units that cover it, in order: ``(bundle_id, page, hint)``."""
    line = F.concat_ws(" ", "kind", "marker", F.when(F.col("title").isNotNull(), F.concat(F.lit("'"), F.substring(clean(F.col("title")), 1, 60), F.lit("'"))))
    rows = units.select("bundle_id", F.explode(F.sequence("page_start", "page_end")).alias("page"), F.struct("page_start", "unit_id", line.alias("line")).alias("u"))
    return rows.groupBy("bundle_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list("u")), lambda u: u["line"]), "; ").alias("hint"))


def needs_tree(doc_type: Column, n_candidates: Column) -> Column:
    """Flat types need no tree; some need two candidates, the others one."""
    return F.when(doc_type.isin(*FLAT), False).when(doc_type.isin(*TREE_IF_STRUCTURED), n_candidates >= 2).otherwise(n_candidates >= 1)


def template_key(number: Column, title: Column, text: Column) -> Column:
    """Key of a candidate in a template: its marker and the start of its title or text."""
    return F.concat(F.coalesce(normalize_marker(number), F.lit("")), F.lit("|"), F.substring(norm_lower(F.coalesce(title, text)), 1, 60))


def template_matches(candidates: DataFrame, templates: DataFrame, least: float = 0.9) -> DataFrame:
    """The best template per segment and the share of candidate keys that it has. ``candidates``: segment_key, doc_type, key; ``templates``: template_id, doc_type, key."""
    keys = candidates.select("segment_key", "doc_type", "key")
    size = keys.groupBy("segment_key").agg(F.count("*").alias("_n"))
    hits = keys.join(templates.select("template_id", "doc_type", "key").distinct(), ["doc_type", "key"]).groupBy("segment_key", "template_id").agg(F.count("*").alias("hits"))
    best = hits.withColumn("_r", F.row_number().over(W.partitionBy("segment_key").orderBy(F.desc("hits"), "template_id"))).where("_r = 1")
    return best.join(size, "segment_key").select("segment_key", "template_id", (F.col("hits") / F.col("_n")).alias("coverage")).withColumn("reused", F.col("coverage") >= least)


def template_digest(candidates: DataFrame, least: int = 15) -> DataFrame:
    """Segments worth keeping as templates: at least ``least`` distinct keys; the id is the start of the hash of the sorted keys."""
    rows = candidates.groupBy("segment_key", "doc_type").agg(F.array_sort(F.collect_set("key")).alias("keys"))
    return rows.where(F.size("keys") >= least).select("segment_key", "doc_type", F.size("keys").alias("n_entries"), F.concat("doc_type", F.lit("_"), F.substring(F.sha2(F.to_json("keys"), 256), 1, 16)).alias("template_id"))


def decision_chunks(candidates: DataFrame, by: list[str], order: list[str], size: int = 300, context: int = 25) -> DataFrame:
    """Chunks of ``size`` undecided candidates (column ``decided``), and the first row of the context that goes before each."""
    w = W.partitionBy(*by).orderBy(*order)
    rows = candidates.withColumn("pos", F.row_number().over(w))
    undecided = F.sum(F.when(F.col("decided"), 0).otherwise(1)).over(w.rowsBetween(W.unboundedPreceding, 0))
    rows = rows.withColumn("chunk", F.floor(F.greatest(undecided - 1, F.lit(0)) / size).cast("int"))
    begin = F.min("pos").over(W.partitionBy(*by, "chunk"))
    return rows.withColumn("context_from", F.greatest(F.lit(1), begin - context))


def attachment_order(idx: Column) -> Column:
    """Numeric index of an attachment, or null."""
    i = attachment_index(idx)
    return F.when(i.rlike(r"^\d+$"), i.cast("int"))
