"""Queries of the structural operators over the driver's tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quirework.functions import dates, numbering, text
from quirework.operators import assemble, boundaries, checks, merges, ordered, reader, recovery, tree
from quirework.plans import reference_sql
from quirework.runtime import materialize, table
from quirework.sinks import files as sinks

BODY = ["clause", "paragraph", "recital", "table", "heading", "handwritten"]


# ---- tables as the operators take them; rows sent twice come once ----


def pages(s: SparkSession, d: str) -> DataFrame:
    p = table(s, d, "pages").select("page_id", "bundle_id", "page", "page_type", "is_document_start", "document_title", "printed_label", "running_header", "first_continues", "status", "ink_ratio", "cross_references", "contract_documents_list", "call_key")
    return p.dropDuplicates(["page_id"]).withColumn("duplicate_of", F.lit(None).cast("int"))


def blocks(s: SparkSession, d: str) -> DataFrame:
    b = table(s, d, "blocks").select("block_key", "bundle_id", "page", "idx", "block_id", "kind", "number", "title", "text", "legibility", "source", "call_key")
    return b.dropDuplicates(["block_key"])


def clauses(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "clauses").drop("loaded_at").dropDuplicates(["clause_id"])


def _started(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The page headers and the starts among them, written once: windows over bundles of any size read them several times."""
    p = materialize(pages(s, d))
    return p, materialize(boundaries.heuristic_starts(p))


def starts(s: SparkSession, d: str) -> DataFrame:
    return boundaries.heuristic_starts(materialize(pages(s, d)))


def parts(s: SparkSession, d: str) -> DataFrame:
    p, begin = _started(s, d)
    return boundaries.segments(begin, p)


def _segment_pages(s: SparkSession, d: str) -> DataFrame:
    """One row per page with its segment."""
    return checks.pages_of_ranges(parts(s, d), ["bundle_id", "segment_id", "doc_type", "start_page"], "start_page", "end_page")


def _numbered(s: SparkSession, d: str) -> DataFrame:
    """Structural blocks with the segment that they stand in."""
    return blocks(s, d).where("kind IN ('heading', 'clause')").join(_segment_pages(s, d), ["bundle_id", "page"])


# ---- queries ----


def page_windows(s: SparkSession, d: str) -> DataFrame:
    n = pages(s, d).groupBy("bundle_id").agg(F.min("page").alias("lo"), F.max("page").alias("hi"))
    return n.select("bundle_id", F.posexplode(boundaries.windows_in(F.col("lo"), F.col("hi"), 15, 14)).alias("window_no", "w")).select("bundle_id", "window_no", "w.lo", "w.hi")


def segmentation_windows(s: SparkSession, d: str) -> DataFrame:
    n = pages(s, d).groupBy("bundle_id").agg(F.min("page").alias("first"), F.max("page").alias("last"))
    return n.select("bundle_id", "first", "last", F.explode(boundaries.segmentation_windows(F.col("first"), F.col("last"))).alias("w")).select("bundle_id", "first", "last", "w.lo", "w.hi")


def best_start_per_page(s: SparkSession, d: str) -> DataFrame:
    w = segmentation_windows(s, d)
    p = pages(s, d).where("is_document_start").select("bundle_id", F.col("page").alias("start_page"), F.when(F.col("first_continues"), 0.6).otherwise(0.95).alias("confidence"), F.col("page_id").alias("ord"))
    prop = p.join(w, "bundle_id").where(boundaries.within_edges(F.col("start_page"), F.col("lo"), F.col("hi"), F.col("first"), F.col("last"))).select("bundle_id", "start_page", "confidence", F.col("lo").alias("window_lo"), "ord")
    return boundaries.best_starts(prop)


def blank_start_shift(s: SparkSession, d: str) -> DataFrame:
    p = materialize(pages(s, d))
    begin = p.where("is_document_start OR status = 'blank'").select("bundle_id", F.col("page").alias("start_page"), "page_type")
    return boundaries.shift_blank_starts(begin, p)


def prev_content_page(s: SparkSession, d: str) -> DataFrame:
    return boundaries.prev_content(materialize(pages(s, d)), ["page_type"]).select("bundle_id", "page", "prev_page", "prev_page_type")


def heuristic_starts(s: SparkSession, d: str) -> DataFrame:
    return starts(s, d).select("bundle_id", "start_page", "doc_type", "title", "evidence")


def segment_ranges(s: SparkSession, d: str) -> DataFrame:
    return parts(s, d).select("bundle_id", "segment_id", "doc_type", "start_page", "end_page")


def coverage_violations(s: SparkSession, d: str) -> DataFrame:
    """Clause ranges of each division against the pages they span: clauses share pages."""
    c = clauses(s, d).select("bundle_id", "contract_id", "division_id", "unit_id", F.col("page_start").alias("start_page"), F.col("page_end").alias("end_page")).distinct()
    by = ["bundle_id", "contract_id", "division_id"]
    span = c.select(*by, F.explode(F.array("start_page", "end_page")).alias("page"))
    return boundaries.coverage_violations(c, span, shared=True, by=by).groupBy(*by).agg(F.count("*").alias("n_violations"))


def boundary_checks(s: SparkSession, d: str) -> DataFrame:
    p, begin = _started(s, d)
    return boundaries.boundary_checks(begin, p).select("bundle_id", "page", "against_page", "listed", "rank", "checked")


def boundary_verdicts(s: SparkSession, d: str) -> DataFrame:
    """Verdicts taken from the pages themselves: a page whose first block continues the page before starts nothing."""
    p, begin = _started(s, d)
    none = F.lit(None).cast("string")
    v = boundaries.boundary_checks(begin, p).where("checked").join(p.select("bundle_id", "page", "first_continues"), ["bundle_id", "page"])
    v = v.select("bundle_id", "page", F.when(F.col("first_continues"), "continuation").when(F.col("against_page").isNull(), "unclear").otherwise("new_document").alias("verdict"), none.alias("new_type"), none.alias("new_title"))
    return boundaries.apply_verdicts(begin, v, p).select("bundle_id", "start_page", "doc_type", "boundary_verified")


def division_map(s: SparkSession, d: str) -> DataFrame:
    p = pages(s, d)
    items = p.where("is_document_start AND document_title IS NOT NULL").select("bundle_id", "page", F.col("page_type").alias("division_type"), F.col("document_title").alias("title"), "running_header", F.col("first_continues").alias("mid_page"), (F.col("page_type") == "stamp_paper").alias("is_cover"), F.col("page_id").alias("ord"))
    totals = p.groupBy("bundle_id").agg(F.max("page").alias("total"))
    out = boundaries.stitch_divisions(items, totals)
    return out.withColumn("flags", F.array_join("flags", ","))


def toc_fold(s: SparkSession, d: str) -> DataFrame:
    """Schedules fold like tables of contents here: the pages have no index pages."""
    g = parts(s, d).join(pages(s, d).select("bundle_id", F.col("page").alias("start_page"), "running_header"), ["bundle_id", "start_page"])
    g = g.select("bundle_id", F.upper("doc_type").alias("division_type"), "title", "running_header", "start_page", "end_page")
    return boundaries.fold_tocs(g, toc="SCHEDULE", foldable=["GENERAL_CONDITIONS", "SPECIAL_CONDITIONS", "TECHNICAL_SPECIFICATION", "ANNEXURE"]).select("bundle_id", "division_id", "division_type", "start_page", "end_page", F.col("n_folded").cast("long").alias("n_folded"))


def _anchors(s: SparkSession, d: str) -> DataFrame:
    a = _numbered(s, d).where("kind = 'clause' AND number IS NOT NULL").select("bundle_id", F.col("segment_id").alias("division_id"), F.lit("clause").alias("kind"), F.col("number").alias("marker"), F.coalesce("title", F.lit("")).alias("title"), "page")
    return boundaries.collect_anchors(a, ["bundle_id", "division_id"])


def anchor_collect(s: SparkSession, d: str) -> DataFrame:
    return _anchors(s, d).select("bundle_id", "division_id", "anchor_key", "page", "title", "ambiguous")


def unit_ranges(s: SparkSession, d: str) -> DataFrame:
    divs = parts(s, d).withColumnRenamed("segment_id", "division_id")
    return boundaries.build_units(boundaries.main_clauses(_anchors(s, d), ["bundle_id", "division_id"]), divs).select("bundle_id", "division_id", "unit_id", "kind", "marker", "page_start", "page_end", "shares_start_page")


def leaf_levels(s: SparkSession, d: str) -> DataFrame:
    c = clauses(s, d).groupBy("contract_id", "division_id").agg(F.sum((F.col("kind") == "section").cast("int")).alias("n_sections"), F.sum((F.col("kind") == "clause").cast("int")).alias("n_clauses"))
    return c.select("contract_id", "division_id", boundaries.leaf_level(F.col("n_sections"), F.col("n_clauses")).alias("level"))


def page_contexts(s: SparkSession, d: str) -> DataFrame:
    c = clauses(s, d).where("page_end >= page_start").select("bundle_id", "kind", "marker", "title", "page_start", "page_end", F.col("clause_id").cast("string").alias("unit_id"))
    return boundaries.page_contexts(c)


def page_to_clause(s: SparkSession, d: str) -> DataFrame:
    r = checks.pages_of_ranges(clauses(s, d), ["bundle_id", "clause_id"], "page_start", "page_end")
    return pages(s, d).select("page_id", "bundle_id", "page").join(r, ["bundle_id", "page"]).groupBy("page_id").agg(F.count("*").alias("n_clauses"), F.min("clause_id").alias("first_clause"))


def template_coverage(s: SparkSession, d: str) -> DataFrame:
    """Every segment against the other segments of its type as templates: the coverage of the best one."""
    n = _numbered(s, d).select(F.concat_ws("/", "bundle_id", "segment_id").alias("segment_key"), "doc_type", boundaries.template_key(F.col("number"), F.col("title"), F.col("text")).alias("key"))
    t = boundaries.template_digest(n.distinct()).select("segment_key", "template_id")
    tpl = n.distinct().join(t, "segment_key").select("template_id", "doc_type", "key").distinct()
    return boundaries.template_matches(n.where("length(key) > 1"), tpl)


def sibling_gaps(s: SparkSession, d: str) -> DataFrame:
    c = clauses(s, d).where("kind = 'clause'")
    return ordered.sibling_gaps(c, ["contract_id", "division_id"], ["seq", "clause_id"], "marker", 4)


def subclause_gaps(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "subclauses").select("subclause_id", "clause_id", "marker", "seq").dropDuplicates(["subclause_id"])
    return ordered.sibling_gaps(c, ["clause_id"], ["seq", "subclause_id"], "marker", 8)


def label_continuity(s: SparkSession, d: str) -> DataFrame:
    seg = checks.pages_of_ranges(parts(s, d), ["bundle_id", "segment_id"], "start_page", "end_page")
    return ordered.label_findings(pages(s, d).where("status NOT IN ('blank', 'failed')").join(seg, ["bundle_id", "page"]), ["bundle_id", "segment_id"])


def attachment_series_gap(s: SparkSession, d: str) -> DataFrame:
    found = _keys(s, d)[1]
    return ordered.series_gaps(found.select("bundle_id", "kind", boundaries.attachment_order(F.col("idx")).alias("idx")), ["bundle_id"])


def _keys(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    p = pages(s, d)
    refs = p.select("bundle_id", "page", F.explode("cross_references").alias("r")).withColumn("k", numbering.attachment_key(F.col("r"))).where("k IS NOT NULL").select("bundle_id", "page", "k.kind", "k.idx")
    found = checks.found_attachments(clauses(s, d).select("bundle_id", F.col("page_start").alias("page"), "marker"), ["bundle_id"], "marker")
    return refs, found


def reference_findings(s: SparkSession, d: str) -> DataFrame:
    refs, found = _keys(s, d)
    return checks.reference_findings(refs, found, ["bundle_id"]).withColumn("pages", F.array_join(F.transform("pages", lambda x: x.cast("string")), ","))


def listed_documents_missing(s: SparkSession, d: str) -> DataFrame:
    listed = pages(s, d).select("bundle_id", F.explode("contract_documents_list").alias("name"))
    docs = starts(s, d).select("bundle_id", "doc_type", "title")
    return checks.listed_missing(listed, docs, ["bundle_id"])


def index_entries_missing(s: SparkSession, d: str) -> DataFrame:
    entries = clauses(s, d).where("title IS NOT NULL").select("contract_id", checks.clean_entry(F.col("title")).alias("entry"))
    titles = blocks(s, d).where("kind = 'heading'").select("bundle_id", text.clean(F.col("text")).alias("title")).distinct()
    c = clauses(s, d).select("contract_id", "bundle_id").distinct()
    return checks.index_missing(entries.join(c, "contract_id").select("bundle_id", "entry"), titles, ["bundle_id"])


def _tree(n: DataFrame) -> DataFrame:
    n = ordered.fallback_levels(n, ["bundle_id", "segment_id"], ["page", "idx"]).withColumnRenamed("level", "wanted")
    return tree.tree(n, ["bundle_id", "segment_id"], ["page", "idx"], "wanted")


def clause_tree(s: SparkSession, d: str) -> DataFrame:
    return _tree(_numbered(s, d))


def tree_paths(s: SparkSession, d: str) -> DataFrame:
    return clause_tree(s, d).select("bundle_id", "segment_id", "pos", "wanted", "level", "parent_pos", "ordinal", F.array_join(F.transform("path", lambda x: x.cast("string")), ".").alias("path"))


def sibling_groups(s: SparkSession, d: str) -> DataFrame:
    n = ordered.fallback_levels(_numbered(s, d), ["bundle_id", "segment_id"], ["page", "idx"])
    return ordered.sibling_groups(n, ["bundle_id", "segment_id"], ["page", "idx"], "level", 5).select("bundle_id", "segment_id", "pos", "level", "group_key")


def block_owner(s: SparkSession, d: str) -> DataFrame:
    b = blocks(s, d).where(F.col("kind").isin(*BODY)).join(_segment_pages(s, d), ["bundle_id", "page"])
    return tree.owners(b, ["bundle_id", "segment_id"], ["page", "idx"], F.col("kind").isin("heading", "clause"))


def owner_sizes(s: SparkSession, d: str) -> DataFrame:
    return block_owner(s, d).groupBy("bundle_id", "segment_id", "owner_pos").agg(F.count("*").alias("n_blocks"), F.max("page").alias("last_page"))


def page_end_rollup(s: SparkSession, d: str) -> DataFrame:
    """Blocks are placed once, without their texts; nodes and what they own come from the same rows."""
    mark = F.coalesce("number", F.when(F.col("kind").isin("heading", "clause"), numbering.leading_marker(F.col("text"))))
    b = blocks(s, d).where(F.col("kind").isin(*BODY)).select("bundle_id", "page", "idx", "kind", mark.alias("number"), F.lit(None).cast("string").alias("text"))
    by = ["bundle_id", "segment_id"]
    placed = materialize(tree.owners(b.join(_segment_pages(s, d), ["bundle_id", "page"]), by, ["page", "idx"], F.col("kind").isin("heading", "clause")))
    own = placed.groupBy(*by, F.col("owner_pos").alias("pos")).agg(F.max("page").alias("last_page"))
    n = _tree(placed.where("kind IN ('heading', 'clause')")).select(*by, "pos", "level").join(own, [*by, "pos"])
    return tree.page_ends(n, by, "last_page").select(*by, "pos", "page_end")


def assembled_nodes(s: SparkSession, d: str) -> DataFrame:
    first = F.row_number().over(W.partitionBy("bundle_id", "page").orderBy("idx")) == 1
    b = block_owner(s, d).withColumn("_f", first).join(pages(s, d).select("bundle_id", "page", "first_continues"), ["bundle_id", "page"])
    b = b.withColumn("continues", F.coalesce(F.col("_f") & F.col("first_continues"), F.lit(False)))
    return assemble.node_texts(b, ["bundle_id", "segment_id", "owner_pos"], ["page", "idx"])


def plain_texts(s: SparkSession, d: str) -> DataFrame:
    """Text of each segment; a segment is one document, however large its bundle is."""
    seg = checks.pages_of_ranges(parts(s, d), ["bundle_id", "segment_id"], "start_page", "end_page")
    b = blocks(s, d).where("kind IN ('clause', 'paragraph', 'recital')").join(pages(s, d).select("bundle_id", "page", "first_continues"), ["bundle_id", "page"]).join(seg, ["bundle_id", "page"])
    first = F.row_number().over(W.partitionBy("bundle_id", "page").orderBy("idx")) == 1
    out = assemble.plain_texts(b.withColumn("continues", F.coalesce(first & F.col("first_continues"), F.lit(False))), ["bundle_id", "segment_id"], ["page", "idx"], "continues")
    return out.select("bundle_id", "segment_id", F.length("text").alias("n_chars"), F.md5("text").alias("digest"))


def full_texts(s: SparkSession, d: str) -> DataFrame:
    n = clause_tree(s, d).withColumn("head", F.when(F.col("kind") == "heading", text.clean(F.col("text"))).otherwise("")).withColumn("own", F.when(F.col("kind") == "clause", F.coalesce("text", F.lit(""))).otherwise(""))
    return tree.full_texts(n, ["bundle_id", "segment_id"], "head", "own").select("bundle_id", "segment_id", "pos", F.md5("full_text").alias("digest"))


def path_titles(s: SparkSession, d: str) -> DataFrame:
    n = clause_tree(s, d).withColumn("label", tree.node_label(F.col("number"), F.col("title"), F.col("text")))
    return tree.path_titles(n, ["bundle_id", "segment_id"], "label").select("bundle_id", "segment_id", "pos", "path_titles")


def toc_lines(s: SparkSession, d: str) -> DataFrame:
    n = clause_tree(s, d).withColumn("label", tree.node_label(F.col("number"), F.col("title"), F.col("text"))).withColumn("page_start", F.col("page"))
    return sinks.toc(n, ["bundle_id", "segment_id"], "label")


def nested_trees(s: SparkSession, d: str) -> DataFrame:
    return sinks.nested_tree(clause_tree(s, d), ["bundle_id", "segment_id"], ["block_id", "number", "title", "level"])


def unit_texts(s: SparkSession, d: str) -> DataFrame:
    """Texts of the clauses of each division from the blocks of the pages that the division spans."""
    by = ["bundle_id", "contract_id", "division_id"]
    c = clauses(s, d).where("page_end >= page_start")
    u = c.select(*by, F.col("clause_id").cast("string").alias("unit_id"), "kind", "marker", "title", "page_start", "page_end")
    span = c.groupBy(*by).agg(F.min("page_start").alias("lo"), F.max("page_end").alias("hi"))
    b = blocks(s, d).join(pages(s, d).select("bundle_id", "page", "first_continues"), ["bundle_id", "page"]).join(checks.pages_of_ranges(span, by, "lo", "hi"), ["bundle_id", "page"])
    b = b.select(*by, "page", "idx", "kind", F.col("number").alias("marker"), "text", (F.coalesce("first_continues", F.lit(False)) & (F.col("idx") == 0)).alias("continues"))
    return assemble.unit_texts(u, b, by)


def duplicate_page_pairs(s: SparkSession, d: str) -> DataFrame:
    body = blocks(s, d).where(~F.col("kind").isin("header", "footer", "page_number", "stamp_or_seal", "signature_block") & F.col("text").isNotNull())
    t = body.groupBy("bundle_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "text"))), lambda x: x["text"]), "\n").alias("text"))
    return checks.duplicate_pairs(t, ["bundle_id"], "page")


def duplicate_pages(s: SparkSession, d: str) -> DataFrame:
    return checks.duplicate_of(materialize(duplicate_page_pairs(s, d)), ["bundle_id"])


def degenerate_texts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", text.looks_degenerate(F.col("text")).alias("degenerate")).groupBy("degenerate").agg(F.count("*").alias("n"))


def card_lines(s: SparkSession, d: str) -> DataFrame:
    b = blocks(s, d).where(~F.col("kind").isin("header", "footer", "page_number") & F.col("text").isNotNull())
    per = b.groupBy("bundle_id", "page").agg(F.min_by("text", "idx").alias("first"), F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("kind").isin("heading", "clause"), F.struct("idx", text.quoted(F.col("text"), 50).alias("t"))))), lambda x: x["t"]), "; ").alias("heads"))
    p = pages(s, d).join(per, ["bundle_id", "page"], "left")
    q = lambda c, n: text.quoted(F.col(c), n)
    refs = F.array_join(F.transform(F.slice(F.coalesce("cross_references", F.array()), 1, 5), lambda x: text.quoted(x, 40)), ", ")
    yn = lambda c: F.when(F.col(c), "Y").otherwise("N")
    line = F.format_string('[p%d] type=%s start=%s label="%s" hdr="%s" cont=%s title="%s" first="%s" heads=%s refs=%s', "page", "page_type", yn("is_document_start"), q("printed_label", 20), q("running_header", 50), yn("first_continues"), q("document_title", 90), q("first", 90), F.substring(F.coalesce("heads", F.lit("")), 1, 260), refs)
    return p.select("page_id", F.when(F.col("status") == "blank", F.format_string("[p%d] BLANK", "page")).when(F.col("status") == "failed", F.format_string("[p%d] UNREADABLE", "page")).otherwise(line).alias("card"))


def marker_keys(s: SparkSession, d: str) -> DataFrame:
    m = table(s, d, "clauses").select("marker").distinct()
    c = F.col("marker")
    return m.select("marker", numbering.normalize_marker(c).alias("key"), numbering.depth_hint(c).alias("hint"))


def label_keys(s: SparkSession, d: str) -> DataFrame:
    m = table(s, d, "pages").select("printed_label").distinct()
    return m.withColumn("l", numbering.parse_label(F.col("printed_label"))).select("printed_label", "l.prefix", "l.value")


def attachment_keys(s: SparkSession, d: str) -> DataFrame:
    m = table(s, d, "pages").select(F.explode("cross_references").alias("reference")).distinct()
    return m.withColumn("k", numbering.attachment_key(F.col("reference"))).select("reference", "k.kind", "k.idx")


def snippet_dates(s: SparkSession, d: str) -> DataFrame:
    """The first date in each decision against its column."""
    r = table(s, d, "documents").select("doc_id", F.date_format("decided_on", "yyyy-MM-dd").alias("iso_value"), dates.parse_snippet(F.col("text")).alias("parsed"))
    return r.withColumn("agrees", F.col("iso_value") == F.col("parsed"))


def date_merge(s: SparkSession, d: str) -> DataFrame:
    """Decision dates of the versions of a docket; the court portal governs like an agreement, the law reports like a letter."""
    r = table(s, d, "documents").where("docket IS NOT NULL").select("docket", F.date_format("decided_on", "yyyy-MM-dd").alias("iso_value"), F.when(F.col("source") == "court_portal", "CONTRACT_AGREEMENT").when(F.col("source") == "law_reports", "LETTER_OF_AWARD").alias("division_type"))
    return merges.date_merge(r, ["docket"])


def display_names(s: SparkSession, d: str) -> DataFrame:
    p = table(s, d, "parties").where("name IS NOT NULL").withColumn("name_key", dates.canonical_name(F.col("name"))).where("name_key <> ''")
    return merges.display_names(p, ["name_key"], "name")


def pick_parties(s: SparkSession, d: str) -> DataFrame:
    p = table(s, d, "parties").dropDuplicates(["party_id"]).withColumn("division_type", F.when(F.col("party_role").isin("Employer", "Contractor"), "CONTRACT_AGREEMENT").otherwise("LETTER_OF_AWARD"))
    return merges.pick_parties(p, ["bundle_id"], "contract_id", ["party_id"]).select("bundle_id", "side", "party_id", "name")


def page_status(s: SparkSession, d: str) -> DataFrame:
    return merges.counts(pages(s, d), ["status", "page_type"])


def run_status(s: SparkSession, d: str) -> DataFrame:
    return merges.run_status(pages(s, d), clauses(s, d), ["bundle_id"])


PRICES = [("reader-a", 0.50, 3.00), ("reader-b", 0.25, 1.50), ("reader-lite", 0.25, 1.50), ("reader-alt", 2.00, 12.00)]


def cost_rollup(s: SparkSession, d: str) -> DataFrame:
    prices = s.createDataFrame(PRICES, "model string, usd_in double, usd_out double")
    return merges.cost_rollup(reader.calls(table(s, d, "replay")), prices, ["model", "task"])


def call_outcomes(s: SparkSession, d: str) -> DataFrame:
    return reader.outcomes(table(s, d, "replay")).groupBy("task", "outcome").agg(F.count("*").alias("n"), F.sum(F.coalesce(F.col("parsed.blocks"), F.lit(0)).cast("long")).alias("n_blocks"))


def ladder_first_success(s: SparkSession, d: str) -> DataFrame:
    """Calls of a bundle's pages as rungs: a whole read before half reads; the first that is usable."""
    c = reader.outcomes(table(s, d, "replay"))
    p = pages(s, d).select("bundle_id", "page", "call_key").join(c, F.col("call_key") == F.col("cache_key"))
    rung = F.when(F.col("task") == "page_read", 0).when(F.col("task") == "page_read_half", 1).otherwise(2)
    mode = F.when(F.col("task") == "page_read", "full").otherwise("half")
    return ordered.ladder(p.withColumn("rung", rung).withColumn("mode", mode), ["bundle_id", "page"], "rung", "mode", "outcome", ["cache_key"]).select("bundle_id", "page", "cache_key", "rung", "n_attempts")


def page_diagnosis(s: SparkSession, d: str) -> DataFrame:
    n = blocks(s, d).groupBy("bundle_id", "page").agg(F.count("*").alias("n_blocks"), F.max(text.looks_degenerate(F.col("text"))).alias("degenerate"))
    c = reader.outcomes(table(s, d, "replay")).select("cache_key", "outcome")
    p = pages(s, d).join(n, ["bundle_id", "page"], "left").join(c, F.col("call_key") == F.col("cache_key"), "left").na.fill(0, ["n_blocks"]).na.fill(False, ["degenerate"])
    return reader.page_diagnosis(p).groupBy("diagnosis").agg(F.count("*").alias("n"))


def worst_legibility(s: SparkSession, d: str) -> DataFrame:
    return merges.worst_legibility(blocks(s, d), ["bundle_id", "page"])


def text_budget(s: SparkSession, d: str) -> DataFrame:
    c = clauses(s, d).where("text IS NOT NULL").select("bundle_id", "clause_id", "page_start", "text")
    return ordered.text_budget(c, ["bundle_id"], ["page_start", "clause_id"], F.length("text"), 90_000).select("bundle_id", "clause_id", "running")


def clause_projection(s: SparkSession, d: str) -> DataFrame:
    """Flat clauses: no preambles, whole divisions only near the front, nothing empty."""
    c = clauses(s, d).where("kind <> 'preamble' AND NOT (kind = 'whole' AND coalesce(page_start, 1) > 5) AND trim(coalesce(text, '')) <> ''")
    return c.select("clause_id", "contract_id", text.clean(F.col("marker")).alias("marker"), text.is_heading(F.col("text")).alias("heading_only"), F.length("text").alias("n_chars"))


def date_candidates(s: SparkSession, d: str) -> DataFrame:
    """Clauses that state a date near an anchor term."""
    c = clauses(s, d).where(F.col("text").rlike(dates.TERMS) & F.col("text").rlike(dates.LITERAL))
    return c.select("clause_id", dates.near_hits(F.col("text")).alias("hits")).where("hits > 0")


def second_reads(s: SparkSession, d: str) -> DataFrame:
    """Structural blocks of the first reader against those found by hunts and arbitration on the same page."""
    b = blocks(s, d).where("kind IN ('heading', 'clause')")
    first = b.where("source = 'read'").select("bundle_id", "page", F.col("idx").alias("pos"), F.col("number").alias("marker"), "text")
    second = b.where("source <> 'read'").select("bundle_id", "page", F.col("idx").alias("pos"), F.col("number").alias("marker"), "text")
    return checks.aligned(first, second, "bundle_id").groupBy("outcome").agg(F.count("*").alias("n"))


def follow_markers(s: SparkSession, d: str) -> DataFrame:
    c = clauses(s, d).select(F.concat_ws("/", F.col("contract_id").cast("string"), "division_id").alias("division_id"), F.col("clause_id").cast("string").alias("unit_id"), F.regexp_extract("marker", r"^\s*(\d+)\.?\s*$", 1).alias("plain"), "page_start", "page_end", "seq", "marker")
    b = c.select("division_id", "unit_id", "marker", F.col("page_start").alias("page"), "seq")
    units = c.where("plain <> ''").select("division_id", "unit_id", "plain", "page_start", "page_end")
    return tree.follow_markers(b, ["division_id"], ["seq", "unit_id"], numbering.normalize_marker(F.col("marker")), "plain", "page_start", "page_end", units).groupBy((F.col("unit_id") != F.col("new_unit_id")).alias("moved")).agg(F.count("*").alias("n"))


def candidate_lines(s: SparkSession, d: str) -> DataFrame:
    n = _numbered(s, d)
    return n.select("block_key", recovery.candidate_line(F.col("block_id"), F.col("page"), F.col("kind"), F.col("number"), F.col("text")).alias("line"))


def recovered_headings(s: SparkSession, d: str) -> DataFrame:
    """Headings of the hunts put into the first read of their pages."""
    b = blocks(s, d).select("bundle_id", "page", "idx", "kind", "text", "source", F.lit(None).cast("int").alias("y")).where("text IS NOT NULL")
    lines = b.where("kind = 'heading' AND source = 'hunt'").select("bundle_id", "page", F.col("idx").alias("ord"), "text", "y")
    first = b.where("source = 'read'").join(lines.select("bundle_id", "page").distinct(), ["bundle_id", "page"])
    return recovery.put_headings(first.select("bundle_id", "page", "idx", "kind", "text", "y"), lines, ["bundle_id", "page"]).select("bundle_id", "page", "idx", "kind", "text", "how")


def date_sources(s: SparkSession, d: str) -> DataFrame:
    u = clauses(s, d).select("bundle_id", F.col("clause_id").alias("unit_id"), "title", "marker", "text", "page_start")
    div = parts(s, d).select("bundle_id", F.upper("doc_type").alias("division_type"), "start_page", "end_page")
    return recovery.date_sources(u, div, ["bundle_id"])


def review_queue(s: SparkSession, d: str) -> DataFrame:
    """All findings of the deterministic checks as one queue."""
    refs, found = _keys(s, d)
    one = lambda c: F.array(F.col(c))
    labels = ordered.label_findings(pages(s, d).where("status NOT IN ('blank', 'failed')").join(checks.pages_of_ranges(parts(s, d), ["bundle_id", "segment_id"], "start_page", "end_page"), ["bundle_id", "page"]), ["bundle_id", "segment_id"]).withColumn("pages", one("page"))
    ref = checks.reference_findings(refs, found, ["bundle_id"])
    none = F.expr("cast(array() as array<int>)")
    gaps = ordered.sibling_gaps(clauses(s, d).where("kind = 'clause'"), ["bundle_id", "contract_id", "division_id"], ["seq", "clause_id"], "marker", 4).withColumn("pages", none)
    series = attachment_series_gap(s, d).withColumn("pages", none)
    listed = listed_documents_missing(s, d).withColumn("pages", none)
    q = sinks.review(
        (labels.where("code = 'label_jump'"), "label_jump", "warning", "concat('label ', value, ' follows ', prev_value)"),
        (labels.where("code = 'label_backwards'"), "label_backwards", "warning", "concat('label ', value, ' follows ', prev_value)"),
        (ref.where("code = 'reference_not_found'"), "reference_not_found", "warning", "concat(kind, ' ', idx, ' is referred to but not in the bundle')"),
        (ref.where("code = 'attachment_not_referenced'"), "attachment_not_referenced", "info", "concat(kind, ' ', idx, ' is not referred to')"),
        (gaps, "numbering_gap", "warning", "concat(missing, ' is missing between ', prev_marker, ' and ', next_marker)"),
        (series, "attachment_series_gap", "warning", "concat(kind, ' ', prev_idx, ' is followed by ', idx)"),
        (listed, "listed_document_missing", "warning", "concat(name, ' is listed but not in the bundle')"),
    )
    return q.withColumn("pages", F.array_join(F.transform("pages", lambda x: x.cast("string")), ","))


def unduplicated_segments(s: SparkSession, d: str) -> DataFrame:
    """Segments after pages that repeat others were marked: those start nothing."""
    p = materialize(checks.mark_duplicates(pages(s, d), duplicate_pages(s, d)))
    return boundaries.segments(materialize(boundaries.heuristic_starts(p)), p).select("bundle_id", "segment_id", "doc_type", "start_page", "end_page")


def tree_needed(s: SparkSession, d: str) -> DataFrame:
    """Per document: its candidates, and whether its type and their number call for a tree."""
    seg = materialize(parts(s, d).select("bundle_id", "segment_id", "doc_type", "start_page", "end_page"))
    n = blocks(s, d).where("kind IN ('heading', 'clause')").join(checks.pages_of_ranges(seg, ["bundle_id", "segment_id"], "start_page", "end_page"), ["bundle_id", "page"]).groupBy("bundle_id", "segment_id").agg(F.count("*").alias("n_candidates"))
    rows = seg.join(n, ["bundle_id", "segment_id"], "left").na.fill(0, ["n_candidates"])
    return rows.select("bundle_id", "segment_id", "n_candidates", boundaries.needs_tree(F.col("doc_type"), F.col("n_candidates")).alias("needed"))


def outlines(s: SparkSession, d: str) -> DataFrame:
    n = clause_tree(s, d).withColumn("label", tree.node_label(F.col("number"), F.col("title"), F.col("text")))
    return tree.outline(n, ["bundle_id", "segment_id"], "label")


def heading_titles(s: SparkSession, d: str) -> DataFrame:
    """Display titles of clauses: from their text, and their title without a section that is glued on."""
    c = clauses(s, d)
    return c.select("clause_id", text.heading_title(F.col("text"), F.col("marker")).alias("from_text"), text.trim_embedded_section(text.clean(F.col("title"))).alias("title"))


def tree_chunks(s: SparkSession, d: str) -> DataFrame:
    """Candidates of each document in chunks for a decision, those with a number of their own decided already."""
    n = _numbered(s, d).withColumn("decided", F.col("number").isNotNull())
    return boundaries.decision_chunks(n, ["bundle_id", "segment_id"], ["page", "idx"], size=4, context=2).select("bundle_id", "segment_id", "pos", "chunk", "context_from")


def review_pages(s: SparkSession, d: str) -> DataFrame:
    """Findings on pages, headings and boundaries as a queue: what could not be read, was not checked, was added or removed."""
    p, begin = _started(s, d)
    check = materialize(boundaries.boundary_checks(begin, p))
    one, none = (lambda c: F.array(F.col(c).cast("int"))), F.expr("cast(array() as array<int>)")
    heads = blocks(s, d).where("kind IN ('heading', 'clause') AND legibility <> 'clear'").withColumn("pages", one("page")).withColumn("shown", F.substring(F.coalesce("text", F.lit("")), 1, 80))
    capped = check.groupBy("bundle_id").agg(F.count("*").alias("n")).where("n > 120").withColumn("pages", none)
    listed = p.groupBy("bundle_id").agg(F.max(F.coalesce(F.size("contract_documents_list"), F.lit(0))).alias("n")).where("n <= 0").withColumn("pages", none)
    judged = check.where("checked").join(p.select("bundle_id", "page", "first_continues"), ["bundle_id", "page"]).withColumn("pages", one("page"))
    return sinks.review(
        (heads, "illegible_heading", "warning", "concat(legibility, ' heading: ', shown)"),
        (p.where("status = 'failed'").withColumn("pages", one("page")), "page_unreadable", "error", "concat('page ', page, ' could not be read')"),
        (capped, "boundary_checks_capped", "warning", "concat(n, ' boundaries to check, 120 were')"),
        (listed, "no_contract_documents_list", "info", "'no page lists the documents of the contract'"),
        (judged.where("listed AND first_continues"), "boundary_removed", "info", "concat('page ', page, ' continues page ', coalesce(cast(against_page AS string), '-'))"),
        (judged.where("NOT listed AND NOT coalesce(first_continues, false) AND against_page IS NOT NULL"), "boundary_added", "info", "concat('page ', page, ' starts a document')"),
        (judged.where("NOT coalesce(first_continues, false) AND against_page IS NULL"), "boundary_unclear", "warning", "concat('no page before page ', page)"),
    ).withColumn("pages", F.array_join(F.transform("pages", lambda x: x.cast("string")), ",")).drop("ord")


_NAMES = """review_pages unduplicated_segments tree_needed outlines heading_titles tree_chunks page_windows segmentation_windows best_start_per_page blank_start_shift prev_content_page heuristic_starts segment_ranges coverage_violations boundary_checks
boundary_verdicts division_map toc_fold anchor_collect unit_ranges leaf_levels page_contexts page_to_clause template_coverage sibling_gaps subclause_gaps label_continuity attachment_series_gap
reference_findings listed_documents_missing index_entries_missing tree_paths sibling_groups owner_sizes page_end_rollup assembled_nodes plain_texts full_texts path_titles toc_lines nested_trees unit_texts
duplicate_page_pairs duplicate_pages degenerate_texts card_lines marker_keys label_keys attachment_keys snippet_dates date_merge display_names pick_parties page_status run_status cost_rollup
call_outcomes ladder_first_success page_diagnosis worst_legibility text_budget clause_projection date_candidates second_reads follow_markers candidate_lines recovered_headings date_sources review_queue""".split()
QUERIES = {n: globals()[n] for n in _NAMES}
ORACLES = reference_sql.ORACLES
