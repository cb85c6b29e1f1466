"""Clause trees from ordered decisions, by windows only.

The level of the i-th opened node is its wanted depth, but at most one below the node before. That clamp is a
running minimum, so levels, parents, ordinals and owners need no state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def clamped_levels(nodes: DataFrame, by: list[str], order: list[str], depth: str) -> DataFrame:
    """``nodes`` with ``pos`` (from 1) and ``level``: ``max(1, min(depth, level before + 1))``."""
    w = W.partitionBy(*by).orderBy(*order)
    rows = nodes.withColumn("pos", F.row_number().over(w)).withColumn("_d", F.greatest(F.lit(1), F.col(depth)) - F.col("pos"))
    run = F.min("_d").over(W.partitionBy(*by).orderBy("pos").rowsBetween(W.unboundedPreceding, 0))
    return rows.withColumn("level", (F.col("pos") + F.least(F.lit(0), run)).cast("int")).drop("_d")


def tree(nodes: DataFrame, by: list[str], order: list[str], depth: str, deepest: int = 5) -> DataFrame:
    """Levels, ``parent_pos`` (null at the top), ``ordinal`` among siblings and ``path`` (array of ordinals) of each node.

    The path is the ordinal of each ancestor: along the levels, the last node of that level so far.
    """
    rows = clamped_levels(nodes, by, order, depth)
    w = W.partitionBy(*by).orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    for k in range(1, deepest + 1):
        rows = rows.withColumn(f"_at{k}", F.last(F.when(F.col("level") == k, F.col("pos")), ignorenulls=True).over(w))
    parent = F.lit(None).cast("int")
    for k in range(2, deepest + 1):
        parent = F.when(F.col("level") == k, F.col(f"_at{k - 1}")).otherwise(parent)
    rows = rows.withColumn("parent_pos", parent)
    rows = rows.withColumn("ordinal", F.row_number().over(W.partitionBy(*by, "parent_pos").orderBy("pos")))
    steps = []
    for k in range(1, deepest + 1):
        last = F.last(F.when(F.col("level") == k, F.col("ordinal")), ignorenulls=True).over(w)
        steps.append(F.when(F.col("level") >= k, last))
    return rows.withColumn("path", F.array_compact(F.array(*steps))).drop(*(f"_at{k}" for k in range(1, deepest + 1)))


def owners(blocks: DataFrame, by: list[str], order: list[str], opens: Column) -> DataFrame:
    """``blocks`` with ``owner_pos``: which opened node (counted from 1) each belongs to, 0 for the document itself."""
    w = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return blocks.withColumn("owner_pos", F.sum(opens.cast("int")).over(w).cast("int"))


def roles(blocks: DataFrame, by: list[str], order: list[str], opens: Column, title: Column, annotations: tuple[str, ...] = ("stamp_or_seal", "signature_block"), similar: float = 0.85) -> DataFrame:
    """:func:`owners` with the ``role`` of each block: ``node``, ``title``, ``annotation``, ``recital`` or ``text``.

    Before the first node a block belongs to the document itself: a heading like the document's title is its title
    block as long as the document has no text, and recitals make up a node of their own.
    """
    from quirework.functions.text import full_similarity_udf

    rows = owners(blocks, by, order, opens).withColumn("_open", opens).withColumn("_title", title)
    noted, loose = F.col("kind").isin(*annotations), F.col("owner_pos") == 0
    like = F.when(loose & (F.col("kind") == "heading"), full_similarity_udf(F.col("text"), F.col("_title")) >= similar).otherwise(F.lit(False))
    rows = rows.withColumn("_like", F.coalesce(like, F.lit(False)))
    says = loose & ~noted & (F.col("kind") != "recital") & ~F.col("_like")
    before = F.coalesce(F.max(says.cast("int")).over(W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    role = F.when(F.col("_open"), "node").when(F.col("_like") & (before == 0), "title").when(noted, "annotation").when(loose & (F.col("kind") == "recital"), "recital").otherwise("text")
    return rows.withColumn("role", role).drop("_open", "_title", "_like")


def page_ends(nodes: DataFrame, by: list[str], own_end: str, deepest: int = 5) -> DataFrame:
    """Last page of each node over its own blocks and its descendants', as ``page_end``. ``nodes``: by, pos, level.

    A node and its descendants are the rows up to the next one that is not below it: numbered by a running count,
    they are partitions of a window, so rows are neither copied nor joined and stay where their document is.
    """
    so_far = W.partitionBy(*by).orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    rows = nodes.withColumns({f"_g{k}": F.sum((F.col("level") <= k).cast("int")).over(so_far) for k in range(1, deepest + 1)})
    end = F.lit(None).cast(nodes.schema[own_end].dataType)
    for k in range(1, deepest + 1):
        end = F.when(F.col("level") == k, F.max(own_end).over(W.partitionBy(*by, f"_g{k}"))).otherwise(end)
    return rows.withColumn("page_end", end).drop(*(f"_g{k}" for k in range(1, deepest + 1)))


def full_texts(nodes: DataFrame, by: list[str], heading: str, text: str) -> DataFrame:
    """Text of each node with its descendants' in reading order, heading first where there is one, as ``full_text``."""
    own = F.concat_ws("\n\n", F.when(F.col(heading) != "", F.col(heading)), F.when(F.col(text) != "", F.col(text)))
    up = nodes.select(*by, F.struct("pos", own.alias("t")).alias("_p"), F.explode(F.transform(F.sequence(F.lit(1), F.size("path")), lambda i: F.slice("path", 1, i))).alias("path"))
    parts = up.groupBy(*by, "path").agg(F.array_sort(F.collect_list("_p")).alias("_p"))
    joined = F.array_join(F.filter(F.transform("_p", lambda p: p["t"]), lambda t: t != ""), "\n\n")
    return nodes.join(parts.select(*by, "path", joined.alias("full_text")), [*by, "path"])


def path_titles(nodes: DataFrame, by: list[str], label: str, separator: str = " > ", deepest: int = 5) -> DataFrame:
    """Labels of the ancestors and the node itself, from the top, as ``path_titles``: along the levels, the label of the last node
    of that level so far. ``nodes``: by, pos, level."""
    so_far = W.partitionBy(*by).orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    titles = [F.when(F.col("level") >= k, F.last(F.when(F.col("level") == k, F.col(label)), ignorenulls=True).over(so_far)) for k in range(1, deepest + 1)]
    return nodes.withColumn("path_titles", F.concat_ws(separator, *titles))


def node_label(number: Column, title: Column, text: Column) -> Column:
    """Display label: number and title, or the start of the text where there is no title."""
    shown = F.when(F.coalesce(title, F.lit("")) != "", title).when(F.length(text) > 70, F.concat(F.substring(text, 1, 70), F.lit("..."))).otherwise(text)
    return F.trim(F.concat_ws(" ", number, shown))


def node_flags(incomplete: Column, disputed: Column, legibility: Column, empty: Column) -> Column:
    """Flags in their fixed order."""
    return F.array_compact(F.array(F.when(incomplete, "text_incomplete"), F.when(disputed, "disputed"), F.when(legibility != "clear", F.concat(F.lit("legibility:"), legibility)), F.when(empty, "empty_text")))


def outline(nodes: DataFrame, by: list[str], label: str, deepest: int = 2) -> DataFrame:
    """Nodes down to a level as indented lines, one text per document."""
    line = F.concat(F.expr("repeat('  ', level - 1)"), F.col(label))
    rows = nodes.where(F.col("level") <= deepest).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("pos", line.alias("l")))).alias("_l"))
    return rows.select(*by, F.array_join(F.transform("_l", lambda x: x["l"]), "\n").alias("outline"))


def split_children(blocks: DataFrame, by: list[str], order: list[str], marker: Column, parent: Column) -> DataFrame:
    """Sub-clauses of bare-number parents: each block with a marker ``{parent}.n`` opens one, blocks before the first stay
    with the parent (``child_no`` 0). Parents of another form keep all blocks."""
    bare = parent.rlike(r"^\d+$")
    opens = bare & (F.regexp_extract(marker, r"^(\d+)\.\d+$", 1) == parent)
    w = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return blocks.withColumn("child_no", F.sum(F.coalesce(opens, F.lit(False)).cast("int")).over(w).cast("int"))


def follow_markers(blocks: DataFrame, by: list[str], order: list[str], marker: Column, unit_marker: str, unit_start: str, unit_end: str, units: DataFrame, margin: int = 2) -> DataFrame:
    """Blocks with a dotted marker ``x.y`` go to the unit ``x`` of their division if it lies within ``margin`` pages; unmarked
    blocks follow the run they stand in. ``blocks`` carries ``unit_id``; a marker that several units have moves nothing."""
    head = F.regexp_extract(F.coalesce(marker, F.lit("")), r"^(\d+)(?:\.\d+)+$", 1)
    one = units.groupBy("division_id", unit_marker).agg(F.min("unit_id").alias("_to"), F.min(unit_start).alias("_s"), F.max(unit_end).alias("_e"), F.count("*").alias("_n")).where("_n = 1")
    rows = blocks.withColumn("_head", head).join(one.select("division_id", F.col(unit_marker).alias("_head"), "_to", "_s", "_e"), ["division_id", "_head"], "left")
    there = F.col("_to").isNotNull() & F.col("page").between(F.col("_s") - margin, F.col("_e") + margin)
    stated = F.when(F.col("_head") == "", None).otherwise(F.when(there, F.col("_to")).otherwise(F.col("unit_id")))
    w = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    moved = F.coalesce(F.last(stated, ignorenulls=True).over(w), F.col("unit_id"))
    return rows.withColumn("new_unit_id", moved).drop("_head", "_to", "_s", "_e")
