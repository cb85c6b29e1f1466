"""Text of nodes and units from their blocks, in reading order.

Joining depends only on the block before within the same flow, so it is a ``lag``; only a table that is
continued after other blocks, and the moves between units that share a page, need a pass in order, which is
made per node or division.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quirework.functions.numbering import normalize_marker
from quirework.functions.text import _clean

NON_BODY = ("header", "footer", "page_number")
ANNOTATIONS = ("stamp_or_seal", "signature_block")
SEPARATOR = re.compile(r"^\s*\|?\s*:?-{2,}:?\s*(?:\|\s*:?-{2,}:?\s*)*\|?\s*$")


def rendered(kind: Column, text: Column) -> Column:
    """Text of a block as it stands in a node; handwriting is marked."""
    t = F.trim(F.coalesce(text, F.lit("")))
    return F.when((kind == "handwritten") & (t != ""), F.concat(F.lit("[Handwritten: "), t, F.lit("]"))).otherwise(t)


def plain_texts(blocks: DataFrame, by: list[str], order: list[str], continues: str) -> DataFrame:
    """``by`` and ``text``: blocks joined by a blank line, a block that continues the page before by a space or, after a hyphen
    and before a lower-case letter, directly. Native; for nodes without split tables."""
    rows = blocks.withColumn("_p", rendered(F.col("kind"), F.col("text"))).where("_p <> ''")
    w = W.partitionBy(*by).orderBy(*order)
    before = F.lag("_p").over(w)
    broken = before.rlike(r"[A-Za-z]-$") & F.col("_p").rlike(r"^[a-z]")
    joiner = F.when(before.isNull(), "").when(~F.col(continues), "\n\n").when(broken, "").otherwise(" ")
    rows = rows.withColumn("_j", joiner)
    cut = F.when((F.lead("_j").over(w) == "") & F.col("_p").rlike(r"[A-Za-z]-$"), F.expr("left(_p, length(_p) - 1)")).otherwise(F.col("_p"))
    rows = rows.withColumn("_c", F.concat("_j", cut))
    parts = F.array_sort(F.collect_list(F.struct(*order, "_c")))
    return rows.groupBy(*by).agg(parts.alias("_l")).select(*by, F.array_join(F.transform("_l", lambda x: x["_c"]), "").alias("text"))


def join_blocks(blocks: list[dict]) -> str:
    """Text of one node from its blocks (kind, text, continues), tables stitched: a continued table goes on by a line, without
    a header row that repeats the last table's, nor the rule under it."""
    out, last_kind, header = "", None, None
    for b in blocks:
        piece = (b["text"] or "").strip()
        if not piece:
            continue
        if b["kind"] == "handwritten":
            piece = f"[Handwritten: {piece}]"
        lines = piece.splitlines()
        if b["kind"] == "table":
            if b["continues"] and last_kind == "table" and out:
                if header is not None and lines[0].strip() == header:
                    lines = lines[1:]
                    if lines and SEPARATOR.match(lines[0]):
                        lines = lines[1:]
                if lines:
                    out += "\n" + "\n".join(lines)
                last_kind = "table"
                continue
            header = lines[0].strip()
        if not out:
            out = piece
        elif b["continues"] and b["kind"] != "table" and last_kind != "table":
            out = out[:-1] + piece if re.search(r"[^\W\d_]-$", out) and piece[:1].islower() else f"{out} {piece}"
        else:
            out += "\n\n" + piece
        last_kind = b["kind"]
    return out


def node_texts(blocks: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """``by``, ``text``, ``page_start``, ``page_end``, ``n_blocks`` of each node, by :func:`join_blocks`; headers, footers and annotations are left out.

    Blocks pass through sorted partitions, so a task holds the blocks of one node at a time.
    """
    body = blocks.where(~F.col("kind").isin(*NON_BODY, *ANNOTATIONS))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in body.select(*by).schema.fields) + ", text string, page_start int, page_end int, n_blocks int"
    names = [*by, "text", "page_start", "page_end", "n_blocks"]

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held, out = None, [], []

        def close() -> None:
            if held:
                pages = [b["page"] for b in held]
                out.append((*key, join_blocks(held), min(pages), max(pages), len(held)))

        for pdf in batches:
            for b in pdf.to_dict("records"):
                k = tuple(b[c] for c in by)
                if k != key:
                    close()
                    key, held = k, []
                held.append(b)
            yield pd.DataFrame(out, columns=names)
            out = []
        close()
        yield pd.DataFrame(out, columns=names)

    parts = int(body.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = body.select(*by, *(c for c in dict.fromkeys(order + ["kind", "text", "continues", "page"]) if c not in by))
    return rows.repartition(parts, *by).sortWithinPartitions(*by, *order).mapInPandas(stream, schema)


# ---- texts of units that share pages ----

# A section's or part's number at the begin of a marker or heading, kinds of blocks that begin no unit, and
# how many pages outside a clause's own a sub-clause is still taken for its.
SECTION = re.compile(r"\s*(?:section|part)\b\s*[-.:]?\s*(?:no\.?\s*)?([0-9]+|[ivxlcdm]+|[a-z])\b", re.I)
NO_HEADING = ("paragraph", "table", "signature", "stamp")
MARGIN = 2
FRONT = ("preamble", "whole")


def section_number(text: str | None) -> str | None:
    """Number of the SECTION or PART that a marker or heading begins with, without leading zeros."""
    m = SECTION.match(_clean(text))
    return (m[1].lower().lstrip("0") or "0") if m else None


def starts_unit(block: dict, unit: dict, lists_too: bool = False) -> bool:
    """The block is the unit's own heading: same canonical marker (``key``), or the same section number in its marker or text."""
    if not unit["marker"] or block["kind"] in NO_HEADING or (block["kind"] == "list_item" and not lists_too):
        return False
    if block["key"] and block["key"] == unit["key"]:
        return True
    want = section_number(unit["marker"])
    return want is not None and want in (section_number(block["marker"]), section_number((block["text"] or "")[:40]))


def distribute(units: list[dict], blocks: list[dict], level: str = "clause") -> list[list[int]]:
    """The blocks (their positions) of each unit of a division, in order; each block is looked at a bounded number of times.

    Blocks go to the unit that owns their page; on a page where the next unit starts they go to it from its heading
    on. What stands before a unit's heading then goes back to the unit before. Where the leaves are clauses with
    numbers of their own, a sub-clause ``x.y`` goes, with what follows it, to clause ``x`` if that is near. What
    stands before the heading of a first unit is front matter and goes to none.
    """
    own: list[list[int]] = [[] for _ in units]
    if not units:
        return own
    starting = Counter(u["page_start"] for u in units if u["kind"] not in FRONT)
    at = 0
    for k, b in enumerate(blocks):
        while at + 1 < len(units) and b["page"] > units[at]["page_end"]:
            at += 1
        dense = starting[b["page"]] >= 2
        while at + 1 < len(units) and units[at + 1]["page_start"] == b["page"] and starts_unit(b, units[at + 1], dense and units[at]["kind"] not in FRONT):
            at += 1
        own[at].append(k)
    for i in range(1, len(units)):
        head = next((j for j, k in enumerate(own[i]) if starts_unit(blocks[k], units[i])), 0)
        own[i - 1] += own[i][:head]
        own[i] = own[i][head:]
    numbers = [_number(u["key"]) for u in units if u["kind"] == "clause"]
    if level == "clause" and numbers and None not in numbers and len(set(numbers)) == len(numbers):
        clause = {_number(u["key"]): i for i, u in enumerate(units) if u["kind"] == "clause"}
        moved: list[list[int]] = [[] for _ in units]
        for i, u in enumerate(units):
            to = i
            for k in own[i]:
                if u["kind"] == "clause" and (sub := SUBCLAUSE.fullmatch(blocks[k]["key"] or "")) and (j := clause.get(sub[1])) is not None:
                    if units[j]["page_start"] - MARGIN <= blocks[k]["page"] <= units[j]["page_end"] + MARGIN:
                        to = j
                moved[to].append(k)
        own = [sorted(ks, key=lambda k: blocks[k]["page"]) for ks in moved] if moved != own else own
    if units[0]["kind"] not in FRONT:
        own[0] = own[0][next((j for j, k in enumerate(own[0]) if starts_unit(blocks[k], units[0], True)), 0) :]
    return own


SUBCLAUSE = re.compile(r"\(?(\d+)\)?\.\d+(?:\.\d+)*")


def _number(key: str | None) -> str | None:
    m = re.fullmatch(r"\(?(\d+)\)?", key or "")
    return m[1] if m else None


def unit_texts(units: DataFrame, blocks: DataFrame, by: list[str]) -> DataFrame:
    """``by``, ``unit_id``, ``text``, ``n_blocks``, ``first_page``, ``last_page``, ``empty`` of each unit of a division. Signatures and stamps are dropped.

    ``units``: by, unit_id, kind, marker, title, page_start, page_end; ``blocks``: by, page, idx, kind, marker, text, continues.
    A division is one document of a bundle and one group, however large the bundle is. Units without blocks are empty,
    blocks of divisions without units are left aside.
    """
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in units.select(*by).schema.fields)

    def one(us: pd.DataFrame, bs: pd.DataFrame) -> pd.DataFrame:
        cols = [*by, "unit_id", "text", "n_blocks", "first_page", "last_page", "empty"]
        if us.empty:
            return pd.DataFrame([], columns=cols)
        u = us.sort_values(["page_start", "unit_id"]).to_dict("records")
        b = bs[~bs["kind"].isin(ANNOTATIONS + NON_BODY)].sort_values(["page", "idx"]).to_dict("records")
        n = Counter(x["kind"] for x in u)
        level = "section" if n["section"] >= 2 and n["section"] >= n["clause"] else "clause" if n["clause"] else "section"
        out = []
        for unit, own in zip(u, distribute(u, b, level)):
            rows = [b[k] for k in own]
            text = join_blocks([x | {"text": x["text"] if not x["marker"] or (x["text"] or "").lower().startswith(str(x["marker"]).lower()) else f"{x['marker']} {x['text'] or ''}"} for x in rows])
            pages = [x["page"] for x in rows]
            out.append((*(unit[c] for c in by), unit["unit_id"], text, len(own), min(pages, default=None), max(pages, default=None), not text))
        return pd.DataFrame(out, columns=cols).astype({"first_page": "Int32", "last_page": "Int32"})

    key = normalize_marker(F.col("marker")).alias("key")
    units = units.select(*units.columns, key)
    blocks = blocks.select(*(F.col(c).alias(c) for c in blocks.columns), key)  # may come from the same table as units
    return units.groupBy(*by).cogroup(blocks.groupBy(*by)).applyInPandas(one, f"{kinds}, unit_id string, text string, n_blocks int, first_page int, last_page int, empty boolean")


def merge_halves(top: list[dict], bottom: list[dict], similar: float = 0.85) -> list[dict]:
    """Blocks of two overlapping half-page reads as one page: a block of the lower half that lies in the overlap and is like one
    at the end of the upper half comes once. Boxes must be those of the half pages."""
    from quirework.functions.text import _norm, ratio

    def place(box, low):
        return [min(1000, round(y * 0.55 + (450 if low else 0))) if i % 2 == 0 else y for i, y in enumerate(box)] if box and len(box) == 4 else None

    a = [x | {"box": place(x.get("box"), False)} for x in top]
    tail = [x for x in a if x["box"] and x["box"][0] > 380] or a[-4:]
    out = list(a)
    for x in bottom:
        y = x | {"box": place(x.get("box"), True)}
        seam = y["box"] is None or y["box"][0] < 570
        if seam and any(ratio(_norm(y["text"]), _norm(t["text"])) > similar for t in tail):
            continue
        out.append(y)
    return out
