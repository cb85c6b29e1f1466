"""Recovered headings put into pages, sources of dates, and the review queue's rows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions.dates import near_hits
from quirework.functions.numbering import depth_hint, leading_marker
from quirework.functions.text import _norm, clean, prefix_ratio

# Divisions whose cover is read for dates, and words in titles of units that define dates.
COVERS = ["RECITALS", "CONTRACT_AGREEMENT", "LETTER_OF_AWARD", "LETTER_OF_INTENT"]
DATE_TITLES = ["definition", "interpretation", "commencement", "effective date", "appointed date", "contract data", "appendix to tender", "key dates", "schedule of dates", "time for completion", "particular conditions", "milestone"]


def put_heading(blocks: list[dict], line: str, y: int | None, similar: float = 0.8, probe: int = 40, least: int = 12) -> tuple[list[dict], str]:
    """The blocks of a page with a heading that the first read missed, and how it got there.

    A block that is like the line becomes a heading (``promoted``); a block in which the line's start stands
    behind other text is cut there (``split``); else the line is put in by its height (``inserted``), at the end
    where it has none. ``blocks``: kind, text, y; positions are given anew.
    """
    out = [dict(b) for b in blocks]
    want = _norm(line)
    scores = [prefix_ratio(want, _norm(b["text"])) for b in out]
    best = max(range(len(out)), key=scores.__getitem__, default=None)
    if best is not None and scores[best] >= similar:
        out[best]["kind"] = "heading"
        how = "promoted"
    else:
        start = line.strip()[:probe].lower()
        at = next(((i, k) for i, b in enumerate(out) if len(start) >= least and (k := (b["text"] or "").lower().find(start)) > 0), None)
        if at:
            i, k = at
            rest = out[i]["text"][k:]
            out[i : i + 1] = [out[i] | {"text": out[i]["text"][:k].rstrip()}, out[i] | {"kind": "heading", "text": rest}]
            how = "split"
        else:
            i = next((j for j, b in enumerate(out) if y is not None and b["y"] is not None and b["y"] > y), len(out))
            out.insert(i, {"kind": "heading", "text": line, "y": y})
            how = "inserted"
    return [b | {"idx": i} for i, b in enumerate(out)], how


def put_headings(blocks: DataFrame, lines: DataFrame, by: list[str]) -> DataFrame:
    """Pages with recovered lines put in, in their order: ``by``, idx, kind, text, y, ``how`` (of the last line put in).

    ``blocks``: by, idx, kind, text, y; ``lines``: by, ord, text, y. Pages without lines stay as they are.
    """
    keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in blocks.select(*by).schema.fields)

    def one(bs: pd.DataFrame, ls: pd.DataFrame) -> pd.DataFrame:
        rows = [{k: (None if pd.isna(v) else v) for k, v in r.items()} for r in bs.sort_values("idx")[["idx", "kind", "text", "y"]].to_dict("records")]
        how = None
        for r in ls.sort_values("ord").to_dict("records"):
            rows, how = put_heading(rows, r["text"], None if pd.isna(r["y"]) else int(r["y"]))
        key = (bs if len(bs) else ls).iloc[0][by]
        out = pd.DataFrame([(*key, r["idx"], r["kind"], r["text"], r["y"], how) for r in rows], columns=[*by, "idx", "kind", "text", "y", "how"])
        return out.astype({"idx": "Int32", "y": "Int32"})

    lines = lines.select(*(F.col(c).alias(c) for c in lines.columns))  # may come from the same table as blocks
    return blocks.groupBy(*by).cogroup(lines.groupBy(*by)).applyInPandas(one, f"{keys}, idx int, kind string, text string, y int, how string")


def candidate_line(block_id: Column, page: Column, kind: Column, number: Column, text: Column) -> Column:
    """One line per candidate of the hierarchy, with its kind of numbering."""
    shown = F.substring(F.translate(clean(text), "|", "/"), 1, 160)
    hint = depth_hint(F.coalesce(number, F.when(kind == "clause", leading_marker(text))))
    return F.concat_ws(" | ", block_id, F.concat(F.lit("p"), page.cast("string")), kind, F.when(clean(number) != "", clean(number)).otherwise("-"), shown, hint)


def date_sources(units: DataFrame, divisions: DataFrame, by: list[str], near: int = 200) -> DataFrame:
    """Units to read for dates: ``by``, unit_id, page_start, ``score``; hits of a term near a date, and two for a defining title.

    Units on pages of a cover division are left to its cover. ``units``: by, unit_id, title, marker, text,
    page_start; ``divisions``: by, division_type, start_page, end_page.
    """
    covers = divisions.where(F.upper("division_type").isin(*COVERS) & (F.col("end_page") >= F.col("start_page"))).select(*by, F.explode(F.sequence("start_page", "end_page")).alias("page_start")).distinct()
    blob = F.lower(F.concat_ws(" ", "title", "marker"))
    hint = F.lit(False)
    for word in DATE_TITLES:
        hint = hint | F.contains(blob, F.lit(word))
    rows = units.where("trim(coalesce(text, '')) <> ''").join(covers, [*by, "page_start"], "left_anti").withColumn("_hint", hint).withColumn("_hits", near_hits(F.col("text"), near))
    return rows.where("_hint OR _hits > 0").select(*by, "unit_id", "page_start", (F.col("_hits") + F.when(F.col("_hint"), 2).otherwise(0)).alias("score"))


def section_clauses(blocks: DataFrame, by: list[str], order: list[str], marker: Column) -> DataFrame:
    """Clauses inside a section: each block with a bare number opens one, headings of sections aside (``clause_no``, 0 before the first)."""
    from pyspark.sql import Window as W

    opens = F.coalesce(marker.rlike(r"^\s*\d+\.?\s*$") & ~F.coalesce(F.col("text"), F.lit("")).rlike(r"(?i)^\s*(?:section|part)\b"), F.lit(False))
    w = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return blocks.withColumn("clause_no", F.sum(opens.cast("int")).over(w).cast("int"))

