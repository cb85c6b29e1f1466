"""Oversized texts cut at natural boundaries, with overlap.

One regular expression with bounded quantifiers takes the pieces off a text from the left: its alternatives
are ordered by the strength of the boundary that they end at, and each takes as much as the limit allows. The
last one takes characters, so any text is consumed. Overlap is looked back for in the bodies of the pieces
before. All of it is native SQL on arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ends of pieces, strongest first: paragraph, list item or table row, sentence.
PARAGRAPH = r"(?<=\n[ \t]{0,8}\n)(?![ \t]*\n)"
ITEM = r"(?<=\n)(?=[ \t]*(?:[-•*|]|\(?[0-9A-Za-z]{1,5}[.)]|[0-9]+(?:\.[0-9]+)+\s))|(?<=[;:|]\n)"
SENTENCE = r"(?<=[.!?][\"')\]’”]{0,2}\s)(?=[A-ZÀ-Þ\"'(\[‘“])"
SPACE = r"(?<=\s)(?=\S)"


def pattern(limit: int, overlap: int) -> str:
    """The expression for bodies of at most ``limit - overlap`` characters."""
    top = limit - overlap
    ends = (PARAGRAPH, ITEM, SENTENCE)
    long = "|".join(f".{{{top // 2},{top}}}(?:{e})" for e in ends)
    short = "|".join(f".{{{max(1, top // 10)},{top}}}(?:{e})" for e in ends)
    return rf"(?s).{{1,{top}}}\z|{long}|{short}|.{{{max(1, top // 2)},{top}}}{SPACE}|.{{1,{top}}}"


def bodies(text: Column, limit: int, overlap: int) -> Column:
    """Array of bodies: together they are the text again, unless it fits as a whole."""
    whole = F.length(text) <= limit
    return F.when(whole, F.array(text)).otherwise(F.regexp_extract_all(text, F.lit(pattern(limit, overlap)), 0))


def pieces(records: DataFrame, keys: list[str], text: str, limit: int = 2000, overlap: int = 200) -> DataFrame:
    """``keys`` and ``piece_no``, ``n_pieces``, ``start_pos``, ``overlap_chars``, ``piece`` of each text.

    No piece has more than ``limit`` characters (code points). Each but the first begins with up to ``overlap``
    characters of what came before, from the first whole word in them. start_pos counts from 1 and is where the
    piece's own part (after the overlap) begins. A text within the limit is one piece; null and empty texts give
    none. Repeated rows give repeated pieces.
    """
    df = records.select(*keys, F.col(text).alias("_t")).where("length(_t) > 0")
    df = df.select(*keys, bodies(F.col("_t"), limit, overlap).alias("_b"))
    starts = F.aggregate("_b", F.expr("named_struct('at', 1, 'all', cast(array() as array<int>))"), lambda s, b: F.struct((s["at"] + F.length(b)).alias("at"), F.array_append(s["all"], s["at"]).alias("all")))["all"]
    df = df.withColumn("_s", starts).select(*keys, F.size("_b").alias("n_pieces"), F.col("_b"), F.posexplode(F.arrays_zip("_b", "_s")).alias("_i", "_z"))
    before = F.concat(F.when(F.col("_i") > 1, F.element_at("_b", F.col("_i") - 1)).otherwise(""), F.element_at("_b", F.greatest(F.col("_i"), F.lit(1))))
    back = F.expr(f"right(_before, {overlap})")
    cut = F.regexp_replace(back, r"^\S*\s+(?=\S)", "")
    df = df.withColumn("_before", before)
    df = df.withColumn("_over", F.when(F.col("_i") == 0, F.lit("")).when(F.length("_before") <= overlap, F.col("_before")).otherwise(cut))
    return df.select(*keys, (F.col("_i") + 1).alias("piece_no"), "n_pieces", F.col("_z._s").alias("start_pos"), F.length("_over").alias("overlap_chars"), F.concat("_over", "_z._b").alias("piece"))
