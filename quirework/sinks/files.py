"""Sinks: JSON lines, nested trees, tables of contents, review queues and the relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def clause_lines(nodes: DataFrame) -> DataFrame:
    """Rows for ``clauses.jsonl``: nodes but documents that have children and no text of their own."""
    return nodes.where(~((F.col("kind") == "document") & F.col("has_children") & (F.coalesce("text", F.lit("")) == "")))


def toc(nodes: DataFrame, by: list[str], label: str, deepest: int = 3) -> DataFrame:
    """Markdown table of contents per document: ``by``, ``toc``. ``nodes`` have pos, level, page_start."""
    line = F.concat(F.expr("repeat('  ', level - 1)"), F.lit("- "), F.col(label), F.lit(" (p. "), F.col("page_start").cast("string"), F.lit(")"))
    rows = nodes.where(F.col("level") <= deepest).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("pos", line.alias("l")))).alias("_l"))
    return rows.select(*by, F.array_join(F.transform("_l", lambda x: x["l"]), "\n").alias("toc"))


def bookmarks(nodes: DataFrame, label: str) -> DataFrame:
    """``level``, ``label``, ``page`` in reading order, as PDF tools take them."""
    return nodes.select("pos", "level", F.col(label).alias("label"), F.col("page_start").alias("page"))


def nested_tree(nodes: DataFrame, by: list[str], fields: list[str], deepest: int = 5) -> DataFrame:
    """``by``, ``tree``: the nodes of a document as nested JSON, built from the deepest level up, one aggregation a level."""
    rows = nodes.withColumn("_j", F.to_json(F.struct(*fields))).withColumn("_parent", F.expr("slice(path, 1, size(path) - 1)"))
    kids = None
    for level in range(deepest, 0, -1):
        at = rows.where(F.size("path") == level)
        if kids is not None:
            at = at.join(kids, [F.col(f"path").eqNullSafe(F.col("_kp")), *(at[c] == kids[f"_k_{c}"] for c in by)], "left")
            full = F.when(F.col("_kids").isNotNull(), F.concat(F.expr("left(_j, length(_j) - 1)"), F.lit(',"children":['), F.array_join("_kids", ","), F.lit("]}"))).otherwise(F.col("_j"))
        else:
            full = F.col("_j")
        parts = at.select(*by, "_parent", F.struct(F.element_at("path", -1).alias("o"), full.alias("j")).alias("_p")).groupBy(*by, "_parent").agg(F.transform(F.array_sort(F.collect_list("_p")), lambda p: p["j"]).alias("_kids"))
        kids = parts.select(*(F.col(c).alias(f"_k_{c}") for c in by), F.col("_parent").alias("_kp"), "_kids")
    return kids.select(*(F.col(f"_k_{c}").alias(c) for c in by), F.concat(F.lit("["), F.array_join("_kids", ","), F.lit("]")).alias("tree"))


def relational(documents: DataFrame, divisions: DataFrame, clauses: DataFrame, subclauses: DataFrame) -> dict[str, DataFrame]:
    """The four persisted tables with surrogate keys and parent keys. Keys are hashes of the natural keys, so every run gives the
    same ones and no task numbers all rows. NUL characters are dropped. Sub-clauses that do not name their bundle and division
    get them from the clause of their ``clause_id``; those without such a clause have a null ``clause_key``."""
    from quirework.functions.text import strip_nul

    def keyed(df: DataFrame, own: list[str], parent: list[str] | None, name: str, up: str | None) -> DataFrame:
        df = df.withColumn(name, F.xxhash64(*own))
        if parent:
            df = df.withColumn(up, F.xxhash64(*parent))
        return df.withColumns({f.name: strip_nul(F.col(f.name)) for f in df.schema.fields if f.dataType.simpleString() == "string"})

    of = ["bundle_id", "division_id", "clause_id"]
    if not set(of) <= set(subclauses.columns):
        known = clauses.select(*of).dropDuplicates(["clause_id"])
        subclauses = subclauses.drop("bundle_id", "division_id").join(known, "clause_id", "left")
    subclauses = keyed(subclauses, ["bundle_id", "clause_id", "subclause_id"], of, "subclause_key", "clause_key")
    return {
        "document": keyed(documents, ["bundle_id"], None, "document_key", None),
        "division": keyed(divisions, ["bundle_id", "division_id"], ["bundle_id"], "division_key", "document_key"),
        "clause": keyed(clauses, ["bundle_id", "division_id", "clause_id"], ["bundle_id", "division_id"], "clause_key", "division_key"),
        "subclause": subclauses.withColumn("clause_key", F.when(F.col("bundle_id").isNotNull(), F.col("clause_key"))),
    }


def write_tables(tables: dict[str, DataFrame], target: str, mode: str = "append", **options: str) -> None:
    """Write the tables: a ``jdbc:`` URL takes them as tables, anything else as folders of parquet files. Appends by default."""
    for name, df in tables.items():
        if target.startswith("jdbc:"):
            df.write.format("jdbc").options(url=target, dbtable=name, **options).mode(mode).save()
        else:
            df.write.mode(mode).parquet(f"{target.rstrip('/')}/{name}")


def async_url(url: str) -> str:
    """A plain database URL with its asynchronous driver, as services expect it."""
    for plain, driver in (("postgresql://", "postgresql+asyncpg://"), ("postgres://", "postgresql+asyncpg://"), ("sqlite://", "sqlite+aiosqlite://"), ("mysql://", "mysql+aiomysql://")):
        if url.startswith(plain):
            return driver + url[len(plain) :]
    return url


def review(*findings: tuple[DataFrame, str, str, str]) -> DataFrame:
    """The review queue: findings ``(frame with bundle_id and pages, code, severity, SQL of the message)`` as one table."""
    out = None
    for df, code, severity, message in findings:
        rows = df.select("bundle_id", F.lit(severity).alias("severity"), F.lit(code).alias("code"), F.expr(message).alias("message"), "pages")
        out = rows if out is None else out.unionByName(rows)
    return out.withColumn("ord", F.row_number().over(W.partitionBy("bundle_id").orderBy("severity", "code", "pages", "message")))
