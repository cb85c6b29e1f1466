"""Deeply nested records to flat, related tables.

A record is one JSON text. Child lists may be an array, a single object, an array with nulls among the
objects, or any of these as a JSON string, at any depth. Each round of :func:`flatten` explodes one level of
all lists into child rows that carry the parent's key and their ordinal; the payload of a level is read once.
Which fields are lists of objects comes from the merged schema of a level, unless they are named.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.runtime import materialize

#: list field -> letter of its step in a path
LISTS = {"divisions": "d", "documents": "d", "units": "u", "children": "c"}
OBJECT = "map<string,variant>"


def _objects(v: str) -> str:
    """SQL: the JSON objects of the list ``v``, however it is written."""
    plain = lambda x: f"CASE WHEN try_variant_get({x}, '$', 'array<variant>') IS NOT NULL THEN try_variant_get({x}, '$', 'array<variant>') WHEN try_variant_get({x}, '$', '{OBJECT}') IS NOT NULL THEN array({x}) END"
    text = f"try_parse_json(try_variant_get({v}, '$', 'string'))"
    return f"filter(coalesce({plain(v)}, {plain(text)}), x -> try_variant_get(x, '$', '{OBJECT}') IS NOT NULL)"


def roots(records: DataFrame, key: str, payload: str, wrapper: str = "contract") -> DataFrame:
    """``(key, path, node)`` of the outermost object of each record; broken or null payloads give no row."""
    df = records.select(F.col(key).alias("key"), F.expr(f"try_parse_json({payload})").alias("v"))
    df = df.withColumn("v", F.expr(f"CASE WHEN try_variant_get(v, '$', '{OBJECT}') IS NULL THEN try_parse_json(try_variant_get(v, '$', 'string')) ELSE v END"))
    inner = f"try_variant_get(v, '$.{wrapper}', 'variant')"
    df = df.withColumn("node", F.expr(f"CASE WHEN try_variant_get({inner}, '$', '{OBJECT}') IS NOT NULL THEN {inner} ELSE v END"))
    return df.where(f"key IS NOT NULL AND try_variant_get(node, '$', '{OBJECT}') IS NOT NULL").select("key", F.lit(None).cast("string").alias("path"), "node")


def children(frontier: DataFrame, lists: dict[str, str] = LISTS) -> DataFrame:
    """One level down: ``(key, parent_path, path, letter, ordinal, node)``; ``lists``: field and the letter of its steps."""
    parts = []
    for field, letter in lists.items():
        objects = _objects(f"try_variant_get(node, {_at(field)}, 'variant')")
        parts.append(f"coalesce(transform({objects}, (x, i) -> named_struct('letter', '{letter}', 'ordinal', i + 1, 'node', x)), array())")
    exploded = F.expr(f"explode(concat({', '.join(parts)}))") if parts else F.expr("explode(cast(array() as array<struct<letter string, ordinal int, node variant>>))")
    got = frontier.select("key", "path", exploded.alias("c"))
    step = F.concat("c.letter", F.col("c.ordinal").cast("string"))
    return got.select("key", F.coalesce("path", F.lit("root")).alias("parent_path"), F.concat_ws("/", "path", step).alias("path"), "c.letter", "c.ordinal", "c.node")


def _at(field: str) -> str:
    """SQL: the path of a field. Names with a quote or backslash cannot be asked for and are left out before."""
    return "\"$['" + field + "']\""


def flatten(records: DataFrame, key: str = "contract_id", payload: str = "payload", lists: dict[str, str] | None = LISTS, max_depth: int = 1000) -> list[DataFrame]:
    """The levels of the tree as frames of :func:`children`, written level by level until one is empty.

    ``lists`` None: at each level :data:`LISTS` and every other field that holds objects, with steps ``<field>:<n>``.
    Records may repeat; a repeated record repeats its rows. The number of rounds is the depth of the deepest
    record, whatever the number of records. An empty table gives one empty level.
    """
    levels, frontier = [], roots(records, key, payload)
    for _ in range(max_depth):
        level = materialize(children(frontier, held_lists(frontier) if lists is None else lists))
        levels.append(level)
        if level.isEmpty():
            return levels
        frontier = level.select("key", "path", "node")
    raise ValueError(f"records are nested more than {max_depth} levels deep")


def held_lists(nodes: DataFrame) -> dict[str, str]:
    """The fields of a level that hold objects: :data:`LISTS`, and those of the merged schema whose values are lists of objects
    however they are written (an array, one object in its place, or either as a string)."""
    schema = merged_schema(nodes)
    kinds = fields(schema) if schema and schema.startswith("OBJECT") else {}
    sure = {f for f, kind in kinds.items() if f not in LISTS and kind.startswith("ARRAY<OBJECT")}
    maybe = sorted(f for f, kind in kinds.items() if f not in LISTS and f not in sure and (kind.startswith("OBJECT") or kind in ("VARIANT", "ARRAY<VARIANT>")))
    if maybe:
        # mixed values and lone objects count if any value has objects
        tests = [F.max(F.coalesce(F.expr(f"size({_objects(f'try_variant_get(node, {_at(f)}, ' + chr(39) + 'variant' + chr(39) + ')')})") > 0, F.lit(False))).alias(f"x{i}") for i, f in enumerate(maybe)]
        row = nodes.agg(*tests).first()
        sure |= {f for i, f in enumerate(maybe) if row[f"x{i}"]}
    return LISTS | {f: f"{f}:" for f in sorted(sure)}


def _all(levels: list[DataFrame]) -> DataFrame:
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def links(records: DataFrame, key: str = "contract_id", payload: str = "payload") -> DataFrame:
    """Every parent-child link once: ``(<key>, parent_path, node_path)``."""
    rows = _all([x.select("key", "parent_path", "path") for x in flatten(records, key, payload)])
    return rows.select(F.col("key").alias(key), "parent_path", F.col("path").alias("node_path")).distinct()


def merged_schema(rows: DataFrame, node: str = "node") -> str | None:
    """Schema, as DDL, that all objects of a column share after merging; null without rows."""
    return rows.agg(F.schema_of_variant_agg(node)).first()[0]


def fields(schema: str) -> dict[str, str]:
    """Fields of the outermost object of a merged schema and their types, as they stand there. Those whose names hold a quote or backslash are left out."""
    base = start = schema.find("<") + 1
    out, depth = {}, 0
    for m in re.finditer(r"[<>(),]", schema[base:]):
        at = base + m.start()
        if m[0] == "," and depth == 0 or m[0] == ">" and depth == 0:
            name, _, kind = schema[start:at].strip().partition(": ")
            start = at + 1
            name = name.strip("`")
            if name and not re.search(r"['\"\\\\]", name):
                out[name] = kind
        depth += {"<": 1, "(": 1, ">": -1, ")": -1}.get(m[0], 0)
    return out


NAMES = {"d": "divisions", "u": "units", "c": "children"}
KINDS = {"d": "division", "u": "unit", "c": "child"}


def latest(records: DataFrame, key: str, payload: str, received: str) -> DataFrame:
    """One row per key: the payload received last; the greater text among those received at the same time."""
    return records.groupBy(key).agg(F.max(F.struct(received, payload))[payload].alias(payload))


def flat_tables(records: DataFrame, key: str = "contract_id", payload: str = "payload", only: list[str] | None = None) -> dict[str, DataFrame]:
    """The related tables of nested records: ``contracts`` for the outermost objects, ``divisions``, ``units``, ``children``, and one
    for each other field that holds objects, called like the field (``only``: those asked for).

    Every row has its key (``node_key``, a hash of ``<key>`` and ``node_path``), its parent's (``parent_key``;
    ``parent_path`` is ``root`` at the top), its ``parent_kind`` and its ``ordinal`` within the list. The columns come
    from the merged schema of all nodes of the table; what holds further objects is a table of its own and no
    column, other arrays and objects are JSON strings. A field called like one of the keys comes as
    ``field_<name>``. Rows sent twice come once; of different rows under one key see :func:`latest`.
    """
    null = F.lit(None)
    top = materialize(roots(records, key, payload).select("key", null.cast("string").alias("parent_path"), F.lit("root").alias("path"), F.lit("").alias("letter"), null.cast("int").alias("ordinal"), "node"))
    every = _all([top, *flatten(records, key, payload, None)])
    letters = {r.letter: NAMES.get(r.letter, r.letter[:-1]) for r in every.select("letter").distinct().collect()}  # a few names of fields
    letters = dict.fromkeys(["", *NAMES], "") | letters | NAMES | {"": "contracts"}
    step = F.regexp_replace(F.element_at(F.split("parent_path", "/"), -1), r"\d+$", "")
    known = F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv])
    parent = F.when(F.col("parent_path") == "root", "contract").otherwise(F.coalesce(known[step], F.regexp_replace(step, ":$", "")))
    keys = [key, "node_key", "parent_key", "parent_path", "node_path", "parent_kind", "ordinal"]
    out = {}
    for letter, name in letters.items():
        if only is not None and name not in only:
            continue
        rows = every.where(F.col("letter") == letter)
        schema = merged_schema(rows)
        lists = {f for x in letters for f in ({k for k, v in LISTS.items() if v == x} or {x[:-1]})}
        cols = {f: "string" if kind.startswith(("ARRAY", "OBJECT", "VARIANT", "VOID")) else kind.lower() for f, kind in (fields(schema) if schema and schema.startswith("OBJECT") else {}).items() if f not in lists}
        own = [F.expr(f"try_variant_get(node, {_at(f)}, '{kind}')").alias(f"field_{f}" if f in keys else f) for f, kind in sorted(cols.items())]
        links = [F.xxhash64("key", "path").alias("node_key"), F.when(F.col("parent_path").isNotNull(), F.xxhash64("key", "parent_path")).alias("parent_key")]
        out[name] = rows.select(F.col("key").alias(key), *links, "parent_path", F.col("path").alias("node_path"), F.when(F.col("parent_path").isNotNull(), parent).alias("parent_kind"), "ordinal", *own).dropDuplicates([key, "node_path"])
    return out
