"""Variant spellings of organisations and persons, linked in a metric space.

A name is parsed into its own words, its line of business and, for persons, a given name; courtesy, legal
form and abbreviations are put aside. The own words, written together, are points of the space of the
Levenshtein metric. Points are assigned to their nearest pivot; a point is also sent to every cell
that can hold a point within the radius of it, which the triangle inequality decides, and within a cell the
join is exact. Linked spellings, the line of business and the given name make an entity; initialisms and bare
own words are resolved within their bundle.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.operators.components import components
from quirework.runtime import materialize

# Words of courtesy and standing phrases, legal forms, lines of business with their short forms, short forms of given names.
PHRASES = [r"through its authori[sz]ed signatory", r"(?:&|and) its successors(?: and assigns)?", r"\(the company\)", r"\bm/s\.?", r"\bmessrs\b\.?"]
TITLES = {"mr", "mrs", "ms", "mx", "dr", "shri", "smt", "sri", "prof", "er"}
LEGAL = {"private", "pvt", "p", "limited", "ltd", "llp", "plc", "inc", "company", "co", "the", "of", "and"}
LINES = {
    "engineering": ["engg", "eng", "engrg"], "works": ["wks", "wrks"], "marine": ["mar"], "contractors": ["contrs", "contr", "contractor"], "water": ["wtr"],
    "technologies": ["technol", "tech", "techs", "technology"], "power": ["pwr"], "systems": ["sys", "syst", "system"], "steel": ["stl"], "industries": ["inds", "ind", "indus", "industry"],
    "tunnelling": ["tunn", "tunneling", "tunnel"], "constructions": ["constrn", "const", "constr", "construction", "constrns"], "infraprojects": ["infraprojs", "infra", "projects", "infraproj", "projs"],
    "electricals": ["elec", "electrical", "elect"], "metro": [], "corporation": ["corp", "corpn"], "port": [], "authority": ["auth", "authy"], "highways": ["hwys", "hwy", "highway"], "agency": ["agcy", "agy"],
    "electricity": ["elecy"], "board": ["bd", "brd"], "urban": ["urb"], "development": ["dev", "devt", "devpt"],
}
JOINT = {"udb": ["urban", "development", "board"]}
GIVEN = {
    "richard": ["rick", "dick", "rich"], "james": ["jim", "jimmy", "jamie"], "margaret": ["peggy", "maggie", "meg"], "frederick": ["fred", "freddie"], "patricia": ["pat", "tricia", "patty"],
    "william": ["bill", "will", "billy"], "elizabeth": ["liz", "beth", "betty", "lizzie", "eliza"], "michael": ["mike", "mick"], "edward": ["ted", "ed", "eddie", "ned"], "robert": ["bob", "rob", "bobby"],
    "charles": ["chuck", "charlie"], "joseph": ["joe", "joey"], "thomas": ["tom", "tommy"], "john": ["jack", "johnny"], "katherine": ["kate", "kathy", "kit", "catherine", "catharina", "katharina", "cathy", "katie"], "anthony": ["tony"], "susan": ["sue"],
    "henry": ["harry", "hal"], "george": [], "mary": ["molly", "polly"], "anne": ["nan", "annie", "ann"], "david": ["dave"], "daniel": ["dan"], "alexander": ["alex", "sandy"], "dorothy": ["dot", "dolly"], "samuel": ["sam"], "barbara": ["barb"],
}
LINE_OF = {v: k for k, vs in LINES.items() for v in [k, *vs]}
GIVEN_OF = {v: k for k, vs in GIVEN.items() for v in [k, *vs]}


def fold(text: str) -> str:
    text = unicodedata.normalize("NFKD", text)
    return "".join(c for c in text if not unicodedata.combining(c)).lower()


def near(a: str, b: str) -> bool:
    """At most one insertion, deletion, substitution or swap of neighbours apart."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])


def _line(word: str) -> str | None:
    known = LINE_OF.get(word)
    if known or len(word) < 5:
        return known
    return next((k for v, k in LINE_OF.items() if len(v) >= 5 and near(word, v)), None)


def parse(name: str) -> dict:
    """``own`` words, ``line`` (canonical words, sorted), ``given``, ``initial``, ``person`` and ``short`` (an initialism)."""
    raw = re.sub(r"\s+", " ", fold(name)).strip()
    for p in PHRASES:
        raw = re.sub(p, " ", raw)
    turned = bool(re.match(r"^[^,]*[a-z]-?[^,]*,\s*[a-z]+\.?(?:\s+[a-z]\.?)?\s*$", raw))
    if turned:  # surname, given
        last, _, first = raw.partition(",")
        raw = f"{first} {last}"
    words = [w for w in re.split(r"[^a-z0-9]+", raw) if w]
    own, line, firm, given, initial, first, letters = [], set(), False, None, None, None, []
    titled = False
    for w in words:
        if w in TITLES and not own:
            titled = True
        elif w in JOINT:
            line.update(JOINT[w])
            firm = True
        elif (k := _line(w)) is not None:
            line.add(k)
            firm = True
        elif w in LEGAL and not (len(w) == 1 and not firm and not own):
            firm = firm or w in ("limited", "ltd", "private", "pvt", "company")
        elif w in GIVEN_OF and given is None and not own:
            given, first = GIVEN_OF[w], w
            initial = given[0]
        elif len(w) == 1:
            if initial is None and not own:
                initial = w
            letters.append(w)
        else:
            own.append(w)
    if firm and first:  # a firm's given name is one of its own words, and its letters are if it has no other
        own.insert(0, first)
    if firm and not own:
        own = letters
    if {"board", "electricals"} <= line:  # the short form of electrical is that of electricity too
        line = line - {"electricals"} | {"electricity"}
    person = not firm and (given is not None or initial is not None or titled)
    bare = re.sub(r"[^A-Za-z]", "", name)
    short = bare.upper() if len(words) == 1 and 2 <= len(bare) <= 8 and bare.isupper() and not line else None
    return {"own": own, "line": " ".join(sorted(line)) or None, "given": given if person else None, "initial": initial if person else None, "person": person, "short": short, "letters": "".join(w[0] for w in words if w not in TITLES).upper()}


PARSED = "name string, f1 string, f2 string, f3 string, line string, given string, initial string, person boolean, short string, letters string"


def parsed(names: DataFrame) -> DataFrame:
    """``name`` with its parts; f1 are the own words written together, f2 those with the first one last (null for one word), f3
    those sorted (null for two words or fewer), which all orders of the same words share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for n in batch.column("name").to_pylist():
                p = parse(n)
                own = p["own"]
                rows.append((n, "".join(own) or None, "".join(own[1:] + own[:1]) if len(own) > 1 else None, "".join(sorted(own)) if len(own) > 2 else None, p["line"], p["given"], p["initial"], p["person"], p["short"], p["letters"]))
            cols = list(zip(*rows)) if rows else [()] * 10
            yield pa.record_batch([pa.array(c, pa.bool_() if i == 7 else pa.string()) for i, c in enumerate(cols)], names=["name", "f1", "f2", "f3", "line", "given", "initial", "person", "short", "letters"])

    return names.mapInArrow(run, PARSED)


def edit_distances(a: list[str], b: list[str]) -> np.ndarray:
    """Damerau-Levenshtein distances (the unrestricted metric) of the pairs of two lists, all pairs at once."""
    n = len(a)
    la, lb = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    chars = {c: i + 1 for i, c in enumerate(sorted({c for x in a for c in x} | {c for x in b for c in x}))}
    m, k = int(la.max(initial=0)), int(lb.max(initial=0))
    ca, cb = np.zeros((n, m), np.int64), np.zeros((n, k), np.int64)
    for i, x in enumerate(a):
        ca[i, : len(x)] = [chars[c] for c in x]
    for i, x in enumerate(b):
        cb[i, : len(x)] = [chars[c] for c in x]
    rows = np.arange(n)
    big = (la + lb).astype(np.int32)
    d = np.zeros((m + 2, k + 2, n), np.int32)
    d[0] = big
    d[:, 0] = big
    d[1:, 1] = np.arange(m + 1)[:, None]
    d[1, 1:] = np.arange(k + 1)[:, None]
    seen = np.zeros((len(chars) + 2, n), np.int64)
    for i in range(1, m + 1):
        match = np.zeros(n, np.int64)
        x = ca[:, i - 1]
        for j in range(1, k + 1):
            y = cb[:, j - 1]
            i1, j1 = seen[y, rows], match
            same = x == y
            best = np.minimum(d[i, j] + np.where(same, 0, 1), np.minimum(d[i + 1, j], d[i, j + 1]) + 1)
            swap = d[i1, j1, rows] + (i - i1 - 1) + 1 + (j - j1 - 1)
            d[i + 1, j + 1] = np.minimum(best, swap)
            match = np.where(same, j, match)
        seen[x, rows] = i
    return d[la + 1, lb + 1, rows]


def distances_to(strings: list[str], pivots: list[str]) -> np.ndarray:
    """Levenshtein distances of all strings to all pivots of at most 64 characters, by Myers' bit vectors, many at once."""
    chars = {c: i for i, c in enumerate(sorted({c for p in pivots for c in p}))}
    size = np.array([len(p) for p in pivots], np.int64)
    eq = np.zeros((len(chars) + 1, len(pivots)), np.uint64)  # the last row: characters that no pivot has
    for j, p in enumerate(pivots):
        for i, c in enumerate(p):
            eq[chars[c], j] |= np.uint64(1 << i)
    top = (size - 1).astype(np.uint64)
    lens = np.array([len(x) for x in strings], np.int64)
    longest = int(lens.max(initial=0))
    text = np.full((len(strings), longest), len(chars), np.int64)
    for i, x in enumerate(strings):
        text[i, : len(x)] = [chars.get(c, len(chars)) for c in x]
    pv, mv = np.full((len(strings), len(pivots)), np.uint64(0xFFFFFFFFFFFFFFFF)), np.zeros((len(strings), len(pivots)), np.uint64)
    score = np.broadcast_to(size, (len(strings), len(pivots))).copy()
    out = score.copy()
    one = np.uint64(1)
    for t in range(longest):
        e = eq[text[:, t]]
        xv = e | mv
        xh = (((e & pv) + pv) ^ pv) | e
        ph = mv | ~(xh | pv)
        mh = pv & xh
        score += ((ph >> top) & one).astype(np.int64) - ((mh >> top) & one).astype(np.int64)
        ph = (ph << one) | one
        pv = (mh << one) | ~(xv | ph)
        mv = ph & xv
        done = lens == t + 1
        out[done] = score[done]
    return out


REFERENCES = 4


def radius_pairs(points: DataFrame, radius: int = 2, pivots: int = 512, per_cell: int = 64, seed: int = 5) -> DataFrame:
    """``(a, b, d)`` of distinct strings of the column ``s`` within ``radius`` Levenshtein edits, smaller first.

    One pivot per ``per_cell`` strings, ``pivots`` at most, drawn by hash. A string goes to its nearest pivot's
    cell as a member, and as a guest to each cell whose pivot is within twice the radius of being its nearest:
    if x and y are within the radius, x is in y's cell as member or guest. Inside a cell members meet guests
    through filters that the triangle inequality gives, on the cell's pivot and on a few pivots that all strings
    were measured against, and on lengths, then through the metric itself.
    """
    spark = points.sparkSession
    points = materialize(points.select("s").where("s IS NOT NULL AND s <> ''").distinct())
    n = points.count()
    m = min(pivots, max(REFERENCES, n // per_cell))
    chosen = [r[0] for r in points.where(F.length("s") <= 64).orderBy(F.xxhash64("s", F.lit(seed)), "s").limit(m).collect()]
    refs = [f"r{i}" for i in range(REFERENCES)]
    schema = "cell int, s string, d int, home boolean, " + ", ".join(f"{r} int" for r in refs)
    if not chosen:
        return spark.createDataFrame([], "a string, b string, d int")
    held = spark.sparkContext.broadcast(chosen)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ps = held.value
        step = max(1, 30_000 // len(ps))
        for batch in batches:
            strings = batch.column("s").to_pylist()
            for at in range(0, len(strings), step):
                part = strings[at : at + step]
                dist = distances_to(part, ps)
                home = dist.argmin(1)
                i, c = np.nonzero(dist <= dist.min(1)[:, None] + 2 * radius)
                near_refs = [dist[i, min(k, len(ps) - 1)].astype(np.int32) for k in range(REFERENCES)]
                yield pa.record_batch([c.astype(np.int32), pa.array([part[k] for k in i], pa.string()), dist[i, c].astype(np.int32), pa.array(home[i] == c), *near_refs], names=["cell", "s", "d", "home", *refs])

    spread = points.repartition(max(spark.sparkContext.defaultParallelism, n // 20_000 + 1), "s")
    placed = materialize(spread.mapInArrow(cells, schema))
    x = placed.where("home").select("cell", F.col("s").alias("a"), F.col("d").alias("da"), *(F.col(r).alias(f"a{r}") for r in refs))
    y = placed.select("cell", F.col("s").alias("b"), F.col("d").alias("db"), *(F.col(r).alias(f"b{r}") for r in refs))
    close = (F.col("a") != F.col("b")) & (F.abs(F.col("da") - F.col("db")) <= radius) & (F.abs(F.length("a") - F.length("b")) <= radius)
    for r in refs:
        close = close & (F.abs(F.col(f"a{r}") - F.col(f"b{r}")) <= radius)
    found = x.join(y, "cell").where(close).withColumn("d", F.levenshtein("a", "b", radius)).where("d >= 0")
    return found.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min("d").alias("d"))


SHORT = 8  #: Own words of fewer letters count as short.


def linked_spellings(points: DataFrame) -> DataFrame:
    """``(a, b)`` of the strings of ``(s, rare)`` that are one typing error apart, or two if either is rare.
    Where one has fewer than ``SHORT`` letters, it is one, and only if either is rare.

    An error is an insertion, deletion, substitution or swap of neighbours. All pairs within two Levenshtein
    edits, which hold every single error, come from the metric join; their errors are counted exactly.
    """
    rare = points.where("s IS NOT NULL").groupBy("s").agg(F.max(F.col("rare").cast("int")).alias("rare"))
    pairs = radius_pairs(points).join(rare.select(F.col("s").alias("a"), F.col("rare").alias("ra")), "a").join(rare.select(F.col("s").alias("b"), F.col("rare").alias("rb")), "b")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = edit_distances(batch.column("a").to_pylist(), batch.column("b").to_pylist())
                rare = np.maximum(batch.column("ra").to_numpy(), batch.column("rb").to_numpy())
                short = np.array([min(len(x), len(y)) < SHORT for x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())])
                most = np.where(short, rare, 1 + rare)  # short ones lie close together by chance
                yield batch.select(["a", "b"]).filter(pa.array(d <= most))

    return pairs.select("a", "b", "ra", "rb").mapInArrow(exact, "a string, b string")


def link(mentions: DataFrame, aliases: DataFrame) -> DataFrame:
    """``(mention, entity)``: the entity of every mention.

    ``mentions``: ``(mention string, bundle_id, name)``; null and blank names give no row, repeated rows count
    once. ``aliases``: ``(bundle_id, alias, name)``: aliases of the bundle's parties with the party's name.
    Spellings are linked if they are one typing error apart, or two if only one name has one of them; short ones
    if they are one apart and only one name has one of them.
    An entity is named by a canonical text. Names that have no own words (only letters of an unknown
    initialism, say) are one entity per bundle and spelling.
    """
    mentions = mentions.select("mention", "bundle_id", "name").where("mention IS NOT NULL AND trim(name) <> ''").distinct()
    aliases = aliases.select("bundle_id", "alias", "name").where("trim(alias) <> ''").distinct()
    names = mentions.select("name").union(aliases.where("trim(name) <> ''").select("name")).distinct()
    p = materialize(parsed(names))
    # spellings of own words that belong together
    forms = p.where("f1 IS NOT NULL AND short IS NULL").groupBy("f1", "f2", "f3").agg((F.count("*") == 1).alias("rare"))
    points = forms.select(F.explode(F.array("f1", "f2", "f3")).alias("s"), "rare").where("s IS NOT NULL")
    close = linked_spellings(materialize(points))
    turned = forms.select(F.col("f1").alias("a"), F.explode(F.array("f2", "f3")).alias("b")).where("b IS NOT NULL")
    roots = materialize(components(materialize(close.union(turned))))
    p = p.join(roots.select(F.col("node").alias("f1"), "root"), "f1", "left").withColumn("family", F.coalesce("root", "f1")).drop("root")
    p = materialize(p)
    # initialisms and other proper aliases of the bundle stand for the party that bears them
    letters = lambda c: F.upper(F.regexp_replace(c, "[^A-Za-z]", ""))
    parts = F.max(F.struct("line", "family", "given", "initial", "person")).alias("_w")
    known = p.where("short IS NULL AND family IS NOT NULL").select("name", "family", "line", "given", "initial", "person", "letters")
    bearers = aliases.where(~F.lower("alias").startswith("the ")).join(known, "name")
    borne = bearers.groupBy("bundle_id", letters("alias").alias("_a")).agg(parts)
    spelt = mentions.select("bundle_id", "name").distinct().join(known, "name").groupBy("bundle_id", F.col("letters").alias("_a")).agg(parts.alias("_v"))
    rows = mentions.join(p.drop("letters"), "name").withColumn("_a", letters("name")).join(borne, ["bundle_id", "_a"], "left").join(spelt, ["bundle_id", "_a"], "left")
    rows = rows.withColumn("_w", F.coalesce("_w", F.when(F.col("short").isNotNull(), F.col("_v")))).withColumn("_w", F.when(F.col("line").isNull() | F.col("_w.line").isNotNull(), F.col("_w")))
    for c in ("family", "line", "given", "initial", "person"):
        rows = rows.withColumn(c, F.when(F.col("_w").isNotNull(), F.col(f"_w.{c}")).otherwise(F.col(c)))
    rows = materialize(rows.drop("_w", "_v", "_a"))
    # a line of business named in part is the one line of the family that contains it
    lines = rows.where("NOT person AND line IS NOT NULL AND family IS NOT NULL").select("family", "line").distinct()
    words = lambda c: F.split(c, " ")
    wider = lines.join(lines.select("family", F.col("line").alias("wide")), "family").where((F.size(words("line")) < F.size(words("wide"))) & (F.size(F.array_except(words("line"), words("wide"))) == 0))
    wider = wider.groupBy("family", "line").agg(F.max("wide").alias("_wide"), F.count("*").alias("_n")).where("_n = 1").drop("_n")
    rows = materialize(rows.join(wider, ["family", "line"], "left").withColumn("line", F.when(~F.col("person"), F.coalesce("_wide", "line")).otherwise(F.col("line"))).drop("_wide"))
    # firms named without their line of business: the one line of the family in the bundle, else overall
    firms = rows.where("NOT person AND family IS NOT NULL AND line IS NOT NULL")
    one = lambda df, keys, name: df.groupBy(*keys).agg(F.when(F.countDistinct("line") == 1, F.max("line")).alias(name))
    rows = rows.join(one(firms, ["bundle_id", "family"], "_l1"), ["bundle_id", "family"], "left").join(one(firms, ["family"], "_l2"), ["family"], "left")
    # persons: a given name that is only an initial is the family's given name with it
    people = rows.where("person AND given IS NOT NULL").groupBy("family", "initial").agg(F.when(F.countDistinct("given") == 1, F.max("given")).alias("_g"))
    rows = rows.join(people, ["family", "initial"], "left")
    # own words alone, of a family that only persons bear, are such a person
    sole = rows.where("person").groupBy("family").agg(F.when(F.countDistinct(F.coalesce("given", "_g", "initial")) == 1, F.max(F.coalesce("given", "_g", "initial"))).alias("_p"))
    rows = rows.join(sole, ["family"], "left")
    line = F.coalesce("line", "_l1", "_l2")
    who_ = F.when(F.col("person"), F.concat(F.lit("person "), F.coalesce("given", "_g", "initial", "_p", F.lit("")))).when(line.isNotNull(), F.concat(F.lit("firm "), line)).when(F.col("_p").isNotNull(), F.concat(F.lit("person "), F.col("_p"))).otherwise("firm")
    alone = F.concat_ws(" ", F.lit("unknown"), "bundle_id", F.upper(F.trim("name")))
    return rows.select("mention", F.when(F.col("family").isNull(), alone).otherwise(F.concat_ws(": ", "family", who_)).alias("entity")).distinct()


def with_links(linked: DataFrame) -> DataFrame:
    """``linked`` with ``n_links``: the other mentions of the entity."""
    return linked.join(linked.groupBy("entity").agg((F.count("*") - 1).alias("n_links")), "entity").select("mention", "entity", "n_links")


def entity_pairs(linked: DataFrame) -> DataFrame:
    """``(mention_a, mention_b)`` of the same entity, smaller first; every pair is part of the result."""
    x, y = linked.select("entity", F.col("mention").alias("mention_a")), linked.select("entity", F.col("mention").alias("mention_b"))
    return x.join(y, "entity").where("mention_a < mention_b").select("mention_a", "mention_b").distinct()
