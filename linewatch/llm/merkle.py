"""A Merkle manifest of a dataset: a content-addressed DAG, and proofs by descent from its root.

A row's leaf is the SHA-256 of its encoded columns. The leaves of a group, in order, are hashed in runs of FAN until one node, the
group's subroot, is left, and the subroots likewise give the root. What is stored are records of a digest and its children's digests, in segments
of LEVELS levels. A leaf request starts at the root, and the digits of its rank to the base FAN choose the child at each record; the children not
chosen are its path, which is reversed, segment by segment, to be the proof from the leaf up.

A segment has at most FAN**LEVELS nodes at its foot, so requests go down it together in one bounded group, however large the group of the manifest is,
and the path to a segment is found once for all requests below it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewatch.llm.names import unused
from linewatch.llm.places import groups_of, in_order, meet
from linewatch.session import materialise

FAN = 3
LEVELS = 6
FOOT = FAN**LEVELS
_POWERS = [FAN**i for i in range(40)]


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_of(columns: Sequence[Column | str]) -> Column:
    return digest(*[encoded(F.col(c) if isinstance(c, str) else c) for c in columns])


def _height(n: Column) -> Column:
    """Levels above ``n`` nodes until one is left."""
    return F.size(F.filter(F.lit(_POWERS), lambda p: p < n))


@dataclass(frozen=True)
class Forest:
    """``segments[i]`` are records of the levels from i * LEVELS on: digest of the segment's top, and ``nodes`` (digest, children). ``roots`` has
    tree, height and digest. Trees of one node have no record."""

    segments: list[DataFrame]
    roots: DataFrame


def _levels(foot: Column, steps: Column) -> Column:
    """The digests of a segment by level, its foot first."""

    def up(below: Column) -> Column:
        runs = F.sequence(F.lit(0), F.floor((F.size(below) - 1) / FAN).cast("int"))
        return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(below, i * FAN + 1, F.lit(FAN)), ""), 256))

    return F.aggregate(
        F.sequence(F.lit(1), steps), F.array(foot), lambda made, _: F.concat(made, F.array(up(F.element_at(made, -1))))
    )


def build(nodes: DataFrame) -> Forest:
    """The trees over ``nodes`` (tree, at, digest, height): ``at`` counts 0, 1, ... in a tree."""
    spark = nodes.sparkSession
    top = nodes.agg(F.max("height")).first()[0] or 0
    segments, roots = [], nodes.where("height = 0").select("tree", "height", "digest")
    for base in range(0, top, LEVELS):
        steps = F.least(F.lit(LEVELS), F.col("height") - base)
        foot = F.transform(F.sort_array(F.collect_list(F.struct("at", "digest"))), lambda n: n["digest"])
        block = F.floor(F.col("at") / FOOT).alias("at")
        # A segment's foot is at most FOOT digests.
        cut = nodes.where(F.col("height") > base).groupBy("tree", "height", block).agg(foot.alias("foot"))
        grown = cut.select("tree", "height", "at", _levels(F.col("foot"), steps).alias("levels"), steps.alias("steps"))
        records = F.flatten(
            F.transform(
                F.sequence(F.lit(1), F.col("steps")),
                lambda j: F.transform(
                    F.get("levels", j),
                    lambda d, i: F.struct(d.alias("digest"), F.slice(F.get("levels", j - 1), i * FAN + 1, F.lit(FAN)).alias("children")),
                ),
            )
        )
        above = F.get(F.element_at("levels", -1), F.lit(0))
        stored = materialise(spark, grown.select("tree", "height", "at", above.alias("digest"), records.alias("nodes")), "segments")
        segments.append(stored)
        nodes = stored.select("tree", "height", "at", "digest")
        roots = roots.unionByName(nodes.where(F.col("height") <= base + LEVELS).select("tree", "height", "digest"))
    return Forest(segments, materialise(spark, roots, "roots"))


PATH = "path array<array<string>>, digits array<int>"
_PATHS = [("path", pa.list_(pa.list_(pa.string()))), ("digits", pa.list_(pa.int32()))]


def _walk(requests: pa.Table, place: pa.Table) -> pa.Table:
    """Requests of one segment, from its top down, each with what lies beside its way, from the leaf's side up."""
    out = requests.select([c for c in requests.column_names if c != "block"])
    paths, ways, reached = [], [], []
    if place.num_rows:
        (above,), (digits_above,) = place.column("path").to_pylist(), place.column("digits").to_pylist()
        (top,), (steps,) = place.column("digest").to_pylist(), place.column("steps").to_pylist()
        children = {n["digest"]: n["children"] for n in place.column("nodes").to_pylist()[0]}
        for at in out.column("at").to_pylist():
            now, beside, chosen = top, [], []
            for level in range(steps - 1, -1, -1):
                run, digit = children[now], at // _POWERS[level] % FAN
                now = run[digit]
                beside.append(run[:digit] + run[digit + 1 :])
                chosen.append(digit)
            paths.append(beside[::-1] + above)
            ways.append(chosen[::-1] + digits_above)
            reached.append(now)
    elif out.num_rows:
        raise ValueError("a request for a leaf that the manifest does not hold")
    for (name, kind), column in zip([*_PATHS, ("digest", pa.string())], (paths, ways, reached)):
        out = out.append_column(name, pa.array(column, kind))
    if place.num_rows:
        out = out.append_column("root", pa.array(place.column("root").to_pylist() * out.num_rows, pa.string()))
    else:
        out = out.append_column("root", pa.array([], pa.string()))
    return out


def descend(forest: Forest, starts: DataFrame, requests: DataFrame) -> DataFrame:
    """``requests`` (tree, height, at, and more) with ``path`` and ``digits`` from the leaf up, the ``digest`` reached and the ``root`` of their tree. ``starts``
    (tree, path, digits) says what lies above each tree."""
    spark = requests.sparkSession
    opened = forest.roots.join(starts, "tree").withColumn("root", F.col("digest"))
    opened = materialise(spark, opened, "opened")
    alone = opened.where("height = 0").drop("height")
    lone = requests.where("height = 0").join(alone, "tree").select(*requests.columns, "path", "digits", "digest", "root")
    requests = requests.where("height > 0")
    places = None
    for i in range(len(forest.segments) - 1, -1, -1):
        base = i * LEVELS
        here = opened.where(F.col("height").between(base + 1, base + LEVELS)).withColumn("at", F.lit(0).cast("bigint"))
        here = here.select("tree", "height", "at", "digest", "path", "digits", "root")
        places = here if places is None else here.unionByName(places)
        # A record is found by its digest; equal subtrees share theirs.
        records = forest.segments[i].select("digest", "nodes").dropDuplicates(["digest"])
        found = places.join(records, "digest").withColumn("steps", F.least(F.lit(LEVELS), F.col("height") - base))
        found = found.withColumnRenamed("at", "block")
        below = forest.segments[i - 1].select("tree", "height", "at") if i else requests
        if i:
            below = below.where(F.col("height") > base)
        asked = below.withColumn("block", F.floor(F.col("at") / FOOT))
        asked = asked.toDF(*asked.columns)
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in below.schema.fields)
        schema = f"{kinds}, {PATH}, digest string, root string"
        walked = asked.groupBy("tree", "block").cogroup(found.groupBy("tree", "block")).applyInArrow(_walk, schema)
        if not i:
            return walked.unionByName(lone)
        places = materialise(spark, walked, "places").select("tree", "height", "at", "digest", "path", "digits", "root")
    return lone


@dataclass(frozen=True)
class Manifest:
    """``leaves`` has the rows with their ``tree``, its ``height`` and ``at``; ``trees`` and ``top`` hold the records; ``groups`` names the trees."""

    root: str | None
    leaves: DataFrame
    groups: DataFrame
    trees: Forest
    top: Forest


def manifest(rows: DataFrame, group: str, order: str, leaf: str) -> Manifest:
    """The manifest of ``rows``, which have a digest in the column ``leaf``.

    A group's leaves go by ``order``, null first, and equal ones by digest; groups go by value, null first. Rows repeated are leaves of their own. No row: no root."""
    spark = rows.sparkSession
    nth = unused(rows, "nth")
    ordered = in_order(rows, [group, order, leaf], nth)
    groups = groups_of(ordered, group, nth).withColumn("height", _height(F.col("n")))
    groups = in_order(groups, ["group"], "tree")
    placed = meet(ordered, groups, group, nth).select(*rows.columns, "tree", "height", (F.col(nth) - F.col("first")).alias("at"))
    placed = materialise(spark, placed, "placed")
    trees = build(placed.select("tree", "at", F.col(leaf).alias("digest"), "height"))
    n = groups.count()
    high = sum(p < n for p in _POWERS)
    top = build(trees.roots.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("at"), "digest", F.lit(high).alias("height")))
    root = top.roots.first()
    return Manifest(root and root["digest"], placed, groups, trees, top)


def prove(made: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """Rows of ``made.leaves`` (or those ``wanted`` of them) with ``proof`` (the siblings by level, from the leaf up, left to right), ``digits`` (the place
    among them) and ``subroot``."""
    requests = made.leaves if wanted is None else wanted
    nothing = made.top.roots.select(
        "tree", F.lit([]).cast("array<array<string>>").alias("path"), F.lit([]).cast("array<int>").alias("digits")
    )
    root = made.top.roots.first()
    high = F.lit(root["height"] if root else 0).alias("height")
    groups = made.groups.select(F.lit(0).cast("bigint").alias("tree"), high, F.col("tree").alias("at"))
    starts = descend(made.top, nothing, groups).select(F.col("at").alias("tree"), "path", "digits")
    walked = descend(made.trees, starts, requests)
    kept = [c for c in requests.columns if c not in ("tree", "height", "at")]
    return walked.select(*kept, F.col("path").alias("proof"), "digits", F.col("root").alias("subroot"))


def folded(leaf: Column, proof: str = "proof", digits: str = "digits") -> Column:
    """The root that a leaf and its proof give."""
    steps = F.arrays_zip(F.col(proof).alias("beside"), F.col(digits).alias("digit"))

    def up(now: Column, step: Column) -> Column:
        left = F.slice(step["beside"], F.lit(1), step["digit"])
        right = F.slice(step["beside"], step["digit"] + 1, F.lit(FAN))
        return digest(F.array_join(left, ""), now, F.array_join(right, ""))

    return F.aggregate(steps, leaf, up)


def audit(documents: DataFrame, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text")) -> DataFrame:
    """Every row of ``documents`` with its leaf, subroot, root, ``proof``, ``digits`` and ``folded_root``, which starts from the leaf of a copy tampered with: where
    2 divides the crc32 of the id, the copy's text has lost its line breaks.

    Null columns are encoded as such; a null id sorts first and is not tampered with; rows repeated are leaves of their own. Texts are hashed whole,
    where they lie: only digests are shuffled. Other columns are left out. An empty table gives no rows."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = [F.replace(F.col(c), F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in columns]
    rows = documents.select(
        "doc_id", "source", leaf_of(columns).alias("leaf"),
        F.when(even & F.contains("text", F.lit("\n")), leaf_of(changed)).alias("tampered"),
    )
    made = manifest(materialise(documents.sparkSession, rows, "hashed"), "source", "doc_id", "leaf")
    proven = prove(made).withColumn("root", F.lit(made.root).cast("string"))
    return proven.withColumn("folded_root", folded(F.coalesce("tampered", "leaf")))
