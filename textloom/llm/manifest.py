"""A Merkle manifest of a dataset: one digest for all rows, and a short proof for each.

Every row is a leaf, the SHA-256 of its fields. Leaves of a source stand in
order of id, and every `WIDTH` consecutive digests become the digest of their
joined text, until one is left; the sources' digests are joined the same way
into the root. Each such digest is kept as a record (digest, children), so the
tree is a directed acyclic graph addressed by content: equal runs of nodes are
one record.

A request for a leaf descends from the root. The digits of its source's place
and of its own place, to the base of `WIDTH`, say which child to take; the
children not taken are collected as a segment of its path. Requests with the
same digits so far travel as one row, so a level has as many rows as it has
requested nodes and no record is asked for by all requests at once. Turned
round, the segments are the leaf's proof: joined with them, level by level, the
leaf must give the root again.

Sources are cut into range partitions with the rest of the rows, so a source
with a third of all rows is spread like any other, and a node never has more
than `WIDTH` children.

A null field is `-`, which no text or number is written as, so null and empty
texts differ. Null ids stand before all others, a null source before all
sources. Rows with the same id stand in order of their digests; equal rows stand
next to each other and have a proof each. An empty table has no root and gives
no rows. Columns other than `FIELDS` are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import Stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DIGIT_BITS = 4
WIDTH = 1 << DIGIT_BITS
_PATH = "array<struct<left: string, right: string>>"


def field_text(value: Column) -> Column:
    """How a field enters a digest: its length in UTF-8 bytes, a colon and the value; null is a dash."""
    value = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(**changed: Column) -> Column:
    """The digest of a row's fields, some of them replaced."""
    return digest(*[field_text(changed.get(name, F.col(name))) for name in FIELDS])


@dataclass
class Manifest:
    """`leaves(source, place, size, ...)`, and the tree above them.

    `levels[k]` holds the nodes `(source, place, size, digest, children)` of height k + 1 of the sources' trees,
    `top[k]` those of the tree over the sources, and `sources` is `(source, digest, height, number)`.
    """

    leaves: Stored
    levels: list[Stored]
    sources: Stored
    top: list[Stored]

    def root(self) -> DataFrame:
        """`(digest)`: one row, or none for an empty table."""
        return (self.top[-1] if self.top else self.sources).df.select("digest")


def placed_leaves(rows: DataFrame, order: list[Column]) -> Stored:
    """`rows` in order inside their source: with `place`, from 0, and `size`, the rows of the source.

    Range partitioning samples its input, so the sorted partitions are stored before they are counted.
    """
    at = F.monotonically_increasing_id()
    sorted_rows = rows.repartitionByRange(F.col("source").asc_nulls_first(), *order)
    sorted_rows = sorted_rows.sortWithinPartitions(F.col("source").asc_nulls_first(), *order).withColumn("__at", at)
    stored = Stored(sorted_rows, "leaves")
    part = F.shiftright("__at", 33).alias("__part")
    runs = stored.df.groupBy("source", part).agg(F.count("*").alias("n"), F.min("__at").alias("__first"))
    source = Window.partitionBy("source")  # a row for each partition that the source lies in
    before = F.coalesce(F.sum("n").over(source.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(
        F.col("source").alias("__source"), "__part", "__first", before.alias("__before"), F.sum("n").over(source).alias("size")
    )
    same = F.col("source").eqNullSafe(F.col("__source")) & (F.shiftright("__at", 33) == F.col("__part"))
    placed = stored.df.join(runs, same).withColumn("place", F.col("__before") + F.col("__at") - F.col("__first"))
    return Stored(placed.drop("__source", "__part", "__first", "__before", "__at"), "placed")


def grow(nodes: DataFrame) -> list[Stored]:
    """The levels above `nodes(source, place, size, digest)`, until each source has one node."""
    levels: list[Stored] = []
    size = nodes.agg(F.max("size")).first()[0] or 0
    while size > 1:
        parent = F.shiftright("place", DIGIT_BITS).alias("place")
        runs = nodes.filter("size > 1").groupBy("source", parent, "size").agg(
            F.sort_array(F.collect_list(F.struct(F.col("place").alias("at"), "digest"))).getField("digest").alias("children")
        )
        runs = runs.select(
            "source", "place", F.expr(f"(size + {WIDTH - 1}) div {WIDTH}").alias("size"),
            digest(F.array_join("children", "")).alias("digest"), "children",
        )
        levels.append(Stored(runs, "nodes"))
        nodes = levels[-1].df.drop("children")
        size = (size + WIDTH - 1) // WIDTH
    return levels


def build(leaves: DataFrame, order: list[Column]) -> Manifest:
    """The tree over `leaves(source, digest, ...)`, ordered inside a source by `order`."""
    placed = placed_leaves(leaves, order)
    levels = grow(placed.df.select("source", "place", "size", "digest"))
    ends = [placed.df.filter("size = 1").select("source", "digest", F.lit(0).alias("height"))]
    ends += [nodes.df.filter("size = 1").select("source", "digest", F.lit(k + 1).alias("height")) for k, nodes in enumerate(levels)]
    subroots = reduce(DataFrame.unionByName, ends)
    # The sources are rows of a tree of their own, with no source above them.
    names = subroots.select(F.lit(None).cast("string").alias("source"), F.col("source").alias("name"), "digest", "height")
    numbered = placed_leaves(names, [F.col("name").asc_nulls_first()])
    return Manifest(placed, levels, numbered, grow(numbered.df.select("source", "place", "size", "digest")))


def records(nodes: DataFrame) -> Stored:
    """The store of a level: digest to children, each digest once."""
    return Stored(nodes.groupBy("digest").agg(F.first("children").alias("children")), "records")


def step(asked: DataFrame, store: DataFrame, wanted: DataFrame | None) -> DataFrame:
    """From the nodes `asked` to their children, by the children's digits; not taken siblings become a segment."""
    rows = asked.join(store, "digest").select(*[c for c in asked.columns if c not in ("digest", "place")], "place", "children")
    rows = rows.select("*", F.posexplode("children").alias("__digit", "digest"))
    rows = rows.withColumn("place", F.shiftleft("place", DIGIT_BITS) + F.col("__digit"))
    rows = rows.withColumn("path", F.concat("path", F.array(segment(F.col("children"), F.col("__digit")))))
    rows = rows.select(*asked.columns)
    if wanted is None:
        return rows
    same = [rows[c].eqNullSafe(wanted[c]) for c in wanted.columns]
    return rows.join(wanted, reduce(Column.__and__, same), "left_semi")


def segment(children: Column, digit: Column) -> Column:
    """The siblings of a child: those before it and those after it, joined."""
    left = F.array_join(F.slice(children, F.lit(1), digit), "")
    right = F.array_join(F.slice(children, digit + 2, F.greatest(F.lit(0), F.size(children) - digit - 1)), "")
    return F.struct(left.alias("left"), right.alias("right"))


def proofs(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """The leaves, or those with the `requests(source, place)`, with `subroot`, `root` and `path`.

    `path` is the proof, from the leaf up: of each level the siblings to the left and to the right, joined.
    """

    def wanted(height: int) -> DataFrame | None:
        if requests is None:
            return None
        return requests.select("source", F.shiftright("place", DIGIT_BITS * height).alias("place")).distinct()

    asked = manifest.root().select(F.lit(0).cast("long").alias("place"), "digest", F.col("digest").alias("root"), F.expr(f"cast(array() as {_PATH})").alias("path"))
    for nodes in reversed(manifest.top):
        asked = step(asked, records(nodes.df).df, None)
    sources = manifest.sources.df.select(F.col("place").alias("__number"), F.col("name").alias("source"), "height")
    if requests is not None:
        names = requests.select(F.col("source").alias("__name")).distinct()
        sources = sources.join(names, F.col("source").eqNullSafe(F.col("__name")), "left_semi")
    starts = asked.join(sources, F.col("place") == F.col("__number")).select(
        "source", "height", F.lit(0).cast("long").alias("place"), "digest", F.col("digest").alias("subroot"), "root", "path"
    )
    asked, columns = None, starts.columns
    for k in range(len(manifest.levels) - 1, 0, -1):
        begun = starts.filter(F.col("height") == k + 1)
        asked = begun if asked is None else asked.unionByName(begun)
        asked = step(asked, records(manifest.levels[k].df).df, wanted(k))
    # The last digit is taken by the leaves themselves, sixteen of them to a row of their parent.
    lone = starts.filter("height = 0").select(*columns, F.lit(None).cast("array<string>").alias("children"))
    if manifest.levels:
        begun = starts.filter("height = 1")
        asked = begun if asked is None else asked.unionByName(begun)
        last = asked.join(records(manifest.levels[0].df).df, "digest").select(*columns, "children")
        lone = lone.unionByName(last)
    parents = lone.select(F.col("source").alias("__source"), F.col("place").alias("__parent"), "subroot", "root", "path", "children")
    leaves = manifest.leaves.df
    if requests is not None:
        same = F.col("source").eqNullSafe(F.col("__s")) & (F.col("place") == F.col("__p"))
        asked_for = requests.select(F.col("source").alias("__s"), F.col("place").alias("__p")).distinct()
        leaves = leaves.join(asked_for, same, "left_semi")
    same = F.col("source").eqNullSafe(F.col("__source")) & (F.shiftright("place", DIGIT_BITS) == F.col("__parent"))
    found = leaves.join(parents, same)
    own = F.when(F.col("children").isNull(), F.expr(f"cast(array() as {_PATH})")).otherwise(
        F.array(segment(F.col("children"), F.col("place").bitwiseAND(F.lit(WIDTH - 1)).cast("int")))
    )
    return found.withColumn("path", F.reverse(F.concat("path", own))).drop("__source", "__parent", "children")


def fold(path: Column, leaf: Column) -> Column:
    """The root that a leaf's digest gives with the siblings of its path."""
    return F.aggregate(path, leaf, lambda below, level: F.sha2(F.concat(level["left"], below, level["right"]), 256))


def proof_digest(path: Column) -> Column:
    """One digest over all siblings of a path, level by level, from left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda level: F.concat(level["left"], level["right"])), ""), 256)


def lower_case(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def verified_rows(docs: DataFrame, tampered: Column, text: Column) -> DataFrame:
    """Every row of `docs` with its digests, its proof's digest, and whether it still proves to be in the manifest.

    The manifest is of `docs` as it is; where `tampered` holds, the row that is verified has `text` as its text.
    """
    rows = docs.select(*FIELDS)
    presented = F.when(tampered, leaf_digest(text=text))
    leaves = Stored(rows.select("doc_id", "source", leaf_digest().alias("digest"), presented.alias("presented")), "digests")
    manifest = build(leaves.df, [F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("presented")])
    folded = fold(F.col("path"), F.coalesce("presented", "digest"))
    found = proofs(manifest).select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root")
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
