"""Merkle manifest of a dataset with nested-interval labels.

Each row is a leaf; the leaves of a source stand in the order of their ids and have
ranks from 0. A node is labelled with its source, its level and the interval of leaf ranks
that it covers, so ancestry is containment of intervals: at level L an interval starts at a
multiple of width**L, which is the bucket by which nodes and their parents meet. Joining
each level with the one above attaches all ancestors to a node; the siblings of a node are
what its parent covers without the node's own interval, to the left and to the right. The
tops of the sources (subroots), ordered by source, are the leaves of one more tree of the
same kind, whose top is the root.

Ranks are counted without bringing a source together: rows are dealt by ranges of (source,
id), numbered inside each range, and shifted by the counts of the ranges before. A family
has at most `width` children, so neither a large source nor a large family meets in one
task. Levels shrink by `width`; each is cut from its lineage in the shared folder.

Null sources are one source, the first; sources are compared as UTF-8 bytes. Null ids come
first; rows of equal id are ordered by their digests, equal rows have each a leaf. Null
values are digested as `-`, so they differ from empty ones. Texts of any length are
digested whole. Columns that are no fields are not looked at. An empty table has no leaf and
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut
from .urls import ascii_lower

#: Children of a node, digested fields in their order.
WIDTH = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: (range, key) pairs up to which their counts are broadcast: 10 MB or so.
BROADCAST_SPANS = 100_000
PATH = "array<struct<left: string, right: string>>"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of values, each with its length in bytes; null is `-`."""
    texts = [v.cast("string") for v in values]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def source_key(source: Column) -> Column:
    """A text without null that sorts as sources do, null first."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """rows(key, ...) with `lo` and `hi`, both the row's number inside its key from 0 in the
    given order, and `n`, the rows of the key. Rows equal in key and order are
    told apart by their place in the input, so they needn't meet in one task."""
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    keys = [F.col("key"), *[F.col(f"`{c}`") for c in order], F.col("tie")]
    ranged = cut(tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie").withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)))
    spans = ranged.groupBy("part", "key").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("held"))
    each = Window.partitionBy("key")
    before = F.coalesce(F.sum("held").over(each.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = cut(spans.select("part", "key", (before - F.col("first")).alias("shift"), F.sum("held").over(each).alias("n")))
    side = F.broadcast(spans) if spans.count() <= BROADCAST_SPANS else spans
    return ranged.join(side, ["part", "key"]).withColumn("lo", F.col("at") + F.col("shift")).withColumn("hi", F.col("lo")).drop("part", "at", "shift")


def bucket(level: int, width: int) -> Column:
    """The label of the level's interval that holds a node."""
    return F.expr(f"lo div {width**level}")


def climb(leaves: DataFrame, width: int = WIDTH) -> list[DataFrame]:
    """The levels above leaves(key, n, lo, hi, digest), lowest first. A node has its bucket,
    interval and digest and its children with theirs."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    nodes, levels = leaves.select("key", "n", "lo", "hi", "digest"), []
    while width ** len(levels) < most:
        level = len(levels) + 1
        unfinished = nodes.where(F.col("n") > width ** (level - 1))
        kids = F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("kids")
        family = unfinished.groupBy("key", bucket(level, width).alias("bucket")).agg(F.first("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), kids)
        levels.append(cut(family.withColumn("digest", digest(F.array_join("kids.digest", "")))))
        nodes = levels[-1].select("key", "n", "lo", "hi", "digest")
    return levels


def tops(leaves: DataFrame, levels: list[DataFrame], width: int = WIDTH) -> DataFrame:
    """(key, digest) of the node that covers all leaves of a key."""
    names = ["key", "digest"]
    found = [leaves.where(F.col("n") == 1).select(*names)]
    found += [nodes.where(F.col("n") <= width**level).select(*names) for level, nodes in enumerate(levels, 1)]
    return reduce(DataFrame.unionByName, found)


def descend(leaves: DataFrame, levels: list[DataFrame], crown: DataFrame, width: int = WIDTH) -> DataFrame:
    """leaves with `path`, the siblings to the left and right at each level up to the root, and
    the digests of `crown`(key, path, ...), which has for every key the path above its top.

    Each level meets the one above by bucket and containment of intervals; the top of a key
    is one row, so a key with many leaves meets crown once."""
    marks = [c for c in crown.columns if c not in ("key", "path")]
    above = None
    for level in range(len(levels), -1, -1):
        nodes = leaves if level == 0 else levels[level - 1]
        placed = nodes.where(F.col("n") <= width**level).join(crown, "key")
        if above is not None:
            kids = F.col("kids_above")
            left = F.array_join(F.transform(F.filter(kids, lambda k: k["hi"] < F.col("lo")), lambda k: k["digest"]), "")
            right = F.array_join(F.transform(F.filter(kids, lambda k: k["lo"] > F.col("hi")), lambda k: k["digest"]), "")
            path = F.concat(F.array(F.struct(left.alias("left"), right.alias("right"))), "path")
            inner = nodes.where(F.col("n") > width**level).withColumn("bucket_above", bucket(level + 1, width))
            inside = (F.col("lo_above") <= F.col("lo")) & (F.col("hi") <= F.col("hi_above"))
            inner = inner.join(above, ["key", "bucket_above"]).where(inside).withColumn("path", path).drop("bucket_above", "lo_above", "hi_above", "kids_above")
            placed = placed.unionByName(inner)
        if level:
            above = placed.select("key", F.col("bucket").alias("bucket_above"), F.col("lo").alias("lo_above"), F.col("hi").alias("hi_above"), F.col("kids").alias("kids_above"), "path", *marks)
    return placed


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda acc, s: digest(F.concat(s["left"], acc, s["right"])))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def no_path() -> Column:
    return F.array().cast(PATH)


def prove(leaves: DataFrame, width: int = WIDTH) -> DataFrame:
    """leaves(key, id, digest, ...) with their path, subroot and root."""
    ranked = numbered(leaves, ["id", "digest"])
    levels = climb(ranked, width)
    # The subroots are the leaves of one more tree with one key.
    subroots = tops(ranked, levels, width).select(F.lit("").alias("key"), F.col("key").alias("source_key"), "digest")
    crowns = numbered(subroots, ["source_key"])
    upper = climb(crowns, width)
    roots = tops(crowns, upper, width).select("key", no_path().alias("path"), F.col("digest").alias("root"))
    crown = cut(descend(crowns, upper, roots, width).select(F.col("source_key").alias("key"), "path", F.col("digest").alias("subroot"), "root"))
    return descend(ranked, levels, crown, width)


def nodes(leaves: DataFrame, width: int = WIDTH) -> DataFrame:
    """The manifest of leaves(key, id, digest): a row (key, level, lo, hi, digest) for every node
    of the sources' trees, leaves included."""
    ranked = numbered(leaves, ["id", "digest"])
    names = ["key", "lo", "hi", "digest"]
    levels = [ranked, *climb(ranked, width)]
    return reduce(DataFrame.unionByName, [d.select(*names).withColumn("level", F.lit(i)) for i, d in enumerate(levels)])


def tampered() -> Column:
    """Whether op13 changes the row's text; rows without id stay."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def op13_merkle_intervals(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*FIELDS)
    own = F.when(tampered(), ascii_lower(F.col("text"))).otherwise(F.col("text"))
    leaf, changed = leaf_digest([F.col(c) for c in FIELDS]), leaf_digest([own if c == "text" else F.col(c) for c in FIELDS])
    leaves = docs.select(source_key(F.col("source")).alias("key"), F.col("doc_id").alias("id"), leaf.alias("digest"), changed.alias("own"))
    proved = prove(leaves).withColumn("folded_root", folded(F.col("own"), F.col("path")))
    return proved.select(F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
