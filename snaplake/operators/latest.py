"""Row choice per key: newest row, n newest, keep-best, duplicates and suffixes.

All of them are one row_number over the key. A filter on the number lets Spark cut
each partition down before the shuffle, so a hot key sends n rows a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import slices


def _ordered(order: Sequence[str | Column]) -> list[Column]:
    """Column names mean newest first, nulls last."""
    return [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in order]


def newest_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column], n: int = 1, rank: str | None = None) -> DataFrame:
    """The first n rows of every key in the given order (names: newest first). The order
    should be total; equal rows are interchangeable. Null keys form one group."""
    name = rank or "_rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*_ordered(order)))).where(F.col(name) <= n)
    return ranked if rank else ranked.drop(name)


def newest_with_complete_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """newest_per_key without the rows that have a null or blank key part."""
    for k in keys:
        df = df.where(F.col(k).isNotNull() & (F.trim(F.col(k).cast("string")) != ""))
    return newest_per_key(df, keys, order)


def keep_newest_duplicates(df: DataFrame, source_id: Column, keys: Sequence[Column], order: Sequence[str | Column]) -> DataFrame:
    """Rows with a source id: the newest of each key; rows without one are untouched."""
    marked = df.withColumn("_source", source_id)
    numbered = marked.withColumn("_rank", F.row_number().over(Window.partitionBy("_source", *keys, F.when(F.col("_source").isNull(), F.monotonically_increasing_id())).orderBy(*_ordered(order))))
    return numbered.where("_rank = 1").drop("_source", "_rank")


def suffix_collisions(df: DataFrame, key: str, order: Sequence[Column], out: str = "unique_key", rows: int = slices.ROWS) -> DataFrame:
    """The first row of a key keeps it; later ones get -2, -3 and so on. A key with more than
    `rows` rows is numbered slice by slice."""
    plain = lambda part: part.withColumn("_number", F.row_number().over(Window.partitionBy(key).orderBy(*order)).cast("long"))
    found = slices.apart(df, key, rows, plain, lambda part: slices.numbered(part, key, order))
    n = F.col("_number")
    return found.withColumn(out, F.when(n > 1, F.concat(F.col(key), F.lit("-"), n.cast("string"))).otherwise(F.col(key))).drop("_number")


def distinguished(df: DataFrame, key: str, own: str, order: Sequence[str], out: str) -> DataFrame:
    """df with `out`: the key for rows of the identity `own` that the first row of the key has, and
    key_own for all others; of rows of one such name the last in order stays. The first identity of a
    key is an aggregate, so a key of very many rows is no single task."""
    first = df.groupBy(key).agg(F.min_by(own, F.struct(*order)).alias("_first"))
    named = df.join(first, key).withColumn(out, F.when(F.col(own) == F.col("_first"), F.col(key)).otherwise(F.concat_ws("_", key, own)))
    return newest_per_key(named.drop("_first"), [out], order)


def first_non_empty(*columns: Column) -> Column:
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in columns])


def distinct_union(frames: Sequence[DataFrame], key: str, order: Sequence[Column]) -> DataFrame:
    """Union in which the first row of each id wins; rows without an id are kept."""
    tagged = [f.withColumn("_from", F.lit(i)) for i, f in enumerate(frames)]
    every = tagged[0]
    for f in tagged[1:]:
        every = every.unionByName(f, allowMissingColumns=True)
    known = every.where(F.col(key).isNotNull())
    rank = F.row_number().over(Window.partitionBy(key).orderBy("_from", *order))
    return known.withColumn("_rank", rank).where("_rank = 1").drop("_rank").unionByName(every.where(F.col(key).isNull())).drop("_from")
