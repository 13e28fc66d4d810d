"""Joins with a policy: as-of, unique-key cascades, either-way lookups, anti joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import slices


def as_of_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, values: Sequence[str], rows: int = slices.ROWS) -> DataFrame:
    """left with the values of the newest row of right that has the key and a time not after
    the left row's. Both sides are put on one time line per key, where the last right row
    is carried forward: one shuffle by key, no pair of rows is ever compared. right has one
    row for each key and time. Left rows with a null key or time get nulls. A key with more
    than `rows` rows is carried slice by slice, in many tasks."""
    cols = left.columns
    line = left.select(*cols, F.col(left_time).alias("_t"), F.lit(1).alias("_side"), *[F.lit(None).cast(right.schema[v].dataType).alias(f"_v_{v}") for v in values], F.lit(None).cast("boolean").alias("_here"))
    points = right.where(F.col(right_time).isNotNull() & F.col(key).isNotNull()).select(
        *[(F.col(key) if c == key else F.lit(None).cast(left.schema[c].dataType)).alias(c) for c in cols],
        F.col(right_time).alias("_t"), F.lit(0).alias("_side"), *[F.col(v).alias(f"_v_{v}") for v in values], F.lit(True).alias("_here"),
    )
    order = [F.col("_t").asc_nulls_last(), F.col("_side")]
    point = F.when(F.col("_here"), F.struct(*[F.col(f"_v_{v}").alias(v) for v in values]))
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    plain = lambda df: df.withColumn("_last", F.last(point, ignorenulls=True).over(w))
    found = slices.apart(line.unionByName(points), key, rows, plain, lambda df: slices.carried(df, key, order, point)).where("_side = 1")
    known = F.col(key).isNotNull() & F.col("_t").isNotNull()
    return found.select(*cols, *[F.when(known, F.col("_last")[v]).alias(v) for v in values])


def unique_lookup(right: DataFrame, key: Column, values: Sequence[str], name: str) -> DataFrame:
    """key -> values for the keys that occur once; repeated keys are no evidence."""
    return (
        right.where(key.isNotNull()).groupBy(key.alias(f"_k_{name}"))
        .agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*values)).alias(f"_r_{name}")).where("_n = 1").drop("_n")
    )


def lookup_cascade(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, Column, Column]], values: Sequence[str]) -> DataFrame:
    """left with values of right by the first of several (name, left key, right key) pairs
    that finds exactly one row, and matched_by, its name."""
    out = left
    for name, mine, theirs in keys:
        side = unique_lookup(right, theirs, values, name)
        out = out.join(side, mine == F.col(f"_k_{name}"), "left").drop(f"_k_{name}")
    best = F.coalesce(*[F.col(f"_r_{n}") for n, _, _ in keys])
    by = F.coalesce(*[F.when(F.col(f"_r_{n}").isNotNull(), F.lit(n)) for n, _, _ in keys])
    return out.select(*left.columns, *[best[v].alias(v) for v in values], by.alias("matched_by"))


def unreferenced(dim: DataFrame, key: str, *references: DataFrame) -> DataFrame:
    """Rows of dim whose key stands in none of the one-column references."""
    used = references[0].toDF("_key")
    for r in references[1:]:
        used = used.union(r.toDF("_key"))
    return dim.join(used.distinct(), F.col(key) == F.col("_key"), "left_anti")


def top_keys_semi(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows of the n smallest keys."""
    keys = df.select(F.col(key).alias("_key")).where(F.col("_key").isNotNull()).distinct().orderBy("_key").limit(n)
    return df.join(keys, F.col(key) == F.col("_key"), "left_semi")


def either_way(left: DataFrame, right: DataFrame, a: str, b: str, right_a: str, right_b: str, values: Sequence[str]) -> DataFrame:
    """left with values of the row of right with (a, b), or else with (b, a). right has
    one row for each ordered pair."""
    side = lambda n: right.select(F.col(right_a).alias(f"_{n}a"), F.col(right_b).alias(f"_{n}b"), F.struct(*values).alias(f"_{n}v"))
    out = left.join(side("p"), (F.col(a) == F.col("_pa")) & (F.col(b) == F.col("_pb")), "left").join(side("q"), (F.col(b) == F.col("_qa")) & (F.col(a) == F.col("_qb")), "left")
    return out.select(*left.columns, *[F.coalesce(F.col("_pv")[v], F.col("_qv")[v]).alias(v) for v in values])


def slot_competitors(df: DataFrame, slot: Sequence[str], member: str, out: str = "competitors") -> DataFrame:
    """df with the other members of the row's slot, in order. A slot's members are few: they
    compete for one place."""
    names = df.groupBy(*slot).agg(F.array_sort(F.collect_set(member)).alias("_all"))
    return df.join(names, list(slot)).withColumn(out, F.filter("_all", lambda x: x != F.col(member))).drop("_all")
