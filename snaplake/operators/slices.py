"""Keys with very many rows, in slices.

A window over a key sorts all of its rows in one task. Here the rows of such keys are dealt by
ranges of (key, order) to many tasks; each slice is worked on by itself, and the little that
goes from one slice to the next (a count, a last row, a few rows) is brought over. Other keys
keep their one shuffle by key. Results are the same either way.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import cut

#: Rows of a key beyond which it is dealt out.
ROWS = 1_000_000


def frequent(df: DataFrame, key: str, rows: int) -> DataFrame | None:
    """One column `key`: the keys with more than `rows` rows; None where there is none. They
    are fewer than a `rows`-th of df, and their names are what is broadcast."""
    found = df.groupBy(F.col(key).alias(key)).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows).select(key)
    return None if found.isEmpty() else cut(found)


def apart(df: DataFrame, key: str, rows: int, plain: Callable[[DataFrame], DataFrame], sliced: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """plain(df) for keys of up to `rows` rows, and sliced(df) for the others."""
    many = frequent(df, key, rows)
    if many is None:
        return plain(df)
    side = F.broadcast(many.select(F.col(key).alias("_many")))
    same = F.col(key).eqNullSafe(F.col("_many"))
    rest = plain(df.join(side, same, "left_anti"))
    return rest.unionByName(sliced(df.join(side, same, "left_semi")).select(*rest.columns))


def dealt(df: DataFrame, key: str, order: Sequence[Column | str]) -> DataFrame:
    """df in ranges of (key, order), with `_at`, which counts up in that order, and `_part`, the
    number of the range. Written, so that both stay what they are."""
    by = [F.col(key), *order]
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    return cut(ranged.withColumn("_part", F.shiftright("_at", 33)))


def _joined(rows: DataFrame, spans: DataFrame, key: str) -> DataFrame:
    """rows with the columns of spans(key, _part, ..): a row for each slice, so they are few."""
    side = F.broadcast(spans.withColumnsRenamed({key: "_k", "_part": "_p"}))
    return rows.join(side, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_part") == F.col("_p"))).drop("_k", "_p")


def numbered(df: DataFrame, key: str, order: Sequence[Column | str], out: str = "_number") -> DataFrame:
    """df with the row's number in its key, from 1 in the given order: its place in its slice,
    and the rows of the slices before."""
    rows = dealt(df, key, order)
    spans = rows.groupBy(key, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_held"))
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(key, "_part", (F.coalesce(F.sum("_held").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    return _joined(rows, spans, key).withColumn(out, F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def carried(df: DataFrame, key: str, order: Sequence[Column | str], value: Column, out: str = "_last") -> DataFrame:
    """df with the last value that isn't null up to each row of its key: a segmented scan. Inside a
    slice it is a window; where a slice has none yet, the last of the slices before counts."""
    rows = dealt(df, key, order).withColumn("_value", value)
    ends = rows.groupBy(key, "_part").agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col("_at"))).alias("_end"))
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(key, "_part", F.last("_end", ignorenulls=True).over(earlier).alias("_before"))
    inside = F.last("_value", ignorenulls=True).over(Window.partitionBy(key, "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    return _joined(rows.withColumn("_inside", inside), ends, key).withColumn(out, F.coalesce("_inside", "_before")).drop("_at", "_part", "_value", "_inside", "_before")


def with_halo(df: DataFrame, key: str, order: Sequence[Column | str], rows: int, halo: int) -> DataFrame:
    """df with `_slice`, `rows` rows of a key each, and `_number`, their order; the last `halo` rows of a
    slice stand in the next one once more, where `_halo` is true."""
    found = numbered(df, key, order)
    own = F.floor((F.col("_number") - 1) / rows)
    twice = F.when((F.col("_number") - 1) % rows >= rows - halo, F.struct((own + 1).alias("slice"), F.lit(True).alias("halo")))
    places = F.array_compact(F.array(F.struct(own.alias("slice"), F.lit(False).alias("halo")), twice))
    return found.withColumn("_place", F.explode(places)).withColumns({"_slice": F.col("_place.slice"), "_halo": F.col("_place.halo")}).drop("_place")
