"""Sequence features, group-scaled constraints and time folds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import slices


def sequence_features(df: DataFrame, key: str, order: Sequence[Column], value: str, means: Sequence[int] = (3, 5, 10), spread: int = 5, rows: int = slices.ROWS) -> DataFrame:
    """Features of each row from the rows before it in its key: the last value, means of
    the last n, and the population deviation of the last `spread` (0 for fewer than two).
    Null values count as 0, and a first row has zeros. A key with more than `rows` rows is
    worked on in slices, each with the few rows before it that its first rows look back to."""
    v = F.coalesce(F.col(value).cast("double"), F.lit(0.0))

    def features(part: DataFrame, w: Window) -> DataFrame:
        before = lambda n: w.rowsBetween(-n, -1)
        cols = {f"{value}_lag_1": F.coalesce(F.lag(v).over(w), F.lit(0.0))}
        cols |= {f"{value}_mean_{n}": F.coalesce(F.avg(v).over(before(n)), F.lit(0.0)) for n in means}
        cols[f"{value}_std_{spread}"] = F.when(F.count(v).over(before(spread)) >= 2, F.stddev_pop(v).over(before(spread))).otherwise(0.0)
        return part.withColumns(cols)

    def sliced(part: DataFrame) -> DataFrame:
        haloed = slices.with_halo(part, key, order, rows, max(1, spread, *means))
        return features(haloed, Window.partitionBy(key, "_slice").orderBy("_number")).where(~F.col("_halo"))

    return slices.apart(df, key, rows, lambda part: features(part, Window.partitionBy(key).orderBy(*order)), sliced)


def scale_to_caps(df: DataFrame, group: Sequence[str], caps: dict[str, float], weight: Column | None = None) -> DataFrame:
    """Scale each column so that its sum over a group is at most its cap, then each row so
    that its columns add up to 1 at most. A null group is a group; a row counts `weight` times. Sums are aggregated and joined
    back, so no task holds a group."""
    sums = df.groupBy(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)]).agg(*[F.sum(c if weight is None else F.col(c) * weight).alias(f"_s_{c}") for c in caps])
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)])
    scaled = df.join(sums, same).withColumns({c: F.col(c) * F.least(F.lit(1.0), F.coalesce(F.lit(cap) / F.nullif(F.col(f"_s_{c}"), F.lit(0.0)), F.lit(1.0))) for c, cap in caps.items()})
    total = sum((F.col(c) for c in caps), F.lit(0.0))
    return scaled.withColumn("_sum", total).withColumns({c: F.when(F.col("_sum") > 1, F.col(c) / F.col("_sum")).otherwise(F.col(c)) for c in caps}).select(*df.columns)


def day_numbers(df: DataFrame, day: Column) -> DataFrame:
    """(day, n, days) of the distinct days: as many rows as there are days."""
    days = df.select(day.alias("day")).where(F.col("day").isNotNull()).distinct()
    w = Window.orderBy("day")
    return days.withColumns({"n": F.row_number().over(w), "days": F.count(F.lit(1)).over(Window.partitionBy())})


def rolling_folds(df: DataFrame, day: Column, n_splits: int = 4, min_train_days: int = 10, validation_days: int = 4) -> DataFrame:
    """(fold, day, part): train and valid days of rolling-origin folds. Validation windows
    follow each other up to the last day; a fold trains on all days before its window, and
    folds with fewer than min_train_days are left out."""
    days = day_numbers(df, day)
    folds = F.explode(F.sequence(F.lit(1), F.lit(n_splits)))
    marked = days.select("day", "n", "days", folds.alias("fold")).withColumn("first", F.col("days") - (n_splits - F.col("fold") + 1) * validation_days + 1)
    kept = marked.where((F.col("first") - 1 >= min_train_days) & (F.col("n") < F.col("first") + validation_days))
    return kept.select("fold", "day", F.when(F.col("n") < F.col("first"), "train").otherwise("valid").alias("part"))


def time_holdout(df: DataFrame, day: Column, last_days: int) -> DataFrame:
    """df with part: the rows of the last days are valid, the others train."""
    newest = df.agg(F.max(day).alias("_newest"))
    return df.join(F.broadcast(newest)).withColumn("part", F.when(day > F.date_sub("_newest", last_days), "valid").otherwise("train")).drop("_newest")
