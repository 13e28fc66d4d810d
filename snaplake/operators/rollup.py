"""Aggregations: ordered text, splits by keyword, reconciliation, error metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ordered_text(item: Column, order: Sequence[Column], separator: str = ", ") -> Column:
    """Aggregate: texts of a group joined in order. A group's texts are kept together, so
    groups are to be small (the parts of one thing)."""
    ranked = F.array_sort(F.collect_list(F.when(item.isNotNull(), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], item.alias("x")))))
    return F.array_join(F.transform(ranked, lambda s: s["x"]), separator)


def component_rollup(df: DataFrame, keys: Sequence[str], points: str, time: str) -> DataFrame:
    p = F.col(points).cast("decimal(18,2)")
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(p).cast("double").alias("points"), F.min(time).alias("first_ts"), F.max(time).alias("last_ts"))


def keyword_split(df: DataFrame, keys: Sequence[str], name: str, points: Column, groups: dict[str, Sequence[str]]) -> DataFrame:
    """Points of each keyword group, and of names in no group; a name may be in several."""
    flags = {g: F.coalesce(F.lower(F.col(name)).rlike("|".join(words)), F.lit(False)) for g, words in groups.items()}
    none = ~F.lit(False)
    for f in flags.values():
        none = none & ~f
    sums = [F.sum(F.when(f, points).otherwise(0)).alias(f"{g}_points") for g, f in {**flags, "uncategorised": none}.items()]
    return df.groupBy(*keys).agg(*sums, F.count(F.lit(1)).alias("n_events"), *[F.max(f).alias(f"has_{g}") for g, f in flags.items()])


def reconcile(totals: DataFrame, parts: DataFrame, key: str, total: str, part: str, tolerance: float = 0.005) -> DataFrame:
    """(key, total, part_sum, delta, class) of every total: no_parts, exact or mismatch."""
    sums = parts.groupBy(key).agg(F.sum(F.col(part).cast("decimal(18,2)")).alias("part_sum"), F.count(F.lit(1)).alias("n_parts"))
    j = totals.select(key, F.col(total).cast("decimal(18,2)").alias("total")).join(sums, key, "left")
    delta = F.col("total") - F.coalesce("part_sum", F.lit(0))
    kind = F.when(F.coalesce("n_parts", F.lit(0)) == 0, "no_parts").when(F.abs(delta) <= tolerance, "exact").otherwise("mismatch")
    return j.select(key, F.col("total").cast("double").alias("total"), F.coalesce("part_sum", F.lit(0)).cast("double").alias("part_sum"), delta.cast("double").alias("delta"), kind.alias("class"))


def error_metrics(df: DataFrame, error: Column, by: str) -> DataFrame:
    """n, MAE, RMSE and bias over all rows (ALL) and for each value of by; blank is UNKNOWN."""
    scope = F.coalesce(F.nullif(F.trim(F.col(by)), F.lit("")), F.lit("UNKNOWN"))
    rows = df.select(scope.alias("scope"), error.alias("e"))
    return rows.rollup("scope").agg(
        F.count("e").alias("n"), F.avg(F.abs("e")).alias("mae"), F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"), F.avg("e").alias("bias"), F.grouping("scope").alias("all")
    ).select(F.when(F.col("all") == 1, "ALL").otherwise(F.col("scope")).alias("scope"), "n", "mae", "rmse", "bias")


def backtest(predicted: DataFrame, actual: DataFrame, key: str, by: str) -> DataFrame:
    """error_metrics of (key, predicted, by) against (key, actual); an error if no key is
    in both."""
    both = predicted.join(actual, key)
    if both.isEmpty():
        raise LookupError("no prediction has an actual value")
    return error_metrics(both, F.col("predicted") - F.col("actual"), by)


def square_error(probability: Column, outcome: Column) -> Column:
    """Squared difference of a probability and a 0/1 outcome."""
    return (probability - outcome.cast("double")) * (probability - outcome.cast("double"))


def brier(probability: Column, outcome: Column) -> Column:
    """Aggregate: mean squared difference of a probability and a 0/1 outcome."""
    return F.avg(square_error(probability, outcome))


def as_metric_rows(row: DataFrame) -> DataFrame:
    """A one-row frame of numbers as (metric, value) rows."""
    return row.select(*[F.col(c).cast("double").alias(c) for c in row.columns]).unpivot([], row.columns, "metric", "value")


def draw_summary(df: DataFrame, key: str, value: str) -> DataFrame:
    """Exact p10, p50, p90, mean and population deviation of the draws of each key."""
    q = F.percentile(value, F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))
    return df.groupBy(key).agg(q.alias("q"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std")).select(key, "mean", "std", F.col("q")[0].alias("p10"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p90"))


def missing_fields(df: DataFrame, columns: Sequence[str], out: str = "open_issues") -> DataFrame:
    """df with the names of the columns that are null in a row."""
    return df.withColumn(out, F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])))
