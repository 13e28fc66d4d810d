"""Scores, priors and sampled outcomes as column arithmetic.

Draws come from a counter: the md5 of (key, draw, stream) is a uniform number, so any
task can make any draw again and results depend on the key only.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clamp, labelled


def mapped(c: Column, values: Mapping[str, float], default: float) -> Column:
    return labelled(F.lower(c), {k: str(v) for k, v in values.items()}, str(default)).cast("double")


def start_probability(status: Column, lineup: Column, risk: Column, base: Mapping[str, float], lineup_shift: Mapping[str, float], risk_shift: Mapping[str, float], default: float = 0.5) -> Column:
    """Base by status, shifted by lineup and risk, in [0.01, 0.98]."""
    return clamp(mapped(status, base, default) + mapped(lineup, lineup_shift, 0.0) + mapped(risk, risk_shift, 0.0), 0.01, 0.98)


def value_score(points: Column, price: Column) -> Column:
    """Points per million, 0 where the price is not positive."""
    return F.when(price > 0, points / (price / 1_000_000)).otherwise(0.0)


def blended(live: Column, history: Column, weight: float, low: float, high: float) -> Column:
    """weight of the live value and the rest of the history, or what there is."""
    both = F.when(live.isNotNull() & history.isNotNull(), live * weight + history * (1 - weight)).otherwise(F.coalesce(live, history))
    return clamp(both, low, high)


def expected_goals(line: Column, win: Column, draw: Column, loss: Column) -> Column:
    z = lambda c: F.coalesce(c, F.lit(0.0))
    return clamp(z(line) * 0.5 + (z(win) - z(loss)) * 0.9 + z(draw) * 0.2, 0.0, 5.5)


def composed_points(raw: Column, bonus: Column, minutes: Column, start: Column, sub: Column) -> Column:
    """Points of a player from parts: minutes scale them up to 1.2, a substitute counts 0.3."""
    scale = F.least(F.lit(1.2), F.greatest(minutes, F.lit(0.0)) / 90)
    share = F.least(F.lit(1.0), clamp(start, 0.0, 1.0) + clamp(sub, 0.0, 1.0) * 0.3)
    return (F.greatest(raw, F.lit(0.0)) * scale + bonus) * share


def digest(key: Column, draw: Column, block: int) -> Column:
    """Hex text of 32 digits, which gives four numbers."""
    return F.md5(F.concat_ws("|", key.cast("string"), draw.cast("string"), F.lit(str(block))))


def uniform(hexes: Column, stream: int) -> Column:
    """A number in (0, 1): eight hex digits of an array of digests. Four streams share one."""
    return (F.conv(F.substring(F.get(hexes, F.lit(stream // 4)), 1 + 8 * (stream % 4), 8), 16, 10).cast("double") + 0.5) / float(2**32)


def drawn_points(key: Column, start: Column, mean: Column, spread: Column, bonus: Mapping[str, tuple[Column, float]], n: int = 400, always: float = 0.0) -> Column:
    """An array of n >= 100 draws: whether it starts, a normal base (not below 0), each bonus
    with its probability, and the points of every start; never below 0. Nothing leaves its
    row, so there is no shuffle."""
    if n < 100:
        raise ValueError("at least 100 draws")

    def one(hexes: Column) -> Column:
        u = lambda stream: uniform(hexes, stream)
        normal = F.sqrt(-2 * F.log(u(1))) * F.cos(2 * math.pi * u(2))
        extra = sum((F.when(u(3 + j) < p, points).otherwise(0.0) for j, (p, points) in enumerate(bonus.values())), F.lit(always))
        total = F.greatest(F.greatest(mean + spread * normal, F.lit(0.0)) + extra, F.lit(0.0))
        return F.when(u(0) < start, total).otherwise(0.0)

    blocks = range(1 + (2 + len(bonus)) // 4)
    return F.transform(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.array(*[digest(key, i, b) for b in blocks])), one)


def dealt(df: DataFrame, key: str) -> DataFrame:
    """df in several tasks a core. A small file of many keys is one input task, and so is a joined
    one that adaptive execution coalesced by its bytes, but what a row costs here is its draws."""
    spark = df.sparkSession
    return df.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), key)


def draws(df: DataFrame, key: str, start: str, mean: str, spread: str, bonus: Mapping[str, float], n: int = 400) -> DataFrame:
    """(key, draw, points): the n draws of each row as rows."""
    d = drawn_points(F.col(key), F.col(start), F.col(mean), F.col(spread), {p: (F.col(p), v) for p, v in bonus.items()}, n)
    return dealt(df, key).select(key, F.posexplode(d).alias("draw", "points")).withColumn("draw", F.col("draw") + 1)


def summary_of(values: Column) -> Column:
    """Mean, population deviation and exact p10, p50 and p90 of an array, as a struct."""
    ordered, n = F.sort_array(values), F.size(values)
    mean = F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / n
    square = F.aggregate(values, F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2")), _welford)["m2"]

    def quantile(q: float) -> Column:
        at = (n - 1) * F.lit(q)
        low, high = F.get(ordered, F.floor(at).cast("int")), F.get(ordered, F.ceil(at).cast("int"))
        return low + (high - low) * (at - F.floor(at))

    return F.struct(mean.alias("mean"), F.sqrt(square / n).alias("std"), quantile(0.1).alias("p10"), quantile(0.5).alias("p50"), quantile(0.9).alias("p90"))


def _welford(s: Column, x: Column) -> Column:
    n = s["n"] + 1
    mean = s["mean"] + (x - s["mean"]) / n
    return F.struct(n.alias("n"), mean.alias("mean"), (s["m2"] + (x - s["mean"]) * (x - mean)).alias("m2"))


def sampled_distribution(df: DataFrame, key: str, start: str, mean: str, spread: str, bonus: Mapping[str, float], n: int = 400) -> DataFrame:
    """Mean, deviation, p10, p50 and p90 of n draws of each row; bonus maps the column of a
    probability to points."""
    d = drawn_points(F.col(key), F.col(start), F.col(mean), F.col(spread), {p: (F.col(p), v) for p, v in bonus.items()}, n)
    return dealt(df, key).select(key, d.alias("draws")).select(key, summary_of(F.col("draws")).alias("s")).select(key, "s.*")
