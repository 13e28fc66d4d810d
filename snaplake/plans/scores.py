"""Queries: scores, priors, sampled distributions, supervision targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import latest, scoring
from ..sources.tables import table
from .catalog import query

BASE = {"building": 0.8, "automobile": 0.6, "machinery": 0.4}
SHIFT = {"a": 0.1, "b": -0.1}


@query("h20_start_probability", """
SELECT c_custkey, round(greatest(0.01, least(0.98, CASE lower(c_mktsegment) WHEN 'building' THEN 0.8 WHEN 'automobile' THEN 0.6 WHEN 'machinery' THEN 0.4 ELSE 0.5 END + CASE WHEN c_nationkey % 3 = 0 THEN 0.1 WHEN c_nationkey % 3 = 1 THEN -0.1 ELSE 0 END)), 6)::DOUBLE AS p FROM customer""")  # fmt: skip
def h20(spark, d):
    lineup = F.when(F.col("c_nationkey") % 3 == 0, "A").when(F.col("c_nationkey") % 3 == 1, "B")
    p = scoring.start_probability(F.col("c_mktsegment"), lineup, F.lit(None).cast("string"), BASE, SHIFT, {"x": 0.0})
    return table(spark, d, "customer").select("c_custkey", F.round(p, 6).alias("p"))


@query("h21_value_score", "SELECT c_custkey, round(CASE WHEN c_acctbal > 0 THEN c_nationkey / (c_acctbal / 1000000) ELSE 0 END, 4) AS value_score FROM customer")
def h21(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.round(scoring.value_score(F.col("c_nationkey"), F.col("c_acctbal")), 4).alias("value_score"))


@query("h23_domain_features", "SELECT o_orderkey, round(ln(1 + o_totalprice), 6) AS log_price, round(o_totalprice / greatest(o_custkey, 1), 4) AS ratio, round(least(1.0, greatest(0.0, dayofyear(o_orderdate) / 365.0)), 6) AS progress FROM orders")
def h23(spark, d):
    progress = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.dayofyear("o_orderdate") / 365.0))
    return table(spark, d, "orders").select("o_orderkey", F.round(F.log1p("o_totalprice"), 6).alias("log_price"), F.round(F.col("o_totalprice") / F.greatest("o_custkey", F.lit(1)), 4).alias("ratio"), F.round(progress, 6).alias("progress"))


@query("h24_expected_goals", "SELECT l_orderkey, l_partkey, l_extendedprice, round(greatest(0, least(5.5, 0.5 * (l_quantity / 10) + 0.9 * (l_discount * 10 - l_tax * 10) + 0.2 * l_tax)), 6) AS goals FROM lineitem")
def h24(spark, d):
    g = scoring.expected_goals(F.col("l_quantity") / 10, F.col("l_discount") * 10, F.col("l_tax"), F.col("l_tax") * 10)
    return table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", F.round(g, 6).alias("goals"))


@query("h25_composed_points", "SELECT l_orderkey, l_partkey, l_extendedprice, round((l_quantity * least(1.2, greatest(l_linenumber * 20, 0) / 90.0) + l_tax) * least(1.0, least(1.0, l_discount * 8) + least(1.0, l_tax * 8) * 0.3), 6) AS points FROM lineitem")
def h25(spark, d):
    p = scoring.composed_points(F.col("l_quantity"), F.col("l_tax"), (F.col("l_linenumber") * 20).cast("double"), F.col("l_discount") * 8, F.col("l_tax") * 8)
    return table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", F.round(p, 6).alias("points"))


U = "((CAST(concat('0x', substr(md5(concat_ws('|', CAST(c_custkey AS VARCHAR), CAST(draw AS VARCHAR), '{0}')), {1}, 8)) AS UBIGINT) + 0.5) / 4294967296.0)"
DRAWS = f"""SELECT c_custkey, CASE WHEN {U.format(0, 1)} < start THEN greatest(mean + spread * sqrt(-2 * ln({U.format(0, 9)})) * cos(2 * pi() * {U.format(0, 17)}), 0) + CASE WHEN {U.format(0, 25)} < goal THEN 4.0 ELSE 0 END ELSE 0 END AS points
FROM (SELECT c_custkey, 0.3 + (c_nationkey % 7) / 10.0 AS start, c_nationkey * 1.0 AS mean, 1.0 + c_nationkey % 4 AS spread, 0.1 AS goal FROM customer), (SELECT unnest(range(1, 101)) AS draw)"""


@query("k4_sampled_distribution", f"SELECT c_custkey, round(avg(points), 6) AS mean, round(stddev_pop(points), 6) AS std, round(quantile_cont(points, 0.1), 6) AS p10, round(quantile_cont(points, 0.5), 6) AS p50, round(quantile_cont(points, 0.9), 6) AS p90 FROM ({DRAWS}) GROUP BY 1")
def k4(spark, d):
    c = table(spark, d, "customer").select("c_custkey", (0.3 + (F.col("c_nationkey") % 7) / 10.0).alias("start"), F.col("c_nationkey").cast("double").alias("mean"), (1.0 + F.col("c_nationkey") % 4).alias("spread"), F.lit(0.1).alias("goal"))
    out = scoring.sampled_distribution(c, "c_custkey", "start", "mean", "spread", {"goal": 4.0}, n=100)
    return out.select("c_custkey", *[F.round(x, 6).alias(x) for x in ("mean", "std", "p10", "p50", "p90")])


@query("k5_supervision_targets", """
WITH s AS (SELECT l_orderkey, CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS top, max(l_quantity) AS minutes FROM lineitem GROUP BY 1)
SELECT o_orderkey, coalesce(minutes, 22) AS minutes, CAST(coalesce(minutes, 22) >= 45 AS INTEGER) AS started, round(o_totalprice, 2) AS total, coalesce(top, 0) AS on_top, round(o_totalprice - coalesce(top, 0), 2) AS raw FROM orders LEFT JOIN s ON l_orderkey = o_orderkey""")  # fmt: skip
def k5(spark, d):
    top = F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice").cast("decimal(18,2)")).otherwise(0)).cast("double")
    s = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(top.alias("top"), F.max("l_quantity").alias("minutes"))
    j = table(spark, d, "orders").join(s, "o_orderkey", "left").withColumns({"minutes": F.coalesce("minutes", F.lit(22.0)), "on_top": F.coalesce("top", F.lit(0.0))})
    return j.select("o_orderkey", "minutes", (F.col("minutes") >= 45).cast("int").alias("started"), F.round("o_totalprice", 2).alias("total"), "on_top", F.round(F.col("o_totalprice") - F.col("on_top"), 2).alias("raw"))


@query("k8_live_history_blend", """
WITH h AS (SELECT o_custkey, o_totalprice / 500000 AS history FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1)
SELECT c_custkey, round(greatest(0, least(1, CASE WHEN history IS NULL THEN live ELSE live * 0.7 + history * 0.3 END)), 9) AS blended FROM (SELECT c_custkey, c_acctbal / 10000 AS live FROM customer) LEFT JOIN h ON o_custkey = c_custkey""")  # fmt: skip
def k8(spark, d):
    h = latest.newest_per_key(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(F.col("o_custkey").alias("c_custkey"), (F.col("o_totalprice") / 500000).alias("history"))
    live = table(spark, d, "customer").select("c_custkey", (F.col("c_acctbal") / 10000).alias("live"))
    return live.join(h, "c_custkey", "left").select("c_custkey", F.round(scoring.blended(F.col("live"), F.col("history"), 0.7, 0.0, 1.0), 9).alias("blended"))


@query("k11_dimension_from_facts", "SELECT c_nationkey AS id, min_by(n, o) AS name FROM (SELECT c_nationkey, c_name AS n, c_custkey AS o FROM customer WHERE c_name IS NOT NULL UNION ALL SELECT s_nationkey, s_name, 1000000000 + s_suppkey FROM supplier) GROUP BY 1")
def k11(spark, d):
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("id"), F.col("c_name").alias("name"), F.col("c_custkey").alias("o"))
    s = table(spark, d, "supplier").select(F.col("s_nationkey"), F.col("s_name"), F.col("s_suppkey") + 1_000_000_000)
    return c.union(s).groupBy("id").agg(F.min_by("name", "o").alias("name"))
