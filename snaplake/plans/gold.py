"""Queries: the four tables of scored players."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gold
from ..sources.tables import table
from .catalog import query

AT = "2024-01-30T120000Z"
U = "((CAST(concat('0x', substr(md5(concat_ws('|', player_uid, '" + AT + "', CAST(draw AS VARCHAR), '{0}')), {1}, 8)) AS UBIGINT) + 0.5) / 4294967296.0)"
PLAYERS = f"""
t AS (SELECT o_orderkey % 23 AS team, CASE WHEN o_orderstatus <> 'P' THEN (o_orderkey % 90) / 100.0 END AS w FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_orderkey % 23 ORDER BY (o_orderstatus <> 'P') DESC, o_orderdate NULLS LAST, CASE WHEN o_orderstatus <> 'P' THEN (o_orderkey % 90) / 100.0 END DESC NULLS LAST) = 1),
p AS (SELECT CAST(c_custkey AS VARCHAR) AS player_uid, c_name AS player_name, CAST(c_nationkey AS VARCHAR) AS team_uid, c_custkey % 34 AS matchday, c_acctbal * 1000 AS market_value, coalesce(w, 0.5) AS win,
  CASE c_custkey % 5 WHEN 0 THEN 'FWD' WHEN 1 THEN 'mid ' WHEN 2 THEN 'DEF' WHEN 3 THEN 'GK' END AS position,
  CASE c_custkey % 5 WHEN 0 THEN 0.24 WHEN 1 THEN 0.15 WHEN 2 THEN 0.07 WHEN 3 THEN 0.01 ELSE 0.10 END AS scorer,
  CASE c_custkey % 6 WHEN 0 THEN 0.84 WHEN 1 THEN 0.58 WHEN 2 THEN 0.08 WHEN 3 THEN 0.05 ELSE 0.72 END + CASE c_nationkey % 5 WHEN 0 THEN 0.10 WHEN 1 THEN 0.12 WHEN 2 THEN 0.04 WHEN 3 THEN -0.18 ELSE 0 END AS base,
  CASE WHEN c_custkey % 4 = 0 OR c_custkey % 3 = 2 THEN 2 ELSE c_custkey % 3 END AS risk, c_custkey % 6 = 1 AS quest,
  coalesce(CASE WHEN c_custkey % 7 <> 0 THEN abs(c_acctbal) / 100 END, CASE WHEN c_custkey % 11 <> 0 THEN 30.0 END, 45.0) AS recent FROM customer LEFT JOIN t ON team = c_nationkey),
s AS (SELECT *, CAST(greatest(0.01, least(0.98, base + CASE risk WHEN 0 THEN 0.03 WHEN 1 THEN -0.06 ELSE -0.12 END)) AS DOUBLE) AS start, CAST(0.12 + CASE WHEN quest THEN 0.05 ELSE 0 END + CASE risk WHEN 2 THEN 0.04 ELSE 0 END AS DOUBLE) AS card FROM p),
r AS (SELECT player_uid, CASE WHEN {U.format(0, 1)} < start THEN greatest(greatest(recent * 0.78 + greatest(4.0, sqrt(greatest(recent, 1)) * 0.9) * sqrt(-2 * ln({U.format(0, 9)})) * cos(2 * pi() * {U.format(0, 17)}), 0) + 4.0
  + CASE WHEN {U.format(0, 25)} < scorer THEN 14.0 ELSE 0 END + CASE WHEN {U.format(1, 1)} < win THEN 6.0 ELSE 0 END - CASE WHEN {U.format(1, 9)} < card THEN 4.0 ELSE 0 END, 0) ELSE 0 END AS x FROM s, (SELECT unnest(range(1, 101)) AS draw)),
d AS (SELECT player_uid, avg(x) AS mean, stddev_pop(x) AS std, quantile_cont(x, 0.1) AS p10, quantile_cont(x, 0.5) AS p50, quantile_cont(x, 0.9) AS p90 FROM r GROUP BY 1)"""
DAILY = """round(start, 6) AS start_probability, round(mean, 6) AS pred_total, round(1 - start, 6) AS p_dnp, round(std, 6) AS std_points, round(p10, 6) AS p10_points, round(p50, 6) AS p50_points, round(p90, 6) AS p90_points, round(market_value, 2) AS market_value,
round(market_value + market_value * (mean - 50) / 1000, 4) AS value_next, round(market_value * (mean - 50) / 1000 * 7, 4) AS value_change_7d, round(CASE WHEN market_value > 0 THEN mean / (market_value / 1000000) * (1 - 0.5 * (1 - start)) ELSE 0 END, 4) AS value_score"""
FOUR = {"market_value": 2, "value_next": 4, "value_change_7d": 4, "value_score": 4, "base_raw_ev": 8}


def _tables(spark, d):
    k = F.col("c_custkey")

    def pick(n, *values):
        out = F.lit(None).cast("string")
        for i, v in enumerate(values):
            out = F.when(n % len(values) == i, v).otherwise(out)
        return out

    players = table(spark, d, "customer").select(
        k.cast("string").alias("player_uid"), F.col("c_name").alias("player_name"), F.col("c_nationkey").cast("string").alias("team_uid"), pick(k, "FWD", "mid ", "DEF", "GK", None).alias("position"), pick(k, "Fit", "questionable", " injured", "SUSPENDED", " ", None).alias("status"),
        pick(F.col("c_nationkey"), "Starter", "safe starter", "potential starter", "bench", None).alias("lineup"), F.when(k % 4 == 0, "High").otherwise(" ").alias("risk"), (k % 3).alias("competitors"), F.when(k % 7 != 0, F.abs("c_acctbal") / 100).alias("last_points"),
        F.when(k % 11 != 0, F.lit(30.0)).alias("average_points"), (k % 34).alias("matchday"), (F.col("c_acctbal") * 1000).alias("market_value"),
    )
    win = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey") % 90 / 100.0)
    teams = table(spark, d, "orders").select((F.col("o_orderkey") % 23).cast("string").alias("team_uid"), win.alias("win_probability"), F.col("o_orderdate").alias("commence_time"))
    return gold.gold_tables(players, teams, AT, n=100)


def _rounded(df):
    return df.select(*[F.round(c, FOUR.get(c, 6)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query("k3_player_daily", f"WITH {PLAYERS} SELECT s.player_uid, player_name, team_uid, position, {DAILY} FROM s JOIN d ON s.player_uid = d.player_uid")
def k3_daily(spark, d):
    return _rounded(_tables(spark, d)["player_daily"])


@query("k3_player_matchday", f"WITH {PLAYERS} SELECT s.player_uid, matchday, {DAILY} FROM s JOIN d ON s.player_uid = d.player_uid")
def k3_matchday(spark, d):
    return _rounded(_tables(spark, d)["player_matchday"])


@query("k3_points_components", f"""
WITH {PLAYERS} SELECT s.player_uid, player_name, matchday, round(start * (recent * 0.78), 8) AS base_raw_ev, round(start * scorer * 14, 6) AS scorer_ev, round(start * win * 6, 6) AS win_ev, round(start * 4, 6) AS minutes_bonus_ev, round(-start * card * 4, 6) AS cards_negative_ev, round(mean, 6) AS pred_total FROM s JOIN d ON s.player_uid = d.player_uid""")  # fmt: skip
def k3_components(spark, d):
    return _rounded(_tables(spark, d)["points_components"])


@query("k3_quality_metrics", f"SELECT 'player_count' AS metric, CAST(count(*) AS DOUBLE) AS value, '{AT}' AS at FROM customer UNION ALL SELECT 'coverage_ratio', CASE WHEN count(*) > 0 THEN 1.0 ELSE 0.0 END, '{AT}' FROM customer UNION ALL SELECT 'draws', 100.0, '{AT}' FROM customer HAVING count(*) >= 0")
def k3_metrics(spark, d):
    return _tables(spark, d)["quality_metrics"]
