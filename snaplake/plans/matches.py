"""Queries: match rows of nested history payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import matches
from ..sources.tables import table
from .catalog import query

#: Symbols that everyone knows; the payload's come first.
CODES = {0: "ZER", 1: "O-ne", 2: "two"}
ACTIVE = "1998/1999"


def _payloads(spark, d) -> DataFrame:
    """(o_custkey, payload): a customer's orders as matches, by season, in order of time. Every third
    customer's payload is one list deeper; orders of status P have no points."""
    o = table(spark, d, "orders")
    start = F.year("o_orderdate") - F.when(F.month("o_orderdate") < 7, 1).otherwise(0)
    t1, t2, n = F.col("o_custkey") % 18, F.col("o_orderkey") % 18, F.col("o_orderkey")
    match = F.struct(
        F.month("o_orderdate").alias("day"), F.when(F.col("o_orderstatus") != "P", F.floor(F.col("o_totalprice") / 1000)).alias("p"), F.when(n % 7 > 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("md"),
        F.when(n % 11 > 0, t1).cast("string").alias("t1"), t2.cast("string").alias("t2"), F.when(n % 5 > 0, F.day("o_orderdate") % 4).alias("t1g"), F.when(n % 5 > 0, n % 3).alias("t2g"), F.when(n % 5 == 1, F.lit("7 : 3")).alias("score"),
        F.when(n % 3 == 0, t1).when(n % 3 == 1, t2).cast("string").alias("pt"), F.when(n % 13 == 0, F.concat(F.lit("s-"), t2)).alias("t2sy"), F.when(n % 2 == 0, n).alias("match_id"), n.alias("n"),
    )
    rows = o.select("o_custkey", start.alias("start"), F.struct("o_orderdate", "o_orderkey", match.alias("m")).alias("s"))
    seasons = rows.groupBy("o_custkey", "start").agg(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["m"]).alias("ph"))
    season = F.struct(F.concat_ws("/", "start", F.col("start") + 1).alias("ti"), "ph")
    text = F.to_json(F.struct(F.array_sort(F.collect_list(season)).alias("it")))
    return seasons.groupBy("o_custkey").agg(F.when(F.col("o_custkey") % 3 == 0, F.concat(F.lit('{"data":[{"sn":"none"},['), text, F.lit("]]}"))).otherwise(text).alias("payload"))


SQL = f"""
WITH o AS (SELECT *, year(o_orderdate) - CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 0 END AS start, CAST(month(o_orderdate) AS BIGINT) AS matchday, o_orderkey AS n,
    CASE WHEN o_orderkey % 11 > 0 THEN o_custkey % 18 END AS t1, o_orderkey % 18 AS t2, o_custkey % 18 AS x FROM orders WHERE o_orderstatus <> 'P'),
r AS (SELECT *, concat(start, '/', start + 1) AS season, concat(lpad(CAST(start % 100 AS VARCHAR), 2, '0'), '/', lpad(CAST((start + 1) % 100 AS VARCHAR), 2, '0')) AS token,
    CASE WHEN n % 3 = 0 THEN x WHEN n % 3 = 1 THEN t2 END AS team FROM o WHERE t1 IS NOT NULL AND t1 < 16 AND t2 < 16
    QUALIFY row_number() OVER (PARTITION BY o_custkey, start, matchday ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
f AS (SELECT *, season = '{ACTIVE}' AND (t1 + t2) % 2 = 0 AS hit FROM r),
g AS (SELECT *, CASE WHEN n % 7 > 0 THEN CAST(o_orderdate AS TIMESTAMP) WHEN hit THEN TIMESTAMP '1999-01-01 00:00:00' END AS kickoff_ts,
    CASE WHEN n % 5 > 0 THEN CAST(day(o_orderdate) % 4 AS BIGINT) WHEN hit THEN 1 END AS gh, CASE WHEN n % 5 > 0 THEN n % 3 WHEN hit THEN 0 END AS ga,
    CASE WHEN team = t1 THEN true WHEN team = t2 THEN false END AS is_home,
    CASE WHEN n % 2 = 0 THEN n WHEN hit THEN matchday * 1000 + least(t1, t2) * 20 + greatest(t1, t2) END AS match_id,
    CASE t1 WHEN 0 THEN 'ZER' WHEN 1 THEN 'ONE' WHEN 2 THEN 'TWO' ELSE CASE WHEN t1 % 4 = 3 THEN concat('N', t1) END END AS t1_code,
    CASE WHEN n % 13 = 0 THEN concat('S', t2) ELSE CASE WHEN t2 % 4 = 3 THEN concat('N', t2) ELSE CASE t2 WHEN 0 THEN 'ZER' WHEN 1 THEN 'ONE' WHEN 2 THEN 'TWO' END END END AS t2_code FROM f)
SELECT o_custkey, season AS season_label, matchday, concat(token, '-MD', lpad(CAST(matchday AS VARCHAR), 2, '0'), '-', coalesce(t1_code, 'TNA'), coalesce(t2_code, 'TNA')) AS match_uid, match_id, kickoff_ts, team AS team_id,
  CASE WHEN is_home THEN t2 WHEN NOT is_home THEN t1 END AS opponent_team_id, t1 AS t1_id, t2 AS t2_id, t1_code, t2_code, is_home, gh AS score_home, ga AS score_away,
  CASE WHEN is_home THEN CASE sign(gh - ga) WHEN 1 THEN 'W' WHEN -1 THEN 'L' WHEN 0 THEN 'D' END WHEN NOT is_home THEN CASE sign(ga - gh) WHEN 1 THEN 'W' WHEN -1 THEN 'L' WHEN 0 THEN 'D' END END AS match_result,
  CAST(floor(o_totalprice / 1000) AS BIGINT) AS points_total, n AS raw_n FROM g"""


@query("j11_performance_rows", SQL)
def j11_rows(spark, d):
    """Fixtures know half of the pairs, each in one order; teams 16 and 17 are out of scope."""
    pairs = table(spark, d, "orders").select(F.month("o_orderdate").cast("long").alias("day"), (F.col("o_custkey") % 18).alias("a"), (F.col("o_orderkey") % 18).alias("b")).where("(a + b) % 2 = 0").select("day", F.least("a", "b").alias("t1"), F.greatest("a", "b").alias("t2")).distinct()
    fixtures = pairs.select("day", "t1", "t2", (F.col("day") * 1000 + F.col("t1") * 20 + F.col("t2")).alias("match_id"), S.parse_time(F.lit("1999-01-01T00:00:00Z")).alias("kickoff"), F.lit(1).cast("long").alias("t1_goals"), F.lit(0).cast("long").alias("t2_goals"))
    known = spark.range(18).select(F.col("id").alias("team"), F.when(F.col("id") % 4 == 3, F.concat(F.lit("n "), F.col("id").cast("string"))).alias("code"))
    rows = matches.performance_rows(_payloads(spark, d), "o_custkey", "payload", active_season=ACTIVE, fixtures=fixtures, codes=known, default_codes=CODES, allowed=spark.range(16).toDF("team"))
    return rows.withColumns({"kickoff_ts": F.col("kickoff_ts").cast("timestamp_ntz"), "raw_n": F.get_json_object("raw_json", "$.n").cast("long")}).drop("raw_json")
