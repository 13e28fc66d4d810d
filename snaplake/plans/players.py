"""Queries: player rows from payloads and pages, entity matching, exports of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import pages as P
from ..functions import scalars as S
from ..operators import latest, players, silver
from ..sources import snapshots
from ..sources.tables import table
from .catalog import query

NOW = "TIMESTAMP '1998-08-01 00:00:00'"
POSITIONS = {1: "GK", 2: "DEF", 3: "MID", 4: "FWD"}
INJURIES = {0: "fit", 1: "injured", 2: "doubtful"}
COLORS = {1: "green", 2: "yellow", 3: "orange", 4: "red"}
CHANCES = {1: "likely", 2: "probable", 3: "open", 4: "unlikely"}


def _payloads(spark, d) -> DataFrame:
    """Customers as players: a market and a details object in JSON, and their orders as
    matches, values and transfers."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"))
    match = F.to_json(F.struct(
        F.month("o_orderdate").alias("md"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey") % 50).alias("p"),
        F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderkey") % 90).alias("mins"), (F.col("o_orderkey") % 2).alias("st"),
    ))
    value = F.struct(F.col("o_orderdate").alias("time"), F.col("o_totalprice").alias("value"))
    by = F.array_sort(F.collect_list(F.struct("o_orderdate", "o_orderkey", match.alias("m"))))
    nested = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.transform(by, lambda x: F.from_json(x["m"], "map<string,string>")).alias("matches"), F.collect_list(value).alias("values"), F.collect_list(F.when(F.col("o_orderstatus") == "F", value)).alias("transfers"))
    c, k = table(spark, d, "customer"), F.col("c_custkey")
    market = F.to_json(F.struct(
        k.alias("i"), F.col("c_name").alias("n"), F.when(k % 3 > 0, F.col("c_nationkey")).alias("tid"), (k % 5).alias("pos"), F.when(k % 4 > 0, F.floor("c_acctbal")).alias("mv"),
        F.when(k % 7 > 0, k % 3).alias("st"), F.when(k % 2 == 0, k % 6).alias("prob"), F.when(k % 5 == 0, F.lit(" ")).alias("fn"),
    ))
    details = F.to_json(F.struct(
        F.col("c_mktsegment").alias("fn"), F.when(k % 6 > 0, F.concat(F.lit("L"), k)).alias("ln"), F.lit(99).alias("tid"), (k % 1000).alias("cv"), (k % 4).alias("st"), F.when(k % 2 == 0, k % 11).alias("smc"),
        F.when(k % 2 == 0, k % 7).alias("ismc"), F.when(k % 9 == 0, F.lit("12.5")).alias("avg_minutes"), (k % 13).alias("g"), (k % 8).alias("yellow_cards"), F.lit("2024-01-01").alias("ts"),
    ))
    asked = c.select("c_custkey", F.from_json(market, "map<string,string>").alias("market"), F.from_json(details, "map<string,string>").alias("details"))
    return asked.join(nested, "c_custkey", "left")


@query("j1_player_row", f"""
WITH o AS (SELECT *, CAST(o_orderkey % 50 AS DOUBLE) AS p, CASE WHEN o_orderkey % 4 > 0 THEN CAST(o_orderkey % 90 AS DOUBLE) END AS mins, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS seq FROM orders),
m AS (SELECT o_custkey AS k, count(*) FILTER (o_orderstatus = 'F' OR coalesce(mins, 0) > 0) AS played, count(*) FILTER (o_orderkey % 2 = 1) AS started, coalesce(sum(mins), 0) AS minutes, max(month(o_orderdate)) AS last_day,
  arg_max(p, (month(o_orderdate), seq)) FILTER (o_orderstatus = 'F' AND month(o_orderdate) = top) AS last_points_top, arg_max(p, seq) FILTER (o_orderstatus = 'F') AS any_points
  FROM (SELECT *, max(month(o_orderdate)) OVER (PARTITION BY o_custkey) AS top FROM o) GROUP BY 1),
v AS (SELECT o_custkey AS k, max(o_totalprice) FILTER (o_orderdate >= {NOW} - INTERVAL 365 DAY) AS hi, min(o_totalprice) FILTER (o_orderdate >= {NOW} - INTERVAL 365 DAY) AS lo, max(o_totalprice) AS hi_all, min(o_totalprice) AS lo_all,
  count(*) FILTER (o_orderdate >= {NOW} - INTERVAL 10 DAY) AS n_10, avg(o_totalprice) FILTER (o_orderdate >= {NOW} - INTERVAL 10 DAY AND o_orderstatus = 'F') AS paid FROM orders GROUP BY 1),
c AS (SELECT *, c_custkey AS k, CASE WHEN c_custkey % 4 > 0 THEN CAST(floor(c_acctbal) AS BIGINT) ELSE c_custkey % 1000 END AS mv, CASE WHEN c_custkey % 7 > 0 THEN c_custkey % 3 ELSE c_custkey % 4 END AS st FROM customer)
SELECT c.c_custkey, CAST(c.k AS VARCHAR) AS player_id, c_mktsegment AS first_name, concat(c_mktsegment, ' ', CASE WHEN c.k % 6 > 0 THEN concat('L', c.k) ELSE c_name END) AS player_name, CASE WHEN c.k % 3 > 0 THEN CAST(c_nationkey AS VARCHAR) ELSE '99' END AS team_id,
  CASE c.k % 5 WHEN 1 THEN 'GK' WHEN 2 THEN 'DEF' WHEN 3 THEN 'MID' WHEN 4 THEN 'FWD' ELSE 'unknown' END AS position, mv AS market_value,
  CAST(round(coalesce(hi, hi_all, mv)) AS BIGINT) AS market_value_high_365d, CAST(round(coalesce(lo, lo_all, mv)) AS BIGINT) AS market_value_low_365d, coalesce(n_10, 0) AS n_history, round(paid, 2) AS average_paid_price_10d,
  CASE WHEN c.k % 2 = 0 THEN greatest(c.k % 11, c.k % 7) ELSE nullif(played, 0) END AS appearances_total, CASE WHEN c.k % 2 = 0 THEN least(c.k % 11, c.k % 7) ELSE nullif(started, 0) END AS starts_total,
  round(CASE WHEN c.k % 9 = 0 THEN 12.5 ELSE nullif(minutes, 0) / nullif(CASE WHEN c.k % 2 = 0 THEN greatest(c.k % 11, c.k % 7) ELSE nullif(played, 0) END, 0) END, 2) AS average_minutes,
  last_day AS last_matchday, c.k % 13 AS goals_total, c.k % 8 AS yellow_cards_total, CASE st WHEN 0 THEN 'fit' WHEN 1 THEN 'injured' WHEN 2 THEN 'doubtful' ELSE 'unknown' END AS injury_status, st = 1 AS is_injured,
  CASE WHEN c.k % 2 = 0 THEN CASE c.k % 6 WHEN 2 THEN 'probable' WHEN 4 THEN 'unlikely' ELSE 'unknown' END ELSE 'unknown' END AS start_probability_label, '2024-01-01' AS status_last_updated_at
FROM c LEFT JOIN m ON m.k = c.k LEFT JOIN v ON v.k = c.k""")  # fmt: skip
def j1(spark, d):
    rows = _player_rows(spark, d)
    # last_match_points has a test of its own: it depends on the order of the matches.
    return rows.withColumn("n_history", F.size("market_value_history_10d").cast("long")).select(
        "c_custkey", "player_id", "first_name", "player_name", "team_id", "position", "market_value", "market_value_high_365d", "market_value_low_365d", "n_history", "average_paid_price_10d",
        "appearances_total", "starts_total", "average_minutes", "last_matchday", "goals_total", "yellow_cards_total", "injury_status", "is_injured", "start_probability_label", "status_last_updated_at",
    )


def _player_rows(spark, d) -> DataFrame:
    payloads = _payloads(spark, d).withColumns({c: F.coalesce(c, F.array().cast("array<struct<time:timestamp,value:double>>")) for c in ("values", "transfers")})
    return players.player_row(
        payloads, ["c_custkey"], market="market", details="details", matches="matches", values="values", transfers="transfers", now=F.expr(NOW),
        positions=POSITIONS, injuries=INJURIES, injured=[1], chances=CHANCES, colors=COLORS,
    )


@query("j1_raw_columns", """
WITH o AS (SELECT o_custkey AS k, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f, CAST(arg_min(month(o_orderdate), (o_orderdate, o_orderkey)) AS VARCHAR) AS first_day FROM orders GROUP BY 1)
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN CASE c_custkey % 6 WHEN 2 THEN 'yellow' WHEN 4 THEN 'red' ELSE 'unknown' END ELSE 'unknown' END AS start_probability_color, c_name AS market_name, c_mktsegment AS details_name, n AS n_matches, first_day, coalesce(f, 0) AS n_transfers
FROM customer LEFT JOIN o ON k = c_custkey""")  # fmt: skip
def j1_raw(spark, d):
    rows = _player_rows(spark, d)
    return rows.select("c_custkey", "start_probability_color", F.col("raw_market_row.n").alias("market_name"), F.col("raw_player_details.fn").alias("details_name"), F.size("raw_player_performance").cast("long").alias("n_matches"), F.get("raw_player_performance", F.lit(0))["md"].alias("first_day"), F.size("raw_player_transfers").cast("long").alias("n_transfers"))


#: Teams, their names and the first parts of their pages' addresses.
TEAMS = {k: f"T{k:02d}" for k in range(20)}
TEAM_NAMES = {f"T{k:02d}": f"Team {k}" for k in range(0, 20, 2)}
SITE = ("site.example", "https://www.site.example", "/squad/")
_NAME = "CASE WHEN c_custkey % 50 = 7 THEN 'Same Name' ELSE concat(c_mktsegment, ' ', CASE WHEN c_custkey % 6 > 0 THEN concat('L', c_custkey) ELSE c_name END) END"


def _team_pages(spark, d) -> DataFrame:
    """Pages of two of three players: every third one has two of its name, another third one of its slug."""
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", F.expr(_NAME).alias("name"))
    k, n = F.col("c_custkey"), F.col("n")
    twice = c.where("c_custkey % 3 < 2").withColumn("n", F.explode(F.array(F.lit(0), F.lit(1)))).where("n = 0 or c_custkey % 3 = 0")
    by_name = k % 3 == 0
    text = lambda c: c.cast("string")
    return twice.select(
        F.when(by_name, F.lit("no-slug")).otherwise(S.slug(F.col("name"))).alias("slug"), text(k * 10 + n).alias("page_player_id"),
        F.when(by_name, F.translate("name", "AEIO", "ÀËÌÔ")).otherwise("zzz").alias("page_name"), F.when(k % 4 == 0, F.lit("03.02.1999")).when(k % 4 == 1, F.lit("2000/01/01")).when(k % 4 == 2, F.lit("2001-05-06")).alias("birthdate"),
        F.concat(F.lit("http://www.site.example/"), F.when(n == 0, F.concat(F.lit("team-"), text(F.col("c_nationkey")))).otherwise("other"), F.lit("/12/squad/?x=1")).alias("source_url"), F.concat(F.lit("p"), text(k)).alias("profile_url"),
        F.lit(None).cast("string").alias("image_url"), F.when(n == 0, " bench ").otherwise("starter").alias("lineup"), F.lit("fit").alias("status"), F.when(k % 5 == 0, "HIGH ").when(k % 5 == 1, "none").alias("risk"),
        F.when(k % 5 != 3, F.array_repeat(F.lit("X"), (k % 3).cast("int"))).alias("competitors"), F.when(k % 7 == 0, F.lit("2")).alias("competitor_count"), F.when(n == 1, F.lit("2024-02-01")).otherwise("2024-01-01").alias("last_changed_at"),
        F.lit("2023-01-01").alias("first_seen_at"), F.lit("2024-03-01").alias("scraped_at"), k.alias("at"), n.alias("n"),
    )


@query("k1_silver_players", f"""
WITH c AS (SELECT *, {_NAME} AS name, CASE WHEN c_custkey % 3 > 0 THEN c_nationkey ELSE 99 END AS team_id FROM customer),
t AS (SELECT *, CASE WHEN team_id < 20 THEN concat('T', lpad(CAST(team_id AS VARCHAR), 2, '0')) END AS kb FROM c),
pg AS (SELECT c.c_custkey AS pk, n, c.name, c_nationkey, CASE WHEN n = 0 THEN CASE WHEN c_nationkey < 15 THEN concat('U', c_nationkey) ELSE 'TEA' END ELSE 'OTH' END AS code FROM c, (SELECT unnest([0, 1]) AS n) WHERE c_custkey % 3 = 0 OR (c_custkey % 3 = 1 AND n = 0)),
m AS (SELECT t.*, coalesce(
    (SELECT max_by(pk * 10 + n, (n, -pk)) FROM pg WHERE pk % 3 = 0 AND pg.name = t.name),
    CASE WHEN t.c_custkey % 3 < 3 THEN (SELECT min(pk * 10 + n) FROM pg WHERE pk % 3 = 1 AND pg.name = t.name) END) AS page FROM t),
x AS (SELECT m.*, page // 10 AS pk, page % 10 AS n, pg.code, CASE WHEN page // 10 % 4 = 0 THEN '1999-02-03' WHEN page // 10 % 4 = 2 THEN '2001-05-06' END AS born FROM m LEFT JOIN pg ON page = pg.pk * 10 + pg.n),
b AS (SELECT *, concat(CASE WHEN name = 'Same Name' THEN 'SameName' ELSE concat(upper(left(lower(c_mktsegment), 1)), substr(lower(c_mktsegment), 2), CASE WHEN c_custkey % 6 > 0 THEN concat('L', c_custkey) ELSE concat('Customer', split_part(c_name, '#', 2)) END) END, coalesce(replace(born, '-', ''), '00000000')) AS base FROM x),
r AS (SELECT *, coalesce(kb, code) AS team, CASE WHEN pk % 7 = 0 THEN 2 WHEN pk % 5 <> 3 THEN pk % 3 END AS told FROM b)
SELECT CASE WHEN c_custkey = min(c_custkey) OVER (PARTITION BY base) THEN base ELSE concat(base, '_', c_custkey) END AS player_uid, name AS player_name, born AS player_birthdate, team AS team_uid,
  CASE WHEN regexp_matches(team, '^T[0-9][02468]$') THEN concat('Team ', CAST(substr(team, 2) AS INTEGER)) ELSE '' END AS team_name, CASE c_custkey % 5 WHEN 1 THEN 'GK' WHEN 2 THEN 'DEF' WHEN 3 THEN 'MID' WHEN 4 THEN 'FWD' ELSE 'UNKNOWN' END AS player_position,
  9899 AS season_uid, '1998-08-01' AS snapshot_date, CAST(c_custkey AS VARCHAR) AS player_id, team_id, c_custkey % 13 AS goals_total, page AS page_player_id, CASE WHEN page IS NULL THEN '' WHEN pk % 3 = 0 THEN 'no-slug' ELSE regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g') END AS page_slug,
  CASE WHEN page IS NULL THEN '' ELSE concat('https://www.site.example/', CASE WHEN n = 0 THEN concat('team-', (SELECT c_nationkey FROM pg WHERE pg.pk = r.pk LIMIT 1)) ELSE 'other' END, '/12/') END AS page_team_url,
  CASE WHEN page IS NULL THEN '' WHEN n = 0 THEN 'bench' ELSE 'starter' END AS page_predicted_lineup, CASE WHEN pk % 5 = 0 THEN 'high' WHEN told IS NULL THEN 'unknown' WHEN told = 0 THEN 'low' WHEN told = 1 THEN 'medium' ELSE 'high' END AS page_competition_risk,
  coalesce(told, 0) AS page_competitor_count, CASE WHEN pk % 5 <> 3 THEN pk % 3 ELSE 0 END AS n_competitors, CASE WHEN page IS NULL THEN '' WHEN n = 1 THEN '2024-02-01' ELSE '2024-01-01' END AS page_last_changed_at
FROM r""")  # fmt: skip
def k1_silver(spark, d):
    """Names in other spellings, two pages of a name, slugs, and many players of one name."""
    rows = _player_rows(spark, d).join(table(spark, d, "customer").select("c_custkey", F.expr(_NAME).alias("given")), "c_custkey").withColumn("player_name", F.col("given")).drop("given")
    url_codes = {f"team-{k}": f"U{k}" for k in range(15)}
    out = silver.silver_players(rows, _team_pages(spark, d), stamp="1998-08-01T000000Z", order=["c_custkey"], page_order=[F.col("at"), F.col("n")], team_codes=TEAMS, team_names=TEAM_NAMES, url_codes=url_codes, site=SITE)
    assert len(out.columns) == 45
    return out.withColumn("n_competitors", F.size("page_competitor_names").cast("long")).select(
        "player_uid", "player_name", "player_birthdate", "team_uid", "team_name", "player_position", "season_uid", "snapshot_date", "player_id", "team_id", "goals_total", "page_player_id", "page_slug", "page_team_url",
        "page_predicted_lineup", "page_competition_risk", "page_competitor_count", "n_competitors", "page_last_changed_at",
    )


_R = "(SELECT *, s_suppkey % 3 AS team, s_suppkey % 20 AS slug FROM supplier WHERE s_nationkey < 15)"
_MATCHED = f"""r AS {_R},
n AS (SELECT c.c_custkey, r.s_suppkey, row_number() OVER (PARTITION BY c_custkey ORDER BY (c_custkey % 3 = team) DESC, s_acctbal DESC, s_suppkey) AS rn FROM customer c JOIN r ON c_nationkey = s_nationkey),
s AS (SELECT slug, s_suppkey FROM r QUALIFY row_number() OVER (PARTITION BY slug ORDER BY s_acctbal DESC, s_suppkey) = 1),
e AS (SELECT c.*, coalesce(n.s_suppkey, s.s_suppkey) AS s_suppkey FROM customer c LEFT JOIN n ON n.c_custkey = c.c_custkey AND rn = 1 LEFT JOIN s ON c.c_custkey % 50 = s.slug)"""


def _matched(spark, d, left: DataFrame, values) -> DataFrame:
    s = table(spark, d, "supplier").where("s_nationkey < 15").withColumns({"team": F.col("s_suppkey") % 3, "slug": F.col("s_suppkey") % 20})
    return players.match_entities(
        left, s, name=(F.col("c_nationkey"), "s_nationkey"), team=(F.col("c_custkey") % 3, "team"), slug=(F.col("c_custkey") % 50, "slug"),
        order=[F.col("s_acctbal").desc(), F.col("s_suppkey")], values=values,
    )


@query("c1_entity_match_with_slug", f"WITH {_MATCHED} SELECT c_custkey, s_suppkey FROM e")
def c1b(spark, d):
    return _matched(spark, d, table(spark, d, "customer"), ["s_suppkey"]).select("c_custkey", "s_suppkey")


@query("k1_player_snapshot_matched", f"""
WITH {_MATCHED}, k AS (SELECT *, concat(lower(c_mktsegment), '_', coalesce(CAST(s_suppkey AS VARCHAR), 'unknown')) AS base FROM e)
SELECT c_custkey, CASE WHEN row_number() OVER (PARTITION BY base ORDER BY c_custkey) > 1 THEN concat(base, '_', c_custkey) ELSE base END AS player_uid, concat(c_mktsegment, ' ', CASE WHEN c_custkey % 6 > 0 THEN concat('L', c_custkey) ELSE c_name END) AS player_name,
  coalesce(CASE WHEN c_custkey % 3 > 0 THEN concat('T', c_nationkey) ELSE 'T99' END, concat('T', s_suppkey)) AS team_uid, s_suppkey AS page_id, 'https://site.example/' || s_suppkey || '/' AS page_url,
  CASE WHEN c_custkey % 4 > 0 THEN CAST(floor(c_acctbal) AS BIGINT) ELSE c_custkey % 1000 END AS market_value, c_custkey % 13 AS goals_total, '1998-08-01' AS snapshot_date, CAST(9899 AS INTEGER) AS season_uid FROM k""")  # fmt: skip
def k1b(spark, d):
    """Payload rows with their page, a key that is unique, and the snapshot's date and season."""
    rows = _player_rows(spark, d).join(table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"), "c_custkey")
    found = _matched(spark, d, rows, ["s_suppkey"])
    base = F.concat_ws("_", F.lower("c_mktsegment"), F.coalesce(F.col("s_suppkey").cast("string"), F.lit("unknown")))
    n = F.row_number().over(Window.partitionBy("base").orderBy("c_custkey"))
    keyed = found.withColumn("base", base).withColumn("player_uid", F.when(n > 1, F.concat_ws("_", "base", F.col("c_custkey").cast("string"))).otherwise(F.col("base")))
    now = F.expr(NOW)
    return keyed.select(
        "c_custkey", "player_uid", "player_name", F.coalesce(F.concat(F.lit("T"), "team_id"), F.concat(F.lit("T"), F.col("s_suppkey").cast("string"))).alias("team_uid"), F.col("s_suppkey").alias("page_id"),
        F.concat(F.lit("https://site.example/"), F.col("s_suppkey").cast("string"), F.lit("/")).alias("page_url"), "market_value", "goals_total", F.date_format(now, "yyyy-MM-dd").alias("snapshot_date"), S.season_of(now).alias("season_uid"),
    )


@query("c11_comparison_mart", """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS rn FROM orders),
s AS (SELECT o_custkey, round(avg(o_totalprice) FILTER (rn <= 5), 4) AS avg_points_last_5, round(avg(o_totalprice) FILTER (rn <= 10), 4) AS avg_points_last_10, count(*) FILTER (rn <= 5) AS matches_last_5, count(*) FILTER (rn <= 10) AS matches_last_10, max(o_totalprice) FILTER (rn = 1) AS current_value, CAST(max(o_orderdate) FILTER (rn = 1) AS DATE) AS current_value_date FROM r GROUP BY 1)
SELECT c_custkey, c_name, n_name AS team_name, current_value, current_value_date, avg_points_last_5, avg_points_last_10, matches_last_5, matches_last_10 FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN s ON o_custkey = c_custkey""")  # fmt: skip
def c11(spark, d):
    """Profiles with their newest value and the averages of their last 5 and 10 rows: one
    ranking of the facts gives all three."""
    r = latest.newest_per_key(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], n=10, rank="rn")
    avg = lambda n: F.round(F.avg(F.when(F.col("rn") <= n, F.col("o_totalprice"))), 4).alias(f"avg_points_last_{n}")
    newest = lambda c, name: F.max(F.when(F.col("rn") == 1, F.col(c))).alias(name)
    stats = r.groupBy(F.col("o_custkey").alias("c_custkey")).agg(avg(5), avg(10), F.count_if(F.col("rn") <= 5).alias("matches_last_5"), F.count_if(F.col("rn") <= 10).alias("matches_last_10"), newest("o_totalprice", "current_value"), newest("o_orderdate", "day"))
    teams = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("team_name"))
    out = table(spark, d, "customer").join(teams, "c_nationkey", "left").join(stats, "c_custkey", "left")
    return out.select("c_custkey", "c_name", "team_name", "current_value", F.col("day").cast("date").alias("current_value_date"), "avg_points_last_5", "avg_points_last_10", "matches_last_5", "matches_last_10")


@query("a18_lineup_export", """
WITH t AS (SELECT concat('http://', CASE WHEN n_nationkey % 2 = 0 THEN 'www.' ELSE '' END, 'site.example/', n_nationkey, '/') AS url, n_name AS team_uid FROM nation WHERE n_nationkey < 20)
SELECT c_custkey AS player_id, team_uid, CASE WHEN c_nationkey < 24 THEN concat('http://', CASE WHEN c_nationkey % 2 = 0 THEN 'www.' ELSE '' END, 'site.example/', c_nationkey, '/') END AS team_source_url, nullif(trim(c_mktsegment), '') AS status, '1998-08-01' AS source_snapshot_ts
FROM customer LEFT JOIN t ON t.url = concat('http://', CASE WHEN c_nationkey % 2 = 0 THEN 'www.' ELSE '' END, 'site.example/', c_nationkey, '/') AND c_nationkey < 24""")  # fmt: skip
def a18_lineup(spark, d):
    """Rows of the newest snapshot with the key of their team, by the team page's URL."""
    url = lambda c: F.concat(F.lit("http://"), F.when(F.col(c) % 2 == 0, "www.").otherwise(""), F.lit("site.example/"), F.col(c).cast("string"), F.lit("/"))
    day = F.when(F.col("stamp") == 1, "1998-07-01").otherwise("1998-08-01")
    rows = table(spark, d, "customer").crossJoin(F.broadcast(spark.range(1, 3).toDF("stamp"))).withColumn("source_snapshot_ts", day)  # two snapshots of each row
    newest = snapshots.pinned(rows, snapshots.latest_common([rows], "source_snapshot_ts"), "source_snapshot_ts")
    teams = table(spark, d, "nation").where("n_nationkey < 20").select(url("n_nationkey").alias("url"), F.col("n_name").alias("team_uid"))
    found = newest.withColumn("team_source_url", F.when(F.col("c_nationkey") < 24, url("c_nationkey"))).join(teams, F.col("team_source_url") == F.col("url"), "left")
    return found.select(F.col("c_custkey").alias("player_id"), "team_uid", "team_source_url", S.to_text(F.col("c_mktsegment")).alias("status"), "source_snapshot_ts")


@query("a18_odds_export", """
WITH t AS (SELECT lower(replace(n_name, '_', ' ')) AS k, n_nationkey AS uid FROM nation WHERE n_nationkey < 20)
SELECT o_orderkey AS odds_event_id, h.n_name AS home_team_name, a.n_name AS away_team_name, th.uid AS home_team_uid, ta.uid AS away_team_uid, o_totalprice AS h2h_home_odds FROM orders
LEFT JOIN nation h ON h.n_nationkey = o_orderkey % 25 LEFT JOIN nation a ON a.n_nationkey = o_custkey % 25 LEFT JOIN t th ON th.k = lower(replace(h.n_name, '_', ' ')) LEFT JOIN t ta ON ta.k = lower(replace(a.n_name, '_', ' '))""")  # fmt: skip
def a18_odds(spark, d):
    """Events with the keys of both teams, by their normalised names."""
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    names = lambda key, out: n.select(F.col("n_nationkey").alias(key), F.col("n_name").alias(out))
    key = lambda c: S.name_key(F.replace(F.col(c), F.lit("_"), F.lit(" ")))
    teams = lambda k, out: n.where("n_nationkey < 20").select(key("n_name").alias(k), F.col("n_nationkey").alias(out))
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("odds_event_id"), (F.col("o_orderkey") % 25).alias("home"), (F.col("o_custkey") % 25).alias("away"), F.col("o_totalprice").alias("h2h_home_odds"))
    named = o.join(names("home", "home_team_name"), "home", "left").join(names("away", "away_team_name"), "away", "left").withColumns({"hk": key("home_team_name"), "ak": key("away_team_name")})
    return named.join(teams("hk", "home_team_uid"), "hk", "left").join(teams("ak", "away_team_uid"), "ak", "left").select("odds_event_id", "home_team_name", "away_team_name", "home_team_uid", "away_team_uid", "h2h_home_odds")


def run_exports(live: DataFrame, folds: dict[str, DataFrame], champion: DataFrame, stamp: str, metric: str = "rmse") -> dict[str, DataFrame]:
    """The four tables of a model run: live predictions with the champion's name, the folds
    of all families with theirs, the champion (the first family where it is missing), and a
    summary. champion(champion, reason) has one row or none."""
    families, at = list(folds), F.lit(stamp).alias("ml_run_ts")
    every = snapshots.tagged_union(folds, "model_family")
    means = every.groupBy().agg(*[F.avg(F.when(F.col("model_family") == f, F.col(metric))).alias(f"{f}_score") for f in families])
    chosen = means.join(champion.limit(1), how="left").select(  # one row with one or none
        at, F.coalesce("champion", F.lit(families[0])).alias("champion_model"), F.coalesce("reason", F.lit("fallback: no champion was chosen")).alias("champion_reason"), F.lit(metric).alias("metric_key"), *[f"{f}_score" for f in families]
    )
    name = F.broadcast(chosen.select("champion_model"))
    summary = live.agg(F.count(F.lit(1)).alias("live_rows")).join(every.agg(F.count(F.lit(1)).alias("fold_rows"))).join(chosen.drop("champion_reason", "metric_key"))
    return {"live": live.join(name).withColumn("ml_run_ts", F.lit(stamp)), "folds": every.withColumn("ml_run_ts", F.lit(stamp)), "champion": chosen, "run": summary}


@query("a16_run_exports", """
WITH l AS (SELECT avg(value) AS view_score FROM events WHERE event_type = 'view'), p AS (SELECT avg(value) AS buy_score FROM events WHERE event_type = 'purchase')
SELECT 'live' AS table_name, count(*) AS n, 'view' AS champion_model, CAST(NULL AS DOUBLE) AS score FROM customer UNION ALL SELECT 'folds', count(*), NULL, round(sum(value), 2) FROM events WHERE event_type IN ('view', 'purchase')
UNION ALL SELECT 'champion', 1, 'view', round(view_score, 4) FROM l UNION ALL SELECT 'run', (SELECT count(*) FROM customer), 'view', round(buy_score, 4) FROM p""")  # fmt: skip
def a16b(spark, d):
    e = table(spark, d, "events").select("event_id", F.col("value").alias("rmse"), "event_type")
    folds = {"view": e.where("event_type = 'view'").drop("event_type"), "purchase": e.where("event_type = 'purchase'").withColumn("extra", F.lit(1)).drop("event_type")}
    none = spark.createDataFrame([], "champion string, reason string")
    got = run_exports(table(spark, d, "customer").select("c_custkey"), folds, none, "1998-08-01")
    n, no = F.count(F.lit(1)).alias("n"), F.lit(None).cast("double").alias("score")
    live = got["live"].groupBy("champion_model").agg(n).select(F.lit("live").alias("table_name"), "n", "champion_model", no)
    fold = got["folds"].agg(n, F.round(F.sum("rmse"), 2).alias("score")).select(F.lit("folds"), "n", F.lit(None).cast("string"), "score")
    best = got["champion"].select(F.lit("champion"), F.lit(1).cast("long"), "champion_model", F.round("view_score", 4))
    return live.union(fold).union(best).union(got["run"].select(F.lit("run"), "live_rows", "champion_model", F.round("purchase_score", 4)))


def _squad_pages(spark, d) -> DataFrame:
    """Pages with rows for each of the parsers around their own HTML, by page_id."""
    i = F.col("page_id").cast("string")
    script = F.concat(F.lit("<script id=\"__NEXT_DATA__\">{&quot;a&quot;:[{\"player_name\":\"P"), i, F.lit("\",\"slug\":\"p-"), i, F.lit("\",\"status\":\"fit\",\"sub\":{\"name\":\"Q"), i, F.lit("\",\"lineUp\":true}},{\"name\":\"no row\"}]}</script>"))
    link = lambda who, body: F.concat(F.lit(f'<a href="/{who}-'), i, F.lit(f'_7/">{body}</a>'))
    photo = lambda who, alt: F.concat(F.lit('<div class="player_position_photo left"><div class="sub_pic">'), link(who, f'<img alt="{alt}">'), F.lit("</div><div><div>7</div></div></div>"))
    sub = lambda who, name: F.concat(F.lit('<div class="sub_child" style="x">'), photo(who, ""), F.lit('<div class="player_name">'), link(who, name), F.lit("</div></div>"))
    area = F.concat(
        F.lit('<div class="box"><div class="player_position_row"><div class="player_position_column x">'), sub("ann", "M&uuml;ller &amp; Ann"), sub("bob", ""),
        F.lit('</div></div></div><div class="team_squad_area"><div class="player_position_column">'), photo("cid", "CID"), link("not", "a photo"), F.lit('</div><div class="player_position_column">'), photo("ann", ""),
        F.lit('</div></div><div class="league_name_holder"></div>'), photo("far", "behind the league"),
    )
    tags = F.concat(F.lit("<i data-player-name='D &amp; "), i, F.lit("' data-player-id='"), i, F.lit("' data-predicted-lineup='Bank'></i><i data-player-name=' '></i>"))
    kind = F.col("page_id") % 4
    return table(spark, d, "pages").select("page_id", "url", F.concat(F.when(kind == 0, script).otherwise(""), F.when(kind < 2, area).otherwise(""), F.when(kind < 3, tags).otherwise(""), "html").alias("html"))


@query("j18_player_rows", """
SELECT page_id, 0 AS parser, concat('p-', page_id) AS slug, concat('P', page_id) AS player_name, 'fit' AS status, 'unknown' AS lineup, '' AS competitors FROM pages WHERE page_id % 4 = 0
UNION ALL SELECT page_id, 0, '', concat('Q', page_id), 'unknown', 'starter', '' FROM pages WHERE page_id % 4 = 0
UNION ALL SELECT page_id, 1, concat('ann-', page_id), 'Müller & Ann', 'unknown', 'starter', concat('Bob ', page_id) FROM pages WHERE page_id % 4 = 1
UNION ALL SELECT page_id, 1, concat('bob-', page_id), concat('Bob ', page_id), 'unknown', 'starter', 'Müller & Ann' FROM pages WHERE page_id % 4 = 1
UNION ALL SELECT page_id, 1, concat('cid-', page_id), 'CID', 'unknown', 'bench', '' FROM pages WHERE page_id % 4 = 1
UNION ALL SELECT page_id, 2, CAST(page_id AS VARCHAR), concat('D & ', page_id), 'unknown', 'bench', '' FROM pages WHERE page_id % 4 = 2""")  # fmt: skip
def j18_rows(spark, d):
    rows = P.player_rows(_squad_pages(spark, d), "page_id", "html")
    return rows.select("page_id", "parser", "slug", "player_name", "status", "lineup", F.array_join("competitors", ",").alias("competitors"))


@query("j18_squad_rows", """
SELECT page_id, CAST(0 AS INTEGER) AS place, concat('eva-', page_id) AS slug, concat('EVA & ', page_id) AS player_name, concat(regexp_extract(url, '^([a-z]+://[^/?#]+)', 1), '/eva-', page_id, '_8/') AS profile_url, concat(regexp_extract(url, '^([a-z]+://[^/?#]+)', 1), '/images/player/', page_id, '.png') AS image_url, DATE '1999-02-03' AS birthdate FROM pages
UNION ALL SELECT page_id, 1, concat('fay-', page_id), concat('Fay ', page_id), concat(regexp_extract(url, '^([a-z]+://[^/?#]+)', 1), '/fay-', page_id, '_9/'), NULL, NULL FROM pages
UNION ALL SELECT page_id, 2, concat('gil-', page_id), 'Gil é', concat(regexp_extract(url, '^([a-z]+://[^/?#]+)', 1), '/gil-', page_id, '_10/'), NULL, NULL FROM pages""")  # fmt: skip
def j18_squads(spark, d):
    i = F.col("page_id").cast("string")
    block = lambda who, n, name, more: F.concat(F.lit('<div class="leg_column_row"><div class="player_img">'), F.lit(f'<a href="/{who}-'), i, F.lit(f'_{n}/">'), name, F.lit("</a></div>"), more, F.lit("</div>"))
    eva = block("eva", 8, F.concat(F.lit("<b>EVA</b> &#x26; "), i), F.concat(F.lit('<img src="/logo.png"><div><img src="/images/player/'), i, F.lit('.png"> 03.02.1999</div>')))
    foot = F.lit('<div class="foot"><img src="/images/player/foot.png">05.06.1970</div>')
    pages = table(spark, d, "pages").select("page_id", "url", F.concat("html", eva, block("fay", 9, F.lit(""), F.lit(" 41.02.1999")), eva, block("gil", 10, F.lit('<img alt="Gil &eacute;">'), F.lit("")), foot).alias("html"))
    return P.squad_rows(pages, "page_id", "html", "url").select("page_id", "place", "slug", "player_name", "profile_url", "image_url", "birthdate")
