"""Queries: fixture payloads, team codes and addresses, team dimensions, records, landing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import nested as N
from ..functions import scalars as S
from ..operators import fixtures, latest, rollup
from ..sources import snapshots
from ..sources.tables import table
from .catalog import query
from .streams import scratch

CODES = {0: "AAA", 1: "BBB", 2: "CCC", 30: "ZZZ"}
CODES_SQL = "CASE {0} WHEN 0 THEN 'AAA' WHEN 1 THEN 'BBB' WHEN 2 THEN 'CCC' WHEN 30 THEN 'ZZZ' END"


def _payloads(spark, d):
    """The lines of an order as a list of days with one match each, under changing keys."""
    c = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_extendedprice", "l_quantity")
    match = F.struct((F.col("l_partkey") % 18).alias("t1"), F.when(F.col("l_quantity") < 48, F.col("l_suppkey") % 18).alias("t2"), F.when(F.col("l_linenumber") > 2, F.concat(F.lit(" t-"), F.col("l_partkey").cast("string"))).alias("t1sy"))
    day = F.struct(
        F.when(F.col("l_linenumber") < 4, F.col("l_linenumber")).alias("day"), F.when(F.col("l_linenumber") >= 4, F.col("l_linenumber") % 3).alias("matchday"), (F.col("l_returnflag") == "R").alias("isCurrent"),
        F.when(F.col("l_quantity") > 25, F.concat(F.lit("S"), F.col("l_partkey").cast("string"))).alias("season"), F.array(match).alias("it"),
    )
    order = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_returnflag")
    lines = c.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(*order, day.alias("day")))).alias("x"))
    text = F.to_json(F.transform("x", lambda x: x["day"]))
    key = F.when(F.col("l_orderkey") % 3 == 1, "it").otherwise("result")
    return lines.select("l_orderkey", F.when(F.col("l_orderkey") % 3 == 0, text).otherwise(F.concat(F.lit('{"'), key, F.lit('":'), text, F.lit("}"))).alias("payload"))


LINES = """(SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_returnflag) AS pos,
CAST(CASE WHEN l_linenumber < 4 THEN l_linenumber ELSE l_linenumber % 3 END AS BIGINT) AS day, l_partkey % 18 AS t1, CASE WHEN l_quantity < 48 THEN l_suppkey % 18 END AS t2 FROM lineitem)"""


@query("j15_fixture_lookup", f"SELECT l_orderkey, day, t1, t2, CASE WHEN l_linenumber > 2 THEN ' t-' || l_partkey END AS t1sy FROM {LINES} WHERE t2 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY l_orderkey, day, t1, t2 ORDER BY pos DESC) = 1")
def j15_lookup(spark, d):
    m = fixtures.matches_of(_payloads(spark, d), "payload", ["l_orderkey"])
    return fixtures.fixture_lookup(m, ["l_orderkey"]).select("l_orderkey", "day", "t1", "t2", "t1sy")


@query("j15_calendar", f"""
SELECT l_orderkey, coalesce(arg_max(day, pos) FILTER (l_returnflag = 'R'), max(day)) AS current_day, arg_min('S' || l_partkey, pos) FILTER (l_quantity > 25) AS season FROM {LINES} GROUP BY 1""")  # fmt: skip
def j15_calendar(spark, d):
    day, season = fixtures.calendar(F.col("days"))
    p = _payloads(spark, d).select("l_orderkey", fixtures.days_of(F.col("payload")).alias("days"))
    return p.select("l_orderkey", day.alias("current_day"), season.alias("season"))


@query("j15_team_symbols", f"""
WITH s AS (SELECT t1 AS team, CASE WHEN l_linenumber > 2 THEN 'T' || l_partkey END AS code, l_orderkey, pos FROM {LINES} UNION ALL SELECT t2, NULL, l_orderkey, pos FROM {LINES} WHERE t2 IS NOT NULL),
l AS (SELECT team, arg_max(code, l_orderkey * 1000 + pos) FILTER (code IS NOT NULL) AS code FROM s GROUP BY 1)
SELECT coalesce(l.team, k.team) AS team, coalesce(code, {CODES_SQL.format('coalesce(l.team, k.team)')}) AS code FROM l FULL JOIN (SELECT unnest([0, 1, 2, 30]) AS team) k ON l.team = k.team""")  # fmt: skip
def j15_symbols(spark, d):
    return fixtures.team_symbols(fixtures.matches_of(_payloads(spark, d), "payload", ["l_orderkey"]), ["l_orderkey"], CODES)


@query("h12_resolved_code", f"""
WITH m AS (SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN n_name WHEN n_nationkey % 3 = 1 THEN '' END AS mapped FROM nation)
SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment || c_custkey WHEN mapped <> '' THEN upper(regexp_replace(mapped, '[^A-Za-z0-9]+', '', 'g')) ELSE {CODES_SQL.format('c_nationkey')} END AS code FROM customer LEFT JOIN m ON n_nationkey = c_nationkey""")  # fmt: skip
def h12_resolved(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.when(F.col("n_nationkey") % 3 == 0, F.col("n_name")).when(F.col("n_nationkey") % 3 == 1, "").alias("mapped"))
    c = table(spark, d, "customer").join(n, "c_nationkey", "left")
    inline = F.when(F.col("c_custkey") % 4 == 0, F.concat_ws("-", F.lower("c_mktsegment"), F.col("c_custkey").cast("string"))).otherwise("")
    return c.select("c_custkey", fixtures.resolved_code(inline, F.col("mapped"), F.col("c_nationkey"), CODES).alias("code"))


@query("h12_code_of_url", "SELECT page_id, CASE p WHEN 'en' THEN 'ENG' WHEN 'fr' THEN 'FRA' ELSE nullif(upper(regexp_replace(substr(replace(p, '-', ''), 1, 3), '[^A-Za-z0-9]+', '', 'g')), '') END AS code FROM (SELECT page_id, lower(regexp_extract(url, '://[^/?#]*/*([^/?#]+)', 1)) AS p FROM pages)")
def h12_url(spark, d):
    return table(spark, d, "pages").select("page_id", fixtures.code_of_url(F.col("url"), {"en": "ENG", "fr": "FRA"}).alias("code"))


@query("h13_site_url", """
SELECT page_id, CASE WHEN NOT contains(url, 'example.com') THEN url WHEN NOT starts_with(s, 'https://www.') THEN s WHEN contains(p, '/en/') THEN split_part(p, '/en/', 1) || '/' WHEN p LIKE '%/' THEN p ELSE p || '/' END AS url
FROM (SELECT page_id, trim(url) AS url, regexp_replace(trim(url), '^http://', 'https://') AS s, regexp_replace(regexp_replace(trim(url), '^http://', 'https://'), '[?#].*$', '') AS p FROM pages)""")  # fmt: skip
def h13_site(spark, d):
    return table(spark, d, "pages").select("page_id", S.site_url(F.col("url"), "example.com", "https://www.", "/en/").alias("url"))


@query("h13_squad_url", r"""
SELECT page_id, h || CASE WHEN p LIKE '%/en/' THEN p WHEN contains(p, '/en/') THEN split_part(p, '/en/', 1) || '/en/' WHEN contains(p, '/fr/') THEN replace(p, '/fr/', '/en/') WHEN regexp_matches(p, '/[^/]+/\d+/?$') THEN regexp_replace(p, '/$', '') || '/en/' END AS url
FROM (SELECT page_id, regexp_extract(url, '^([A-Za-z]+://[^/?#]+)', 1) AS h, coalesce(nullif(regexp_extract(url, '^[A-Za-z]+://[^/?#]+([^?#]*)', 1), ''), '/') AS p FROM pages)""")  # fmt: skip
def h13_squad(spark, d):
    return table(spark, d, "pages").select("page_id", S.squad_url(F.col("url"), "/en/", "/fr/").alias("url"))


@query("j7_newest_marker_of_event", """
SELECT l_orderkey, strftime(greatest(max(l_shipdate + to_days(CAST(l_partkey % 200 AS INTEGER))), max(l_shipdate + to_days(CAST(l_suppkey % 300 AS INTEGER))), coalesce(min(CASE WHEN l_orderkey % 3 = 0 THEN l_shipdate + to_days(120) END), TIMESTAMP '1900-01-01')), '%Y-%m-%dT%H:%M:%SZ') AS newest FROM lineitem GROUP BY 1""")  # fmt: skip
def j7_event(spark, d):
    at = lambda days: F.date_format(F.timestamp_add("DAY", days, F.col("l_shipdate")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    market = F.struct(at(F.col("l_suppkey") % 300).alias("updatedAt"), F.lit("not a time").alias("last_update"))
    book = F.struct(at(F.col("l_partkey") % 200).alias("lastUpdate"), F.array(market).alias("markets"))
    own = F.min(F.when(F.col("l_orderkey") % 3 == 0, at(F.lit(120))))
    events = table(spark, d, "lineitem").groupBy("l_orderkey").agg(own.alias("updated_at"), F.collect_list(book).alias("bookmakers"))
    text = F.to_json(F.struct("updated_at", "bookmakers"))
    return events.select("l_orderkey", F.date_format(N.newest_event_marker(text), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("newest"))


@query("k11_team_dimension", f"""
WITH p AS (SELECT CASE WHEN c_custkey % 9 <> 0 THEN c_nationkey END AS id, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS c, CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS name, CASE WHEN c_custkey % 6 = 0 THEN 'u' || c_custkey END AS url, c_custkey AS o FROM customer),
q AS (SELECT id, coalesce(c, {CODES_SQL.format('id')}) AS code, name, url, o FROM p)
SELECT id, code, first(name ORDER BY o) AS name, arg_min(url, o) FILTER (url IS NOT NULL) AS url FROM q WHERE (id IS NULL OR id < 12) AND code IN ('AAA', 'BBB', 'BUILDING', 'MACHINERY') GROUP BY 1, 2""")  # fmt: skip
def k11_dimension(spark, d):
    c = F.col("c_custkey")
    rows = table(spark, d, "customer").select(
        F.when(c % 9 != 0, F.col("c_nationkey")).alias("id"), F.when(c % 4 != 0, F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit("."))).alias("code"), F.when(c % 5 != 0, F.col("c_name")).alias("name"),
        F.when(c % 6 == 0, F.concat(F.lit("u"), c.cast("string"))).alias("url"), "c_custkey",
    )
    return fixtures.dimension_rows(rows, "id", "code", "name", "url", [c], ids=range(12), codes=["AAA", "BBB", "BUILDING", "MACHINERY"], default_codes=CODES)


@query("a4_master_records", """
SELECT c_custkey AS player_id, CASE WHEN c_custkey % 10 = 1 THEN 'u-' || c_custkey WHEN c_custkey % 3 = 0 THEN 'Player' || c_custkey || '20000102' ELSE replace(initcap, '#', '') || '20000102' END AS player_uid, CASE WHEN c_custkey % 3 = 0 THEN 'player_' || c_custkey ELSE c_name END AS player_name, CAST(c_nationkey AS BIGINT) AS team_id
FROM (SELECT *, c_name AS initcap FROM customer)""")  # fmt: skip
def a4(spark, d):
    at = scratch(spark, "records")
    c = table(spark, d, "customer").withColumn("name", F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).otherwise(" "))
    uid = F.when(F.col("c_custkey") % 10 == 1, F.concat(F.lit("u-"), F.col("c_custkey").cast("string"))).otherwise(F.col("c_custkey").cast("string")).alias("uid")
    c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("player_id"), uid, "name", F.lit("02.01.2000").alias("birthday"), F.col("c_nationkey").alias("team_id")).write.option("header", True).csv(f"{at}/even")
    c.where("c_custkey % 2 = 1").select(F.concat(F.lit(" "), F.col("c_custkey").cast("string")).alias("pi"), uid, F.col("name").alias("player_name"), F.lit("2000-01-02").alias("dob"), F.col("c_nationkey").cast("double").alias("tid")).write.option("header", True).csv(f"{at}/odd")
    fields = {"player_uid": ("string", ["player_uid", "uid"]), "player_id": ("bigint", ["player_id", "id", "pi"]), "player_name": ("string", ["player_name", "name"]), "born": ("string", ["birthdate", "birthday", "dob"]), "team_id": ("double", ["team_id", "tid"])}
    read = snapshots.read_aliased_csv(spark, f"{at}/even", fields).unionByName(snapshots.read_aliased_csv(spark, f"{at}/odd", fields))
    out = snapshots.master_records(read.withColumn("born", S.parse_date(F.col("born"))), "player_uid", "player_id", "player_name", "born")
    return out.select("player_id", "player_uid", "player_name", S.to_int(F.col("team_id")).alias("team_id"))


@query("a8_bronze_landing", "SELECT 'customer' AS dataset, count(*) AS n, count(c_acctbal) AS n_known, '2024-01-30T120000Z' AS stamp, true AS loaded FROM customer UNION ALL SELECT 'supplier', count(*), count(s_acctbal), '2024-01-30T120000Z', true FROM supplier")
def a8(spark, d):
    at, stamp = scratch(spark, "landing"), "2024-01-30T120000Z"
    frames = {"customer": table(spark, d, "customer").withColumnRenamed("c_acctbal", "v"), "supplier": table(spark, d, "supplier").withColumnRenamed("s_acctbal", "v"), "lineups": None}
    names = snapshots.land_all(frames, ["customer"], at, stamp)
    every = snapshots.tagged_union({name: spark.read.parquet(f"{at}/{name}") for name in names}, "dataset")
    loaded = F.bool_and(F.col("bronze_loaded_at").isNotNull())
    return every.groupBy("dataset").agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("n_known"), F.max("bronze_file_timestamp").alias("stamp"), loaded.alias("loaded"))


@query("c12_team_outlook", """
WITH o AS (SELECT o_custkey % 22 AS team, o_custkey % 25 AS opponent, o_orderdate AS starts_at, (o_orderkey % 10) / 10.0 AS win, (o_orderkey % 3) / 4.0 AS draw, (o_orderkey % 7) / 8.0 AS loss FROM orders WHERE o_orderstatus = 'O' QUALIFY row_number() OVER (PARTITION BY o_custkey % 22 ORDER BY o_orderdate, o_orderkey) = 1),
l AS (SELECT s_nationkey AS team, count(*) FILTER (s_acctbal > 0) AS n_safe, string_agg(CASE WHEN s_acctbal > 0 THEN s_name END, ', ' ORDER BY s_suppkey) AS safe FROM supplier WHERE s_nationkey <> 5 GROUP BY 1)
SELECT n.n_name AS team, b.n_name AS opponent, starts_at, CASE WHEN win >= draw AND win >= loss THEN 'win' WHEN loss >= win AND loss >= draw THEN 'loss' ELSE 'draw' END AS outlook, n_safe, nullif(safe, '') AS safe
FROM nation n LEFT JOIN o ON o.team = n.n_nationkey LEFT JOIN nation b ON b.n_nationkey = o.opponent LEFT JOIN l ON l.team = n.n_nationkey""")  # fmt: skip
def c12_outlook(spark, d):
    k = F.col("o_orderkey")
    o = table(spark, d, "orders").where("o_orderstatus = 'O'").select((F.col("o_custkey") % 22).alias("team"), (F.col("o_custkey") % 25).alias("opponent"), F.col("o_orderdate").alias("starts_at"), "o_orderkey", (k % 10 / 10.0).alias("win"), (k % 3 / 4.0).alias("draw"), (k % 7 / 8.0).alias("loss"))
    odds = latest.newest_per_key(o, ["team"], [F.col("starts_at"), k])
    safe = F.col("s_acctbal") > 0
    lineup = table(spark, d, "supplier").where("s_nationkey <> 5").groupBy(F.col("s_nationkey").alias("team")).agg(F.count_if(safe).alias("n_safe"), F.nullif(rollup.ordered_text(F.when(safe, F.col("s_name")), [F.col("s_suppkey")]), F.lit("")).alias("safe"))
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("team"), F.col("n_name").alias("name"))
    j = n.join(odds, "team", "left").join(n.select(F.col("team").alias("opponent"), F.col("name").alias("rival")), "opponent", "left").join(lineup, "team", "left")
    outlook = F.when((F.col("win") >= F.col("draw")) & (F.col("win") >= F.col("loss")), "win").when((F.col("loss") >= F.col("win")) & (F.col("loss") >= F.col("draw")), "loss").otherwise("draw")
    return j.select(F.col("name").alias("team"), F.col("rival").alias("opponent"), "starts_at", outlook.alias("outlook"), "n_safe", "safe")
