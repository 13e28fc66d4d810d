"""Queries: sources, projections, marts and assembled entities."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import assembly, latest, merge, scoring
from ..sources import snapshots
from ..sources.tables import table
from .catalog import query

DEC = "CAST(sum(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)"


@query("a9_audited_rows", "SELECT event_id, 'events' AS source, '1' AS source_version, 'run-1' AS run_id FROM events")
def a9(spark, d):
    return snapshots.audited(table(spark, d, "events").select("event_id"), "run-1", "events", "1").drop("ingested_at")


@query("a10_run_telemetry", "SELECT 'run-1' AS run_id, count(*) AS rows, count(DISTINCT event_type) AS datasets, CASE WHEN count(*) > 0 THEN 'success' ELSE 'empty' END AS status FROM events")
def a10(spark, d):
    n = F.count(F.lit(1))
    return table(spark, d, "events").agg(F.lit("run-1").alias("run_id"), n.alias("rows"), F.count_distinct("event_type").alias("datasets"), F.when(n > 0, "success").otherwise("empty").alias("status"))


@query("a12_append_load", "SELECT c_mktsegment, 2 * count(*) AS n FROM customer GROUP BY 1")
def a12(spark, d):
    from .streams import scratch

    at = scratch(spark, "load")
    c = table(spark, d, "customer")
    c.write.mode("overwrite").parquet(at)
    c.drop("c_acctbal").write.mode("append").parquet(at)
    return spark.read.option("mergeSchema", True).parquet(at).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("a14_distinct_typed_list", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_uid FROM events WHERE user_id IS NOT NULL")
def a14(spark, d):
    return table(spark, d, "events").where("user_id is not null").select(F.col("user_id").cast("string").alias("user_uid")).distinct()


@query("a16_tagged_union_of_families", "SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment, 'customer' AS family FROM customer UNION ALL SELECT s_suppkey, s_acctbal, NULL, 'supplier' FROM supplier")
def a16(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return snapshots.tagged_union({"customer": c, "supplier": s}, "family")


@query("b1_selection_slice", "SELECT c_custkey, c_name FROM customer WHERE c_nationkey IN (1, 3, 5, 7) AND contains(lower(c_name), '0') ORDER BY lower(c_name), c_custkey OFFSET 10 LIMIT 20")
def b1(spark, d):
    c = table(spark, d, "customer").where(F.col("c_nationkey").isin(1, 3, 5, 7) & F.lower("c_name").contains("0"))
    return c.select("c_custkey", "c_name").orderBy(F.lower("c_name"), "c_custkey").offset(10).limit(20)


@query("b2_missing_enrichment", "SELECT o_orderkey FROM orders WHERE nullif(o_orderstatus, 'O') IS NULL OR nullif(o_orderpriority, '5-LOW') IS NULL OR o_totalprice IS NULL OR o_orderdate IS NULL")
def b2(spark, d):
    gaps = [F.nullif("o_orderstatus", F.lit("O")), F.nullif("o_orderpriority", F.lit("5-LOW")), F.col("o_totalprice"), F.col("o_orderdate")]
    return table(spark, d, "orders").where(gaps[0].isNull() | gaps[1].isNull() | gaps[2].isNull() | gaps[3].isNull()).select("o_orderkey")


@query("c3_enrichment_waterfall", """
WITH o AS (SELECT o_custkey, max(o_orderpriority) AS p FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), e AS (SELECT user_id, min(event_type) AS t FROM events GROUP BY 1)
SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), p, t) AS label, CASE WHEN nullif(c_mktsegment, 'BUILDING') IS NOT NULL THEN 'left' WHEN p IS NOT NULL THEN 'orders' WHEN t IS NOT NULL THEN 'events' END AS found_in
FROM customer LEFT JOIN o ON o_custkey = c_custkey LEFT JOIN e ON user_id = c_custkey""")  # fmt: skip
def c3(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("label"))
    o = table(spark, d, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderpriority").alias("label"))
    e = table(spark, d, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(F.min("event_type").alias("label"))
    return assembly.waterfall(c, [(o, "orders"), (e, "events")], "c_custkey", ["label"])


@query("c4_context_on_two_keys", """
WITH t AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE user_id % 2 = 0 GROUP BY 1, 2)
SELECT event_id, t.n AS context FROM events e LEFT JOIN t ON e.event_type = t.event_type AND CAST(e.ts AS DATE) = t.day""")  # fmt: skip
def c4(spark, d):
    e = table(spark, d, "events").withColumn("day", F.col("ts").cast("date"))
    t = e.where("user_id % 2 = 0").groupBy("event_type", "day").agg(F.count(F.lit(1)).alias("context"))
    return e.join(t, ["event_type", "day"], "left").select("event_id", "context")


@query("c10_breakdown_mart", f"""
SELECT o.o_orderkey, c.c_name, r.n AS n_parts, r.points FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN (SELECT l_orderkey, count(*) AS n, {DEC.format('l_extendedprice')} AS points FROM lineitem GROUP BY 1) r ON r.l_orderkey = o.o_orderkey""")  # fmt: skip
def c10(spark, d):
    r = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n_parts"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("points"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return table(spark, d, "orders").join(c, "o_custkey", "left").join(r, "o_orderkey", "left").select("o_orderkey", "c_name", "n_parts", "points")


@query("c18_alias_resolution", "SELECT c_custkey, CASE lower(c_mktsegment) WHEN 'building' THEN 'BLD' WHEN 'automobile' THEN 'AUT' WHEN 'machinery' THEN 'MAC' END AS code FROM customer")
def c18(spark, d):
    """Aliases are spelt in other ways than the names that look for them."""
    names = F.create_map(*[F.lit(x) for x in ("building", "BLD", "automobile", "AUT", "machinery", "MAC")])
    aliases = table(spark, d, "customer").select(S.name_key(F.col("c_mktsegment")).alias("alias")).distinct().withColumn("code", names[F.col("alias")])
    spelt = S.name_key(F.translate("c_mktsegment", "AIUE", "ÀĪŰẼ"))
    return assembly.resolve_alias(table(spark, d, "customer"), spelt, aliases, "code").select("c_custkey", "code")


@query("c19_rekeyed_facts", "SELECT o_orderkey, n_name || '-' || c_custkey AS player_uid FROM orders LEFT JOIN (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey > 0) ON o_custkey = c_custkey")
def c19(spark, d):
    n = table(spark, d, "nation").where("n_regionkey > 0")
    dim = table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).withColumn("player_uid", F.concat_ws("-", "n_name", F.col("c_custkey").cast("string")))
    return assembly.rekey(table(spark, d, "orders"), dim, ["o_custkey"], ["c_custkey"], "player_uid").select("o_orderkey", "player_uid")


@query("d13_mean_of_metric_columns", "SELECT round(avg(m_a), 6) AS m_a, round(avg(m_b), 6) AS m_b FROM (SELECT l_returnflag, avg(l_discount) AS m_a, avg(l_tax) AS m_b FROM lineitem GROUP BY 1)")
def d13(spark, d):
    folds = table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.avg("l_discount").alias("m_a"), F.avg("l_tax").alias("m_b"))
    return assembly.mean_of_metrics(folds, "m_").select(F.round("m_a", 6).alias("m_a"), F.round("m_b", 6).alias("m_b"))


@query("d18_max_per_key", "SELECT l_partkey, max(l_shipdate) AS newest, CAST(max(l_quantity) AS DOUBLE) AS most FROM lineitem GROUP BY 1")
def d18(spark, d):
    return table(spark, d, "lineitem").groupBy("l_partkey").agg(F.max("l_shipdate").alias("newest"), F.max("l_quantity").alias("most"))


@query("d22_run_counters", "SELECT count(*) AS rows, count(DISTINCT o_custkey) AS players, count(DISTINCT CAST(o_orderdate AS DATE)) AS days FROM orders")
def d22(spark, d):
    return table(spark, d, "orders").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("o_custkey").alias("players"), F.count_distinct(F.col("o_orderdate").cast("date")).alias("days"))


@query("h10_recent_seasons", "SELECT o_orderkey, concat_ws(',', s, s - 101, s - 202) AS seasons FROM (SELECT o_orderkey, CAST((y % 100) * 100 + (y + 1) % 100 AS INTEGER) AS s FROM (SELECT o_orderkey, year(o_orderdate) - CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 0 END AS y FROM orders))")
def h10(spark, d):
    s = S.recent_seasons(S.season_of(F.col("o_orderdate")), 3)
    return table(spark, d, "orders").select("o_orderkey", F.array_join(F.transform(s, lambda x: x.cast("string")), ",").alias("seasons"))


@query("h12_code_by_patterns", "SELECT page_id, CASE WHEN url LIKE '%example.com%' THEN 'COM' WHEN url LIKE '%example.net%' THEN 'NET' WHEN url LIKE '%example%' THEN 'ORG' END AS code FROM pages")
def h12(spark, d):
    return table(spark, d, "pages").select("page_id", assembly.coded(F.col("url"), {"%example.com%": "COM", "%example.net%": "NET", "%example%": "ORG"}).alias("code"))


@query("h22_priors", "SELECT c_custkey, round(0.6 * CASE lower(c_mktsegment) WHEN 'building' THEN 0.9 WHEN 'machinery' THEN 0.2 ELSE 0.5 END + 0.4 * greatest(0, least(1, c_acctbal / 10000)), 6)::DOUBLE AS prior FROM customer")
def h22(spark, d):
    label = scoring.mapped(F.col("c_mktsegment"), {"building": 0.9, "machinery": 0.2}, 0.5)
    return table(spark, d, "customer").select("c_custkey", F.round(label * 0.6 + S.clamp(F.col("c_acctbal") / 10000, 0.0, 1.0) * 0.4, 6).alias("prior"))


@query("j2_array_under_several_envelopes", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def j2(spark, d):
    wrap = F.concat(F.lit('{"'), F.when(F.col("event_id") % 2 == 0, "it").otherwise("items"), F.lit('":['), "props", F.lit("]}"))
    parsed = F.from_json(wrap, "it array<struct<k:int>>, data array<struct<k:int>>, items array<struct<k:int>>")
    rows = table(spark, d, "events").select("event_id", parsed.alias("p"))
    return rows.select("event_id", F.explode(F.coalesce("p.it", "p.data", "p.items")).alias("x")).select("event_id", "x.k")


@query("j4_recent_price_average", "SELECT l_partkey, round(avg(l_extendedprice) FILTER (l_extendedprice >= 10000), 4) AS mean_price FROM lineitem GROUP BY 1")
def j4(spark, d):
    g = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.avg(F.when(F.col("l_extendedprice") >= 10000, F.col("l_extendedprice"))).alias("mean"))
    return g.select("l_partkey", F.round("mean", 4).alias("mean_price"))


@query("j11_last_row_wins_per_match", "SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS season, CAST(month(o_orderdate) AS INTEGER) AS matchday, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY 1, 2, 3")
def j11(spark, d):
    o = table(spark, d, "orders").withColumns({"season": F.year("o_orderdate"), "matchday": F.month("o_orderdate")})
    return latest.newest_per_key(o, ["o_custkey", "season", "matchday"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "season", "matchday", "o_orderkey")


@query("j15_current_matchday", "SELECT event_type, coalesce(max(CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) < 3 THEN CAST(day(ts) AS INTEGER) END), max(CAST(day(ts) AS INTEGER))) AS current_day FROM events GROUP BY 1")
def j15(spark, d):
    flag = F.get_json_object("props", "$.k").cast("int") < 3
    return table(spark, d, "events").groupBy("event_type").agg(F.coalesce(F.max(F.when(flag, F.day("ts"))), F.max(F.day("ts"))).alias("current_day"))


@query("k1_player_snapshot", """
WITH p AS (SELECT *, concat(c_mktsegment, c_nationkey) AS k FROM customer), l AS (SELECT lang, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) = 1)
SELECT c_custkey, CASE WHEN rn > 1 THEN concat(k, '-', rn) ELSE k END AS player_uid, l.doc_id AS page FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY c_custkey) AS rn, CASE c_nationkey % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' END AS lng FROM p) LEFT JOIN l ON l.lang = lng""")  # fmt: skip
def k1(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    pages = table(spark, d, "documents").select("lang", "n_chars", F.col("doc_id").alias("page"))
    lang = F.when(F.col("c_nationkey") % 3 == 0, "en").when(F.col("c_nationkey") % 3 == 1, "fr")
    key = F.concat("c_mktsegment", F.col("c_nationkey").cast("string"))
    out = assembly.player_snapshot(c, pages, key, lang, F.col("lang"), [F.col("n_chars").desc(), F.col("page")], ["page"])
    return out.select("c_custkey", "player_uid", "page")


@query("k2_team_snapshot", "WITH o AS (SELECT s_nationkey AS team, count(*) AS books FROM supplier WHERE s_nationkey < 12 GROUP BY 1), l AS (SELECT c_nationkey AS team, count(*) AS squad FROM customer GROUP BY 1) SELECT o.team, books, squad FROM o LEFT JOIN l ON o.team = l.team")
def k2(spark, d):
    odds = table(spark, d, "supplier").where("s_nationkey < 12").groupBy(F.col("s_nationkey").alias("team")).agg(F.count(F.lit(1)).alias("books"))
    lineup = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("team")).agg(F.count(F.lit(1)).alias("squad"))
    return assembly.team_snapshot(odds, lineup, "team").select("team", "books", "squad")


@query("k3_gold_scores", """
SELECT c_custkey, round(p, 6) AS start_probability, round(p * c_nationkey, 6) AS expected_points, round(CASE WHEN c_acctbal > 0 THEN p * c_nationkey / (c_acctbal / 1000000) ELSE 0 END, 3) AS value_score
FROM (SELECT *, greatest(0.01, least(0.98, CAST(CASE lower(c_mktsegment) WHEN 'building' THEN 0.8 ELSE 0.5 END AS DOUBLE))) AS p FROM customer)""")  # fmt: skip
def k3(spark, d):
    p = scoring.start_probability(F.col("c_mktsegment"), F.lit(None).cast("string"), F.lit(None).cast("string"), {"building": 0.8}, {"x": 0.0}, {"x": 0.0})
    c = table(spark, d, "customer").withColumn("p", p).withColumn("e", F.col("p") * F.col("c_nationkey"))
    return c.select("c_custkey", F.round("p", 6).alias("start_probability"), F.round("e", 6).alias("expected_points"), F.round(scoring.value_score(F.col("e"), F.col("c_acctbal")), 3).alias("value_score"))


@query("k9_actuals_override_priors", "WITH a AS (SELECT o_custkey, max(o_totalprice) AS actual FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) SELECT c_custkey, coalesce(actual, c_acctbal) AS value FROM customer LEFT JOIN a ON o_custkey = c_custkey")
def k9(spark, d):
    a = table(spark, d, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("actual"))
    return table(spark, d, "customer").join(a, "c_custkey", "left").select("c_custkey", F.coalesce("actual", "c_acctbal").alias("value"))


@query("k10_feature_contract", "SELECT p_partkey, p_size, p_retailprice FROM part")
def k10(spark, d):
    part = table(spark, d, "part")
    return part.select("p_partkey", *assembly.intersected(["p_height", "p_size", "p_weight", "p_retailprice"], part))


@query("m4_replace_if_digest_is_new", """
SELECT o_orderkey, CASE WHEN d IS NOT NULL AND d IS DISTINCT FROM o_orderstatus THEN d ELSE o_orderstatus END AS digest, round(CASE WHEN d IS NOT NULL AND d IS DISTINCT FROM o_orderstatus THEN o_totalprice + 1 ELSE o_totalprice END, 2) AS size
FROM (SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN nullif(left(o_orderpriority, 1), '1') END AS d FROM orders)""")  # fmt: skip
def m4(spark, d):
    old = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("digest"), F.col("o_totalprice").alias("size"))
    new = table(spark, d, "orders").where("o_orderkey % 2 = 0").select("o_orderkey", F.nullif(F.substring("o_orderpriority", 1, 1), F.lit("1")).alias("digest"), (F.col("o_totalprice") + 1).alias("size"))
    return assembly.replace_if_new(old, new, "o_orderkey", "digest", ["size"]).withColumn("size", F.round("size", 2))


@query("f3_errors_largest_first", f"SELECT o_orderkey, round(abs(o_totalprice - s), 2) AS abs_error FROM orders JOIN (SELECT l_orderkey, {DEC.format('l_extendedprice')} AS s FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey ORDER BY 2 DESC, 1 LIMIT 50")
def f3(spark, d):
    s = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("s"))
    j = table(spark, d, "orders").join(s, "o_orderkey").select("o_orderkey", F.round(F.abs(F.col("o_totalprice") - F.col("s")), 2).alias("abs_error"))
    return j.orderBy(F.col("abs_error").desc(), "o_orderkey").limit(50)


@query("m6_unreferenced_after_purge", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) >= 2001 AND o_custkey IS NOT NULL)")
def m6b(spark, d):
    kept = merge.purge(table(spark, d, "orders"), table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("season")), "o_orderkey", F.col("season") >= 2001)
    return table(spark, d, "customer").join(kept, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("a13_star_dump", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer ORDER BY c_custkey")
def a13(spark, d):
    return table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment").orderBy("c_custkey")


@query("b7_pure_projection", "SELECT s_suppkey AS player, s_acctbal AS market_value, CASE WHEN s_acctbal < 0 THEN 'high' ELSE 'low' END AS risk FROM supplier")
def b7(spark, d):
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("player"), F.col("s_acctbal").alias("market_value"), F.when(F.col("s_acctbal") < 0, "high").otherwise("low").alias("risk"))


@query("c7_profile_with_team", "SELECT s_suppkey, s_name, n_name, r_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def c7(spark, d):
    s, n, r = (table(spark, d, t) for t in ("supplier", "nation", "region"))
    return s.join(n, s.s_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left").select("s_suppkey", "s_name", "n_name", "r_name")


@query("c9_value_curve", "SELECT o_orderkey, c_name, CAST(o_orderdate AS DATE) AS day, o_totalprice FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def c9(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return table(spark, d, "orders").join(c, "o_custkey", "left").select("o_orderkey", "c_name", F.col("o_orderdate").cast("date").alias("day"), "o_totalprice")


@query("c13_predictions_with_champion", """
WITH b AS (SELECT CAST(ts AS DATE) AS run, arg_max(event_type, (value, event_id)) AS champion FROM events WHERE event_type <> 'error' GROUP BY 1)
SELECT event_id, champion, event_type = champion AS is_champion FROM events LEFT JOIN b ON CAST(ts AS DATE) = run""")  # fmt: skip
def c13(spark, d):
    e = table(spark, d, "events").withColumn("run", F.col("ts").cast("date"))
    b = e.where("event_type <> 'error'").groupBy("run").agg(F.max_by("event_type", F.struct("value", "event_id")).alias("champion"))
    return e.join(b, "run", "left").select("event_id", "champion", (F.col("event_type") == F.col("champion")).alias("is_champion"))


@query("d21_max_code_lookup", "SELECT n_regionkey, max(upper(left(n_name, 3))) AS code FROM nation GROUP BY 1")
def d21(spark, d):
    return table(spark, d, "nation").groupBy("n_regionkey").agg(F.max(F.upper(F.substring("n_name", 1, 3))).alias("code"))


@query("e16_last_row_per_team_and_day", "SELECT user_id, CAST(ts AS DATE) AS day, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC NULLS LAST, event_id DESC) = 1")
def e16(spark, d):
    e = table(spark, d, "events").withColumn("day", F.col("ts").cast("date"))
    return latest.newest_per_key(e, ["user_id", "day"], ["ts", "event_id"]).select("user_id", "day", "event_id")


@query("j12_last_event_per_hash", "SELECT sha1(concat_ws('|', CAST(user_id AS VARCHAR), event_type, json_extract_string(props, '$.k'))) AS event_hash, max(event_id) AS event_id FROM events GROUP BY 1")
def j12(spark, d):
    key = S.content_hash(F.col("user_id"), F.col("event_type"), F.get_json_object("props", "$.k"))
    return table(spark, d, "events").groupBy(key.alias("event_hash")).agg(F.max("event_id").alias("event_id"))


@query("j14_value_history_last_wins", "SELECT user_id, CAST(ts AS DATE) AS mv_date, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2")
def j14(spark, d):
    rows = table(spark, d, "events").withColumn("mv_date", F.col("ts").cast("date"))
    return latest.newest_per_key(rows, ["user_id", "mv_date"], ["ts", "event_id"]).select("user_id", "mv_date", "value")
