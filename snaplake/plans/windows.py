"""Queries: newest rows, sequence features, folds, constraints."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import history, latest, sequence
from ..sources.tables import table
from .catalog import query

NEWEST = "QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1"


@query("core_to_mart_leaderboard", f"""
WITH core AS (SELECT * FROM events {NEWEST})
SELECT e.event_id, e.user_id, e.event_type, e.value, c.c_name AS customer_name, c.c_mktsegment AS segment
FROM core e LEFT JOIN customer c ON c.c_custkey = e.user_id
ORDER BY e.value DESC NULLS LAST, e.event_id LIMIT 100""")  # fmt: skip
def core_to_mart_leaderboard(spark, d):
    core = latest.newest_per_key(table(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"])
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("customer_name"), F.col("c_mktsegment").alias("segment"))
    return core.join(c, "user_id", "left").select("event_id", "user_id", "event_type", "value", "customer_name", "segment").orderBy(F.col("value").desc_nulls_last(), "event_id").limit(100)


@query("e1_newest_per_key", f"SELECT event_id, user_id, event_type, ts, value FROM events {NEWEST}")
def e1(spark, d):
    return latest.newest_per_key(table(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("event_id", "user_id", "event_type", "ts", "value")


@query("e2_newest_per_expression_key", """
SELECT event_id, user_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY coalesce(CASE WHEN event_type = 'error' THEN NULL ELSE event_type END, concat('user-', user_id)) ORDER BY ts DESC NULLS LAST, event_id DESC) = 1""")  # fmt: skip
def e2(spark, d):
    key = F.coalesce(F.when(F.col("event_type") != "error", F.col("event_type")), F.concat(F.lit("user-"), F.col("user_id").cast("string")))
    return latest.newest_per_key(table(spark, d, "events"), [key], ["ts", "event_id"]).select("event_id", "user_id", "value")


@query("e4_newest_with_complete_key", """
SELECT doc_id, lang, source FROM documents WHERE trim(lang) <> '' AND trim(source) <> ''
QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY n_chars DESC NULLS LAST, doc_id DESC) = 1""")  # fmt: skip
def e4(spark, d):
    return latest.newest_with_complete_key(table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars"), ["lang", "source"], ["n_chars", "doc_id"]).select("doc_id", "lang", "source")


@query("e5_recency_rank_last_five", """
SELECT o_custkey, o_orderkey, rn AS recency FROM (SELECT *, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderpriority DESC NULLS LAST, o_totalprice DESC NULLS LAST, o_orderkey DESC) AS INTEGER) AS rn FROM orders) WHERE rn <= 5""")  # fmt: skip
def e5(spark, d):
    return latest.newest_per_key(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderpriority", "o_totalprice", "o_orderkey"], n=5, rank="recency").select("o_custkey", "o_orderkey", "recency")


@query("e6_latest_value_of_key", "SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS last_date, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order FROM orders GROUP BY o_custkey")
def e6(spark, d):
    newest = F.struct("o_orderdate", "o_orderkey")
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").cast("date").alias("last_date"), F.max_by("o_orderkey", newest).alias("last_order"))


@query("e7_next_per_key", """
SELECT o_custkey, o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate ASC NULLS LAST, o_totalprice DESC NULLS LAST, o_orderkey) = 1""")  # fmt: skip
def e7(spark, d):
    ahead = table(spark, d, "orders").where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    return latest.newest_per_key(ahead, ["o_custkey"], [F.col("o_orderdate").asc_nulls_last(), "o_totalprice", F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


SEQ = "coalesce(o_totalprice, 0)"


@query("e8_sequence_features", f"""
SELECT o_orderkey, round(coalesce(lag({SEQ}) OVER w, 0), 4) AS o_totalprice_lag_1,
  round(coalesce(avg({SEQ}) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 0), 4) AS o_totalprice_mean_3,
  round(coalesce(avg({SEQ}) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 0), 4) AS o_totalprice_mean_5,
  round(coalesce(avg({SEQ}) OVER (w ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), 0), 4) AS o_totalprice_mean_10,
  round(CASE WHEN count({SEQ}) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) >= 2 THEN stddev_pop({SEQ}) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) ELSE 0 END, 4) AS o_totalprice_std_5
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate ASC NULLS LAST, o_orderkey)""")  # fmt: skip
def e8(spark, d):
    out = sequence.sequence_features(table(spark, d, "orders"), "o_custkey", [F.col("o_orderdate").asc_nulls_last(), F.col("o_orderkey")], "o_totalprice")
    return out.select("o_orderkey", *[F.round(f"o_totalprice_{c}", 4).alias(f"o_totalprice_{c}") for c in ("lag_1", "mean_3", "mean_5", "mean_10", "std_5")])


@query("k6_training_frame", f"""
SELECT o_orderkey, round(target, 4) AS target, round(log_price, 6) AS log_price, is_high, round(o_totalprice_lag_1, 4) AS o_totalprice_lag_1, round(o_totalprice_mean_5, 4) AS o_totalprice_mean_5 FROM (
  SELECT o_orderkey, o_orderdate, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS target, ln(1 + o_totalprice) AS log_price, CAST(o_totalprice > 150000 AS INTEGER) AS is_high, coalesce(lag({SEQ}) OVER w, 0) AS o_totalprice_lag_1,
    coalesce(avg({SEQ}) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 0) AS o_totalprice_mean_5
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate ASC NULLS LAST, o_orderkey)) WHERE target IS NOT NULL AND o_orderdate IS NOT NULL""")  # fmt: skip
def k6(spark, d):
    target = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    more = {"log_price": F.log1p("o_totalprice"), "is_high": (F.col("o_totalprice") > 150000).cast("int")}
    out = history.training_frame(table(spark, d, "orders"), "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice", target, more)
    four = [F.round(c, 4).alias(c) for c in ("target", "o_totalprice_lag_1", "o_totalprice_mean_5")]
    return out.select("o_orderkey", F.round("log_price", 6).alias("log_price"), "is_high", *four)


@query("k7_history_load", """
WITH o AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS season FROM orders), n AS (SELECT * FROM o WHERE season >= (SELECT max(season) FROM o) - 2),
f AS (SELECT * FROM n WHERE o_custkey IN (SELECT DISTINCT o_custkey FROM n WHERE o_custkey IS NOT NULL ORDER BY 1 LIMIT 40)),
v AS (SELECT o_custkey, o_orderdate, max(o_totalprice) AS known_value FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2)
SELECT f.o_orderkey, f.o_custkey, f.season, v.known_value FROM f ASOF LEFT JOIN v ON f.o_custkey = v.o_custkey AND f.o_orderdate >= v.o_orderdate""")  # fmt: skip
def k7(spark, d):
    o = table(spark, d, "orders")
    values = o.where("o_orderstatus = 'F'").groupBy("o_custkey", "o_orderdate").agg(F.max("o_totalprice").alias("known_value"))
    facts = o.select("o_orderkey", "o_custkey", "o_orderdate", F.year("o_orderdate").alias("season"))
    return history.load_history(facts, values, "o_custkey", "o_orderdate", "season", "known_value", n_keys=40).select("o_orderkey", "o_custkey", "season", "known_value")


@query("e9_live_features_of_key", f"""
SELECT o_custkey, round(avg(x), 4) AS last_three FROM (
  SELECT o_custkey, {SEQ} AS x, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS rn FROM orders) WHERE rn <= 3 GROUP BY o_custkey""")  # fmt: skip
def e9(spark, d):
    newest = latest.newest_per_key(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], n=3)
    return newest.groupBy("o_custkey").agg(F.round(F.avg(F.coalesce("o_totalprice", F.lit(0.0))), 4).alias("last_three"))


@query("e10_group_scaled_caps", """
WITH p AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_quantity / 50 * 8 AS s, l_discount * 30 AS u FROM lineitem),
g AS (SELECT *, s * least(1.0, coalesce(11 / nullif(sum(s) OVER (PARTITION BY l_orderkey), 0), 1.0)) AS s2, u * least(1.0, coalesce(5 / nullif(sum(u) OVER (PARTITION BY l_orderkey), 0), 1.0)) AS u2 FROM p)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, round(CASE WHEN s2 + u2 > 1 THEN s2 / (s2 + u2) ELSE s2 END, 6) AS start_share, round(CASE WHEN s2 + u2 > 1 THEN u2 / (s2 + u2) ELSE u2 END, 6) AS sub_share FROM g""")  # fmt: skip
def e10(spark, d):
    p = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", (F.col("l_quantity") / 50 * 8).alias("start_share"), (F.col("l_discount") * 30).alias("sub_share"))
    out = sequence.scale_to_caps(p, ["l_orderkey"], {"start_share": 11.0, "sub_share": 5.0})
    return out.withColumns({c: F.round(c, 6) for c in ("start_share", "sub_share")})


@query("e11_newest_duplicates_by_source_id", """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity FROM lineitem WHERE l_linenumber <> 3
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, l_extendedprice DESC, l_quantity DESC) = 1
UNION ALL SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity FROM lineitem WHERE l_linenumber = 3""")  # fmt: skip
def e11(spark, d):
    source = F.when(F.col("l_linenumber") != 3, F.col("l_linenumber"))
    return latest.keep_newest_duplicates(table(spark, d, "lineitem"), source, [F.col("l_orderkey")], ["l_shipdate", "l_extendedprice", "l_quantity"]).select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")


@query("e12_suffix_collisions", """
SELECT p_partkey, CASE WHEN rn > 1 THEN concat(p_brand, '-', rn) ELSE p_brand END AS unique_key FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rn FROM part)""")  # fmt: skip
def e12(spark, d):
    return latest.suffix_collisions(table(spark, d, "part"), "p_brand", [F.col("p_partkey")]).select("p_partkey", "unique_key")


@query("e13_latest_bridge_update", """
WITH b AS (SELECT o_custkey, o_orderkey % 25 AS team FROM orders WHERE o_orderkey % 3 > 0 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate) DESC, o_orderdate DESC, o_orderkey DESC) = 1)
SELECT c_custkey, CASE WHEN o_custkey IS NOT NULL THEN team ELSE c_nationkey END AS team, o_custkey IS NOT NULL AND team IS DISTINCT FROM c_nationkey AS changed FROM customer LEFT JOIN b ON o_custkey = c_custkey""")  # fmt: skip
def e13(spark, d):
    """A dimension takes the team of its newest bridge row, where it has one that differs."""
    bridge = table(spark, d, "orders").where("o_orderkey % 3 > 0").select("o_custkey", (F.col("o_orderkey") % 25).alias("team"), F.year("o_orderdate").alias("season"), "o_orderdate", "o_orderkey")
    newest = latest.newest_per_key(bridge, ["o_custkey"], ["season", "o_orderdate", "o_orderkey"])
    c = table(spark, d, "customer").join(newest, F.col("c_custkey") == F.col("o_custkey"), "left")
    known = F.col("o_custkey").isNotNull()
    return c.select("c_custkey", F.when(known, F.col("team")).otherwise(F.col("c_nationkey").cast("long")).alias("team"), (known & ~F.col("team").eqNullSafe(F.col("c_nationkey").cast("long"))).alias("changed"))


DAYS = "days AS (SELECT day, row_number() OVER (ORDER BY day) AS n, count(*) OVER () AS days FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE ts IS NOT NULL))"


@query("e14_rolling_time_folds", f"""
WITH {DAYS}, m AS (SELECT *, days - (4 - fold + 1) * 4 + 1 AS first FROM days, (SELECT unnest([1, 2, 3, 4]) AS fold)),
f AS (SELECT fold, day, CASE WHEN n < first THEN 'train' ELSE 'valid' END AS part FROM m WHERE first - 1 >= 10 AND n < first + 4)
SELECT fold, part, count(*) AS n_events, round(avg(value), 4) AS mean_value FROM events e JOIN f ON CAST(e.ts AS DATE) = f.day GROUP BY fold, part""")  # fmt: skip
def e14(spark, d):
    events = table(spark, d, "events").withColumn("day", F.col("ts").cast("date"))
    folds = sequence.rolling_folds(events, F.col("day"))
    return events.join(F.broadcast(folds), "day").groupBy("fold", "part").agg(F.count(F.lit(1)).alias("n_events"), F.round(F.avg("value"), 4).alias("mean_value"))


@query("e15_time_holdout", """
SELECT CASE WHEN CAST(ts AS DATE) > (SELECT CAST(max(CAST(ts AS DATE)) AS DATE) - 7 FROM events) THEN 'valid' ELSE 'train' END AS part, count(*) AS n FROM events GROUP BY 1""")  # fmt: skip
def e15(spark, d):
    events = table(spark, d, "events").withColumn("day", F.col("ts").cast("date"))
    return sequence.time_holdout(events, F.col("day"), 7).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query("e17_keep_best_context", """
SELECT user_id, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY (event_type = 'purchase') DESC, ts ASC NULLS LAST, event_id) = 1""")  # fmt: skip
def e17(spark, d):
    order = [(F.col("event_type") == "purchase").desc(), F.col("ts").asc_nulls_last(), F.col("event_id")]
    return latest.newest_per_key(table(spark, d, "events"), ["user_id"], order).select("user_id", "event_id", "event_type")


@query("f1_leaderboard_top", "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 25")
def f1(spark, d):
    return table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal").orderBy(F.col("c_acctbal").desc_nulls_last(), "c_custkey").limit(25)


@query("f4_offset_limit_slice", "SELECT c_custkey, c_name FROM customer ORDER BY lower(c_name), c_custkey OFFSET 50 LIMIT 50")
def f4(spark, d):
    return table(spark, d, "customer").select("c_custkey", "c_name").orderBy(F.lower("c_name"), "c_custkey").offset(50).limit(50)


@query("f6_next_events_unknown_last", """
SELECT event_id, ts FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS ts FROM events) ORDER BY ts ASC NULLS LAST, event_id LIMIT 40""")  # fmt: skip
def f6(spark, d):
    e = table(spark, d, "events").select("event_id", F.when(F.col("event_type") != "error", F.col("ts")).alias("ts"))
    return e.orderBy(F.col("ts").asc_nulls_last(), "event_id").limit(40)


@query("a15_first_row_per_id_by_name", """
SELECT c_mktsegment, c_custkey, c_name FROM customer QUALIFY row_number() OVER (PARTITION BY c_mktsegment, c_nationkey ORDER BY c_custkey) = 1""")  # fmt: skip
def a15(spark, d):
    w = Window.partitionBy("c_mktsegment", "c_nationkey").orderBy("c_custkey")
    return table(spark, d, "customer").withColumn("rn", F.row_number().over(w)).where("rn = 1").orderBy(F.lower("c_name")).select("c_mktsegment", "c_custkey", "c_name")
