"""Queries: upserts, merges, retention, change tracking. The base is orders before 1999,
what comes in is later orders and changed copies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import merge
from ..sources.tables import table
from .catalog import query

BASE = "base AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01')"
INCOMING = "incoming AS (SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'O') AS o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')"


def _base(spark, d):
    return table(spark, d, "orders").where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def _incoming(spark, d):
    o = table(spark, d, "orders").where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    return o.select("o_orderkey", "o_custkey", F.nullif("o_orderstatus", F.lit("O")).alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice"))


@query("m1_upsert_with_policies", f"""
WITH {BASE}, {INCOMING}
SELECT coalesce(b.o_orderkey, i.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN i.o_custkey ELSE coalesce(b.o_custkey, i.o_custkey) END AS o_custkey,
  CASE WHEN i.o_orderkey IS NULL THEN b.o_orderstatus ELSE coalesce(i.o_orderstatus, b.o_orderstatus) END AS o_orderstatus, round(CASE WHEN i.o_orderkey IS NULL THEN b.o_totalprice ELSE i.o_totalprice END, 2) AS o_totalprice,
  CASE WHEN b.o_orderkey IS NULL THEN 'inserted' WHEN i.o_orderkey IS NULL THEN 'kept' ELSE 'updated' END AS action FROM base b FULL JOIN incoming i ON b.o_orderkey = i.o_orderkey""")  # fmt: skip
def m1(spark, d):
    out = merge.upsert(_base(spark, d), _incoming(spark, d), ["o_orderkey"], {"o_custkey": "keep", "o_orderstatus": "fill", "o_totalprice": "overwrite"}, action="action")
    return out.withColumn("o_totalprice", F.round("o_totalprice", 2))


@query("m2_match_by_id_or_code", """
WITH base AS (SELECT CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE n_nationkey END AS id, CASE WHEN n_nationkey % 3 = 1 THEN NULL ELSE n_name END AS code, n_name AS name FROM nation WHERE n_nationkey < 20),
i AS (SELECT n_nationkey AS id, n_name AS code, concat(n_name, '!') AS name FROM nation)
SELECT i.id, i.code, i.name FROM i""")  # fmt: skip
def m2(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("code"), F.col("n_name").alias("name"))
    base = n.where("id < 20").select(F.when(F.col("id") % 3 != 0, F.col("id")).alias("id"), F.when(F.col("id") % 3 != 1, F.col("code")).alias("code"), "name")
    return merge.match_by_id_or_code(base, n.withColumn("name", F.concat("name", F.lit("!"))), "id", "code", "name")


@query("m3_insert_if_absent", f"""
WITH {BASE}, b AS (SELECT DISTINCT sha1(CAST(o_custkey AS VARCHAR)) AS event_hash, o_custkey FROM base WHERE o_custkey % 3 = 0), i AS (SELECT DISTINCT sha1(CAST(o_custkey AS VARCHAR)) AS event_hash, o_custkey FROM orders)
SELECT * FROM b UNION ALL SELECT * FROM i WHERE event_hash NOT IN (SELECT event_hash FROM b)""")  # fmt: skip
def m3(spark, d):
    hashed = lambda df: df.select(F.sha1(F.col("o_custkey").cast("string")).alias("event_hash"), "o_custkey")
    return merge.insert_absent(hashed(_base(spark, d).where("o_custkey % 3 = 0")).distinct(), hashed(table(spark, d, "orders")), "event_hash")


@query("m5_identity_merge", """
SELECT CASE WHEN user_id % 10 = 1 THEN user_id - 1 ELSE user_id END AS user_id, event_type, max(value) AS value, max(ts) AS ts, count(*) AS n FROM events GROUP BY 1, 2""")  # fmt: skip
def m5(spark, d):
    e = table(spark, d, "events")
    moved = e.where("user_id % 10 = 1").select(F.col("user_id").alias("source"), (F.col("user_id") - 1).alias("target")).distinct()
    return merge.merge_identity(e, moved, "user_id", ["user_id", "event_type"], {"value": F.max("value"), "ts": F.max("ts"), "n": F.count(F.lit(1))})


@query("m5_identity_chain", """
SELECT user_id - CASE WHEN user_id % 10 BETWEEN 1 AND 6 THEN user_id % 10 ELSE 0 END AS user_id, max(value) AS value, count(*) AS n FROM events GROUP BY 1""")  # fmt: skip
def m5_chain(spark, d):
    """Each of six ids is merged into the one before it: all end at the last of the chain."""
    e = table(spark, d, "events")
    moved = e.where("user_id % 10 between 1 and 6").select(F.explode(F.sequence(F.lit(1), F.lit(6))).alias("k"), F.expr("user_id - user_id % 10").alias("base")).select((F.col("base") + F.col("k")).alias("source"), (F.col("base") + F.col("k") - 1).alias("target")).distinct()
    return merge.merge_identity(e, moved, "user_id", ["user_id"], {"value": F.max("value"), "n": F.count(F.lit(1))})


@query("m6_retention_purge", "SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE year(o_orderdate) >= 1999) GROUP BY 1")
def m6(spark, d):
    dim = table(spark, d, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    return merge.purge(table(spark, d, "lineitem"), dim, "l_orderkey", F.year("o_orderdate") >= 1999).groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query("m7_scope_cleanup_three_valued", """
WITH m AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS a, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_custkey + 1 END AS b FROM orders)
SELECT o_orderkey FROM m WHERE coalesce(NOT (NOT (a IN (SELECT c_custkey FROM customer WHERE c_custkey % 4 < 3) AND b IN (SELECT c_custkey FROM customer WHERE c_custkey % 4 < 3))), true)""")  # fmt: skip
def m7(spark, d):
    m = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_custkey")).alias("a"), F.when(F.col("o_orderkey") % 13 != 0, F.col("o_custkey") + 1).alias("b"))
    return merge.outside_scope(m, "a", "b", table(spark, d, "customer").where("c_custkey % 4 < 3").select("c_custkey")).select("o_orderkey")


@query("m8_newer_than_marks", """
WITH s AS (SELECT user_id, max(ts) AS mark FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-15' AND user_id % 5 <> 0 GROUP BY 1)
SELECT e.event_id FROM events e LEFT JOIN s ON e.user_id = s.user_id WHERE mark IS NULL OR ts > mark""")  # fmt: skip
def m8(spark, d):
    e = table(spark, d, "events")
    stored = e.where((F.col("ts").cast("date") <= F.lit("2024-01-15").cast("date")) & (F.col("user_id") % 5 != 0))
    return merge.newer_than_marks(e, stored, "user_id", "ts").select("event_id")


@query("m9_change_tracking", """
WITH p AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS status, max(ts) AS at FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-20' GROUP BY 1),
c AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS status, max(ts) AS at FROM events GROUP BY 1)
SELECT c.user_id, c.status, CASE WHEN p.status = c.status THEN p.at ELSE c.at END AS last_changed_at, coalesce(p.at, c.at) AS first_seen_at FROM c LEFT JOIN p ON c.user_id = p.user_id""")  # fmt: skip
def m9(spark, d):
    e = table(spark, d, "events")
    state = lambda df: df.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("status"), F.max("ts").alias("at"))
    nothing = state(e).limit(0).select("user_id", F.lit("").alias("change_fingerprint"), F.col("at").alias("last_changed_at"), F.col("at").alias("first_seen_at"))
    before = merge.track_changes(state(e.where(F.col("ts").cast("date") <= F.lit("2024-01-20").cast("date"))), nothing, "user_id", ["status"], "at")
    return merge.track_changes(state(e), before, "user_id", ["status"], "at").select("user_id", "status", "last_changed_at", "first_seen_at")


@query("g5_field_level_merge", """
SELECT user_id, coalesce(arg_min(event_type, (event_type = 'error', event_id)), NULL) AS event_type FROM events GROUP BY 1""")  # fmt: skip
def g5(spark, d):
    return merge.merge_fields(table(spark, d, "events"), "user_id", F.col("event_id"), ["event_type"], weak="error")
