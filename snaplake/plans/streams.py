"""Queries: the event table as a file stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..sources.tables import table
from ..streaming import streams
from .catalog import query


def scratch(spark, name: str) -> str:
    """A new folder in the cluster's shared folder, or in the warehouse where none is set."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/shared"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _events(spark, d):
    schema = table(spark, d, "events").schema
    return streams.files(spark, f"{d}/events.parquet*", schema).withColumn("ts", F.col("ts").cast("timestamp"))


@query("n1_stream_to_bronze", "SELECT event_id, user_id, event_type, 'events' AS source FROM events")
def n1(spark, d):
    at = scratch(spark, "bronze")
    streams.land(_events(spark, d), f"{at}/data", f"{at}/checkpoint", "events")
    return spark.read.parquet(f"{at}/data").select("event_id", "user_id", "event_type", "source")


@query("n2_stateful_change_tracking", """
SELECT user_id, event_type AS status, ts AS changed_at, first_seen_at FROM (
  SELECT *, lag(event_type) OVER w AS prev, min(ts) OVER (PARTITION BY user_id) AS first_seen_at FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_type))
WHERE prev IS DISTINCT FROM event_type""")  # fmt: skip
def n2(spark, d):
    at = scratch(spark, "changes")
    s = _events(spark, d).select("user_id", F.col("event_type").alias("status"), "ts")
    out = streams.changes(s, "user_id", "status", "ts", f"{at}/data", f"{at}/checkpoint")
    return out.select("user_id", "status", F.col("changed_at").cast("timestamp_ntz").alias("changed_at"), F.col("first_seen_at").cast("timestamp_ntz").alias("first_seen_at"))


@query("n3_incremental_upsert", "SELECT user_id, max(ts) AS ts, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY 1")
def n3(spark, d):
    at = scratch(spark, "upsert")
    newest = F.max_by(F.struct("ts", "event_type"), F.struct("ts", "event_id")).alias("r")
    streams.upsert(_events(spark, d), f"{at}/table", f"{at}/checkpoint", ["user_id"], lambda batch: batch.groupBy("user_id").agg(newest).select("user_id", "r.ts", "r.event_type"), default="overwrite")
    return streams.newest_version(spark, f"{at}/table").select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type")


@query("n4_idempotent_event_dedup", "SELECT user_id, event_type, count(DISTINCT event_id) AS n FROM events GROUP BY 1, 2")
def n4(spark, d):
    at = scratch(spark, "dedup")
    twice = _events(spark, d).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    once = streams.deduplicated(twice, "ts", ["event_id"], late="60 days").select("event_id", "user_id", "event_type")
    return streams.collected(once, f"{at}/data", f"{at}/checkpoint").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("a2_partitioned_snapshots", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS snapshot_ts FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)")
def a2(spark, d):
    from ..sources import snapshots

    at = scratch(spark, "snapshots")
    e = table(spark, d, "events").withColumn(snapshots.STAMP, F.date_format("ts", "yyyy-MM-dd"))
    e.write.partitionBy(snapshots.STAMP).parquet(at)
    stored = spark.read.parquet(at).withColumn(snapshots.STAMP, F.col(snapshots.STAMP).cast("string"))
    return snapshots.pinned(stored, snapshots.latest_common([stored, stored.where("event_type = 'view'")])).select("event_id", snapshots.STAMP)


@query("a2_snapshot_replaced", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS snapshot_ts FROM events WHERE event_type = 'view' AND CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""")  # fmt: skip
def a2_replaced(spark, d):
    """Snapshots are written one after another; the last one of a time replaces it alone."""
    from ..sources import snapshots

    at, e = scratch(spark, "replaced"), table(spark, d, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    newest = e.agg(F.max("day")).first()[0]
    snapshots.write_snapshot(e.where(F.col("day") < newest).drop("day"), at, "1990-01-01")
    for part in (e, e.where("event_type = 'view'")):
        snapshots.write_snapshot(part.where(F.col("day") == newest).drop("day"), at, newest)
    stored = spark.read.parquet(at).withColumn(snapshots.STAMP, F.col(snapshots.STAMP).cast("string"))
    return snapshots.pinned(stored, newest).select("event_id", snapshots.STAMP)


@query("a10_telemetry_of_stored_rows", "SELECT 'run-1' AS run_id, count(*) AS rows, count(*) FILTER (event_type = 'error') AS errors, count(DISTINCT event_type) AS datasets, CASE WHEN count(*) > 0 THEN 'success' ELSE 'empty' END AS status FROM events")
def a10_stored(spark, d):
    """The run's row tells of what was stored, and reads one column of it."""
    from ..sources import snapshots

    stored, n = snapshots.write_snapshot(table(spark, d, "events"), scratch(spark, "run"), "run-1"), F.count(F.lit(1))
    return stored.agg(F.lit("run-1").alias("run_id"), n.alias("rows"), F.count_if(F.col("event_type") == "error").alias("errors"), F.count_distinct("event_type").alias("datasets"), F.when(n > 0, "success").otherwise("empty").alias("status"))


@query("a3_csv_round_trip", "SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS slug FROM customer")
def a3(spark, d):
    from ..sources import snapshots

    at = scratch(spark, "csv")
    snapshots.write_csv(table(spark, d, "customer"), at, ["c_custkey", "c_name", "slug"])
    return snapshots.read_aliased_csv(spark, at, {"c_custkey": ("bigint", ["id", "c_custkey"]), "c_name": ("string", ["name", "c_name"]), "slug": ("string", ["slug"])})


@query("a1_ndjson_round_trip", "SELECT event_id, user_id, props FROM events")
def a1(spark, d):
    from ..sources import snapshots

    at = scratch(spark, "ndjson")
    table(spark, d, "events").select("event_id", "user_id", "props").write.json(at)
    return snapshots.read_ndjson(spark, at, "event_id long, user_id long, props string")
