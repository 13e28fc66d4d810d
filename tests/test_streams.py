"""Streams that stop, start again and run a batch twice."""

import datetime as dt
import os
import time

from pyspark.sql import functions as F

from snaplake.streaming import streams

SCHEMA = "k string, s string, ts timestamp"


def arrive(spark, path, name, rows):
    at = [(k, s, None if t is None else dt.datetime(2024, 1, t)) for k, s, t in rows]
    spark.createDataFrame(at, SCHEMA).coalesce(1).write.parquet(f"{path}/in/{name}")


def source(spark, path, **options):
    return streams.files(spark, f"{path}/in/*", SCHEMA, **options)


def changed(spark, path, **options):
    rows = streams.changes(source(spark, path), "k", "s", "ts", f"{path}/out", f"{path}/cp", **options).collect()
    return sorted((r["k"], r["s"], r["changed_at"] and r["changed_at"].day, r["first_seen_at"] and r["first_seen_at"].day) for r in rows)


def test_changes_go_on_after_a_stop(spark, tmp_path):
    arrive(spark, tmp_path, "a", [("a", "x", 3), ("a", "x", 2), ("b", "y", 1), ("c", "z", None)])
    first = changed(spark, tmp_path)
    assert first == [("a", "x", 2, 2), ("b", "y", 1, 1), ("c", "z", None, None)]
    assert changed(spark, tmp_path) == first  # nothing arrived
    arrive(spark, tmp_path, "b", [("a", "x", 4), ("b", "w", 5), ("b", "y", 6), ("c", "z", 7), ("d", "q", 1)])
    assert changed(spark, tmp_path) == sorted([*first, ("b", "w", 5, 1), ("b", "y", 6, 1), ("d", "q", 1, 1)])


def test_a_key_is_forgotten_after_its_time(spark, tmp_path):
    arrive(spark, tmp_path, "a", [("a", "x", 1)])
    assert changed(spark, tmp_path, ttl_ms=1000) == [("a", "x", 1, 1)]
    time.sleep(2)
    arrive(spark, tmp_path, "b", [("a", "x", 5)])
    assert changed(spark, tmp_path, ttl_ms=1000) == [("a", "x", 1, 1), ("a", "x", 5, 5)]


def test_a_key_with_many_rows_of_one_batch(spark, tmp_path):
    days = [(i * 7919) % 28 + 1 for i in range(3000)]
    arrive(spark, tmp_path, "a", [("hot", f"s{t // 2}", t) for t in days] + [("b", "y", 1)])
    assert changed(spark, tmp_path) == sorted([("b", "y", 1, 1)] + [("hot", f"s{n}", max(1, 2 * n), 1) for n in range(15)])


def newest(df):
    return df.groupBy("k").agg(F.max_by(F.struct("s", "ts"), F.struct("ts", "s")).alias("r")).select("k", "r.s", "r.ts")


def upserted(spark, path, **options):
    streams.upsert(source(spark, path, **options), f"{path}/table", f"{path}/cp", ["k"], newest, default="overwrite")
    return sorted((r["k"], r["s"]) for r in streams.newest_version(spark, f"{path}/table").collect())


def test_upsert_goes_on_after_a_stop(spark, tmp_path):
    assert streams.newest_version(spark, f"{tmp_path}/table") is None
    arrive(spark, tmp_path, "a", [("a", "x", 1), ("b", "y", 1)])
    assert upserted(spark, tmp_path) == [("a", "x"), ("b", "y")]
    arrive(spark, tmp_path, "b", [("b", "z", 2), ("c", "w", 2)])
    assert upserted(spark, tmp_path) == [("a", "x"), ("b", "z"), ("c", "w")]
    assert sorted((r["k"], r["s"]) for r in streams.newest_version(spark, f"{tmp_path}/table", before=1).collect()) == [("a", "x"), ("b", "y")]


def test_a_batch_that_is_run_again(spark, tmp_path):
    """The stream dies behind a batch's write, before its commit: the batch runs again on the
    version before its own."""
    arrive(spark, tmp_path, "a", [("a", "x", 1)])
    arrive(spark, tmp_path, "b", [("a", "y", 2), ("b", "z", 2)])
    want = upserted(spark, tmp_path, per_batch=1)
    assert want == [("a", "y"), ("b", "z")]
    for f in ("1", ".1.crc"):
        os.remove(tmp_path / "cp/commits" / f)
    assert upserted(spark, tmp_path, per_batch=1) == want
    log = spark.read.json(f"{tmp_path}/table/log").collect()
    assert sorted((r["batch"], r["version"]) for r in log) == [(0, "v0"), (1, "v1")]


def test_a_version_without_its_line_is_not_read(spark, tmp_path):
    table = spark.createDataFrame([("a", 1)], "k string, v int")
    streams.commit_version(table, str(tmp_path), 0)
    table.withColumn("v", F.lit(2)).write.parquet(f"{tmp_path}/data/v1")
    assert streams.newest_version(spark, str(tmp_path)).first()["v"] == 1
