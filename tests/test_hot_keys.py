"""Keys with half of all rows: the same results as by one window, in many tasks."""

import pytest
from pyspark.sql import functions as F

from snaplake.operators import joins, latest, merge, sequence, slices
from snaplake.sources import snapshots


@pytest.fixture
def many_partitions(spark):
    """Ranges as small as these would be put together."""
    names = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("false", "8")):
        spark.conf.set(n, v)
    yield
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def events(spark, n=6000):
    """Half of the rows are of key a; some keys and times are null, some times tie."""
    key = F.when(F.col("id") % 2 == 0, "a").when(F.col("id") % 97 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 50))
    time = F.when(F.col("id") % 101 != 3, (F.col("id") * 7919) % 2003)
    return spark.range(n).select(F.col("id").alias("i"), key.cast("string").alias("k"), time.alias("t"), F.when(F.col("id") % 13 > 0, (F.col("id") * 31 % 500).cast("double")).alias("v")).repartition(5)


def plain(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_numbers_and_scans(spark, many_partitions):
    df = events(spark)
    got = slices.numbered(df, "k", ["t", "i"])
    assert got.exceptAll(df.selectExpr("*", "row_number() over (partition by k order by t, i) as _number")).count() == 0
    assert max(r["count"] for r in slices.dealt(df, "k", ["t", "i"]).groupBy("_part").count().collect()) < 6000 * 0.3
    got = slices.carried(df, "k", ["t", "i"], F.col("v"), "last")
    want = df.selectExpr("*", "last(v, true) over (partition by k order by t, i rows between unbounded preceding and current row) as last")
    assert plain(got, "i", "last") == plain(want, "i", "last")


def test_as_of_join_of_a_hot_key(spark, many_partitions):
    df = events(spark)
    right = df.where("i % 3 = 0 and t is not null").groupBy("k", "t").agg(F.max("v").alias("x"), F.max("i").alias("y"))
    left = df.where("i % 3 > 0").select("i", "k", "t")
    want = plain(joins.as_of_join(left, right, "k", "t", "t", ["x", "y"]), "i", "x", "y")
    assert plain(joins.as_of_join(left, right, "k", "t", "t", ["x", "y"], rows=500), "i", "x", "y") == want
    assert any(w[2] is not None for w in want) and len(want) == left.count()


@pytest.mark.parametrize("rows", [11, 250, 1000])
def test_sequence_features_of_a_hot_key(spark, many_partitions, rows):
    df, order = events(spark, 3000), [F.col("t").asc_nulls_last(), F.col("i")]
    round_ = lambda out: [F.round(c, 6).alias(c) if c.startswith("v_") else F.col(c) for c in out.columns]
    want, got = sequence.sequence_features(df, "k", order, "v"), sequence.sequence_features(df, "k", order, "v", rows=rows)
    assert got.columns == want.columns and plain(got, *round_(got)) == plain(want, *round_(want))


def test_suffixes_of_a_hot_key(spark, many_partitions):
    df = events(spark)
    assert plain(latest.suffix_collisions(df, "k", [F.col("i")], rows=300), "i", "unique_key") == plain(latest.suffix_collisions(df, "k", [F.col("i")]), "i", "unique_key")


def test_distinguished_names(spark):
    rows = [("x", "1", 1), ("x", "2", 2), ("x", "1", 3), ("x", "2", 4), ("y", "9", 5)]
    got = latest.distinguished(spark.createDataFrame(rows, "b string, own string, at int"), "b", "own", ["at"], "uid")
    assert plain(got, "uid", "at") == [("x", 3), ("x_2", 4), ("y", 5)]


def test_chains_of_merged_ids(spark):
    chain = [(i, i + 1) for i in range(1000)] + [(2000, 500), (7, 8), (3000, 3000)]
    got = {r["source"]: r["target"] for r in merge.last_targets(spark.createDataFrame(chain, "source long, target long")).collect()}
    assert set(got.values()) == {1000} and len(got) == 1001
    for bad in ([(1, 2), (2, 3), (3, 1)], [(1, 2), (2, 1)]):
        with pytest.raises(ValueError, match="circle"):
            merge.last_targets(spark.createDataFrame(bad, "source long, target long"))
    with pytest.raises(ValueError, match="several"):
        merge.last_targets(spark.createDataFrame([(1, 2), (1, 3)], "source long, target long"))
    assert merge.last_targets(spark.createDataFrame([], "source long, target long")).count() == 0


def test_snapshots_replace_their_own_time(spark, tmp_path):
    df = spark.range(100)
    assert snapshots.write_snapshot(df, f"{tmp_path}/t", "2024-01-01").count() == 100
    assert snapshots.write_snapshot(df.where("id < 7"), f"{tmp_path}/t", "2024-01-02").count() == 7
    again = snapshots.write_snapshot(df.where("id < 3"), f"{tmp_path}/t", "2024-01-01")
    assert again.columns == ["id", "snapshot_ts"] and again.dtypes[1][1] == "string" and again.count() == 3
    assert spark.read.parquet(f"{tmp_path}/t").count() == 10
    assert snapshots.write_snapshot(df.limit(0), f"{tmp_path}/t", "2024-01-02").count() == 0
    assert spark.read.parquet(f"{tmp_path}/t").count() == 3
    manifest = snapshots.export({"x": df, "y": df.where("id < 3")}, f"{tmp_path}/out", "s")
    assert plain(manifest, "table", "rows") == [("x", 100), ("y", 3)]
    plan = manifest._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan  # no column is read


def test_line_items_meet_orders_in_tasks_of_so_many_rows(spark, monkeypatch):
    from snaplake.plans import QUERIES, joins

    monkeypatch.setattr(joins, "TASK_ROWS", 500, raising=False)
    for name in ("c6_role_playing_dims", "g1_both_sides_of_a_match"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        n = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count() // 500 + 1
        assert "RepartitionByExpression [l_orderkey" in plan and f"], {n}" in plan
