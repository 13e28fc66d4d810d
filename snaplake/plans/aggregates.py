"""Queries: aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import latest, rollup
from ..sources.tables import table
from .catalog import query

DEC = "CAST(sum(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)"


@query("d1_component_rollup", f"SELECT l_orderkey, l_returnflag, l_linestatus, count(*) AS n, {DEC.format('l_extendedprice')} AS points, min(l_shipdate) AS first_ts, max(l_shipdate) AS last_ts FROM lineitem GROUP BY 1, 2, 3")
def d1(spark, d):
    return rollup.component_rollup(table(spark, d, "lineitem"), ["l_orderkey", "l_returnflag", "l_linestatus"], "l_extendedprice", "l_shipdate")


@query("d2_ordered_rollup_text", """
SELECT l_orderkey, string_agg(concat(l_returnflag, ':', l_linenumber, ':', CAST(l_quantity AS INTEGER)), ', ' ORDER BY -l_quantity, l_returnflag, l_linenumber) AS parts, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity FROM lineitem GROUP BY 1""")  # fmt: skip
def d2(spark, d):
    item = F.concat_ws(":", "l_returnflag", F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("int").cast("string"))
    order = [-F.col("l_quantity"), F.col("l_returnflag"), F.col("l_linenumber")]
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(rollup.ordered_text(item, order).alias("parts"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity"))


@query("d3_listagg_within_group", "SELECT c_nationkey, string_agg(c_mktsegment, ', ' ORDER BY c_acctbal DESC, c_custkey) AS segments FROM customer GROUP BY 1")
def d3(spark, d):
    return spark.sql("SELECT c_nationkey, listagg(c_mktsegment, ', ') WITHIN GROUP (ORDER BY c_acctbal DESC, c_custkey) AS segments FROM {c} GROUP BY 1", c=table(spark, d, "customer"))


@query("d5_conditional_recent_averages", """
SELECT o_custkey, round(avg(o_totalprice) FILTER (rn <= 5), 4) AS avg_5, round(avg(o_totalprice) FILTER (rn <= 10), 4) AS avg_10, count(*) FILTER (rn <= 5) AS n_5, count(*) FILTER (rn <= 10) AS n_10
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS rn FROM orders) GROUP BY 1""")  # fmt: skip
def d5(spark, d):
    r = latest.newest_per_key(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], n=10, rank="rn")
    avg = lambda n: F.round(F.avg(F.when(F.col("rn") <= n, F.col("o_totalprice"))), 4).alias(f"avg_{n}")
    return r.groupBy("o_custkey").agg(avg(5), avg(10), F.count_if(F.col("rn") <= 5).alias("n_5"), F.count_if(F.col("rn") <= 10).alias("n_10"))


@query("d6_bucket_counts_and_names", """
SELECT c_nationkey, count(*) FILTER (c_acctbal > 5000) AS n_rich, count(*) FILTER (c_acctbal <= 0) AS n_poor, string_agg(c_name, '|' ORDER BY c_name) FILTER (c_acctbal > 9000) AS rich_names, string_agg(c_name, '|' ORDER BY c_name) FILTER (c_acctbal < -900) AS poor_names FROM customer GROUP BY 1""")  # fmt: skip
def d6(spark, d):
    names = lambda cond: F.nullif(rollup.ordered_text(F.when(cond, F.col("c_name")), [F.col("c_name")], "|"), F.lit(""))
    b = F.col("c_acctbal")
    return table(spark, d, "customer").groupBy("c_nationkey").agg(F.count_if(b > 5000).alias("n_rich"), F.count_if(b <= 0).alias("n_poor"), names(b > 9000).alias("rich_names"), names(b < -900).alias("poor_names"))


@query("d7_group_stats_with_coverage", """
SELECT user_id, count(*) FILTER (event_type = 'view') AS n_view, count(*) FILTER (event_type = 'click') AS n_click, count(*) FILTER (event_type IN ('view', 'click')) AS coverage, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types, max(ts) AS last_change FROM events GROUP BY 1""")  # fmt: skip
def d7(spark, d):
    t = F.col("event_type")
    return table(spark, d, "events").groupBy("user_id").agg(
        F.count_if(t == "view").alias("n_view"), F.count_if(t == "click").alias("n_click"), F.count_if(t.isin("view", "click")).alias("coverage"),
        F.array_join(F.array_sort(F.collect_set(t)), ",").alias("types"), F.max("ts").alias("last_change"),
    )


@query("d8_keyword_split", """
WITH x AS (SELECT user_id, CAST(value AS DECIMAL(18,2)) AS v, regexp_matches(lower(event_type), 'view|click') AS r, regexp_matches(lower(event_type), 'purchase|click') AS t FROM events)
SELECT user_id, CAST(sum(CASE WHEN r THEN v ELSE 0 END) AS DOUBLE) AS raw_points, CAST(sum(CASE WHEN t THEN v ELSE 0 END) AS DOUBLE) AS top_points, CAST(sum(CASE WHEN NOT r AND NOT t THEN v ELSE 0 END) AS DOUBLE) AS uncategorised_points, count(*) AS n_events, bool_or(r) AS has_raw, bool_or(t) AS has_top FROM x GROUP BY 1""")  # fmt: skip
def d8(spark, d):
    out = rollup.keyword_split(table(spark, d, "events"), ["user_id"], "event_type", F.col("value").cast("decimal(18,2)"), {"raw": ["view", "click"], "top": ["purchase", "click"]})
    return out.withColumns({c: F.col(c).cast("double") for c in ("raw_points", "top_points", "uncategorised_points")})


RECONCILED = f"""SELECT o_orderkey, o_totalprice AS total, coalesce(s, 0) AS part_sum, round(o_totalprice - coalesce(s, 0), 2) AS delta, CASE WHEN s IS NULL THEN 'no_parts' WHEN abs(o_totalprice - s) <= 0.005 THEN 'exact' ELSE 'mismatch' END AS class
FROM orders LEFT JOIN (SELECT l_orderkey, {DEC.format('l_extendedprice')} AS s FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey"""


def _reconciled(spark, d):
    parts = table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return rollup.reconcile(table(spark, d, "orders"), parts, "o_orderkey", "o_totalprice", "l_extendedprice").withColumn("delta", F.round("delta", 2))


@query("d9_reconciliation", RECONCILED)
def d9(spark, d):
    return _reconciled(spark, d)


@query("f2_top_mismatches", f"SELECT * FROM ({RECONCILED}) WHERE class = 'mismatch' ORDER BY abs(delta) DESC, o_orderkey DESC LIMIT 20")
def f2(spark, d):
    return _reconciled(spark, d).where("class = 'mismatch'").orderBy(F.abs("delta").desc(), F.col("o_orderkey").desc()).limit(20)


@query("d10_error_metrics_by_scope", """
WITH e AS (SELECT coalesce(nullif(trim(l_returnflag), ''), 'UNKNOWN') AS scope, l_extendedprice - l_quantity * p_retailprice AS e FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT coalesce(scope, 'ALL') AS scope, count(e) AS n, round(avg(abs(e)), 2) AS mae, round(sqrt(avg(e * e)), 2) AS rmse, round(avg(e), 2) AS bias FROM e GROUP BY GROUPING SETS ((), (scope))""")  # fmt: skip
def d10(spark, d):
    li = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    out = rollup.error_metrics(li, F.col("l_extendedprice") - F.col("l_quantity") * F.col("p_retailprice"), "l_returnflag")
    return out.withColumns({c: F.round(c, 2) for c in ("mae", "rmse", "bias")})


@query("d11_regression_and_brier", """
SELECT round(sqrt(avg((l_quantity - 25) * (l_quantity - 25))), 6) AS rmse, round(avg(abs(l_quantity - 25)), 6) AS mae, round(avg((l_discount * 10 - CAST(l_returnflag = 'R' AS DOUBLE)) * (l_discount * 10 - CAST(l_returnflag = 'R' AS DOUBLE))), 6) AS brier FROM lineitem""")  # fmt: skip
def d11(spark, d):
    e = F.col("l_quantity") - 25
    return table(spark, d, "lineitem").agg(F.round(F.sqrt(F.avg(e * e)), 6).alias("rmse"), F.round(F.avg(F.abs(e)), 6).alias("mae"), F.round(rollup.brier(F.col("l_discount") * 10, F.col("l_returnflag") == "R"), 6).alias("brier"))


@query("d14_quality_metric_rows", """
SELECT 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM events UNION ALL SELECT 'coverage', round(avg(CAST(user_id IN (SELECT c_custkey FROM customer) AS DOUBLE)), 6) FROM events UNION ALL SELECT 'users', CAST(count(DISTINCT user_id) AS DOUBLE) FROM events""")  # fmt: skip
def d14(spark, d):
    known = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), F.lit(1.0).alias("known"))
    e = table(spark, d, "events").join(known, "user_id", "left")
    return rollup.as_metric_rows(e.agg(F.count(F.lit(1)).alias("rows"), F.round(F.avg(F.coalesce("known", F.lit(0.0))), 6).alias("coverage"), F.count_distinct("user_id").alias("users")))


@query("d15_exact_quantiles", "SELECT l_returnflag, round(avg(l_extendedprice), 2) AS mean, round(stddev_pop(l_extendedprice), 2) AS std, round(quantile_cont(l_extendedprice, 0.1), 3) AS p10, round(quantile_cont(l_extendedprice, 0.5), 3) AS p50, round(quantile_cont(l_extendedprice, 0.9), 3) AS p90 FROM lineitem GROUP BY 1")
def d15(spark, d):
    out = rollup.draw_summary(table(spark, d, "lineitem"), "l_returnflag", "l_extendedprice")
    return out.select("l_returnflag", *[F.round(c, 2 if c in ("mean", "std") else 3).alias(c) for c in ("mean", "std", "p10", "p50", "p90")])


@query("d16_measures", "SELECT c_mktsegment, count(*) AS n, count(DISTINCT c_nationkey) AS nations, round(avg(c_acctbal), 4) AS mean_balance, round(avg(c_acctbal / (c_nationkey + 1)), 4) AS mean_ratio FROM customer GROUP BY 1")
def d16(spark, d):
    return table(spark, d, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("c_nationkey").alias("nations"), F.round(F.avg("c_acctbal"), 4).alias("mean_balance"), F.round(F.avg(F.col("c_acctbal") / (F.col("c_nationkey") + 1)), 4).alias("mean_ratio"))


@query("d17_measure_on_latest_run", "SELECT event_type, max(CASE WHEN event_type = 'view' THEN value ELSE -value END) AS measure FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) GROUP BY 1")
def d17(spark, d):
    e = table(spark, d, "events").withColumn("day", F.col("ts").cast("date"))
    newest = e.agg(F.max("day").alias("day"))
    return e.join(F.broadcast(newest), "day").groupBy("event_type").agg(F.max(F.when(F.col("event_type") == "view", F.col("value")).otherwise(-F.col("value"))).alias("measure"))


@query("d19_median_price_per_outcome", "SELECT l_partkey, round(median(l_extendedprice) FILTER (l_returnflag = 'R'), 3) AS median_r, round(median(l_extendedprice) FILTER (l_returnflag <> 'R'), 3) AS median_other, count(DISTINCT l_suppkey) AS n_books FROM lineitem GROUP BY 1")
def d19(spark, d):
    m = lambda cond: F.round(F.median(F.when(cond, F.col("l_extendedprice"))), 3)
    return table(spark, d, "lineitem").groupBy("l_partkey").agg(m(F.col("l_returnflag") == "R").alias("median_r"), m(F.col("l_returnflag") != "R").alias("median_other"), F.count_distinct("l_suppkey").alias("n_books"))


@query("d20_open_issue_list", """
SELECT o_orderkey, concat_ws(',', CASE WHEN nullif(o_orderstatus, 'O') IS NULL THEN 'status' END, CASE WHEN nullif(o_orderpriority, '1-URGENT') IS NULL THEN 'priority' END) AS open_issues FROM orders""")  # fmt: skip
def d20(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("O")).alias("status"), F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("priority"))
    return rollup.missing_fields(o, ["status", "priority"]).select("o_orderkey", F.array_join("open_issues", ",").alias("open_issues"))


LINES = "SELECT l_partkey, l_linenumber AS line, median(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS over_price, median(CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END) AS under_price, count(*) AS n FROM lineitem GROUP BY 1, 2"


@query("f5_best_balanced_line", f"""
SELECT l_partkey, line FROM ({LINES}) WHERE over_price IS NOT NULL AND under_price IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY round(abs(over_price - under_price), 3), round(abs(over_price / under_price - 1), 6), n DESC, abs(line - 2.5), line) = 1""")  # fmt: skip
def f5(spark, d):
    m = lambda cond: F.median(F.when(cond, F.col("l_extendedprice")))
    lines = table(spark, d, "lineitem").groupBy("l_partkey", F.col("l_linenumber").alias("line")).agg(m(F.col("l_returnflag") == "R").alias("over_price"), m(F.col("l_returnflag") != "R").alias("under_price"), F.count(F.lit(1)).alias("n"))
    both = lines.where("over_price is not null and under_price is not null")
    gap, even = F.round(F.abs(F.col("over_price") - F.col("under_price")), 3), F.round(F.abs(F.col("over_price") / F.col("under_price") - 1), 6)
    return latest.newest_per_key(both, ["l_partkey"], [gap, even, F.col("n").desc(), F.abs(F.col("line") - 2.5), F.col("line")]).select("l_partkey", "line")


@query("a11_export_manifest", "SELECT 'customer' AS \"table\", count(*) AS rows FROM customer UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem")
def a11(spark, d):
    from ..sources.snapshots import export
    from .streams import scratch

    return export({t: table(spark, d, t) for t in ("customer", "orders", "lineitem")}, scratch(spark, "export"), "1998-08-01T000000Z")


@query("a17_preview_by_name", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, substr(text, 1, 60) AS text, lang FROM documents WHERE contains(lower(source), 'src1') OR contains(lower(lang), 'fr')")
def a17(spark, d):
    from ..sources.snapshots import preview

    docs = table(spark, d, "documents")
    return preview(docs, ["doc_id", "text", "lang"], ["source"], "src1", 1 << 30).union(preview(docs.where(~F.lower("source").contains("src1")), ["doc_id", "text", "lang"], ["lang"], "fr", 1 << 30))
