"""Queries: JSON, arrays, pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import nested as N
from ..functions import scalars as S
from ..operators import latest
from ..sources.tables import table
from .catalog import query


@query("j5_playing_stats", """
SELECT l_orderkey, CAST(count(*) FILTER (l_quantity > 10) AS INTEGER) AS appearances, CAST(count(*) FILTER (l_quantity > 10 AND l_returnflag = 'R') AS INTEGER) AS starts, CAST(sum(CASE WHEN l_quantity > 10 THEN CAST(l_quantity AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS minutes FROM lineitem GROUP BY 1""")  # fmt: skip
def j5(spark, d):
    m = F.struct(F.when(F.col("l_quantity") > 10, F.col("l_quantity")).otherwise(0.0).alias("minutes"), (F.col("l_returnflag") == "R").alias("started"))
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(m).alias("matches"))
    return rows.select("l_orderkey", N.playing_stats(F.col("matches")).alias("s")).select("l_orderkey", "s.*")


@query("j3_recent_history_arrays", """
WITH n AS (SELECT user_id, max(CAST(ts AS DATE)) AS newest FROM events GROUP BY 1)
SELECT e.user_id, CAST(count(*) FILTER (CAST(ts AS DATE) > newest - 10) AS INTEGER) AS n_recent, max(value) AS high, min(value) AS low FROM events e JOIN n ON e.user_id = n.user_id WHERE value IS NOT NULL GROUP BY 1""")  # fmt: skip
def j3(spark, d):
    h = F.struct(F.col("ts").cast("date").alias("day"), F.col("value").alias("value"))
    rows = table(spark, d, "events").groupBy("user_id").agg(F.collect_list(h).alias("history"), F.max("ts").cast("date").alias("newest"))
    tail, high, low = N.recent_history(F.col("history"), "day", "value", F.col("newest"))
    return rows.select("user_id", F.size(tail).alias("n_recent"), high.alias("high"), low.alias("low"))


def _books(spark, d):
    """Books of a part as nested arrays: supplier, return flag, lines."""
    li = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag", "l_linenumber", "l_extendedprice", "l_shipdate")
    outcome = F.struct(F.col("l_linenumber").cast("string").alias("name"), F.when(F.col("l_linenumber") == 7, -1.0).otherwise(F.col("l_extendedprice")).alias("price"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_linenumber").cast("double")).alias("point"))
    markets = li.groupBy("l_partkey", "l_suppkey", "l_returnflag").agg(F.collect_list(outcome).alias("outcomes"), F.max("l_shipdate").cast("string").alias("last_update"))
    m = F.struct(F.col("l_returnflag").alias("key"), "last_update", F.lit(2.5).alias("point"), "outcomes")
    books = markets.groupBy("l_partkey", "l_suppkey").agg(F.collect_list(m).alias("markets"), F.min("last_update").alias("last_update"))
    return books.groupBy("l_partkey").agg(F.collect_list(F.struct(F.col("l_suppkey").cast("string").alias("key"), "last_update", "markets")).alias("bookmakers"))


@query("j6_explode_nested_odds", """
SELECT l_partkey, CAST(l_suppkey AS VARCHAR) AS book, l_returnflag AS market, CAST(l_linenumber AS VARCHAR) AS outcome, l_extendedprice AS price, CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_linenumber AS DOUBLE) ELSE 2.5 END AS point FROM lineitem WHERE l_linenumber <> 7""")  # fmt: skip
def j6(spark, d):
    return N.explode_odds(_books(spark, d), "l_partkey", "bookmakers")


@query("j7_newest_nested_marker", "SELECT l_partkey, strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') AS newest FROM lineitem GROUP BY 1")
def j7(spark, d):
    return _books(spark, d).select("l_partkey", N.newest_marker(F.col("bookmakers")).alias("newest"))


@query("j8_sorted_distinct_lists", "SELECT l_partkey, (SELECT string_agg(x, ',' ORDER BY x) FROM (SELECT DISTINCT l_returnflag AS x FROM lineitem b WHERE b.l_partkey = a.l_partkey)) AS markets, count(DISTINCT l_suppkey) AS n_books FROM lineitem a GROUP BY 1")
def j8(spark, d):
    b = _books(spark, d).select("l_partkey", F.explode("bookmakers").alias("b")).select("l_partkey", "b.key", F.explode("b.markets").alias("m"))
    return b.groupBy("l_partkey").agg(F.array_join(F.array_sort(F.collect_set("m.key")), ",").alias("markets"), F.count_distinct("key").alias("n_books"))


@query("j9_clean_competitor_names", """
WITH n AS (SELECT c_nationkey, lower(c_mktsegment) AS k, arg_min(c_mktsegment, c_custkey) AS first, min(c_custkey) AS i FROM customer GROUP BY 1, 2)
SELECT c_nationkey, string_agg(first, '|' ORDER BY i) AS names, count(*) AS n_names FROM n WHERE k <> 'building' GROUP BY 1""")  # fmt: skip
def j9(spark, d):
    spelt = F.concat(F.lit(" "), "c_mktsegment")
    names = N.clean_names_of(table(spark, d, "customer"), "c_nationkey", spelt, F.col("c_custkey"), F.lit(" Building ")).where(F.size("names") > 0)
    return names.select("c_nationkey", F.array_join("names", "|").alias("names"), F.size("names").cast("long").alias("n_names"))


@query("j10_objects_at_any_depth", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, '/wrap/0/it' AS path, event_type AS kind FROM events")
def j10(spark, d):
    wrapped = table(spark, d, "events").select("event_id", F.concat(F.lit('{"kind":"'), "event_type", F.lit('","wrap":[{"it":'), "props", F.lit("}]}")).alias("payload"))
    found = N.json_objects(wrapped, "event_id", "payload", ["k"], ["kind"])
    return found.select("event_id", F.get_json_object("object", "$.k").cast("long").alias("k"), "path", F.get_json_object("inherited", "$.kind").alias("kind"))


@query("j12_nested_events_last_wins", """
SELECT sha1(concat_ws('|', CAST(user_id AS VARCHAR), json_extract_string(props, '$.k'), event_type)) AS event_hash, max(event_id) AS event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS points FROM events WHERE user_id IS NOT NULL AND event_type <> 'error' GROUP BY user_id, event_type, json_extract_string(props, '$.k')""")  # fmt: skip
def j12_nested(spark, d):
    """Objects with a type and points at any depth; of those with one hash the last stays."""
    e = table(spark, d, "events").where("user_id is not null")
    k = F.get_json_object("props", "$.k")
    event = F.concat(F.lit('{"eti":"'), F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")), F.lit('","p":'), k, F.lit("}"))
    payload = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"it":[{"deep":['), event, F.lit(']},{"eti":"no points"}]}'))).otherwise(event)
    found = N.json_objects(e.select(F.struct("event_id", "user_id").alias("row"), payload.alias("payload")), "row", "payload", ["eti", "p"])
    kind, points = N.json_first(F.col("object"), ["eti"]), N.json_first(F.col("object"), ["p"])
    rows = found.where(kind.isNotNull()).select("row.*", S.content_hash(F.col("row.user_id"), points, kind).alias("event_hash"), points.cast("double").alias("points"), "place")
    return latest.newest_per_key(rows, ["event_hash"], ["event_id", "place"]).select("event_hash", "event_id", "points")


@query("j13_table_from_array_or_map", "SELECT DISTINCT CAST(json_extract(props, '$.k') AS INTEGER) AS type_id, concat('event_', json_extract(props, '$.k')) AS name FROM events")
def j13(spark, d):
    pairs = F.explode(F.from_json("props", "map<string,int>")).alias("key", "type_id")
    return table(spark, d, "events").select(pairs).select("type_id", F.coalesce(F.lit(None).cast("string"), F.concat(F.lit("event_"), F.col("type_id").cast("string"))).alias("name")).distinct()


@query("j16_minutes_from_json", "SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.minutes') AS DOUBLE), TRY_CAST(rtrim(json_extract_string(props, '$.k'), '''') AS DOUBLE)) AS minutes FROM events")
def j16(spark, d):
    return table(spark, d, "events").select("event_id", N.minutes_of(F.col("props"), ["minutes", "k"]).alias("minutes"))


@query("j17_json_key_fallback", "SELECT event_id, coalesce(json_extract_string(props, '$.ei'), json_extract_string(props, '$.k')) AS source_id FROM events")
def j17(spark, d):
    return table(spark, d, "events").select("event_id", N.json_first(F.col("props"), ["ei", "k"]).alias("source_id"))


@query("j18_page_links", """SELECT page_id, i AS place, href FROM (SELECT page_id, unnest(l) AS href, CAST(unnest(range(len(l))) AS INTEGER) AS i FROM (SELECT page_id, regexp_extract_all(html, '\\bhref\\s*=\\s*["'']([^"'']*)["'']', 1) AS l FROM pages))""")
def j18(spark, d):
    return table(spark, d, "pages").select("page_id", F.posexplode(N.attribute_values(F.col("html"), "href")).alias("place", "href"))


@query("j19_page_fields_by_patterns", """
SELECT page_id, coalesce(nullif(regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1), ''), nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '')) AS title, nullif(regexp_extract(html, '<html lang="([a-z]+)"', 1), '') AS lang FROM pages""")  # fmt: skip
def j19(spark, d):
    h = F.col("html")
    return table(spark, d, "pages").select("page_id", N.first_match(h, ["<h1[^>]*>([^<]*)</h1>", "<title>([^<]*)</title>"]).alias("title"), N.first_match(h, ['<html lang="([a-z]+)"']).alias("lang"))
