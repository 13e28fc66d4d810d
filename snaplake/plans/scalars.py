"""Queries: scalar functions on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources.tables import table
from .catalog import query


@query("h1_safe_casts", """
SELECT doc_id, CAST(trunc(TRY_CAST(trim(replace(source, 'src', '')) AS DOUBLE)) AS BIGINT) AS n, TRY_CAST(trim(source) AS DOUBLE) AS bad, nullif(trim(lang), 'en') AS lang FROM documents""")  # fmt: skip
def h1(spark, d):
    return table(spark, d, "documents").select("doc_id", S.to_int(F.replace("source", F.lit("src"), F.lit(""))).alias("n"), S.to_double(F.col("source")).alias("bad"), F.nullif(S.to_text(F.col("lang")), F.lit("en")).alias("lang"))


@query("h2_first_text_of_aliases", "SELECT o_orderkey, coalesce(nullif(trim(CASE WHEN o_orderstatus = 'O' THEN ' ' ELSE o_orderstatus END), ''), nullif(trim(o_orderpriority), '')) AS label FROM orders")
def h2(spark, d):
    blank = F.when(F.col("o_orderstatus") == "O", " ").otherwise(F.col("o_orderstatus"))
    return table(spark, d, "orders").select("o_orderkey", S.first_text(blank, F.col("o_orderpriority")).alias("label"))


KEY = "nullif(trim(regexp_replace(lower(strip_accents({0})), '[^a-z0-9]+', ' ', 'g')), '')"
#: Names of several scripts, and their keys as DuckDB's own functions can't tell them.
SCRIPTS = {
    "Kovačić Łukasz": "kovacic ukasz", "Şükrü Çağlar": "sukru caglar", "Őry Ødegård": "ory degard", "ﬁne № ½": "fine no 1 2", "Ｆｕｌｌ ｗｉｄｔｈ": "full width", "𝐁𝐨𝐥𝐝": "bold", "Ἀθηνᾶ 7": "7", "Мюллер": None, "e\u0301a\u0308": "ea", "ǅ ĳ ŉ": "dz ij n", "": None, "①② x²": "12 x2",
}


def _scripts_sql() -> str:
    rows = ", ".join(f"({i}, {'NULL' if k is None else repr(k)})" for i, k in enumerate(SCRIPTS.values()))
    return f"SELECT doc_id, nullif(concat_ws(' ', {KEY.format('text')}, k), '') AS name_key FROM documents JOIN (VALUES {rows}) s(i, k) ON doc_id % {len(SCRIPTS)} = i"


@query("h3_name_key", _scripts_sql())
def h3(spark, d):
    """Keys of texts with a name of some script behind them."""
    names = F.array(*[F.lit(n) for n in SCRIPTS])
    name = F.get(names, (F.col("doc_id") % len(SCRIPTS)).cast("int"))
    return table(spark, d, "documents").select("doc_id", S.name_key(F.concat_ws(" ", "text", name)).alias("name_key"))


@query("h4_slug", f"SELECT p_partkey, replace({KEY.format('p_name')}, ' ', '-') AS slug FROM part")
def h4(spark, d):
    return table(spark, d, "part").select("p_partkey", S.slug(F.col("p_name")).alias("slug"))


@query("h5_entity_key", f"""
SELECT o_orderkey, concat(coalesce((SELECT string_agg(concat(upper(w[1]), w[2:]), '' ORDER BY i) FROM (SELECT unnest(string_split({KEY.format('o_orderpriority')}, ' ')) AS w, generate_subscripts(string_split({KEY.format('o_orderpriority')}, ' '), 1) AS i)), 'PlayerUnknown'), coalesce(strftime(o_orderdate, '%Y%m%d'), '00000000')) AS entity_key FROM orders""")  # fmt: skip
def h5(spark, d):
    return table(spark, d, "orders").select("o_orderkey", S.entity_key(F.col("o_orderpriority"), F.col("o_orderdate")).alias("entity_key"))


@query("h6_match_key", """
SELECT o_orderkey, concat(lpad(CAST(s % 100 AS VARCHAR), 2, '0'), '/', lpad(CAST((s + 1) % 100 AS VARCHAR), 2, '0'), '-MD', lpad(CAST(day(o_orderdate) AS VARCHAR), 2, '0'), '-', o_orderstatus, coalesce(nullif(trim(CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE left(o_orderpriority, 1) END), ''), 'TNA')) AS match_key
FROM (SELECT *, year(o_orderdate) - CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 0 END AS s FROM orders)""")  # fmt: skip
def h6(spark, d):
    season = S.season_of(F.col("o_orderdate"))
    label = F.concat(F.lpad(F.floor(season / 100).cast("string"), 2, "0"), F.lit("/"), F.lpad((season % 100).cast("string"), 2, "0"))
    away = F.when(F.col("o_orderkey") % 7 != 0, F.substring("o_orderpriority", 1, 1))
    return table(spark, d, "orders").select("o_orderkey", S.match_key(label, F.day("o_orderdate"), F.col("o_orderstatus"), away).alias("match_key"))


@query("h7_parse_date", """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS parsed FROM orders""")  # fmt: skip
def h7(spark, d):
    k = F.col("o_orderkey") % 4
    t = F.when(k == 0, F.date_format("o_orderdate", "dd.MM.yyyy")).when(k == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 2, F.date_format("o_orderdate", "yyyy/MM/dd")).otherwise("not a date")
    return table(spark, d, "orders").select("o_orderkey", S.parse_date(t).alias("parsed"))


@query("h8_parse_time", """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts) WHEN 2 THEN date_trunc('day', ts) END AS parsed FROM events""")  # fmt: skip
def h8(spark, d):
    k, sec = F.col("event_id") % 4, F.unix_timestamp(F.col("ts").cast("timestamp"))
    t = F.when(k == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 1, (sec * 1000).cast("string")).when(k == 2, F.floor(sec / 86400).cast("string")).otherwise("soon")
    return table(spark, d, "events").select("event_id", S.parse_time(t).cast("timestamp_ntz").alias("parsed"))


@query("h9_season_numbers", """
SELECT o_orderkey, CAST((s % 100) * 100 + (s + 1) % 100 AS INTEGER) AS season, CAST((s % 100) * 100 + (s + 1) % 100 AS BIGINT) AS from_label FROM (SELECT *, year(o_orderdate) - CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 0 END AS s FROM orders)""")  # fmt: skip
def h9(spark, d):
    start = F.year("o_orderdate") - F.when(F.month("o_orderdate") < 7, 1).otherwise(0)
    label = F.concat_ws("/", start.cast("string"), (start + 1).cast("string"))
    return table(spark, d, "orders").select("o_orderkey", S.season_of(F.col("o_orderdate")).cast("int").alias("season"), S.season_of_label(label).alias("from_label"))


@query("h11_age_in_years", "SELECT o_orderkey, CAST(date_diff('year', o_orderdate, DATE '2024-03-15') - CASE WHEN strftime(DATE '2024-03-15', '%m%d') < strftime(o_orderdate, '%m%d') THEN 1 ELSE 0 END AS INTEGER) AS age FROM orders")
def h11(spark, d):
    return table(spark, d, "orders").select("o_orderkey", S.age_in_years(F.col("o_orderdate"), F.lit("2024-03-15").cast("date")).alias("age"))


@query("h13_canonical_url", "SELECT page_id, concat(regexp_replace(regexp_replace(regexp_replace(trim(url), '^http://', 'https://'), '[?#].*$', ''), '/+$', ''), '/') AS url FROM pages")
def h13(spark, d):
    return table(spark, d, "pages").select("page_id", S.canonical_url(F.col("url")).alias("url"))


@query("h14_code_labels", "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'final' ELSE 'unknown' END AS label FROM orders")
def h14(spark, d):
    return table(spark, d, "orders").select("o_orderkey", S.labelled(F.col("o_orderstatus"), {"O": "open", "F": "final"}, "unknown").alias("label"))


@query("h15_competition_risk", "SELECT c_nationkey, CASE WHEN n - 1 >= 2 THEN 'high' WHEN n - 1 = 1 THEN 'medium' ELSE 'low' END AS risk FROM (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1)")
def h15(spark, d):
    n = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    return n.select("c_nationkey", S.competition_risk(F.lit(" "), F.col("n") - 1).alias("risk"))


@query("h16_score_and_result", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, CASE WHEN l_returnflag = 'N' THEN NULL WHEN h > a AND l_returnflag = 'R' OR h < a AND l_returnflag <> 'R' THEN 'W' WHEN h = a THEN 'D' ELSE 'L' END AS result
FROM (SELECT *, CAST(l_quantity % 5 AS INTEGER) AS h, l_linenumber % 5 AS a FROM lineitem)""")  # fmt: skip
def h16(spark, d):
    li = table(spark, d, "lineitem").withColumn("score", F.concat_ws(":", (F.col("l_quantity") % 5).cast("int").cast("string"), (F.col("l_linenumber") % 5).cast("string")))
    home, away = S.score_parts(F.col("score"))
    side = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag") == "R")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", S.result_of(side, home, away).alias("result"))


@query("h17_likely_result", "SELECT l_orderkey, l_partkey, l_extendedprice, CASE WHEN l_tax >= l_discount AND l_tax >= 0.04 THEN 'win' WHEN l_discount >= 0.04 THEN 'draw' ELSE 'loss' END AS likely FROM lineitem")
def h17(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", S.likely_result(F.col("l_tax"), F.col("l_discount"), F.lit(0.04)).alias("likely"))


@query("h18_display_name", "SELECT n_nationkey, concat(upper(left(n_name, 3)), ' (', n_name, ')') AS once, concat(upper(left(n_name, 3)), ' (', n_name, ')') AS twice FROM nation")
def h18(spark, d):
    code = F.upper(F.substring("n_name", 1, 3))
    return table(spark, d, "nation").withColumn("once", S.display_name(code, F.col("n_name"))).select("n_nationkey", "once", S.display_name(code, F.col("once")).alias("twice"))


@query("h19_implied_shares", """
SELECT p_partkey, round(a / (a + b + c), 6) AS home, round(b / (a + b + c), 6) AS draw, round(c / (a + b + c), 6) AS away FROM (SELECT p_partkey, 1.0 / (1 + p_size) AS a, 1.0 / p_retailprice AS b, 1.0 / (2 + p_partkey % 7) AS c FROM part)""")  # fmt: skip
def h19(spark, d):
    shares = S.implied_shares([(F.col("p_size") + 1).cast("double"), F.col("p_retailprice"), (2 + F.col("p_partkey") % 7).cast("double")])
    return table(spark, d, "part").select("p_partkey", *[s.alias(n) for s, n in zip(shares, ("home", "draw", "away"), strict=True)])


@query("h26_content_hash", "SELECT o_orderkey, sha1(concat_ws('|', CAST(o_orderkey AS VARCHAR), coalesce(nullif(o_orderstatus, 'O'), ''), o_orderpriority)) AS event_hash FROM orders")
def h26(spark, d):
    return table(spark, d, "orders").select("o_orderkey", S.content_hash(F.col("o_orderkey"), F.nullif("o_orderstatus", F.lit("O")), F.col("o_orderpriority")).alias("event_hash"))
