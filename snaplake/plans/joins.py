"""Queries: as-of joins, cascades, marts, set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import joins, latest, players
from ..sources.tables import table
from .catalog import query


@query("c1_entity_match_best_candidate", """
WITH p AS (SELECT c.c_custkey, s.s_suppkey, row_number() OVER (PARTITION BY c.c_custkey ORDER BY coalesce(right(c.c_name, 1) = right(s.s_name, 1), false) DESC, s.s_acctbal DESC, s.s_suppkey) AS rn
  FROM customer c JOIN supplier s ON c.c_nationkey = s.s_nationkey)
SELECT c_custkey, s_suppkey FROM p WHERE rn = 1""")  # fmt: skip
def c1(spark, d):
    """A row a key on the right before it is joined: a nation with many of both makes no pairs."""
    s = table(spark, d, "supplier").withColumns({"team": F.substring("s_name", -1, 1), "slug": F.lit(None).cast("string")})
    found = players.match_entities(
        table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_name"), s, name=(F.col("c_nationkey"), "s_nationkey"), team=(F.substring("c_name", -1, 1), "team"), slug=(F.lit(""), "slug"),
        order=[F.col("s_acctbal").desc(), F.col("s_suppkey")], values=["s_suppkey"],
    )
    return found.where("s_suppkey is not null").select("c_custkey", "s_suppkey")


_SPELT = ("Kovačić", "KOVACIC", "kovacic!", "Ｋｏｖａｃｉｃ", "Müller", "muller", "Мюллер", "ﬁne")
#: The key of each spelling; letters without a plain form are none.
_SPELT_KEYS = ("kovacic", "kovacic", "kovacic", "kovacic", "muller", "muller", "", "fine")
_SPELT_SQL = ", ".join(f"({i}, '{k}')" for i, k in enumerate(_SPELT_KEYS))


@query("c1_entity_match_by_spelling", f"""
WITH spelt(i, k) AS (VALUES {_SPELT_SQL}), s AS (SELECT s_suppkey, s_acctbal, trim(concat(k, ' ', s_nationkey)) AS name FROM supplier JOIN spelt ON s_suppkey % 8 = i),
c AS (SELECT c_custkey, trim(concat(k, ' ', c_nationkey)) AS name FROM customer JOIN spelt ON c_custkey % 8 = i)
SELECT c_custkey, name, (SELECT s_suppkey FROM s WHERE s.name = c.name ORDER BY s_acctbal DESC, s_suppkey LIMIT 1) AS s_suppkey FROM c""")  # fmt: skip
def c1_spelling(spark, d):
    """Names written in other ways meet by their keys."""
    spelt = F.array(*[F.lit(x) for x in _SPELT])
    key = lambda number, nation: S.name_key(F.concat_ws(" ", F.get(spelt, (F.col(number) % 8).cast("int")), F.col(nation)))
    s = table(spark, d, "supplier").select("s_suppkey", "s_acctbal", key("s_suppkey", "s_nationkey").alias("key"), F.lit(None).cast("string").alias("team"), F.lit(None).cast("string").alias("slug"))
    c = table(spark, d, "customer").select("c_custkey", key("c_custkey", "c_nationkey").alias("name"))
    none = F.lit("")
    return players.match_entities(c, s, name=(F.col("name"), "key"), team=(none, "team"), slug=(none, "slug"), order=[F.col("s_acctbal").desc(), F.col("s_suppkey")], values=["s_suppkey"])


@query("c2_cascade_by_spelling", f"""
WITH spelt(i, k) AS (VALUES {_SPELT_SQL}), s AS (SELECT s_suppkey, trim(concat(k, ' ', s_suppkey // 8)) AS name, nullif(k, '') AS last FROM supplier JOIN spelt ON s_suppkey % 8 = i),
c AS (SELECT c_custkey, trim(concat(k, ' ', c_custkey // 8)) AS name, nullif(k, '') AS last FROM customer JOIN spelt ON c_custkey % 8 = i),
n AS (SELECT name, max(s_suppkey) AS v FROM s GROUP BY 1 HAVING count(*) = 1), l AS (SELECT last, max(s_suppkey) AS v FROM s WHERE last IS NOT NULL GROUP BY 1 HAVING count(*) = 1)
SELECT c_custkey, coalesce(n.v, l.v) AS s_suppkey, CASE WHEN n.v IS NOT NULL THEN 'name' WHEN l.v IS NOT NULL THEN 'last' END AS matched_by FROM c LEFT JOIN n USING (name) LEFT JOIN l ON c.last = l.last""")  # fmt: skip
def c2_spelling(spark, d):
    """Exact key, then the key of one word, each only where one row has it."""
    spelt = F.array(*[F.lit(x) for x in _SPELT])
    word = lambda number: F.get(spelt, (F.col(number) % 8).cast("int"))
    both = lambda number: (S.name_key(F.concat_ws(" ", word(number), F.expr(f"{number} div 8"))), S.name_key(word(number)))
    (mine, my_last), (theirs, their_last) = both("c_custkey"), both("s_suppkey")
    s = table(spark, d, "supplier").select("s_suppkey", theirs.alias("key"), their_last.alias("last"))
    c = table(spark, d, "customer").select("c_custkey", mine.alias("mine"), my_last.alias("mine_last"))
    return joins.lookup_cascade(c, s, [("name", F.col("mine"), F.col("key")), ("last", F.col("mine_last"), F.col("last"))], ["s_suppkey"]).select("c_custkey", "s_suppkey", "matched_by")


@query("c2_unique_key_cascade", """
WITH a AS (SELECT p_type AS k, count(*) AS n, max(p_partkey) AS v FROM part WHERE p_type IS NOT NULL GROUP BY 1 HAVING count(*) = 1),
b AS (SELECT p_name AS k, max(p_partkey) AS v FROM part WHERE p_name IS NOT NULL GROUP BY 1 HAVING count(*) = 1),
c AS (SELECT concat(p_brand, '|', p_size) AS k, max(p_partkey) AS v FROM part WHERE p_brand IS NOT NULL AND p_size IS NOT NULL GROUP BY 1 HAVING count(*) = 1)
SELECT p.p_partkey, coalesce(a.v, b.v, c.v) AS found, CASE WHEN a.v IS NOT NULL THEN 'type' WHEN b.v IS NOT NULL THEN 'name' WHEN c.v IS NOT NULL THEN 'brand' END AS matched_by
FROM part p LEFT JOIN a ON p.p_type = a.k LEFT JOIN b ON p.p_name = b.k LEFT JOIN c ON concat(p.p_brand, '|', p.p_size) = c.k""")  # fmt: skip
def c2(spark, d):
    part = table(spark, d, "part")
    right = part.withColumn("found", F.col("p_partkey"))
    brand = F.concat("p_brand", F.lit("|"), F.col("p_size").cast("string"))
    keys = [("type", F.col("p_type"), F.col("p_type")), ("name", F.col("p_name"), F.col("p_name")), ("brand", brand, brand)]
    return joins.lookup_cascade(part, right, keys, ["found"]).select("p_partkey", "found", "matched_by")


@query("c5_as_of_join", """
SELECT p.event_id, p.user_id, v.value AS last_view_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT user_id, ts, max_by(value, event_id) AS value FROM events WHERE event_type = 'view' GROUP BY user_id, ts) v ON p.user_id = v.user_id AND p.ts >= v.ts""")  # fmt: skip
def c5(spark, d):
    events = table(spark, d, "events")
    views = events.where("event_type = 'view'").groupBy("user_id", "ts").agg(F.max_by("value", "event_id").alias("last_view_value"))
    bought = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return joins.as_of_join(bought, views, "user_id", "ts", "ts", ["last_view_value"]).select("event_id", "user_id", "last_view_value")


#: Line items that meet their orders in one task.
TASK_ROWS = 1_000_000


def _sides(spark, d, placed, *more):
    """(o_orderkey, customer_id, supplier_id, *more): line items with what placed(df, key of its nation, name)
    tells of their customer and supplier. Either side is narrow before the two meet in one
    join by order, in a task for each million line items (adaptive execution would merge more of
    them, by bytes of compressed rows): what a task sorts and groups doesn't grow."""
    li, o, c, s = (table(spark, d, t) for t in ("lineitem", "orders", "customer", "supplier"))
    sold = li.join(placed(s, "s_nationkey", "supplier_id"), F.col("l_suppkey") == F.col("s_suppkey")).select("l_orderkey", "supplier_id", *more)
    bought = o.join(placed(c, "c_nationkey", "customer_id"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "customer_id")
    tasks = 1 + li.count() // TASK_ROWS  # from the files' footers
    return sold.repartition(tasks, "l_orderkey").join(bought.repartition(tasks, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")).drop("l_orderkey")


@query("c6_role_playing_dims", """
SELECT o.o_orderkey, cn.n_name AS customer_nation, sn.n_name AS supplier_nation, CASE WHEN l.l_returnflag = 'R' THEN cn.n_name ELSE sn.n_name END AS own_nation, CASE WHEN l.l_returnflag = 'R' THEN sn.n_name ELSE cn.n_name END AS other_nation, count(*) AS n
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey GROUP BY ALL""")  # fmt: skip
def c6(spark, d):
    """Orders are grouped by small numbers of names, and names are put beside the groups."""
    n = table(spark, d, "nation")
    ids = n.select("n_nationkey", F.when(F.col("n_name").isNotNull(), F.min("n_nationkey").over(Window.partitionBy("n_name"))).alias("id"))
    both = _sides(spark, d, lambda df, key, out: df.join(ids.select(F.col("n_nationkey").alias(key), F.col("id").alias(out)), key, "left"), F.coalesce(F.col("l_returnflag") == "R", F.lit(False)).alias("returned"))
    # Where both names are the same, it makes no difference which one is its own.
    turned = F.col("returned") & ~F.col("customer_id").eqNullSafe(F.col("supplier_id"))
    groups = both.groupBy("o_orderkey", "customer_id", "supplier_id", turned.alias("turned")).agg(F.count(F.lit(1)).alias("n"))
    named = lambda key, name: n.where("n_name is not null").groupBy(F.col("n_name").alias(name)).agg(F.min("n_nationkey").alias(key))
    out = groups.join(named("customer_id", "customer_nation"), "customer_id", "left").join(named("supplier_id", "supplier_nation"), "supplier_id", "left")
    own = F.when(F.col("turned"), F.col("customer_nation")).otherwise(F.col("supplier_nation"))
    other = F.when(F.col("turned"), F.col("supplier_nation")).otherwise(F.col("customer_nation"))
    return out.select("o_orderkey", "customer_nation", "supplier_nation", own.alias("own_nation"), other.alias("other_nation"), "n")


@query("c8_profile_with_latest_value", """
SELECT c.c_custkey, c.c_name, n.n_name AS team_name, o.o_orderkey AS last_order, o.o_totalprice AS last_value FROM customer c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1) o ON o.o_custkey = c.c_custkey""")  # fmt: skip
def c8(spark, d):
    last = latest.newest_per_key(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("last_order"), F.col("o_totalprice").alias("last_value"))
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("team_name"))
    return table(spark, d, "customer").join(nation, "c_nationkey", "left").join(last, "c_custkey", "left").select("c_custkey", "c_name", "team_name", "last_order", "last_value")


@query("c12_self_join_outlook", """
SELECT a.n_name AS team, r.r_name AS league, count(b.n_nationkey) AS n_rivals, min(b.n_name) AS first_rival FROM nation a
LEFT JOIN region r ON a.n_regionkey = r.r_regionkey LEFT JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey <> b.n_nationkey GROUP BY 1, 2""")  # fmt: skip
def c12(spark, d):
    a, b, r = table(spark, d, "nation").alias("a"), table(spark, d, "nation").alias("b"), table(spark, d, "region").alias("r")
    j = a.join(r, F.col("a.n_regionkey") == F.col("r.r_regionkey"), "left").join(b, (F.col("a.n_regionkey") == F.col("b.n_regionkey")) & (F.col("a.n_nationkey") != F.col("b.n_nationkey")), "left")
    return j.groupBy(F.col("a.n_name").alias("team"), F.col("r.r_name").alias("league")).agg(F.count("b.n_nationkey").alias("n_rivals"), F.min("b.n_name").alias("first_rival"))


@query("c14_top_keys_semi_join", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1 ORDER BY 1 LIMIT 20)")
def c14(spark, d):
    return joins.top_keys_semi(table(spark, d, "orders"), "o_custkey", 20).select("o_orderkey", "o_custkey")


@query("c15_unreferenced_dims", "SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F') AND NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey)")
def c15(spark, d):
    return joins.unreferenced(table(spark, d, "customer"), "c_custkey", table(spark, d, "orders").where("o_orderstatus = 'F'").select("o_custkey"), table(spark, d, "events").select("user_id")).select("c_custkey")


@query("c16_prediction_against_actual", """
WITH a AS (SELECT l_orderkey AS k, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS predicted FROM lineitem GROUP BY 1)
SELECT o_orderkey, round(predicted - o_totalprice, 2) AS error, round(abs(predicted - o_totalprice), 2) AS abs_error FROM orders JOIN a ON o_orderkey = k""")  # fmt: skip
def c16(spark, d):
    a = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("predicted"))
    diff = F.col("predicted") - F.col("o_totalprice")
    return table(spark, d, "orders").join(a, "o_orderkey").select("o_orderkey", F.round(diff, 2).alias("error"), F.round(F.abs(diff), 2).alias("abs_error"))


PAIR = "SELECT c_nationkey AS a, s_nationkey AS b, max(o_totalprice) AS best, min(o_orderkey) AS first_order FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey WHERE c_nationkey % 2 = 0 GROUP BY 1, 2"


@query("c17_either_way_lookup", f"""
WITH p AS ({PAIR}), q AS (SELECT x.n_nationkey AS a, y.n_nationkey AS b FROM nation x JOIN nation y ON x.n_regionkey = y.n_regionkey AND x.n_nationkey < y.n_nationkey)
SELECT q.a, q.b, coalesce(p.best, r.best) AS best, coalesce(p.first_order, r.first_order) AS first_order FROM q LEFT JOIN p ON q.a = p.a AND q.b = p.b LEFT JOIN p r ON q.b = r.a AND q.a = r.b""")  # fmt: skip
def c17(spark, d):
    li, o, c, s = (table(spark, d, t) for t in ("lineitem", "orders", "customer", "supplier"))
    fact = li.join(o, li.l_orderkey == o.o_orderkey).join(c.where("c_nationkey % 2 = 0"), o.o_custkey == c.c_custkey).join(s, li.l_suppkey == s.s_suppkey)
    p = fact.groupBy(F.col("c_nationkey").alias("pa"), F.col("s_nationkey").alias("pb")).agg(F.max("o_totalprice").alias("best"), F.min("o_orderkey").alias("first_order"))
    x, y = table(spark, d, "nation").alias("x"), table(spark, d, "nation").alias("y")
    q = x.join(y, (F.col("x.n_regionkey") == F.col("y.n_regionkey")) & (F.col("x.n_nationkey") < F.col("y.n_nationkey"))).select(F.col("x.n_nationkey").alias("a"), F.col("y.n_nationkey").alias("b"))
    return joins.either_way(q, p, "a", "b", "pa", "pb", ["best", "first_order"])


@query("c20_slot_competitors", """
WITH m AS (SELECT DISTINCT s_nationkey, s_name FROM supplier)
SELECT a.s_name, coalesce(string_agg(b.s_name, '|' ORDER BY b.s_name), '') AS competitors FROM m a LEFT JOIN m b ON a.s_nationkey = b.s_nationkey AND a.s_name <> b.s_name GROUP BY a.s_nationkey, a.s_name""")  # fmt: skip
def c20(spark, d):
    m = table(spark, d, "supplier").select("s_nationkey", "s_name").distinct()
    return joins.slot_competitors(m, ["s_nationkey"], "s_name").select("s_name", F.array_join("competitors", "|").alias("competitors"))


@query("b3_optional_predicates", "SELECT c_custkey, c_name FROM customer WHERE c_name ILIKE '%01%' AND c_mktsegment LIKE 'B%'")
def b3(spark, d):
    df = table(spark, d, "customer")
    for column, how, pattern in (("c_name", "ilike", "%01%"), ("c_mktsegment", "like", "B%"), ("c_name", "like", None)):
        if pattern is not None:  # an absent parameter filters nothing
            df = df.where(getattr(F.col(column), how)(pattern))
    return df.select("c_custkey", "c_name")


@query("b4_recency_predicate", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-28 00:00:00' - INTERVAL 1 DAY")
def b4(spark, d):
    return table(spark, d, "events").where(F.col("ts") >= F.expr("TIMESTAMP_NTZ '2024-01-28 00:00:00' - INTERVAL 1 DAY")).select("event_id")


@query("b5_scope_filter_both_sides", """
SELECT l_orderkey, l_suppkey, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3) AND s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3) GROUP BY 1, 2""")  # fmt: skip
def b5(spark, d):
    allowed = table(spark, d, "nation").where("n_regionkey < 3").select("n_nationkey")
    c = table(spark, d, "customer").join(allowed, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
    s = table(spark, d, "supplier").join(allowed, F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")
    o = table(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    li = table(spark, d, "lineitem").join(s, F.col("l_suppkey") == F.col("s_suppkey"), "left_semi").join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    return li.groupBy("l_orderkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query("b6_season_floor_filter", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS season FROM orders WHERE year(o_orderdate) >= (SELECT max(year(o_orderdate)) FROM orders) - 2")
def b6(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("season"))
    newest = o.agg(F.max("season").alias("newest"))
    return o.join(F.broadcast(newest), F.col("season") >= F.col("newest") - 2).select("o_orderkey", "season")


@query("b8_null_safe_difference", "SELECT o_orderkey FROM orders WHERE nullif(o_orderstatus, 'P') IS DISTINCT FROM nullif(o_orderpriority, '1-URGENT')")
def b8(spark, d):
    a, b = F.nullif(F.col("o_orderstatus"), F.lit("P")), F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT"))
    return table(spark, d, "orders").where(~a.eqNullSafe(b)).select("o_orderkey")


SIDES = "SELECT o_orderkey, c_nationkey AS team, s_nationkey AS opponent, 'home' AS side FROM m UNION ALL SELECT o_orderkey, s_nationkey, c_nationkey, 'away' FROM m"
MATCH = "m AS (SELECT DISTINCT o_orderkey, c_nationkey, s_nationkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)"


@query("g1_both_sides_of_a_match", f"WITH {MATCH} SELECT team, opponent, side, count(*) AS n FROM ({SIDES}) GROUP BY ALL")
def g1(spark, d):
    m = _sides(spark, d, lambda df, key, out: df.withColumnRenamed(key, out)).select("o_orderkey", F.col("customer_id").alias("c_nationkey"), F.col("supplier_id").alias("s_nationkey")).distinct()
    side = lambda a, b, name: F.struct(F.col(a).alias("team"), F.col(b).alias("opponent"), F.lit(name).alias("side"))
    both = m.select("o_orderkey", F.explode(F.array(side("c_nationkey", "s_nationkey", "home"), side("s_nationkey", "c_nationkey", "away"))).alias("s")).select("s.*")
    return both.groupBy("team", "opponent", "side").agg(F.count(F.lit(1)).alias("n"))


@query("g2_distinct_union_first_wins", """
SELECT id, name FROM (SELECT c_custkey AS id, c_name AS name, 0 AS src FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_suppkey END, s_name, 1 FROM supplier)
QUALIFY id IS NULL OR row_number() OVER (PARTITION BY id ORDER BY src, name) = 1""")  # fmt: skip
def g2(spark, d):
    a = table(spark, d, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    b = table(spark, d, "supplier").select(F.when(F.col("s_suppkey") % 5 != 0, F.col("s_suppkey")).alias("id"), F.col("s_name").alias("name"))
    return latest.distinct_union([a, b], "id", [F.col("name")])


@query("g4_placeholder_dims_for_unseen_keys", "SELECT o_custkey AS c_custkey, concat('customer_', o_custkey) AS c_name FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL) WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)")
def g4(spark, d):
    known = table(spark, d, "customer").where("c_custkey % 2 = 0").select("c_custkey")
    seen = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")).where("c_custkey is not null").distinct()
    return seen.join(known, "c_custkey", "left_anti").withColumn("c_name", F.concat(F.lit("customer_"), F.col("c_custkey").cast("string")))


@query("a5_latest_common_snapshot", "SELECT max(day) AS day FROM (SELECT CAST(ts AS DATE) AS day FROM events WHERE event_type = 'view' INTERSECT SELECT CAST(ts AS DATE) FROM events WHERE event_type = 'purchase')")
def a5(spark, d):
    days = lambda t: table(spark, d, "events").where(F.col("event_type") == t).select(F.col("ts").cast("date").alias("day"))
    return days("view").intersect(days("purchase")).agg(F.max("day").alias("day"))


@query("a7_snapshot_as_of_resolution", "SELECT event_type, coalesce(max(CASE WHEN CAST(ts AS DATE) <= DATE '2024-01-10' THEN CAST(ts AS DATE) END), max(CAST(ts AS DATE))) AS day FROM events GROUP BY 1")
def a7(spark, d):
    from ..sources.snapshots import resolve_as_of

    return table(spark, d, "events").groupBy("event_type").agg(resolve_as_of(F.col("ts").cast("date"), F.lit("2024-01-10").cast("date")).alias("day"))
