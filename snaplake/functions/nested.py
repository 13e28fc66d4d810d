"""Nested data: JSON, arrays of structs, web pages.

Known shapes are exploded; shapes of unknown depth are opened level by level inside their
row. All are expressions of built-in functions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalars import parse_time


def json_first(c: Column, keys: Sequence[str], kind: str = "string") -> Column:
    """The first of several top-level keys that is present and readable."""
    return F.coalesce(*[F.nullif(F.trim(F.get_json_object(c, f"$.{k}")), F.lit("")).try_cast(kind) for k in keys])


def minutes_of(c: Column, keys: Sequence[str]) -> Column:
    """Minutes from JSON under one of several keys; an apostrophe behind them is dropped."""
    return F.coalesce(*[F.rtrim(F.trim(F.get_json_object(c, f"$.{k}")), F.lit("'")).try_cast("double") for k in keys])


def recent_history(history: Column, day: str, value: str, newest: Column, days: int = 10) -> tuple[Column, Column, Column]:
    """Of an array of structs: the last `days` days in order, and the highest and lowest
    value of the last year (of all where that is empty)."""
    known = F.filter(history, lambda h: h[day].isNotNull() & h[value].isNotNull())
    ordered = F.array_sort(F.transform(known, lambda h: F.struct(h[day].alias("day"), h[value].alias("value"))))
    tail = F.filter(ordered, lambda h: h["day"] > F.date_sub(newest, days))
    year = F.filter(ordered, lambda h: h["day"] > F.date_sub(newest, 365))
    span = F.when(F.size(year) > 0, year).otherwise(ordered)
    return tail, F.array_max(F.transform(span, lambda h: h["value"])), F.array_min(F.transform(span, lambda h: h["value"]))


def playing_stats(matches: Column) -> Column:
    """Appearances, starts and minutes of an array of structs (minutes, started)."""
    zero = F.struct(F.lit(0).alias("appearances"), F.lit(0).alias("starts"), F.lit(0.0).alias("minutes"))
    def step(s: Column, m: Column) -> Column:  # noqa: E306
        played = F.coalesce(m["minutes"], F.lit(0.0)) > 0
        return F.struct(
            (s["appearances"] + F.when(played, 1).otherwise(0)).alias("appearances"),
            (s["starts"] + F.when(played & F.coalesce(m["started"], F.lit(False)), 1).otherwise(0)).alias("starts"),
            (s["minutes"] + F.coalesce(m["minutes"], F.lit(0.0))).alias("minutes"),
        )
    return F.aggregate(matches, zero, step)  # noqa: E305


def clean_names(names: Column, own: Column) -> Column:
    """Trimmed names, the first spelling of each (case aside), without one's own. Spellings are
    sorted, so a list of many names costs no comparison of all pairs."""
    texts = F.filter(F.transform(names, lambda n: F.trim(n)), lambda n: n != "")
    keyed = F.array_sort(F.transform(texts, lambda n, i: F.struct(F.lower(n).alias("k"), i.alias("i"), n.alias("n"))))
    first = _bound(keyed, lambda all_: F.filter(all_, lambda s, i: (i == 0) | (s["k"] != F.get(all_, i - 1)["k"])))
    others = F.filter(first, lambda s: s["k"] != F.coalesce(F.lower(F.trim(own)), F.lit("")))
    return F.transform(F.array_sort(F.transform(others, lambda s: F.struct(s["i"], s["n"]))), lambda s: s["n"])


def clean_names_of(df: DataFrame, group: str, name: Column, order: Column, own: Column, out: str = "names") -> DataFrame:
    """(group, out): clean_names of each group's rows in an order. Spellings of one name are merged
    before rows are collected, so a list is as long as a group has different names."""
    text = F.trim(name)
    spelt = df.where(F.nullif(text, F.lit("")).isNotNull()).groupBy(group, F.lower(text).alias("_k")).agg(F.min(F.struct(order.alias("o"), text.alias("n"))).alias("_s"))
    lists = spelt.groupBy(group).agg(F.transform(F.array_sort(F.collect_list("_s")), lambda s: s["n"]).alias("_all"))
    return lists.select(group, clean_names(F.col("_all"), own).alias(out))


def explode_odds(df: DataFrame, event: str, bookmakers: str) -> DataFrame:
    """(event, book, market, outcome, price, point) of nested books, prices above 0 only;
    an outcome without a point has its market's."""
    b = df.select(event, F.explode(bookmakers).alias("b"))
    m = b.select(event, F.col("b.key").alias("book"), F.explode("b.markets").alias("m"))
    o = m.select(event, "book", F.col("m.key").alias("market"), F.col("m.point").alias("_point"), F.explode("m.outcomes").alias("o"))
    return o.where("o.price > 0").select(event, "book", "market", F.col("o.name").alias("outcome"), F.col("o.price").alias("price"), F.coalesce("o.point", "_point").alias("point"))


def newest_marker(bookmakers: Column) -> Column:
    """The newest last_update of books and their markets."""
    inner = F.flatten(F.transform(bookmakers, lambda b: F.transform(b["markets"], lambda m: m["last_update"])))
    return F.array_max(F.concat(F.transform(bookmakers, lambda b: b["last_update"]), inner))


#: Spellings of the time of an update.
UPDATED = ("last_update", "lastUpdate", "updated_at", "updatedAt")


def newest_event_marker(event: Column) -> Column:
    """The newest time under any spelling at an event (JSON text), its books and their
    markets; texts that are no time are passed over."""
    own = ",".join(f"{k}:string" for k in UPDATED)
    texts = lambda x: F.array(*[x[k] for k in UPDATED])

    def newest(e: Column) -> Column:
        books = F.filter(F.coalesce(e["bookmakers"], F.array()), lambda b: b.isNotNull())
        markets = F.flatten(F.transform(books, lambda b: F.coalesce(b["markets"], F.array())))
        every = F.concat(texts(e), F.flatten(F.transform(books, texts)), F.flatten(F.transform(markets, texts)))
        return F.array_max(F.transform(F.array_compact(F.array_distinct(every)), parse_time))

    # The text is read once, and each of its times once.
    return _bound(F.from_json(event, f"struct<{own},bookmakers:array<struct<{own},markets:array<struct<{own}>>>>>"), newest)


#: Levels of a JSON text that one plan goes down before what it found is written.
LEVELS = 24


def _depth(text: Column) -> Column:
    """How deep the brackets of a JSON text are nested."""
    brackets = F.regexp_replace(F.regexp_replace(text, r'"(?:[^"\\]|\\.)*+"', ""), r"[^\[\]{}]+", "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(s: Column, c: Column) -> Column:
        now = s["now"] + F.when(c.isin("{", "["), 1).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(s["most"], now).alias("most"))

    return F.aggregate(F.filter(F.split(brackets, ""), lambda c: c != ""), start, step)["most"]


def _bound(value: Column, use) -> Column:
    """use(value), with value computed once however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _opened(node: Column, needs: Sequence[str], carries: Sequence[str | Sequence[str]]) -> Column:
    """The node, done, and its children that are objects or lists; a node that is done alone."""
    text = node["text"]
    is_object = text.startswith("{")
    inner = F.when(is_object, text)
    outer = F.when(~is_object, text)
    # Texts of children are read where there is a second bracket only: most objects hold none.
    read = F.struct(
        F.from_json(inner, "map<string,variant>").alias("values"), F.from_json(F.when(F.substring(text, 2, 1 << 30).rlike(r"[\[{]"), inner), "map<string,string>").alias("raw"),
        F.from_json(outer, "array<variant>").alias("items"), F.from_json(outer, "array<string>").alias("raw_items"),
    )

    def holds(value: Column, raw: Column) -> Column:
        """Whether a value is an object or a list, and no text that looks like one."""
        is_a = lambda kind: F.try_variant_get(value, "$", kind).isNotNull()
        return F.when(raw.startswith("{"), is_a("map<string,variant>")).when(raw.startswith("["), is_a("array<variant>")).otherwise(False)

    def made(at: Column, path: Column, text: Column, fits: Column, open_: Column, carried: Column) -> Column:
        return F.struct(at.alias("at"), path.alias("path"), text.alias("text"), fits.alias("fits"), open_.alias("open"), carried.alias("carried"))

    def carried_by(values: Column) -> Column:
        value = lambda c: F.when(F.map_contains_key(values, c) & ~F.is_variant_null(F.element_at(values, c)), F.to_json(F.element_at(values, c)))
        # Of several spellings the first that is present counts; blank texts tell nothing.
        either = lambda names: reduce(lambda out, c: F.when(F.map_contains_key(values, c), value(c)).otherwise(out), reversed(names), F.lit(None).cast("string"))
        told = lambda c: value(c) if isinstance(c, str) else _bound(either(c), lambda x: F.when(~x.rlike(r'^"\s*"$'), x))
        found = F.array(*[F.coalesce(told(c), F.get(node["carried"], F.lit(i))) for i, c in enumerate(carries)]).cast("array<string>")
        return F.when(is_object, found).otherwise(node["carried"])

    def family(r: Column, carried: Column) -> Column:
        values, raw, items, raw_items = (r[c] for c in ("values", "raw", "items", "raw_items"))
        fits = is_object & F.coalesce(reduce(lambda x, y: x & y, [F.map_contains_key(values, n) for n in needs], F.lit(True)), F.lit(False))
        child = lambda i, name, text: made(F.concat(node["at"], F.array(i)), F.concat(node["path"], F.lit("/"), name), F.ltrim(text), F.lit(False), F.lit(True), carried)
        # Numbered first, so that a child knows its place among all of them.
        keyed = F.filter(F.transform(F.map_entries(values), lambda e, i: F.struct(e["key"].alias("key"), i.alias("i"), holds(e["value"], F.element_at(raw, e["key"])).alias("holds"))), lambda e: e["holds"])
        listed = F.filter(F.transform(items, lambda v, i: F.struct(i.alias("i"), holds(v, F.get(raw_items, i)).alias("holds"))), lambda e: e["holds"])
        children = F.when(is_object, F.transform(keyed, lambda e: child(e["i"], e["key"], F.element_at(raw, e["key"])))).otherwise(F.transform(listed, lambda e: child(e["i"], e["i"].cast("string"), F.get(raw_items, e["i"]))))
        done = made(node["at"], node["path"], text, fits, F.lit(False), carried)
        return F.concat(F.array(done), F.coalesce(children, F.array()))

    # What holds no other node and none of the keys asked for is done unread; an escape may hide a key.
    asked = [f'"{n}"' for c in (needs, *carries) for n in ((c,) if isinstance(c, str) else c)]
    shut = reduce(lambda x, y: x & y, [~text.contains(k) for k in asked], ~F.substring(text, 2, 1 << 30).rlike(r"[\[{\\]"))
    unread = made(node["at"], node["path"], text, is_object if not needs else F.lit(False), F.lit(False), node["carried"])
    return F.when(node["open"] & shut, F.array(unread)).when(node["open"], _bound(read, lambda r: _bound(carried_by(r["values"]), lambda c: family(r, c)))).otherwise(F.array(node))


def json_objects(df: DataFrame, key: str, payload: str, needs: Sequence[str], carries: Sequence[str | Sequence[str]] = ()) -> DataFrame:
    """(key, place, path, object, inherited): every object at any depth of a JSON text that has
    all of `needs`, numbered from above in the order of the text. inherited holds the nearest value of each of
    `carries` at or above it; several spellings of one are named by the first. Texts that are no
    JSON have none.

    The nodes of a text are one array, whose open ones are replaced by themselves and
    their children once for each level; how many levels there are is counted first. Nothing is
    shuffled, and no Python runs."""
    start = F.struct(F.array().cast("array<int>").alias("at"), F.lit("").alias("path"), F.trim(F.col(payload)).alias("text"), F.lit(False).alias("fits"), F.lit(True).alias("open"), F.array(*[F.lit(None).cast("string") for _ in carries]).cast("array<string>").alias("carried"))
    good = F.try_parse_json(F.col(payload)).isNotNull() & F.trim(F.col(payload)).rlike(r"^[\[{]")
    rows = df.where(good).select(F.col(key), F.array(start).alias("nodes"), _depth(F.col(payload)).alias("depth"))
    levels = rows.agg(F.max("depth")).first()[0] or 0
    rows = rows.drop("depth")
    for level in range(levels):
        rows = rows.withColumn("nodes", F.flatten(F.transform("nodes", lambda n: _opened(n, needs, carries))))
        if level % LEVELS == LEVELS - 1 and level + 1 < levels:
            rows = rows.checkpoint()
    fitting = F.array_sort(F.transform(F.filter("nodes", lambda n: n["fits"]), lambda n: F.struct(n["at"], n["path"], n["text"], n["carried"])))
    found = rows.select(key, F.posexplode(fitting).alias("place", "n"))
    names = [c if isinstance(c, str) else c[0] for c in carries]
    pairs = [F.when(F.get("n.carried", F.lit(i)).isNotNull(), F.concat(F.to_json(F.array(F.lit(c))).substr(F.lit(2), F.length(F.to_json(F.array(F.lit(c)))) - 2), F.lit(": "), F.get("n.carried", F.lit(i)))) for i, c in enumerate(names)]
    inherited = F.concat(F.lit("{"), F.array_join(F.array(*pairs).cast("array<string>"), ", "), F.lit("}"))
    return found.select(key, "place", "n.path", F.col("n.text").alias("object"), inherited.alias("inherited"))


def attribute_values(html: Column, name: str) -> Column:
    """All values of an attribute in a page, in order."""
    return F.regexp_extract_all(html, F.lit(rf"""\b{name}\s*=\s*["']([^"']*)["']"""), F.lit(1))


def first_match(c: Column, patterns: Sequence[str]) -> Column:
    """The first group of the first pattern that matches; null if none does."""
    return F.coalesce(*[F.nullif(F.regexp_extract(c, p, 1), F.lit("")) for p in patterns])
