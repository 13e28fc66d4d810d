"""Player rows of web pages: embedded JSON, line-up pages, squad pages, data attributes.

All readers stand on the tags of markup.tokens: an element's extent comes from its depth, so
a block ends where its element does. Pages are independent: windows and groups are by page.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import markup as M
from . import nested as N

#: Spellings of the fields in embedded JSON, and of line-ups.
NAMES = ("player_name", "name", "display_name", "displayName", "full_name", "fullname")
STATUS = ("status", "injury_status", "availability")
LINEUP = ("predicted_lineup", "lineup", "lineUp", "starting11", "is_starting")
RISK = ("competition_risk", "rotation_risk", "risk")
SLUG = ("slug", "player_slug", "playerSlug", "id", "player_id", "playerId")
IDENT = ("player_id", "playerId", "id", "pid")
STARTER = ("starter", "startelf", "starting", "starting11", "first11", "1", "true")
BENCH = ("bench", "bank", "reserve", "0", "false")
#: The script that holds data, classes of blocks, folders of players' photos.
DATA_SCRIPT = "__NEXT_DATA__"
LINEUP_START, BENCH_START, LEAGUE = "player_position_row", "team_squad_area", "league_name_holder"
COLUMN, SUB, PHOTO, NAME_BOX, SQUAD_ROW = "player_position_column", "sub_child", "player_position_photo", "player_name", "leg_column_row"
PHOTO_FOLDERS = ("/images/player/", "player/team")

COLUMNS = ("slug", "player_id", "player_name", "status", "lineup", "risk", "competitors")


def lineup_of(c: Column) -> Column:
    text = F.lower(F.trim(c))
    return F.when(text.isin(*STARTER), "starter").when(text.isin(*BENCH), "bench").otherwise(F.nullif(text, F.lit("")))


def _known(c: Column) -> Column:
    return F.coalesce(c, F.lit("unknown"))


def _row(slug: Column, ident: Column, name: Column, status: Column, lineup: Column, risk: Column, competitors: Column | None = None) -> list[Column]:
    none = F.array().cast("array<string>") if competitors is None else competitors
    return [c.alias(n) for c, n in zip((F.coalesce(slug, F.lit("")), F.coalesce(ident, F.lit("")), name, _known(status), _known(lineup), _known(risk), none), COLUMNS, strict=True)]


def embedded_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Objects at any depth of the page's data script that have a name and one of status,
    line-up and risk; the first of those with one slug and name."""
    scripts = F.regexp_extract_all(html, F.lit(r"(?si)<script\b[^>]*>.*?</script\s*>"), F.lit(0))
    own = F.get(F.filter(scripts, lambda s: M.attribute(F.regexp_extract(s, "^<[^>]*>", 0), "id") == DATA_SCRIPT), F.lit(0))
    body = M.unescaped(F.regexp_replace(own, r"(?si)^<[^>]*>|</script\s*>$", ""))
    objects = N.json_objects(pages.where(F.col(html).contains(DATA_SCRIPT)).select(key, body.alias("body")).where("trim(body) <> ''"), key, "body", ())
    o = F.col("object")
    text = lambda keys: N.json_first(o, keys)
    lineup = F.coalesce(*[lineup_of(F.get_json_object(o, f"$.{k}")) for k in LINEUP])
    rows = objects.select(key, "place", *_row(text(SLUG), text(IDENT), text(NAMES), text(STATUS), lineup, text(RISK)))
    told = rows.where("player_name is not null and not (status = 'unknown' and lineup = 'unknown' and risk = 'unknown')")
    return _first_of(told, key, ["slug", "player_name"])


def _first_of(rows: DataFrame, key: str, same: Sequence[str]) -> DataFrame:
    """Rows of a page without those whose `same` columns an earlier one has."""
    n = F.row_number().over(Window.partitionBy(key, *same).orderBy("place"))
    return rows.withColumn("_n", n).where("_n = 1").drop("_n")


def _starts(css: str, exact: bool = True) -> Column:
    """Whether a token starts a div of this class."""
    own = (F.col("css") == css) if exact else F.col("css").startswith(css)
    return F.coalesce((F.col("tag") == "div") & ~F.col("closes") & own, F.lit(False))


def _since(key: str, current: bool = True) -> Window:
    return Window.partitionBy(key).orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow if current else -1)


def _blocks(rows: DataFrame, key: str, name: str, starts: Column, within: Column) -> DataFrame:
    """rows with `name`: the number of the block's first token for tokens inside a block, else
    null. A block is an element whose start tag `starts` says; it ends with its end tag, or with
    `within`, the last token it may have. Blocks inside a block of the kind aren't told apart."""
    ends = F.least(F.coalesce("ends", within), within)
    rows = rows.withColumn("_ends", F.when(starts, ends))
    rows = rows.withColumn("_own", F.col("_ends").isNotNull() & ~F.coalesce(F.max("_ends").over(_since(key, False)) >= F.col("i"), F.lit(False)))
    first = F.last(F.when(F.col("_own"), F.col("i")), ignorenulls=True).over(_since(key))
    last = F.last(F.when(F.col("_own"), F.col("_ends")), ignorenulls=True).over(_since(key))
    rows = rows.withColumns({"_first": first, "_last": last})
    return rows.withColumn(name, F.when(F.col("i") <= F.col("_last"), F.col("_first"))).drop("_ends", "_own", "_first", "_last")


PLAYER_HREF = r"(?i)^/([a-z0-9-]+)_([0-9]+)/$"


def _links(rows: DataFrame, key: str, by: Sequence[str], starts: Column) -> DataFrame:
    """(by, link, slug, ident, said) of the links whose start tags `starts` says: said is the alt text in
    them, else their text."""
    rows = rows.withColumns({"_link": F.last(F.when(starts, F.col("i")), ignorenulls=True).over(_since(key)), "_over": F.last(F.when((F.col("tag") == "a") & F.col("closes"), F.col("i")), ignorenulls=True).over(_since(key))})
    inside = rows.where("_link is not null and coalesce(_over < _link, true)").withColumn("alt", M.attribute(F.col("token"), "alt"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("i", "token"))), lambda s: s["token"])
    href = F.min_by("href", "i")
    alt = F.min_by(F.when(F.col("alt") != "", F.col("alt")), F.when(F.col("alt") != "", F.col("i")))
    found = inside.groupBy(*by, F.col("_link").alias("link")).agg(href.alias("href"), alt.alias("alt"), F.array_join(parts, " ").alias("body"))
    # Decoded once: alt text and text, each trimmed behind that.
    both = F.split(M.unescaped(F.concat_ws("\x02", F.coalesce("alt", F.lit("")), F.regexp_replace("body", r"<[^>]+>", " "))), "\x02")
    found = found.withColumn("both", F.transform(both, lambda t: F.nullif(F.trim(F.regexp_replace(t, r"(?U)^\s+|\s+$", "")), F.lit(""))))
    said = F.coalesce(F.get("both", F.lit(0)), F.regexp_replace(F.get("both", F.lit(1)), r"(?U)\s+", " "))
    return found.select(*by, "link", F.lower(F.regexp_extract("href", PLAYER_HREF, 1)).alias("slug"), F.regexp_extract("href", PLAYER_HREF, 2).alias("ident"), said.alias("said"))


def _name_of_slug(slug: Column) -> Column:
    return F.initcap(F.trim(F.regexp_replace(slug, "-+", " ")))


#: Characters of HTML in one task; tokens of a page are sorted there several times.
TASK_CHARS = 4_000_000


def dealt(pages: DataFrame, key: str, html: str) -> DataFrame:
    """The pages in a task for each TASK_CHARS, whatever the number of shuffle partitions; windows by
    page need no other shuffle."""
    chars = pages.agg(F.sum(F.length(html))).first()[0] or 0
    return pages.repartition(chars // TASK_CHARS + 1, key)


def _read(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Tokens of pages with class, href and the ends of div elements."""
    rows = M.with_ends(M.tokens(dealt(pages.select(key, html), key, html), key, html), key, "div")
    return rows.withColumns({"css": F.when(F.col("tag") == "div", M.attribute(F.col("token"), "class")), "href": F.when((F.col("tag") == "a") & ~F.col("closes"), M.attribute(F.col("token"), "href"))})


def squad_area_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Players of a line-up page: those before the squad area start, those in it are on the
    bench. A column's players compete with one another; a part without columns
    has a player for every photo. The first row of a slug stays."""
    rows = _read(pages.where(F.col(html).contains(LINEUP_START)), key, html)
    page = Window.partitionBy(key)
    first = lambda c: F.min(F.when(c, F.col("i"))).over(page)
    rows = rows.withColumns({"start": first(_starts(LINEUP_START, False)), "area": first(M.attribute(F.col("token"), "class") == BENCH_START), "league": first(M.attribute(F.col("token"), "class") == LEAGUE), "over": F.max("i").over(page) + 1})
    bench = F.col("area") > F.col("start")
    stop = F.when(bench, F.col("area")).when(F.col("league") > F.col("start"), F.col("league")).otherwise(F.col("over"))
    last = F.when(F.col("league") > F.col("area"), F.col("league")).otherwise(F.col("over"))
    lineup = F.when((F.col("i") >= F.col("start")) & (F.col("i") < stop), "starter").when(bench & (F.col("i") >= F.col("area")) & (F.col("i") < last), "bench")
    rows = rows.withColumn("lineup", lineup).where("lineup is not null").withColumn("stop", F.when(F.col("lineup") == "starter", stop).otherwise(last) - 1)
    rows = _blocks(rows, key, "column", _starts(COLUMN, False), F.col("stop"))
    rows = rows.withColumn("has_columns", F.max("column").over(Window.partitionBy(key, "lineup")).isNotNull())
    rows = rows.withColumn("column_ends", F.max("i").over(Window.partitionBy(key, "column")))
    rows = _blocks(rows, key, "sub", _starts(SUB) & F.col("column").isNotNull(), F.col("column_ends"))
    has_subs = F.max("sub").over(Window.partitionBy(key, "column")).isNotNull()
    rows = rows.withColumn("unit", F.when(F.col("column").isNotNull(), F.when(has_subs, F.col("sub")).otherwise(F.col("column"))))
    # A photo's link stands behind its box with nothing but start tags of divs between.
    opens = (F.col("tag") == "div") & ~F.col("closes")
    other = F.last(F.when(~F.coalesce(opens, F.lit(False)), F.col("i")), ignorenulls=True).over(_since(key, False))
    photo = F.last(F.when(_starts(PHOTO, False), F.col("i")), ignorenulls=True).over(_since(key, False))
    named = F.coalesce(F.lag(_starts(NAME_BOX)).over(Window.partitionBy(key).orderBy("i")), F.lit(False))
    is_link = F.coalesce(F.col("href").rlike(PLAYER_HREF), F.lit(False))
    rows = rows.withColumns({"is_photo": is_link & F.coalesce(photo > F.coalesce(other, F.lit(-1)), F.lit(False)), "is_name": named & (F.col("tag") == "a") & ~F.col("closes")})
    by = [key, "lineup", "column", "unit"]
    told = rows.where("unit is not null or not has_columns")
    photos = _links(told, key, by, F.col("is_photo"))
    # One player a unit, the first; where there are no columns every link is a unit.
    unit = F.coalesce("unit", "link")
    photos = photos.withColumn("unit", unit).withColumn("_n", F.row_number().over(Window.partitionBy(key, "unit").orderBy("link"))).where("_n = 1").drop("_n")
    names = _links(told.where("unit is not null"), key, [key, "unit"], F.col("is_name")).groupBy(key, "unit").agg(F.min_by("said", "link").alias("box_name"))
    players = photos.join(names, [key, "unit"], "left").withColumn("name", F.coalesce("said", "box_name", _name_of_slug(F.col("slug"))))
    team = Window.partitionBy(key, "column").orderBy("unit").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    mates = F.collect_list(F.struct("slug", "name")).over(team)
    rivals = F.when(F.col("column").isNotNull(), F.transform(F.filter("mates", lambda q: q["slug"] != F.col("slug")), lambda q: q["name"])).otherwise(F.array().cast("array<string>"))
    none = F.lit(None).cast("string")
    made = players.withColumn("mates", mates).select(key, F.col("link").alias("place"), *_row(F.col("slug"), F.col("ident"), F.col("name"), none, F.col("lineup"), none, rivals))
    return _first_of(made, key, ["slug"])


def attribute_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """A row for each tag with a player's name among its data attributes."""
    tags = M.tokens(pages.where(F.lower(html).contains("data-player-name")), key, html).where("tag is not null and not closes")
    names = ("player-slug", "player-id", "player-name", "status", "predicted-lineup", "competition-risk")
    raw = F.concat_ws("\x02", *[F.coalesce(M.attribute(F.col("token"), f"data-{n}"), F.lit("")) for n in names])
    told = tags.where(F.lower("token").contains("data-player-name")).select(key, "i", F.split(M.unescaped(raw), "\x02").alias("v"))
    value = {n: F.nullif(F.trim(F.get("v", F.lit(k))), F.lit("")) for k, n in enumerate(names)}
    rows = told.select(key, F.col("i").alias("place"), *_row(F.coalesce(value["player-slug"], value["player-id"]), value["player-id"], value["player-name"], value["status"], lineup_of(value["predicted-lineup"]), value["competition-risk"]))
    return _first_of(rows.where("player_name is not null"), key, ["slug", "player_name"])


def player_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, parser, place, ..COLUMNS): the rows of the first parser that finds any in a page."""
    parsers = (embedded_rows, squad_area_rows, attribute_rows)
    found = [f(pages, key, html).select(key, F.lit(i).alias("parser"), F.col("place").cast("long").alias("place"), *COLUMNS) for i, f in enumerate(parsers)]
    every = found[0].union(found[1]).union(found[2])
    return every.withColumn("_best", F.min("parser").over(Window.partitionBy(key))).where("parser = _best").drop("_best")


def absolute(page_url: Column, ref: Column) -> Column:
    """ref as seen from the page: with a scheme, without one, from the site's root or beside the page."""
    scheme, site = F.regexp_extract(page_url, "^([A-Za-z][A-Za-z0-9+.-]*:)//", 1), F.regexp_extract(page_url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(page_url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(path, "^(.*/)", 1), F.lit("")), F.lit("/"))
    return F.when(ref.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), ref).when(ref.startswith("//"), F.concat(scheme, ref)).when(ref.startswith("/"), F.concat(site, ref)).otherwise(F.concat(site, folder, ref))


def squad_rows(pages: DataFrame, key: str, html: str, url: str) -> DataFrame:
    """(key, place, slug, player_id, player_name, profile_url, image_url, birthdate) of a
    squad page's rows, the first of each slug; place counts rows with a player. The image is the
    first one from a folder of players' photos."""
    some = pages.where(F.col(html).contains(SQUAD_ROW))
    rows = _read(some, key, html).withColumn("over", F.max("i").over(Window.partitionBy(key)))
    rows = _blocks(rows, key, "block", _starts(SQUAD_ROW), F.col("over")).where("block is not null")
    links = _links(rows, key, [key, "block"], F.coalesce(F.col("href").rlike(PLAYER_HREF), F.lit(False)))
    first = links.withColumn("_n", F.row_number().over(Window.partitionBy(key, "block").orderBy("link"))).where("_n = 1")
    src = F.when((F.col("tag") == "img") & ~F.col("closes"), F.trim(M.attribute(F.col("token"), "src")))
    photo = F.when(src.contains(PHOTO_FOLDERS[0]) | src.contains(PHOTO_FOLDERS[1]), src)
    day = F.nullif(F.regexp_extract("token", r"\b([0-9]{2}\.[0-9]{2}\.[0-9]{4})\b", 1), F.lit(""))
    marked = rows.withColumns({"photo": photo, "day": day})
    seen = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("i")))
    facts = marked.groupBy(key, "block").agg(seen("photo").alias("photo"), seen("day").alias("day"))
    urls = some.select(key, F.col(url).alias("page_url")).dropDuplicates([key])
    made = first.join(facts, [key, "block"]).join(urls, key).select(
        key, F.col("block").alias("place"), "slug", F.col("ident").alias("player_id"), F.coalesce("said", _name_of_slug(F.col("slug"))).alias("player_name"),
        absolute(F.col("page_url"), F.concat(F.lit("/"), "slug", F.lit("_"), "ident", F.lit("/"))).alias("profile_url"), absolute(F.col("page_url"), M.unescaped(F.col("photo"))).alias("image_url"),
        F.try_to_timestamp(F.col("day"), F.lit("dd.MM.yyyy")).cast("date").alias("birthdate"),
    )
    kept = _first_of(made, key, ["slug"])
    return kept.withColumn("place", (F.row_number().over(Window.partitionBy(key).orderBy("place")) - 1).cast("int"))
