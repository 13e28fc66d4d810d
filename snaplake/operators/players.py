"""A player's row from four payloads: market, details, matches, values and transfers.

Payloads are maps of texts (JSON objects read with from_json) whose fields have several
spellings; the market's come before the details'. Arrays stand in the payload of one
player, so they are folded where they are and never joined.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import latest

#: Spellings of the fields.
MINUTES, SECONDS = ("minutes", "mins", "m", "min"), ("sec", "seconds")
POINTS, DAY = ("p", "points", "raw_points"), ("matchday", "md", "mday", "spieltag")
STARTED = ("1", "true", "starter", "startelf")
IDS, FIRST, LAST, FULL = ("kickbase_player_id", "player_id", "id", "i", "pi"), ("first_name", "fn"), ("last_name", "ln"), ("player_name", "name", "full_name")
TOTAL_MINUTES, TOTAL_SECONDS = ("total_minutes", "minutes_total", "mins", "minutes", "tm"), ("sec", "seconds", "seconds_played")
AVERAGE_MINUTES = ("avg_minutes", "average_minutes", "minutes_avg", "avg_min")
APPEARANCES, STARTS = ("appearances", "apps", "matches", "games"), ("starts", "s11", "starting_eleven", "startelf")


def text(m: Column, keys: Sequence[str]) -> Column:
    """The first of several fields that is no empty text."""
    return F.coalesce(*[F.nullif(F.trim(m[k]), F.lit("")) for k in keys])


def number(m: Column, keys: Sequence[str]) -> Column:
    """The first of several fields that is a number."""
    return F.coalesce(*[m[k].try_cast("double") for k in keys])


def whole(m: Column, keys: Sequence[str]) -> Column:
    return number(m, keys).cast("long")


def _counted(matches: Column) -> Column:
    """Appearances, starts, minutes, last day and its points, and the last points of all."""
    zero = F.struct(
        F.lit(0).cast("long").alias("appearances"), F.lit(0).cast("long").alias("starts"), F.lit(0.0).alias("minutes"), F.lit(None).cast("long").alias("last_day"),
        F.lit(None).cast("double").alias("last_points"), F.lit(None).cast("double").alias("any_points"),
    )

    def step(s: Column, m: Column) -> Column:
        minutes, points, day = F.coalesce(number(m, MINUTES), number(m, SECONDS) / 60), number(m, POINTS), whole(m, DAY)
        played = F.coalesce(m["hp"] == "true", F.lit(False)) | F.coalesce(minutes > 0, F.lit(False)) | points.isNotNull()
        started = F.coalesce(F.lower(F.trim(m["st"])).isin(*STARTED) | F.coalesce(m["st"].try_cast("double") > 0, F.lit(False)), F.lit(False))
        newest = day.isNotNull() & (s["last_day"].isNull() | (day >= s["last_day"]))
        return F.struct(
            (s["appearances"] + played.cast("long")).alias("appearances"), (s["starts"] + started.cast("long")).alias("starts"),
            (s["minutes"] + F.greatest(F.coalesce(minutes, F.lit(0.0)), F.lit(0.0))).alias("minutes"), F.when(newest, day).otherwise(s["last_day"]).alias("last_day"),
            F.when(newest & points.isNotNull(), points).otherwise(s["last_points"]).alias("last_points"), F.coalesce(points, s["any_points"]).alias("any_points"),
        )

    return F.aggregate(F.coalesce(matches, F.array().cast("array<map<string,string>>")), zero, step)


def playing_stats(details: Column, counted: Column) -> dict[str, Column]:
    """Totals of the details, else of the matches. Of the counters smc and ismc the larger
    one is appearances and the smaller one starts."""
    one, two = whole(details, ("smc",)), whole(details, ("ismc",))
    both = one.isNotNull() & two.isNotNull()
    of_matches = lambda c: F.when(counted[c] > 0, counted[c])
    appearances = F.coalesce(whole(details, APPEARANCES), F.when(both, F.greatest(one, two)).otherwise(two), of_matches("appearances"))
    starts = F.coalesce(whole(details, STARTS), F.when(both, F.least(one, two)).otherwise(one), of_matches("starts"))
    total = F.coalesce(number(details, TOTAL_MINUTES), number(details, TOTAL_SECONDS) / 60, of_matches("minutes"))
    average = F.coalesce(number(details, AVERAGE_MINUTES), F.when(appearances > 0, total / appearances))
    return {
        "appearances_total": appearances, "starts_total": starts, "average_minutes": F.round(average, 2), "last_matchday": counted["last_day"],
        "last_match_points": F.round(F.coalesce(counted["last_points"], counted["any_points"]), 2),
    }


def _label(code: Column, labels: Mapping[int, str], default: str) -> Column:
    out = F.lit(default)
    for k, v in labels.items():
        out = F.when(code == k, v).otherwise(out)
    return out


def player_row(
    df: DataFrame, keep: Sequence[str], *, market: str, details: str, matches: str, values: str, transfers: str, now: Column,
    positions: Mapping[int, str], injuries: Mapping[int, str], injured: Sequence[int], chances: Mapping[int, str], colors: Mapping[int, str] | None = None,
) -> DataFrame:
    """keep and the 35 columns of a player. values and transfers are arrays of (time, value)."""
    # The spellings of fields below.
    m, d = F.coalesce(F.col(market), F.create_map().cast("map<string,string>")), F.coalesce(F.col(details), F.create_map().cast("map<string,string>"))
    either = lambda f, mine, theirs=None: F.coalesce(f(m, mine), f(d, theirs or mine))
    first = either(text, FIRST)
    last = F.coalesce(text(m, LAST), text(d, (*LAST, "n")), text(m, ("n",)))
    name = F.coalesce(text(m, FULL), text(d, ("player_name", "name")), F.nullif(F.concat_ws(" ", first, last), F.lit("")), text(m, ("n",)))
    position, status, chance = either(whole, ("position", "pos")), either(whole, ("st", "status_code")), either(whole, ("prob", "start_probability_code"))
    price = F.coalesce(whole(m, ("market_value", "mv")), whole(d, ("market_value", "mv", "cv")))
    known = F.filter(values, lambda v: v["time"].isNotNull() & v["value"].isNotNull())
    ordered = F.array_sort(F.transform(known, lambda v: F.struct(v["time"].alias("time"), v["value"].alias("value"))))
    year = F.filter("_values", lambda v: v["time"] >= now - F.expr("INTERVAL 365 DAYS"))
    span = F.transform(F.when(F.size(year) > 0, year).otherwise(F.col("_values")), lambda v: v["value"])
    paid = F.transform(F.filter(transfers, lambda t: (t["time"] >= now - F.expr("INTERVAL 10 DAYS")) & t["value"].isNotNull()), lambda t: t["value"])
    rows = df.withColumns({"_counted": _counted(F.col(matches)), "_values": ordered, "_paid": paid})
    columns = {
        "player_id": either(text, IDS), "player_name": name, "first_name": first, "last_name": last, "team_id": either(text, ("team_id", "tid")),
        "position_code": position, "position": _label(position, positions, "unknown"), "market_value": price,
        "market_value_day_change": F.coalesce(whole(m, ("mvt", "market_value_change_1d")), whole(d, ("mvt", "tfhmvt"))),
        "market_value_history_10d": F.transform(F.filter("_values", lambda v: v["time"] >= now - F.expr("INTERVAL 10 DAYS")), lambda v: F.struct(v["time"].alias("date"), F.round(v["value"]).cast("long").alias("market_value"))),
        "market_value_high_365d": F.round(F.coalesce(F.array_max(span), price.cast("double"), F.lit(0.0))).cast("long"),
        "market_value_low_365d": F.round(F.coalesce(F.array_min(span), price.cast("double"), F.lit(0.0))).cast("long"),
        "average_paid_price_10d": F.when(F.size("_paid") > 0, F.round(F.aggregate("_paid", F.lit(0.0), lambda s, x: s + x) / F.size("_paid"), 2)),
        "average_points": either(number, ("average_points", "ap")), "total_points": either(whole, ("points", "p", "tp")),
        **playing_stats(d, F.col("_counted")),
        "goals_total": whole(d, ("g", "goals", "goals_total")), "assists_total": whole(d, ("a", "assists", "assists_total")),
        "yellow_cards_total": whole(d, ("y", "yellow_cards", "yellow_total")), "red_cards_total": whole(d, ("r", "red_cards", "red_total")),
        "start_probability_code": chance, "start_probability_color": _label(chance, colors or {}, "unknown"), "start_probability_label": _label(chance, chances, "unknown"), "injury_status_code": status, "injury_status": _label(status, injuries, "unknown"),
        "is_injured": F.coalesce(status.isin(*injured), F.lit(False)), "status_last_updated_at": F.coalesce(text(m, ("dt", "status_updated_at", "updated_at")), text(d, ("dt", "ts", "status_updated_at", "updated_at"))),
        "raw_market_row": F.col(market), "raw_player_details": F.when(F.size(d) > 0, d), "raw_player_performance": F.when(F.size(matches) > 0, F.col(matches)), "raw_player_transfers": F.coalesce(F.col(transfers), F.array()),
    }
    return rows.select(*keep, *[c.alias(n) for n, c in columns.items()])


def match_entities(left: DataFrame, right: DataFrame, *, name: tuple[Column, str], team: tuple[Column, str], slug: tuple[Column, str], order: Sequence[Column], values: Sequence[str], slug_order: Sequence[Column] | None = None) -> DataFrame:
    """Every row of left with values of the row of right that is the same entity: by name,
    of the same team where a row of that name is, then the first by order; where no row has
    the name, the first with the slug (by slug_order where given); else nulls. Each pair is a left column and the name of
    a right one. right is cut to a row a key before each join, so a frequent name makes no
    pairs."""
    out, found = left, []
    for tag, pairs in (("t", (name, team)), ("n", (name,)), ("s", (slug,))):
        keys = [c for _, c in pairs]
        known = right.where(" and ".join(f"`{k}` is not null" for k in keys))
        side = latest.newest_per_key(known, keys, slug_order or order if tag == "s" else order).select(*[F.col(k).alias(f"_{tag}{i}") for i, k in enumerate(keys)], F.struct(*values).alias(f"_{tag}v"))
        on = [mine == F.col(f"_{tag}{i}") for i, (mine, _) in enumerate(pairs)]
        out = out.join(side, on[0] if len(on) == 1 else on[0] & on[1], "left")
        found.append(F.col(f"_{tag}v"))
    best = F.coalesce(*found)
    return out.select(*left.columns, *[best[v].alias(v) for v in values])
