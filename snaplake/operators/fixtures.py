"""Fixture payloads, team codes and team dimensions.

A payload is JSON text: a list of days, bare or under one of several keys, each with its
matches. Payloads are read by from_json and stay rows of Spark; one payload is small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import first_text, to_int, to_text, without_accents
from .latest import newest_per_key

#: Keys under which a payload may hold its list, in order of preference.
ENVELOPES = ("data", "items", "rows", "it", "result", "players", "history", "ph")
#: Keys of a day's number (of a match list, of a calendar), of its flag and of its season.
MATCH_DAY = ("day", "dayNumber", "matchday")
CALENDAR_DAY = ("dayNumber", "matchday", "day", "id", "n")
CURRENT = ("isCurrent", "current", "cur")
SEASON = ("ti", "season", "season_label", "sn", "seasonLabel")

_TEXTS = ",".join(f"{k}:string" for k in dict.fromkeys((*CALENDAR_DAY, *CURRENT, *SEASON)))
_DAY = f"struct<{_TEXTS},it:array<struct<t1:string,t2:string,t1sy:string,t2sy:string>>>"


def days_of(payload: Column) -> Column:
    """The days of a payload as an array; null where it is none."""
    wrapped = F.from_json(payload, "struct<" + ",".join(f"{e}:array<{_DAY}>" for e in ENVELOPES) + ">")
    return F.when(F.ltrim(payload).startswith("["), F.from_json(payload, f"array<{_DAY}>")).otherwise(F.coalesce(*[wrapped[e] for e in ENVELOPES]))


def calendar(days: Column) -> tuple[Column, Column]:
    """The current day (the last one with a flag, or else the highest) and the first season
    label of an array of days."""
    read = F.transform(days, lambda r: F.struct(to_int(F.coalesce(*[r[k] for k in CALENDAR_DAY])).alias("day"), F.lower(F.trim(F.coalesce(*[r[k] for k in CURRENT]))).isin("true", "1", "yes").alias("flag")))
    known = F.filter(read, lambda r: r["day"].isNotNull())
    flagged = F.filter(known, lambda r: r["flag"])
    labels = F.filter(F.transform(days, lambda r: first_text(*[r[k] for k in SEASON])), lambda x: x.isNotNull())
    return F.coalesce(F.try_element_at(flagged, F.lit(-1))["day"], F.array_max(F.transform(known, lambda r: r["day"]))), F.try_element_at(labels, F.lit(1))


def matches_of(df: DataFrame, payload: str, keys: Sequence[str]) -> DataFrame:
    """(keys, day, place, t1, t2, t1sy, t2sy) of every match; place tells their order."""
    days = df.select(*keys, F.posexplode(days_of(F.col(payload))).alias("at_day", "d"))
    rows = days.select(*keys, to_int(F.coalesce(*[F.col("d")[k] for k in MATCH_DAY])).alias("day"), "at_day", F.posexplode("d.it").alias("at", "m"))
    return rows.select(*keys, "day", F.struct("at_day", "at").alias("place"), to_int(F.col("m.t1")).alias("t1"), to_int(F.col("m.t2")).alias("t2"), "m.t1sy", "m.t2sy")


def fixture_lookup(matches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each (keys, day, t1, t2): the last of the payload. Matches without a day
    or a side are left out."""
    full = matches.where("day is not null and t1 is not null and t2 is not null")
    return newest_per_key(full, [*keys, "day", "t1", "t2"], ["place"])


def team_symbols(matches: DataFrame, order: Sequence[str], defaults: Mapping[int, str]) -> DataFrame:
    """(team, code): the last symbol that a match names, or the default; null is a team
    without either."""
    sides = F.array(*[F.struct(F.col(t).alias("team"), normal_code(F.col(f"{t}sy")).alias("code"), F.lit(i).alias("side")) for i, t in enumerate(("t1", "t2"))])
    seen = matches.select(*order, "place", F.explode(sides).alias("s")).where("s.team is not null")
    named = F.when(F.col("s.code").isNotNull(), F.struct(*order, "place", "s.side"))
    last = seen.groupBy(F.col("s.team").alias("team")).agg(F.max_by("s.code", named).alias("code"))
    known = matches.sparkSession.createDataFrame(list(defaults.items()), "team bigint, standard string")  # a short list
    return last.join(known, "team", "full").select("team", F.coalesce("code", normal_code(F.col("standard"))).alias("code"))


def normal_code(c: Column) -> Column:
    """Letters and digits in upper case; without any it is null."""
    return F.nullif(F.upper(F.regexp_replace(c, "[^A-Za-z0-9]+", "")), F.lit(""))


def resolved_code(inline: Column, mapped: Column, team: Column, defaults: Mapping[int, str]) -> Column:
    """The first of the inline symbol, the payload's code and the default that is not empty."""
    standard = F.create_map(*[F.lit(x) for kv in defaults.items() for x in kv])[team]
    return F.when(inline != "", normal_code(inline)).when(mapped != "", normal_code(mapped)).otherwise(normal_code(standard))


def code_of_url(url: Column, codes: Mapping[str, str]) -> Column:
    """The code of the first part of a URL's path, or its first three letters or digits."""
    path = F.regexp_replace(F.regexp_replace(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""), "[?#].*$", "")
    part = F.lower(F.trim(F.regexp_extract(path, "^/*([^/]+)", 1)))
    short = normal_code(F.substring(without_accents(F.regexp_replace(part, "-", "")), 1, 3))
    return F.coalesce(F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])[part], short)


def dimension_rows(df: DataFrame, id_col: str, code: str, name: str, url: str, order: Sequence[Column], *, ids: Sequence[int] | None = None, codes: Sequence[str] | None = None, default_codes: Mapping[int, str]) -> DataFrame:
    """One row for each (id, code): the name of its first row and its first URL. A missing
    code is the id's default; rows without id and code are left out, and rows outside the
    ids or codes in scope, where given (rows without an id pass the scope of ids)."""
    standard = F.create_map(*[F.lit(x) for kv in default_codes.items() for x in kv])[F.col(id_col)]
    rows = df.select(F.col(id_col), F.coalesce(normal_code(F.col(code)), standard).alias(code), to_text(F.col(name)).alias(name), to_text(F.col(url)).alias(url), F.struct(*order).alias("_at"))
    rows = rows.where(F.col(id_col).isNotNull() | F.col(code).isNotNull())
    if ids is not None:
        rows = rows.where(F.col(id_col).isNull() | F.col(id_col).isin(list(ids)))
    if codes is not None:
        rows = rows.where(F.col(code).isin(list(codes)))
    return rows.groupBy(id_col, code).agg(F.min_by(name, "_at").alias(name), F.min_by(url, F.when(F.col(url).isNotNull(), F.col("_at"))).alias(url))
