"""Match rows of players from nested history payloads.

A payload is JSON text of any nesting. An object with a day and points is a match; its
season is the nearest label at or above it. Everything is column functions on the object
found, and broadcast-sized joins for what is known about fixtures and teams.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import nested
from ..functions.scalars import parse_time, to_int, to_text
from .fixtures import resolved_code
from .latest import newest_per_key

#: Spellings of the fields of a match; the first one present counts, null or not.
SEASON = ("ti", "season", "season_label", "sn")
LOOKS_LIKE_DAY, LOOKS_LIKE_POINTS = ("day", "matchday", "md", "dayNumber"), ("p", "points", "pts", "total_points")
DAY = ("matchday", "dayNumber", "spieltag", "day")
KICKOFF = ("kickoff", "md", "match_ts", "d", "date", "ts")
HOME_GOALS, AWAY_GOALS = ("scoreHome", "score_home", "sh", "t1g"), ("scoreAway", "score_away", "sa", "t2g")
SCORE = ("score", "result", "res")
TEAM = ("team_id", "kickbase_team_id", "tid", "t", "pt")
HOME, AWAY = ("t1", "team_home_id"), ("t2", "team_away_id")
HOME_SYMBOL, AWAY_SYMBOL = ("t1sy", "team_home_symbol"), ("t2sy", "team_away_symbol")
OPPONENT = ("opponent_team_id", "opp_tid", "otid", "opponentTeamId")
MATCH_ID = ("match_id", "matchId", "mid", "m")
UNKNOWN_SEASON, UNKNOWN_CODE = "unknown", "TNA"

COLUMNS = ("season_label", "matchday", "match_uid", "match_id", "kickoff_ts", "team_id", "opponent_team_id", "t1_id", "t2_id", "t1_code", "t2_code", "is_home", "score_home", "score_away", "match_result", "points_total", "raw_json")


def present(fields: Column, names: Sequence[str]) -> Column:
    """The value of the first of names that a map has as a key, also where it is null."""
    return reduce(lambda out, n: F.when(F.map_contains_key(fields, n), F.element_at(fields, n)).otherwise(out), reversed(names), F.lit(None).cast("string"))


def season_token(label: Column) -> Column:
    """25/26 of 2025/2026; other labels as they are."""
    pattern = r"^\s*\d{2}(\d{2})\s*/\s*\d{2}(\d{2})\s*$"
    return F.when(label.rlike(pattern), F.concat(F.regexp_extract(label, pattern, 1), F.lit("/"), F.regexp_extract(label, pattern, 2))).otherwise(label)


def match_uid(season: Column, day: Column, home: Column, away: Column) -> Column:
    code = lambda c: F.coalesce(c, F.lit(UNKNOWN_CODE))
    return F.concat(season_token(season), F.lit("-MD"), F.when(day < 10, F.concat(F.lit("0"), day.cast("string"))).otherwise(day.cast("string")), F.lit("-"), code(home), code(away))


def performance_rows(
    df: DataFrame,
    key: str,
    payload: str,
    *,
    active_season: str | None = None,
    fixtures: DataFrame | None = None,
    codes: DataFrame | None = None,
    default_codes: Mapping[int, str] | None = None,
    allowed: DataFrame | None = None,
) -> DataFrame:
    """(key, ..COLUMNS): one row for each season and day of a player's payload, the last of the
    text. key tells rows of df apart.

    fixtures(day, t1, t2, match_id, kickoff, t1_goals, t2_goals), one row for each pair in an order,
    fill what rows of the active season lack, found by either order of the pair. codes(team, code)
    name teams without a symbol of their own, then default_codes. allowed(team): rows whose teams
    aren't both in it are left out."""
    objects = nested.json_objects(df, key, payload, (), [SEASON])
    m = F.col("fields")
    rows = objects.select(key, "place", F.get_json_object("inherited", f"$.{SEASON[0]}").alias("label"), F.col("object").alias("raw_json"), F.explode(F.array(F.from_json("object", "map<string,string>"))).alias("fields"))  # behind explode conditions on fields don't read the text again
    rows = rows.where(present(m, LOOKS_LIKE_DAY).isNotNull() & present(m, LOOKS_LIKE_POINTS).isNotNull())
    goals = F.split(F.replace(to_text(present(m, SCORE)), F.lit(" "), F.lit("")), ":", 2)
    both = F.transform(goals, lambda g: F.when(g.rlike(r"^[+-]?\d+$"), g.try_cast("bigint")))
    told = (F.size(goals) == 2) & F.get(both, F.lit(0)).isNotNull() & F.get(both, F.lit(1)).isNotNull()
    rows = rows.select(
        key, "place", "raw_json", "fields", F.coalesce(to_text(F.col("label")), F.lit(UNKNOWN_SEASON)).alias("season_label"), to_int(present(m, DAY)).alias("matchday"), to_int(present(m, LOOKS_LIKE_POINTS)).alias("points_total"),
        parse_time(present(m, KICKOFF)).alias("kickoff_ts"), to_int(present(m, HOME_GOALS)).alias("gh"), to_int(present(m, AWAY_GOALS)).alias("ga"), told.alias("told"), both.alias("both"),
        to_int(present(m, TEAM)).alias("team_id"), to_int(present(m, HOME)).alias("t1_id"), to_int(present(m, AWAY)).alias("t2_id"), to_int(present(m, MATCH_ID)).alias("match_id"), to_int(present(m, OPPONENT)).alias("opponent_team_id"),
    ).where("matchday is not null and points_total is not null")
    # A score text counts where either number is missing, and then for both.
    lacks = (F.col("gh").isNull() | F.col("ga").isNull()) & F.col("told")
    rows = rows.withColumns({"score_home": F.when(lacks, F.get("both", F.lit(0))).otherwise(F.col("gh")), "score_away": F.when(lacks, F.get("both", F.lit(1))).otherwise(F.col("ga"))})
    if allowed is not None:
        team = allowed.columns[0]
        for side in ("t1_id", "t2_id"):
            rows = rows.join(allowed.select(F.col(team).alias(side)).distinct(), side, "left_semi")
    if fixtures is not None and active_season is not None:
        what = F.struct("match_id", "kickoff", "t1_goals", "t2_goals")
        for name, a, b in (("_as", "t1", "t2"), ("_other", "t2", "t1")):
            side = fixtures.select(F.lit(active_season).alias("season_label"), F.col("day").alias("matchday"), F.col(a).alias("t1_id"), F.col(b).alias("t2_id"), what.alias(name))
            rows = rows.join(side, ["season_label", "matchday", "t1_id", "t2_id"], "left")
        hit = F.coalesce("_as", "_other")
        filled = {"match_id": F.when(hit.isNotNull() & F.element_at(m, "match_id").isNull(), hit["match_id"]).otherwise(F.col("match_id"))}
        filled |= {c: F.coalesce(c, hit[f]) for c, f in (("kickoff_ts", "kickoff"), ("score_home", "t1_goals"), ("score_away", "t2_goals"))}
        rows = rows.withColumns(filled)
    for side, symbol in (("t1", HOME_SYMBOL), ("t2", AWAY_SYMBOL)):
        known = F.lit(None).cast("string")
        if codes is not None:
            rows = rows.join(codes.select(F.col("team").alias(f"{side}_id"), F.col("code").alias(f"_{side}")), f"{side}_id", "left")
            known = F.col(f"_{side}")
        rows = rows.withColumn(f"{side}_code", resolved_code(F.coalesce(to_text(present(m, symbol)), F.lit("")), F.coalesce(known, F.lit("")), F.col(f"{side}_id"), default_codes or {-1: ""}))
    own = F.when(F.col("team_id") == F.col("t1_id"), True).when(F.col("team_id") == F.col("t2_id"), False)
    complete = F.col("t1_id").isNotNull() & F.col("t2_id").isNotNull()
    rows = rows.withColumn("is_home", F.when(complete, own))
    other = F.when(F.col("is_home"), F.col("t2_id")).when(~F.col("is_home"), F.col("t1_id"))
    ahead = F.when(F.col("is_home"), F.col("score_home") - F.col("score_away")).when(~F.col("is_home"), F.col("score_away") - F.col("score_home"))
    rows = rows.withColumns({"opponent_team_id": F.coalesce("opponent_team_id", other), "match_result": F.when(ahead > 0, "W").when(ahead < 0, "L").when(ahead == 0, "D"), "match_uid": match_uid(F.col("season_label"), F.col("matchday"), F.col("t1_code"), F.col("t2_code"))})
    return newest_per_key(rows, [key, "season_label", "matchday"], ["place"]).select(key, *COLUMNS)
