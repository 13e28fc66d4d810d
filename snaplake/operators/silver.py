"""The silver player row: a market row, the page of the same player, one key for each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from . import latest
from .fixtures import code_of_url
from .players import match_entities

#: Positions by number, states by number, and labels that tell of no risk.
POSITIONS, LABELS = {1: "GK", 2: "DEF", 3: "MID", 4: "FWD"}, ("GK", "DEF", "MID", "FWD")
STATES = {0: "fit", 1: "questionable", 2: "injured"}
NO_RISK = ("unknown", "none", "nan")

#: What a page row has. competitors is an array of names, times are texts that sort.
PAGE = ("slug", "page_player_id", "page_name", "birthdate", "source_url", "profile_url", "image_url", "lineup", "status", "risk", "competitors", "competitor_count", "last_changed_at", "first_seen_at", "scraped_at")
WHOLE = ("market_value_high_365d", "market_value_low_365d", "average_paid_price_10d", "appearances_total", "starts_total", "goals_total", "assists_total", "yellow_cards_total", "red_cards_total", "last_matchday", "last_match_points")


def _text(c: Column) -> Column:
    return F.coalesce(F.trim(c.cast("string")), F.lit(""))


def _of(labels: Mapping, key: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])[key]


def position(label: Column) -> Column:
    """One of four labels in upper case, the label of a number, or the text as it is."""
    text = F.upper(_text(label))
    number = S.to_int(text)
    return F.when(text.isin(*LABELS, ""), text).when(number.isNull(), text).otherwise(F.coalesce(_of(POSITIONS, number.cast("int")), number.cast("string")))


def risk(label: Column, count: Column) -> Column:
    """The page's own word, or what the number of competitors tells."""
    own = F.lower(_text(label))
    by_count = F.when(count.isNull(), "unknown").when(count <= 0, "low").when(count == 1, "medium").otherwise("high")
    return F.when((own != "") & ~own.isin(*NO_RISK), own).otherwise(by_count)


def silver_players(
    rows: DataFrame,
    pages: DataFrame,
    *,
    stamp: str,
    order: Sequence[str],
    page_order: Sequence[Column],
    team_codes: Mapping[int, str],
    team_names: Mapping[str, str],
    url_codes: Mapping[str, str],
    site: tuple[str, str, str],
) -> DataFrame:
    """One row of 45 columns for each player key at a snapshot's time.

    rows are market rows (see players.player_row), in `order`; rows without id or name are left
    out. Each takes the page (PAGE columns) of its name, of its team where one is, the newest by
    last_changed_at and scraped_at; without one of its name the first by page_order with its slug. The key is
    the name and birth date; a second player of one key has its id behind it, and of several rows of
    a player the last stays. site is (domain, address, section) of team pages."""
    name = F.coalesce(S.to_text(F.col("player_name")), F.nullif(F.concat_ws(" ", S.to_text(F.col("first_name")), S.to_text(F.col("last_name"))), F.lit("")))
    team_id = S.to_int(F.col("team_id"))
    left = rows.withColumns({"_id": S.to_text(F.col("player_id")), "_name": name, "_team_id": team_id, "_team": _of(team_codes, team_id.cast("int"))}).where("_id is not null and _name is not null")
    left = left.withColumns({"_key": S.name_key(F.col("_name")), "_slug": S.slug(F.col("_name"), only_ascii=False)})
    p = pages.withColumns({"_page_key": S.name_key(F.col("page_name")), "_page_team": code_of_url(F.col("source_url"), url_codes), "_page_slug": F.nullif(F.lower(_text(F.col("slug"))), F.lit(""))})
    newest = [_text(F.col("last_changed_at")).desc(), _text(F.col("scraped_at")).desc(), *page_order]
    found = match_entities(left, p, name=(F.col("_key"), "_page_key"), team=(F.col("_team"), "_page_team"), slug=(F.col("_slug"), "_page_slug"), order=newest, slug_order=list(page_order), values=[*[c for c in PAGE if c not in left.columns], "_page_team"])
    born = F.when(~F.col("birthdate").contains("/"), S.parse_date(F.col("birthdate")))
    keyed = latest.distinguished(found.withColumns({"_born": born, "_base": S.entity_key(F.col("_name"), born)}), "_base", "_id", order, "player_uid")
    team = F.coalesce("_team", "_page_team")
    competitors = F.coalesce("competitors", F.array().cast("array<string>"))
    told = F.coalesce(S.to_int(F.col("competitor_count")), F.when(F.col("competitors").isNotNull(), F.size("competitors").cast("long")))
    has = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    columns = {
        "player_uid": F.col("player_uid"), "player_name": F.col("_name"), "player_birthdate": F.date_format("_born", "yyyy-MM-dd"), "team_uid": team,
        "team_name": F.coalesce(_of(team_names, team), S.to_text(has("team_name")), S.to_text(has("team")), _of(team_names, F.col("_page_team")), F.lit("")), "player_position": position(F.col("position")),
        "season_uid": S.season_of(F.to_timestamp(F.lit(stamp[:10]))).cast("long"), "snapshot_date": F.lit(stamp[:10]), "source_snapshot_ts": F.lit(stamp), "player_id": F.col("_id"), "team_id": F.col("_team_id"),
        "market_value": S.to_int(F.col("market_value")), "market_value_day_change": S.to_int(F.col("market_value_day_change")), "market_value_history_10d": F.col("market_value_history_10d"),
        **{c: S.to_int(F.col(c)) for c in WHOLE}, "average_points": S.to_double(F.col("average_points"), 0.0), "average_minutes": S.to_double(F.col("average_minutes"), 0.0), "total_points": S.to_int(F.col("total_points")),
        "start_probability_label": F.lower(_text(F.col("start_probability_label"))), "start_probability_color": _text(F.col("start_probability_color")),
        "injury_status": F.coalesce(F.nullif(F.lower(_text(F.col("injury_status"))), F.lit("")), _of(STATES, F.col("injury_status_code").cast("int")), F.lit("unknown")), "status_last_updated_at": _text(F.col("status_last_updated_at")),
        "page_player_id": S.to_int(F.col("page_player_id")), "page_slug": _text(F.col("slug")), "page_name": _text(F.col("page_name")), "page_profile_url": _text(F.col("profile_url")), "page_team_url": F.coalesce(S.site_url(F.col("source_url"), *site), F.lit("")),
        "player_image_url": _text(F.col("image_url")), "page_predicted_lineup": _text(F.col("lineup")), "page_status": _text(F.col("status")), "page_competition_risk": risk(F.col("risk"), told),
        "page_competitor_count": F.coalesce(told, F.lit(0).cast("long")), "page_competitor_names": competitors, "page_last_changed_at": _text(F.col("last_changed_at")), "page_first_seen_at": _text(F.col("first_seen_at")),
    }
    return keyed.select(*[c.alias(n) for n, c in columns.items()])
