"""Scored players: expected values by part, a sampled distribution, four tables.

Every number of a player comes from its own row and its team's row. Draws are an array
inside the row; only the players are dealt to many tasks before they are drawn for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clamp, competition_risk
from .latest import newest_per_key
from .rollup import as_metric_rows
from .scoring import dealt, drawn_points, mapped, start_probability, summary_of

#: Start probability by status, its shifts by lineup and risk.
STATUS = {"fit": 0.84, "questionable": 0.58, "injured": 0.08, "suspended": 0.05}
LINEUP = {"starter": 0.10, "safe starter": 0.12, "potential starter": 0.04, "bench": -0.18}
RISK = {"low": 0.03, "medium": -0.06, "high": -0.12}
#: Chance to score by position; points of a score, a win, minutes and a card.
SCORER = {"fwd": 0.24, "mid": 0.15, "def": 0.07, "gk": 0.01}
SCORE_POINTS, WIN_POINTS, MINUTES_POINTS, CARD_POINTS = 14.0, 6.0, 4.0, -4.0
#: The share of recent points without bonus; their spread by square root, and its
#: least; points that keep a value, and points of a whole change of it.
RAW_SHARE, SPREAD, LEAST_SPREAD = 0.78, 0.9, 4.0
EVEN_POINTS, POINTS_A_VALUE = 50.0, 1000.0


def best_context(teams: DataFrame) -> DataFrame:
    """One row a team: one with odds, then the earliest, then the better odds."""
    order = [F.col("win_probability").isNotNull().desc(), F.col("commence_time").asc_nulls_last(), F.col("win_probability").desc_nulls_last()]
    return newest_per_key(teams.where("trim(team_uid) != ''"), ["team_uid"], order).select("team_uid", "win_probability")


def scored_players(players: DataFrame, teams: DataFrame, at: str, n: int = 400) -> DataFrame:
    """players with a key, with start_probability, the parts of the expected value, the
    summary of n draws, and values. Columns of players: player_uid, team_uid, position,
    status, lineup, risk, competitors, last_points, average_points, market_value."""
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    known = players.where(F.trim("player_uid") != "").withColumn("team_uid", F.trim("team_uid"))
    rows = known.join(best_context(teams), "team_uid", "left").withColumns({
        "risk": competition_risk(F.col("risk"), F.coalesce("competitors", F.lit(0))), "win": F.coalesce("win_probability", F.lit(0.5)), "recent": F.coalesce("last_points", "average_points", F.lit(45.0)),
        "scorer": mapped(blank("position"), SCORER, 0.10),
    })
    card = F.lit(0.12) + F.when(F.lower(blank("status")) == "questionable", 0.05).otherwise(0.0) + F.when(F.lower("risk") == "high", 0.04).otherwise(0.0)
    rows = rows.withColumns({"start": start_probability(blank("status"), blank("lineup"), F.col("risk"), STATUS, LINEUP, RISK, default=0.72), "card": clamp(card, 0.05, 0.30)})
    spread = F.greatest(F.lit(LEAST_SPREAD), F.sqrt(F.greatest("recent", F.lit(1.0))) * SPREAD)
    bonus: dict[str, float] = {"scorer": SCORE_POINTS, "win": WIN_POINTS, "card": CARD_POINTS}
    draws = drawn_points(F.concat_ws("|", "player_uid", F.lit(at)), F.col("start"), F.col("recent") * RAW_SHARE, spread, {p: (F.col(p), v) for p, v in bonus.items()}, n=max(100, n), always=MINUTES_POINTS)
    out = dealt(rows, "player_uid").withColumn("draws", draws).withColumn("s", summary_of(F.col("draws"))).drop("draws")
    worth, total = F.coalesce("market_value", F.lit(0.0)), F.col("s.mean")
    change = worth * ((total - EVEN_POINTS) / POINTS_A_VALUE)
    parts: dict[str, Column] = {"base_raw_ev": F.col("recent") * RAW_SHARE, "scorer_ev": F.col("scorer") * SCORE_POINTS, "win_ev": F.col("win") * WIN_POINTS, "minutes_bonus_ev": F.lit(MINUTES_POINTS), "cards_negative_ev": F.col("card") * CARD_POINTS}
    return out.select(
        *players.columns, F.col("start").alias("start_probability"), (1 - F.col("start")).alias("p_dnp"), *[(F.col("start") * c).alias(p) for p, c in parts.items()],
        total.alias("pred_total"), *[F.col(f"s.{q}").alias(f"{q}_points") for q in ("std", "p10", "p50", "p90")],
        (worth + change).alias("value_next"), (change * 7).alias("value_change_7d"), F.when(worth > 0, total / (worth / 1_000_000) * (1 - 0.5 * (1 - F.col("start")))).otherwise(0.0).alias("value_score"),
    )


DAILY = ("start_probability", "pred_total", "p_dnp", "std_points", "p10_points", "p50_points", "p90_points", "market_value", "value_next", "value_change_7d", "value_score")
PARTS = ("base_raw_ev", "scorer_ev", "win_ev", "minutes_bonus_ev", "cards_negative_ev", "pred_total")


def gold_tables(players: DataFrame, teams: DataFrame, at: str, n: int = 400) -> dict[str, DataFrame]:
    """The tables by day, by matchday and of parts, and quality metrics. The share of
    players with lineup or risk counts a risk that is derived from competitors too."""
    s = scored_players(players, teams, at, n)
    known = players.where(F.trim("player_uid") != "")
    told = (F.trim(F.coalesce("lineup", F.lit(""))) != "") | F.coalesce(competition_risk(F.col("risk"), F.coalesce("competitors", F.lit(0))) != "", F.lit(False))
    covered = F.coalesce(F.avg(told.cast("double")), F.lit(0.0))
    metrics = known.agg(F.count(F.lit(1)).alias("player_count"), covered.alias("coverage_ratio"), F.lit(max(100, n)).alias("draws"))
    return {
        "player_daily": s.select("player_uid", "player_name", "team_uid", "position", *DAILY),
        "player_matchday": s.select("player_uid", "matchday", *DAILY),
        "points_components": s.select("player_uid", "player_name", "matchday", *PARTS),
        "quality_metrics": as_metric_rows(metrics).withColumn("at", F.lit(at)),
    }
