"""Match rows of history payloads: home and away, codes, scope, fixtures, odd payloads."""

import json

import pytest

from snaplake.operators import matches

CODES = {5: "HOM", 6: "AWY"}


def season(*games, label="2025/2026", key="ti"):
    return {"it": [{key: label, "ph": list(games)}]}


def game(day, home, away, goals, own, **more):
    return {"day": day, "p": 100 + day, "md": f"2026-02-{day:02d}T17:30:00Z", "t1": str(home), "t2": str(away), "t1g": goals[0], "t2g": goals[1], "pt": str(own), **more}


def rows(spark, payload, **how):
    df = spark.createDataFrame([("p", payload if isinstance(payload, str) else json.dumps(payload))], "k string, payload string")
    return {(r["season_label"], r["matchday"]): r for r in matches.performance_rows(df, "k", "payload", **how).collect()}


def test_home_away_and_result(spark):
    got = rows(spark, season(game(23, 5, 6, (2, 2), 5), game(22, 7, 5, (0, 1), 5), game(21, 5, 6, (0, 1), 5), game(20, 5, 6, (3, 1), 9)), default_codes=CODES)
    say = lambda day: tuple(got["2025/2026", day][c] for c in ("is_home", "match_result", "opponent_team_id", "match_uid", "points_total"))
    assert say(23) == (True, "D", 6, "25/26-MD23-HOMAWY", 123)
    assert say(22) == (False, "W", 7, "25/26-MD22-TNAHOM", 122)
    assert say(21) == (True, "L", 6, "25/26-MD21-HOMAWY", 121)
    assert say(20) == (None, None, None, "25/26-MD20-HOMAWY", 120)
    assert str(got["2025/2026", 23]["kickoff_ts"]) == "2026-02-23 17:30:00" and json.loads(got["2025/2026", 23]["raw_json"])["p"] == 123


def test_codes_come_from_the_row_then_the_payload_then_the_list(spark):
    known = spark.createDataFrame([(5, "p-5"), (6, None)], "team long, code string")
    got = rows(spark, season(game(9, 5, 6, (0, 2), 6), game(10, 5, 6, (1, 1), 6, t1sy="in line"), game(3, 99, 5, (1, 1), 5)), codes=known, default_codes=CODES)
    assert [got["2025/2026", d]["match_uid"] for d in (9, 10, 3)] == ["25/26-MD09-P5AWY", "25/26-MD10-INLINEAWY", "25/26-MD03-TNAP5"]


def test_teams_out_of_scope(spark):
    allowed = spark.createDataFrame([(5,), (6,)], "team long")
    got = rows(spark, season(game(1, 5, 6, (2, 1), 5), game(2, 5, 58, (1, 0), 5), {"day": 3, "p": 1}), default_codes=CODES, allowed=allowed)
    assert list(got) == [("2025/2026", 1)]


def test_fixtures_fill_what_is_missing(spark):
    bare = {"day": 4, "p": 9, "t1": 6, "t2": 5, "pt": 5}
    fixtures = spark.createDataFrame([(4, 5, 6, 77, 3, 1)], "day long, t1 long, t2 long, match_id long, t1_goals long, t2_goals long").selectExpr("*", "timestamp'2026-03-01 12:00:00' AS kickoff")
    how = {"fixtures": fixtures, "active_season": "2025/2026", "default_codes": CODES}
    r = rows(spark, season(bare), **how)["2025/2026", 4]
    assert (r["match_id"], r["score_home"], r["score_away"], r["is_home"], r["match_result"], str(r["kickoff_ts"])) == (77, 3, 1, False, "L", "2026-03-01 12:00:00")
    r = rows(spark, season({**bare, "match_id": 1, "score": "0:2", "md": "2026-03-02T00:00:00Z"}), **how)["2025/2026", 4]
    assert (r["match_id"], r["score_home"], r["score_away"], str(r["kickoff_ts"])) == (1, 0, 2, "2026-03-02 00:00:00")
    assert rows(spark, season(bare, label="2024/2025"), **how)["2024/2025", 4]["score_home"] is None


@pytest.mark.parametrize(("payload", "want"), [("no json", {}), ("[]", {}), ('{"p": 1}', {}), ('{"day": 1, "p": null}', {}), ('{"md": 1, "p": 2}', {}), ('{"day": "x", "p": 2}', {}), ('[[{"day": 7.0, "p": "2.9"}]]', {("unknown", 7): 2})])
def test_payloads_of_any_form(spark, payload, want):
    assert {k: r["points_total"] for k, r in rows(spark, payload).items()} == want


def test_the_nearest_season_and_the_last_row_count(spark):
    deep = {"season": "2023/2024", "x": [{"day": 1, "p": 1}, {"sn": "2024/2025", "y": {"day": 1, "p": 2, "z": {"ti": " ", "day": 1, "p": 3}}}, {"season_label": "24/25", "day": 2, "p": 4}, {"day": 1, "p": 5}]}
    got = rows(spark, deep)
    assert {k: (r["points_total"], r["match_uid"]) for k, r in got.items()} == {("2023/2024", 1): (5, "23/24-MD01-TNATNA"), ("2024/2025", 1): (3, "24/25-MD01-TNATNA"), ("24/25", 2): (4, "24/25-MD02-TNATNA")}


def test_the_first_spelling_counts_even_if_null(spark):
    got = rows(spark, '{"matchday": 3, "day": 4, "points": 8, "p": null, "scoreHome": null, "t1g": 5}')
    assert got == {}
    got = rows(spark, '{"matchday": 3, "day": 4, "p": 8, "points": 9, "scoreHome": null, "t1g": 5}')
    assert [(k, r["points_total"], r["score_home"]) for k, r in got.items()] == [(("unknown", 3), 8, None)]
