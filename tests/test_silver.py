"""Silver player rows: keys, pages, teams, defaults, odd values."""

import pytest
from pyspark.sql import functions as F

from snaplake.operators import silver

MARKET = "player_id string, player_name string, first_name string, last_name string, team_id string, position string, market_value string, market_value_day_change long, market_value_history_10d array<long>, average_points string, average_minutes double, total_points long, start_probability_label string, start_probability_color string, injury_status string, injury_status_code long, status_last_updated_at string, at int"
PAGES = "slug string, page_player_id string, page_name string, birthdate string, source_url string, profile_url string, image_url string, lineup string, status string, risk string, competitors array<string>, competitor_count string, last_changed_at string, first_seen_at string, scraped_at string, place int"


def player(at, ident, name, **more):
    base = {"player_id": ident, "player_name": name, "at": at}
    return {f.split()[0]: None for f in MARKET.split(", ")} | base | more


def page(place, name, slug="", **more):
    base = {"page_name": name, "slug": slug, "place": place}
    return {f.split()[0]: None for f in PAGES.split(", ")} | base | more


def run(spark, players, pages):
    names = [f.split()[0] for f in MARKET.split(", ")], [f.split()[0] for f in PAGES.split(", ")]
    rows = spark.createDataFrame([tuple(p[n] for n in names[0]) for p in players], MARKET)
    rows = rows.withColumns({c: F.lit(None).cast("long") for c in silver.WHOLE})
    site = spark.createDataFrame([tuple(p[n] for n in names[1]) for p in pages], PAGES)
    out = silver.silver_players(
        rows, site, stamp="2026-02-03T040506Z", order=["at"], page_order=[F.col("place")], team_codes={1: "ONE", 2: "TWO"}, team_names={"ONE": "First", "UNO": "Primo"}, url_codes={"uno": "UNO", "first": "ONE"},
        site=("site.test", "https://www.site.test", "/squad/"),
    )
    assert len(out.columns) == 45
    return {r["player_uid"]: r for r in out.collect()}


def test_page_of_the_same_team_then_the_newest(spark):
    url = lambda team: f"http://www.site.test/{team}/9/squad/?q"
    pages = [page(0, "Ann Lee", source_url=url("uno"), last_changed_at="2026-02-02", birthdate="05.06.1999", page_player_id="1"), page(1, "ÄNN LÉE!", source_url=url("first"), last_changed_at="2026-01-01", birthdate="1998-07-08", page_player_id="2.0")]
    got = run(spark, [player(0, "10", "Ann Lee", team_id="1"), player(1, "11", "ann  lee", team_id="2"), player(2, "12", "Ann-Lee", team_id=None)], pages)
    assert {k: (r["player_id"], r["page_player_id"], r["team_uid"], r["team_name"]) for k, r in got.items()} == {"AnnLee19980708": ("10", 2, "ONE", "First"), "AnnLee19990605": ("11", 1, "TWO", "Primo"), "AnnLee19990605_12": ("12", 1, "UNO", "Primo")}
    assert got["AnnLee19980708"]["page_team_url"] == "https://www.site.test/first/9/" and got["AnnLee19980708"]["player_birthdate"] == "1998-07-08"


def test_slug_only_where_no_page_has_the_name(spark):
    pages = [page(5, "Other", slug="ann-lee", last_changed_at="9"), page(4, "Another", slug="ANN-LEE ", last_changed_at="1"), page(1, "Bob", slug="cid")]
    got = run(spark, [player(0, "1", "Ann Lee"), player(1, "2", "Bob"), player(2, "3", "Łód Ź")], pages)
    assert {k: r["page_name"] for k, r in got.items()} == {"AnnLee00000000": "Another", "Bob00000000": "Bob", "OdZ00000000": ""}


def test_keys_of_one_name(spark):
    """The first player keeps the key, others have their id; of rows of one player the last stays."""
    got = run(spark, [player(0, "7", "A B"), player(1, "8", "a b"), player(2, "7", "A b", market_value="5"), player(3, "8", "A.B", market_value="6.9"), player(4, "", "No Id"), player(5, "9", " ", first_name="Fay", last_name=None), player(6, "10", None)], [])
    assert {k: (r["player_id"], r["market_value"]) for k, r in got.items()} == {"AB00000000": ("7", 5), "AB00000000_8": ("8", 6), "Fay00000000": ("9", None)}


def test_defaults_and_states(spark):
    got = run(spark, [player(0, "1", "X", injury_status_code=2, average_points="bad", position="3"), player(1, "2", "Y", injury_status=" FIT ", position="def", start_probability_label="Likely")], [page(0, "Y", risk="none", competitors=["a", "b"], birthdate="2000/01/02", lineup=" bench ")])
    x, y = got["X00000000"], got["Y00000000"]
    assert (x["injury_status"], x["average_points"], x["average_minutes"], x["player_position"], x["page_competition_risk"], x["page_competitor_count"], x["page_competitor_names"], x["page_slug"]) == ("injured", 0.0, 0.0, "MID", "unknown", 0, [], "")
    assert (y["injury_status"], y["player_position"], y["page_competition_risk"], y["page_competitor_count"], y["page_predicted_lineup"], y["start_probability_label"]) == ("fit", "DEF", "high", 2, "bench", "likely")
    assert (x["season_uid"], x["snapshot_date"], x["source_snapshot_ts"]) == (2526, "2026-02-03", "2026-02-03T040506Z")


@pytest.mark.parametrize(("label", "count", "want"), [("HIGH ", None, "high"), ("nan", 0, "low"), (None, 1, "medium"), ("", 2, "high"), ("unknown", None, "unknown"), ("odd", 0, "odd")])
def test_risk(spark, label, count, want):
    assert spark.createDataFrame([(label, count)], "l string, c int").select(silver.risk(F.col("l"), F.col("c"))).first()[0] == want


def test_no_rows(spark):
    assert run(spark, [], []) == {}
