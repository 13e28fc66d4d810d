"""Edge rows of the operators: nulls, ties, empty groups, one row, accents, bad text."""

import datetime as dt
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from snaplake.functions import nested as N
from snaplake.functions import scalars as S
from snaplake.operators import fixtures, gold, joins, latest, merge, rollup, scoring, sequence
from snaplake.sources import snapshots


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_newest_per_key_with_nulls_and_ties(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", None, 2), ("a", 1, 3), (None, 5, 4)], "k string, t int, id int")
    assert rows(latest.newest_per_key(df, ["k"], ["t", "id"]).where("k = 'a'"), "id") == [(3,)]
    assert latest.newest_per_key(df, ["k"], ["t", "id"]).count() == 2
    assert rows(latest.newest_with_complete_key(df, ["k"], ["t", "id"]), "id") == [(3,)]
    assert latest.newest_per_key(df.limit(0), ["k"], ["t"]).count() == 0


def test_duplicates_without_source_id_stay(spark):
    df = spark.createDataFrame([("x", 1, 1), ("x", 1, 2), (None, 1, 3), (None, 1, 4)], "s string, k int, t int")
    assert rows(latest.keep_newest_duplicates(df, F.col("s"), [F.col("k")], ["t"]), "t") == [(2,), (3,), (4,)]


def test_distinct_union_keeps_rows_without_id(spark):
    a = spark.createDataFrame([(1, "a"), (None, "n")], "id int, v string")
    b = spark.createDataFrame([(1, "b"), (2, "c"), (None, "m")], "id int, v string")
    assert sorted(r[1] for r in latest.distinct_union([a, b], "id", [F.col("v")]).collect()) == ["a", "c", "m", "n"]


def test_as_of_join_ties_and_nulls(spark):
    left = spark.createDataFrame([(1, "k", 10), (2, "k", 4), (3, "k", None), (4, None, 10), (5, "z", 10)], "id int, k string, t int")
    right = spark.createDataFrame([("k", 5, 1.0), ("k", 10, 2.0), ("k", 11, 3.0), (None, 1, 9.0), ("k", None, 8.0)], "k string, t int, v double")
    got = {r["id"]: r["v"] for r in joins.as_of_join(left, right, "k", "t", "t", ["v"]).collect()}
    assert got == {1: 2.0, 2: None, 3: None, 4: None, 5: None}


def test_lookup_cascade_ignores_repeated_keys(spark):
    left = spark.createDataFrame([(1, "s1", "n1"), (2, "s2", "n2"), (3, None, None)], "id int, s string, n string")
    right = spark.createDataFrame([("s1", "n9", 10), ("s1", "n8", 11), ("s7", "n1", 12), ("s2", "n2", 13)], "rs string, rn string, v int")
    got = joins.lookup_cascade(left, right, [("slug", F.col("s"), F.col("rs")), ("name", F.col("n"), F.col("rn"))], ["v"])
    assert sorted((r["id"], r["v"], r["matched_by"]) for r in got.collect()) == [(1, 12, "name"), (2, 13, "slug"), (3, None, None)]


def test_sequence_features_exclude_the_row(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 4.0), ("a", 3, None), ("a", None, 8.0)], "k string, t int, v double")
    got = {r["t"]: r for r in sequence.sequence_features(df, "k", [F.col("t").asc_nulls_last()], "v").collect()}
    assert (got[1]["v_lag_1"], got[1]["v_std_5"]) == (0.0, 0.0)
    assert (got[3]["v_mean_3"], got[3]["v_std_5"]) == (3.0, 1.0)
    assert got[None]["v_lag_1"] == 0.0 and got[None]["v_mean_3"] == 2.0


def test_scale_to_caps_keeps_null_group(spark):
    df = spark.createDataFrame([(None, 8.0, 0.0), (None, 8.0, 0.0), (1, 0.6, 0.6)], "g int, a double, b double")
    got = sequence.scale_to_caps(df, ["g"], {"a": 11.0, "b": 5.0})
    assert [round(r["a"], 4) for r in got.orderBy("g").collect()] == [1.0, 1.0, 0.5]


def test_rolling_folds_are_ordered_in_time(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, i),) for i in range(1, 21)] + [(None,)], "d date")
    f = sequence.rolling_folds(df, F.col("d"), n_splits=3, min_train_days=5, validation_days=4).collect()
    for k in {r["fold"] for r in f}:
        assert max(r["day"] for r in f if r["fold"] == k and r["part"] == "train") < min(r["day"] for r in f if r["fold"] == k and r["part"] == "valid")


def test_upsert_policies(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, s string, n int")
    new = spark.createDataFrame([(2, None, 9), (3, "c", 3)], "k int, s string, n int")
    got = merge.upsert(base, new, ["k"], {"n": "keep"}, action="did")
    assert sorted(map(tuple, got.collect())) == [(1, "a", 1, "kept"), (2, "b", 2, "updated"), (3, "c", 3, "inserted")]
    with pytest.raises(ValueError):
        merge.upsert(base, new, ["k"], {"n": "never"})


def test_change_tracking_keeps_the_last_change(spark):
    old = merge.track_changes(spark.createDataFrame([("a", "x", 1), ("b", "x", 1)], "k string, s string, t int"), spark.createDataFrame([], "k string, change_fingerprint string, last_changed_at int, first_seen_at int"), "k", ["s"], "t")
    new = merge.track_changes(spark.createDataFrame([("a", "x", 2), ("b", None, 2), ("c", "x", 2)], "k string, s string, t int"), old, "k", ["s"], "t")
    assert sorted((r["k"], r["last_changed_at"], r["first_seen_at"]) for r in new.collect()) == [("a", 1, 1), ("b", 2, 1), ("c", 2, 2)]


def test_scope_is_three_valued(spark):
    df = spark.createDataFrame([(1, 1, 2), (2, 1, 9), (3, None, 1), (4, None, 9), (5, None, None)], "id int, a int, b int")
    assert rows(merge.outside_scope(df, "a", "b", spark.createDataFrame([(1,), (2,)], "id int")), "id") == [(1,), (3,), (5,)]


def test_merge_fields_weak_value(spark):
    df = spark.createDataFrame([("k", 1, "unknown"), ("k", 2, " fit "), ("z", 1, "Unknown"), ("z", 2, " ")], "k string, r int, s string")
    assert rows(merge.merge_fields(df, "k", F.col("r"), ["s"]), "k", "s") == [("k", "fit"), ("z", "Unknown")]


def test_keyword_split_may_overlap(spark):
    df = spark.createDataFrame([("m", "shot on goal", 3), ("m", "foul", -1), ("m", None, 2)], "m string, n string, p int")
    r = rollup.keyword_split(df, ["m"], "n", F.col("p"), {"raw": ["shot"], "top": ["goal"]}).first()
    assert (r["raw_points"], r["top_points"], r["uncategorised_points"], r["n_events"]) == (3, 3, 1, 3)


def test_scalars_on_bad_text(spark):
    df = spark.createDataFrame([("3.9", "31.12.1999", "Éric  de-Ção!"), ("x", "1999-02-30", " "), (None, None, None), (" 7 ", "2000/01/02", "Zoë")], "n string, d string, s string")
    got = df.select(S.to_int(F.col("n")), S.parse_date(F.col("d")), S.name_key(F.col("s")), S.slug(F.col("s")), S.slug(F.lit("Łódź / Ελλάς"), only_ascii=False)).collect()
    assert [r[0] for r in got] == [3, None, None, 7]
    assert [r[1] for r in got] == [dt.date(1999, 12, 31), None, None, dt.date(2000, 1, 2)]
    assert [r[2] for r in got] == ["eric de cao", None, None, "zoe"]
    assert [r[3] for r in got][0] == "eric-de-cao" and [r[4] for r in got][0] == "łodz-ελλας"


def test_name_keys_of_all_characters(spark):
    """Every character between two letters, against the standard library."""

    def key(text):
        plain = "".join(x for x in unicodedata.normalize("NFKD", text) if not unicodedata.combining(x))
        return re.sub("[^a-z0-9]+", " ", plain.lower()).strip() or None

    texts = [f"x{chr(c)}Y" for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF and (c < 0x3100 or c % 7 == 0 or 0xF900 <= c < 0x10000 or 0x1D400 <= c < 0x1D800 or 0x1F100 <= c < 0x1F200)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").repartition(4).select("t", S.name_key(F.col("t")).alias("k")).collect()
    assert [(r["t"], r["k"]) for r in got if r["k"] != key(r["t"])] == []


def test_times_and_seasons(spark):
    df = spark.createDataFrame([("2024-07-01T00:00:00Z",), ("1719792000",), ("1719792000000",), ("19905",), ("never",)], "t string")
    got = [r[0] for r in df.select(S.parse_time(F.col("t")).cast("string")).collect()]
    assert got[:4] == ["2024-07-01 00:00:00"] * 4 and got[4] is None
    assert spark.range(1).select(S.season_of_label(F.lit("2025/2026"))).first()[0] == 2526


def test_result_and_shares(spark):
    df = spark.createDataFrame([(True, "2:1"), (False, "2:1"), (None, "1:1"), (True, "x"), (True, "0:0")], "h boolean, s string")
    a, b = S.score_parts(F.col("s"))
    assert [r[0] for r in df.select(S.result_of(F.col("h"), a, b)).collect()] == ["W", "L", None, None, "D"]
    h, x, w = spark.createDataFrame([(1.825, 3.75, 4.45)], "a double, b double, c double").select(*S.implied_shares([F.col("a"), F.col("b"), F.col("c")])).first()
    assert round(h + x + w, 5) == 1.0


def test_objects_at_any_depth(spark):
    df = spark.createDataFrame([(1, '{"season":"s","it":[{"ph":[{"day":1,"p":2},{"day":2}]}]}'), (2, "no json"), (3, None)], "k int, j string")
    got = N.json_objects(df, "k", "j", ["day", "p"], ["season"]).collect()
    assert [(r["k"], r["path"]) for r in got] == [(1, "/it/0/ph/0")] and '"season": "s"' in got[0]["inherited"]


def test_texts_of_objects_are_not_read_again(spark):
    """Keys behind escapes, texts that look like objects, and empty lists; conditions on fields."""
    from snaplake.operators import matches

    text = r'''{"sn": "A", "x": [{"k": "{\"a\": 1}", "e": {}, "l": []}, {"\u0073n": "B", "v": 1}, {"v": 2}, [1], "[2]", {"v": "]["}]}'''
    got = N.json_objects(spark.createDataFrame([(1, text)], "i int, t string"), "i", "t", (), ["sn"]).orderBy("place").collect()
    assert [(r["path"], r["inherited"]) for r in got] == [("", '{"sn": "A"}'), ("/x/0", '{"sn": "A"}'), ("/x/0/e", '{"sn": "A"}'), ("/x/1", '{"sn": "B"}'), ("/x/2", '{"sn": "A"}'), ("/x/5", '{"sn": "A"}')]
    assert [r["path"] for r in N.json_objects(spark.createDataFrame([(1, text)], "i int, t string"), "i", "t", ("v",), ["sn"]).orderBy("place").collect()] == ["/x/1", "/x/2", "/x/5"]
    df = spark.createDataFrame([("p", "{}")], "k string, payload string")
    plan = matches.performance_rows(df, "k", "payload")._jdf.queryExecution().optimizedPlan().toString()
    assert "MapType(StringType,StringType" in plan and all("from_json" not in line for line in plan.split("\n") if "Filter (" in line)
    event = N.newest_event_marker(F.col("payload")).alias("m")
    assert df.select(event)._jdf.queryExecution().analyzed().toString().count("from_json(") == 1


def test_clean_names(spark):
    df = spark.createDataFrame([([" Ann ", "ann", "Bob", "", "Cid"], "bob")], "n array<string>, o string")
    assert df.select(N.clean_names(F.col("n"), F.col("o"))).first()[0] == ["Ann", "Cid"]


def test_clean_names_of_long_groups(spark):
    df = spark.range(20_000).select((F.col("id") % 2).alias("g"), F.when(F.col("id") % 2 == 0, F.concat(F.lit(" N"), (F.col("id") % 7000).cast("string"))).otherwise("Own").alias("n"), F.col("id").alias("o"))
    one = df.where("g = 0").agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "n"))), lambda s: s["n"]).alias("all")).select(N.clean_names(F.col("all"), F.lit("n2 "))).first()[0]
    assert one == [f"N{i}" for i in range(0, 7000, 2) if i != 2]
    got = {r["g"]: r["names"] for r in N.clean_names_of(df, "g", F.col("n"), F.col("o"), F.lit("OWN")).collect()}
    assert got == {0: [f"N{i}" for i in range(0, 7000, 2)], 1: []}


def test_draws_of_one_file_are_many_tasks(spark):
    df = spark.range(0, 400, 1, 1).select("id", F.lit(0.5).alias("s"), F.lit(9.0).alias("m"), F.lit(2.0).alias("d"), F.lit(0.1).alias("g"))
    got = scoring.sampled_distribution(df, "id", "s", "m", "d", {"g": 4.0}, n=100).withColumn("_task", F.spark_partition_id())
    assert got.select("_task").distinct().count() > 4 and got.count() == 400
    players = df.select(F.col("id").cast("string").alias("player_uid"), F.lit("t").alias("team_uid"), *[F.lit(None).cast("string").alias(c) for c in ("position", "status", "lineup", "risk")], F.lit(0).alias("competitors"), F.lit(30.0).alias("last_points"), F.lit(30.0).alias("average_points"), F.lit(1e6).alias("market_value"))
    teams = spark.createDataFrame([("t", 0.4, 1)], "team_uid string, win_probability double, commence_time int")
    assert gold.scored_players(players, teams, "now", 100).select(F.spark_partition_id()).distinct().count() > 4


def test_draws_need_a_hundred(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0, 0.0, 0.0)], "k string, s double, m double, d double, b double")
    with pytest.raises(ValueError):
        scoring.draws(df, "k", "s", "m", "d", {"b": 4.0}, n=50)
    r = scoring.sampled_distribution(df, "k", "s", "m", "d", {"b": 4.0}, n=100).first()
    assert (r["mean"], r["std"], r["p50"]) == (5.0, 0.0, 5.0)


def test_snapshots(spark, tmp_path):
    a = spark.createDataFrame([("2024-01-01T000000Z", 1), ("2024-01-02T000000Z", 2)], "snapshot_ts string, v int")
    b = a.where("v = 1")
    assert snapshots.latest_common([a, b]) == "2024-01-01T000000Z"
    with pytest.raises(LookupError):
        snapshots.pinned(a, "2023")
    assert rows(snapshots.as_of(a, "2024-01-01T120000Z"), "v") == [(1,)]
    assert snapshots.as_of(a, "2020").count() == 0
    assert rows(snapshots.as_of(a, "2020", or_later=True), "v") == [(2,)]
    (tmp_path / "x.json").write_text('{"v": 1}\n\n{"v": 2}\n')
    assert snapshots.read_ndjson(spark, str(tmp_path / "x.json"), "v int").count() == 2


def test_points_of_the_last_day_and_odd_payloads(spark):
    from snaplake.operators import players

    maps = [{"md": "3", "p": "5"}, {"md": "4", "hp": "true"}, {"spieltag": "4", "points": "7.456", "sec": "600"}, {"md": "x", "p": "9", "st": "Startelf"}]
    df = spark.createDataFrame([("m", maps, {"ismc": "3"}), ("none", None, {}), ("seconds", [{"sec": "120"}], {"seconds": "600", "games": "2"})], "k string, m array<map<string,string>>, d map<string,string>")
    out = df.withColumn("c", players._counted(F.col("m"))).select("k", *[c.alias(n) for n, c in players.playing_stats(F.col("d"), F.col("c")).items()])
    got = {r["k"]: tuple(r)[1:] for r in out.collect()}
    assert got == {"m": (3, 1, 3.33, 4, 7.46), "none": (None, None, None, None, None), "seconds": (2, None, 5.0, None, None)}


def test_one_class_gives_a_constant(spark):
    from snaplake.plans import models

    rows = spark.createDataFrame([(dt.date(2024, 1, i), 1.0, 2.0, 3.0, "b", 1.0) for i in range(1, 9)], "day date, quantity double, size double, price double, brand string, started double")
    got = models.best_classifier(rows, "started")
    assert (got["family"], got["constant"], got["model"]) == ("constant", 1.0, None)
    assert {r["p"] for r in models.with_chance(got, rows, "p").collect()} == {1.0}


def test_parts_of_training_rows_are_not_broadcast(spark):
    from snaplake.plans import models

    rows = models.features_of(spark, "/root/testdata/sf0.001")
    assert "Broadcast" not in rows._jdf.queryExecution().executedPlan().toString()
    with models.kept(rows) as same:
        assert same.storageLevel.useMemory
    assert not rows.storageLevel.useMemory


def test_equal_training_rows_are_read_once(spark):
    from snaplake.plans import models

    rows = models.features_of(spark, "/root/testdata/sf0.001").where("key < 400").drop("started").cache()
    many = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("size") > 20, 3).otherwise(2)))).drop("copy")
    once = models.weighted(many)
    assert once.count() == rows.drop("key").distinct().count() < many.count() / 2
    again = models.repeated(once, block=2)
    assert rows_of(again) == rows_of(many.drop("key"))
    # Sums and medians are those of all rows: a third of the weights' errors would be seen here.
    assert models.prepared_by(once).stages[0].surrogateDF.first() == models.preprocessing(models.NUMBERS, models.KINDS)[0].fit(many).surrogateDF.first()
    one_by_one = many.withColumn(models.WEIGHT, F.lit(1.0))
    got, want = ([tuple(r) for r in models.walk_forward(x, families=("linear", "boosted")).collect()] for x in (once, one_by_one))
    assert got == [(f, n, pytest.approx(rmse, rel=1e-6), pytest.approx(mae, rel=1e-6)) for f, n, rmse, mae in want] and len(got) == 4


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def test_entities_without_any_match_stay(spark):
    from snaplake.operators import players

    left = spark.createDataFrame([(1, "ann", "x", "ann-a"), (2, "bob", "x", "cid"), (3, None, None, None)], "id int, name string, team string, slug string")
    right = spark.createDataFrame([("ann", "y", "s", 9), ("ann", "x", "s", 1), (None, "x", "cid", 4), ("cid", None, "cid", 5)], "name string, team string, slug string, v int")
    got = players.match_entities(left, right, name=(F.col("name"), "name"), team=(F.col("team"), "team"), slug=(F.col("slug"), "slug"), order=[F.col("v").desc()], values=["v"])
    assert rows(got, "id", "v") == [(1, 1), (2, 5), (3, None)]


def test_pages_without_players(spark):
    from snaplake.functions import pages

    df = spark.createDataFrame([(1, None, "u"), (2, "", "u"), (3, '<script id="__NEXT_DATA__">{broken</script><b data-player-name="A">', "u"), (4, '<div class="player_position_row"><div class="player_position_column">', "u")], "id int, html string, url string")
    got = pages.player_rows(df, "id", "html").collect()
    assert [(r["id"], r["player_name"], r["status"]) for r in got] == [(3, "A", "unknown")]
    assert pages.squad_rows(df, "id", "html", "url").count() == 0 and pages.player_rows(df.limit(0), "id", "html").count() == 0


def test_pages_meet_in_tasks_of_so_many_characters(spark, monkeypatch):
    from snaplake.functions import pages as P

    monkeypatch.setattr(P, "TASK_CHARS", 2000, raising=False)
    block = '<div class="leg_column_row"><a href="/eva-x_8/">Eva</a></div>' + "<p>word</p>" * 50
    df = spark.range(40).select("id", F.lit(block).alias("html"), F.lit("https://a.b/").alias("url"))
    got = P.squad_rows(df, "id", "html", "url")
    assert f"], {len(block) * 40 // 2000 + 1}" in got._jdf.queryExecution().optimizedPlan().toString()
    assert rows(got, "id", "place", "slug", "player_name") == [(i, 0, "eva-x", "Eva") for i in range(40)]


def test_changes_over_several_batches(spark, tmp_path):
    from snaplake.streaming import streams

    batches = [[("a", "x", 1), ("a", "x", 2), ("b", "y", 1)], [("a", "x", 3), ("a", "z", 4), (None, "n", 4)], [("b", "y", 5), ("a", "x", 6), ("c", None, 6), (None, "n", 7)]]
    for i, rows_ in enumerate(batches):
        at = [(k, s, dt.datetime(2024, 1, t)) for k, s, t in rows_]
        spark.createDataFrame(at, "k string, s string, ts timestamp").coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    stream = streams.files(spark, f"{tmp_path}/in/*", "k string, s string, ts timestamp", per_batch=1)
    got = streams.changes(stream, "k", "s", "ts", f"{tmp_path}/out", f"{tmp_path}/cp").collect()
    assert sorted((r["k"] or "", r["s"] or "", r["changed_at"].day, r["first_seen_at"].day) for r in got) == [("", "n", 4, 4), ("a", "x", 1, 1), ("a", "x", 6, 1), ("a", "z", 4, 1), ("b", "y", 1, 1)]


def test_addresses(spark):
    rows = ["http://www.a.de/fc/1/kader/?x=1", "https://www.a.de/fc/1#t", "https://m.a.de/fc/1", "ftp://b.de/x", " ", None, "https://www.a.de", "https://www.a.de/fc/12/kaderanalyse/3", "https://www.a.de/fc/kader/9/", "nothing"]
    df = spark.createDataFrame([(r,) for r in rows], "u string")
    got = df.select(S.site_url(F.col("u"), "a.de", "https://www.a.de", "/kader/"), S.squad_url(F.col("u"), "/kader/", "/kaderanalyse/")).collect()
    assert [r[0] for r in got] == ["https://www.a.de/fc/1/", "https://www.a.de/fc/1/", "https://m.a.de/fc/1", "ftp://b.de/x", "", None, "https://www.a.de/", "https://www.a.de/fc/12/kaderanalyse/3/", "https://www.a.de/fc/", "nothing"]
    assert [r[1] for r in got] == ["http://www.a.de/fc/1/kader/", "https://www.a.de/fc/1/kader/", "https://m.a.de/fc/1/kader/", None, None, None, None, "https://www.a.de/fc/12/kader/3", "https://www.a.de/fc/kader/", None]


def test_fixture_payloads_of_any_form(spark):
    rows = [(1, '[{"day": 1, "cur": true, "it": [{"t1": 1, "t2": 2, "t1sy": "a.b"}, {"t1": 1, "t2": 2}]}, {"n": "7", "sn": "25/26"}]'), (2, '{"data": [], "it": [{"day": 3}]}'), (3, "no json"), (4, None), (5, '{"items": [{"matchday": 4}, {"matchday": 2}]}')]
    df = spark.createDataFrame(rows, "k int, p string")
    day, season = fixtures.calendar(fixtures.days_of(F.col("p")))
    assert [tuple(r) for r in df.select("k", day, season).orderBy("k").collect()] == [(1, 1, "25/26"), (2, None, None), (3, None, None), (4, None, None), (5, 4, None)]
    matches = fixtures.matches_of(df, "p", ["k"])
    assert [tuple(r) for r in fixtures.fixture_lookup(matches, ["k"]).select("k", "day", "t1", "t2", "t1sy").collect()] == [(1, 1, 1, 2, None)]
    assert sorted(tuple(r) for r in fixtures.team_symbols(matches, ["k"], {2: "z-z", 9: "q"}).collect()) == [(1, "AB"), (2, "ZZ"), (9, "Q")]


def test_newest_marker_under_any_spelling(spark):
    rows = ['{"updatedAt": "2024-01-03T00:00:00Z", "bookmakers": null}', '{"bookmakers": [{"lastUpdate": "2024-01-01", "markets": [{"updated_at": "2024-02-01T10:00:00Z"}, {"last_update": "soon"}]}, {"markets": null}]}', "{}", "x", None]
    got = spark.createDataFrame([(r,) for r in rows], "e string").select(N.newest_event_marker(F.col("e"))).collect()
    assert [r[0] and r[0].strftime("%m-%d %H") for r in got] == ["01-03 00", "02-01 10", None, None, None]


def test_missing_inputs_are_errors(spark, tmp_path):
    with pytest.raises(LookupError):
        snapshots.land_all({"a": spark.range(1), "b": None}, ["a", "b"], str(tmp_path / "x"), "t")
    assert not (tmp_path / "x").exists()
    with pytest.raises(LookupError):
        rollup.backtest(spark.sql("select 1 k, 1.0D predicted, 'x' s"), spark.sql("select 2 k, 1.0D actual"), "k", "s")
    with pytest.raises(LookupError):
        snapshots.master_records(spark.sql("select '1' u, 1 i, 'n' n, date'2000-01-01' b where false"), "u", "i", "n", "b")


def test_gold_tables_of_odd_players(spark):
    schema = "player_uid string, player_name string, team_uid string, position string, status string, lineup string, risk string, competitors int, last_points double, average_points double, matchday int, market_value double"
    players = spark.createDataFrame([("a", None, None, None, None, None, None, None, None, None, None, None), (" ", "b", "t", "FWD", "fit", "starter", "low", 1, 5.0, 5.0, 1, 1.0)], schema)
    teams = spark.createDataFrame([("t", 0.4, None), ("t", None, "2024")], "team_uid string, win_probability double, commence_time string")
    tables = gold.gold_tables(players, teams, "now", 10)
    row = tables["player_daily"].collect()
    assert len(row) == 1 and row[0].start_probability == pytest.approx(0.75) and row[0].value_score == 0 and row[0].market_value is None
    assert {r.metric: r.value for r in tables["quality_metrics"].collect()} == {"player_count": 1.0, "coverage_ratio": 1.0, "draws": 100.0}
    assert [tuple(r) for r in gold.best_context(teams).collect()] == [("t", 0.4)]
    empty = gold.gold_tables(players.limit(0), teams, "now", 10)
    assert empty["player_daily"].count() == 0 and empty["quality_metrics"].where("value = 0").count() == 2
