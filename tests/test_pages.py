"""Tags, extents and references of pages, and the player rows on top of them."""

import html

import pytest
from pyspark.sql import functions as F

from snaplake.functions import markup, pages


def page(spark, text, url="https://www.site.test/team/1/kader/"):
    return spark.createDataFrame([(1, text, url)], "id int, html string, url string")


def players(spark, text):
    rows = pages.player_rows(page(spark, text), "id", "html").orderBy("place").collect()
    return [(r["slug"], r["player_id"], r["player_name"], r["lineup"], list(r["competitors"])) for r in rows]


def test_references_as_the_standard_library(spark):
    from html.entities import html5

    texts = [f"x&{k} y" for k in html5] + [f"&#{n};" for n in [*range(0x300), *range(0xD7F0, 0xE010), *range(0xFDC0, 0xFDF8), *range(0xFFF0, 0x10010), 0x1F600, 0x10FFFF, 0x110000, 10**30]]
    texts += ["", "&", "&;", "&#;", "&#x;", "&amp;lt;", "&notit; &notin", "&unknown;", "a & b &&amp;", "&AMP&copy2", "&#X41 &#65x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    wrong = [(r["t"], r["u"]) for r in df.select("t", markup.unescaped(F.col("t")).alias("u")).collect() if r["u"] != html.unescape(r["t"])]
    assert wrong == []


def test_ends_of_elements(spark):
    text = "<div a='>'><p>x</p><div><DIV>y</div></div></div></div><div>z<!-- </div> --><script>'</div>'</script>"
    rows = markup.with_ends(markup.tokens(page(spark, text), "id", "html"), "id", "div").orderBy("i").collect()
    ends = {r["i"]: r["ends"] for r in rows if r["tag"] == "div" and not r["closes"]}
    tags = [r["token"] for r in rows]
    assert list(ends) == [0, 4, 5, 11] and [ends[k] for k in ends] == [9, 8, 7, None]
    assert "<!-- </div> -->" not in tags and markup.tokens(page(spark, None), "id", "html").count() == 0


@pytest.mark.parametrize(("token", "value"), [('<a href="/x">', "/x"), ("<a  HREF = '/y&amp;z'>", "/y&amp;z"), ("<a href=z>", "z"), ("<a data-href='q'>", None), ("<a href=''>", "")])
def test_attributes(spark, token, value):
    assert spark.createDataFrame([(token,)], "t string").select(markup.attribute(F.col("t"), "href").alias("v")).first()["v"] == value


PHOTO = '<div class="player_position_photo left">\n <a href="/{0}/"><img alt="{1}" /></a></div>'


def test_line_up_without_columns(spark):
    text = f'<div class="player_position_row">{PHOTO.format("ann-lee_12", "Ann Lee")}</div><div class="team_squad_area">{PHOTO.format("bob-o_34", "Bob O")}</div><div class="league_name_holder"></div>'
    assert players(spark, text) == [("ann-lee", "12", "Ann Lee", "starter", []), ("bob-o", "34", "Bob O", "bench", [])]


def test_line_up_without_a_bench(spark):
    text = f'<div class="player_position_row wide">{PHOTO.format("ann-lee_12", "")}{PHOTO.format("bob-o_34", " ")}{PHOTO.format("ann-lee_12", "Again")}</div><div class="league_name_holder"></div>{PHOTO.format("far-off_9", "")}'
    assert players(spark, text) == [("ann-lee", "12", "Ann Lee", "starter", []), ("bob-o", "34", "Bob O", "starter", [])]


def sub(slug, name):
    """A shared slot's player: the photo two boxes deep, the name in its own box."""
    return f'<div class="sub_child" style="display: block;"><div class="player_position_photo"><div class="sub_pic"><a href="/{slug}/"><img alt="" /></a></div><div class="no"><div><span></span></div></div></div><div class="player_name"><a href="/{slug}/">{name}</a></div></div>'


def test_players_of_a_column_compete(spark):
    two = f'<div class="player_position_row"><div class="player_position_column center">{sub("ann-lee_1", "Lee")}{sub("bob-o_2", "M&uuml;ller")}</div><div class="player_position_column">{PHOTO.format("cid_3", "Cid")}{PHOTO.format("not-first_4", "x")}</div></div>'
    assert players(spark, two) == [("ann-lee", "1", "Lee", "starter", ["Müller"]), ("bob-o", "2", "Müller", "starter", ["Lee"]), ("cid", "3", "Cid", "starter", [])]


def test_a_column_ends_with_its_element(spark):
    """What stands behind the last column, or in a column that never ends, isn't mixed up."""
    text = f'<div class="player_position_row"><div class="player_position_column">{sub("ann_1", "Ann")}</div>{PHOTO.format("stray_5", "Stray")}<div class="player_position_column">{sub("bob_2", "Bob")}'
    assert players(spark, text) == [("ann", "1", "Ann", "starter", []), ("bob", "2", "Bob", "starter", [])]


def test_many_players_of_a_column(spark):
    many = "".join(sub(f"p-{k}_{k}", f"P{k}") for k in range(1200))
    got = players(spark, f'<div class="player_position_row"><div class="player_position_column">{many}</div></div>')
    assert [g[0] for g in got] == [f"p-{k}" for k in range(1200)] and all(len(g[4]) == 1199 for g in got)


def test_squad_rows_end_with_their_element(spark):
    row = '<div class="leg_column_row"><img src="/logo.png"><div class="player_img"><a href="/{0}/"><img src="{1}" alt="{2}" /></a></div><small>{3}</small></div>'
    text = row.format("ann-lee_1", "https://cdn.test/images/player/a.jpg", "Ann &amp; Lee", "27.03.1986") + row.format("bob_2", "/x/player/team/b.jpg", "", "") + row.format("cid_3", "c.jpg", "", "31.02.2000") + row.format("ann-lee_1", "", "Twice", "") + "<footer>01.01.1970 <img src='/images/player/foot.jpg'></footer>"
    got = [tuple(str(x) for x in r)[1:] for r in pages.squad_rows(page(spark, text), "id", "html", "url").orderBy("place").collect()]
    assert got == [
        ("0", "ann-lee", "1", "Ann & Lee", "https://www.site.test/ann-lee_1/", "https://cdn.test/images/player/a.jpg", "1986-03-27"),
        ("1", "bob", "2", "Bob", "https://www.site.test/bob_2/", "https://www.site.test/x/player/team/b.jpg", "None"),
        ("2", "cid", "3", "Cid", "https://www.site.test/cid_3/", "None", "None"),
    ]


def test_links_seen_from_a_page(spark):
    df = spark.createDataFrame([("http://a.b/c/d?x=/y", r) for r in ("e.png", "/e", "//h/e", "https://z/e")], "u string, r string")
    assert [x[0] for x in df.select(pages.absolute(F.col("u"), F.col("r"))).collect()] == ["http://a.b/c/e.png", "http://a.b/e", "http://h/e", "https://z/e"]


def test_embedded_and_attribute_rows(spark):
    script = '<script id="__NEXT_DATA__" type="application/json">{"a":{"players":[{"name":"Ann","status":"fit","predicted_lineup":"starter","slug":"ann"},{"name":"Bob","risk":"high","id":7}]}}</script>'
    assert players(spark, script + "<b data-player-name='C'>") == [("ann", "", "Ann", "starter", []), ("7", "7", "Bob", "unknown", [])]
    tags = """<div data-player-name="Ann &amp; X" data-player-slug="ann" data-predicted-lineup="Startelf"></div><i data-player-name=' '></i><i data-player-name="Ann &amp; X" data-player-slug="ann">"""
    assert players(spark, tags) == [("ann", "", "Ann & X", "starter", [])]
