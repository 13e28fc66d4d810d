"""Markup in column functions: tags as rows, elements by running depth, character references.

A page becomes one row for each tag and each text between tags. The depth of nesting of an
element is a running count of its start and end tags; a start tag and the tag that ends it are
neighbours among the tags of one depth, so matching them is one window. All windows are by
page: a page is one row of the table before, so no task gets more than it had.
"""

from __future__ import annotations

from functools import lru_cache, reduce
from html import unescape as stdlib_unescape
from html.entities import html5

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A comment, a script or style with its body, a tag (quoted values may hold anything), text.
TOKEN = r"""(?si)<!--.*?(?:-->|\z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)|</?[a-z](?:"[^"]*+"|'[^']*+'|[^'">]++)*+>|[^<]++|<"""


def tokens(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, i, token, tag, closes) of the tags and texts of each page in order, without comments
    and blank texts; tag is the element's name in lower case, null for texts and scripts."""
    rows = pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0))).alias("i", "token"))
    tag = F.nullif(F.lower(F.regexp_extract("token", r"^</?([A-Za-z][^\s/>]*)", 1)), F.lit(""))
    plain = F.when(~tag.isin("script", "style"), tag)
    return rows.where(~F.col("token").startswith("<!--") & F.col("token").rlike(r"\S")).select(key, "i", "token", plain.alias("tag"), F.col("token").startswith("</").alias("closes"))


def attribute(token: Column, name: str) -> Column:
    """The value of an attribute of a start tag as it stands there, references and all, or null."""
    value = F.regexp_extract(token, rf"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return F.when(value != "", F.regexp_replace(value, r"""^["']|["']$""", ""))


def with_ends(rows: DataFrame, key: str, tag: str) -> DataFrame:
    """rows of tokens() with `ends`: for a start tag of the element the number of the token that
    ends it, null where none does."""
    own = F.col("tag") == tag
    step = F.when(own & ~F.col("closes"), 1).when(own, -1).otherwise(0)
    depth = F.sum(step).over(Window.partitionBy(key).orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # The depth around the element: before its start tag and after its end tag.
    around = F.when(own, F.when(F.col("closes"), depth).otherwise(depth - 1))
    beside = Window.partitionBy(key, "_around").orderBy("i")
    closing = F.when(F.lead("closes").over(beside), F.lead("i").over(beside))
    return rows.withColumn("_around", around).withColumn("ends", F.when(own & ~F.col("closes"), closing)).drop("_around")


@lru_cache(None)
def _named() -> str:
    """All named references of HTML as name=text lines; the standard library has them."""
    return "\x01".join(f"{k}={v}" for k, v in sorted(html5.items()))


@lru_cache(None)
def _short() -> str:
    """The names that need no semicolon, longest first, as alternatives."""
    return "|".join(sorted((k for k in html5 if not k.endswith(";")), key=lambda k: (-len(k), k)))


@lru_cache(None)
def _low_numbers() -> list[str]:
    """What the numbers below 160 stand for: controls are Windows letters or nothing."""
    return [stdlib_unescape(f"&#{n};") for n in range(160)]


def _code_point(digits: Column, base: int) -> Column:
    short = F.regexp_replace(digits, "^0+", "")
    number = F.when(F.length(short) > 8, F.lit(0x110000)).otherwise(F.conv(F.concat(F.lit("0"), short), base, 10).cast("int"))
    low = F.split(F.lit("\x01".join(_low_numbers())), "\x01")

    def text(n: Column) -> Column:
        tail = lambda shift: F.shiftright(n, shift).bitwiseAND(63) + 128
        joined = lambda *parts: reduce(lambda a, b: a * 256 + b, parts)
        lead = lambda shift, mark: (F.shiftright(n, shift) + mark).cast("long")
        utf8 = F.when(n < 0x800, joined(lead(6, 192), tail(0))).when(n < 0x10000, joined(lead(12, 224), tail(6), tail(0))).otherwise(joined(lead(18, 240), tail(12), tail(6), tail(0)))
        unknown = (n > 0x10FFFF) | n.between(0xD800, 0xDFFF)
        none = n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(0xFFFE) == 0xFFFE)
        return F.when(n < 160, F.get(low, n)).when(unknown, F.lit("\ufffd")).when(none, F.lit("")).otherwise(F.decode(F.unhex(F.hex(utf8)), "UTF-8"))

    return F.get(F.transform(F.array(number), text), F.lit(0))


def unescaped(c: Column) -> Column:
    """Text with its character references decoded once: named ones of HTML, with or without a
    semicolon where HTML allows it, decimal and hexadecimal ones."""
    pieces = F.regexp_extract_all(c, F.lit(r"&#[0-9]+;?|&#[xX][0-9a-fA-F]+;?|&[A-Za-z][A-Za-z0-9]*;?|[^&]+|&"), F.lit(0))
    names = F.str_to_map(F.lit(_named()), F.lit("\x01"), F.lit("="))

    def decoded(p: Column) -> Column:
        body = F.substring(p, 2, 1 << 30)
        short = F.regexp_extract(body, f"^(?:{_short()})", 0)
        named = F.coalesce(F.try_element_at(names, body), F.when(short != "", F.concat(F.try_element_at(names, short), F.substr(body, F.length(short) + 1))))
        return (
            F.when(~p.startswith("&"), p).when(p.rlike("^&#[0-9]"), _code_point(F.regexp_extract(p, "([0-9]+)", 1), 10)).when(p.rlike("^&#[xX]"), _code_point(F.regexp_extract(p, "[xX]([0-9a-fA-F]+)", 1), 16)).otherwise(F.coalesce(named, p))
        )

    return F.when(c.contains("&"), F.array_join(F.transform(pieces, decoded), "")).otherwise(c)

