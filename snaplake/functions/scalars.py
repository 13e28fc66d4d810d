"""Column functions: safe casts, name keys, dates, seasons, URLs, probabilities.

All are expressions of built-in functions.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Mapping, Sequence
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_text(c: Column) -> Column:
    """Trimmed text, blank is null."""
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def to_double(c: Column, default: float | None = None) -> Column:
    v = F.trim(c.cast("string")).try_cast("double")
    return v if default is None else F.coalesce(v, F.lit(default))


def to_int(c: Column) -> Column:
    """Whole number by way of a decimal one: 3.9 and "3.9" are 3, bad text is null."""
    return to_double(c).try_cast("bigint")


def first_text(*columns: Column) -> Column:
    return F.coalesce(*[to_text(c) for c in columns])


@lru_cache(None)
def _folds() -> tuple[str, str, str, dict[str, str]]:
    """Characters that are another one under compatibility decomposition without combining
    marks and what they become, those that vanish, and those that become several. Hangul
    syllables aren't listed: their parts are no letters of a key."""
    one, plain, gone, several = [], [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF:
            continue
        c = chr(code)
        folded = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if folded == c:
            continue
        if not folded:
            gone.append(c)
        elif len(folded) == 1:
            one.append(c)
            plain.append(folded)
        else:
            several[c] = folded
    return "".join(one), "".join(plain), "".join(gone), several


@lru_cache(None)
def _plain_ranges() -> str:
    """Ranges of characters that don't become several, as a class of a pattern: those of Latin
    letters and the widest others. The patterns of Java try the ranges of a class one by one, so
    there are few."""
    marks = sorted(map(ord, _folds()[3]))
    gaps = [(a, b) for a, b in zip([0, *[m + 1 for m in marks]], [*[m - 1 for m in marks], sys.maxunicode]) if a <= b]
    latin = [g for g in gaps if g[0] < 0x250]
    wide = sorted(set(gaps) - set(latin), key=lambda g: g[0] - g[1])[:10]
    return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in [*latin, *sorted(wide)])


def without_accents(c: Column) -> Column:
    """Text after compatibility decomposition, without combining marks. Texts without a
    character that becomes several are one translate."""
    one, plain, gone, several = _folds()
    spelled = F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in several.items())), F.lit("\x01"), F.lit("\x02"))
    has_some = F.translate(c, "".join(several), "\x01" * len(several)).contains("\x01")
    # Runs of characters that surely stay, and the others one by one.
    pieces = F.regexp_extract_all(c, F.lit(f"(?s)[{_plain_ranges()}]+|."), F.lit(0))
    longer = F.array_join(F.transform(pieces, lambda x: F.when(F.length(x) == 1, F.coalesce(F.try_element_at(spelled, x), x)).otherwise(x)), "")
    # Characters of `one + gone` beyond the length of `plain` are dropped.
    return F.translate(F.when(has_some, longer).otherwise(c), one + gone, plain)


def name_key(c: Column, joiner: str = " ", default: str | None = None) -> Column:
    """Lower-case words of a-z and 0-9 without accents, joined."""
    words = F.trim(F.regexp_replace(F.lower(without_accents(c)), "[^a-z0-9]+", " "))
    key = F.nullif(F.replace(words, F.lit(" "), F.lit(joiner)), F.lit(""))
    return key if default is None else F.coalesce(key, F.lit(default))


def slug(c: Column, only_ascii: bool = True) -> Column:
    """Lower-case letters and digits joined by hyphens; letters of other scripts stay with
    only_ascii=False and else part words."""
    other = "[^a-z0-9]+" if only_ascii else r"[^\p{L}\p{N}]+"
    return F.nullif(F.regexp_replace(F.regexp_replace(F.lower(without_accents(c)), other, "-"), "^-|-$", ""), F.lit(""))


def entity_key(name: Column, born: Column) -> Column:
    """CamelCase name and birth date as yyyyMMdd, or 00000000."""
    camel = F.replace(F.initcap(name_key(name)), F.lit(" "), F.lit(""))
    return F.concat(F.coalesce(F.nullif(camel, F.lit("")), F.lit("PlayerUnknown")), F.coalesce(F.date_format(born, "yyyyMMdd"), F.lit("00000000")))


def match_key(season: Column, day: Column, home: Column, away: Column) -> Column:
    """yy/yy-MDnn-HOMEAWAY; an unknown code is TNA."""
    code = lambda c: F.coalesce(to_text(c), F.lit("TNA"))
    return F.concat(season, F.lit("-MD"), F.lpad(day.cast("string"), 2, "0"), F.lit("-"), code(home), code(away))


def parse_date(c: Column) -> Column:
    """dd.MM.yyyy, yyyy-MM-dd or yyyy/MM/dd; anything else is null."""
    forms = {r"^\d{2}\.\d{2}\.\d{4}$": "dd.MM.yyyy", r"^\d{4}-\d{2}-\d{2}$": "yyyy-MM-dd", r"^\d{4}/\d{2}/\d{2}$": "yyyy/MM/dd"}
    t = F.trim(c)
    return F.coalesce(*[F.when(t.rlike(r), F.try_to_timestamp(t, F.lit(f)).cast("date")) for r, f in forms.items()])


def parse_time(c: Column) -> Column:
    """ISO time (without zone: UTC), or a number of days (10 000 to 100 000), seconds, or
    milliseconds (above 1e10) since 1970; anything else is null."""
    t = F.trim(c)
    # A colon, or a minus behind a digit, is in no number; a cast that fails on them is dear.
    n = to_double(F.when(~t.rlike("[0-9]-|:"), t))
    number = F.when((n >= 10_000) & (n <= 100_000), n * 86_400).when(n > 1e10, n / 1000).otherwise(n)
    return F.when(n.isNotNull(), F.timestamp_seconds(number)).otherwise(F.try_to_timestamp(t))


def season_of(time: Column) -> Column:
    """Season number yyYY of a time: seasons start in July, 2526 is 2025/2026."""
    start = F.year(time) - F.when(F.month(time) < 7, 1).otherwise(0)
    return F.pmod(start, F.lit(100)) * 100 + F.pmod(start + 1, F.lit(100))


def season_of_label(label: Column) -> Column:
    """Season number of a label like 2025/2026; other labels get a number from their hash."""
    a, b = F.regexp_extract(label, r"^\d{2}(\d{2})/\d{2}(\d{2})$", 1), F.regexp_extract(label, r"^\d{2}(\d{2})/\d{2}(\d{2})$", 2)
    return F.when(a != "", F.concat(a, b).try_cast("bigint")).otherwise(F.conv(F.substring(F.sha1(label), 1, 6), 16, 10).cast("bigint"))


def recent_seasons(newest: Column, n: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: newest - i * 101)


def age_in_years(born: Column, on: Column) -> Column:
    return F.year(on) - F.year(born) - F.when(F.date_format(on, "MMdd") < F.date_format(born, "MMdd"), 1).otherwise(0)


def canonical_url(c: Column) -> Column:
    """https, no query or fragment, one slash at the end."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(c), "^http://", "https://"), "[?#].*$", "")
    return F.concat(F.regexp_replace(bare, "/+$", ""), F.lit("/"))


def site_url(c: Column, domain: str, site: str, section: str) -> Column:
    """Page addresses of a domain: https, no query or fragment, cut before a section of the
    path, a slash at the end. Other addresses are only trimmed; other hosts of the domain
    only get https."""
    text = F.trim(c)
    secure = F.regexp_replace(text, "^http://", "https://")
    path = F.regexp_replace(F.substring(secure, F.lit(len(site) + 1), F.length(secure)), "[?#].*$", "")
    path = F.when(path.contains(section), F.concat(F.split_part(path, F.lit(section), F.lit(1)), F.lit("/"))).otherwise(path)
    return F.when(~text.contains(domain), text).when(~secure.startswith(site), secure).otherwise(F.concat(F.lit(site), path, F.when(path.endswith("/"), "").otherwise("/")))


def squad_url(c: Column, section: str, other: str) -> Column:
    """The squad page of a team page: the path up to its section, or with the section in
    place of another one, or behind a path that ends in a name and a number; else null."""
    form = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)([^?#]*)"
    host, path = F.regexp_extract(F.trim(c), form, 1), F.coalesce(F.nullif(F.regexp_extract(F.trim(c), form, 2), F.lit("")), F.lit("/"))
    clean = (
        F.when(path.endswith(section), path)
        .when(path.contains(section), F.concat(F.split_part(path, F.lit(section), F.lit(1)), F.lit(section)))
        .when(path.contains(other), F.replace(path, F.lit(other), F.lit(section)))
        .when(path.rlike(r"/[^/]+/\d+/?$"), F.concat(F.regexp_replace(path, "/$", ""), F.lit(section)))
    )
    return F.when(host != "", F.concat(host, clean))


def labelled(code: Column, labels: Mapping[str, str], default: str) -> Column:
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[code], F.lit(default))


def competition_risk(label: Column, competitors: Column) -> Column:
    by_count = F.when(competitors >= 2, "high").when(competitors == 1, "medium").otherwise("low")
    return F.coalesce(F.lower(to_text(label)), by_count)


def score_parts(score: Column) -> tuple[Column, Column]:
    part = lambda k: F.trim(F.get(F.split(score, ":"), F.lit(k))).try_cast("int")
    return part(0), part(1)


def result_of(is_home: Column, home: Column, away: Column) -> Column:
    """W, D or L from the side and the score; null if either is unknown."""
    own, other = F.when(is_home, home).otherwise(away), F.when(is_home, away).otherwise(home)
    known = is_home.isNotNull() & home.isNotNull() & away.isNotNull()
    return F.when(known & (own > other), "W").when(known & (own == other), "D").when(known, "L")


def likely_result(win: Column, draw: Column, loss: Column) -> Column:
    w, x, y = (F.coalesce(c, F.lit(-1.0)) for c in (win, draw, loss))
    return F.when((w >= x) & (w >= y), "win").when(x >= y, "draw").otherwise("loss")


def display_name(code: Column, name: Column) -> Column:
    """CODE (Name), once."""
    return F.when(code.isNull() | (to_text(code).isNull()), name).when(name.isNull() | name.startswith(F.concat(code, F.lit(" ("))), name).otherwise(F.concat(code, F.lit(" ("), name, F.lit(")")))


def implied_shares(odds: Sequence[Column], digits: int = 6) -> list[Column]:
    """1 / odds over their sum: what the book thinks without its margin."""
    raw = [F.lit(1.0) / F.nullif(o, F.lit(0.0)) for o in odds]
    total = sum((F.coalesce(r, F.lit(0.0)) for r in raw), F.lit(0.0))
    return [F.round(r / F.nullif(total, F.lit(0.0)), digits) for r in raw]


def clamp(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def content_hash(*columns: Column) -> Column:
    return F.sha1(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]))
