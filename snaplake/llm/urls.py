"""URL filters whose pattern rules are indexed by their rarest literal token.

A pattern rule is a regular expression over the lower-cased URL. A literal of it that
stands between fixed separators or word boundaries must be a whole token (a run of
a-z and 0-9) of every URL that the rule matches. Of these tokens the one in the fewest
URLs indexes the rule. The tokens of a URL fetch the rules that they index, by a hash
join, and only those run their regular expression; of the matching rules the first in
the list decides. A rule without such a token is tried on every URL.

Site rules (host and path prefix) come before pattern rules; the longest fitting one
decides. Everything is DataFrame expressions. Rules are a list in the program, so the
rule side of the join is as small as that list and is broadcast; token counts are
pre-aggregated, and only those of rule tokens.

Hosts run from the first :// to the next / ? # or the end, A-Z lower-cased; paths from
there to ? # or the end. Null URLs, and those without ://, have empty ones. Repeated
URLs are judged once and answered each; ties between rules of one length go to the
first. Input columns named like an output column are replaced. An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import fresh, without

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed values: (verdict, host and path prefix).
SITE_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: (verdict, pattern), the first match decides.
PATTERN_RULES = (
    ("allow", r"://docs\.[^/?#]*/"),
    ("block", r"\bspam-farm\."),
    ("block", r"\bcheap-pills\."),
    ("block", r"\b(?:online-)?casino\b"),
    ("block", r"\breplica-(?:bags|watches)\b"),
    ("block", r"/wp-login\.php\b"),
    ("block", r"[?&]sessionid=[0-9a-f]{8,}"),
    ("block", r"/tag/[^/?#]+/page/[0-9]+"),
    ("block", r"[?&]utm_source=feed(?:&|#|$).*[?&]ref="),
    ("block", r"\.(?:exe|apk|torrent)(?:[?#]|$)"),
)
#: Most rules for which the broadcast of their tokens is asked for.
BROADCAST_RULES = 100_000


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def site_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for say, text in sorted(rules, key=lambda r: len(r[1])):
        site, slash, rest = text.partition("/")
        fits = ((host == site) | host.endswith(f".{site}")) & path.startswith(slash + rest)
        name, verdict = F.when(fits, F.lit(text)).otherwise(name), F.when(fits, F.lit(say)).otherwise(verdict)
    return name, verdict


def literal_tokens(pattern: Column) -> Column:
    """Tokens that every match of the pattern has as whole tokens; maybe none."""
    edge, gap = "\u0001", "\u0002"
    plain = F.regexp_replace(pattern, r"\\b", edge)
    plain = F.regexp_replace(plain, r"\[(?:\\.|[^\]\\])*\][?*+]?(?:\{[^}]*\})?", gap)
    for _ in range(4):  # groups, innermost first, with what is repeated or optional
        plain = F.regexp_replace(plain, r"\((?:\\.|[^()\\])*\)[?*+]?(?:\{[^}]*\})?", gap)
    plain = F.when(plain.contains("|"), F.lit("")).otherwise(plain)  # alternatives: no token is sure
    plain = F.regexp_replace(plain, r"(?:\\[^A-Za-z0-9]|[^\\])[?*+](?:\{[^}]*\})?|\\[A-Za-z0-9]|.\{[^}]*\}", gap)
    plain = F.regexp_replace(plain, r"\\([^A-Za-z0-9])", edge)
    plain = F.regexp_replace(plain, r"[.^$]", gap)
    return F.regexp_extract_all(plain, F.lit(f"(?<=[-/_=&:;,~%@{edge}])([a-z0-9]+)(?=[-/_=&:;,~%@{edge}])"), F.lit(1))


def url_tokens(lower_url: Column) -> Column:
    return F.array_distinct(F.filter(F.split(lower_url, "[^a-z0-9]+"), lambda t: t != ""))


def pattern_verdicts(urls: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(url, pattern, said) of the distinct urls(url) that some pattern rule matches."""
    if not rules:
        return urls.select("url", F.lit(None).cast("string").alias("pattern"), F.lit(None).cast("string").alias("said")).limit(0)
    spark = urls.sparkSession
    listed = F.array(*[F.struct(F.lit(i).alias("rule_id"), F.lit(v).alias("said"), F.lit(p).alias("pattern")) for i, (v, p) in enumerate(rules)])
    table = spark.range(1).select(F.inline(listed)).withColumn("tokens", F.array_distinct(literal_tokens(F.col("pattern"))))
    small = F.broadcast if len(rules) <= BROADCAST_RULES else (lambda df: df)
    distinct = urls.where(F.col("url").isNotNull()).select("url").distinct().withColumn("lu", ascii_lower(F.col("url")))
    tokens = distinct.select("url", "lu", F.explode(url_tokens(F.col("lu"))).alias("token"))
    by_token = table.select("rule_id", "said", "pattern", F.explode("tokens").alias("token"))
    counts = tokens.join(small(by_token.select("token").distinct()), "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = by_token.join(counts, "token", "left").groupBy("rule_id", "said", "pattern").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("r")).select("rule_id", "said", "pattern", F.col("r.token").alias("token"))
    fetched = tokens.join(small(rarest), "token").where(F.expr("lu rlike pattern")).select("url", "rule_id", "said", "pattern")
    # Known from the patterns alone, of which there are as many as in the program's list.
    unsure = [r["rule_id"] for r in table.where(F.size("tokens") == 0).select("rule_id").orderBy("rule_id").collect()]
    first = F.coalesce(*[F.when(F.col("lu").rlike(rules[i][1]), F.lit(i)) for i in unsure], F.lit(None).cast("int"))
    tried = distinct.withColumn("rule_id", first).where(F.col("rule_id").isNotNull()).join(small(table.select("rule_id", "said", "pattern")), "rule_id").select("url", "rule_id", "said", "pattern")
    best = F.min(F.struct("rule_id", "said", "pattern")).alias("b")
    return fetched.union(tried).groupBy("url").agg(best).select("url", F.col("b.pattern").alias("pattern"), F.col("b.said").alias("said"))


def judge(pages: DataFrame, *, url: str = "url", site_rules: Sequence[tuple[str, str]] = SITE_RULES, pattern_rules: Sequence[tuple[str, str]] = PATTERN_RULES) -> DataFrame:
    """pages with host, path, rule, pattern and verdict."""
    rows = without(pages, "host", "path", "rule", "pattern", "verdict")
    own, u = fresh(pages, "url", "said"), F.col(f"`{url}`")
    host, path = host_of(u), path_of(u)
    rule, said = site_rule(F.col("host"), F.col("path"), site_rules)
    matched = pattern_verdicts(rows.select(u.alias("url")), pattern_rules).select(F.col("url").alias(own["url"]), "pattern", F.col("said").alias(own["said"]))
    judged = rows.withColumns({"host": host, "path": path}).join(matched, u == F.col(own["url"]), "left")
    return judged.withColumns({"rule": rule, "verdict": F.coalesce(said, own["said"], F.lit("allow"))}).drop(own["url"], own["said"])


def op6_url_rules(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict", "pattern")


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def op6_sql() -> str:
    fits = lambda t: f"((host = {_q(t.partition('/')[0])} OR ends_with(host, {_q('.' + t.partition('/')[0])})) AND starts_with(path, {_q('/' + t.partition('/')[2])}))"
    order = sorted(SITE_RULES, key=lambda r: -len(r[1]))
    rule = " ".join(f"WHEN {fits(t)} THEN {_q(t)}" for _, t in order)
    said = " ".join(f"WHEN {fits(t)} THEN {_q(v)}" for v, t in order)
    pattern = " ".join(f"WHEN regexp_matches(lu, {_q(p)}) THEN {_q(p)}" for _, p in PATTERN_RULES)
    method = " ".join(f"WHEN regexp_matches(lu, {_q(p)}) THEN {_q(v)}" for v, p in PATTERN_RULES)
    return f"""
WITH parts AS (
  SELECT page_id, translate(url, '{UPPER}', '{LOWER}') AS lu,
         coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages)
SELECT page_id, host, path, CASE {rule} ELSE NULL END AS rule,
       CASE {said} {method} ELSE 'allow' END AS verdict,
       CASE {pattern} ELSE NULL END AS pattern
FROM parts"""
