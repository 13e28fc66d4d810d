"""Entity assembly: silver and gold tables put together from matched parts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import latest


def waterfall(left: DataFrame, sources: Sequence[tuple[DataFrame, str]], key: str, columns: Sequence[str]) -> DataFrame:
    """left with each column from the first source (in order, left itself first) that has a
    value for it; sources have one row for each of their key. found_in names it for the
    first column."""
    out = left
    for df, name in sources:
        have = [c for c in columns if c in df.columns]
        out = out.join(df.select(F.col(key).alias(f"_{name}"), *[F.col(c).alias(f"_{name}_{c}") for c in have]), F.col(key) == F.col(f"_{name}"), "left")
    def best(c: str) -> Column:  # noqa: E306
        return F.coalesce(*([F.col(c)] if c in left.columns else []), *[F.col(f"_{n}_{c}") for df, n in sources if c in df.columns])
    first = columns[0]
    own = [F.when(F.col(first).isNotNull(), "left")] if first in left.columns else []
    found = F.coalesce(*own, *[F.when(F.col(f"_{n}_{first}").isNotNull(), F.lit(n)) for df, n in sources if first in df.columns])
    return out.select(*[c for c in left.columns if c not in columns], *[best(c).alias(c) for c in columns], found.alias("found_in"))


def rekey(facts: DataFrame, dim: DataFrame, old: Sequence[str], dim_old: Sequence[str], new: str) -> DataFrame:
    """facts with the dimension's new key; rows without one keep a null."""
    side = dim.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(dim_old)], F.col(new))
    on = None
    for i, c in enumerate(old):
        same = F.col(c) == F.col(f"_k{i}")
        on = same if on is None else on & same
    return facts.join(side, on, "left").drop(*[f"_k{i}" for i in range(len(old))])


def resolve_alias(df: DataFrame, name: Column, aliases: DataFrame, out: str) -> DataFrame:
    """df with the code of its name; aliases(alias, code) are normalised. Spark broadcasts
    them where their size allows."""
    return df.withColumn("_alias", name).join(aliases.select(F.col("alias").alias("_a"), F.col("code").alias(out)), F.col("_alias") == F.col("_a"), "left").drop("_alias", "_a")


def player_snapshot(players: DataFrame, pages: DataFrame, key: Column, name: Column, page_name: Column, order: Sequence[Column], values: Sequence[str]) -> DataFrame:
    """Players with a unique key and the newest page of their name; a player without a page
    has nulls, and a key seen again gets a suffix in order."""
    newest = latest.newest_per_key(pages.withColumn("_page", page_name).where("_page is not null"), ["_page"], order)
    joined = players.withColumns({"_name": name, "_key": key}).join(newest.select("_page", *values), F.col("_name") == F.col("_page"), "left")
    return latest.suffix_collisions(joined, "_key", [F.col(c) for c in players.columns], "player_uid").drop("_name", "_key", "_page")


def team_snapshot(odds: DataFrame, lineup: DataFrame, team: str) -> DataFrame:
    """Teams of odds with their lineup columns. If there are any odds, teams with a lineup
    only are left out; without odds the lineups are all there is."""
    has_odds = odds.select(F.lit(1).alias("_any")).limit(1)
    with_odds = odds.join(lineup, team, "left")
    blank = lineup.join(has_odds, how="left").where("_any is null").drop("_any")
    return with_odds.unionByName(blank, allowMissingColumns=True)


def intersected(wanted: Sequence[str], df: DataFrame) -> list[str]:
    """The wanted columns that df has, in the wanted order."""
    have = set(df.columns)
    return [c for c in wanted if c in have]


def mean_of_metrics(folds: DataFrame, prefix: str) -> DataFrame:
    """Mean over the rows of every column whose name starts with prefix."""
    return folds.agg(*[F.avg(c).alias(c) for c in folds.columns if c.startswith(prefix)])


def replace_if_new(old: DataFrame, new: DataFrame, key: str, digest: str, columns: Sequence[str]) -> DataFrame:
    """old with columns of new where its digest is known and another."""
    side = new.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in (digest, *columns)])
    changed = F.col(f"_{digest}").isNotNull() & ~F.col(f"_{digest}").eqNullSafe(F.col(digest))
    j = old.join(side, F.col(key) == F.col("_k"), "left")
    return j.select(*[F.when(changed, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in (digest, *columns) else F.col(c) for c in old.columns])


def coded(c: Column, codes: Mapping[str, str]) -> Column:
    """Code by the first of several LIKE patterns that fits."""
    out = F.lit(None).cast("string")
    for pattern, code in reversed(list(codes.items())):
        out = F.when(c.like(pattern), F.lit(code)).otherwise(out)
    return out
