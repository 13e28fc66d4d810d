"""State on plain tables: upserts with policies, identity merges, retention, changes.

Each operator returns the new state of a table; writing it to a new version and moving
a pointer is the caller's. All are joins and groupings on the table's key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import cut

#: What a column of an existing row becomes: the new value, the new one unless null, or the old one unless null.
POLICIES = ("overwrite", "fill", "keep")


def upsert(base: DataFrame, incoming: DataFrame, keys: Sequence[str], policy: Mapping[str, str] | None = None, default: str = "fill", action: str | None = None) -> DataFrame:
    """base with the rows of incoming (one for each key). Columns that incoming lacks keep
    their values. With `action` a column says inserted, updated or kept."""
    policy = policy or {}
    b, n = base.withColumn("_old", F.lit(True)).alias("b"), incoming.withColumn("_new", F.lit(True)).alias("n")
    on = None
    for k in keys:
        same = F.col(f"b.{k}").eqNullSafe(F.col(f"n.{k}"))
        on = same if on is None else on & same
    j = b.join(n, on, "full")

    def value(c: str) -> Column:
        old, new = F.col(f"b.{c}"), F.col(f"n.{c}") if c in incoming.columns else None
        how = policy.get(c, default)
        if how not in POLICIES:
            raise ValueError(f"unknown policy {how}")
        if new is None:
            return old
        if c in keys:
            return F.when(F.col("_old"), old).otherwise(new)
        kept = new if how == "overwrite" else F.coalesce(new, old) if how == "fill" else F.coalesce(old, new)
        return F.when(F.col("_new") & F.col("_old"), kept).when(F.col("_new"), new).otherwise(old)

    cols = [value(c).alias(c) for c in base.columns]
    if action:
        cols.append(F.when(F.col("_old").isNull(), "inserted").when(F.col("_new").isNull(), "kept").otherwise("updated").alias(action))
    return j.select(*cols)


def insert_absent(base: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """base with those rows of incoming whose key it lacks, one for each key."""
    fresh = incoming.dropDuplicates([key]).join(base.select(key), key, "left_anti")
    return base.unionByName(fresh.select(*base.columns))


def last_targets(moved: DataFrame) -> DataFrame:
    """(source, target) with the end of each chain a to b to c as the target of all before it, by
    pointer jumping: each round doubles how far a target looks, so a chain of n ids takes
    about log2(n) rounds. One target a source; a chain that comes back to itself raises."""
    now = cut(moved.select("source", "target").where(~F.col("source").eqNullSafe(F.col("target"))).distinct())
    n = now.count()
    if now.select("source").distinct().count() != n:
        raise ValueError("a source has several targets")
    for _ in range(n.bit_length() + 1):
        ahead = now.select(F.col("source").alias("_s"), F.col("target").alias("_t"))
        hops = now.join(ahead, F.col("target") == F.col("_s"), "left")
        now = cut(hops.select("source", F.coalesce("_t", "target").alias("target"), F.col("_t").isNotNull().alias("moved")))
        if now.where("moved").isEmpty():
            return now.drop("moved")
        now = now.drop("moved")
    raise ValueError("ids are merged in a circle")


def merge_identity(facts: DataFrame, moved: DataFrame, id_col: str, keys: Sequence[str], policy: Mapping[str, Column]) -> DataFrame:
    """facts with ids replaced by moved(source, target), up to the last target of a chain; rows
    that then share a key become one by the aggregates of policy."""
    moved = last_targets(moved)
    j = facts.join(moved.select(F.col("source").alias("_source"), "target"), F.col(id_col) == F.col("_source"), "left")
    renamed = j.withColumn(id_col, F.coalesce("target", F.col(id_col))).drop("_source", "target")
    return renamed.groupBy(*keys).agg(*[agg.alias(c) for c, agg in policy.items()])


def purge(facts: DataFrame, dim: DataFrame, key: str, keep: Column) -> DataFrame:
    """Rows of facts whose row of dim is to keep; rows of unknown keys go."""
    return facts.join(dim.where(F.coalesce(keep, F.lit(False))).select(key), key, "left_semi")


def outside_scope(df: DataFrame, a: str, b: str, allowed: DataFrame) -> DataFrame:
    """df without the rows of which a known side is not allowed. A row goes if NOT (a in
    allowed AND b in allowed) is true in three-valued logic: with a null side it stays
    unless the other is not allowed."""
    ids = allowed.toDF("_id").where("_id is not null").distinct()
    side = lambda n: ids.select(F.col("_id").alias(f"_{n}"))
    j = df.join(side("a"), F.col(a) == F.col("_a"), "left").join(side("b"), F.col(b) == F.col("_b"), "left")
    bad = lambda c, hit: F.col(c).isNotNull() & F.col(hit).isNull()
    return j.where(~(bad(a, "_a") | bad(b, "_b"))).drop("_a", "_b")


def newer_than_marks(incoming: DataFrame, stored: DataFrame, key: str, time: str) -> DataFrame:
    """Rows of incoming after the newest stored time of their key; all rows of new keys."""
    marks = stored.groupBy(key).agg(F.max(time).alias("_mark"))
    return incoming.join(marks, key, "left").where(F.col("_mark").isNull() | (F.col(time) > F.col("_mark"))).drop("_mark")


def track_changes(current: DataFrame, previous: DataFrame, key: str, fields: Sequence[str], time: str) -> DataFrame:
    """current with change_fingerprint, last_changed_at and first_seen_at. A row whose
    fields are as in previous keeps its last change; others changed now."""
    mark = F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)
    old = previous.select(F.col(key).alias("_key"), F.col("change_fingerprint").alias("_mark"), F.col("last_changed_at").alias("_changed"), F.col("first_seen_at").alias("_seen"))
    j = current.withColumn("change_fingerprint", mark).join(old, F.col(key) == F.col("_key"), "left")
    same = F.col("_mark") == F.col("change_fingerprint")
    return j.withColumns({"last_changed_at": F.when(same, F.coalesce("_changed", F.col(time))).otherwise(F.col(time)), "first_seen_at": F.coalesce("_seen", F.col(time))}).drop("_key", "_mark", "_changed", "_seen")


def merge_fields(df: DataFrame, key: str, rank: Column, fields: Sequence[str], weak: str = "unknown") -> DataFrame:
    """One row for each key: of every field the first value by rank that is not blank, where
    a weak word counts only if there is no other."""
    def best(c: str) -> Column:  # noqa: E306
        v = F.nullif(F.trim(F.col(c)), F.lit(""))
        return F.min(F.when(v.isNotNull(), F.struct((F.lower(v) == weak).alias("weak"), rank.alias("rank"), v.alias("v"))))["v"].alias(c)
    return df.groupBy(key).agg(*[best(c) for c in fields])  # noqa: E305


def match_by_id_or_code(base: DataFrame, incoming: DataFrame, id_col: str, code_col: str, name_col: str) -> DataFrame:
    """Upsert of a dimension whose rows are found by id, or else by code. Null ids and codes
    of a found row are filled if no other row uses them; names are overwritten unless null."""
    i = incoming.select(F.col(id_col).alias("_id"), F.col(code_col).alias("_code"), F.col(name_col).alias("_name"))
    by_id = base.join(i, F.col(id_col) == F.col("_id"), "left")
    used_codes, used_ids = base.select(F.col(code_col).alias("_u")).where("_u is not null"), base.select(F.col(id_col).alias("_u")).where("_u is not null")
    by_code = i.join(used_ids, F.col("_id") == F.col("_u"), "left_anti").select(F.col("_id").alias("_id2"), F.col("_code").alias("_code2"), F.col("_name").alias("_name2"))
    free = used_codes.withColumnRenamed("_u", "_taken")
    j = by_id.join(by_code, F.col("_id").isNull() & (F.col(code_col) == F.col("_code2")), "left").join(free, F.col("_code") == F.col("_taken"), "left")
    found = j.select(
        F.coalesce(F.col(id_col), "_id2").alias(id_col), F.coalesce(F.col(code_col), F.when(F.col("_taken").isNull(), F.col("_code"))).alias(code_col),
        F.coalesce("_name", "_name2", F.col(name_col)).alias(name_col),
    )
    new = by_code.join(used_codes, F.col("_code2") == F.col("_u"), "left_anti").select(F.col("_id2").alias(id_col), F.col("_code2").alias(code_col), F.col("_name2").alias(name_col))
    return found.union(new)
