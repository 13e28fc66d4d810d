"""Timestamped snapshot datasets: landing, pinned and as-of reads, exports.

A dataset is a folder partitioned by snapshot_ts, a sortable text like
2024-01-30T120000Z; a read of one snapshot is a partition filter.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import entity_key, to_text

STAMP = "snapshot_ts"


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One JSON object a line; blank lines are skipped, anything else fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_snapshot(df: DataFrame, path: str, stamp: str) -> DataFrame:
    """Write df as the snapshot of this time, an older one of the same time is replaced, and return
    what was written, read from there: df isn't computed again for what is told of it."""
    at = f"{path}/{STAMP}={stamp}"
    df.write.mode("overwrite").parquet(at)
    # Read by the folder of its time: a stamp may look like a date or a number.
    return df.sparkSession.read.schema(df.schema).parquet(at).withColumn(STAMP, F.lit(stamp))


def export(tables: Mapping[str, DataFrame], path: str, stamp: str) -> DataFrame:
    """Write each table's snapshot below path and return the manifest (table, rows). Rows are
    counted in the files written, where Parquet knows them without reading a column. (Observed
    metrics would do it in the write, but leave a session in which plans that hold a fitted
    model can't be sent to executors.)"""
    counts = [write_snapshot(df, f"{path}/{name}", stamp).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows") for name, df in tables.items()]
    return reduce(DataFrame.union, counts)


def write_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """CSV with these columns in this order; absent ones are empty."""
    df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns]).write.mode("overwrite").option("header", True).csv(path)


def read_aliased_csv(spark: SparkSession, path: str, fields: dict[str, tuple[str, Sequence[str]]]) -> DataFrame:
    """CSV rows as typed records: fields maps a column to its type and the headers that it
    may have; the first that is not blank counts, and unreadable values are null."""
    df = spark.read.option("header", True).csv(path)
    have = set(df.columns)

    def pick(kind: str, names: Sequence[str]) -> Column:
        found = [F.nullif(F.trim(F.col(f"`{n}`")), F.lit("")) for n in names if n in have]
        return (F.coalesce(*found) if found else F.lit(None).cast("string")).try_cast(kind)

    return df.select(*[pick(kind, names).alias(c) for c, (kind, names) in fields.items()])


def latest_common(datasets: Sequence[DataFrame], stamp: str = STAMP) -> str:
    """The newest time that every dataset has; an error if there is none."""
    common = datasets[0].select(stamp)
    for d in datasets[1:]:
        common = common.intersect(d.select(stamp))
    newest = common.agg(F.max(stamp)).first()[0]
    if newest is None:
        raise LookupError("the datasets have no snapshot time in common")
    return newest


def pinned(df: DataFrame, at: str, stamp: str = STAMP) -> DataFrame:
    """The snapshot of exactly this time; an error if it is missing."""
    out = df.where(F.col(stamp) == at)
    if out.isEmpty():
        raise LookupError(f"there is no snapshot of {at}")
    return out


def resolve_as_of(stamp: Column, at: Column, or_later: bool = True) -> Column:
    """Aggregate: the newest time not after `at`, or else (or_later) the newest of all."""
    older = F.max(F.when(stamp <= at, stamp))
    return F.coalesce(older, F.max(stamp)) if or_later else older


def as_of(df: DataFrame, at: str, stamp: str = STAMP, or_later: bool = False) -> DataFrame:
    """The newest snapshot not after `at`; a later one only where asked for."""
    time = df.agg(resolve_as_of(F.col(stamp), F.lit(at), or_later)).first()[0]
    return df.where(F.col(stamp) == time) if time is not None else df.limit(0)


def audited(df: DataFrame, run_id: str, source: str, version: str, ingested_at: Column | None = None) -> DataFrame:
    """df with the audit columns of a run."""
    return df.withColumns({"ingested_at": ingested_at if ingested_at is not None else F.current_timestamp(), "source": F.lit(source), "source_version": F.lit(version), "run_id": F.lit(run_id)})


def land(df: DataFrame, path: str, file_stamp: str) -> None:
    """Append raw rows with the load time and the time of their file."""
    df.withColumns({"bronze_loaded_at": F.current_timestamp(), "bronze_file_timestamp": F.lit(file_stamp)}).write.mode("append").parquet(path)


def land_all(frames: dict[str, DataFrame | None], required: Sequence[str], path: str, file_stamp: str) -> list[str]:
    """Land every dataset that is there, in a folder of its name below path, and return the
    names; an error before anything is written if a required one is missing."""
    missing = [name for name in required if frames.get(name) is None]
    if missing:
        raise LookupError(f"no dataset {', '.join(missing)}")
    landed = {name: df for name, df in frames.items() if df is not None}
    for name, df in landed.items():
        land(df, f"{path.rstrip('/')}/{name}", file_stamp)
    return sorted(landed)


def master_records(records: DataFrame, uid: str, id_col: str, name: str, born: str) -> DataFrame:
    """Records with a name (player_<id> where there is none) and a key: the given one, if it
    is not a number, or else one of name and birth date; an error if there is no record."""
    if records.isEmpty():
        raise LookupError("there are no records")
    named = records.withColumn(name, F.coalesce(to_text(F.col(name)), F.concat(F.lit("player_"), F.coalesce(F.col(id_col).cast("string"), F.lit("unknown")))))
    given = to_text(F.col(uid))
    return named.withColumn(uid, F.when(given.rlike("[^0-9]"), given).otherwise(entity_key(F.col(name), F.col(born))))


def preview(df: DataFrame, columns: Sequence[str], name_columns: Sequence[str], contains: str | None, n: int, width: int = 60) -> DataFrame:
    """n rows of some columns, of those whose names contain a text in any case; arrays are
    joined and long texts cut for display."""
    if contains:
        hit = F.lit(False)
        for c in name_columns:
            hit = hit | F.coalesce(F.lower(F.col(c)).contains(contains.lower()), F.lit(False))
        df = df.where(hit)
    shown = [F.array_join(c, ", ") if isinstance(df.schema[c].dataType, T.ArrayType) else F.col(c).cast("string") for c in columns]
    return df.select(*[F.substring(s, 1, width).alias(c) for s, c in zip(shown, columns, strict=True)]).limit(n)


def tagged_union(frames: dict[str, DataFrame], tag: str) -> DataFrame:
    """Union of frames by column name, each with its name as tag; absent columns are null."""
    out = None
    for name, df in frames.items():
        one = df.withColumn(tag, F.lit(name))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out
