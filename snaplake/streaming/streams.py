"""File streams of snapshots: landing, deduplication, upserts, change tracking.

All run with availableNow: they take what has arrived since the last run and stop. The
checkpoint of a stream is what a high-water mark is to a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ..operators import merge


def files(spark: SparkSession, path: str, schema: T.StructType | str, kind: str = "parquet", per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.format(kind).load(path)


def land(stream: DataFrame, path: str, checkpoint: str, source: str) -> None:
    """Append what arrived with its load time, source and file."""
    stamped = stream.withColumns({"bronze_loaded_at": F.current_timestamp(), "source": F.lit(source), "source_file": F.col("_metadata.file_path")})
    stamped.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path).awaitTermination()


def deduplicated(stream: DataFrame, time: str, keys: Sequence[str], late: str = "2 days") -> DataFrame:
    """The first row of each key; keys are forgotten once the watermark has passed."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))


def upsert_each_batch(stream: DataFrame, checkpoint: str, merge: Callable[[DataFrame, int], None]) -> None:
    """Call the batch merge for each micro-batch; it must be idempotent by batch id."""
    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def newest_version(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The table of the last batch in path's log, of those before a batch; None where there is none."""
    try:
        log = spark.read.schema("version string, batch long").json(f"{path}/log")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if before is not None:
        log = log.where(F.col("batch") < before)
    last = log.agg(F.max_by("version", "batch").alias("v")).first()["v"]
    return None if last is None else spark.read.parquet(f"{path}/data/{last}")


def commit_version(table: DataFrame, path: str, batch_id: int) -> None:
    """Write the table that a batch leaves, then its line in the log. A batch that is run again
    replaces its own version; until its line stands there the one before is the newest."""
    version = f"v{batch_id}"
    table.write.mode("overwrite").parquet(f"{path}/data/{version}")
    line = table.sparkSession.createDataFrame([(version,)], "version string")
    line.coalesce(1).write.mode("overwrite").json(f"{path}/log/batch={batch_id}")


def upsert(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], rows: Callable[[DataFrame], DataFrame], **policies) -> None:
    """Upsert rows(batch), a row for each key, into a table of versions at path. What a batch
    builds on is the version of the batch before it, as the log in the shared folder
    says: so a stream that starts again, or a batch that is run again, ends with the same table."""

    def one(batch: DataFrame, batch_id: int) -> None:
        base, new = newest_version(batch.sparkSession, path, before=batch_id), rows(batch)
        commit_version(new if base is None else merge.upsert(base, new, keys, **policies), path, batch_id)

    upsert_each_batch(stream, checkpoint, one)


#: Stands for a time that is null, before all others.
NO_TIME = -(1 << 62)


class StatusChanges(StatefulProcessor):
    """The last status of a key and the first time it was seen, in the state store."""

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        self.seen = handle.getValueState("seen", "status string, first_at long", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat([f[["status", "at"]] for f in rows], ignore_index=True)
        batch = batch.sort_values(["at", "status"], na_position="first", kind="stable", ignore_index=True)
        status = pd.Series([None if pd.isna(x) else x for x in batch["status"]], dtype=object)
        known = self.seen.get() if self.seen.exists() else None
        times = batch.loc[batch["at"] != NO_TIME, "at"]
        firsts = [int(times.min())] if len(times) else []
        if known is not None and known[1] != NO_TIME:
            firsts.append(known[1])
        first_at = min(firsts, default=NO_TIME)
        before = status.shift(1)
        same = (status == before) | (status.isna() & before.isna())
        # A key never seen had no status: its first row changes it unless that has none either.
        same.iloc[0] = status.iloc[0] == (known[0] if known is not None else None)
        self.seen.update((status.iloc[-1], first_at))
        told = status.loc[~same]
        if len(told):
            yield pd.DataFrame({"key": pd.Series([key[0]] * len(told), index=told.index, dtype=object), "status": told, "at": batch.loc[~same, "at"], "first_at": first_at})

    def close(self) -> None:
        pass


def changes(stream: DataFrame, key: str, status: str, time: str, path: str, checkpoint: str, ttl_ms: int | None = None) -> DataFrame:
    """(key, status, changed_at, first_seen_at) whenever the status of a key is another than
    before, read from path at the stream's end. Rows of one micro-batch are taken in order of
    time and status, after what earlier batches left; null times and statuses come first.

    The last status and first time of a key are in the state store, so a batch costs what it
    holds, whatever the number of keys, and a stream that starts again goes on from its
    checkpoint. A key not seen for ttl_ms is forgotten; a stream with state that expires by the
    clock never comes to an end by itself, so what has arrived is then one micro-batch. A task sorts the statuses and times
    of one key of one micro-batch; the size of a micro-batch bounds them (see files)."""
    spark = stream.sparkSession
    kinds = {c: stream.schema[c].dataType for c in (key, status)}
    rows = stream.select(F.col(key).alias("key"), F.col(status).cast("string").alias("status"), F.coalesce(F.unix_micros(F.col(time).cast("timestamp")), F.lit(NO_TIME)).alias("at"))
    schema = T.StructType([T.StructField("key", kinds[key]), T.StructField("status", T.StringType()), T.StructField("at", T.LongType()), T.StructField("first_at", T.LongType())])
    store = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(store)
    spark.conf.set(store, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        found = rows.groupBy("key").transformWithStateInPandas(statefulProcessor=StatusChanges(ttl_ms), outputStructType=schema, outputMode="Append", timeMode="ProcessingTime" if ttl_ms else "None")
        when = lambda c: F.when(F.col(c) != NO_TIME, F.timestamp_micros(F.col(c)))
        told = found.select(F.col("key").alias(key), F.col("status").cast(kinds[status]).alias(status), when("at").alias("changed_at"), when("first_at").alias("first_seen_at"))
        return collected(told, path, checkpoint, one_batch=ttl_ms is not None)
    finally:
        spark.conf.set(store, before)


def collected(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", one_batch: bool = False) -> DataFrame:
    """Run a stream to its end into Parquet and read the result; one_batch: all that has arrived at once."""
    trigger = {"once": True} if one_batch else {"availableNow": True}
    stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).trigger(**trigger).start(path).awaitTermination()
    return stream.sparkSession.read.parquet(path)
