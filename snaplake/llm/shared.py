"""What the operators of this subpackage share: the shared folder, blobs, columns."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def use_checkpoints(spark: SparkSession) -> None:
    """Keep the cluster's spark.checkpoint.dir; only where there is none use a folder of the
    warehouse, which executors share as well."""
    sc = spark.sparkContext
    if not sc.getConf().get("spark.checkpoint.dir") and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/shared")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see."""
    use_checkpoints(spark)
    return spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df from the shared folder: its lineage ends there, so a lost executor costs no recomputation."""
    use_checkpoints(df.sparkSession)
    return df.checkpoint()


def without(df: DataFrame, *names: str) -> DataFrame:
    """df without columns of these names in any case; an operator's own columns replace them."""
    taken = {n.lower() for n in names}
    return df.select(*[f"`{c}`" for c in df.columns if c.lower() not in taken])


def fresh(df: DataFrame, *names: str) -> dict[str, str]:
    """A column name that df has not, in any case, for each of names."""
    taken, out = {c.lower() for c in df.columns}, {}
    for n in names:
        free = f"_{n}"
        while free.lower() in taken:
            free = f"_{free}"
        out[n] = free
        taken.add(free.lower())
    return out


def fields(df: DataFrame) -> str:
    """The columns of df as a schema in DDL."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def pack(*arrays: np.ndarray | bytes, level: int = 3) -> bytes:
    """Arrays and byte strings as one compressed blob."""
    parts, head = [], []
    for a in arrays:
        raw = a if isinstance(a, bytes) else np.ascontiguousarray(a).tobytes()
        head.append(len(raw))
        parts.append(raw)
    return zstandard.ZstdCompressor(level=level).compress(np.array([len(head), *head], dtype=np.int64).tobytes() + b"".join(parts))


def unpack(blob: bytes) -> list[memoryview]:
    """The parts of pack() as read-only buffers."""
    raw = memoryview(zstandard.ZstdDecompressor().decompress(blob))
    n = int(np.frombuffer(raw[:8], dtype=np.int64)[0])
    lens = np.frombuffer(raw[8 : 8 + 8 * n], dtype=np.int64)
    out, at = [], 8 + 8 * n
    for k in lens.tolist():
        out.append(raw[at : at + k])
        at += k
    return out


def as_batch(columns: dict[str, Iterable], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def groups_for(df: DataFrame, text: str, bytes_each: int, least: int = 1) -> int:
    """How many groups of about bytes_each the texts of df make: grows with the input."""
    total = df.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    return max(least, int(-(-total // bytes_each)))


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


#: Ids up to which a list of them is broadcast: 16 MB or so.
BROADCAST_IDS = 1_000_000


def without_ids(df: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """df without the rows whose id is in ids (one distinct column). A short list is
    broadcast, so df isn't shuffled; a longer one is joined by its hash."""
    gone = fresh(df, "gone")["gone"]
    side = ids.toDF(gone)
    if ids.count() <= BROADCAST_IDS:
        side = F.broadcast(side)
    return df.join(side, F.col(f"`{name}`") == F.col(gone), "left_anti")


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession, size: str = "8m") -> None:
    """Hand texts to Python tasks in batches of this size, less memory beside the heap, where
    the session sets no size of its own."""
    if spark.conf.get(BATCH_BYTES, "1") == "1":
        spark.conf.set(BATCH_BYTES, size)


def tidy(run):
    """run, a function over Arrow batches, which gives unused memory back at its end."""

    @functools.wraps(run)
    def tidied(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return tidied
