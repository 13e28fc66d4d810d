"""Media columns stored as content-defined chunks and read back verified.

A text becomes a payload (its UTF-8 bytes, then bytes 255 up to a positive multiple of
576), and the payload an 8-bit mono WAV file. A gear hash rolls over the file; where
its low bits are zero a chunk ends, so equal passages make equal chunks wherever they
stand. Spark joins of the chunk digests give each distinct chunk one owner: the file
that holds its bytes in the store. A file's row has its ordered chunk list and the
bytes of the chunks that it owns; the others are fetched from their owners by digest.

Only digests take part in deduplication. Bytes are moved once, packed and compressed,
to where their file's row is written, and borrowed chunks once more on reading. Equal
files are stored and read once, however many rows hold them. Every chunk and every
file is verified against its digest when it is read.

Null texts count as empty. Texts of any length are handled whole; equal texts give
equal values in every column but the id, and repeated rows are answered each. Input
columns beside id and text are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
import wave
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblocks as tb
from .shared import cut, groups_for, pack, shared_folder, unpack, written

BLOCK = 4 << 20
UNIT = 576
#: Bytes of a chunk: least, and most; about LEAST + 2**BITS on average.
LEAST, BITS, MOST = 256, 11, 8192
RATE = 8000
#: Shared chunks up to which the list of their owners is broadcast: 50 MB or so.
BROADCAST_CHUNKS = 1_000_000
#: Compression level of moved and stored bytes.
LEVEL = 12
_GEAR = np.random.default_rng(31).integers(0, 2**32, 256, dtype=np.uint32)


def name_of(data: bytes) -> bytes:
    """The name of a chunk or file: half a SHA-256 digest."""
    return hashlib.sha256(data).digest()[:16]


def payload_of(text: bytes) -> bytes:
    return text + b"\xff" * (max(UNIT, -(-len(text) // UNIT) * UNIT) - len(text))


def wav(samples: bytes) -> bytes:
    """A WAV file of 8-bit mono samples; their number is even."""
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(samples), b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", len(samples)) + samples


def samples_of(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media)) as f:
        return f.readframes(f.getnframes())


def feature(samples: bytes) -> str:
    """Sum, energy about the middle, crossings of the middle and peak."""
    x = np.frombuffer(samples, dtype=np.uint8).astype(np.int64) - 128
    return f"{x.sum()}:{(x * x).sum()}:{np.count_nonzero((x[1:] < 0) != (x[:-1] < 0))}:{np.abs(x).max()}"


def _gear_cuts(buf: np.ndarray) -> list[int]:
    """Places after which a chunk may end: the gear hash of the last 32 bytes decides."""
    h = _GEAR[buf]
    for step in (1, 2, 4, 8, 16):
        shifted = np.zeros_like(h)
        shifted[step:] = h[:-step] << np.uint32(step)
        h = h + shifted
    return (np.flatnonzero(h >> np.uint32(32 - BITS) == 0) + 1).tolist()


def chunk_ends(media: list[bytes]) -> list[list[int]]:
    """For each file the ends of its chunks, the last at the file's end."""
    at, places = 0, _gear_cuts(np.frombuffer(b"".join(media), dtype=np.uint8))
    out = []
    for m in media:
        ends, pos, stop = [], at, at + len(m)
        while stop - pos > LEAST:
            k = bisect_left(places, pos + LEAST)
            end = min(places[k] if k < len(places) else stop, pos + MOST, stop)
            ends.append(end - at)
            pos = end
        if pos < stop:
            ends.append(stop - at)
        out.append(ends)
        at = stop
    return out


def _files(texts: pa.Array) -> Iterator[tuple[int, list[bytes], list[int]]]:
    """Blocks of neighbouring texts: the first's number, their files and their sizes."""
    for i, j in tb.blocks(texts, BLOCK):
        buf, at = tb.flat(texts.slice(i, j - i))
        raw = buf.tobytes()
        cuts = at.tolist()
        yield i, [wav(payload_of(raw[a:b])) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], np.diff(at).tolist()


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_bytes, file, chunks): digests only."""
    for batch in batches:
        for i, media, sizes in _files(batch.column("text")):
            chunks = [[name_of(m[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)] for m, ends in zip(media, chunk_ends(media), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(i, len(media)), pa.array(sizes, pa.int64()), pa.array([name_of(m) for m in media], pa.binary()), pa.array(chunks, pa.list_(pa.binary()))],
                names=["doc_id", "n_bytes", "file", "chunks"],
            )


def _send_bytes(buckets: int, senders: dict[bytes, int]):
    """senders: for files that stand in very many rows the one id whose rows send the bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, media, _ in _files(batch.column("text")):
                by: dict[int, dict[bytes, bytes]] = {}
                ids = batch.column("doc_id").slice(i, len(media)).to_pylist()
                for doc_id, m in zip(ids, media, strict=True):
                    d = name_of(m)
                    if senders.get(d, doc_id) != doc_id:
                        continue
                    by.setdefault(int.from_bytes(d[:6], "big") % buckets, {})[d] = m
                blobs = [pack(b"".join(x), np.array([len(m) for m in x.values()], dtype=np.int64), b"".join(x.values()), level=LEVEL) for x in by.values()]
                yield pa.RecordBatch.from_arrays([pa.array(list(by), pa.int64()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])

    return run


_STORE = "file binary, digests array<binary>, sizes array<int>, owned array<binary>, lends array<int>, borrows int"


def _store_rows(left: pa.Table, right: pa.Table) -> pa.Table:
    """The files of a bucket with the bytes of the chunks that each one owns."""
    files: dict[bytes, bytes] = {}
    for blob in left.column("blob").to_pylist():
        names, sizes, raw = unpack(blob)
        at = 0
        for k, n in enumerate(np.frombuffer(sizes, dtype=np.int64).tolist()):
            files.setdefault(bytes(names[16 * k : 16 * k + 16]), raw[at : at + n])
            at += n
    shared = {r["file"]: r for r in right.select(["file", "borrowed", "lent"]).to_pylist()}
    media = [bytes(m) for m in files.values()]
    digests, sizes, owned, lends, borrows = [], [], [], [], []
    for name, m, ends in zip(files, media, chunk_ends(media), strict=True):
        own = shared.get(name)
        gone = set(own["borrowed"]) if own else ()
        parts = [m[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        digests.append([name_of(p) for p in parts])
        sizes.append([len(p) for p in parts])
        owned.append([None if k in gone else p for k, p in enumerate(parts)])
        lends.append(sorted(own["lent"]) if own else [])
        borrows.append(len(gone))
    return pa.table(
        {"file": pa.array(list(files), pa.binary()), "digests": pa.array(digests, pa.list_(pa.binary())), "sizes": pa.array(sizes, pa.list_(pa.int32())),
         "owned": pa.array(owned, pa.list_(pa.binary())), "lends": pa.array(lends, pa.list_(pa.int32())), "borrows": pa.array(borrows, pa.int32())}
    )


def index(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, file, chunks) of every row: the digests of its file and chunks."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(_digest_rows, "doc_id long, n_bytes long, file binary, chunks array<binary>")


#: Rows of one file beyond which one id alone sends it; in large inputs a thousandth of the rows.
FREQUENT = 10_000


def store(docs: DataFrame, digests: DataFrame, path: str, *, doc_id: str = "doc_id", text: str = "text", buckets: int | None = None) -> None:
    """Write the files of docs to path; digests is index(docs)."""
    files = cut(digests.groupBy("file").agg(F.first("chunks").alias("chunks"), F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("sender")))
    # A file of more than a thousandth of all rows is one of a thousand at most.
    total = files.agg(F.sum("n")).first()[0] or 0
    often = files.where((F.col("n") > max(FREQUENT, total // 1000)) & F.col("sender").isNotNull())
    senders = {bytes(r["file"]): r["sender"] for r in often.select("file", "sender").collect()}
    places = files.select("file", F.posexplode("chunks").alias("place", "digest"))
    owner = cut(places.groupBy("digest").agg(F.min(F.struct("file", "place")).alias("owner"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    if owner.count() <= BROADCAST_CHUNKS:
        owner = F.broadcast(owner)
    mine = (F.col("owner.file") == F.col("file")) & (F.col("owner.place") == F.col("place"))
    duties = places.join(owner, "digest").groupBy("file").agg(
        F.collect_list(F.when(~mine, F.col("place"))).alias("borrowed"), F.collect_list(F.when(mine, F.col("place"))).alias("lent")
    )
    buckets = buckets or groups_for(docs, text, 2 * BLOCK, least=8)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    sent = rows.mapInArrow(_send_bytes(buckets, senders), "bucket long, blob binary")
    duties = duties.withColumn("bucket", F.conv(F.substring(F.hex("file"), 1, 12), 16, 10).cast("long") % buckets)
    rows = sent.groupBy("bucket").cogroup(duties.groupBy("bucket")).applyInArrow(_store_rows, _STORE)
    rows.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", str(LEVEL)).parquet(path)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {k: [] for k in ("file", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")}
        for at in range(batch.num_rows):
            name, digests, owned, fetched = (batch.column(c)[at].as_py() for c in ("file", "digests", "owned", "fetched"))
            if fetched:
                got = {f["digest"]: f["bytes"] for f in fetched}
                owned = [got[d] if p is None else p for d, p in zip(digests, owned, strict=True)]
            for d, p in zip(digests, owned, strict=True):
                if p is None or name_of(p) != d:
                    raise ValueError(f"chunk {d.hex()} of file {name.hex()} is lost or damaged")
            media = b"".join(owned)
            if name_of(media) != name:
                raise ValueError(f"file {name.hex()} is damaged")
            x = samples_of(media)
            for k, v in zip(out, (name, len(x), hashlib.sha256(x).digest(), zlib.crc32(x[-32:]), len(media), hashlib.sha256(media).digest(), feature(x)), strict=True):
                out[k].append(v)
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.string() if k == "feature" else pa.int64() if k in ("payload_bytes", "tail_crc32", "media_bytes") else pa.binary()) for k, v in out.items()], names=list(out))


def read(stored: DataFrame) -> DataFrame:
    """Features of every stored file, computed from its bytes as they are read back."""
    lent = stored.where(F.size("lends") > 0).select(F.explode(F.transform("lends", lambda k: F.struct(F.get("digests", k).alias("digest"), F.get("owned", k).alias("bytes")))).alias("c")).select("c.*")
    needs = stored.where("borrows > 0")
    wanted = needs.select("file", F.explode(F.arrays_zip("digests", F.transform("owned", lambda p: p.isNull()).alias("gone"))).alias("c")).where("c.gone").select("file", F.col("c.digests").alias("digest")).distinct()
    fetched = wanted.join(lent, "digest").groupBy("file").agg(F.collect_list(F.struct("digest", "bytes")).alias("fetched"))
    whole = stored.where("borrows = 0").select("file", "digests", "owned", F.lit(None).cast("array<struct<digest:binary,bytes:binary>>").alias("fetched"))
    mended = needs.join(fetched, "file", "left").select("file", "digests", "owned", "fetched")
    return whole.union(mended).mapInArrow(_read_back, "file binary, payload_bytes long, payload_sha256 binary, tail_crc32 long, media_bytes long, media_sha256 binary, feature string")


def round_trip(docs: DataFrame, path: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Store docs at path, read them back and return a row for every row of docs."""
    digests = written(index(docs, doc_id=doc_id, text=text), "media-index")
    store(docs, digests, path, doc_id=doc_id, text=text)
    features = read(docs.sparkSession.read.parquet(path))
    hexed = {c: F.lower(F.hex(c)) for c in ("payload_sha256", "media_sha256")}
    return digests.select("doc_id", "n_bytes", "file").join(features, "file").drop("file").withColumns(hexed)


def op2_media_chunks(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return round_trip(docs, f"{shared_folder(spark).rstrip('/')}/media-{uuid.uuid4().hex}")
