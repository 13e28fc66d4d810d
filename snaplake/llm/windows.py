"""Exact removal of word windows that repeat across documents, by super-k-mers.

A window is k consecutive words of one document. It is repeated if its word
sequence also starts in a document with a smaller id; every word that a repeated
window covers goes. Windows are judged on the input, not on what is left.

Each window has a minimiser: the smallest hash among its runs of m words.
Consecutive windows with one minimiser (a super-k-mer) overlap in all but one word,
so they travel together as one packed string to the bucket of the minimiser. There
all windows are cut out again and sorted, which brings equal windows together.

A task first judges the windows of its own block and sends only those that no
smaller id of the block has, so a passage in a third of all documents reaches its
bucket once a block. With salts > 1 a bucket is judged in that many parts before
the survivors meet.

Buckets grow in number with the input, not in size: a first pass counts the windows of
every bucket, and where a frequent run of words as minimiser makes one larger than
`most` windows, its windows go by a longer minimiser instead (2 m + 1 words), and where
that is too frequent as well, each by itself as a whole. Equal windows take equal
decisions, so they still meet. What can't be split is one window repeated, and that is
sent once a block.

Equality of windows is that of two 64-bit hashes of their words that share no table. Null
and empty texts have no words; texts of any length are handled whole. A row with a
null id neither removes nor loses words. Equal rows, and rows that share an id, never
remove each other's words. Input columns named like an output column are replaced.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblocks as tb
from .shared import fields, fresh, groups_for, pack, tidy, unpack, without

BLOCK = 4 << 20
#: Text bytes whose super-k-mers share a bucket; packed they are about three times that.
BUCKET_BYTES = 6 << 20
#: Compression level of the packed strings, which are most of what is shuffled.
LEVEL = 7
#: Windows of a bucket beyond which it is split, about four times those of BUCKET_BYTES of prose.
MOST_WINDOWS = 4_000_000


def _lanes(words: tb.Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    return tb.window_hashes(words.hashes(), k), tb.window_hashes(words.hashes(lane=1), k)


def _repeated(one: np.ndarray, two: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """True for each window whose equals include one with a smaller id."""
    if not len(one):
        return np.zeros(0, dtype=bool)
    order = np.argsort(one, kind="stable")
    a, b = one[order], two[order]
    if ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():
        order = np.lexsort((two, one))
        a, b = one[order], two[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = np.flatnonzero(new)
    sorted_ids = ids[order]
    least = np.repeat(np.minimum.reduceat(sorted_ids, first), np.diff(np.append(first, len(a))))
    out = np.empty(len(a), dtype=bool)
    out[order] = sorted_ids > least
    return out


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[:-step], x[step:])
        done += step
    return x


def _breaks(places: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of neighbouring places that agree in all of same."""
    if not len(places):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    new = np.ones(len(places), dtype=bool)
    new[1:] = places[1:] != places[:-1] + 1
    for s in same:
        new[1:] |= s[1:] != s[:-1]
    first = np.flatnonzero(new)
    return first, np.append(first[1:], len(places)) - 1


def _blob_rows(bucket, runs, strings, spans) -> tuple[list[int], list[bytes]]:
    """A blob for each bucket that has runs; the spans found so far ride with the first."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1])) if len(order) else np.zeros(0, dtype=np.int64)
    keys, blobs, left = [], [], spans
    none = tuple(x[:0] for x in spans)
    for a, b in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
        part = order[a:b]
        texts = [strings[i] for i in part.tolist()]
        lens = np.array([len(t) for t in texts], dtype=np.int32)
        keys.append(int(bucket[part[0]]))
        blobs.append(pack(*(r[part] for r in runs), lens, b"".join(texts), *left, level=LEVEL))
        left = none
    if len(left[0]):
        keys.append(0)
        blobs.append(pack(*(r[:0] for r in runs), np.zeros(0, dtype=np.int32), b"", *left))
    return keys, blobs


def _spans(where: np.ndarray, owner: np.ndarray, ids: np.ndarray, rows: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """(id, row, first window, windows) of each run of neighbouring windows of one owner."""
    first, last = _breaks(where, owner)
    o = owner[first]
    return ids[o], rows[o], at[first].astype(np.int32), (last - first + 1).astype(np.int32)


def _keys(h: np.ndarray, k: int, m: int, starts: np.ndarray) -> np.ndarray:
    """The least hash of m neighbouring words in each of the windows of k words at starts."""
    return _sliding_min(tb.window_hashes(h, m), k - m + 1)[starts]


def _widths(k: int, m: int) -> list[int]:
    """Words of the minimisers that are tried in turn; the last is the window itself."""
    return [m, *([2 * m + 1] if 2 * m + 1 < k else []), *([k] if m < k else [])]


def _inner(words: tb.Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of the windows that lie in one text, and their texts."""
    owner = words.text_ids()
    if len(owner) < k:
        return np.zeros(0, dtype=np.int64), owner[:0]
    starts = np.flatnonzero(owner[: len(owner) - k + 1] == owner[k - 1 :])
    return starts, owner[starts]


def _sizes(k: int, m: int, buckets: int):
    """(bucket, n): windows of a block by the buckets of all minimisers but the last; those of
    the second width are numbered from `buckets` on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in tb.blocks(batch.column("text"), BLOCK):
                words = tb.split(batch.column("text").slice(i, j - i))
                starts, h = _inner(words, k)[0], words.hashes()
                found = [_keys(h, k, w, starts) % np.uint64(buckets) + np.uint64(lap * buckets) for lap, w in enumerate(_widths(k, m)[:-1])] if len(starts) else []
                bucket, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int64)), pa.array(n.astype(np.int64))], names=["bucket", "n"])

    return run


def large_buckets(docs: DataFrame, k: int, m: int, buckets: int, most: int) -> list[int]:
    """Buckets of more than most windows: no more than twice the corpus's windows / most, with
    the default 8 bytes for two million windows."""
    counted = docs.select("text").mapInArrow(_sizes(k, m, buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    return sorted(r["bucket"] for r in counted.where(F.col("n") > most).select("bucket").collect())


def _send(k: int, m: int, buckets: int, large: list[int]):
    schema = pa.schema([("bucket", pa.int64()), ("blob", pa.binary())])
    split = np.array(large, dtype=np.int64)

    def key_and_bucket(h: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What neighbouring windows share that travel together, and where they go."""
        key = np.zeros(len(starts), dtype=np.uint64)
        bucket, left = np.zeros(len(starts), dtype=np.int64), np.arange(len(starts))
        for lap, width in enumerate(_widths(k, m)):
            key[left] = _keys(h, k, width, starts[left])
            bucket[left] = (key[left] % np.uint64(buckets)).astype(np.int64) + lap * buckets
            left = left[np.isin(bucket[left], split)] if len(split) else left[:0]
            if not len(left):
                break
        return key, bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in tb.blocks(batch.column("text"), BLOCK):
                part = batch.slice(i, j - i)
                ids, rows = (part.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("id", "row"))
                words = tb.split(part.column("text"))
                starts, owner = _inner(words, k)
                if not len(starts):
                    continue
                one, two = (x[starts] for x in _lanes(words, k))
                gone = _repeated(one, two, ids[owner])
                at = starts - words.offsets[owner]
                spans = _spans(starts[gone], owner[gone], ids, rows, at[gone])
                stay, at, owner = starts[~gone], at[~gone], owner[~gone]
                key, bucket = key_and_bucket(words.hashes(), stay)
                first, last = _breaks(stay, owner, key, bucket)
                o = owner[first]
                strings = words.packed(stay[first], stay[last] + k - 1)[1]
                keys, blobs = _blob_rows(bucket[first], (ids[o], rows[o], at[first].astype(np.int32), (last - first + 1).astype(np.int32)), strings, spans)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(blobs, pa.binary())], schema=schema)

    return run


def _open(blob: bytes) -> tuple[list[np.ndarray], np.ndarray, memoryview, list[np.ndarray]]:
    kinds = (np.int64, np.int64, np.int32, np.int32)
    parts = unpack(blob)
    runs = [np.frombuffer(p, dtype=t) for p, t in zip(parts[:4], kinds, strict=True)]
    spans = [np.frombuffer(p, dtype=t) for p, t in zip(parts[6:], kinds, strict=True)]
    return runs, np.frombuffer(parts[4], dtype=np.int32), parts[5], spans


def _judge(k: int, *, last_round: bool):
    """The windows of one bucket: spans of the repeated ones, and before the last round
    the others packed anew."""

    def run(table: pa.Table) -> pa.Table:
        runs, lens, raw, spans = zip(*(_open(b) for b in table.column("blob").to_pylist()), strict=True)
        ids, rows, at, n = (np.concatenate([r[c] for r in runs]) for c in range(4))
        found = [tuple(s) for s in spans]
        sizes = np.concatenate(lens).astype(np.int64)
        place = np.zeros(len(sizes) + 1, dtype=np.int64)
        np.cumsum(sizes, out=place[1:])
        text = b"".join(raw)
        ones, twos, kept_words = [], [], []
        i = 0
        while i < len(sizes):
            j = max(i + 1, int(np.searchsorted(place, place[i] + BLOCK, side="right")) - 1)
            offsets = (place[i : j + 1] - place[i]).astype(np.int64)
            part = pa.LargeStringArray.from_buffers(j - i, pa.py_buffer(offsets.tobytes()), pa.py_buffer(text[place[i] : place[j]]))
            words = tb.split(part)
            one, two = _lanes(words, k)
            starts = tb.ranges(words.offsets[:-1], n[i:j].astype(np.int64))
            ones.append(one[starts])
            twos.append(two[starts])
            if not last_round:
                kept_words.append((words, starts))
            i = j
        if ones:
            owner = np.repeat(np.arange(len(ids)), n)
            within = tb.ranges(np.zeros(len(n), dtype=np.int64), n.astype(np.int64))
            gone = _repeated(np.concatenate(ones), np.concatenate(twos), ids[owner])
            where = np.flatnonzero(gone)
            found.append(_spans(where, owner[where], ids, rows, (at[owner] + within)[where]))
        spans = tuple(np.concatenate([f[c] for f in found]) for c in range(4))
        if last_round:
            return pa.table({"id": spans[0], "row": spans[1], "start": spans[2], "n": spans[3]})
        bucket = table.column("bucket")[0].as_py()
        pieces, strings, done = [], [], 0
        for words, starts in kept_words:
            stay = np.flatnonzero(~gone[done : done + len(starts)])
            own = owner[done + stay]
            first, last = _breaks(stay, own)
            strings += words.packed(starts[stay[first]], starts[stay[last]] + k - 1)[1]
            o = own[first]
            pieces.append((ids[o], rows[o], (at[o] + within[done + stay[first]]).astype(np.int32), (last - first + 1).astype(np.int32)))
            done += len(starts)
        again = tuple(np.concatenate([p[c] for p in pieces]) for c in range(4)) if pieces else (ids, rows, at, n)
        keys, blobs = _blob_rows(np.full(len(strings), bucket, dtype=np.int64), again, strings, spans)
        return pa.table({"bucket": pa.array(keys, pa.int64()), "blob": pa.array(blobs, pa.binary())})

    return run


def repeated_spans(docs: DataFrame, *, k: int = 13, minimiser: int = 3, buckets: int | None = None, salts: int | None = None, most: int = MOST_WINDOWS) -> DataFrame:
    """(id, row, start, n) for docs(id, row, text): n windows from word `start` on are repeated.

    buckets: grows with the input where not given. salts: parts in which a bucket is
    judged first, so that a passage of every block comes to its last group once a part; one for
    a thousand blocks where not given.
    most: windows beyond which a bucket is split."""
    if not 1 <= minimiser <= k:
        raise ValueError("a minimiser has 1 to k words")
    docs = docs.where(F.col("id").isNotNull())
    buckets = buckets or groups_for(docs, "text", BUCKET_BYTES, least=8)
    salts = salts or groups_for(docs, "text", 1000 * BLOCK)
    sent = docs.mapInArrow(tidy(_send(k, minimiser, buckets, large_buckets(docs, k, minimiser, buckets, most))), "bucket long, blob binary")
    if salts > 1:
        sent = (
            sent.withColumn("salt", F.spark_partition_id() % salts).groupBy("bucket", "salt")
            .applyInArrow(_judge(k, last_round=False), "bucket long, blob binary")
        )
    return sent.groupBy("bucket").applyInArrow(_judge(k, last_round=True), "id long, row long, start int, n int")


def _kept(k: int, names: list[str]):
    """The rows with their columns `names`, from those, the text and the spans in this order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in tb.blocks(batch.column(len(names)), BLOCK):
                part = batch.slice(i, j - i)
                words = tb.split(part.column(len(names)))
                spans = part.column(len(names) + 1).fill_null([])
                values = spans.flatten()
                owner = np.repeat(np.arange(j - i), spans.value_lengths().to_numpy(zero_copy_only=False))
                start, n = (values.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (0, 1))
                edge = np.zeros(len(words.starts) + 1, dtype=np.int64)
                first = words.offsets[owner] + start
                np.add.at(edge, first, 1)
                np.add.at(edge, first + n + k - 1, -1)
                gone = np.cumsum(edge[:-1]) > 0
                flat, at, end = words.joined()
                texts = []
                for a, b in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist(), strict=True):
                    if a == b:
                        texts.append(b"")
                    elif not (lost := gone[a:b]).any():
                        texts.append(flat[at[a] : end[b - 1]])
                    else:
                        x, y = _breaks(np.flatnonzero(~lost) + a)
                        stay = np.flatnonzero(~lost) + a
                        texts.append(b" ".join([flat[p:q] for p, q in zip(at[stay[x]].tolist(), end[stay[y]].tolist(), strict=True)]))
                lost_words = np.concatenate([[0], np.cumsum(gone)])
                removed = lost_words[words.offsets[1:]] - lost_words[words.offsets[:-1]]
                kept = pa.array(texts, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], pa.array(words.counts), pa.array(removed), kept], names=[*names, "n_words", "n_removed", "kept"])

    return run


def remove_repeated(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", k: int = 13, minimiser: int = 3, buckets: int | None = None, salts: int | None = None, most: int = MOST_WINDOWS) -> DataFrame:
    """docs without its text column but with n_words, n_removed (long) and kept: the
    words that stay, joined by one space."""
    rest = without(docs, text, "n_words", "n_removed", "kept")
    names = rest.columns
    # Rows are told apart by their texts only where ids repeat: a hash does not compress.
    repeats = not docs.groupBy(f"`{doc_id}`").count().where("count > 1").isEmpty()
    own = fresh(docs, "id", "row", "text", "spans")
    rows = docs.select(
        *[F.col(f"`{c}`") for c in names], F.col(f"`{doc_id}`").cast("long").alias(own["id"]), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(own["text"]),
        (F.xxhash64(f"`{text}`") if repeats else F.lit(0).cast("long")).alias(own["row"]),
    )
    spans = repeated_spans(rows.select(F.col(own["id"]).alias("id"), F.col(own["row"]).alias("row"), F.col(own["text"]).alias("text")), k=k, minimiser=minimiser, buckets=buckets, salts=salts, most=most)
    by_row = spans.groupBy(F.col("id").alias(own["id"]), F.col("row").alias(own["row"])).agg(F.collect_list(F.struct("start", "n")).alias(own["spans"]))
    joined = rows.join(by_row.hint("shuffle_hash"), [own["id"], own["row"]], "left").select(*[f"`{c}`" for c in names], own["text"], own["spans"])
    return joined.mapInArrow(_kept(k, names), f"{fields(rest)}, n_words long, n_removed long, kept string".lstrip(", "))


def op4_superkmer_repeats(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeated(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
