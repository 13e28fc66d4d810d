"""SimHash near-duplicate groups by covering locality-sensitive hashing.

A fingerprint has a bit set where over half the shingle hashes have it. Two texts
link if their fingerprints differ in at most `radius` bits. Table v of the
2**(radius + 1) - 1 tables keeps the bits i with an odd number of common ones in v
and m(i), for vectors m(i) of radius + 1 bits. At most `radius` differing bits span
less than all dimensions, so some v is orthogonal to all of theirs: that table masks
them all away, and the pair surely meets there. No link is lost.

Equal fingerprints are one node before any table is built, so a bucket holds distinct
fingerprints: at most the points of a Hamming ball for a group of near copies, 8 bytes
each, however many rows the group has. Inside a bucket a breadth-first search compares
with fingerprints not reached yet and emits a spanning forest, never all pairs.

Near copies by similarity (`most_bits`) take two steps. Distinct shingles of few words
(`meet_shingle`) make the fingerprints whose tables bring candidates together: a changed
word spoils only that many of them, so near copies differ in few of these bits. Where whole
blocks were moved, added or replaced this is too few, so `bands` of `band_rows` min-hashes of
the wanted shingles are tables as well: a pair of similarity s shares one of them with
probability 1 - (1 - s**band_rows)**bands, whatever was changed. The fingerprints of the
wanted shingles, carried along, then judge every pair that meets.

Words are runs without white space, A-Z lower-cased. A text with fewer words than a
shingle has its whole sequence as shingle; one without words (null, empty) has the
fingerprint zero and links like any other. Texts of any length are handled whole.
Repeated rows share a component; the component's name is its smallest id. A null id
counts as no id: its row gets the smallest id that it reaches. Input columns named
like an output column are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblocks as tb
from .components import components
from .shared import cut, pack, tidy, unpack, without_ids

BLOCK = 4 << 20
SEED = 42


def covering_masks(radius: int, bits: int = 64) -> np.ndarray:
    """2**(radius + 1) - 1 masks such that any `radius` bits are zero in one of them."""
    every = np.arange(1, 2 ** (radius + 1))
    vectors = np.resize(np.random.default_rng(7).permutation(every), bits)
    odd = np.bitwise_count(vectors[None, :] & every[:, None]) & 1
    return (odd.astype(np.uint64) << np.arange(bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def _shingle_hashes(words: tb.Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle of every text, and how many each text has."""
    flat, at, end = words.joined()
    n = words.counts
    shingles = np.where(n == 0, 0, np.maximum(1, n - k + 1))
    first = tb.ranges(words.offsets[:-1], shingles)
    last = np.minimum(first + k - 1, np.repeat(words.offsets[1:], shingles) - 1)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(flat[a:b], SEED) for a, b in zip(at[first].tolist(), end[last].tolist(), strict=True)), dtype=np.uint64, count=len(first)), shingles


def _windows(words: tb.Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of the words of every shingle of every text, and how many each text has."""
    h, n = words.hashes(), words.counts
    shingles = np.where(n == 0, 0, np.maximum(1, n - k + 1))
    first, owner = tb.ranges(words.offsets[:-1], shingles), np.repeat(np.arange(len(n)), shingles)
    values, size = np.zeros(len(first), dtype=np.uint64), np.minimum(n, k)[owner]
    for width in range(1, k + 1):
        at = np.flatnonzero(size == width)
        values[at] = tb.window_hashes(h, width)[first[at]] if len(at) else 0
    return values, shingles


def _distinct_shingles(words: tb.Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every distinct shingle of every text, and how many each text has."""
    values, n = _windows(words, k)
    owner = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.append(True, (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])) if len(values) else np.zeros(0, dtype=bool)
    return values[new], np.bincount(owner[new], minlength=len(n))


def _bands(h: np.ndarray, n: np.ndarray, bands: int, rows: int) -> list[np.ndarray]:
    """For each run of n hashes `bands` keys of `rows` min-hashes each; zero where there are none."""
    full = np.flatnonzero(n)
    starts = (np.cumsum(n) - n)[full]
    seeds = np.random.default_rng(13).integers(1, 2**63, bands * rows, dtype=np.uint64)
    out = []
    for band in range(bands):
        key = np.zeros(len(n), dtype=np.uint64)
        for seed in seeds[band * rows : (band + 1) * rows]:
            if len(full):
                key[full] = tb.mix(key[full] ^ np.minimum.reduceat(tb.mix(h ^ seed), starts))
        out.append(key)
    return out


def _majority(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For each run of n hashes the bits set in over half of them."""
    out = np.zeros(len(n), dtype=np.uint64)
    full = np.flatnonzero(n)
    if not len(full):
        return out
    # Eight byte-wide counters in a word count up to 255 hashes at once.
    starts = np.cumsum(n) - n
    parts = -(-n[full] // 255)
    owner = np.repeat(np.arange(len(full)), parts)
    cuts = starts[full][owner] + 255 * tb.ranges(np.zeros(len(full), dtype=np.int64), parts)
    ones = np.uint64(0x0101010101010101)
    first = np.cumsum(parts) - parts
    for bit in range(8):
        lanes = np.add.reduceat((h >> np.uint64(bit)) & ones, cuts).view(np.uint8).reshape(-1, 8)
        counts = np.add.reduceat(lanes.astype(np.int64), first, axis=0)
        over = (2 * counts > n[full][:, None]).astype(np.uint64)
        out[full] |= (over << (np.arange(8, dtype=np.uint64) * np.uint64(8) + np.uint64(bit))).sum(axis=1, dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, prints: int = 1, meet_shingle: int = 2, meet_prints: int = 0, bands: int = 0, band_rows: int = 3) -> DataFrame:
    """(doc_id, prints array<long>): `meet_prints` independent fingerprints of the distinct
    shingles of meet_shingle words, `bands` keys of min-hashes of all shingles, then `prints`
    fingerprints of these, of every row."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("prints", pa.list_(pa.int64()))])
    seeds = np.random.default_rng(11).integers(1, 2**63, meet_prints + prints, dtype=np.uint64)
    total = meet_prints + bands + prints

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in tb.blocks(batch.column("text"), BLOCK):
                part = batch.slice(i, j - i)
                words = tb.split(part.column("text"), lower=True)
                each = []
                if meet_prints:
                    h, n = _distinct_shingles(words, meet_shingle)
                    each = [_majority(tb.mix(h ^ seeds[prints + k]), n) for k in range(meet_prints)]
                if bands:
                    each += _bands(*_windows(words, shingle), bands, band_rows)
                h, n = _shingle_hashes(words, shingle)
                each += [_majority(h if not k else tb.mix(h ^ seeds[k]), n) for k in range(prints)]
                values = pa.array(np.stack(each, axis=1).reshape(-1).view(np.int64))
                offsets = pa.array(np.arange(0, total * (j - i) + 1, total, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.ListArray.from_arrays(offsets, values)], schema=schema)

    return rows.mapInArrow(tidy(run), "doc_id long, prints array<long>")


def _to_buckets(masks: np.ndarray, prints: int, buckets: int):
    schema = pa.schema([("bucket", pa.int64()), ("blob", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                ids = part.column("id").to_numpy(zero_copy_only=False)
                values = part.column("prints").flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, prints)
                table = np.repeat(np.arange(prints * len(masks), dtype=np.uint16), len(ids))
                fp = np.repeat(values.T, len(masks), axis=0).reshape(-1)
                key = tb.mix((fp & masks[table % len(masks)]) ^ tb.mix(table.astype(np.uint64) + np.uint64(1)))
                yield _split(key % np.uint64(buckets), schema, table, fp, np.tile(ids, prints * len(masks)))

    return run


def _forest(fp: np.ndarray, ids: np.ndarray, radius: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """A spanning forest of the links among distinct fingerprints."""
    a, b = [], []
    left, left_ids = fp, ids
    while len(left):
        queue = [(left[0], left_ids[0])]
        left, left_ids = left[1:], left_ids[1:]
        while queue and len(left):
            x, name = queue.pop()
            near = np.bitwise_count(left ^ x) <= radius
            if near.any():
                queue += zip(left[near], left_ids[near], strict=True)
                a.append(np.full(int(near.sum()), name))
                b.append(left_ids[near])
                left, left_ids = left[~near], left_ids[~near]
    return a, b


def _links(masks: np.ndarray, radius: int):
    def run(table: pa.Table) -> pa.Table:
        parts = [unpack(x) for x in table.column("blob").to_pylist()]
        t, fp, ids = (np.concatenate([np.frombuffer(p[c], dtype=kind) for p in parts]) for c, kind in enumerate((np.uint16, np.uint64, np.int64)))
        key = fp & masks[t % len(masks)]
        order = np.lexsort((ids, key, t))
        t, fp, ids, key = t[order], fp[order], ids[order], key[order]
        new = np.ones(len(t), dtype=bool)
        new[1:] = (t[1:] != t[:-1]) | (key[1:] != key[:-1])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(t)))
        two = first[size == 2]
        two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= radius]
        a, b = [ids[two]], [ids[two + 1]]
        for i, n in zip(first[size > 2].tolist(), size[size > 2].tolist(), strict=True):
            x, y = _forest(fp[i : i + n], ids[i : i + n], radius)
            a += x
            b += y
        pairs = np.unique(np.sort(np.stack([np.concatenate(a), np.concatenate(b)], axis=1), axis=1), axis=0)
        return pa.table({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})

    return run


def links(nodes: DataFrame, *, radius: int = 4, prints: int = 1, buckets: int | None = None) -> DataFrame:
    """(a, b): a spanning set of the links among nodes(id, prints), whose prints differ
    from node to node. A pair links if one of its prints is within radius."""
    masks = covering_masks(radius)
    # About 400 000 (table, fingerprint) entries a bucket.
    buckets = buckets or max(8, -(-nodes.count() * len(masks) * prints // 400_000))
    sent = nodes.select("id", "prints").mapInArrow(tidy(_to_buckets(masks, prints, buckets)), "bucket long, blob binary")
    return sent.groupBy("bucket").applyInArrow(_links(masks, radius), "a long, b long").distinct()


def _to_meet(masks: np.ndarray, prints: int, bands: int, buckets: int):
    """As _to_buckets for the first `prints` fingerprints and the `bands` keys behind them, with 32 bits
    of the key in place of table and fingerprint."""
    schema = pa.schema([("bucket", pa.int64()), ("blob", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                ids = part.column("id").to_numpy(zero_copy_only=False)
                values = part.column("prints").flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(ids), -1)
                table = np.repeat(np.arange(prints * len(masks) + bands, dtype=np.uint16), len(ids))
                fp = np.repeat(values[:, :prints].T, len(masks), axis=0).reshape(-1) & masks[table[: prints * len(masks) * len(ids)] % len(masks)]
                fp = np.concatenate([fp, values[:, prints : prints + bands].T.reshape(-1)])
                key = tb.mix(fp ^ tb.mix(table.astype(np.uint64) + np.uint64(1)))
                yield _split(key % np.uint64(buckets), schema, (key >> np.uint64(32)).astype(np.uint32), np.tile(ids, prints * len(masks) + bands))

    return run


def _runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal keys starts, and where the last one ends behind them."""
    first = np.flatnonzero(np.append(True, sorted_keys[1:] != sorted_keys[:-1])) if len(sorted_keys) else np.zeros(0, dtype=np.int64)
    return first, np.append(first, len(sorted_keys))


def _split(to: np.ndarray, schema: pa.Schema, *columns: np.ndarray) -> pa.RecordBatch:
    """A blob of the columns for each part that gets any."""
    order = np.argsort(to, kind="stable")
    first, cuts = _runs(to[order])
    blobs = [pack(*(c[o] for c in columns)) for o in (order[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()))]
    return pa.RecordBatch.from_arrays([pa.array(to[order[first]].astype(np.int64), pa.int64()), pa.array(blobs, pa.binary())], schema=schema)


def _columns(table: pa.Table, *kinds) -> list[np.ndarray]:
    parts = [unpack(x) for x in table.column("blob").to_pylist()]
    return [np.concatenate([np.frombuffer(p[c], dtype=kind) for p in parts]) for c, kind in enumerate(kinds)]


def _salted(ids: np.ndarray) -> np.ndarray:
    return tb.mix(ids.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


def _parted(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = _salted(batch.column("id").to_numpy(zero_copy_only=False)) % np.uint64(parts)
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int64)), *batch.columns], names=["part", "id", "prints"])

    return run


def _meetings(parts: int):
    """(part, blob): the sets of nodes that meet in a bucket, each once, by parts of nodes."""
    schema = pa.schema([("part", pa.int64()), ("blob", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        key, ids = _columns(table, np.uint32, np.int64)
        order = np.lexsort((ids, key))
        key, ids = key[order], ids[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(first, len(key)))
        # A set is named by its members, so it is one set in whatever tables it meets.
        name = tb.mix(np.add.reduceat(_salted(ids), first))
        many = np.flatnonzero(size > 1)
        many = many[np.unique(name[many], return_index=True)[1]]
        at = tb.ranges(first[many], size[many])
        name, ids = np.repeat(name[many], size[many]), ids[at]
        return pa.Table.from_batches([_split(_salted(ids) % np.uint64(parts), schema, name, ids)])

    return run


def _carry(skip: int, buckets: int):
    """(bucket, blob): the members of the sets with the fingerprints that judge them, all but the first `skip`, by sets."""
    schema = pa.schema([("bucket", pa.int64()), ("blob", pa.binary())])

    def run(nodes: pa.Table, met: pa.Table) -> pa.Table:
        if not met.num_rows or not nodes.num_rows:
            return schema.empty_table()
        known = nodes.column("id").to_numpy()
        values = nodes.column("prints").combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(known), -1)[:, skip:]
        order = np.argsort(known, kind="stable")
        known, values = known[order], values[order]
        name, ids = _columns(met, np.uint64, np.int64)
        order = np.lexsort((ids, name))
        name, ids = name[order], ids[order]
        new = np.append(True, (name[1:] != name[:-1]) | (ids[1:] != ids[:-1]))
        name, ids = name[new], ids[new]
        # Several rows of one id may have different texts.
        low = np.searchsorted(known, ids)
        rows = np.searchsorted(known, ids, side="right") - low
        at, name = tb.ranges(low, rows), np.repeat(name, rows)
        bucket = name % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        first, cuts = _runs(bucket[order])
        found = bucket[order[first]].astype(np.int64)
        blobs = []
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            o = order[lo:hi]
            used, row = np.unique(at[o], return_inverse=True)
            blobs.append(pack(name[o], row.astype(np.int32), known[used], values[used]))
        return pa.table({"bucket": pa.array(found, pa.int64()), "blob": pa.array(blobs, pa.binary())})

    return run


def _merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node of each node's component once the links a-b are added."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (root[root] != root).any():
            root = root[root]


def _spanning(values: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links, of at most `most` differing bits, among rows of prints."""
    a, b = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    left = np.arange(len(values))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(values[left] ^ values[x]).sum(axis=1, dtype=np.int64) <= most
            if near.any():
                queue += left[near].tolist()
                a.append(np.full(int(near.sum()), x))
                b.append(left[near])
                left = left[~near]
    return np.concatenate(a), np.concatenate(b)


def _judged(prints: int, most: int):
    """Judges every pair of each set; links each node to the least id that it reaches in the bucket."""

    def run(table: pa.Table) -> pa.Table:
        parts = [unpack(x) for x in table.column("blob").to_pylist()]
        name, row, ids, values = ([np.frombuffer(p[c], dtype=kind) for p in parts] for c, kind in enumerate((np.uint64, np.int32, np.int64, np.uint64)))
        start = np.cumsum([0, *[len(i) for i in ids]])
        row = np.concatenate([r + s for r, s in zip(row, start[:-1].tolist(), strict=True)]).astype(np.int64)
        name, ids, values = np.concatenate(name), np.concatenate(ids), np.concatenate(values).reshape(-1, prints)
        order = np.argsort(name, kind="stable")
        name, row = name[order], row[order]
        first = np.flatnonzero(np.append(True, name[1:] != name[:-1]))
        size = np.diff(np.append(first, len(name)))
        root = np.arange(len(ids))
        # Pairs of small sets are judged side by side, larger sets are searched: the links are the same.
        for n in range(2, 17):
            sets = first[size == n]
            i, j = np.triu_indices(n, 1)
            for lo in range(0, len(sets), 100_000 // len(i) + 1):
                member = row[sets[lo : lo + 100_000 // len(i) + 1, None] + np.arange(n)]
                a, b = member[:, i].reshape(-1), member[:, j].reshape(-1)
                good = root[a] != root[b]
                a, b = a[good], b[good]
                good = np.bitwise_count(values[a] ^ values[b]).sum(axis=1, dtype=np.int64) <= most
                root = _merge(root, a[good], b[good])
        for i, n in zip(first[size > 16].tolist(), size[size > 16].tolist(), strict=True):
            member = row[i : i + n]
            if (root[member] != root[member[0]]).any():
                a, b = _spanning(values[member], most)
                root = _merge(root, member[a], member[b])
        least = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(least, root, ids)
        least = least[root]
        far = least != ids
        return pa.table({"a": pa.array(least[far], pa.int64()), "b": pa.array(ids[far], pa.int64())})

    return run


def judged_links(nodes: DataFrame, *, radius: int, meet_prints: int, most_bits: int, bands: int = 0, buckets: int | None = None) -> DataFrame:
    """(a, b): pairs with the components of all links among nodes(id, prints). Every pair that
    meets in a table of its first meet_prints prints, or in one of the bands behind them, is
    judged; it links if at most most_bits of the bits of its other prints differ.

    Three steps: short keys tell which nodes meet in a table; their prints are added to those
    alone; and each set of nodes, named by its members, is judged where it comes together."""
    masks = covering_masks(radius)
    first = nodes.agg(F.count(F.lit(1)), F.max(F.size("prints"))).first()
    meets = meet_prints + bands
    n, judges = first[0], (first[1] or meets) - meets
    buckets = buckets or max(8, -(-n * (len(masks) * meet_prints + bands) // 400_000))
    parts = max(8, -(-n // 4096))
    sent = nodes.select("id", "prints").mapInArrow(tidy(_to_meet(masks, meet_prints, bands, buckets)), "bucket long, blob binary")
    met = sent.groupBy("bucket").applyInArrow(_meetings(parts), "part long, blob binary")
    rows = nodes.select("id", "prints").mapInArrow(tidy(_parted(parts)), "part long, id long, prints array<long>")
    carried = rows.groupBy("part").cogroup(met.groupBy("part")).applyInArrow(_carry(meets, buckets), "bucket long, blob binary")
    return carried.groupBy("bucket").applyInArrow(_judged(judges, most_bits), "a long, b long").distinct()


#: Copies of a fingerprint beyond which its name is broadcast; in large inputs a thousandth of the rows.
FREQUENT = 10_000


def group(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 4,
    radius: int = 4,
    prints: int = 1,
    meet_shingle: int = 2,
    meet_prints: int = 0,
    bands: int = 0,
    band_rows: int = 3,
    most_bits: int | None = None,
) -> DataFrame:
    """(doc_id, prints, component_id) for every row of docs.

    Without most_bits two rows link if one of their prints is within radius. With it every
    pair that meets by one of meet_prints fingerprints within radius (and maybe others), or by
    one of the bands, links if at most most_bits bits of its prints differ altogether."""
    rows = cut(fingerprints(docs, doc_id=doc_id, text=text, shingle=shingle, prints=prints, meet_shingle=meet_shingle, meet_prints=meet_prints, bands=bands, band_rows=band_rows))
    nodes = cut(rows.groupBy("prints").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies")))
    known = nodes.where(F.col("id").isNotNull())
    found = links(known, radius=radius, prints=prints) if most_bits is None else judged_links(known, radius=radius, meet_prints=meet_prints, bands=bands, most_bits=most_bits)
    roots = components(found)
    named = nodes.join(roots, "id", "left").select("prints", "copies", F.coalesce("root", "id").alias("component_id"))
    # Fingerprints of more than a thousandth of all rows are a thousand at most: their names are
    # broadcast, so that a large group of copies is no hot key of the join.
    frequent = F.col("copies") > max(FREQUENT, (nodes.agg(F.sum("copies")).first()[0] or 0) // 1000)
    most = F.broadcast(named.where(frequent).select("prints", F.col("component_id").alias("most_id")))
    told = rows.join(most, "prints", "left")
    rest = told.where(F.col("most_id").isNull()).drop("most_id").join(named.where(~frequent).drop("copies"), "prints")
    return told.where(F.col("most_id").isNotNull()).select("doc_id", "prints", F.col("most_id").alias("component_id")).unionByName(rest)


def keep_one(
    docs: DataFrame,
    *,
    shingle: int = 5,
    radius: int = 5,
    prints: int = 16,
    most_bits: int = 169,
    meet_shingle: int = 2,
    meet_prints: int = 4,
    bands: int = 10,
    band_rows: int = 3,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """docs without near copies: of every group the smallest doc_id stays; columns stay.

    The default is for a Jaccard similarity of 0.8 on shingles of five words. The 1 024 bits
    that judge then differ with probability acos(0.889) / pi = 0.152, with a deviation of
    0.011; a pair links up to 0.165. It meets in one of ten bands with probability
    0.9992 at 0.80 and 0.9999 at 0.85, and besides in the tables of the fingerprints. Of repeated
    rows with one id all stay or go together."""
    named = group(docs, doc_id=doc_id, text=text, shingle=shingle, radius=radius, prints=prints, meet_shingle=meet_shingle, meet_prints=meet_prints, bands=bands, band_rows=band_rows, most_bits=most_bits)
    gone = cut(named.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct())
    return without_ids(docs, gone, doc_id)


def op8_simhash_components(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return group(docs).select("doc_id", F.lpad(F.lower(F.hex(F.col("prints")[0])), 16, "0").alias("fingerprint"), "component_id")
