"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so a question and its copy with
other numbers or names have one template. Windows of template tokens of benchmark and
documents meet in a hash join. Matches of one document and item on one diagonal
(document place minus item place) form an alignment; alignments on diagonals at most half
the item's length apart, as left by inserted or deleted tokens, add up from the largest on
while consistent. The values in the slots must be
consistent: one item value always stands for one document value, and one document value
for one item value. An alignment that covers `cover` of the item's windows is a leak:
exact if no slot differs, re-parameterised if slots differ consistently. Inconsistent
slots mean another text on the same pattern, and no leak.

Tokens are runs of letters and digits, a point or comma between digits included. A
token that starts with a digit is a number; a unit word right behind a number is a unit;
a capitalised token with small letters that starts no sentence is a name; others
count lower-cased. A second reading, matched apart from the first, takes a capitalised
token that starts a sentence for a name too, and has one placeholder for a run of names and
one for a run of numbers with the unit behind it. A
window needs `literal` tokens that are no placeholders. Items shorter than a window are
one window of their own length. An item with windows of fewer literal tokens (sums, tables
of values, lists of names) is matched in a third reading too, whose tokens are the words and
values themselves: its copies are found, not those with other values.

Items with one template whose slots repeat alike (the same question with other values)
are one class: what is consistent with one of them is with all. Documents meet only the
class's item of the smallest id, which stands for it in the result, so N items of one
template and M documents of it give M rows; classes() has the members. Kinds are told
against that item.

A row with a null id is not looked at and stays. Null and empty texts match nothing; texts of any length are handled whole. Ties are
broken by coverage, then place. Repeated rows give one result; an input column named
like an output column is not looked at. Empty tables give an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textblocks as tb
from .shared import cut, tidy, without_ids

BLOCK = 4 << 20
#: Benchmark windows up to which they are sent to the tasks: 2 MB of hashes, 50 MB of rows or so.
SENT_WINDOWS = 200_000
#: Unit words.
UNITS = (
    "%", "kg", "g", "mg", "t", "km", "m", "cm", "mm", "l", "ml", "s", "ms", "min", "h", "hz", "khz", "mhz", "w", "kw", "v", "mph", "kmh",
    "meter", "meters", "metre", "metres", "kilometers", "kilometres", "miles", "mile", "feet", "foot", "inches", "inch", "yards",
    "gram", "grams", "kilograms", "pounds", "pound", "ounces", "tons", "liters", "litres", "gallons", "cups",
    "seconds", "second", "minutes", "minute", "hours", "hour", "days", "day", "weeks", "week", "months", "month", "years", "year",
    "dollars", "dollar", "cents", "cent", "euros", "euro", "percent", "degrees", "degree",
)
NUMBER, NAME, UNIT = (np.uint64(x) for x in (0x6E756D62, 0x6E616D65, 0x756E6974))

_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = _ALNUM[128:] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?:\n"]] = True
_UNIT_HASHES = np.sort(tb.split(pa.array([" ".join(UNITS)])).hashes())


def _inside(buf: np.ndarray) -> np.ndarray:
    inside = _ALNUM[buf]
    if len(buf) > 2:
        digit = _DIGIT[buf]
        inside[1:-1] |= ((buf[1:-1] == 46) | (buf[1:-1] == 44)) & digit[:-2] & digit[2:]
    return inside


#: Ways to read a text: a placeholder a token, wide ones for runs, or no placeholders.
TOKENS, RUNS, RAW = 0, 1, 2


def template(texts: pa.Array) -> tuple[tb.Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts in their own spelling, template token hashes, which are slots,
    which are slots if words that start a sentence can be names, and lower-cased words' hashes."""
    buf, at = tb.flat(texts)
    words = tb.split_where(buf, at, _inside(buf))
    n = len(words.starts)
    # Lower case may change the length of a word, but not the number of words.
    low, low_at = tb.flat(pc.utf8_lower(texts.fill_null("")))
    h = tb.split_where(low, low_at, _inside(low)).hashes()
    if not n:
        return words, h, np.zeros(0, dtype=bool), np.zeros(0, dtype=bool), h
    first = buf[words.starts]
    number = _DIGIT[first]
    stops = np.cumsum(_STOP[buf], dtype=np.int64)[words.starts]
    begins = np.zeros(n, dtype=bool)
    begins[1:] = stops[1:] != stops[:-1]
    begins[words.offsets[:-1][words.counts > 0]] = True
    # Capitals: A-Z, and the two-byte ones from C3 80 to C3 9E.
    second = buf[np.minimum(words.starts + 1, len(buf) - 1)]
    capital = ((first >= 65) & (first <= 90)) | ((first == 0xC3) & (second >= 0x80) & (second <= 0x9E))
    # A small letter must follow: words in capitals throughout are no names.
    low_at = words.starts + np.where(first == 0xC3, 2, 1)
    inner = low_at < words.ends
    follow, after = (buf[np.minimum(low_at + d, len(buf) - 1)] for d in (0, 1))
    small = inner & (((follow >= 97) & (follow <= 122)) | ((follow == 0xC3) & (after >= 0xA0)))
    named = capital & small & ~number
    name = named & ~begins
    known = _UNIT_HASHES[np.minimum(np.searchsorted(_UNIT_HASHES, h), len(_UNIT_HASHES) - 1)] == h
    unit = np.zeros(n, dtype=bool)
    unit[1:] = known[1:] & number[:-1]
    unit[words.offsets[:-1][words.counts > 0]] = False
    typed = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, h)))
    return words, typed, number | name | unit, number | named | unit, h


@dataclass
class Reading:
    """Template tokens: hashes, which are slots, first and last word (inclusive), text."""

    h: np.ndarray
    slot: np.ndarray
    first: np.ndarray
    last: np.ndarray
    owner: np.ndarray
    offsets: np.ndarray


def readings(texts: pa.Array) -> tuple[tb.Words, list[Reading]]:
    words, h, slot, wide, raw = template(texts)
    each, owner = np.arange(len(h)), words.text_ids()
    out = [Reading(h, slot, each, each, owner, words.offsets)]
    kind = np.where(wide & ~slot, NAME, h)
    # A unit belongs to its number; words in a run have one space between them.
    joined = np.zeros(len(h), dtype=bool)
    close = (owner[1:] == owner[:-1]) & (words.starts[1:] == words.ends[:-1] + 1) & (words.buf[words.ends[:-1]] == 32) if len(h) else joined[1:]
    joined[1:] = wide[1:] & wide[:-1] & (close & (kind[1:] == kind[:-1]) & (kind[1:] != UNIT) | (kind[1:] == UNIT))
    first = np.flatnonzero(~joined)
    last = np.append(first[1:], len(h))[: len(first)] - 1
    offsets = np.searchsorted(first, words.offsets)
    out.append(Reading(kind[first], wide[first], first, last, owner[first], offsets))
    out.append(Reading(raw, np.zeros(len(raw), dtype=bool), each, each, owner, words.offsets))
    return words, out


def _windows(read: Reading, mode: int, k: int, literal: int) -> tuple[np.ndarray, np.ndarray]:
    """First tokens and hashes of the windows of k tokens with enough literal ones."""
    h, slot, owner = read.h, read.slot, read.owner
    if len(h) < k:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    plain = np.concatenate([[0], np.cumsum(~slot)])
    start = np.flatnonzero((owner[: len(h) - k + 1] == owner[k - 1 :]) & (plain[k:] - plain[:-k] >= min(literal, k)))
    return start, (tb.window_hashes(h, k) ^ np.uint64(k + 1024 * mode))[start]


def _slots(words: tb.Words, read: Reading, start: int, k: int) -> list[str]:
    """The values of the window's slots; a unit behind its number is told apart by a tab."""
    raw = words.buf
    out = []
    for t in range(start, start + k):
        if read.slot[t]:
            parts = [raw[words.starts[w] : words.ends[w]].tobytes().decode(errors="replace") for w in range(read.first[t], read.last[t] + 1)]
            unit = len(parts) > 1 and parts[0][0].isdigit() and not parts[-1][0].isdigit()
            out.append(" ".join(parts[:-1]) + "\t" + parts[-1] if unit else " ".join(parts))
    return out


def _items(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    return benchmark.select(F.col(f"`{item_id}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).where(F.col("id").isNotNull())


def _all_literal(read: Reading, k: int, literal: int) -> bool:
    """Whether every window of an item has enough literal tokens."""
    size = min(k, len(read.h))
    return size > 0 and len(_windows(read, TOKENS, size, literal)[0]) == len(read.h) - size + 1


def _named(k: int, literal: int):
    """(id, text, name): a digest of an item's template and of which slots share a value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = []
            for row in range(batch.num_rows):
                words, reads = readings(batch.column("text").slice(row, 1))
                made = hashlib.sha256()
                for read in reads[:RAW]:
                    seen: dict[str, int] = {}
                    pattern = [seen.setdefault(v.lower(), len(seen)) for v in _slots(words, read, 0, len(read.h))]
                    made.update(read.h.tobytes() + read.slot.tobytes() + np.array(pattern, dtype=np.int32).tobytes())
                if not _all_literal(reads[TOKENS], k, literal):
                    made.update(reads[RAW].h.tobytes())  # its own words and values are matched too
                names.append(made.digest()[:16])
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text"), pa.array(names, pa.binary())], names=["id", "text", "name"])

    return run


def classes(benchmark: DataFrame, *, item_id: str = "item_id", text: str = "text", k: int = 8, literal: int = 4) -> DataFrame:
    """(item_id, class_id) of every item: class_id is the smallest id of its class."""
    named = _items(benchmark, item_id, text).mapInArrow(_named(k, literal), "id long, text string, name binary").select("id", "name")
    return named.join(named.groupBy("name").agg(F.min("id").alias("class_id")), "name").select(F.col("id").alias("item_id"), "class_id").distinct()


_ROWS = "id long, hash long, mode int, place int, word int, size int, windows int, slots array<string>"
_NAMES = ["id", "hash", "mode", "place", "word", "size", "windows", "slots"]
_KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.string())]


def _item_rows(k: int, literal: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in _NAMES]
            for row in range(batch.num_rows):
                words, reads = readings(batch.column("text").slice(row, 1))
                for mode, read in enumerate(reads):
                    size = min(k, len(read.h))
                    if not size:
                        continue
                    start, hashes = _windows(read, mode, size, literal)
                    if mode == RAW and _all_literal(reads[TOKENS], k, literal):
                        continue
                    for p, x in zip(start.tolist(), hashes.view(np.int64).tolist(), strict=True):
                        for col, v in zip(out, (batch.column("id")[row].as_py(), x, mode, p, int(read.first[p]), size, len(start), _slots(words, read, p, size)), strict=True):
                            col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(out, _KINDS, strict=True)], names=_NAMES)

    return run


def _doc_rows(sizes: list[tuple[int, int]], literal: int, known):
    """Windows of the documents; known: sorted hashes of a broadcast that are worth a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = known.value if known is not None else None
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            for i, j in tb.blocks(batch.column("text"), BLOCK):
                words, reads = readings(batch.column("text").slice(i, j - i))
                out: list[list] = [[] for _ in _NAMES]
                for mode, size in sizes:
                    read = reads[mode]
                    start, hashes = _windows(read, mode, size, literal)
                    if wanted is not None:
                        at = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
                        hit = np.flatnonzero(wanted[at] == hashes) if len(wanted) else at[:0]
                        start, hashes = start[hit], hashes[hit]
                    text = read.owner[start]
                    out[0] += ids[i + text].tolist()
                    out[1] += hashes.view(np.int64).tolist()
                    out[2] += [mode] * len(start)
                    out[3] += (start - read.offsets[text]).tolist()
                    out[4] += (read.first[start] - words.offsets[text]).tolist()
                    out[5] += [size] * len(start)
                    out[6] += [0] * len(start)
                    out[7] += [_slots(words, read, p, size) for p in start.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(out, _KINDS, strict=True)], names=_NAMES)

    return run


def _consistent(pairs: set) -> bool:
    """One value for one value both ways, or no value changed."""
    return len({i for i, _ in pairs}) == len(pairs) == len({d for _, d in pairs}) or all(i == d for i, d in pairs)


def _values(pairs: list[dict]) -> set:
    """(item value, document value); a number and its unit count apart where both sides have a unit."""
    out = set()
    for p in pairs:
        i, d = p["i"].split("\t"), p["d"].split("\t")
        out |= set(zip(i, d, strict=True)) if len(i) == len(d) else {(" ".join(i), " ".join(d))}
    return out


_BEST = "doc_id long, item_id long, coverage double, n_slots int, n_changed int, place int"


def _judge(cover: float):
    """The best alignment of each document and item, near diagonals added up."""
    names = ["doc_id", "item_id", "coverage", "n_slots", "n_changed", "place"]
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32()]

    def best(windows: int, length: int, found: list[dict]):
        found = sorted(found, key=lambda f: f["diagonal"])
        at, tried = [f["diagonal"] for f in found], []
        pairs = [_values(f["pairs"]) for f in found]
        for k, seed in enumerate(found):
            lo, hi = bisect_left(at, at[k] - length // 2), bisect_right(at, at[k] + length // 2)
            if sum(len(found[j]["places"]) for j in range(lo, hi)) < cover * windows or not _consistent(pairs[k]):
                continue
            places, values, place = set(seed["places"]), pairs[k], seed["place"]
            tried.append((-len(places) / windows, sum(i != d for i, d in values), place, len(values)))
            for j in sorted(range(lo, hi), key=lambda j: (-len(found[j]["places"]), abs(at[j] - at[k]))):
                if len(places) == windows:
                    break
                if not places.issuperset(found[j]["places"]) and _consistent(values | pairs[j]):
                    places, values, place = places | set(found[j]["places"]), values | pairs[j], min(place, found[j]["place"])
            tried.append((-len(places) / windows, sum(i != d for i, d in values), place, len(values)))
        return min((x for x in tried if -x[0] >= cover), default=None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for row in range(batch.num_rows):
                r = {c: batch.column(c)[row].as_py() for c in ("doc_id", "item_id", "windows", "size", "found")}
                b = best(r["windows"], r["windows"] + r["size"] - 1, r["found"])
                if b:
                    for col, v in zip(out, (r["doc_id"], r["item_id"], -b[0], b[3], b[1], b[2]), strict=True):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(out, kinds, strict=True)], names=names)

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", k: int = 8, literal: int = 4, cover: float = 0.5) -> DataFrame:
    """(doc_id, item_id, kind, coverage, n_slots, n_changed, place) of each leaked class of items."""
    spark = docs.sparkSession
    named = _items(benchmark, item_id, "text").mapInArrow(_named(k, literal), "id long, text string, name binary")
    items = cut(named.groupBy("name").agg(F.min(F.struct("id", "text")).alias("first")).select("first.*").mapInArrow(_item_rows(k, literal), _ROWS))
    sizes = sorted((r["mode"], r["size"]) for r in items.select("mode", "size").distinct().collect())  # k at most
    n = items.count()
    known = None
    if n <= SENT_WINDOWS:
        got = items.select("hash").distinct().toPandas()["hash"].to_numpy(dtype=np.int64)
        known = spark.sparkContext.broadcast(np.sort(got.view(np.uint64)))
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")).where(F.col("id").isNotNull())
    found = rows.mapInArrow(tidy(_doc_rows(sizes, literal, known)), _ROWS).select(F.col("id").alias("doc_id"), "hash", F.col("place").alias("doc_place"), F.col("word"), F.col("slots").alias("doc_slots"))
    small = F.broadcast if n <= SENT_WINDOWS else (lambda df: df)
    side = items.select(F.col("id").alias("item_id"), "hash", "mode", "size", F.col("place").alias("item_place"), "windows", F.col("slots").alias("item_slots"))
    if known is None:
        found = found.join(side.select("hash").distinct(), "hash", "left_semi")
    found = cut(found)
    # A leak has ceil(cover * windows) places of an item, so one of any windows - that + 1 of them:
    # only an item's rarest so many fetch documents. A sentence that stands in front of many
    # items brings no document to all of them.
    common = Window.partitionBy("item_id", "mode").orderBy("n_items", "item_place")
    often = side.groupBy("hash").agg(F.count(F.lit(1)).alias("n_items"))
    rank = F.row_number().over(common)
    rarest = side.join(often, "hash").withColumn("rank", rank).where(F.col("rank") <= F.col("windows") - F.ceil(F.col("windows") * cover) + 1).select("hash", "item_id", "mode")
    candidates = found.select("doc_id", "hash").distinct().join(small(rarest), "hash").select("doc_id", "item_id", "mode").distinct()
    met = found.join(candidates, "doc_id").join(small(side), ["hash", "item_id", "mode"]).withColumn("diagonal", F.col("doc_place") - F.col("item_place"))
    pairs = F.transform(F.arrays_zip("item_slots", "doc_slots"), lambda s: F.struct(F.lower(s["item_slots"]).alias("i"), F.lower(s["doc_slots"]).alias("d")))
    # An alignment has as many windows as the item at most, so its sets are small.
    aligned = met.groupBy("doc_id", "item_id", "mode", "diagonal").agg(
        F.collect_set("item_place").alias("places"), F.max("windows").alias("windows"), F.max("size").alias("size"), F.min("word").alias("place"),
        F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"),
    )
    together = aligned.groupBy("doc_id", "item_id", "mode").agg(
        F.max("windows").alias("windows"), F.max("size").alias("size"), F.sum(F.size("places")).alias("n"), F.collect_list(F.struct("diagonal", "places", "place", "pairs")).alias("found")
    )
    judged = together.where(F.col("n") >= cover * F.col("windows")).drop("mode", "n").mapInArrow(tidy(_judge(cover)), _BEST)
    best = judged.groupBy("doc_id", "item_id").agg(F.min(F.struct(-F.col("coverage"), "n_changed", "place", "n_slots")).alias("b"))
    return best.select(
        "doc_id", "item_id", F.when(F.col("b.n_changed") == 0, "exact").otherwise("reparameterised").alias("kind"),
        (-F.col("b.col1")).alias("coverage"), "b.n_slots", "b.n_changed", "b.place",
    )


def reject(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """docs without those that leak a benchmark item; columns stay."""
    gone = cut(leaks(docs, benchmark, **how).select("doc_id").distinct())
    return without_ids(docs, gone, how.get("doc_id", "doc_id"))


def op3_template_leaks(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
