"""Best-fit packing of tokenised documents with vector capacities.

A document's tokens end with an end token. Longer documents than a sequence are cut
into pieces of the full length, of which the last may be shorter; others stay whole.
A full piece is a sequence. The rest are dealt by hash into shards of about
`shard_pieces`, which grow in number with the input, and each shard packs its pieces,
longest first: a bin has a residual of tokens, of documents and of attention cost (the
sum of squared lengths), and a piece goes to the feasible bin with the best score,
either the smallest weighted residual norm after placing or the largest weighted dot
product of piece and residual. A new bin opens only where none is feasible. A shard
wastes about a bin, one in thousands.

White space separates words before the tokenizer's own rules, and so does a stop behind
a letter, so a block is tokenised by its distinct parts, and a worker remembers theirs. Null and empty texts are the end token alone; texts of any
length are handled whole. Ties are broken by id and piece; repeated rows are packed
each. Input columns beside id and text are not looked at. An empty table gives an
empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblocks as tb
from .shared import cut, tidy

BLOCK = 6 << 20
#: Words whose tokens a worker remembers.
REMEMBERED = 1_000_000
#: Stands between words when many are encoded as one string: a token of its own.
MARK = "\x01"
_STOPS = np.zeros(256, dtype=bool)
_STOPS[[ord(c) for c in ".,!?;:"]] = True
_PLAIN = np.zeros(256, dtype=bool)
_PLAIN[48:58] = _PLAIN[65:91] = _PLAIN[97:123] = True
_vocabularies: dict[str, _Vocabulary] = {}


class _Vocabulary:
    """A tokenizer and the tokens of the words that this worker has met."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 and self._encode(f"a {MARK} b").tolist() == [*self._encode("a"), mark[0], *self._encode("b")] else None
        self.forget()

    def forget(self) -> None:
        self.keys, self.begin, self.size = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one after another, and how many each has."""
        ids, sizes = [], []
        for lo in range(0, len(words), 2_000):
            part = words[lo : lo + 2_000]
            text = b" \x01 ".join(part)
            if self.mark is None or text.count(b"\x01") != len(part) - 1:
                each = [self._encode(w.decode()) for w in part]
            else:
                got = self._encode(text.decode())
                cut = np.flatnonzero(got == self.mark)
                ids.append(got[got != self.mark])
                sizes.append(np.diff(np.concatenate([[-1], cut, [len(got)]])) - 1)
                continue
            ids += each
            sizes.append(np.array([len(e) for e in each], dtype=np.int64))
        return np.concatenate(ids) if ids else self.ids[:0], np.concatenate(sizes) if sizes else self.size[:0]

    def look_up(self, distinct: np.ndarray, word: Callable[[np.ndarray], list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Where in ids the tokens of the distinct hashes begin, and how many they are.
        word gives the spelling of the hashes at some places."""
        if len(self.keys) > REMEMBERED:
            self.forget()
        at = np.searchsorted(self.keys, distinct)
        new = np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] != distinct) if len(self.keys) else np.arange(len(distinct))
        if len(new):
            ids, size = self._encode_words(word(new))
            begin = len(self.ids) + np.cumsum(size) - size
            self.ids = np.concatenate([self.ids, ids])
            to = np.searchsorted(self.keys, distinct[new])
            self.keys, self.begin, self.size = np.insert(self.keys, to, distinct[new]), np.insert(self.begin, to, begin), np.insert(self.size, to, size)
            at = np.searchsorted(self.keys, distinct)
        return self.begin[at], self.size[at]


def _parts(texts: pa.Array) -> tb.Words:
    """Parts of the texts that are tokenised alone: what white space separates, cut again
    where a stop or comma follows a letter or digit, A-Z lower-cased as the tokenizer does
    it (but not where a special token may stand)."""
    buf, at = tb.flat(texts)
    if b"<|" not in buf.tobytes():
        buf = tb.lowered(buf)
    stop = np.flatnonzero(_STOPS[buf])
    stop = stop[stop > 1]
    one, two = buf[stop - 1], buf[stop - 2]
    letter = _PLAIN[one] | ((two == 0xC3) & (one >= 0x80) & (one != 0x97) & (one != 0xB7))
    return tb.split_where(buf, at, tb.not_white(buf), stop[letter])


def _word_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """All token ids of the texts, one text after another, and how many each has."""
    if path not in _vocabularies:
        _vocabularies[path] = _Vocabulary(path)
    vocabulary = _vocabularies[path]
    words = _parts(texts)
    distinct, first, number = np.unique(words.hashes(), return_index=True, return_inverse=True)
    raw = words.buf.tobytes()

    def spelling(places: np.ndarray) -> list[bytes]:
        at = first[places]
        return [raw[a:b] for a, b in zip(words.starts[at].tolist(), words.ends[at].tolist(), strict=True)]

    begin, size = vocabulary.look_up(distinct, spelling)
    ids = vocabulary.ids[tb.ranges(begin[number], size[number])]
    total = np.concatenate([[0], np.cumsum(size[number])])
    return ids, total[words.offsets[1:]] - total[words.offsets[:-1]]


def _piece_rows(path: str, capacity: int, end_id: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in tb.blocks(batch.column("text"), BLOCK):
                part = batch.slice(i, j - i)
                ids, n = _word_ids(part.column("text"), path)
                at = np.concatenate([[0], np.cumsum(n + 1)])
                tokens = np.full(int(at[-1]), end_id, dtype=np.uint32)
                tokens[tb.ranges(at[:-1], n)] = ids
                pieces = -(-(n + 1) // capacity)
                owner = np.repeat(np.arange(len(n)), pieces)
                piece = tb.ranges(np.zeros(len(n), dtype=np.int64), pieces)
                start = piece * capacity
                length = np.minimum(capacity, (n + 1)[owner] - start)
                view = memoryview(tokens.astype("<u4").tobytes())
                begin = (at[:-1][owner] + start).tolist()
                crc = [zlib.crc32(view[4 * a : 4 * (a + k)]) for a, k in zip(begin, length.tolist(), strict=True)]
                cols = [part.column("doc_id").take(pa.array(owner)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    offsets = np.append(begin, at[-1]).astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def tokenised(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", capacity: int = 2048, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every piece, and its ids if wanted."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return rows.mapInArrow(tidy(_piece_rows(tokenizer, capacity, end_id, keep_ids)), schema)


def fit_bins(length: np.ndarray, limits: np.ndarray, weights: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each piece and its offset there; pieces come longest first."""
    needs = np.stack([length, np.ones_like(length), length * length], axis=1).astype(float)
    left = np.zeros((len(length), 3))
    bins = np.zeros(len(length), dtype=np.int64)
    offsets = np.zeros(len(length), dtype=np.int64)
    # Bins with room for some piece to come, by number.
    live, made, shortest = np.zeros(0, dtype=np.int64), 0, needs.min(axis=0) if len(needs) else None
    scale = weights / limits**2
    for k, need in enumerate(needs):
        room = left[live]
        fits = np.flatnonzero((room >= need).all(axis=1))
        if len(fits):
            good = room[fits]
            score = ((good - need) ** 2) @ scale if rule == "norm" else -(good * need) @ scale
            b = int(live[fits[np.argmin(score)]])
        else:
            b, made = made, made + 1
            left[b] = limits
            live = np.append(live, b)
        bins[k], offsets[k] = b, int(limits[0] - left[b, 0])
        left[b] -= need
        if (left[b] < shortest).any():
            live = live[live != b]
    return bins, offsets


def _pack(limits: np.ndarray, weights: np.ndarray, rule: str):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        bins, offsets = fit_bins(table.column("length").to_numpy(), limits, weights, rule)
        shard = table.column("shard")[0].as_py()
        return table.drop_columns(["shard"]).append_column("sequence_id", pa.array(bins + (shard << 32))).append_column("offset", pa.array(offsets))

    return run


def pack_pieces(
    pieces: DataFrame,
    *,
    capacity: int = 2048,
    most_documents: int | None = None,
    most_cost: int | None = None,
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01),
    rule: str = "norm",
    shard_pieces: int = 8192,
) -> DataFrame:
    """pieces with sequence_id and offset. most_documents and most_cost (squared tokens)
    bound a sequence beside its tokens; without them they never bind. rule: norm or dot."""
    if rule not in ("norm", "dot"):
        raise ValueError("rule is norm or dot")
    limits = np.array([capacity, most_documents or capacity, most_cost or capacity**2], dtype=float)
    if limits[2] < capacity**2:
        raise ValueError("a full piece costs capacity squared; pieces must fit a bin alone")
    pieces = cut(pieces)
    full = pieces.where(F.col("length") == capacity).withColumns({"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    rest = pieces.where(F.col("length") < capacity)
    shards = max(1, -(-rest.count() // shard_pieces))
    rest = rest.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(shards)))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    packed = rest.groupBy("shard").applyInArrow(_pack(limits, np.array(weights), rule), f"{fields}, sequence_id long, offset long")
    return full.union(packed)


def pack(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", capacity: int = 2048, end_id: int = 0, **how) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for docs(doc_id, text)."""
    return pack_pieces(tokenised(docs, tokenizer, doc_id=doc_id, text=text, capacity=capacity, end_id=end_id), capacity=capacity, **how)


def word_tokenizer() -> str:
    """The place of the installed 49k word tokenizer."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op9_vector_best_fit(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(docs, word_tokenizer())
