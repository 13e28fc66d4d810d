"""Language-model scores by a weighted backoff automaton over distributed counts.

Training counts of all n-grams up to `order` make the automaton. A state is a seen
history of at most order - 1 tokens. State s has an arc for each token w seen after
it, with weight log10 P(w | s), to the longest seen suffix of s w, and a failure arc to
its longest proper suffix, with weight log10(mu / (c(s) + mu)). Weights are
Dirichlet-smoothed,

    P(w | s) = (c(s w) + mu * P(w | suffix of s)) / (c(s) + mu),
    P(w)     = (c(w) + 1) / (N + V + 1),

so every state's distribution sums to one and counts are all that is gathered. The root
has an arc for every token; that of an unseen one leads back to it.

No task holds the model. A block of texts asks for the n-grams that it holds: each
distinct one goes, with its training count in the block, to the bucket of its hash;
buckets add up and answer each block. The block's tokens, as numbers, join the answers,
and the part of the automaton that the block can reach is built there: states, arcs and
failure arcs. It is traversed once from left to right: the state is carried from token to
token, fails until it has an arc, and the weights add up. The traversal runs over many
texts side by side, and over pieces of long ones: a piece starts order - 1 tokens early,
which is all that a state can remember. Frequent n-grams cost one entry a block, and
buckets grow in number with the input.

N-grams are told apart by 64-bit hashes. A bucket is a range of them, so the keys of a block
are in the order of buckets, and go there as small differences without losing a bit. A-Z is lower-cased, words
are runs without white space, and each text ends with an end token. Null and empty
texts hold just that. A row with a null id trains the model. Repeated rows count and
are scored each. docs is read twice and must give the same rows each time, as a
table does; where it doesn't, an error is raised. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblocks as tb
from .shared import groups_for, pack, tidy, unpack, written
from .toxicity import held_out

BLOCK = 4 << 20
CHUNK = 10 << 20
BUCKET_BYTES = 4 << 20
#: Tokens of a piece, the longest stretch that is traversed in one go.
PIECE = 512
#: Fixed values of this module's hashes: the end of a text and what stands before its start.
END, START = np.uint64(0x0E4D0E4D0E4D0E4D), np.uint64(0x57A9757A97757A97)


def _tokens(texts: pa.Array, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each with `pad` starts before and an end after, and
    where each text begins among them."""
    hashes, counts = [], []
    for i, j in tb.blocks(texts, BLOCK):
        words = tb.split(texts.slice(i, j - i), lower=True)
        hashes.append(words.hashes())
        counts.append(words.counts)
    n = np.concatenate(counts) if counts else np.zeros(0, dtype=np.int64)
    at = np.zeros(len(n) + 1, dtype=np.int64)
    np.cumsum(n + pad + 1, out=at[1:])
    out = np.full(int(at[-1]), START, dtype=np.uint64)
    out[at[1:] - 1] = END
    out[tb.ranges(at[:-1] + pad, n)] = np.concatenate(hashes) if hashes else []
    return out, at


class Grams:
    """The distinct n-grams of a block: keys in order, and the number of the key that ends
    at each token, -1 where too few tokens stand before it."""

    def __init__(self, tokens: np.ndarray, at: np.ndarray, order: int) -> None:
        self.keys: list[np.ndarray] = []
        self.number: list[np.ndarray] = []
        # What ends at the last start before a text is a history; before that nothing counts.
        self.counted = np.ones(len(tokens), dtype=bool)
        self.counted[tb.ranges(at[:-1], np.full(len(at) - 1, max(0, order - 2)))] = False
        for n in range(1, order + 1):
            keys = tb.window_hashes(tokens, n) ^ np.uint64(n) if n > 1 else tokens
            ends = tb.ranges(at[:-1] + n - 1, np.diff(at) - n + 1)
            distinct, number = np.unique(keys[ends - n + 1], return_inverse=True)
            every = np.full(len(tokens), -1, dtype=np.int32)
            every[ends] = number
            self.keys.append(distinct)
            self.number.append(every)

    def counts(self, trains: np.ndarray) -> list[np.ndarray]:
        """How often each n-gram ends at a place that trains."""
        return [np.bincount(x[trains & self.counted & (x >= 0)], minlength=len(k)) for k, x in zip(self.keys, self.number, strict=True)]


def _by_bucket(keys: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, where its keys begin, where they end) of sorted keys, for the buckets that occur."""
    if not len(keys):
        return []
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    return list(zip(bucket[first].tolist(), first.tolist(), [*first[1:].tolist(), len(keys)], strict=True))


def _squeeze(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte by byte: the high bytes are mostly zero."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unsqueeze(raw: memoryview) -> np.ndarray:
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).reshape(-1), dtype=np.uint64)


def _narrow(x: np.ndarray) -> bytes:
    """Numbers below 2**32, byte by byte."""
    return x.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()


def _wide(raw: memoryview) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(4, -1).T).view(np.uint32).reshape(-1).astype(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch], pad: int) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(name, rows, tokens, where texts begin) of the parts of a task's rows. The name is made
    of their place and tokens, so it is the same when the task reads the same rows again."""
    task, made = TaskContext.get().partitionId(), 0
    for batch in batches:
        for i, j in tb.blocks(batch.column("text"), CHUNK):
            part = batch.slice(i, j - i)
            tokens, at = _tokens(part.column("text"), pad)
            content = tb.mix(tokens).sum(dtype=np.uint64) + tb.mix(np.array([(task << 24) + made + 1], dtype=np.uint64))
            yield int(tb.mix(content).view(np.int64)[0]), part, tokens, at
            made += 1


def _trains(part: pa.RecordBatch, at: np.ndarray) -> np.ndarray:
    return np.repeat(part.column("trains").to_numpy(zero_copy_only=False).astype(bool), np.diff(at))


def _ask(order: int, buckets: int):
    """(chunk, bucket, blob): the n-grams of a chunk and their training counts, to their buckets."""
    schema = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("blob", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, part, tokens, at in _chunks(batches, order - 1):
            grams = Grams(tokens, at, order)
            blobs: dict[int, list[bytes]] = {}
            for n, (keys, counts) in enumerate(zip(grams.keys, grams.counts(_trains(part, at)), strict=True)):
                for b, i, j in _by_bucket(keys, buckets):
                    blobs.setdefault(b, [b""] * (2 * order))[2 * n : 2 * n + 2] = _squeeze(keys[i:j]), _narrow(counts[i:j])
            yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(blobs), pa.int64()), pa.array(list(blobs), pa.int64()), pa.array([pack(*x) for x in blobs.values()], pa.binary())], schema=schema)

    return run


def _send(order: int):
    """(chunk, blob): a chunk's rows as numbers of their tokens, low ones for frequent tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, part, tokens, at in _chunks(batches, order - 1):
            distinct, number, counts = np.unique(tokens, return_inverse=True, return_counts=True)
            rank = np.empty(len(distinct), dtype=np.int64)
            rank[np.argsort(-counts, kind="stable")] = np.arange(len(distinct))
            ids = part.column("doc_id").cast(pa.int64())
            plain = (ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False), part.column("trains").to_numpy(zero_copy_only=False).astype(bool), at)
            yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([pack(*plain, _squeeze(distinct), _narrow(rank[number]), _narrow(counts))], pa.binary())], names=["chunk", "blob"])

    return run


def _opened(blobs: list[bytes]) -> list[list[tuple[np.ndarray, np.ndarray]]]:
    """(keys, counts) by blob and order."""
    parts = [unpack(b) for b in blobs]
    return [[(_unsqueeze(k), _wide(c)) for k, c in zip(p[::2], p[1::2], strict=True)] for p in parts]


def _sums(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The distinct keys, the sum of each, and for each part the sums of its keys."""
    distinct, number = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    total = np.bincount(number, weights=np.concatenate([c for _, c in found]).astype(float), minlength=len(distinct)).astype(np.int64)
    return distinct, total, np.split(total[number], np.cumsum([len(k) for k, _ in found])[:-1])


_ANSWERS = "chunk long, bucket long, blob binary, n long, v long"


def _answer(table: pa.Table) -> pa.Table:
    """The corpus counts of the n-grams that each chunk asked a bucket for, and in a row without
    a chunk the occurrences and distinct tokens of the bucket's training tokens."""
    opened = _opened(table.column("blob").to_pylist())
    sums = [_sums([x[n] for x in opened]) for n in range(len(opened[0]))]
    blobs = [pack(*(answers[k].view(np.uint8).reshape(-1, 8).T.tobytes() for _, _, answers in sums)) for k in range(len(opened))]
    # The start before a text is a history, no token.
    tokens, none = sums[0][1][sums[0][0] != START], [None] * len(blobs)
    columns = {"chunk": [*table.column("chunk").to_pylist(), None], "bucket": [*table.column("bucket").to_pylist(), None], "n": [*none, int(tokens.sum())], "v": [*none, int((tokens > 0).sum())]}
    out = {c: pa.array(v, pa.int64()) for c, v in columns.items()}
    return pa.table({"chunk": out["chunk"], "bucket": out["bucket"], "blob": pa.array([*blobs, None], pa.binary()), "n": out["n"], "v": out["v"]})


class Automaton:
    """States, arcs and failure arcs of the n-grams of a block.

    State 0 is the root, the others are the seen n-grams below the order. Each seen n-gram is
    an arc: from the state of its history on its last token. The arcs of a state of k tokens
    are among the n-grams of k + 1, whose numbers by place the block knows: that is how the
    arc of a state and the next token is found."""

    def __init__(self, grams: Grams, counts: list[np.ndarray], n: int, v: int, mu: float) -> None:
        order = len(counts)
        name, total = [], 1  # of the state of each n-gram, 0: no such state
        for c in counts[:-1]:
            seen = np.flatnonzero(c > 0)
            name.append(np.zeros(len(c), dtype=np.int64))
            name[-1][seen] = total + np.arange(len(seen))
            total += len(seen)
        # All n-grams in one row of arcs, those of each order from `base` on.
        self.base = np.cumsum([0, *[len(c) for c in counts]])
        self.number = grams.number
        self.length = np.zeros(total, dtype=np.int64)
        self.fails_to, self.fail_weight = np.zeros(total, dtype=np.int64), np.zeros(total)
        prob = (counts[0] + 1.0) / (n + v + 1.0)
        weights, targets, seens = [np.log10(prob)], [name[0] if order > 1 else np.zeros(len(prob), dtype=np.int64)], [np.ones(len(prob), dtype=bool)]
        for k in range(1, order):
            end = np.zeros(len(counts[k]), dtype=np.int64)  # a place where each n-gram ends
            place = np.flatnonzero(grams.number[k] >= 0)
            end[grams.number[k][place]] = place
            history, suffix = grams.number[k - 1][end - 1], grams.number[k - 1][end]
            c = counts[k - 1][history]
            prob = np.where(c > 0, (counts[k] + mu * prob[suffix]) / (c + mu), prob[suffix])
            weights.append(np.log10(prob))
            seens.append(counts[k] > 0)
            targets.append(name[k] if k + 1 < order else name[k - 1][suffix])
            if k + 1 < order:
                s = np.flatnonzero(name[k])
                self.fails_to[name[k][s]] = name[k - 1][suffix[s]]
        for k, states in enumerate(name):
            s = np.flatnonzero(states)
            self.length[states[s]] = k + 1
            self.fail_weight[states[s]] = np.log10(mu / (counts[k][s] + mu))
        self.weight, self.to, self.has = np.concatenate(weights), np.concatenate(targets), np.concatenate(seens)

    def step(self, state: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after reading the tokens at the places, each in its state, and the weights."""
        cost, left = np.zeros(len(state)), np.arange(len(state))
        to, state = np.zeros(len(state), dtype=np.int64), state.copy()
        while len(left):
            length = self.length[state[left]]
            arc = np.empty(len(left), dtype=np.int64)
            for k, number in enumerate(self.number):
                of = np.flatnonzero(length == k)
                arc[of] = self.base[k] + number[place[left[of]]]
            has = self.has[arc]
            cost[left[has]] += self.weight[arc[has]]
            to[left[has]] = self.to[arc[has]]
            left = left[~has]
            cost[left] += self.fail_weight[state[left]]
            state[left] = self.fails_to[state[left]]
        return to, cost

    def traverse(self, at: np.ndarray, pad: int) -> np.ndarray:
        """log10 P of every text: at tells where it begins, `pad` starts before its tokens."""
        size = np.diff(at) - pad
        pieces = np.maximum(1, -(-size // PIECE))
        owner = np.repeat(np.arange(len(size)), pieces)
        within = tb.ranges(np.zeros(len(size), dtype=np.int64), pieces) * PIECE
        length = np.minimum(PIECE, size[owner] - within)
        by = np.argsort(-length, kind="stable")
        owner, begin, length = owner[by], (at[:-1][owner] + within)[by], length[by]
        state, score = np.zeros(len(by), dtype=np.int64), np.zeros(len(by))
        for t in range(int(length[0]) + pad if len(length) else 0):
            n = len(length) if t < pad else int(np.searchsorted(-length, pad - t, side="left"))
            state[:n], cost = self.step(state[:n], begin[:n] + t)
            if t >= pad:
                score[:n] += cost
        return np.bincount(owner, weights=score, minlength=len(size))


def _score(order: int, buckets: int, n: int, v: int, mu: float):
    def run(table: pa.Table, sent: pa.Table) -> pa.Table:
        if sent.num_rows != 1 or not table.num_rows:
            raise ValueError("docs gave other rows when it was read again; write it to a table first")
        own, answers = unpack(sent.column("blob")[0].as_py()), {}
        for bucket, blob in zip(table.column("bucket").to_pylist(), table.column("blob").to_pylist(), strict=True):
            answers[bucket] = [np.ascontiguousarray(np.frombuffer(p, dtype=np.uint8).reshape(8, -1).T).view(np.int64).reshape(-1) for p in unpack(blob)]
        del table, sent
        ids, no_id, trains, at = (np.frombuffer(p, dtype=t) for p, t in zip(own[:4], (np.int64, bool, bool, np.int64), strict=True))
        tokens = _unsqueeze(own[4])[np.argsort(-_wide(own[6]), kind="stable")][_wide(own[5])] if len(own[5]) else np.zeros(0, dtype=np.uint64)
        grams, pad, counts = Grams(tokens, at, order), order - 1, []
        for k, keys in enumerate(grams.keys):
            c = np.zeros(len(keys), dtype=np.int64)
            for b, i, j in _by_bucket(keys, buckets):
                c[i:j] = answers[b][k]
            counts.append(c)
        real = tb.ranges(at[:-1] + pad, np.diff(at) - pad)
        seen = counts[0][grams.number[0][real]]
        cut, size = np.searchsorted(real, at[:-1]), np.diff(at) - pad
        add = lambda x: np.add.reduceat(x, cut) if len(cut) else np.zeros(0)
        base = add(np.log10(seen + 1.0)) - size * np.log10(n + v + 1.0)
        del tokens, answers, own
        score = Automaton(grams, counts, n, v, mu).traverse(at, pad)
        pa.default_memory_pool().release_unused()
        return pa.table({"doc_id": pa.array(ids, mask=no_id), "held_out": ~trains, "n_tokens": pa.array(size), "n_known": pa.array(add((seen > 0).astype(np.int64)), pa.int64()), "base_score": base, "score": score})

    return run


def score(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", trains: F.Column | None = None, order: int = 3, mu: float = 64.0, buckets: int | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every
    row of docs. trains says which rows train the model (all where not given)."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"), (F.lit(True) if trains is None else trains).alias("trains"))
    buckets = buckets or groups_for(rows, "text", BUCKET_BYTES, least=8)
    asked = rows.mapInArrow(tidy(_ask(order, buckets)), "chunk long, bucket long, blob binary")
    # In the shared folder: the sizes of the corpus are known before the first text is scored.
    answers = written(asked.groupBy("bucket").applyInArrow(_answer, _ANSWERS), "answers")
    n, v = answers.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    answered = answers.where(F.col("chunk").isNotNull()).select("chunk", "bucket", "blob")
    sent = rows.mapInArrow(tidy(_send(order)), "chunk long, blob binary")
    scored = answered.groupBy("chunk").cogroup(sent.groupBy("chunk")).applyInArrow(_score(order, buckets, int(n), int(v), mu), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(n)).cast("long").alias("train_tokens"), "base_score", "score")


def op5_backoff_automaton(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score(docs, trains=~held_out(parts=7))
