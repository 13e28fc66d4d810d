"""Toxicity by multiple-instance learning.

A document is a bag of sentences of which only the bag has a label. Sentence i
offends with probability p_i = sigmoid(bias + sum of the weights of its words),
and the document is toxic with the noisy-or

    P = 1 - (1 - leak) * prod(1 - p_i).

Weights and leak are fitted to document labels alone; afterwards p_i says which
sentences offend. The vocabulary comes from Spark aggregates over the labelled
texts; the likelihood is maximised on a bounded sample of them (max_labelled),
whose few matching words are all that reaches the driver. Scoring is one pass
without any shuffle.

Words are runs of letters (A-Z lower-cased); features are words and word
beginnings of 3 to 8 bytes. Sentences end at . ! ? or a line
end. Null and empty texts have no sentence and score the leak. Repeated rows are
scored each; ties do not occur. An input column named like an output column is
replaced by it. An empty table gives an empty result; without any usable label
the model knows no words and every text scores the leak.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblocks as tb
from .shared import as_batch, fields, fresh, tidy, without

BLOCK = 4 << 20
#: A sentence without any known word offends with about 6e-6.
BIAS = -12.0
#: Bytes of the word beginnings that are features beside the whole words: inflected forms share them.
STEMS = (3, 4, 5, 6, 7, 8)


@dataclass(frozen=True)
class ToxicityModel:
    """Sorted word hashes, their weights and the leak; at most `vocabulary` words."""

    words: np.ndarray
    weights: np.ndarray
    leak: float
    bias: float = BIAS


def _features(words: tb.Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, hashes) of the whole words, then of the stems of each length in STEMS."""
    size = words.ends - words.starts
    out = [(np.arange(len(size)), words.hashes())]
    for k in STEMS:
        at = np.flatnonzero(size > k)
        stems = tb.Words(words.buf, words.starts[at], words.starts[at] + k, words.offsets, words.text_offsets)
        out.append((at, stems.hashes() ^ np.uint64(k)))
    return out


def _known(words: tb.Words, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words with a feature that the vocabulary has, and its number there."""
    places, numbers = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    if len(vocabulary) and len(words.starts):
        # A small table of the low bits spares most words the search.
        seen = np.zeros(1 << 16, dtype=bool)
        seen[(vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True
        for at, h in _features(words):
            maybe = np.flatnonzero(seen[(h & np.uint64(0xFFFF)).astype(np.int64)])
            found = np.minimum(np.searchsorted(vocabulary, h[maybe]), len(vocabulary) - 1)
            hit = vocabulary[found] == h[maybe]
            places.append(at[maybe[hit]])
            numbers.append(found[hit])
    return np.concatenate(places), np.concatenate(numbers)


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, clean, kin): a row for each distinct feature of a toxic text with its kin,
    and one for each feature of a block's other texts with their number.

    kin is the text's smallest hash of three neighbouring words, which near copies
    mostly share."""
    schema = pa.schema([("word", pa.int64()), ("clean", pa.int64()), ("kin", pa.int64())])
    for batch in batches:
        texts, toxic = batch.column("text"), batch.column("toxic").to_numpy(zero_copy_only=False)
        for i, j in tb.blocks(texts, BLOCK):
            words = tb.split(texts.slice(i, j - i), lower=True, letters=True)
            found = _features(words)
            whole, ids = found[0][1], words.text_ids()
            kin = np.zeros(j - i, dtype=np.uint64)
            if len(three := tb.window_hashes(np.concatenate([whole, whole[:2]]), 3)):
                full = np.flatnonzero(words.counts)
                kin[full] = np.minimum.reduceat(three, words.offsets[full])
            h, ids = np.concatenate([x for _, x in found]), np.concatenate([ids[at] for at, _ in found])
            order = np.lexsort((h, ids))
            h, ids = h[order], ids[order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = (h[1:] != h[:-1]) | (ids[1:] != ids[:-1])
            h, ids = h[new], ids[new]
            bad = toxic[i:j][ids] > 0
            clean, n = np.unique(h[~bad], return_counts=True)
            yield as_batch({"word": np.concatenate([h[bad], clean]).view(np.int64), "clean": np.concatenate([np.zeros(bad.sum(), dtype=np.int64), n]), "kin": pa.array(np.concatenate([kin[ids[bad]], clean]).view(np.int64), mask=np.arange(bad.sum() + len(clean)) >= bad.sum())}, schema)


def _bag_rows(vocabulary: np.ndarray):
    """(toxic, bag): for each text the pairs of sentence and vocabulary number."""
    schema = pa.schema([("toxic", pa.int32()), ("bag", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, toxic = batch.column("text"), batch.column("toxic").to_numpy(zero_copy_only=False)
            for i, j in tb.blocks(texts, BLOCK):
                words = tb.split(texts.slice(i, j - i), lower=True, letters=True)
                hit, number = _known(words, vocabulary)
                sentence, ids = tb.sentence_ids(words)[hit], words.text_ids()[hit]
                both = np.unique(np.stack([ids, sentence, number], axis=1), axis=0) if len(hit) else np.zeros((0, 3), dtype=np.int64)
                cuts = np.searchsorted(both[:, 0], np.arange(j - i + 1))
                bags = [both[a:b, 1:].reshape(-1).tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield as_batch({"toxic": toxic[i:j], "bag": bags}, schema)

    return run


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    max_labelled: int = 20_000,
    vocabulary: int = 2_048,
    min_texts: int = 3,
    evidence: float = 16.0,
    ridge: float = 0.02,
    rounds: int = 400,
) -> ToxicityModel:
    """Fit to labels(doc_id, toxic) of docs(doc_id, text).

    max_labelled bounds the labelled rows that are used (those with the smallest
    hash of doc_id), and so the labels that are broadcast. Equal texts count once.
    A feature enters the vocabulary if it occurs in min_texts toxic texts, where near
    copies count once, and its log-likelihood ratio against chance is `evidence` nats
    or more (16: about one chance feature among millions).
    """
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    )
    sample = (
        docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy(F.sha2("text", 256).alias("digest")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
        .select("text", "toxic")
    ).persist()
    totals = {int(r["toxic"]): int(r["n"]) for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = totals.get(1, 0), sum(v for k, v in totals.items() if k < 1)
    if not n1 or not n0:
        sample.unpersist()
        return ToxicityModel(np.zeros(0, dtype=np.uint64), np.zeros(0), min(max((n1 + 0.5) / (n1 + n0 + 1), 1e-4), 0.25))
    counts = sample.mapInArrow(_word_rows, "word long, clean long, kin long").groupBy("word").agg(
        F.count_distinct("kin").alias("k1"), F.sum("clean").alias("k0")
    )
    share = n1 / (n1 + n0)
    k1, k0 = F.col("k1").cast("double"), F.col("k0").cast("double")
    gain = k1 * F.log(k1 / ((k1 + k0) * share)) + F.when(k0 > 0, k0 * F.log(k0 / ((k1 + k0) * (1 - share)))).otherwise(0.0)
    top = (
        counts.where((k1 >= min_texts) & (k1 / (k1 + k0) > share)).withColumn("gain", gain).where(F.col("gain") >= evidence)
        .orderBy(F.desc("gain"), "word").limit(vocabulary).select("word").collect()
    )
    known = np.sort(np.array([r["word"] for r in top], dtype=np.int64).view(np.uint64))
    rows = sample.mapInArrow(_bag_rows(known), "toxic int, bag array<int>").groupBy("toxic", "bag").agg(F.count(F.lit(1)).alias("n")).orderBy("toxic", "bag").collect()
    sample.unpersist()
    return _maximise(known, [(int(r["toxic"]), int(r["n"]), r["bag"]) for r in rows], ridge, rounds)


def _maximise(known: np.ndarray, rows: list[tuple[int, int, list[int]]], ridge: float, rounds: int) -> ToxicityModel:
    """Maximum a posteriori weights (not below 0) and leak, by Adam on the noisy-or likelihood."""
    y = np.array([r[0] for r in rows], dtype=float)
    n = np.array([r[1] for r in rows], dtype=float)
    bag, sent, word, s = [], [], [], 0
    for i, (_, _, pairs) in enumerate(rows):
        last = None
        for sentence, number in zip(pairs[::2], pairs[1::2], strict=True):
            if sentence != last:
                bag.append(i)
                s, last = s + 1, sentence
            sent.append(s - 1)
            word.append(number)
    bag_a, sent_a, word_a = (np.array(x, dtype=np.int64) for x in (bag, sent, word))
    w, b = np.full(len(known), 11.0), -3.0
    theta = np.append(w, b)
    m, v, total = np.zeros_like(theta), np.zeros_like(theta), n.sum()
    for t in range(1, rounds + 1):
        w, leak = theta[:-1], 1 / (1 + np.exp(-theta[-1]))
        z = BIAS + np.bincount(sent_a, weights=w[word_a], minlength=s) if s else np.zeros(0)
        p = 1 / (1 + np.exp(-z))
        log_no = np.bincount(bag_a, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(y)) + np.log1p(-leak)
        toxic = -np.expm1(log_no)
        # d(loss)/d(log_no): 1 for label 0 times -1, or the odds of "no" for label 1.
        slope = np.where(y > 0, np.exp(log_no) / np.maximum(toxic, 1e-9), -1.0) * n / total
        grad = np.zeros_like(theta)
        if s:
            grad[:-1] = np.bincount(word_a, weights=(-slope[bag_a] * p)[sent_a], minlength=len(known))
        grad[:-1] += ridge * (w - 6.0) / total
        grad[-1] = -(slope * leak).sum()
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-10)
        theta[:-1] = np.clip(theta[:-1], 0.0, 24.0)
        theta[-1] = np.clip(theta[-1], -9.0, -1.1)
    return ToxicityModel(known, theta[:-1], float(1 / (1 + np.exp(-theta[-1]))))


def score(docs: DataFrame, model: ToxicityModel, *, text: str = "text", offends_at: float = 0.5, columns: tuple[str, str] = ("score", "offending")) -> DataFrame:
    """Every row of docs with `score` (double) and `offending`: the sentences with
    p >= offends_at as (start, end, p), in bytes of the UTF-8 text from their first to
    their last word. columns: other names for the two."""
    docs = without(docs, *columns)
    span = "array<struct<start:bigint,end:bigint,p:double>>"
    known, weights, leak, bias = model.words, model.weights, model.leak, model.bias
    arrow_span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text)
            for i, j in tb.blocks(texts, BLOCK):
                part = batch.slice(i, j - i)
                words = tb.split(part.column(text), lower=True, letters=True)
                hit, number = _known(words, known)
                log_no = np.full(j - i, np.log1p(-leak))
                spans: list[list[dict]] = [[] for _ in range(j - i)]
                if len(hit):
                    sentence = tb.sentence_ids(words)
                    ids = words.text_ids()
                    pairs = np.unique(np.stack([sentence[hit], number], axis=1), axis=0)
                    at, first = np.unique(pairs[:, 0], return_index=True)
                    p = 1 / (1 + np.exp(-(bias + np.add.reduceat(weights[pairs[:, 1]], first))))
                    low, high = np.searchsorted(sentence, at), np.searchsorted(sentence, at, side="right") - 1
                    owner = ids[low]
                    np.add.at(log_no, owner, np.log1p(-np.minimum(p, 1 - 1e-12)))
                    base = words.text_offsets[owner]
                    for k in np.flatnonzero(p >= offends_at).tolist():
                        spans[owner[k]].append({"start": int(words.starts[low[k]] - base[k]), "end": int(words.ends[high[k]] - base[k]), "p": float(p[k])})
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(-np.expm1(log_no)), pa.array(spans, type=arrow_span)], names=[*part.schema.names, *columns])

    return docs.mapInArrow(tidy(run), f"{fields(docs)}, `{columns[0]}` double, `{columns[1]}` {span}")


def held_out(doc_id: str = "doc_id", parts: int = 4, part: int = 2) -> F.Column:
    """True for ids that are kept from training."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == part, F.lit(False))


def reject(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3) -> DataFrame:
    """docs without those that score threshold or more; all columns stay, `score` as well."""
    model = fit(docs, labels.where(~held_out()))
    own = fresh(docs, "score", "offending")
    scored = score(docs, model, columns=(own["score"], own["offending"]))
    return scored.where(F.col(own["score"]) < threshold).select(*[f"`{c}`" for c in docs.columns])


def op1_toxicity_noisy_or(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = fit(docs, labels.where(~held_out()))
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).cast("int").alias("predicted"),
        F.size("offending").alias("n_offending"),
        F.array_join(F.transform("offending", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("offending_spans"),
    )
