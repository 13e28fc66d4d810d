"""Personal data and the terms that disclose it.

Patterns find e-mail addresses, IP addresses, payment card and phone numbers. Hiding
those is not enough where words beside them tell the same: corpus co-occurrence
estimates how strongly a term reveals a protected value. For a value e and a term t,

    disclosure(t, e) = PMI(t; e) / IC(e) = log(n_te N / (n_t n_e)) / log(N / n_e),

the share of e's information that t gives away (1: t occurs with e only), where n
counts texts and t occurs anywhere in the text outside personal data. A term reaching
`generalise_at` is generalised to a placeholder, one reaching `remove_at` removed, wherever
it stands in a text with that value. Any rare word stands by chance in a text with some
value: a term needs `support` texts with it, where texts that share their least hash of
three neighbouring words, as copies and near copies do, count once. A value in fewer texts
is hidden itself, and no word of its text is judged.

Terms are runs of letters, A-Z lower-cased. Their numbers of texts cover the whole
corpus: a block sends each of its words once, with its count, to a bucket that keeps
the asked ones. Texts themselves are never shuffled for the spans; only texts with
personal data are joined to their spans when they are rewritten.

Spans are in code points, end exclusive. Null and empty texts have none; texts of any
length are handled whole, in time linear in their length. Rows that share an id are
told apart by their texts; repeated rows are answered each. Input columns named like
an output column are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblocks as tb
from .shared import cut, fields, groups_for, pack, tidy, unpack, without

BLOCK = 4 << 20
KINDS = ("email", "ip", "card", "phone", "term")
#: The characters before an address's @, and the patterns.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match can only start where a run of digits starts, which keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _emails(t: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses: each @ with local characters before it and a domain behind."""
    free, at = 0, t.find("@")
    while at >= 0:
        before = t[free:at]
        start = free + len(before.rstrip(LOCAL))
        found = _DOMAIN.match(t, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        else:
            free = at + 1
        at = t.find("@", free)


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def base_spans(t: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the personal data in t, in order."""
    out = [(a, 0, b) for a, b in _emails(t)]
    for m in _IP.finditer(t):
        if all(len(x) <= 3 and int(x or "0") <= 255 for x in (p.lstrip("0") for p in m[0].split("."))):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(t):
        d = _digits(m[0])
        if 12 <= len(d) <= 19 and _luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(t):
        if 9 <= len(_digits(m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


_BASE = "array<struct<kind:int,start:int,end:int>>"
_FOUND = f"_base {_BASE}, _kin bigint, _entities array<bigint>"
_ARROW = (pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])), pa.int64(), pa.list_(pa.int64()))


def _entity(kind: int, value: str) -> int:
    """A 64-bit name of a protected value, its spelling aside."""
    plain = value.lower() if kind == 0 else value if kind == 1 else _digits(value)
    words = tb.split(pa.array([f"{kind}:{plain}"]))
    return int(words.hashes().view(np.int64)[0])


def _may_hold(words: tb.Words) -> np.ndarray:
    """Numbers of the texts with a digit or an @; others hold no personal data."""
    mark = np.flatnonzero(((words.buf >= 48) & (words.buf <= 57)) | (words.buf == 64))
    return np.unique(np.searchsorted(words.text_offsets, mark, side="right") - 1)


def _free(words: tb.Words, chars: np.ndarray, k: int, spans: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, starts and ends (code points) of the words of text k outside the spans."""
    at = np.arange(int(words.offsets[k]), int(words.offsets[k + 1]))
    zero = chars[words.text_offsets[k]]
    starts, ends = chars[words.starts[at]] - zero, chars[words.ends[at]] - zero
    free = np.ones(len(at), dtype=bool)
    for a, _, b in spans:
        free[np.searchsorted(ends, a, side="right") : np.searchsorted(starts, b)] = False
    return at[free], starts[free], ends[free]


def _chars(words: tb.Words) -> np.ndarray:
    """Code points before each byte."""
    return np.concatenate([[0], np.cumsum((words.buf & 0xC0) != 0x80)])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with _base, _kin and _entities added; texts without personal data have no kin."""
    for batch in batches:
        for i, j in tb.blocks(batch.column("_text"), BLOCK):
            part = batch.slice(i, j - i)
            texts = part.column("_text")
            words = tb.split(texts, lower=True, letters=True)
            base, kin, entities, h = [[] for _ in range(j - i)], [None] * (j - i), [[] for _ in range(j - i)], None
            for k in _may_hold(words).tolist():
                t = texts[k].as_py() or ""
                spans = base_spans(t)
                if not spans:
                    continue
                h = words.hashes() if h is None else h
                own = h[int(words.offsets[k]) : int(words.offsets[k + 1])]
                base[k] = [{"kind": kind, "start": a, "end": b} for a, kind, b in spans]
                kin[k] = int(tb.window_hashes(own, min(3, len(own))).min().view(np.int64)) if len(own) else 0
                entities[k] = sorted({_entity(kind, t[a:b]) for a, kind, b in spans})
            cols = [pa.array(v, type=kind) for v, kind in zip((base, kin, entities), _ARROW, strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns, *cols], names=[*part.schema.names, "_base", "_kin", "_entities"])


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_id, _twin, _kin, term): the distinct words of each text outside its personal data."""
    for batch in batches:
        for i, j in tb.blocks(batch.column("_text"), BLOCK):
            part = batch.slice(i, j - i)
            words = tb.split(part.column("_text"), lower=True, letters=True)
            h, chars = words.hashes().view(np.int64), _chars(words)
            terms = [np.unique(h[_free(words, chars, k, base_spans(t))[0]]) for k, t in enumerate(part.column("_text").to_pylist())]
            row = pa.array(np.repeat(np.arange(j - i), [len(t) for t in terms]))
            yield pa.RecordBatch.from_arrays([*(part.column(c).take(row) for c in ("_id", "_twin", "_kin")), pa.array(np.concatenate(terms))], names=["_id", "_twin", "_kin", "term"])


def _text_counts(buckets: int):
    """(bucket, blob): for each block its distinct words and the number of texts with them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in tb.blocks(batch.column("text"), 2 * BLOCK):
                keys, ids = [], []
                for a, b in tb.blocks(batch.column("text").slice(i, j - i), BLOCK):
                    words = tb.split(batch.column("text").slice(i + a, b - a), lower=True, letters=True)
                    keys.append(words.hashes())
                    ids.append(words.text_ids() + a)
                h, owner = np.concatenate(keys), np.concatenate(ids)
                order = np.argsort(h, kind="stable")
                h, owner = h[order], owner[order]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
                words_, counts = np.unique(h[new], return_counts=True)
                bucket = (words_ & np.uint64(2**63 - 1)).astype(np.int64) % buckets
                by = np.argsort(bucket, kind="stable")
                first = np.flatnonzero(np.diff(bucket[by], prepend=-1))
                blobs = [pack(words_[o], counts[o].astype(np.int32)) for o in np.split(by, first[1:])] if len(first) else []
                yield pa.RecordBatch.from_arrays([pa.array(bucket[by][first], pa.int64()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])

    return run


def _asked_counts(left: pa.Table, right: pa.Table) -> pa.Table:
    asked = np.unique(right.column("term").to_numpy().view(np.uint64))
    total = np.zeros(len(asked), dtype=np.int64)
    for blob in left.column("blob").to_pylist() if len(asked) else ():
        words, counts = (np.frombuffer(p, dtype=t) for p, t in zip(unpack(blob), (np.uint64, np.int32), strict=True))
        at = np.minimum(np.searchsorted(words, asked), len(words) - 1)
        hit = words[at] == asked
        total[hit] += counts[at[hit]]
    return pa.table({"term": asked.view(np.int64), "n_t": total})


_TERMS = "array<struct<start:int,end:int,remove:boolean>>"


def _occurrences(remove_at: float):
    """(_id, _twin, _terms): every place of a text's disclosing terms outside its personal data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("remove", pa.bool_())]))
        for batch in batches:
            for i, j in tb.blocks(batch.column("_text"), BLOCK):
                part = batch.slice(i, j - i)
                words = tb.split(part.column("_text"), lower=True, letters=True)
                h, chars = words.hashes().view(np.int64), _chars(words)
                out = []
                for k, told in enumerate(part.column("_told").to_pylist()):
                    share = {t["term"]: t["disclosure"] for t in told}
                    at, starts, ends = _free(words, chars, k, base_spans(part.column("_text")[k].as_py()))
                    hit = np.flatnonzero(np.isin(h[at], np.array(list(share), dtype=np.int64)))
                    out.append([{"start": int(starts[w]), "end": int(ends[w]), "remove": share[int(h[at[w]])] >= remove_at} for w in hit.tolist()])
                yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("_twin"), pa.array(out, type=kind)], names=["_id", "_twin", "_terms"])

    return run


def _told(rows: DataFrame, hit: DataFrame) -> DataFrame:
    """hit's (_id, _twin, _kin, _text) with the list _told of rows(_i, _t, _told); a text once."""
    return hit.join(rows, hit["_id"].eqNullSafe(rows["_i"]) & (hit["_twin"] == rows["_t"])).select("_id", "_twin", "_kin", "_text", "_told").dropDuplicates(["_id", "_twin"])


def term_spans(texts: DataFrame, hit: DataFrame, *, support: int, generalise_at: float, remove_at: float, buckets: int | None = None) -> DataFrame:
    """(_id, _twin, _terms): the disclosing terms of each text of hit, the texts with personal
    data. texts(text) are all texts.

    Words and values meet only where they can disclose: as n_te <= n_e, a term reaches d for e
    only if n_t <= N**(1 - d) * n_e**d, and it stands in `support` texts. Values of just the same
    texts are one class, which is counted once for all of them."""
    n_all = texts.count()
    held = hit.select(F.col("_id").alias("_i"), F.col("_twin").alias("_t"), "_kin", F.explode("_entities").alias("entity"))
    mark = lambda *c: F.sum(F.xxhash64(*c).cast("decimal(20,0)"))
    known = held.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"), F.count_distinct("_kin").alias("kins"), mark("_i", "_t").alias("a"), mark("_t", F.lit(7), "_i").alias("b"))
    known = cut(known.where((F.col("kins") >= support) & (F.col("n_e") < n_all)).select("entity", "n_e", F.xxhash64("n_e", "a", "b").alias("class")))
    asking = cut(held.join(known, "entity").select("_i", "_t", "class", "n_e").distinct())
    most = asking.agg(F.max("n_e")).first()[0] or 0
    bound = lambda n_e: F.pow(F.lit(float(max(n_all, 1))), F.lit(1 - generalise_at)) * F.pow(n_e, F.lit(generalise_at)) * (1 + 1e-9)
    # A row of hit counts for itself, also where several share a text and an id.
    texts_asked = asking.select("_i", "_t").distinct()
    holders = hit.join(texts_asked, hit["_id"].eqNullSafe(texts_asked["_i"]) & (hit["_twin"] == texts_asked["_t"]), "left_semi").select("_id", "_twin", "_kin", "_text")
    words = holders.mapInArrow(tidy(_words), "_id long, _twin long, _kin long, term long")
    buckets = buckets or groups_for(texts, "text", 8 * BLOCK, least=8)
    bucket = F.col("term").bitwiseAND(F.lit(2**63 - 1)) % buckets
    counts = texts.mapInArrow(tidy(_text_counts(buckets)), "bucket long, blob binary")
    asked = words.groupBy("term").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= support).select("term", bucket.alias("bucket"))
    n_t = counts.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInArrow(_asked_counts, "term long, n_t long")
    rare = cut(n_t.where((F.col("n_t") > 0) & (F.col("n_t") <= bound(F.lit(float(most))))))
    own = words.join(rare, "term")
    both = own.join(asking, own["_id"].eqNullSafe(asking["_i"]) & (own["_twin"] == asking["_t"])).where(F.col("n_t") <= bound(F.col("n_e")))
    met = both.groupBy("class", "term", "_kin").agg(F.count(F.lit(1)).alias("n"), F.first("n_t").alias("n_t"), F.first("n_e").alias("n_e"))
    pairs = met.groupBy("class", "term").agg(F.sum("n").alias("n_te"), F.count(F.lit(1)).alias("kins"), F.first("n_t").alias("n_t"), F.first("n_e").alias("n_e")).where(F.col("kins") >= support)
    share = F.log(F.col("n_te") * F.lit(float(n_all)) / (F.col("n_t") * F.col("n_e"))) / F.log(F.lit(float(n_all)) / F.col("n_e"))
    risky = pairs.withColumn("disclosure", share).where(F.col("disclosure") >= generalise_at)
    told = asking.join(risky.select("class", "term", "disclosure"), "class").groupBy("_i", "_t", "term").agg(F.max("disclosure").alias("disclosure"))
    told = told.groupBy("_i", "_t").agg(F.collect_list(F.struct("term", "disclosure")).alias("_told"))
    return _told(told, hit).mapInArrow(tidy(_occurrences(remove_at)), f"_id long, _twin long, _terms {_TERMS}")


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(row, _id, _twin, _text): all columns but the text in one struct, so no name clashes."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() != text.lower()]
    return docs.select(F.struct(*rest).alias("row"), F.col(f"`{doc_id}`").cast("long").alias("_id"), F.xxhash64(f"`{text}`").alias("_twin"), F.col(f"`{text}`").alias("_text"))


def find(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", support: int = 3, generalise_at: float = 0.8, remove_at: float = 0.95) -> DataFrame:
    """Every row of docs without its text, with spans: array of (start, kind, end, remove)
    in order of start and kind; kind is a place in KINDS."""
    keyed = _keyed(without(docs, "spans"), doc_id, text)
    scanned = keyed.mapInArrow(tidy(_scan), f"{fields(keyed)}, {_FOUND}")
    found = cut(scanned.withColumn("_text", F.when(F.size("_base") > 0, F.col("_text"))))
    terms = term_spans(docs.select(F.col(f"`{text}`").alias("text")), found.where(F.size("_base") > 0), support=support, generalise_at=generalise_at, remove_at=remove_at)
    base = F.transform("_base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.lit(False).alias("remove")))
    extra = F.transform(F.coalesce("_terms", F.array()), lambda s: F.struct(s["start"].alias("start"), F.lit(4).alias("kind"), s["end"].alias("end"), s["remove"].alias("remove")))
    return _left_by_row(found.select("row", "_id", "_twin", "_base"), terms).select("row.*", F.array_sort(F.concat(base, extra)).alias("spans"))


def _left_by_row(rows: DataFrame, terms: DataFrame) -> DataFrame:
    right = terms.select(F.col("_id").alias("_i"), F.col("_twin").alias("_t"), "_terms")
    return rows.join(right, rows["_id"].eqNullSafe(right["_i"]) & (rows["_twin"] == right["_t"]), "left").drop("_i", "_t")


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place = ["[EMAIL]", "[IP]", "[CARD]", "[PHONE]", "[TERM]"]
    for batch in batches:
        out = []
        for t, base, terms in zip(*(batch.column(c).to_pylist() for c in ("_text", "_base", "_terms")), strict=True):
            spans = sorted([(s["start"], s["end"], place[s["kind"]]) for s in base] + [(s["start"], s["end"], "" if s["remove"] else place[4]) for s in terms or ()])
            parts, done = [], 0
            for a, b, to in spans:
                if a >= done:
                    parts += [t[done:a], to]
                done = max(done, b)
            out.append("".join([*parts, t[done:]]))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())], names=["row", "_text"])


def sanitise(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", support: int = 3, generalise_at: float = 0.8, remove_at: float = 0.95) -> DataFrame:
    """docs with personal data and disclosing terms replaced in the text; columns stay.
    Where spans overlap the first placeholder stands for all. n_chars is not touched."""
    keyed = _keyed(docs, doc_id, text)
    scanned = keyed.mapInArrow(tidy(_scan), f"{fields(keyed)}, {_FOUND}")
    plain = scanned.where(F.size("_base") == 0).select("row", "_text")
    hit = cut(scanned.where(F.size("_base") > 0))
    terms = term_spans(docs.select(F.col(f"`{text}`").alias("text")), hit, support=support, generalise_at=generalise_at, remove_at=remove_at)
    changed = _left_by_row(hit.select("row", "_id", "_twin", "_text", "_base"), terms).select("row", "_text", "_base", "_terms").mapInArrow(_rewrite, fields(plain))
    back = [F.col("_text").alias(c) if c.lower() == text.lower() else F.col(f"row.`{c}`") for c in docs.columns]
    return plain.union(changed).select(*back)


def op10_pii_disclosure(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    kinds = F.array(*[F.lit(k) for k in KINDS])
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    base = F.filter("spans", lambda s: s["kind"] < 4)
    return find(docs).select("doc_id", *[count(k) for k in range(4)], F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"), count(4))
