"""Windows, language model, fingerprints, packing and media against plain Python."""

import collections
import hashlib
import math
import uuid
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from snaplake.llm import components, lm, media, packing, shared, simhash, textblocks, windows

from .brute import Groups, edge_docs, edge_texts, prose, words


def test_words_and_hashes_of_odd_texts():
    import pyarrow as pa

    texts = pa.array(edge_texts())
    w = textblocks.split(texts)
    flat, at, end = w.joined()
    every = [x for t in edge_texts() for x in words(t)]
    assert [flat[a:b].decode() for a, b in zip(at, end, strict=True)] == every
    assert len(set(zip(every, w.hashes().tolist(), strict=True))) == len(set(every)) == len(set(w.hashes().tolist()))


def brute_windows(rows, k):
    first, out = {}, {}
    for i, t in rows:
        w = words(t)
        for p in range(len(w) - k + 1):
            key = tuple(w[p : p + k])
            first[key] = min(first.get(key, i), i)
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for p in range(len(w) - k + 1):
            if first[tuple(w[p : p + k])] < i:
                gone[p : p + k] = [True] * k
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return out


@pytest.mark.parametrize(("k", "m", "salts"), [(13, 3, 1), (13, 3, 3), (4, 1, 1), (2, 2, 2)])
def test_repeated_windows(spark, k, m, salts):
    docs = edge_docs(spark)
    got = windows.remove_repeated(docs, k=k, minimiser=m, salts=salts, buckets=5)
    assert got.columns == ["doc_id", "score", "lang", "n_words", "n_removed", "kept"]
    want = brute_windows([(r["doc_id"], r["text"]) for r in docs.collect()], k)
    rows = got.collect()
    assert len(rows) == docs.count()
    assert all((r["n_words"], r["n_removed"], r["kept"]) == want[r["doc_id"]] for r in rows)


def test_windows_of_rows_that_share_an_id_and_of_null_ids(spark):
    a, b = prose(5, 20, 900), prose(6, 20, 900)
    docs = spark.createDataFrame([(1, a), (1, b), (None, a), (2, a), (0, b)], "doc_id long, text string")
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_removed"]) for r in windows.remove_repeated(docs).collect())
    assert got == [(-1, 0), (0, 0), (1, 0), (1, 20), (2, 20)]
    assert windows.remove_repeated(docs.limit(0)).count() == 0


def test_language_model(spark):
    docs = edge_docs(spark)
    trains = F.col("doc_id") % 2 == 1
    for order in (1, 2, 3, 4):
        got = lm.score(docs, trains=trains, order=order, mu=4.0, buckets=3).collect()
        rows = [(r["doc_id"], words(r["text"], lower=True) + ["</s>"]) for r in docs.collect()]
        counts = collections.Counter()
        for i, w in rows:
            if i % 2 == 1:
                padded = ["<s>"] * (order - 1) + w
                for p in range(max(0, order - 2), len(padded)):
                    for n in range(1, order + 1):
                        if n <= p + 1:
                            counts[tuple(padded[p - n + 1 : p + 1])] += 1
        single = {g[0]: c for g, c in counts.items() if len(g) == 1 and g[0] != "<s>"}
        total, distinct = sum(single.values()), len(single)
        want = {}
        for i, w in rows:
            padded, s, base = ["<s>"] * (order - 1) + w, 0.0, 0.0
            for p in range(order - 1, len(padded)):
                prob = (single.get(padded[p], 0) + 1) / (total + distinct + 1)
                base += math.log10(prob)
                for n in range(2, order + 1):
                    state = counts[tuple(padded[p - n + 1 : p])]
                    if state:
                        prob = (counts[tuple(padded[p - n + 1 : p + 1])] + 4.0 * prob) / (state + 4.0)
                s += math.log10(prob)
            want[i] = (len(w), sum(x in single for x in w), total, base, s)
        assert len(got) == len(rows)
        for r in got:
            n, known, t, base, s = want[r["doc_id"]]
            assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (n, known, t, r["doc_id"] % 2 == 0)
            assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(s)
    assert lm.score(docs.limit(0)).count() == 0


class PlainAutomaton:
    """States are tuples; arcs and failure arcs as dictionaries, one token at a time."""

    def __init__(self, rows, order, mu):
        self.order, counts = order, collections.Counter()
        for w in rows:
            padded = ["<s>"] * (order - 1) + w
            for p in range(order - 2, len(padded)):
                for n in range(1, min(order, p + 1) + 1):
                    counts[tuple(padded[p - n + 1 : p + 1])] += 1
        self.single = {g: c for g, c in counts.items() if len(g) == 1 and g != ("<s>",)}
        self.floor = sum(self.single.values()) + len(self.single) + 1
        self.states = {g for g in counts if len(g) < order} | {()}
        self.fail = {s: (s[1:], math.log10(mu / (counts[s] + mu))) for s in self.states if s}
        prob = {}
        for g in sorted(counts, key=len):
            below = prob[g[1:]] if len(g) > 1 else None
            prob[g] = (counts[g] + 1) / self.floor if below is None else (counts[g] + mu * below) / (counts[g[:-1]] + mu)
        self.arcs = {(g[:-1], g[-1]): (next(g[k:] for k in range(len(g) + 1) if g[k:] in self.states), math.log10(prob[g])) for g in counts}

    def score(self, w):
        state, total = next(s for s in (("<s>",) * n for n in range(self.order - 1, -1, -1)) if s in self.states), 0.0
        for token in w:
            while (state, token) not in self.arcs and state:
                state, weight = self.fail[state]
                total += weight
            state, weight = self.arcs.get((state, token), ((), -math.log10(self.floor)))
            total += weight
        return total


def test_language_model_equals_a_plain_automaton(spark):
    """Long texts are traversed in pieces, others side by side; the scores are those of one walk."""
    texts = [prose(i, 30 + 400 * (i % 5), 40 + i) for i in range(40)] + ["new words only", "", None, prose(5, 3000, 300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for order in (2, 3):
        plain = PlainAutomaton([words(t, lower=True) + ["</s>"] for i, t in enumerate(texts) if i % 3], order, 2.0)
        for r in lm.score(docs, trains=F.col("doc_id") % 3 > 0, order=order, mu=2.0, buckets=5).collect():
            assert r["score"] == pytest.approx(plain.score(words(texts[r["doc_id"]], lower=True) + ["</s>"]))
    none = lm.score(docs, trains=F.lit(False)).collect()
    assert len(none) == len(texts) and all(r["score"] == 0 and r["train_tokens"] == 0 for r in none)


def test_language_model_tells_of_rows_that_change(spark):
    docs = spark.createDataFrame([(i, prose(i, 50)) for i in range(20)], "doc_id long, text string").withColumn("text", F.concat("text", F.udf(lambda: f" {uuid.uuid4()}").asNondeterministic()()))
    with pytest.raises(Exception, match="write it to a table first"):
        lm.score(docs).collect()


def fingerprint(text, k=4):
    w = words(text, lower=True)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("radius", [1, 3, 4])
def test_covering_masks_leave_no_pair_out(radius):
    masks = simhash.covering_masks(radius)
    r = np.random.default_rng(radius)
    for _ in range(3000):
        bits = np.uint64(0)
        for b in r.choice(64, size=r.integers(0, radius + 1), replace=False):
            bits |= np.uint64(1) << np.uint64(b)
        assert ((masks & bits) == 0).any()


def test_simhash_components(spark):
    docs = edge_docs(spark)
    got = simhash.group(docs).collect()
    rows = {r["doc_id"]: fingerprint(r["text"]) for r in docs.collect()}
    groups = Groups(rows)
    for a in rows:
        for b in rows:
            if (rows[a] ^ rows[b]).bit_count() <= 4:
                groups.join(a, b)
    assert len(got) == docs.count()
    assert all((r["prints"][0] % 2**64, r["component_id"]) == (rows[r["doc_id"]], groups.find(r["doc_id"])) for r in got)
    assert simhash.group(docs.limit(0)).count() == 0


def test_links_of_a_dense_ball(spark):
    r = np.random.default_rng(3)
    prints = {0}
    while len(prints) < 300:
        x = 0
        for b in r.choice(64, size=r.integers(1, 4), replace=False):
            x |= 1 << int(b)
        prints.add(x)
    far = [int(x) for x in r.integers(2**40, 2**63, 300)]
    every = sorted(prints) + far
    signed = [x - 2**64 if x >= 2**63 else x for x in every]
    nodes = spark.createDataFrame([(i, [x]) for i, x in enumerate(signed)], "id long, prints array<long>")
    groups = Groups(range(len(every)))
    for i, x in enumerate(every):
        for j in range(i):
            if (x ^ every[j]).bit_count() <= 4:
                groups.join(i, j)
    found = simhash.links(nodes, buckets=3)
    roots = {row["id"]: row["root"] for row in components.components(found).collect()}
    assert {i: roots.get(i, i) for i in range(len(every))} == {i: groups.find(i) for i in range(len(every))}
    assert found.count() < 300 * 31


def flipped(r, x, n):
    for b in r.choice(512, size=n, replace=False).tolist():
        x ^= 1 << b
    return x


def signed(x):
    return [v - 2**64 if v >= 2**63 else v for v in (x >> 64 * k & (2**64 - 1) for k in range(8))]


def test_judged_links_of_dense_sets(spark):
    """Pairs that meet beside many nearer ones, and chains in sets of every size, are linked."""
    r = np.random.default_rng(8)
    every = []
    for size in (2, 5, 30, 400):
        base = int.from_bytes(r.bytes(64))
        every += [flipped(r, base, int(n)) for n in r.integers(1, 110, size)]
    every += [int.from_bytes(r.bytes(64)) for _ in range(100)]
    every = [every[i] for i in r.permutation(len(every)).tolist()]
    nodes = spark.createDataFrame([(i, signed(x) * 2) for i, x in enumerate(every)], "id long, prints array<long>")
    masks = [int(m) for m in simhash.covering_masks(5)]
    groups, met = Groups(range(len(every))), collections.defaultdict(list)
    for i, x in enumerate(every):
        for k in range(8):
            for t, m in enumerate(masks):
                met[k, t, x >> 64 * k & m].append(i)
    for ids in met.values():
        for i in ids:
            for j in ids:
                if i < j and (every[i] ^ every[j]).bit_count() <= 84:
                    groups.join(i, j)
    found = simhash.judged_links(nodes, radius=5, meet_prints=8, most_bits=84, buckets=3)
    roots = {row["id"]: row["root"] for row in components.components(found).collect()}
    assert {i: roots.get(i, i) for i in range(len(every))} == {i: groups.find(i) for i in range(len(every))}
    assert found.count() < 3 * len(every)
    assert simhash.judged_links(nodes.limit(0), radius=5, meet_prints=8, most_bits=84).count() == 0


def test_a_hub_takes_no_link_away(spark):
    """y and z meet by one print alone, in a set of over 256 whose smallest id has that print too."""
    r = np.random.default_rng(9)
    hub = int.from_bytes(r.bytes(64))
    change = lambda x, n: x ^ sum(1 << 64 * k + b for k in range(1, 8) for b in r.choice(64, size=n, replace=False).tolist())
    y = change(hub, 20)
    fill = [hub & (2**64 - 1) | int.from_bytes(r.bytes(56)) << 64 for _ in range(300)]
    every = [hub, y, change(y, 12), *fill]
    nodes = spark.createDataFrame([(i, signed(x) * 2) for i, x in enumerate(every)], "id long, prints array<long>")
    found = simhash.judged_links(nodes, radius=5, meet_prints=8, most_bits=84, buckets=3)
    assert {(row["id"], row["root"]) for row in components.components(found).collect()} == {(1, 1), (2, 1)}


def test_components_of_a_long_path(spark):
    edges = spark.range(1, 65).select((F.col("id") - 1).alias("a"), F.col("id").alias("b")).union(spark.createDataFrame([(100, 101), (101, 100), (7, 7), (None, 3)], "a long, b long"))
    got = {r["id"]: r["root"] for r in components.components(edges).collect()}
    assert got == {**{i: 0 for i in range(65)}, 100: 100, 101: 100}
    assert components.components(edges.limit(0)).count() == 0


def test_keep_one_of_near_copies(spark):
    docs = edge_docs(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    base = [3 * i + 1 for i in (7, 8, 9, 10)]
    assert base[0] in ids and not ids & set(base[1:])
    assert {1, 10, 16, 19} <= ids and not ids & {4, 7}


def test_packing_equals_the_tokenizer_and_fits(spark):
    from tokenizers import Tokenizer

    path = packing.word_tokenizer()
    tokenizer = Tokenizer.from_file(path)
    odd = ["<|ENDOFTEXT|> a<|endoftext|>.b \x01", "It's, they're... é.É. 1²³ ﬁ ß İ"]
    docs = edge_docs(spark).select("doc_id", "text").union(spark.createDataFrame([(900 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    got = packing.pack(docs, path).collect()
    want = collections.Counter()
    for r in docs.collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        for k, s in enumerate(range(0, len(ids), 2048)):
            part = ids[s : s + 2048]
            want[r["doc_id"], k, s, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        assert [o for o, _ in sorted(b)] == np.cumsum([0, *[n for _, n in sorted(b)][:-1]]).tolist() and sum(n for _, n in b) <= 2048
    assert packing.pack(docs.limit(0), path).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_bins_keep_every_capacity(rule):
    length = np.sort(np.random.default_rng(5).integers(1, 300, 400))[::-1]
    limits = np.array([300.0, 3.0, 50_000.0])
    limits[2] = max(limits[2], 300.0**2)
    bins, offsets = packing.fit_bins(length, limits, np.ones(3), rule)
    for b in np.unique(bins):
        n = length[bins == b]
        assert n.sum() <= 300 and len(n) <= 3 and (n * n).sum() <= limits[2]
        assert sorted(offsets[bins == b]) == np.cumsum([0, *n[:-1]]).tolist()
    assert bins.max() + 1 <= 1.25 * max(length.sum() / 300, len(length) / 3)


def test_media_round_trip(spark):
    shared_part = prose(8, 900, 5000)
    docs = edge_docs(spark).select("doc_id", "text").union(spark.createDataFrame([(800 + i, prose(50 + i, 300, 5000) + " " + shared_part) for i in range(4)], "doc_id long, text string"))
    path = f"{shared.shared_folder(spark)}/media-test"
    got = media.round_trip(docs, path).collect()
    assert len(got) == docs.count()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    for r in got:
        p = media.payload_of(texts[r["doc_id"]])
        assert len(p) % 576 == 0 and len(p) >= 576
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(texts[r["doc_id"]]), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]))
        assert (r["media_bytes"], r["media_sha256"], r["feature"]) == (len(media.wav(p)), hashlib.sha256(media.wav(p)).hexdigest(), media.feature(p))
    stored = spark.read.parquet(path)
    chunks = stored.select(F.explode(F.arrays_zip("digests", "owned")).alias("c")).select("c.*")
    assert chunks.where("owned is not null").groupBy("digests").count().where("count > 1").count() == 0
    assert stored.agg(F.sum("borrows")).first()[0] > 0


def test_a_frequent_file_is_sent_once(spark, monkeypatch):
    """Copies beyond the bound are sent by the rows of one id; all rows are read back the same."""
    docs = spark.createDataFrame([(i, "copy of one text " * 300) for i in range(60)] + [(None, "copy of one text " * 300), (90, None), (91, "other")], "`doc.id` long, `a text` string").repartition(6)
    read = lambda: sorted(map(str, media.round_trip(docs, f"{shared.shared_folder(spark)}/frequent-{uuid.uuid4().hex}", doc_id="doc.id", text="a text").collect()))
    want = read()
    monkeypatch.setattr(media, "FREQUENT", 10)
    assert read() == want and len(want) == 63


def test_damaged_media_is_told(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    path = f"{shared.shared_folder(spark)}/media-damaged"
    media.store(docs, media.index(docs), path)
    bad = spark.read.parquet(path).withColumn("owned", F.transform("owned", lambda _: F.lit(b"other")))
    with pytest.raises(Exception, match="damaged"):
        media.read(bad).collect()


def shingle_set(text, k=5):
    w = words(text, lower=True)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}


def similarity(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b)


def changed(r, text, n):
    w = text.split()
    for i in r.choice(len(w), size=n, replace=False).tolist():
        w[i] = f"new{r.integers(10**9)}"
    return " ".join(w)


def test_recall_of_near_copies_against_all_pairs(spark):
    """Pairs by similarity, beside 2 000 near copies of one text that all stay one group."""
    r = np.random.default_rng(12)
    pairs, rows = [], []
    for k in range(400):
        base = prose(20_000 + k, 150 + k % 3 * 100, 4000)
        near = changed(r, base, 3 + int(r.integers(0, 4)) * (1 + k % 3) // 2)
        pairs.append((len(rows), len(rows) + 1, similarity(base, near)))
        rows += [base, near]
    base = prose(19_999, 300, 4000)
    first = len(rows)
    rows += [base, *[changed(r, base, int(r.integers(1, 4))) for _ in range(2000)]]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    kept = {x["doc_id"] for x in simhash.keep_one(docs).collect()}
    caught = lambda low, high: [b not in kept for _, b, s in pairs if low <= s < high]
    assert len(caught(0.8, 0.85)) > 40 and np.mean(caught(0.8, 0.85)) >= 0.9
    assert len(caught(0.85, 1.1)) > 60 and all(caught(0.85, 1.1))
    assert not any(caught(0, 0.65))
    assert kept & set(range(first, len(rows))) == {first}
    assert all(a in kept for a, _, _ in pairs)


def blocks_of(r, text, kind, share):
    """text with a share of it changed as a block: moved about, put behind it, or replaced."""
    w = text.split()
    new = [f"fresh{r.integers(10**9)}" for _ in range(int(len(w) * share))]
    if kind == "appended":
        return " ".join([*w, *new])
    if kind == "replaced":
        at = int(r.integers(0, len(w) - len(new)))
        return " ".join([*w[:at], *new, *w[at + len(new) :]])
    cuts = sorted(r.choice(np.arange(1, len(w)), size=int(r.integers(3, 9)), replace=False).tolist())
    parts = [w[a:b] for a, b in zip([0, *cuts], [*cuts, len(w)])]
    return " ".join(x for k in r.permutation(len(parts)) for x in parts[k])


def test_recall_of_copies_changed_in_blocks(spark):
    """Moved, appended and replaced blocks: 0.9 of the pairs from 0.80, all from 0.85."""
    r = np.random.default_rng(21)
    pairs, rows = [], []
    for k in range(900):
        kind = ("moved", "appended", "replaced")[k % 3]
        share = {"moved": 0, "appended": r.uniform(0.12, 0.26), "replaced": r.uniform(0.05, 0.12)}[kind]
        base = prose(30_000 + k, 300, 4000)
        near = blocks_of(r, base, kind, share)
        pairs.append((kind, len(rows) + 1, similarity(base, near)))
        rows += [base, near]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    kept = {x["doc_id"] for x in simhash.keep_one(docs).collect()}
    assert set(range(0, len(rows), 2)) <= kept
    for kind in ("moved", "appended", "replaced"):
        caught = lambda low, high: [b not in kept for k, b, s in pairs if k == kind and low <= s < high]  # noqa: E731, B023
        print(kind, len(caught(0.8, 0.85)), np.mean(caught(0.8, 0.85)), len(caught(0.85, 1.1)), np.mean(caught(0.85, 1.1)))
        assert kind == "moved" or len(caught(0.8, 0.85)) > 40 and np.mean(caught(0.8, 0.85)) >= 0.9
        assert len(caught(0.85, 1.1)) > 40 and all(caught(0.85, 1.1))


def test_a_frequent_fingerprint_is_named_by_broadcast(spark, monkeypatch):
    """Groups of copies beyond the bound get the same names as by the join."""
    docs = spark.createDataFrame([(i, "the same words in many rows of it") for i in range(50)] + [(100, None), (101, ""), (102, "other words stand in this one row")], "doc_id long, text string")
    want = sorted((x["doc_id"], x["component_id"]) for x in simhash.group(docs).collect())
    monkeypatch.setattr(simhash, "FREQUENT", 10)
    assert sorted((x["doc_id"], x["component_id"]) for x in simhash.group(docs).collect()) == want
    assert {c for d, c in want if d < 50} == {0}


def test_a_frequent_run_of_words_fills_no_bucket(spark):
    """One triple stands in every window: its bucket is split, and the result is that of no split."""
    r = np.random.default_rng(4)
    texts = [" ".join(f"the same three x{r.integers(4000)} y{r.integers(4000)} z{r.integers(9)}" for _ in range(60)) for _ in range(60)]
    texts += [texts[3][:1500], "a " + texts[7]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    buckets, most = 40, 1500
    rows = docs.select(F.col("doc_id").alias("id"), F.lit(0).cast("long").alias("row"), "text")
    large = windows.large_buckets(rows, 13, 3, buckets, most)
    assert large
    windows_of = lambda split: {b: sum(int(windows._open(x)[0][3].sum()) for x in blobs) for b, blobs in rows.mapInArrow(windows._send(13, 3, buckets, split), "bucket long, blob binary").groupBy("bucket").agg(F.collect_list("blob")).collect()}
    assert max(windows_of([]).values()) > most >= max(windows_of(large).values())
    want = brute_windows(list(enumerate(texts)), 13)
    got = windows.remove_repeated(docs, buckets=buckets, most=most).collect()
    assert len(got) == len(texts) and all((x["n_words"], x["n_removed"], x["kept"]) == want[x["doc_id"]] for x in got)
    assert sum(x["n_removed"] for x in got) > 300


def test_hash_lanes_differ():
    import pyarrow as pa

    w = textblocks.split(pa.array(["some words of a text " * 3]))
    one, two = w.hashes(), w.hashes(lane=1)
    assert not set(one.tolist()) & set(two.tolist()) and len(set(zip(one.tolist(), two.tolist(), strict=True))) == 5
