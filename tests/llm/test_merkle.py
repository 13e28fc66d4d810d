"""The Merkle manifest against a plain Python tree, by nested lists."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from snaplake.llm import merkle

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def H(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf_of(row, text):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)])


def tree(leaves, width=16):
    """The top, and the siblings of each leaf as (left, right) by level."""
    nodes, paths = [(d, [i]) for i, d in enumerate(leaves)], [[] for _ in leaves]
    while len(nodes) > 1:
        above = []
        for i in range(0, len(nodes), width):
            run = nodes[i : i + width]
            for k, (_, held) in enumerate(run):
                for x in held:
                    paths[x].append(("".join(d for d, _ in run[:k]), "".join(d for d, _ in run[k + 1 :])))
            above.append((H(*[d for d, _ in run]), [x for _, held in run for x in held]))
        nodes = above
    return nodes[0][0], paths


def expected(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r["source"], []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    subs, placed = [], []
    for s in order:
        held = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"])), i) for i, r in enumerate(by_source[s]))
        sub, paths = tree([k[2] for k, _ in held])
        subs.append(sub)
        placed.append([(by_source[s][i], k[2], p) for (k, i), p in zip(held, paths)])
    root, upper = tree(subs)
    out = []
    for sub, up, held in zip(subs, upper, placed):
        for r, leaf, p in held:
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            text = r["text"].translate(LOWER) if hit and r["text"] is not None else r["text"]
            got = leaf_of(r, text)
            for left, right in p + up:
                got = H(left, got, right)
            out.append((r["doc_id"], leaf, sub, root, H(*[left + right for left, right in p + up]), got, got == root))
    return sorted(out, key=str)


def plain(df):
    return sorted([tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in df.collect()], key=str)


def run(spark, rows, tmp_path, partitions=3):
    schema = "doc_id long, source string, lang string, n_chars long, text string, digest string, KEY int"
    spark.createDataFrame([(*r, "x", 1) for r in rows], schema).repartition(partitions).write.parquet(f"{tmp_path}/documents.parquet")
    return merkle.op13_merkle_intervals(spark, str(tmp_path))


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [r.asDict() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = plain(merkle.op13_merkle_intervals(spark, sf))
    assert got == expected(rows) and {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("count", [1, 16, 17, 257])
def test_sources_of_all_depths(spark, tmp_path, count):
    """One source with count rows, twenty with few, so that subroots make two levels."""
    rows = [(i, "hot", "en", i, f"Text {i}") for i in range(count)]
    rows += [(1000 + i, f"s{i % 20}", None, None, "Ab") for i in range(30)]
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    assert plain(run(spark, rows, tmp_path)) == expected([dict(zip(names, r)) for r in rows])


def test_edge_rows(spark, tmp_path):
    """Null in every column, empty and very long texts, ties, repeated rows, odd sources."""
    rows = [(None, None, None, None, None), (None, None, None, None, None), (1, "", "", 0, ""), (1, "", "", 0, "Z"), (5, "é", "-", -3, "x" * 300_000), (5, "z", "e", 7, "ÄB"), (5, "z", "e", 7, "ÄB"), (-9, "Z", "e", 1, None), (2, None, "a", 1, "A\nB")]
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    got = plain(run(spark, rows, tmp_path))
    assert got == expected([dict(zip(names, r)) for r in rows]) and len(got) == len(rows)


def test_empty_table(spark, tmp_path):
    assert run(spark, [], tmp_path).count() == 0


def test_hot_source_is_dealt_to_many_tasks(spark):
    """Ranks of a source that holds all rows are right, and no range holds many of them."""
    leaves = spark.range(20_000).select(F.lit("=hot").alias("key"), F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    small = "spark.sql.adaptive.coalescePartitions.enabled"  # else ranges as small as these are put together
    spark.conf.set(small, "false")
    try:
        ranked = merkle.numbered(leaves.repartition(8, "digest"), ["id", "digest"])
        assert ranked.where("lo <> id or hi <> id or n <> 20000").count() == 0
        widest = max(r["count"] for r in ranked.groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.unset(small)
    assert widest < 20_000 * 0.6
    rows = merkle.nodes(leaves)
    assert [r["count"] for r in rows.groupBy("level").count().orderBy("level").collect()] == [20_000, 1250, 79, 5, 1]
