"""Chat formatting as a prefix tree of turns.

Every turn becomes a segment of the template

    <|role|>\\n text <|end|>\\n

whose control strings can't occur inside texts: backslash, < and [ are escaped there
(roles: also | and line ends), reversibly. A node of the tree is a segment after given
segments; conversations that share their first turns share nodes. The nodes are laid
out depth-first in one stream, each once. Tokens are code points. A node has its
offset in the stream, its first position id (the length of its ancestors), its loss
mask (assistant texts) and the stream intervals of its ancestors, which with the node
itself are all that its tokens attend to. A conversation is read back by its nodes.

A node's name is a digest of the chain of segments, so building the tree is one
grouping by name. Depth-first order: conversations are sorted by the names along their
path and numbered; a node belongs to the first conversation through it. Offsets are
running sums in that order, by partition first. Conversations are streamed in order
of turns through tasks, never held, but for 8 bytes a turn that make its path. A first
turn that most conversations share is one group of partial aggregates; where ways meet
their nodes, such a node is dealt to several keys.

Turns are ordered by turn, then role and text; null turns come first, null roles and
texts count as empty. Repeated rows are turns of their own, and rows with a null
conv_id one conversation. Turns of any length are handled whole. Other columns are not
looked at. An empty table gives an empty result. The order is depth-first at any depth; a
path ends at Spark's largest binary value, 268 million turns.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, fields, shared_folder

_TEXT = str.maketrans({"\\": "\\\\", "<": "\\l", "[": "\\k"})
_ROLE = str.maketrans({"\\": "\\\\", "<": "\\l", "[": "\\k", "|": "\\p", "\n": "\\n"})
_PLAIN = {"\\": "\\", "l": "<", "k": "[", "p": "|", "n": "\n"}
_ESCAPED = re.compile(r"\\(.)")
_SEGMENT = re.compile(r"<\|([^|]*)\|>\n(.*)<\|end\|>\n", re.DOTALL)


def segment(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn and where its text starts and ends there."""
    head = f"<|{role.translate(_ROLE)}|>\n"
    body = text.translate(_TEXT)
    return f"{head}{body}<|end|>\n", len(head), len(head) + len(body)


def plain(text: str) -> str:
    return _ESCAPED.sub(lambda m: _PLAIN[m[1]], text)


def parse(seg: str) -> tuple[str, str]:
    """(role, text) of a segment."""
    found = _SEGMENT.fullmatch(seg)
    if not found:
        raise ValueError("not a segment")
    return plain(found[1]), plain(found[2])


_TURNS = "conv_id long, depth long, node binary, parent binary, n_chars long, position long, loss_start long, loss_end long, seg string, path binary"


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns in order to nodes; the last turn of a conversation has its path."""
    names = [f.split()[0] for f in _TURNS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    out: list[list] = []
    conv, node, depth, position, path, begun = None, b"", 0, 0, bytearray(), False

    def flush(upto: int) -> Iterator[pa.RecordBatch]:
        if upto > 0:
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out[:upto]], type=k) for c, k in enumerate(kinds)], names=names)
            del out[:upto]

    def close() -> None:
        if out:
            out[-1][9] = bytes(path)

    for batch in batches:
        for c, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "role", "text")), strict=True):
            if not begun or c != conv:
                close()
                conv, node, depth, position, path, begun = c, b"", 0, 0, bytearray(), True
            seg, a, b = segment(role or "", text or "")
            above, node = node, hashlib.sha256(node + seg.encode()).digest()[:16]
            loss = (a, b) if role == "assistant" else (None, None)
            out.append([c, depth, node, above or None, len(seg), position, *loss, seg, None])
            path += node[:8]
            depth, position = depth + 1, position + len(seg)
        yield from flush(len(out) - 1)
    close()
    yield from flush(len(out))


#: Ways through a node beyond which it is dealt to several keys; in large inputs a hundred-thousandth of them.
WAYS = 50_000


def _at_nodes(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """ways(conv_id, node, ..) joined with nodes(node, n_ways, ..). A node on many ways is
    repeated under several keys, and its ways are dealt to them; there are at most 100 000
    such nodes, whose names are broadcast."""
    most = max(WAYS, ways.count() // 100_000)
    parts = F.ceil(F.col("n_ways") / most).cast("int")
    shared = nodes.where(F.col("n_ways") > most).select("node", parts.alias("parts"))
    left = ways.join(F.broadcast(shared), "node", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("conv_id"), F.col("parts")).cast("int"), F.lit(0))).drop("parts")
    right = nodes.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("n_ways")
    return left.join(right, ["node", "part"]).drop("part")


def _offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The running length of the nodes of a partition."""
    total = 0
    for batch in batches:
        here = []
        for n in batch.column("n_chars").to_pylist():
            here.append(total)
            total += n
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(here, pa.int64())], names=[*batch.schema.names, "offset"])


_SPANS = "array<struct<start:bigint,end:bigint>>"
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _ancestors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, ancestors) of the nodes that a conversation owns, from its path in order."""
    conv, spans, begun = None, [], False
    for batch in batches:
        nodes, lists = [], []
        for c, node, offset, n, own in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "node", "offset", "n_chars", "own")), strict=True):
            if not begun or c != conv:
                conv, spans, begun = c, [], True
            if own:
                nodes.append(node)
                lists.append([{"start": a, "end": b} for a, b in spans])
            if spans and spans[-1][1] == offset:
                spans[-1] = (spans[-1][0], offset + n)
            else:
                spans.append((offset, offset + n))
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(lists, type=_ARROW_SPANS)], names=["node", "ancestors"])


def build(turns: DataFrame, path: str, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Write the tree of turns to path/tree and return (conv_id, depth, node), the way of
    each conversation through it. The tree's columns: node, n_ways, parent, offset, n_chars,
    position, loss_start, loss_end, seg, ancestors."""
    rows = turns.select(F.col(f"`{conv_id}`").cast("long").alias("conv_id"), *[F.col(f"`{c}`").alias(n) for c, n in ((turn, "turn"), (role, "role"), (text, "text"))])
    ways = cut(rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(_chain, _TURNS))
    ranks = cut(ways.where(F.col("path").isNotNull()).select("conv_id", "path").orderBy("path", "conv_id").select(F.col("conv_id").alias("_c"), F.monotonically_increasing_id().alias("rank")))
    ranked = ways.drop("path").join(ranks, F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c")
    same = ["parent", "n_chars", "position", "loss_start", "loss_end", "seg"]
    nodes = ranked.groupBy("node").agg(F.min(F.struct("rank", "depth")).alias("at"), F.count(F.lit(1)).alias("n_ways"), *[F.first(c).alias(c) for c in same])
    laid = cut(nodes.select("node", "n_ways", "at.rank", "at.depth", *same).orderBy("rank", "depth"))
    part = laid.withColumn("part", F.spark_partition_id())
    sizes = {r["part"]: r["n"] for r in part.groupBy("part").agg(F.sum("n_chars").alias("n")).collect()}  # one number a partition
    before, total = [], 0
    for p in range(max(sizes, default=-1) + 1):
        before.append(total)
        total += sizes.get(p, 0)
    base = F.get(F.array(*[F.lit(b).cast("long") for b in before or [0]]), F.col("part"))
    placed = cut(part.mapInArrow(_offsets, f"{fields(part)}, offset long").withColumn("offset", F.col("offset") + base).drop("part"))
    spots = placed.select("node", "n_ways", "offset", F.col("rank").alias("owner"))
    on_way = _at_nodes(ranked.select("conv_id", "rank", "depth", "node", "n_chars"), spots)
    owned = (
        on_way.select("conv_id", "depth", "node", "offset", "n_chars", (F.col("rank") == F.col("owner")).alias("own"))
        .repartition("conv_id").sortWithinPartitions("conv_id", "depth").mapInArrow(_ancestors, f"node binary, ancestors {_SPANS}")
    )
    placed.join(owned, "node").drop("rank", "depth").write.parquet(f"{path}/tree")
    return ways.select("conv_id", "depth", "node")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each conversation, from the segments of its way in order."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_intervals"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    conv, state = None, None
    done: list[tuple] = []

    def close() -> None:
        if state:
            done.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], len(state[5])))

    for batch in batches:
        cols = ("conv_id", "seg", "position", "offset", "loss_start", "loss_end", "ancestors")
        for c, seg, position, offset, a, b, ancestors in zip(*(batch.column(k).to_pylist() for k in cols), strict=True):
            if state is None or c != conv:
                close()
                conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, []]
            # What the node attends to must be just what was read before it.
            if position != state[4] or [(s["start"], s["end"]) for s in ancestors] != state[5]:
                raise ValueError(f"the ancestors of a node of conversation {c} do not fit")
            role, text = parse(seg)
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode())
            if a is not None:
                said = plain(seg[a:b])
                state[2] += len(said)
                state[3].update(said.encode())
            state[4] += len(seg)
            spans = state[5]
            if spans and spans[-1][1] == offset:
                spans[-1] = (spans[-1][0], offset + len(seg))
            else:
                spans.append((offset, offset + len(seg)))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], type=t) for k, t in enumerate(kinds)], names=names)
            done.clear()
    close()
    if done:
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], type=t) for k, t in enumerate(kinds)], names=names)


def read_back(ways: DataFrame, tree: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    n_intervals) of every conversation, from the tree."""
    read = _at_nodes(ways, tree.select("node", "n_ways", "seg", "position", "offset", "loss_start", "loss_end", "ancestors"))
    ordered = read.repartition("conv_id").sortWithinPartitions("conv_id", "depth")
    return ordered.mapInArrow(_digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_intervals long")


def op7_prefix_tree_chat(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    says = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", says), (-7, 1, "assistant", says)], "conv_id long, turn long, role string, text string")
    path = f"{shared_folder(spark).rstrip('/')}/chat-{uuid.uuid4().hex}"
    ways = build(turns.unionByName(extra), path)
    return read_back(ways, spark.read.parquet(f"{path}/tree"))
