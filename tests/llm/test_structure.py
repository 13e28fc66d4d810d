"""Conversation repair against a plain recursion over all edits."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from snaplake.llm import structure

NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SF = "/root/testdata/sf0.001"


def damage(rows):
    out = []
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(c, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit) of (initial, fault) rows: the least pair over all edits."""

    @lru_cache(None)
    def best(i, said, inserted):
        """said: what was said last, '' at first; inserted: rows inserted since the last row."""
        after = {"": "su", "s": "u", "u": "a", "a": "u"}[said]
        found = [(0, "")] if i == len(rows) and said in ("", "a") else []
        if inserted < 4:
            found += [(5 + c, "I" + t) for x in after if x != "s" for c, t in [best(i, x, inserted + 1)] if t is not None]
        if i < len(rows):
            initial, fault = rows[i]
            steps = [(2, "D", said)]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                steps += [(more, "K", initial)] if initial and initial in after else []
                steps += [(1 + more, "R", x) for x in after if x != "s"]
            for cost, letter, x in steps:
                c, t = best(i + 1, x, 0)
                if t is not None:
                    found.append((cost + c, letter + t))
        return min(found, default=(10**9, None))

    return best(0, "", 0)


def expected(rows, given=None):
    """The reports of rows; conversations of `given` without rows are reported too."""
    by_conv = {r[0]: [] for r in (given or rows)}
    for r in rows:
        by_conv[r[0]].append(r)
    out = []
    for c, held in by_conv.items():
        held.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        faults, seen = [], set()
        for _, _, role, text in held:
            bare = re.sub(r"[\x20\x09-\x0D]", "", text)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
            seen.add((role, text))
        cost, audit = cheapest(tuple((r[2][:1], f) for r, f in zip(held, faults)))
        lines, said, i = [], "", 0
        for letter in audit:
            role, text = ("", "") if letter == "I" else held[i][2:]
            i += letter != "I"
            if letter == "D":
                continue
            if letter != "K":
                role = "assistant" if said == "u" else "user"
            said = role[:1]
            lines.append(f"{role}:{text}")
        assert re.fullmatch("(s?(ua)+)?", "".join(x[:1] for x in lines))
        turns = {r[1] for r in held} - {None}
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(held, held[1:]))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((c, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    assert df.columns == NAMES
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def random_rows(seed, convs, most):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "Why", "", " \t", "Because it is.", "Same.", "Same.", "ends \n", "ends. \n", "é?", "漢字"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "User", "", "support", "assistant "]
    return [(c, r.choice([t, t, t + 2, None]), r.choice(roles), r.choice(texts) + r.choice(["", f"{t}."])) for c in range(convs) for t in range(r.randrange(1, most))]


def test_powers_are_repeated_steps():
    for sym in [structure.GONE, ("u", False), ("a", True), ("s", False), ("?", True)]:
        for n in (1, 2, 3, 7, 64, 1000):
            stepped = structure.behind_all()
            for _ in range(n):
                stepped = structure.before_run(sym, 1, stepped)
            assert structure.before_run(sym, n, structure.behind_all()) == stepped


@pytest.mark.parametrize("seed", range(300))
def test_cheapest_and_least_audit(seed):
    r = random.Random(seed)
    rows = []
    for _ in range(r.randrange(0, 6)):
        rows += [(r.choice("sua?"), r.choice(["", "", "blank", "truncated"]))] * r.choice([1, 1, 2, 5])
    code = {"": 0, "blank": 1, "truncated": 3}
    steps = list(structure.edits(structure.runs_of(structure.symbol(i, code[f]) for i, f in rows)))
    assert "".join(letters for _, letters in steps) == cheapest(tuple(rows))[1]


def test_random_conversations(spark):
    rows = random_rows(1, 120, 9)
    assert got(structure.repair(frame(spark, rows).repartition(5))) == expected(rows)


def test_given_table_damaged(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(structure.op12_run_length_repair(spark, SF)) == expected(damage(rows), rows)


def test_edge_rows(spark, tmp_path):
    """Nulls everywhere, repeated rows, a conversation that loses all rows, long texts, odd columns."""
    lost = next(c for c in range(100, 10_000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    rows = [(None, None, None, None), (None, 3, "user", "Hi."), (1, None, "user", None), (1, None, "user", "x."), (1, 2, None, "y?"), (2, 1, "user", "z" * 200_000), (2, 2, "assistant", "Ok."), (2, 2, "assistant", "Ok."), (3, 5, "system", "Only."), (lost, 1, "user", "Gone."), (4, -3, "user", "A."), (4, 9, "assistant", "B.")]
    frame(spark, rows).withColumn("audit", F.lit(1)).withColumn("LIVE", F.lit(0)).write.parquet(f"{tmp_path}/conversations.parquet")
    found = got(structure.op12_run_length_repair(spark, str(tmp_path)))
    assert found == expected(damage(rows), rows)
    assert (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in found
    assert got(structure.repair(frame(spark, rows).withColumn("at", F.lit("x")).withColumnRenamed("conv_id", "a.b"), conv_id="a.b")) == expected([(c, t, r or " ", x or " ") for c, t, r, x in rows])
    assert structure.repair(frame(spark, []), conv_id="conv_id").count() == 0


def test_conversation_over_many_ranges(spark):
    """One conversation holds most rows and spreads over ranges; its neighbours are whole."""
    r = random.Random(5)
    rows = [(7, t, r.choice(["user", "assistant"]), r.choice(["Same.", f"New {t}.", f"Cut {t}", ""])) for t in range(3000)] + random_rows(2, 6, 7)
    small = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(small, "false")
    try:
        found = got(structure.repair(frame(spark, rows).repartition(4)))
    finally:
        spark.conf.unset(small)
    others = [x for x in rows if x[0] != 7]
    assert [f for f in found if f[0] != 7] == [e for e in expected(others) if e[0] != 7]
    seven = next(f for f in found if f[0] == 7)
    hot = [x for x in rows if x[0] == 7]
    whole = structure._whole(7, [(0, t, role, text, True) for _, t, role, text in hot]).values()
    assert seven == whole
