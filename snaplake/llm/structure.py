"""Repair of conversation structure by a run-length dynamic program.

Rows of a conversation, in order of turns, become symbols: what the row's role begins with
and its first fault (blank, duplicate, truncated). Edits give roles that read
`(s?(ua)+)?`: keep (0), re-role to user or assistant (1), delete (2; blank and duplicate rows
must go), insert an empty user or assistant row (5); a truncated row that stays adds 5.
The automaton of that pattern has four states, so a symbol is a 4 x 4 min-plus matrix from
state to state, inserts before the row included. Equal symbols in a row are one run;
the costs to go before a run are the costs behind it times the run's power, put together from
cached binary powers. The audit is unrolled forwards: in each state the first letter in
ASCII order (D, I, K, R) that keeps the cost. What a symbol does to relative costs to go
is remembered, as few differ.

Rows are dealt by ranges of (conversation, turn, role, text) and sorted there, so a long
conversation spreads over many tasks. A conversation inside one range is repaired there in
one pass. The first and last of every range may go on elsewhere: their rows come out
again, duplicates are found among them by grouping digests, one task per conversation
turns its symbols (runs, and 8 bytes a row) into edits, and one reads its rows in order
to digest them, as SHA-256 and an audit in one row ask for; texts are streamed there, not held.

Null roles and texts count as one space; null turns come first, rows of one turn are
ordered by role, then text. A null conversation id is a conversation. Rows that are equal are
rows of their own (duplicates after the first). Texts of any length are taken whole. Other
columns are not looked at. A conversation without rows costs nothing and has an empty
audit. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import bounded_batches, cut, written

#: Faults, costs, white space, roles, legal neighbours.
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
REROLE, DELETE, INSERT, KEPT_TRUNCATED = 1, 2, 5, 5
SPACE = " \t\n\v\f\r"
LEGAL = frozenset({"su", "ua", "au"})
#: States of the pattern: nothing yet, after s, after u, after a; the user or assistant row
#: that comes next leads from each to NEXT. START and AFTER_A accept.
START, AFTER_S, AFTER_U, AFTER_A = STATES = range(4)
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
SAID = {AFTER_U: "user", AFTER_A: "assistant"}
FAR = 1 << 60
GONE = ("", False)
Symbol = tuple[str, bool]  # what a row that may stay begins with, and if it is truncated; or GONE
Costs = tuple[int, int, int, int]


def symbol(role: str, fault: int) -> Symbol:
    if fault in (BLANK, DUPLICATE):
        return GONE
    return role[:1] if role[:1] in ("s", "u", "a") else "?", fault == TRUNCATED


def kept(state: int, initial: str) -> int | None:
    """The state after a kept row, or None where the pattern has no such row there."""
    if initial == "s":
        return AFTER_S if state == START else None
    return NEXT[state] if initial == ("a" if state == AFTER_U else "u") else None


@lru_cache(None)
def inserts() -> tuple[Costs, ...]:
    """Cheapest inserts from state to state."""
    table = [[0 if p == q else FAR for q in STATES] for p in STATES]
    for p in STATES:
        q, cost = p, 0
        for _ in STATES:
            q, cost = NEXT[q], cost + INSERT
            table[p][q] = min(table[p][q], cost)
    return tuple(map(tuple, table))


def product(a: tuple[Costs, ...], b: tuple[Costs, ...]) -> tuple[Costs, ...]:
    return tuple(tuple(min(min(a[p][k] + b[k][q] for k in STATES), FAR) for q in STATES) for p in STATES)


@lru_cache(None)
def power(sym: Symbol, k: int) -> tuple[Costs, ...]:
    """The min-plus matrix of 2**k rows of one symbol."""
    if k:
        half = power(sym, k - 1)
        return product(half, half)
    initial, truncated = sym
    row = [[FAR] * 4 for _ in STATES]
    for p in STATES:
        row[p][p] = DELETE
        if sym != GONE:
            extra = KEPT_TRUNCATED if truncated else 0
            row[p][NEXT[p]] = min(row[p][NEXT[p]], REROLE + extra)
            q = kept(p, initial)
            if q is not None:
                row[p][q] = min(row[p][q], extra)
    return product(inserts(), tuple(map(tuple, row)))


def relative(costs: Iterable[int]) -> Costs:
    costs = tuple(costs)
    least = min(costs)
    return tuple(min(c - least, FAR) for c in costs)


@lru_cache(None)
def behind_all() -> Costs:
    """Costs to go after the last row: inserts up to an accepting state."""
    return relative(min(inserts()[p][START], inserts()[p][AFTER_A]) for p in STATES)


@lru_cache(1 << 16)
def before_run(sym: Symbol, n: int, behind: Costs) -> Costs:
    """Costs to go before n rows of one symbol, from those behind them."""
    k = 0
    while n:
        if n & 1:
            m = power(sym, k)
            behind = relative(min(m[p][q] + behind[q] for q in STATES) for p in STATES)
        n, k = n >> 1, k + 1
    return behind


@lru_cache(1 << 16)
def moves(sym: Symbol, behind: Costs) -> tuple[tuple[str, int], ...]:
    """For each state before a row the least letters among the cheapest ones, and the state
    after the row."""
    m, (initial, truncated) = power(sym, 0), sym
    extra = KEPT_TRUNCATED if truncated else 0
    cost = [min(m[p][q] + behind[q] for q in STATES) for p in STATES]
    out = []
    for state in STATES:
        letters = ""
        while letters[-1:] in ("", "I"):
            best, to = cost[state], kept(state, initial)
            if best == DELETE + behind[state]:
                letters += "D"
            elif best == INSERT + cost[NEXT[state]]:
                letters, state = letters + "I", NEXT[state]
            elif sym != GONE and to is not None and best == extra + behind[to]:
                letters, state = letters + "K", to
            else:
                letters, state = letters + "R", NEXT[state]
        out.append((letters, state))
    return tuple(out)


#: Rows of a run whose costs to go are held at once while it is unrolled.
STRETCH = 1024


def edits(runs: list[list]) -> Iterator[tuple[int, str]]:
    """For each row of runs [symbol, rows] the state before it and its letters; at last
    the state and the letters behind all rows."""
    behind = [behind_all()]
    for sym, n in reversed(runs):
        behind.append(before_run(sym, n, behind[-1]))
    behind.pop()
    state = START
    for sym, n in runs:
        after = behind.pop()
        while n:
            take = (n - 1) % STRETCH + 1
            n -= take
            costs = [before_run(sym, n, after)]
            for _ in range(take - 1):
                costs.append(before_run(sym, 1, costs[-1]))
            for here in reversed(costs):
                letters, to = moves(sym, here)[state]
                yield state, letters
                state = to
    tail = {START: "", AFTER_A: "", AFTER_S: "II", AFTER_U: "I"}[state]
    yield state, tail


def runs_of(symbols: Iterable[Symbol]) -> list[list]:
    runs: list[list] = []
    for s in symbols:
        if runs and runs[-1][0] == s:
            runs[-1][1] += 1
        else:
            runs.append([s, 1])
    return runs


def rows_after(state: int, letters: str, role: str, text: str) -> Iterator[tuple[str, str, str]]:
    """(letter, role, text) of what the edits of one row leave."""
    for letter in letters:
        if letter == "D":
            continue
        after = kept(state, role[:1]) if letter == "K" else NEXT[state]
        state = NEXT[state] if after is None else after
        yield (letter, role, text) if letter == "K" else (letter, SAID[state], text if letter == "R" else "")


def fault_of(text: str, seen: bool) -> int:
    bare = text.rstrip(SPACE)
    if not bare:
        return BLANK
    return DUPLICATE if seen else NONE if bare[-1] in ".!?" else TRUNCATED


class Report:
    """What is returned of one conversation, from its rows in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.faults, self.illegal, self.cost = conv_id, [0, 0, 0, 0], 0, 0
        self.first = self.last = None
        self.turns, self.initial, self.letters = 0, None, []
        self.digest, self.begun = hashlib.sha256(), False

    def row(self, turn: int | None, role: str, text: str, fault: int, state: int, letters: str) -> None:
        if turn is not None and turn != self.last:
            self.first, self.last, self.turns = turn if self.first is None else self.first, turn, self.turns + 1
        if self.initial is not None and self.initial + role[:1] not in LEGAL:
            self.illegal += 1
        self.initial = role[:1]
        self.faults[fault] += 1
        if fault == TRUNCATED and letters[-1] != "D":
            self.cost += KEPT_TRUNCATED
        self.edited(state, letters, role, text)

    def edited(self, state: int, letters: str, role: str = "", text: str = "") -> None:
        self.letters.append(letters)
        self.cost += DELETE * letters.count("D") + INSERT * letters.count("I") + REROLE * letters.count("R")
        for _, r, t in rows_after(state, letters, role, text):
            self.digest.update(f"{chr(10) if self.begun else ''}{r}:{t}".encode())
            self.begun = True

    def values(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (self.conv_id, gaps, *self.faults[1:], self.illegal, self.cost, "".join(self.letters), self.digest.hexdigest())


REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
ROWS = "at long, turn long, role string, text string, live boolean"
_NAMES = [f.split()[0] for f in REPORT.split(", ")]
_KINDS = [pa.int64()] * 7 + [pa.string()] * 2
_ROW_NAMES = [f.split()[0] for f in ROWS.split(", ")]
_ROW_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_()]


def _columns(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], type=t) for k, t in enumerate(kinds)], names=names)


def _whole(conv_id: int | None, rows: list[tuple]) -> Report:
    """The report of a conversation that is all here."""
    report, seen, live = Report(conv_id), set(), []
    for _, turn, role, text, is_live in rows:
        if is_live:
            live.append((turn, role, text, fault_of(text, (role, text) in seen)))
            seen.add((role, text))
    steps = edits(runs_of(symbol(role, fault) for _, role, _, fault in live))
    for turn, role, text, fault in live:
        report.row(turn, role, text, fault, *next(steps))
    report.edited(*next(steps))
    return report


def _inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reports of the conversations that begin and end in this range, and the rows of the
    first and the last one, which may go on in others."""
    at, conv, held, number = TaskContext.get().partitionId() << 33, None, [], 0
    out: list[tuple] = []

    def edge(rows: list[tuple]) -> None:
        out.extend((conv, *[None] * 8, *r) for r in rows)

    for batch in batches:
        for c, turn, role, text, live in _columns(batch, "conv_id", "turn", "role", "text", "live"):
            if number == 0 or c != conv:
                if number > 1:
                    out.append((*_whole(conv, held).values(), *[None] * 5))
                else:
                    edge(held)
                conv, held, number = c, [], number + 1
            held.append((at, turn, role, text, live))
            at += 1
            if number == 1 and len(held) >= 1000:  # nothing of the first one needs to be held
                edge(held)
                held = []
        if out:
            yield _batch(out, _NAMES + _ROW_NAMES, _KINDS + _ROW_KINDS)
            out.clear()
    edge(held)
    if out:
        yield _batch(out, _NAMES + _ROW_NAMES, _KINDS + _ROW_KINDS)


def _symbols_to_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(at, state, letters) of each row and, with the last, what comes behind it, from the
    symbols of conversations in order."""
    conv, places, runs, begun = None, array("q"), [], False

    def close() -> Iterator[pa.RecordBatch]:
        steps, out = edits(runs), []
        for i, place in enumerate(places):
            out.append((place, *next(steps), *(next(steps) if i == len(places) - 1 else (None, None))))
            if len(out) == 10_000 or i == len(places) - 1:
                yield _batch(out, ["at", "state", "letters", "end_state", "tail"], [pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.string()])
                out = []

    for batch in batches:
        for c, at, role, fault in _columns(batch, "conv_id", "at", "initial", "fault"):
            if begun and c != conv:
                yield from close()
                places, runs = array("q"), []
            conv, begun = c, True
            places.append(at)
            sym = symbol(role, fault)
            if runs and runs[-1][0] == sym:
                runs[-1][1] += 1
            else:
                runs.append([sym, 1])
    yield from close()


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reports of conversations from their rows with edits, in order."""
    report, out = None, []
    for batch in batches:
        for c, turn, role, text, live, fault, state, letters, end_state, tail in _columns(batch, "conv_id", "turn", "role", "text", "live", "fault", "state", "letters", "end_state", "tail"):
            if report is None or c != report.conv_id:
                if report:
                    out.append(report.values())
                report = Report(c)
            if live:
                report.row(turn, role, text, fault, state, letters)
                if tail:
                    report.edited(end_state, tail)
        if out:
            yield _batch(out, _NAMES, _KINDS)
            out = []
    if report:
        yield _batch([report.values()], _NAMES, _KINDS)


def is_blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x20\x09-\x0D]")


def is_truncated(text: Column) -> Column:
    return ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")


def _over_ranges(rows: DataFrame) -> DataFrame:
    """Reports of the conversations whose rows(at, conv_id, turn, role, text, live) were dealt out."""
    text, digest = F.col("text"), F.sha2(F.col("text").cast("binary"), 256)
    firsts = rows.where("live").groupBy("conv_id", "role", digest).agg(F.min("at").alias("at")).select("at", F.lit(True).alias("is_first"))
    fault = F.when(is_blank(text), BLANK).when(F.col("is_first").isNull(), DUPLICATE).when(is_truncated(text), TRUNCATED).otherwise(NONE)
    told = cut(rows.select("at", "conv_id", "live", F.substring("role", 1, 1).alias("initial"), "text").join(firsts, "at", "left").withColumn("fault", fault).drop("text", "is_first"))
    symbols = told.where("live").select("conv_id", "at", "initial", "fault").repartition("conv_id").sortWithinPartitions("conv_id", "at")
    steps = symbols.mapInArrow(_symbols_to_edits, "at long, state int, letters string, end_state int, tail string")
    edited = rows.join(told.select("at", "fault"), "at").join(steps, "at", "left")
    ordered = edited.repartition("conv_id").sortWithinPartitions("conv_id", "at")
    return ordered.mapInArrow(_reports, REPORT)


def repair(turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", live: Column | None = None) -> DataFrame:
    """A report (see REPORT) of every conversation of turns. Rows that aren't `live` only
    tell that their conversation exists."""
    bounded_batches(turns.sparkSession)
    said = {n: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")).alias(n) for n, c in (("role", role), ("text", text))}
    rows = turns.select(F.col(f"`{conv_id}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"), said["role"], said["text"], (F.lit(True) if live is None else live).alias("live"))
    order = ["conv_id", "turn", "role", "text"]
    # Rows equal in all of these may be many: their place in the input deals them out.
    ranged = rows.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
    found = written(ranged.mapInArrow(_inside, f"{REPORT}, {ROWS}"), "structure")
    names = ", ".join(_NAMES)
    spread = _over_ranges(found.where("at is not null").select("conv_id", *_ROW_NAMES))
    return found.where("at is null").selectExpr(*names.split(", ")).unionByName(spread)


def damaged(turns: DataFrame) -> DataFrame:
    """turns(conv_id, turn, role, text) with one fault in five rows of twenty, and `live`:
    dropped rows stay, not live."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    given = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(key) % 20).alias("kind"))
    kind, text = F.col("kind"), F.col("text")
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    changed = given.withColumns({"role": F.when(kind == 4, "user").otherwise(F.col("role")), "text": text, "live": kind != 0})
    return changed.withColumn("copy", F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("copy", "kind")


def op12_run_length_repair(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return repair(damaged(turns), live=F.col("live"))
