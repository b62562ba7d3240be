"""Operator 13: conversation structure repair by a run-length dynamic program.

Every turn is a symbol: its role's initial (s, u, a or another) with its first fault. Faults are blank (no visible character), duplicate
(role and text seen earlier in the conversation) and truncated (the last visible character ends no sentence). Edits are Keep (0),
Rerole to the legal next one of user and assistant (1), Delete (2; the only one for blank and duplicate turns) and Insert of an empty
user or assistant turn (5); a truncated turn that is not deleted adds 5. The cheapest edits that leave the roles (s?(ua)+)? are
taken; of those the ones whose initials, read in order, come first in ASCII.

A turn with the insertions before it is one transition between the automaton's four states, a (min, +) matrix whose entries also carry
the order of the tied audits. Equal consecutive symbols are collapsed to runs; a run of length L is advanced by the cached powers
M, M^2, M^4, ... of its transition, and its choices are unrolled by halving those powers.

A conversation may be any share of the table: rows are range-partitioned by conversation and turn and pinned by a checkpoint. The first
and the last conversation of a partition are summarised as one matrix each; the driver chains these (two for each partition,
whatever the rows), and each partition then repairs its rows knowing the states at its borders. What was seen earlier is found by one
aggregate over (conversation, role, text), combined before its shuffle, and joined back by the row's position, which is unique.
A task holds the turns of one conversation within one partition.

Output: a row for each turn after repair and for each deleted one; see ``repair``. ``digests`` folds these rows to one for each
conversation; each task first joins the turns of a conversation to pieces of at most PIECE characters, so that a long conversation
reaches the task that hashes it as a few rows, one at a time.

Defined results: turns are ordered by turn (nulls first); turns of one number by role, the text's first 32 characters, then its hash.
Repeated rows are duplicates. Null roles and texts are taken as
one space. A null conversation id is a conversation. Other columns are dropped. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revflow.session import ensure_checkpoint_dir

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Characters of repaired text or audit in one row on its way to a conversation's digest.
PIECE = 1 << 18
VISIBLE = r"[^\x20\x09-\x0D]"
INF = 1 << 60

#: States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant. The role that may be inserted, and the state it leads to.
NEXT = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
LEGAL = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
#: Insertions that close a conversation left in each state.
CLOSING = (0, 2, 1, 0)
FAULTS = ("", "blank", "duplicate", "truncated")


def _step(state: int, symbol: str) -> dict[int, tuple[int, str]]:
    """exit state -> (cost, letters) of one turn with the insertions before it. ``symbol``: initial and fault's initial."""
    role, fault = symbol
    out: dict[int, tuple[int, str]] = {}
    for n in range(4):  # more insertions would run in a circle
        head, spent = "I" * n, INSERT * n
        choices = [(state, DELETE, "D")]
        if fault not in "bd":
            late = TRUNCATED if fault == "t" else 0
            choices.append((NEXT[state][1], REROLE + late, "R"))
            if (state, role) in LEGAL:
                choices.append((LEGAL[state, role], KEEP + late, "K"))
        for to, cost, letter in choices:
            out[to] = min(out.get(to, (INF, "")), (spent + cost, head + letter))
        state = NEXT[state][1]
    return out


class Matrix:
    """cost[entry][exit], the exits of each entry by their audits (rank), and what the best way passes (via)."""

    def __init__(self, cost, rank, via=None):
        self.cost, self.rank, self.via = cost, rank, via

    def then(self, other: Matrix) -> Matrix:
        cost, rank, via = [], [], []
        for q in range(4):
            c, order, mid = [], [], []
            for e in range(4):
                # audits of the first part are of different text for different states between, and none begins another
                best = min((min(self.cost[q][p] + other.cost[p][e], INF), self.rank[q][p], p) for p in range(4))
                c.append(best[0]), mid.append(best[2])
                order.append((best[1], other.rank[best[2]][e], e))
            place = {x[2]: i for i, x in enumerate(sorted(order))}
            cost.append(c), rank.append([place[e] for e in range(4)]), via.append(mid)
        return Matrix(cost, rank, via)


UNIT = Matrix([[0 if q == e else INF for e in range(4)] for q in range(4)], [[0] * 4 for _ in range(4)])


@lru_cache(maxsize=None)  # 16 symbols, at most 63 powers of each
def power(symbol: str, k: int) -> Matrix:
    """The transition of 2^k equal turns."""
    if k:
        half = power(symbol, k - 1)
        return half.then(half)
    cost, rank = [], []
    for q in range(4):
        ways = _step(q, symbol)
        cost.append([ways[e][0] if e in ways else INF for e in range(4)])
        order = sorted(range(4), key=lambda e: (e not in ways, ways.get(e, (0, ""))[1]))
        rank.append([order.index(e) for e in range(4)])
    return Matrix(cost, rank)


def run_length(symbols: list[str]) -> list[tuple[str, int]]:
    return [(s, len(list(same))) for s, same in groupby(symbols)]


def _blocks(runs):
    """(symbol, k) of the powers of two that make up the runs, in order."""
    for symbol, n in runs:
        for k in reversed(range(n.bit_length())):
            if n >> k & 1:
                yield symbol, k


def summary(symbols: list[str]) -> Matrix:
    total = UNIT
    for symbol, k in _blocks(run_length(symbols)):
        total = total.then(power(symbol, k))
    return total


def _unroll(symbol: str, k: int, entry: int, leave: int, out: list[tuple[str, int]]) -> None:
    """(letters, state after it) of each of 2^k equal turns between two states."""
    if k == 0:
        out.append((_step(entry, symbol)[leave][1], leave))
        return
    mid = power(symbol, k).via[entry][leave]
    _unroll(symbol, k - 1, entry, mid, out)
    _unroll(symbol, k - 1, mid, leave, out)


def edits(symbols: list[str], entry: int = 0, leave: int | None = None) -> list[tuple[str, int]]:
    """(letters, state after it) of each turn from ``entry`` to ``leave`` (None: to the end of the conversation, without its closing)."""
    blocks = list(_blocks(run_length(symbols)))
    cost, rank, back = UNIT.cost[entry], [0] * 4, []
    for symbol, k in blocks:
        m = power(symbol, k)
        best = [min((min(cost[p] + m.cost[p][e], INF), rank[p], p) for p in range(4)) for e in range(4)]
        order = sorted((best[e][1], m.rank[best[e][2]][e], e) for e in range(4))
        cost, rank = [b[0] for b in best], [[o[2] for o in order].index(e) for e in range(4)]
        back.append([b[2] for b in best])
    state = leave if leave is not None else min(range(4), key=lambda e: (cost[e] + INSERT * CLOSING[e], rank[e]))
    ways = []
    for (symbol, k), via in zip(reversed(blocks), reversed(back)):
        ways.append((symbol, k, via[state], state))
        state = via[state]
    out: list[tuple[str, int]] = []
    for symbol, k, a, b in reversed(ways):
        _unroll(symbol, k, a, b, out)
    return out


# rows

def damaged(turns: DataFrame) -> DataFrame:
    """The damage of the contract, by crc32 of ``conv_id:turn`` modulo 20: drops, empties, cuts, repeats or relabels turns."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind, text = F.crc32(key) % 20, F.coalesce("text", F.lit(" "))
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), kind.alias("kind")).filter("kind <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def _fault() -> Column:
    """The number in FAULTS of a row's first fault."""
    last = F.regexp_extract("text", rf"({VISIBLE})[\x20\x09-\x0D]*\z", 1)
    return (F.when(last == "", F.lit(1)).when(F.col("seen"), F.lit(2)).when(~last.isin(".", "!", "?"), F.lit(3)).otherwise(F.lit(0)))


def _pinned(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, turn, role, text, fault) in order over the partitions, which stay as they are."""
    spark = turns.sparkSession
    ensure_checkpoint_dir(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = turns.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                       F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"))
    src = src.withColumns({"head": F.substring("text", 1, 32), "tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    # the range key holds no whole text, as a sample of it goes to the driver; the row number spreads repeated rows
    placed = src.repartitionByRange(n, "conv_id", "turn", "role", "head", "tie", "row").sortWithinPartitions("conv_id", "turn", "role", "head", "tie", "row")
    placed = placed.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("place")).checkpoint()
    first = placed.groupBy("conv_id", "role", "text").agg(F.min("place").alias("place")).select("place", F.lit(False).alias("again"))
    known = placed.join(first, "place", "left").withColumn("seen", F.coalesce("again", F.lit(True)))
    known = known.withColumn("fault", _fault())
    return known.repartitionByRange(n, "place").sortWithinPartitions("place").select("conv_id", "turn", "role", "text", "fault").checkpoint()


def _symbol(role: str, fault: int) -> str:
    return (role[:1] if role[:1] in ("s", "u", "a") else "x") + (FAULTS[fault][:1] or "-")


def _segments(batches):
    """(conversation, rows without it) of each run of rows with one conversation id."""
    def rows():
        for b in batches:
            yield from zip(*(c.to_pylist() for c in b.columns))

    for conv, part in groupby(rows(), key=lambda r: r[0]):
        yield conv, [r[1:] for r in part]


_BORDER = "part int, at int, conv long, n long, cost array<long>, rank array<int>"


def _borders(batches):
    out, last, n = [], None, 0
    part = TaskContext.get().partitionId()

    def row(at, conv, rows):
        m = summary([_symbol(*r) for r in rows])
        return (part, at, conv, len(rows), sum(m.cost, []), sum(m.rank, []))

    for last in _segments(batches):
        if n == 0:
            out.append(row(0, *last))
        n += 1
    if n > 1:
        out.append(row(1, *last))
    if out:
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()))
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["part", "at", "conv", "n", "cost", "rank"])


def _chain(rows) -> dict[tuple[int, int], tuple[int, int | None, int, bool]]:
    """(part, at) -> (entry state, leave state or None for the conversation's end, turns before it, ends the conversation)."""
    rows = sorted(rows, key=lambda r: (r.part, r.at))
    several = {r.part for r in rows if r.at == 1}
    runs: list[list] = []
    for r in rows:
        open_end = runs and runs[-1][-1].conv == r.conv and r.at == 0 and (runs[-1][-1].at == 1 or runs[-1][-1].part not in several)
        (runs[-1].append(r) if open_end else runs.append([r]))
    plan = {}
    for run in runs:
        cost, rank, back = UNIT.cost[0], [0] * 4, []
        for r in run:
            best = [min((min(cost[p] + r.cost[4 * p + e], INF), rank[p], p) for p in range(4)) for e in range(4)]
            order = sorted((best[e][1], r.rank[4 * best[e][2] + e], e) for e in range(4))
            cost, rank = [b[0] for b in best], [[o[2] for o in order].index(e) for e in range(4)]
            back.append([b[2] for b in best])
        state = min(range(4), key=lambda e: (cost[e] + INSERT * CLOSING[e], rank[e]))
        before = sum(r.n for r in run)
        for i in reversed(range(len(run))):
            before -= run[i].n
            entry = back[i][state]
            plan[run[i].part, run[i].at] = (entry, state, before, i == len(run) - 1)
            state = entry
    return plan


_OUT = "conv_id long, seq long, turn long, role string, text string, fault string, edit string, new_role string, new_text string, cost long"
_KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64())


def _mended(conv, rows, entry, leave, before, ends):
    """Output rows of one conversation's rows within a partition."""
    state, seq = entry, 4 * before  # at most three insertions come before a turn
    for (turn, role, text, fault), (letters, after) in zip(rows, edits([_symbol(r[1], r[3]) for r in rows], entry, leave)):
        for i in range(len(letters) - 1):
            new, state = NEXT[state]
            yield conv, seq + i, None, None, None, None, "I", new, "", INSERT
        edit, late = letters[-1], TRUNCATED * (fault == 3)
        cost = {"K": KEEP + late, "R": REROLE + late, "D": DELETE}[edit]
        new = {"K": role, "R": NEXT[state][0], "D": None}[edit]
        yield conv, seq + 3, turn, role, text, FAULTS[fault] or None, edit, new, text if new is not None else None, cost
        state, seq = after, seq + 4
    for i in range(CLOSING[state] if ends else 0):
        new, state = NEXT[state]
        yield conv, seq + i, None, None, None, None, "I", new, "", INSERT


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, seq, turn, role, text, fault, edit, new_role, new_text, cost) of every turn and every inserted one.

    ``edit`` is K, R, D or I; ``seq`` orders a conversation's rows (with gaps); inserted rows have no turn, role, text and fault, deleted
    ones no new role and text. The repaired conversation is the rows with a new role.
    """
    pinned = _pinned(turns, conv_col, turn_col, role_col, text_col)
    plan = _chain(pinned.select("conv_id", "role", "fault").mapInArrow(_borders, _BORDER).collect())  # at most two for each partition
    several = {p for p, at in plan if at == 1}

    def run(batches):
        part = TaskContext.get().partitionId()
        out, held, n = [], None, 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), _KINDS)], names=[f.split()[0] for f in _OUT.split(", ")])

        def flush(final):
            at = 0 if n == 1 else 1 if final and part in several else None
            return _mended(*held, *(plan[part, at] if at is not None else (0, None, 0, True)))

        for segment in _segments(batches):
            if held:
                for row in flush(False):
                    out.append(row)
                    if len(out) == 2000:
                        yield batch()
                        out = []
            held, n = segment, n + 1
        if held:
            for row in flush(True):
                out.append(row)
                if len(out) == 2000:
                    yield batch()
                    out = []
        if out:
            yield batch()

    return pinned.mapInArrow(run, _OUT)


# one row for each conversation

_PART = "conv_id long, seq long, blank long, duplicate long, truncated long, illegal long, first string, last string, cost long, audit string, body string, lines long"
_NAMES = [f.split()[0] for f in _PART.split(", ")]
_PART_KINDS = (*[pa.int64()] * 6, pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())


def _pair(a: str, b: str) -> int:
    return int((a[:1] + b[:1]) not in ("su", "ua", "au"))


def _pieces(batches):
    """Consecutive rows of a conversation as rows of at most about PIECE characters."""
    def rows():
        for b in batches:
            yield from zip(*(c.to_pylist() for c in b.columns))

    def piece(conv, seq, faults, illegal, first, last, cost, audit, lines):
        return (conv, seq, faults["blank"], faults["duplicate"], faults["truncated"], illegal, first, last, cost, "".join(audit), "\n".join(lines), len(lines))

    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), _PART_KINDS)], names=_NAMES)

    out, room = [], 0
    for conv, part in groupby(rows(), key=lambda r: r[0]):
        open_, size = None, 0
        for _, seq, role, fault, edit, new_role, new_text, cost in part:
            if open_ is None:
                open_, size = [conv, seq, dict.fromkeys(FAULTS[1:], 0), 0, None, None, 0, [], []], 0
            if fault:
                open_[2][fault] += 1
            if role is not None:
                open_[3] += _pair(open_[5], role) if open_[5] is not None else 0
                open_[4] = role[:1] if open_[4] is None else open_[4]
                open_[5] = role[:1]
            open_[6] += cost
            open_[7].append(edit)
            if new_role is not None:
                open_[8].append(f"{new_role}:{new_text}")
                size += len(open_[8][-1])
            size += 1
            if size >= PIECE:
                out.append(piece(*open_))
                open_ = None
                yield batch(out)
                out, room = [], 0
        if open_ is not None:
            out.append(piece(*open_))
            room += size
        if room >= PIECE or len(out) >= 2000:
            yield batch(out)
            out, room = [], 0
    if out:
        yield batch(out)


def _folded(batches):
    """The pieces of a conversation, in order, to its row; texts are hashed as they pass."""
    def rows():
        for b in batches:
            for i in range(b.num_rows):
                yield tuple(c[i].as_py() for c in b.columns)

    names = ["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    kinds = (*[pa.int64()] * 6, pa.string(), pa.string())
    out = []
    for conv, part in groupby(rows(), key=lambda r: r[0]):
        sums, cost, audit, sha, some, last = [0] * 4, 0, [], hashlib.sha256(), False, None
        for _, _, *counts, begin, end, c, a, body, lines in part:
            sums = [x + y for x, y in zip(sums, counts)]
            if begin is not None:
                sums[3] += _pair(last, begin) if last is not None else 0
                last = end
            cost += c
            audit.append(a)
            if lines:
                sha.update(b"\n" * some + body.encode())
                some = True
        out.append((conv, *sums, cost, "".join(audit), sha.hexdigest()))
        if len(out) == 2000:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def digests(mended: DataFrame, turns: DataFrame, all_turns: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation of ``all_turns``.

    ``mended`` is the result of ``repair(turns)``; conversations that are not in it have zeros, no audit and the hash of nothing.
    """
    pieces = mended.select("conv_id", "seq", "role", "fault", "edit", "new_role", "new_text", "cost").mapInArrow(_pieces, _PART)
    n = int(mended.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    folded = pieces.repartition(n, "conv_id").sortWithinPartitions("conv_id", "seq").mapInArrow(
        _folded, "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
    conv = F.col("conv_id").cast("long").alias("conv_id")
    turn = F.col("turn").cast("long").alias("turn")
    distinct = turns.select(conv, turn).distinct().groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    rest = {c: F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    found = all_turns.select(conv).distinct()
    for side in (distinct, folded):
        side = side.withColumnRenamed("conv_id", "other_id")
        found = found.join(side, found.conv_id.eqNullSafe(side.other_id), "left").drop("other_id")
    return found.select("conv_id", *rest.values(), F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
