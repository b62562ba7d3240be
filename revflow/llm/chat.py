"""Operator 2: chat formatting with minimum-cost role repair.

The legal order of a conversation is an automaton: an optional system turn, then user and assistant in turn, an assistant turn last.
For every turn dynamic programming over the automaton's states chooses its label (another one than its own role costs RELABEL) and
how it follows: as the next legal turn (free), merged into the open turn of the same label (MERGE), or after empty inserted turns
(INSERT each). Missing last turns are inserted too. Among repairs of equal cost the one whose labels, read from the last turn
backwards, come first in the order system, user, assistant is taken. The repaired turns are rendered with a template.

A conversation may be any share of the table: rows are range-partitioned by conversation and turn, so a long one is spread over many
tasks. Steps of the program are (min, +) matrices; the first and last conversation of each partition are summarised as one matrix
(with the order of tied entry states), the driver chains these (two for each partition, whatever the rows), and every partition
then repairs its rows knowing the states at its borders. Partitions are pinned by a checkpoint, so a lost executor changes nothing.

Output: one row for each input turn; concatenating ``piece`` by ``seq`` gives the rendered conversation.

Defined results: turns are ordered by turn, role, text (nulls first); repeated rows are turns like any other and usually merge. A null or
unknown role takes any label for RELABEL. A null text counts as empty. Null conversation ids are one conversation. Template markers
inside texts lose their bars, so a text can't open a turn. Other columns are dropped.
"""

from __future__ import annotations

from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revflow.session import ensure_checkpoint_dir

ROLES = ("", "system", "user", "assistant")
ALIASES = {"human": "user", "prompter": "user", "customer": "user", "bot": "assistant", "ai": "assistant", "gpt": "assistant",
           "model": "assistant", "developer": "system"}
MERGE, RELABEL, INSERT = 2, 3, 4
OPEN, CLOSE, JOIN = "<|im_start|>{}\n", "<|im_end|>\n", "\n"
INF = 1 << 60

#: Empty turns that must come between a state (0: nothing yet) and a label; pairs that aren't here are illegal.
BETWEEN = {
    (0, 1): (), (0, 2): (), (0, 3): (2,), (1, 2): (), (1, 3): (2,), (2, 3): (), (3, 2): (), (2, 2): (3,), (3, 3): (2,),
}
AFTER = {1: (2, 3), 2: (3,), 3: ()}


def code(role: str | None) -> int:
    r = (role or "").strip().lower()
    r = ALIASES.get(r, r)
    return ROLES.index(r) if r in ROLES else 0


def step(state: int, label: int, role: int) -> tuple[int, bool]:
    """(cost, merged) of giving ``label`` to a turn of ``role`` after ``state``."""
    cost, merged = INF, False
    if (state, label) in BETWEEN:
        cost = INSERT * len(BETWEEN[state, label])
    if state == label and MERGE <= cost:
        cost, merged = MERGE, True
    return cost + (label != role) * RELABEL, merged


_STEP = [[[step(s, x, r)[0] for x in range(4)] for s in range(4)] for r in range(4)]
_END = [0, *(INSERT * len(AFTER[s]) for s in (1, 2, 3))]


def summary(roles: list[int]) -> tuple[list[list[int]], list[list[int]]]:
    """(cost[entry][exit], rank[entry][exit]) of a run of turns: entries of equal total cost are taken by the smaller rank."""
    cost = [[0 if s == e else INF for e in range(4)] for s in range(4)]
    rank = [[0] * 4 for _ in range(4)]
    for r in roles:
        new, order, table = [[INF] * 4 for _ in range(4)], [[0] * 4 for _ in range(4)], _STEP[r]
        for x in (1, 2, 3):
            keys = []
            for s in range(4):
                c, p = min((cost[s][p] + table[p][x], p) for p in range(4))
                new[s][x] = min(c, INF)
                keys.append((p, rank[s][p], s))
            for n, (_, _, s) in enumerate(sorted(keys)):
                order[s][x] = n
        cost, rank = new, order
    return cost, rank


def repair(roles: list[int], entry: int = 0, leave: int | None = None) -> list[int]:
    """Labels of the turns from state ``entry`` to state ``leave`` (None: to the end of the conversation)."""
    cost, back = [0 if s == entry else INF for s in range(4)], []
    for r in roles:
        best = [min((cost[p] + _STEP[r][p][x], p) for p in range(4)) for x in range(1, 4)]
        cost = [INF, *(min(c, INF) for c, _ in best)]
        back.append([0, *(p for _, p in best)])
    state = leave if leave is not None else min(range(1, 4), key=lambda s: (cost[s] + _END[s], s))
    labels = []
    for choice in reversed(back):
        labels.append(state)
        state = choice[state]
    return labels[::-1]


def total(roles: list[int], labels: list[int], entry: int = 0, ends: bool = True) -> int:
    states = [entry, *labels]
    return sum(_STEP[r][s][x] for r, s, x in zip(roles, states, labels)) + (_END[labels[-1]] if ends else 0)


def _segments(batches):
    """(conversation, [(turn, role, text)]) of each run of rows with one conversation id."""
    def rows():
        for b in batches:
            yield from zip(*(c.to_pylist() for c in b.columns))

    for conv, part in groupby(rows(), key=lambda r: r[0]):
        yield conv, [r[1:] for r in part]


def _summaries(batches):
    def row(at, conv, roles):
        cost, rank = summary(roles)
        return (TaskContext.get().partitionId(), at, conv, len(roles), sum(cost, []), sum(rank, []))

    out, last, n = [], None, 0
    for conv, rows in _segments(batches):
        last = (conv, [code(r[1]) for r in rows])
        if n == 0:
            out.append(row(0, *last))
        n += 1
    if n > 1:
        out.append(row(1, *last))
    if out:
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        names = ["part", "at", "conv", "n", "cost", "rank"]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def _chain(rows) -> dict[tuple[int, int], tuple]:
    """(part, at) -> (entry state, leave state or None, rows before it, begins, ends, total cost) of the border segments."""
    rows = sorted(rows, key=lambda r: (r.part, r.at))
    single = {r.part for r in rows} - {r.part for r in rows if r.at == 1}
    runs: list[list] = []
    for r in rows:
        joined = runs and r.at == 0 and runs[-1][-1].conv == r.conv and runs[-1][-1].part < r.part and (
            runs[-1][-1].at == 1 or runs[-1][-1].part in single)
        (runs[-1].append(r) if joined else runs.append([r]))
    plan = {}
    for run in runs:
        vectors = [[0, INF, INF, INF]]
        for r in run:
            vectors.append([min(min(vectors[-1][s] + r.cost[4 * s + e], INF) for s in range(4)) for e in range(4)])
        state = min(range(1, 4), key=lambda s: (vectors[-1][s] + _END[s], s))
        cost, before = vectors[-1][state] + _END[state], sum(r.n for r in run)
        for i in reversed(range(len(run))):
            r, v = run[i], vectors[i]
            before -= r.n
            entry = min(range(4), key=lambda s: (v[s] + r.cost[4 * s + state], r.rank[4 * s + state]))
            plan[r.part, r.at] = (entry, state, before, i == 0, i == len(run) - 1, cost)
            state = entry
    return plan


def _clean(text: str | None) -> str:
    return (text or "").replace("<|im_start|>", "<im_start>").replace("<|im_end|>", "<im_end>")


def _rendered(conv, rows, entry, leave, before, begins, ends, cost):
    roles = [code(r[1]) for r in rows]
    labels = repair(roles, entry, leave)
    if cost is None:
        cost = total(roles, labels)
    state = entry
    for i, ((turn, role, text), r, label) in enumerate(zip(rows, roles, labels)):
        merged = step(state, label, r)[1]
        inserted = () if merged else BETWEEN[state, label]
        empty = "".join(OPEN.format(ROLES[x]) + CLOSE for x in inserted)
        piece = JOIN if merged else (CLOSE if state else "") + empty + OPEN.format(ROLES[label])
        piece += _clean(text)
        added = [ROLES[x] for x in inserted]
        if ends and i == len(rows) - 1:
            piece += CLOSE + "".join(OPEN.format(ROLES[x]) + CLOSE for x in AFTER[label])
            added += [ROLES[x] for x in AFTER[label]]
        action = "+".join(["relabel"] * (label != r) + ["merge"] * merged) or "keep"
        yield conv, before + i, turn, role, ROLES[label], action, added, piece, cost
        state = label


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """(conv_id, seq, turn, role, label, action, inserted, piece, cost); see the module's text."""
    spark = turns.sparkSession
    ensure_checkpoint_dir(spark)
    src = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("role"),
                       F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("tie"))  # the tie spreads repeated rows
    order = ["conv_id", "turn", "role", "text", "tie"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pinned = src.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("tie").checkpoint()
    borders = pinned.select("conv_id", "turn", "role", F.lit("").alias("text")).mapInArrow(
        _summaries, "part int, at int, conv long, n long, cost array<long>, rank array<long>").collect()  # at most two rows for each partition
    plan = _chain(borders)
    last = {p: at for p, at in sorted(plan)}

    def run(batches):
        part = TaskContext.get().partitionId()
        out, held = [], None

        def flush(conv, rows, first, final):
            at = 0 if first else 1 if final else None
            how = plan[part, at] if at is not None else (0, None, 0, True, True, None)
            return _rendered(conv, rows, *how)

        def batch(rows):
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.int64())
            names = ["conv_id", "seq", "turn", "role", "label", "action", "inserted", "piece", "cost"]
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        n = 0
        for conv, rows in _segments(batches):
            if held:
                out += flush(*held, n == 1, False)
            held, n = (conv, rows), n + 1
            if len(out) > 2000:
                yield batch(out)
                out = []
        if held:
            out += flush(*held, n == 1, last[part] == 1)
        for at in range(0, len(out), 2000):
            yield batch(out[at : at + 2000])

    return pinned.mapInArrow(run, "conv_id long, seq long, turn long, role string, label string, action string, inserted array<string>, piece string, cost long")
