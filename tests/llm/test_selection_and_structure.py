"""Importance resampling, exact dedup and conversation repair against brute force, and their defined results on odd rows."""

import hashlib
import heapq
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from revflow.llm import exact, mend, resample
from revflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
EXTRA = "h string, piece int, norm int, row string, head int, nth int, rank string, weight int, part int, at int, fault int, place int, seen string, tie int"
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "A b"), (5, "a B"), (5, "a B"), (None, "a B"), (None, None), (6, "x" * 70_000), (7, "wort und " * 30_000),
       (8, "é Ünï 1a2-b_c " * 9), (9, "\x00null byte\x7f and delete " * 5), (10, "one two  three\nfour " * 6)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def with_extra(df):
    return df.select("*", *(F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in EXTRA.split(", ")))


@pytest.fixture(scope="module")
def odd(spark):
    return with_extra(spark.createDataFrame(ODD, "doc_id long, text string")).repartition(5)


# 11 importance resampling

def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def features_of(text):
    w = words_of(text)
    return [zlib.crc32(x.encode()) % 10000 for x in w + [" ".join(p) for p in zip(w, w[1:])]]


def brute_draw(docs, items):
    s, t = Counter(b for _, x in docs for b in features_of(x)), Counter(b for x in items for b in features_of(x))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)]
    rows = []
    for i, x in docs:
        f = features_of(x)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words_of(x)) >= 20))
    fit = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], math.inf if r[0] is None else r[0]))
    rank = [(*r[:4], k + 1 if k < 25 * len(fit) // 100 else None) for k, r in enumerate(fit)]
    return Counter(rank + [(*r[:4], None) for r in rows if not r[4]])


def drawn(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())


def test_resampling_equals_brute_force(spark, docs):
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert drawn(QUERIES["op11_importance_resample"](spark, SF)) == brute_draw([(r.doc_id, r.text) for r in docs.collect()], items)


def test_resampling_of_odd_rows_and_segments(spark, odd, monkeypatch):
    target = spark.createDataFrame([("a b one two",), (None,), ("é ünï",)], "text string")
    want = brute_draw(ODD, ["a b one two", None, "é ünï"])
    assert drawn(resample.draw(odd, target)) == want
    small = spark.createDataFrame(ODD * 3, "doc_id long, text string")
    assert drawn(resample.draw(small, target)) == brute_draw(ODD * 3, ["a b one two", None, "é ünï"])
    kept = resample.resample(odd, target)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {r[0] for r in want if r[4]}
    assert drawn(resample.draw(odd, target.filter("false"))) == brute_draw(ODD, [])
    assert resample.draw(odd.filter("false"), target).count() == 0
    assert resample.resample(odd.filter("false"), target).count() == 0
    # long texts in segments: same counts and sums, whatever the segment
    text = ("wort UND äöü " * 900 + "x" * 9000 + " ") * 3
    whole = Counter(features_of(text))
    for size in (64, 1000, 1 << 20):
        monkeypatch.setattr(resample, "SEGMENT", size)
        import pyarrow as pa

        got, words = Counter(), 0
        for _, g in resample._batches(pa.array([text, None, "", "a b"]), 2):
            got.update(g.bucket[g.slot].tolist())
            words += int(g.words.sum())
        assert got == whole + Counter(features_of("a b")) and words == len(words_of(text)) + 2


def test_interned_spans():
    rng = random.Random(5)
    parts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, n))) for n in (4, 9, 20, 34, 70) for _ in range(300)]
    buf = np.frombuffer(b"".join(parts) + bytes(8), np.uint8)
    size = np.array([len(p) for p in parts])
    start = np.cumsum(size) - size
    assert resample.hash_spans(buf, start, size).tolist() == [xxhash.xxh64_intdigest(p) for p in parts]
    slot, owner = resample.intern_spans(buf, start, size)
    assert [parts[o] for o in owner[slot]] == parts and len(set(slot.tolist())) == len(set(parts))


def test_colliding_keys_are_told_apart_by_their_bytes(monkeypatch):
    monkeypatch.setattr(resample, "hash_spans", lambda buf, start, size: np.full(len(start), 7, np.uint64))
    parts = [b"aa", b"ab", b"aa", b"b" * 40, b"b" * 39 + b"c", b"b" * 40, b"a"]
    buf = np.frombuffer(b"".join(parts) + bytes(8), np.uint8)
    size = np.array([len(p) for p in parts])
    slot, owner = resample.intern_spans(buf, np.cumsum(size) - size, size)
    assert [parts[o] for o in owner[slot]] == parts and len(set(slot.tolist())) == 5


# 12 exact dedup

def brute_groups(rows, largest):
    ids = defaultdict(list)
    for i, x in rows:
        ids[x or ""].append(i)
    out = Counter()
    for x, group in ids.items():
        known = [i for i in group if i is not None]
        keep = (max if largest else min)(known) if known else None
        for k, i in enumerate(sorted(group, key=lambda i: i != keep)):
            out[i, keep, len(group), k == 0, hashlib.sha256(x.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_groups(spark, docs, odd, keep):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert Counter(tuple(r) for r in exact.groups(docs, keep=keep).collect()) == brute_groups(rows, keep == "largest")
    assert Counter(tuple(r) for r in exact.groups(odd, keep=keep).collect()) == brute_groups(ODD, keep == "largest")
    left = exact.drop_copies(odd, keep=keep)
    want = brute_groups(ODD, keep == "largest")
    assert left.columns == odd.columns and left.count() == sum(n for k, n in want.items() if k[3])


def test_exact_groups_of_hot_and_long_texts(spark):
    rows = [(i, "same") for i in range(400)] + [(1000 + i, "y" * 50_000 + str(i % 2)) for i in range(30)] + [(2000 + i, f"text {i}") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert Counter(tuple(r) for r in exact.groups(df, keep="largest").collect()) == brute_groups(rows, True)
    lower = exact.groups(spark.createDataFrame([(1, "A"), (2, "a")], "doc_id long, text string"), normalise=F.lower)
    assert {(r.doc_id, r.keep_id, r.kept) for r in lower.collect()} == {(1, 1, True), (2, 1, False)}
    assert exact.groups(df.filter("false")).count() == 0 and exact.drop_copies(df.filter("false")).count() == 0
    with pytest.raises(ValueError):
        exact.groups(df, keep="first")


def test_exact_groups_need_no_further_exchange_and_no_python(spark, docs):
    plan = exact._found(docs, "text", "doc_id", True, None, False)
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()


# 13 conversation repair

LEGAL_ROLES = re.compile(r"(s?(ua)+)?")


def brute_edits(rows):
    """(cost, audit, repaired) of rows (role, text, fault): Dijkstra over (turns read, roles' state), the roles checked by expression."""
    def extend(state, r):  # the roles so far by their last and whether there is one
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}.get((state, r))

    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) + 1:
            return cost, audit, "\n".join(lines)
        if i == len(rows):
            if state in ("", "a"):
                heapq.heappush(heap, (cost, audit, i + 1, state, lines))
        for r, name in (("u", "user"), ("a", "assistant")):
            if (to := extend(state, r)) is not None:
                heapq.heappush(heap, (cost + 5, audit + "I", i, to, (*lines, f"{name}:")))
                if i < len(rows) and rows[i][2] not in ("blank", "duplicate"):
                    heapq.heappush(heap, (cost + 1 + 5 * (rows[i][2] == "truncated"), audit + "R", i + 1, to, (*lines, f"{name}:{rows[i][1]}")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state, lines))
            if fault not in ("blank", "duplicate") and (to := extend(state, role[:1])) is not None:
                heapq.heappush(heap, (cost + 5 * (fault == "truncated"), audit + "K", i + 1, to, (*lines, f"{role}:{text}")))


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        visible = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def brute_conversations(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv]
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        convs[conv] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for conv, turns in convs.items():
        turns.sort(key=lambda r: (-math.inf if r[0] is None else r[0], r[1], r[2]))
        known = [t for t, _, _ in turns if t is not None]
        marked = faults_of([r[1:] for r in turns])
        count = Counter(f for _, _, f in marked)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, body = brute_edits(marked)
        out[conv] = (conv, max(known) - min(known) + 1 - len(set(known)) if known else 0, count["blank"], count["duplicate"], count["truncated"],
                     illegal, cost, audit, hashlib.sha256(body.encode()).hexdigest())
    return out


def conversations(df):
    hurt = mend.damaged(df)
    return {r.conv_id: tuple(r) for r in mend.digests(mend.repair(hurt), hurt, df).collect()}


def test_conversations_equal_brute_force(spark):
    for sf in (SF, "/root/testdata/sf0.01"):
        df = spark.read.parquet(f"{sf}/conversations.parquet")
        got = QUERIES["op13_conversation_repair"](spark, sf).collect()
        assert {r.conv_id: tuple(r) for r in got} == brute_conversations([tuple(r) for r in df.collect()]) and len(got) == len({r.conv_id for r in got})


def test_conversations_of_odd_rows(spark):
    rng = random.Random(11)
    texts = ["ok.", "no stop", "", "  ", None, "same.", "what? ", "a\u0085", "äh!"]
    roles = ["user", "assistant", "system", "tool", None, "", "usr", "Agent"]
    rows = [(rng.choice([1, 2, 3, None, 4, 5, 6, 7]), rng.choice([None, 0, 1, 2, 3, 9, 10, 11, 12]), rng.choice(roles[: rng.choice([2, 3, 8])]), rng.choice(texts)) for _ in range(300)]
    rows += [(50, t, "user" if t % 2 == 0 else "assistant", f"turn {t}." if t % 7 else "again.") for t in range(900)]  # longer than a partition
    rows += [(51, 3, "user", "one.")] * 60 + [(52, None, "system", "x.")] * 3 + [(53, 5, "user", "long. " * 100_000)]
    df = with_extra(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).repartition(7)
    assert conversations(df) == brute_conversations(rows)
    assert conversations(df.filter("false")) == {}


def test_rows_of_a_repair(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi."), (1, 1, "user", "still."), (1, 2, "bot", "yes."), (1, 3, "user", "")], "conv_id long, turn long, role string, text string")
    rows = sorted(mend.repair(df).collect(), key=lambda r: r.seq)
    assert "".join(r.edit for r in rows) == "DKRD" and [r.new_role for r in rows] == [None, "user", "assistant", None]
    assert [r.fault for r in rows] == [None, None, None, "blank"] and sum(r.cost for r in rows) == 5


def test_runs_and_powers_equal_the_plain_program():
    rng = random.Random(3)
    symbols = [a + b for a in "suax" for b in "-bdt"]
    named = {"-": None, "b": "blank", "d": "duplicate", "t": "truncated"}
    for trial in range(400):
        line = [s for s in rng.choices(symbols, weights=[8 if s[1] == "-" else 2 for s in symbols], k=rng.randrange(1, 7)) for _ in range(rng.choice([1, 1, 2, 5, 17]))]
        cost, audit, _ = brute_edits([(s[0], "", named[s[1]]) for s in line])
        ways = mend.edits(line)
        got = "".join(w for w, _ in ways) + "I" * mend.CLOSING[ways[-1][1]]
        assert got == audit, (line, got, audit)
        cut = rng.randrange(len(line) + 1)
        m = mend.summary(line[:cut]).then(mend.summary(line[cut:]))
        whole = mend.summary(line)
        assert m.cost == whole.cost and min(whole.cost[0][e] + 5 * mend.CLOSING[e] for e in range(4)) == cost
        for q, e, f in itertools.product(range(4), repeat=3):
            if whole.cost[q][e] < mend.INF and whole.cost[q][f] < mend.INF:
                assert (m.rank[q][e] < m.rank[q][f]) == (whole.rank[q][e] < whole.rank[q][f])


def test_pieces_of_long_conversations(spark, monkeypatch):
    rows = [(7, t, "user" if t % 2 == 0 else "assistant", f"words of turn {t}.") for t in range(200)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    mended = mend.repair(df)
    want = mend.digests(mended, df, df).collect()
    import pyarrow as pa

    narrow = mended.select("conv_id", "seq", "role", "fault", "edit", "new_role", "new_text", "cost").collect()
    batch = pa.RecordBatch.from_pylist([r.asDict() for r in sorted(narrow, key=lambda r: r.seq)])
    monkeypatch.setattr(mend, "PIECE", 100)
    pieces = list(mend._pieces([batch]))
    assert sum(p.num_rows for p in pieces) > 10
    folded = [r for b in mend._folded(pieces) for r in b.to_pylist()]
    assert [(r["conv_id"], r["cost"], r["audit"], r["repaired_sha256"]) for r in folded] == [(r.conv_id, r.cost, r.audit, r.repaired_sha256) for r in want]
