"""The ten operators against brute force, and their defined results on odd rows."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

import public_tokenizers as P
from revflow.llm import ann, bpe, chat, chunks, decontam, graph, langid, neardup, pii, toxicity, unigram
from revflow.llm.common import Memo, held_out
from revflow.llm.queries import RANKS, VOCABULARY

SF = "/root/testdata/sf0.001"
LONG = "worte und " * 20_000
#: id, text, lang and columns whose names the operators use inside
ODD = [
    (1, None, "en"), (2, "", None), (3, "  \n ", "en"), (4, "12 34 !!", "de"), (5, "one", "en"), (6, "one two three four five six", "en"),
    (7, "ONE two three four five SIX", "en"), (7, "ONE two three four five SIX", "en"), (None, "one two three four five six", None), (8, LONG, "de"),
    (9, "mail me: a.b@c-d.org or +1 (234) 567-8901 😀", "en"),
]
EXTRA = "key string, k int, t string, id int, score string, n int, gone string, hit_id int, digest int, kept int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    base = spark.createDataFrame(ODD, "doc_id long, text string, lang string")
    extra = [f.strip().split() for f in EXTRA.split(",")]
    return base.select("*", *(F.lit(None).cast(kind).alias(name) for name, kind in extra))


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


# 1 language identification

def test_language_held_out_accuracy(docs, odd):
    model = langid.fit_on_documents(docs)
    rows = langid.predict(docs, model).join(docs.select("doc_id", "lang", held_out().alias("h")), "doc_id").filter("h").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    got = {(r.doc_id, r.lang_pred == "und") for r in langid.predict(odd, model).collect()}
    assert {i for i, und in got if und} == {1, 2, 3, 4}
    assert all(0 <= r.score <= 1 for r in langid.predict(odd, model).collect())
    left = langid.drop_unidentified(odd, model)
    assert left.columns == odd.columns and left.count() == len(ODD) - 4


def test_language_without_labels(odd):
    model = langid.fit(odd.filter("false"))
    assert {r.lang_pred for r in langid.predict(odd, model).collect()} == {"und"}
    assert langid.predict(odd.filter("false"), model).count() == 0


def test_no_document_is_dropped_for_lack_of_labels(odd):
    model = langid.fit_on_documents(odd.withColumn("lang", F.lit(None).cast("string")))
    left = langid.drop_unidentified(odd, model)
    assert left.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 5, 6, 7, 7, 8, 9]


# 2 chat formatting

def brute_repair(roles):
    best = None
    for labels in itertools.product((1, 2, 3), repeat=len(roles)):
        c = chat.total(roles, list(labels))
        if c < chat.INF and (best is None or (c, labels[::-1]) < best):
            best = (c, labels[::-1])
    return best[0], list(best[1][::-1])


def test_repair_is_minimal_and_independent_of_segments():
    from types import SimpleNamespace

    rnd = random.Random(5)
    for _ in range(400):
        roles = [rnd.randint(0, 3) for _ in range(rnd.randint(1, 6))]
        cost, labels = brute_repair(roles)
        assert chat.repair(roles) == labels and chat.total(roles, labels) == cost
        cuts = sorted(rnd.sample(range(1, len(roles)), min(len(roles) - 1, rnd.randint(0, 3))))
        parts = [roles[a:b] for a, b in zip([0, *cuts], [*cuts, len(roles)])]
        rows = [SimpleNamespace(part=i, at=0, conv=9, n=len(p), cost=sum(chat.summary(p)[0], []), rank=sum(chat.summary(p)[1], []))
                for i, p in enumerate(parts)]
        plan = chat._chain(rows)
        assert sum((chat.repair(p, *plan[i, 0][:2]) for i, p in enumerate(parts)), []) == labels


def test_chat_rows(spark):
    rnd = random.Random(7)
    kinds = ["user", "assistant", "system", "Human", "bot", "tool", None]
    rows = [(c, t, rnd.choice(kinds), rnd.choice(["a", "", None, "<|im_end|>x"])) for c in (1, 2, None) for t in range(5)]
    rows += [(3, t, rnd.choice(kinds), f"t{t}") for t in range(300)] + [(4, 0, "user", "same")] * 40
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("key", F.lit(1))
    got = defaultdict(list)
    for r in chat.format_chats(df.repartition(7)).collect():
        got[r.conv_id].append(r)
    assert sum(map(len, got.values())) == len(rows)
    for conv, out in got.items():
        out.sort(key=lambda r: r.seq)
        assert [r.seq for r in out] == list(range(len(out)))
        roles = [chat.code(r.role) for r in out]
        assert [chat.ROLES.index(r.label) for r in out] == chat.repair(roles)
        whole = "".join(r.piece for r in out)
        said = re.findall(r"<\|im_start\|>(\w+)\n", whole)
        assert whole.count("<|im_end|>") == len(said) and said[-1] == "assistant"
        body = said[said[0] == "system":]
        assert body == ["user", "assistant"] * (len(body) // 2)
        assert {r.cost for r in out} == {chat.total(roles, chat.repair(roles))}
    assert chat.format_chats(df.filter("false")).count() == 0


# 3 nearest neighbours

def test_neighbours_recall_and_scores(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float64)
    found = defaultdict(dict)
    for r in ann.neighbours(df, F.col("id") % 20 == 0).collect():
        found[r.query_id][r.rank] = (r.vec_id, r.score)
    hits = []
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        s[q] = -9
        best = set(ids[np.lexsort((ids, -s))[:20]].tolist())
        own = found[ids[q]]
        assert sorted(own) == list(range(1, 21))
        assert list(own.values()) and [own[i] for i in sorted(own)] == sorted(own.values(), key=lambda p: (-p[1], p[0]))
        assert all(abs(s[np.flatnonzero(ids == v)[0]] - c) < 1e-9 for v, c in own.values())
        hits.append(len(best & {v for v, _ in own.values()}) / 20)
    assert np.mean(hits) >= 0.9


def test_neighbours_odd_vectors_and_copies(spark):
    rows = [(i, [1.0, 2.0]) for i in range(0, 60)] + [(60, None), (61, [0.0, 0.0]), (62, [float("nan"), 1.0]), (63, [None, 1.0]),
            (64, [float("inf"), 1.0]), (None, [1.0, 1.0]), (80, [3.0, 0.5]), (100, [1.0, 2.0, 3.0]), (100, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in ann.neighbours(df, F.col("id") % 20 == 0).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(got) == {0, 20, 40, 80}  # 100 has no vector of its length beside it
    assert [v for _, v, _ in sorted(got[20])] == [i for i in [80, *range(22)] if i != 20][:20] or sorted(got[20])[0][2] >= 5.0
    for q in (0, 20, 40):
        best = sorted(((-(4.0 if i == 80 else 5.0), i) for i in [*range(60), 80] if i != q))[:20]
        assert [v for _, v, _ in sorted(got[q])] == [i for _, i in best]
    few = ann.neighbours(df.filter("vec_id in (0, 80, 61)"), F.col("id") % 20 == 0).collect()
    assert {(r.query_id, r.rank, r.vec_id) for r in few} == {(0, 1, 80), (80, 1, 0)}
    assert ann.neighbours(df.filter("false"), F.col("id") % 20 == 0).count() == 0


def test_scored_rows_do_not_grow_with_the_shards(spark, monkeypatch):
    """A query's bound is carried through the rounds: many shards return hardly more rows than few, and the answers are the same."""
    x = np.random.default_rng(9).standard_normal((1200, 16))
    df = spark.createDataFrame([(i, v.tolist(), "x", 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, v string, key int")
    plain, made, answers = ann._nearest, {}, {}
    for shard in (1200, 40):
        total = spark.sparkContext.accumulator(0)

        def counted(keep, total=total):
            run = plain(keep)

            def count(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
                out = run(queries, rows)
                total.add(len(out))
                return out

            return count

        monkeypatch.setattr(ann, "SHARD", shard)
        monkeypatch.setattr(ann, "_nearest", counted)
        answers[shard] = sorted(map(tuple, ann.neighbours(df, F.col("id") % 20 == 0).collect()))
        made[shard] = total.value
    assert answers[1200] == answers[40] and made[40] < 3 * made[1200] < 3 * 60 * 6 * 21


def test_neighbours_are_distinct_over_many_shards(spark, monkeypatch):
    """Tables cut into different shards meet a pair beside other rows; it must still be one candidate with one score."""
    monkeypatch.setattr(ann, "SHARD", 150)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 7)
    x = np.random.default_rng(3).standard_normal((900, 96))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = defaultdict(list)
    for r in ann.neighbours(df, F.col("id") % 20 == 0).collect():
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(found) == set(range(0, 900, 20))
    for q, rows in found.items():
        assert [r for r, _, _ in sorted(rows)] == list(range(1, 21))
        assert len({v for _, v, _ in rows}) == 20
        assert all(c == (x[v : v + 1] * x[q]).sum(axis=1)[0] for _, v, c in rows)


# 4 substring deduplication

def test_gear_hash_by_definition():
    data = np.random.default_rng(1).integers(0, 256, 300, dtype=np.uint8)
    h, want = 0, []
    for b in data.tolist():
        h = ((h << 1) + int(chunks.GEAR[b])) & 0xFFFF
        want.append(h)
    assert chunks.gear_hashes(data).tolist() == want


def test_passages_found_and_clean_left_alone(spark):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyzäé") for _ in range(rnd.randint(2, 9)))
    words = lambda n: " ".join(word() for _ in range(n))
    passages = [words(60) for _ in range(30)]
    rows = [(i, words(80)) for i in range(100)]
    rows += [(100 + 3 * p + j, f"{words(rnd.randint(0, 40))} {passages[p]} {words(rnd.randint(0, 40))}") for p in range(30) for j in range(3)]
    rows += [(300, None), (301, ""), (302, "x" * 5000), (303, "x" * 5000), (304, words(4)), (None, passages[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("digest", F.lit("x"))
    spans = chunks.repeated_spans(df).collect()
    held = {r.doc_id for r in spans}
    assert held == {*range(100, 190), 302, 303}
    text = dict(rows)
    for r in spans:
        if r.doc_id < 300:
            assert text[r.doc_id][r.start : r.end] in passages[(r.doc_id - 100) // 3] or passages[(r.doc_id - 100) // 3] in text[r.doc_id]
            assert r.is_first == (r.first_doc_id == r.doc_id) and (r.first_doc_id - 100) // 3 == (r.doc_id - 100) // 3
            if r.doc_id % 3 == 1:
                assert r.is_first
    assert {r.doc_id for r in spans if not r.is_first} == {i for i in held if i % 3 != 1 and i < 300} | {303}
    left = chunks.drop_repeats(df)
    assert left.columns == df.columns and left.count() == len(rows)
    got = {r.doc_id: r.text for r in left.collect()}
    assert got[100] == text[100] and len(got[101]) < len(text[101]) and got[5] == text[5] and got[303] == ""
    assert chunks.repeated_spans(df.filter("false")).count() == 0


def test_passages_of_repeated_words_and_lines_are_found_whole(spark):
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyzäé") for _ in range(rnd.randint(3, 9)))
    words = lambda n: " ".join(word() for _ in range(n))
    passages = [(w := word() + " ") * (320 // len(w)) for _ in range(20)]
    passages += [(line := words(4) + "\n") * (320 // len(line)) for _ in range(20)]
    for _ in range(20):
        few = [word() for _ in range(4)]
        passages.append(" ".join(rnd.choice(few) for _ in range(50)))
    passages += [words(40) for _ in range(20)] + ["-" * 300, "ab" * 150]
    # what stands beside a passage differs between its holders
    rows = [(10 * p + j, f"{words(rnd.randint(5, 40))}{'QRS'[j]}{t}{'XYZ'[j]}{words(rnd.randint(5, 40))}") for p, t in enumerate(passages) for j in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = defaultdict(list)
    for r in chunks.repeated_spans(df).collect():
        spans[r.doc_id].append((r.start, r.end, r.is_first))
    for i, t in rows:
        at = t.index(passages[i // 10])
        to = at + len(passages[i // 10])
        assert (at, to, i % 10 == 0) in spans[i], (i, passages[i // 10])
        assert all(at <= a and b <= to and own for a, b, own in spans[i] if (a, b, own) != (at, to, i % 10 == 0))  # a chunk first held by the second
    texts = dict(rows)
    for r in chunks.drop_repeats(df).collect():
        assert r.text == (texts[r.doc_id] if r.doc_id % 10 == 0 else texts[r.doc_id].replace(passages[r.doc_id // 10], ""))


# 5 token counts

def test_unigram_counts_equal_the_tokenizer(spark, docs, texts, odd):
    from tokenizers import Tokenizer, models, pre_tokenizers

    def reference(vocabulary, by_bytes):
        t = Tokenizer(models.Unigram(vocabulary, 0, by_bytes))
        t.pre_tokenizer = pre_tokenizers.Metaspace(replacement=unigram.SPACE, prepend_scheme="always", split=True)
        return t

    vocabulary = unigram.sentencepiece_vocabulary(P.path(VOCABULARY))
    whole = reference(vocabulary, True)
    got = {r.doc_id: r.n_tokens for r in unigram.token_counts(docs, vocabulary).collect()}
    assert got == {i: len(whole.encode(t, add_special_tokens=False).ids) for i, t in texts.items()}
    rnd = random.Random(3)
    ties = [("<unk>", 0.0)] + [(w, -float(rnd.choice([1, 1, 2, 2, 3]))) for w in "a b ab ba aa bb aab abb ▁ ▁a ▁b ▁ab bab abab c▁".split()]
    small, counter = reference(ties, False), unigram.Counter(ties)
    for _ in range(1500):
        s = "".join(rnd.choice("abab  cxyz") for _ in range(rnd.randint(0, 20)))
        assert counter.count(s)[0] == len(small.encode(s, add_special_tokens=False).ids), s
    rows = unigram.token_counts(odd, vocabulary).collect()
    assert len(rows) == len(ODD) and {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {0}


# 6 personal data

def brute_pii(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) < 256 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and pii.luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda x: (x[1], pii.KINDS.index(x[0])))


def test_iban_before_words_and_numbers():
    iban = "DE89 3704 0044 0532 0130 00"
    for after in ("", " BIC COBADEFF now", " 12 345", " GB29 NWBK 6016 1331 9268 19 X", ", then"):
        t = f"IBAN {iban}{after}"
        found = [t[a:b] for k, a, b, _ in pii.find(t) if k == "iban"]
        assert found == [iban] + ["GB29 NWBK 6016 1331 9268 19"] * ("GB29" in after), t
    assert pii.redacted(f"pay {iban} BIC COBADEFF").count("3704") == 0
    assert not any(k == "iban" for k, *_ in pii.find("IBAN DE88 3704 0044 0532 0130 00 BIC"))


def test_pii_spans(docs, texts, odd):
    rnd = random.Random(1)
    for _ in range(20_000):
        t = "".join(rnd.choice("a@.1-+ 2(0%5é4") for _ in range(rnd.randint(0, 45)))
        assert brute_pii(t) == [s[:3] for s in pii.find(t) if s[0] in pii.BASE], t
    import hashlib

    for r in pii.digests(pii.find_pii(docs)).collect():
        spans = brute_pii(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in spans) for k in pii.BASE)
    rows = {r.doc_id: r for r in pii.digests(pii.find_pii(odd)).collect()}
    assert rows[1].spans == "" and rows[9].n_email == 1 and rows[9].n_phone == 1


def test_pii_validators_context_and_redaction(odd):
    assert [s[0] for s in pii.find("bank DE89 3704 0044 0532 0130 00, not DE88 3704 0044 0532 0130 00")] == ["iban"]
    assert [s[0] for s in pii.find("SSN 219-09-9999; 219-09-9999 elsewhere and far away from that word, 000-12-3456 ssn 000-12-3456")][:1] == ["ssn"]
    assert pii.find("serial 219-09-9999") == [] and [s[0] for s in pii.find("call (555) 123-4567")] == ["local_phone"]
    out = pii.redact(odd)
    assert out.columns == odd.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[9] == "mail me: [EMAIL] or [PHONE] 😀" and got[1] is None and got[8] == LONG
    assert pii.redact(odd.filter("false")).count() == 0


# 7 decontamination

def brute_contaminated(docs, items):
    split = lambda t: [w for w in regex.split(r"[^\p{L}\p{N}]+", (t or "").lower()) if w]
    grams = lambda w, q: [" ".join(w[i : i + q]) for i in range(len(w) - q + 1)]
    items = {i: w for i, t in items if (w := split(t))}
    df = Counter(g for w in items.values() for g in set(grams(w, min(5, len(w)))))
    weight = lambda g, known: 1 + math.log(len(items) / (df[g] if g in known else 1))
    out = {}
    for d, t in docs:
        w = split(t)
        for i, x in items.items():
            q, ci = min(5, len(x)), Counter(grams(x, min(5, len(x))))
            if not set(ci) & set(grams(w, q)):
                continue  # no shared shingle, similarity 0
            best = None
            for p in range(max(1, len(w) - len(x) + 1)):
                win = w[p : p + len(x)]
                cw = Counter(grams(win, min(q, len(win)))) if win else Counter()
                both = sum(weight(g, ci) * min(ci[g], cw[g]) for g in ci)
                most = sum(weight(g, ci) * max(ci[g], cw[g]) for g in ci | cw)
                s = round(both / most, 9)
                if s >= 0.8 and (best is None or s > best[0]):
                    best = (s, p)
            if best:
                out[d, i] = best
    return out


def test_decontamination_equals_brute_force(spark):
    rnd = random.Random(2)
    vocab = ["w%d" % i for i in range(300)]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, text(rnd.randint(14, 45))) for i in range(8)] + [(8, "alpha beta gamma"), (9, None), (10, "")]
    docs = [(i, text(60)) for i in range(20)]
    for n in range(24):
        words = items[n % 8][1].split()
        if n % 3 == 1:
            words[rnd.randrange(len(words))] = "changed"
        if n % 3 == 2:
            words.insert(rnd.randrange(len(words)), "added")
        docs.append((100 + n, f"{text(20)} {' '.join(words).upper()}, {text(15)}"))
    docs += [(200, None), (201, ""), (202, "x alpha, BETA gamma y"), (203, items[0][1]), (203, items[0][1]), (204, " ".join(items[1][1].split()[:-2]))]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("item_id", F.lit("x"))
    b = spark.createDataFrame(items + items[:2], "item_id long, text string").withColumn("q", F.lit(0))
    got = {(r.doc_id, r.item_id): (r.similarity, r.word_start) for r in decontam.contaminated(d, b).collect()}
    want = brute_contaminated(docs, items)
    assert set(got) == set(want)
    assert all(abs(got[k][0] - want[k][0]) < 1e-6 for k in want)
    left = decontam.drop_contaminated(d, b)
    assert left.columns == d.columns
    assert {r.doc_id for r in left.collect()} == {i for i, _ in docs} - {i for i, _ in want}
    assert decontam.contaminated(d, b.filter("false")).count() == 0 and decontam.contaminated(d.filter("false"), b).count() == 0


def test_blocks_find_every_fingerprint_within_the_radius(spark):
    """Pigeonhole: two fingerprints that differ in at most r bits agree on one of the r + 1 blocks."""
    rnd = random.Random(6)
    rows = []
    for r in (1, 2, 7, 20, 21, 40, 63):
        for _ in range(60):
            x = rnd.getrandbits(64)
            y = x
            for bit in rnd.sample(range(64), r):
                y ^= 1 << bit
            rows.append((x - (1 << 63), y - (1 << 63), r))
    df = spark.createDataFrame(rows, "x long, y long, r int")
    shared = df.select("r", F.arrays_overlap(decontam.blocks("x", "r"), decontam.blocks("y", "r")).alias("hit"), F.size(decontam.blocks("x", "r")).alias("n"))
    assert all(r.hit and r.n == r.r + 1 for r in shared.collect())


def test_radius_misses_fewer_than_one_in_ten_thousand(spark):
    """Sets of m shingles with the most differences that similarity 0.8 allows: how often their fingerprints lie beyond the radius."""
    rng = np.random.default_rng(5)
    for m, k in ((11, 1), (20, 2), (31, 3), (41, 4), (55, 6), (100, 11)):
        r = spark.range(1).select(decontam.radius(F.lit(m), F.lit(k), F.lit(k)).alias("r")).first().r
        beyond, trials = 0, 40_000
        for _ in range(trials // 2_000):
            h = rng.integers(0, 2, (2_000, m + k, 64), dtype=np.int8)
            a, b = h[:, :m].sum(1) > m // 2, h[:, k:].sum(1) > m // 2
            beyond += int(((a != b).sum(1) > r).sum())
        assert beyond <= 4 and r < 40, (m, k, r, beyond)


def test_fingerprint_is_the_majority_of_the_shingles(spark):
    words = "a b c d e f g h i a b c d e".split()
    df = spark.createDataFrame([(words,)], "w array<string>")
    grams = sorted({" ".join(words[i : i + 5]) for i in range(10)})
    hashes = [r[0] & (1 << 64) - 1 for r in spark.createDataFrame([(g,) for g in grams], "g string").select(F.xxhash64("g")).collect()]
    want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) > len(hashes) // 2)
    for field in (8, 16, 32):
        assert df.select(decontam._fingerprint(F.col("w"), F.lit(5), field)).first()[0] & (1 << 64) - 1 == want


def test_decontamination_of_long_documents_shuffles_in_proportion(spark, monkeypatch):
    """Without broadcasts: passages in texts of 20,000 words are found, and no array of a whole text meets the items."""
    rnd = random.Random(3)
    item = " ".join(f"k{i}" for i in range(30))
    docs = [(i, " ".join(f"w{rnd.randrange(5000)}" for _ in range(20_000 if i == 1 else 300)) + (" " + item if i < 3 else "")) for i in range(6)] + [(None, item)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item), (8, "k1 k2")], "item_id long, text string")
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam.contaminated(d, b).collect()}
    assert got == {(i, x): 1.0 for i in (0, 1, 2, None) for x in (7, 8)}


def test_decontamination_with_replaced_edge_words(spark):
    """Several words replaced at an item's edges, up to the threshold, also in items of few different words."""
    rnd = random.Random(8)
    vocab = ["v%d" % i for i in range(4000)]
    text = lambda n, of=vocab: " ".join(rnd.choice(of) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([15, 24, 35, 45, 55, 59] * 5)] + [(30 + i, text(40, vocab[:6])) for i in range(6)]
    docs = []
    for i, t in items:
        words = t.split()
        for most in range(1, 2 + (len(words) - 4) // 10):
            for left in range(most + 1):
                kept = words[left : len(words) - (most - left)]
                docs.append((len(docs), " ".join([text(12 + left), *kept, text(12 + most - left)])))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam.contaminated(d, b).collect()}
    want = brute_contaminated(docs, items)
    assert len(want) > 250 and set(got) == set(want)
    assert all(abs(got[k] - want[k][0]) < 1e-6 for k in want)


# 8 near duplicates

def components_of(docs, words, percent=80):
    sets = defaultdict(list)
    for i, t in docs:
        sets[i].append(shingles(t, words))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(i for i in sets if i is not None), 2):
        if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets if i is not None}


def test_near_duplicates_equal_brute_force(spark, docs, texts, odd):
    got = {r.doc_id: r for r in neardup.near_duplicates(docs).collect()}
    want = components_of(texts.items(), 2)
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.n_shingles == len(shingles(texts[i], 2)) and r.kept == (i == r.component_id) for i, r in got.items())
    rows = neardup.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    by = {r.doc_id: r for r in rows}
    assert by[6].component_id == by[7].component_id == 6 and by[None].component_id is None and by[None].kept
    assert by[1].n_shingles == by[3].n_shingles == 0 and by[5].n_shingles == 1 and by[2].component_id == 2
    left = neardup.drop_near_duplicates(odd)
    assert left.columns == odd.columns
    assert sorted((r.doc_id or -1) for r in left.collect()) == [-1, 1, 2, 3, 4, 5, 6, 8, 9]
    assert neardup.near_duplicates(odd.filter("false")).count() == 0


def test_near_duplicate_chains_in_one_bucket(spark):
    """A chain of texts in which neighbours are linked and distant ones are not, with a hub that is not the chain's centre."""
    rnd = random.Random(4)
    base = ["v%d" % rnd.randrange(10_000) for _ in range(120)]
    rows = []
    for n in range(40):
        w = list(base)
        for _ in range(rnd.choice([2, 5, 8, 11])):
            w[rnd.randrange(len(w))] = "e%d" % rnd.randrange(10_000)
        rows.append((1000 - n, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(df).collect()} == components_of(rows, 2)


def test_what_leaves_the_tasks_grows_with_the_documents(spark, monkeypatch):
    """Near copies around the threshold: pairs of them are quadratic, what the comparing tasks hand on is not."""
    made = {}
    for name in ("_similar", "_joined"):
        def counted(*how, name=name, plain=getattr(neardup, name)):
            out = plain(*how)
            made[name] = out.count()
            return out

        monkeypatch.setattr(neardup, name, counted)
    seen = []
    for size in (100, 200, 400):
        rnd = random.Random(8)
        base = ["v%d" % i for i in range(100)]
        rows = []
        for n in range(size):
            w = list(base)
            for at in rnd.sample(range(100), 4):
                w[at] = "e%d" % rnd.randrange(10_000)
            rows.append((n, " ".join(w)))
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r.doc_id: r.component_id for r in neardup.near_duplicates(df).collect()}
        if size < 400:
            assert got == components_of(rows, 2)
        assert made["_similar"] and made["_joined"]
        seen.append(made["_similar"] + made["_joined"])
    assert seen[2] <= 3 * seen[1] + 50 and seen[1] <= 3 * seen[0] + 50 and seen[2] < 40 * 400


def test_unlike_texts_of_one_id_all_stay(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    df = spark.createDataFrame([(1, a, "x"), (1, b, "y"), (1, b, "y"), (2, b, "z"), (3, "c d e", None)], "doc_id long, text string, kept string")
    left = neardup.drop_near_duplicates(df)
    assert left.columns == df.columns and sorted((r.doc_id, r.text) for r in left.collect()) == [(1, a), (1, b), (3, "c d e")]


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    for n in (3, 40, 1500):
        a, b = np.unique(pool[:n]), np.unique(pool[n // 3 : n + n // 3])
        s = neardup.signatures([a, b], 192)
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((s[0] == s[1]).mean() - true) < 0.12
        assert (neardup.signatures([b], 192)[0] == s[1]).all()  # a signature doesn't depend on the batch


# 9 toxicity

def test_toxicity_finds_insults(spark, docs, odd):
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = toxicity.fit(big, labels)
    rows = toxicity.score(big, model).join(labels, "doc_id").join(big.select("doc_id", "text", held_out().alias("h")), "doc_id").filter("h").collect()
    insult = re.compile("idiot|moron|stupid|worthless|pathetic|trash|disgusting|loser|scum|clown")
    plain = [r for r in rows if not r.toxic and not insult.search(r.text.lower())]
    assert sum(r.score >= 0.7 for r in plain) <= 0.03 * len(plain)
    loud = [r for r in rows if r.toxic and len(insult.findall(r.text.lower())) > 2]
    assert sum(r.score >= 0.5 for r in loud) >= 0.7 * len(loud)
    got = toxicity.score(odd, model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.fit(big.filter("false"), labels) is None
    assert {r.score for r in toxicity.score(odd, None).collect()} == {0.0}


def test_string_kernel_tolerates_gaps():
    k = toxicity.Kernel(["idiot", "garden"])
    same, gap, other = k(["idiot", "idixot", "thereby"])[:, 0]
    assert same > gap > 10 * other
    assert toxicity.sentences("you i d i o t. i.d.i.o.t!")[0][1] == "idiot" and toxicity.sentences(None) == [[]]


# 10 byte-level BPE

def test_bpe_equals_tiktoken(docs, texts, odd):
    import tiktoken

    ranks = bpe.read_ranks(P.path(RANKS))
    reference = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=dict(ranks), special_tokens={})
    rows = bpe.round_trip(docs, P.path(RANKS), P.PATTERN).collect()
    assert all(list(r.token_ids) == reference.encode_ordinary(texts[r.doc_id]) and bytes(r.decoded) == texts[r.doc_id].encode() for r in rows)
    for r in bpe.round_trip(odd, P.path(RANKS), P.PATTERN).collect():
        text = dict((i, t) for i, t, _ in ODD)[r.doc_id] or ""
        assert list(r.token_ids) == reference.encode_ordinary(text) and bytes(r.decoded) == text.encode()
    codec = bpe.Codec(ranks, P.PATTERN)
    for s in ("<|endoftext|>", " \t\n  x", "日本語テキスト", "a" * 5000, "é̀‍👩‍👩‍👧", "\u0085 x\x1c y"):
        assert codec.encode(s) == reference.encode_ordinary(s)
    assert bpe.round_trip(odd.filter("false"), P.path(RANKS), P.PATTERN).count() == 0


def test_bpe_merges_a_repeated_piece_once():
    import tiktoken

    ranks = bpe.read_ranks(P.path(RANKS))
    codec, asked = bpe.Codec(ranks, P.PATTERN), []
    compute = codec.memo.compute
    codec.memo.compute = lambda k: asked.append(k) or compute(k)
    text = "".join(" " + "".join(w) for w in itertools.islice(itertools.product("qaezx", "bdou", "ertyuiop", "asdfghjkl", "nmvxc", "aeiou", "stn"), 75_000))
    ids = codec.encode(text)
    assert codec.encode(text) == ids and len(asked) == len(set(asked)) == 75_000
    reference = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=dict(ranks), special_tokens={})
    assert ids == reference.encode_ordinary(text)
    rnd = random.Random(5)
    for n in [*range(2, 12), 63, 64, 65, 66, 300, 2000]:  # the links of pieces up to 64 bytes are prepared
        for letters in ("ab", "abcdefghinorst", "éàüß日本"):
            s = "".join(rnd.choices(letters, k=n))
            assert codec.encode(s) == reference.encode_ordinary(s)
    runs = [codec.encode(s) for s in ("", "one two", "", "né 😀", "")]
    ends = np.cumsum([0, *map(len, runs)]).astype(np.int32)
    decoded = codec.decode(pa.array([i for r in runs for i in r], pa.int32()), ends).to_pylist()
    assert decoded == [s.encode() for s in ("", "one two", "", "né 😀", "")]
    assert codec.decode(pa.array([], pa.int32()), np.zeros(3, np.int32)).to_pylist() == [b"", b""]


def test_perfect_hash_is_minimal():
    keys = [str(i).encode() for i in range(5000)]
    h = bpe.PerfectHash(keys)
    assert sorted(h.slot(k) for k in keys) == list(range(5000)) and h.slot(b"no") == -1


# whole texts, repeated blocks

def test_bitmap_misses_no_id(spark):
    docs = spark.range(-500, 20_000).select(F.when(F.col("id") % 97 != 5, F.col("id")).alias("id"), F.lit("x").alias("word"))
    ids = spark.range(-500, 20_000).filter("id % 7 = 0").unionByName(spark.sql("select cast(null as long) id"))
    told = graph.maybe_in(docs, "id", ids, "maybe")
    assert told.columns == ["id", "word", "maybe"] and told.count() == docs.count()
    assert told.filter("id % 7 = 0 and not maybe").count() == 0  # no id is missed
    assert told.filter("maybe and (id is null or id % 7 <> 0)").count() <= 20  # few others pass: 3,000 of 34 million bits are set
    want = {r[0] for r in docs.filter("id % 7 = 0").collect()}
    assert {r[0] for r in graph.picked(docs, ids).select("id").collect()} == want
    assert graph.maybe_in(docs, "id", ids.limit(0), "maybe").filter("maybe").count() == 0


def test_components(spark):
    from revflow.llm.graph import components

    rnd = random.Random(9)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000 + i) for i in range(80)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long").repartition(5)).collect()}
    assert got == {n: find(n) for a, b in edges if a != b for n in (a, b)}


def test_bpe_decodes_null_and_empty_lists(spark):
    path = P.path(RANKS)
    codec = bpe.Codec(bpe.read_ranks(path), P.PATTERN)
    rows = [(1, codec.encode("one two")), (2, None), (3, []), (4, codec.encode("né à 😀")), (None, codec.encode("x"))]
    out = bpe.decode(spark.createDataFrame(rows, "doc_id long, token_ids array<int>").coalesce(1), path).collect()
    assert {r.doc_id: bytes(r.decoded).decode() for r in out} == {1: "one two", 2: "", 3: "", 4: "né à 😀", None: "x"}
    assert [r.token_ids for r in sorted(out, key=lambda r: r.doc_id or 0)][2] is None


def test_memo_is_bounded_and_keeps_no_long_key():
    asked = []
    memo = Memo(lambda k: asked.append(k) or len(k), cap=3, longest=4)
    assert [memo[k] for k in ("a", "bb", "a", "ccccc", "ccccc", "ddd", "eeee", "a", "bb")] == [1, 2, 1, 5, 5, 3, 4, 1, 2]
    assert asked == ["a", "bb", "ccccc", "ccccc", "ddd", "eeee"]  # a and bb came from the older generation
    assert len(memo) + len(memo.old) <= 2 * 3 and "ccccc" not in memo and "ccccc" not in memo.old
