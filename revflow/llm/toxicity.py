"""Operator 9: toxicity by a support vector machine over a gapped subsequence string kernel with Nystroem landmarks.

Words are compared by their three-letter subsequences within five letters, each weighted DECAY to the power of the letters
it spans, so inserted letters lower the similarity but do not break it; signs and digits inside a word are removed first and
spelled-out letters ("i d i o t") are joined. The word kernel is the inner product of these weights, divided by the lengths of
both words' lists of occurrence weights, to the power POWER; the sentence kernel is the sum over the word pairs of two sentences. Landmark words give the Nystroem map K_mm^(-1/2) k_m, on
which a linear support vector machine is trained. Because the map is additive over words, a word's part of the decision is one
number, remembered by word. A sentence counts each of its distinct words once and is cut into pieces of at most PIECE words; a
document's score is the logistic value of the mean of its ``top`` highest pieces (of all its pieces, if fewer).

Learning is multiple-instance: a toxic document has at least one toxic sentence. The fit reads at most ``per_class`` labelled
documents of each label (smallest hashes). Landmarks are the words and word beginnings most typical of toxic documents (document
frequency less its expectation, in standard deviations), none the beginning of another. From each document INSTANCES pieces,
those nearest the landmarks, are training rows; the support vector machine and the choice of a toxic document's ``top`` highest
pieces alternate. ``top`` is the one of TOPS with the smallest log loss in a cross-validation of FOLDS folds over the training documents.

Defined results: a null or empty text, or one without letters, has one empty sentence and the score of the bare intercept; without
labelled documents of both labels every score is 0. Labels that are null count for nothing, a document with several labels is
toxic if one says so; of an id's texts the smallest is learned from; repeated rows are scored alike; only the id, text and label columns are read.
"""

from __future__ import annotations

import re
from heapq import nlargest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revflow.llm.common import held_out, map_rows
from revflow.llm.graph import staged
from revflow.llm.langid import linear_svm, sample

DECAY, POWER, PIECE, INSTANCES = 0.6, 3, 12, 12
TOPS, FOLDS = (1, 2, 3), 3
LANDMARKS = 48
THRESHOLD = 0.7
_GAPS = [(a, b) for b in range(2, 5) for a in range(1, b)]
_BITS = 20
_K = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)

_SENTENCE = re.compile(r"[.!?]+\s+|\n+")
_SIGNS = re.compile(r"[^\w\s]+|[\d_]+")
_SPELLED = re.compile(r"(?<!\S)\w(?: \w){2,}(?!\S)")


def sentences(text: str | None) -> list[list[str]]:
    """Lists of at most PIECE words; at least one list, which may be empty."""
    out = []
    for s in _SENTENCE.split((text or "").lower()):
        s = _SPELLED.sub(lambda m: m[0].replace(" ", ""), _SIGNS.sub("", s))
        words = list(dict.fromkeys(s.split()))
        out += [words[i : i + PIECE] for i in range(0, len(words), PIECE)]
    return out or [[]]


def _subsequences(words: list[str]):
    """Yield (word index, code, weight) arrays of every gapped three-letter subsequence."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    word = np.repeat(np.arange(len(words)), [len(w) for w in words])
    a = flat * _K[0]
    for g1, g2 in _GAPS:
        if len(flat) <= g2:
            continue
        inside = np.flatnonzero(word[:-g2] == word[g2:])
        code = (a[inside] ^ (flat[inside + g1] * _K[1]) + (flat[inside + g2] * _K[2])) * _K[1]
        yield word[inside], code >> np.uint32(32 - _BITS), DECAY ** (g2 + 1)


class Kernel:
    """Kernel values of words against the landmark words."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        m = len(landmarks)
        found: dict[int, np.ndarray] = {}
        norm = np.zeros(m)
        for w, code, weight in _subsequences(landmarks):
            for i, c in zip(w.tolist(), code.tolist()):
                found.setdefault(c, np.zeros(m, np.float32))[i] += weight
                norm[i] += weight**2
        self.row = np.full(1 << _BITS, -1, np.int32)
        codes = sorted(found)
        self.row[codes] = np.arange(len(codes))
        table = np.array([found[c] for c in codes], np.float32).reshape(len(codes), m)
        self.table = table / np.sqrt(np.maximum(norm, 1e-9)).astype(np.float32)

    def __call__(self, words: list[str]) -> np.ndarray:
        """len(words) x landmarks; a word of fewer than three letters has value 0 everywhere."""
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        norm = np.zeros(len(words))
        for w, code, weight in _subsequences(words):
            norm += np.bincount(w, minlength=len(words)) * weight**2
            r = self.row[code]
            hit = r >= 0
            if hit.any():
                own = w[hit]  # ascending, so each word's hits are one run
                first = np.flatnonzero(np.diff(own, prepend=-1))
                out[own[first]] += np.add.reduceat(self.table[r[hit]], first) * np.float32(weight)
        out /= np.sqrt(np.maximum(norm, 1e-9))[:, None].astype(np.float32)
        return np.maximum(out, 0) ** POWER


class Model:
    def __init__(self, landmarks: list[str], top: int = TOPS[0]):
        self.top = top
        self.kernel = Kernel(landmarks)
        k = self.kernel(landmarks).astype(np.float64)
        k = (k + k.T) / 2
        value, vector = np.linalg.eigh(k)
        self.map = (vector * np.where(value > 1e-6, np.maximum(value, 1e-6) ** -0.5, 0)) @ vector.T
        self.weights: np.ndarray | None = None
        self.intercept = 0.0
        self.logistic = (0.0, -1e9)

    def word_scores(self, words: list[str]) -> np.ndarray:
        return self.kernel(words) @ (self.map @ self.weights).astype(np.float32)

    def learn(self, bags: list[np.ndarray], toxic: np.ndarray, toxic_share: float) -> None:
        """Alternate: support vector machine on each toxic bag's chosen row and all clean rows; choose again; then fit the logistic."""
        clean = np.concatenate([b for b, y in zip(bags, toxic) if not y])
        chosen = [list(range(min(self.top, len(b)))) for b in bags]
        for _ in range(5):
            rows = np.concatenate([b[c] for b, c, y in zip(bags, chosen, toxic) if y])
            x = np.concatenate([rows, clean]).astype(np.float32)
            x = np.column_stack([x, np.ones(len(x), np.float32)])
            y = np.concatenate([np.ones(len(rows)), -np.ones(len(clean))]).astype(np.float32)
            w = linear_svm(x, y, decay=1e-4, steps=1500)
            self.weights, self.intercept = w[:-1].astype(np.float64), float(w[-1])
            tops = [b @ self.weights for b in bags]
            chosen = [np.argsort(-t, kind="stable")[: self.top].tolist() for t in tops]
        top = np.array([t[c].mean() for t, c in zip(tops, chosen)]) + self.intercept
        share = np.where(toxic, toxic_share / toxic.sum(), (1 - toxic_share) / (~toxic).sum())
        a, c = 1.0, 0.0
        for _ in range(50):  # Newton steps of a weighted one-variable logistic regression with a slight pull to a = 1, c = 0
            p = 1 / (1 + np.exp(-np.clip(a * top + c, -30, 30)))
            g = np.array([(share * (p - toxic) * top).sum() + 1e-4 * (a - 1), (share * (p - toxic)).sum() + 1e-4 * c])
            v = share * p * (1 - p)
            h = np.array([[(v * top * top).sum() + 1e-4, (v * top).sum()], [(v * top).sum(), v.sum() + 1e-4]])
            a, c = np.array([a, c]) - np.linalg.solve(h, g)
        self.logistic = (float(a), float(c))

    def probability(self, top: float) -> float:
        a, c = self.logistic
        return float(1 / (1 + np.exp(-np.clip(a * (top + self.intercept) + c, -500, 500))))


def _train_docs(docs: DataFrame, labels: DataFrame, per_class: int) -> tuple[DataFrame, float]:
    """(label, text) of the bounded sample, staged, and the share of toxic documents."""
    known = (labels.filter("doc_id is not null and toxic is not null").filter(~held_out())
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    share = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    ids = sample(known, F.col("toxic"), "doc_id", "doc_id", per_class, 2 * per_class).select("label", F.col("text").alias("doc_id"))
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # ids: at most 2 * per_class
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))  # of an id's texts always the same one
    return staged(rows.select("label", "text"), "toxicity-sample"), share


def _landmarks(train: DataFrame) -> list[str]:
    """Words and word beginnings that toxic documents hold more often than their share says, none the beginning of another."""
    def start():
        def work(b: pa.RecordBatch) -> pa.RecordBatch:
            rows = [(y, w) for y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                    for w in sorted({w[:k] for s in sentences(t) for w in s for k in range(4, min(len(w), 16) + 1)})]
            return pa.record_batch([pa.array([y for y, _ in rows], pa.int32()), pa.array([w for _, w in rows], pa.string())], names=["y", "w"])

        return work

    count = {r.label: r["count"] for r in train.groupBy("label").count().collect()}
    if len(count) < 2:
        return []
    share = count[1] / (count[0] + count[1])
    words = map_rows(train.select("label", "text"), start, "y int, w string").groupBy("w").agg(
        F.sum("y").alias("a"), F.count("*").alias("n")).filter("a >= 3").withColumn(
            "z", F.round((F.col("a") - share * F.col("n")) / F.sqrt(F.col("n") * share * (1 - share)), 9))
    first = words.filter("z > 3").orderBy(F.desc("z"), F.desc(F.length("w")), "w").limit(20 * LANDMARKS).collect()
    chosen: list[str] = []
    for r in first:
        if len(chosen) < LANDMARKS and not any(r.w.startswith(c) or c.startswith(r.w) for c in chosen):
            chosen.append(r.w)
    return chosen


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1500) -> Model | None:
    """The model, or None when there are no documents of both labels or no toxic word."""
    train, share = _train_docs(docs, labels, per_class)
    landmarks = _landmarks(train)
    if not landmarks:
        return None
    model = Model(landmarks)
    model_map = model.map.astype(np.float32)

    def start():
        def work(b: pa.RecordBatch) -> pa.RecordBatch:
            bags = []
            for t in b.column(1).to_pylist():
                parts = sentences(t)
                words = sorted({w for s in parts for w in s})
                at = {w: i for i, w in enumerate(words)}
                k = model.kernel(words) if words else np.zeros((0, len(landmarks)), np.float32)
                near = k.max(1) if len(words) else np.zeros(0)
                rank = sorted(range(len(parts)), key=lambda i: (-sum(near[at[w]] for w in parts[i]), i))[:INSTANCES]
                bags.append(b"".join((k[[at[w] for w in parts[i]]].sum(0) @ model_map).astype(np.float32).tobytes() for i in rank))
            return pa.record_batch([b.column(0), pa.array(bags, pa.binary())], names=["y", "x"])

        return work

    rows = map_rows(train.select("label", "text"), start, "y int, x binary").collect()  # at most 2 * per_class * INSTANCES vectors
    rows.sort(key=lambda r: (r.y, bytes(r.x)))
    bags = [np.frombuffer(r.x, np.float32).reshape(-1, len(landmarks)) for r in rows]
    toxic = np.array([r.y == 1 for r in rows])
    model.top = min(TOPS, key=lambda top: (_log_loss(landmarks, bags, toxic, share, top), top))
    model.learn(bags, toxic, share)
    return model


def _log_loss(landmarks: list[str], bags: list[np.ndarray], toxic: np.ndarray, share: float, top: int) -> float:
    """Mean log loss of documents that a model of the other folds scores, each label with its share."""
    loss = np.zeros(len(bags))
    fold = np.empty(len(bags), int)
    for label in (False, True):  # every fold has both labels
        fold[toxic == label] = np.arange((toxic == label).sum()) % FOLDS
    for f in range(FOLDS):
        own, rest = np.flatnonzero(fold == f), np.flatnonzero(fold != f)
        if not len(own) or toxic[rest].all() or not toxic[rest].any():
            continue
        model = Model(landmarks, top)
        model.learn([bags[i] for i in rest], toxic[rest], share)
        for i in own:
            p = min(max(model.probability(_mean_top((bags[i] @ model.weights).tolist(), top)), 1e-6), 1 - 1e-6)
            loss[i] = -np.log(p if toxic[i] else 1 - p)
    return float(np.round(share * loss[toxic].mean() + (1 - share) * loss[~toxic].mean(), 9))


def _mean_top(values: list[float], top: int) -> float:
    best = nlargest(top, values)
    return sum(best) / len(best)


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every whole text."""
    src = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).alias("t"))

    def start():
        known: dict[str, float] = {}

        def work(b: pa.RecordBatch) -> pa.RecordBatch:
            texts = b.column(1).to_pylist()
            if model is None:
                return pa.record_batch([b.column(0), pa.array([0.0] * len(texts))], names=["k", "score"])
            if len(known) > 500_000:
                known.clear()
            docs = [sentences(t) for t in texts]
            new = sorted({w for d in docs for s in d for w in s}.difference(known))
            for at in range(0, len(new), 20_000):
                part = new[at : at + 20_000]
                known.update(zip(part, model.word_scores(part).tolist()))
            look = known.__getitem__
            tops = [_mean_top([sum(map(look, s)) for s in d], model.top) for d in docs]
            return pa.record_batch([b.column(0), pa.array([model.probability(x) for x in tops], pa.float64())], names=["k", "score"])

        return work

    return map_rows(src, start, "k long, score double").withColumnRenamed("k", id_col)
