"""Operator 1: language identification by hierarchical discrimination.

A text becomes the L2-normalised vector of its hashed character 1- to 3-grams (lower case, anything but letters read as a
space). One-versus-rest linear support vector machines first choose the language family; within the family, one linear support
vector machine for each pair of languages votes, votes first, then summed margins, then the smaller name. The score is the
product of the logistic confidences of both steps.

The fit uses a bounded sample: at most ``rows_per_lang`` labelled rows of each language (those with the smallest hashes of id and
text) and ``max_rows`` in all, whole texts, reduced to vectors by the tasks. Prediction reads every whole text.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every text when there are no labelled
rows. Rows with a null language or a null text teach nothing; repeated rows are predicted alike; only the id, text and (for the
fit) language columns are read. Without a known family a language is a family of its own.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revflow.llm.common import held_out, map_rows

DIM = 8192
UND = "und"

#: ISO 639-1 codes of each family; a parameter of ``fit``.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nl", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "turkic": ("az", "kk", "ky", "tr", "uz"),
    "uralic": ("et", "fi", "hu"),
    "semitic": ("am", "ar", "he", "mt"),
}

_LETTER = regex.compile(r"\p{L}")
_K = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
#: Characters below 128 that are not letters read as a space.
_FOLD = np.array([c if chr(c).isalpha() else 32 for c in range(128)], np.uint32)


def features(text: str) -> np.ndarray:
    """The normalised n-gram vector, last component 1 for the intercept."""
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.where(c < 128, _FOLD[np.minimum(c, 127)], c)
    one = c * _K[0]
    two = one[1:] ^ (c[:-1] * _K[1])
    three = two[1:] ^ (c[:-2] * _K[2])
    v = np.zeros(DIM + 1, np.float32)
    for grams in (one, two * _K[0], three * _K[1]):
        v[:DIM] += np.bincount((grams ^ (grams >> np.uint32(15))) * _K[0] >> np.uint32(19), minlength=DIM)
    v[:DIM] /= max(float(np.linalg.norm(v)), 1e-9)
    v[DIM] = 1
    return v


def linear_svm(x: np.ndarray, y: np.ndarray, decay: float = 1e-4, steps: int = 300) -> np.ndarray:
    """Weights of a linear support vector machine with squared hinge loss, both classes of equal total weight (y is -1 or 1);
    accelerated gradient steps, so the fit is deterministic."""
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = np.zeros(x.shape[1], np.float32)
    at, t, rate = w, 1.0, 1 / (2 * float(share @ np.einsum("ij,ij->i", x, x)) + decay)  # the trace bounds the curvature
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (x @ at))
        new = at - rate * (decay * at - 2 * (x.T @ (share * slack * y)))
        nt = (1 + (1 + 4 * t * t) ** 0.5) / 2
        at, w, t = new + (t - 1) / nt * (new - w), new, nt
    return w


class Model:
    """Families, their one-versus-rest weights, and the pairwise weights within each."""

    def __init__(self, x: np.ndarray, langs: list[str], families: dict[str, tuple[str, ...]]):
        of = {code: f for f, codes in families.items() for code in codes}
        family = [of.get(a, a) for a in langs]
        self.families = sorted(set(family))
        self.members = {f: sorted({a for a, g in zip(langs, family) if g == f}) for f in self.families}
        sign = lambda flags: np.where(flags, 1, -1).astype(np.float32)
        fam, lang = np.array(family), np.array(langs)
        weights = [linear_svm(x, sign(fam == f)) for f in self.families] if len(self.families) > 1 else []
        self.first = len(weights)
        self.pairs = []
        for f in self.families:
            for a, b in combinations(self.members[f], 2):
                rows = (lang == a) | (lang == b)
                self.pairs.append((f, a, b))
                weights.append(linear_svm(x[rows], sign(lang[rows] == a)))
        self.weights = np.array(weights, np.float32).reshape(len(weights), DIM + 1)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.families or not text or not _LETTER.search(text):
            return UND, 0.0
        m = self.weights @ features(text)
        family, sure = self.families[0], 1.0
        if self.first:
            best = int(np.argmax(m[: self.first]))
            rest = float(np.max(np.delete(m[: self.first], best)))
            family, sure = self.families[best], float(1 / (1 + np.exp(-2 * (m[best] - rest))))
        votes = {a: [0, 0.0] for a in self.members[family]}
        weakest = {a: np.inf for a in votes}
        for (f, a, b), margin in zip(self.pairs, m[self.first :].tolist()):
            if f == family:
                votes[a if margin > 0 else b][0] += 1
                for code, own in ((a, margin), (b, -margin)):
                    votes[code][1] += own
                    weakest[code] = min(weakest[code], own)
        lang = min(votes, key=lambda a: (-votes[a][0], -votes[a][1], a))
        if len(votes) > 1:
            sure *= float(1 / (1 + np.exp(-4 * weakest[lang])))
        return lang, min(1.0, max(0.0, sure))


def sample(labelled: DataFrame, label: Column, id_col: str, text_col: str, rows_per_label: int, max_rows: int) -> DataFrame:
    """(label, text) of a bounded sample, the smallest hashes first: a hash threshold from the label's count keeps about twice the
    bound before the rows are ranked, so the ranked rows stay few however many are labelled."""
    rows = labelled.select(label.alias("label"), F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("label is not null and text is not null")
    counts = rows.groupBy("label").count()
    if (kinds := counts.count()) == 0:
        return rows.limit(0)
    keep = max(1, min(rows_per_label, max_rows // kinds))
    rows = rows.withColumn("h", F.pmod(F.xxhash64("id", "text"), F.lit(1 << 40)))
    cut = counts.select("label", ((2 * keep + 50) / F.col("count") * (1 << 40)).alias("cut"))
    some = rows.join(F.broadcast(cut) if kinds <= 1000 else cut, "label").filter("h < cut")
    first = F.row_number().over(Window.partitionBy("label").orderBy("h", "id", "text"))
    return some.withColumn("rank", first).filter(F.col("rank") <= keep).select("label", "text")


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", families: dict | None = None,
        rows_per_lang: int = 200, max_rows: int = 1600) -> Model:
    def start():
        def work(b: pa.RecordBatch) -> pa.RecordBatch:
            x = [features(t) for t in b.column(1).to_pylist()]
            return pa.record_batch([b.column(0), pa.array([v.tobytes() for v in x], pa.binary())], names=["label", "x"])

        return work

    chosen = sample(labelled, F.col(lang_col).cast("string"), id_col, text_col, rows_per_lang, max_rows)
    rows = map_rows(chosen, start, "label string, x binary").collect()  # at most max_rows vectors
    rows.sort(key=lambda r: (r.label, hashlib.sha1(r.x).digest()))  # the fit doesn't depend on the order of arrival
    x = np.array([np.frombuffer(r.x, np.float32) for r in rows], np.float32).reshape(len(rows), DIM + 1)
    return Model(x, [r.label for r in rows], FAMILIES if families is None else families)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every whole text."""
    src = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).alias("t"))

    def start():
        def work(b: pa.RecordBatch) -> pa.RecordBatch:
            found = [model.predict(t) for t in b.column(1).to_pylist()]
            return pa.record_batch([b.column(0), pa.array([a for a, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                                   names=["k", "lang_pred", "score"])

        return work

    return map_rows(src, start, "k long, lang_pred string, score double").withColumnRenamed("k", id_col)


def fit_on_documents(docs: DataFrame, **how) -> Model:
    """The model of the labelled rows outside the fixed hold-out."""
    return fit(docs.filter(~held_out()), **how)


def drop_unidentified(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose language is ``und``; all columns and other rows stay as they are.

    A model that had no labels to learn from calls every text ``und``; then only null texts and texts without a letter are dropped.
    """
    identified = lambda t: model.predict(t)[0] != UND if model.families else bool(t and _LETTER.search(t))

    def start():
        def work(b: pa.RecordBatch) -> pa.RecordBatch:
            at = b.schema.names.index(text_col)
            keep = [identified(t) for t in b.column(at).to_pylist()]
            return b.filter(pa.array(keep, pa.bool_()))

        return work

    return map_rows(docs, start, docs.schema)
