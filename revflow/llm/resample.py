"""Operator 11: importance resampling of documents towards a target distribution of hashed word n-grams.

Features are the runs of 1 to ``n`` consecutive words of a whole text, each hashed to a bucket. A bucket's gain is the log of its
smoothed share among the target texts over its smoothed share among the source texts; a document's weight is the mean gain of its
features. Adding Gumbel noise drawn from a hash of the identifier to the weight and keeping the highest scores samples documents
without replacement in proportion to their importance; the draw is the same in every run.

A task takes its texts in batches of bounded bytes. The words of a batch are written to one normalised buffer, so every n-gram is one
span of it, and an open-addressed NumPy table interns the spans: the xxhash64 of a span is the key, linear probing finds its slot, and
the bytes are compared before a span shares a slot. A slot stores the bucket (the crc32 is computed once for each distinct n-gram
of the batch) and the number of occurrences. The first pass adds the slots' counts to the task's bucket counts (at most BUCKETS rows
leave a task); the second gathers the gains by the occurrences' slots. Texts above SEGMENT bytes are cut between words, and a
segment begins with the words that its first n-grams reach back to; so memory is bounded by SEGMENT and the longest word.

The driver sees only the bucket counts (BUCKETS numbers a side) and the counts of range partitions. Ranks come from a range partition
by score and identifier: the place within the partition plus the rows of those before it.

Defined results: a null text has no words, a null identifier is drawn with the noise of an empty one and comes last among ties.
Repeated rows are scored and drawn each for itself. A document without features has weight 0. Empty tables: an empty source gives an
empty result, an empty target leaves the smoothing alone. Further columns of any name are ignored by ``draw``; ``resample``
keeps them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revflow.llm.common import unused
from revflow.llm.graph import staged

BUCKETS = 10_000
#: Bytes of text that are interned at once.
SEGMENT = 1 << 20

_SPACE = 32
#: Letters and digits of ASCII and all other characters' bytes are kept (A-Z lower-cased); the rest becomes a space.
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else _SPACE for b in range(256)], np.uint8)
#: The primes of xxhash64.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def _rotate(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _lane(buf: np.ndarray, kind: str) -> np.ndarray:
    """The little-endian number that begins at each byte of ``buf``."""
    return np.ndarray(len(buf) - np.dtype(kind).itemsize + 1, kind, buf, strides=(1,))


def hash_spans(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """xxhash64 of the spans of ``buf`` (which has 8 spare bytes at its end)."""
    wide, half = _lane(buf, "<u8"), _lane(buf, "<u4")
    h = _P5 + size.astype(np.uint64)
    at, left = start.copy(), size.copy()
    for _ in range(3):  # spans of 32 bytes and more are hashed below
        live = np.flatnonzero((left >= 8) & (size < 32))
        if not len(live):
            break
        h[live] = _rotate(h[live] ^ (_rotate(wide[at[live]] * _P2, 31) * _P1), 27) * _P1 + _P4
        at[live] += 8
        left[live] -= 8
    live = np.flatnonzero((left >= 4) & (size < 32))
    h[live] = _rotate(h[live] ^ (half[at[live]].astype(np.uint64) * _P1), 23) * _P2 + _P3
    at[live] += 4
    left[live] -= 4
    for _ in range(3):
        live = np.flatnonzero((left > 0) & (size < 32))
        h[live] = _rotate(h[live] ^ (buf[at[live]].astype(np.uint64) * _P5), 11) * _P1
        at[live] += 1
        left[live] -= 1
    h ^= h >> np.uint64(33)
    h *= _P2
    h ^= h >> np.uint64(29)
    h *= _P3
    h ^= h >> np.uint64(32)
    for i in np.flatnonzero(size >= 32):
        h[i] = xxhash.xxh64_intdigest(buf[start[i] : start[i] + size[i]])
    return h


def same_spans(buf: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the spans of equal ``size`` at ``a`` and ``b`` hold equal bytes."""
    wide, same = _lane(buf, "<u8"), np.ones(len(a), bool)
    for at in range(0, 32, 8):
        live = np.flatnonzero(same & (size > at) & (size < 32))
        if not len(live):
            break
        cut = np.uint64(8) * np.maximum(at + 8 - size[live], 0).astype(np.uint64)  # bytes beyond the span
        same[live] = ((wide[a[live] + at] ^ wide[b[live] + at]) << cut) == 0
    for i in np.flatnonzero(size >= 32):
        same[i] = np.array_equal(buf[a[i] : a[i] + size[i]], buf[b[i] : b[i] + size[i]])
    return same


def intern_spans(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slot of each span, span that owns each slot or -1) of an open-addressed table with linear probing."""
    room = 1 << max(int(2 * len(start) - 1).bit_length(), 1)
    key = hash_spans(buf, start, size)
    owner = np.full(room, -1, np.int64)
    slot = (key & np.uint64(room - 1)).astype(np.int64)
    live = np.arange(len(start))
    while len(live):
        free = live[owner[slot[live]] < 0]
        owner[slot[free]] = free  # one of those that meet at a free slot takes it
        held = owner[slot[live]]
        like = (key[live] == key[held]) & (size[live] == size[held])
        like[like] = same_spans(buf, start[live[like]], start[held[like]], size[live[like]])
        live = live[~like]
        slot[live] = (slot[live] + 1) & (room - 1)
    return slot, owner


class Grams:
    """The interned n-grams of a batch: ``doc`` and ``slot`` of each occurrence, ``bucket`` and ``count`` of each slot."""

    def __init__(self, texts: list[bytes], n: int, context: np.ndarray):
        """``context``: words at the beginning of each text that only lengthen the n-grams which end behind them."""
        raw = b" ".join(texts) + b" "
        buf = _FOLD[np.frombuffer(raw, np.uint8)]
        ends = np.cumsum([len(t) + 1 for t in texts])
        word = buf != _SPACE
        keep = word.copy()
        keep[1:] |= word[:-1]  # one space after each word
        closing = np.flatnonzero(~word[1:] & word[:-1]) + 1
        doc = np.searchsorted(ends, closing, side="right")
        buf = np.concatenate([buf[keep], np.zeros(8, np.uint8)])
        end = np.flatnonzero(buf[:-8] == _SPACE)
        start = np.concatenate([[0], end[:-1] + 1]).astype(np.int64) if len(end) else end
        place = np.arange(len(end)) - np.searchsorted(doc, doc)
        fresh = place >= context[doc]
        self.words = np.bincount(doc[fresh], minlength=len(texts))
        of, first, last = [], [], []
        for k in range(n):  # runs of k + 1 words by their last word
            ok = np.flatnonzero(fresh & (place >= k))
            of.append(doc[ok]), first.append(start[ok - k]), last.append(end[ok])
        self.doc, begin, stop = (np.concatenate(x) for x in (of, first, last))
        self.slot, owner = intern_spans(buf, begin, stop - begin)
        self.count = np.bincount(self.slot, minlength=len(owner))
        self.bucket = np.zeros(len(owner), np.int64)
        view = memoryview(buf)
        used = np.flatnonzero(owner >= 0)
        spans = zip(begin[owner[used]].tolist(), stop[owner[used]].tolist())
        self.bucket[used] = [zlib.crc32(view[a:b]) % BUCKETS for a, b in spans]


def _cut(text: bytes, n: int) -> Iterator[tuple[bytes, int]]:
    """(segment, context words at its beginning): ``text`` cut between words into about SEGMENT bytes."""
    at, size = 0, len(text)
    tail = b""
    while True:
        stop = min(at + SEGMENT, size)
        while stop < size:  # on to the next byte between words
            rest = np.flatnonzero(_FOLD[np.frombuffer(text, np.uint8, min(size - stop, 4096), stop)] == _SPACE)
            if len(rest):
                stop += int(rest[0])
                break
            stop = min(stop + 4096, size)
        piece = text[at:stop]
        yield tail + piece, len(tail.split())
        if stop >= size:
            return
        tail = b"".join(w + b" " for w in _last_words(tail + piece, n - 1))
        at = stop


def _words(text: bytes) -> list[bytes]:
    return _FOLD[np.frombuffer(text, np.uint8)].tobytes().split()


def _last_words(text: bytes, k: int) -> list[bytes]:
    size = 4096
    while len(words := _words(text[-size:])) <= k and size < len(text):  # the first one may be cut
        size *= 2
    return words[len(words) - k :]


def _batches(column: pa.Array, n: int) -> Iterator[tuple[list[int], Grams]]:
    """(row of each text, n-grams) of batches of at most about SEGMENT bytes."""
    rows, texts, context, held = [], [], [], 0
    for i, text in enumerate(column.cast(pa.binary())):
        for piece, known in _cut(text.as_py() or b"", n):
            if held and held + len(piece) > SEGMENT:
                yield rows, Grams(texts, n, np.array(context))
                rows, texts, context, held = [], [], [], 0
            rows.append(i), texts.append(piece), context.append(known)
            held += len(piece) + 1
    if rows:
        yield rows, Grams(texts, n, np.array(context))


def bucket_counts(df: DataFrame, text: str = "text", n: int = 2) -> np.ndarray:
    """Features in each bucket over all texts: summed in the tasks, then by bucket."""

    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for _, grams in _batches(b.column(0), n):
                np.add.at(total, grams.bucket, grams.count)
        hit = np.flatnonzero(total)
        yield pa.record_batch([pa.array(hit), pa.array(total[hit])], names=["bucket", "n"])

    parts = df.select(F.col(text).alias("text")).mapInArrow(run, "bucket long, n long")
    counts = np.zeros(BUCKETS, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most BUCKETS rows
        counts[r.bucket] = r.n
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the smoothed share in the target over that in the source, for each bucket."""
    s, t = source.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, text: str = "text", ident: str = "doc_id", n: int = 2) -> DataFrame:
    """``docs`` with the columns of ``draw`` but its rank: (row, doc_id, n_words, n_features, weight)."""

    def run(batches):
        for b in batches:
            words, features, weight = (np.zeros(b.num_rows, np.int64) for _ in range(3))
            for rows, grams in _batches(b.column(1), n):
                rows = np.array(rows)
                of = rows[grams.doc]
                np.add.at(words, rows, grams.words)
                np.add.at(features, of, 1)
                np.add.at(weight, of, gain[grams.bucket[grams.slot]])
            weight //= np.maximum(features, 1)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x) for x in (words, features, weight))],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    src = docs.select(F.col(ident).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return src.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def draw(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7, n: int = 2,
         text: str = "text", ident: str = "doc_id", target_text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row; ``rank`` is null for those not drawn.

    Of the rows with at least ``least_words`` words, ``percent`` in a hundred (rounded down) are drawn.
    """
    gain = gains(bucket_counts(docs, text, n), bucket_counts(target, target_text, n))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    noise = F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0)))
    scored = staged(weigh(docs, gain, text, ident, n).withColumn("score", (F.col("weight") + noise).cast("long")), "resample-scores")
    fit = F.col("n_words") >= least_words
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the id counts the rows of a partition in their order below bit 33, the partition above it
    placed = scored.filter(fit).repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    placed = staged(placed.withColumn("at", F.monotonically_increasing_id()), "resample-places")
    placed = placed.withColumn("part", F.shiftright("at", 33))
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))  # one row for each range partition
    before = F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("rows")
    ranked = placed.join(F.broadcast(sizes.select("part", before.alias("before"))), "part")
    rank = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    drawn = placed.count() * percent // 100
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    return ranked.select(*columns, F.when(rank <= drawn, rank).alias("rank")).unionByName(
        scored.filter(~fit).select(*columns, F.lit(None).cast("long").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, text: str = "text", ident: str = "doc_id", **how) -> DataFrame:
    """The rows of ``docs`` whose identifier is drawn, with all their columns."""
    name = unused(docs, "drawn_id")
    drawn = draw(docs, target, text=text, ident=ident, **how).filter("rank is not null and doc_id is not null")
    return docs.join(drawn.select(F.col("doc_id").alias(name)).distinct(), F.col(ident).cast("long") == F.col(name), "left_semi")
