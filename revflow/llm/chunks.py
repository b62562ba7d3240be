"""Operator 4: substring deduplication by content-defined chunks of a gear rolling hash.

The gear hash of the last 16 bytes (``h = (h << 1) + gear[byte]`` modulo 2**16, so older bytes are shifted out) marks the cuts: each
window of 2 * GAP positions has one at its smallest hash, the leftmost on ties, at a character's start. That is a cut every GAP bytes
on average and never a longer gap than the window, however few different words a text has. From each cut a chunk runs to the first
cut at least LEAST bytes further on. Cuts depend on the bytes around them only, so an insertion moves the cuts near it and no others, and
because a chunk starts at every cut, a repeated passage shares all chunks between its first and its last cut, wherever it stands.
Chunks are compared by the 64-bit digest of their bytes; overlapping repeated chunks of a document are joined into spans. (In a
constant stretch the hash stands still; such a stretch can be cut every STEP bytes only, so it doesn't cut at every byte.)

Cuts leave out what a passage has before its first and after its last usable one, so both ends of a span are widened for as long as the
characters beside one of its OUTER outermost chunks, at most REACH, equal those beside the same chunk in the other holder: the first
one, or for spans that are first held here the last one. Where a holder has a chunk several times, the left end is compared at its first and the right
end at its last places (those within DRIFT, as the outermost cuts of a periodic passage depend on what stands beside it).

A digest counts as repeated when at least two documents hold it. Digests are folded to their smallest and largest doc_id before the
shuffle; occurrences are joined with the repeated digests, one row each, so a digest that very many documents hold can be
split. No repeated passage of 15 + 6 * GAP + LEAST bytes (255) or more is missed: windows that reach over
its end can add cuts in its last 2 * GAP bytes, which move chunk ends there. (Constant stretches, cut from where they begin, are not in this bound.)

Defined results: null and short texts (under LEAST bytes) have no chunks; a text without two cuts far enough apart is one chunk. Rows
with a null doc_id take no part; rows that share a doc_id are one document. Offsets are code points, the end is exclusive.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revflow.llm.common import map_rows, unused
from revflow.llm.graph import staged

GAP, LEAST, SEED = 24, 96, 4242
STEP, REACH, DRIFT, OUTER = 32, 255, 128, 4
GEAR = np.random.default_rng(SEED).integers(0, 1 << 16, 256, dtype=np.uint16)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte, by doubling: the sum over 2n bytes is the sum over n plus the shifted sum of the n before."""
    h = GEAR[data]
    for n in (1, 2, 4, 8):
        older = h[:-n] << np.uint16(n)
        h = h.copy()
        h[n:] += older
    return h


def _leftmost_least(values: np.ndarray, size: int) -> np.ndarray:
    """The place of the smallest value, the leftmost on ties, in each window of ``size`` values, by doubling."""
    least = values << 32 | np.arange(len(values))
    size = min(size, len(values))
    width = 1
    while width < size:
        step = min(width, size - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    return least & 0xFFFFFFFF


def chunk_bounds(text: bytes, gap: int = GAP, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets (starts, ends) of the chunks."""
    if len(text) < least:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    data = np.frombuffer(text, np.uint8)
    h = gear_hashes(data)[:-1]
    place = np.arange(len(h))
    still = np.concatenate([[False], h[1:] == h[:-1]])
    run = place - np.maximum.accumulate(np.where(still, 0, place))  # how long the hash has stood still
    usable = (data[1:] & 0xC0 != 0x80) & (run % STEP == 0)
    at = _leftmost_least(np.where(usable, h.astype(np.int64), 1 << 16), 2 * gap)
    at = at[np.concatenate([[True], at[1:] != at[:-1]])]  # they never move back
    cuts = at[usable[at]] + 1
    cuts = np.concatenate([[0], cuts, [len(text)]])
    to = np.searchsorted(cuts, cuts + least)
    some = to < len(cuts) - 1  # ends at a cut, not merely at the text's end
    if not some.any():
        return np.array([0]), np.array([len(text)])
    return cuts[some], cuts[to[some]]


def chunk_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gap: int = GAP, least: int = LEAST) -> DataFrame:
    """(digest, id, start, end) for every chunk of every whole text."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).filter("id is not null and t is not null")

    def start():
        def work(b: pa.RecordBatch) -> pa.RecordBatch:
            digest, ids, first, last = [], [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                data = t.encode()
                lo, hi = chunk_bounds(data, gap, least)
                if len(lo):
                    points = np.concatenate([[0], np.cumsum(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)]).astype(np.int32)
                    digest += [xxhash.xxh3_64_intdigest(data[x:y]) for x, y in zip(lo.tolist(), hi.tolist())]
                    ids.append(np.full(len(lo), i)), first.append(points[lo]), last.append(points[hi])
            whole = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.empty(0, kind)
            return pa.record_batch([np.array(digest, np.uint64).view(np.int64), whole(ids, np.int64), whole(first, np.int32), whole(last, np.int32)],
                                   names=["digest", "id", "start", "end"])

        return work

    return map_rows(src, start, "digest long, id long, start int, end int")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gap: int = GAP, least: int = LEAST) -> DataFrame:
    """(doc_id, start, end, n_chunks, first_doc_id, is_first) for every stretch that other documents hold too.

    ``is_first``: this document is the smallest id that holds the stretch's chunks; chunks first held here and chunks first held
    elsewhere make separate spans. ``first_doc_id`` is the smallest id that holds one of the chunks.
    """
    rows = chunk_rows(docs, id_col, text_col, gap, least)
    shared = rows.groupBy("digest").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo < hi")
    shared = staged(shared, "repeated")  # a plain scan on this side lets the skew join split a digest that very many documents hold
    found = staged(rows.join(shared, "digest").select("id", "start", "end", "lo", "hi", "digest", (F.col("lo") == F.col("id")).alias("own")), "shared-chunks")
    spans = staged(_joined(found.withColumn("n_chunks", F.lit(1).cast("long")), outer=True), "spans")
    spans = _joined(_widened(spans, found, docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))))
    return spans.select(F.col("id").alias("doc_id"), "start", "end", "n_chunks", F.col("lo").alias("first_doc_id"), F.col("own").alias("is_first"))


def _joined(pieces: DataFrame, outer: bool = False) -> DataFrame:
    """Overlapping and touching pieces of one document and kind as one; with ``outer``, also the OUTER outermost at each end."""
    in_order = Window.partitionBy("id", "own").orderBy("start", "end")
    before, upto = in_order.rowsBetween(Window.unboundedPreceding, -1), in_order.rowsBetween(Window.unboundedPreceding, 0)
    opens = (F.col("start") > F.coalesce(F.max("end").over(before), F.lit(-1))).cast("int")
    spans = pieces.withColumn("opens", opens).withColumn("span", F.sum("opens").over(upto))
    more = []
    if outer:
        spans = spans.withColumns({"is_head": F.max("opens").over(in_order.rowsBetween(1 - OUTER, 0)) == 1,
                                   "is_tail": (F.lead("opens", OUTER).over(in_order).isNull() | (F.max("opens").over(in_order.rowsBetween(1, OUTER)) == 1))})
        more = [F.collect_list(F.when(F.col(f"is_{end}"), F.struct(F.col(at).alias("at"), "digest", "lo", "hi"))).alias(end)
                for end, at in (("head", "start"), ("tail", "end"))]
    return spans.groupBy("id", "own", "span").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n_chunks").alias("n_chunks"), F.min("lo").alias("lo"), *more).drop("span")


def _same(a: Column, b: Column) -> Column:
    """How many characters two strings have in common from the start, up to REACH, by halving steps."""
    steps = [1 << i for i in reversed(range(REACH.bit_length()))]
    fits = lambda k, s: (k + s <= F.least(F.length(a), F.length(b))) & (a.substr(k + 1, s) == b.substr(k + 1, s))
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda k, s: F.when(fits(k, s), k + s).otherwise(k))


def _widened(spans: DataFrame, found: DataFrame, texts: DataFrame) -> DataFrame:
    """Spans with both ends moved over the characters that the other holder of the end's chunk has there too."""
    of_one = Window.partitionBy("digest", "id")
    places = found.filter("id = lo or id = hi").select("digest", F.col("id").alias("other"), "start", "end", F.min("start").over(of_one).alias("first"),
                                                       F.max("end").over(of_one).alias("last"))
    places = staged(places.filter((F.col("start") <= F.col("first") + DRIFT) | (F.col("end") >= F.col("last") - DRIFT)), "places")
    # this and the contexts are plain scans, so that a chunk that very many spans end in can be split
    ends = None
    for head, outer, inward in ((True, "head", F.col("c.at") - F.col("start")), (False, "tail", F.col("end") - F.col("c.at"))):
        side = spans.select("id", "own", "start", "end", F.explode(outer).alias("c")).select(
            "id", "own", F.col("start").alias("of"), "c.at", inward.alias("inward"), F.lit(head).alias("is_head"), "c.digest",
            F.when(F.col("own"), F.col("c.hi")).otherwise(F.col("c.lo")).alias("other"))
        ends = side if ends is None else ends.unionByName(side)
    near = F.when(F.col("is_head"), F.col("start") <= F.col("first") + DRIFT).otherwise(F.col("end") >= F.col("last") - DRIFT)
    ends = ends.join(places, ["digest", "other"]).filter(near).withColumn("there", F.when(F.col("is_head"), F.col("start")).otherwise(F.col("end")))
    ends = staged(ends.select("id", "own", "of", "at", "inward", "is_head", "other", "there"), "span-ends")
    asked = ends.select("id", "is_head", "at").unionByName(ends.select(F.col("other").alias("id"), "is_head", F.col("there").alias("at"))).distinct()
    asked = asked.groupBy("id").agg(F.collect_list(F.struct("is_head", "at")).alias("asked"))
    beside = texts.filter("t is not null").join(asked, "id").select("id", "t", F.explode("asked").alias("e")).select("id", "t", "e.is_head", "e.at")
    near = F.greatest(F.col("at") - REACH, F.lit(0))
    context = F.when(F.col("is_head"), F.reverse(F.col("t").substr(near + 1, F.col("at") - near))).otherwise(F.col("t").substr(F.col("at") + 1, F.lit(REACH)))
    beside = staged(beside.select("id", "is_head", "at", context.alias("context")), "contexts")
    theirs = beside.select(F.col("id").alias("other"), "is_head", F.col("at").alias("there"), F.col("context").alias("theirs"))
    grown = ends.join(beside, ["id", "is_head", "at"]).join(theirs, ["other", "is_head", "there"]).withColumn("more", _same(F.col("context"), F.col("theirs")))
    # several texts under one id give several rows for a place: the least of them, then the best place
    grown = grown.groupBy("id", "own", F.col("of").alias("start"), "is_head", "at", "inward", "other", "there").agg(F.min("more").alias("more"))
    gain = F.greatest(F.lit(0), F.col("more") - F.col("inward"))
    grown = grown.groupBy("id", "own", "start").agg(F.max(F.when(F.col("is_head"), gain)).alias("left"), F.max(F.when(~F.col("is_head"), gain)).alias("right"))
    return spans.join(grown, ["id", "own", "start"]).select("id", "own", (F.col("start") - F.col("left")).alias("start"),
                                                            (F.col("end") + F.col("right")).alias("end"), "n_chunks", "lo")


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with every repeated span cut out except where it is first held; same columns and rows."""
    key, cuts = unused(docs, "span_id"), unused(docs, "cuts")
    spans = (repeated_spans(docs, id_col, text_col, **how).filter("not is_first").groupBy(F.col("doc_id").alias(key))
             .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias(cuts)))
    joined = docs.join(spans, F.col(id_col).cast("long") == F.col(key), "left")
    # spans of one kind are disjoint and in order
    edges = F.concat(F.array(F.lit(0)), F.transform(cuts, lambda s: s["end"]))
    ends = F.concat(F.transform(cuts, lambda s: s["start"]), F.array(F.length(text_col)))
    parts = F.zip_with(edges, ends, lambda a, b: F.substring(F.col(text_col), a + 1, b - a))
    return joined.withColumn(text_col, F.when(F.col(cuts).isNull(), F.col(text_col)).otherwise(F.array_join(parts, ""))).select(*docs.columns)
