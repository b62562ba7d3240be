"""Operator 8: near-duplicate documents by SuperMinHash, banding, exact verification and union-find grouping.

A document's set holds its distinct word shingles (words `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased). SuperMinHash gives each
set ``bands * rows`` slots: every element carries its own random permutation of the slots (a Fisher-Yates shuffle driven by
the element's hash), and at rank j proposes the value j + r_j for the slot its permutation visits j-th. Ranks are tried for
all elements together, and a document stops at the first rank after which no slot is open, because later ranks can only
propose larger values. Documents that agree on all slots of a band are candidates.

Equal sets are first folded into one representative, so exact copies never meet in a bucket. In each bucket every document is
verified against the bucket's smallest id, on the full sets; verified links give components. Documents of one bucket that are still in
different components are then compared by longer signatures of FINE slots, inside tasks and in blocks of about BLOCK documents; pairs
whose share of equal slots is above the threshold less 4.5 standard deviations (a link lies below with probability 3e-6) make a
graph of which each task hands on a spanning forest only. Documents that are connected in it meet once more, by blocks, with their full
sets; there the pairs between different components are counted exactly through an inverted index of the block's shingles, and a task
hands on only the links that join two components it had apart. So what leaves the tasks grows with the documents and not with their
pairs; links inside a component change nothing, and the components equal those of all candidate pairs.

Defined results: a null or empty text, or one without words, has an empty set, is linked with nothing and is its own
component. A document with fewer words than a shingle has its whole word sequence as one shingle. Rows that share a doc_id are
one node with the links of all their texts; each row is returned. A row with a null doc_id is linked with nothing, has a null
component and is kept. Only the id and text columns are read, so other columns never clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revflow.llm.common import give_back, map_rows, unused
from revflow.llm.graph import components, maybe_in, picked, staged

#: 32 bands of 6 slots: a pair at similarity 0.8 shares no band with probability (1 - 0.8**6)**32 = 6e-5, at 0.85 with 3e-7.
BANDS, ROWS = 32, 6
FINE, BLOCK = 512, 8192
#: Shingles of a block of full sets.
ELEMENTS = 1 << 20

_G, _A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S27, _S30, _S31, _S32, _LOW = np.uint64(27), np.uint64(30), np.uint64(31), np.uint64(32), np.uint64(0xFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S30)) * _A
    x = (x ^ (x >> _S27)) * _B
    return x ^ (x >> _S31)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles."""
    toks = (text or "").encode().lower().split()
    if not toks:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, toks), np.uint64, len(toks))
    n = max(1, len(h) - words + 1)
    acc = np.full(n, min(len(h), words), np.uint64)
    for i in range(min(words, len(h))):
        acc = _mix(acc * _G + h[i : i + n])
    return np.unique(acc)


def signatures(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """SuperMinHash signatures (one row for each non-empty set): rank in the high half of a slot, random part in the low half."""
    sig = np.full((len(sets), slots), np.iinfo(np.uint64).max, np.uint64)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    elem = np.concatenate(sets)
    perm = None
    for j in range(slots):
        u = _mix(elem + np.uint64(0x9E3779B97F4A7C15 * (j + 1) & (1 << 64) - 1))
        k = (j + ((u & _LOW) * np.uint64(slots - j) >> _S32)).astype(np.int64)
        if perm is None:
            slot = k
        else:
            row = np.arange(len(elem))
            slot = perm[row, k].astype(np.int64)
            perm[row, k] = perm[:, j]
        np.minimum.at(sig.reshape(-1), doc * slots + slot, (np.uint64(j) << _S32) | (u >> _S32))
        open_docs = sig.max(1) >= np.uint64(j + 1) << _S32
        if not open_docs.any():
            break
        left = open_docs[doc]
        if perm is None:
            elem, doc, k = elem[left], doc[left], k[left]
            perm = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (len(elem), 1))
            perm[np.arange(len(elem)), k] = 0
        elif left.sum() < 0.7 * len(left):
            elem, doc, perm = elem[left], doc[left], perm[left]
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    parts = sig.reshape(len(sig), bands, rows)
    key = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), 1))
    for r in range(rows):
        key = _mix(key * _G + parts[:, :, r])
    return key.view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays).view(np.int64) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def sketch(docs: DataFrame, words: int = 2, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, n, digest of the set, band keys) for every row of ``docs(id, text)``."""

    def start():
        def work(b: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingle_set(t, words) for t in b.column(1).to_pylist()]
            full = [i for i, s in enumerate(sets) if len(s)]
            keys: list[np.ndarray] = [np.empty(0, np.int64)] * len(sets)
            at = 0
            while at < len(full):  # at most about 60,000 elements at a time, or one document
                end, total = at, 0
                while end < len(full) and (end == at or total + len(sets[full[end]]) <= 60_000):
                    total += len(sets[full[end]])
                    end += 1
                for i, key in zip(full[at:end], band_keys(signatures([sets[i] for i in full[at:end]], bands * rows), bands, rows)):
                    keys[i] = key
                at = end
            digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            return pa.record_batch(
                [b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), _lists(keys)],
                names=["id", "n", "digest", "keys"])

        return work

    return map_rows(docs, start, "id long, n long, digest binary, keys array<long>")


def _fine(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """(id, n, keys, sig): four bytes of each band key, and one byte of each of FINE slots."""

    def start():
        def work(b: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                s = shingle_set(t, words)
                if len(s):
                    sig = (_mix(signatures([s], FINE)[0]) & np.uint64(255)).astype(np.uint8)
                    out.append((i, len(s), band_keys(signatures([s], bands * rows), bands, rows)[0].astype(np.uint32).tobytes(), sig.tobytes()))
            cols = zip(*out) if out else ((), (), (), ())
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            return pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names=["id", "n", "keys", "sig"])

        return work

    return map_rows(docs, start, "id long, n long, keys binary, sig binary").distinct()


def _sets(docs: DataFrame, words: int) -> DataFrame:
    def start():
        def work(b: pa.RecordBatch) -> pa.RecordBatch:
            return pa.record_batch([b.column(0), _lists([shingle_set(t, words) for t in b.column(1).to_pylist()])], names=["id", "s"])

        return work

    return map_rows(docs, start, "id long, s array<long>")


def verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity: 100 * intersection >= percent * union."""
    ids = staged(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "paired")
    sets = _sets(picked(docs, ids), words)
    a = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")
    ab = a.join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    both = F.size(F.array_intersect("sa", "sb"))
    return (ab.select("a", "b", both.alias("both"), (F.size("sa") + F.size("sb") - both).alias("either"))
            .filter(100 * F.col("both") >= percent * F.col("either")).select("a", "b").distinct())


class _Forest:
    """Union-find over the numbers below ``n``; ``join`` tells whether two trees became one."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def _dealt(rows: DataFrame, key: str, blocks: DataFrame) -> DataFrame:
    """``rows`` with (key, i, j, own): a key's rows are dealt to its ``blocks`` by id, and each two blocks i and j meet."""
    dealt = rows.join(blocks, key).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    return dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        key, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", *(c for c in rows.columns if c != key))


def _in_blocks(dealt: DataFrame, compare) -> DataFrame:
    """Pairs (a, b) that ``compare(key, part)`` finds among the dealt rows (key, i, j, own, ...) that meet; a part's rows begin with ``own``."""
    group = dealt.columns[:3]
    parts = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        found, at, part = [], None, []

        def rows_of():
            for b in batches:
                yield from zip(*(c.to_numpy(zero_copy_only=False) if pa.types.is_list(c.type) else c.to_pylist() for c in b.columns))

        def batch():
            a, b = zip(*found)
            return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        def pairs():
            # blocks i and j of one key: rows of a single block are compared where i and j are that block
            if len(part) > 1 and (at[1] == at[2] or len({x[0] for x in part}) == 2):
                yield from compare(at[0], part)

        for r in rows_of():
            if r[:3] != at:
                found += pairs()
                at, part = r[:3], []
                if len(found) >= 20_000:
                    yield batch()
                    found = []
            part.append(r[3:])
        found += pairs()
        if found:
            yield batch()
        found, part = [], []
        give_back()

    return dealt.repartition(parts, *group).sortWithinPartitions(*group).mapInArrow(run, "a long, b long").distinct()


def _similar(rows: DataFrame, fine: DataFrame, percent: int) -> DataFrame:
    """A spanning forest of the pairs (a, b) of ``rows(key, id, hub, n, component)``: same key, different components, sizes and
    signatures (``fine``) near enough."""
    blocks = rows.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    share = percent / 100
    least = FINE * share - 4.5 * (FINE * share * (1 - share)) ** 0.5

    def compare(key, part):
        low = np.int64(key).astype(np.uint32)
        part = [r for r in part if low in np.frombuffer(r[5], np.uint32)]  # not another text under the same id
        if not part:
            return
        own, ids, hubs, n, comp = (np.array(c) for c in list(zip(*part))[:5])
        keys = np.frombuffer(b"".join(r[5] for r in part), np.uint32).reshape(len(part), -1)
        sig = np.frombuffer(b"".join(r[6] for r in part), np.uint8).reshape(len(part), -1)
        band = int(np.flatnonzero(keys[0] == low)[0])
        lone, tree = own.min() == own.max(), _Forest(len(part))
        for x in range(len(part)):
            if ids[x] == hubs[x]:
                continue
            can = (comp != comp[x]) & (100 * np.minimum(n, n[x]) >= percent * np.maximum(n, n[x])) & (ids > ids[x]) & (ids != hubs)
            if not lone:
                can &= own != own[x]
            at = np.flatnonzero(can)
            at = at[~(keys[at, :band] == keys[x, :band]).any(1)]  # those that met in an earlier band
            if len(at):
                for y in at[(sig[at] == sig[x]).sum(1) >= least].tolist():
                    if tree.join(x, y):
                        yield int(ids[x]), int(ids[y])

    dealt = _dealt(rows, "key", blocks).join(fine, ["id", "n"])  # narrow rows are dealt, then joined with their signatures
    return _in_blocks(dealt.select("key", "i", "j", "own", "id", "hub", "n", "component", "keys", "sig"), compare)


def _joined(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of ``rows(near, id, component, s)`` that join two components, by exact counts of the full sets within ``near``."""
    blocks = rows.groupBy("near").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum(F.size("s")) / ELEMENTS)).cast("int").alias("blocks"))

    def compare(_, part):
        own, ids, comp = (np.array(c) for c in list(zip(*part))[:3])
        sets = [r[3] for r in part]
        n = np.array([len(x) for x in sets])
        # postings: the documents of each shingle of the block
        shingle = np.unique(np.concatenate(sets), return_inverse=True)[1]
        doc = np.repeat(np.arange(len(part)), n)
        posted = doc[np.argsort(shingle, kind="stable")]
        size = np.bincount(shingle)
        start = np.cumsum(size) - size
        at = np.cumsum(n) - n
        roots = np.unique(comp, return_inverse=True)[1].tolist()
        lone, tree = own.min() == own.max(), _Forest(max(roots) + 1)
        for x in range(len(part)):
            can = (ids > ids[x]) & (comp != comp[x]) & (100 * np.minimum(n, n[x]) >= percent * np.maximum(n, n[x]))
            if not lone:
                can &= own != own[x]
            if not can.any():
                continue
            mine = shingle[at[x] : at[x] + n[x]]
            many = size[mine]
            where = np.repeat(start[mine] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            both = np.bincount(posted[where], minlength=len(part))
            for y in np.flatnonzero(can & (100 * both >= percent * (n + n[x] - both))).tolist():
                if tree.join(roots[x], roots[y]):
                    yield int(ids[x]), int(ids[y])

    return _in_blocks(_dealt(rows, "near", blocks), compare)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 2, percent: int = 80,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row; see the module's text."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows_of = staged(sketch(src, words, bands, rows), "sketch")
    known = rows_of.filter("n > 0 and id is not null")
    # staged, so that joins with them read plain scans and the skew join can split a hot digest or bucket
    firsts = staged(known.groupBy("digest").agg(F.min("id").alias("rep")), "firsts")
    classes = known.join(firsts, "digest")
    edges = staged(classes.filter("id <> rep").select(F.col("id").alias("u"), F.col("rep").alias("v")).distinct(), "copies")

    slots = classes.filter("id = rep").select("id", "n", F.explode("keys").alias("key"))
    crowded = slots.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last")).filter("hub < last").select("key", "hub")
    crowded = staged(crowded, "crowded")
    members = staged(slots.join(crowded, "key").distinct(), "buckets")
    sizes = members.select("id", "n").distinct()

    spokes = members.filter("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b"), F.col("n").alias("nb")).distinct()
    spokes = spokes.join(sizes.select(F.col("id").alias("a"), F.col("n").alias("na")), "a")
    spokes = spokes.filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b").distinct()
    links = staged(verified(staged(spokes, "spokes"), src, words, percent), "links")
    edges = edges.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    comp = components(edges)

    placed = members.join(comp.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("key")
    rest = staged(placed.join(mixed, "key"), "mixed")
    fine = _fine(picked(src, staged(rest.select("id").distinct(), "unlinked")), words, bands, rows)
    near = staged(_similar(rest.select("key", "id", "hub", "n", "component"), fine, percent).select(F.col("b").alias("u"), F.col("a").alias("v")), "near")
    if near.take(1):
        near = staged(components(near, "near").withColumnsRenamed({"node": "id", "component": "near"}), "near-ids")
        meet = near.join(comp.withColumnRenamed("node", "id"), "id", "left").select("near", "id", F.coalesce("component", "id").alias("component"))
        sets = _sets(picked(src, near), words).filter(F.size("s") > 0)
        meet = staged(meet.join(sets, "id").select("near", "id", "component", "s").distinct(), "meet")
        more = staged(_joined(meet, percent), "more-links")
        comp = components(edges.unionByName(more.select(F.col("b").alias("u"), F.col("a").alias("v"))))
    found = rows_of.select("id", "n").join(comp.withColumnRenamed("node", "id"), "id", "left")
    component = F.coalesce("component", "id")
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
                        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id. Its repeated rows with one text become one row, its rows
    with other texts stay, and so do all rows with a null id. Rows that are surely neither removed nor repeated are not shuffled."""
    found = near_duplicates(docs, id_col, text_col, **how)
    judged = found.groupBy(F.col("doc_id").alias("id")).agg(F.max(~F.col("kept")).alias("gone"), F.count("*").alias("rows"))
    judged = staged(judged.filter("id is not null and (gone or rows > 1)").select("id", "gone"), "judged")
    key, doubt = unused(docs, "gone_id"), unused(docs, "doubt")
    told = maybe_in(docs.withColumn(key, F.col(id_col).cast("long")), key, judged, doubt)
    sure, doubted = told.filter(~F.col(doubt)).drop(key, doubt), told.filter(doubt).drop(doubt)
    left = doubted.join(judged.filter("gone").select(F.col("id").alias(key)), key, "left_anti").drop(key)
    return sure.unionByName(left.dropDuplicates([id_col, text_col]))
