"""Operator 10: byte-level BPE encoding and decoding.

Each match of the split pattern is looked up in two tiers. Tier one is a minimal perfect hash over the vocabulary
(hash and displace: every key has its own slot, as many slots as keys), which resolves a pre-token that is itself a
vocabulary entry with two hashes and one comparison. Tier two merges the bytes of a miss: a heap of (rank, position)
over a doubly linked list of byte spans, lowest rank first, leftmost among equals.

Defined results: a null text counts as empty and gives no ids and empty decoded bytes; null ids and repeated rows give
one output row per input row; special tokens are ordinary text; only the id and text columns are read, so extra columns
never clash; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revflow.llm.common import Memo, map_rows

#: Keys per displacement bucket of the perfect hash.
BUCKET = 4


def read_ranks(path: str) -> list[tuple[bytes, int]]:
    """(token bytes, rank) of a ``.tiktoken`` file: base64 token and rank on each line."""
    with open(path, "rb") as f:
        return [(base64.b64decode(a), int(b)) for a, b in (line.split() for line in f if line.strip())]


#: Odd multiplier of the displaced hash; its arithmetic is modulo 2**64.
ODD, M64 = 0x9E3779B97F4A7C15, (1 << 64) - 1


def _place(b, d, n):
    """Slots of the hashes ``b`` under the displacements ``d``, modulo 2**64 and then n."""
    odd = np.uint64(ODD)
    return (((b ^ (d * odd)) * odd >> np.uint64(32)) % np.uint64(n)).astype(np.int64)


class PerfectHash:
    """Minimal perfect hash: n keys, n slots. ``disp[b]`` >= 0 displaces bucket b; below 0 it names the slot of a lone key."""

    def __init__(self, keys: list[bytes]):
        n = self.n = max(1, len(keys))
        self.buckets = max(1, n // BUCKET)
        hs = [xxhash.xxh3_64_intdigest(k) for k in keys]
        groups: dict[int, list[int]] = {}
        for i, h in enumerate(hs):
            groups.setdefault(h % self.buckets, []).append(i)
        self.disp, self.slot_key = [0] * self.buckets, [b""] * n
        free, where = np.ones(n, bool), np.full(len(keys), -1)
        lone = []
        for b, members in sorted(groups.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(members) == 1:
                lone.append((b, members[0]))
                continue
            base = np.array([hs[i] for i in members], np.uint64)
            start = 0
            while True:
                d = np.arange(start, start + 256, dtype=np.uint64)[:, None]
                pos = _place(base, d, n)
                ok = free[pos].all(1)
                hit = next((r for r in np.flatnonzero(ok) if len(set(pos[r])) == len(members)), None)
                if hit is not None:
                    break
                start += 256
                if start > 1 << 22:
                    raise ValueError("repeated keys have no perfect hash")
            self.disp[b] = int(start + hit)
            free[pos[hit]] = False
            where[members] = pos[hit]
        for (b, i), slot in zip(lone, np.flatnonzero(free).tolist()):
            self.disp[b], where[i] = -1 - slot, slot
        for i, k in enumerate(keys):
            self.slot_key[where[i]] = k
        self.where = where
        self.turn = [d if d < 0 else d * ODD & M64 for d in self.disp]

    def slot(self, key: bytes) -> int:
        """The key's slot, or -1 for a key outside the set."""
        h = xxhash.xxh3_64_intdigest(key)
        d = self.turn[h % self.buckets]
        s = -1 - d if d < 0 else (((h ^ d) * ODD & M64) >> 32) % self.n
        return s if self.slot_key[s] == key else -1


#: The links of short pieces before any merge.
_NEXT, _LAST = list(range(1, 65)), list(range(-1, 63))


class Codec:
    """Encodes and decodes; many ids are handed on as packed native int32 (``bytes``), a fraction of a list's memory and time."""

    def __init__(self, ranks: list[tuple[bytes, int]], pattern: str):
        self.entry = {k: r << 32 for k, r in ranks}  # the heap's entries are rank << 32 | position
        self.mph = PerfectHash([k for k, _ in ranks])
        self.slot_id = [b""] * self.mph.n
        for (_, r), s in zip(ranks, self.mph.where.tolist()):
            self.slot_id[s] = array("i", (r,)).tobytes()
        self.byte, self.pair = [None] * 256, [[-1] * 256 for _ in range(256)]
        for k, r in self.entry.items():
            if len(k) == 1:
                self.byte[k[0]] = r >> 32
            elif len(k) == 2:
                self.pair[k[0]][k[1]] = r
        tokens = [None] * (max((r for _, r in ranks), default=-1) + 1)
        for k, r in ranks:
            tokens[r] = k
        self.tokens = pa.array(tokens, pa.binary())
        self.split = regex.compile(pattern).findall
        self.memo = Memo(self.piece, 120_000, 48)  # about 35 MB for common words, as the codec stays in the worker

    def piece(self, token: str) -> bytes:
        data = token.encode()
        s = self.mph.slot(data)
        return self.slot_id[s] if s >= 0 else self.merge(data)

    def merge(self, data: bytes) -> bytes:
        get, pair, n = self.entry.get, self.pair, len(data)
        if n <= len(_NEXT):
            after, before = _NEXT[:n], _LAST[:n]
        else:
            after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ids = list(map(self.byte.__getitem__, data))
        now = [pair[a][b] for a, b in zip(data, data[1:])]  # the shifted rank of each span joined with the next one; -1: none
        now.append(-1)
        heap = [x | i for i, x in enumerate(now) if x >= 0]
        heapq.heapify(heap)
        pop, push, live = heapq.heappop, heapq.heappush, len(heap)
        while live:  # entries of the heap that are still some span's; the others are passed over
            x = pop(heap)
            i = x & 0xFFFFFFFF
            if now[i] | i != x:
                continue
            ids[i] = x >> 32
            j = after[i]
            k = after[i] = after[j]
            live -= 1
            if k < n:
                if now[j] >= 0:
                    now[j] = -1
                    live -= 1
                before[k] = i
                x = now[i] = get(data[i : after[k]], -1)
                if x >= 0:
                    push(heap, x | i)
                    live += 1
            else:
                now[i] = -1
            p = before[i]
            if p >= 0:
                if now[p] >= 0:
                    live -= 1
                x = now[p] = get(data[p:k], -1)
                if x >= 0:
                    push(heap, x | p)
                    live += 1
        out, i = array("i"), 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return out.tobytes()

    def packed(self, text: str) -> bytes:
        """The text's ids, packed."""
        return b"".join(map(self.memo.__getitem__, self.split(text)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()

    def decode(self, ids: pa.Array, ends: np.ndarray) -> pa.Array:
        """The bytes of each run of ``ids``; ``ends`` holds 0 and the int32 end of every run."""
        _, starts, data = (found := self.tokens.take(ids)).buffers()
        if found.null_count:
            raise KeyError("an id outside the vocabulary")
        at = np.frombuffer(starts, np.int32, len(ids) + 1)[ends] if len(ids) else np.zeros(len(ends), np.int32)
        return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(at), data if data is not None else pa.py_buffer(b"")])


_CODECS: dict[int, Codec] = {}


def _codec(shared) -> Codec:
    """One codec per worker process and vocabulary."""
    if shared.id not in _CODECS:
        _CODECS.clear()
        _CODECS[shared.id] = Codec(*shared.value[1])
    return _CODECS[shared.id]


class _Shared:
    """A broadcast vocabulary (its size is the vocabulary's, not the data's) under a key that survives pickling."""

    def __init__(self, spark, ranks, pattern):
        self.id = xxhash.xxh3_64_intdigest(repr((sorted(ranks), pattern)).encode())
        self.cast = spark.sparkContext.broadcast((self.id, (ranks, pattern)))

    @property
    def value(self):
        return self.cast.value


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           out: str = "token_ids") -> DataFrame:
    """(id, token ids) of every whole text."""
    return _coded(docs, ranks_path, pattern, id_col, text_col, False).select(F.col("k").alias(id_col), F.col("v").alias(out))


def _coded(docs: DataFrame, ranks_path: str, pattern: str, id_col: str, text_col: str, decoded: bool) -> DataFrame:
    """(k, v): id and token ids of every whole text; with ``decoded`` also d, the bytes that the ids decode to."""
    shared = _Shared(docs.sparkSession, read_ranks(ranks_path), pattern)
    src = docs.select(F.col(id_col).cast("long").alias("k"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))

    def start():
        codec = _codec(shared)

        def work(b: pa.RecordBatch) -> pa.RecordBatch:
            packed = [codec.packed(t) for t in b.column(1).to_pylist()]
            ends = np.zeros(len(packed) + 1, np.int32)
            np.cumsum([len(x) // 4 for x in packed], out=ends[1:])
            ids = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(packed))])
            columns = [b.column(0), pa.ListArray.from_arrays(pa.array(ends), ids)]
            if decoded:
                columns.append(codec.decode(ids, ends))
            return pa.record_batch(columns, names=["k", "v", "d"][: len(columns)])

        return work

    return map_rows(src, start, "k long, v array<int>" + ", d binary" * decoded)


def decode(tokens: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "token_ids",
           out: str = "decoded") -> DataFrame:
    """All columns of the id and ids plus the decoded bytes. A null id list decodes to empty bytes; an unknown id fails."""
    shared = _Shared(tokens.sparkSession, read_ranks(ranks_path), None)
    src = tokens.select(F.col(id_col).cast("long").alias("k"), F.col(ids_col).alias("v"))

    def start():
        token = {r: k for k, r in shared.value[1][0]}  # decoding needs no perfect hash

        def work(b: pa.RecordBatch) -> pa.RecordBatch:
            ids = b.column(1)
            ends = np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy()).tolist()
            parts = list(map(token.__getitem__, ids.flatten().to_numpy(zero_copy_only=False).tolist()))  # skips null lists
            texts = [b"".join(parts[i:j]) for i, j in zip([0, *ends], ends)]
            return pa.record_batch([b.column(0), b.column(1), pa.array(texts, pa.binary())], names=["k", "v", "d"])

        return work

    return map_rows(src, start, "k long, v array<int>, d binary").select(
        F.col("k").alias(id_col), F.col("v").alias(ids_col), F.col("d").alias(out))


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text, then decode its ids: (id, token_ids, decoded). One pass, so a task needs one Python worker and one codec."""
    return _coded(docs, ranks_path, pattern, id_col, text_col, True).select(
        F.col("k").alias(id_col), F.col("v").alias("token_ids"), F.col("d").alias("decoded"))


def digests(coded: DataFrame) -> DataFrame:
    """The contract's digest columns of ``round_trip``."""
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
