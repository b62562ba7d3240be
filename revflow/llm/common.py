"""Helpers shared by the text operators: whole-text mapping in Arrow batches, bounded memo, hash split."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts per Arrow batch that a task hands back; bounds the memory of one batch whatever the partition size.
CHUNK = 256


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """The fixed hold-out split: crc32 of the id as text, remainder 1 by 3. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def unused(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    have = {c.lower() for c in df.columns}
    while base in have:
        base += "_"
    return base


def give_back() -> None:
    """Hand freed memory back to the system. Spark keeps a Python worker for later tasks and stages, and the worker keeps what it freed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim:
        trim(0)


def map_rows(df: DataFrame, fn: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` over slices of at most CHUNK rows. ``fn()`` runs once in each task and returns the batch function."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = fn()
        for b in batches:
            for at in range(0, b.num_rows, CHUNK):
                out = work(b.slice(at, CHUNK))
                if out.num_rows:
                    yield out
        b = out = work = None
        give_back()

    return df.mapInArrow(run, schema)


class Memo(dict):
    """``memo[key]`` computes a missing value; at most two generations of ``cap`` entries stay in memory.

    Keys longer than ``longest`` are computed each time and not kept, so the bytes are bounded too: a text without spaces is one key.
    """

    def __init__(self, compute: Callable, cap: int = 100_000, longest: int = 64):
        super().__init__()
        self.compute, self.cap, self.longest, self.old = compute, cap, longest, {}

    def __missing__(self, key):
        v = self.old.get(key)
        if v is None:
            v = self.compute(key)
        if len(key) > self.longest:
            return v
        if len(self) >= self.cap:
            self.old = dict(self)
            self.clear()
        self[key] = v
        return v
