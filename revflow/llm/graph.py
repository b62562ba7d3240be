"""Staged tables and connected components for the grouping operators."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revflow.llm.common import unused
from revflow.session import scratch_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: a lineage cut that lost executors survive."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bits of the map that ``maybe_in`` broadcasts: at most 524,288 rows of one 64-bit word, about 25 MB, however many ids there are.
BITS = 1 << 25


def maybe_in(df: DataFrame, col: str, ids: DataFrame, maybe: str) -> DataFrame:
    """``df`` with a boolean column ``maybe``: false only where ``col`` is surely not among ``ids(id)`` (null: false).

    A bitmap of the hashed ids, so that rows without a partner are told before they are shuffled. With very many ids most bits are
    set and fewer rows are told; a join decides about the rest.
    """
    word, bits = unused(df, "word"), unused(df, "bits")

    def bit(c):
        return F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(BITS))

    at = ids.filter("id is not null").select(F.shiftright(bit("id"), 6).alias(word), (bit("id") % 64).cast("int").alias("pos"))
    words = at.groupBy(word).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos"))).alias(bits))
    hit = F.getbit(F.col(bits), (bit(col) % 64).cast("int")) == 1
    rows = df.withColumn(word, F.when(F.col(col).isNotNull(), F.shiftright(bit(col), 6)))
    return rows.join(F.broadcast(words), word, "left").withColumn(maybe, F.coalesce(hit, F.lit(False))).drop(word, bits)


def picked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs(id, ...)`` whose id is among ``ids(id)``; most others are left out before the shuffle."""
    return maybe_in(docs, "id", ids, "maybe").filter("maybe").drop("maybe").join(ids, "id", "left_semi")


def _local_forest(edges: DataFrame) -> DataFrame:
    """Union-find within each partition: its edges (u > v) become one edge from each node to its root there."""

    def run(batches):
        parent: dict[int, int] = {}

        def find(x):
            while (p := parent.setdefault(x, x)) != x:
                parent[x] = parent[p]
                x = p
            return x

        for b in batches:
            for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                a, c = find(u), find(v)
                if a != c:
                    parent[max(a, c)] = min(a, c)
        pairs = [(x, r) for x in list(parent) if (r := find(x)) != x]
        for at in range(0, len(pairs), 50_000):
            u, v = zip(*pairs[at : at + 50_000])
            yield pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return edges.mapInArrow(run, "u long, v long")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of the nodes in ``edges(u, v)``; a component's id is its smallest node.

    Union-find shrinks each partition's edges to a forest; then large-star and small-star steps hook every node to its
    smallest known neighbour until nothing changes. A node's minimum is a partial aggregate, so a hub with very many
    neighbours is folded before the shuffle and its edges can be split by the skew join.
    """
    e = edges.filter("u is not null and v is not null and u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = staged(_local_forest(e), name)
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        low = staged(low, f"{name}-low")  # a plain scan, so that the skew join can split a hub's edges
        star = both.join(low, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = star.groupBy("u").agg(F.min("v").alias("m"))
        hooked = star.join(low, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").filter("u <> v").distinct()
        e = staged(hooked, name)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = now
