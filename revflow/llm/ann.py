"""Operator 3: approximate nearest neighbours by multiprobe p-stable hashing, exact reranking in double precision.

Nearness is the largest inner product. Vectors are scaled by the largest norm and get one more component so that all have
norm 1, queries are scaled to norm 1 with a zero there; then the nearest in Euclidean distance have the largest inner product.
Each of TABLES tables hashes a vector by K Gaussian (2-stable) projections cut into cells of width WIDTH. A query visits PROBES
buckets of each table: its own and those reached by moving single projections to a neighbouring cell, in the order of the
estimated chance of success (the sum of the squared distances to the crossed cell borders, smallest first, enumerated by a heap).

Copies of a vector are folded into one before hashing, with their KEEP smallest ids (no answer needs more). Buckets are packed into
shards of about SHARD vectors; a larger bucket is split over several shards and a query visits all of them; queries are cut
into blocks of about QUERY_BLOCK. A task scores one block against one shard and returns at most KEEP rows for each query, so
neither copies nor dense buckets gather in one task. The shards of all tables are visited in rounds, each twice as many as before it;
a query carries its KEEP-th best score so far, and tasks return only what reaches it. About as many rows as are kept reach it in a
round, so the rows that leave the tasks grow with the queries and the logarithm of the shards, and no answer is lost. Queries that
found fewer than KEEP candidates are run exactly against every shard. Every row is indexed; no fit needs a sample.

Defined results: rows with a null id, or a vector that is null, empty, zero or holds null or non-finite components, take no part. A
repeated id counts once, with its smallest vector. Vectors of different lengths are never compared. Ties go to the smaller id;
fewer candidates than ``k`` give fewer rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revflow.llm.common import map_rows
from revflow.llm.graph import staged

K, WIDTH, TABLES, PROBES, SEED = 6, 2.0, 6, 40, 20240607
SHARD, QUERY_BLOCK = 16_384, 4_096


def projections(dim: int, table: int, k: int, width: float, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dim, table])
    return rng.standard_normal((dim, k)), rng.random(k) * width


def _code(cells: np.ndarray) -> np.ndarray:
    """One 64-bit bucket code for each row of cell numbers."""
    h = np.full(len(cells), 0x9E3779B97F4A7C15, np.uint64)
    for i in range(cells.shape[1]):
        h = (h ^ cells[:, i].astype(np.int64).view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def probe_cells(at: np.ndarray, probes: int) -> np.ndarray:
    """Cells of the ``probes`` buckets nearest to the projected point ``at`` (in units of the cell width), own bucket first."""
    cell = np.floor(at).astype(np.int64)
    gap = at - cell
    k = len(at)
    moves = sorted([(float(gap[i] ** 2), i, -1) for i in range(k)] + [(float((1 - gap[i]) ** 2), i, 1) for i in range(k)])
    out, heap = [cell], [(moves[0][0], (0,))]
    while heap and len(out) < probes:
        score, chosen = heapq.heappop(heap)
        last = chosen[-1]
        if last + 1 < len(moves):
            step = moves[last + 1][0]
            heapq.heappush(heap, (score + step, (*chosen, last + 1)))
            heapq.heappush(heap, (score - moves[last][0] + step, (*chosen[:-1], last + 1)))
        if len({moves[m][1] for m in chosen}) == len(chosen):
            c = cell.copy()
            for m in chosen:
                c[moves[m][1]] += moves[m][2]
            out.append(c)
    return np.array(out)


def _usable(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def _hashed(vectors: DataFrame, largest: float, query: bool, tables: int, k: int, width: float, probes: int) -> DataFrame:
    """(key, dim, v bytes, codes): ``tables`` codes of a row, or ``tables * probes`` codes of a query, table after table."""

    def start():
        planes: dict[int, list] = {}

        def work(b: pa.RecordBatch) -> pa.RecordBatch:
            keys, dims, raw, codes = [], [], [], []
            for key, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = np.array(v, np.float64)
                if len(x) not in planes:
                    planes.clear()
                    planes[len(x)] = [projections(len(x) + 1, t, k, width) for t in range(tables)]
                norm = float(np.linalg.norm(x))
                if query:
                    unit = np.append(x / norm, 0.0)
                else:
                    unit = np.append(x / largest, max(0.0, 1 - (norm / largest) ** 2) ** 0.5)
                at = [(unit @ a + shift) / width for a, shift in planes[len(x)]]
                own = [_code(probe_cells(p, probes)) if query else _code(np.floor(p)[None, :]) for p in at]
                keys.append(key), dims.append(len(x)), raw.append(x.tobytes()), codes.append([c.tolist() for c in own])
            return pa.record_batch([pa.array(keys, pa.int64()), pa.array(dims, pa.int32()), pa.array(raw, pa.binary()),
                                    pa.array(codes, pa.list_(pa.list_(pa.int64())))], names=["key", "dim", "v", "codes"])

        return work

    return map_rows(vectors, start, "key long, dim int, v binary, codes array<array<long>>")


def _nearest(keep: int):
    """Cogroup function: a block of queries against a shard; (qkey, vkey, score) of each query's best ``keep`` in visited buckets that
    reach the query's bound (null: none yet).

    The matrix product's last bits depend on the other rows and queries of the block. It only preselects, with its rounding error as
    margin; the scores that count are row sums of a pair's products, the same wherever the pair is met.
    """

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = {"qkey": [], "vkey": [], "score": []}
        if len(queries) and len(rows):
            rows = rows.sort_values("key", ignore_index=True)
            keys = rows["key"].to_numpy()
            data = np.array([np.frombuffer(x, np.float64) for x in rows["v"]])
            rounding = 4 * data.shape[1] * np.finfo(np.float64).eps * np.linalg.norm(data, axis=1).max()
            kinds, bucket = np.unique(rows["code"].to_numpy(), return_inverse=True)
            for at in range(0, len(queries), 128):
                part = queries.iloc[at : at + 128]
                asked = np.array([np.frombuffer(x, np.float64) for x in part["v"]])
                scores = asked @ data.T
                margin = rounding * np.linalg.norm(asked, axis=1)
                seen = np.zeros((len(part), len(kinds)), bool)
                for i, visited in enumerate(part["codes"]):
                    seen[i] = True if visited is None else np.isin(kinds, visited)
                bounds = part["bound"].to_numpy(np.float64, na_value=-np.inf)
                for key, x, own, s, m, bound in zip(part["key"], asked, seen, scores, margin, np.where(np.isnan(bounds), -np.inf, bounds)):
                    near = np.flatnonzero(own[bucket] & (s >= bound - m))
                    if len(near) > keep:
                        least = np.partition(s[near], -keep)[-keep] - m
                        near = near[s[near] >= least]
                    exact = (data[near] * x).sum(axis=1)
                    near, exact = near[exact >= bound], exact[exact >= bound]
                    best = np.argsort(-exact, kind="stable")[:keep]  # stable: equal scores stay by id
                    out["qkey"].append(np.full(len(best), key)), out["vkey"].append(keys[near[best]]), out["score"].append(exact[best])
        return pd.DataFrame({c: np.concatenate(v) if v else np.empty(0, float if c == "score" else np.int64) for c, v in out.items()})

    return run


def neighbours(vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
               tables: int = TABLES, projections_of: int = K, width: float = WIDTH, probes: int = PROBES) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``vectors`` that the condition ``queries`` on ``id`` selects."""
    keep = k + 1
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
            .filter(F.col("id").isNotNull() & _usable(F.col("v"))).groupBy("id").agg(F.min("v").alias("v")))
    rows = staged(rows, "vectors")
    groups = rows.groupBy("v").agg(F.min("id").alias("key"))
    named = staged(rows.join(groups, "v").select("id", "key"), "copies")  # the join is split where one vector has very many copies
    first = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    members = named.withColumn("n", first).filter(F.col("n") <= keep).select("key", "id")
    asked = named.filter(queries).select("key").distinct()
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    facts = rows.agg(F.max(norm)).first()
    largest = facts[0] or 1.0
    of = (tables, projections_of, width, probes)
    points = groups.select("key", "v")
    hashed = staged(_hashed(points, largest, False, *of), "hashed")
    wanted = staged(_hashed(points.join(asked, "key", "left_semi"), largest, True, *of), "probes")

    n_queries = wanted.count()
    blocks = max(1, -(-n_queries // QUERY_BLOCK))
    code_rows = hashed.select("key", "dim", F.posexplode(F.flatten("codes")).alias("t", "code"))
    spread = lambda n: F.pmod(F.xxhash64("key"), n)
    sizes = code_rows.groupBy("dim", "t", "code").agg(F.count("*").alias("size"))
    sizes = staged(sizes.join(sizes.groupBy("dim", "t").agg(F.ceil(F.sum("size") / SHARD).cast("long").alias("shards")), ["dim", "t"])
                   .withColumn("parts", F.ceil(F.col("size") / SHARD).cast("long")), "bucket-sizes")
    shard = F.pmod(F.xxhash64("code", "part"), F.col("shards"))
    turn = F.floor(F.log2(F.col("shard") * tables + F.col("t") + 1)).cast("int")
    # where each row and each visit belongs, without the vectors
    placed = (code_rows.join(sizes, ["dim", "t", "code"]).withColumn("part", spread(F.col("parts"))).withColumn("shard", shard)
              .select("dim", "t", "shard", "key", "code", turn.alias("turn")))
    placed = staged(placed, "placed")
    visits = wanted.select("key", "dim", F.posexplode("codes").alias("t", "list")).select("key", "dim", "t", F.explode("list").alias("code"))
    visits = (visits.join(sizes, ["dim", "t", "code"]).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
              .withColumn("shard", shard).withColumn("block", spread(F.lit(blocks)).cast("int"))
              .groupBy("dim", "t", "shard", "block", "key").agg(F.collect_set("code").alias("codes")))
    visits = staged(visits.withColumn("turn", turn), "visits")
    in_blocks = lambda rows: rows.join(hashed.select("key", "v"), "key").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select("dim", "t", "shard", "block", "key", "v", "code")
    on = ["dim", "t", "shard", "block"]
    result = "qkey long, vkey long, score double"
    folded = lambda pairs: pairs.groupBy("qkey", "vkey").agg(F.max("score").alias("score"))  # noqa: E731  (a pair is met in several tables)
    kept = lambda pairs: pairs.withColumn("n", F.row_number().over(
        Window.partitionBy("qkey").orderBy(F.desc("score"), "vkey"))).filter(F.col("n") <= keep).drop("n")
    vectors_of = wanted.select("key", "v")
    found = None
    for now in range(((placed.agg(F.max("turn")).first()[0]) or 0) + 1):  # as many rounds as the shards have binary digits
        asking = visits.filter(F.col("turn") == now).drop("turn").join(vectors_of, "key")
        if found is None:
            asking = asking.withColumn("bound", F.lit(None).cast("double"))
        else:
            bounds = found.groupBy("qkey").agg(F.when(F.count("*") >= keep, F.min("score")).alias("bound"))
            asking = asking.join(bounds, F.col("key") == F.col("qkey"), "left").drop("qkey")
        rows_now = in_blocks(placed.filter(F.col("turn") == now))
        pairs = asking.groupBy(*on).cogroup(rows_now.groupBy(*on)).applyInPandas(_nearest(keep), result)
        found = staged(kept(folded(pairs if found is None else found.unionByName(pairs))), "found")

    counts = members.groupBy("key").agg(F.count("*").alias("copies"))
    enough = (found.join(counts, F.col("vkey") == F.col("key")).groupBy("qkey").agg(F.sum("copies").alias("n")).filter(F.col("n") >= keep))
    short = staged(wanted.join(enough, F.col("key") == F.col("qkey"), "left_anti").select("key", "dim", "v"), "short")
    if short.take(1):
        every = in_blocks(placed.filter("t = 0"))
        shards = sizes.filter("t = 0").select("dim", "shards").distinct()
        ask = (short.join(shards, "dim").withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
               .withColumn("block", spread(F.lit(blocks)).cast("int")))
        ask = ask.select("dim", F.lit(0).alias("t"), "shard", "block", "key", F.lit(None).cast("array<long>").alias("codes"), "v",
                         F.lit(None).cast("double").alias("bound"))
        exact = ask.groupBy(*on).cogroup(every.groupBy(*on)).applyInPandas(_nearest(keep), result)
        found = folded(found.unionByName(exact))

    order = lambda key: Window.partitionBy(key).orderBy(F.desc("score"), "vec_id")
    lists = (kept(found).join(members.select(F.col("key").alias("vkey"), F.col("id").alias("vec_id")), "vkey")
             .withColumn("n", F.row_number().over(order("qkey"))).filter(F.col("n") <= keep).select("qkey", "vec_id", "score"))
    each = named.filter(queries).select(F.col("id").alias("query_id"), F.col("key").alias("qkey"))
    answers = each.join(lists, "qkey").filter("query_id <> vec_id")
    return (answers.withColumn("rank", F.row_number().over(order("query_id"))).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
