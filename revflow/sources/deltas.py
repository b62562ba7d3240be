"""Keyed tables as appended changes in plain partitioned Parquet, folded on read.

``changes/schema_generation=<g>/_order=<n>/_run=<run>/`` holds the rows that one run changed, written with Spark's dynamic partition overwrite: a run's write is
proportional to its batch and touches no other run's files. A read
takes the changes and folds them (``operators.fold``). ``fold`` writes the state of all changes so far as ``base/_upto=<n>/`` and then
adds ``n`` to ``folds``; from then on reads take that base and the changes after ``n`` (older partitions are pruned and can be deleted by
the storage's lifecycle rule). A base that was not finished is not in ``folds`` and never read.

Columns may be added by any run. A run whose columns have other types than before belongs to a new schema generation (the caller gives its
number, see ``sources.schemas``); each generation is read by itself and cast to the widened types.

One writer at a time for each table, as with the runs of one job or the micro-batches of one stream; readers need no coordination.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from revflow.operators.fold import ORDER, RUN, STATE, fold_activity, fold_current_state, fold_fact, newest_kind
from revflow.sources.schemas import GENERATION, merged
from revflow.spec import EntitySpec


class ChangeTable:
    """``folded`` maps the live changes to one row for each key; ``shown`` maps these rows to those that a reader gets."""

    def __init__(self, spark: SparkSession, root: str, folded: Callable[[DataFrame], DataFrame],
                 shown: Callable[[DataFrame], DataFrame] = lambda rows: rows, generation: int = 0):
        self.spark, self.root, self.folded, self.shown, self.generation = spark, root.rstrip("/"), folded, shown, generation

    def _read(self, path: str, merge: bool = True) -> DataFrame | None:
        try:
            return self.spark.read.option("mergeSchema", str(merge).lower()).parquet(f"{self.root}/{path}")
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def upto(self) -> int | None:
        """The last order that the current base holds."""
        folds = self._read("folds", merge=False)
        return None if folds is None else folds.agg(F.max("upto")).first()[0]

    def appended(self) -> DataFrame | None:
        """Every run's changes, with their order and run."""
        parts = [self._read(f"changes/{GENERATION}={g}") for g in range(self.generation + 1)]
        rows = _union([p for p in parts if p is not None])
        return None if rows is None else rows.withColumns({ORDER: F.col(ORDER).cast("long"), RUN: F.col(RUN).cast("string")})

    def changes(self) -> DataFrame | None:
        """The live changes: those after the base, and the base's rows as of its order."""
        return self._live(self.appended(), self.upto())

    def _live(self, rows: DataFrame | None, upto: int | None) -> DataFrame | None:
        if rows is not None:
            rows = rows.withColumn(STATE, F.lit(False))
        if upto is None:
            return rows
        base = self.spark.read.parquet(f"{self.root}/base/_upto={upto}").withColumns(
            {ORDER: F.lit(upto).cast("long"), RUN: F.lit(""), STATE: F.lit(True)})
        return base if rows is None else _union([rows.filter(F.col(ORDER) > upto), base])

    def changes_at(self, after: int) -> DataFrame | None:
        """The changes from which the state at ``after`` and later ones follow: with the base if it is not later than ``after``, else
        every run's (their partitions must still be there)."""
        base = self.upto()
        return self._live(self.appended(), base if base is not None and base <= after else None)

    def exists(self) -> bool:
        """S10."""
        return any(self._read(f"changes/{GENERATION}={g}", merge=False) is not None for g in range(self.generation + 1))

    def read(self) -> DataFrame | None:
        changes = self.changes()
        return None if changes is None else self.shown(self.folded(changes))

    def append(self, rows: DataFrame, run: str, order: int = 0, replays: bool = False) -> int:
        """Write one run's changes (one row for each key) and return their order: ``order`` or the next one free, whichever is later.

        ``order`` is usually the run's time in microseconds. A repeated run is appended again, as it may have read more; merging a
        change twice changes nothing. With ``replays`` (a run that always has the same rows, as a micro-batch) it replaces its own rows in
        their place.
        """
        seen = self.appended()
        if seen is not None:
            last, own = seen.agg(F.max(ORDER), F.max(F.when(F.col(RUN) == run, F.col(ORDER)))).first()
            order = own if replays and own is not None else max(order, last + 1)
        self._write(rows.withColumns({ORDER: F.lit(order).cast("long"), RUN: F.lit(run)}))
        return order

    def append_runs(self, rows: DataFrame) -> None:
        """Write the changes of several runs, with their order and run as columns, in one job."""
        self._write(rows.hint("rebalance", ORDER, RUN))

    def _write(self, rows: DataFrame) -> None:
        (rows.withColumn(GENERATION, F.lit(self.generation)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(GENERATION, ORDER, RUN).parquet(f"{self.root}/changes"))

    def fold(self, *cluster_by: str) -> int | None:
        """Write a new base of all changes so far, its files clustered by ``cluster_by``; returns the order it holds."""
        rows, upto = self.appended(), self.upto()
        last = None if rows is None else rows.agg(F.max(ORDER)).first()[0]
        if last is None or last == upto:
            return None
        state = self.folded(self._live(rows, upto).filter(F.col(ORDER) <= last))
        if cluster_by:
            state = state.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
        state.write.mode("overwrite").parquet(f"{self.root}/base/_upto={last}")
        self.spark.createDataFrame([(last,)], "upto long").coalesce(1).write.mode("append").parquet(f"{self.root}/folds")
        return last


def _union(frames: list[DataFrame]) -> DataFrame | None:
    """The rows of all frames with the columns of all, cast to their widened types."""
    if len(frames) < 2:
        return frames[0] if frames else None
    kinds = reduce(merged, (f.schema for f in frames))
    cast = [f.select(*(F.col(k.name).cast(k.dataType).alias(k.name) for k in kinds.fields if k.name in f.columns)) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)


def state_table(spark: SparkSession, root: str, spec: EntitySpec, generation: int = 0, **how) -> ChangeTable:
    """A silver table: prepared changes (``prepare_silver_source``), read as the current state; ``how`` goes to the fold."""
    return ChangeTable(spark, root, lambda changes: fold_current_state(changes, spec, **how), generation=generation)


def fact_table(spark: SparkSession, root: str, key: str, generation: int = 0) -> ChangeTable:
    """A gold fact: rows with ``gold_delete_flag``, read as the active rows."""
    return ChangeTable(spark, root, lambda changes: fold_fact(changes, key), generation=generation)


def activity_table(spark: SparkSession, root: str, generation: int = 0) -> ChangeTable:
    """fact_activity: flagged rows of both kinds, read as the active ones; what each kind says of an id is kept."""
    return ChangeTable(spark, root, fold_activity, newest_kind, generation)
