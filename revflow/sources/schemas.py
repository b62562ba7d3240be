"""The schema store of a feed: discovered, widened, kept as a history, and read across its versions.

A version is added when landed files bring a new column or a wider type. Types widen along int, long, double and then string (dates to
timestamps, nested fields each for themselves; whatever has nothing else in common becomes a string). A version that changes the
type of a column begins a new generation: Parquet files of one generation can be read with one schema, so stored rows are partitioned by
generation and each is read with its own schema and cast to the current one.

JSON feeds are read as lines, so that no value is lost: a value that doesn't fit its column's type, and a column that the schema didn't
have yet, go to the map ``_rescued``. When a later version fits them, ``current_rows`` takes them back from there. Declared
columns (``hints``) keep their type for good. Other formats are read with the discovered schema; they have nothing to rescue.
"""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from revflow.sources.files import check_format

RESCUED, GENERATION = "_rescued", "schema_generation"
#: Files are looked at again for this long, as the storage's clock may differ from the driver's.
OVERLAP = timedelta(hours=1)
_HISTORY = "version int, generation int, schema string, seen_until string, changes array<string>"
_INTEGERS = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())


def widened(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type of the rule that holds the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _INTEGERS and b in _INTEGERS:
        return max(a, b, key=_INTEGERS.index)
    numbers = (*_INTEGERS, T.FloatType(), T.DoubleType())
    if a in numbers and b in numbers:
        return T.DoubleType()
    if {type(a), type(b)} <= {T.DateType, T.TimestampType}:
        return T.TimestampType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widened(a.elementType, b.elementType))
    return T.StringType()


def merged(old: T.StructType, new: T.StructType) -> T.StructType:
    """``old`` with its types widened by ``new`` and the columns that only ``new`` has at its end."""
    found = {f.name: f.dataType for f in new.fields}
    fields = [T.StructField(f.name, widened(f.dataType, found.pop(f.name, f.dataType))) for f in old.fields]
    return T.StructType(fields + [T.StructField(n, T.StringType() if isinstance(t, T.NullType) else t) for n, t in found.items()])


def _text_cast(text: Column, kind: T.DataType) -> Column:
    """The typed value of a JSON value's text, or null where it doesn't fit."""
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.from_json(text, kind)
    return text.try_cast(kind)


class SchemaStore:
    def __init__(self, spark: SparkSession, root: str, hints: T.StructType | None = None):
        self.spark, self.root, self.hints = spark, root.rstrip("/"), hints or T.StructType()

    def history(self) -> DataFrame:
        """One row for each version: its schema, its generation and what changed."""
        try:
            return self.spark.read.schema(_HISTORY).json(self.root)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _HISTORY)

    def _latest(self):
        """The newest row of the history, or None."""
        return self.history().agg(F.max_by(F.struct("*"), F.struct("version", "seen_until"))).first()[0]

    def schema(self) -> T.StructType | None:
        row = self._latest()
        return None if row is None else _parsed(row.schema)

    def generation(self) -> int:
        row = self._latest()
        return 0 if row is None else row.generation

    def _landed(self, landing: str, fmt: str, since: datetime | None) -> T.StructType:
        """The schema of the files that landed since then; empty if there are none."""
        reader = self.spark.read.format(check_format(fmt)).option("mergeSchema", "true")
        if fmt == "csv":
            reader = reader.option("header", "true").option("inferSchema", "true")
        if since is not None:
            reader = reader.option("modifiedAfter", f"{since:%Y-%m-%dT%H:%M:%S}").option("timeZone", "UTC")
        try:
            return reader.load(landing).schema
        except AnalysisException as e:
            if e.getCondition() in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
                return T.StructType()
            raise

    def discover(self, landing: str, fmt: str = "json") -> T.StructType:
        """Look at the files that landed since the last look, add a version if they need one, and return the current schema."""
        row, now = self._latest(), datetime.now(timezone.utc)
        since = None if row is None else datetime.fromisoformat(row.seen_until) - OVERLAP
        old = self.hints if row is None else _parsed(row.schema)
        declared = set(self.hints.fieldNames())
        found = T.StructType([f for f in self._landed(landing, fmt, since).fields if f.name not in declared])
        new = merged(old, found)
        before = {f.name: f.dataType.simpleString() for f in old.fields}
        retyped = [f"{f.name}: {before[f.name]} -> {f.dataType.simpleString()}" for f in new.fields if f.name in before and before[f.name] != f.dataType.simpleString()]
        changes = [f"+ {f.name}: {f.dataType.simpleString()}" for f in new.fields if row is None or f.name not in before] + retyped
        if row is None or changes:
            version, generation = (0, 0) if row is None else (row.version + 1, row.generation + bool(retyped))
        else:
            version, generation = row.version, row.generation
        if row is None or changes or since + OVERLAP < now - OVERLAP:  # else the last look still covers it
            self.spark.createDataFrame([(version, generation, new.json(), now.isoformat(), changes)], _HISTORY).coalesce(1).write.mode("append").json(self.root)
        return new

    def typed(self, lines: DataFrame, schema: T.StructType) -> DataFrame:
        """JSON ``lines`` (column ``value``) as the columns of ``schema``, the rest in ``_rescued``; a line that is no object is kept under ``_line``."""
        parsed = F.coalesce(F.from_json("value", "map<string,string>"), F.create_map(F.lit("_line"), F.col("value")))
        rows = lines.select("_metadata", parsed.alias("__all"))
        typed = {f.name: _text_cast(F.col("__all")[f.name], f.dataType) for f in schema.fields}
        fits = F.map_from_arrays(F.array(*(F.lit(n) for n in typed)), F.array(*(c.isNotNull() for c in typed.values()))) if typed else None
        rest = F.map_filter("__all", lambda k, v: v.isNotNull() & ~(F.coalesce(F.try_element_at(fits, k), F.lit(False)) if typed else F.lit(False)))
        return rows.select("_metadata", *(c.alias(n) for n, c in typed.items()), F.when(F.size(rest) > 0, rest).alias(RESCUED))

    def read_stream(self, landing: str, fmt: str = "json") -> DataFrame:
        """The landed files as a stream in the current schema, after a look at what is new; carries the generation."""
        schema, generation = self.discover(landing, fmt), self.generation()
        if fmt == "json":
            rows = self.typed(self.spark.readStream.format("text").load(landing), schema)
        else:
            reader = self.spark.readStream.format(check_format(fmt)).schema(schema)
            rows = (reader.option("header", "true") if fmt == "csv" else reader).load(landing)
        return rows.withColumn(GENERATION, F.lit(generation))

    def current_rows(self, path: str) -> DataFrame:
        """The rows stored at ``path``, partitioned by generation, in the current schema; rescued values are taken back where they fit."""
        schemas = {r.generation: _parsed(r.schema) for r in self.history().groupBy("generation").agg(
            F.max_by("schema", "version").alias("schema")).collect()}  # one row for each generation
        current = schemas[max(schemas)]
        feed = {f.name for s in schemas.values() for f in s.fields}
        other = [f for f in self.spark.read.parquet(path).schema.fields if f.name not in feed]  # the same in every file
        out = None
        for generation, schema in sorted(schemas.items()):
            rows = self.spark.read.schema(T.StructType([*schema.fields, *other])).parquet(path).filter(F.col(GENERATION) == generation)
            rows = rows.select(*self._current(schema, current), *(f.name for f in other if f.name not in (RESCUED, GENERATION)))
            out = rows if out is None else out.unionByName(rows)
        return out

    def _current(self, schema: T.StructType, current: T.StructType) -> list[Column]:
        stored = {f.name: f.dataType for f in schema.fields}
        columns = []
        for f in current.fields:
            text = F.try_element_at(F.col(RESCUED), F.lit(f.name))
            value = _text_cast(text, f.dataType)
            if f.name in stored:
                nested = isinstance(stored[f.name], (T.StructType, T.ArrayType)) and isinstance(f.dataType, T.StringType)
                own = F.to_json(f.name) if nested else F.col(f.name).cast(f.dataType)
                value = F.coalesce(own, value)
            columns.append(value.alias(f.name))
        known = F.array(*(F.when(_text_cast(F.try_element_at(F.col(RESCUED), F.lit(f.name)), f.dataType).isNotNull(), F.lit(f.name)) for f in current.fields))
        left = F.map_filter(F.col(RESCUED), lambda k, v: ~F.coalesce(F.array_contains(F.array_compact(known), k), F.lit(False)))
        return [*columns, F.when(F.size(left) > 0, left).alias(RESCUED)]


def _parsed(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))
