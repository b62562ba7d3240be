"""The schema store (S2, S5), drift over landed files (X26) and Z-order clustering."""

import json
import random
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revflow import jobs
from revflow.operators.layout import compact, z_ordered
from revflow.plans import ops_views
from revflow.sources.schemas import SchemaStore, merged, widened
from revflow.spec import OPPORTUNITY

B, I, L, D, S = T.ByteType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()


@pytest.mark.parametrize("a,b,want", [
    (I, I, I), (I, L, L), (B, I, I), (L, D, D), (D, I, D), (D, S, S), (L, S, S), (T.BooleanType(), L, S), (T.NullType(), L, L), (L, T.NullType(), L),
    (T.DateType(), T.TimestampType(), T.TimestampType()), (T.ArrayType(I), T.ArrayType(D), T.ArrayType(D)), (T.ArrayType(I), S, S),
])
def test_widening(a, b, want):
    assert widened(a, b) == want == widened(b, a)


def test_merged_keeps_order_and_nested_fields():
    old = T.StructType().add("a", I).add("s", T.StructType().add("x", I))
    new = T.StructType().add("z", T.NullType()).add("s", T.StructType().add("y", S).add("x", D)).add("a", L)
    assert merged(old, new).simpleString() == "struct<a:bigint,s:struct<x:double,y:string>,z:string>"


def land(spark, path, *rows):
    spark.createDataFrame([(json.dumps(r) if not isinstance(r, str) else r,) for r in rows], "value string").coalesce(1).write.mode("append").text(path)


def test_history_and_generations(spark, scratch):
    store, landing = SchemaStore(spark, f"{scratch}/schemas", T.StructType().add("id", L)), f"{scratch}/landing"
    land(spark, landing, {"id": 1, "n": 1})
    assert store.discover(landing).simpleString() == "struct<id:bigint,n:bigint>"
    assert store.discover(landing) == store.schema() and store.generation() == 0
    land(spark, landing, {"id": 2, "n": 2, "more": True})
    assert store.discover(landing).simpleString() == "struct<id:bigint,n:bigint,more:boolean>" and store.generation() == 0
    land(spark, landing, {"id": "not a number", "n": 2.5})
    assert store.discover(landing).simpleString() == "struct<id:bigint,n:double,more:boolean>" and store.generation() == 1
    versions = {r.version: r.changes for r in store.history().collect() if r.changes}
    assert versions == {0: ["+ id: bigint", "+ n: bigint"], 1: ["+ more: boolean"], 2: ["n: bigint -> double"]}


def test_nothing_is_lost_and_later_versions_take_rescued_values_back(spark, scratch):
    """Rows that came before their column was known, values that don't fit, and lines that are no objects."""
    ws = jobs.Workspace(spark, f"{scratch}/ws", {"opportunity": T.StructType().add("opportunityid", L).add("modifiedon", T.TimestampType())})
    store, landing = ws.schemas("opportunity"), f"{scratch}/landing"
    land(spark, landing, {"opportunityid": 1, "n": 1, "modifiedon": "2024-01-01 00:00:00"})
    schema = store.discover(landing)
    # the stream was started before this file came: its new column and the value that doesn't fit are rescued
    land(spark, landing, {"opportunityid": 2, "n": "two", "late": {"x": [1]}}, "no json", {"opportunityid": "x3"}, {})
    lines = spark.read.text(landing).select("value", F.struct(F.lit("f").alias("file_path")).alias("_metadata"))
    got = {json.dumps([r.opportunityid, r.n, r._rescued], sort_keys=True) for r in store.typed(lines, schema).collect()}
    assert got == {json.dumps(x, sort_keys=True) for x in (
        [1, 1, None], [2, None, {"n": "two", "late": '{"x":[1]}'}], [None, None, {"_line": "no json"}], [None, None, {"opportunityid": "x3"}], [None, None, None])}
    assert jobs.run_bronze(ws, OPPORTUNITY, landing, None, "b1", fmt="json") == 5
    land(spark, landing, {"opportunityid": 4, "n": 4.5})
    assert jobs.run_bronze(ws, OPPORTUNITY, landing, None, "b2", fmt="json") == 1
    rows = {r.opportunityid: r for r in ws.bronze("opportunity").collect() if r.opportunityid}
    assert {i: r.n for i, r in rows.items()} == {1: "1", 2: "two", 4: "4.5"} and rows[2].late.x == [1] and rows[2]._rescued is None
    assert ws.bronze("opportunity").filter("_rescued is not null").count() == 2
    assert rows[2].bronze_source_file_path.endswith(".txt")


def test_silver_across_generations(spark, scratch):
    """A column that widens between two runs: silver and its fold hold the values of both."""
    ws = jobs.Workspace(spark, f"{scratch}/ws", {"opportunity": T.StructType().add("opportunityid", L).add("modifiedon", T.TimestampType())})
    landing = f"{scratch}/landing"
    base = dict.fromkeys(OPPORTUNITY.mandatory_columns, "x") | {"estimatedvalue": 5}
    for i, n in enumerate((1, 2.5, "three")):
        land(spark, landing, *({**base, "opportunityid": k, "modifiedon": f"2024-01-0{i + 1} 00:00:00", "n": n} for k in ((1, 2, 3)[i:] if i else (1, 2, 3, 4))))
        jobs.run_bronze(ws, OPPORTUNITY, landing, None, f"b{i}", fmt="json")
        assert jobs.run_silver(ws, OPPORTUNITY, f"s{i}") == "success"
        if i == 1:
            assert ws.silver("opportunity").fold("opportunityid") is not None
    assert {r.opportunityid: r.n for r in ws.silver("opportunity").read().collect()} == {1: "1.0", 2: "2.5", 3: "three", 4: "1.0"}


def test_drift_of_odd_files(spark):
    t = [datetime(2024, 1, d, tzinfo=timezone.utc) for d in (1, 2, 3)]
    rows = [('{"a": 1, "b": 2.0}', "f1", t[0]), ('{"a": 2, "b": 3}', "f1", t[0]), ('{"a": "x", "c": null}', "f2", t[1]), ("broken", "f3", t[2]), ("", "f3", t[2])]
    lines = spark.createDataFrame(rows, "value string, file string, landed timestamp")
    got = {(r.column_name, r.change, r.actual_type, r.files, r.first_file) for r in ops_views.landed_drift(lines, T.StructType().add("a", L).add("b", D)).collect()}
    assert got == {("a", "TYPE_CHANGED", "string", 1, "f2"), ("a", "MISSING_COLUMN", None, 1, "f3"), ("b", "MISSING_COLUMN", None, 2, "f2")}
    assert ops_views.landed_drift(lines.filter("false"), T.StructType().add("a", L)).count() == 0


def rows_scanned(spark, df) -> int:
    """Rows that the scan handed on, from its own metric (row groups that the footer rules out are not read)."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df._jdf.queryExecution().executedPlan()
        df._jdf.queryExecution().toRdd().count()
        leaves = plan.collectLeaves()
        return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_z_order_skips_on_either_column(spark, scratch):
    rng = random.Random(4)
    rows = [(i, rng.randrange(1000), date(2024, 1, 1 + rng.randrange(28)), rng.choice(["u", "v", None])) for i in range(20_000)]
    df = spark.createDataFrame(rows, "id long, a int, t date, s string")
    df.repartition(20).write.parquet(f"{scratch}/v0")
    z = compact(spark, f"{scratch}/v0", f"{scratch}/z", ["a", "t"], rows_per_file=100, z_order=True)
    line = compact(spark, f"{scratch}/v0", f"{scratch}/line", ["a", "t"], rows_per_file=100)
    assert sorted(z.collect()) == sorted(df.collect())
    on_a, on_t = F.col("a").between(500, 520), F.col("t").between(F.lit(date(2024, 1, 14)), F.lit(date(2024, 1, 15)))
    whole = 20_000
    assert rows_scanned(spark, spark.read.parquet(f"{scratch}/v0").filter(on_a)) == whole
    assert rows_scanned(spark, line.filter(on_t)) > 0.9 * whole  # sorted by a first: t rules nothing out
    for cond in (on_a, on_t):
        assert rows_scanned(spark, z.filter(cond)) < 0.4 * whole
    assert sorted(z_ordered(df, ["s", "a", "t"], 4, bits=2).collect(), key=str) == sorted(df.collect(), key=str)
    assert z_ordered(df.filter("false"), ["a", "t"], 3).count() == 0
