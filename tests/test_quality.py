from pyspark.sql import functions as F
from pyspark.sql import types as T

from revflow.functions import quality as dq


def _reasons(df):
    return {r[0]: list(r.dq_failure_reasons) for r in df.collect()}


def test_mandatory_blank_null_missing(spark):
    df = spark.createDataFrame([(1, "a"), (2, " "), (3, None)], "id long, name string")
    out = _reasons(dq.apply_mandatory_checks(df, ["name", "absent"]))
    assert out == {1: ["MISSING_COLUMN:absent"], 2: ["MANDATORY_NULL:name", "MISSING_COLUMN:absent"],
                   3: ["MANDATORY_NULL:name", "MISSING_COLUMN:absent"]}


def test_no_rules_gives_empty_array_not_null(spark):
    df = spark.createDataFrame([(1, 5.0)], "id long, v double")
    checked = dq.apply_mandatory_checks(df, [])
    assert checked.first().dq_failure_reasons == []
    valid, invalid = dq.split_valid_invalid(checked)
    assert valid.count() == 1 and invalid.count() == 0


def test_non_negative_null_passes_and_union_dedups(spark):
    df = spark.createDataFrame([(1, -1.0), (2, None), (3, 0.0)], "id long, v double")
    out = dq.apply_non_negative_checks(dq.apply_mandatory_checks(df, ["v"]), ["v", "absent"])
    r = _reasons(out)
    assert r[1] == ["NEGATIVE_VALUE:v"] and r[2] == ["MANDATORY_NULL:v"] and r[3] == []
    assert dq.apply_non_negative_checks(df, ["absent"]) is df


def test_split_is_a_partition(spark):
    df = spark.range(100).withColumn("v", F.col("id") - 50)
    checked = dq.apply_non_negative_checks(dq.apply_mandatory_checks(df, ["id"]), ["v"])
    valid, invalid = dq.split_valid_invalid(checked)
    assert valid.count() + invalid.count() == 100 and invalid.count() == 50


def test_deletes_exempt_from_attribute_rules(spark):
    df = spark.createDataFrame([(1, None, True), (2, None, False), (None, None, True)],
                               "id long, created string, bronze_is_delete boolean")
    out = dq.apply_entity_rules(df, ["id", "created"], [], key="id")
    r = {row.bronze_is_delete and row.id: list(row.dq_failure_reasons) for row in out.collect()}
    assert r[1] == [] and r[False] == ["MANDATORY_NULL:created"]
    strict = dq.apply_entity_rules(df, ["id", "created"], [], key="id", deletes_exempt=False)
    assert dq.split_valid_invalid(strict)[0].count() == 0


def test_bad_record_envelope_is_stable(spark):
    df = spark.createDataFrame([(7, -2.0, "f1")], "id long, v double, bronze_source_file_path string")
    inv = dq.split_valid_invalid(dq.apply_non_negative_checks(dq.apply_mandatory_checks(df, ["id"]), ["v"]))[1]
    a = dq.build_bad_records(inv, "r", "e", "silver", "id", F.lit("2024-01-01").cast("timestamp"))
    b = dq.build_bad_records(inv, "r", "e", "silver", "id", F.lit("2024-01-01").cast("timestamp"))
    ra, rb = a.first(), b.first()
    assert a.columns == list(dq.BAD_RECORD_COLUMNS)
    assert ra.quarantine_id == rb.quarantine_id and ra.record_key == "7"
    assert ra.failed_rule_name == "NEGATIVE_VALUE:v" and ra.source_file_path == "f1" and ra.status == "quarantined"
    assert '"v":-2.0' in ra.raw_record


def test_extended_rules(spark):
    df = spark.createDataFrame(
        [(1, 0.0, "2024-01-02", "2024-01-01", "2024-01-01 00:00:00", "2024-01-02 00:00:00"),
         (1, 5.0, "2024-01-01", "2024-01-02", "2024-01-01 00:00:00", "2024-01-01 01:00:00")],
        "id long, amt double, created string, close string, ev string, ing string")
    out = dq.add_reasons(df, [dq.positive_rule(df, "amt"), dq.date_order_rule(df, "created", "close"),
                              dq.timeliness_rule("ev", "ing", 3600 * 12)])
    out = dq.with_duplicate_key_reason(out, ["id"])
    rows = sorted((r.amt, sorted(r.dq_failure_reasons)) for r in out.collect())
    assert rows[0] == (0.0, sorted(["NOT_POSITIVE:amt", "DATE_ORDER:created,close", "LATE_ARRIVAL:ev",
                                    "DUPLICATE_KEY"]))
    assert rows[1] == (5.0, ["DUPLICATE_KEY"])


def test_conform_types(spark):
    df = spark.createDataFrame([("1", "x"), ("2", "3"), (None, None)], "a string, b string")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.IntegerType()),
                           T.StructField("c", T.DateType())])
    out = dq.conform_types(df, schema)
    assert out.schema["a"].dataType == T.LongType() and out.schema["c"].dataType == T.DateType()
    got = {r.a: (r.b, list(r.dq_failure_reasons)) for r in out.collect()}
    assert got == {1: (None, ["BAD_TYPE:b"]), 2: (3, []), None: (None, [])}
