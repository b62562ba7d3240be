"""Data-quality rules (D1-D7, X10-X14, X32) and the quarantine envelope.

Every rule is a Column that yields a reason string or NULL. Reasons are
collected with ``array_compact`` (not ``array_remove(.., NULL)``, which yields
NULL for every row) and merged with ``array_union`` so that a row carries each
reason once. All rules are narrow expressions except the duplicate-key rule,
which is one window over the key.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REASONS = "dq_failure_reasons"


def empty_reasons() -> Column:
    return F.array().cast(T.ArrayType(T.StringType()))

BAD_RECORD_COLUMNS = (
    "quarantine_id",
    "run_id",
    "entity_name",
    "layer_name",
    "record_key",
    "failed_rule_name",
    "failure_reason",
    "raw_record",
    "source_file_path",
    "status",
    "quarantined_ts",
)


def _collect(reasons: Sequence[Column]) -> Column:
    if not reasons:
        return empty_reasons()
    return F.array_compact(F.array(*reasons)).cast(T.ArrayType(T.StringType()))


def add_reasons(df: DataFrame, reasons: Sequence[Column]) -> DataFrame:
    """Union new reasons into ``dq_failure_reasons`` (created empty if absent)."""
    current = F.coalesce(F.col(REASONS), empty_reasons()) if REASONS in df.columns else empty_reasons()
    if not reasons and REASONS in df.columns:
        return df
    return df.withColumn(REASONS, F.array_union(current, _collect(reasons)))


# --- single rules ----------------------------------------------------------

def mandatory_rule(df: DataFrame, column: str) -> Column:
    """NULL or blank (after trim) fails; an absent column fails every row."""
    if column not in df.columns:
        return F.lit(f"MISSING_COLUMN:{column}")
    c = F.col(column)
    return F.when(c.isNull() | (F.trim(c.cast("string")) == F.lit("")), F.lit(f"MANDATORY_NULL:{column}"))


def non_negative_rule(df: DataFrame, column: str) -> Column | None:
    """D3: a non-NULL value below zero fails; NULL and absent columns pass."""
    if column not in df.columns:
        return None
    v = F.col(column).try_cast("double")
    return F.when(v.isNotNull() & (v < F.lit(0.0)), F.lit(f"NEGATIVE_VALUE:{column}"))


def positive_rule(df: DataFrame, column: str) -> Column | None:
    """A non-NULL value that is not strictly positive fails."""
    if column not in df.columns:
        return None
    v = F.col(column).try_cast("double")
    return F.when(v.isNotNull() & (v <= F.lit(0.0)), F.lit(f"NOT_POSITIVE:{column}"))


def date_order_rule(df: DataFrame, earlier: str, later: str) -> Column | None:
    """X11: ``later >= earlier`` must hold when both are present."""
    if earlier not in df.columns or later not in df.columns:
        return None
    a, b = F.col(earlier), F.col(later)
    return F.when(a.isNotNull() & b.isNotNull() & (b < a), F.lit(f"DATE_ORDER:{earlier},{later}"))


def timeliness_rule(event_col: str, ingest_col: str, max_delay_seconds: int) -> Column:
    """A row that arrived more than ``max_delay_seconds`` after its event fails."""
    delay = F.unix_timestamp(F.col(ingest_col).cast("timestamp")) - F.unix_timestamp(
        F.col(event_col).cast("timestamp")
    )
    return F.when(delay > F.lit(max_delay_seconds), F.lit(f"LATE_ARRIVAL:{event_col}"))


def with_duplicate_key_reason(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every copy of a key seen more than once in the input fails.

    Counts per key are a partial aggregation (a hot key collapses map-side);
    the repeated keys are then joined back. A whole-partition window would
    instead buffer a hot key's rows in one task.
    """
    dups = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__copies")).filter(F.col("__copies") > 1)
            .select(*(F.col(k).alias(f"__key{i}") for i, k in enumerate(keys)), F.lit("DUPLICATE_KEY").alias("__dup")))
    same = [F.col(k).eqNullSafe(F.col(f"__key{i}")) for i, k in enumerate(keys)]  # a NULL key repeats like any other
    flagged = df.join(dups, same, "left").drop(*(f"__key{i}" for i in range(len(keys))))
    return add_reasons(flagged, [F.col("__dup")]).drop("__dup")


# --- rule sets ---------------------------------------------------------------

def apply_mandatory_checks(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """D1 + D2: sets ``dq_failure_reasons`` (an empty array when all pass)."""
    reasons = [mandatory_rule(df, c) for c in columns]
    return df.withColumn(REASONS, _collect(reasons))


def apply_non_negative_checks(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """D3 + D4: unions NEGATIVE_VALUE reasons; unchanged when no rule applies."""
    reasons = [r for r in (non_negative_rule(df, c) for c in columns) if r is not None]
    if not reasons:
        return df
    return add_reasons(df, reasons)


def apply_entity_rules(
    df: DataFrame,
    mandatory: Iterable[str] = (),
    non_negative: Iterable[str] = (),
    key: str | None = None,
    deletes_exempt: bool = True,
) -> DataFrame:
    """The entity's coded rule set.

    With ``deletes_exempt`` (default) a delete tombstone is checked only for
    its key, so a delete with missing attributes still reaches the merge; set
    it to False to check deletes like any other row.
    """
    mandatory = list(mandatory)
    checked = apply_non_negative_checks(apply_mandatory_checks(df, mandatory), non_negative)
    if not deletes_exempt or "bronze_is_delete" not in df.columns:
        return checked
    key_only = [mandatory_rule(df, key)] if key else []
    is_delete = F.coalesce(F.col("bronze_is_delete"), F.lit(False))
    return checked.withColumn(REASONS, F.when(is_delete, _collect(key_only)).otherwise(F.col(REASONS)))


def conform_types(df: DataFrame, schema: T.StructType, keep_raw: bool = False) -> DataFrame:
    """Cast feed columns to a declared schema with ``try_cast``.

    A non-NULL value that fails its cast becomes NULL and adds ``BAD_TYPE:<c>``;
    a declared column absent from the feed is added as a typed NULL.
    """
    casts, reasons = {}, []
    for f in schema.fields:
        if f.name in df.columns:
            src = F.col(f.name)
            casted = src.try_cast(f.dataType)
            casts[f.name] = casted
            reasons.append(F.when(src.isNotNull() & casted.isNull(), F.lit(f"BAD_TYPE:{f.name}")))
        else:
            casts[f.name] = F.lit(None).cast(f.dataType)
    if keep_raw:
        df = df.withColumns({f"_raw_{n}": F.col(n) for n in casts if n in df.columns})
    # reasons must read the raw values, so compute them before replacing columns
    return add_reasons(df, reasons).withColumns(casts)


def split_valid_invalid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) by the size of the reason array (never NULL here)."""
    n = F.size(F.coalesce(F.col(REASONS), empty_reasons()))
    return df.filter(n == 0), df.filter(n > 0)


def split_counts(df: DataFrame) -> DataFrame:
    """A4 / F5 counts in one pass: valid and invalid rows (they add up to the input)."""
    n = F.size(F.coalesce(F.col(REASONS), empty_reasons()))
    return df.agg(F.count_if(n == 0).alias("valid_rows"), F.count_if(n > 0).alias("invalid_rows"))


def build_bad_records(
    invalid: DataFrame,
    run_id: str,
    entity_name: str,
    layer_name: str,
    key_col: str | None,
    quarantined_ts: Column | None = None,
    quarantine_id: Column | None = None,
) -> DataFrame:
    """The 11-column quarantine envelope.

    ``quarantine_id`` defaults to a hash of (entity, layer, whole row) without the
    run, so another run over the same rows gives the same ids and
    ``new_bad_records`` appends none of them twice.
    """
    cols = invalid.columns
    raw = F.to_json(F.struct(*[F.col(c) for c in cols]))
    key = F.col(key_col).cast("string") if key_col and key_col in cols else F.lit(None).cast("string")
    src_file = F.col("bronze_source_file_path") if "bronze_source_file_path" in cols else F.lit(None).cast("string")
    if quarantine_id is None:
        quarantine_id = F.sha2(F.concat_ws("\u0001", F.lit(entity_name), F.lit(layer_name), raw), 256)
    reasons = F.concat_ws("|", F.col(REASONS))
    return invalid.select(
        quarantine_id.alias("quarantine_id"),
        F.lit(run_id).alias("run_id"),
        F.lit(entity_name).alias("entity_name"),
        F.lit(layer_name).alias("layer_name"),
        key.alias("record_key"),
        reasons.alias("failed_rule_name"),
        reasons.alias("failure_reason"),
        raw.alias("raw_record"),
        src_file.alias("source_file_path"),
        F.lit("quarantined").alias("status"),
        (quarantined_ts if quarantined_ts is not None else F.current_timestamp()).alias("quarantined_ts"),
    )


def new_bad_records(bad: DataFrame, stored: DataFrame) -> DataFrame:
    """The rows of ``bad`` that are not quarantined yet. Equal bad rows of one run share an id and are all kept."""
    return bad.join(stored.select("quarantine_id").distinct(), "quarantine_id", "left_anti").select(*bad.columns)
