"""Change feed between two versions of a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], compare: Sequence[str],
               carry: Sequence[str] = ()) -> DataFrame:
    """insert / update / delete rows between ``old`` and ``new``.

    One full outer join on the key; a row is an update when any ``compare``
    column differs NULL-safely. ``carry`` columns are returned as
    ``old_<c>`` / ``new_<c>``. Unchanged keys produce no row.
    """
    cols = list(dict.fromkeys([*compare, *carry]))
    o = old.select(*keys, *[F.col(c).alias(f"old_{c}") for c in cols], F.lit(True).alias("__old"))
    n = new.select(*keys, *[F.col(c).alias(f"new_{c}") for c in cols], F.lit(True).alias("__new"))
    j = o.join(n, list(keys), "full_outer")
    changed = None
    for c in compare:
        d = ~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}"))
        changed = d if changed is None else changed | d
    kind = (F.when(F.col("__old").isNull(), F.lit("insert"))
             .when(F.col("__new").isNull(), F.lit("delete"))
             .when(changed if changed is not None else F.lit(False), F.lit("update")))
    out = j.withColumn("change_type", kind).filter(F.col("change_type").isNotNull())
    return out.select(*keys, "change_type", *[f"old_{c}" for c in carry], *[f"new_{c}" for c in carry])
