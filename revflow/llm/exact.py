"""Operator 12: exact duplicates by sorting contents (DataFrame functions only).

Spark samples splitters and range-partitions the normalised texts, an external sort places equal texts next to each other, and a
window over the sorted rows, whose groups end where the full text of a row differs from its neighbour's, finds the identifier that
stays. The range key is the text's first 32 characters with its 64-bit hash, so the sample that Spark takes to the driver holds no
whole text; within a range the order is that of the whole text. The window needs no further shuffle.

A text that holds more than 1/(4n) of all rows or bytes (n: shuffle partitions; so fewer than 8n texts) is dealt into pieces by a
hash of the identifier, each with at most about that share. A window group, which Spark buffers, is so never larger than a quarter of
a mean partition. The pieces of such a text are folded by one aggregate over their first rows; its result (fewer than 8n rows) is
broadcast.

Defined results: a null text counts as empty, and empty texts equal each other. A null identifier stays only if its group has no
other one. Of repeated rows with the identifier that stays, exactly one is kept. Rows are counted, repeated ones too. An empty
table gives an empty result. Further columns of any name are ignored by ``groups`` and kept by ``drop_copies``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revflow.llm.graph import staged

#: Characters of a text in the range key.
HEAD = 32


def _found(docs: DataFrame, text: str, ident: str, largest: bool, normalise: Callable[[Column], Column] | None, carry: bool) -> DataFrame:
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    norm = F.coalesce(F.col(text), F.lit(""))
    norm = F.coalesce(normalise(norm), F.lit("")) if normalise else norm
    src = docs.select(F.col(ident).alias("doc_id"), norm.alias("norm"), *([F.struct(*docs.columns).alias("row")] if carry else []))
    src = src.withColumn("h", F.xxhash64("norm"))
    sizes = src.groupBy("h").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("norm") + 1).alias("bytes"))
    share = F.greatest(*(F.col(c) / sizes.agg(F.sum(c)).scalar() for c in ("rows", "bytes"))) * (4 * n)
    hot = sizes.select("h", F.ceil(share).alias("pieces")).filter("pieces > 1")  # fewer than 8n texts can pass
    dealt = src.join(F.broadcast(hot), "h", "left").select(
        "*", F.substring("norm", 1, HEAD).alias("head"), F.col("pieces").isNotNull().alias("hot"),
        F.when(F.col("pieces").isNotNull(), F.pmod(F.xxhash64("doc_id"), F.col("pieces"))).otherwise(0).alias("piece"))
    equal = Window.partitionBy("head", "h", "piece", "norm")
    best = F.max("doc_id") if largest else F.min("doc_id")
    order = F.desc_nulls_last("doc_id") if largest else F.asc_nulls_last("doc_id")
    found = dealt.repartitionByRange(n, "head", "h", "piece").select(
        "doc_id", "h", "hot", F.sha2("norm", 256).alias("text_sha256"), "norm", *(["row"] if carry else []),
        F.row_number().over(equal.orderBy(order)).alias("nth"), best.over(equal).alias("piece_keep"),
        F.count(F.lit(1)).over(equal).alias("piece_size"))
    # the text itself goes on only with the first row of a piece
    found = staged(found.withColumn("norm", F.when(F.col("hot") & (F.col("nth") == 1), F.col("norm"))), "exact-dedup")
    fold = found.filter("hot and nth = 1").groupBy("norm", "h", "text_sha256").agg(
        (F.max if largest else F.min)("piece_keep").alias("all_keep"), F.sum("piece_size").alias("all_size"))
    fold = fold.select("h", "text_sha256", "all_keep", "all_size", F.lit(True).alias("folded"))
    return found.join(F.broadcast(fold), ["h", "text_sha256"], "left").select(
        "doc_id", F.when(F.col("folded"), F.col("all_keep")).otherwise(F.col("piece_keep")).alias("keep_id"),
        F.coalesce("all_size", "piece_size").alias("group_size"),
        ((F.col("nth") == 1) & (F.col("folded").isNull() | F.col("piece_keep").eqNullSafe(F.col("all_keep")))).alias("kept"),
        "text_sha256", *(["row"] if carry else []))


def groups(docs: DataFrame, text: str = "text", ident: str = "doc_id", keep: str = "smallest",
           normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row; ``keep`` is ``smallest`` or ``largest`` identifier."""
    return _found(docs, text, ident, _largest(keep), normalise, carry=False)


def drop_copies(docs: DataFrame, text: str = "text", ident: str = "doc_id", keep: str = "smallest",
                normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    kept = _found(docs, text, ident, _largest(keep), normalise, carry=True).filter("kept")
    return kept.select("row.*")


def _largest(keep: str) -> bool:
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is smallest or largest, not {keep!r}")
    return keep == "largest"
