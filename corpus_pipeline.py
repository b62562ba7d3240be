"""The corpus pipeline: language identification, near-duplicate removal, benchmark decontamination, redaction, tokenization.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir). ``run`` applies them to ``documents``, each stage written as
Parquet to the shared checkpoint folder and read again as the next one's input. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revflow.llm import bpe, decontam, langid, neardup, pii
from revflow.llm.common import table
from revflow.llm.graph import staged
from revflow.llm.queries import RANKS


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; the model learns from the labelled rows outside the fixed hold-out."""
    return langid.drop_unidentified(docs, langid.fit_on_documents(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, on five-word shingles at 0.8."""
    return neardup.drop_near_duplicates(docs, words=5)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by the kind's name."""
    return pii.redact(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, token_ids) of every document, checked against its decoding."""
    coded = bpe.round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return coded.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids",
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("byte_bpe", tokenize),
]

#: The stages learn, hash and merge in ways that SQL can't state; tests compare with a brute-force pipeline.
ORACLE_SQL = None


#: Whole documents that travel to or from a Python worker at once. Spark's own 10,000 rows are meant for short rows: a batch
#: of whole texts is held by the executor and its worker, several times over, outside the heap.
BATCH_ROWS = 1_000


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. The session's Arrow batches are set to at most BATCH_ROWS rows, also while the result is read."""
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(batch)) <= BATCH_ROWS:
        spark.conf.set(batch, BATCH_ROWS)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
