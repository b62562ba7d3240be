"""The registered queries: each operator on its whole intended table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revflow.llm import ann, bpe, chat, chunks, decontam, exact, langid, mend, neardup, pii, resample, toxicity, unigram
from revflow.llm.common import held_out, table

RANKS = "byte_bpe_multi_50k.tiktoken"
VOCABULARY = "piece_bpe_32k.model"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.fit_on_documents(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op3_multiprobe_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ann.neighbours(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)
    return found.select("query_id", "rank", "vec_id", "score")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.repeated_spans(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = unigram.sentencepiece_vocabulary(public_tokenizers.path(VOCABULARY))
    return unigram.token_counts(table(spark, sf_dir, "documents"), vocabulary)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find_pii(table(spark, sf_dir, "documents")))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.digests(bpe.round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN))


def op11_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample.draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=25, least_words=20, seed=7, n=2)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.groups(table(spark, sf_dir, "documents"), keep="largest")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    hurt = mend.damaged(turns)
    return mend.digests(mend.repair(hurt), hurt, turns)


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_chat_format, op3_multiprobe_lsh, op4_substring_dedup, op5_token_counts, op6_pii, op7_decontamination,
    op8_near_duplicates, op9_toxicity, op10_byte_bpe, op11_importance_resample, op12_exact_dedup, op13_conversation_repair)}

#: The others learn models or hash by code; tests compare them with brute force.
ORACLES: dict[str, str] = {
    "op8_near_duplicates": r"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x20\x09-\x0D]+') AS ws FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 2 THEN ws
                ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS shingle FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
        link AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)),
        reach AS (SELECT doc_id, doc_id AS r FROM w UNION SELECT doc_id, b FROM reach JOIN link ON a = r)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
        FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)""",
    "op12_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
}
