"""The pipeline against a brute-force one, and the registration of the queries."""

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from revflow.llm import bpe, pii
from revflow.llm.queries import RANKS
from test_operators import SF, brute_contaminated, components_of


def test_every_operator_is_registered():
    names = set(E.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names


@pytest.fixture(scope="module")
def small(spark):
    """Documents of one language and odd rows, with the columns of the real table."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(9001, None, "en", "s", 0), (9002, "12 34", "en", "s", 5), (9003, "", None, None, None), (9004, "write to a@b.org please", "en", "s", 23)]
    return docs.unionByName(spark.createDataFrame(odd, docs.schema))


def test_stages_keep_columns_and_match_brute_force(spark, small):
    docs = small
    texts = {r.doc_id: r.text for r in docs.collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    from revflow.llm.graph import staged

    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, SF), name)
        assert docs.columns == small.columns, name
    left = {i: t for i, t in texts.items() if i not in (9001, 9002, 9003)}
    comp = components_of(left.items(), 5)
    left = {i: t for i, t in left.items() if comp[i] == i}
    bad = {d for d, _ in brute_contaminated(left.items(), items)}
    left = {i: pii.redacted(t) for i, t in left.items() if i not in bad}
    rows = {r.doc_id: r for r in docs.collect()}
    assert {i: r.text for i, r in rows.items()} == left
    assert all(r.n_chars == len(r.text) for i, r in rows.items())
    codec = bpe.Codec(bpe.read_ranks(P.path(RANKS)), P.PATTERN)
    coded = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id: list(r.token_ids) for r in coded} == {i: codec.encode(t) for i, t in left.items()}


def test_empty_documents(spark, small):
    docs = small.filter("false")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0, name
        docs = docs if name != "byte_bpe" else docs.select(F.lit(1))
