"""The registered queries on the test tables, and the corpus stage by stage."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from sectorlens.llm import mixing, pii, queries, spm
from tests.helpers import TINY
from tests.llm.fixtures import documents
from tests.llm.test_operators import plain_components, plain_fingerprint, plain_spans
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, name, queries.QUERIES[name], queries.SQL[name], TINY) is None


def test_contract_has_them():
    assert set(queries.QUERIES) <= set(contract.queries()) and set(queries.SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL) - {"pipeline", "op13_spelling"}))
def test_query_has_a_row_for_every_document(spark, name):
    n = spark.read.parquet(f"{TINY}/documents.parquet").count()
    assert queries.QUERIES[name](spark, TINY).count() == n


def test_native_plans_have_no_python(spark):
    for name in ("op1_mixing", "op6_sharding", "op8_fingerprints"):
        plan = queries.QUERIES[name](spark, TINY)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_corpus_stages_by_hand(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    columns = docs.columns

    kept = stages["language"](spark, docs, TINY).cache()
    assert kept.columns == columns
    before, after = {r["doc_id"]: r for r in docs.collect()}, {r["doc_id"]: r for r in kept.collect()}
    assert all(before[i] == r for i, r in after.items())
    assert all(not any(c.isalpha() for c in before[i]["text"]) for i in before.keys() - after.keys())

    single = stages["near_duplicates"](spark, kept, TINY).cache()
    rows = sorted(after.values(), key=lambda r: r["doc_id"])
    roots = plain_components([plain_fingerprint(r["text"]) for r in rows])
    want = {}
    for r, root in zip(rows, roots):
        want.setdefault(root, r["doc_id"])
    assert single.columns == columns and sorted(r["doc_id"] for r in single.collect()) == sorted(want.values())

    masked = stages["personal_data"](spark, single, TINY).cache()
    assert masked.columns == columns and masked.count() == single.count()
    for r in masked.collect():
        assert not plain_spans(r["text"])
        if not plain_spans(after[r["doc_id"]]["text"]):
            assert r["text"] == after[r["doc_id"]]["text"]

    mixed = stages["mixing"](spark, masked, TINY).cache()
    plan = {r["doc_id"]: r for r in mixing.mix_plan(masked).collect()}
    times = Counter(r["doc_id"] for r in mixed.collect())
    assert mixed.columns == columns and set(times) <= set(plan)
    assert all(abs(times[i] - r["taken"] / r["size"]) <= 0.5 + 1e-9 for i, r in plan.items() if r["size"])

    last = stages["sentencepiece"](spark, mixed, TINY)
    model = spm.pieces(queries.tokenizer_path("piece_bpe_32k.model"))
    assert last.count() == mixed.count()
    for r in last.collect():
        assert r["piece_ids"] == model.sp.encode(r["text"]) and r["n_pieces"] == len(r["piece_ids"])


def test_span_text_matches_the_contract(spark):
    df = spark.createDataFrame([([("ip", 3, 9), ("card", 12, 30)],)], f"base {pii.SPAN}")
    assert df.select(queries._spans_text(F.col("base")).alias("t")).first()["t"] == "ip:3:9,card:12:30"


def test_last_stage_replaces_its_own_columns(spark):
    docs = documents(spark, clashing=True).selectExpr("*", "1 AS n_pieces", "'x' AS piece_ids")
    got = corpus_pipeline.encoded(spark, docs, TINY)
    assert got.columns == [*docs.columns[:-2], "piece_ids", "n_pieces"]
    assert all(len(r["piece_ids"]) == r["n_pieces"] for r in got.collect())
