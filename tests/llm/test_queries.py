"""The registered queries over the given tables, and the pipeline against its stages."""
from __future__ import annotations

import pytest
from oracle_compare import compare, duck_connection

import __spark_entry__ as E
import corpus_pipeline as P
from closequarters.llm import queries as llm

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered_once():
    names = [q.split("_")[0] for q in llm.queries()]
    assert names == [f"op{n}" for n in range(1, 14)]
    assert set(llm.queries()) | {"pipeline"} <= set(E.queries())
    assert set(llm.oracle_sql()) <= set(llm.queries())


@pytest.mark.parametrize("key", sorted(llm.ORACLES))
def test_query_matches_oracle(spark, key):
    problems, n = compare(E.queries()[key](spark, SF), duck_connection(SF), E.oracle_sql()[key])
    assert not problems and n > 0, problems


def test_pipeline_stages_decide_as_their_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    sizes = [docs.count()]
    for name, stage in P.STAGES:
        docs = P.cut(stage(spark, docs, SF), f"test-{name}")
        sizes.append(docs.count())
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns
    assert sizes[0] > sizes[1] >= sizes[2] == sizes[3] >= sizes[4] > 0
    out = P.run(spark, SF)
    key = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    assert sorted(tuple(r[c] for c in key) for r in out.collect()) == sorted(tuple(r[c] for c in key) for r in docs.collect())


def test_pipeline_stages_take_odd_rows(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    rows = [(None, "a text without id", "en", "src1", 17), (1, None, None, None, None), (1, None, None, None, None),
            (2, "", "en", "src2", 0), (3, "word " * 30_000, "en", "src3", 150_000), (4, "plain words here", "en", "src4", 16)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in P.STAGES:
        assert stage(spark, docs, SF).count() <= 100
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_pipeline_stages_take_clashing_names(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clash = ["_id", "_gone", "_kept_id", "predicted", "score", "rest", "site", "_label", "kept", "component_id", "_class", "line.no"]
    plain = docs
    for c in clash:
        docs = docs.withColumn(c, docs["doc_id"] * 2)
    for name, stage in P.STAGES:
        plain, docs = (P.cut(stage(spark, d, SF), f"test-clash-{name}") for d in (plain, docs))
        if name != P.STAGES[-1][0]:
            assert docs.columns == [*plain.columns, *clash]
            assert docs.filter("`line.no` <> 2 * doc_id or _gone <> 2 * doc_id").count() == 0
        assert sorted(r["doc_id"] for r in docs.collect()) == sorted(r["doc_id"] for r in plain.collect())
