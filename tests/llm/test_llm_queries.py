"""Registered queries against their SQL, and the pipeline's stages, at the smallest size."""

import os

import pytest

from phenocast.llm.catalog import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)
    assert got == sorted(con.sql(f"SELECT {', '.join(cols)} FROM ({ORACLE_SQL[name]})").fetchall(), key=str) and got


def test_pipeline_stages(spark):
    import corpus_pipeline
    from phenocast.llm._common import table, written

    docs = table(spark, SF, "documents")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), name)
        assert docs.columns == columns and 0.5 * n < docs.count() <= n
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_language_of_held_out_documents(spark):
    """Accuracy on documents that the model has not seen, where their language is known and they have letters."""
    from phenocast.llm._common import table

    sf = SF.replace("0.001", "0.01")
    if not os.path.isdir(sf):
        pytest.skip("test tables are not here")
    known = table(spark, sf, "documents").where("lang IS NOT NULL AND text RLIKE '[A-Za-z]{2}'").select("doc_id", "lang")
    rows = QUERIES["op8_language_id"](spark, sf).where("held_out").join(known, "doc_id").collect()
    right = [r["lang"] == r["lang_pred"] for r in rows]
    assert len(right) > 100 and sum(right) / len(right) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)
