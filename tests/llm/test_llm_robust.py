"""Columns with clashing names, repeated ids, large dialogues, and the pipeline on odd tables."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from phenocast.llm import chat, knn, line_dedup, simhash
from phenocast.llm._common import written

HELPERS = ["__id", "__th", "__h", "__d", "__gone", "__lines", "__text", "__keep", "id", "th", "d", "h", "n_lines", "first", "fp"]


def test_no_column_of_the_user_is_lost_or_changed(spark):
    lines = "one two three four five six\nseven eight nine ten eleven"
    docs = spark.createDataFrame([(1, lines), (2, lines), (3, "something else here"), (None, "no id")], "doc_id long, text string")
    docs = docs.withColumns({c: F.concat(F.lit(f"{c}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("x"))) for c in HELPERS})
    want = {r["text"] if r["doc_id"] is None else r["doc_id"]: {c: r[c] for c in HELPERS} for r in docs.collect()}
    out = line_dedup.dedup_lines(docs)
    got = {r["text"] if r["doc_id"] is None else r["doc_id"]: r for r in out.collect()}
    assert out.columns == docs.columns and got.keys() == want.keys() and (got[1]["text"], got[2]["text"]) == (lines, "")
    assert all({c: got[k][c] for c in HELPERS} == want[k] for k in want)
    out = simhash.near_dedup(docs)
    got = {r["text"] if r["doc_id"] is None else r["doc_id"]: r for r in out.collect()}
    assert out.columns == docs.columns and set(got) == {1, 3, "no id"} and all({c: got[k][c] for c in HELPERS} == want[k] for k in got)
    report = line_dedup.dedup_lines(docs, report=True)
    assert report.columns == [*[c for c in docs.columns if c != "n_lines"], "n_lines", "n_deleted"]


def test_a_repeated_query_id_is_answered_once(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.standard_normal(4).round(3).tolist()) for i in range(1, 200)] + [(0, [3.0, 1.0, 0.0, 0.0]), (0, [-3.0, 1.0, 0.0, 0.0]), (0, [-3.0, 1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in knn.top_k(df, F.col("vec_id") == 0, k=5, n_pivots=6).orderBy("rank").collect()]
    q = np.floor(64 * np.array([-3.0, 1.0, 0.0, 0.0]))
    score = sorted(((-int(q @ np.floor(64 * np.array(v))), i) for i, v in rows if i), key=lambda x: x)[:5]
    assert got == [(0, k + 1, i, -s) for k, (s, i) in enumerate(score)]


def test_rotation_sql_knows_pieces(spark, scratch):
    rows = [(1, 5, ("user", "assistant")[i % 2], f"turn {i}") for i in range(9000)] + [(1, 600, "user", "later"), (None, None, None, None), (2, 0, "system", "s"), (2, 1, "user", "hi")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.coalesce(1).write.parquet(f"{scratch}/conversations.parquet")
    out = chat.op6_chat_rotation(spark, scratch)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{scratch}/conversations.parquet/*.parquet'")
    cols = sorted(out.columns)
    got = sorted((tuple(r[c] for c in cols) for r in out.collect()), key=str)
    assert got == sorted(con.execute(f"SELECT {', '.join(cols)} FROM ({chat.OP6_SQL})").fetchall(), key=str)
    assert {r["piece"] for r in out.collect()} == {0, 1, 2}


def _odd_documents():
    rng = np.random.default_rng(9)
    parts = {"en": ["th", "ing", "er", "wh", "ight", "sh"], "de": ["sch", "ung", "ei", "ch", "lich", "ver"]}
    word = lambda lang: "".join(rng.choice(parts[lang], rng.integers(2, 4)))
    docs = [(i, "\n".join(" ".join(word(lang) for _ in range(12)) for _ in range(6)), lang) for i in range(60) for lang in [("en", "de")[i % 2]]]
    odd = [(None, docs[0][1] + "\nown line of a document without an id", "en"), (None, "\n".join(" ".join(word("de") for _ in range(12)) for _ in range(5)), "de"),
           (70, None, "en"), (71, "", None), (72, " \n\t", "de"), (73, "1234 5678 !!", None), (1, docs[1][1], "de"), (1, docs[2][1], "en"),
           (74, " ".join(word("en") for _ in range(30_000)), "en"), (75, docs[3][1], "de"), (76, docs[3][1], "de")]
    return [(i, t, lang, "s", len(t) if t else None, "extra", 1) for i, t, lang in docs + odd]


@pytest.mark.parametrize("case", ["odd", "empty"])
def test_pipeline_on_odd_tables(spark, scratch, case):
    import corpus_pipeline

    # extra columns, with names that stages use inside
    schema = "doc_id long, text string, lang string, source string, n_chars long, tokens string, component_id int"
    docs = spark.createDataFrame(_odd_documents() if case == "odd" else [], schema)
    bench = [(1, " ".join(_odd_documents()[5][1].split()[:14])), (2, None), (3, "")] if case == "odd" else []
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    docs.write.parquet(f"{scratch}/documents.parquet")
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    columns, n = docs.columns, docs.count()
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, scratch), name)
        seen.append(docs.count())
        assert docs.columns == columns and docs.where("tokens <> 'extra' OR component_id <> 1").count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, scratch)
    if case == "empty":
        assert seen == [0, 0, 0, 0] and pieces.count() == 0
        return
    assert n >= seen[0] >= seen[1] >= seen[2] >= seen[3] > 50
    left = docs.collect()
    ids = [r["doc_id"] for r in left]
    assert not {70, 71, 72, 73, 75, 76} & set(ids)          # no text, no letter, whole copies
    assert None in ids and {0, 4, 6, 74} <= set(ids)        # clean documents stay, with and without an id
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == set(ids)
