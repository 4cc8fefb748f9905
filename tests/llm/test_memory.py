"""What a task and a table of the pipeline take: matrices of a group, slices of batches, files."""

import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from phenocast.llm import components, langid, line_dedup
from phenocast.llm._common import few, released, slices


def test_a_group_has_one_matrix():
    rng = np.random.default_rng(1)
    got = []
    for k in range(600):                # one family: its rows are all rows
        at = np.sort(rng.choice(langid._DIM, 40, replace=False)).astype(np.uint16)
        got.append(("en" if k % 2 else "de", at, rng.random(40).astype(np.float32)))
    total: dict = {}
    tracemalloc.start()
    langid._group_machines(got, total)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert set(total) == {("germanic", "de", "en")}
    assert most < 1.5 * len(got) * langid._DIM * 4


def test_machines_are_added_in_parts():
    rng = np.random.default_rng(2)
    one, two = ({("f", "a", "b"): (n, rng.integers(-9, 9, 1300)), (None, "f", "g"): (n, rng.integers(-9, 9, 1300))} for n in (3, 4))
    got: dict = {}
    for batch in langid._added([*langid._sums(one), *langid._sums(two)]):
        for r in batch.to_pylist():
            assert r["n"] == 7
            got.setdefault((r["family"], r["a"], r["b"]), {})[r["part"]] = r["w"]
    for k in one:
        w = np.frombuffer(b"".join(got[k][p] for p in sorted(got[k])), np.int64)
        assert (w == one[k][1] + two[k][1]).all()


def test_languages_are_learned_without_an_rdd(spark, monkeypatch):
    def no_rdd(self):
        raise AssertionError("workers of a second kind")

    df = spark.createDataFrame([(i, ("aaa bbb", "ccc ddd")[i % 2], ("en", "de")[i % 2]) for i in range(40)], "doc_id long, text string, lang string")
    monkeypatch.setattr(type(df), "rdd", property(no_rdd))
    model = langid.fit_languages(df, F.lit(True), piece=10)
    assert df.join(langid.identify(df, model), "doc_id").where("lang != lang_pred").count() == 0


def test_slices_and_released():
    texts = ["a" * 10, None, "b" * 25, "", "c", "d" * 3]
    batch = pa.RecordBatch.from_pydict({"i": list(range(6)), "t": pa.array(texts, pa.string())})
    cut = list(slices(batch, 1, 10))
    assert len(cut) > 1 and pa.Table.from_batches(cut).to_pylist() == batch.to_pylist()
    assert list(slices(batch.slice(0, 0), 1)) == []
    assert list(released(lambda xs: (x + 1 for x in xs))([1, 2])) == [2, 3]


def _parts(spark, tmp_path, monkeypatch, make) -> dict:
    """Part files by table that ``make`` writes with 64 shuffle partitions that are not merged."""
    from phenocast.llm import _common

    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    monkeypatch.setattr(_common, "ensure_checkpoint_dir", lambda s: str(tmp_path))
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        make()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return {p.name: len(list(p.glob("part-*"))) for p in Path(tmp_path).iterdir()}


def test_tables_of_few_rows_are_few_files(spark, tmp_path, monkeypatch):
    line = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(i, f"{line}\nown line {i} of a document\n{line} {i % 9}\n") for i in range(300)], "doc_id long, text string")
    found = {}
    parts = _parts(spark, tmp_path, monkeypatch,
                   lambda: found.update({r["doc_id"]: r["n_deleted"] for r in line_dedup.dedup_lines(docs, n_chars_col=None, report=True).collect()}))
    assert found == {i: (i > 0) + (i >= 9) for i in range(300)}
    assert sum(parts.values()) <= 64 + 2 * len(parts)    # the first table's rows aren't known before


def test_component_tables_are_few_files(spark, tmp_path, monkeypatch):
    links = spark.range(2000).selectExpr("id a", "id + 1 b")
    found = []
    parts = _parts(spark, tmp_path, monkeypatch, lambda: found.extend(
        components.connected_components(links).select("root").distinct().collect()))
    assert [r["root"] for r in found] == [0]
    assert sum(n for name, n in parts.items() if not name.startswith("cc-links")) <= 2 * len(parts)


def test_few_keeps_all_rows(spark):
    df = spark.range(100).repartition(20)
    assert few(df, 100).count() == 100 and few(df, 100).rdd.getNumPartitions() == 1
    assert few(df, 100, 4).rdd.getNumPartitions() == 20 and few(df, 0).count() == 100
