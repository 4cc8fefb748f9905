"""Jump consistent hashing, and dense numbers along an order."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from phenocast.llm import sharding
from phenocast.llm.numbering import numbered


def _jump_brute(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def _hash(i):
    return int(hashlib.md5(("|".join(([] if i is None else [str(i)]) + ["0"])).encode()).hexdigest()[:15], 16)


def test_jump_equals_the_scalar_form_and_moves_only_into_the_new_shard():
    keys = np.random.default_rng(1).integers(0, 1 << 60, 4000)
    before = None
    for n in (1, 2, 3, 24, 25, 1000):
        got = sharding.jump(keys, n)
        assert got.tolist() == [_jump_brute(int(k), n) for k in keys]
        assert np.bincount(got, minlength=n).max() < 4000 / n * 1.5 + 20
    for n in range(1, 40):
        now = sharding.jump(keys, n)
        if before is not None:
            moved = now != before
            assert (now[moved] == n - 1).all() and abs(moved.mean() - 1 / n) < 0.04
        before = now


def test_places_on_odd_rows(spark):
    rows = [(i, f"text {i}", "x", i) for i in range(300)] + [(7, None, "a", 1), (8, "", "b", 2), (None, "no id ü", None, None), (None, None, "c", 0)]
    rows += [(5, "hot", "h", 9)] * 200 + [(9, "w " * 100_000, "long", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, at string, slot long").repartition(7)  # slot, at: clashing names
    got = sharding.place(docs, 24).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"doc_id", "text", "at", "size", "text_crc32", "shard", "grown_shard", "slot"}
    slots, order = defaultdict(list), defaultdict(list)
    for r in got:
        text = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 8, zlib.crc32(text))
        assert (r["shard"], r["grown_shard"]) == (_jump_brute(_hash(r["doc_id"]), 24), _jump_brute(_hash(r["doc_id"]), 25))
        slots[r["shard"]].append(r["slot"])
        order[r["shard"]].append((r["slot"], (r["doc_id"] is not None, r["doc_id"] or 0, r["text_crc32"], r["size"])))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all([k for _, k in sorted(o)] == sorted(k for _, k in o) for o in order.values())
    none = docs.limit(0)
    assert sharding.place(none, 24).count() == 0 and sharding.moves(none, 2, 3, ["doc_id"]).count() == 0


def test_moves_and_written_shards(spark, scratch):
    docs = spark.createDataFrame([(f"k{i % 90}", i) for i in range(270)], "key string, n long")
    got = sharding.moves(docs, 24, 26, ["key"])
    want = {f"k{i}": (_jump_brute(h, 24), _jump_brute(h, 26)) for i in range(90)
            for h in [int(hashlib.md5(f"k{i}|0".encode()).hexdigest()[:15], 16)]}
    assert Counter((r["key"], r["shard_from"], r["shard_to"]) for r in got.collect()) == Counter({(k, *v): 3 for k, v in want.items() if v[0] != v[1]})
    assert got.where("shard_to < 24").count() == 0
    sharding.write_shards(docs, f"{scratch}/shards", 4, ["key"], files_per_shard=3)
    back = spark.read.parquet(f"{scratch}/shards")
    assert back.count() == 270 and all(r["shard"] == _jump_brute(int(hashlib.md5(f"{r['key']}|0".encode()).hexdigest()[:15], 16), 4) for r in back.collect())


def test_numbers_along_an_order(spark):
    rows = [(i % 11, None if i % 13 == 0 else i % 5, f"p{i}") for i in range(500)] + [(3, 3, "same")] * 300
    df = spark.createDataFrame(rows, "a int, n long, low string").repartition(5)
    got = sorted((r["place"], (r["n"] is not None, r["n"] or 0, r["a"])) for r in numbered(df, ["n", "a"], "place").collect())
    assert [p for p, _ in got] == list(range(800)) and [k for _, k in got] == sorted(k for _, k in got)
    inside = defaultdict(list)
    for r in numbered(df, ["low"], "place", within="n").collect():
        inside[r["n"]].append((r["place"], r["low"]))
    assert all([p for p, _ in sorted(v)] == list(range(len(v))) and [x for _, x in sorted(v)] == sorted(x for _, x in v) for v in inside.values())
    assert numbered(df.limit(0), ["n"], "place").count() == 0 and numbered(df.limit(0), ["n"], "place", within="a").columns == [*df.columns, "place"]
