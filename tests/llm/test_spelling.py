"""Spelling variants against brute force; trie nodes against prefixes."""

import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from phenocast.llm import spelling


def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _brute(counts, ratio):
    out, forms = {}, {}
    for w, n in counts.items():
        near = [v for v in counts if _near(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= ratio * n else None
        out[w] = [forms[w], None, n, len(near), counts[forms[w]] if forms[w] else None]
    for w in counts:
        end = w
        while forms[end]:
            end = forms[end]
        out[w][1] = end
    return {w: tuple(v) for w, v in out.items()}


def _rows(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_variants_equal_brute_force(spark):
    rng = np.random.default_rng(13)
    words = {"".join(rng.choice(list("abcé"), rng.integers(1, 7))) for _ in range(700)}
    counts = {w: int(3 ** rng.integers(0, 9)) for w in sorted(words)}
    counts |= {"aaaa" * 2000: 500, "aaaa" * 2000 + "b": 4, "aaaa" * 2000 + "bc": 3, "x": 7}
    df = spark.createDataFrame(list(counts.items()), "word string, n int").repartition(5)
    got = _rows(spelling.group_variants(df, ratio=10))
    assert got == _brute(counts, 10)
    assert max(len(w) for w in got) == 8002 and any(v[1] != v[0] and v[0] for v in got.values())  # chains of two forms


def test_trie_nodes_are_prefixes(spark):
    rng = np.random.default_rng(5)
    words = sorted({"".join(rng.choice(list("ab"), rng.integers(1, 12))) for _ in range(600)} | {"abab" * 40 + "b" * k for k in range(30)})
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "id long, word string").repartition(6)
    for key, text in ((F.col("word"), lambda w: w), (F.reverse("word"), lambda w: w[::-1])):
        node, prefix = {}, {}
        for r in spelling.trie_nodes(df, key, "nodes").collect():
            w = text(words[r["id"]])
            assert len(r["nodes"]) == len(w) + 1 and r["fresh"] == [k == 0 or w[k] != w[k - 1] for k in range(len(w))]
            for d, number in enumerate(r["nodes"]):
                assert node.setdefault(w[:d], number) == number and prefix.setdefault(number, w[:d]) == w[:d]
    assert sum(n < 0 for n in prefix) > 3  # nodes that reach over a border of two ranges


def test_words_of_odd_rows(spark):
    def brute(docs, least, drop):
        n = Counter()
        for i, text in docs:
            for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
                low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
                h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
                if drop and h % drop == 0:
                    low = low[:h % len(low)] + low[h % len(low) + 1:]
                if len(low) >= least:
                    n[low] += 1
        return {w: k for w, k in n.items() if k >= 2}

    docs = [(1, "Réponse réponse ÉTAT état wordone wordtwo"), (1, "Réponse réponse ÉTAT état wordone wordtwo"), (None, "nothing nothing NOTHING"), (2, None),
            (3, ""), (4, " \n12 "), (5, "wordone " * 40_000 + "q" * 50_000), (6, "q" * 50_000 + " ÷×éééé ÷×éééé")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, run string, n long")  # clashing names
    for least, drop in ((7, None), (7, 31), (3, 2), (1, 3)):
        assert {r["word"]: r["n"] for r in spelling.count_words(df, least, drop_every=drop).collect()} == brute(docs, least, drop)
    got = _rows(spelling.group_variants(spelling.count_words(df, drop_every=31)))
    assert got == _brute(brute(docs, 7, 31), 10)
    none = df.limit(0)
    assert spelling.group_variants(spelling.count_words(none)).collect() == []
    assert spelling.group_variants(spelling.count_words(df.where("doc_id = 4"))).columns == ["word", "form", "root", "n", "n_near", "form_n"]
