"""Each operator against a brute-force version, and on odd tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from phenocast.llm import chat, decontaminate, knn, langid, line_dedup, ngram_lm, packing, pii, simhash, warc
from phenocast.llm.components import connected_components

ODD = [(1, "One two three four five six seven eight nine ten eleven.", "en", 1), (1, "One two three four five six seven eight nine ten eleven.", "en", 1),
       (2, None, "en", 2), (3, "", None, 3), (4, "   \n\t", "de", 4), (None, "text without an id 1.2.3.4", "de", 5), (6, "1234 +-*/ !!", None, None),
       (7, "wort " * 30_000, "de", 7), (8, "Ünïcode ñandú façade", "es", 8), (9, "a@b.co +1 (644) 555-7859", "fr", 9)]
SCHEMA = "doc_id long, text string, lang string, fp long"  # fp: a clashing name


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def tokenizer_path():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


# --- operator 1 ----------------------------------------------------------------------------

def _knn_brute(rows, k):
    v = {i: np.floor(64 * np.array(e, dtype=float)) for i, e in rows}
    return {(q, r + 1, c, int(s)) for q in v if q % 20 == 0
            for r, (s, c) in enumerate(sorted(((float(v[q] @ v[c]), c) for c in v if c != q), key=lambda x: (-x[0], x[1]))[:k])}


def test_knn_matches_brute_force_with_ties_and_hot_vector(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((6, 8)) * 3
    rows = [(i, (centres[i % 6] + rng.standard_normal(8) * 0.1).tolist()) for i in range(300)] + [(300 + i, [1.0] * 8) for i in range(150)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {tuple(r) for r in knn.top_k(df, F.col("vec_id") % 20 == 0, k=7, n_pivots=9, slice_rows=64).collect()}
    assert got == _knn_brute(rows, 7)


def test_knn_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (5, [0.5, 0.5]), (None, [1.0, 1.0]), (6, [2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cell", F.lit("x"))
    got = {tuple(r) for r in knn.top_k(df, F.col("vec_id") % 20 == 0).collect()}
    assert got == {(0, 1, 6, 64 * 128), (0, 2, 5, 64 * 32 + 128 * 32)}
    assert knn.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_knn_bound_leaves_vectors_out_where_data_are_clustered():
    pivots = np.array([[10.0, 0], [0, 10.0]])
    summary = {0: {"n": 50, "r": 1.0, "qr": 1.0, "qn": 2}, 1: {"n": 50, "r": 1.0, "qr": 1.0, "qn": 2}}
    theta = knn._summary_bounds(pivots, summary, [0], 20)[0]
    assert 0 + 10 + 1 < theta  # p.x of the other cell and what a query may add


# --- operator 2 ----------------------------------------------------------------------------

def test_warc_round_trip_and_revisits(spark):
    pages = [(1, "http://a/ b", "same"), (5, "http://b", "same"), (3, None, None), (4, "", ""), (9, "u\n", "é" * 70_000), (None, "x", "same"), (7, "c", "alone")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    got = {r["page_id"]: r for r in warc.read(warc.write(df, archive_bytes=400), with_payload=True).collect()}
    assert len(got) == len(pages)
    for page, _, html in pages:
        data = (html or "").encode()
        r = got[page]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), warc.digest(data))
        if r["record_type"] == "response":
            assert bytes(r["payload"]) == data
    assert {k: v["refers_to"] for k, v in got.items()} == {1: 5, 5: None, 3: 4, 4: None, 9: None, None: 5, 7: None}
    assert warc.read(warc.write(df, least_bytes=5)).where("record_type = 'revisit'").count() == 0
    assert warc.read(warc.write(df.limit(0))).count() == 0


@pytest.mark.parametrize("piece", [1, 7, 1000])
def test_warc_reader_takes_any_cut(piece):
    data = b"".join(warc.record(i, "u", b"x" * i * 50) for i in range(20))
    got = [warc.parse(*r) for r in warc.read_records(data[i:i + piece] for i in range(0, len(data), piece))]
    assert [len(g[5]) for g in got] == [i * 50 for i in range(20)]


def test_warc_reader_rejects_damage(spark, tmp_path):
    import gzip

    good = gzip.decompress(warc.record(1, "u", b"payload"))
    for bad in (good.replace(b"payload", b"paxload"), good[:-2], good + b"\r\n", good.replace(b"WARC/1.1", b"WARD/1.1")):
        with pytest.raises(ValueError):
            [warc.parse(*r) for r in warc.read_records([gzip.compress(bad)])]
    with pytest.raises(ValueError):
        list(warc.read_records([warc.record(1, "u", b"payload")[:-3]]))
    (tmp_path / "x.warc.gz").write_bytes(warc.record(3, "u", b"abc"))
    assert [r["page_id"] for r in warc.read_files(spark, str(tmp_path)).collect()] == [3]


# --- operator 3 ----------------------------------------------------------------------------

def _check_pieces(pieces, texts, tokenizer, window):
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_seq.setdefault(p["sequence_id"], []).append(p)
    for i, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p["start"]):
            raw = np.array(ids[at:at + p["length"]], dtype="<u4").tobytes()
            assert (p["start"], p["doc_tokens"], p["ids_crc32"]) == (at, len(ids), zlib.crc32(raw))
            at += p["length"]
        assert at == len(ids)
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= window and (at == window or at & (at - 1) == 0)


def test_packing_covers_every_id_once(spark, odd, none, tokenizer_path):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path)
    texts = {i: t for i, t, _, _ in ODD if i != 1} | {10 + i: f"alpha beta gamma word{i % 5} " * (i % 17) for i in range(80)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for size in (2_000_000, 300):
        _check_pieces(packing.pack(df, tokenizer_path, window=64, shard_tokens=size).collect(), texts, tok, 64)
    assert packing.pack(odd, tokenizer_path).where("doc_id = 1 and start = 0").count() == 2  # repeated rows are packed as they are
    assert packing.pack(none, tokenizer_path).count() == 0


def test_packing_places_neighbours_behind_their_seed(spark, tokenizer_path):
    docs = [(0, "zebra quagga okapi " * 10), (1, "flour butter sugar " * 10), (2, "zebra okapi " * 15), (3, "butter flour " * 15)]
    rows = packing.pack(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), tokenizer_path, pivots=1, with_ids=True).collect()
    place = {r["doc_id"]: (r["sequence_id"] >> 32, r["sequence_id"], r["offset"]) for r in rows if r["start"] == 0}
    for a, b in ((0, 2), (1, 3)):       # a topic's documents share a rare token, so they lie in one shard, one behind the other
        between = sorted(k for k in place if place[a] <= place[k] <= place[b] or place[b] <= place[k] <= place[a])
        assert place[a][0] == place[b][0] and between == [a, b]
    assert all(len(r["ids"]) == 4 * r["length"] for r in rows)


def _bm25(docs, seed):
    n, mean, tfs = len(docs), sum(map(len, docs)) / len(docs), [Counter(d.tolist()) for d in docs]
    df = {t: sum(t in c for c in tfs) for t in tfs[seed]}
    return np.array([sum(np.log1p((n - df[t] + 0.5) / (df[t] + 0.5)) * c[t] * 2.2 / (c[t] + 1.2 * (0.25 + 0.75 * len(d) / mean)) for t in df if t in c)
                     for d, c in zip(docs, tfs)])


def test_neighbours_equal_brute_force_on_all_terms():
    rng = np.random.default_rng(4)
    docs = [rng.integers(0, 60, rng.integers(1, 200)).astype(np.uint16) for _ in range(40)]
    df = np.array([sum(t in d for d in docs) for t in range(70)], dtype=np.int64)
    index = packing.Bm25Shard(docs, df, len(docs), sum(map(len, docs)) / len(docs))
    unused = rng.random(40) < 0.7
    for seed in range(40):
        want = _bm25(docs, seed)
        got = list(index.neighbours(seed, unused))
        assert set(got) == {k for k in range(40) if unused[k] and want[k] > 0}
        assert all(want[a] >= want[b] - 1e-4 for a, b in zip(got, got[1:]))


def test_routing_brings_neighbours_of_all_partitions_together(spark, tokenizer_path):
    rng = np.random.default_rng(6)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    topics = [["".join(rng.choice(letters, 7)) for _ in range(12)] for _ in range(25)]
    texts = [" ".join(rng.choice(topics[i % 25], 40)) for i in range(200)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(8)
    rows = packing.pack(df, tokenizer_path, window=256, shard_tokens=2000).collect()
    shard = {r["doc_id"]: r["sequence_id"] >> 32 for r in rows}
    assert len(set(shard.values())) > 3
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path)
    docs = [np.array(tok.encode(t, add_special_tokens=False).ids) for t in texts]
    hits = [shard[s] == shard[k] for s in range(0, 200, 5) for k in [int(x) for x in np.argsort(-_bm25(docs, s)) if x != s][:5]]
    assert np.mean(hits) >= 0.9


def test_packed_words_match_the_tokenizer(tokenizer_path):
    import random

    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path)
    memo = packing.word_memo(tok, np.uint16)
    rng = random.Random(5)
    parts = [*"abcdeABC'.,!?-$%^&*()0123 \n\t<|>=é̸́ßÄñ—…ıİΣςσ中文の한\x85\xa0 ²½", "<|endoftext|>", "'s", "it's", "!'s", "ﬁ", "don't"]
    memo.most = 500                     # the memo turns over
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(3000)] + [None, "word " * 5000, ""]
    want = [tok.encode(s or "", add_special_tokens=False).ids for s in texts]
    for size in (1, 7, 3003):
        got = [b for lo in range(0, 3003, size) for b in packing.encode_texts(pa.array(texts[lo:lo + size], pa.string()), tok, memo, np.uint16)]
        assert [np.frombuffer(b, np.uint16).tolist() for b in got] == want


def test_words_met_before_are_not_tokenized_again(tokenizer_path, monkeypatch):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path)
    texts = ["zebra Zebra, x2 été x2! 'tis don't", "okapi x2... zebra", None, "straße été; a1b2 okapi?"]
    want = [tok.encode(s or "", add_special_tokens=False).ids for s in texts]
    ids = lambda memo, some: [np.frombuffer(b, np.uint16).tolist() for b in packing.encode_texts(pa.array(some, pa.string()), tok, memo, np.uint16)]
    memo, asked = packing.word_memo(tok, np.uint16), []
    letters = memo.letters
    memo.letters = lambda words: asked.extend(words.to_pylist()) or letters(words)
    assert ids(memo, texts) == want and ids(memo, texts[::-1]) == want[::-1]
    assert len(asked) == len(set(asked))                # words that are none of letters included
    memo.most = 4                                       # full: what was met longest ago goes, and comes again
    for k in (0, 1, 3, 0, 1, 3):
        assert ids(memo, [texts[k]]) == [want[k]]
    assert len(memo.words) < 15 and len(memo.hashes) == len(memo.owner) == len(memo.sizes) == len(memo.met) == len(memo.words)
    monkeypatch.setattr(packing, "_hashes", lambda words: np.zeros(len(words), dtype=np.uint64))
    memo = packing.word_memo(tok, np.uint16)            # all hashes equal: slow, not wrong
    assert ids(memo, texts) == want and ids(memo, texts) == want
    spec = tok.to_str()
    assert packing._tokenizer(spec, np.uint16)[1] is packing._tokenizer(spec, np.uint16)[1]     # kept for a worker's next task


def test_merges_of_many_words_match_the_tokenizer(tokenizer_path):
    import random

    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path)
    rng = random.Random(8)
    words = ["".join(rng.choice(some) for _ in range(rng.randint(1, 70))) for some in ("a", "ab", "etaoinshr", "éüßñaeo", "łşæœþ") for _ in range(300)]
    words = list(dict.fromkeys([*words, "the", "a", "Upper", "x1", ""]))
    memo = packing.word_memo(tok, np.uint16)
    assert not memo.merges.partial
    for partial in (False, True):                       # True: each word by the tokenizer
        memo.merges.partial = partial
        ids, sizes = memo.letters(pa.array(words, pa.large_string()))
        assert [w for w, n in zip(words, sizes) if n < 0] == ["x1", ""]
        got = iter(np.split(ids, np.cumsum(sizes[sizes > 0])[:-1]))
        assert all(next(got).tolist() == [t.id for t in tok.model.tokenize(
            w.encode().decode("latin-1").translate(memo.alphabet))] for w, n in zip(words, sizes) if n > 0)


# --- operator 4 ----------------------------------------------------------------------------

@pytest.mark.parametrize("n,u", [(0, 1), (1, 5), (1000, 10), (1000, 1 << 20), (70_000, 1 << 62), (3, 1 << 62)])
def test_elias_fano(n, u):
    rng = np.random.default_rng(1)
    v = np.sort(rng.integers(0, u, n, dtype=np.uint64))
    e = ngram_lm.EliasFano(ngram_lm.EliasFano.encode(v))
    assert (e.get(np.arange(n)) == v).all()
    q = np.concatenate([v, rng.integers(0, u, 500, dtype=np.uint64), np.array([0, u - 1, u + 3], np.uint64)])
    assert (e.successor(q) == np.searchsorted(v, q)).all()


def _lm_brute(rows, mu):
    toks = [(i, utf.lower().split() + [b" "]) for i, t in rows for utf in [(t or "").encode()]]
    learned = [ws for i, ws in toks if i is not None and zlib.crc32(str(i).encode()) % 5 != 1]
    c, pairs = Counter(w for ws in learned for w in ws), Counter(p for ws in learned for p in zip([b"  ", *ws[:-1]], ws))
    ctx = c | Counter({b"  ": len(learned)})
    unit = sum(c.values()) + 0.5 * (len(c) + 1)
    for i, ws in toks:
        p1 = [(c[w] + 0.5) / unit for w in ws]
        yield (i, len(ws), sum(c[w] > 0 for w in ws), sum(c.values()), sum(map(math.log10, p1)),
               sum(math.log10((pairs[v, w] + mu * p) / (ctx[v] + mu)) for v, w, p in zip([b"  ", *ws[:-1]], ws, p1)))


@pytest.mark.parametrize("block", [50, 2_000_000])
def test_lm_scores_match_brute_force(spark, tmp_path, block):
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(rng.choice(["the", "The", "a", "fox", "dog", "ñandú", f"w{i % 7}"], size=int(rng.integers(0, 60))))) for i in range(60)]
    rows += [(None, "the fox"), (100, None), (101, ""), (102, "the\x0bfox\tthe"), (102, "the\x0bfox\tthe")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit(0))
    got = ngram_lm.score_texts(df, mu=3.0, block_tokens=block, model_to=str(tmp_path / "trie")).collect()
    want = sorted(_lm_brute(rows, 3.0), key=str)
    for g, w in zip(sorted(got, key=lambda r: str((r[0], r[2], r[3], r[4], r[5]))), want):
        assert (g["doc_id"], g["n_tokens"], g["n_known"], g["train_tokens"]) == w[:4]
        assert g["base_score"] == pytest.approx(w[4], abs=1e-9) and g["score"] == pytest.approx(w[5], abs=2e-4 * w[1])
        assert g["held_out"] == (w[0] is not None and zlib.crc32(str(w[0]).encode()) % 5 == 1)
    assert len(got) == len(want)
    assert set(spark.read.parquet(str(tmp_path / "trie")).columns) == {"shard", *ngram_lm.TrieShard.FIELDS}


def test_lm_odd_tables(odd, none):
    assert ngram_lm.score_texts(odd).count() == len(ODD)
    assert ngram_lm.score_texts(none).count() == 0


# --- operator 5 ----------------------------------------------------------------------------

def _fingerprint(text):
    ws = (text or "").encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(ws[i:i + 3]), 42) for i in range(max(1, len(ws) - 2))] if ws else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _components(values, near):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    vs = sorted(values)
    for i, a in enumerate(vs):
        for b in vs[i + 1:]:
            if near(a, b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in vs}


def test_simhash_matches_brute_force(spark, odd, none):
    got = simhash.simhash_components(odd).collect()
    fps = {i: _fingerprint(t) for i, t, _, _ in ODD}
    ids = {}
    for i, f in fps.items():
        ids.setdefault(f, []).append(i)
    root = _components(set(ids), lambda a, b: (a ^ b).bit_count() <= 2)
    for r in got:
        mates = [i for f, g in ids.items() if root[f] == root[fps[r["doc_id"]]] for i in g if i is not None]
        assert (r["fingerprint"], r["component_id"]) == (f"{fps[r['doc_id']]:016x}", min(mates) if mates else None)
    assert len(got) == len(ODD) and simhash.simhash_components(none).count() == 0
    kept = simhash.near_dedup(odd).collect()
    assert sorted((r["doc_id"] or 0) for r in kept) == [0, 1, 2, 6, 7, 8, 9] and set(kept[0].asDict()) == set(odd.columns)


def test_near_dedup_keeps_texts_under_null_and_repeated_ids(spark):
    def text(k):
        return " ".join(f"w{k}x{j}" for j in range(40))

    rows = [(None, text(k)) for k in (0, 1, 2, 2, 3)] + [(5, text(4)), (5, text(5)), (5, text(5)), (6, text(6)), (None, text(6)), (7, text(4))]
    got = simhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.columns == ["doc_id", "text"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(None, text(k)) for k in range(4)] + [(5, text(4)), (5, text(5)), (6, text(6))], key=str)


@pytest.mark.parametrize("bucket_rows", [4096, 8])
def test_near_links_keep_all_components(spark, bucket_rows):
    rng = np.random.default_rng(4)
    seeds = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    fps = set(seeds.tolist())
    for s in seeds[:6].tolist():  # dense groups, chains, and skewed bits
        for _ in range(60):
            s ^= 1 << int(rng.integers(0, 64))
            fps.add(s)
    fps |= {int(x) for x in rng.integers(0, 256, 60)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), 2, bucket_rows=bucket_rows).collect()
    mask = (1 << 64) - 1
    assert all(((r["a"] & mask) ^ (r["b"] & mask)).bit_count() <= 2 for r in links)
    want = _components(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    pairs = {frozenset((r["a"] & mask, r["b"] & mask)) for r in links}
    got = _components(fps, lambda a, b: frozenset((a, b)) in pairs)
    assert got == want


def test_thresholds_follow_the_costs():
    assert simhash.allocate_thresholds([[0, 9, 99, 999], [0, 1, 2, 3], [0, 9, 99, 999]], 2) == [-1, 2, -1]
    assert simhash.allocate_thresholds([[0, 1, 50, 99]] * 3, 2) == [0, 0, 0]


def test_components_of_a_chain(spark):
    got = connected_components(spark.createDataFrame([(i, i + 1) for i in range(40)] + [(90, 91)], "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == {**{i: 0 for i in range(41)}, 90: 90, 91: 90}


# --- operator 6 ----------------------------------------------------------------------------

def test_chat_rotation(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", "yo"), (1, 3, "ann", None), (1, 3, "ann", None), (1, 600, "cy", "late"),
            (2, 0, "system", "alone"), (None, None, None, "x"), (3, 0, "", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit("clash"))
    got = {(r["conv_id"], r["speaker"], r["part"]): r for r in chat.rotate(df).collect()}
    assert set(got) == {(1, s, p) for s in ("ann", "bob", "cy") for p in (0, 1)} | {(None, "unknown", -1), (3, "unknown", 0)}
    r = got[1, "ann", 0]
    assert r["n_turns"] == 4 and "<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi < |im_end|><|im_end|>\n<|im_start|>user name=bob\nyo" in r["rendered"]
    parts = [r["rendered"][int(a):int(b)] for a, b in (s.split(":") for s in r["assistant_spans"].split(","))]
    assert parts == ["hi < |im_end|><|im_end|>", "<|im_end|>"]
    assert got[1, "cy", 0]["assistant_spans"] == "" and chat.rotate(df.limit(0)).count() == 0


def test_chat_pieces_of_a_hot_turn_lose_nothing(spark):
    df = spark.createDataFrame([(1, 0, "a", f"t{i}") for i in range(100)], "conv_id long, turn long, role string, text string")
    got = chat.rotate(df, tie_rows=20).collect()
    assert len(got) > 1 and sum(r["n_turns"] for r in got) == 100


def test_chat_pieces_in_order_make_up_the_dialogue(spark):
    rows = [(c, t, "ab"[i % 2], f"{c}.{t}.{i:03d}") for c in (1, None) for t, n in ((0, 3), (5, 100), (9, 30), (600, 70)) for i in range(n)]
    rows += [(2, t, "a", f"2.{t}") for t in range(4)]
    got = chat.rotate(spark.createDataFrame(rows + rows[:50], "conv_id long, turn long, role string, text string"), tie_rows=20).collect()
    for conv in (1, 2, None):
        mine = sorted((r for r in got if r["conv_id"] == conv and r["speaker"] == "a"), key=lambda r: (r["part"], r["piece"]))
        bodies = [x for r in mine for x in re.findall(r"\n([^\n]*)<\|im_end\|>", r["rendered"])]
        assert bodies == [x[3] for x in sorted((x for x in rows if x[0] == conv), key=lambda x: x[1:])]
        sizes = [(r["part"], r["piece"], r["n_turns"]) for r in mine]
        if conv != 2:
            assert sizes == [(0, i, 20) for i in range(6)] + [(0, 6, 13), (1, 0, 20), (1, 1, 20), (1, 2, 20), (1, 3, 10)]
        else:
            assert sizes == [(0, 0, 4)]


# --- operator 7 ----------------------------------------------------------------------------

def _pii_brute(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) for d in [re.sub(r"\D", "", m[0])]
            if 16 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(d[::-1])) % 10 == 0]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub(r"\D", "", m[0])) <= 15]


def test_base_spans_match_the_patterns():
    import random

    rng = random.Random(3)
    parts = [*"ab1234567890@@.+- ()%_\n", "+1 (555) 123-4567", "a@b.co", "1.2.3.4", "4111111111111111", "4111-1111 1111 1111"]
    for _ in range(5000):
        s = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(s) == _pii_brute(s)


def test_long_runs_take_linear_time():
    assert pii.base_spans("a" * 300_000 + "@" * 1000 + "1" * 100_000 + "+" * 100_000) == []


def test_crf_gradient():
    rng = np.random.default_rng(0)
    p = {k: v.astype(float) for k, v in pii.init_weights(rng, 4, 5).items()}
    x = rng.integers(1, 20, (3, 7))
    x[1, 5:] = 0
    y = rng.integers(0, 9, (3, 7)) * (x > 0)
    s = pii.emissions(p, x)[0].astype(float)
    loss, ds, _, _ = pii.crf_loss(p, s, y, x > 0)
    for at in [(0, 0, 1), (1, 4, 2), (2, 6, 8), (1, 5, 3)]:
        t = s.copy()
        t[at] += 1e-5
        assert (pii.crf_loss(p, t, y, x > 0)[0] - loss) / 1e-5 == pytest.approx(ds[at], abs=1e-5)


def test_network_finds_held_out_spans_and_adds_to_the_base(spark, odd, none):
    rng = np.random.default_rng(6)

    def text(i):
        n = [str(x) for x in rng.integers(100, 999, 3)]
        words = " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit"], 6))
        return f"{words} call ({n[0]}) {n[1]}-{n[2]}1 {words} or mail u{n[0]}@mail{i % 9}.example.com {words} v{i}.0"

    def label(t):  # a labelling that knows phones without a country code
        return sorted(pii.base_spans(t) + [("phone", *m.span()) for m in re.finditer(r"\([0-9]{3}\) [0-9]{3}-[0-9]{4}", t)], key=lambda s: pii.KINDS.index(s[0]))

    docs = [(i, text(i)) for i in range(160)]
    model = pii.fit(spark.createDataFrame(docs[:120], "doc_id long, text string"), label=label)
    found = pii.find_spans(model, [t for _, t in docs[120:]])
    want = [set(label(t)) for _, t in docs[120:]]
    hit = sum(len(w & set(full)) for w, (_, full) in zip(want, found))
    assert hit >= 0.9 * sum(map(len, want)) and all(set(b) <= set(full) for b, full in found)
    rows = {r["doc_id"]: r for r in pii.detect(odd, model).collect()}
    assert rows[9]["n_email"] == rows[9]["n_phone"] == 1 and rows[2]["spans"] == "" and rows[None]["n_ip"] == 1
    assert rows[3]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert pii.detect(none, pii.fit(none)).count() == 0 and pii.fit(none) is None
    assert "<email>" in [r["text"] for r in pii.redact(odd, model).where("doc_id = 9").collect()][0]


# --- operator 8 ----------------------------------------------------------------------------

def test_language_held_out_accuracy_and_odd_rows(spark, odd, none):
    words = {"en": "the and with that ship water", "de": "der und mit nicht schiff wasser", "fr": "le et avec que navire eau", "es": "el y con que barco agua"}
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(rng.choice(words[g].split(), 12)), g) for i, g in enumerate(list(words) * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_languages(docs, langid.fold() != 2)
    got = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    assert np.mean([got[i]["lang_pred"] == g for i, _, g in rows]) > 0.95 and all(0 <= r["score"] <= 1 for r in got.values())
    out = {(r["doc_id"], r["lang_pred"] == "und", r["score"] == 0) for r in langid.identify(odd, model).collect()}
    assert {(2, True, True), (3, True, True), (4, True, True), (6, True, True)} <= out and (None, False, False) in out
    assert {r["doc_id"] for r in langid.accepted(odd, model).collect()} == {1, None, 7, 8, 9}
    assert {r["lang_pred"] for r in langid.identify(odd, langid.fit_languages(none, F.lit(True))).collect()} == {"und"}
    assert langid.identify(none, model).count() == 0


# --- operator 9 ----------------------------------------------------------------------------

def _hits(words, items, window):
    hit, found = set(), set()
    for item, ws in items:
        k = min(window, len(ws))
        wins = {tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)} if ws else set()
        for p in range(len(words) - k + 1):
            if k and tuple(words[p:p + k]) in wins:
                hit |= set(range(p, p + k))
                found.add(item)
    return hit, found


@pytest.mark.parametrize("block", [8, 2_000_000])
def test_decontamination_matches_brute_force(block):
    rng = np.random.default_rng(9)
    vocab = [w.encode() for w in "a b c d".split()]
    for _ in range(60):
        items = [(str(i), [vocab[k] for k in rng.integers(0, 4, rng.integers(0, 9))]) for i in range(4)]
        docs = [[vocab[k] for k in rng.integers(0, 4, rng.integers(0, 40))] for _ in range(5)]
        models = [decontaminate.SuffixAutomaton(items[:2], 4), decontaminate.SuffixAutomaton(items[2:], 4)] if block == 8 else [decontaminate.SuffixAutomaton(items, 4)]
        found = [([], set()) for _ in docs]
        for m in models:
            for f, (s, i) in zip(found, m.match(docs)):
                f[0].extend(s)
                f[1].update(i)
        for d, (spans, got) in zip(docs, found):
            assert ({p for a, b in spans for p in range(a, b)}, got) == _hits(d, items, 4)


def test_decontaminate_removes_passages_and_keeps_clean(spark, odd, none):
    passage = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    bench = spark.createDataFrame([(1, passage, "x"), (None, None, "y"), (3, "", "z")], "item_id long, text string, doc_id string")
    docs = spark.createDataFrame([(1, "Clean words here, " * 8 + passage.upper() + "; more words.", 0), (2, passage, 0), (3, "clean", 7), (4, None, None)],
                                 "doc_id long, text string, n_chars long")
    out = {r["doc_id"]: r for r in decontaminate.decontaminate(docs, bench).collect()}
    assert out[1]["text"] == "Clean words here, " * 8 + "; more words." and out[1]["n_chars"] == len(out[1]["text"])
    assert set(out) == {1, 3, 4} and (out[3]["text"], out[3]["n_chars"], out[4]["text"]) == ("clean", 7, None)
    rows = {r["doc_id"]: r for r in decontaminate.find_contamination(docs, bench).collect()}
    assert (rows[2]["n_hit"], rows[2]["n_items"], rows[4]["n_words"]) == (11, 1, 0)
    assert decontaminate.find_contamination(none, bench).count() == 0
    assert decontaminate.decontaminate(none, bench).count() == 0 and decontaminate.decontaminate(odd, bench.limit(0)).count() == len(ODD)
    assert not any(r["contaminated"] for r in decontaminate.find_contamination(odd, bench.limit(0)).collect())


def test_decontamination_in_blocks_equals_one_block(spark, odd):
    rng = np.random.default_rng(19)
    text = lambda n: " ".join(rng.choice(list("abc"), n))
    items = [(f"i{k}", text(int(n))) for k, n in enumerate([3, 40, 7, 25, 0, 12])] + [(None, text(9)), ("odd", ODD[0][1])]
    bench = spark.createDataFrame(items, "item_id string, text string").coalesce(1)
    docs = spark.createDataFrame([(i, text(int(n)), "en", i) for i, n in enumerate(rng.integers(0, 60, 20))], SCHEMA).unionAll(odd)
    assert max(sum(len(w) for _, w in b) for b in decontaminate.blocks(bench, 6, block_words=8)) <= 8
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    one, many = (rows(decontaminate.find_contamination(docs, bench, 6, block_words=n)) for n in (1000, 8))
    assert one == many and any(r[3] > 1 for r in one)
    one, many = (rows(decontaminate.decontaminate(docs, bench, 6, block_words=n)) for n in (1000, 8))
    assert one == many and len(one) < 20 + len(ODD)


# --- operator 10 ---------------------------------------------------------------------------

def test_line_dedup_odd_rows(odd, none):
    got = line_dedup.dedup_lines(odd, report=True).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, *_ in ODD)
    texts = {r["doc_id"]: r["text"] for r in got}
    assert texts[1] == ODD[0][1] and texts[2] is None and texts[3] == ""  # repeated rows are one document
    assert line_dedup.dedup_lines(none).count() == 0 and line_dedup.dedup_lines(none).columns == none.columns


def _runs_brute(docs, least):
    """All qualifying runs, of every length."""
    firsts, gone = {}, {}
    for i, text in sorted(docs, key=lambda r: (r[0] is None, r[0] or 0)):
        lines = text.split("\n")
        at = [k for k, x in enumerate(lines) if x.strip(" ")]
        for s in range(len(at)):
            for e in range(s, len(at)):
                if sum(lines[k].strip(" ").count(" ") + 1 for k in at[s:e + 1]) >= least:
                    run = tuple(lines[k] for k in at[s:e + 1])
                    if firsts.setdefault(run, (i, s)) != (i, s):
                        gone.setdefault(i, set()).update(at[s:e + 1])
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get(i, ())) for i, t in docs}


@pytest.mark.parametrize("least", [1, 2, 3, 5, 10])
def test_line_dedup_deletes_runs_of_every_length(spark, least):
    rng = np.random.default_rng(11)
    pool = ["a", "b c", "", " ", "d e f", "g h i j k l", "m"]
    docs = [(i, "\n".join(pool[k] for k in rng.integers(0, len(pool), rng.integers(1, 14)))) for i in range(40)] + [(None, "b c\nb c\nb c")]
    docs += [(100 + i, docs[i][1] + "\nz") for i in range(5)]
    got = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), min_words=least).collect()
    assert {r["doc_id"]: r["text"] for r in got} == _runs_brute(docs, least)


def test_line_dedup_leaves_no_short_end_of_a_copy(spark):
    text = "\n".join(" ".join(f"{c}{i}" for i in range(n)) for c, n in zip("abcd", (10, 22, 93, 2)))
    docs = spark.createDataFrame([(i, text) for i in range(3)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_lines"], r["n_deleted"], r["text"]) for r in line_dedup.dedup_lines(docs, report=True).collect()}
    assert got == {0: (4, 0, text), 1: (4, 4, ""), 2: (4, 4, "")}
