"""Language-model scoring with a sharded Elias-Fano n-gram trie (operator 4).

Tokens of a text: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, then one end.  The model
is a word bigram with Dirichlet smoothing,

    P(w | v) = (c(v, w) + mu * P1(w)) / (c(v) + mu),
    P1(w) = (c(w) + 0.5) / (N + 0.5 * (V + 1)),

a proper distribution over the V words of the training texts and one unknown word.

The trie is sharded by its first level, the word w; the second level holds w's
contexts v (as in suffix tries).  All of a level is compact and read through a memory
map: the words' hashes, the monotone pointers to their contexts, the prefix sums of
their counts, and the contexts, made monotone over the whole level by their word's
number, are Elias-Fano sequences; the smoothed numerators log10(c(v,w) + mu * P1(w))
are quantised to 16 bits.  A lookup finds w by successor search, and v by successor
search relative to w's range.  The logarithm of P splits into a numerator known in
w's shard and a denominator known in v's, so each occurrence is sent to its shards
once, and no model is sent to the documents.

Jobs: (1) word counts, pre-aggregated per block of documents, give N, V and the frequent
words, those that occur over bytes / (48 S) times for S shards, so at most 24 S words; (2) bigram occurrences,
folded per block, go to the shards, where counts are merged, the trie is built and the
block's occurrences are looked up; sums per document go back to their block.  A
frequent word is spread over all shards by its contexts.  Words are 64-bit hashes,
contexts 40-bit hashes beside their word.

Defined results: a null or empty text is the end alone; a null id is neither learned
from nor held out; repeated rows are counted and scored as they are; without training
texts every probability is one; an empty table gives an empty result; other columns
are passed by.
"""

from __future__ import annotations

import mmap
import tempfile
import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenocast.llm._common import shuffle_partitions, table, utf8, written

END, START = (xxhash.xxh64_intdigest(b" " * n) for n in (1, 2))  # no word holds a blank
CTX_BITS = 40
_PRIME = np.uint64(0x9E3779B97F4A7C15)


# --- Elias-Fano ------------------------------------------------------------------------------

class EliasFano:
    """A non-decreasing sequence of unsigned integers under 2^63 in about
    2 + log2(universe / n) bits each."""

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        v = np.asarray(values, dtype=np.uint64)
        n = len(v)
        top = int(v[-1]) if n else 0
        low = min(56, max(0, (top // max(n, 1)).bit_length() - 1)) if n else 0
        high = (v >> np.uint64(low)).astype(np.int64)
        bits = np.zeros(n + int(high[-1]) + 1 if n else 1, dtype=np.uint8)
        bits[high + np.arange(n)] = 1
        upper = np.packbits(bits, bitorder="little").tobytes()
        lower = b""
        if low and n:
            part = (v & np.uint64((1 << low) - 1)).astype("<u8").view(np.uint8).reshape(n, 8)
            lower = b"".join(np.packbits(np.unpackbits(part[lo:lo + 65536], axis=1, bitorder="little")[:, :low].ravel(), bitorder="little").tobytes()
                             for lo in range(0, n, 65536))  # 65536 * low bits fill whole bytes
        head = np.array([n, low, len(upper), len(bits)], dtype="<u8").tobytes()
        return head + upper + lower + b"\0" * 8

    def __init__(self, data):
        """Over a buffer, as of a memory map; the low bits stay there."""
        head = np.frombuffer(data, dtype="<u8", count=4)
        self.n, self.low, upper, nbits = (int(x) for x in head)
        bits = np.unpackbits(np.frombuffer(data, dtype=np.uint8, count=upper, offset=32), bitorder="little")[:nbits]
        self.zeros = np.flatnonzero(bits == 0)
        self.ones = np.flatnonzero(bits)
        size = len(data) - 32 - upper - 7
        self.words = np.ndarray(shape=(max(size, 1),), dtype="<u8", buffer=data, offset=32 + upper, strides=(1,))

    def _low(self, at: np.ndarray) -> np.ndarray:
        bit = at.astype(np.int64) * self.low
        return (self.words[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.low) - 1)

    def get(self, at: np.ndarray) -> np.ndarray:
        at = np.asarray(at, dtype=np.int64)
        high = (self.ones[at] - at).astype(np.uint64) << np.uint64(self.low)
        return high | self._low(at) if self.low else high

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Place of the first value that is at least x (n if there is none)."""
        x = np.asarray(x, dtype=np.uint64)
        if not self.n:
            return np.zeros(len(x), dtype=np.int64)
        high = (x >> np.uint64(self.low)).astype(np.int64)
        # values with a smaller high part stand before the high-th zero
        last = len(self.zeros)
        lo = np.where(high == 0, 0, self.zeros[np.minimum(high, last) - 1] - np.minimum(high, last) + 1)
        hi = np.where(high >= last, lo, self.zeros[np.minimum(high, last - 1)] - np.minimum(high, last - 1)) if last else lo
        lo, hi = np.where(high >= last + 1, self.n, lo), np.where(high >= last, self.n, hi)
        lo = np.minimum(lo, self.n)
        if self.low:
            want = x & np.uint64((1 << self.low) - 1)
            inside = high < last
            end = hi.copy()
            live = np.flatnonzero(inside & (lo < end))
            while len(live):
                mid = (lo[live] + end[live]) >> 1
                less = self._low(mid) < want[live]
                lo[live] = np.where(less, mid + 1, lo[live])
                end[live] = np.where(less, end[live], mid)
                live = live[lo[live] < end[live]]
        return lo

    def find(self, x: np.ndarray) -> np.ndarray:
        """Place of x, or -1."""
        at = self.successor(x)
        ok = at < self.n
        out = np.full(len(at), -1, dtype=np.int64)
        out[ok] = np.where(self.get(at[ok]) == np.asarray(x, dtype=np.uint64)[ok], at[ok], -1)
        return out


def quantise(values: np.ndarray) -> tuple[np.ndarray, float, float]:
    """16-bit codes, and the first value and step they stand for."""
    lo, hi = (float(values.min()), float(values.max())) if len(values) else (0.0, 0.0)
    step = (hi - lo) / 65535 or 1.0
    return np.rint((values - lo) / step).astype("<u2"), lo, step


class TrieShard:
    """Two mapped levels: words with counts, and each word's contexts."""

    FIELDS = ("words", "counts", "pointers", "contexts", "codes")

    @classmethod
    def build(cls, words: np.ndarray, counts: np.ndarray, node_word: np.ndarray, node_ctx: np.ndarray, node_value: np.ndarray) -> dict[str, bytes]:
        """Level blobs; words sorted, nodes sorted by (place of the word, context)."""
        codes, lo, step = quantise(node_value)
        return {"words": EliasFano.encode(words >> np.uint64(1)), "counts": EliasFano.encode(np.cumsum(counts)),
                "pointers": EliasFano.encode(np.searchsorted(node_word, np.arange(len(words) + 1))),
                "contexts": EliasFano.encode((node_word.astype(np.uint64) << np.uint64(CTX_BITS)) | node_ctx),
                "codes": np.array([lo, step], dtype="<f8").tobytes() + codes.tobytes()}

    def __init__(self, blobs: dict[str, bytes]):
        self.file = tempfile.TemporaryFile()
        spans, at = {}, 0
        for name in self.FIELDS:
            self.file.write(blobs[name])
            spans[name] = (at, at + len(blobs[name]))
            at = spans[name][1]
        self.file.flush()
        self.map = mmap.mmap(self.file.fileno(), at, access=mmap.ACCESS_READ)
        view = memoryview(self.map)
        part = {k: view[a:b] for k, (a, b) in spans.items()}
        self.words, self.counts, self.pointers, self.contexts = (EliasFano(part[k]) for k in self.FIELDS[:4])
        self.lo, self.step = np.frombuffer(part["codes"], dtype="<f8", count=2)
        self.codes = np.frombuffer(part["codes"], dtype="<u2", offset=16)

    def count(self, place: np.ndarray) -> np.ndarray:
        """Training count of the words at these places, 0 at -1."""
        out = np.zeros(len(place), dtype=np.int64)
        ok = place >= 0
        at = place[ok]
        total = self.counts.get(at).astype(np.int64)
        out[ok] = total - np.where(at > 0, self.counts.get(np.maximum(at - 1, 0)).astype(np.int64), 0)
        return out

    def numerator(self, place: np.ndarray, ctx: np.ndarray) -> np.ndarray:
        """log10 of the smoothed numerator of each (word's place, context), NaN if unseen."""
        out = np.full(len(place), np.nan)
        rows = np.flatnonzero(place >= 0)
        if not self.contexts.n or not len(rows):
            return out
        key = (place[rows].astype(np.uint64) << np.uint64(CTX_BITS)) | ctx[rows]
        at = self.contexts.successor(key)
        first, last = self.pointers.get(place[rows]).astype(np.int64), self.pointers.get(place[rows] + 1).astype(np.int64)
        inside = (at >= first) & (at < last)  # the successor lies within the word's own range
        rows, at, key = rows[inside], at[inside], key[inside]
        hit = self.contexts.get(at) == key
        out[rows[hit]] = self.lo + self.step * self.codes[at[hit]]
        return out


# --- blocks ----------------------------------------------------------------------------------

class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def _pack(a: np.ndarray) -> bytes:
    """Compressed, bytes of like weight together."""
    a = np.ascontiguousarray(a)
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes())


def _unpack(data: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel()


def _blocks(batches, block_tokens: int, fold: int, held: int):
    """(block, ids, training flags, sizes, token hashes) of runs of documents."""
    part, k = TaskContext.get().partitionId(), 0
    ids, train, toks, n = [], [], [], 0
    memo = _Hashes()

    def out():
        nonlocal k, ids, train, toks, n, memo
        got = (part << 24) + k, ids, np.array(train), np.array([len(t) for t in toks]), np.concatenate(toks)
        k, ids, train, toks, n, memo = k + 1, [], [], [], 0, _Hashes()
        return got

    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
            ws = utf8(t.as_py()).lower().split()
            a = np.empty(len(ws) + 1, dtype=np.uint64)
            a[:-1] = np.fromiter(map(memo.__getitem__, ws), dtype=np.uint64, count=len(ws))
            a[-1] = END
            ids.append(i)
            train.append(i is not None and zlib.crc32(str(i).encode()) % fold != held)
            toks.append(a)
            n += len(a)
            if n >= block_tokens:
                yield out()
    if ids:
        yield out()


def _shard(h: np.ndarray, shards: int) -> np.ndarray:
    return (((h * _PRIME) >> np.uint64(40)) % np.uint64(shards)).astype(np.int64)


def _by_key(batches, names: list[str]):
    """Rows (as dicts of lists) of equal first column, from batches sorted by it."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(batch.column(batch.schema.get_field_index(c)) for c in names)):
            k = row[0].as_py()
            if k != key and rows:
                yield key, rows
                rows = []
            key = k
            rows.append([x.as_py() for x in row[1:]])
    if rows:
        yield key, rows


def _word_statistics(docs: DataFrame, shards: int, often: int, block_tokens: int, fold: int, held: int) -> tuple[int, int, int, dict[int, int]]:
    """N, V, training documents, and {hash: training count} of the words that occur over ``often`` times."""
    def count(batches):
        for block, _, train, sizes, toks in _blocks(batches, block_tokens, fold, held):
            words, at = np.unique(toks, return_inverse=True)
            learned = np.bincount(at, weights=np.repeat(train, sizes), minlength=len(words)).astype(np.int64)
            total = np.bincount(at, minlength=len(words))
            s = _shard(words, shards)
            order = np.argsort(s, kind="stable")
            cut = np.searchsorted(s[order], np.arange(shards + 1))
            for k in range(shards):
                r = order[cut[k]:cut[k + 1]]
                if len(r):
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([block], pa.int64()), pa.array([words[r].tobytes()], pa.binary()),
                                                      pa.array([_pack(learned[r].astype("<u4"))], pa.binary()), pa.array([_pack(total[r].astype("<u4"))], pa.binary())],
                                                     names=["shard", "block", "words", "learned", "total"])

    def merge(batches):
        for shard, rows in _by_key(batches, ["shard", "words", "learned", "total"]):
            words = np.concatenate([np.frombuffer(r[0], dtype=np.uint64) for r in rows])
            uniq, at = np.unique(words, return_inverse=True)
            learned = np.bincount(at, weights=np.concatenate([_unpack(r[1], "<u4") for r in rows]), minlength=len(uniq)).astype(np.int64)
            total = np.bincount(at, weights=np.concatenate([_unpack(r[2], "<u4") for r in rows]), minlength=len(uniq)).astype(np.int64)
            top, end = np.flatnonzero(total > often), np.flatnonzero(uniq == np.uint64(END))
            at = np.concatenate((top, end))
            yield pa.RecordBatch.from_arrays([
                pa.array([0, *[1] * len(top), *[2] * len(end)], pa.int32()), pa.array([0, *uniq[at].view(np.int64).tolist()], pa.int64()),
                pa.array([int(learned.sum()), *learned[at].tolist()], pa.int64()), pa.array([int((learned > 0).sum()), *[0] * len(at)], pa.int64())],
                names=["kind", "word", "learned", "v"])

    rows = docs.mapInArrow(count, "shard int, block bigint, words binary, learned binary, total binary")
    rows = rows.repartition(shuffle_partitions(docs.sparkSession), "shard").sortWithinPartitions("shard", "block")
    stats = written(rows.mapInArrow(merge, "kind int, word bigint, learned bigint, v bigint"), "lm-words")
    one = stats.where("kind = 0").agg(F.sum("learned"), F.sum("v")).first()
    n, v = (int(x or 0) for x in one)
    hot = {r["word"] & (1 << 64) - 1: r["learned"] for r in stats.where("kind = 1").select("word", "learned").collect()}  # at most 24 S rows
    end = stats.where("kind = 2").agg(F.sum("learned")).first()[0]  # an end a training document
    return n, v, int(end or 0), hot


def score_texts(docs: DataFrame, mu: float = 50.0, fold: int = 5, held: int = 1, block_tokens: int = 2_000_000,
                shard_tokens: int = 2_000_000, id_col: str = "doc_id", text_col: str = "text", model_to: str | None = None) -> DataFrame:
    """Score of every document under the model of those whose crc32 of the id's text,
    mod ``fold``, is not ``held`` (module text).  ``model_to``: a path to which the trie
    is written as a table (shard, words, counts, pointers, contexts, codes)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("t"))
    # tokens are bounded by half the characters; only a guide for the number of shards
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    shards = max(shuffle_partitions(spark), -(-size // (6 * shard_tokens)))
    n_train, v_train, n_docs, hot = _word_statistics(rows, shards, size // (48 * shards), block_tokens, fold, held)
    hot_words = np.array(sorted(hot), dtype=np.uint64)
    hot_counts = np.array([hot[w] for w in sorted(hot)], dtype=np.int64)
    unit = n_train + 0.5 * (v_train + 1)

    def send(batches):
        schema = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("kind", pa.int32()), *((c, pa.binary()) for c in "abcde")])

        def row(shard, block, kind, *blobs):
            cols = [*blobs, *[None] * (5 - len(blobs))]
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([block], pa.int64()), pa.array([kind], pa.int32()),
                                               *(pa.array([x], pa.binary()) for x in cols)], schema=schema)

        for block, ids, train, sizes, toks in _blocks(batches, block_tokens, fold, held):
            null = np.array([i is None for i in ids])
            yield row(block % shards, block, 0, np.array([i or 0 for i in ids], dtype=np.int64).tobytes(), null.tobytes(), train.tobytes(), sizes.astype("<i8").tobytes())
            words, at = np.unique(toks, return_inverse=True)
            first = np.cumsum(sizes) - sizes
            prev = np.empty(len(toks), dtype=np.int64)
            prev[1:] = at[:-1]
            prev[first] = len(words)  # the start
            ctx = np.append(words, np.uint64(START)) >> np.uint64(64 - CTX_BITS)
            s = _shard(words, shards)[at]
            spread = np.isin(words, hot_words)[at]
            s[spread] = _shard(toks[spread] ^ (ctx[prev[spread]] * _PRIME), shards)
            bits = max(len(words).bit_length(), 1)
            key = (s << (2 * bits)) | (at << bits) | prev
            order = np.argsort(key, kind="stable")  # documents stay in order
            key = key[order]
            doc = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)[order]
            node = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            many = np.diff(np.append(node, len(key)))
            node_shard, node_word, node_ctx = key[node] >> (2 * bits), (key[node] >> bits) & ((1 << bits) - 1), key[node] & ((1 << bits) - 1)
            cut = np.searchsorted(node_shard, np.arange(shards + 1))
            for k in range(shards):
                a, b = cut[k], cut[k + 1]
                if a == b:
                    continue
                w, run = node_word[a:b], np.flatnonzero(np.concatenate(([True], node_word[a + 1:b] != node_word[a:b - 1])))
                c = ctx[node_ctx[a:b]].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :CTX_BITS // 8].copy()
                p, q = node[a], node[b] if b < len(node) else len(key)
                yield row(k, block, 1, words[w[run]].tobytes(), _pack(np.diff(np.append(run, b - a)).astype("<u4")),
                          zstandard.ZstdCompressor(level=1).compress(c.T.tobytes()), _pack(many[a:b].astype("<u4")),
                          np.packbits(train).tobytes() + _pack(doc[p:q].astype("<u4")))

    def answer(batches):
        schema = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("kind", pa.int32()), *((c, pa.binary()) for c in "abcde")])

        def row(block, shard, kind, *blobs):
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([shard], pa.int32()), pa.array([kind], pa.int32()),
                                               *(pa.array([x], pa.binary()) for x in [*blobs, *[None] * (5 - len(blobs))])], schema=schema)

        for shard, rows in _by_key(batches, ["shard", "block", "kind", *"abcde"]):
            for block, kind, *blobs in rows:
                if kind == 0:
                    yield row(block, shard, 0, *blobs[:4])
            rows = [r for r in rows if r[1] == 1]
            if not rows:
                continue
            parts = []
            for block, _, a, b, c, d, e in rows:
                w = np.repeat(np.frombuffer(a, dtype=np.uint64), _unpack(b, "<u4"))
                raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(c), dtype=np.uint8).reshape(CTX_BITS // 8, -1)
                ctx = np.zeros((raw.shape[1], 8), dtype=np.uint8)
                ctx[:, :CTX_BITS // 8] = raw.T
                parts.append((block, w, ctx.view("<u8").ravel(), _unpack(d, "<u4").astype(np.int64), e))
            words = np.unique(np.concatenate([p[1] for p in parts]))
            # training counts of all nodes
            keys, learned, tails = [], [], []
            for block, w, ctx, many, e in parts:
                place = np.searchsorted(words, w).astype(np.uint64)
                # the flags' length isn't sent: the packed documents begin with zstd's magic number
                at = e.index(b"\x28\xb5\x2f\xfd")
                train = np.unpackbits(np.frombuffer(e[:at], dtype=np.uint8))
                doc = _unpack(e[at:], "<u4")
                keys.append((place << np.uint64(CTX_BITS)) | ctx)
                learned.append(np.add.reduceat(train[doc].astype(np.int64), np.cumsum(many) - many))
                tails.append((block, many, doc, len(train)))
            every = np.concatenate(keys)
            order = np.argsort(every)
            sorted_keys = every[order]
            edge = np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))
            seen = np.add.reduceat(np.concatenate(learned)[order], edge)
            node = sorted_keys[edge]
            del every, order, sorted_keys
            node, seen = node[seen > 0], seen[seen > 0]
            node_word = (node >> np.uint64(CTX_BITS)).astype(np.int64)
            counts = np.bincount(node_word, weights=seen, minlength=len(words)).astype(np.int64)
            at = np.searchsorted(words, hot_words)
            here = (at < len(words)) & (words[np.minimum(at, len(words) - 1)] == hot_words)
            counts[at[here]] = hot_counts[here]  # these words' contexts lie in all shards
            known = counts > 0  # words of held-out texts alone are no part of the model
            new_place = np.cumsum(known) - 1
            numerator = np.log10(seen + mu * (counts[node_word] + 0.5) / unit)
            blobs = TrieShard.build(words[known], counts[known], new_place[node_word], node & np.uint64((1 << CTX_BITS) - 1), numerator)
            trie = TrieShard(blobs)
            if model_to:
                yield row(-1, shard, 2, *(blobs[f] for f in TrieShard.FIELDS))
            for (block, many, doc, n), key in zip(tails, keys):
                place = (key >> np.uint64(CTX_BITS)).astype(np.int64)
                w = words[place]
                place = trie.words.find(w >> np.uint64(1))
                c = trie.count(place)
                p1 = (c + 0.5) / unit
                base = np.log10(p1)
                num = trie.numerator(place, key & np.uint64((1 << CTX_BITS) - 1))
                num = np.where(np.isnan(num), np.log10(mu * p1), num)
                score = num - np.where(w == np.uint64(END), 0.0, np.log10(c + mu))
                each = np.repeat(np.arange(len(many)), many)
                m = int(doc.max()) + 1
                yield row(block, shard, 1, _pack(np.bincount(doc, weights=base[each], minlength=m)), _pack(np.bincount(doc, weights=score[each], minlength=m)),
                          _pack(np.bincount(doc, weights=(c > 0)[each], minlength=m).astype("<u4")))

    def finish(batches):
        for _, rows in _by_key(batches, ["block", "kind", *"abcd"]):
            meta = next(r for r in rows if r[0] == 0)
            ids = np.frombuffer(meta[1], dtype=np.int64)
            null, train = np.frombuffer(meta[2], dtype=bool), np.frombuffer(meta[3], dtype=bool)
            sizes = np.frombuffer(meta[4], dtype="<i8")
            base, score, known = np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids), dtype=np.int64)
            for kind, a, b, c, _ in rows:
                if kind == 1:
                    x = _unpack(a, "<f8")
                    base[:len(x)] += x
                    score[:len(x)] += _unpack(b, "<f8")
                    known[:len(x)] += _unpack(c, "<u4")
            score -= np.log10(n_docs + mu)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64(), mask=null), pa.array(~train & ~null, pa.bool_()), pa.array(sizes, pa.int64()), pa.array(known, pa.int64()),
                pa.array(np.full(len(ids), n_train), pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64())],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    n = shuffle_partitions(spark)
    cols = ", ".join(f"{c} binary" for c in "abcde")
    sent = rows.mapInArrow(send, f"shard int, block bigint, kind int, {cols}").repartition(n, "shard").sortWithinPartitions("shard", "block", "kind")
    back = sent.mapInArrow(answer, f"block bigint, shard int, kind int, {cols}")
    if model_to:
        back = written(back, "lm-answers")
        back.where("kind = 2").select("shard", *(F.col(c).alias(f) for c, f in zip("abcde", TrieShard.FIELDS))).write.parquet(model_to)
        back = back.where("kind < 2")
    return (back.repartition(n, "block").sortWithinPartitions("block", "kind", "shard")
            .mapInArrow(finish, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))
