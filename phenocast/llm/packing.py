"""Lexical retrieval packing (operator 3).

Documents are tokenized, routed by content and dealt into shards of about ``shard_tokens``
tokens.  Routing: of a random sample of about ``SAMPLE`` different documents ``pivots``
stand for groups; a document joins the pivot of the largest cosine of BM25 weights (with the
sample's frequencies), and the groups are laid out in ranges by (pivot, min-hash of the
tokens, hash), so copies lie side by side, like documents near them, and a hot group is cut
into shards like any other.  Each shard has a BM25 inverted index over its
documents' token ids, weighted with document frequencies and a mean length counted over all
documents.  A seed document opens a window; its best unused neighbours in the shard, by BM25
on all of the seed's terms, are placed after it until the window is full.  The document that
crosses the end is cut there, opens the next window and is its seed; without unused
neighbours the first unused document is.

Every id lies in exactly one piece.  A shard's last tokens, fewer than a window, are
cut into sequences of the powers of two of their number's binary digits, which need
no padding either, so no sequence is padded.

Defined results: a null or empty text has the end id alone; repeated rows and null
ids are packed as they are; an empty table gives no piece; other columns are passed by.
"""

from __future__ import annotations

import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenocast.llm._common import give_back, released, slices, table, written

PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint")
# marks that never merge with the letters before them; an apostrophe may
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and c != 39)


_NO_MERGE = np.iinfo(np.int32).max


class WordIds:
    """Packed token ids of whole batches of texts, for a tokenizer whose white-space separated
    chunks are independent.

    Arrow finds a batch's distinct chunks, and of chunks of letters with plain marks behind
    them, which never merge, the distinct words without their marks; only these meet the
    tokenizer, or a memo of words met before.  Any other chunk is encoded whole.  The memo is
    held in arrays and searched by hash, for all words of a batch at once, and each word found
    is compared; of a full memo the half met longest ago goes.
    """

    def __init__(self, tokenizer, dtype, most: int = 500_000):
        self.tokenizer, self.tokenize, self.most, self.dtype = tokenizer, tokenizer.model.tokenize, most, dtype
        self.code = {np.uint16: "H", np.uint32: "I"}[dtype]
        self.alphabet = _byte_alphabet()
        self.merges = Merges(tokenizer, self.alphabet)
        self.marks: dict = {}
        # a word's text, number of ids (-1: no word of letters), last batch; all ids; hashes in order, and whose they are
        self.words = pa.array([], pa.large_string())
        self.sizes, self.met, self.ids = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32), np.zeros(0, dtype=dtype)
        self.hashes, self.owner, self.batches = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int32), 0

    def encode(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def word(self, word: str) -> bytes:
        """Ids of a word of letters; one pre-token, straight to the merges."""
        text = word if word.isascii() else word.encode().decode("latin-1").translate(self.alphabet)
        return array(self.code, [t.id for t in self.tokenize(text)]).tobytes()

    def letters(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words one after the other, and their numbers; -1 for what is no word of letters."""
        plain = pc.and_(pc.string_is_ascii(words), pc.ascii_is_alpha(words)).to_numpy(zero_copy_only=False)
        other = np.flatnonzero(~pc.string_is_ascii(words).to_numpy(zero_copy_only=False))
        plain[other] = [_plain(w) for w in words.take(pa.array(other)).to_pylist()]
        long = plain & ((pc.binary_length(words).to_numpy(zero_copy_only=False) > 64) | self.merges.partial)
        short = np.flatnonzero(plain & ~long)
        ids, sizes = self.merges.ids(words.take(pa.array(short)))
        long = np.flatnonzero(long)
        rest = [self.word(w) for w in words.take(pa.array(long)).to_pylist()]
        n, at = np.full(len(words), -1, dtype=np.int32), np.zeros(len(words), dtype=np.int64)
        n[short], n[long] = sizes, [len(r) // np.dtype(self.dtype).itemsize for r in rest]
        at[short], at[long] = np.arange(len(short)), len(short) + np.arange(len(long))
        flat = np.concatenate([ids.astype(self.dtype), np.frombuffer(b"".join(rest), dtype=self.dtype)])
        known = n >= 0
        return _gathered(flat, np.concatenate([n[short], n[long]]), at[known]), n

    def shrink(self) -> None:
        keep = self.met >= np.median(self.met)
        self.ids = self.ids[np.repeat(keep, np.maximum(self.sizes, 0))]
        self.words, self.sizes, self.met = self.words.filter(pa.array(keep)), self.sizes[keep], self.met[keep]
        held = keep[self.owner]
        self.hashes, self.owner = self.hashes[held], (np.cumsum(keep, dtype=np.int32) - 1)[self.owner[held]]

    def entries(self, words: pa.Array) -> np.ndarray:
        """Where the memo has each of the distinct ``words``; new ones are added."""
        if len(self.words) > self.most or self.words.nbytes > 40 * self.most:
            self.shrink()
        h, at = _hashes(words), np.full(len(words), -1, dtype=np.int64)
        if len(self.words):
            place = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            found = np.flatnonzero(self.hashes[place] == h)
            owner = self.owner[place[found]]
            same = pc.equal(self.words.take(pa.array(owner)), words.take(pa.array(found))).to_numpy(zero_copy_only=False)
            at[found[same]] = owner[same]
        new = np.flatnonzero(at < 0)
        at[new] = len(self.words) + np.arange(len(new))
        added = words.take(pa.array(new))
        ids, sizes = self.letters(added)
        self.words = pa.concat_arrays([self.words, added])
        self.ids, self.sizes = np.append(self.ids, ids), np.append(self.sizes, sizes)
        new = new[np.argsort(h[new])]
        place = np.searchsorted(self.hashes, h[new])
        self.hashes, self.owner = np.insert(self.hashes, place, h[new]), np.insert(self.owner, place, at[new])
        self.met = np.append(self.met, np.zeros(len(new), dtype=np.int32))
        self.batches += 1
        self.met[at] = self.batches
        return at

    def chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct chunks one after the other, and their numbers."""
        stems = pc.ascii_rtrim(chunks, characters=_MARKS).dictionary_encode()
        at = self.entries(stems.dictionary)[stems.indices.to_numpy(zero_copy_only=False)]
        over = pc.binary_length(chunks).to_numpy(zero_copy_only=False) - pc.binary_length(self.words).to_numpy(zero_copy_only=False)[at]
        # chunks that are no word with marks are encoded whole, behind the words
        whole = np.flatnonzero(self.sizes[at] < 0)
        at[whole] = len(self.words) + np.arange(len(whole))
        over[whole] = 0
        extra = [self.encode(x) for x in chunks.take(pa.array(whole)).to_pylist()]
        tails, tail_at, places = [b""], np.zeros(len(at), dtype=np.int64), {"": 0}
        raw = chunks.cast(pa.large_binary())
        for n in np.unique(over[over > 0]).tolist():
            some = np.flatnonzero(over == n)
            marks = pc.binary_slice(raw.take(pa.array(some)), -n).dictionary_encode()
            of = []
            for m in marks.dictionary.to_pylist():
                if m not in places:
                    tail = self.marks.get(m)
                    if tail is None:
                        tail = self.encode(m.decode())
                        if len(self.marks) < 150_000:
                            self.marks[m] = tail
                    places[m] = len(tails)
                    tails.append(tail)
                of.append(places[m])
            tail_at[some] = np.array(of)[marks.indices.to_numpy(zero_copy_only=False)]
        behind = len(self.words) + len(extra)
        extra += tails
        sizes = np.fromiter(map(len, extra), dtype=np.int64, count=len(extra)) // np.dtype(self.dtype).itemsize
        sizes = np.concatenate([np.maximum(self.sizes, 0), sizes])
        ids = np.append(self.ids, np.frombuffer(b"".join(extra), dtype=self.dtype))
        pairs = np.stack([at, behind + tail_at], axis=1).ravel()
        return _gathered(ids, sizes, pairs), sizes[pairs].reshape(-1, 2).sum(axis=1)

    def batch(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text, null read as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        special = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)     # a special token's name could arise
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.if_else(pa.array(special), "", texts)))
        flat = lists.flatten()
        full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
        upto = np.concatenate(([0], np.cumsum(full)))[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        coded = flat.filter(pa.array(full)).dictionary_encode()
        del lists, flat, full
        ids, sizes = self.chunks(coded.dictionary)
        at = coded.indices.to_numpy(zero_copy_only=False)
        flat_ids = _gathered(ids, sizes, at)
        ends = np.concatenate(([0], np.cumsum(sizes[at])))
        bounds = ends[upto]
        out = [flat_ids[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        for j in np.flatnonzero(special).tolist():
            out[j] = b"".join(map(self.encode, texts[j].as_py().split()))
        return out


class Merges:
    """The merges of a byte-pair vocabulary with word ends, made in many words at once: in each
    round a word's pair of least rank, the leftmost of such, becomes one token."""

    def __init__(self, tokenizer, alphabet: dict[int, str], end: str = "</w>"):
        import json

        model = json.loads(tokenizer.to_str())["model"]
        usual = model.get("type") == "BPE" and not model.get("ignore_merges") and not model.get("continuing_subword_prefix")
        vocab, pairs = (model["vocab"], model["merges"]) if usual else ({}, [])
        self.inner = np.array([vocab.get(alphabet[b], -1) for b in range(256)], dtype=np.int64)
        self.last = np.array([vocab.get(alphabet[b] + end, -1) for b in range(256)], dtype=np.int64)
        self.partial = bool((self.inner < 0).any() or (self.last < 0).any())      # other rules, or a byte without a token: left to the tokenizer
        merges = {}
        for rank, pair in enumerate(pairs):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            merges[vocab[a] << 32 | vocab[b]] = (rank, vocab[a + b])
        keys = sorted(merges)
        self.keys = np.array([*keys, 1 << 62], dtype=np.int64)
        self.rank = np.array([*(merges[k][0] for k in keys), _NO_MERGE], dtype=np.int32)
        self.made = np.zeros(len(pairs), dtype=np.int64)
        for rank, made in merges.values():
            self.made[rank] = made

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.rank[at], _NO_MERGE)

    def ids(self, words: pa.LargeStringArray, some: int = 1 << 13) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that are not empty, one after the other, and their numbers."""
        parts = [self._some(words.slice(lo, some)) for lo in range(0, len(words), some)]
        if not parts:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return tuple(np.concatenate(x) for x in zip(*parts))

    def _some(self, words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        raw, bounds = _bytes(words)
        token, word = self.inner[raw], np.repeat(np.arange(len(words)), np.diff(bounds))
        token[bounds[1:] - 1] = self.last[raw[bounds[1:] - 1]]
        rank = np.full(len(token), _NO_MERGE, dtype=np.int32)        # of a token with the next of its word
        pair = np.flatnonzero(word[1:] == word[:-1])
        rank[pair] = self.ranks(token[pair], token[pair + 1])
        done, sizes = [], np.diff(bounds)
        while len(token):
            starts = np.cumsum(sizes) - sizes
            least = np.minimum.reduceat(rank.astype(np.int64) << 32 | np.arange(len(token)), starts)    # with its place
            more = least < _NO_MERGE << 32
            stays = np.repeat(more, sizes)
            done.append((word[~stays], token[~stays]))
            hit, starts, sizes = least[more] & 0xFFFFFFFF, starts[more], sizes[more] - 1
            token[hit] = self.made[rank[hit]]
            rank[hit] = rank[hit + 1]
            stays[hit + 1] = False                                   # merged into the one before
            token, word, rank = token[stays], word[stays], rank[stays]
            first = np.cumsum(sizes) - sizes
            at = hit - starts + first
            for left in (at[at > first] - 1, at[at < first + sizes - 1]):
                rank[left] = self.ranks(token[left], token[left + 1])
        word, token = (np.concatenate(x) for x in zip(*done))
        return token[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))


def _bytes(words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all words one after the other, and their bounds."""
    _, offsets, data = words.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[words.offset:words.offset + len(words) + 1]
    return np.frombuffer(data or b"", dtype=np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]


def _hashes(words: pa.LargeStringArray) -> np.ndarray:
    """A number of 64 bits for each word: its bytes' random numbers times those of their places, summed."""
    rng = np.random.default_rng(17)
    byte, spot = rng.integers(0, 1 << 64, 256, dtype=np.uint64), rng.integers(0, 1 << 64, 64, dtype=np.uint64) | np.uint64(1)
    raw, ends = _bytes(words)
    upto = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(byte[raw] * spot[(np.arange(len(raw)) - np.repeat(ends[:-1], np.diff(ends))) & 63], out=upto[1:])
    return upto[ends[1:]] - upto[ends[:-1]]


def _gathered(ids: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The runs ``at`` of ``ids``, which holds runs of the given sizes."""
    first, n = np.cumsum(sizes) - sizes, sizes[at]
    ends = np.cumsum(n)
    place = np.repeat(first[at] - ends + n, n)
    place += np.arange(len(place))
    return ids[place]


def _plain(word: str) -> bool:
    """Letters only, lower case and composed: the normaliser leaves it as it is."""
    return word.isalpha() and word == word.lower() and max(word) < "\u0300"


def _byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the rest follows at 256."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    return {**{b: chr(b) for b in keep}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


def word_memo(tokenizer, dtype) -> WordIds | None:
    """The memo if this tokenizer's chunks are independent, as with a vocabulary of
    word ends that drops white space; None if each text has to be encoded whole."""
    import json

    spec = json.loads(tokenizer.to_str())
    steps = str(spec["pre_tokenizer"])
    ok = (spec["model"].get("end_of_word_suffix") == "</w>" and "'behavior': 'Removed'" in steps and "ByteLevel" in steps
          and "Lowercase" in str(spec["normalizer"]) and not spec["model"].get("dropout"))
    return WordIds(tokenizer, dtype) if ok else None


@lru_cache(maxsize=1)
def _tokenizer(spec: str, dtype):
    """A tokenizer and its memo, kept by the process: the next task in the same worker goes on with them."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(spec)
    return tokenizer, word_memo(tokenizer, dtype)


def encode_texts(texts: pa.Array, tokenizer, memo: WordIds | None, dtype) -> list[bytes]:
    """Packed ids of each text, null read as empty."""
    if memo is not None:
        return memo.batch(texts)
    return [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, dtype=dtype).tobytes() for t in texts.to_pylist()]


K1, B = 1.2, 0.75        # of BM25
_MOST_RANGES = 50_000


class Router:
    """Group and min-hash of documents, from a bounded sample of them."""

    def __init__(self, sample: list[np.ndarray], size: int, pivots: int):
        self.size, self.n = size, len(sample)
        self.mean = sum(map(len, sample)) / max(self.n, 1)
        df = np.zeros(size, dtype=np.int64)
        for d in sample:
            df[np.unique(d)] += 1
        self.idf = np.log1p((self.n - df + 0.5) / (df + 0.5)).astype(np.float32)
        table = np.zeros((size, max(min(pivots, self.n), 1)), dtype=np.float32)
        for k, d in enumerate(sample[:pivots]):
            term, tf = np.unique(d, return_counts=True)
            w = self.weights(term, tf, len(d))
            table[term, k] = w / max(float(np.linalg.norm(w)), 1e-9)
        # like pivots side by side: each is followed by the most similar one that is left
        near, chain, left = table.T @ table, [0], set(range(1, table.shape[1]))
        while left:
            chain.append(max(left, key=lambda k: (near[chain[-1], k], -k)))
            left.remove(chain[-1])
        table = table[:, chain]
        self.at = tuple(x.astype(np.int32) for x in np.nonzero(table))     # sparse on its way to the tasks
        self.values, self.width, self.table, self.mixed = table[self.at], table.shape[1], None, None

    def unpack(self) -> None:
        self.table = np.zeros((self.size, self.width), dtype=np.float32)
        self.table[self.at] = self.values
        self.mixed = np.random.default_rng(3).permutation(self.size).astype(np.int32)

    def weights(self, term, tf, length) -> np.ndarray:
        return (self.idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / max(self.mean, 1e-9)))).astype(np.float32)

    def place(self, term: np.ndarray, tf: np.ndarray, start: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Groups and min-hashes of documents whose distinct terms begin at ``start``."""
        if self.table is None:
            self.unpack()
        sizes = np.diff(start, append=len(term))
        groups = np.empty(len(start), dtype=np.int32)
        # some documents at a time, so that their rows of the table stay small
        cuts = np.searchsorted(start, np.arange(0, len(term), 2_000)).tolist()
        for lo, hi in zip(cuts, [*cuts[1:], len(start)]):
            if lo < hi:
                a, z = start[lo], start[hi] if hi < len(start) else len(term)
                w = self.weights(term[a:z], tf[a:z], np.repeat(lengths[lo:hi], sizes[lo:hi]))
                groups[lo:hi] = np.add.reduceat(self.table[term[a:z]] * w[:, None], start[lo:hi] - a, axis=0).argmax(1)
        return groups, np.minimum.reduceat(self.mixed[term], start)


def _distinct_terms(flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of all documents one after the other, their counts, and where each document's begin."""
    key = np.repeat(np.arange(len(lengths), dtype=np.uint64) << np.uint64(32), lengths)
    key |= flat
    key.sort()
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    tf = np.diff(np.append(first, len(key)))
    doc = (key[first] >> np.uint64(32)).astype(np.int64)
    return (key[first] & np.uint64(0xFFFFFFFF)).astype(np.int64), tf, np.searchsorted(doc, np.arange(len(lengths)))


SAMPLE = 512


def _sample(docs: DataFrame, spec: str, text_col: str, count: int = SAMPLE) -> tuple[int, list[np.ndarray]]:
    """Vocabulary size, and the ids of about ``count`` different texts of 100 to 20,000 characters
    (all, if they are fewer); tokenized in a task, the driver loads no tokenizer."""
    from tokenizers import Tokenizer

    texts = docs.select(F.col(text_col).alias("t")).where(F.length("t").between(100, 20_000))
    share = min(1.0, 4 * count / max(docs.count(), 1))
    drawn = texts.where(F.rand(11) < share).withColumn("h", F.xxhash64("t")).groupBy("h").agg(F.first("t").alias("t")).orderBy("h").limit(count)

    def run(batches):
        tokenizer = Tokenizer.from_str(spec)
        memo = word_memo(tokenizer, np.uint32)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.nulls(len(batch), pa.int32()), pa.array(encode_texts(batch.column(0), tokenizer, memo, np.uint32), pa.binary())],
                                             names=["size", "tokens"])
        yield pa.RecordBatch.from_arrays([pa.array([tokenizer.get_vocab_size()], pa.int32()), pa.nulls(1, pa.binary())], names=["size", "tokens"])

    rows = drawn.select("t").mapInArrow(released(run), "size int, tokens binary").collect()     # at most `count` short documents
    size = max((r["size"] for r in rows if r["size"] is not None), default=0) or Tokenizer.from_str(spec).get_vocab_size()
    return size, [np.frombuffer(r["tokens"], dtype=np.uint32) for r in rows if r["tokens"]]


def token_table(docs: DataFrame, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id",
                text_col: str = "text", pivots: int = 64) -> DataFrame:
    """(doc_id, tokens, route, mark, df): a row a document with its packed ids, group and
    min-hash; and a row a task with null tokens, whose ``df`` packs the task's document
    frequencies, documents and tokens."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    size, sample = _sample(docs, spec, text_col)
    size = max(size, end_id + 1)
    dtype = np.uint16 if size <= 1 << 16 else np.uint32
    router = Router(sample, size, pivots)
    schema = pa.schema([("doc_id", pa.int64()), ("tokens", pa.binary()), ("route", pa.int32()), ("mark", pa.int32()), ("df", pa.binary())])

    def run(batches):
        tokenizer, memo = _tokenizer(spec, dtype)
        end = np.array([end_id], dtype=dtype).tobytes()
        df = np.zeros(size + 2, dtype=np.int64)
        for batch in batches:
            for some in slices(batch, 1, 2 << 20):
                out = [b + end for b in encode_texts(some.column(1), tokenizer, memo, dtype)]
                lengths = np.array([len(b) for b in out], dtype=np.int64) // np.dtype(dtype).itemsize
                term, tf, start = _distinct_terms(np.frombuffer(b"".join(out), dtype=dtype), lengths)
                df[:size] += np.bincount(term, minlength=size)
                df[size:] += len(out), lengths.sum()
                groups, marks = router.place(term, tf, start, lengths)
                yield pa.RecordBatch.from_arrays([some.column(0).cast(pa.int64()), pa.array(out, pa.binary()), pa.array(groups), pa.array(marks),
                                                  pa.nulls(len(out), pa.binary())], schema=schema)
                del out, term, tf, start
                give_back()
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int32()),
                                          pa.array([df.tobytes()], pa.binary())], schema=schema)

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col)).mapInArrow(released(run), "doc_id bigint, tokens binary, route int, mark int, df binary")


def _statistics(tokens: DataFrame) -> np.ndarray:
    """Document frequency of every token id, then documents, then tokens: one row an
    id reaches the driver, however large the corpus."""
    def run(batches):
        total = None
        for batch in batches:
            for v in batch.column(0).to_pylist():
                a = np.frombuffer(v, dtype=np.int64)
                total = a.copy() if total is None else total + a
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["i", "n"])

    rows = tokens.where("df IS NOT NULL").select("df").mapInArrow(run, "i bigint, n bigint").groupBy("i").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(max((r["i"] for r in rows), default=1) + 1, dtype=np.int64)
    for r in rows:
        out[r["i"]] = r["n"]
    return out


class Bm25Shard:
    """Index over the token ids of a shard's documents: postings of the rarer terms, a dense
    table of the weights of terms in over a quarter of the documents."""

    def __init__(self, docs: list[np.ndarray], df: np.ndarray, n_docs: int, mean: float,
                 k1: float = K1, b: float = B):
        sizes = np.array([len(d) for d in docs], dtype=np.int64)
        term, tf, start = _distinct_terms(np.concatenate(docs), sizes)
        self.n = len(docs)
        doc = np.repeat(np.arange(self.n), np.diff(np.append(start, len(term))))
        idf = np.log1p((n_docs - df[term] + 0.5) / (df[term] + 0.5))
        weight = (idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * sizes[doc] / max(mean, 1e-9)))).astype(np.float32)
        held = np.bincount(term)
        common = np.flatnonzero(held * 4 > self.n)
        column = np.full(len(held), -1, dtype=np.int64)
        column[common] = np.arange(len(common))
        # a document's query: all its terms, the common ones as columns of the table
        dense = column[term] >= 0
        cut = lambda x, of: np.split(x, np.searchsorted(of, np.arange(1, self.n)))
        self.rare, self.often = cut(term[~dense], doc[~dense]), cut(column[term[dense]], doc[dense])
        self.table = np.zeros((self.n, len(common)), dtype=np.float32)
        self.table[doc[dense], column[term[dense]]] = weight[dense]
        term, doc, weight = term[~dense], doc[~dense], weight[~dense]
        by_term = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[by_term], weight[by_term]
        self.ptr = np.searchsorted(term[by_term], np.arange(len(held) + 1))

    def scores(self, seed: int) -> np.ndarray:
        lo, hi = self.ptr[self.rare[seed]], self.ptr[self.rare[seed] + 1]
        size = hi - lo
        at = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        score = np.bincount(self.doc[at], weights=self.weight[at], minlength=self.n)
        query = np.zeros(self.table.shape[1], dtype=np.float32)
        query[self.often[seed]] = 1
        return score + self.table @ query

    def neighbours(self, seed: int, unused: np.ndarray):
        """Unused documents that share a term with the seed, best first, ties by place."""
        score = np.where(unused, self.scores(seed), 0)
        found = np.flatnonzero(score > 0)
        if len(found) > 64:             # most windows are full after a few
            least = -np.partition(-score[found], 48)[48]
            top = found[score[found] >= least]
            yield from top[np.argsort(-score[top], kind="stable")].tolist()
            found = found[score[found] < least]
        yield from found[np.argsort(-score[found], kind="stable")].tolist()


def pack_shard(index: Bm25Shard, sizes: np.ndarray, window: int) -> list[int]:
    """Order of the shard's documents, by greedy filling."""
    unused = np.ones(len(sizes), dtype=bool)
    order: list[int] = []
    filled, nxt, seed = 0, 0, -1
    while len(order) < len(sizes):
        if seed < 0:
            while not unused[nxt]:
                nxt += 1
            seed = nxt
            unused[seed] = False
            order.append(seed)
            filled += int(sizes[seed])
        goal = -(-filled // window) * window
        if filled == goal:
            seed = -1
            continue
        last = -1
        for d in index.neighbours(seed, unused):
            unused[d] = False
            order.append(d)
            filled += int(sizes[d])
            if filled >= goal:
                last = d
                break
        seed = last
    return order


def _pieces(order: list[int], sizes: np.ndarray, window: int) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of a shard."""
    total = int(sizes.sum())
    whole = total // window
    bounds = [(k + 1) * window for k in range(whole)]
    rest = total - whole * window
    for bit in reversed(range(max(rest, 1).bit_length())):
        if rest >> bit & 1:
            bounds.append((bounds[-1] if bounds else 0) + (1 << bit))
    out, seq, at, opened = [], 0, 0, 0
    for d in order:
        start, left = 0, int(sizes[d])
        while left:
            if at == bounds[seq]:
                opened = at
                seq += 1
            n = min(left, bounds[seq] - at)
            out.append((d, start, n, seq, at - opened))
            start, left, at = start + n, left - n, at + n
    return out


def pack(docs: DataFrame, tokenizer_path: str, window: int = 4096, end_id: int = 2, shard_tokens: int = 1_000_000,
         pivots: int = 64, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of all documents in sequences of at most ``window`` tokens (module text), a written
    table; ``with_ids`` adds each piece's token ids as little-endian unsigned 32-bit integers."""
    tokens = written(token_table(docs, tokenizer_path, end_id, id_col, text_col, pivots), "packing-tokens")
    stats = _statistics(tokens)
    df, n_docs, n_tokens = stats[:-2], int(stats[-2]), int(stats[-1])
    dtype = np.uint16 if len(df) <= 1 << 16 else np.uint32
    mean = n_tokens / max(n_docs, 1)

    def solve(ids, held, base):
        sizes = np.array([len(h) for h in held], dtype=np.int64)
        index = Bm25Shard(held, df, n_docs, mean)
        got = _pieces(pack_shard(index, sizes, window), sizes, window)
        raw = [held[d][s:s + n].astype("<u4").tobytes() for d, s, n, _, _ in got]
        cols = [pa.array([ids[d] for d, *_ in got], pa.int64()), pa.array([p[1] for p in got], pa.int64()),
                pa.array([p[2] for p in got], pa.int64()), pa.array([zlib.crc32(r) for r in raw], pa.int64()),
                pa.array([int(sizes[p[0]]) for p in got], pa.int64()), pa.array([base + p[3] for p in got], pa.int64()),
                pa.array([p[4] for p in got], pa.int64())]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        if with_ids:
            cols, names = [*cols, pa.array(raw, pa.binary())], [*names, "ids"]
        return pa.RecordBatch.from_arrays(cols, names=names), base + (got[-1][3] + 1 if got else 0)

    def run(batches):
        base = TaskContext.get().partitionId() << 32
        ids, held, n = [], [], 0
        for batch in batches:
            for i, v in zip(batch.column(0), batch.column(1)):
                a = np.frombuffer(v.as_py(), dtype=dtype)
                ids.append(i.as_py())
                held.append(a)
                n += len(a)
                if n >= shard_tokens:
                    out, base = solve(ids, held, base)
                    yield out
                    ids, held, n = [], [], 0
        if held:
            yield solve(ids, held, base)[0]

    ranges = max(1, min(-(-n_tokens // (2 * shard_tokens)), _MOST_RANGES))      # two shards a task, more where the ranges are at their most
    order = ["route", "mark", "h", "doc_id"]
    dealt = tokens.where("tokens IS NOT NULL").select("doc_id", "tokens", "route", "mark", F.xxhash64("tokens").alias("h"))
    dealt = dealt.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("doc_id", "tokens")
    return written(dealt.mapInArrow(run, PIECES + (", ids binary" if with_ids else "")), "packing-pieces")


def op3_lexical_packing(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), tokenizer_path or public_tokenizers.path("word_bpe_49k.json"))
