"""Benchmark decontamination with a generalised suffix automaton (operator 9).

The normalised words of all benchmark items form one generalised suffix
automaton.  Documents are streamed through it: at every word the automaton
gives the longest suffix of the document that occurs in some item.  Where that
match is at least ``window`` words long, its words are hit; an item shorter
than a window must match whole.

What is sent to the tasks has a bound: items are read in blocks of at most
``block_words`` words (a longer item in pieces that share ``window - 1`` words, so no
window is lost), each block gives one automaton, and the documents are matched against
one block after the other.  The driver holds two blocks and one automaton, a task one
automaton; what was found so far is written beside the documents between two passes.
A benchmark of one block takes one pass and writes nothing.

Words: A-Z lower-cased, then runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``.

Defined results: a null or empty text has no words and is never hit; an item
without words (or null) has no window; items with a null id hit words but are
not listed; rows that repeat are treated one by one and get equal results; an
empty benchmark hits nothing; columns other than those named are passed by.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenocast.llm._common import released, slices, table, utf8, written

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
DIGEST = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"


def words(text: str | None) -> list[bytes]:
    return utf8(text).translate(_FOLD).split()


class SuffixAutomaton:
    """Generalised suffix automaton over word ids, with the items of each state."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.length, self.link, self.next = [0], [-1], [{}]
        pairs: set[int] = set()
        coded = []
        for item, ws in items:
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in ws]
            if not ids:
                continue
            coded.append((item, ids))
            pairs.update((a << 32) | b for a, b in zip(ids, ids[1:]))
            last = 0
            for c in ids:
                last = self._extend(last, c)
        self.pairs = np.array(sorted(pairs), dtype=np.int64)
        self.items: dict[int, set] = {}     # of the states that hold a window
        self.short: dict[int, list[tuple[int, str | None]]] = {}
        for item, ids in coded:
            s = 0
            for c in ids:
                s = self.next[s][c]
                u = s
                while u > 0 and self.length[u] >= window and item not in self.items.setdefault(u, set()):
                    self.items[u].add(item)
                    u = self.link[u]
            if len(ids) < window:
                self.short.setdefault(s, []).append((len(ids), item))
        self.shortest = min([window, *(len(ids) for _, ids in coded)])

    def _extend(self, last: int, c: int) -> int:
        length, link, nxt = self.length, self.link, self.next
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._split(last, c, q)
        cur = len(length)
        length.append(length[last] + 1)
        link.append(0)
        nxt.append({})
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, c, q)
        return cur

    def _split(self, p: int, c: int, q: int) -> int:
        length, link, nxt = self.length, self.link, self.next
        clone = len(length)
        length.append(length[p] + 1)
        link.append(link[q])
        nxt.append(dict(nxt[q]))
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = clone
            p = link[p]
        link[q] = clone
        return clone

    def stream(self, ids: list[int]):
        """Of every position: (state, length of the longest match that ends there)."""
        length, link, nxt = self.length, self.link, self.next
        s = n = 0
        for c in ids:
            while s > 0 and c not in nxt[s]:
                s = link[s]
                n = length[s]
            if c in nxt[s]:
                s = nxt[s][c]
                n += 1
            yield s, n

    def hits(self, ids: list[int]) -> tuple[list[tuple[int, int]], set]:
        """Word intervals inside occurring windows, and the items these are of."""
        spans, items = [], set()
        length, link, window = self.length, self.link, self.window
        for p, (s, n) in enumerate(self.stream(ids)):
            if n < self.shortest:
                continue
            if n >= window:
                spans.append((p - n + 1, p + 1))
                u = s
                while length[link[u]] >= window:
                    u = link[u]
                items |= self.items.get(u, set())
            if self.short:
                u = s
                while u > 0:
                    for m, item in self.short.get(u, ()):
                        if m <= n:
                            spans.append((p - m + 1, p + 1))
                            items.add(item)
                    u = link[u]
        return spans, items

    def match(self, docs: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], set]]:
        """``hits`` of each document, walking only the runs that can hold a window.

        Inside an occurring window every word is known and every two neighbours
        follow each other in some item, so all other positions are passed over.
        """
        out = [([], set()) for _ in docs]
        sizes = np.array([len(d) for d in docs], dtype=np.int64)
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(docs) else 0
        if not total or not self.vocab:
            return out
        get = self.vocab.get
        ids = np.fromiter((i for d in docs for i in map(get, d, repeat(0))), dtype=np.int64, count=total)
        first = np.zeros(total + 1, dtype=bool)
        first[ends - sizes] = True
        first = first[:total]
        if self.shortest == 1:
            good, reach = ids > 0, 0
        else:
            code = (ids[:-1] << 32) | ids[1:]
            at = np.minimum(np.searchsorted(self.pairs, code), max(len(self.pairs) - 1, 0))
            good = np.zeros(total, dtype=bool)
            if len(self.pairs):
                good[1:] = (self.pairs[at] == code) & ~first[1:]
            reach = 1
        if self.shortest == 1:
            cut = np.flatnonzero(good & first)
        edge = np.diff(np.concatenate(([0], good.astype(np.int8), [0])))
        starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if self.shortest == 1 and len(cut):
            # runs of known words must not run on into the next document
            cut = cut[~np.isin(cut, starts)]
            starts, stops = np.sort(np.concatenate((starts, cut))), np.sort(np.concatenate((stops, cut)))
        keep = stops - starts >= self.shortest - reach
        ends_list = ends.tolist()
        for a, b in zip(starts[keep].tolist(), stops[keep].tolist()):
            d = bisect_right(ends_list, a)
            base = ends_list[d] - len(docs[d])
            a -= reach
            spans, items = self.hits(ids[a:b].tolist())
            if spans:
                out[d][0].extend((x + a - base, y + a - base) for x, y in spans)
                out[d][1].update(items)
        return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def blocks(benchmark: DataFrame, window: int = 10, item_col: str = "item_id", text_col: str = "text",
           block_words: int = 500_000):
    """(item, words) in lists of at most ``block_words`` words, read one after the other."""
    most = max(block_words, window)
    rows = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).alias("t"))
    block, n = [], 0
    for r in rows.toLocalIterator():
        ws = words(r["t"])
        if not ws:
            continue
        step = most - window + 1
        for at in range(0, len(ws) - window + 1, step) if len(ws) > most else (0,):
            piece = ws[at:at + most]
            if block and n + len(piece) > most:
                yield block
                block, n = [], 0
            block.append((r["i"], piece))
            n += len(piece)
    if block:
        yield block


def _groups(texts: list[str | None], most: int = 4_000_000):
    """Runs of (position, words) of about ``most`` characters, to bound memory."""
    part, n = [], 0
    for i, t in enumerate(texts):
        part.append((i, words(t)))
        n += len(t or "")
        if n >= most:
            yield part
            part, n = [], 0
    if part:
        yield part


def _matches(texts: list[str | None], model: SuffixAutomaton,
             before: list[tuple[list[int], list]] | None) -> list[tuple[int, list[tuple[int, int]], set]]:
    """Of each text: its number of words, merged hit intervals, items; with those found before."""
    out = []
    for part in _groups(texts):
        found = model.match([d for _, d in part])
        for (i, d), (spans, items) in zip(part, found):
            if before:
                ends, old = before[i]
                spans, items = [*spans, *zip(ends[::2], ends[1::2])], items.union(old)
            out.append((len(d), merged(spans), items))
    return out


def _matched(docs: DataFrame, at: int, benchmark: DataFrame, window: int, item_col: str, item_text_col: str,
             block_words: int, finish, schema) -> DataFrame:
    """``finish(batch, found)`` over all rows, after a pass for each block of the benchmark.

    ``at`` is the place of the text; between passes, the ends of the hit intervals and
    the items found so far stand in two more columns.
    """
    width = len(docs.columns)
    tag = max((len(c) for c in docs.columns), default=0) * "_"    # longer than any given name
    carry = T.StructType([*docs.schema.fields, T.StructField(f"{tag}ends", T.ArrayType(T.LongType())),
                          T.StructField(f"{tag}items", T.ArrayType(T.StringType()))])

    def one_pass(model, last):
        def run(batches):
            for batch in (some for whole in batches for some in slices(whole, at)):
                before = None
                if batch.num_columns > width:
                    before = list(zip(batch.column(width).to_pylist(), batch.column(width + 1).to_pylist()))
                    batch = batch.select(list(range(width)))
                found = _matches(batch.column(at).to_pylist(), model, before)
                if last:
                    yield finish(batch, found)
                else:
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns, pa.array([[x for s in spans for x in s] for _, spans, _ in found], pa.list_(pa.int64())),
                         pa.array([list(items) for _, _, items in found], pa.list_(pa.string()))],
                        names=carry.names)
        return released(run)

    rest = blocks(benchmark, window, item_col, item_text_col, block_words)
    block, frame = next(rest, []), docs
    while (following := next(rest, None)) is not None:
        frame = written(frame.mapInArrow(one_pass(SuffixAutomaton(block, window), False), carry), "decontaminate")
        block = following
    return frame.mapInArrow(one_pass(SuffixAutomaton(block, window), True), schema)


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id",
                       text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                       block_words: int = 500_000) -> DataFrame:
    """Per document: words, hit words, items with occurring windows (module text)."""
    def digest(batch, found):
        hit = [sum(b - a for a, b in spans) for _, spans, _ in found]
        items = [sorted(i for i in x if i is not None) for _, _, x in found]
        return pa.RecordBatch.from_arrays([
            batch.column(0).cast(pa.int64()), pa.array([n for n, _, _ in found], pa.int64()), pa.array(hit, pa.int64()),
            pa.array([len(i) for i in items], pa.int64()),
            pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in items], pa.string()),
            pa.array([h > 0 for h in hit], pa.bool_())],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return _matched(rows, 1, benchmark, window, item_col, item_text_col, block_words, digest, DIGEST)


def _cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans and what stands between them."""
    at = [m.span() for m in _WORD.finditer(text)]
    out, last = [], 0
    for a, b in spans:
        out.append(text[last:at[a][0]])
        last = at[b - 1][1]
    return "".join(out) + text[last:]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.5,
                  text_col: str = "text", n_chars_col: str | None = "n_chars",
                  item_col: str = "item_id", item_text_col: str = "text", block_words: int = 500_000) -> DataFrame:
    """``docs`` without benchmark passages, same columns.

    Spans whose match reaches the length limit (``window`` words) are removed
    from the text; a document of which more than ``max_coverage`` of the words
    are hit is removed whole.  All others stay as they are.
    """
    at = docs.columns.index(text_col)
    chars = docs.columns.index(n_chars_col) if n_chars_col in docs.columns else None

    def clean(batch, found):
        if not any(spans for _, spans, _ in found):
            return batch
        texts = batch.column(at).to_pylist()
        keep = [sum(b - a for a, b in spans) <= max_coverage * n for n, spans, _ in found]
        texts = [_cut(t, spans) if spans else t for t, (_, spans, _) in zip(texts, found)]
        cols = list(batch.columns)
        if chars is not None:
            old = batch.column(chars).to_pylist()
            cols[chars] = pa.array([len(t) if spans else o for o, t, (_, spans, _) in zip(old, texts, found)],
                                   batch.schema.field(chars).type)
        cols[at] = pa.array(texts, batch.schema.field(at).type)
        return pa.RecordBatch.from_arrays(cols, schema=batch.schema).filter(pa.array(keep))

    return _matched(docs, at, benchmark, window, item_col, item_text_col, block_words, clean, docs.schema)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SPLIT = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")
OP9_SQL = f"""
WITH dw AS (SELECT doc_id, {_SPLIT} AS w FROM documents),
iw AS (SELECT item_id, {_SPLIT} AS w FROM benchmark),
ip AS (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p
       FROM iw WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS s FROM ip),
ks AS (SELECT DISTINCT k FROM win),
dp AS (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS p FROM dw JOIN ks ON len(w) >= k),
dwin AS (SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS s FROM dp),
h AS (SELECT doc_id, p, dwin.k AS k, item_id FROM dwin JOIN win ON dwin.s = win.s AND dwin.k = win.k),
pos AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS s
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM h) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(dw.w) AS BIGINT) AS n_words, CAST(coalesce(pos.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(it.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(it.s, '')) AS items_sha256,
       coalesce(pos.n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos ON dw.doc_id = pos.doc_id LEFT JOIN it ON dw.doc_id = it.doc_id
"""
