"""Personal data: base patterns, and a character BiLSTM-CRF that adds spans (operator 7).

Kinds: email, ip, card, phone.  The base patterns (``base_spans``) run over every whole
text.  A character-level bidirectional LSTM with CRF transitions, trained in numpy from
labelled spans, then adds spans that no base span overlaps.

The network reads the surroundings of every digit and ``@``: each kind holds one of
these characters by definition, so no span can lie elsewhere.  A surrounding (``HALO``
characters to each side, overlapping ones joined) is cut into overlapping windows;
their tag scores are averaged, most weight at a window's centre, and the surrounding
is decoded as one with the CRF.  An added span must hold what its kind is defined by
(``valid``): an ``@`` with a dotted domain, four parts up to 255, 13 to 19 digits
passing Luhn, or 7 to 15 digits.

``fit`` learns from the windows of at most ``max_documents`` documents, a share of them
for each kind, labelled by the base spans or by any given labelling function, and from the
same phone numbers without their country prefix, which the base patterns do not know.
Without a labelled span in the documents that look like holding one there is no network,
and the base spans are the result.

Defined results: a null or empty text has no spans; repeated rows get equal results;
null ids are kept; an empty table gives an empty result; other columns are passed by.
Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phenocast.llm._common import table, written

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]
WINDOW, STRIDE, HALO = 64, 32, 32
_TRIGGER = re.compile("[0-9@]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


# --- base ------------------------------------------------------------------------------------

def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[Span]:
    """Leftmost matches, found from each @ outwards, so long words cost no more than their length."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            last = m.end()
            out.append(("email", start, last))
        # a run that ends at this @ can't reach the next one
        at = text.find("@", max(at + 1, last))
    return out


def base_spans(text: str | None) -> list[Span]:
    """Base spans by kind as listed, then start."""
    if not text:
        return []
    out = _emails(text) if "@" in text else []
    if re.search("[0-9]", text):
        if "." in text:
            out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                d = _digits(m[0])
                if 16 <= len(d) <= 19 and luhn(d):
                    out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def valid(kind: str, text: str) -> bool:
    """What a span that the network adds must hold."""
    d = _digits(text)
    if kind == "email":
        return bool(re.search(r"[^\s@]@[^\s@]+\.[^\s@]", text))
    if kind == "ip":
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    return 13 <= len(d) <= 19 and luhn(d) if kind == "card" else 7 <= len(d) <= 15


# --- network ---------------------------------------------------------------------------------

_TAGS = 1 + 2 * len(KINDS)  # O, then B and I of each kind
_MARKS = " \n\t@.+-()_%,:;/=#*!?\"'[]<>&$"
_N_CHARS = 4 + 10 + len(_MARKS) + 26


def char_ids(text: str) -> np.ndarray:
    """0 padding, 1 other, 2 capital, 3 non-ASCII, then digits, marks and letters."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return _LOOKUP[np.minimum(c, 128)]


def _lookup() -> np.ndarray:
    out = np.ones(129, dtype=np.int64)
    out[128] = 3
    out[65:91] = 2
    out[48:58] = 4 + np.arange(10)
    for i, ch in enumerate(_MARKS):
        out[ord(ch)] = 14 + i
    out[97:123] = 14 + len(_MARKS) + np.arange(26)
    return out


_LOOKUP = _lookup()


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-x))


def init_weights(rng, embed: int = 8, hidden: int = 16) -> dict[str, np.ndarray]:
    def w(*shape):
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    out = {"E": w(_N_CHARS, embed) * 2, "out": w(2 * hidden, _TAGS), "bo": np.zeros(_TAGS, np.float32),
           "T": np.zeros((_TAGS, _TAGS), np.float32), "first": np.zeros(_TAGS, np.float32)}
    for d in "fb":
        out[f"x{d}"], out[f"h{d}"] = w(embed, 4 * hidden), w(hidden, 4 * hidden)
        out[f"b{d}"] = np.zeros(4 * hidden, np.float32)
        out[f"b{d}"][hidden:2 * hidden] = 1
    return out


def _lstm(p: dict, d: str, e: np.ndarray, keep: bool):
    """Hidden states of one direction over e (batch, time, embed); time runs as given."""
    n, t, _ = e.shape
    hid = p[f"h{d}"].shape[0]
    z = e @ p[f"x{d}"] + p[f"b{d}"]
    h, c = np.zeros((n, hid), np.float32), np.zeros((n, hid), np.float32)
    hs, saved = np.empty((n, t, hid), np.float32), []
    for k in range(t):
        g = z[:, k] + h @ p[f"h{d}"]
        s = _sigmoid(g[:, :3 * hid])
        i, f, o, u = s[:, :hid], s[:, hid:2 * hid], s[:, 2 * hid:], np.tanh(g[:, 3 * hid:])
        before = c
        c = f * c + i * u
        tc = np.tanh(c)
        if keep:
            saved.append((h, before, i, f, o, u, tc))
        h = o * tc
        hs[:, k] = h
    return hs, saved


def _lstm_back(p: dict, d: str, e: np.ndarray, saved: list, dhs: np.ndarray, grad: dict) -> np.ndarray:
    n, t, hid = dhs.shape
    dz = np.empty((n, t, 4 * hid), np.float32)
    dh, dc = np.zeros((n, hid), np.float32), np.zeros((n, hid), np.float32)
    for k in reversed(range(t)):
        h0, c0, i, f, o, u, tc = saved[k]
        dh = dh + dhs[:, k]
        dc = dc + dh * o * (1 - tc * tc)
        g = np.concatenate([dc * u * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - u * u)], axis=1)
        dz[:, k] = g
        grad[f"h{d}"] += h0.T @ g
        dh, dc = g @ p[f"h{d}"].T, dc * f
    flat = dz.reshape(-1, 4 * hid)
    grad[f"x{d}"] += e.reshape(-1, e.shape[2]).T @ flat
    grad[f"b{d}"] += flat.sum(axis=0)
    return dz @ p[f"x{d}"].T


def emissions(p: dict, x: np.ndarray, keep: bool = False):
    """Tag scores (batch, time, tags) of character ids (batch, time)."""
    e = p["E"][x]
    f, sf = _lstm(p, "f", e, keep)
    b, sb = _lstm(p, "b", e[:, ::-1], keep)
    h = np.concatenate([f, b[:, ::-1]], axis=2)
    return h @ p["out"] + p["bo"], (e, h, sf, sb)


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis=axis))


def crf_loss(p: dict, s: np.ndarray, y: np.ndarray, mask: np.ndarray):
    """Mean negative log likelihood of tags y, and gradients by s, T and first; masked
    positions lie behind a window's text."""
    n, t, k = s.shape
    a = np.empty((n, t, k))
    a[:, 0] = s[:, 0] + p["first"]
    for i in range(1, t):
        nxt = _lse(a[:, i - 1, :, None] + p["T"][None], 1) + s[:, i]
        a[:, i] = np.where(mask[:, i, None], nxt, a[:, i - 1])
    z = _lse(a[:, -1], 1)
    b = np.zeros((n, t, k))
    for i in range(t - 2, -1, -1):
        back = _lse(p["T"][None] + (s[:, i + 1] + b[:, i + 1])[:, None, :], 2)
        b[:, i] = np.where(mask[:, i + 1, None], back, b[:, i + 1])
    rows = np.arange(n)
    gold = s[rows, 0, y[:, 0]] + p["first"][y[:, 0]]
    ds = np.exp(a + b - z[:, None, None]) * mask[:, :, None]
    dt = np.zeros((k, k))
    dfirst = ds[:, 0].sum(axis=0)
    np.add.at(dfirst, y[:, 0], -1)
    for i in range(1, t):
        m = mask[:, i]
        gold = gold + np.where(m, p["T"][y[:, i - 1], y[:, i]] + s[rows, i, y[:, i]], 0)
        q = np.exp(a[:, i - 1, :, None] + p["T"][None] + (s[:, i] + b[:, i])[:, None, :] - z[:, None, None])
        dt += (q * m[:, None, None]).sum(axis=0)
        np.add.at(dt, (y[m, i - 1], y[m, i]), -1)
    ds[rows[:, None], np.arange(t)[None], y] -= mask
    return float((z - gold).mean()), ds / n, dt / n, dfirst / n


def train(x: np.ndarray, y: np.ndarray, steps: int = 400, batch: int = 48, rate: float = 0.02, seed: int = 7) -> dict[str, np.ndarray]:
    """Weights fitted to windows of character ids and tags, by Adam."""
    rng = np.random.default_rng(seed)
    p = init_weights(rng)
    m1, m2 = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    step = 0
    while step < steps:
        order = rng.permutation(len(x))
        for lo in range(0, len(x), batch):
            at = order[lo:lo + batch]
            xs, ys = x[at], y[at]
            s, (e, h, sf, sb) = emissions(p, xs, keep=True)
            _, ds, dt, dfirst = crf_loss(p, s.astype(np.float64), ys, xs > 0)
            ds = ds.astype(np.float32)
            grad = {k: np.zeros_like(v) for k, v in p.items()}
            grad["T"], grad["first"] = dt.astype(np.float32), dfirst.astype(np.float32)
            flat = ds.reshape(-1, _TAGS)
            grad["out"] = h.reshape(-1, h.shape[2]).T @ flat
            grad["bo"] = flat.sum(axis=0)
            dh = ds @ p["out"].T
            hid = dh.shape[2] // 2
            de = _lstm_back(p, "f", e, sf, dh[:, :, :hid], grad)
            de = de + _lstm_back(p, "b", e[:, ::-1], sb, dh[:, ::-1, hid:], grad)[:, ::-1]
            np.add.at(grad["E"], xs.ravel(), de.reshape(-1, de.shape[2]))
            step += 1
            lr = rate * max(0.0, 1 - (step - 1) / steps)
            for k in p:
                g = np.clip(grad[k], -1, 1)
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.99 * m2[k] + 0.01 * g * g
                p[k] = p[k] - (lr * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return p


# --- windows and decoding --------------------------------------------------------------------

def surroundings(text: str) -> list[tuple[int, int]]:
    """Joined surroundings of all digits and @."""
    out: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - HALO), min(len(text), m.end() + HALO)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _starts(n: int) -> list[int]:
    """Window starts that cover n characters, STRIDE apart, the last one flush with the end."""
    return [0] if n <= WINDOW else [*range(0, n - WINDOW, STRIDE), n - WINDOW]


def tags_of(spans: list[Span], a: int, b: int) -> np.ndarray:
    out = np.zeros(b - a, dtype=np.int64)
    for kind, s, e in reversed(spans):  # kinds listed first win
        s, e = max(s, a), min(e, b)
        if s < e:
            out[s - a:e - a] = 2 + 2 * KINDS.index(kind)
            out[s - a] = 1 + 2 * KINDS.index(kind)
    return out


def training_windows(text: str, spans: list[Span]) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for a, b in surroundings(text):
        ids, tags = char_ids(text[a:b]), tags_of(spans, a, b)
        for s in _starts(b - a):
            x, y = np.zeros(WINDOW, np.int64), np.zeros(WINDOW, np.int64)
            n = min(WINDOW, b - a - s)
            x[:n], y[:n] = ids[s:s + n], tags[s:s + n]
            out.append((x, y))
    return out


_WEIGHT = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)


def viterbi(p: dict, scores: list[np.ndarray]) -> list[np.ndarray]:
    """Best tags of each sequence; sequences of like length are decoded together."""
    out: list = [None] * len(scores)
    order = sorted(range(len(scores)), key=lambda i: len(scores[i]))
    for lo in range(0, len(order), 128):
        at = order[lo:lo + 128]
        t = len(scores[at[-1]])
        s = np.zeros((len(at), t, _TAGS), np.float32)
        size = np.array([len(scores[i]) for i in at])
        for k, i in enumerate(at):
            s[k, :size[k]] = scores[i]
        best, back = s[:, 0] + p["first"], np.zeros((len(at), t, _TAGS), np.int8)
        for i in range(1, t):
            step = best[:, :, None] + p["T"][None]
            live = (i < size)[:, None]
            back[:, i] = np.where(live, step.argmax(axis=1), np.arange(_TAGS)[None])
            best = np.where(live, step.max(axis=1) + s[:, i], best)
        tag = best.argmax(axis=1)
        path = np.zeros((len(at), t), np.int8)
        path[:, -1] = tag
        for i in range(t - 1, 0, -1):
            tag = back[np.arange(len(at)), i, tag]
            path[:, i - 1] = tag
        for k, i in enumerate(at):
            out[i] = path[k, :size[k]]
    return out


def _runs(tags: np.ndarray, a: int) -> list[Span]:
    out, kind, start = [], -1, 0
    for i, t in enumerate([*tags.tolist(), 0]):
        k = (t - 1) // 2 if t else -1
        if kind >= 0 and (k != kind or t % 2 == 1):
            out.append((KINDS[kind], a + start, a + i))
            kind = -1
        if k >= 0 and kind < 0:
            kind, start = k, i
    return out


def network_spans(p: dict, texts: list[str], most: int = 512) -> list[list[Span]]:
    """Decoded spans of each text."""
    out: list[list[Span]] = [[] for _ in texts]
    held, n = [], 0

    def flush():
        x = np.zeros((n, WINDOW), np.int64)
        k = 0
        for _, _, ids, starts in held:
            for s in starts:
                x[k, :min(WINDOW, len(ids) - s)] = ids[s:s + WINDOW]
                k += 1
        e = np.concatenate([emissions(p, x[lo:lo + most])[0] for lo in range(0, n, most)])
        k, scores = 0, []
        for _, _, ids, starts in held:
            total, weight = np.zeros((len(ids), _TAGS), np.float32), np.zeros((len(ids), 1), np.float32)
            for s in starts:
                m = min(WINDOW, len(ids) - s)
                total[s:s + m] += e[k, :m] * _WEIGHT[:m, None]
                weight[s:s + m] += _WEIGHT[:m, None]
                k += 1
            scores.append(total / weight)
        for (i, a, _, _), tags in zip(held, viterbi(p, scores)):
            out[i] += _runs(tags, a)

    for i, text in enumerate(texts):
        for a, b in surroundings(text):
            starts = _starts(b - a)
            held.append((i, a, char_ids(text[a:b]), starts))
            n += len(starts)
            if n >= 4 * most:
                flush()
                held, n = [], 0
    if held:
        flush()
    return out


def _trim(text: str, a: int, b: int) -> tuple[int, int]:
    while a < b and text[a].isspace():
        a += 1
    while b > a and (text[b - 1].isspace() or text[b - 1] in ",.;:"):
        b -= 1
    return a, b


def find_spans(p: dict | None, texts: list[str | None]) -> list[tuple[list[Span], list[Span]]]:
    """Of each text: base spans, and all spans by kind and start."""
    base = [base_spans(t) for t in texts]
    if p is None:
        return [(b, b) for b in base]
    at = [i for i, t in enumerate(texts) if t and _TRIGGER.search(t)]
    full = list(base)
    for i, found in zip(at, network_spans(p, [texts[i] for i in at])):
        spans, text = list(base[i]), texts[i]
        for kind, a, b in found:
            a, b = _trim(text, a, b)
            if valid(kind, text[a:b]) and not any(a < e and s < b for _, s, e in spans):
                spans.append((kind, a, b))
        full[i] = sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1]))
    return list(zip(base, full))


# --- on Spark --------------------------------------------------------------------------------

_HINTS = {"email": "@[A-Za-z0-9-]+[.]", "ip": "[0-9][.][0-9]+[.][0-9]+[.][0-9]", "card": "[0-9]([ -]?[0-9]){15}", "phone": "[+][0-9]"}
_PREFIX = re.compile(r"\+[0-9]{1,3}[ .-]")


def without_prefix(text: str, spans: list[Span]) -> tuple[str, list[Span]] | None:
    """The text with its phone numbers as they are written at home, and its spans there; None
    if no phone number has a country prefix.  The base patterns do not know this form."""
    out, moved, last, gone = [], [], 0, 0
    found = False
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        m = _PREFIX.match(text, a, b) if kind == "phone" and a >= last else None
        if m and len(_digits(text[m.end():b])) >= 7:
            out.append(text[last:a])
            gone += m.end() - a
            moved.append((kind, m.end() - gone, b - gone))
            last, found = m.end(), True
        else:
            moved.append((kind, a - gone, b - gone))
    return ("".join(out) + text[last:], moved) if found else None


def fit(docs: DataFrame, max_documents: int = 600, max_windows: int = 1500, label: Callable[[str], list[Span]] = base_spans,
        id_col: str = "doc_id", text_col: str = "text") -> dict | None:
    """Network trained on labelled spans of a bounded sample (module text).

    A fifth of the documents and windows goes to each kind, those with the least hashes that
    hold it (documents by a plain pattern of the kind), the last fifth to the rest; documents
    with phone numbers count a second time in the form of :func:`without_prefix`.
    """
    share = max_documents // (len(KINDS) + 1)

    def run(batches):
        for batch in batches:
            hs, ks, got = [], [], []
            for t in batch.column(0).to_pylist():
                spans = label(t)
                home = without_prefix(t, spans)
                for text, found in [(t, spans), *([home] if home else [])]:
                    for row in training_windows(text, found):
                        raw = np.concatenate(row).astype(np.int8).tobytes()
                        tags = row[1][row[1] > 0]
                        hs.append(int.from_bytes(hashlib.blake2b(raw, digest_size=7).digest(), "big"))
                        ks.append(int(tags[0] - 1) // 2 if len(tags) else -1)
                        got.append(raw)
            yield pa.RecordBatch.from_arrays([pa.array(hs, pa.int64()), pa.array(ks, pa.int32()), pa.array(got, pa.binary())], names=["h", "k", "window"])

    rows = docs.where(F.col(text_col).rlike("[0-9@]")).select(F.xxhash64(id_col).alias("h"), F.col(text_col).alias("t"))
    hints = [F.col("t").rlike(p) for p in _HINTS.values()]
    hints.append(~(hints[0] | hints[1] | hints[2] | hints[3]))
    n = rows.agg(*[F.count_if(c).alias(f"n{k}") for k, c in enumerate(hints)]).first()
    # a threshold on the hash for each kind, so that few texts are ordered
    place = F.pmod("h", F.lit(1 << 40))
    low = [c & (place < int(min(1.0, 2.0 * share / max(m, 1)) * (1 << 40))) for c, m in zip(hints, n)]
    some = rows.where(low[0] | low[1] | low[2] | low[3] | low[4]).select("h", "t", F.array(*[F.when(c, F.lit(k)) for k, c in enumerate(low)]).alias("ks"))
    some = some.select("h", "t", F.explode(F.filter("ks", lambda k: k.isNotNull())).alias("k"))
    some = some.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("h", "t"))).where(F.col("rn") <= share)    # about 2 * share texts a kind
    windows = written(some.select("t").distinct().mapInArrow(run, "h bigint, k int, window binary"), "pii-windows")
    best = Window.partitionBy("k").orderBy("h", "window")       # windows of at most max_documents documents
    got = (windows.distinct().withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= max_windows // (len(KINDS) + 1))
           .orderBy("h", "window").select("window").collect())
    xy = np.array([np.frombuffer(r["window"], np.int8) for r in got], dtype=np.int64).reshape(-1, 2 * WINDOW)
    if not xy[:, WINDOW:].any():
        return None
    return train(xy[:, :WINDOW], xy[:, WINDOW:])


def _text_of(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def detect(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the base spans' counts and digest, and all spans."""
    schema = "doc_id bigint, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base_sha256 string, spans string"

    def run(batches):
        for batch in batches:
            found = find_spans(model, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(pa.int64()), *(pa.array([sum(s[0] == k for s in b) for b, _ in found], pa.int64()) for k in KINDS),
                pa.array([hashlib.sha256(_text_of(b).encode()).hexdigest() for b, _ in found], pa.string()),
                pa.array([_text_of(f) for _, f in found], pa.string())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col)).mapInArrow(run, schema)


def redact(docs: DataFrame, model: dict | None, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets."""
    at = docs.columns.index(text_col)

    def mask(text, spans):
        out, last = [], 0
        for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
            if a >= last:
                out += [text[last:a], f"<{kind}>"]
            last = max(last, b)
        return "".join(out) + text[last:] if spans else text

    def run(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            texts = [mask(t, full) for t, (_, full) in zip(texts, find_spans(model, texts))]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return detect(docs, fit(docs))
