"""Hierarchical language identification (operator 8).

First the language family is predicted, then one-versus-one linear support vector
machines separate the languages within that family.  Features are hashed byte
2-grams and 3-grams of the whole text (letters lower-cased, everything that is
ASCII and no letter read as a space), as square roots of relative frequencies, so
a text's length does not matter.

Every labelled row is learned from.  The rows are dealt by hash to groups of about
``piece``; a language that is rare lends its rows to several groups, so that each group
has ``piece`` / languages of them (all, if there are fewer), at most doubling the rows.
The machines are fitted in each group and their weights averaged, by the rows of the two
languages in the group; the sums are integers, so the order of adding does not matter.
Machines are sent and added in parts of ``_PART`` weights.
Only the averaged machines reach the driver.

Defined results: ``und`` with score 0 for a null text, a text without any letter,
or if no labelled row could be learned from; with a single learned language every
other text gets it with score 1; rows with a null id or language are not learned
from but are predicted; repeated rows get equal results; other columns are passed
by.  Score: the logistic of the smallest margin won on the way, 0 to 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenocast.llm._common import released, shuffle_partitions, slices, table

#: ISO 639-1 codes by family; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "uralic": "et fi hu",
    "indo-aryan": "bn gu hi mr ne pa ur",
    "turkic": "az kk ky tr tt uz",
}
_BI, _TRI = 1 << 12, 1 << 13
_DIM = _BI + _TRI
_FOLD = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_PIECE = 1 << 22
_STEPS = 1 << 24
_PART = 512
_SUMS = "family string, a string, b string, part int, n bigint, w binary"
Model = dict


def family_of(lang: str) -> str:
    code = lang.lower().split("-")[0].split("_")[0]
    return next((f for f, codes in FAMILIES.items() if code in codes.split()), f"only {lang}")


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def features(text: str) -> np.ndarray:
    data = b" " + b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_FOLD).split()) + b" "
    raw = np.frombuffer(data, dtype=np.uint8)
    counts = np.zeros(_DIM)
    for lo in range(0, len(raw), _PIECE):  # bounded memory; neighbours overlap by two bytes
        b = raw[lo:lo + _PIECE + 2].astype(np.uint32)
        two = (b[:-1] << 8) | b[1:]
        three = (two[:-1] << 8) | b[2:]
        if lo + _PIECE + 2 < len(raw):
            two = two[:-1]
        counts[:_BI] += np.bincount((two * np.uint32(2654435761)) >> np.uint32(20), minlength=_BI)
        counts[_BI:] += np.bincount((three * np.uint32(2654435761)) >> np.uint32(19), minlength=_TRI)
    counts[:_BI] /= max(counts[:_BI].sum(), 1)
    counts[_BI:] /= max(counts[_BI:].sum(), 1)
    return np.sqrt(counts).astype(np.float32)


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, epochs: int = 30, seed: int = 0, rows: np.ndarray | None = None) -> np.ndarray:
    """Linear SVM (squared hinge, weights then bias) by dual coordinate descent on the given
    rows of ``x`` (all by default); y is +1 or -1, one a row that is used."""
    rows = np.arange(len(x)) if rows is None else rows
    alpha, w, bias = np.zeros(len(rows)), np.zeros(x.shape[1], dtype=x.dtype), 0.0
    diag = 1.0 / (2.0 * c)
    q = np.array([float(x[i] @ x[i]) for i in rows]) + 1.0 + diag
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)).tolist():
            row = x[rows[i]]
            g = y[i] * (float(row @ w) + bias) - 1.0 + diag * alpha[i]
            new = max(alpha[i] - g / q[i], 0.0)
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w += np.float32(step) * row
                bias += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return np.append(w, np.float32(bias))


def _one_versus_one(x: np.ndarray, names: np.ndarray, mine: np.ndarray) -> list[tuple[str, str, int, np.ndarray]]:
    """(label, label, rows, machine) of each two labels of the rows ``mine``; none are copied."""
    labels = sorted(set(names[mine].tolist()))
    out = []
    for i, a in enumerate(labels):
        for b in labels[i + 1:]:
            rows = mine[(names[mine] == a) | (names[mine] == b)]
            out.append((a, b, len(rows), fit_svm(x, np.where(names[rows] == a, 1.0, -1.0), rows=rows)))
    return out


def _group_machines(got: list[tuple[str, np.ndarray, np.ndarray]], total: dict) -> None:
    """The machines of one group of (language, feature numbers, values), added to (family or
    None, label, label) -> (rows, weights times rows, in steps of 1 / _STEPS)."""
    x = np.zeros((len(got), _DIM), dtype=np.float32)
    for i, (_, at, value) in enumerate(got):
        x[i, at] = value
    langs = np.array([lang for lang, _, _ in got], dtype=object)
    fams = np.array([family_of(lang) for lang in langs], dtype=object)
    found = [(None, *m) for m in _one_versus_one(x, fams, np.arange(len(got)))]
    for f in sorted(set(fams.tolist())):
        mine = np.flatnonzero(fams == f)
        if len(set(langs[mine].tolist())) > 1:
            found += [(f, *m) for m in _one_versus_one(x, langs, mine)]
    for f, a, b, n, w in found:
        n_all, w_all = total.get((f, a, b), (0, 0))
        total[f, a, b] = n_all + n, w_all + np.rint(w.astype(np.float64) * (n * _STEPS)).astype(np.int64)


def _sums(total: dict):
    """Batches of rows (family, label, label, part, rows, weights) of what ``_group_machines`` has added."""
    for (f, a, b), (n, w) in total.items():
        parts = [w[lo:lo + _PART].tobytes() for lo in range(0, len(w), _PART)]
        yield pa.RecordBatch.from_arrays([*(pa.array([k] * len(parts), pa.string()) for k in (f, a, b)), pa.array(range(len(parts)), pa.int32()),
                                          pa.array([n] * len(parts), pa.int64()), pa.array(parts, pa.binary())],
                                         names=["family", "a", "b", "part", "n", "w"])


def _added(batches):
    """The rows of ``_sums`` of all tasks, added by machine and part."""
    total: dict = {}
    for batch in batches:
        for f, a, b, part, n, w in zip(*(c.to_pylist() for c in batch.columns)):
            n_all, w_all = total.get((f, a, b, part), (0, 0))
            total[f, a, b, part] = n_all + n, w_all + np.frombuffer(w, np.int64)
    for (f, a, b, part), (n, w) in total.items():
        yield pa.RecordBatch.from_arrays([*(pa.array([k], pa.string()) for k in (f, a, b)), pa.array([part], pa.int32()), pa.array([n], pa.int64()),
                                          pa.array([w.tobytes()], pa.binary())], names=["family", "a", "b", "part", "n", "w"])


def fit_languages(docs: DataFrame, learn, piece: int = 1000, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang") -> Model:
    """Machines learned from all rows where ``learn`` holds (module text)."""
    spark = docs.sparkSession
    rows = docs.where(learn & F.col(id_col).isNotNull() & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    rows = rows.select(F.xxhash64(id_col).alias("h"), F.col(text_col).alias("t"), F.col(lang_col).alias("lang"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row a language
    if not counts:
        return {"families": [], "within": {}, "langs": {}}
    groups, quota = -(-sum(counts.values()) // piece), max(piece // len(counts), 2)
    copies = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, -(-groups * min(n, quota) // n))])
    dealt = rows.withColumn("g", F.explode(F.sequence(F.lit(0), F.element_at(copies, F.col("lang")) - 1)))
    dealt = dealt.withColumn("g", F.pmod(F.col("h") + F.col("g"), F.lit(groups))).withColumn("k", F.xxhash64("h", "t", "lang"))
    dealt = dealt.repartition(min(groups, shuffle_partitions(spark)), "g").sortWithinPartitions("g", "k").select("g", "lang", "t")

    def run(batches):
        total, got, now = {}, [], None
        for batch in batches:
            for lo in range(0, len(batch), 64):
                for g, lang, t in zip(*(c.to_pylist() for c in batch.slice(lo, 64).columns)):
                    if got and (g != now or len(got) >= 4 * piece):     # more only where many rows are copies of one
                        _group_machines(got, total)
                        got = []
                    now = g
                    f = features(t)
                    at = np.flatnonzero(f).astype(np.uint16)
                    got.append((lang, at, f[at]))
        if got:
            _group_machines(got, total)
        yield from _sums(total)

    sums = dealt.mapInArrow(released(run), _SUMS).repartition(min(groups, shuffle_partitions(spark)), "family", "a", "b", "part")
    found: dict = {}
    for r in sums.mapInArrow(_added, _SUMS).collect():        # a machine each two labels
        found.setdefault((r["family"], r["a"], r["b"], r["n"]), {})[r["part"]] = bytes(r["w"])
    machines: dict = {}
    for (f, a, b, n), w in found.items():
        w = np.frombuffer(b"".join(w[k] for k in sorted(w)), np.int64)
        machines.setdefault(f, []).append((a, b, (w / (n * _STEPS)).astype(np.float32)))
    langs: dict = {}
    for lang in sorted(counts):
        langs.setdefault(family_of(lang), []).append(lang)
    by_name = {f: sorted(some, key=lambda m: m[:2]) for f, some in machines.items()}
    return {"families": by_name.get(None, []), "within": {f: by_name.get(f, []) for f in sorted(langs)}, "langs": langs}


def _vote(x: np.ndarray, machines: list[tuple[str, str, np.ndarray]], labels: list[str]) -> tuple[list[str], np.ndarray]:
    """Of each row the label with most votes (then the larger sum of margins, then
    the first), and the smallest margin by which it won."""
    if len(labels) == 1:
        return labels * len(x), np.full(len(x), np.inf)
    at = {a: i for i, a in enumerate(labels)}
    votes, margins = np.zeros((len(x), len(labels))), np.zeros((len(x), len(labels)))
    least = np.full((len(x), len(labels)), np.inf)
    for a, b, w in machines:
        m = x @ w[:-1] + w[-1]
        votes[:, at[a]] += m >= 0
        votes[:, at[b]] += m < 0
        for lab, v in ((a, m), (b, -m)):
            margins[:, at[lab]] += v
            least[:, at[lab]] = np.minimum(least[:, at[lab]], v)
    best = np.array([max(range(len(labels)), key=lambda k: (votes[i, k], margins[i, k], -k)) for i in range(len(x))], dtype=int)
    return [labels[k] for k in best], least[np.arange(len(x)), best]


def predict(model: Model, texts) -> tuple[list[str], list[float]]:
    """Languages and scores of a list or an Arrow array of texts, read a few at a time."""
    langs, scores = ["und"] * len(texts), [0.0] * len(texts)
    if not model["within"]:
        return langs, scores
    for lo in range(0, len(texts), 64):
        some = texts[lo:lo + 64]
        some = some if isinstance(some, list) else some.to_pylist()
        rows = [lo + i for i, t in enumerate(some) if has_letter(t)]
        if not rows:
            continue
        x = np.stack([features(some[i - lo]) for i in rows]).astype(np.float64)
        fams, m1 = _vote(x, model["families"], sorted(model["within"]))
        for f in set(fams):
            mine = np.array([k for k, g in enumerate(fams) if g == f])
            names, m2 = _vote(x[mine], model["within"][f], model["langs"][f])
            p = 1.0 / (1.0 + np.exp(-3.0 * np.minimum(m1[mine], m2)))
            for k, name, s in zip(mine.tolist(), names, p.tolist()):
                langs[rows[k]], scores[rows[k]] = name, s
    return langs, scores


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    def run(batches):
        for batch in batches:
            langs, scores = predict(model, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    return (docs.select(F.col(id_col).cast("bigint"), F.col(text_col))
            .mapInArrow(released(run), "doc_id bigint, lang_pred string, score double"))


def accepted(docs: DataFrame, model: Model, text_col: str = "text", min_score: float = 0.0) -> DataFrame:
    """``docs`` without those that are rejected: ``und``, or a score under ``min_score``."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for some in slices(batch, at):
                langs, scores = predict(model, some.column(at))
                yield some.filter(pa.array([g != "und" and s >= min_score for g, s in zip(langs, scores)], pa.bool_()))

    return docs.mapInArrow(released(run), docs.schema)


def fold(id_col: str = "doc_id"):
    """Column: remainder of the CRC-32 of the id's text by 4."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_languages(docs, fold() != 2)
    return (identify(docs, model).withColumn("held_out", F.coalesce(fold() == 2, F.lit(False)))
            .select("doc_id", "held_out", "lang_pred", "score"))
