"""Line dedup by a suffix array over line ids (operator 10), DataFrame functions only.

Every document is a sequence of its non-blank lines.  A run of lines qualifies if it
has at least ``min_words`` words (counted by blanks).  Of every qualifying run that
occurs more than once, at whatever length, the first occurrence stays, by document
id and line, and the lines of all later ones are deleted.

The suffix array is built by distributed prefix doubling: ranks of one-line prefixes
are the order of the distinct line ids, ranks of 2^(k+1)-line prefixes the order of
the distinct pairs (rank of the first 2^k lines, rank of the next 2^k).  Prefixes that
occur once are dropped at once, they lie in no repeated run.  Two runs are looked up
for each position, the shortest qualifying one that starts there and the shortest that
ends there; of a run of T lines, the suffixes with its pair of overlapping ranks are
the interval of the suffix array whose longest common prefix is at least T.  The
interval's least position is the first copy.  Every repeated qualifying run R, of any
length, is a union of such shortest runs: a line with ``min_words`` words from it to
the end of R starts one inside R, one with as many from the start of R to it ends one
inside R, and any other line lies in the one that starts where R does.  A copy of R
copies them all, so the deleted lines are those of the maximal repeated runs, and no
prefix of more than ``min_words`` lines is needed, as a line has a word at least.

Ranks of distinct keys come from a range partitioning and the partitions' counts; only
these counts, one a partition, reach the driver.  A key with over 1/256 of the
positions is joined by broadcast (fewer than 256 of them, of the runs fewer than 512),
so a hot line is no hot task.  Lines are compared by 128-bit hashes.

Defined results: a null text stays null, an empty one empty, and both have no lines;
blank lines are never deleted by themselves; rows that repeat (same id and text) are
one document and get the same result; null ids come last; the first occurrence of a
line is never deleted; an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phenocast.llm._common import few, shuffle_partitions, table, written

_DOC = ["d", "th"]


def _words(line: Column) -> Column:
    line = F.trim(line)
    return F.when(line == "", 0).otherwise(F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1)


def line_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(d, th, s, i, h1, h2, w): non-blank lines, s-th of their document and at index i."""
    lines = F.transform(F.split(F.col(text_col), "\n", -1), lambda x, i: F.struct(
        i.alias("i"), F.xxhash64(x).alias("h1"), F.xxhash64(F.lit(1), x).alias("h2"), _words(x).cast("int").alias("w")))
    return (docs.where(F.col(text_col).isNotNull())
            .select(F.col(id_col).cast("bigint").alias("d"), F.xxhash64(text_col).alias("th"),
                    F.posexplode(F.filter(lines, lambda x: x["w"] > 0)).alias("s", "x"))
            .select("d", "th", "s", "x.i", "x.h1", "x.h2", "x.w"))


def _first() -> Column:
    """Least position: documents by id, nulls last, then by text hash."""
    return F.min(F.struct(F.col("d").isNull().alias("n"), "d", "th", "s"))


def _ranked(classes: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``classes`` (one row a key) of ``total`` rows with ``rank``, the place in the order of the keys."""
    n = shuffle_partitions(classes.sparkSession)
    placed = classes.repartitionByRange(n, *keys).withColumn("part", F.spark_partition_id())
    placed = written(few(placed.withColumn("at", F.row_number().over(Window.partitionBy("part").orderBy(*keys))), total), "lines-ranks")
    counts = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}  # one row a partition
    offset, starts = 0, []
    for part in sorted(counts):
        starts += [F.lit(part), F.lit(offset).cast("bigint")]
        offset += counts[part]
    base = F.element_at(F.create_map(*starts), F.col("part")) if starts else F.lit(0).cast("bigint")
    return placed.withColumn("rank", base + F.col("at")).drop("part", "at")


def _join(rows: DataFrame, classes: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``rows`` with their class; keys with over 1/256 of ``total`` rows by broadcast."""
    hot = classes.where(F.col("n") * 256 > total)
    cold = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(classes.where(F.col("n") * 256 <= total), keys)
    warm = rows.join(F.broadcast(hot), keys)
    return cold.unionByName(warm.select(*cold.columns))


def repeated_lines(docs: DataFrame, min_words: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(d, th, deleted): of each document with later copies, the indices of their lines."""
    lines = written(line_table(docs, id_col, text_col).distinct(), "lines")
    classes = lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1")
    total = lines.count()
    classes = _ranked(classes, ["h1", "h2"], total)
    rows = written(few(_join(lines, classes, ["h1", "h2"], total).select(*_DOC, "s", "i", "w", F.col("rank").alias("r0")), total), "lines-0")
    by_doc = Window.partitionBy(*_DOC).orderBy("s")

    def ahead(name: str, k: int) -> Column:
        """A later line's value, null where a line between occurs once and so is missing."""
        return F.when(F.lead("s", k).over(by_doc) == F.col("s") + k, F.lead(name, k).over(by_doc))

    def behind(name: str, k: int) -> Column:
        return F.when(F.lag("s", k).over(by_doc) == F.col("s") - k, F.lag(name, k).over(by_doc))

    # t, u: lines of the shortest run with min_words words that starts, that ends here; 0 for
    # one that ends here and is the shortest from its start too, so that it is counted once
    more = range(1, min_words)
    rows = rows.select("*", *[ahead("w", j).alias(f"w{j}") for j in more], *[behind("w", j).alias(f"v{j}") for j in more])
    starts, ends = ([sum((F.col(f"{v}{i}") for i in range(1, j + 1)), F.col("w")) for j in range(max(min_words, 1))] for v in "wv")
    rows = (rows.withColumn("t", F.coalesce(*[F.when(x >= min_words, j + 1) for j, x in enumerate(starts)]))
            .withColumn("u", F.coalesce(*[F.when(x >= min_words, F.when(x - F.col("w") >= min_words, j + 1).otherwise(0)) for j, x in enumerate(ends)]))
            .drop(*[f"{v}{j}" for j in more for v in "wv"]))
    levels = max(min_words, 1).bit_length() - 1
    for k in range(levels):
        rows = written(few(rows.withColumn("nxt", ahead(f"r{k}", 1 << k)), total), f"lines-{k}-pairs")
        keys = [f"r{k}", "nxt"]
        pairs = rows.where("nxt IS NOT NULL").groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
        pairs = _ranked(pairs, keys, total).select(*keys, "n", F.col("rank").alias(f"r{k + 1}"))
        paired = _join(rows.where("nxt IS NOT NULL"), pairs, keys, total).select(*_DOC, "s", f"r{k + 1}")
        rows = (rows.drop("nxt").join(paired.select(F.col("d").alias("__d"), F.col("th").alias("__th"), F.col("s").alias("__s"), f"r{k + 1}"),
                                      F.col("d").eqNullSafe(F.col("__d")) & (F.col("th") == F.col("__th")) & (F.col("s") == F.col("__s")), "left")
                .drop("__d", "__th", "__s"))
    def at(name: str, k: int) -> Column:
        return F.lead(name, k).over(by_doc) if k > 0 else F.lag(name, -k).over(by_doc) if k else F.col(name)

    # a run of T lines as two overlapping prefixes of 2^k lines
    a, b, c, d = [F.lit(None).cast("bigint")] * 4
    for t in range(1, min_words + 1):
        k = t.bit_length() - 1
        a = F.when(F.col("t") == t, at(f"r{k}", 0)).otherwise(a)
        b = F.when(F.col("t") == t, at(f"r{k}", t - (1 << k))).otherwise(b)
        c = F.when(F.col("u") == t, at(f"r{k}", 1 - t)).otherwise(c)
        d = F.when(F.col("u") == t, at(f"r{k}", 1 - (1 << k))).otherwise(d)
    runs = written(few(rows.select(*_DOC, "s", "i", F.array(
        F.struct("s", "t", a.alias("a"), b.alias("b")),
        F.struct((F.col("s") - F.col("u") + 1).alias("s"), F.col("u").alias("t"), c.alias("a"), d.alias("b"))).alias("x")), total), "lines-runs")
    whole = (runs.select(*_DOC, F.explode(F.filter("x", lambda x: x["a"].isNotNull() & x["b"].isNotNull())).alias("x"))
             .select(*_DOC, "x.s", "x.t", "x.a", "x.b"))
    copies = written(few(whole.groupBy("t", "a", "b").agg(F.count("*").alias("n"), _first().alias("first")).where("n > 1"), total), "lines-copies")
    later = _join(whole, copies, ["t", "a", "b"], total).where(
        ~(F.col("d").eqNullSafe(F.col("first.d")) & (F.col("th") == F.col("first.th")) & (F.col("s") == F.col("first.s"))))
    gone = later.select(*_DOC, F.explode(F.sequence(F.col("s"), F.col("s") + F.col("t") - 1)).alias("s")).distinct()
    gone = gone.join(runs.select(F.col("d").alias("__d"), F.col("th").alias("__th"), F.col("s").alias("__s"), "i"),
                     F.col("d").eqNullSafe(F.col("__d")) & (F.col("th") == F.col("__th")) & (F.col("s") == F.col("__s")))
    return few(gone.groupBy(*_DOC).agg(F.collect_list("i").alias("deleted")), total)


def dedup_lines(docs: DataFrame, min_words: int = 10, id_col: str = "doc_id", text_col: str = "text", n_chars_col: str | None = "n_chars",
                report: bool = False) -> DataFrame:
    """``docs`` without later copies of repeated line runs, same columns; ``n_chars_col``
    is kept up.  ``report`` adds ``n_lines`` (non-blank) and ``n_deleted``, in place of columns named so."""
    tag = uuid.uuid4().hex              # helper columns that no column of ``docs`` is named like
    doc, at, lost, new, cut = (f"{c}_{tag}" for c in ("doc", "hash", "gone", "text", "lines"))
    gone = written(repeated_lines(docs, min_words, id_col, text_col), "lines-deleted")
    gone = gone.select(F.col("d").alias(doc), F.col("th").alias(at), F.col("deleted").alias(lost))
    both = docs.join(gone, F.col(id_col).cast("bigint").eqNullSafe(F.col(doc)) & (F.xxhash64(text_col) == F.col(at)), "left")
    lines = F.split(F.col(text_col), "\n", -1)
    # linear in the lines: indices by a hash set, then lines by index
    text = F.when(F.col(lost).isNull(), F.col(text_col)).otherwise(
        F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(lost)), lambda i: F.get(F.col(cut), i)), "\n"))
    both = both.withColumn(cut, F.when(F.col(lost).isNotNull(), lines)).withColumn(new, text)
    out = []
    for c in docs.columns:
        if c == text_col:
            out.append(F.col(new).alias(c))
        elif c == n_chars_col:
            kind = docs.schema[c].dataType
            out.append(F.when(F.col(lost).isNull(), F.col(c)).otherwise(F.length(new)).cast(kind).alias(c))
        elif not (report and c in ("n_lines", "n_deleted")):
            out.append(F.col(c))
    if report:
        n = F.size(F.filter(lines, lambda x: F.trim(x) != ""))
        out += [F.coalesce(n, F.lit(0)).cast("bigint").alias("n_lines"),
                F.coalesce(F.size(lost), F.lit(0)).cast("bigint").alias("n_deleted")]
    return both.select(*out)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, n_chars_col=None, report=True).select("doc_id", "n_lines", "n_deleted", "text")


OP10_SQL = """
WITH RECURSIVE l AS (SELECT doc_id, i, trim(x, ' ') AS x, length(trim(x, ' ')) - length(replace(trim(x, ' '), ' ', '')) + 1 AS w, line
           FROM (SELECT doc_id, unnest(range(0, len(string_split(text, chr(10))))) AS i, unnest(string_split(text, chr(10))) AS x,
                        unnest(string_split(text, chr(10))) AS line FROM documents)),
m AS (SELECT doc_id, i, line, w, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS s, row_number() OVER (ORDER BY doc_id, i) AS pos
      FROM l WHERE x <> ''),
n AS (SELECT *, min(pos) OVER (PARTITION BY line) AS lid, count(*) OVER (PARTITION BY line) AS c FROM m),
r(doc_id, s, pos, k, w, cls) AS (
  SELECT doc_id, s, pos, CAST(1 AS BIGINT), CAST(w AS BIGINT), lid FROM n WHERE c > 1
  UNION ALL
  SELECT doc_id, s, pos, k, w, f FROM (
    SELECT r.doc_id, r.s, r.pos, r.k + 1 AS k, CAST(r.w + x.w AS BIGINT) AS w,
           min(r.pos) OVER (PARTITION BY r.cls, x.lid) AS f, count(*) OVER (PARTITION BY r.cls, x.lid) AS c
    FROM r JOIN n x ON x.pos = r.pos + r.k AND x.doc_id = r.doc_id AND x.c > 1) t WHERE c > 1),
longest AS (SELECT doc_id, s, max(k) AS k FROM r WHERE w >= 10 AND cls <> pos GROUP BY doc_id, s),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + k)) AS s FROM longest),
gi AS (SELECT n.doc_id, n.i FROM gone JOIN n ON gone.doc_id = n.doc_id AND gone.s = n.s),
kept AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS text FROM l LEFT JOIN gi ON l.doc_id = gi.doc_id AND l.i = gi.i
         WHERE gi.i IS NULL GROUP BY l.doc_id),
nd AS (SELECT doc_id, count(*) AS n_deleted FROM gi GROUP BY doc_id),
nl AS (SELECT doc_id, count(*) AS n_lines FROM n GROUP BY doc_id)
SELECT d.doc_id, coalesce(nl.n_lines, 0) AS n_lines, coalesce(nd.n_deleted, 0) AS n_deleted,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text
FROM documents d LEFT JOIN nl ON d.doc_id = nl.doc_id LEFT JOIN nd ON d.doc_id = nd.doc_id LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
