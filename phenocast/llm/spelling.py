"""Spelling variants by a dictionary of trie-node pairs (operator 13).

The nodes of the trie of all words and of the trie of all reversed words are numbered.
Of a word of L letters the i-th prefix node and the node of the suffix that leaves out
letter i are its i-th skipped pair, the i-th prefix node and the node of the whole rest
its i-th whole pair.  Two words share a skipped pair exactly if they differ by one
replaced letter there; a whole pair of one word is a skipped pair of another exactly if
the other has one more letter there.  So joining on the two integers gives the exact
neighbours at edit distance one.  A pair belongs to at most one word as a whole pair, and
as a skipped pair to one word a letter of the alphabet, so no group of the join grows with
the data.  A word with equal adjacent letters counts as an insertion only at the first.

Trie nodes are numbered where the sorted words lie: a task walks a range of them, a word
shares the nodes of its common prefix with the word before it and opens new ones below.
Nodes that reach over the border of two ranges get their numbers from the border words,
two a range; these alone pass through the driver.

A word's form is its neighbour with the largest count, ties to the smallest in code-point
order, if that count is at least ``ratio`` times its own.  Words are numbered by falling
count and word, so the best neighbour is the least number.  ``root`` follows the forms to
the last one; counts grow by ``ratio`` a step, so doubling the steps ends in a few rounds.

Defined results: a null text has no words; a null id counts as an empty one where an id
is used; very long words are words like others (work grows with their length); repeated
rows count again; an empty table, or one without words, gives no row; other columns play
no part.
"""

from __future__ import annotations

import string

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from phenocast.llm._common import shuffle_partitions, table, written
from phenocast.llm.numbering import numbered
from phenocast.llm.sharding import CRC_TABLE_SQL, crc32_sql

WORD = "[A-Za-zÀ-ÿ]"


def _common(a: str, b: str, least: int = 0) -> int:
    """Length of the common prefix, known to be ``least`` or more."""
    n = min(len(a), len(b))
    if a[least:n] == b[least:n]:
        return n
    lo, hi = least, n                      # a[:lo] == b[:lo], a[:hi] != b[:hi]
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def border_numbers(ranges: list[tuple[int, str, str]]) -> dict[int, tuple[str, list[int], list[int]]]:
    """Of each range (number, first and last word): its last word, and the numbers of the nodes
    that its first word shares with the range before, its last word with the range after.

    A shared node is numbered by the first border that it reaches over and its depth.
    """
    ranges = sorted(ranges)
    left: list[list[int]] = [[]]
    for k in range(1, len(ranges)):
        depth = _common(ranges[k - 1][2], ranges[k][1])
        older = left[-1][:min(_common(ranges[k - 1][1], ranges[k][1]), depth)]
        left.append(older + [-(ranges[k][0] << 32 | d) for d in range(len(older) + 1, depth + 1)])
    return {r[0]: (r[2], left[k], left[k + 1] if k + 1 < len(ranges) else []) for k, r in enumerate(ranges)}


def trie_nodes(words: DataFrame, key: Column, out: str) -> DataFrame:
    """(id, ``out``, fresh): of each row of ``words`` the numbers of its key's trie nodes, root
    first, and for each letter of the key whether the letter before it is another."""
    n = shuffle_partitions(words.sparkSession)
    placed = (words.select("id", key.alias("key")).repartitionByRange(n, "key").sortWithinPartitions("key")
              .withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)))
    placed = written(placed, "spelling-sorted")
    borders = border_numbers([tuple(r) for r in placed.groupBy("part").agg(F.min("key"), F.max("key")).collect()])  # a row a range
    kind = pa.schema([("id", pa.int64()), (out, pa.list_(pa.int64())), ("fresh", pa.list_(pa.bool_()))])

    def run(batches):
        part, before, path, used = None, "", [0], 0
        for batch in batches:
            ids, nodes, fresh, held = [], [], [], 0
            for i, word, p in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if p != part:
                    part, before, path, used = p, "", [0], 0
                    last, left, right = borders[p]
                    opening = left
                else:
                    opening = []
                depth = _common(before, word)
                known = max(opening, right[:_common(word, last)], key=len)
                path = path[:depth + 1]
                path += known[depth:len(word)]
                path += [(p + 1) << 40 | k for k in range(used, used + len(word) + 1 - len(path))]
                used += len(word)
                before = word
                ids.append(i)
                nodes.append(path)
                fresh.append([k == 0 or word[k] != word[k - 1] for k in range(len(word))])
                held += len(word)
                if held > 500_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((ids, nodes, fresh), kind.types)], schema=kind)
                    ids, nodes, fresh, held = [], [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((ids, nodes, fresh), kind.types)], schema=kind)

    walk = placed.repartition(n, "part").sortWithinPartitions("part", "at").select("id", "key", "part")
    return walk.mapInArrow(run, f"id bigint, {out} array<bigint>, fresh array<boolean>")


def node_pairs(words: DataFrame) -> DataFrame:
    """(p, s, kind, id): the pairs of prefix and suffix nodes of all words; kind 0 is a whole
    pair, 1 a skipped one that stands for an insertion, 2 one at a letter like that before it."""
    ahead = trie_nodes(words, F.col("word"), "f")
    back = trie_nodes(words, F.reverse("word"), "b").drop("fresh")
    size = F.size("f") - 1
    whole = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(
        F.get("f", i).alias("p"), F.get("b", size - i).alias("s"), F.lit(0).cast("tinyint").alias("kind")))
    skipped = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
        F.get("f", i).alias("p"), F.get("b", size - 1 - i).alias("s"), F.when(F.get("fresh", i), 1).otherwise(2).cast("tinyint").alias("kind")))
    return ahead.join(back, "id").where(size > 0).select("id", F.explode(F.concat(whole, skipped)).alias("x")).select("x.p", "x.s", "x.kind", "id")


def nearest(pairs: DataFrame) -> DataFrame:
    """(id, best, n_near): of each word with a neighbour its least-numbered one and their count."""
    groups = pairs.groupBy("p", "s").agg(F.sort_array(F.collect_list(F.struct("id", "kind"))).alias("m"))  # one word a letter, and one
    skips, canon = F.filter("m", lambda x: x["kind"] > 0), F.filter("m", lambda x: x["kind"] == 1)
    groups = groups.where(F.size("m") > 1).select(
        "m", skips["id"].alias("skips"), canon["id"].alias("canon"), F.get(F.filter("m", lambda x: x["kind"] == 0), F.lit(0))["id"].alias("a"))
    each = groups.withColumn("x", F.explode("m"))
    is_a, has_a = F.col("x.kind") == 0, (F.col("x.kind") == 1) & F.col("a").isNotNull()
    other = F.when(F.get("skips", F.lit(0)) == F.col("x.id"), F.get("skips", F.lit(1))).otherwise(F.get("skips", F.lit(0)))
    each = each.select(
        F.col("x.id").alias("id"),
        F.when(is_a, F.get("canon", F.lit(0))).otherwise(F.least(other, F.when(has_a, F.col("a")))).alias("best"),
        F.when(is_a, F.size("canon")).otherwise(F.size("skips") - 1 + has_a.cast("int")).alias("n"))
    return each.where("n > 0").groupBy("id").agg(F.min("best").alias("best"), F.sum("n").alias("n_near"))


def _roots(up: DataFrame) -> DataFrame:
    """(id, root) from (id, up): the ends of all chains, by doubling."""
    up = written(up, "spelling-up")
    while True:
        ahead = up.select(F.col("id").alias("up"), F.col("up").alias("next"))
        both = written(up.join(ahead, "up", "left").select("id", F.coalesce("next", "up").alias("up"), F.col("next").isNotNull().alias("moved")), "spelling-up")
        up = both.select("id", "up")
        if both.where("moved").isEmpty():
            return up.withColumnRenamed("up", "root")


def group_variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of ``words`` (word, n): distinct non-empty words, counts."""
    ranked = numbered(words.select("word", F.col("n").cast("bigint").alias("n"), (-F.col("n").cast("bigint")).alias("order")), ["order", "word"], "id")
    ranked = written(ranked.select("id", "word", "n"), "spelling-words")
    near = nearest(node_pairs(ranked))
    best = ranked.select(F.col("id").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    links = ranked.join(near, "id", "left").join(best, "best", "left")
    ok = F.col("form_n") >= ratio * F.col("n")
    links = written(links.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(ok, F.col("best")).alias("best"),
                                 F.when(ok, F.col("form")).alias("form"), F.when(ok, F.col("form_n")).alias("form_n")), "spelling-links")
    roots = _roots(links.where("best IS NOT NULL").select("id", F.col("best").alias("up")))
    names = ranked.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    return (links.join(roots.join(names, "root").select("id", "root_word"), "id", "left")
            .select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"))


def count_words(docs: DataFrame, least_length: int = 7, least_count: int = 2, drop_every: int | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): words of ``least_length`` letters or more in whole texts, A-Z lowered; with
    ``drop_every`` a letter of every such-th word of a document is left out (by its CRC)."""
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("d"),
                       F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"{WORD}{{{least_length},}}"), F.lit(0))).alias("run"))
    words = runs.select("d", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))
    if drop_every:
        words = words.withColumn("h", F.crc32(F.encode(F.concat("d", F.lit(":"), "run"), "utf-8")))
        cut = (F.col("h") % F.length("run")).cast("int")
        less = F.concat(F.col("run").substr(F.lit(1), cut), F.col("run").substr(cut + 2, F.length("run")))
        words = words.select(F.when(F.col("h") % drop_every == 0, less).otherwise(F.col("run")).alias("run"))
    return (words.where(F.length("run") >= least_length).groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n"))
            .where(F.col("n") >= least_count))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(count_words(table(spark, sf_dir, "documents"), drop_every=31), ratio=10)


OP13_SQL = f"""
WITH RECURSIVE {CRC_TABLE_SQL},
r AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, unnest(regexp_extract_all(text, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]{{7,}}')) AS run FROM documents),
c AS (SELECT d, translate(run, '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS run, count(*) AS n FROM r GROUP BY 1, 2),
h AS (SELECT run, n, {crc32_sql("encode(d || ':' || run)")} AS h FROM c, crc),
v AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM v WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
k AS (SELECT word, n, unnest(range(0, length(word))) AS i FROM w),
x AS (SELECT word, n, substr(word, 1, i) AS a, substr(word, i + 2) AS z FROM k),
t AS (SELECT DISTINCT word, n, a || z AS cut FROM x),
near AS (SELECT p.word, q.word AS other, q.n AS m FROM x p JOIN x q ON p.a = q.a AND p.z = q.z AND p.word <> q.word
         UNION ALL SELECT t.word, w.word, w.n FROM t JOIN w ON t.cut = w.word
         UNION ALL SELECT w.word, t.word, t.n FROM t JOIN w ON t.cut = w.word),
b AS (SELECT word, count(*) AS n_near, arg_min(other, struct_pack(o := -m, s := other)) AS form, max(m) AS form_n FROM near GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.form_n >= 10 * w.n THEN b.form END AS form,
             CASE WHEN b.form_n >= 10 * w.n THEN b.form_n END AS form_n FROM w LEFT JOIN b ON w.word = b.word),
chain(word, tip, step) AS (SELECT word, word, 0 FROM f UNION ALL
  SELECT chain.word, f.form, step + 1 FROM chain JOIN f ON chain.tip = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM f JOIN (SELECT word, arg_max(tip, step) AS root FROM chain GROUP BY word) e ON f.word = e.word
"""
