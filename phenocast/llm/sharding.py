"""Sharding by jump consistent hashing (operator 11).

A row's key and the number of shards decide its shard: a 64-bit linear congruential
generator seeded by the key's hash draws the shard counts at which the key jumps, and
the last jump below the number of shards is its shard.  No ring or table is kept.  With
one more shard a key stays or jumps to the new one, so growing from n to m shards moves
(m - n) / m of the keys, all of them into the new shards (``moves`` lists them).

The hash is the first 60 bits of the MD5 of the key columns, so any key type works and
every engine finds the same shard.  Assigning is a narrow projection without a shuffle;
the generator runs on whole Arrow batches.  Places within a shard are numbered along the
key by ranges of rows (``numbering.numbered``), so a hot key is no hot task there.

Defined results: a null text has no bytes (size 8, CRC 0, like an empty one); null keys
are one key of their own, and rows with equal keys are in one shard, whatever their
text; repeated rows are placed one after the other; an empty table gives an empty
result; other columns are kept; columns that have an added column's name (or ``shard_key``)
are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from phenocast.functions.numeric import hash64
from phenocast.llm._common import table
from phenocast.llm.numbering import numbered

# Fixed values of the published generator.
_MULTIPLIER = 2862933555777941757
_SHIFT, _SPAN = 33, float(1 << 31)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key among ``shards``."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), dtype=np.int64)
    live = np.arange(len(state))
    while len(live):
        draw = state[live] * np.uint64(_MULTIPLIER) + np.uint64(1)
        state[live] = draw
        nxt = ((shard[live] + 1) * (_SPAN / ((draw >> np.uint64(_SHIFT)) + np.uint64(1)).astype(np.float64))).astype(np.int64)
        stays = nxt < shards
        live = live[stays]
        shard[live] = nxt[stays]
    return shard


def shard_of(keys: list[str], shards: int, seed: int = 0) -> Column:
    """Shard of a row by its key columns, an integer from 0."""
    @F.pandas_udf("int")
    def run(h: pd.Series) -> pd.Series:
        return pd.Series(jump(h.to_numpy(), shards))

    return run(hash64(keys, seed))


def assign(df: DataFrame, shards: int, keys: list[str], out: str = "shard", seed: int = 0) -> DataFrame:
    return df.withColumn(out, shard_of(keys, shards, seed))


def moves(df: DataFrame, old: int, new: int, keys: list[str], seed: int = 0) -> DataFrame:
    """The rows that change their shard when ``old`` shards become ``new``, with ``shard_from``
    and ``shard_to``; all other rows stay where they are."""
    both = df.withColumn("shard_from", shard_of(keys, old, seed)).withColumn("shard_to", shard_of(keys, new, seed))
    return both.where("shard_from <> shard_to")


def place(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", seed: int = 0,
          keep: list[str] | None = None) -> DataFrame:
    """``docs`` (of its columns those in ``keep``, all by default) with ``size`` (bytes of the text
    and 8), ``text_crc32``, ``shard``, ``grown_shard`` (with one more shard) and ``slot``, the row's
    gapless place in its shard by id, CRC and size."""
    added = {"size", "text_crc32", "shard", "grown_shard", "slot", "shard_key"}
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    text = F.coalesce(F.col(text_col), F.lit(""))
    placed = docs.select(*keep, F.col(id_col).alias("shard_key"), (F.octet_length(text).cast("bigint") + 8).alias("size"),
                         F.crc32(F.encode(text, "utf-8")).alias("text_crc32"))
    placed = placed.withColumns({"shard": shard_of(["shard_key"], shards, seed), "grown_shard": shard_of(["shard_key"], shards + 1, seed)})
    return numbered(placed, ["shard_key", "text_crc32", "size"], "slot", within="shard").drop("shard_key")


def write_shards(docs: DataFrame, path: str, shards: int, keys: list[str], files_per_shard: int = 1, seed: int = 0) -> None:
    """``docs`` as Parquet, a folder a shard (``shard=<k>``) with up to ``files_per_shard`` files;
    rows are dealt to a shard's files by their content, so equal keys do not fill one file."""
    spread = F.pmod(F.xxhash64(*docs.columns), F.lit(files_per_shard))
    (assign(docs, shards, keys, seed=seed).repartition(shards * files_per_shard, "shard", spread)
     .write.partitionBy("shard").parquet(path))


def op11_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = place(table(spark, sf_dir, "documents"), 24, keep=["doc_id"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def crc32_sql(blob: str) -> str:
    """DuckDB expression: the unsigned CRC-32 of a blob, byte by byte with the table ``crc`` of
    :data:`CRC_TABLE_SQL` (one row, a list ``t`` of 256 entries)."""
    return (f"xor(4294967295, list_reduce(list_transform(regexp_extract_all(hex({blob}), '..'), lambda h: CAST('0x' || h AS BIGINT)), "
            "lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)))")


CRC_TABLE_SQL = """crc AS (SELECT list(v ORDER BY i) AS t FROM (
  SELECT i, list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v
  FROM (SELECT unnest(range(0, 256)) AS i)))"""

OP11_SQL = f"""
WITH RECURSIVE {CRC_TABLE_SQL},
d AS (SELECT doc_id, coalesce(text, '') AS text,
             CAST('0x' || substr(md5(concat_ws('|', CAST(doc_id AS VARCHAR), '0')), 1, 15) AS BIGINT) AS h FROM documents),
j(h, n, s, b, nxt) AS (
  SELECT DISTINCT h, n, CAST(h AS HUGEINT), CAST(-1 AS BIGINT), CAST(0 AS BIGINT) FROM d, (VALUES (24), (25)) v(n)
  UNION ALL
  SELECT h, n, s, b, CAST(floor((b + 1) * (CAST(2147483648 AS DOUBLE) / CAST((s // 8589934592) + 1 AS DOUBLE))) AS BIGINT)
  FROM (SELECT h, n, (s * {_MULTIPLIER} + 1) % 18446744073709551616 AS s, nxt AS b FROM j WHERE nxt < n) t),
p AS (SELECT h, max(b) FILTER (WHERE n = 24) AS shard, max(b) FILTER (WHERE n = 25) AS grown FROM j GROUP BY h),
r AS (SELECT doc_id, CAST(octet_length(encode(text)) + 8 AS BIGINT) AS size,
             CASE WHEN text = '' THEN 0 ELSE {crc32_sql('encode(text)')} END AS text_crc32, h FROM d, crc)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, CAST(grown AS INTEGER) AS grown_shard
FROM r JOIN p USING (h)
"""
