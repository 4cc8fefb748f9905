"""Dense numbers along an order, without a global window and without the driver."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phenocast.llm._common import shuffle_partitions, written


def numbered(df: DataFrame, order: list[str], out: str, within: str | None = None) -> DataFrame:
    """``df`` with ``out``, the gapless place from 0 along ``order`` (nulls first), counted
    anew for each value of ``within`` if given (a column of few values, such as shards).

    The rows are written once and dealt by ranges of the order, so neither a value of
    ``within`` nor a repeated row makes a hot task: rows equal in the whole order are told
    apart by their place in the written files.  Each sorted range counts its own rows; a
    range's first number comes from the counts of the ranges before it, a table of one row
    a range and a value of ``within`` that begins or goes on there, which is broadcast.
    """
    tag = uuid.uuid4().hex
    part, at, low, num, begin = (f"{x}_{tag}" for x in ("part", "at", "low", "num", "begin"))
    n = shuffle_partitions(df.sparkSession)
    rows = written(df, "numbering-rows").withColumn(f"f_{tag}", F.xxhash64("_metadata.file_path")).withColumn(f"r_{tag}", F.col("_metadata.row_index"))
    keys = [*([within] if within else []), *order, f"f_{tag}", f"r_{tag}"]
    placed = (rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys).drop(f"f_{tag}", f"r_{tag}")
              .withColumn(at, F.monotonically_increasing_id()))
    placed = written(placed.withColumn(part, F.shiftright(at, 33)), "numbering-ranges")
    by = [part, within] if within else [part]
    counts = placed.groupBy(*by).agg(F.count("*").alias(num), F.min(at).alias(low))
    before = Window.partitionBy(*([within] if within else [])).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    first = counts.withColumn(begin, F.coalesce(F.sum(num).over(before), F.lit(0)))
    first = F.broadcast(first.select(F.col(part).alias(f"p_{tag}"), *([F.col(within).alias(f"w_{tag}")] if within else []), low, begin))
    same = F.col(part) == F.col(f"p_{tag}")
    if within:
        same &= F.col(within).eqNullSafe(F.col(f"w_{tag}"))
    return placed.join(first, same).select(*[F.col(c) for c in df.columns], (F.col(at) - F.col(low) + F.col(begin)).alias(out))
