"""Multi-party perspective rotation of dialogues (operator 6), DataFrame functions only.

For every participant of a conversation the dialogue is rendered once, with that
participant's turns as the assistant's and all others' as named users'; system turns
stay system turns.  ``assistant_spans`` is the loss mask: start and end (code points,
end exclusive, relative to ``rendered``) of what the assistant has to write, each
turn's text with its closing mark.

A dialogue of any length is rendered in parts of ``part_turns`` consecutive turn
numbers, and each part in pieces of ``tie_rows`` consecutive turns, numbered from 0, so
no row holds an unbounded dialogue; parts and their pieces in order make up the
dialogue.  Parts that may have more turns are sorted as a whole by a range
partitioning; a turn's place is its place in its range and the counts of the ranges
before, so no task sorts an unbounded part.

Defined results: rows that repeat in all four columns are one turn; a null or empty
role is the participant ``unknown``; a null text is empty; rows without a turn number
come first (part -1); ties are ordered by role, then text; rows without a
conversation id form a conversation of their own; a conversation of system turns alone has no
participant and no row; an empty table gives an empty result; other columns are
passed by.  Marks that occur in a text are taken apart with a blank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phenocast.llm._common import shuffle_partitions, table, written

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _pieces(rows: DataFrame, piece_rows: int) -> DataFrame:
    """``rows`` with ``piece``, their place in their part by ``piece_rows``."""
    order = ["turn", "name", "content"]
    placed = written(rows.repartitionByRange(shuffle_partitions(rows.sparkSession), "conv_id", "part", *order)
                     .withColumn("range", F.spark_partition_id()), "chat-order")
    # at most the first part of each range begins in an earlier one
    before = F.sum("count").over(Window.partitionBy("conv_id", "part").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    begun = (placed.groupBy("conv_id", "part", "range").count().withColumn("before", before).where("before IS NOT NULL")
             .select(F.col("conv_id").alias("__c"), F.col("part").alias("__p"), F.col("range").alias("__r"), "before"))
    at = F.row_number().over(Window.partitionBy("conv_id", "part", "range").orderBy(*order))
    placed = placed.withColumn("at", at).join(F.broadcast(begun), F.col("conv_id").eqNullSafe(F.col("__c")) & (F.col("part") == F.col("__p"))
                                              & (F.col("range") == F.col("__r")), "left")
    piece = F.floor((F.coalesce("before", F.lit(0)) + F.col("at") - 1) / piece_rows).cast("int")
    return placed.select(*rows.columns, piece.alias("piece"))


def rotate(conversations: DataFrame, part_turns: int = 512, tie_rows: int = 4096, system_role: str = "system",
           id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, speaker, part, piece, n_turns, rendered, assistant_spans): module text."""
    def clean(c):
        return F.replace(c, F.lit("<|"), F.lit("< |"))

    role = F.col(role_col).cast("string")
    rows = conversations.select(
        F.col(id_col).alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"),
        clean(F.regexp_replace(F.when(role != "", role).otherwise("unknown"), "[\r\n]", " ")).alias("name"),
        clean(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("content")).distinct()
    rows = rows.withColumn("name", F.coalesce("name", F.lit("unknown")))
    rows = rows.withColumn("part", F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(-1)))
    # parts of more rows, repeated ones counted: under 1 / tie_rows of the rows, joined by their written size
    part = F.coalesce(F.floor(F.col(turn_col).cast("bigint") / part_turns), F.lit(-1))
    large = written(conversations.groupBy(F.col(id_col).alias("conv_id"), part.alias("part")).count().where(F.col("count") > tie_rows)
                    .select(F.col("conv_id").alias("__c"), F.col("part").alias("__p")), "chat-large")
    turns = rows.withColumn("piece", F.lit(0))
    if not large.isEmpty():
        of_large = F.col("conv_id").eqNullSafe(F.col("__c")) & (F.col("part") == F.col("__p"))
        turns = turns.join(large, of_large, "left_anti").unionByName(
            _pieces(rows.join(large, of_large, "left_semi"), tie_rows))
    parts = (turns.select("conv_id", "part", "piece", F.struct("turn", "name", "content").alias("t"))
             .groupBy("conv_id", "part", "piece").agg(F.sort_array(F.collect_list("t")).alias("turns")))
    people = (rows.select("conv_id", F.col("name").alias("speaker")).where(F.col("speaker") != system_role).distinct()
              .select(F.col("conv_id").alias("__c"), "speaker"))
    both = parts.join(people, F.col("conv_id").eqNullSafe(F.col("__c"))).drop("__c")

    def head(t):
        return F.concat(F.lit(OPEN), F.when(t["name"] == system_role, F.lit("system"))
                        .when(t["name"] == F.col("speaker"), F.lit("assistant"))
                        .otherwise(F.concat(F.lit("user name="), t["name"])), F.lit("\n"))

    both = both.withColumn("segs", F.transform("turns", lambda t: F.struct(
        head(t).alias("head"), F.concat(t["content"], F.lit(CLOSE)).alias("body"), (t["name"] == F.col("speaker")).alias("own"))))
    spans = F.aggregate(
        "segs", F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("spans")),
        lambda acc, s: F.struct(
            (acc["at"] + F.length(s["head"]) + F.length(s["body"]) + 1).cast("bigint").alias("at"),
            F.when(s["own"], F.array_append(acc["spans"], F.concat((acc["at"] + F.length(s["head"])).cast("string"), F.lit(":"),
                                                                   (acc["at"] + F.length(s["head"]) + F.length(s["body"])).cast("string"))))
            .otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    return both.select(
        "conv_id", "speaker", F.col("part").cast("bigint").alias("part"), "piece", F.size("turns").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("segs", lambda s: F.concat(s["head"], s["body"], F.lit("\n"))), "").alias("rendered"),
        F.array_join(spans, ",").alias("assistant_spans"))


def op6_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(table(spark, sf_dir, "conversations"))


OP6_SQL = f"""
WITH r AS (SELECT DISTINCT conv_id, turn,
             replace(regexp_replace(CASE WHEN role <> '' THEN role ELSE 'unknown' END, '[\\r\\n]', ' ', 'g'), '<|', '< |') AS name,
             replace(coalesce(text, ''), '<|', '< |') AS content FROM conversations),
p AS (SELECT DISTINCT conv_id, name AS speaker FROM r WHERE name <> 'system'),
x AS (SELECT r.conv_id, speaker, CAST(coalesce(floor(turn / 512), -1) AS BIGINT) AS part, turn, name, content,
        '{OPEN}' || CASE WHEN name = 'system' THEN 'system' WHEN name = speaker THEN 'assistant' ELSE 'user name=' || name END || chr(10) AS head,
        content || '{CLOSE}' AS body FROM r JOIN p ON r.conv_id IS NOT DISTINCT FROM p.conv_id),
c AS (SELECT *, CAST((row_number() OVER (PARTITION BY conv_id, speaker, part ORDER BY turn NULLS FIRST, name, content) - 1) // 4096 AS INTEGER) AS piece FROM x),
o AS (SELECT *, row_number() OVER w AS rn,
        coalesce(sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, speaker, part, piece ORDER BY turn NULLS FIRST, name, content
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base
      FROM c WINDOW w AS (PARTITION BY conv_id, speaker, part, piece ORDER BY turn NULLS FIRST, name, content))
SELECT conv_id, speaker, part, piece, count(*) AS n_turns,
       string_agg(head || body || chr(10), '' ORDER BY rn) AS rendered,
       coalesce(string_agg(CAST(CAST(base + length(head) AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(base + length(head) + length(body) AS BIGINT) AS VARCHAR), ',' ORDER BY rn)
           FILTER (WHERE name = speaker), '') AS assistant_spans
FROM o GROUP BY conv_id, speaker, part, piece
"""
