"""Conversation structure repair by generalised LR parsing (operator 12).

The roles of a conversation have to be ``(s?(ua)+)?``: an optional system turn, then pairs of
user and assistant.  ``glr.RepairParser`` finds the cheapest edits: keep a turn (0), give it
the role user or assistant (3), delete it (4; blank and duplicate turns have to go), insert an
empty turn of user or assistant anywhere (3); a truncated turn that stays costs 3 more.  Of
equally cheap audits, the edits' initials in order, the least in ASCII order is taken.

Turns are in the order of turn (nulls first), role and text.  Equal turns of a conversation are
one row with their number before anything is sorted; a turn is a duplicate if its role and text
came earlier in the conversation, by a join with the first turn of each that comes twice.  The
rows are then dealt by ranges of the order, so a conversation of any size is spread, and a task
reads its sorted range once, as pieces of at most ``PIECE_ROWS`` rows.  A conversation inside
one piece is solved there.  A piece of a longer one, or of one that reaches over the border of
two ranges, is solved from each state that a stack's top can have: costs and the order of the
audits from state to state.  These small tables, a row a piece, are composed along the
conversation, then each piece writes out its part of the chosen audit.  Only SHA-256 over the
whole repaired text, which nothing can split, reads such a conversation's pieces one by one.

Defined results: a null role or text is one space (so such a text is blank, such a role is
deleted or replaced); a null turn comes first and has no part in ``gaps``; rows with a null id
are one conversation; repeated rows are duplicates; roles count by their first character, an empty role is none and cannot be kept; an
empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phenocast.llm._common import shuffle_partitions, table, written
from phenocast.llm.glr import FORCED, INSERT, RepairParser
from phenocast.llm.sharding import CRC_TABLE_SQL, crc32_sql

PIECE_ROWS, PIECE_CHARS = 4096, 4_000_000
_SPACE = " \t\n\x0b\x0c\r"
_LEGAL = ("su", "ua", "au")
_COUNTS = ["n_rows", "blank", "duplicate", "truncated", "illegal"]


def turn_runs(convs: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, copies, late): equal turns as one row; ``late`` where the role
    and text came in an earlier turn."""
    turns = convs.select(F.col(id_col).alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"),
                         F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("text"))
    runs = turns.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    runs = written(runs.withColumns({"h1": F.xxhash64("role", "text"), "h2": F.xxhash64(F.lit(1), "text", "role")}), "repair-runs")
    first = (runs.groupBy("conv_id", "h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct(F.col("turn").isNotNull().alias("k"), "turn")).alias("first"))
             .where("n > 1").select(F.col("conv_id").alias("c"), F.col("h1").alias("g1"), F.col("h2").alias("g2"), "first", F.lit(True).alias("again")))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))
    late = F.coalesce(F.col("again"), F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    return runs.join(first, same, "left").select("conv_id", "turn", "role", "text", "copies", late.alias("late"))


def _fault(text: str) -> str:
    """blank, truncated or none."""
    end = text.rstrip(_SPACE)
    return "blank" if not end else "" if end[-1] in ".!?" else "truncated"


def _kinds(rows) -> list:
    """Rows (role, text, copies, late) as the parser's kinds."""
    out = []
    for role, text, copies, late in rows:
        fault = _fault(text)
        if fault == "blank" or late:
            out.append((FORCED, copies))
        else:
            out.append(((role[:1], fault == "truncated"), 1))
            if copies > 1:
                out.append((FORCED, copies - 1))
    return out


def _counts(rows) -> list[int]:
    """``_COUNTS`` of a piece, of ``illegal`` the pairs inside."""
    n = blank = duplicate = truncated = illegal = 0
    before = None
    for role, text, copies, late in rows:
        fault = _fault(text)
        n += copies
        if fault == "blank":
            blank += copies
        else:
            duplicate += copies if late else copies - 1
            truncated += fault == "truncated" and not late
        illegal += before is not None and before + role[:1] not in _LEGAL
        illegal += (copies - 1) * (role[:1] * 2 not in _LEGAL)
        before = role[:1]
    return [n, blank, duplicate, truncated, illegal]


def _text(turns: list[tuple[str, str]]) -> str:
    return "\n".join(f"{role}:{text}" for role, text in turns)


def _pieces_schema(id_type: pa.DataType) -> pa.Schema:
    i, s = pa.int64(), pa.string()
    return pa.schema([("conv_id", id_type), ("piece", i), ("whole", pa.bool_()), *[(c, i) for c in _COUNTS],
                      ("first", s), ("last", s), ("low", i), ("high", i), ("turns", i), ("low_null", pa.bool_()),
                      ("cost", i), ("audit", s), ("sha", s),
                      ("table", pa.list_(pa.list_(i))), ("roles", pa.list_(s)), ("texts", pa.list_(s)), ("copies", pa.list_(i)), ("lates", pa.list_(pa.bool_()))])


_PIECES = ("piece bigint, whole boolean, " + ", ".join(f"{c} bigint" for c in _COUNTS) + ", first string, last string, low bigint, high bigint, "
           "turns bigint, low_null boolean, cost bigint, audit string, sha string, table array<array<bigint>>, roles array<string>, "
           "texts array<string>, copies array<bigint>, lates array<boolean>")


def _pieces(runs: DataFrame, keep_texts: bool = False) -> DataFrame:
    """A row a piece.  ``whole``: all of a conversation, with its cost, audit and hash; its texts
    only with ``keep_texts``.  Else ``table``: (start, end, cost) in the order of the audits."""
    n = shuffle_partitions(runs.sparkSession)
    id_type = runs.schema["conv_id"].dataType.simpleString()
    placed = (runs.withColumn("head", F.substring("text", 1, 64)).repartitionByRange(n, "conv_id", "turn", "role", "head")
              .sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "turn", "role", "text", "copies", "late"))

    def run(batches):
        parser = RepairParser()
        number = TaskContext.get().partitionId() << 33
        kind, out = None, []
        conv, rows, turns, chars, opened, inside = None, [], [], 0, False, True     # inside: begun in the range before, maybe

        def close(more: bool):
            """Emit the rows held; ``more``: the conversation may go on."""
            nonlocal rows, turns, chars, number
            known = [t for t in turns if t is not None]
            kinds = _kinds(rows)
            whole = not inside and not more
            counts = [*_counts(rows), rows[0][0][:1], rows[-1][0][:1], min(known, default=None), max(known, default=None), len(set(known)), turns[0] is None]
            if whole:
                got = parser.run(kinds)
                extra, k, n_end = parser.best([(x.state, c) for x, c in got.tops])
                audit = parser.audit(got, k) + "I" * n_end
                repaired = _text(parser.apply(audit, [r[:3] for r in rows]))
                solved = [got.cost + extra, audit, hashlib.sha256(repaired.encode("utf-8", "surrogatepass")).hexdigest(), None]
            else:
                tables = []
                for start in parser.starts:
                    got = parser.run(kinds, start)
                    tables += [[start, x.state, got.cost + c] for x, c in got.tops]
                solved = [None, None, None, tables]
            texts = [list(c) for c in zip(*rows)] if keep_texts or not whole else [None] * 4
            out.append([conv, number, whole, *counts, *solved, *texts])
            number += 1
            rows, turns, chars = [], [], 0

        for batch in batches:
            kind = kind or _pieces_schema(batch.schema.field(0).type)
            for c, turn, role, text, copies, late in zip(*(batch.column(k).to_pylist() for k in range(6))):
                if opened and c != conv:
                    close(False)
                    inside = False
                elif len(rows) >= PIECE_ROWS or chars > PIECE_CHARS:
                    close(True)
                    inside = True
                conv, opened = c, True
                rows.append((role, text, copies, late))
                turns.append(turn)
                chars += len(role) + len(text)
                if len(out) >= 500:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kind.types)], schema=kind)
                    out.clear()
        if rows:
            close(True)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kind.types)], schema=kind)

    return written(placed.mapInArrow(run, f"conv_id {id_type}, {_PIECES}"), "repair-pieces")


def _composed(pieces: DataFrame) -> DataFrame:
    """Of all pieces that are no whole conversation: (piece, start, end, closing, n_pieces, cost,
    boundary counts), the way of the cheapest repair through each conversation's pieces."""
    small = pieces.where("NOT whole").select("conv_id", "piece", "table")
    n = shuffle_partitions(pieces.sparkSession)

    def run(batches):
        parser = RepairParser()
        ids, held = [], []

        def solve():
            # tops in the order of their audits: (state, cost); steps: of each top (top before, end)
            tops, steps = [(0, 0)], []
            for _, entries in held:
                found: dict = {}
                for k, (state, cost) in enumerate(tops):
                    for place, (start, end, more) in enumerate(entries):
                        if start == state:
                            new = (cost + more, k, place)
                            if end not in found or new < found[end]:
                                found[end] = new
                kept = sorted(found.items(), key=lambda x: x[1][1:])
                steps.append([(x[1], end) for end, x in kept])
                tops = [(end, x[0]) for end, x in kept]
            total, k, closing = parser.best(tops)
            ends = []
            for step in reversed(steps):
                k, end = step[k]
                ends.append(end)
            ends.reverse()
            last = len(held) - 1
            return [(p, ([0] + ends)[j], ends[j], closing if j == last else 0, total) for j, (p, _) in enumerate(held)]

        conv, opened, out = None, False, []
        for batch in batches:
            for c, piece, entries in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if opened and c != conv:
                    out += solve()
                    held.clear()
                conv, opened = c, True
                held.append((piece, entries))
                if len(out) > 50_000:
                    yield pa.RecordBatch.from_pylist([dict(zip(("piece", "start", "end", "closing", "cost"), x)) for x in out])
                    out = []
        if held:
            out += solve()
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(("piece", "start", "end", "closing", "cost"), x)) for x in out])

    dealt = small.repartition(n, "conv_id").sortWithinPartitions("conv_id", "piece")
    return written(dealt.mapInArrow(run, "piece bigint, start bigint, end bigint, closing bigint, cost bigint"), "repair-composed")


def _written_out(pieces: DataFrame, chosen: DataFrame) -> DataFrame:
    """(conv_id, piece, audit, text, empty): each piece's part of the audit and of the repaired text."""
    id_type = pieces.schema["conv_id"].dataType.simpleString()
    way = chosen.select(F.col("piece").alias("p"), "start", "end", "closing")
    parts = (pieces.where("NOT whole").join(way, F.col("piece") == F.col("p"))
             .select("conv_id", "piece", "start", "end", "closing", "roles", "texts", "copies", "lates"))

    def run(batches):
        parser = RepairParser()
        for batch in batches:
            for k in range(len(batch)):
                _, _, start, end, closing, *cols = (batch.column(c)[k].as_py() for c in range(9))
                rows = list(zip(*cols))
                got = parser.run(_kinds(rows), start)
                order = next(j for j, (x, _) in enumerate(got.tops) if x.state == end)
                audit = parser.audit(got, order) + "I" * closing
                turns = parser.apply(audit, [r[:3] for r in rows], start)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1), batch.column(1).slice(k, 1), pa.array([audit]), pa.array([_text(turns)], pa.string()),
                                                  pa.array([not turns])], names=["conv_id", "piece", "audit", "text", "empty"])

    return parts.mapInArrow(run, f"conv_id {id_type}, piece bigint, audit string, text string, empty boolean")


def _hashed(parts: DataFrame) -> DataFrame:
    """(conv_id, audit, sha) of the conversations' parts in order; one part is in memory at a time."""
    id_type = parts.schema["conv_id"].dataType.simpleString()

    def run(batches):
        conv, opened, digest, audits, begun = None, False, hashlib.sha256(), [], False
        kind = None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array(["".join(audits)]), pa.array([digest.hexdigest()])], names=["conv_id", "audit", "sha"])

        for batch in batches:
            kind = batch.schema.field(0).type
            for k in range(len(batch)):
                c, _, audit, text, empty = (batch.column(j)[k].as_py() for j in range(5))
                if opened and c != conv:
                    yield row()
                    digest, audits, begun = hashlib.sha256(), [], False
                conv, opened = c, True
                audits.append(audit)
                if not empty:
                    digest.update((("\n" if begun else "") + text).encode("utf-8", "surrogatepass"))
                    begun = True
        if opened:
            yield row()

    n = shuffle_partitions(parts.sparkSession)
    return parts.repartition(n, "conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(run, f"conv_id {id_type}, audit string, sha string")


def _totals(pieces: DataFrame) -> DataFrame:
    """(conv_id, gaps and counts): pieces added up; a pair of turns and a turn may lie across a border."""
    along = Window.partitionBy("conv_id").orderBy("piece")     # a row a piece, not a turn
    pair = F.concat(F.lag("last").over(along), "first")
    met = pieces.withColumns({
        "across": (pair.isNotNull() & ~F.coalesce(pair, F.lit("")).isin(*_LEGAL)).cast("bigint"),
        "twice": F.coalesce(F.lag("high").over(along) == F.when(~F.col("low_null"), F.col("low")), F.lit(False)).cast("bigint")})
    span = F.max("high") - F.min("low") + 1 - (F.sum("turns") - F.sum("twice"))
    return met.groupBy("conv_id").agg(F.coalesce(span, F.lit(0)).cast("bigint").alias("gaps"), F.sum("blank").alias("blank"),
                                      F.sum("duplicate").alias("duplicate"), F.sum("truncated").alias("truncated"),
                                      (F.sum("illegal") + F.sum("across")).alias("illegal"))


def repair(convs: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A row a conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    pieces = _pieces(turn_runs(convs, id_col, turn_col, role_col, text_col))
    chosen = _composed(pieces)
    counts = ["gaps", *_COUNTS[1:]]
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("bigint")
    whole = pieces.where("whole").select("conv_id", gaps.alias("gaps"), *_COUNTS[1:], "cost", "audit", F.col("sha").alias("repaired_sha256"))
    long = pieces.where("NOT whole")
    cost = long.join(chosen.select(F.col("piece").alias("p"), F.col("cost").alias("total")), F.col("piece") == F.col("p")).groupBy("conv_id").agg(F.max("total").alias("cost"))
    hashed = _hashed(_written_out(pieces, chosen))
    c = lambda df, tag: df.withColumnRenamed("conv_id", tag)
    joined = (_totals(long.drop("table", "roles", "texts", "copies", "lates")).join(c(cost, "c1"), F.col("conv_id").eqNullSafe(F.col("c1")))
              .join(c(hashed, "c2"), F.col("conv_id").eqNullSafe(F.col("c2"))))
    return whole.unionByName(joined.select("conv_id", *counts, "cost", "audit", F.col("sha").alias("repaired_sha256")))


def repaired_turns(convs: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, piece, place, role, text): the turns of all repaired conversations, in the order
    of piece and place; a conversation with nothing left has none."""
    pieces = _pieces(turn_runs(convs, id_col, turn_col, role_col, text_col), keep_texts=True)
    id_type = pieces.schema["conv_id"].dataType.simpleString()
    way = _composed(pieces).select(F.col("piece").alias("p"), "start", "end", "closing")
    parts = (pieces.join(way, F.col("piece") == F.col("p"), "left")
             .select("conv_id", "piece", "audit", "start", "end", "closing", "roles", "texts", "copies", "lates"))

    def run(batches):
        parser = RepairParser()
        for batch in batches:
            for k in range(len(batch)):
                _, piece, audit, start, end, closing, *cols = (batch.column(c)[k].as_py() for c in range(10))
                rows = list(zip(*cols))
                if audit is None:
                    got = parser.run(_kinds(rows), start)
                    audit = parser.audit(got, next(j for j, (x, _) in enumerate(got.tops) if x.state == end)) + "I" * closing
                turns = parser.apply(audit, [r[:3] for r in rows], start or 0)
                if turns:
                    ids = pa.concat_arrays([batch.column(0).slice(k, 1)] * len(turns))
                    yield pa.RecordBatch.from_arrays([ids, pa.array([piece] * len(turns)), pa.array(list(range(len(turns)))), pa.array([t[0] for t in turns]),
                                                      pa.array([t[1] for t in turns])], names=["conv_id", "piece", "place", "role", "text"])

    return parts.mapInArrow(run, f"conv_id {id_type}, piece bigint, place bigint, role string, text string")


def damage(convs: DataFrame) -> DataFrame:
    """``convs`` (conv_id, turn, role, text) with faults by the CRC of ``conv_id:turn`` modulo 20:
    0 drops a row, 1 empties its text, 2 takes its marks ``.!?`` away, 3 repeats it, 4 makes it the user's."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    text = F.coalesce("text", space)
    hit = convs.select("conv_id", "turn", F.coalesce("role", space).alias("role"), text.alias("text"), (F.crc32(F.encode(key, "utf-8")) % 20).alias("k"))
    text = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("k") == 3, 2).otherwise(1)
    return (hit.where("k <> 0").select("conv_id", "turn", F.when(F.col("k") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                                       F.explode(F.array_repeat(F.lit(0), times)).alias("copy")).drop("copy"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = table(spark, sf_dir, "conversations")
    fixed = repair(damage(convs)).withColumnRenamed("conv_id", "c").withColumn("found", F.lit(True))
    every = convs.select("conv_id").distinct().join(fixed, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    zeros = {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return every.withColumns({**zeros, "audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))}).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


OP12_SQL = rf"""
WITH RECURSIVE {CRC_TABLE_SQL},
o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
m AS (SELECT k, {crc32_sql('encode(k)')} % 20 AS h FROM (SELECT DISTINCT k FROM o), crc),
d AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
             CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END))
      FROM o JOIN m USING (k) WHERE h <> 0),
n AS (SELECT *, row_number() OVER w AS i, left(role, 1) AS c, lag(left(role, 1)) OVER w AS b,
             rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS g
      FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
f AS (SELECT *, CASE WHEN t = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                     WHEN right(t, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM n),
counts AS (SELECT conv_id, g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank,
                  count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated,
                  count(*) FILTER (WHERE b || c NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS rows FROM f GROUP BY conv_id, g),
ins(st, k, nx, lines) AS (VALUES ('0', 0, '0', CAST([] AS VARCHAR[])), ('0', 1, 'u', ['user:']), ('0', 2, 'a', ['user:', 'assistant:']), ('s', 0, 's', []), ('s', 1, 'u', ['user:']),
  ('s', 2, 'a', ['user:', 'assistant:']), ('u', 0, 'u', []), ('u', 1, 'a', ['assistant:']), ('u', 2, 'u', ['assistant:', 'user:']),
  ('a', 0, 'a', []), ('a', 1, 'u', ['user:']), ('a', 2, 'a', ['user:', 'assistant:'])),
sh(nx, c, en) AS (VALUES ('0', 's', 's'), ('0', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')),
mv AS (SELECT st, k, lines, c, en, 'K' AS act FROM ins JOIN sh USING (nx)
       UNION ALL SELECT st, k, lines, c, en, 'R' FROM ins JOIN sh USING (nx) WHERE c <> 's'),
p(g, i, st, x) AS (
  SELECT g, CAST(0 AS BIGINT), '0', struct_pack(cost := CAST(0 AS BIGINT), audit := '', lines := CAST([] AS VARCHAR[])) FROM counts
  UNION ALL
  SELECT g, i, st, min(x) FROM (
    SELECT p.g, f.i, p.st, struct_pack(cost := p.x.cost + 4, audit := p.x.audit || 'D', lines := p.x.lines) AS x FROM p JOIN f ON p.g = f.g AND f.i = p.i + 1
    UNION ALL
    SELECT p.g, f.i, mv.en, struct_pack(cost := p.x.cost + 3 * mv.k + CASE WHEN f.fault = 't' THEN 3 ELSE 0 END + CASE WHEN mv.act = 'R' THEN 3 ELSE 0 END,
      audit := p.x.audit || repeat('I', mv.k) || mv.act,
      lines := list_concat(list_concat(p.x.lines, mv.lines), [CASE WHEN mv.act = 'K' THEN f.role WHEN mv.c = 'u' THEN 'user' ELSE 'assistant' END || ':' || f.text]))
    FROM p JOIN f ON p.g = f.g AND f.i = p.i + 1 JOIN mv ON mv.st = p.st AND (mv.act = 'R' OR mv.c = f.c) WHERE f.fault IN ('', 't')) t GROUP BY g, i, st),
e AS (SELECT p.g, min(struct_pack(cost := p.x.cost + 3 * ins.k, audit := p.x.audit || repeat('I', ins.k), lines := list_concat(p.x.lines, ins.lines))) AS x
      FROM p JOIN counts ON p.g = counts.g AND p.i = counts.rows
      JOIN ins ON ins.st = p.st AND (ins.st, ins.k) IN (('0', 0), ('s', 2), ('u', 1), ('a', 0)) GROUP BY p.g),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(e.x.cost, 0) AS cost, coalesce(e.x.audit, '') AS audit,
       sha256(coalesce(array_to_string(e.x.lines, chr(10)), '')) AS repaired_sha256
FROM ids LEFT JOIN counts ON ids.conv_id IS NOT DISTINCT FROM counts.conv_id LEFT JOIN e ON e.g = counts.g
"""
