"""Queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from phenocast.llm import chat, decontaminate, knn, langid, line_dedup, ngram_lm, packing, pii, repair, sharding, simhash, spelling, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    knn.op1_voronoi_knn, warc.op2_warc, packing.op3_lexical_packing, ngram_lm.op4_lm_scoring, simhash.op5_simhash_near_dedup,
    chat.op6_chat_rotation, pii.op7_pii, langid.op8_language_id, decontaminate.op9_decontamination, line_dedup.op10_line_dedup,
    sharding.op11_jump_sharding, repair.op12_conversation_repair, spelling.op13_spelling_variants)}

ORACLE_SQL: dict[str, str] = {
    "op1_voronoi_knn": knn.OP1_SQL, "op2_warc": warc.OP2_SQL, "op6_chat_rotation": chat.OP6_SQL,
    "op9_decontamination": decontaminate.OP9_SQL, "op10_line_dedup": line_dedup.OP10_SQL, "op11_jump_sharding": sharding.OP11_SQL, "op12_conversation_repair": repair.OP12_SQL,
    "op13_spelling_variants": spelling.OP13_SQL}
