"""Queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from quern.llm import bytebpe, gridorder, language, packing, periods, pii, quality, repair, secrets, simhash, tokencount, topk, warc

QUERIES = {
    "op1_secret_scan": secrets.op1_secret_scan,
    "op2_pii": pii.op2_pii,
    "op3_simhash": simhash.op3_simhash,
    "op4_byte_bpe": bytebpe.op4_byte_bpe,
    "op5_top_k": topk.op5_top_k,
    "op6_token_counts": tokencount.op6_token_counts,
    "op7_warc_revisits": warc.op7_warc_revisits,
    "op8_language_id": language.op8_language_id,
    "op9_quality_rules": quality.op9_quality_rules,
    "op10_packing": packing.op10_packing,
    "op11_conversation_repair": repair.op11_conversation_repair,
    "op12_periodic_runs": periods.op12_periodic_runs,
    "op13_embedding_near_dedup": gridorder.op13_embedding_near_dedup,
}

ORACLES: dict[str, str] = {
    "op5_top_k": topk.OP5_SQL,
    "op7_warc_revisits": warc.OP7_SQL,
    "op9_quality_rules": quality.OP9_SQL,
    "op11_conversation_repair": repair.OP11_SQL,
    "op12_periodic_runs": periods.OP12_SQL,
    "op13_embedding_near_dedup": gridorder.OP13_SQL,
}
