"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from tidelake.llm import chat, kn_quality, mixing, packing, periodic_runs, quality_rules, repair, secrets, simhash, suffix_dedup, token_counts, topk_search, toxicity


def queries() -> dict:
    return {
        f.__name__: f
        for f in (
            quality_rules.op1_quality_rules,
            mixing.op2_mixing,
            topk_search.op3_topk,
            chat.op4_chat,
            suffix_dedup.op5_suffix_dedup,
            packing.op6_packing,
            toxicity.op7_toxicity,
            simhash.op8_simhash,
            kn_quality.op9_kn_quality,
            secrets.op10_secret_scan,
            periodic_runs.op11_periodic_runs,
            repair.op12_repair,
            token_counts.op13_token_counts,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {"op10_secret_scan": secrets.OP10_SQL, "op12_repair": repair.OP12_SQL, "op1_quality_rules": quality_rules.OP1_SQL, "op5_suffix_dedup": suffix_dedup.OP5_SQL, "op3_topk": topk_search.OP3_SQL, "op4_chat": chat.OP4_SQL}
