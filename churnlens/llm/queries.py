"""The queries of this subpackage and their DuckDB twins, for the entry module."""

from __future__ import annotations

from churnlens.llm import (bpe_count, decontaminate, packing, periodic, quality, quality_rules, rans,
                           ranked_search, secret_scan, simhash, tool_calls, toxicity, warc)

QUERIES = {
    "op1_tool_call_links": tool_calls.op1_tool_call_links,
    "op2_rans_files": rans.op2_rans_files,
    "op3_toxic_segments": toxicity.op3_toxic_segments,
    "op4_length_buckets": packing.op4_length_buckets,
    "op5_quality_rff": quality.op5_quality_rff,
    "op6_simhash_dedup": simhash.op6_simhash_dedup,
    "op7_token_counts": bpe_count.op7_token_counts,
    "op8_simhash_decontamination": decontaminate.op8_simhash_decontamination,
    "op9_warc": warc.op9_warc,
    "op10_adaptive_rules": quality_rules.op10_adaptive_rules,
    "op11_ranked_search": ranked_search.op11_ranked_search,
    "op12_periodic_runs": periodic.op12_periodic_runs,
    "op13_secret_scan": secret_scan.op13_secret_scan,
}

#: Queries that SQL can express; the others are tested against brute force.
ORACLE = {
    "op8_simhash_decontamination": decontaminate.OP8_SQL,
    "op9_warc": warc.OP9_SQL,
    "op10_adaptive_rules": quality_rules.OP10_SQL,
    "op11_ranked_search": ranked_search.OP11_SQL,
}
