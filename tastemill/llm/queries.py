"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from tastemill.llm import (
    block_names, filter_audit, host_paths, mixing, packing, periodic_runs, quality_machine, sentencepieces, simhash, skip_chain,
    token_records, topk, toxicity,
)

QUERIES = {
    "op1_token_records": token_records.op1_token_records,
    "op2_shards": packing.op2_shards,
    "op3_host_paths": host_paths.op3_host_paths,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_sentencepiece": sentencepieces.op5_sentencepiece,
    "op6_topk": topk.op6_topk,
    "op7_exact_dedup": block_names.op7_exact_dedup,
    "op8_simhash": simhash.op8_simhash,
    "op9_mixing": mixing.op9_mixing,
    "op10_skip_chain": skip_chain.op10_skip_chain,
    "op11_quality_machine": quality_machine.op11_quality_machine,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}

ORACLES = {
    "op6_topk": topk.ORACLE,
    "op7_exact_dedup": block_names.ORACLE,
    "op9_mixing": mixing.ORACLE,
    "op13_filter_audit": filter_audit.ORACLE,
}
