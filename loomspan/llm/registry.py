"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from . import bpe, chat, decontaminate, neardup, pii, quality, repeats, secret_scan, token_file, toxicity

QUERIES = {
    "op1_byte_bpe": bpe.op1_byte_bpe,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_pii": pii.op3_pii,
    "op4_chat_format": chat.op4_chat_format,
    "op5_quality_rules": quality.op5_quality_rules,
    "op6_token_file": token_file.op6_token_file,
    "op7_suffix_array_dedup": repeats.op7_suffix_array_dedup,
    "op8_minhash_near_dedup": neardup.op8_minhash_near_dedup,
    "op9_secret_scan": secret_scan.op9_secret_scan,
    "op10_decontaminate": decontaminate.op10_decontaminate,
}
#: Where SQL cannot express a query, the test that holds it against plain Python, a round trip or held-out accuracy.
TESTS = {
    "op1_byte_bpe": "tests/llm/test_queries.py::test_op1", "op2_toxicity": "tests/llm/test_queries.py::test_op2", "op6_token_file": "tests/llm/test_queries.py::test_op6",
    "op9_secret_scan": "tests/llm/test_queries.py::test_op9", "pipeline": "tests/llm/test_pipeline.py",
}
ORACLE_SQL = {
    "op3_pii": pii.ORACLE_SQL,
    "op4_chat_format": chat.ORACLE_SQL,
    "op5_quality_rules": quality.ORACLE_SQL,
    "op7_suffix_array_dedup": repeats.ORACLE_SQL,
    "op8_minhash_near_dedup": neardup.ORACLE_SQL,
    "op10_decontaminate": decontaminate.ORACLE_SQL,
}
