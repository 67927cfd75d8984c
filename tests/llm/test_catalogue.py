"""Which queries have SQL, and where the others are held against a plain version."""

import importlib

import __spark_entry__ as entry
from pointloom.llm.queries import ALL, SQL

WITHOUT_SQL = {
    "op1_suffix_array": "test_suffix_dedup", "op2_embeddings": "test_embeddings", "op3_packing": "test_packing", "op4_licences": "test_licences",
    "op5_fingerprints": "test_syncmers", "op6_chats": "test_chats", "op8_simhash": "test_simhash", "op9_token_counts": "test_token_counts",
    "op10_toxicity": "test_toxicity", "op11_lm_scores": "test_lm",
}


def test_every_query_has_sql_or_a_plain_version():
    assert set(ALL) - set(SQL) == set(WITHOUT_SQL)
    assert all(importlib.util.find_spec(m) for m in WITHOUT_SQL.values())
    assert set(ALL) | {"pipeline"} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
