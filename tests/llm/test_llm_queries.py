"""The registered queries: their SQL where there is one, their columns otherwise."""

import pytest

from cascadia.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SMALL
from tests.oracle import differences, duck

COLUMNS = {
    "op2_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op3_compression_bands": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"],
    "op6_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op7_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op8_speculative_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op9_surrogates": ["doc_id", "text", "n_replaced"],
    "op10_importance": ["doc_id", "log_odds", "gumbel", "kept"],
    "op13_context_trees": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
}


def test_thirteen_queries():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
    assert set(COLUMNS) == set(QUERIES) - set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, name):
    problem, n = differences(QUERIES[name](spark, SMALL), duck(SMALL), ORACLE_SQL[name])
    assert problem is None and n, problem


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    found = QUERIES[name](spark, SMALL)
    assert found.columns[: len(COLUMNS[name])] == COLUMNS[name]
    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert found.select("doc_id").distinct().count() == n
