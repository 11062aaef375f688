"""Every registered query of the subpackage over whole tables: its columns, and a row for every row."""

import os

import pytest

from __spark_entry__ import oracle_sql, queries
from tributary.llm import registered

SF = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")

COLUMNS = {
    "op1": ("pages", "page_id payload_bytes payload_digest record_type refers_to"),
    "op2": ("documents", "doc_id n_shingles component_id"),
    "op4": ("documents", "doc_id held_out n_tokens n_known train_tokens base_score score"),
    "op5": ("documents", "doc_id n_words n_removed kept_sha256"),
    "op6": ("documents", "doc_id start n_tokens ids_crc32"),
    "op7": ("documents", "doc_id n_tokens ids_sha256 decoded_sha256"),
    "op8": ("pages", "page_id url text n_chars"),
    "op10": ("documents", "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept"),
    "op11": ("pages", "page_id host path rule verdict"),
    "op12": ("documents", "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256"),
    "op13": ("documents", "doc_id leaf subroot root proof_sha256 folded_root verified"),
}


def test_all_are_registered():
    assert {n.split("_")[0] for n in registered.QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(registered.QUERIES) | {"pipeline"} <= set(queries()) and set(registered.ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", registered.QUERIES)
def test_query(spark, name):
    got = registered.QUERIES[name](spark, SF)
    op = name.split("_")[0]
    if op in COLUMNS:
        table, columns = COLUMNS[op]
        assert set(columns.split()) <= set(got.columns)
        assert got.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
    else:
        assert got.count() > 0
