"""The registered queries: their columns, one row for each of their table, and the entry module."""

import os

import pytest

import __spark_entry__ as entry
from gridloom.llm import queries as Q

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op2_simhash": "doc_id fingerprint component_id",
    "op3_toxicity": "doc_id held_out score predicted",
    "op4_mixing": "doc_id source epoch tokens block before_tokens budget_tokens",
    "op5_suffix": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op6_webp": "doc_id n_bytes payload_bytes payload_sha256 tail_crc32 media_bytes media_sha256 feature",
    "op7_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op8_neighbours": "query_id rank vec_id score",
    "op9_html": "page_id url text n_chars",
    "op10_language": "doc_id held_out lang_pred score",
}


def test_names():
    assert set(Q.queries()) == set(COLUMNS)
    assert set(COLUMNS) | {"pipeline"} <= set(entry.queries())
    assert set(Q.oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    got = Q.queries()[name](spark, FOLDER)
    assert set(COLUMNS[name].split()) <= set(got.columns)
    rows = got.collect()
    if name in ("op1_packing", "op4_mixing"):
        assert len({r["doc_id"] for r in rows}) == 200
    elif name == "op8_neighbours":
        assert len(rows) == 25 * 20
    else:
        assert len(rows) == (50 if name == "op9_html" else 200)
