"""The registered queries: columns of the contract, whole tables, and the DuckDB twins."""

import re

import pytest

import __spark_entry__ as entry_point
from orderlake.llm import queries
from tools.check_oracle import compare, duck

SF_DIR = "/root/testdata/sf0.001"
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
}
COLUMNS = {
    1: "doc_id held_out score predicted",
    2: "page_id payload_bytes payload_digest record_type refers_to",
    3: "query_id rank vec_id score",
    4: "doc_id fingerprint component_id",
    5: "doc_id n_words n_base first_word last_word base_labels labels score",
    6: "doc_id held_out lang_pred score",
    7: "doc_id n_words n_removed kept_sha256",
    8: "doc_id n_words n_hit n_items items_sha256 contaminated",
    9: "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    10: "doc_id piece first_token n_tokens bucket boundary batch slot",
    11: "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
    12: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    13: "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
}
NAMES = list(queries.queries())


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_all_are_registered():
    numbers = [int(re.match(r"op([0-9]+)_", name)[1]) for name in NAMES]
    assert numbers == sorted(COLUMNS)
    assert set(NAMES) | {"pipeline"} <= set(entry_point.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, connection, name):
    frame = queries.queries()[name](spark, SF_DIR)
    number = int(re.match(r"op([0-9]+)_", name)[1])
    assert frame.columns == COLUMNS[number].split()
    twin = queries.oracle_sql().get(name)
    if twin:
        assert compare(frame, connection, twin) == "ok"
        described = connection.execute(f"DESCRIBE ({twin})").fetchall()
        assert {f.name: f.dataType.simpleString() for f in frame.schema} == {
            row[0]: TYPES[row[1]] for row in described
        }
    else:
        rows = frame.collect()
        docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
        assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in docs.collect())
