"""Registered queries: SQL where there is some, names and columns of the contracts."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_html_text": "page_id url text n_chars", "op2_quality": "doc_id held_out score predicted",
    "op3_licenses": "file_id path license origin cosine from_directory",
    "op4_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op5_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op6_secrets": "doc_id n_assign n_access n_hex base_sha256 spans", "op7_token_files": "doc_id start n_tokens ids_crc32",
    "op8_exact_dedup": "doc_id keep_id group_size kept text_sha256", "op9_simhash": "doc_id fingerprint component_id",
    "op10_mixing": "doc_id size source_size target taken copies position",
    "op11_merkle": "doc_id leaf subroot root proof_sha256 folded_root verified",
    "op12_chat_tree": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op13_periodic_runs": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "pipeline": "doc_id start n_tokens ids_crc32",
}


@pytest.mark.parametrize("name", COLUMNS)
def test_query(spark, name):
    df = entry.queries()[name](spark, SF)
    assert set(df.columns) == set(COLUMNS[name].split())
    if name in entry.oracle_sql():
        assert differences(df, connect(SF).sql(entry.oracle_sql()[name])) == []
    elif name != "pipeline":
        table = "pages" if name == "op1_html_text" else "documents"
        assert df.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
