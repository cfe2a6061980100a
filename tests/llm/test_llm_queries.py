"""The queries of the operators: their SQL, and the columns they promise."""

import compare
import corpus_pipeline
import pytest

from corpusflow.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op2_chat_format": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op3_license_scan": ["doc_id", "license", "containment", "first_word"],
    "op4_simhash": ["doc_id", "fingerprint", "component_id"],
    "op5_embedding_dedup": ["vec_id", "n_links", "component_id", "kept"],
    "op6_lattice_lm": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op7_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op8_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op9_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op10_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op11_spelling": ["word", "form", "root", "n", "n_near", "form_n"],
    "op12_filter_audit": [
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
    ],
    "op13_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, name):
    assert compare.differences(QUERIES[name](spark, SF), compare.connect(SF), ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    out = QUERIES[name](spark, SF)
    assert out.columns == COLUMNS[name]
    table = "conversations" if "conv_id" in out.columns else "embeddings" if "vec_id" in out.columns else "documents"
    if name in ("op11_spelling", "op12_filter_audit"):
        assert out.count() > 0
    elif name == "op13_packing":
        docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id")
        assert out.select("doc_id").distinct().count() == docs.distinct().count()
    elif name != "op3_license_scan":
        key = out.columns[0]
        rows = spark.read.parquet(f"{SF}/{table}.parquet").select(key).distinct().count()
        assert out.count() == rows + (name == "op2_chat_format")


def test_registered():
    assert set(QUERIES) == set(COLUMNS)
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "repeated_strings", "decontamination", "tokens"]
