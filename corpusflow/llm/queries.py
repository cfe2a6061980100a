"""The operators on the given tables: query name to function, and SQL where it can say the same."""

import public_tokenizers
from pyspark.sql import functions as F

from . import lattice_lm, sql
from .byte_bpe import round_trip
from .chat_format import digests, format_records, records_of
from .decontaminate import contamination
from .embedding_dedup import near_vectors
from .filter_audit import audit
from .license_scan import find_licenses
from .packing import pack
from .simhash_dedup import hex_digits, near_duplicates
from .spelling import spelling_variants
from .suffix_dedup import remove_repeats
from .token_files import read_token_files, write_token_files
from .toxicity import score_with_labels

QUERIES: dict = {}
ORACLE: dict[str, str] = {
    "op2_chat_format": sql.CHAT,
    "op5_embedding_dedup": sql.VECTORS,
    "op9_decontamination": sql.CONTAMINATION,
    "op11_spelling": sql.SPELLING,
    "op12_filter_audit": sql.AUDIT,
}


def _table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_suffix_dedup(spark, sf):
    out = remove_repeats(_table(spark, sf, "documents"), keep_text=False)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


QUERIES["op1_suffix_dedup"] = op1_suffix_dedup


def op7_byte_bpe(spark, sf):
    out = round_trip(_table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op8_token_files(spark, sf):
    path = public_tokenizers.path("word_bpe_49k.json")
    folder, manifest = write_token_files(_table(spark, sf, "documents"), path, end_id=1, vocab_size=49_408)
    out = read_token_files(spark, folder, manifest)
    return out.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES["op7_byte_bpe"] = op7_byte_bpe
QUERIES["op8_token_files"] = op8_token_files


def op4_simhash(spark, sf):
    out = near_duplicates(_table(spark, sf, "documents"))
    return out.select("doc_id", hex_digits("fp").alias("fingerprint"), "component_id")


def op5_embedding_dedup(spark, sf):
    return near_vectors(_table(spark, sf, "embeddings"))


def op9_decontamination(spark, sf):
    out = contamination(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))
    names = F.array_sort(F.transform("item_ids", lambda x: x.cast("string")))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


QUERIES["op4_simhash"] = op4_simhash
QUERIES["op5_embedding_dedup"] = op5_embedding_dedup
QUERIES["op9_decontamination"] = op9_decontamination


def op2_chat_format(spark, sf):
    turns = _table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    return digests(format_records(records_of(turns.unionAll(probe)), "conv_id", "record"), "conv_id")


def op3_license_scan(spark, sf):
    return find_licenses(_table(spark, sf, "documents"))


def op6_lattice_lm(spark, sf):
    docs = _table(spark, sf, "documents")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    out = lattice_lm.score_texts(docs, docs.filter(~held), public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_toxicity(spark, sf):
    return score_with_labels(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


QUERIES |= {
    "op2_chat_format": op2_chat_format,
    "op3_license_scan": op3_license_scan,
    "op6_lattice_lm": op6_lattice_lm,
    "op10_toxicity": op10_toxicity,
}


def op11_spelling(spark, sf):
    return spelling_variants(_table(spark, sf, "documents"), damage=97)


def op12_filter_audit(spark, sf):
    return audit(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op13_packing(spark, sf):
    out = pack(_table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return out.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


QUERIES |= {
    "op11_spelling": op11_spelling,
    "op12_filter_audit": op12_filter_audit,
    "op13_packing": op13_packing,
}
