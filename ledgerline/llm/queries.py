"""One registered query per corpus operator, over its whole table."""

import public_tokenizers

from ledgerline.llm.class_lm import score_documents
from ledgerline.llm.decontaminate import contaminated
from ledgerline.llm.fingerprints import document_fingerprints
from ledgerline.llm.importance import draw_report
from ledgerline.llm.licenses import oracle as licenses_oracle
from ledgerline.llm.licenses import scan_licenses
from ledgerline.llm.near_dedup import near_duplicates
from ledgerline.llm.pii import personal_data
from ledgerline.llm.quality import score_quality
from ledgerline.llm.sentence_pieces import digest as digest_pieces
from ledgerline.llm.sentence_pieces import encode_decode as encode_pieces
from ledgerline.llm.shared import table
from ledgerline.llm.token_files import token_index
from ledgerline.llm.vector_codes import code_report
from ledgerline.llm.vector_codes import oracle as vector_codes_oracle
from ledgerline.llm.warc import archived_pages
from ledgerline.llm.word_bpe import digest, encode_decode

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def op1_personal_data(spark, sf_dir):
    return personal_data(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark, sf_dir):
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_benchmark_decontamination(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_class_lm(spark, sf_dir):
    return score_documents(table(spark, sf_dir, "documents"))


def op5_document_fingerprints(spark, sf_dir):
    return document_fingerprints(table(spark, sf_dir, "documents"))


def op6_token_files(spark, sf_dir):
    return token_index(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op7_warc(spark, sf_dir):
    return archived_pages(table(spark, sf_dir, "pages"))


def op8_license_scan(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents"))


def op9_word_bpe(spark, sf_dir):
    path = public_tokenizers.path(WORD_BPE)
    return digest(encode_decode(table(spark, sf_dir, "documents"), path))


def op10_simhash_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark, sf_dir):
    return draw_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_vector_codes(spark, sf_dir):
    return code_report(table(spark, sf_dir, "embeddings"))


def op13_sentence_pieces(spark, sf_dir):
    path = public_tokenizers.path(PIECES)
    return digest_pieces(encode_pieces(table(spark, sf_dir, "documents"), path))


QUERIES = {
    "op1_personal_data": op1_personal_data,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_class_lm": op4_class_lm,
    "op5_document_fingerprints": op5_document_fingerprints,
    "op6_token_files": op6_token_files,
    "op7_warc": op7_warc,
    "op8_license_scan": op8_license_scan,
    "op9_word_bpe": op9_word_bpe,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_vector_codes": op12_vector_codes,
    "op13_sentence_pieces": op13_sentence_pieces,
}

ORACLES = {"op8_license_scan": licenses_oracle(), "op12_vector_codes": vector_codes_oracle()}
