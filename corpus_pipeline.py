"""The corpus pipeline: stages over documents, each written as Parquet and read again."""

import public_tokenizers

from ledgerline.llm.decontaminate import keep_clean
from ledgerline.llm.near_copies import keep_one
from ledgerline.llm.pii import redact
from ledgerline.llm.quality import keep_good
from ledgerline.llm.shared import table, written
from ledgerline.llm.word_bpe import digest, encode_decode

TOKENIZER = "word_bpe_49k.json"


def quality(spark, docs, sf_dir):
    """Documents that the quality classifier rejects go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark, docs, sf_dir):
    """One document of each group of near copies stays."""
    return keep_one(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that hold a benchmark item go."""
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark, docs, sf_dir):
    """Personal data give way to the names of their kinds."""
    return redact(docs)


def word_bpe(spark, docs, sf_dir):
    """Per document: the number of tokens, digests of the ids and of the text they decode to."""
    return digest(encode_decode(docs, public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("word_bpe", word_bpe),
]

# Near duplicates and learned scores have no SQL form; tests/llm hold brute-force versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages in order, from the whole of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
