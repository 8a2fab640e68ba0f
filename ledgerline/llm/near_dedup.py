"""SimHash near-duplicates by the index over positional bytes of ``byte_index``."""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from ledgerline.llm.byte_index import RADIUS, fingerprint_links, majority
from ledgerline.llm.components import connected_components
from ledgerline.llm.near_copies import keep_one, words_of  # noqa: F401
from ledgerline.llm.shared import hex16, map_in_arrow, written

SHINGLE = 3
SEED = 42


def simhash(text, shingle=SHINGLE):
    """The signed 64-bit fingerprint of one text: bits set in over half the shingle hashes."""
    words = words_of(text)
    if not words:
        return 0
    if len(words) < shingle:
        grams = [" ".join(words)]
    else:
        grams = map(" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), dtype="<u8")
    return majority(hashes)


def fingerprints(docs, shingle=SHINGLE):
    """(doc_id, fp) for every row; a null text is an empty one, which has fingerprint zero."""

    def each(batches):
        for batch in batches:
            made = [simhash(t or "", shingle) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(made, pa.int64())], ["doc_id", "fp"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_in_arrow(rows, each, "doc_id long, fp long")


def near_duplicates(docs, shingle=SHINGLE, radius=RADIUS):
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints link at ``radius`` or fewer differing bits; component_id is the smallest
    doc_id reachable over such links. Repeated rows keep their number and share a
    component; rows without a doc_id (null) are fingerprinted and linked, but never name a
    component unless all its ids are null. Empty and null texts have fingerprint zero. An
    empty table gives no rows. Only ``doc_id`` and ``text`` are read.
    """
    fps = written(fingerprints(docs, shingle), "fingerprints")
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    reached = connected_components(fingerprint_links(distinct.select("fp"), radius))
    grouped = distinct.join(reached, distinct["fp"] == reached["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    names = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    named = grouped.join(names, "component").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", hex16("fp").alias("fingerprint"), "component_id")
