"""Importance resampling of documents towards the distribution of target texts.

Arrow kernels lower-case, split, flatten and dictionary-encode the words of a slice of texts.
Shifted dictionary indices form runs of two and three words: each distinct pair of (run so
far, next word) gets its CRC once, joined from the CRCs of its two sides, and is taken back to
its places. Counts per bucket are summed by Spark; their logarithmic gains, a table of fixed
size, are summed per document in a second pass over the texts.
"""

import hashlib
import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from ledgerline.llm.shared import map_in_arrow, text_of, written

NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SLICE_BYTES = 2_000_000
# Word positions whose runs are formed at once; a text of any length takes several.
WINDOW = 500_000


@dataclass(frozen=True)
class Settings:
    """What decides the result; the defaults are those of the registered query."""

    buckets: int = 10_000
    longest_run: int = 3
    scale: int = 1000
    least_words: int = 20
    percent: int = 5
    seed: int = 42


def _shift_tables():
    """Row k: what appending 2**k zero bytes does to each byte of a CRC, by its place."""
    step = np.array([zlib.crc32(bytes([b])) for b in range(256)], dtype=np.uint32)
    # The CRC of one byte has the register's start and end mixed in; taken out here.
    step ^= zlib.crc32(b"\0")
    places = np.arange(256, dtype=np.uint32)[None, :] << (np.uint32(8) * np.arange(4, dtype=np.uint32)[:, None])
    one = (places >> np.uint32(8)) ^ step[places & np.uint32(255)]
    tables = [one]
    for _ in range(31):
        tables.append(_shifted(tables[-1], tables[-1]))
    return np.stack(tables)


def _shifted(crc, table):
    out = table[0][crc & np.uint32(255)]
    for place in range(1, 4):
        out = out ^ table[place][(crc >> np.uint32(8 * place)) & np.uint32(255)]
    return out


_SHIFT = _shift_tables()


def joined_crc(left, right, right_bytes):
    """The CRCs of strings joined of two, from the CRCs of both and the length of the right."""
    out = left.copy()
    for k in range(int(right_bytes.max(initial=0)).bit_length()):
        long = np.flatnonzero(right_bytes >> k & 1)
        out[long] = _shifted(out[long], _SHIFT[k])
    return out ^ right


def _encoded(keys):
    """Index of the distinct value at each place, and the distinct values."""
    encoded = pa.array(keys).dictionary_encode()
    return encoded.indices.to_numpy(), encoded.dictionary.to_numpy()


def words_of(texts):
    """(first word of each text and the end, index of each word, the distinct words)."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), NOT_A_WORD)
    words, owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
    real = pc.greater(pc.binary_length(words), 0)
    words = pc.filter(words, real).dictionary_encode()
    counts = np.bincount(pc.filter(owner, real).to_numpy(), minlength=len(texts))
    return (
        np.concatenate([[0], np.cumsum(counts)]),
        words.indices.to_numpy(),
        words.dictionary.cast(pa.binary()).to_pylist(),
    )


def run_buckets(starts, index, words, settings):
    """Buckets of all runs, by window: (first position, one array per length of run).

    A run that would leave its text has bucket -1.
    """
    crc = np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words))
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    spaced = np.fromiter((zlib.crc32(b" " + w) for w in words), dtype=np.uint32, count=len(words))
    ends = np.repeat(starts[1:], np.diff(starts))
    for first in range(0, len(index), WINDOW):
        count = min(WINDOW, len(index) - first)
        here = index[first : first + count].astype(np.int64)
        run, run_crc, out = here, crc, [(crc % settings.buckets).astype(np.int64)[here]]
        for more in range(1, settings.longest_run):
            inside = np.flatnonzero(np.arange(first, first + count) + more < ends[first : first + count])
            bucket = np.full(count, -1, dtype=np.int64)
            following = index[first + more + inside].astype(np.int64)
            at, pairs = _encoded(run[inside] * len(words) + following)
            left, right = pairs // max(len(words), 1), pairs % max(len(words), 1)
            run_crc = joined_crc(run_crc[left], spaced[right], size[right] + 1)
            bucket[inside] = (run_crc % settings.buckets).astype(np.int64)[at]
            run = np.full(count, -1, dtype=np.int64)
            run[inside] = at
            out.append(bucket)
        yield first, out


def _slices(texts):
    """Parts of an array of texts of about SLICE_BYTES; a longer text stands alone."""
    sizes = pc.binary_length(texts).to_numpy()
    start, size = 0, 0
    for at, n in enumerate(sizes):
        if at > start and size + n > SLICE_BYTES:
            yield start, texts.slice(start, at - start)
            start, size = at, 0
        size += n
    if len(texts) > start:
        yield start, texts.slice(start)


def bucket_counts(texts, settings):
    """(bucket, n): how many features of all ``texts`` (a column ``text``) each bucket holds."""

    def each(batches):
        counts = np.zeros(settings.buckets, dtype=np.int64)
        for batch in batches:
            for _, part in _slices(batch.column(0)):
                for _, runs in run_buckets(*words_of(part), settings):
                    for bucket in runs:
                        counts += np.bincount(bucket[bucket >= 0], minlength=settings.buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(counts[used])], ["bucket", "n"]
        )

    each_task = map_in_arrow(texts.select(text_of().alias("text")), each, "bucket long, n long")
    return each_task.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs, target, settings):
    """The gain of each bucket, an array: one row per bucket comes to the driver."""
    raw, wanted = (np.zeros(settings.buckets, dtype=np.int64) for _ in range(2))
    for counts, df in ((raw, docs), (wanted, target)):
        for row in bucket_counts(df, settings).collect():
            counts[row["bucket"]] = row["n"]
    all_raw, all_wanted = float(raw.sum()), float(wanted.sum())
    return np.array(
        [
            math.floor(
                settings.scale
                * math.log(
                    (t + 1.0) * (all_raw + settings.buckets)
                    / ((s + 1.0) * (all_wanted + settings.buckets))
                )
            )
            for s, t in zip(raw.tolist(), wanted.tolist(), strict=True)
        ],
        dtype=np.int64,
    )


def gumbel_noise(doc_id, settings):
    """The part of a score that makes drawing the highest scores a draw by weight."""
    name = "" if doc_id is None else str(doc_id)
    h = int(hashlib.sha256(f"{settings.seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-settings.scale * math.log(-math.log((h + 0.5) / 4294967296)))


def _weighed(docs, gains, settings):
    """(doc_id, n_words, n_features, weight, score, text_hash) per row."""

    def each(batches):
        for batch in batches:
            ids = batch.column(0)
            n_words = np.zeros(len(ids), dtype=np.int64)
            weight = np.zeros(len(ids), dtype=np.int64)
            for start, part in _slices(batch.column(2)):
                starts, index, words = words_of(part)
                n_words[start : start + len(part)] = np.diff(starts)
                for first, runs in run_buckets(starts, index, words, settings):
                    gain = sum(np.where(b >= 0, gains[b], 0) for b in runs)
                    total = np.concatenate([[0], np.cumsum(gain)])
                    edge = np.clip(starts - first, 0, len(gain))
                    weight[start : start + len(part)] += total[edge[1:]] - total[edge[:-1]]
            features = sum(
                np.maximum(n_words - more, 0) for more in range(settings.longest_run)
            )
            noise = np.fromiter(
                (gumbel_noise(i, settings) for i in ids.to_pylist()), np.int64, len(ids)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    *(pa.array(a) for a in (n_words, features, weight, weight + noise)),
                    batch.column(1),
                ],
                ["doc_id", "n_words", "n_features", "weight", "score", "text_hash"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long"), F.xxhash64(text_of()).alias("text_hash"), text_of().alias("text")
    )
    schema = (
        "doc_id long, n_words long, n_features long, weight long, score long, text_hash long"
    )
    return map_in_arrow(rows, each, schema)


def _ranked(rows, order):
    """``rows`` with ``rank`` 1, 2, 3... in ``order``: a range shuffle and counts per partition.

    The sorted rows are written, so that positions and counts are of the same partitions;
    one count per partition comes to the driver.
    """
    sorted_rows = written(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .withColumn("place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)),
        "ranked",
    )
    sizes = sorted_rows.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()
    before, offsets = 0, []
    for row in sizes:
        offsets.append((row["part"], before))
        before += row["n"]
    offset = rows.sparkSession.createDataFrame(offsets, "part int, before long")
    return (
        sorted_rows.join(F.broadcast(offset), "part")
        .withColumn("rank", F.col("before") + F.col("place") + 1)
        .drop("part", "place", "before")
    ), before


def importance(docs, target, settings=Settings()):
    """(doc_id, n_features, weight, score, rank, n_words, text_hash) per row of ``docs``.

    Words are runs of digits, a-z (A-Z in lower case) and everything beyond ASCII; features
    are all runs of one to ``longest_run`` words. A feature's gain is the scaled logarithm of
    how much more frequent its bucket is in the texts of ``target`` than in those of
    ``docs``; ``weight`` sums them and ``score`` adds Gumbel noise by doc_id, so that the
    highest scores are a draw without replacement by weight. ``rank`` counts the ``percent``
    drawn of all rows with ``least_words``; it is null for others.

    A null text has no words: weight 0, and no rank. A null doc_id is kept, with the noise
    of an empty name, and comes last among equal scores; equal scores go by doc_id, then
    n_features and text hash, and whole repeats are ranked one after the other. An empty ``docs``
    gives no rows, an empty ``target`` counts of zero. Only ``doc_id`` and ``text`` are read.
    """
    gains = bucket_gains(docs, target, settings)
    rows = written(
        _weighed(docs, gains, settings).withColumn("row", F.monotonically_increasing_id()),
        "weighed",
    )
    long_enough = F.col("n_words") >= settings.least_words
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), "text_hash", "row"]
    ranked, n = _ranked(rows.where(long_enough), order)
    drawn = settings.percent * n // 100
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    out = ranked.unionByName(rows.where(~long_enough).withColumn("rank", F.lit(None).cast("long")))
    return out.select(
        "doc_id", "n_features", "weight", "score", "rank", "n_words", "text_hash"
    )


def resample(docs, target, settings=Settings()):
    """The rows of ``docs`` that are drawn, all columns and their ``rank``, see :func:`importance`.

    Of rows that share doc_id and text, as many are returned as are drawn, with the other
    columns of one of them. A column ``rank`` of ``docs`` is replaced.
    """
    drawn = importance(docs, target, settings).where("rank is not null")
    drawn = drawn.select(F.col("doc_id").alias("_of"), "text_hash", "rank")
    one = docs.drop("rank").select(F.struct("*").alias("_row"), F.xxhash64(text_of()).alias("_hash"))
    one = one.withColumn("_id", F.col("_row.doc_id").cast("long")).dropDuplicates(["_id", "_hash"])
    same = F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_hash") == F.col("text_hash"))
    return one.join(drawn, same).select("_row.*", "rank")


def draw_report(docs, target, settings=Settings()):
    """The columns of the registered query: doc_id, n_features, weight, score, rank."""
    return importance(docs, target, settings).drop("n_words", "text_hash")
