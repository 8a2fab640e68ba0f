"""What the corpus operators share: inputs, written intermediate tables, native word terms."""

import os

import numpy as np
from pyspark.sql import functions as F

from ledgerline.session import bound_batches, scratch_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = " \t\n\v\f\r"
# Two 32-bit counters in one long: bit i of a hash and bit i + 32.
PAIR = 0x0000000100000001
HALF = 0xFFFFFFFF


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(column="text"):
    """The text, or the empty string for null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def written(df, purpose):
    """The rows of ``df`` from Parquet files in the shared folder.

    Cuts the lineage: a lost executor costs a read of files, not the work before them.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def find_package_on_workers(spark):
    """Python workers find this package where the driver does, if it lies there for them too.

    Elsewhere it must be installed on the executors or shipped with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def map_in_arrow(df, each, schema):
    find_package_on_workers(df.sparkSession)
    bound_batches(df.sparkSession)
    return df.mapInArrow(each, schema)


def map_in_pandas(df, each, schema):
    find_package_on_workers(df.sparkSession)
    bound_batches(df.sparkSession)
    return df.mapInPandas(each, schema)


def runs(sizes, most):
    """(start, end) of runs of neighbours that add up to at most ``most``, a larger one alone."""
    start, size = 0, 0
    for at, more in enumerate(sizes):
        if size and size + more > most:
            yield start, at
            start, size = at, 0
        size += more
    if len(sizes) > start:
        yield start, len(sizes)


def text_slices(texts, chars=2_000_000):
    """(start, end) of runs of texts of at most about ``chars`` characters, a longer one alone."""
    return runs(list(map(len, texts)), chars)


def gathered(ids, sizes, order):
    """The ids of words, of which there are ``sizes`` each, in this order; where each one ends."""
    first = (np.cumsum(sizes) - sizes)[order]
    taken = sizes[order]
    ends = np.cumsum(taken)
    if not len(order):
        return ids[:0], ends
    return ids[np.repeat(first - ends + taken, taken) + np.arange(ends[-1])], ends


def ascii_lower(column):
    return F.translate(column, UPPER, LOWER)


def space_words(column):
    """Runs of anything but ASCII white space, in order; none for an empty text."""
    trimmed = F.btrim(column, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+")
    )


def plain_words(column):
    """Lower-case runs of letters and digits, in order."""
    # a-z and 0-9 are named first as they are found faster than by their category.
    return F.array_remove(F.split(F.lower(column), r"[^a-z0-9\p{L}\p{N}]+"), "")


def signed_bit_votes(keys, term, weight, carried=()):
    """Aggregates one row per ``keys``: the fingerprint of weighted 64-bit term hashes.

    Columns ``carried`` have one value per key and come along.

    Every term votes with its weight for its set bits and against the others; a bit of
    the fingerprint is set if the votes for it are over half of all. ``df`` rows whose
    term is null (a text without terms) give zero. The counters of bits i and i + 32
    share a long, so 32 sums do for 64 bits, as long as all weights of a text add up
    to less than 2**31.
    """

    def fingerprint(df):
        spread = [
            F.sum(F.shiftrightunsigned(term, i).bitwiseAND(F.lit(PAIR)) * weight).alias(f"_v{i}")
            for i in range(32)
        ]
        votes = df.groupBy(*keys).agg(
            *spread,
            F.sum(F.when(term.isNotNull(), weight)).alias("_all"),
            *[F.max(c).alias(c) for c in carried],
        )
        bits = F.lit(0).cast("long")
        for i in range(64):
            counted = (
                F.shiftrightunsigned(F.col(f"_v{i - 32}"), 32)
                if i >= 32
                else F.col(f"_v{i}").bitwiseAND(F.lit(HALF))
            )
            one = (1 << i) if i < 63 else -(1 << 63)
            bits = bits.bitwiseOR(
                F.when(counted * 2 > F.col("_all"), F.lit(one)).otherwise(F.lit(0)).cast("long")
            )
        return votes.select(*keys, *carried, bits.alias("fingerprint"))

    return fingerprint


def hex16(column):
    """A long as 16 lower-case hexadecimal digits."""
    return F.lpad(F.lower(F.hex(column)), 16, "0")


def broadcast_if_small(df, rows):
    """``df``, marked for broadcast if it has at most ``rows`` rows; counts it.

    Beyond that bound Spark shuffles both sides of the join, whose result is the same.
    """
    return F.broadcast(df) if df.count() <= rows else df


def word_shingles(words, width, item):
    """Array of ``item(list of width word columns, first position)`` over all positions."""
    starts = F.slice(words, 1, F.greatest(F.size(words) - (width - 1), F.lit(0)))
    return F.transform(
        starts, lambda w, i: item([w, *[F.get(words, i + k) for k in range(1, width)]], i)
    )
