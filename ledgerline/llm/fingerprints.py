"""SimHash document fingerprints and a search by permuted block tables.

The terms of a text are its pairs of neighbouring words, in lower case (the single word of
a one-word text); a term weighs its characters, each time it stands there. The 64 bits of
its hash vote with that weight. Everything is DataFrame expressions.
"""

from functools import reduce
from itertools import combinations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.llm.shared import (
    broadcast_if_small,
    hex16,
    plain_words,
    signed_bit_votes,
    text_of,
    word_shingles,
    written,
)

BITS = 64
# Rows of a run of neighbouring documents that are looked at together.
RUN_ROWS = 2000
MAX_RUNS = 20_000
BLOCKS = 6
RADIUS = 3
# Documents whose doc_id it divides search for their neighbours.
ASKING = 20
# Up to so many results of theirs are sent to all tasks; more are shuffled.
FEW_ASKING = 1_000_000


def _terms(words):
    """Array of (hash, weight) of the terms of a text with these words."""

    def of(parts):
        size = reduce(lambda a, b: a + b, [F.length(p) for p in parts])
        return F.struct(F.xxhash64(*parts).alias("hash"), size.cast("long").alias("weight"))

    return F.when(F.size(words) > 1, word_shingles(words, 2, lambda w, _: of(w))).otherwise(
        F.transform(words, lambda w: of([w]))
    )


def fingerprint_texts(texts, keys):
    """(keys, fingerprint long) of ``texts`` (keys, text), one row per distinct ``keys``.

    Rows that share their keys vote together. A text without words has fingerprint zero.
    """
    split = texts.select(*keys, plain_words(text_of()).alias("words"))
    terms = split.select(*keys, F.explode_outer(_terms(F.col("words"))).alias("term"))
    return signed_bit_votes(keys, F.col("term.hash"), F.col("term.weight"))(terms)


def likeness(a, b):
    """Share of equal bits of two fingerprints."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(BITS)


def _runs(rows):
    """``rows`` with ``run``: ranges of doc_id of about RUN_ROWS rows, null ids in run -1.

    Bounds come from quantiles of doc_id; at most MAX_RUNS of them reach the driver.
    """
    n = rows.count()
    parts = max(1, min(MAX_RUNS, n // RUN_ROWS))
    cuts = []
    if parts > 1:
        cuts = rows.where("doc_id is not null").approxQuantile(
            "doc_id", [i / parts for i in range(1, parts)], 0.25 / parts
        )
    cuts = sorted(set(cuts))
    if not cuts:
        return rows.withColumn("run", F.when(F.col("doc_id").isNull(), -1).otherwise(0))
    splits = [float("-inf"), *cuts, float("inf")]
    bucketizer = Bucketizer(
        splits=splits, inputCol="_place", outputCol="_run", handleInvalid="keep"
    )
    placed = bucketizer.transform(
        rows.withColumn("_place", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))))
    )
    run = F.when(F.col("doc_id").isNull(), -1).otherwise(F.col("_run").cast("int"))
    return placed.withColumn("run", run).drop("_place", "_run")


def with_next(docs):
    """(run, doc_id, text, next_id, next_text) per row of ``docs``: the next document.

    The order is by doc_id, descending, then by text; null ids come last; after the last
    document comes the first. Each run also gets the first row of the run after it, so no
    window goes over the whole table.
    """
    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    placed = _runs(rows)
    firsts = written(
        placed.groupBy("run").agg(
            F.max("doc_id").alias("doc_id"), F.count("*").alias("n")
        ),
        "fingerprint-runs",
    )
    order = [r["run"] for r in firsts.select("run").orderBy(F.desc("run")).collect()]  # MAX_RUNS
    if not order:
        return placed.select(
            "run", "doc_id", "text", F.col("doc_id").alias("next_id"), F.col("text").alias("next_text")
        )
    following = {a: b for a, b in zip(order, order[1:] + order[:1], strict=True)}
    before = docs.sparkSession.createDataFrame(
        [(b, a) for a, b in following.items()], "run int, guest_of int"
    )
    leaders = (
        placed.join(
            F.broadcast(firsts.select(F.col("run").alias("_run"), F.col("doc_id").alias("_id"))),
            (F.col("run") == F.col("_run")) & F.col("doc_id").eqNullSafe(F.col("_id")),
        )
        .groupBy("run")
        .agg(F.min("text").alias("text"), F.first("doc_id").alias("doc_id"))
        .join(F.broadcast(before), "run")
        .select(F.col("guest_of").alias("run"), "doc_id", "text", F.lit(1).alias("guest"))
    )
    both = placed.select("run", "doc_id", "text", F.lit(0).alias("guest")).unionByName(leaders)
    window = Window.partitionBy("run").orderBy("guest", F.desc_nulls_last("doc_id"), "text")
    return (
        both.withColumn("next_id", F.lead("doc_id").over(window))
        .withColumn("next_text", F.lead("text").over(window))
        .where("guest = 0")
        .drop("guest")
    )


def edited(text, other):
    """``text`` whose last half of code points, rounded down, gives way to the first of ``other``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(other, F.lit(1), half))


def document_fingerprints(docs):
    """One row per row of ``docs``, with its fingerprint, its edited text's, and likenesses.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (16 hex
    digits), near_edited, near_next, n_near, nearest, nearest_distance. The last three are
    of documents whose doc_id ASKING divides, null for others: the number of other
    fingerprints among all within RADIUS bits, and the nearest of them (the least of equally
    near ones), null for none. The edited text and the next document are those of
    :func:`with_next`. A null text is empty; an empty text has fingerprint zero; a single
    document is its own next; repeated rows keep their number; an empty table gives no
    rows. Only ``doc_id`` and ``text`` are read.
    """
    rows = (
        with_next(docs)
        .withColumn("edited", edited(F.col("text"), F.col("next_text")))
        .withColumn("row", F.monotonically_increasing_id())
    )
    sha = F.sha2("edited", 256)
    halves = rows.select(
        "run",
        "row",
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        "next_id",
        F.xxhash64("next_text").alias("next_hash"),
        F.length("text").cast("long").alias("n_chars"),
        # As four longs, since aggregates of fixed width stay in the hash table.
        *[
            F.conv(F.substring(sha, 16 * i + 1, 16), 16, -10).cast("long").alias(f"sha{i}")
            for i in range(4)
        ],
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("part"), F.col("text").alias("text")),
                F.struct(F.lit(1).alias("part"), F.col("edited").alias("text")),
            )
        ).alias("half"),
    )
    carried = ["doc_id", "text_hash", "next_id", "next_hash", "n_chars", *[f"sha{i}" for i in range(4)]]
    split = halves.select("run", "row", *carried, "half.part", plain_words(F.col("half.text")).alias("words"))
    voted = signed_bit_votes(
        ["run", "row", "part"], F.col("term.hash"), F.col("term.weight"), carried
    )(
        split.select(
            "run", "row", "part", *carried, F.explode_outer(_terms(F.col("words"))).alias("term")
        )
    )
    # All of a run lies in one partition, so nothing here is shuffled again.
    prints = written(
        voted.groupBy("run", "row").agg(
            *[F.max(c).alias(c) for c in carried],
            F.max(F.when(F.col("part") == 0, F.col("fingerprint"))).alias("print"),
            F.max(F.when(F.col("part") == 1, F.col("fingerprint"))).alias("edited_print"),
        ),
        "fingerprints",
    )
    following = (
        prints.select(
            F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("print").alias("_next")
        )
        .groupBy("_id", "_hash")
        .agg(F.max("_next").alias("_next"))
    )
    asks = F.coalesce(F.col("doc_id") % ASKING == 0, F.lit(False))
    return prints.join(
        following,
        F.col("next_id").eqNullSafe(F.col("_id")) & (F.col("next_hash") == F.col("_hash")),
        "left",
    ).join(
        broadcast_if_small(written(_neighbours(prints), "neighbours"), FEW_ASKING),
        F.when(asks, F.col("print")) == F.col("of"),
        "left",
    ).select(
        "doc_id",
        "n_chars",
        F.concat(*[hex16(f"sha{i}") for i in range(4)]).alias("edited_sha256"),
        hex16("print").alias("fingerprint"),
        hex16("edited_print").alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("_next")).alias("near_next"),
        "n_near",
        F.when(F.col("nearest").isNotNull(), hex16("nearest")).alias("nearest"),
        "nearest_distance",
    )


def _lead_masks(radius, blocks):
    """The bits of each choice of blocks that ``radius`` differing bits must leave alone."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = []
    for lead in combinations(range(blocks), blocks - radius):
        mask = sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in lead)
        masks.append(mask - (1 << BITS) if mask >> (BITS - 1) else mask)
    return [F.lit(m).cast("long") for m in masks]


def _block_tables(column, masks):
    """Array of (table, key): the leading bits of a fingerprint in each table.

    A table is the fingerprints permuted so that its blocks lead; two fingerprints within
    the radius differ in at most ``radius`` blocks, so they agree on the lead of a table.
    """
    return F.array(
        *[
            F.struct(F.lit(i).alias("table"), column.bitwiseAND(m).alias("key"))
            for i, m in enumerate(masks)
        ]
    )


def within_radius(queries, fingerprints, radius=RADIUS, blocks=BLOCKS):
    """(query, found, distance): all distinct fingerprints within ``radius`` bits of a query's.

    Both sides have a column ``fingerprint`` (long); each distinct value counts once, so
    copies never multiply, and each pair comes from the first table that it agrees on. Null
    fingerprints find nothing.
    """
    if not 0 <= radius < blocks:
        raise ValueError("radius must be below the number of blocks")
    masks = _lead_masks(radius, blocks)
    differing = F.col("query").bitwiseXOR(F.col("found"))
    distance = F.bit_count(differing)
    first = F.lit(None).cast("int")
    for i, mask in reversed(list(enumerate(masks))):
        first = F.when(differing.bitwiseAND(mask) == 0, i).otherwise(first)

    def tables(df, name):
        one = df.select(F.col("fingerprint").alias(name)).where(F.col(name).isNotNull()).distinct()
        return one.select(name, F.inline(_block_tables(F.col(name), masks)))

    return (
        tables(queries, "query")
        .join(tables(fingerprints, "found"), ["table", "key"])
        .where((distance <= radius) & (F.col("table") == first))
        .select("query", "found", distance.alias("distance"))
    )


def _neighbours(prints):
    """(of, n_near, nearest, nearest_distance) per fingerprint of the documents that ask.

    Those whose doc_id is divisible by ASKING search all fingerprints for others.
    """
    one = F.col("print").alias("fingerprint")
    near = within_radius(prints.where(F.col("doc_id") % ASKING == 0).select(one), prints.select(one))
    other = F.col("distance") > 0
    best = F.min(F.when(other, F.struct("distance", "found")))
    return near.groupBy(F.col("query").alias("of")).agg(
        F.count_if(other).alias("n_near"),
        best["found"].alias("nearest"),
        best["distance"].cast("long").alias("nearest_distance"),
    )
