"""Benchmark decontamination: SimHash of item-sized windows, multi-index search, exact check.

A window has as many words as an item. Its similarity to the item is the weighted Dice
similarity of their five-word shingles: twice the shared weight over both weights, where a
shingle weighs its characters times its number. Every window is laid that can reach the
similarity: what it shares with the item is at most the weight of the item's shingles that
stand in it, in any order. All of them are fingerprinted. Fingerprints of windows and items
meet in a multi-index: of ``radius + 1`` blocks of bits, two
fingerprints within the radius share at least one whole. Those within the radius are then
compared exactly on the text of their shingles. Everything is DataFrame expressions.
"""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.llm.shared import (
    broadcast_if_small,
    plain_words,
    signed_bit_votes,
    text_of,
    word_shingles,
    written,
)

SHINGLE = 5
SIMILARITY = 0.8
# At 64 bits a pair of cosine 0.8 differs in 13 bits on average, with a deviation of 3.2.
RADIUS = 20
RESULT = (
    "doc_id long, item_id long, similarity double, start int, distance int, n_windows long"
)
# Up to so many rows a table is sent to all executors (about 40 MB); beyond, joins shuffle.
BROADCAST_ROWS = 1_000_000

def _shingle_hash(words, _):
    return F.xxhash64(*words)


def _terms(words):
    """Array of the shingles of a text as strings; a shorter text is one shingle."""
    return F.when(
        F.size(words) >= SHINGLE,
        word_shingles(words, SHINGLE, lambda w, _: F.concat_ws(" ", *w)),
    ).otherwise(
        F.when(F.size(words) > 0, F.array(F.concat_ws(" ", words))).otherwise(
            F.array().cast("array<string>")
        )
    )


def _items(benchmark):
    """(item_id, words, length, item): items with a word, one row per id and word sequence."""
    return (
        benchmark.select(F.col("item_id").cast("long"), plain_words(text_of()).alias("words"))
        .where(F.size("words") > 0)
        .distinct()
        .select(
            "item_id",
            "words",
            F.size("words").alias("length"),
            F.monotonically_increasing_id().alias("item"),
        )
    )


def _anchored(words, widths):
    """Array of (position, hash) of all shingles of the wanted widths."""
    found = [
        word_shingles(
            words, w, lambda ws, i: F.struct(i.alias("at"), _shingle_hash(ws, i).alias("hash"))
        )
        for w in widths
    ]
    return F.concat(*found) if len(found) > 1 else found[0]


def _places(split, widths):
    """(text_id, n_words, at, hash) of all shingles of the wanted widths of texts' words.

    The number of words is taken first, or each shingle would be made with a copy of them all.
    """
    return (
        split.select("text_id", "words", F.size("words").alias("n_words"))
        .select("text_id", "n_words", F.explode(_anchored(F.col("words"), widths)).alias("mark"))
        .select("text_id", "n_words", F.col("mark.at").alias("at"), F.col("mark.hash").alias("hash"))
    )


def _marks(items, widths):
    """(item, hash, held, weight, total) per distinct shingle of each item.

    ``weight`` is of all its occurrences, ``total`` of the whole item, and ``held`` says how
    many items hold the shingle.
    """
    width = F.least("length", F.lit(SHINGLE))
    hashes = reduce(
        lambda rest, w: F.when(width == w, _anchored(F.col("words"), [w])).otherwise(rest),
        widths,
        F.lit(None),
    )
    each = items.select("item", F.explode(F.arrays_zip(hashes.alias("mark"), _terms(F.col("words")).alias("term"))).alias("at"))
    counted = each.groupBy("item", F.col("at.mark.hash").alias("hash")).agg(
        F.sum(F.length("at.term")).alias("weight"), F.max(F.length("at.term")).alias("chars")
    )
    held = counted.groupBy("hash").agg(F.count("*").alias("held"))
    totals = counted.groupBy("item").agg(F.sum("weight").alias("total"))
    return counted.join(held, "hash").join(totals, "item")


def _least_shared(similarity):
    """The weight that a window has to share with an item, if it weighs no more than that."""
    return F.col("total") * (similarity / (2 - similarity)) - 1e-6


def _windows(texts, items, similarity, broadcast_rows):
    """(window, item, text_id, start, own, total, words): windows that can reach the similarity.

    ``own`` and ``total`` are the weights of the window and of the item. ``texts`` has (text_id, text). The shingles of the benchmark that stand in a text are its
    hits. A window that shares enough with an item holds one of the item's rarest shingles, of
    those that outweigh what it may lack; that gives pairs of text and item, so a shingle of
    many items makes none by itself. For each pair the weight of hits within a window is
    summed along the text: it changes only where a hit comes in or goes out.
    """
    widths = sorted(
        r["w"]
        for r in items.select(F.least("length", F.lit(SHINGLE)).alias("w")).distinct().collect()
    )  # at most SHINGLE numbers
    if not widths:
        return None
    marks = written(_marks(items, widths), "benchmark-shingles")
    known = broadcast_if_small(marks.select("hash").distinct(), broadcast_rows)
    split = texts.select("text_id", plain_words(F.col("text")).alias("words"))
    hits = written(
        _places(split, widths).join(known, "hash", "left_semi").distinct(),
        "benchmark-hits",
    )
    rarest = Window.partitionBy("item").orderBy("held", "hash").rowsBetween(
        Window.unboundedPreceding, -1
    )
    rare = (
        marks.withColumn("before", F.coalesce(F.sum("weight").over(rarest), F.lit(0)))
        .where(F.col("before") <= F.col("total") - _least_shared(similarity))
        .select("hash", "item")
    )
    pairs = hits.join(broadcast_if_small(rare, broadcast_rows), "hash")
    pairs = pairs.select("text_id", "item").distinct()
    length = items.select("item", "length")
    of_pair = (
        hits.join(pairs, "text_id")
        .join(broadcast_if_small(marks, broadcast_rows), ["item", "hash"])
        .join(broadcast_if_small(length, broadcast_rows), "item")
    )
    places = F.col("length") - F.least("length", F.lit(SHINGLE)) + 1
    changes = of_pair.select(
        "text_id",
        "item",
        "length",
        "n_words",
        "total",
        F.explode(
            F.array(
                F.struct((F.col("at") - places + 1).alias("start"), F.col("chars").alias("by")),
                F.struct((F.col("at") + 1).alias("start"), (-F.col("chars")).alias("by")),
            )
        ).alias("change"),
    )
    along = Window.partitionBy("text_id", "item").orderBy("start")
    steps = (
        changes.groupBy("text_id", "item", "length", "n_words", "total", F.col("change.start").alias("start"))
        .agg(F.sum("change.by").alias("by"))
        .withColumn("shared", F.sum("by").over(along))
        .withColumn("next", F.lead("start").over(along))
        .where(F.col("shared") >= _least_shared(similarity))
    )
    first = F.greatest("start", F.lit(0))
    last = F.least(F.col("next") - 1, F.greatest(F.col("n_words") - F.col("length"), F.lit(0)))
    starts = (
        steps.select("text_id", "item", "length", "total", "shared", first.alias("first"), last.alias("last"))
        .where("first <= last")
        .withColumn("start", F.explode(F.sequence("first", "last")))
        .drop("first", "last")
    )
    wanted = written(starts, "window-starts")
    chosen = split.join(
        broadcast_if_small(wanted.select("text_id").distinct(), broadcast_rows), "text_id", "left_semi"
    ).dropDuplicates(["text_id"])
    words = F.slice("words", F.col("start") + 1, F.col("length"))
    return written(
        chosen.join(broadcast_if_small(wanted, broadcast_rows), "text_id")
        .select("text_id", "item", "total", "shared", "start", words.alias("words"))
        .withColumn("own", _weight("words"))
        # The weight of the window itself is known now; it may be too much.
        .where(2 * F.col("shared") + 1e-6 >= (F.col("own") + F.col("total")) * similarity)
        .withColumn("window", F.monotonically_increasing_id())
        .select("window", "item", "text_id", "start", "own", "total", "words"),
        "windows",
    )


def _weight(words):
    """The weight of all shingles of a text."""
    return F.aggregate(
        F.transform(_terms(F.col(words)), lambda term: F.length(term)),
        F.lit(0),
        lambda total, x: total + x,
    )


def _prints(texts, key):
    """(key, print) of each text. Its votes meet in its task before anything is shuffled."""
    voices = texts.select(key, F.explode(_terms(F.col("words"))).alias("term")).select(
        key, F.xxhash64("term").alias("hash"), F.length("term").cast("long").alias("weight")
    )
    votes = signed_bit_votes([key], F.col("hash"), F.col("weight"))
    return votes(voices).withColumnRenamed("fingerprint", "print")


def _weighed(texts, key):
    """(key, term, weight) of the distinct shingles of each text."""
    return (
        texts.select(key, F.explode(_terms(F.col("words"))).alias("term"))
        .groupBy(key, "term")
        .agg((F.count("*") * F.length("term")).alias("weight"))
    )


def _blocks(column, radius):
    """Array of (number, bits) of ``radius + 1`` blocks of a fingerprint."""
    m = radius + 1
    edges = [64 * i // m for i in range(m + 1)]
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("no"),
                F.shiftrightunsigned(column, edges[i])
                .bitwiseAND(F.lit((1 << (edges[i + 1] - edges[i])) - 1))
                .alias("bits"),
            )
            for i in range(m)
        ]
    )


def within_radius(windows, items, radius, on="length"):
    """(window, item, distance) of all fingerprints within ``radius`` bits, by blocks.

    ``windows`` and ``items`` have a ``print`` each, the names ``window`` and ``item``, and
    the column ``on``, in which those that meet are equal.
    """
    blocks = F.inline(_blocks(F.col("print"), radius))
    left = windows.select("window", on, "print", blocks)
    right = items.select(
        *dict.fromkeys(["item", on]), F.col("print").alias("other"), blocks
    )
    distance = F.bit_count(F.col("print").bitwiseXOR(F.col("other")))
    return (
        left.join(right, [on, "no", "bits"])
        .select("window", "item", distance.alias("distance"))
        .where(F.col("distance") <= radius)
        .distinct()
    )


def _text_id(text):
    """128 bits of a text: copies are searched once."""
    return F.unhex(F.md5(text))


def _alike(texts, items, similarity, radius, broadcast_rows):
    """(text_id, item, start, similarity, distance) of the windows that reach the similarity."""
    windows = _windows(texts, items, similarity, broadcast_rows)
    if windows is None:
        return None
    window_prints = _prints(windows, "window").join(windows.select("window", "item"), "window")
    near = written(within_radius(window_prints, _prints(items, "item"), radius, "item"), "windows-near")
    # Partitioned by window, so that its shingles are counted without another shuffle.
    close = windows.join(near.select("window"), "window").repartition("window")
    terms = written(_weighed(items, "item").withColumnRenamed("weight", "other"), "item-terms")
    shared = (
        close.select("window", "item", F.explode(_terms(F.col("words"))).alias("term"))
        .groupBy("window", "item", "term")
        .agg((F.count("*") * F.length("term")).alias("weight"))
        .join(broadcast_if_small(terms, broadcast_rows), ["item", "term"])
        .groupBy("window")
        .agg(F.sum(F.least("weight", "other")).alias("shared"))
    )
    score = 2 * F.col("shared") / (F.col("own") + F.col("total"))
    return (
        windows.drop("words")
        .join(near.select("window", "distance"), "window")
        .join(shared, "window")
        .select("text_id", "item", "start", score.alias("similarity"), "distance")
        .where(F.col("similarity") >= similarity)
    )


def _texts(docs):
    text = text_of()
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), _text_id(text).alias("text_id"))


def contaminated(
    docs, benchmark, similarity=SIMILARITY, radius=RADIUS, broadcast_rows=BROADCAST_ROWS
):
    """(doc_id, item_id, similarity, start, distance, n_windows) of documents that hold an item.

    One row per pair with a window of at least ``similarity`` whose fingerprint is within
    ``radius`` bits of the item's: the best similarity, the first word of the first such
    window, its distance in bits, and the number of windows that reach the similarity,
    wherever they start. A document shorter than the
    item is one window. Items of fewer than five words are one shingle. Null and empty
    texts and items hold and are held by nothing; a null id is kept as null; repeated rows
    count once. An empty table on either side gives no rows. Only ``doc_id``, ``item_id``
    and ``text`` are read.
    """
    texts = _texts(docs)
    items = written(_items(benchmark), "items")
    alike = _alike(texts, items, similarity, radius, broadcast_rows)
    if alike is None:
        return docs.sparkSession.createDataFrame([], RESULT)
    first = F.struct((-F.col("similarity")).alias("unlike"), "start", "distance")
    per_text = (
        alike.join(items.select("item", "item_id", "length"), "item")
        .groupBy("text_id", "item_id")
        .agg(F.min(first).alias("first"), F.count_distinct("start", "length").alias("n_windows"))
    )
    return (
        texts.select("doc_id", "text_id")
        .join(broadcast_if_small(written(per_text, "contaminated"), broadcast_rows), "text_id")
        .dropDuplicates(["doc_id", "text_id", "item_id"])
        .groupBy("doc_id", "item_id")
        .agg(F.min("first").alias("first"), F.sum("n_windows").alias("n_windows"))
        .select(
            "doc_id",
            "item_id",
            (-F.col("first.unlike")).alias("similarity"),
            "first.start",
            "first.distance",
            "n_windows",
        )
    )


def keep_clean(
    docs, benchmark, similarity=SIMILARITY, radius=RADIUS, broadcast_rows=BROADCAST_ROWS
):
    """The rows of ``docs`` whose text holds no benchmark item, see :func:`contaminated`.

    Every row is judged by its own text, whatever its doc_id or whether it has one.
    """
    items = written(_items(benchmark), "items")
    alike = _alike(_texts(docs), items, similarity, radius, broadcast_rows)
    if alike is None:
        return docs
    held = written(alike.select("text_id").distinct(), "contaminated")
    # The row as one column, so that no name of its columns is taken.
    rows = docs.select(F.struct("*").alias("row"), _text_id(text_of()).alias("text_id"))
    return rows.join(broadcast_if_small(held, broadcast_rows), "text_id", "left_anti").select("row.*")
