"""Near copies for the pipeline: word shingles at an exact Jaccard similarity.

Texts of equal words are one node. Each has a SimHash fingerprint of its shingles; nodes whose
fingerprints link in the index over positional bytes are the first candidates. What links
leave apart, since a similarity of 0.8 is far beyond any radius such an index can search,
meets on all minima of a band of MinHash functions. Each candidate pair, of either kind, is
checked on its whole sets of shingles. In
a bucket all members are checked against one of them, and those that this leaves in another
group against others, as long as that finds copies: a bucket of near copies costs a few rows
per member, not a pair. What is left meets on its rarest shingles: sets that are alike share
one of the first few in any order, so a passage that many texts hold makes no pairs.
"""

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.byte_index import fingerprint_links, majority
from ledgerline.llm.components import connected_components
from ledgerline.llm.shared import (
    LOWER,
    SPACE,
    UPPER,
    broadcast_if_small,
    map_in_arrow,
    text_of,
    written,
)

SHINGLE = 5
# The least similarity of copies, as a fraction so that the check is exact.
LIKE, OF = 4, 5
# A pair of similarity s shares a band with 1 - (1 - s ** ROWS) ** BANDS: 0.99994 at 0.8.
BANDS, ROWS = 32, 6
SEED = 42
# The band of fingerprints that link, beside those of MinHash.
PRINTS = -1
# Up to so many texts are told to all tasks that read the table; beyond, the table is shuffled.
FEW_TEXTS = 250_000
_STEP = 1024
_FOLD = str.maketrans(UPPER, LOWER)
_OTHER_SPACE = str.maketrans({c: " " for c in SPACE})


def words_of(text):
    """Words between ASCII white space, A-Z in lower case."""
    return [w for w in text.translate(_FOLD).translate(_OTHER_SPACE).split(" ") if w]


def _mixed(x):
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_FACTORS = _mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)
_OFFSETS = _mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) << np.uint64(32))


def shingle_hashes(words, shingle=SHINGLE):
    """The sorted distinct 64-bit hashes of the shingles; fewer words are one shingle."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    width = min(shingle, len(words))
    each = np.fromiter(
        (xxhash.xxh64_intdigest(w, SEED) for w in words), dtype="<u8", count=len(words)
    )
    n = len(each) - width + 1
    hashes = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        hashes = _mixed(hashes * np.uint64(0x9E3779B97F4A7C15) + each[k : k + n])
    return np.unique(hashes)


def band_keys(hashes):
    """One long per band, of the minima of its functions over the set."""
    least = np.full(BANDS * ROWS, np.uint64(2**64 - 1))
    for start in range(0, len(hashes), _STEP):
        part = hashes[start : start + _STEP]
        np.minimum(
            least, (part * _FACTORS[:, None] + _OFFSETS[:, None]).min(axis=1), out=least
        )
    minima = least.reshape(BANDS, ROWS)
    keys = np.arange(BANDS, dtype=np.uint64)
    for row in range(ROWS):
        keys = _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + minima[:, row])
    return keys.view(np.int64)


def _node(words):
    """What texts of equal words share: 128 bits, so that different ones do not meet."""
    return xxhash.xxh3_128_digest(" ".join(words), SEED)


def _row_key():
    """Tells the rows of a table apart by doc_id, which may be null, and text: 128 bits."""
    id_ = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("-"))
    return F.unhex(F.md5(F.concat(id_, F.lit(" "), text_of())))


def _nodes(docs):
    """(doc_id, text_hash, key, node, fp, bands) per row."""

    def each(batches):
        for batch in batches:
            nodes, prints, bands = [], [], []
            for text in batch.column(3):
                words = words_of(text.as_py())
                hashes = shingle_hashes(words)
                nodes.append(_node(words))
                prints.append(majority(hashes))
                bands.append(band_keys(hashes))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array(nodes, pa.binary()),
                    pa.array(prints, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["doc_id", "text_hash", "key", "node", "fp", "bands"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long"), F.xxhash64(text_of()), _row_key(), text_of().alias("text")
    )
    schema = "doc_id long, text_hash long, key binary, node binary, fp long, bands array<long>"
    return map_in_arrow(rows, each, schema)


def _sets(docs, wanted):
    """(node, size, shingles) of the ``wanted`` (node, key), from the text of that key."""

    def each(batches):
        for batch in batches:
            sets = [shingle_hashes(words_of(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                ["node", "size", "shingles"],
            )

    texts = (
        docs.select(_row_key().alias("key"), text_of().alias("text"))
        .join(broadcast_if_small(wanted, FEW_TEXTS), "key")
        .dropDuplicates(["key"])
        .select("node", "text")
    )
    return map_in_arrow(texts, each, "node binary, size long, shingles array<long>")


def _alike(pairs, sets):
    """The pairs (u, v) whose sets of shingles reach the similarity."""
    sizes = sets.select("node", "size")
    near = (
        pairs.join(sizes.toDF("u", "nu"), "u")
        .join(sizes.toDF("v", "nv"), "v")
        .where(F.least("nu", "nv") * OF >= F.greatest("nu", "nv") * LIKE)
    )
    shared = F.size(F.array_intersect("su", "sv"))
    return (
        near.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("su")), "u")
        .join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("sv")), "v")
        .where(shared * OF >= (F.col("nu") + F.col("nv") - shared) * LIKE)
        .select("u", "v")
    )


def _in_mixed_buckets(crowded, reached):
    """Members of buckets whose members are in different groups, with their group."""
    grouped = crowded.join(reached, "node", "left").select(
        "band", "bucket", "node", "met", F.coalesce("component", "node").alias("component")
    )
    mixed = grouped.groupBy("band", "bucket").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi")
    ).where("lo <> hi").select("band", "bucket")
    return written(grouped.join(mixed, ["band", "bucket"]), "near-copy-members")


def _stars(grouped, turn):
    """Pairs (u, v) of a member of each bucket with those of other groups.

    The first turn takes the member that meets most others in all its buckets, as a text does
    of which others are copies; later ones take any, another one each turn.
    """
    order = F.lit(0) if turn else -F.col("met")
    one = F.struct(order, F.xxhash64("node", F.lit(turn)), "node", "component")
    hubs = grouped.groupBy("band", "bucket").agg(F.min(one).alias("hub"))
    return (
        grouped.join(hubs, ["band", "bucket"])
        .where("component <> hub.component")
        .select(F.least("node", "hub.node").alias("u"), F.greatest("node", "hub.node").alias("v"))
        .distinct()
    )


def _meeting(grouped, sets):
    """All pairs of members of different groups that may reach the similarity, and few others.

    Shingles are ordered by how many sets hold them, rarest first. Two sets at a Jaccard
    similarity of LIKE / OF share at least LIKE / (LIKE + OF) of the sum of their sizes.
    Their first shared shingle has, in each, no more before it than that leaves, and no less
    behind it. Sets meet on a shingle if sizes and both places of it allow for this.
    """
    members = grouped.select("node", "component").distinct().join(sets, "node")
    # A number is half as wide as a node, and there is a row per shingle.
    members = written(members.withColumn("member", F.monotonically_increasing_id()), "mixed-sets")
    terms = members.select("member", F.explode("shingles").alias("shingle"))
    held = terms.groupBy("shingle").agg(F.count("*").alias("held"))
    ordered = (
        terms.join(held, "shingle")
        .groupBy("member")
        .agg(F.sort_array(F.collect_list(F.struct("held", "shingle"))).alias("ordered"))
        .join(members.drop("shingles"), "member")
    )
    # The larger of two sets has the longer prefix: its partner may be as small as LIKE / OF.
    longest = F.col("size") - F.ceil(F.col("size") * LIKE / OF) + 1
    placed = written(
        ordered.select(
            "node",
            "component",
            "size",
            F.posexplode(F.slice("ordered", F.lit(1), longest.cast("int"))).alias("place", "term"),
        )
        .where("term.held > 1")
        .select("node", "component", "size", "place", F.col("term.shingle").alias("shingle")),
        "near-copy-prefixes",
    )
    short = F.col("size") - F.ceil(F.col("size") * (2 * LIKE) / (LIKE + OF))
    small = placed.where(F.col("place") <= short).toDF("su", "cu", "nu", "pu", "shingle")
    large = placed.toDF("sv", "cv", "nv", "pv", "shingle")
    in_order = (F.col("nu") < F.col("nv")) | ((F.col("nu") == F.col("nv")) & (F.col("su") < F.col("sv")))
    behind = F.least(F.col("nu") - F.col("pu"), F.col("nv") - F.col("pv"))
    return (
        small.join(
            large,
            (small["shingle"] == large["shingle"])
            & (F.col("cu") != F.col("cv"))
            & in_order
            & (F.col("nu") * OF >= F.col("nv") * LIKE)
            & (behind * (LIKE + OF) >= (F.col("nu") + F.col("nv")) * LIKE),
        )
        .select(F.least("su", "sv").alias("u"), F.greatest("su", "sv").alias("v"))
        .distinct()
    )


def _linked_prints(nodes):
    """(node, band, bucket): nodes by the group that the links of their fingerprints make."""
    reached = connected_components(fingerprint_links(nodes.select("fp").distinct()))
    return nodes.join(reached.toDF("fp", "least"), "fp", "left").select(
        "node", F.lit(PRINTS).alias("band"), F.coalesce("least", "fp").alias("bucket")
    )


def copy_links(docs, nodes):
    """Links (u, v) that connect the nodes whatever candidate pairs at the similarity connect."""
    # Copies meet as one node before they are put into buckets.
    different = nodes.dropDuplicates(["node"])
    members = different.select(
        "node", F.posexplode("bands").alias("band", "bucket")
    ).unionByName(_linked_prints(different.select("node", "fp")))
    shared = members.groupBy("band", "bucket").agg(F.count("*").alias("n")).where("n > 1")
    crowded = written(members.join(shared, ["band", "bucket"]), "near-copy-buckets")
    met = crowded.groupBy("node").agg(F.sum("n").alias("met"))
    crowded = written(crowded.drop("n").join(met, "node"), "near-copy-members")
    # A row per node before the join: copies are combined where they are read.
    one = nodes.groupBy("node").agg(F.min("key").alias("key"))
    one = one.join(crowded.select("node").distinct(), "node", "left_semi")
    sets = written(_sets(docs, one), "near-copy-sets")
    alone = crowded.withColumn("component", F.col("node"))
    pairs = written(_stars(alone.where(F.col("band") == PRINTS), 0), "near-copy-stars")
    links, turn = [written(_alike(pairs, sets), "near-copy-links")], 0
    grouped = _in_mixed_buckets(crowded, connected_components(links[0]))
    while True:
        pairs = written(_stars(grouped, turn), "near-copy-stars")
        links.append(written(_alike(pairs, sets), "near-copy-links"))
        reached = connected_components(reduce(DataFrame.unionByName, links))
        grouped = _in_mixed_buckets(crowded, reached)
        turn += 1
        # Worth another turn while most of what is compared turns out to be a copy.
        if 2 * links[-1].count() < pairs.count() or grouped.isEmpty():
            break
    links.append(_alike(_meeting(grouped, sets), sets))
    return reduce(DataFrame.unionByName, links)


def keep_one(docs):
    """The rows of ``docs`` but all but one of each group of near copies.

    Groups connect texts of equal words, and texts whose sets of SHINGLE-word shingles have
    a Jaccard similarity of at least LIKE / OF; the row with the least (doc_id, text hash)
    stays, a null doc_id before others. Rows are told apart by doc_id and text, so rows
    that share an id, or have none, are each decided on their own. Texts without words are
    equal. An empty table gives no rows. Only ``doc_id`` and ``text`` are read.
    """
    nodes = written(_nodes(docs), "near-copy-nodes")
    reached = connected_components(copy_links(docs, nodes))
    # The least row of each node first, so that any number of copies is one row in the join.
    least = nodes.groupBy("node").agg(F.min(F.struct("doc_id", "text_hash", "key")).alias("least"))
    kept = (
        least.join(reached, "node", "left")
        .groupBy(F.coalesce("component", "node").alias("group"))
        .agg(F.min("least").alias("least"))
        .select(F.col("least.key").alias("kept"))
    )
    # The row as one column, so that no name of its columns is taken.
    rows = docs.select(F.struct("*").alias("row"), _row_key().alias("key"))
    one = rows.join(kept, F.col("key") == F.col("kept"), "left_semi").dropDuplicates(["key"])
    return one.select("row.*")
