"""Inverted index over positional bytes of 64-bit fingerprints, with count filtering.

A fingerprint of 64 bits is eight bytes at eight positions. Two fingerprints that differ
in at most ``radius`` bits differ in at most that many bytes, so they share at least
``8 - radius`` positional bytes. The index has one posting for every set of that many
positions, so a posting list holds just the fingerprints whose tally of shared positional
bytes reaches the guaranteed minimum, and no pair has to be counted one byte at a time.
The members of a list agree but for ``radius`` bytes, so a list of distinct fingerprints
has at most ``256 ** radius`` of them, however many documents there are; there each is
verified against those at most ``radius`` bits away, found by flipping bits, not by pairs.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerline.llm.shared import map_in_arrow

RADIUS = 2
BYTES = 8


def majority(hashes):
    """The signed 64-bit fingerprint of hashes: bits set in over half of them."""
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 65536):
        part = hashes[start : start + 65536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def _masks(radius):
    """Per posting kind: the bits of the shared bytes."""
    return [
        sum(0xFF << (8 * b) for b in kept) for kept in combinations(range(BYTES), BYTES - radius)
    ]


def _signed(mask):
    return mask - (1 << 64) if mask >> 63 else mask


def _flips(mask, radius):
    """All changes of one to ``radius`` bits outside ``mask``."""
    free = [1 << i for i in range(64) if not mask >> i & 1]
    return [sum(c) for n in range(1, radius + 1) for c in combinations(free, n)]


def _list_links(kind, fps, radius, masks):
    """(fingerprint, least fingerprint it reaches) within the lists of one kind.

    ``fps`` are the sorted distinct fingerprints of whole lists. A flip changes only bytes
    outside the mask, so what it finds is in the same list.
    """
    here = np.arange(len(fps))
    left, right = [], []
    for flip in _flips(masks[kind], radius):
        other = fps ^ np.uint64(flip)
        at = np.searchsorted(fps, other)
        at[at == len(fps)] = 0
        hit = (fps[at] == other) & (at > here)
        left.append(here[hit])
        right.append(at[hit])
    a, b = np.concatenate(left), np.concatenate(right)
    root = here.copy()
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root == before).all():
            break
    moved = root != here
    return fps[moved], fps[root[moved]]


def fingerprint_links(distinct, radius=RADIUS):
    """Links (u, v) that connect all distinct ``fp`` within ``radius`` bits of each other.

    Per posting list they form a forest, not all pairs: whatever reaches each other by
    pairs within the radius does so by these links, and the other way round.
    """
    masks = _masks(radius)
    postings = distinct.select(
        "fp",
        F.posexplode(
            F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")) for m in masks])
        ).alias("kind", "shared"),
    )

    def links(batches):
        rest = None
        for batch in batches:
            kind = batch.column(0).to_numpy(zero_copy_only=False)
            shared = batch.column(1).to_numpy(zero_copy_only=False)
            fps = batch.column(2).to_numpy(zero_copy_only=False)
            if rest is not None:
                kind, shared, fps = (np.concatenate(x) for x in zip(rest, (kind, shared, fps)))
            if not len(fps):
                continue
            # The last list may go on in the next batch.
            new = np.flatnonzero((kind[1:] != kind[:-1]) | (shared[1:] != shared[:-1])) + 1
            cut = new[-1] if len(new) else 0
            rest = kind[cut:], shared[cut:], fps[cut:]
            if cut:
                yield from _whole(kind[:cut], shared[:cut], fps[:cut])
        if rest is not None:
            yield from _whole(*rest)

    def _whole(kind, shared, fps):
        same = (kind[1:] == kind[:-1]) & (shared[1:] == shared[:-1])
        many = np.append(same, False) | np.insert(same, 0, False)
        for k in np.unique(kind[many]):
            u, v = _list_links(k, np.sort(fps[many & (kind == k)].view(np.uint64)), radius, masks)
            if len(u):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"]
                )

    lists = (
        postings.select("kind", "shared", "fp")
        .repartition(F.col("kind"), F.col("shared"))
        .sortWithinPartitions("kind", "shared")
    )
    return map_in_arrow(lists, links, "u long, v long")
