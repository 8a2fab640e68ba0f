"""Compression of vectors to a code per part, with codebooks found in exact integers.

Every part position's pieces are sorted along a Hilbert curve and cut into flat blocks, each
with its box of least and greatest components and its sums. In each round a block's box
decides which entries can be the nearest of any piece in it. If one is left, the stored sums
and count stand for the whole block; else a kernel tests the pieces against the few left.
Only codebooks, of a size set by parameters, and their sums reach the driver.
"""

import hashlib
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.shared import broadcast_if_small, map_in_arrow, written

# Labels up to this many are sent to all tasks with their sums; more are shuffled.
FEW_LABELS = 100_000
# Doubles hold integers below it exactly.
EXACT = 2**53


@dataclass(frozen=True)
class Settings:
    """What decides the result, and last the sizes of blocks and of the curve's cells."""

    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024
    block: int = 512
    bits: int = 4


class Compressed(NamedTuple):
    """Per kept vector (vec_id, label, code, error), and the codebooks as (part, entry, position)."""

    rows: DataFrame
    codebooks: np.ndarray


def hilbert_keys(cells, bits):
    """The place along a Hilbert curve of each row of cells in [0, 2**bits), as sortable bytes."""
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(len(x)):
            turned = (x[i] >> level & 1).astype(bool)
            swapped = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swapped)
            x[i] = x[0] if i == 0 else x[i] ^ swapped
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0)
    spread = [(axis ^ flip) >> level & 1 for level in range(bits - 1, -1, -1) for axis in x]
    return np.packbits(np.stack(spread, axis=1).astype(np.uint8), axis=1)


def shortlist(low, high, sums, n, entries):
    """The entries, ascending, that may be the nearest to some point of a block's box.

    How much farther than a pivot an entry is is linear in the point, so its least value
    over the box is at a corner; an entry that is farther even there is never the nearest.
    """
    middle = sums / n
    pivot = int(np.argmin(((entries - middle) ** 2).sum(axis=1)))
    step = entries - entries[pivot]
    squares = (entries * entries).sum(axis=1)
    farther = squares - squares[pivot] - 2 * np.maximum(low * step, high * step).sum(axis=1)
    return np.flatnonzero(farther <= 0)


def nearest(points, entries):
    """Per point the index of the nearest entry, the lowest of equals, and the squared distance.

    Integers throughout: in doubles, where all products and sums are exact, or in longs.
    """
    greatest = max(np.abs(points).max(), np.abs(entries).max())
    kind = np.float64 if 4 * points.shape[1] * int(greatest) ** 2 < EXACT else np.int64
    x, c = points.astype(kind), entries.astype(kind)
    without = (c * c).sum(axis=1) - 2 * (x @ c.T)
    code = without.argmin(axis=1)
    squared = without[np.arange(len(code)), code] + (x * x).sum(axis=1)
    return code, squared.astype(np.int64)


def _kept(vectors):
    """(row, vec_id, label, vector) of the rows whose vector has finite components only."""
    infinite = float("inf")
    return (
        vectors.select(
            F.col("vec_id").cast("long"),
            F.col("label").cast("string"),
            F.col("embedding").cast("array<double>").alias("vector"),
        )
        .where("vector is not null")
        .where(~F.exists("vector", lambda x: x.isNull()))
        .where(~F.exists("vector", lambda x: F.isnan(x) | (F.abs(x) == infinite)))
        .withColumn("row", F.monotonically_increasing_id())
    )


def _integers(flat, settings):
    return np.floor(flat * settings.scale).astype(np.int64)


def _list_values(column):
    """All values of a column of lists, in order."""
    return column.flatten().to_numpy(zero_copy_only=False)


def _pieces(kept, width, greatest, kind, settings):
    """(part, place, row, piece) per part of each vector: where it lies on the curve, its integers."""

    def each(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = _integers(_list_values(batch.column(1)), settings)
            whole = whole.reshape(batch.num_rows, settings.parts, width)
            for part in range(settings.parts):
                points = whole[:, part]
                cells = ((points + greatest) << settings.bits) // (2 * greatest + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(points), part, dtype=np.int32)),
                        pa.array([k.tobytes() for k in hilbert_keys(cells, settings.bits)], pa.binary()),
                        batch.column(0),
                        pa.array([p.tobytes() for p in points.astype(kind)], pa.binary()),
                    ],
                    ["part", "place", "row", "piece"],
                )

    return map_in_arrow(
        kept.select("row", "vector"), each, "part int, place binary, row long, piece binary"
    )


def _blocks(pieces, width, kind, settings):
    """(part, n, rows, flat, low, high, sums) per block of pieces that are neighbours on the curve."""
    order = ["part", "place", "row"]

    def block(part, rows, points):
        rows, points = np.concatenate(rows), np.concatenate(points)
        return {
            "part": part,
            "n": len(rows),
            "rows": rows.astype("<i8").tobytes(),
            "flat": points.astype(kind).tobytes(),
            "low": points.min(axis=0).tolist(),
            "high": points.max(axis=0).tolist(),
            "sums": points.sum(axis=0).tolist(),
        }

    schema = pa.schema(
        [
            ("part", pa.int32()),
            ("n", pa.int64()),
            ("rows", pa.binary()),
            ("flat", pa.binary()),
            *[(c, pa.list_(pa.int64())) for c in ("low", "high", "sums")],
        ]
    )

    def each(batches):
        rows, points, held, now = [], [], 0, None
        for batch in batches:
            part_of = batch.column(0).to_numpy()
            row_of = batch.column(1).to_numpy()
            flat = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=kind)
            point_of = flat.reshape(-1, width).astype(np.int64)
            done, start = [], 0
            while start < len(part_of):
                if held and (part_of[start] != now or held == settings.block):
                    done.append(block(now, rows, points))
                    rows, points, held = [], [], 0
                now = int(part_of[start])
                end = start + int(np.searchsorted(part_of[start:], now, side="right"))
                end = min(end, start + settings.block - held)
                rows.append(row_of[start:end])
                points.append(point_of[start:end])
                held, start = held + end - start, end
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
        if held:
            yield pa.RecordBatch.from_pylist([block(now, rows, points)], schema)

    sorted_pieces = pieces.repartitionByRange(*order).sortWithinPartitions(*order)
    return map_in_arrow(
        sorted_pieces.select("part", "row", "piece"),
        each,
        "part int, n long, rows binary, flat binary, low array<long>, high array<long>, "
        "sums array<long>",
    )


def _block_parts(batch):
    """(part, n, low, high, sums, bytes of the pieces) per block of a batch."""
    boxes = [_list_values(batch.column(c)).reshape(batch.num_rows, -1) for c in ("low", "high", "sums")]
    return zip(
        batch.column("part").to_pylist(),
        batch.column("n").to_pylist(),
        *boxes,
        batch.column("flat"),
        strict=True,
    )


def _points(flat, width, kind):
    return np.frombuffer(flat.as_buffer(), dtype=kind).reshape(-1, width).astype(np.int64)


def _next_codebooks(blocks, codebooks, kind):
    """The codebooks after a round: each entry the floor of its pieces' mean, or as it was."""
    parts, entries, width = codebooks.shape

    def each(batches):
        sums = np.zeros((parts, entries, width), dtype=np.int64)
        counts = np.zeros((parts, entries), dtype=np.int64)
        for batch in batches:
            for part, n, low, high, total, flat in _block_parts(batch):
                few = shortlist(low, high, total, n, codebooks[part])
                if len(few) == 1:
                    counts[part, few[0]] += n
                    sums[part, few[0]] += total
                    continue
                points = _points(flat, width, kind)
                code, _ = nearest(points, codebooks[part][few])
                order = np.argsort(code, kind="stable")
                used, first, n_of = np.unique(code[order], return_index=True, return_counts=True)
                counts[part, few[used]] += n_of
                sums[part, few[used]] += np.add.reduceat(points[order], first, axis=0)
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part.astype(np.int32)),
                pa.array(entry.astype(np.int32)),
                pa.array(counts[part, entry]),
                pa.array(list(sums[part, entry]), pa.list_(pa.int64())),
            ],
            ["part", "entry", "n", "sums"],
        )

    columns = blocks.select("part", "n", "flat", "low", "high", "sums")
    found = (
        map_in_arrow(columns, each, "part int, entry int, n long, sums array<long>")
        .groupBy("part", "entry")
        .agg(
            F.sum("n").alias("n"),
            F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums"),
        )
    )
    out = codebooks.copy()
    for row in found.collect():
        out[row["part"], row["entry"]] = [s // row["n"] for s in row["sums"]]
    return out


def _codes(blocks, codebooks, kind):
    """(row, part, code, error) per piece: its nearest entry and the squared distance to it."""
    width = codebooks.shape[2]

    def each(batches):
        for batch in batches:
            for rows, (part, n, low, high, total, flat) in zip(
                batch.column("rows"), _block_parts(batch), strict=True
            ):
                few = shortlist(low, high, total, n, codebooks[part])
                code, error = nearest(_points(flat, width, kind), codebooks[part][few])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(rows.as_buffer(), dtype="<i8")),
                        pa.array(np.full(n, part, dtype=np.int32)),
                        pa.array(few[code].astype(np.int32)),
                        pa.array(error),
                    ],
                    ["row", "part", "code", "error"],
                )

    return map_in_arrow(blocks, each, "row long, part int, code int, error long")


def compress(vectors, settings=Settings()):
    """:class:`Compressed`: a code per vector of ``vectors`` and the codebooks it refers to.

    Components are scaled and floored to integers. Each part's codebook starts from the
    ``entries`` vectors of the smallest vec_id; rounds replace entries by the floored mean of
    the pieces nearest to them. ``code`` has the entry's index per part in hexadecimal digits,
    ``error`` the squared distances of all parts.

    Rows whose vector is null or has a null or non-finite component go. So do vectors of
    another length than the one of smallest vec_id among those that divide into the parts.
    A null vec_id comes last; rows that repeat one are told apart by their vectors, all are
    kept. Fewer vectors than entries give as many entries; no vectors, no rows and empty
    codebooks. Components so large that squared distances could leave 64 bits raise
    OverflowError. Only ``vec_id``, ``embedding`` and ``label`` are read.
    """
    parts = settings.parts
    kept = written(_kept(vectors), "vectors")
    order = [F.asc_nulls_last("vec_id"), "vector"]
    size = F.size("vector")
    shaped = kept.where((size > 0) & (size % parts == 0)).orderBy(*order).first()
    if shaped is None:
        nothing = kept.where("false").select(
            "vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")
        )
        return Compressed(nothing, np.zeros((parts, 0, 0), dtype=np.int64))
    dimension = len(shaped["vector"])
    width = dimension // parts
    kept = kept.where(size == dimension)
    greatest = kept.agg(
        F.max(F.array_max(F.transform("vector", lambda x: F.abs(x))))
    ).first()[0]
    greatest = int(greatest * settings.scale) + 1
    if dimension * (2 * greatest) ** 2 >= 2**62:
        raise OverflowError("Components are too large for squared distances of 64 bits.")
    kind = next(f"<i{b}" for b in (2, 4, 8) if greatest < 1 << (8 * b - 1))
    first = [r["vector"] for r in kept.orderBy(*order).limit(settings.entries).collect()]
    start = _integers(np.array(first), settings).reshape(len(first), parts, width)
    codebooks = np.ascontiguousarray(start.transpose(1, 0, 2))
    pieces = _pieces(kept, width, greatest, kind, settings)
    blocks = written(_blocks(pieces, width, kind, settings), "vector-blocks")
    for _ in range(settings.rounds):
        codebooks = _next_codebooks(blocks, codebooks, kind)
    digits = len(f"{settings.entries - 1:x}")
    by_part = [
        F.max(F.when(F.col("part") == p, F.lpad(F.lower(F.hex("code")), digits, "0")))
        for p in range(parts)
    ]
    codes = (
        _codes(blocks, codebooks, kind)
        .groupBy("row")
        .agg(F.concat(*by_part).alias("code"), F.sum("error").alias("error"))
    )
    rows = kept.select("row", "vec_id", "label").join(codes, "row").drop("row")
    return Compressed(rows, codebooks)


def code_report(vectors, settings=Settings()):
    """The columns of the registered query: vec_id, code, error, label_error, codebooks_sha256.

    ``label_error`` is the error of all vectors of the same label, those without one
    together; the digest is of the final codebooks. Cases as in :func:`compress`.
    """
    rows, codebooks = compress(vectors, settings)
    digest = hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()
    rows = written(rows, "vector-codes")
    by_label = rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return rows.join(
        broadcast_if_small(by_label, FEW_LABELS), F.col("label").eqNullSafe(F.col("of"))
    ).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def oracle(settings=Settings()):
    """The query as SQL: every piece against every entry, one common table per round."""
    distance = "list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))"
    assigned = f"""(
      SELECT vec_id, label, part, x, arg_min(entry, (d, entry)) AS entry, min(d) AS d
      FROM (SELECT p.*, entry, {distance} AS d FROM pieces p JOIN {{book}} USING (part))
      GROUP BY ALL)"""
    steps = [
        f"""kept AS (
      SELECT vec_id, label, list_transform(
        embedding, lambda x: CAST(floor({settings.scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""pieces AS (
      SELECT vec_id, label, part, list_slice(
        v, part * len(v) // {settings.parts} + 1, (part + 1) * len(v) // {settings.parts}) AS x
      FROM kept, range({settings.parts}) AS t(part))""",
        f"""book0 AS (
      SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS c
      FROM pieces QUALIFY entry < {settings.entries})""",
    ]
    for r in range(settings.rounds):
        steps += [
            f"near{r} AS {assigned.format(book=f'book{r}')}",
            f"""mean{r} AS (
      SELECT part, entry, list(m ORDER BY i) AS m FROM (
        SELECT part, entry, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS m
        FROM near{r}, range(1, (SELECT max(len(x)) + 1 FROM pieces)) AS t(i)
        GROUP BY part, entry, i) GROUP BY part, entry)""",
            f"""book{r + 1} AS (
      SELECT part, entry, coalesce(m, c) AS c
      FROM book{r} LEFT JOIN mean{r} USING (part, entry))""",
        ]
    last = f"book{settings.rounds}"
    digits = len(f"{settings.entries - 1:x}")
    return f"""WITH {", ".join(steps)},
    final AS {assigned.format(book=last)},
    coded AS (
      SELECT vec_id, label, string_agg(printf('%0{digits}x', entry), '' ORDER BY part) AS code,
        CAST(sum(d) AS BIGINT) AS error
      FROM final GROUP BY vec_id, label)
    SELECT vec_id, code, error,
      CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
      (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM {last})
        AS codebooks_sha256
    FROM coded"""
