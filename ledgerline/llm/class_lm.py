"""Brown class-based bigram scores.

The classes come from exchange clustering. The most frequent words, the core, are exchanged
one by one, beside groups of the other words by their ending. Then each other word that
occurs more than once chooses its class by its own neighbours, and the core is exchanged
again. Words seen once stand for those never seen: they stay together by their ending. Class
transitions and word emissions give a smoothed probability.

The corpus is cut into chunks of a bounded number of tokens, a row each. A chunk sends each
of its distinct words once, with the classes of its neighbours, is sent back their counts
and classes, and keeps its texts as symbol codes from then on. So no vocabulary is ever held
in one place, however large it grows; what the driver sees are counts between symbols and
classes, of a size set by the parameters.
"""

import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import functions as F

from ledgerline.llm.shared import (
    LOWER,
    SPACE,
    UPPER,
    find_package_on_workers,
    map_in_arrow,
    text_of,
    written,
)

HELD_OUT_OF, HELD_OUT = 7, 2
CHUNK_TOKENS = 2_000_000
ENDINGS = 16
BANDS = 48
_FOLD = str.maketrans(UPPER + SPACE, LOWER + " " * len(SPACE))


@dataclass(frozen=True)
class Settings:
    """``words``: words exchanged one by one; ``prior``: weight of the class frequencies."""

    words: int = 2000
    classes: int = 48
    rounds: int = 12
    prior: float = 20.0

    @property
    def end(self):
        """The symbol at the end of each text, and before its first word."""
        return self.words + (BANDS + 1) * ENDINGS

    @property
    def symbols(self):
        return self.end + 1

    @property
    def once(self):
        """The first symbol of words seen once; code and symbol are equal up to here."""
        return self.words + BANDS * ENDINGS

    @property
    def unknown(self):
        """The first code of words not seen; their symbols are those of words seen once."""
        return self.symbols


def is_held_out(doc_id):
    return F.coalesce(
        F.pmod(F.crc32(doc_id.cast("string")), F.lit(HELD_OUT_OF)) == HELD_OUT, F.lit(False)
    )


class _Numbers(dict):
    """Numbers words in the order of their first occurrence."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def words_of(text):
    return [w for w in text.translate(_FOLD).split(" ") if w]


def ending_of(word):
    """The group of a word's last two letters or digits."""
    letters = "".join(c for c in word[-6:] if c.isalnum())
    return zlib.crc32(letters[-2:].encode()) % ENDINGS


def _new_chunk():
    """A number no other chunk has, of this or another attempt."""
    return uuid.uuid4().int >> 65


CHUNKS = (
    "chunk long, doc_ids array<long>, held array<boolean>, sizes array<long>, ids binary, "
    "words binary, endings binary, counts binary"
)


def _chunks(docs):
    """A row per chunk: its documents as numbers of words, and its distinct words.

    ``sizes`` has the number of words of each document, ``counts`` those of each word in the
    training texts of the chunk.
    """

    def each(batches):
        packer = zstandard.ZstdCompressor(level=1)

        def row():
            each_size = [len(i) for i in ids]
            both = np.concatenate(ids)
            trained = both[np.repeat(~np.array(held), each_size)]
            listed = list(numbers)
            binaries = [
                both.tobytes(),
                " ".join(listed).encode("utf-8", "surrogatepass"),
                bytes(map(ending_of, listed)),
                np.bincount(trained, minlength=len(listed)).astype("<u4").tobytes(),
            ]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([_new_chunk()], pa.int64()),
                    pa.array([doc_ids], pa.list_(pa.int64())),
                    pa.array([held], pa.list_(pa.bool_())),
                    pa.array([each_size], pa.list_(pa.int64())),
                    *[pa.array([packer.compress(b)], pa.binary()) for b in binaries],
                ],
                [c.split()[0] for c in CHUNKS.split(", ")],
            )

        numbers, doc_ids, held, ids, tokens = _Numbers(), [], [], [], 0
        for batch in batches:
            for doc_id, held_out, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                doc_ids.append(doc_id)
                held.append(held_out)
                ids.append(np.array(list(map(numbers.__getitem__, words_of(text))), dtype="<u4"))
                tokens += len(ids[-1]) + 1
                if tokens >= CHUNK_TOKENS:
                    yield row()
                    numbers, doc_ids, held, ids, tokens = _Numbers(), [], [], [], 0
        if ids:
            yield row()

    return map_in_arrow(docs, each, CHUNKS)


class _Chunk:
    """A row of the chunks, unpacked; ``core`` has the numbers of the most frequent words."""

    def __init__(self, row, core):
        unpack = zstandard.ZstdDecompressor().decompress
        self.chunk, self.doc_ids = row["chunk"], row["doc_ids"]
        self.held = np.array(row["held"], dtype=bool)
        self.sizes = np.array(row["sizes"], dtype=np.int64)
        self.ids = np.frombuffer(unpack(row["ids"]), dtype="<u4")
        words = unpack(row["words"]).decode("utf-8", "surrogatepass")
        self.words = words.split(" ") if words else []
        self.endings = np.frombuffer(unpack(row["endings"]), dtype=np.uint8).astype(np.int64)
        self.counts = np.frombuffer(unpack(row["counts"]), dtype="<u4").astype(np.int64)
        self.core = np.array([core.get(w, -1) for w in self.words], dtype=np.int64)

    def first_symbols(self, s):
        """By word, before it has a class of its own: words beyond the core by their ending."""
        return np.where(self.core >= 0, self.core, s.words + self.endings)

    def training(self):
        """(words of the training texts in order, number of words of each text)."""
        return self.ids[np.repeat(~self.held, self.sizes)], self.sizes[~self.held]


def _chain(values, sizes, end):
    """The values of texts with ``end`` before, between and behind them, and where they are."""
    at = np.arange(len(values)) + np.repeat(np.arange(len(sizes)), sizes) + 1
    chain = np.full(len(values) + len(sizes) + 1, end, dtype=np.int64)
    chain[at] = values
    return chain, at


def _opened(batches, core):
    for batch in batches:
        for row in batch.to_pylist():
            yield _Chunk(row, core)


def _core(chunks, settings):
    """The most frequent words, counted where a chunk holds them twice, by rank."""

    def each(batches):
        for c in _opened(batches, {}):
            twice = np.flatnonzero(c.counts > 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([c.words[i] for i in twice], pa.string()), pa.array(c.counts[twice])],
                ["word", "n"],
            )

    counted = map_in_arrow(chunks, each, "word string, n long").groupBy("word")
    rows = (
        counted.agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(settings.words).collect()
    )  # settings.words rows
    return {r["word"]: i for i, r in enumerate(rows)}


CONTEXTS = "chunk long, number int, word string, n long, before binary, after binary"


def _contexts(chunks, core, classes, settings):
    """Per chunk and word: its count, and the classes of its neighbours, one per occurrence.

    Words of the core have no neighbours here, since they have been exchanged.
    """
    s = settings
    kind = np.uint8 if s.classes < 256 else np.uint16

    def each(batches):
        for c in _opened(batches, core):
            ids, sizes = c.training()
            chain, at = _chain(classes[c.first_symbols(s)][ids], sizes, s.classes)
            chain = chain.astype(kind)
            rest = np.flatnonzero(c.core[ids] < 0)
            rest = rest[np.argsort(ids[rest], kind="stable")]
            ends = np.cumsum(np.bincount(ids[rest], minlength=len(c.words)))
            offsets = np.concatenate([[0], ends]) * chain.itemsize
            columns = [
                pa.array(np.full(len(c.words), c.chunk, dtype=np.int64)),
                pa.array(np.arange(len(c.words), dtype=np.int32)),
                pa.array(c.words, pa.string()),
                pa.array(c.counts),
            ]
            for near in (chain[at[rest] - 1], chain[at[rest] + 1]):
                buffers = [None, *map(pa.py_buffer, (offsets.astype(np.int32), near.tobytes()))]
                columns.append(pa.Array.from_buffers(pa.binary(), len(c.words), buffers))
            whole = pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in CONTEXTS.split(", ")])
            for start in range(0, len(c.words), 20_000):
                yield whole.slice(start, 20_000)

    return map_in_arrow(chunks, each, CONTEXTS)


def _neighbours(column, word, words, kind, size):
    """How often each class occurs in the lists of each word, as a matrix."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    if offsets[-1] == offsets[0]:
        return np.zeros((words, size))
    near = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]].view(kind)
    of = np.repeat(word, np.diff(offsets) // near.itemsize)
    return np.bincount(of * size + near, minlength=words * size).reshape(words, size)


PLACED = "chunk long, number int, n long, class int, first boolean"


def _placed(contexts, classes, left, settings):
    """Per chunk and word: its count in all training texts and the class its neighbours choose.

    That is the class to which the likelihood of the class bigrams rises most, with the
    classes of its neighbours as they are. ``first`` marks one row of each word.
    """
    s = settings
    kind = np.uint8 if s.classes < 256 else np.uint16
    matrix = _class_matrix(left, classes, s.classes + 1) + 0.5
    # The slopes of the likelihood: a word is too rare to change a cell by much itself.
    from_class = (np.log(matrix) - np.log(matrix.sum(axis=0)))[:, :-1]
    to_class = (np.log(matrix) - np.log(matrix.sum(axis=1, keepdims=True)))[:-1].T

    def whole(rows, starts):
        first = np.zeros(rows.num_rows, dtype=bool)
        first[starts] = True
        word = np.cumsum(first) - 1
        n = np.add.reduceat(rows.column(3).to_numpy(), starts)
        before, after = (
            _neighbours(rows.column(i), word, len(starts), kind, s.classes + 1) for i in (4, 5)
        )
        chosen = np.argmax(before @ from_class + after @ to_class, axis=1)
        return pa.RecordBatch.from_arrays(
            [
                rows.column(0),
                rows.column(1),
                pa.array(n[word]),
                pa.array(chosen[word].astype(np.int32)),
                pa.array(first),
            ],
            [x.split()[0] for x in PLACED.split(", ")],
        )

    def each(batches):
        rest = None
        for batch in batches:
            if rest is not None:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            words = batch.column(2)
            other = pc.not_equal(words.slice(1), words.slice(0, len(words) - 1))
            starts = np.flatnonzero(np.concatenate([[True], other.to_numpy(zero_copy_only=False)]))
            # The last word may go on in the next batch.
            if len(starts) > 1:
                yield whole(batch.slice(0, starts[-1]), starts[:-1])
            rest = batch.slice(starts[-1])
        if rest is not None:
            yield whole(rest, np.zeros(1, dtype=np.int64))

    ordered = contexts.repartition("word").sortWithinPartitions("word")
    return map_in_arrow(ordered, each, PLACED)


CODED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, log_more double, "
    "log_band double, codes binary"
)


def _coded(chunks, words, core, settings):
    """Documents as symbol codes, a compressed byte pair per token, with sums over counts.

    ``log_more`` is the sum of log10(count + 1), ``log_band`` that of log10(count) of the
    words beyond the core; the end of the text is in none of the columns but n_tokens.
    """
    s = settings

    def each(rows, found):
        (c,) = _opened(rows.to_batches(), core)
        number = found.column("number").to_numpy()
        count = np.zeros(len(number), dtype=np.int64)
        placed = np.zeros(len(number), dtype=np.int64)
        count[number] = found.column("n").to_numpy()
        placed[number] = found.column("class").to_numpy()
        code = np.select(
            [c.core >= 0, count >= 2, count == 1],
            [c.core, s.words + placed, s.once + c.endings],
            s.unknown + c.endings,
        )
        in_band = (code >= s.words) & (code < s.once)
        log_more = np.log10(count + 1.0)
        log_band = np.where(in_band, np.log10(np.maximum(count, 1)), 0.0)
        packer = zstandard.ZstdCompressor(level=1)
        ids = np.split(c.ids, np.cumsum(c.sizes)[:-1])
        return pa.table(
            {
                "doc_id": pa.array(c.doc_ids, pa.int64()),
                "held_out": pa.array(c.held),
                "n_tokens": pa.array(c.sizes + 1),
                "n_known": pa.array([int((count[i] > 0).sum()) for i in ids], pa.int64()),
                "log_more": pa.array([float(log_more[i].sum()) for i in ids], pa.float64()),
                "log_band": pa.array([float(log_band[i].sum()) for i in ids], pa.float64()),
                "codes": pa.array(
                    [packer.compress(code[i].astype("<u2").tobytes()) for i in ids], pa.binary()
                ),
            }
        )

    find_package_on_workers(chunks.sparkSession)
    return chunks.groupBy("chunk").cogroup(words.groupBy("chunk")).applyInArrow(each, CODED)


def _unpacked(packed):
    """The codes of each text."""
    unpacker = zstandard.ZstdDecompressor()
    return [np.frombuffer(unpacker.decompress(p), dtype="<u2") for p in packed]


def _symbols(codes, s):
    symbols = np.asarray(codes, dtype=np.int64)
    return np.where(symbols >= s.unknown, symbols - s.unknown + s.once, symbols)


def _pair_counts(chains, s):
    """Batches of (a, b, n) over all the chains."""
    pairs = np.zeros(0, dtype=np.int64)
    counts = np.zeros(0, dtype=np.int64)
    for chain in chains:
        new, n = np.unique(chain[:-1] * s.symbols + chain[1:], return_counts=True)
        both = np.concatenate([pairs, new])
        pairs, where = np.unique(both, return_inverse=True)
        counts = np.bincount(where, np.concatenate([counts, n])).astype(np.int64)
    # At most one row per pair of symbols, whatever the size of the partition.
    for start in range(0, len(pairs), 100_000):
        some = pairs[start : start + 100_000]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array((some // s.symbols).astype(np.int32)),
                pa.array((some % s.symbols).astype(np.int32)),
                pa.array(counts[start : start + 100_000]),
            ],
            ["a", "b", "n"],
        )


def _summed(df, each):
    return map_in_arrow(df, each, "a int, b int, n long").groupBy("a", "b").agg(
        F.sum("n").alias("n")
    )


def _first_bigrams(chunks, core, settings):
    """Bigrams of the training texts, words beyond the core by their ending."""
    s = settings

    def chains(batches):
        for c in _opened(batches, core):
            ids, sizes = c.training()
            yield _chain(c.first_symbols(s)[ids], sizes, s.end)[0]

    return _summed(chunks, lambda batches: _pair_counts(chains(batches), s))


def _bigrams(coded, settings):
    """(a, b, n): how often symbol ``b`` follows ``a`` in the training texts."""
    s = settings

    def chains(batches):
        for batch in batches:
            texts = [_symbols(codes, s) for codes in _unpacked(batch.column(0).to_pylist())]
            if texts:
                yield _chain(np.concatenate(texts), [len(t) for t in texts], s.end)[0]

    train = coded.where("not held_out").select("codes")
    return _summed(train, lambda batches: _pair_counts(chains(batches), s))


def _f(x):
    return x * np.log(np.maximum(x, 1))


def _profiles(bigrams, classes, settings):
    """Counts of each symbol before and after each class, and after itself."""
    s = settings
    spark = bigrams.sparkSession
    table = spark.createDataFrame(
        [(i, int(c)) for i, c in enumerate(classes)], "symbol int, class int"
    )
    left = np.zeros((s.symbols, s.classes + 1))
    right = np.zeros((s.symbols, s.classes + 1))
    for one, other, out in (("a", "b", left), ("b", "a", right)):
        rows = (
            bigrams.join(F.broadcast(table), F.col(other) == F.col("symbol"))
            .groupBy(one, "class")
            .agg(F.sum("n").alias("n"))
            .toArrow()  # symbols * (classes + 1) rows at most
        )
        at = (rows.column(0).to_numpy(), rows.column(1).to_numpy())
        out[at] = rows.column(2).to_numpy()
    return left, right


def _likelihood(matrix):
    return _f(matrix).sum() - _f(matrix.sum(axis=1)).sum() - _f(matrix.sum(axis=0)).sum()


def _class_matrix(left, classes, size):
    matrix = np.zeros((size, size))
    np.add.at(matrix, classes, left)
    return matrix


def _moves(left, right, twice, classes, chosen):
    """The best class of each chosen symbol, all else staying where it is."""
    size = left.shape[1]
    matrix = _class_matrix(left, classes, size)
    best = classes.copy()
    diagonal = np.arange(size)
    for w in chosen:
        old, same = classes[w], twice[w]
        # Neighbours other than the symbol itself, by class.
        after, before = left[w].copy(), right[w].copy()
        after[old] -= same
        before[old] -= same
        if not after.any() and not before.any():
            continue
        rest = matrix.copy()
        rest[old] -= after
        rest[:, old] -= before
        rest[old, old] -= same
        rows, columns = rest.sum(axis=1), rest.sum(axis=0)
        gain_after = _f(rest + after) - _f(rest)
        gain_before = _f(rest + before[:, None]) - _f(rest)
        inner = rest[diagonal, diagonal]
        gain = (
            gain_after.sum(axis=1)
            - gain_after[diagonal, diagonal]
            + gain_before.sum(axis=0)
            - gain_before[diagonal, diagonal]
            + _f(inner + after + before + same)
            - _f(inner)
            - _f(rows + after.sum() + same)
            + _f(rows)
            - _f(columns + before.sum() + same)
            + _f(columns)
        )
        gain[-1] = -np.inf  # the class of the end
        new = int(np.argmax(gain))
        if gain[new] > gain[old] + 1e-9:
            best[w] = new
    return best


def exchange(bigrams, settings, start=None):
    """The class of every symbol; the end has the last class for itself.

    ``start``: the classes to begin with.

    In each round a half of the symbols, in turn, move to the class that raises the
    likelihood of all class bigrams most; the best assignment of all rounds counts.
    """
    s = settings
    classes = np.arange(s.symbols) % s.classes if start is None else start.copy()
    classes[s.end] = s.classes
    twice = np.zeros(s.symbols)
    for row in bigrams.where("a = b").collect():  # one row per symbol at most
        twice[row["a"]] = row["n"]
    best, reached, since = None, -np.inf, 0
    for turn in range(s.rounds + 1):
        left, right = _profiles(bigrams, classes, s)
        likelihood = _likelihood(_class_matrix(left, classes, s.classes + 1))
        if likelihood > reached + 1e-9:
            best, reached, since = (classes, left), likelihood, 0
        else:
            since += 1
        if turn == s.rounds or since == 2:
            break
        chosen = [w for w in range(s.end) if zlib.crc32(b"%d" % w) % 2 == turn % 2]
        classes = _moves(left, right, twice, classes, chosen)
    return best


def _parameters(classes, left, totals, settings):
    """(log10 of transitions, log10 of emissions by code) of the smoothed model."""
    s = settings
    matrix = _class_matrix(left, classes, s.classes + 1)
    seen = matrix.sum(axis=0)
    frequency = (seen + 1) / (seen.sum() + len(seen))
    transitions = (matrix + s.prior * frequency) / (matrix.sum(axis=1, keepdims=True) + s.prior)
    counts = np.asarray(totals["counts"], dtype=float)  # occurrences by symbol
    once = np.arange(s.once, s.once + ENDINGS)
    counts[once] += 1  # leaves room for unknown words of an ending never seen
    by_class = np.bincount(classes, counts, minlength=s.classes + 1)
    unseen = (totals["n1"] + 1) / (totals["n1"] + 2 * totals["n2"] + 2)
    # Chao's estimate of how many words there are that were never seen, by ending.
    never = np.maximum((counts[once] - 1) * (totals["n1"] - 1) / (2 * totals["n2"] + 2), 1)
    emissions = np.zeros(s.unknown + ENDINGS)
    with np.errstate(divide="ignore", invalid="ignore"):  # symbols without any word
        emissions[: s.words] = np.log10(counts[: s.words] / by_class[classes[: s.words]])
        # The counts of words in a frequency group come in with their documents.
        groups = np.arange(s.words, s.once)
        emissions[groups] = -np.log10(by_class[classes[groups]])
        share = counts[once] / by_class[classes[once]]
        emissions[once] = np.log10(share * (1 - unseen) / np.maximum(counts[once] - 1, 1))
        emissions[s.unknown :] = np.log10(share * unseen / never)
    return np.log10(transitions), emissions


def score_documents(docs, settings=None):
    """One row per row of ``docs`` with its base score and its class bigram score.

    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. Learns
    from the rows that are not held out, repeated rows each. A null text is an empty one:
    just its end. A null doc_id is kept and never held out. Without any training row all
    words are unknown. An empty table gives no rows. Only ``doc_id`` and ``text`` are read.
    """
    s = settings or Settings()
    if s.classes > BANDS * ENDINGS:
        raise ValueError(f"At most {BANDS * ENDINGS} classes, not {s.classes}.")
    rows = docs.select(
        F.col("doc_id").cast("long"),
        is_held_out(F.col("doc_id")).alias("held_out"),
        text_of().alias("text"),
    )
    chunks = written(_chunks(rows), "lm-chunks")
    core = _core(chunks, s)
    classes, left = exchange(written(_first_bigrams(chunks, core, s), "lm-bigrams"), s)
    words = written(
        _placed(_contexts(chunks, core, classes, s), classes, left, s), "lm-words"
    )
    sizes = words.where("first and n > 0").agg(
        F.count("*").alias("types"),
        F.sum("n").alias("tokens"),
        F.sum((F.col("n") == 1).cast("long")).alias("n1"),
        F.sum((F.col("n") == 2).cast("long")).alias("n2"),
    ).first()
    ends = chunks.agg(F.sum(F.size(F.filter("held", lambda h: ~h))).alias("n")).first()["n"] or 0
    coded = written(
        _coded(chunks, words.select("chunk", "number", "n", "class"), core, s), "lm-coded"
    )
    # From here on the symbols beyond the core are the classes that words have chosen.
    start = classes.copy()
    start[s.words : s.words + s.classes] = np.arange(s.classes)
    start[s.once : s.once + ENDINGS] = classes[s.words : s.words + ENDINGS]
    classes, left = exchange(written(_bigrams(coded, s), "lm-bigrams"), s, start)
    totals = {
        "n1": sizes["n1"] or 0,
        "n2": sizes["n2"] or 0,
        "counts": left.sum(axis=1),
    }
    transitions, emissions = _parameters(classes, left, totals, s)
    n_all = (sizes["tokens"] or 0) + ends
    types = (sizes["types"] or 0) + (1 if ends else 0)
    below = float(np.log10(n_all + types + 1))
    end_more = float(np.log10(ends + 1))
    code_class = classes[_symbols(np.arange(s.unknown + ENDINGS), s)]

    def each(batches):
        for batch in batches:
            scores = []
            for code in _unpacked(batch.column(0).to_pylist()):
                path = np.concatenate([[s.classes], code_class[code], [s.classes]])
                scores.append(
                    float(transitions[path[:-1], path[1:]].sum() + emissions[code].sum())
                )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "n_tokens", "n_known", "log_more", "log_band", "chain"],
            )

    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, log_more double, "
        "log_band double, chain double"
    )
    return map_in_arrow(
        coded.select(
            "codes", "doc_id", "held_out", "n_tokens", "n_known", "log_more", "log_band"
        ),
        each,
        schema,
    ).select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.lit(1 if ends else 0)).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("log_more") + end_more - F.col("n_tokens") * below).alias("base_score"),
        (F.col("chain") + F.col("log_band")).alias("score"),
    )
