"""A quality classifier on document statistics.

Random Fourier features approximate a Gaussian kernel over standardised statistics of the
text. Ridge scores come from normal equations, summed per partition and then per row of the
matrix, so what moves is a few matrices of fixed size, whatever the number of labels.
Isotonic regression on out-of-fold scores turns them into probabilities.
"""

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerline.llm.shared import map_in_arrow, map_in_pandas, written

HELD_OUT_OF, HELD_OUT = 4, 2
FOLDS = 4
THRESHOLD = 0.7
SYMBOLS = b"#$%&*@~^_=+<>\\{}[]`"
STATISTICS = (
    "log_chars log_words mean_word longest_word distinct_words upper lower digit high space "
    "symbol bang pipe stop comma other_mark lines mean_line repeated_lines repeated_words "
    "capital_words all_upper_words"
).split()


@dataclass(frozen=True)
class Settings:
    """``features``: number of random features; ``ridge``: penalty per training row."""

    features: int = 192
    ridge: float = 1e-4
    width: float = 1.0
    seed: int = 7
    bins: int = 2000


@dataclass
class Model:
    """Everything scores depend on, of a size fixed by the settings."""

    settings: Settings
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    x: list = field(default_factory=list)
    y: list = field(default_factory=list)

    def raw(self, statistics, weights=None):
        return fourier(statistics, self) @ (self.weights if weights is None else weights)

    def probability(self, raw):
        """Isotonic value; a hundredth of the raw score keeps the order within a step."""
        step = np.interp(raw, self.x, self.y) if self.x else np.full(len(raw), 0.5)
        return np.clip(0.99 * step + 0.01 * np.clip(raw, 0, 1), 0, 1)


_MARKS = np.zeros((9, 256))
for _row, _set in enumerate(
    (
        range(65, 91),
        range(97, 123),
        range(48, 58),
        range(128, 256),
        (9, 10, 11, 12, 13, 32),
        SYMBOLS,
        b"!",
        b"|",
        b".",
    )
):
    _MARKS[_row, list(_set)] = 1


def statistics_of(text):
    """The statistics of one text, in the order of STATISTICS; all defined for no text."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    n = max(len(raw), 1)
    counts = np.bincount(raw, minlength=256)
    upper, lower, digit, high, space, symbol, bang, pipe, stop = (_MARKS @ counts) / n
    comma = counts[44] / n
    other = max(0.0, 1 - upper - lower - digit - high - space - symbol - bang - pipe - stop - comma)
    words = text.split()
    m = max(len(words), 1)
    distinct = set(words)
    lengths = [len(w) for w in distinct]
    lines = [x for x in text.split("\n") if x]
    repeated = len("".join(lines)) - len("".join(set(lines)))
    return (
        np.log1p(len(text)),
        np.log1p(len(words)),
        sum(lengths) / max(len(distinct), 1),
        np.log1p(max(lengths, default=0)),
        len(distinct) / m,
        upper, lower, digit, high, space, symbol, bang, pipe, stop, comma, other,
        np.log1p(len(lines)),
        np.log1p(len(text) / max(len(lines), 1)),
        repeated / max(len(text), 1),
        np.log1p(m / max(len(distinct), 1)),
        sum(w[0].isupper() for w in distinct) / max(len(distinct), 1),
        sum(w.isupper() for w in distinct) / max(len(distinct), 1),
    )


def document_statistics(docs):
    """(doc_id, stats) per row; a null text has the statistics of an empty one."""

    def each(batches):
        for batch in batches:
            made = [statistics_of(t or "") for t in batch.column(1).to_pylist()]
            stats = pa.array(made, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), stats], ["doc_id", "stats"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_in_arrow(rows, each, "doc_id long, stats array<double>")


def is_held_out(doc_id):
    return F.coalesce(
        F.pmod(F.crc32(doc_id.cast("string")), F.lit(HELD_OUT_OF)) == HELD_OUT, F.lit(False)
    )


def fourier(statistics, model):
    """Random Fourier features with a constant, per row of ``statistics``."""
    s = model.settings
    d = len(STATISTICS)
    random = np.random.default_rng(s.seed)
    turn = random.normal(0, 1 / (s.width * np.sqrt(d)), (d, s.features))
    shift = random.uniform(0, 2 * np.pi, s.features)
    z = np.clip((statistics - model.mean) / model.scale, -5, 5)
    waves = np.sqrt(2 / s.features) * np.cos(z @ turn + shift)
    return np.hstack([waves, np.ones((len(z), 1))])


def _matrix(series):
    rows = np.array(series.tolist(), dtype=float)
    return rows.reshape(len(series), len(STATISTICS))


def _normal_equations(train, model):
    """Per fold: the sums of z'z and z'y over its rows, and their number."""
    size = model.settings.features + 1

    def part(frames):
        total = np.zeros((FOLDS, size, size + 2))
        for frame in frames:
            z = fourier(_matrix(frame["stats"]), model)
            y = frame["label"].to_numpy()
            for f in range(FOLDS):
                of = (frame["fold"] == f).to_numpy()
                total[f, :, :size] += z[of].T @ z[of]
                total[f, :, size] += z[of].T @ y[of]
                total[f, :, size + 1] += of.sum()
        if total[:, 0, size + 1].any():
            for f in range(FOLDS):
                yield pd.DataFrame({"fold": f, "line": range(size), "sums": list(total[f])})

    def add(frame):
        sums = np.sum(np.array(frame["sums"].tolist()), axis=0)
        return pd.DataFrame({"fold": frame["fold"][:1], "line": frame["line"][:1], "sums": [sums]})

    schema = "fold int, line int, sums array<double>"
    summed = map_in_pandas(train, part, schema).groupBy("fold", "line").applyInPandas(add, schema)
    total = np.zeros((FOLDS, size, size + 2))
    for row in summed.collect():  # FOLDS * size rows, whatever the input
        total[row["fold"], row["line"]] = row["sums"]
    return total


def _solve(total, ridge):
    size = total.shape[0]
    n = total[0, size + 1]
    if not n:
        return np.zeros(size)
    penalty = np.eye(size) * max(ridge * n, 1e-3)
    penalty[-1, -1] = 1e-9
    return np.linalg.solve(total[:, :size] + penalty, total[:, size])


def isotonic(x, weight, total):
    """Pool adjacent violators: mean position and mean label of each block, rising."""
    blocks = []
    for a, w, t in zip(x, weight, total, strict=True):
        blocks.append([a * w, w, t])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    return [b[0] / b[1] for b in blocks], [b[2] / b[1] for b in blocks]


def fit(stats, labels, settings=None):
    """A model from the rows of ``stats`` that are not held out and have a label.

    A document's label is the mean of its label rows that are not null. Without any label
    every score is 0.5.
    """
    settings = settings or Settings()
    marks = (
        labels.where("quality is not null and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.avg(F.col("quality").cast("double")).alias("label"))
    )
    train = written(
        stats.where(~is_held_out(F.col("doc_id")))
        .join(marks, "doc_id")
        .select(
            "stats",
            "label",
            F.pmod(F.xxhash64(F.col("doc_id")), F.lit(FOLDS)).cast("int").alias("fold"),
        ),
        "quality-train",
    )
    moments = train.agg(
        *[F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(len(STATISTICS))],
        *[F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(len(STATISTICS))],
    ).first()
    mean = np.array([moments[f"m{i}"] or 0.0 for i in range(len(STATISTICS))])
    scale = np.array([moments[f"s{i}"] or 0.0 for i in range(len(STATISTICS))])
    scale[scale < 1e-6] = 1.0
    model = Model(settings, mean, scale, np.zeros(settings.features + 1))
    total = _normal_equations(train, model)
    whole = total.sum(axis=0)
    model.weights = _solve(whole, settings.ridge)
    without = [_solve(whole - total[f], settings.ridge) for f in range(FOLDS)]
    bins = settings.bins

    def out_of_fold(frames):
        for frame in frames:
            raw = np.zeros(len(frame))
            for f in range(FOLDS):
                of = (frame["fold"] == f).to_numpy()
                if of.any():
                    raw[of] = model.raw(_matrix(frame["stats"][of]), without[f])
            at = np.clip(np.round(raw * bins), -bins, 2 * bins).astype(int)
            yield pd.DataFrame({"bin": at, "label": frame["label"]})

    steps = (
        map_in_pandas(train, out_of_fold, "bin int, label double")
        .groupBy("bin")
        .agg(F.count("*").alias("n"), F.sum("label").alias("label"))
        .orderBy("bin")
        .collect()  # 3 * bins + 1 rows at most
    )
    model.x, model.y = isotonic(
        [r["bin"] / bins for r in steps], [r["n"] for r in steps], [r["label"] for r in steps]
    )
    return model


def scored(stats, model):
    """(doc_id, held_out, score, predicted) per row of ``stats``."""

    def each(batches):
        for batch in batches:
            rows = np.array(batch.column(2).flatten()).reshape(-1, len(STATISTICS))
            score = model.probability(model.raw(rows))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(score),
                    pa.array((score >= THRESHOLD).astype("int32")),
                ],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = stats.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "stats")
    return map_in_arrow(
        rows, each, "doc_id long, held_out boolean, score double, predicted int"
    )


def score_quality(docs, labels, settings=None):
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted.

    Only the text makes a score, so repeated rows and equal texts score alike; a null text
    scores as an empty one; a null doc_id is scored, never held out and never trained on.
    An empty table gives no rows. Only ``doc_id``, ``text`` and, of ``labels``, ``doc_id``
    and ``quality`` are read.
    """
    stats = written(document_statistics(docs), "quality-statistics")
    return scored(stats, fit(stats, labels.select("doc_id", "quality"), settings))


def keep_good(docs, labels, settings=None):
    """The rows of ``docs`` whose text is predicted good; rejected ones go.

    Every row is judged by its own text, whatever its doc_id or whether it has one; the
    labelled rows are read once more, for the fit. All columns stay as they are.
    """
    known = labels.where("quality is not null").select(F.col("doc_id").cast("long").alias("doc_id"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    labelled = ids.join(known.distinct(), "doc_id", "left_semi")
    stats = written(document_statistics(labelled), "quality-statistics")
    model = fit(stats, labels.select("doc_id", "quality"), settings)
    at = docs.columns.index("text")

    def each(batches):
        for batch in batches:
            texts = batch.column(at).cast(pa.string()).to_pylist()
            made = [statistics_of(t or "") for t in texts]
            rows = np.array(made, dtype=float).reshape(-1, len(STATISTICS))
            good = model.probability(model.raw(rows)) >= THRESHOLD
            yield batch.filter(pa.array(good))

    return map_in_arrow(docs, each, docs.schema)
