"""Small frames with everything awkward, for all corpus operators."""

AWKWARD = [
    (5, "a b c"),
    (5, "a b c"),
    (None, "x"),
    (None, None),
    (7, ""),
    (1, "é\U0001f600 foo bar\x0b A B"),
    (2, "word"),
    (2, "other word"),
    (9, " \t\n "),
    (3, "q r s t u v\nq r s t u v"),
    (11, "long " * 20000 + "x" * 20000),
]


def awkward(spark):
    """Nulls, empty and very long texts, repeated rows, and columns with clashing names."""
    rows = [(i, t, "fp", 1.0, i, "c", "w") for i, t in AWKWARD]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, fingerprint string, score double, row long, chunk string, "
        "words string",
    )


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def texts(spark, listed):
    return spark.createDataFrame(list(enumerate(listed)), "doc_id long, text string")
