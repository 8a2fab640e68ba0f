"""Personal data: pattern matches, and identifiers found by bootstrapped contexts.

The base matches of four kinds are the seeds. Everything of a similar form is an instance,
known or not; the words around its occurrences are its lexical patterns. Patterns and
instances make a bipartite graph. In each round a pattern is trusted for a kind by the score
of its distinct instances believed to be of that kind, against those that contradict it: of
another base kind, or of a form that cannot be of the kind. An instance is believed by the
trust in the patterns it stands in, and from then on supports the other patterns it stands
in; rounds go on until no instance is added. Believed instances add spans; base spans always
stay. Everything is DataFrame expressions.
"""

from dataclasses import dataclass

from pyspark.sql import functions as F

from ledgerline.llm.shared import broadcast_if_small, text_of, written

KINDS = ("email", "ip", "card", "phone")
# A match that can't begin earlier starts a run, or follows the last match within one.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Runs of digits with single separators are whole matches; only 13 to 19 digits count.
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
IP_PARTS = rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"
# What may be an identifier, whether a base pattern knows it or not.
INSTANCE = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:@|\(at\)|\[at\])[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+"
    r"|(?<![A-Za-z0-9])\+?\(?[0-9][0-9\x20().:-]{5,}[0-9](?![A-Za-z0-9])"
)
# The forms in which an instance of no base match may still be of a kind.
FORM = {
    "email": r"@|\(at\)|\[at\]",
    "ip": r"^[0-9]{1,3}(?:[.:-][0-9]{1,3}){3}$",
    "card": r"^(?:[0-9][\x20.-]?){11,18}[0-9]$",
    "phone": r"^\+?\(?(?:[0-9][\x20().-]{0,3}){6,14}[0-9]$",
}


# Up to so many rows spans are sent to all executors for redaction; beyond, the join shuffles.
BROADCAST_ROWS = 100_000


@dataclass(frozen=True)
class Settings:
    """``support``: distinct believed instances a pattern needs; ``trust``, ``belief``: least scores."""

    support: int = 3
    trust: float = 0.8
    belief: float = 0.8


def _spans(text, found, pattern):
    """Array of (start, end, value) of the matches ``found`` of ``pattern``.

    Offsets are in code points. The text between two matches is what ``split`` leaves, so
    offsets follow from lengths.
    """
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(
        found,
        F.slice(gaps, 1, F.size(found)),
        lambda value, gap: F.struct(value.alias("value"), gap.alias("gap")),
    )
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    walked = F.aggregate(
        pairs,
        F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["gap"]) + F.length(x["value"])).alias("at"),
            F.concat(
                acc["out"],
                F.array(
                    F.struct(
                        (acc["at"] + F.length(x["gap"])).alias("start"),
                        (acc["at"] + F.length(x["gap"]) + F.length(x["value"])).alias("end"),
                        x["value"].alias("value"),
                    )
                ),
            ).alias("out"),
        ),
    )
    return F.when(F.size(found) > 0, walked["out"]).otherwise(none)


def _digits(value):
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(digits):
    """Every second digit from the right doubled, its digits added: a multiple of ten."""
    total = F.aggregate(
        F.transform(
            F.split(F.reverse(digits), ""),
            lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
                (d.cast("int") * 2) - F.when(d.cast("int") > 4, 9).otherwise(0)
            ),
        ),
        F.lit(0),
        lambda acc, d: acc + F.coalesce(d, F.lit(0)),
    )
    return total % 10 == 0


def _holds(kind, value):
    """Whether a match of the base pattern of ``kind`` is one."""
    size = F.length(_digits(value))
    return {
        "email": F.lit(True),
        "ip": value.rlike(IP_PARTS),
        "card": size.between(13, 19) & passes_luhn(_digits(value)),
        "phone": size.between(9, 15),
    }[kind]


def _holding(kind):
    return lambda span: _holds(kind, span["value"])


def _numbered(number):
    return lambda span: F.struct(
        F.lit(number).alias("kind"), span["start"].alias("start"), span["end"].alias("end")
    )


def _of_kind(number):
    return lambda span: span["kind"] == number


def _kind_of(value):
    """The kind of which the whole value is a base match, or null."""
    kind = F.lit(None).cast("string")
    for name in reversed(KINDS):
        kind = F.when(
            F.regexp_like(value, F.lit(f"^(?:{BASE[name]})$")) & _holds(name, value), name
        ).otherwise(kind)
    return kind


def _second_word(text):
    """The second word of a text; of a single word after a blank that word.

    Anchored and possessive, so the time grows with the text: to look for the last words of
    a text from its end, it is turned round.
    """
    second = F.regexp_extract(text, r"^\s*+\S++\s++(\S++)", 1)
    return F.when(second != "", second).otherwise(F.regexp_extract(text, r"^\s++(\S++)", 1))


def _scan(docs):
    """One row per row of ``docs``: base spans, and instances with the words around them."""
    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    text = F.col("text")
    found = rows.select(
        "doc_id",
        "text",
        *[F.regexp_extract_all(text, F.lit(BASE[k]), 0).alias(f"m_{k}") for k in KINDS],
        F.regexp_extract_all(text, F.lit(INSTANCE), 0).alias("m_any"),
    )
    gaps = F.split(text, INSTANCE, -1)
    around = F.when(
        F.size("m_any") > 0,
        F.zip_with(
            F.slice(gaps, 1, F.size("m_any")),
            F.slice(gaps, 2, F.size("m_any")),
            lambda before, after: F.struct(
                F.lower(F.reverse(_second_word(F.reverse(before)))).alias("left2"),
                F.lower(F.reverse(F.regexp_extract(F.reverse(before), r"^\s*+(\S++)", 1))).alias("left"),
                F.lower(F.regexp_extract(after, r"^\s*(\S+)", 1)).alias("right"),
            ),
        ),
    )
    placed = found.select(
        "doc_id",
        F.xxhash64(text).alias("text_hash"),
        *[
            F.filter(_spans(text, F.col(f"m_{k}"), BASE[k]), _holding(k)).alias(k) for k in KINDS
        ],
        _spans(text, F.col("m_any"), INSTANCE).alias("instances"),
        around.alias("around"),
    )
    base = F.concat(
        *[
            F.transform(F.col(k), _numbered(n)) for n, k in enumerate(KINDS)
        ]
    )
    return placed.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "text_hash",
        base.alias("base"),
        F.when(
            F.size("instances") > 0, F.arrays_zip("instances", "around")
        ).alias("instances"),
    )


def _occurrences(scan):
    """(row, start, end, value, kind, patterns): instances, ``kind`` null if not a seed.

    An instance that is no seed but overlaps a base span is left out.
    """
    apart = ~F.exists(
        "base", lambda b: (b["start"] < F.col("at.end")) & (F.col("at.start") < b["end"])
    )
    near = F.col("near")
    return (
        scan.where(F.size("instances") > 0)
        .select("row", "base", F.inline("instances").alias("at", "near"))
        .withColumn("kind", _kind_of(F.col("at.value")))
        .where(F.col("kind").isNotNull() | apart)
        .select(
            "row",
            "at.start",
            "at.end",
            "at.value",
            "kind",
            F.filter(
                F.array(
                    F.when(near["left2"] != "", F.concat_ws(" ", near["left2"], near["left"], F.lit("_"))),
                    F.when(near["left"] != "", F.concat_ws(" ", near["left"], F.lit("_"), near["right"])),
                    F.when(near["left"].rlike("[:=#]$"), F.concat_ws(" ", near["left"], F.lit("_"))),
                ),
                lambda p: p.isNotNull(),
            ).alias("patterns"),
        )
    )


def believed(occurrences, settings):
    """(value, kind) of the instances that are no seeds and that contexts make believable."""
    edges = written(
        occurrences.select("value", "kind", F.explode("patterns").alias("pattern")).distinct(),
        "pii-edges",
    )
    unlabelled = F.col("kind").isNull()
    against = {
        k: F.when(unlabelled, ~F.col("value").rlike(FORM[k])).otherwise(F.col("kind") != k)
        for k in KINDS
    }
    # Patterns that can never be supported, or have nothing to find, are left out.
    patterns = written(
        edges.groupBy("pattern")
        .agg(
            F.count("*").alias("n"),
            F.count_if(unlabelled).alias("open"),
            *[F.count_if(c).alias(f"not_{k}") for k, c in against.items()],
        )
        .where(f"n >= {settings.support} and open > 0")
        .drop("n", "open"),
        "pii-patterns",
    )
    edges = written(edges.join(patterns.select("pattern"), "pattern"), "pii-useful")
    open_edges = edges.where("kind is null").select("pattern", "value")
    seeds = edges.where("kind is not null").select("value", "kind", F.lit(1.0).alias("score")).distinct()
    contradicted, has_form = F.lit(None).cast("long"), F.lit(False)
    for kind in KINDS:
        contradicted = F.when(F.col("kind") == kind, F.col(f"not_{kind}")).otherwise(contradicted)
        has_form = has_form | ((F.col("kind") == kind) & F.col("value").rlike(FORM[kind]))
    doubt = F.sum(F.log(F.greatest(1 - F.col("trust"), F.lit(1e-6))))
    found = edges.sparkSession.createDataFrame([], seeds.schema)
    # What is believed stays, so this ends: each round adds a value or is the last.
    while True:
        trusted = (
            edges.select("pattern", "value")
            .join(seeds.unionByName(found), "value")
            .groupBy("pattern", "kind")
            .agg(F.sum("score").alias("score"), F.count("*").alias("support"))
            .where(F.col("support") >= settings.support)
            .join(patterns, "pattern")
            .select(
                "pattern", "kind", (F.col("score") / (F.col("score") + contradicted)).alias("trust")
            )
            .where(F.col("trust") >= settings.trust)
        )
        added = written(
            open_edges.join(found.select("value"), "value", "left_anti")
            .join(trusted, "pattern")
            .where(has_form)
            .groupBy("value", "kind")
            .agg((1 - F.exp(doubt)).alias("score"))
            .where(F.col("score") >= settings.belief)
            .groupBy("value")
            .agg(F.max(F.struct("score", "kind")).alias("best"))
            .select("value", "best.kind", "best.score"),
            "pii-added",
        )
        if added.isEmpty():
            return found.select("value", "kind")
        found = written(found.unionByName(added), "pii-believed")


def _as_text(spans):
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def found_spans(docs, settings=None):
    """(doc_id, text_hash, base, spans) per row of ``docs``: arrays of (kind number, start, end).

    ``base`` is in the order of KINDS and then of the text; ``spans`` also holds what was
    discovered, in the same order. A null text is an empty one and has no spans; a null
    doc_id is kept; repeated rows are found alike; an empty table gives no rows. Only
    ``doc_id`` and ``text`` are read.
    """
    scan = written(_scan(docs), "pii-scan")
    occurrences = written(_occurrences(scan), "pii-occurrences")
    kind_no = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int") - 1
    added = (
        occurrences.where("kind is null")
        .drop("kind")
        .join(believed(occurrences, settings or Settings()), "value")
        .groupBy("row")
        .agg(F.collect_set(F.struct(kind_no.alias("kind"), "start", "end")).alias("added"))
    )
    return scan.join(added, "row", "left").select(
        "doc_id",
        "text_hash",
        "base",
        F.when(F.col("added").isNull(), F.col("base"))
        .otherwise(F.array_sort(F.concat("base", "added")))
        .alias("spans"),
    )


def personal_data(docs, settings=None):
    """Digest of :func:`found_spans` per row: counts by kind, base_sha256, spans as text."""
    return found_spans(docs, settings).select(
        "doc_id",
        *[
            F.size(F.filter("base", _of_kind(n))).cast("long").alias(f"n_{k}")
            for n, k in enumerate(KINDS)
        ],
        F.sha2(_as_text(F.col("base")), 256).alias("base_sha256"),
        _as_text(F.col("spans")).alias("spans"),
    )


def redact(docs, settings=None):
    """``docs`` with every span replaced by its kind in angle brackets, n_chars anew.

    Overlapping spans are replaced together. Rows are matched with their spans by doc_id
    and the hash of the text, so repeated rows stay as they are in number.
    """
    spans = (
        found_spans(docs, settings)
        .where(F.size("spans") > 0)
        .select("doc_id", "text_hash", "spans")
        .dropDuplicates(["doc_id", "text_hash"])
    )
    small = broadcast_if_small(written(spans, "pii-spans"), BROADCAST_ROWS)
    # The row as one column, so that no name of its columns is taken.
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("long").alias("of"),
        text_of().alias("whole"),
        F.col("text").alias("text"),
    )
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    in_order = F.array_sort(
        F.transform(
            "spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
        )
    )
    walked = F.aggregate(
        in_order,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(
                s["start"] >= acc["at"],
                F.concat(
                    acc["out"],
                    F.substring(F.col("whole"), acc["at"] + 1, s["start"] - acc["at"]),
                    F.get(names, s["kind"]),
                ),
            )
            .otherwise(acc["out"])
            .alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(F.col("whole"), acc["at"] + 1, F.length("whole"))),
    )
    same = F.col("of").eqNullSafe(F.col("doc_id")) & (F.xxhash64("whole") == F.col("text_hash"))
    new = F.when(F.col("spans").isNotNull(), walked).otherwise(F.col("text"))
    changed = rows.join(small, same, "left").select("row", new.alias("new"))
    made = {"text": F.col("new"), "n_chars": F.length("new").cast("long")}
    return changed.select(
        *[
            made[c].alias(c) if c in made else F.col("row").getField(c).alias(c)
            for c in docs.columns
        ]
    )
