import random
import zlib
from collections import Counter

from corpus_for_tests import AWKWARD, awkward, empty, texts

from ledgerline.llm import near_copies
from ledgerline.llm.near_copies import keep_one, words_of


def brute_sets(listed):
    sets = []
    for text in listed:
        words = words_of(text or "")
        width = min(5, len(words))
        sets.append(
            {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()
        )
    return sets


def brute_pairs(listed):
    """Pairs of equal words, or whose sets share 0.8: counted over all shared shingles."""
    sets, holders, shared = brute_sets(listed), {}, Counter()
    for j, b in enumerate(sets):
        for shingle in b or {()}:
            shared.update((i, j) for i in holders.setdefault(shingle, []))
            holders[shingle].append(j)
    return [
        (i, j)
        for (i, j), n in shared.items()
        if not sets[j] or 10 * n >= 8 * (len(sets[i]) + len(sets[j]) - n)
    ]


def brute_kept(listed):
    root = list(range(len(listed)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in brute_pairs(listed):
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return {find(i) for i in range(len(listed))}


def test_near_copies_of_given_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    kept = {rows[i]["doc_id"] for i in brute_kept([r["text"] for r in rows])}
    assert {r["doc_id"] for r in keep_one(docs).select("doc_id").collect()} == kept


def test_copies_at_the_least_similarity(spark):
    """Texts with changed words, chains of them and a large group, on both sides of 0.8."""
    rng = random.Random(5)
    listed = []
    for size in (40, 120, 400):
        for _ in range(25):
            words = [f"w{rng.randrange(10**6)}" for _ in range(size)]
            listed.append(" ".join(words))
            for changes in range(1, 1 + size // 25):
                other = list(words)
                for at in rng.sample(range(size), changes):
                    other[at] = f"v{rng.randrange(10**6)}"
                listed.append(" ".join(other))
    words = [f"g{i}" for i in range(300)]
    for i in range(150):
        listed.append(" ".join([*words, f"end{i}"]))
    rng.shuffle(listed)
    found = {r["doc_id"] for r in keep_one(texts(spark, listed).repartition(7)).collect()}
    assert len(brute_kept(listed)) < len(listed) / 2
    assert found == brute_kept(listed)


def test_mixed_buckets_are_split(spark, monkeypatch):
    """With one band of one function buckets hold texts that are no copies of the least."""
    monkeypatch.setattr(near_copies, "band_keys", lambda h: near_copies.np.array([7]))
    base = [[f"{t}{i}" for i in range(60)] for t in "abcd"]
    listed = [" ".join([*b, f"x{k}"]) for b in base for k in range(3)]
    assert {r["doc_id"] for r in keep_one(texts(spark, listed)).collect()} == {0, 3, 6, 9}


def test_one_bucket_of_all_texts_against_brute_force(spark, monkeypatch):
    """Sizes, changes and shared passages of all kinds, where only the rarest shingles sort out."""
    monkeypatch.setattr(near_copies, "band_keys", lambda h: near_copies.np.array([7]))
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(80)]
    listed = []
    for _ in range(120):
        own = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([3, 9, 20, 40]))]
        words = [*passage, *own] if rng.random() < 0.6 else own * rng.choice([1, 4])
        listed.append(" ".join(words))
        for _ in range(rng.randrange(3)):
            changed = list(words)
            for _ in range(rng.randrange(1, 4)):
                changed[rng.randrange(len(changed))] = f"v{rng.randrange(10**6)}"
            listed.append(" ".join(changed[rng.randrange(4) :]))
    assert {r["doc_id"] for r in keep_one(texts(spark, listed)).collect()} == brute_kept(listed)


def test_prints_that_link_are_candidates(spark, monkeypatch):
    """Fingerprints within the radius meet without any band that two texts share."""
    monkeypatch.setattr(
        near_copies, "band_keys", lambda h: near_copies.np.array([zlib.crc32(h.tobytes())])
    )
    rng, listed, expected = random.Random(4), [], set()
    for _ in range(8):
        words = [f"w{rng.randrange(10**6)}" for _ in range(1500)]
        pair = [" ".join(words), " ".join([*words[1:], "z"])]
        a, b = (near_copies.majority(near_copies.shingle_hashes(words_of(t))) for t in pair)
        near = ((a ^ b) & 2**64 - 1).bit_count() <= 2
        expected |= {len(listed)} if near else {len(listed), len(listed) + 1}
        listed += pair
    assert len(expected) < 12
    assert {r["doc_id"] for r in keep_one(texts(spark, listed)).collect()} == expected


def test_texts_of_few_sets_are_not_shuffled(spark, plan):
    docs = texts(spark, ["a b c d e f", "a b c d e g"])
    wanted = near_copies._nodes(docs).select("node", "key")
    assert "BroadcastHashJoin" in plan(near_copies._sets(docs, wanted))


def rows_met(spark, listed, monkeypatch):
    """How many pairs of the texts, all in one bucket and none of them linked, are compared."""
    monkeypatch.setattr(near_copies, "band_keys", lambda h: near_copies.np.array([7]))
    docs = texts(spark, listed)
    nodes = near_copies.written(near_copies._nodes(docs), "n")
    sets = near_copies.written(near_copies._sets(docs, nodes.select("node", "key")), "s")
    alone = nodes.select(
        near_copies.F.lit(0).alias("band"), near_copies.F.lit(0).alias("bucket"), "node"
    ).withColumn("component", near_copies.F.col("node"))
    return near_copies._meeting(alone, sets).count()


def test_a_passage_of_many_texts_makes_no_pairs(spark, monkeypatch):
    passage = [f"p{i}" for i in range(80)]
    listed = [" ".join([*passage, *[f"w{i}.{k}" for k in range(14)]]) for i in range(400)]
    assert rows_met(spark, listed, monkeypatch) == 0


def test_few_rows_for_a_large_group_of_near_copies(spark, monkeypatch):
    """Each text differs from the first by a few words and from others by twice as many."""
    rng, counts = random.Random(2), []
    alike = near_copies._alike

    def counted(pairs, sets):
        counts.append(pairs.count())
        return alike(pairs, sets)

    monkeypatch.setattr(near_copies, "_alike", counted)
    words = [f"w{i}" for i in range(130)]
    listed = [" ".join(words)]
    for _ in range(600):
        other = list(words)
        for at in rng.sample(range(130), 2):
            other[at] = f"v{rng.randrange(10**6)}"
        listed.append(" ".join(other))
    found = {r["doc_id"] for r in keep_one(texts(spark, listed)).collect()}
    assert found == brute_kept(listed) and sum(counts) < 20 * len(listed)


def test_free_column_names(spark):
    docs = texts(spark, ["a b c d e f", "a b c d e f", "x"]).selectExpr(
        "doc_id", "text", "7 as _key", "8 as key", "9 as row", "1 as kept", "2 as node", "3 as component"
    )
    out = keep_one(docs)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect())) == [
        (0, "a b c d e f", 7, 8, 9, 1, 2, 3), (2, "x", 7, 8, 9, 1, 2, 3)
    ]


def test_rows_that_share_an_id_or_have_none(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(1, "clean and unique"), (1, text), (0, text), (None, text + " z"), (None, text + " z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in keep_one(docs).collect()]
    assert sorted(kept, key=repr) == [(1, "clean and unique"), (None, text + " z")]


def test_awkward_rows(spark):
    kept = [tuple(r)[:2] for r in keep_one(awkward(spark)).collect()]
    assert len(kept) == len(set(kept)) and set(kept) <= set(AWKWARD)
    # The second "a b c" goes, and of three texts without words two go.
    assert len(kept) == len(AWKWARD) - 3
    assert keep_one(empty(spark)).collect() == []
