import re

import corpus_pipeline
import duckdb
import pytest
from corpus_for_tests import awkward, empty
from pyspark.sql import functions as F
from test_llm_near_copies import brute_kept

import __spark_entry__ as entry_points
from ledgerline.llm.decontaminate import contaminated
from ledgerline.llm.pii import personal_data
from ledgerline.llm.queries import ORACLES, QUERIES
from ledgerline.llm.quality import score_quality
from ledgerline.llm.shared import table
from ledgerline.llm.word_bpe import digest, encode_decode

SF = "/root/testdata/sf0.001"


def test_queries_are_registered():
    registered = entry_points.queries()
    for n in range(1, 14):
        assert sum(bool(re.match(rf"op{n}_", name)) for name in registered) == 1
    assert registered["pipeline"] is corpus_pipeline.run
    assert set(ORACLES) <= set(QUERIES) <= set(registered)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_oracle(spark, name):
    connection = duckdb.connect()
    for source in ("documents", "embeddings"):
        connection.execute(f"CREATE VIEW {source} AS SELECT * FROM '{SF}/{source}.parquet'")
    out = QUERIES[name](spark, SF)
    result = connection.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(out.columns) == sorted(names)
    assert sorted(map(tuple, out.select(*names).collect()), key=repr) == sorted(
        result.fetchall(), key=repr
    )


def test_every_stage_does_what_its_operator_says(spark, tmp_path):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_dedup", "decontamination", "personal_data", "word_bpe"]
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != names[-1]:
            assert docs.columns == columns
        kept.append((before, docs))

    def ids(df):
        return {r["doc_id"] for r in df.select("doc_id").collect()}

    scores = score_quality(kept[0][0], table(spark, SF, "labels"))
    assert ids(kept[0][1]) == ids(scores.where("predicted = 1")) < ids(kept[0][0])
    rows = kept[1][0].select("doc_id", "text").orderBy("doc_id").collect()
    copies = brute_kept([r["text"] for r in rows])
    assert ids(kept[1][1]) == {rows[i]["doc_id"] for i in copies}
    held = ids(contaminated(kept[2][0], table(spark, SF, "benchmark")))
    assert ids(kept[2][1]) == ids(kept[2][0]) - held
    assert personal_data(kept[3][1]).where("spans <> ''").count() == 0
    assert kept[3][1].where("n_chars <> length(text)").count() == 0
    path = corpus_pipeline.public_tokenizers.path(corpus_pipeline.TOKENIZER)
    expected = digest(encode_decode(kept[4][0], path)).collect()
    assert sorted(expected) == sorted(kept[4][1].collect())
    assert sorted(corpus_pipeline.run(spark, SF).collect()) == sorted(expected)


def test_stages_take_awkward_and_empty_tables(spark):
    for rows in (awkward(spark), empty(spark)):
        docs = rows.select("doc_id", "text").withColumns(
            {"lang": F.lit(None), "source": F.lit("s"), "n_chars": F.length("text").cast("long")}
        )
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF).collect()
