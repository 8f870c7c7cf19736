"""The pipeline's stages on a small lake folder, and the registered queries that have SQL."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hivelake.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.lit(None).cast("string"))
    docs = docs.unionByName(extra).withColumn("more", F.lit(1))
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, kept, SF)
        if name != "sentencepiece":
            assert out.columns == list(corpus_pipeline.COLUMNS)
            assert out.where("doc_id IS NULL").count() == 1
        assert stage(spark, kept.limit(0), SF).count() == 0
        rows = out.cache()
        assert 0 < rows.count() <= kept.count()
        kept = rows
    assert kept.count() < docs.count()
    assert kept.where("n_tokens <> size(ids)").count() == 0


def test_run_leaves_its_result_alone(spark):
    from pathlib import Path

    from hivelake.llm import _scratch

    folder = Path(_scratch.shared_folder(spark))
    before = {p.name for p in folder.glob("*")}
    out = corpus_pipeline.run(spark, SF)
    assert {p.name.split("-")[0] for p in folder.glob("*") if p.name not in before} == {"sentencepiece"} and out.count() > 0


def test_no_near_duplicates_and_no_leaks_remain(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(500)]
    text = [" ".join(rng.choice(words) for _ in range(80)) for _ in range(6)]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = [(i, t) for i, t in enumerate(text)] + [(10, text[0]), (11, f"{text[1]} tail"), (12, f"{text[2]} {item}"), (13, "mail me at a@b.cd")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    near = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert sorted(r.doc_id for r in near.collect()) == [0, 1, 2, 3, 4, 5, 12, 13]
    clean = corpus_pipeline.drop_contaminated(spark, near, SF)
    assert sorted(r.doc_id for r in clean.collect()) == [0, 1, 2, 3, 4, 5, 13]
    red = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.redact(spark, clean, SF).collect()}
    assert red[13] == ("mail me at [EMAIL]", 18) and red[0] == (text[0], len(text[0]))


def test_rows_that_repeat_an_id(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    text = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(5)]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = [
        (7, text[0], "en"), (7, text[1], "en"),  # one id, two texts: both stay
        (8, text[2], "en"), (8, text[2], "de"), (8, text[2], "de"),  # one row thrice, of two languages
        (9, text[2] + " tail", "en"), (5, text[3], "en"), (5, text[3].upper(), "en"),  # linked, one id
        (7, text[4], "fr"), (6, text[4], "fr"),  # a copy under a smaller id takes the repeated id's row with it
        (None, text[0], "en"), (None, text[0], "en"), (3, "", "en"), (3, "", "en"), (4, None, "en"),
        (2, f"{item} end", "en"), (2, "nothing of it here", "en"),
    ]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    near = sorted(((r.doc_id, r.text, r.lang) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()), key=str)
    five = min((text[3], text[3].upper()), key=lambda t: hashlib.md5(t.encode()).hexdigest())
    want = [(7, text[0], "en"), (7, text[1], "en"), (8, text[2], "de"), (5, five, "en"), (6, text[4], "fr"), (None, text[0], "en"), (None, text[0], "en"), (3, "", "en"), (3, "", "en"), (4, None, "en"), (2, f"{item} end", "en"), (2, "nothing of it here", "en")]
    assert near == sorted(want, key=str)
    clean = corpus_pipeline.drop_contaminated(spark, docs, SF)
    assert sorted(r.text for r in clean.where("doc_id = 2").collect()) == ["nothing of it here"] and clean.count() == len(rows) - 1


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, oracle, name):
    got = QUERIES[name](spark, SF)
    assert not got.isEmpty()
    if oracle is None:
        return
    cursor = oracle(SF, ("documents", "pages", "benchmark", "labels")).execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(got.columns)
    want = sorted(map(str, (tuple(r) for r in cursor.fetchall())))
    assert sorted(map(str, (tuple(r) for r in got.select(*columns).collect()))) == want
