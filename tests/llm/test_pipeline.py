import random

from pyspark.sql import functions as F

import corpus_pipeline
from brute import contaminated, groups, simhash, without_repeats
from conftest import SF_SMALL

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def planted(spark):
    random.seed(11)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    item = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").orderBy("item_id").first().text
    clean = [r.text for r in docs.where("lang = 'en' and n_chars > 600").orderBy("doc_id").limit(3).collect()]
    passage = " ".join(f"word{i}" for i in range(60))
    own = random.Random(1)
    fresh = lambda: " ".join(own.choice(clean[0].split()) for _ in range(80))
    rows = [(9000, clean[0]), (9001, clean[0]), (9002, fresh() + "\n" + passage), (9003, fresh() + " " + passage + " end"), (9004, passage),
            (9005, fresh() + " " + item), (9006, None), (9007, ""), (9008, "12 34 ... !!"), (9009, fresh() * 200), (None, fresh()), (9010, fresh()), (9010, fresh())]
    more = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], docs.schema)
    return docs.unionByName(more)


def texts(df):
    return sorted(((r.doc_id is None, r.doc_id or 0, r.text or "") for r in df.collect()))


def test_each_stage_against_brute_force(spark):
    stages = dict(corpus_pipeline.STAGES)
    assert [k for k, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "substring_dedup", "benchmark_decontamination", "sentencepiece"]
    docs = planted(spark).checkpoint()

    one = stages["language_id"](spark, docs, SF_SMALL).checkpoint()
    assert one.columns == COLUMNS
    gone = set(texts(docs)) - set(texts(one))
    assert {g[1] for g in gone} == {9006, 9007, 9008}

    two = stages["simhash_near_dedup"](spark, one, SF_SMALL).checkpoint()
    assert two.columns == COLUMNS
    rows = texts(one)
    first = groups([simhash(t) for _, _, t in rows])
    # rows are sorted by doc_id, a missing one last, so the first of a group stays
    kept = [rows[i] for i in sorted(set(first))]
    assert [k[:2] for k in texts(two)] == [k[:2] for k in kept]

    three = stages["substring_dedup"](spark, two, SF_SMALL).checkpoint()
    assert three.columns == COLUMNS
    rows = [(r.doc_id, r.text) for r in two.collect()]
    want = []
    for (i, t), (n, removed, left) in zip(rows, without_repeats(rows, 50)):
        if removed == 0 or removed < n:
            want.append((i is None, i or 0, left if removed else t))
    assert texts(three) == sorted(want)
    assert 9004 not in {w[1] for w in want} and three.where(F.length("text") != F.col("n_chars")).count() == 0

    four = stages["benchmark_decontamination"](spark, three, SF_SMALL).checkpoint()
    assert four.columns == COLUMNS
    items = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert texts(four) == [w for w in texts(three) if not any(contaminated(w[2], x) for x in items)]
    assert 9005 not in {w[1] for w in texts(four)}

    five = stages["sentencepiece"](spark, four, SF_SMALL)
    assert texts(five) == texts(four)
    assert five.where("n_ids <> size(ids)").count() == 0
    assert sorted((r.decoded or "") for r in five.collect()) == sorted(t.replace("\u2581", " ") for _, _, t in texts(four))


def test_stages_of_empty_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.columns == COLUMNS and docs.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() == 0


def test_run_gives_the_last_stages_rows(spark):
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert got.columns == [*COLUMNS, "n_ids", "ids", "decoded"]
    assert 0 < got.count() < spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
