"""Stored tables: concurrent registry writers, quarantined lines, buckets; model matrices and the feature screen on small inputs."""

import threading
import uuid

import numpy as np
from pyspark.sql import functions as F

from prismtab.operators import metrics as M
from prismtab.operators import registry as RG
from prismtab.plans import feature_search as FS
from prismtab.sources import io as IO


def row(spark, key, note):
    return spark.createDataFrame([(key, note)], "submission_relpath string, notes string")


def test_concurrent_writers_lose_no_update(spark, tmp_path):
    path, errors = str(tmp_path / "registry"), []

    def write(writer):
        try:
            for i in range(3):
                RG.upsert_registry_table(spark, path, row(spark, f"{writer}/{i}", "n"))
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=write, args=(w,)) for w in "abc"]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    got = sorted(r[0] for r in RG.read_registry_table(spark, path).select("submission_relpath").collect())
    assert got == sorted(f"{w}/{i}" for w in "abc" for i in range(3))


def test_a_writer_that_reads_an_old_version_merges_anew(spark, tmp_path, monkeypatch):
    """Another writer completes a version between this one's look and its claim."""
    path = str(tmp_path / "registry")
    RG.upsert_registry_table(spark, path, row(spark, "first", "1"))
    real, calls = IO.create_new, []

    def late(s, p):
        if not calls:
            calls.append(p)
            RG.upsert_registry_table(spark, path, row(spark, "between", "2"))
        return real(s, p)

    monkeypatch.setattr(IO, "create_new", late)
    RG.upsert_registry_table(spark, path, row(spark, "late", "3"))
    assert {r[0] for r in RG.read_registry_table(spark, path).select("submission_relpath").collect()} == {"first", "between", "late"}


def test_a_claim_that_never_completes_is_passed_over(spark, tmp_path):
    path = str(tmp_path / "registry")
    RG.upsert_registry_table(spark, path, row(spark, "first", "1"))
    assert IO.create_new(spark, f"{path}.claims/2") and not IO.create_new(spark, f"{path}.claims/2")
    RG.upsert_registry_table(spark, path, row(spark, "second", "2"), claim_seconds=0.5)
    assert RG.read_registry_table(spark, path).count() == 2


def test_lines_that_are_no_records_are_kept_apart(spark, tmp_path):
    lines = ['{"submission_relpath": "a", "metrics": {"x": 1.5}}', "", "   ", "{cut", '{"submission_relpath": "b", "metrics": "none"}', "[1]", '{"submission_relpath": "c"}']
    (tmp_path / "r.jsonl").write_text("\n".join(lines))
    good, bad = RG.quarantined(spark, str(tmp_path / "r.jsonl"))
    assert sorted(r.submission_relpath for r in good.collect()) == ["a", "c"]
    assert sorted((r.line, r.reason) for r in bad.collect()) == [("[1]", "no json"), ('{"submission_relpath": "b", "metrics": "none"}', "wrong type"), ("{cut", "no json")]


def test_experiments_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "runs")
    for rows in ([("a", 1), ("b", 1)], [("b", 2)]):
        IO.write_experiments(spark.createDataFrame(rows, "experiment string, v int"), path)
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("experiment", "v").collect()) == [("a", 1), ("b", 2)]


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path):
    df = spark.range(1000).withColumn("x", F.col("id") * 2)
    a = IO.store_bucketed(df, str(tmp_path / uuid.uuid4().hex), buckets=4)
    b = IO.store_bucketed(df.where("id % 2 = 0").withColumnRenamed("x", "y"), str(tmp_path / uuid.uuid4().hex), buckets=4)
    joined = a.hint("merge").join(b, "id")
    assert joined.count() == 500
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()


def test_correlations_with_gaps_are_pairwise(spark, monkeypatch):
    monkeypatch.setattr(M, "GRAM_BLOCK", 2)
    rng = np.random.default_rng(1)
    x = rng.random((400, 3, 2))  # rows, models, classes
    x[:, 2] = 0.5  # constant: no correlation
    gap = rng.random(x.shape) < 0.1
    rows = [tuple(None if gap[r, m, c] else float(x[r, m, c]) for m in range(3) for c in range(2)) for r in range(400)]
    df = spark.createDataFrame(rows, ", ".join(f"m{m}_{c} double" for m in range(3) for c in range(2)))
    got = {(r.model_a, r.model_b): r["corr"] for r in M.probability_correlation(df, {f"m{m}": [f"m{m}_0", f"m{m}_1"] for m in range(3)}).collect()}
    both = ~gap[:, 0] & ~gap[:, 1]
    assert np.isclose(got["m0", "m1"], np.corrcoef(x[:, 0][both], x[:, 1][both])[0, 1]) and got["m0", "m1"] == got["m1", "m0"]
    assert len(got) == 9 and got["m1", "m1"] == 1.0


def test_agreement_counts_a_null_as_different(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), (None, "a"), (None, None)], "p string, q string")
    got = {(r.model_a, r.model_b): r.agreement for r in M.prediction_agreement(df, {"p": "p", "q": "q"}).collect()}
    assert got == {("p", "p"): 1.0, ("q", "q"): 1.0, ("p", "q"): 0.25, ("q", "p"): 0.25}


def test_screen_finds_the_planted_columns(spark):
    df = spark.range(3000).select("id", (F.col("id") % 7 + F.rand(1) * 0.4).alias("x"), F.rand(2).alias("noise"), F.when(F.col("id") % 2 == 0, "u").alias("c"))
    df = df.withColumn("class", F.when(F.floor("x") % 3 == 0, "QSO").when(F.col("c").isNotNull() & (F.col("x") >= 4), "STAR").otherwise("GALAXY"))
    numeric = FS.numeric_columns(df)
    assert numeric == ["x", "noise"]
    keys = FS.candidate_keys(numeric, ["c"], (0,), (0,), (5,))
    assert len(keys) == 6 + 3
    got = {r.candidate: r for r in FS.screen(df, keys).collect()}
    assert got["digit__x__0"].survives and not got["round__noise__0"].survives and got["c|qbin__x__5"].gain > got["qbin__x__5"].gain and got["c|qbin__x__5"].survives
    kept, trace = FS.feature_search(df, ["noise"], keys, "rf", {"numTrees": 5, "maxDepth": 4}, k=2, refits=2)
    rows = {r.candidate: r for r in trace.collect()}
    assert len(rows) == 10 and sum(r.accuracy is not None for r in rows.values()) == 3 and len(kept) > 1
