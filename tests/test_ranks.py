"""Range ranks against plain windows, on more distinct values than a range sample holds."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from prismtab.operators import folds, groupkeys, metrics, ranking


@pytest.fixture(params=["true", "false"])
def reuse(request, spark):
    spark.conf.set("spark.sql.exchange.reuse", request.param)
    yield request.param
    spark.conf.set("spark.sql.exchange.reuse", "true")


def scored(spark, n):
    h = F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / float(1 << 40)
    rows = spark.range(n).withColumn("score", h).withColumn("model", F.concat(F.lit("m"), F.col("id") % 3))
    return rows.withColumn("label", ((h + F.pmod(F.hash("id"), F.lit(1000)) / 1000.0) > 1.0).cast("int")).withColumn("wide", F.repeat("model", 3))


def test_ranks_of_two_million_rows(spark, reuse):
    df = scored(spark, 2_000_000)
    got = ranking.global_row_number(df, ["score", "id"], "rn", partitions=16)
    assert got.columns == [*df.columns, "rn"]
    want = df.select("id", F.row_number().over(Window.orderBy("score", "id")).alias("want"))
    both = got.join(want, "id").agg(F.count("*").alias("n"), F.sum((F.col("rn") != F.col("want")).cast("int")).alias("bad"), F.count_distinct("rn").alias("d")).first()
    assert (both.n, both.bad, both.d) == (2_000_000, 0, 2_000_000)


def test_auc_of_many_distinct_scores(spark, reuse):
    df = scored(spark, 300_000).withColumn("model", F.when(F.col("model") != "m2", F.col("model")))
    exact = (
        df.withColumn("r", (F.rank().over(Window.partitionBy("model").orderBy("score"))).cast("double"))
        .groupBy("model").agg(F.sum(F.when(F.col("label") == 1, F.col("r"))).alias("r"), F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("n"))
        .select("model", ((F.col("r") - F.col("p") * (F.col("p") + 1) / 2) / (F.col("p") * F.col("n"))).alias("auc"))
    )
    want = {r.model: r.auc for r in exact.collect()}
    got = {r.model: r.roc_auc for r in metrics.roc_auc(df, "label", "score", by=["model"]).collect()}
    assert set(got) == set(want) == {"m0", "m1", None}
    assert all(abs(got[m] - want[m]) < 1e-9 for m in want)


def test_codes_samples_and_quantiles(spark, reuse):
    df = scored(spark, 200_000)
    codes = ranking.dense_codes(df.select("score").distinct(), "score")
    assert codes.agg(F.count_distinct("code"), F.max("code")).first()[:] == (df.select("score").distinct().count(), df.select("score").distinct().count() - 1)
    got = groupkeys.exact_quantiles_multi(df, {"score": [0.0, 0.1, 0.5, 1.0], "id": [0.25]})
    want = df.agg(*[F.expr(f"percentile(score, {q})") for q in (0.0, 0.1, 0.5, 1.0)]).first()
    assert all(abs(a - b) < 1e-12 for a, b in zip(got["score"], want)) and got["id"] == [49999.75]
    hot = df.withColumn("score", F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("score")))
    assert groupkeys.exact_quantiles_multi(hot, {"score": [0.5]})["score"] == [0.5]
    assert folds.proportional_sample(df.withColumn("c", F.concat("model", F.lit("x"))), "c", 50_001).count() == 50_001


def test_nulls_ties_and_small_tables(spark):
    df = spark.createDataFrame([(None, 1), (3.0, 2), (float("nan"), 3), (3.0, 4), (-1.0, 5)], "x double, id int")
    for n in (1, 2, 5, 9):
        got = {r.id: r.rn for r in ranking.global_row_number(df, ["x", "id"], partitions=n).collect()}
        assert got == {1: 1, 5: 2, 2: 3, 4: 4, 3: 5}
    assert ranking.global_row_number(df.limit(0), ["x"]).count() == 0
    assert ranking.global_row_number(df.withColumn("s", F.lit(None).cast("string")), ["s", "id"]).count() == 5
