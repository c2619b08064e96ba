"""Property tests: rewrites equal their naive forms, fold invariants,
probability invariants (SURVEY §5 item 3)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from prismtab.constants import CLASSES
from prismtab.functions import proba as P
from prismtab.operators import folds as FO
from prismtab.operators import metrics as M
from prismtab.operators import search as S
from prismtab.plans.common import model_cols, predictions
from prismtab.sources.fixtures import load_obs, load_pro

QT = [0.40, 0.46, 0.52]
ST = [0.40, 0.50]
RT = [0.50, 0.65, 0.80]


def _naive_threshold_grid(pro, prob_cols):
    """Every row against every grid point (only for testing the rewrite)."""
    g, q, s = (F.col(c) for c in prob_cols)
    p = P.normalize([g, q, s])
    rows = []
    for qt in QT:
        for st in ST:
            for rt in RT:
                final, staged, replaced = P.two_stage(p[0], p[1], p[2], qt, st, rt)
                agg = pro.agg(
                    F.avg(F.when(final == F.col("class"), 1.0).otherwise(0.0)).alias("acc"),
                    F.sum(F.when(replaced, 1).otherwise(0)).alias("rep"),
                    F.sum(F.when(staged != P.argmax_class(p), 1).otherwise(0)).alias("diff"),
                ).first()
                rows.append(((qt, st, rt), agg["acc"], agg["rep"], agg["diff"]))
    return rows


def test_threshold_histogram_equals_naive(spark):
    pro = load_pro(spark, SF_SMALL).where(F.col("split") == "train")
    res = S.search_threshold_grid(pro, "class", model_cols("m1"), QT, ST, RT).collect()
    got = {(r["qso_threshold"], r["star_threshold"], r["replace_threshold"]): r for r in res}
    assert len(got) == len(QT) * len(ST) * len(RT)
    for key, acc, rep, diff in _naive_threshold_grid(pro, model_cols("m1")):
        r = got[key]
        assert r["accuracy"] == pytest.approx(acc)
        assert r["replaced"] == rep
        assert r["staged_diff_from_argmax"] == diff


def test_guard_grid_empty_threshold_equals_baseline(spark):
    from prismtab.plans.q_search import guard_frame

    df = guard_frame(spark, SF_SMALL)
    res = S.search_guard_grid(df, "class", "base_pred", "other_pred", "p_galaxy",
                              grids={"p_galaxy_threshold": [1.5, 2.0]}).collect()
    assert all(r["changed_to_galaxy"] == 0 and r["delta_accuracy"] == 0 for r in res)


def test_folds_balanced_and_each_row_once(spark):
    obs = load_obs(spark, SF_MID).where(F.col("split") == "train").select("id", "class")
    folds = FO.stratified_folds(obs, "class", k=5)
    assert folds.count() == obs.count()
    assert folds.select("id").distinct().count() == obs.count()
    sizes = folds.groupBy("class", "fold").count().groupBy("class").agg(
        (F.max("count") - F.min("count")).alias("spread")).collect()
    assert all(r["spread"] <= 1 for r in sizes)


def test_bucketed_rank_equals_plain_window(spark):
    from pyspark.sql import Window

    obs = load_obs(spark, SF_SMALL).where(F.col("split") == "train").select("id", "class")
    ours = {r["id"]: r["class_rank"] for r in FO.class_rank(obs, "class", prefix_len=1).collect()}
    w = Window.partitionBy("class").orderBy(FO.order_key("id", 42), "id")
    plain = {r["id"]: r["rk"] for r in obs.select("id", (F.row_number().over(w) - 1).alias("rk")).collect()}
    assert ours == plain


def test_slice_all_equals_global(spark):
    from prismtab.plans.q_metrics import slice_metrics_frame

    sm = {r["candidate"]: r for r in slice_metrics_frame(spark, SF_SMALL).where(F.col("slice") == "ALL").collect()}
    p = predictions(spark, SF_SMALL, "train")
    for m in ("m1", "m2", "m3"):
        g = M.prediction_metrics(p, "class", f"pred_{m}", absent="skip").first()
        assert sm[m]["n"] == g["n"] and sm[m]["accuracy"] == pytest.approx(g["accuracy"])
        assert sm[m]["balanced_accuracy"] == pytest.approx(g["balanced_accuracy"])


def test_confusion_total_equals_rows(spark):
    p = predictions(spark, SF_SMALL, "train")
    tot = M.confusion(p, "class", "pred_m1").agg(F.sum("n")).first()[0]
    assert tot == p.count()


def test_probability_rows_sum_to_one_and_blend_alpha_zero(spark):
    pro = load_pro(spark, SF_SMALL)
    base = P.normalize(model_cols("m1"))
    other = P.normalize(model_cols("m2"))
    bl0 = P.blend(base, other, 0.0)
    rows = pro.select(*[b.alias(f"b{j}") for j, b in enumerate(base)],
                      *[x.alias(f"x{j}") for j, x in enumerate(bl0)],
                      sum(P.combined_two_stage(F.col("m1__QSO"), F.col("m2__STAR"))).alias("cs")).collect()
    for r in rows:
        assert r["b0"] + r["b1"] + r["b2"] == pytest.approx(1.0)
        assert r["cs"] == pytest.approx(1.0)
        for j in range(3):
            assert r[f"x{j}"] == pytest.approx(r[f"b{j}"])


def test_auc_matches_pairwise_definition(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1), (0, 0.5), (1, 0.7)], "y int, s double")
    got = M.roc_auc(df, "y", "s").first()["roc_auc"]
    pos = [0.9, 0.5, 0.7]
    neg = [0.9, 0.1, 0.5]
    want = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg) / 9
    assert got == pytest.approx(want)


def test_no_flow_selected_means_base(spark):
    from prismtab.operators import arbitrate as A

    p = predictions(spark, SF_SMALL, "train")
    flows = A.flow_utility(p, "class", "pred_m1", "pred_m2", min_n=10 ** 9)
    out = A.apply_flows(p, "pred_m1", "pred_m2", flows)
    assert out.where(F.col("arb_pred") != F.col("pred_m1")).count() == 0


def test_exact_quantiles_match_numpy(spark):
    import numpy as np

    from prismtab.operators.groupkeys import exact_quantiles

    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    fr = [0.0, 0.25, 0.5, 0.9, 1.0]
    assert exact_quantiles(df, "x", fr) == pytest.approx(list(np.quantile(vals, fr)))


def test_classes_order():
    assert CLASSES[0] == "GALAXY"


def test_exact_quantiles_with_hot_value(spark):
    """A value repeated on a third of the rows: still exact, and the range
    partitions stay balanced thanks to the row-hash tiebreak."""
    import numpy as np

    from prismtab.operators.groupkeys import exact_quantiles

    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.col("id") * 0.001).alias("x"),
                                  "id")
    vals = [r[0] for r in df.collect()]
    fr = [0.0, 0.1, 0.33, 0.5, 0.9, 1.0]
    assert exact_quantiles(df, "x", fr) == pytest.approx(list(np.quantile(vals, fr)))


def test_bucketed_rank_with_hot_class(spark):
    """One class holding most rows: ranks stay exact per class."""
    from pyspark.sql import Window

    df = spark.range(5000).select("id", F.when(F.col("id") % 10 < 7, "STAR").otherwise("QSO").alias("class"))
    ours = {r["id"]: r["class_rank"] for r in FO.class_rank(df, "class", prefix_len=2).collect()}
    w = Window.partitionBy("class").orderBy(FO.order_key("id", 42), "id")
    plain = {r["id"]: r["rk"] for r in df.select("id", (F.row_number().over(w) - 1).alias("rk")).collect()}
    assert ours == plain


def test_fast_rounding_is_that_of_decimals(spark):
    from prismtab.plans.catalog import round_half_up

    h = F.xxhash64("id")
    x = F.when(F.col("id") % 4 == 0, h / 2.0**40).when(F.col("id") % 4 == 1, F.pmod(h, F.lit(10**9)) / 1e7 * F.signum(h)).otherwise(F.pmod(h, F.lit(10**6)) * 10.0 ** (F.col("id") % 23 - 14))
    odd = spark.createDataFrame([(v,) for v in (None, float("nan"), float("inf"), -float("inf"), -0.0, -1e-9, 5e-7, -5e-7, 1.0000005, 2.5e300, 1e-320, 1099511.6277755, 1099511.627776)], "x double")
    values = spark.range(200_000).select(x.alias("x")).unionByName(odd)
    both = values.select("x", F.round("x", 6).alias("a"), round_half_up(F.col("x"), 6).alias("b"))
    assert "rint" in both._jdf.queryExecution().analyzed().toString().lower()
    off = both.where(~(F.col("a") + F.lit(0.0)).eqNullSafe(F.col("b") + F.lit(0.0)))
    assert off.collect() == []
