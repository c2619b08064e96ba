"""Edge rows (literal DataFrames) for the cases listed in FIXTURES.md §3."""

import math
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from prismtab.constants import CLASSES
from prismtab.functions import cleaning, features as FT, proba as P
from prismtab.operators import arbitrate as A
from prismtab.operators import checks as C
from prismtab.operators import groupkeys as GK
from prismtab.operators import metrics as M
from prismtab.operators import registry as RG
from prismtab.operators import search as S

MAG_SCHEMA = "id long, u double, g double, r double, i double, z double, redshift double"


def test_row_stats_skip_nulls(spark):
    df = spark.createDataFrame([(1, 20.0, 19.0, None, 17.0, 16.0, 0.1), (2, None, None, None, None, None, 0.1)],
                               MAG_SCHEMA)
    out = {r["id"]: r for r in FT.astronomy_features(df).collect()}
    vals = [20.0, 19.0, 17.0, 16.0]
    mean = sum(vals) / 4
    std = math.sqrt(sum((v - mean) ** 2 for v in vals) / 3)
    assert out[1]["mag_mean"] == pytest.approx(mean)
    assert out[1]["mag_std"] == pytest.approx(std)
    assert out[1]["mag_range"] == pytest.approx(4.0)
    assert out[2]["mag_mean"] is None and out[2]["mag_std"] is None


def test_clean_numeric_nan_inf_to_null_and_flags_zero(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, float("-inf")), (4, 0.05)],
                               "id long, redshift double")
    clean = cleaning.clean_numeric(df)
    got = {r["id"]: r["redshift"] for r in clean.collect()}
    assert got[1] is None and got[2] is None and got[3] is None and got[4] == 0.05
    flags = FT.error_diagnostic_features(clean).collect()
    assert all(r["redshift_very_low_le_00497"] in (0, 1) for r in flags)
    assert {r["id"]: r["redshift_very_low_le_00497"] for r in flags}[1] == 0


def test_redshift_zero_and_negative_no_ansi_error(spark):
    df = spark.createDataFrame([(1, 18.0, 17.0, 16.5, 16.0, 15.5, 0.0), (2, 18.0, 17.0, 16.5, 16.0, 15.5, -0.01)],
                               MAG_SCHEMA)
    out = FT.sdss_external_features(FT.astronomy_features(df)).collect()
    assert all(math.isfinite(r["u_redshift_ratio"]) and math.isfinite(r["sdss_cperp_over_redshift_abs"]) for r in out)


@pytest.mark.parametrize("z,low_mid,very_low,le144", [(0.0497, 0, 1, 1), (0.127, 1, 0, 1), (0.144, 0, 0, 1),
                                                       (0.1441, 0, 0, 0)])
def test_redshift_band_edges(spark, z, low_mid, very_low, le144):
    df = spark.createDataFrame([(1, z)], "id long, redshift double")
    r = FT.error_diagnostic_features(df).first()
    assert (r["redshift_low_00497_0127"], r["redshift_very_low_le_00497"], r["redshift_low_le_0144"]) == (
        low_mid, very_low, le144)


def test_argmax_tie_first_class_wins(spark):
    df = spark.createDataFrame([(0.4, 0.4, 0.2), (0.2, 0.4, 0.4), (0.3, 0.3, 0.3)], "a double, b double, c double")
    got = [r[0] for r in df.select(P.argmax_class(["a", "b", "c"])).collect()]
    assert got == ["GALAXY", "QSO", "GALAXY"]


def test_logit_finite_at_zero_and_one(spark):
    df = spark.createDataFrame([(1, 1.0, 0.0, 0.0)], "id long, m__GALAXY double, m__QSO double, m__STAR double")
    r = P.logit_features(df, {"m": P.block_columns("m")}, eps=1e-5).first()
    assert all(math.isfinite(v) for v in r.asDict().values())


def test_p_qso_equal_threshold_selects_qso(spark):
    df = spark.createDataFrame([(0.3, 0.46, 0.24)], "g double, q double, s double")
    final, staged, replaced = P.two_stage(F.col("g"), F.col("q"), F.col("s"), 0.46, 0.38, 0.0)
    r = df.select(final.alias("f"), staged.alias("st")).first()
    assert r["st"] == "QSO" and r["f"] == "QSO"


def test_balanced_accuracy_absent_class_conventions(spark):
    df = spark.createDataFrame([("GALAXY", "GALAXY"), ("QSO", "GALAXY")], "t string, p string")
    zero = M.prediction_metrics(df, "t", "p", absent="zero").first()["balanced_accuracy"]
    skip = M.prediction_metrics(df, "t", "p", absent="skip").first()["balanced_accuracy"]
    assert zero == pytest.approx(1.0 / 3.0) and skip == pytest.approx(0.5)


def test_one_row_group_std_falls_back_to_global(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 4.0)], "k string, v double")
    test = spark.createDataFrame([("a",), ("c",), (None,)], "k string")
    fitted = GK.fit_group_stats(train, ["k"], "v")
    glob = GK.global_stats(train, "v")
    out = {r["k"]: r for r in GK.attach_group_stats(test, fitted, glob, ["k"], "v").collect()}
    gstd = train.agg(F.stddev_samp("v")).first()[0]
    assert out["a"]["v__std"] == pytest.approx(gstd)     # one-row group → NULL std → global
    assert out["c"]["v__mean"] == pytest.approx(7.0 / 3)  # unseen key → global mean
    assert out["c"]["v__count"] == 0.0
    assert out[None]["v__count"] == 0.0


def test_qcut_duplicate_edges_and_right_closed(spark):
    vals = [1.0, 1.0, 1.0, 1.0, 2.0, 3.0, 4.0, 5.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    edges = GK.qcut_edges(df, "x", 4)
    assert edges == sorted(set(edges)) and edges[0] == 1.0
    labels = [r[0] for r in df.select(GK.qcut_label(F.col("x"), edges)).collect()]
    # repeated minimum → label 0; value equal to an edge → lower bin; NULL → -1
    assert labels[0] == 0 and labels[-1] == -1
    e1 = edges[1]
    lab_at_edge = df.where(F.col("x") == e1).select(GK.qcut_label(F.col("x"), edges)).first()
    if lab_at_edge is not None:
        assert lab_at_edge[0] == 0


def test_null_key_joins_null(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, x int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, y int")
    out = {r["x"]: r["y"] for r in C.null_safe_join(left, right, ["k"]).collect()}
    assert out == {1: 10, 2: 20}


def test_no_disagreement_gives_empty_flows_and_unchanged_base(spark):
    df = spark.createDataFrame([(1, "GALAXY", "GALAXY", "GALAXY"), (2, "STAR", "QSO", "QSO")],
                               "id long, class string, a string, b string")
    flows = A.flow_utility(df, "class", "a", "b")
    assert flows.count() == 0
    assert A.rank_flows(flows).count() == 0
    out = A.apply_flows(df, "a", "b", flows).collect()
    assert all(r["arb_pred"] == r["a"] for r in out)


def test_missing_prediction_counts_as_wrong(spark):
    labels = spark.createDataFrame([(1, "STAR"), (2, "GALAXY")], "id long, class string")
    pred = spark.createDataFrame([(1, "STAR")], "id long, a string")
    d = labels.join(pred, "id", "left").fillna("", ["a"])
    wrong = {r["id"]: r["w"] for r in d.select("id", (F.col("a") != F.col("class")).alias("w")).collect()}
    assert wrong == {1: False, 2: True}


def test_duplicate_id_in_one_to_one_join_raises(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y")], "id long, v string")
    b = spark.createDataFrame([(1, "z")], "id long, w string")
    with pytest.raises(C.ContractError):
        C.one_to_one(a, b)


def test_unknown_class_raises(spark):
    df = spark.createDataFrame([(1, "GALAXY"), (2, "PLANET")], "id long, class string")
    with pytest.raises(C.ContractError):
        C.check_class_domain(df, "class")


def test_two_prefixes_detection_error():
    cols = ["id"] + P.block_columns("a") + P.block_columns("b")
    with pytest.raises(ValueError):
        P.detect_prefix(cols)
    assert P.detect_prefix(["id"] + P.block_columns("only")) == "only"


def test_malformed_jsonl_line_skipped(spark):
    d = tempfile.mkdtemp(prefix="prismtab-jsonl-")
    p = os.path.join(d, "registry.jsonl")
    with open(p, "w") as f:
        f.write('{"submission_relpath": "a.csv", "notes": "ok"}\n\n{not json\n{"submission_relpath": "b.csv"}\n')
    df = RG.read_registry_jsonl(spark, p)
    assert sorted(r["submission_relpath"] for r in df.collect()) == ["a.csv", "b.csv"]


def test_output_audit_counts_duplicates_and_nulls(spark):
    df = spark.createDataFrame([(1, "GALAXY"), (1, "STAR"), (None, None), (2, "STAR")], "id long, class string")
    r = RG.output_audit(df).first()
    assert (r["row_count"], r["id_null_count"], r["unique_id_count"], r["duplicate_id_count"],
            r["target_null_count"]) == (4, 1, 2, 1, 1)
    assert r["class_distribution"] == '{"<NA>": 1, "GALAXY": 1, "STAR": 2}'
    assert r["predicted_classes"] == "<NA>|GALAXY|STAR"


def test_upsert_keeps_newest(spark):
    old = spark.createDataFrame([("a", "v1"), ("b", "v1")], "submission_relpath string, notes string")
    new = spark.createDataFrame([("b", "v2")], "submission_relpath string, notes string")
    out = {r[0]: r[1] for r in RG.upsert(old, new).collect()}
    assert out == {"a": "v1", "b": "v2"}


def test_grid_axes():
    assert S.steps("0.40", "0.60", "0.02")[-1] == 0.6
    assert len(S.steps("0.50", "0.95", "0.03")) == 16
    assert S.axis([0.3, 0.1, 0.3]) == [0.1, 0.3]
    with pytest.raises(ValueError):
        S.steps("0", "1", "0")
    with pytest.raises(ValueError):
        S.axis([])


def test_slice_names_lattice():
    names = M.slice_names(["a", "b", "c"])
    assert names[0][0] == "ALL" and len(names) == 8 and ("a&b&c", ("a", "b", "c")) in names


def test_weighted_average_skips_missing_and_errors_when_none(spark):
    df = spark.createDataFrame([(0.5, 0.3, 0.2)], "m__GALAXY double, m__QSO double, m__STAR double")
    cols = P.weighted_average(df, {"m": P.block_columns("m"), "absent": P.block_columns("absent")}, {"m": 2.0})
    r = df.select(*cols).first()
    assert sum(r) == pytest.approx(1.0) and r[0] == pytest.approx(0.5)
    with pytest.raises(ValueError):
        P.weighted_average(df, {"absent": P.block_columns("absent")})


def test_classes_constant():
    assert CLASSES == ["GALAXY", "QSO", "STAR"]


def test_feature_set_builder_and_group_features(spark):
    from prismtab.operators.groupkeys import group_aggregate_features
    from prismtab.sources.fixtures import load_obs

    obs = load_obs(spark, "/root/testdata/sf0.001")
    train = obs.where(F.col("split") == "train")
    test = obs.where(F.col("split") == "test").drop("class")
    gtr, gte = group_aggregate_features(train, test, [(["spectral_type"], "redshift", "mean"),
                                                      (["galaxy_population", "spectral_type"], "u", "count")])
    assert gtr.count() == train.count() and gte.count() == test.count()
    sets = FT.build_feature_sets(train, test, group_features=(gtr, gte))
    assert {"raw", "baseline", "extra", "targeted", "local_guard", "groupagg", "wide", "targeted_wide"} <= set(sets)
    wide_cols = set(sets["wide"][0].columns)
    assert "gb__spectral_type__redshift__mean" in wide_cols and "u_minus_mag_mean" in wide_cols
    assert "hard_star_gr_high" in set(sets["targeted"][0].columns) and "redshift_sq" in set(sets["targeted"][0].columns)
    assert sets["wide"][0].count() == train.count()


def test_align_columns_and_drop_non_features(spark):
    train = spark.createDataFrame([(1, "STAR", 0.5, "M")], "id long, class string, a double, cat string")
    test = spark.createDataFrame([(2, 0.7, 3.0)], "id long, a double, extra double")
    tr, te = cleaning.align_columns(train, test)
    assert tr.columns == te.columns == ["id", "a", "cat", "extra"]
    assert te.first()["cat"] is None and tr.first()["extra"] is None
    assert cleaning.drop_non_features(train).columns == ["a", "cat"]
    (coded_tr, coded_te) = cleaning.encode_categoricals([tr, te], ["cat"])
    # sorted levels: "M" < "__NA__" (NULL), so codes 0 and 1
    assert {r["cat"] for r in coded_tr.collect()} == {0} and {r["cat"] for r in coded_te.collect()} == {1}


def test_f_tail_closed_forms(spark):
    from prismtab.functions.special import f_tail

    rows = [(f, d1, d2) for f in (1e-9, 0.01, 0.3, 1.0, 2.5, 40.0, 1e6) for d1 in (1, 2, 3, 7, 40) for d2 in (2, 6, 101, 11_997, 10**6)]
    df = spark.createDataFrame(rows, "f double, d1 int, d2 long")
    for r in df.withColumn("p", f_tail(F.col("f"), F.col("d1"), F.col("d2"))).collect():
        if r.d1 == 2:
            assert r.p == pytest.approx((1 + 2 * r.f / r.d2) ** (-r.d2 / 2), rel=1e-8, abs=1e-300)
        if r.d2 == 2:
            assert r.p == pytest.approx(1 - (r.d1 * r.f / (2 + r.d1 * r.f)) ** (r.d1 / 2), rel=1e-8)
        if r.d1 == r.d2 and r.f == 1.0:
            assert r.p == pytest.approx(0.5)
        assert 0 <= r.p <= 1
    edge = spark.createDataFrame([(0.0, 3, 20), (None, 3, 20)], "f double, d1 int, d2 long")
    assert [r[0] for r in edge.select(f_tail(F.col("f"), F.col("d1"), F.col("d2"))).collect()] == [1.0, None]


def test_register_prediction_and_upsert_table(spark):
    d = tempfile.mkdtemp(prefix="prismtab-registry-")
    path = os.path.join(d, "registry.parquet")
    pred = spark.createDataFrame([(1, "STAR"), (2, "GALAXY"), (2, "GALAXY")], "id long, class string")
    r1 = RG.register_prediction(pred, "runs/a.csv", "m1", "argmax", {"balanced_accuracy": 0.9, "accuracy": 0.8},
                                {"k": 5}, "first")
    row = r1.first()
    assert (row["row_count"], row["duplicate_id_count"], row["primary_metric_name"]) == (3, 1, "accuracy")
    assert row["metrics_json"] == '{"accuracy":0.8,"balanced_accuracy":0.9}'
    RG.upsert_registry_table(spark, path, r1)
    r2 = RG.register_prediction(pred.limit(2), "runs/a.csv", "m1", notes="second")
    r3 = RG.register_prediction(pred, "runs/b.csv", "m2", metrics={"log_loss": 0.3})
    RG.upsert_registry_table(spark, path, r2)
    out = {r["submission_relpath"]: r for r in RG.upsert_registry_table(spark, path, r3).collect()}
    assert set(out) == {"runs/a.csv", "runs/b.csv"}
    assert out["runs/a.csv"]["notes"] == "second" and out["runs/b.csv"]["primary_metric_name"] == "log_loss"


def test_anova_with_pvalues(spark):
    rows = [("A", 1.0), ("A", 1.2), ("A", 0.9), ("B", 3.0), ("B", 3.1), ("B", 2.8), ("C", 1.0), ("C", 1.1), ("C", 0.95)]
    df = spark.createDataFrame(rows, "class string, x double").withColumn("noise", F.lit(1.0) + F.col("x") * 0)
    out = {r["feature"]: r for r in GK.anova_with_pvalues(df, "class", ["x"]).collect()}
    r = out["x"]
    assert r["df_between"] == 2 and r["df_within"] == 6 and r["f_score"] > 100
    assert r["p_value"] == pytest.approx((1 + 2 * r["f_score"] / 6) ** (-3), rel=1e-9)


def test_long_key_names_score_apart(spark):
    long = "a" * 200
    rows = [(i, "GALAXY" if i % 2 else "STAR", str(i % 2), "same") for i in range(80)]
    df = spark.createDataFrame(rows, f"id long, class string, {long}x string, {long}y string")
    cells = GK.group_cells(df, df, "class", [(f"{long}x",), (f"{long}y",)])
    got = {r["keys"]: r["weighted_purity"] for r in GK.group_key_scores(cells).collect()}
    assert got == {f"{long}x": 1.0, f"{long}y": 0.5}


def test_candidates_are_all_kept_unless_a_limit_says_so():
    cats, bins = [f"c{i}" for i in range(5)], [f"b{i}" for i in range(40)]
    keys = GK.group_candidates(cats, bins)
    assert len(keys) == len(set(keys)) == 45 + 10 + 200 + 780 + 10 * 40 + 5 * 780
    with pytest.warns(UserWarning, match="drops"):
        assert len(GK.group_candidates(cats, bins, limit=100)) == 100


def test_samples_count_null_labels(spark):
    from prismtab.operators import folds

    df = spark.range(10_000).withColumn("class", F.when(F.col("id") % 4 == 0, None).when(F.col("id") % 4 == 1, "STAR").otherwise("QSO"))
    for take in (folds.stratified_sample, folds.proportional_sample):
        got = take(df, "class", 1000)
        assert got.count() == 1000 and got.where("class is null").count() == 250


def test_unknown_classes_end_the_job(spark):
    from prismtab.operators import metrics

    ok = spark.createDataFrame([("STAR", "QSO")], "class string, p string")
    assert metrics.confusion(ok, "class", "p").agg(F.sum("n")).first()[0] == 1
    for bad in (("STAR", None), ("NOVA", "QSO")):
        with pytest.raises(Exception, match="unknown class"):
            metrics.confusion(spark.createDataFrame([bad], "class string, p string"), "class", "p").collect()


def test_registry_and_optional_input_by_uri(spark):
    from prismtab.sources import io as IO

    d = tempfile.mkdtemp(prefix="prismtab-uri-")
    pred = spark.createDataFrame([(1, "STAR")], "id long, class string")
    for name in ("a", "b", "c"):
        out = RG.upsert_registry_table(spark, f"file://{d}/registry", RG.register_prediction(pred, name))
    assert sorted(r["submission_relpath"] for r in out.collect()) == ["a", "b", "c"]
    assert sorted(n for n in os.listdir(f"{d}/registry")) == ["version=2", "version=3"]
    pred.write.parquet(f"file://{d}/pred")
    assert IO.optional_frame(spark, f"file://{d}/pred", IO.PRED_SCHEMA).count() == 1
    assert IO.optional_frame(spark, f"file://{d}/none", IO.PRED_SCHEMA).count() == 0


def test_no_metrics_give_no_metric(spark):
    row = RG.register_prediction(spark.createDataFrame([(1, "STAR")], "id long, class string"), "x").first()
    assert row["primary_metric_name"] is None and row["metrics_json"] in (None, "{}")


def test_null_safe_full_join_keeps_the_keys_of_both_sides(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, a int")
    b = spark.createDataFrame([("y", 3), (None, 4)], "k string, b int")
    got = sorted(map(tuple, C.null_safe_join(a, b, "k", "full_outer").collect()), key=str)
    assert got == sorted([("x", 1, None), (None, 2, 4), ("y", None, 3)], key=str)


def test_folds_do_not_depend_on_the_number_of_buckets(spark, monkeypatch):
    from prismtab.operators import folds

    df = spark.range(20_000).withColumn("class", F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 9 == 0, "STAR").otherwise("QSO"))
    want = {r.id: r.fold for r in folds.stratified_folds(df, "class", prefix_len=2).collect()}
    assert folds.prefix_length(df, "class") == 1
    monkeypatch.setattr(folds, "BUCKET_ROWS", 3)
    assert folds.prefix_length(df, "class") == 4
    assert {r.id: r.fold for r in folds.stratified_folds(df, "class").collect()} == want
