"""Registered arbitration, filter, join and set-operation queries
(J-01..J-04, G-04, B-40, B-41, C-03..C-10, D-01..D-10, H-01..H-04)."""

from __future__ import annotations

from pyspark.sql import functions as F

from prismtab.functions.cleaning import encode_categoricals
from prismtab.functions.features import astronomy_features, guard_features_v2
from prismtab.functions.proba import argmax_class, take_b_if_a_galaxy, take_x_on_flows
from prismtab.operators import arbitrate as A
from prismtab.operators import checks as C
from prismtab.operators.ranking import rank_scoreboard
from prismtab.plans.catalog import register, rounded
from prismtab.plans.common import PREDS_SQL, model_cols, predictions, with_views
from prismtab.sources.fixtures import load_obs, load_pro, read_table

W = "CASE class WHEN 'GALAXY' THEN 1e0 WHEN 'QSO' THEN 3.2e0 WHEN 'STAR' THEN 4.6e0 END"


def _flows(spark, sf_dir):
    train = predictions(spark, sf_dir, "train")
    return A.flow_utility(train, "class", "pred_m1", "pred_m2")


FLOW_SQL = f"""flows AS (
  SELECT pred_m1 AS base_pred, pred_m2 AS other_pred, count(*) AS n,
    sum({W} * ((CASE WHEN pred_m2 = class THEN 1 ELSE 0 END) - (CASE WHEN pred_m1 = class THEN 1 ELSE 0 END)))
      AS delta
  FROM preds WHERE split = 'train' AND pred_m1 <> pred_m2 GROUP BY ALL
)"""


# ---------------------------------------------------------------- J-01
@register("j01_flow_utility", with_views(PREDS_SQL, FLOW_SQL) + """SELECT base_pred, other_pred, n,
  round(delta, 6) AS delta_weighted_correct, round(delta / n, 6) AS mean_delta_weighted_correct,
  (n >= 1 AND delta > 0) AS selected FROM flows""")
def q_flow_utility(spark, sf_dir):
    return rounded(_flows(spark, sf_dir))


# ---------------------------------------------------------------- G-04
@register("g04_flow_ranking", with_views(PREDS_SQL, FLOW_SQL) + """SELECT base_pred, other_pred, n,
  round(delta, 6) AS delta_weighted_correct,
  row_number() OVER (ORDER BY (n >= 1 AND delta > 0) DESC, round(delta, 12) DESC, n DESC, base_pred, other_pred) AS rank
FROM flows""")
def q_flow_ranking(spark, sf_dir):
    from prismtab.operators.search import order_cols

    f = _flows(spark, sf_dir)
    order = order_cols([("selected", "desc"), ("delta_weighted_correct", "desc"), ("n", "desc"), ("base_pred", "asc"), ("other_pred", "asc")], f)
    return rounded(rank_scoreboard(f, order).select("base_pred", "other_pred", "n", "delta_weighted_correct",
                                                    F.col("rank").cast("bigint").alias("rank")))


APPLY_SQL = """arb AS (
  SELECT p.*, CASE WHEN f.delta > 0 THEN p.pred_m2 ELSE p.pred_m1 END AS arb_pred
  FROM preds p LEFT JOIN flows f ON p.pred_m1 = f.base_pred AND p.pred_m2 = f.other_pred
)"""


# ---------------------------------------------------------------- J-02
@register("j02_apply_flows", with_views(PREDS_SQL, FLOW_SQL, APPLY_SQL)
          + "SELECT id, arb_pred FROM arb WHERE split = 'train'")
def q_apply_flows(spark, sf_dir):
    train = predictions(spark, sf_dir, "train")
    return A.apply_flows(train, "pred_m1", "pred_m2", _flows(spark, sf_dir)).select("id", "arb_pred")


# ---------------------------------------------------------------- J-03
def _score_sql(name: str, col: str) -> str:
    bal = " + ".join(
        f"coalesce(sum(CASE WHEN class = '{c}' AND {col} = '{c}' THEN 1 ELSE 0 END) / "
        f"nullif(sum(CASE WHEN class = '{c}' THEN 1 ELSE 0 END), 0), 0e0)"
        for c in ("GALAXY", "QSO", "STAR")
    )
    return f"""SELECT '{name}' AS candidate, round(avg(CASE WHEN {col} = class THEN 1e0 ELSE 0e0 END), 6) AS accuracy,
  round(({bal}) / 3e0, 6) AS balanced_accuracy,
  round(sum(CASE WHEN {col} = class THEN {W} ELSE 0e0 END) / sum({W}), 6) AS weighted_accuracy,
  CAST(sum(CASE WHEN {col} <> class THEN 1 ELSE 0 END) AS BIGINT) AS errors
FROM arb WHERE split = 'train'"""


@register("j03_arbitration_scores", with_views(PREDS_SQL, FLOW_SQL, APPLY_SQL) + "\nUNION ALL\n".join(
    [_score_sql("a", "pred_m1"), _score_sql("b", "pred_m2"), _score_sql("arbitrated", "arb_pred")]))
def q_arbitration_scores(spark, sf_dir):
    train = predictions(spark, sf_dir, "train")
    arb = A.apply_flows(train, "pred_m1", "pred_m2", _flows(spark, sf_dir))
    return rounded(A.arbitration_scores(arb, "class", {"a": "pred_m1", "b": "pred_m2", "arbitrated": "arb_pred"}))


# ---------------------------------------------------------------- J-04
@register("j04_materialize_arbitration", with_views(PREDS_SQL, FLOW_SQL, APPLY_SQL)
          + "SELECT id, arb_pred AS class FROM arb WHERE split = 'test'")
def q_materialize_arbitration(spark, sf_dir):
    test = predictions(spark, sf_dir, "test")
    out = A.apply_flows(test, "pred_m1", "pred_m2", _flows(spark, sf_dir))
    return out.select("id", F.col("arb_pred").alias("class"))


# ---------------------------------------------------------------- B-40 / B-41
@register("b40_b41_reconstruct_streams", with_views(PREDS_SQL) + """SELECT id,
  CASE WHEN pred_m1 = 'GALAXY' AND pred_m2 IN ('QSO', 'STAR') THEN pred_m2 ELSE pred_m1 END AS take_b,
  CASE WHEN (pred_m1 = 'QSO' AND pred_m3 = 'GALAXY') OR (pred_m1 = 'STAR' AND pred_m3 = 'QSO') THEN pred_m1
       ELSE pred_m3 END AS take_x
FROM preds""")
def q_reconstruct(spark, sf_dir):
    p = predictions(spark, sf_dir, None)
    return p.select("id", take_b_if_a_galaxy(F.col("pred_m1"), F.col("pred_m2")).alias("take_b"),
                    take_x_on_flows(F.col("pred_m1"), F.col("pred_m3")).alias("take_x"))


# ---------------------------------------------------------------- C-03
@register("c03_local_region_counts", with_views("""gv AS (
  SELECT class, abs(redshift) AS za, galaxy_population,
    sqrt(((u-g)*(u-g) + (g-r)*(g-r) + (r-i)*(r-i) + (i-z)*(i-z))/4) AS rms,
    sqrt(((u-mm)*(u-mm) + (g-mm)*(g-mm) + (r-mm)*(r-mm) + (i-mm)*(i-mm) + (z-mm)*(z-mm))/4) AS mstd
  FROM (SELECT *, (u+g+r+i+z)/5 AS mm FROM obs WHERE split = 'train')
)""") + """SELECT class, count(*) AS n FROM gv
WHERE za <= 0.144 AND rms <= 1.3 AND mstd <= 0.75 AND galaxy_population = 'Blue_Cloud' GROUP BY class""")
def q_local_region(spark, sf_dir):
    obs = guard_features_v2(astronomy_features(load_obs(spark, sf_dir).where(F.col("split") == "train")))
    region = (F.col("redshift_abs") <= 0.144) & (F.col("compact_color_rms") <= 1.30) & (
        F.col("mag_std") <= 0.75) & (F.col("is_blue_cloud") == 1)
    # mask inside the aggregate: a filter on the derived region flag would be
    # pushed below the feature projection and re-expand it
    return obs.groupBy("class").agg(F.sum(F.when(region, 1).otherwise(0)).alias("n")).where(F.col("n") > 0)


# ---------------------------------------------------------------- C-05
@register("c05_hard_case_ids", with_views(PREDS_SQL) + """SELECT id, class FROM preds
WHERE split = 'train' AND class IN ('STAR', 'QSO') AND pred_m1 = 'GALAXY'""")
def q_hard_cases(spark, sf_dir):
    p = predictions(spark, sf_dir, "train")
    return p.where(F.col("class").isin("STAR", "QSO") & (F.col("pred_m1") == "GALAXY")).select("id", "class")


# ---------------------------------------------------------------- C-06
@register("c06_all_wrong_ids", with_views(PREDS_SQL) + """SELECT id, 0 AS model_correct_votes FROM preds
WHERE split = 'train' AND pred_m1 <> class AND pred_m2 <> class AND pred_m3 <> class""")
def q_all_wrong(spark, sf_dir):
    p = predictions(spark, sf_dir, "train")
    votes = sum((F.when(F.col(f"pred_{m}") == F.col("class"), 1).otherwise(0) for m in ("m1", "m2", "m3")),
                F.lit(0))
    return p.select("id", votes.alias("model_correct_votes")).where(F.col("model_correct_votes") == 0)


# ---------------------------------------------------------------- C-07
@register("c07_diagnostic_flags", with_views(PREDS_SQL, """d AS (
  SELECT o.id, o.class, coalesce(p.pred_m1, '') AS a, coalesce(q.pred_m2, '') AS b
  FROM obs o
  LEFT JOIN (SELECT id, pred_m1 FROM preds WHERE split = 'train') p USING (id)
  LEFT JOIN (SELECT id, pred_m2 FROM preds) q USING (id)
), e AS (SELECT *, CASE WHEN a = 'GALAXY' AND b IN ('QSO', 'STAR') THEN b ELSE a END AS c FROM d)""")
          + """SELECT id, a <> c AS disagreement, (a <> class AND c <> class) AS both_wrong,
  (class IN ('STAR', 'GALAXY') AND a IN ('STAR', 'GALAXY') AND c IN ('STAR', 'GALAXY')
   AND (a <> class OR c <> class)) AS star_gal_hard
FROM e""")
def q_diagnostic_flags(spark, sf_dir):
    """C-07 with a partial prediction table: ``a`` only covers the train
    split, so on test rows the missing prediction '' counts as wrong."""
    obs = load_obs(spark, sf_dir).select("id", "class")
    p = predictions(spark, sf_dir, None)
    a = p.where(F.col("split") == "train").select("id", F.col("pred_m1").alias("a"))
    b = p.select("id", F.col("pred_m2").alias("b"))
    d = obs.join(a, "id", "left").join(b, "id", "left").fillna("", ["a", "b"])
    d = d.withColumn("c", take_b_if_a_galaxy(F.col("a"), F.col("b")))
    t, x, y = F.col("class"), F.col("a"), F.col("c")
    sg = ["STAR", "GALAXY"]
    return d.select(
        "id",
        (x != y).alias("disagreement"),
        ((x != t) & (y != t)).alias("both_wrong"),
        (t.isin(*sg) & x.isin(*sg) & y.isin(*sg) & ((x != t) | (y != t))).alias("star_gal_hard"),
    )


# ---------------------------------------------------------------- C-08 / C-09
@register("c08_unknown_class_values", """SELECT DISTINCT l_returnflag AS value FROM lineitem
WHERE l_returnflag IS NOT NULL AND l_returnflag NOT IN ('A', 'N')""")
def q_unknown_classes(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return C.unknown_classes(li, "l_returnflag", ["A", "N"])


@register("c09_null_counts", """SELECT CAST(sum(CASE WHEN d.doc_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS doc_id,
  CAST(sum(CASE WHEN l.quality IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS quality,
  CAST(sum(CASE WHEN l.toxic IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS toxic
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def q_null_counts(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id")
    lab = read_table(spark, sf_dir, "labels")
    return C.null_counts(d.join(lab, "doc_id", "left"), ["doc_id", "quality", "toxic"])


# ---------------------------------------------------------------- C-10
@register("c10_replaced_rows", with_views("""r AS (
  SELECT id, class, greatest(m1__GALAXY, 1e-12) AS g0, greatest(m1__QSO, 1e-12) AS q0, greatest(m1__STAR, 1e-12) AS s0
  FROM pro WHERE split = 'train'
), x AS (
  SELECT id, class, pq, base, ps / greatest(pg + ps, 1e-12) AS sgo, pg / greatest(pg + ps, 1e-12) AS ggo
  FROM (SELECT id, class, g0 / (g0 + q0 + s0) AS pg, q0 / (g0 + q0 + s0) AS pq, s0 / (g0 + q0 + s0) AS ps,
          CASE WHEN g0 >= q0 AND g0 >= s0 THEN 'GALAXY' WHEN q0 >= s0 THEN 'QSO' ELSE 'STAR' END AS base FROM r)
), s AS (SELECT *, CASE WHEN pq >= 0.46 THEN 'QSO' WHEN sgo >= 0.38 THEN 'STAR' ELSE 'GALAXY' END AS staged FROM x)""")
          + """SELECT id, class, base AS base_class, staged AS staged_class FROM s
WHERE staged <> base AND (CASE staged WHEN 'QSO' THEN pq WHEN 'STAR' THEN sgo ELSE ggo END) >= 0.5""")
def q_replaced_rows(spark, sf_dir):
    from prismtab.operators.search import apply_threshold_row

    pro = load_pro(spark, sf_dir).where(F.col("split") == "train")
    row = {"qso_threshold": 0.46, "star_threshold": 0.38, "replace_threshold": 0.5}
    out = apply_threshold_row(pro, model_cols("m1"), row, out="final")
    out = out.withColumn("base_class", argmax_class(model_cols("m1")))
    from prismtab.session import cut_lineage

    audit = cut_lineage(out.select("id", "class", "base_class", "staged_class", "replaced"))
    return audit.where(F.col("replaced")).select("id", "class", "base_class", "staged_class")


# ---------------------------------------------------------------- D-01 / D-02
@register("d01_join_runs", with_views() + """SELECT a.id, a.class, a.m1__GALAXY, b.m2__GALAXY
FROM pro a JOIN pro b USING (id) WHERE a.split = 'train'""")
def q_join_runs(spark, sf_dir):
    pro = load_pro(spark, sf_dir).where(F.col("split") == "train")
    a = pro.select("id", "class", "m1__GALAXY")
    b = load_pro(spark, sf_dir).select("id", "m2__GALAXY")
    return rounded(C.join_runs([a, b], ["id"]))


@register("d02_label_mismatches", with_views(PREDS_SQL) + """SELECT o.id, o.class AS _la, p.pred_m1 AS _lb
FROM obs o JOIN preds p USING (id) WHERE o.class IS DISTINCT FROM p.pred_m1""")
def q_label_mismatch(spark, sf_dir):
    """The true classes against those that a model's table claims."""
    claimed = predictions(spark, sf_dir, None).select("id", F.col("pred_m1").alias("class"))
    return C.label_mismatches(load_obs(spark, sf_dir), claimed)


# ---------------------------------------------------------------- D-03 / D-06
@register("d03_attach_labels", with_views(PREDS_SQL) + """SELECT p.id, p.pred_m1, o.class
FROM preds p LEFT JOIN obs o USING (id) WHERE p.split = 'test'""")
def q_attach_labels(spark, sf_dir):
    p = predictions(spark, sf_dir, "test").select("id", "pred_m1")
    labels = load_obs(spark, sf_dir)
    return C.attach_labels(p, labels)


@register("d06_one_to_one_join", with_views() + """SELECT o.id, o.split, p.m3__STAR
FROM obs o LEFT JOIN pro p USING (id)""")
def q_one_to_one(spark, sf_dir):
    obs = load_obs(spark, sf_dir).select("id", "split")
    pro = load_pro(spark, sf_dir).select("id", "m3__STAR")
    return rounded(C.one_to_one(obs, pro, "id", "left"))


# ---------------------------------------------------------------- D-05
@register("d05_row_preserving_join", with_views(PREDS_SQL) + """SELECT a.id, a.pred_m1, b.pred_m2
FROM preds a JOIN preds b USING (id)""")
def q_row_preserving(spark, sf_dir):
    p = predictions(spark, sf_dir, None)
    return C.row_preserving_inner(p.select("id", "pred_m1"), p.select("id", "pred_m2"))


# ---------------------------------------------------------------- D-07
@register("d07_attach_with_train_median", """WITH med AS (SELECT quantile_cont(l.quality, 0.5) AS m FROM labels l)
SELECT d.doc_id, round(coalesce(CAST(l.quality AS DOUBLE), coalesce(med.m, 0e0)), 6) AS quality
FROM documents d LEFT JOIN labels l USING (doc_id) CROSS JOIN med""")
def q_attach_median(spark, sf_dir):
    from prismtab.operators.groupkeys import attach_with_median

    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("quality"))
    return rounded(attach_with_median(docs, lab, "doc_id", ["quality"], lab))


# ---------------------------------------------------------------- D-09
@register("d09_membership_flag", """SELECT d.doc_id, (l.doc_id IS NOT NULL) AS in_set
FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)""")
def q_membership(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    lab = read_table(spark, sf_dir, "labels")
    return C.membership_flag(docs, lab, "doc_id")


# ---------------------------------------------------------------- D-10
@register("d10_outer_frequency_alignment", with_views("""tr AS (
  SELECT spectral_type, count(*) AS n FROM obs WHERE split = 'train' GROUP BY ALL
), te AS (SELECT spectral_type, count(*) AS n FROM obs WHERE split = 'test' GROUP BY ALL)""")
          + """SELECT coalesce(tr.spectral_type, te.spectral_type) AS spectral_type,
  CAST(coalesce(tr.n, 0) AS BIGINT) AS train_n, CAST(coalesce(te.n, 0) AS BIGINT) AS test_n
FROM tr FULL OUTER JOIN te ON tr.spectral_type IS NOT DISTINCT FROM te.spectral_type""")
def q_outer_alignment(spark, sf_dir):
    """D-10: both frequency tables, outer-joined on a key that may be NULL, missing counts 0."""
    obs = load_obs(spark, sf_dir)
    train, test = (obs.where(F.col("split") == s).groupBy("spectral_type").agg(F.count(F.lit(1)).alias(f"{s}_n")) for s in ("train", "test"))
    return C.null_safe_join(train, test, "spectral_type", "full").fillna(0, ["train_n", "test_n"])


# ---------------------------------------------------------------- H-01
@register("h01_union_train_test", with_views() + """SELECT split, count(*) AS n, count(spectral_type) AS n_typed
FROM (SELECT id, class, spectral_type, 'train' AS split FROM obs WHERE split = 'train'
      UNION ALL SELECT id, NULL AS class, spectral_type, 'test' AS split FROM obs WHERE split = 'test')
GROUP BY split""")
def q_union(spark, sf_dir):
    obs = load_obs(spark, sf_dir)
    train = obs.where(F.col("split") == "train").select("id", "class", "spectral_type")
    test = obs.where(F.col("split") == "test").select("id", "spectral_type")
    u = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")),
                                                             allowMissingColumns=True)
    return u.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.count("spectral_type").alias("n_typed"))


# ---------------------------------------------------------------- H-03
@register("h03_unseen_test_keys", with_views() + """SELECT DISTINCT o.o_custkey FROM orders o
WHERE o.o_orderkey IN (SELECT id FROM obs WHERE split = 'test') AND NOT EXISTS (
  SELECT 1 FROM orders t JOIN obs ON t.o_orderkey = obs.id
  WHERE obs.split = 'train' AND t.o_custkey IS NOT DISTINCT FROM o.o_custkey)""")
def q_unseen_keys(spark, sf_dir):
    """H-03: customers of test-split orders that never appear in the train split."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    split = load_obs(spark, sf_dir).select(F.col("id").alias("o_orderkey"), "split")
    o = orders.join(split, "o_orderkey")
    test = o.where(F.col("split") == "test").select("o_custkey")
    train = o.where(F.col("split") == "train").select(F.col("o_custkey").alias("_k"))
    return test.join(train, F.col("o_custkey").eqNullSafe(F.col("_k")), "left_anti").distinct()


# ---------------------------------------------------------------- H-04 / B-34 / B-35
@register("h04_category_codes", with_views("""v AS (SELECT DISTINCT coalesce(spectral_type, '__NA__') AS value FROM obs)""")
          + """SELECT o.id, CAST(c.code AS SMALLINT) AS spectral_type
FROM obs o JOIN (SELECT value, row_number() OVER (ORDER BY value) - 1 AS code FROM v) c
  ON coalesce(o.spectral_type, '__NA__') = c.value""")
def q_category_codes(spark, sf_dir):
    obs = load_obs(spark, sf_dir)
    train = obs.where(F.col("split") == "train").select("id", "spectral_type")
    test = obs.where(F.col("split") == "test").select("id", "spectral_type")
    tr, te = encode_categoricals([train, test], ["spectral_type"])
    return tr.unionByName(te)


# ---------------------------------------------------------------- A-03
@register("a03_pruned_read", "SELECT o_orderkey, o_orderstatus FROM orders")
def q_pruned_read(spark, sf_dir):
    """Column-pruned read by a name predicate; ``ReadSchema`` holds 2 columns."""
    from prismtab.sources.io import read_columns
    from prismtab.sources.fixtures import table_path

    return read_columns(spark, table_path(sf_dir, "orders"), lambda c: c in ("o_orderkey", "o_orderstatus"))


# ---------------------------------------------------------------- B-39
@register("b39_feature_set_extra", with_views("""fe AS (SELECT id, (u+g+r+i+z)/5 AS mm, redshift, u FROM obs)""")
          + """SELECT id, round(mm, 6) + 0e0 AS mag_mean, round(u - mm, 6) + 0e0 AS u_minus_mag_mean,
  round(redshift * redshift, 6) + 0e0 AS redshift_sq FROM fe""")
def q_feature_set(spark, sf_dir):
    from prismtab.functions.features import feature_set

    fs = feature_set(load_obs(spark, sf_dir), "extra")
    return rounded(fs.select("id", "mag_mean", "u_minus_mag_mean", "redshift_sq"))


# ---------------------------------------------------------------- B-36
@register("b36_numeric_frame", with_views("""lab AS (
  SELECT d.doc_id, CAST(l.quality AS DOUBLE) AS quality, d.lang FROM documents d LEFT JOIN labels l USING (doc_id)
), med AS (SELECT coalesce(quantile_cont(quality, 0.5), 0e0) AS m FROM lab),
lv AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS code
       FROM (SELECT DISTINCT coalesce(lang, '__NA__') AS value FROM lab))""")
          + """SELECT lab.doc_id, round(coalesce(lab.quality, med.m), 6) AS quality, CAST(lv.code AS SMALLINT) AS lang
FROM lab CROSS JOIN med JOIN lv ON coalesce(lab.lang, '__NA__') = lv.value""")
def q_numeric_frame(spark, sf_dir):
    """B-36: median-impute numerics (train median) and code categoricals."""
    from prismtab.functions.cleaning import median_impute

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("quality"))
    frame = docs.join(lab, "doc_id", "left")
    imputed, _ = median_impute(frame, [], ["quality"])
    (coded,) = encode_categoricals([imputed], ["lang"])
    return rounded(coded.select("doc_id", "quality", "lang"))


# ---------------------------------------------------------------- G-09
@register("g09_top_star_recall", with_views(PREDS_SQL, """lp AS (
  SELECT 'm1' AS model, class, pred_m1 AS pred FROM preds WHERE split = 'train'
  UNION ALL SELECT 'm2', class, pred_m2 FROM preds WHERE split = 'train'
  UNION ALL SELECT 'm3', class, pred_m3 FROM preds WHERE split = 'train'
), rc AS (SELECT model, class, avg(CASE WHEN pred = class THEN 1e0 ELSE 0e0 END) AS recall, sum(CASE WHEN pred = class THEN 1 ELSE 0 END) AS ok, count(*) AS n
  FROM lp GROUP BY model, class),
m AS (SELECT model, max(recall) FILTER (class = 'STAR') AS star, sum(recall) / 3 AS bal, CAST(sum(ok) AS DOUBLE) / sum(n) AS acc FROM rc GROUP BY model)""")
          + """SELECT * FROM (SELECT 'star_recall' AS board, CAST(row_number() OVER (ORDER BY round(star, 12) DESC, round(bal, 12) DESC, model) AS INT) AS rank,
  model, round(star, 6) AS recall_STAR, round(bal, 6) AS balanced_accuracy, round(acc, 6) AS accuracy FROM m) WHERE rank <= 10
UNION ALL SELECT * FROM (SELECT 'balanced', CAST(row_number() OVER (ORDER BY round(bal, 12) DESC, round(acc, 12) DESC, model) AS INT) AS rank,
  model, round(star, 6), round(bal, 6), round(acc, 6) FROM m) WHERE rank <= 10""")
def q_top_star_recall(spark, sf_dir):
    """Both lists of the sweep summary: by STAR recall and by balanced accuracy."""
    from pyspark.sql import Window

    from prismtab.operators.metrics import per_class_metrics, prediction_metrics
    from prismtab.operators.search import order_cols
    from prismtab.plans.q_metrics import long_predictions

    long = long_predictions(spark, sf_dir, "train")
    recall = per_class_metrics(long, "class", "pred", by=("model",)).select("model", "recall_STAR")
    board = recall.join(prediction_metrics(long, "class", "pred", by=("model",)).select("model", "balanced_accuracy", "accuracy"), "model")
    out = None
    for name, keys in (("star_recall", ("recall_STAR", "balanced_accuracy")), ("balanced", ("balanced_accuracy", "accuracy"))):
        order = order_cols([(k, "desc") for k in keys] + [("model", "asc")], board)
        top = board.orderBy(*order).limit(10).select(F.lit(name).alias("board"), F.row_number().over(Window.orderBy(*order)).alias("rank"), "*")
        out = top if out is None else out.unionByName(top)
    return rounded(out)


# ---------------------------------------------------------------- H-02 / D-11
@register("h02_d11_union_scores_with_lookup", with_views(PREDS_SQL, """sc AS (
  SELECT 'train' AS split, 'm1' AS model, avg(CASE WHEN pred_m1 = class THEN 1e0 ELSE 0e0 END) AS accuracy
    FROM preds WHERE split = 'train'
  UNION ALL SELECT 'test', 'm1', avg(CASE WHEN pred_m1 = class THEN 1e0 ELSE 0e0 END) FROM preds WHERE split = 'test'
  UNION ALL SELECT 'train', 'm2', avg(CASE WHEN pred_m2 = class THEN 1e0 ELSE 0e0 END) FROM preds WHERE split = 'train'
  UNION ALL SELECT 'test', 'm2', avg(CASE WHEN pred_m2 = class THEN 1e0 ELSE 0e0 END) FROM preds WHERE split = 'test'
), meta AS (SELECT * FROM (VALUES ('m1', 'synthetic', 60), ('m2', 'synthetic', 45)) t(model, model_type, strength))""")
          + """SELECT sc.split, sc.model, round(sc.accuracy, 6) AS accuracy, meta.model_type, meta.strength
FROM sc LEFT JOIN meta USING (model)""")
def q_union_scores(spark, sf_dir):
    """H-02: union of per-split score tables; D-11: broadcast lookup of
    experiment metadata (one row per experiment) by model name."""
    from prismtab.operators.metrics import prediction_metrics

    p = predictions(spark, sf_dir, None)
    tables = []
    for m in ("m1", "m2"):
        s = prediction_metrics(p, "class", f"pred_{m}", by=("split",)).select(
            "split", F.lit(m).alias("model"), "accuracy")
        tables.append(s)
    scores = tables[0].unionByName(tables[1])
    meta = spark.createDataFrame([("m1", "synthetic", 60), ("m2", "synthetic", 45)],
                                 "model string, model_type string, strength int")
    return rounded(scores.join(F.broadcast(meta), "model", "left").select(
        "split", "model", "accuracy", "model_type", "strength"))
