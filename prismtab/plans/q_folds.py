"""Registered fold, sampling and sample-weight queries (F-02, L-01..L-03,
J-05..J-10, F-05, E-26) with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from prismtab.functions.features import astronomy_features, hard_slice_features
from prismtab.functions.proba import take_b_if_a_galaxy
from prismtab.operators import folds as FO
from prismtab.operators import weights as WT
from prismtab.plans.catalog import register, rounded
from prismtab.plans.common import PREDS_SQL, predictions, with_views
from prismtab.sources.fixtures import load_obs

SEED = 42
TR_SQL = "tr AS (SELECT id, class FROM obs WHERE split = 'train')"
RANK_SQL = ("rk AS (SELECT id, class, row_number() OVER (PARTITION BY class ORDER BY md5('42:' || CAST(id AS VARCHAR)), id)"
            " - 1 AS r, md5('42:' || CAST(id AS VARCHAR)) AS ok FROM tr)")


def _train(spark, sf_dir):
    return load_obs(spark, sf_dir).where(F.col("split") == "train").select("id", "class")


# ---------------------------------------------------------------- F-02
@register("f02_stratified_folds", with_views(TR_SQL, RANK_SQL) + "SELECT id, class, CAST(r % 5 AS INTEGER) AS fold FROM rk")
def q_folds(spark, sf_dir):
    return FO.stratified_folds(_train(spark, sf_dir), "class", k=5, seed=SEED)


# ---------------------------------------------------------------- L-03
@register("l03_train_valid_split", with_views(TR_SQL, RANK_SQL) + "SELECT id, (r % 5 = 0) AS is_valid FROM rk")
def q_split(spark, sf_dir):
    return FO.train_valid_split(_train(spark, sf_dir), "class", 0.2, seed=SEED).select("id", "is_valid")


# ---------------------------------------------------------------- L-01
N_SAMPLE = 1000
QUOTA_SQL = f"""cc AS (SELECT class, count(*) AS c FROM tr GROUP BY class), tot AS (SELECT sum(c) AS t FROM cc),
q0 AS (SELECT class, c, floor({N_SAMPLE} * c / t) AS base, {N_SAMPLE} * c / t - floor({N_SAMPLE} * c / t) AS fr
       FROM cc CROSS JOIN tot),
rem AS (SELECT {N_SAMPLE} - sum(base) AS rr FROM q0),
q AS (SELECT class, base + CASE WHEN row_number() OVER (ORDER BY fr DESC, class) <= (SELECT rr FROM rem)
                           THEN 1 ELSE 0 END AS quota FROM q0)"""


@register("l01_stratified_sample", with_views(TR_SQL, RANK_SQL, QUOTA_SQL)
          + "SELECT rk.id, rk.class FROM rk JOIN q USING (class) WHERE rk.r < q.quota")
def q_stratified_sample(spark, sf_dir):
    return FO.stratified_sample(_train(spark, sf_dir), "class", N_SAMPLE, seed=SEED)


# ---------------------------------------------------------------- L-02
PROP_SQL = f"""cc AS (SELECT class, count(*) AS c FROM tr GROUP BY class), tot AS (SELECT sum(c) AS t FROM cc),
q AS (SELECT class, least(greatest(1, CAST(round_even({N_SAMPLE} * c / t, 0) AS BIGINT)), c) AS quota
      FROM cc CROSS JOIN tot),
picked AS (SELECT rk.* FROM rk JOIN q USING (class) WHERE rk.r < q.quota),
g AS (SELECT id, class, row_number() OVER (ORDER BY ok, id) AS grn FROM picked)"""


@register("l02_proportional_sample", with_views(TR_SQL, RANK_SQL, PROP_SQL)
          + f"SELECT id, class FROM g WHERE grn <= {N_SAMPLE} OR (SELECT sum(quota) FROM q) <= {N_SAMPLE}")
def q_proportional_sample(spark, sf_dir):
    return FO.proportional_sample(_train(spark, sf_dir), "class", N_SAMPLE, seed=SEED)


# ---------------------------------------------------------------- J-06 / F-05
FEAT_SQL = """fe AS (
  SELECT id, class, spectral_type, redshift, g - r AS gr, u - z AS uz,
    greatest(u,g,r,i,z) - least(u,g,r,i,z) AS rng,
    sqrt(((u-mm)*(u-mm) + (g-mm)*(g-mm) + (r-mm)*(r-mm) + (i-mm)*(i-mm) + (z-mm)*(z-mm))/4) AS mstd
  FROM (SELECT *, (u+g+r+i+z)/5 AS mm FROM obs WHERE split = 'train')
)"""


def _f(cond: str, w: float) -> str:
    return f"(CASE WHEN coalesce({cond}, false) THEN {w!r}e0 ELSE 1e0 END)"


_STAR = "class = 'STAR'"
_LOWMID = "(redshift > 0.0497 AND redshift <= 0.127)"
_HARD = f"({_STAR} AND gr > 1.037 AND uz > 3.834 AND (rng > 3.949 OR mstd > 1.624))"
STAR_LOWZ_W = " * ".join([_f(_STAR, 1.15), _f(f"{_STAR} AND spectral_type = 'M'", 1.45), _f(_LOWMID, 1.20),
                          _f(f"{_STAR} AND {_LOWMID}", 1.75), _f(_HARD, 1.65)])
#: base predictions that the hard schemes look at: STAR or QSO taken for GALAXY by m1, rows that all three models get wrong
HARD_SQL = """hd AS (SELECT id, class = 'STAR' AND pred_m1 = 'GALAXY' AS hs, class = 'QSO' AND pred_m1 = 'GALAXY' AS hq,
    pred_m1 <> class AND pred_m2 <> class AND pred_m3 <> class AS aw FROM preds WHERE split = 'train')"""
STAR_LOWZ_HARD_W = " * ".join([STAR_LOWZ_W, _f("hs OR hq", 1.90), _f("aw", 2.30)])


def _schemes_sql(source: str, schemes: dict[str, str], low: float, high: float) -> str:
    """(scheme, id, sample_weight): the factors clipped, then divided by their mean within the scheme."""
    parts = [f"SELECT '{name}' AS scheme, id, least(greatest({w}, {low}e0), {high}e0) AS w FROM {source}" for name, w in schemes.items()]
    return ("SELECT scheme, id, round(w / avg(w) OVER (PARTITION BY scheme), 6) AS sample_weight FROM (" + " UNION ALL ".join(parts) + ")")


def _union(tables):
    out = None
    for name, t in tables.items():
        t = t.select(F.lit(name).alias("scheme"), "id", "sample_weight")
        out = t if out is None else out.unionByName(t)
    return rounded(out)


def _wrong_tables(spark, sf_dir):
    """Training predictions with the hard cases of m1, and the ids that the hard schemes weigh."""
    p = predictions(spark, sf_dir, "train")
    gal = F.col("pred_m1") == "GALAXY"
    p = p.withColumns({"hard_star": (F.col("class") == "STAR") & gal, "hard_qso": (F.col("class") == "QSO") & gal})
    wrong = [F.col(f"pred_m{i}") != F.col("class") for i in (1, 2, 3)]
    return p, p.where("hard_star or hard_qso").select("id"), p.where(wrong[0] & wrong[1] & wrong[2]).select("id")


@register("j06_star_lowz_weights", with_views(PREDS_SQL, FEAT_SQL, HARD_SQL, "fh AS (SELECT * FROM fe JOIN hd USING (id))")
          + _schemes_sql("fh", {"none": "1e0", "star_lowz": STAR_LOWZ_W, "star_lowz_hard": STAR_LOWZ_HARD_W}, 0.25, 8))
def q_star_lowz(spark, sf_dir):
    """All schemes, weight by weight."""
    obs = astronomy_features(load_obs(spark, sf_dir).where(F.col("split") == "train"))
    _, hard, all_wrong = _wrong_tables(spark, sf_dir)
    return _union({s: WT.star_lowz_weights(obs, scheme=s, hard_ids=hard, all_wrong_ids=all_wrong) for s in ("none", "star_lowz", "star_lowz_hard")})


@register("e26_weight_summary", with_views(PREDS_SQL, FEAT_SQL, f"w AS (SELECT id, least(greatest({STAR_LOWZ_W}, 0.25e0), 8e0) AS w FROM fe)",
                                           "wn AS (SELECT id, w / (SELECT avg(w) FROM w) AS v FROM w)", GW_SQL := """gw AS (
  SELECT p.id, p.class, p.pred_m1, p.pred_m2, p.pred_m3,
    (abs(o.redshift) <= 0.144 AND sqrt(((o.u-o.g)*(o.u-o.g) + (o.g-o.r)*(o.g-o.r) + (o.r-o.i)*(o.r-o.i)
      + (o.i-o.z)*(o.i-o.z))/4) <= 1.3 AND sqrt(((o.u-mm)*(o.u-mm) + (o.g-mm)*(o.g-mm) + (o.r-mm)*(o.r-mm)
      + (o.i-mm)*(o.i-mm) + (o.z-mm)*(o.z-mm))/4) <= 0.75 AND o.galaxy_population = 'Blue_Cloud') AS region
  FROM preds p JOIN (SELECT *, (u+g+r+i+z)/5 AS mm FROM obs) o USING (id) WHERE p.split = 'train'
)""")
          + """SELECT count(v) AS n, round(min(v), 6) AS weight_min, round(avg(v), 6) AS weight_mean,
  round(max(v), 6) AS weight_max, round(stddev_samp(v), 6) AS weight_std,
  CAST(count(*) FILTER (pred_m2 <> pred_m3) AS BIGINT) AS disagreement,
  CAST(count(*) FILTER (pred_m2 <> class AND pred_m1 <> class) AS BIGINT) AS both_wrong,
  CAST(count(*) FILTER (pred_m2 = class AND pred_m1 <> class) AS BIGINT) AS only_other_correct,
  CAST(count(*) FILTER (region) AS BIGINT) AS local_region FROM wn JOIN gw USING (id)""")
def q_weight_summary(spark, sf_dir):
    """The weights' range, and how many rows each reason for a weight holds for."""
    obs = astronomy_features(load_obs(spark, sf_dir).where(F.col("split") == "train"))
    weighted = WT.star_lowz_weights(obs).select("id", "sample_weight")
    p = predictions(spark, sf_dir, "train").join(_local_region(spark, sf_dir), "id").join(weighted, "id")
    return rounded(WT.weight_summary(p, reasons=WT.guard_reasons("class", "pred_m1", "pred_m2", "pred_m3", F.col("_region"))))


def _local_region(spark, sf_dir):
    from prismtab.functions.features import guard_features_v2

    obs = guard_features_v2(astronomy_features(load_obs(spark, sf_dir)))
    region = (F.col("redshift_abs") <= 0.144) & (F.col("compact_color_rms") <= 1.30) & (
        F.col("mag_std") <= 0.75) & (F.col("is_blue_cloud") == 1)
    return obs.select("id", region.alias("_region"))


# ---------------------------------------------------------------- J-07
_S, _Q = "class = 'STAR'", "class = 'QSO'"
EXTENSION_SQL = {
    "star": _f(_S, 1.75), "qso": _f(_Q, 1.50), "star_qso": _f(_S, 1.75) + " * " + _f(_Q, 1.50),
    "hard_sgq_to_galaxy": " * ".join([_f(_S, 1.20), _f(_Q, 1.10), _f("hs", 2.60), _f("hq", 2.20)]),
}


@register("j07_hard_sgq_weights", with_views(PREDS_SQL, HARD_SQL, "ph AS (SELECT * FROM preds JOIN hd USING (id))") + _schemes_sql("ph", EXTENSION_SQL, 0.25, 10))
def q_hard_sgq(spark, sf_dir):
    """All four schemes."""
    p, _, _ = _wrong_tables(spark, sf_dir)
    return _union({s: WT.extension_weights(p, s) for s in EXTENSION_SQL})


# ---------------------------------------------------------------- J-08
FLAGS_SQL = """fl AS (
  SELECT id, class, a, c, a <> c AS dis, (a <> class AND c <> class) AS bw,
    (class IN ('STAR', 'GALAXY') AND a IN ('STAR', 'GALAXY') AND c IN ('STAR', 'GALAXY') AND (a <> class OR c <> class)) AS sgh
  FROM (SELECT id, class, pred_m1 AS a,
          CASE WHEN pred_m1 = 'GALAXY' AND pred_m2 IN ('QSO', 'STAR') THEN pred_m2 ELSE pred_m1 END AS c
        FROM preds WHERE split = 'train')
)"""
SUPPLEMENTAL_SQL = {
    "star": _f(_S, 1.35), "star_qso": _f(_S, 1.35) + " * " + _f(_Q, 1.20), "disagreement": _f("dis", 1.70), "both_wrong": _f("bw", 2.40),
    "star_gal_hard": " * ".join([_f(_S, 1.35), _f("dis", 1.70), _f("sgh", 2.25)]),
}


@register("j08_star_gal_hard_weights", with_views(PREDS_SQL, FLAGS_SQL) + _schemes_sql("fl", SUPPLEMENTAL_SQL, 0.25, 10))
def q_star_gal_hard(spark, sf_dir):
    """All five schemes."""
    p = predictions(spark, sf_dir, "train")
    a, t = F.col("pred_m1"), F.col("class")
    c = take_b_if_a_galaxy(a, F.col("pred_m2"))
    sg = ["STAR", "GALAXY"]
    p = p.withColumn("_c", c).withColumns({
        "disagreement": a != F.col("_c"),
        "both_wrong": (a != t) & (F.col("_c") != t),
        "star_gal_hard": t.isin(*sg) & a.isin(*sg) & F.col("_c").isin(*sg) & ((a != t) | (F.col("_c") != t)),
    })
    return _union({s: WT.supplemental_weights(p, s) for s in SUPPLEMENTAL_SQL})


# ---------------------------------------------------------------- J-09
@register("j09_local_guard_weights", with_views(PREDS_SQL, GW_SQL) + "SELECT id, round(" + " * ".join([
    "CASE class WHEN 'GALAXY' THEN 1e0 WHEN 'QSO' THEN 3.2e0 WHEN 'STAR' THEN 4.6e0 END",
    _f("pred_m2 <> pred_m3", 1.25), _f("pred_m2 <> class AND pred_m1 <> class", 1.50),
    _f("pred_m2 = class AND pred_m1 <> class AND class = 'GALAXY'", 2.00), _f("region", 1.75)])
    + ", 6) AS sample_weight FROM gw")
def q_local_guard_weights(spark, sf_dir):
    p = predictions(spark, sf_dir, "train").join(_local_region(spark, sf_dir), "id")
    out = WT.local_guard_weights(p, "class", "pred_m1", "pred_m2", "pred_m3", F.col("_region"))
    return rounded(out.select("id", "sample_weight"))


# ---------------------------------------------------------------- J-10
HS_SQL = """hs AS (
  SELECT p.id, p.class, p.pred_m1, p.pred_m2,
    (abs(o.redshift) <= 0.144 AND o.galaxy_population = 'Blue_Cloud'
     AND sqrt(((o.u-o.g)*(o.u-o.g) + (o.g-o.r)*(o.g-o.r) + (o.r-o.i)*(o.r-o.i) + (o.i-o.z)*(o.i-o.z))/4) <= 1.3
     AND sd <= 0.75 AND NOT (o.g - o.r > 1.037 AND o.u - o.z > 3.834
       AND (greatest(o.u,o.g,o.r,o.i,o.z) - least(o.u,o.g,o.r,o.i,o.z) > 3.949 OR sd > 1.624))) AS hard
  FROM preds p JOIN (SELECT *, sqrt(((u-mm)*(u-mm) + (g-mm)*(g-mm) + (r-mm)*(r-mm) + (i-mm)*(i-mm) + (z-mm)*(z-mm))/4) AS sd
                     FROM (SELECT *, (u+g+r+i+z)/5 AS mm FROM obs)) o USING (id)
  WHERE p.split = 'train' AND p.class IN ('GALAXY', 'STAR')
)"""


@register("j10_pair_weights", with_views(PREDS_SQL, HS_SQL, "w AS (SELECT id, least(greatest(" + " * ".join([
    "CASE class WHEN 'GALAXY' THEN 1e0 WHEN 'QSO' THEN 3.2e0 WHEN 'STAR' THEN 4.6e0 END",
    _f("hard", 2.25), _f("pred_m1 <> class", 1.70), _f("class = 'GALAXY' AND pred_m1 IN ('STAR', 'QSO')", 2.40),
    _f("pred_m2 <> pred_m1", 1.25)]) + ", 0.25e0), 50e0) AS w FROM hs)")
    + "SELECT id, round(w / (SELECT avg(w) FROM w), 6) AS sample_weight FROM w")
def q_pair_weights(spark, sf_dir):
    obs = hard_slice_features(astronomy_features(load_obs(spark, sf_dir))).select("id", "hard_slice_main")
    p = predictions(spark, sf_dir, "train").where(F.col("class").isin("GALAXY", "STAR")).join(obs, "id")
    out = WT.pair_weights(p, "class", base_pred="pred_m1", other_pred="pred_m2")
    return rounded(out.select("id", "sample_weight"))


# ---------------------------------------------------------------- J-05
@register("j05_class_weights", with_views() + """SELECT id,
  CASE class WHEN 'GALAXY' THEN 1e0 WHEN 'QSO' THEN 3.2e0 WHEN 'STAR' THEN 4.6e0 END AS sample_weight
FROM obs WHERE split = 'train'""")
def q_class_weights(spark, sf_dir):
    return WT.class_weights(_train(spark, sf_dir), "class").select("id", "sample_weight")
