"""Sample-weight schemes (J-05..J-10, F-05, E-26).

Each scheme is a product of ``when`` factors, clipped, then divided by its
mean.  The mean is a scalar subquery (one partial aggregate, executed once),
never a global window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prismtab.constants import DEFAULT_CLASS_WEIGHTS
from prismtab.operators.metrics import weight_of


def _factor(cond: Column, w: float) -> Column:
    return F.when(F.coalesce(cond, F.lit(False)), F.lit(float(w))).otherwise(F.lit(1.0))


def _product(factors: list[Column], start: Column | None = None) -> Column:
    init = start if start is not None else F.lit(1.0)
    return reduce(lambda a, b: a * b, factors, init)


def _clip(w: Column, lo: float | None, hi: float | None) -> Column:
    if lo is not None:
        w = F.greatest(w, F.lit(float(lo)))
    if hi is not None:
        w = F.least(w, F.lit(float(hi)))
    return w


def mean_normalise(df: DataFrame, col: str = "sample_weight") -> DataFrame:
    """F-05: w / mean(w) with the mean as a scalar subquery."""
    mean = df.select(F.avg(F.col(col))).scalar()
    return df.withColumn(col, F.col(col) / mean)


def class_weights(df: DataFrame, label: str, weights=None, out: str = "sample_weight") -> DataFrame:
    """J-05: class → weight lookup (literal map)."""
    return df.withColumn(out, weight_of(F.col(label), weights or DEFAULT_CLASS_WEIGHTS))


# fixed values: default factors of the layer-1 weighting schemes
STAR_LOWZ_DEFAULTS = dict(star_weight=1.15, star_m_weight=1.45, star_hard_color_weight=1.65, lowz_weight=1.20,
                          star_lowz_weight=1.75, hard_case_weight=1.90, all_wrong_weight=2.30)


def star_lowz_weights(df: DataFrame, label: str = "class", scheme: str = "star_lowz", hard_ids: DataFrame | None = None,
                      all_wrong_ids: DataFrame | None = None, id_col: str = "id", out: str = "sample_weight",
                      **kw) -> DataFrame:
    """J-06: ``star_lowz`` / ``star_lowz_hard`` multiplicative weights, clip
    [0.25, 8], mean 1.  Needs g_minus_r, u_minus_z, mag_range, mag_std."""
    p = {**STAR_LOWZ_DEFAULTS, **kw}
    col = F.col
    if scheme == "none":
        return df.withColumn(out, F.lit(1.0))
    is_star = col(label) == "STAR"
    is_m = is_star & (col("spectral_type") == "M")
    lowz_mid = (col("redshift") > 0.0497) & (col("redshift") <= 0.127)
    hard = is_star & (col("g_minus_r") > 1.037) & (col("u_minus_z") > 3.834) & (
        (col("mag_range") > 3.949) | (col("mag_std") > 1.624))
    factors = [_factor(is_star, p["star_weight"]), _factor(is_m, p["star_m_weight"]),
               _factor(lowz_mid, p["lowz_weight"]), _factor(is_star & lowz_mid, p["star_lowz_weight"]),
               _factor(hard, p["star_hard_color_weight"])]
    d = df
    if scheme == "star_lowz_hard":
        from prismtab.operators.checks import membership_flag

        if hard_ids is not None:
            d = membership_flag(d, hard_ids.select(id_col), id_col, "_hard")
            factors.append(_factor(col("_hard"), p["hard_case_weight"]))
        if all_wrong_ids is not None:
            d = membership_flag(d, all_wrong_ids.select(id_col), id_col, "_allwrong")
            factors.append(_factor(col("_allwrong"), p["all_wrong_weight"]))
    d = d.withColumn(out, _clip(_product(factors), 0.25, 8.0))
    d = d.drop(*[c for c in ("_hard", "_allwrong") if c in d.columns])
    return mean_normalise(d, out)


# fixed values: default factors of the extension schemes
EXTENSION_DEFAULTS = dict(star_weight=1.75, qso_weight=1.50, hard_star_weight=2.60, hard_qso_weight=2.20,
                          non_hard_weight=1.0)


def extension_weights(df: DataFrame, scheme: str, label: str = "class", hard_star: str = "hard_star",
                      hard_qso: str = "hard_qso", out: str = "sample_weight", **kw) -> DataFrame:
    """J-07: ``star | qso | star_qso | hard_sgq_to_galaxy`` weights, clip
    [0.25, 10], mean 1.  ``hard_*`` are boolean membership columns (C-05)."""
    p = {**EXTENSION_DEFAULTS, **kw}
    col = F.col
    lab = col(label)
    f = [F.lit(float(p["non_hard_weight"]))]
    if scheme in ("star", "star_qso"):
        f.append(_factor(lab == "STAR", p["star_weight"]))
    if scheme in ("qso", "star_qso"):
        f.append(_factor(lab == "QSO", p["qso_weight"]))
    if scheme == "hard_sgq_to_galaxy":
        f += [_factor(lab == "STAR", 1.20), _factor(lab == "QSO", 1.10),
              _factor(col(hard_star), p["hard_star_weight"]), _factor(col(hard_qso), p["hard_qso_weight"])]
    return mean_normalise(df.withColumn(out, _clip(_product(f), 0.25, 10.0)), out)


# fixed values: default factors of the supplemental schemes
SUPPLEMENTAL_DEFAULTS = dict(star_weight=1.35, qso_weight=1.20, disagreement_weight=1.70, both_wrong_weight=2.40,
                             star_gal_hard_weight=2.25)


def supplemental_weights(df: DataFrame, scheme: str, label: str = "class", disagreement: str = "disagreement",
                         both_wrong: str = "both_wrong", star_gal_hard: str = "star_gal_hard",
                         out: str = "sample_weight", **kw) -> DataFrame:
    """J-08: ``star | star_qso | disagreement | both_wrong | star_gal_hard``
    weights over the C-07 diagnostic flags, clip [0.25, 10], mean 1."""
    p = {**SUPPLEMENTAL_DEFAULTS, **kw}
    col = F.col
    lab = col(label)
    f = []
    if scheme in ("star", "star_qso", "star_gal_hard"):
        f.append(_factor(lab == "STAR", p["star_weight"]))
    if scheme == "star_qso":
        f.append(_factor(lab == "QSO", p["qso_weight"]))
    if scheme in ("disagreement", "star_gal_hard"):
        f.append(_factor(col(disagreement), p["disagreement_weight"]))
    if scheme == "both_wrong":
        f.append(_factor(col(both_wrong), p["both_wrong_weight"]))
    if scheme == "star_gal_hard":
        f.append(_factor(col(star_gal_hard), p["star_gal_hard_weight"]))
    return mean_normalise(df.withColumn(out, _clip(_product(f), 0.25, 10.0)), out)


# fixed values: default factors of the local guard weights
GUARD_WEIGHT_DEFAULTS = dict(disagreement_weight=1.25, both_wrong_weight=1.50, only_other_correct_weight=2.00,
                             local_region_weight=1.75)


def local_guard_weights(df: DataFrame, label: str, base_pred: str, pred_a: str, pred_b: str, region: Column,
                        weights=None, out: str = "sample_weight", **kw) -> DataFrame:
    """J-09: class weight x disagreement(a,b) x both-wrong(a, base) x
    only-a-correct-on-GALAXY x local region; no clipping, no normalising."""
    p = {**GUARD_WEIGHT_DEFAULTS, **kw}
    t = F.col(label)
    why = guard_reasons(label, base_pred, pred_a, pred_b, region)
    f = [_factor(why["disagreement"], p["disagreement_weight"]),
         _factor(why["both_wrong"], p["both_wrong_weight"]),
         _factor(why["only_other_correct"] & (t == "GALAXY"), p["only_other_correct_weight"]),
         _factor(why["local_region"], p["local_region_weight"])]
    return df.withColumn(out, _product(f, weight_of(t, weights or DEFAULT_CLASS_WEIGHTS)))


def guard_reasons(label: str, base_pred: str, pred_a: str, pred_b: str, region: Column) -> dict[str, Column]:
    """What the guard weights look at, by name; E-26 counts the same."""
    t, a, base = F.col(label), F.col(pred_a), F.col(base_pred)
    return {"disagreement": a != F.col(pred_b), "both_wrong": (a != t) & (base != t), "only_other_correct": (a == t) & (base != t), "local_region": region}


# fixed values: default factors of the pairwise weights
PAIR_WEIGHT_DEFAULTS = dict(hard_slice_weight=2.25, base_error_weight=1.70, galaxy_injury_weight=2.40,
                            disagreement_weight=1.25)


def pair_weights(df: DataFrame, label: str, base_pred: str | None = "base_pred", other_pred: str | None = None,
                 hard: str = "hard_slice_main", weights=None, out: str = "sample_weight", **kw) -> DataFrame:
    """J-10: class weight x hard slice x base error x galaxy injury x
    disagreement, clip [0.25, 50], mean 1 over the rows of ``df`` (the pair)."""
    p = {**PAIR_WEIGHT_DEFAULTS, **kw}
    col = F.col
    t = col(label)
    f = []
    if hard in df.columns:
        f.append(_factor(col(hard) == 1, p["hard_slice_weight"]))
    if base_pred and base_pred in df.columns:
        b = col(base_pred)
        f.append(_factor(b != t, p["base_error_weight"]))
        f.append(_factor((t == "GALAXY") & b.isin("STAR", "QSO"), p["galaxy_injury_weight"]))
        if other_pred and other_pred in df.columns:
            f.append(_factor(col(other_pred) != b, p["disagreement_weight"]))
    w = _clip(_product(f, weight_of(t, weights or DEFAULT_CLASS_WEIGHTS)), 0.25, 50.0)
    return mean_normalise(df.withColumn(out, w), out)


def weight_summary(df: DataFrame, col: str = "sample_weight", by=(), reasons: dict[str, Column] | None = None) -> DataFrame:
    """E-26: min / mean / max / std (sample) of the weights, and for each of ``reasons`` the rows it is true for; one aggregate."""
    c = F.col(col)
    counts = [F.sum(F.when(r, 1).otherwise(0)).cast("bigint").alias(n) for n, r in (reasons or {}).items()]
    return df.groupBy(*by).agg(F.count(c).alias("n"), F.min(c).alias("weight_min"), F.avg(c).alias("weight_mean"),
                               F.max(c).alias("weight_max"), F.stddev_samp(c).alias("weight_std"), *counts)
