"""Registered feature-block queries (B rows) with hand-written DuckDB oracles.

Spark side: ``obs`` → feature function → id + the block's new columns.
SQL side: the same formulas written directly from their definitions.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from prismtab.functions import cleaning, features as FT
from prismtab.plans.catalog import register, rounded
from prismtab.plans.common import with_views
from prismtab.sources.fixtures import load_obs, read_table

# ------------------------------------------------------------- SQL helpers


def _r(name: str, expr: str) -> str:
    return f"round({expr}, 6) + 0e0 AS {name}"


def _f(name: str, cond: str) -> str:
    return f"CAST(coalesce({cond}, false) AS TINYINT) AS {name}"


def _clip(expr: str) -> str:
    return f"(CASE WHEN ({expr}) < 0 THEN 0e0 ELSE ({expr}) END)"


FB_SQL = """fb0 AS (
  SELECT *, u-g AS u_minus_g, g-r AS g_minus_r, r-i AS r_minus_i, i-z AS i_minus_z,
    u-r AS u_minus_r, g-i AS g_minus_i, r-z AS r_minus_z, u-z AS u_minus_z,
    (u+g+r+i+z)/5 AS mag_mean, least(u,g,r,i,z) AS mag_min, greatest(u,g,r,i,z) AS mag_max,
    abs(redshift) AS za
  FROM obs
), fb AS (
  SELECT *, sqrt(((u-mag_mean)*(u-mag_mean) + (g-mag_mean)*(g-mag_mean) + (r-mag_mean)*(r-mag_mean)
      + (i-mag_mean)*(i-mag_mean) + (z-mag_mean)*(z-mag_mean))/4) AS mag_std,
    mag_max - mag_min AS mag_range,
    (u_minus_g + g_minus_r + r_minus_i + i_minus_z)/4 AS cmean,
    sqrt((u_minus_g*u_minus_g + g_minus_r*g_minus_r + r_minus_i*r_minus_i + i_minus_z*i_minus_z)/4) AS crms
  FROM fb0
)"""


def _select(cols: list[str]) -> str:
    return "SELECT id,\n  " + ",\n  ".join(cols) + "\nFROM fb"


def _new_columns(spark, sf_dir, fn, prefix_fn=None):
    obs = load_obs(spark, sf_dir)
    base = prefix_fn(obs) if prefix_fn else obs
    out = fn(base)
    new = [c for c in out.columns if c not in base.columns]
    return rounded(out.select("id", *new))


# ------------------------------------------------------------- B-01..B-04
MAGS = ["u", "g", "r", "i", "z"]
PAIRS = [("u", "g"), ("g", "r"), ("r", "i"), ("i", "z"), ("u", "r"), ("g", "i"), ("r", "z"), ("u", "z")]
B01_COLS = (
    [_r(f"{a}_minus_{b}", f"{a}_minus_{b}") for a, b in PAIRS]
    + [_r(n, n) for n in ("mag_mean", "mag_std", "mag_min", "mag_max", "mag_range")]
    + [_r(f"{m}_redshift_ratio", f"{m} / (za + 1e-3)") for m in MAGS]
    + [
        _r("redshift_x_mag_mean", "redshift * mag_mean"),
        _r("alpha_sin", "sin(radians(alpha))"),
        _r("alpha_cos", "cos(radians(alpha))"),
        _r("delta_sin", "sin(radians(delta))"),
        _r("delta_cos", "cos(radians(delta))"),
    ]
)


@register("b01_b04_astronomy_features", with_views(FB_SQL) + _select(B01_COLS))
def q_astronomy(spark, sf_dir):
    return _new_columns(spark, sf_dir, FT.astronomy_features)


# ------------------------------------------------------------- B-05..B-10
_CPERP = "(r_minus_i - g_minus_r/4e0 - 0.18e0)"
_CPAR = "(0.7e0*g_minus_r + 1.2e0*(r_minus_i - 0.18e0))"
_LOG = {m: f"log10({w})" for m, w in [("u", "3543e0"), ("g", "4770e0"), ("r", "6231e0"), ("i", "7625e0"), ("z", "9134e0")]}


def _slope(a, b):
    return f"(({a} - {b}) / ({_LOG[a]} - {_LOG[b]}))"


B05_COLS = [
    _r("sdss_lrg_c_perp", _CPERP),
    _r("sdss_lrg_c_parallel", _CPAR),
    _r("sdss_lrg_cut1_cperp_margin", f"0.2e0 - abs({_CPERP})"),
    _r("sdss_lrg_cut2_cperp_margin", f"{_CPERP} - (0.45e0 - g_minus_r/6e0)"),
    _r("sdss_lrg_cut2_gr_margin", "g_minus_r - (1.3e0 + 0.25e0*r_minus_i)"),
    _r("sdss_quasar_ugri_radius", "sqrt(u_minus_g*u_minus_g + g_minus_r*g_minus_r + r_minus_i*r_minus_i)"),
    _r("sdss_quasar_griz_radius", "sqrt(g_minus_r*g_minus_r + r_minus_i*r_minus_i + i_minus_z*i_minus_z)"),
    _r("sdss_quasar_blue_margin", "0.8e0 - u_minus_g"),
    _r("sdss_red_dwarf_ri_over_1", _clip("r_minus_i - 1e0")),
    _r("sdss_red_dwarf_ri_over_1_8", _clip("r_minus_i - 1.8e0")),
    _r("sdss_carbon_star_gr_over_085", _clip("g_minus_r - 0.85e0")),
    _r("sdss_carbon_star_ri_line_margin", "(-0.4e0 + 0.65e0*g_minus_r) - r_minus_i"),
    _r("sdss_subdwarf_gr_over_16", _clip("g_minus_r - 1.6e0")),
    _r("sdss_white_dwarf_blue_score", _clip("-0.15e0 - g_minus_r") + " + " + _clip("-(u_minus_g + 2e0*g_minus_r)")),
    _r("sdss_mag_slope_ug", _slope("u", "g")),
    _r("sdss_mag_slope_gr", _slope("g", "r")),
    _r("sdss_mag_slope_ri", _slope("r", "i")),
    _r("sdss_mag_slope_iz", _slope("i", "z")),
    _r("sdss_mag_slope_uz", _slope("u", "z")),
    _r("sdss_sed_curvature_ugr", f"{_slope('u', 'g')} - {_slope('g', 'r')}"),
    _r("sdss_sed_curvature_gri", f"{_slope('g', 'r')} - {_slope('r', 'i')}"),
    _r("sdss_sed_curvature_riz", f"{_slope('r', 'i')} - {_slope('i', 'z')}"),
    _r("sdss_flux_ratio_u_z", "pow(10e0, -0.4e0*(u - z))"),
    _r("sdss_flux_ratio_g_r", "pow(10e0, -0.4e0*(g - r))"),
    _r("sdss_flux_ratio_r_i", "pow(10e0, -0.4e0*(r - i))"),
    _r("sdss_cparallel_x_redshift", f"{_CPAR} * redshift"),
    _r("sdss_cperp_over_redshift_abs", f"{_CPERP} / (za + 1e-3)"),
]


@register("b05_b10_sdss_external_features", with_views(FB_SQL) + _select(B05_COLS))
def q_sdss(spark, sf_dir):
    return _new_columns(spark, sf_dir, FT.sdss_external_features, FT.astronomy_features)


# ------------------------------------------------------------- B-11..B-14
_GRH = _clip("g_minus_r - 1.037e0")
_UZH = _clip("u_minus_z - 3.834e0")
_RGH = _clip("mag_range - 3.949e0")
_STH = _clip("mag_std - 1.624e0")
_SCORE = f"({_GRH} + {_UZH} + {_RGH} + {_STH})"
_ISM = "(CASE WHEN spectral_type = 'M' THEN 1e0 ELSE 0e0 END)"
_ISRED = "(CASE WHEN galaxy_population = 'Red_Sequence' THEN 1e0 ELSE 0e0 END)"
_LOWMID = "(CASE WHEN redshift > 0.0497 AND redshift <= 0.127 THEN 1e0 ELSE 0e0 END)"
_LOW144 = "(CASE WHEN redshift <= 0.144 THEN 1e0 ELSE 0e0 END)"
B11_COLS = [
    _f("redshift_low_00497_0127", "redshift > 0.0497 AND redshift <= 0.127"),
    _f("redshift_very_low_le_00497", "redshift <= 0.0497"),
    _f("redshift_low_le_0144", "redshift <= 0.144"),
    _f("redshift_abs_low_00497_0127", "za > 0.0497 AND za <= 0.127"),
    _f("redshift_abs_very_low_le_00497", "za <= 0.0497"),
    _r("redshift_low_mid_distance", _clip("redshift - 0.0497e0") + " * (CASE WHEN redshift <= 0.127 THEN 1 ELSE 0 END)"),
    _r("redshift_low_mid_inverse", "1e0 / (za + 1e-3)"),
    _f("is_spectral_type_m", "spectral_type = 'M'"),
    _f("is_spectral_type_af", "spectral_type = 'A/F'"),
    _f("is_red_sequence", "galaxy_population = 'Red_Sequence'"),
    _f("is_blue_cloud", "galaxy_population = 'Blue_Cloud'"),
    _f("is_m_red_sequence", "spectral_type = 'M' AND galaxy_population = 'Red_Sequence'"),
    _r("hard_star_gr_high", _GRH),
    _r("hard_star_uz_high", _UZH),
    _r("hard_star_mag_range_high", _RGH),
    _r("hard_star_mag_std_high", _STH),
    _r("hard_star_mag_std_mid_high", _clip("mag_std - 1.118e0")),
    _f("hard_star_color_spread_flag",
       "g_minus_r > 1.037 AND u_minus_z > 3.834 AND (mag_range > 3.949 OR mag_std > 1.624)"),
    _r("u_z_over_mag_range", "u_minus_z / (abs(mag_range) + 1e-3)"),
    _r("mag_std_over_mag_range", "mag_std / (abs(mag_range) + 1e-3)"),
    _r("hard_star_color_spread_score", _SCORE),
    _r("m_x_hard_star_gr_high", f"{_ISM} * {_GRH}"),
    _r("m_x_hard_star_uz_high", f"{_ISM} * {_UZH}"),
    _r("m_x_hard_star_mag_range_high", f"{_ISM} * {_RGH}"),
    _r("m_x_hard_star_mag_std_high", f"{_ISM} * {_STH}"),
    _r("m_x_hard_star_color_spread_score", f"{_ISM} * {_SCORE}"),
    _r("redseq_x_hard_star_color_spread_score", f"{_ISRED} * {_SCORE}"),
    _r("lowz_mid_x_g_minus_r", f"{_LOWMID} * g_minus_r"),
    _r("lowz_mid_x_u_minus_z", f"{_LOWMID} * u_minus_z"),
    _r("lowz_mid_x_mag_range", f"{_LOWMID} * mag_range"),
    _r("lowz_mid_x_mag_std", f"{_LOWMID} * mag_std"),
    _r("lowz_mid_x_hard_star_score", f"{_LOWMID} * {_SCORE}"),
    _r("lowz_le0144_x_g_minus_r", f"{_LOW144} * g_minus_r"),
    _r("lowz_le0144_x_u_minus_z", f"{_LOW144} * u_minus_z"),
]


@register("b11_b14_error_diagnostic_features", with_views(FB_SQL) + _select(B11_COLS))
def q_error_diag(spark, sf_dir):
    return _new_columns(spark, sf_dir, FT.error_diagnostic_features, FT.astronomy_features)


# ------------------------------------------------------------- B-15
_CSTD = ("sqrt(((u_minus_g-cmean)*(u_minus_g-cmean) + (g_minus_r-cmean)*(g_minus_r-cmean)"
         " + (r_minus_i-cmean)*(r_minus_i-cmean) + (i_minus_z-cmean)*(i_minus_z-cmean))/3)")
_CSCORE = f"(1e0 / (1e0 + abs({_CSTD})))"
_LMS = "(1e0 / (1e0 + abs(mag_std)))"
_ISBLUE = "(CASE WHEN galaxy_population = 'Blue_Cloud' THEN 1e0 ELSE 0e0 END)"
B15_COLS = [
    _r("compact_color_std", _CSTD),
    _r("compact_color_range", "greatest(u_minus_g, g_minus_r, r_minus_i, i_minus_z) - least(u_minus_g, g_minus_r, r_minus_i, i_minus_z)"),
    _r("compact_color_l1", "abs(u_minus_g) + abs(g_minus_r) + abs(r_minus_i) + abs(i_minus_z)"),
    _r("compact_color_score", _CSCORE),
    _r("compact_gr_ri_absdiff", "abs(g_minus_r - r_minus_i)"),
    _r("blue_cloud_color_margin", f"{_clip('0.95e0 - u_minus_g')} + {_clip('0.55e0 - g_minus_r')} + {_clip('0.35e0 - r_minus_i')}"),
    _r("blue_compact_score", f"{_CSCORE} * {_clip('0.9e0 - u_minus_g')}"),
    _r("local_redshift_abs", "za"),
    _f("local_lowz_le_008", "za <= 0.08"),
    _f("local_lowz_le_012", "za <= 0.12"),
    _f("local_lowz_le_016", "za <= 0.16"),
    _f("local_lowz_window_004_016", "za >= 0.04 AND za <= 0.16"),
    _r("low_mag_std_score", _LMS),
    _f("low_mag_std_le_060", "mag_std <= 0.60"),
    _f("low_mag_std_le_080", "mag_std <= 0.80"),
    _f("low_mag_std_le_100", "mag_std <= 1.00"),
    _r("lowz_x_compact_color", f"(1e0 / (za + 1e-3)) * {_CSCORE}"),
    _r("blue_cloud_x_compact_color", f"{_ISBLUE} * {_CSCORE}"),
    _r("blue_cloud_x_low_mag_std", f"{_ISBLUE} * {_LMS}"),
]


@register("b15_local_guard_features", with_views(FB_SQL) + _select(B15_COLS))
def q_local_guard(spark, sf_dir):
    return _new_columns(spark, sf_dir, FT.local_guard_features,
                        lambda d: FT.targeted_features(FT.astronomy_features(d)))


# ------------------------------------------------------------- B-16
_RMS_NON_U = "sqrt((g_minus_r*g_minus_r + r_minus_i*r_minus_i + i_minus_z*i_minus_z)/3)"
_BLUE2 = f"({_clip('0.8e0 - u_minus_g')} + {_clip('0.45e0 - g_minus_r')} + {_clip('0.25e0 - r_minus_i')})"
_CLZ = f"({_clip('0.144e0 - za')} * {_clip('1.3e0 - crms')} * {_clip('0.75e0 - mag_std')})"
B16_COLS = [
    _r("redshift_abs", "za"),
    _f("lowz_abs_le_00497", "za <= 0.0497"),
    _f("lowz_abs_le_008", "za <= 0.08"),
    _f("lowz_abs_le_0127", "za <= 0.127"),
    _f("lowz_abs_le_0144", "za <= 0.144"),
    _f("lowz_abs_le_020", "za <= 0.20"),
    _r("redshift_abs_inverse", "1e0 / (za + 1e-3)"),
    _r("compact_color_rms", "crms"),
    _r("compact_color_rms_non_u", _RMS_NON_U),
    _r("blue_color_score", _BLUE2),
    _f("is_compact_color_090", "crms <= 0.90"),
    _f("is_compact_color_130", "crms <= 1.30"),
    _f("is_blue_color", f"{_BLUE2} > 0"),
    _f("low_mag_std_025", "mag_std <= 0.25"),
    _f("low_mag_std_035", "mag_std <= 0.35"),
    _f("low_mag_std_050", "mag_std <= 0.50"),
    _f("low_mag_std_075", "mag_std <= 0.75"),
    _r("low_mag_std_margin", _clip("0.75e0 - mag_std")),
    _f("is_blue_cloud", "galaxy_population = 'Blue_Cloud'"),
    _f("is_red_sequence", "galaxy_population = 'Red_Sequence'"),
    _r("compact_lowz_score", _CLZ),
    _r("blue_cloud_compact_lowz_score", f"{_CLZ} * {_ISBLUE}"),
    _f("lowz_blue_cloud_compact_low_mag_std",
       "za <= 0.144 AND crms <= 1.30 AND mag_std <= 0.75 AND galaxy_population = 'Blue_Cloud'"),
]


@register("b16_guard_features_v2", with_views(FB_SQL) + _select(B16_COLS))
def q_guard_v2(spark, sf_dir):
    return _new_columns(spark, sf_dir, FT.guard_features_v2, FT.astronomy_features)


# ------------------------------------------------------------- B-17
_EXTRA_PAIRS = [("u_minus_g", "g_minus_r"), ("g_minus_r", "r_minus_i"), ("r_minus_i", "i_minus_z"),
                ("u_minus_r", "r_minus_z"), ("g_minus_i", "i_minus_z")]
B17_COLS = (
    [c for m in MAGS for c in (_r(f"{m}_minus_mag_mean", f"{m} - mag_mean"),
                               _r(f"{m}_over_mag_mean", f"{m} / (abs(mag_mean) + 1e-3)"))]
    + [c for a, b in _EXTRA_PAIRS for c in (_r(f"{a}_over_{b}", f"{a} / (abs({b}) + 1e-3)"),
                                            _r(f"{a}_x_{b}", f"{a} * {b}"))]
    + [
        _r("redshift_log1p_abs", "ln(1e0 + za)"),
        _r("redshift_sq", "redshift * redshift"),
        _r("redshift_sin", "sin(redshift)"),
        _r("redshift_cos", "cos(redshift)"),
        _r("g_minus_r_sin", "sin(g_minus_r)"),
        _r("g_minus_r_cos", "cos(g_minus_r)"),
        _r("mag_range_x_redshift", "mag_range * redshift"),
        _r("mag_range_over_redshift", "mag_range / (za + 1e-3)"),
    ]
)


@register("b17_extra_features", with_views(FB_SQL) + _select(B17_COLS))
def q_extra(spark, sf_dir):
    return _new_columns(spark, sf_dir, FT.extra_features, FT.astronomy_features)


# ------------------------------------------------------------- B-18
_WIDE = "(g_minus_r > 1.037 AND u_minus_z > 3.834 AND (mag_range > 3.949 OR mag_std > 1.624))"
B18_COLS = [
    _r("hard_redshift_abs", "za"),
    _f("hard_lowz", "za <= 0.144"),
    _f("hard_low_mag_std", "mag_std <= 0.75"),
    _r("hard_compact_color_score", "crms"),
    _f("hard_compact_color", "crms <= 1.30"),
    _f("hard_wide_color_false", f"NOT coalesce({_WIDE}, false)"),
    _f("hard_blue_cloud", "galaxy_population = 'Blue_Cloud'"),
    _f("hard_slice_main",
       f"za <= 0.144 AND galaxy_population = 'Blue_Cloud' AND crms <= 1.30 AND mag_std <= 0.75 AND NOT {_WIDE}"),
]


@register("b18_hard_slice_features", with_views(FB_SQL) + _select(B18_COLS))
def q_hard_slice(spark, sf_dir):
    return _new_columns(spark, sf_dir, FT.hard_slice_features, FT.astronomy_features)


# ------------------------------------------------------------- B-19
B19_COLS = [
    _r("u_minus_g", "u_minus_g"), _r("g_minus_r", "g_minus_r"), _r("r_minus_i", "r_minus_i"),
    _r("i_minus_z", "i_minus_z"), _r("u_minus_z", "u_minus_z"), _r("mag_std", "mag_std"),
    _r("mag_range", "mag_range"), _r("compact_color_rms", "crms"),
    f"coalesce({_WIDE}, false) AS wide_color_flag",
]


@register("b19_evaluation_features", with_views(FB_SQL) + _select(B19_COLS))
def q_eval_features(spark, sf_dir):
    return _new_columns(spark, sf_dir, FT.evaluation_features)


# ------------------------------------------------------------- B-20
B20_SQL = """SELECT event_id AS id,
  CASE WHEN isnan(value) OR isinf(value) THEN NULL ELSE round(value, 6) + 0e0 END AS value,
  CASE WHEN isnan(value / (value - value + 1e0)) THEN NULL ELSE round(value / (value - value + 1e0), 6) + 0e0 END AS ratio
FROM events"""


@register("b20_clean_numeric", B20_SQL)
def q_clean_numeric(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    df = ev.select(F.col("event_id").alias("id"), "value",
                   (F.col("value") / (F.col("value") - F.col("value") + F.lit(1.0))).alias("ratio"))
    return rounded(cleaning.clean_numeric(df))

