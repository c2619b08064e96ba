"""Domain feature blocks (pure column expressions, one projection per block).

Every block is conditional on the presence of its input columns, so a block
applied to a frame that lacks them is a no-op.  NULL plays the role of NaN:
run :func:`prismtab.functions.cleaning.clean_numeric` at ingestion so that
NaN/inf never reach these expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prismtab.constants import (
    FEATURE_EPS,
    FILTER_WAVELENGTHS,
    HARD_STAR_GR,
    HARD_STAR_RANGE,
    HARD_STAR_STD,
    HARD_STAR_STD_MID,
    HARD_STAR_UZ,
    MAG_COLS,
)
from prismtab.functions.rowstats import (
    clip_lower,
    flag,
    row_abs_sum,
    row_max,
    row_mean,
    row_min,
    row_rms,
    row_std,
)

col = F.col
EPS = FEATURE_EPS
COLOR_COLS = ["u_minus_g", "g_minus_r", "r_minus_i", "i_minus_z"]
ADJACENT_PAIRS = [("u", "g"), ("g", "r"), ("r", "i"), ("i", "z")]
WIDER_PAIRS = [("u", "r"), ("g", "i"), ("r", "z"), ("u", "z")]


def has(df: DataFrame, *names: str) -> bool:
    cols = set(df.columns)
    return all(n in cols for n in names)


def _lit(x: float) -> Column:
    return F.lit(float(x))


# ---------------------------------------------------------------- B-01..B-04
def astronomy_features(df: DataFrame) -> DataFrame:
    """Colour differences, magnitude row stats, redshift ratios, angle cycles."""
    if has(df, *MAG_COLS):
        exprs = {f"{a}_minus_{b}": col(a) - col(b) for a, b in ADJACENT_PAIRS + WIDER_PAIRS}
        exprs.update({"mag_mean": row_mean(MAG_COLS), "mag_min": row_min(MAG_COLS), "mag_max": row_max(MAG_COLS)})
        df = df.withColumns(exprs).withColumns(
            {"mag_std": row_std(MAG_COLS, mean=col("mag_mean")), "mag_range": col("mag_max") - col("mag_min")}
        )
        if has(df, "redshift"):
            den = F.abs(col("redshift")) + _lit(EPS)
            exprs = {f"{m}_redshift_ratio": col(m) / den for m in MAG_COLS}
            exprs["redshift_x_mag_mean"] = col("redshift") * col("mag_mean")
            df = df.withColumns(exprs)
    exprs = {}
    for name in ("alpha", "delta"):
        if has(df, name):
            rad = F.radians(col(name))
            exprs[f"{name}_sin"] = F.sin(rad)
            exprs[f"{name}_cos"] = F.cos(rad)
    return df.withColumns(exprs) if exprs else df


# ---------------------------------------------------------------- B-05..B-10
def sdss_external_features(df: DataFrame) -> DataFrame:
    """Target-selection colour cuts, filter slopes, flux ratios."""
    if has(df, *COLOR_COLS):
        gr, ri, iz, ug = col("g_minus_r"), col("r_minus_i"), col("i_minus_z"), col("u_minus_g")
        c_perp = ri - gr / 4.0 - 0.18
        c_par = gr * 0.7 + (ri - 0.18) * 1.2
        df = df.withColumns(
            {
                "sdss_lrg_c_perp": c_perp,
                "sdss_lrg_c_parallel": c_par,
                "sdss_lrg_cut1_cperp_margin": _lit(0.2) - F.abs(c_perp),
                "sdss_lrg_cut2_cperp_margin": c_perp - (_lit(0.45) - gr / 6.0),
                "sdss_lrg_cut2_gr_margin": gr - (_lit(1.30) + ri * 0.25),
                "sdss_quasar_ugri_radius": F.sqrt(ug * ug + gr * gr + ri * ri),
                "sdss_quasar_griz_radius": F.sqrt(gr * gr + ri * ri + iz * iz),
                "sdss_quasar_blue_margin": _lit(0.8) - ug,
                "sdss_red_dwarf_ri_over_1": clip_lower(ri - 1.0),
                "sdss_red_dwarf_ri_over_1_8": clip_lower(ri - 1.8),
                "sdss_carbon_star_gr_over_085": clip_lower(gr - 0.85),
                "sdss_carbon_star_ri_line_margin": (_lit(-0.4) + gr * 0.65) - ri,
                "sdss_subdwarf_gr_over_16": clip_lower(gr - 1.6),
                "sdss_white_dwarf_blue_score": clip_lower(_lit(-0.15) - gr) + clip_lower(-(ug + gr * 2.0)),
            }
        )
    if has(df, *MAG_COLS):
        log_lam = {m: math.log10(w) for m, w in FILTER_WAVELENGTHS.items()}
        slopes = {
            f"sdss_mag_slope_{a}{b}": (col(a) - col(b)) / _lit(log_lam[a] - log_lam[b]) for a, b in ADJACENT_PAIRS
        }
        slopes["sdss_mag_slope_uz"] = (col("u") - col("z")) / _lit(log_lam["u"] - log_lam["z"])
        df = df.withColumns(slopes).withColumns(
            {
                "sdss_sed_curvature_ugr": col("sdss_mag_slope_ug") - col("sdss_mag_slope_gr"),
                "sdss_sed_curvature_gri": col("sdss_mag_slope_gr") - col("sdss_mag_slope_ri"),
                "sdss_sed_curvature_riz": col("sdss_mag_slope_ri") - col("sdss_mag_slope_iz"),
                "sdss_flux_ratio_u_z": F.pow(_lit(10.0), (col("u") - col("z")) * -0.4),
                "sdss_flux_ratio_g_r": F.pow(_lit(10.0), (col("g") - col("r")) * -0.4),
                "sdss_flux_ratio_r_i": F.pow(_lit(10.0), (col("r") - col("i")) * -0.4),
            }
        )
    if has(df, "redshift", "sdss_lrg_c_parallel"):
        df = df.withColumns(
            {
                "sdss_cparallel_x_redshift": col("sdss_lrg_c_parallel") * col("redshift"),
                "sdss_cperp_over_redshift_abs": col("sdss_lrg_c_perp") / (F.abs(col("redshift")) + _lit(EPS)),
            }
        )
    return df


# ---------------------------------------------------------------- B-11..B-14
def wide_color_condition(gr: Column, uz: Column, rng: Column, std: Column) -> Column:
    """C-02: the hard-star / wide-colour predicate (NULL when undecidable)."""
    return (gr > HARD_STAR_GR) & (uz > HARD_STAR_UZ) & ((rng > HARD_STAR_RANGE) | (std > HARD_STAR_STD))


def error_diagnostic_features(df: DataFrame) -> DataFrame:
    """Redshift bands, category indicators, hard-star excesses, gated interactions."""
    if has(df, "redshift"):
        z = col("redshift")
        za = F.abs(z)
        df = df.withColumns(
            {
                "redshift_low_00497_0127": flag((z > 0.0497) & (z <= 0.127)),
                "redshift_very_low_le_00497": flag(z <= 0.0497),
                "redshift_low_le_0144": flag(z <= 0.144),
                "redshift_abs_low_00497_0127": flag((za > 0.0497) & (za <= 0.127)),
                "redshift_abs_very_low_le_00497": flag(za <= 0.0497),
                "redshift_low_mid_distance": clip_lower(z - 0.0497) * flag(z <= 0.127),
                "redshift_low_mid_inverse": _lit(1.0) / (za + _lit(EPS)),
            }
        )
    if has(df, "spectral_type", "galaxy_population"):
        sp, pop = col("spectral_type"), col("galaxy_population")
        df = df.withColumns(
            {
                "is_spectral_type_m": flag(sp == "M"),
                "is_spectral_type_af": flag(sp == "A/F"),
                "is_red_sequence": flag(pop == "Red_Sequence"),
                "is_blue_cloud": flag(pop == "Blue_Cloud"),
                "is_m_red_sequence": flag((sp == "M") & (pop == "Red_Sequence")),
            }
        )
    if has(df, "g_minus_r", "u_minus_z", "mag_range", "mag_std"):
        gr, uz, rng, std = col("g_minus_r"), col("u_minus_z"), col("mag_range"), col("mag_std")
        df = df.withColumns(
            {
                "hard_star_gr_high": clip_lower(gr - HARD_STAR_GR),
                "hard_star_uz_high": clip_lower(uz - HARD_STAR_UZ),
                "hard_star_mag_range_high": clip_lower(rng - HARD_STAR_RANGE),
                "hard_star_mag_std_high": clip_lower(std - HARD_STAR_STD),
                "hard_star_mag_std_mid_high": clip_lower(std - HARD_STAR_STD_MID),
                "hard_star_color_spread_flag": flag(wide_color_condition(gr, uz, rng, std)),
                "u_z_over_mag_range": uz / (F.abs(rng) + _lit(EPS)),
                "mag_std_over_mag_range": std / (F.abs(rng) + _lit(EPS)),
            }
        )
        df = df.withColumn(
            "hard_star_color_spread_score",
            col("hard_star_gr_high")
            + col("hard_star_uz_high")
            + col("hard_star_mag_range_high")
            + col("hard_star_mag_std_high"),
        )
        exprs = {}
        if has(df, "is_spectral_type_m"):
            m = col("is_spectral_type_m").cast("double")
            for src, dst in [
                ("hard_star_gr_high", "m_x_hard_star_gr_high"),
                ("hard_star_uz_high", "m_x_hard_star_uz_high"),
                ("hard_star_mag_range_high", "m_x_hard_star_mag_range_high"),
                ("hard_star_mag_std_high", "m_x_hard_star_mag_std_high"),
                ("hard_star_color_spread_score", "m_x_hard_star_color_spread_score"),
            ]:
                exprs[dst] = m * col(src)
        if has(df, "is_red_sequence"):
            exprs["redseq_x_hard_star_color_spread_score"] = col("is_red_sequence").cast("double") * col(
                "hard_star_color_spread_score"
            )
        if has(df, "redshift_low_00497_0127"):
            lm = col("redshift_low_00497_0127").cast("double")
            exprs["lowz_mid_x_g_minus_r"] = lm * gr
            exprs["lowz_mid_x_u_minus_z"] = lm * uz
            exprs["lowz_mid_x_mag_range"] = lm * rng
            exprs["lowz_mid_x_mag_std"] = lm * std
            exprs["lowz_mid_x_hard_star_score"] = lm * col("hard_star_color_spread_score")
        if has(df, "redshift_low_le_0144"):
            lo = col("redshift_low_le_0144").cast("double")
            exprs["lowz_le0144_x_g_minus_r"] = lo * gr
            exprs["lowz_le0144_x_u_minus_z"] = lo * uz
        if exprs:
            df = df.withColumns(exprs)
    return df


def targeted_features(df: DataFrame) -> DataFrame:
    return error_diagnostic_features(sdss_external_features(df))


# ---------------------------------------------------------------- B-15
def local_guard_features(df: DataFrame) -> DataFrame:
    """Compact low-redshift features (variant 1: score = 1/(1+|colour std|))."""
    if has(df, *COLOR_COLS):
        ug, gr, ri = col("u_minus_g"), col("g_minus_r"), col("r_minus_i")
        cstd = row_std(COLOR_COLS)
        df = df.withColumns(
            {
                "compact_color_std": cstd,
                "compact_color_range": row_max(COLOR_COLS) - row_min(COLOR_COLS),
                "compact_color_l1": row_abs_sum(COLOR_COLS),
                "compact_color_score": _lit(1.0) / (_lit(1.0) + F.abs(cstd)),
                "compact_gr_ri_absdiff": F.abs(gr - ri),
                "blue_cloud_color_margin": clip_lower(_lit(0.95) - ug)
                + clip_lower(_lit(0.55) - gr)
                + clip_lower(_lit(0.35) - ri),
            }
        ).withColumn("blue_compact_score", col("compact_color_score") * clip_lower(_lit(0.9) - ug))
    if has(df, "redshift"):
        za = F.abs(col("redshift"))
        df = df.withColumns(
            {
                "local_redshift_abs": za,
                "local_lowz_le_008": flag(za <= 0.08),
                "local_lowz_le_012": flag(za <= 0.12),
                "local_lowz_le_016": flag(za <= 0.16),
                "local_lowz_window_004_016": flag(za.between(0.04, 0.16)),
            }
        )
    if has(df, "mag_std"):
        std = col("mag_std")
        df = df.withColumns(
            {
                "low_mag_std_score": _lit(1.0) / (_lit(1.0) + F.abs(std)),
                "low_mag_std_le_060": flag(std <= 0.60),
                "low_mag_std_le_080": flag(std <= 0.80),
                "low_mag_std_le_100": flag(std <= 1.00),
            }
        )
    exprs = {}
    if has(df, "local_redshift_abs", "compact_color_score"):
        exprs["lowz_x_compact_color"] = (_lit(1.0) / (col("local_redshift_abs") + _lit(EPS))) * col(
            "compact_color_score"
        )
    if has(df, "is_blue_cloud", "compact_color_score"):
        exprs["blue_cloud_x_compact_color"] = col("is_blue_cloud").cast("double") * col("compact_color_score")
    if has(df, "is_blue_cloud", "low_mag_std_score"):
        exprs["blue_cloud_x_low_mag_std"] = col("is_blue_cloud").cast("double") * col("low_mag_std_score")
    return df.withColumns(exprs) if exprs else df


# ---------------------------------------------------------------- B-16
def guard_features_v2(df: DataFrame) -> DataFrame:
    """Guard features, variant 2 (RMS colours).  Same-name clashes with B-15
    are renamed: ``compact_color_rms`` and ``low_mag_std_margin``."""
    if has(df, "redshift"):
        za = F.abs(col("redshift"))
        df = df.withColumns(
            {
                "redshift_abs": za,
                "lowz_abs_le_00497": flag(za <= 0.0497),
                "lowz_abs_le_008": flag(za <= 0.08),
                "lowz_abs_le_0127": flag(za <= 0.127),
                "lowz_abs_le_0144": flag(za <= 0.144),
                "lowz_abs_le_020": flag(za <= 0.20),
                "redshift_abs_inverse": _lit(1.0) / (za + _lit(EPS)),
            }
        )
    if has(df, *COLOR_COLS):
        ug, gr, ri = col("u_minus_g"), col("g_minus_r"), col("r_minus_i")
        rms = row_rms(COLOR_COLS)
        blue = clip_lower(_lit(0.80) - ug) + clip_lower(_lit(0.45) - gr) + clip_lower(_lit(0.25) - ri)
        df = df.withColumns(
            {
                "compact_color_rms": rms,
                "compact_color_rms_non_u": row_rms(COLOR_COLS[1:]),
                "blue_color_score": blue,
                "is_compact_color_090": flag(rms <= 0.90),
                "is_compact_color_130": flag(rms <= 1.30),
                "is_blue_color": flag(blue > 0.0),
            }
        )
    if has(df, "mag_std"):
        std = col("mag_std")
        df = df.withColumns(
            {
                "low_mag_std_025": flag(std <= 0.25),
                "low_mag_std_035": flag(std <= 0.35),
                "low_mag_std_050": flag(std <= 0.50),
                "low_mag_std_075": flag(std <= 0.75),
                "low_mag_std_margin": clip_lower(_lit(0.75) - std),
            }
        )
    if has(df, "galaxy_population"):
        pop = col("galaxy_population")
        df = df.withColumns(
            {"is_blue_cloud": flag(pop == "Blue_Cloud"), "is_red_sequence": flag(pop == "Red_Sequence")}
        )
    if has(df, "redshift_abs", "compact_color_rms", "mag_std"):
        za, rms, std = col("redshift_abs"), col("compact_color_rms"), col("mag_std")
        score = clip_lower(_lit(0.144) - za) * clip_lower(_lit(1.30) - rms) * clip_lower(_lit(0.75) - std)
        exprs = {"compact_lowz_score": score}
        if has(df, "is_blue_cloud"):
            exprs["blue_cloud_compact_lowz_score"] = score * col("is_blue_cloud")
            exprs["lowz_blue_cloud_compact_low_mag_std"] = flag(
                (za <= 0.144) & (rms <= 1.30) & (std <= 0.75) & (col("is_blue_cloud") == 1)
            )
        df = df.withColumns(exprs)
    return df


# ---------------------------------------------------------------- B-17
EXTRA_PAIRS = [
    ("u_minus_g", "g_minus_r"),
    ("g_minus_r", "r_minus_i"),
    ("r_minus_i", "i_minus_z"),
    ("u_minus_r", "r_minus_z"),
    ("g_minus_i", "i_minus_z"),
]


def extra_features(df: DataFrame, trig: bool = True) -> DataFrame:
    """Magnitude-vs-mean, colour pair ratios/products, redshift transforms.

    ``trig=False`` gives the variant without sin/cos columns."""
    exprs: dict[str, Column] = {}
    if has(df, *MAG_COLS, "mag_mean"):
        mm = col("mag_mean")
        for m in MAG_COLS:
            exprs[f"{m}_minus_mag_mean"] = col(m) - mm
            exprs[f"{m}_over_mag_mean"] = col(m) / (F.abs(mm) + _lit(EPS))
    for a, b in EXTRA_PAIRS:
        if has(df, a, b):
            exprs[f"{a}_over_{b}"] = col(a) / (F.abs(col(b)) + _lit(EPS))
            exprs[f"{a}_x_{b}"] = col(a) * col(b)
    if has(df, "redshift"):
        z = col("redshift")
        exprs["redshift_log1p_abs"] = F.log1p(F.abs(z))
        exprs["redshift_sq"] = z * z
        if trig:
            exprs["redshift_sin"] = F.sin(z)
            exprs["redshift_cos"] = F.cos(z)
    if trig and has(df, "g_minus_r"):
        exprs["g_minus_r_sin"] = F.sin(col("g_minus_r"))
        exprs["g_minus_r_cos"] = F.cos(col("g_minus_r"))
    if has(df, "mag_range", "redshift"):
        exprs["mag_range_x_redshift"] = col("mag_range") * col("redshift")
        exprs["mag_range_over_redshift"] = col("mag_range") / (F.abs(col("redshift")) + _lit(EPS))
    return df.withColumns(exprs) if exprs else df


# ---------------------------------------------------------------- B-18
HARD_SLICE_FLAGS = ["hard_lowz", "hard_blue_cloud", "hard_compact_color", "hard_low_mag_std", "hard_wide_color_false"]


def hard_slice_features(df: DataFrame) -> DataFrame:
    """Five hard-slice flags and their conjunction ``hard_slice_main``."""
    if has(df, "redshift"):
        za = F.abs(col("redshift"))
        df = df.withColumns({"hard_redshift_abs": za, "hard_lowz": flag(za <= 0.144)})
    if has(df, *MAG_COLS):
        add = {}
        if not has(df, "mag_std"):
            add["mag_std"] = row_std(MAG_COLS)
        if not has(df, "mag_range"):
            add["mag_range"] = row_max(MAG_COLS) - row_min(MAG_COLS)
        if add:
            df = df.withColumns(add)
        df = df.withColumn("hard_low_mag_std", flag(col("mag_std") <= 0.75))
    if has(df, *COLOR_COLS):
        rms = row_rms(COLOR_COLS)
        df = df.withColumns({"hard_compact_color_score": rms, "hard_compact_color": flag(rms <= 1.30)})
    if has(df, "g_minus_r", "u_minus_z", "mag_range", "mag_std"):
        wide = wide_color_condition(col("g_minus_r"), col("u_minus_z"), col("mag_range"), col("mag_std"))
        df = df.withColumn("hard_wide_color_false", flag(~F.coalesce(wide, F.lit(False))))
    if has(df, "galaxy_population"):
        df = df.withColumn("hard_blue_cloud", flag(col("galaxy_population") == "Blue_Cloud"))
    if has(df, *HARD_SLICE_FLAGS):
        cond = None
        for f in HARD_SLICE_FLAGS:
            c = col(f) == 1
            cond = c if cond is None else cond & c
        df = df.withColumn("hard_slice_main", flag(cond))
    return df


# ---------------------------------------------------------------- B-19
def evaluation_features(df: DataFrame) -> DataFrame:
    """Columns used by slice evaluation: colours, std, range, RMS, wide flag."""
    if not has(df, *MAG_COLS):
        return df
    u, g, r, i, z = (col(m) for m in MAG_COLS)
    df = df.withColumns(
        {
            "u_minus_g": u - g,
            "g_minus_r": g - r,
            "r_minus_i": r - i,
            "i_minus_z": i - z,
            "u_minus_z": u - z,
            "mag_std": row_std(MAG_COLS),
            "mag_range": row_max(MAG_COLS) - row_min(MAG_COLS),
        }
    )
    return df.withColumns(
        {
            "compact_color_rms": row_rms(COLOR_COLS),
            "wide_color_flag": F.coalesce(
                wide_color_condition(col("g_minus_r"), col("u_minus_z"), col("mag_range"), col("mag_std")),
                F.lit(False),
            ),
        }
    )


# ---------------------------------------------------------------- B-39
def _raw(df: DataFrame) -> DataFrame:
    return df


def _baseline(df: DataFrame) -> DataFrame:
    return astronomy_features(df)


def _extra(df: DataFrame) -> DataFrame:
    return extra_features(astronomy_features(df))


def _targeted(df: DataFrame) -> DataFrame:
    return targeted_features(_extra(df))


def _local_guard(df: DataFrame) -> DataFrame:
    return local_guard_features(_targeted(df))


FEATURE_SETS = {
    "raw": _raw,
    "baseline": _baseline,
    "extra": _extra,
    "targeted": _targeted,
    "local_guard": _local_guard,
}


def feature_set(df: DataFrame, name: str) -> DataFrame:
    """B-39: named feature set → DataFrame with the set's columns added."""
    if name not in FEATURE_SETS:
        raise ValueError(f"unknown feature set {name!r}; known: {sorted(FEATURE_SETS)}")
    return FEATURE_SETS[name](df)


def build_feature_sets(train: DataFrame, test: DataFrame, generated: DataFrame | None = None,
                       group_features: tuple[DataFrame, DataFrame] | None = None, id_col: str = "id") -> dict:
    """B-39: all named feature sets as (train, test) pairs.

    ``generated`` (id + searched columns, K-13) and ``group_features``
    (id + group aggregate columns for train and test, E-12/D-08) are attached
    by left joins on id: ``autofe`` = baseline + generated, ``groupagg`` =
    baseline + group features, ``wide`` = extra + both, ``targeted_wide`` =
    targeted + both.  Column lineage is the column list of each frame."""
    out = {name: (fn(train), fn(test)) for name, fn in FEATURE_SETS.items()}

    def attach(pair, gen, grp):
        tr, te = pair
        if gen is not None:
            tr, te = tr.join(gen, id_col, "left"), te.join(gen, id_col, "left")
        if grp is not None:
            tr, te = tr.join(grp[0], id_col, "left"), te.join(grp[1], id_col, "left")
        return tr, te

    if generated is not None:
        out["autofe"] = attach(out["baseline"], generated, None)
    if group_features is not None:
        out["groupagg"] = attach(out["baseline"], None, group_features)
    out["wide"] = attach(out["extra"], generated, group_features)
    out["targeted_wide"] = attach(out["targeted"], generated, group_features)
    return out


def feature_columns(df: DataFrame, exclude=("id", "class", "split", "source_index")) -> list[str]:
    """Numeric model columns of a feature frame (B-38: drop id/target/index)."""
    numeric = {"double", "float", "int", "bigint", "smallint", "tinyint", "boolean"}
    return [n for n, t in df.dtypes if n not in set(exclude) and t in numeric]
