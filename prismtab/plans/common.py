"""Shared building blocks of the registered queries (Spark side and SQL side)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prismtab.constants import (
    CLASSES,
    SLICE_BASE_NAMES,
    SLICE_COMPACT_COLOR_SCORE_MAX,
    SLICE_LOW_MAG_STD_MAX,
    SLICE_LOWZ_REDSHIFT_ABS_MAX,
)
from prismtab.functions.features import evaluation_features
from prismtab.functions.proba import argmax_class
from prismtab.sources.fixtures import OBS_SQL, PRO_SQL, PRO_MODELS, load_obs, load_pro

MODELS = list(PRO_MODELS)


def model_cols(m: str) -> list[str]:
    return [f"{m}__{c}" for c in CLASSES]


def slice_masks(df: DataFrame) -> dict[str, Column]:
    """C-04 base masks over evaluation features (B-19)."""
    col = F.col
    return dict(
        zip(
            SLICE_BASE_NAMES,
            [
                F.abs(col("redshift")) <= SLICE_LOWZ_REDSHIFT_ABS_MAX,
                col("galaxy_population") == "Blue_Cloud",
                col("compact_color_rms") <= SLICE_COMPACT_COLOR_SCORE_MAX,
                col("mag_std") <= SLICE_LOW_MAG_STD_MAX,
                ~col("wide_color_flag"),
            ],
        )
    )


def predictions(spark: SparkSession, sf_dir: str, split: str | None = "train") -> DataFrame:
    """id, class, split, pred_m1..pred_m3 (argmax of each synthetic model)."""
    pro = load_pro(spark, sf_dir)
    if split is not None:
        pro = pro.where(F.col("split") == split)
    return pro.select("id", "class", "split", *[argmax_class(model_cols(m)).alias(f"pred_{m}") for m in MODELS])


def eval_frame(spark: SparkSession, sf_dir: str, split: str = "train") -> DataFrame:
    """Observation rows of one split with B-19 evaluation features."""
    obs = load_obs(spark, sf_dir).where(F.col("split") == split)
    return evaluation_features(obs)


# ------------------------------------------------------------------ SQL side
def with_views(*extra: str) -> str:
    return "WITH " + ",\n".join([OBS_SQL, PRO_SQL, *extra]) + "\n"


ARGMAX_SQL = (
    "CASE WHEN {m}__GALAXY >= {m}__QSO AND {m}__GALAXY >= {m}__STAR THEN 'GALAXY' "
    "WHEN {m}__QSO >= {m}__STAR THEN 'QSO' ELSE 'STAR' END"
)


def argmax_sql(m: str) -> str:
    return ARGMAX_SQL.format(m=m)


PREDS_SQL = (
    "preds AS (SELECT id, class, split, "
    + ", ".join(f"{argmax_sql(m)} AS pred_{m}" for m in MODELS)
    + " FROM pro)"
)

EVAL_SQL = """evf AS (
  SELECT *, sqrt((ug*ug + gr*gr + ri*ri + iz*iz)/4) AS rms,
    (gr > 1.037 AND uz > 3.834 AND (mag_range > 3.949 OR mag_std > 1.624)) AS wide
  FROM (
    SELECT id, class, split, galaxy_population, redshift,
      u-g AS ug, g-r AS gr, r-i AS ri, i-z AS iz, u-z AS uz,
      greatest(u,g,r,i,z) - least(u,g,r,i,z) AS mag_range,
      sqrt(((u-mm)*(u-mm) + (g-mm)*(g-mm) + (r-mm)*(r-mm) + (i-mm)*(i-mm) + (z-mm)*(z-mm))/4) AS mag_std
    FROM (SELECT *, (u+g+r+i+z)/5 AS mm FROM obs)
  )
)"""

# one row per slice: bit j of b selects base mask j
SLICES_SQL = """slices AS (
  SELECT b, CASE WHEN nm = '' THEN 'ALL' ELSE nm END AS slice FROM (
    SELECT b, concat_ws('&',
      CASE WHEN b & 1 > 0 THEN 'lowz' END, CASE WHEN b & 2 > 0 THEN 'Blue_Cloud' END,
      CASE WHEN b & 4 > 0 THEN 'compact_color' END, CASE WHEN b & 8 > 0 THEN 'low_mag_std' END,
      CASE WHEN b & 16 > 0 THEN 'wide_color_false' END) AS nm
    FROM (SELECT range AS b FROM range(32))
  )
)"""

MASK_JOIN_SQL = """((s.b & 1 = 0) OR abs(e.redshift) <= 0.144)
  AND ((s.b & 2 = 0) OR e.galaxy_population = 'Blue_Cloud')
  AND ((s.b & 4 = 0) OR e.rms <= 1.30)
  AND ((s.b & 8 = 0) OR e.mag_std <= 0.75)
  AND ((s.b & 16 = 0) OR NOT e.wide)"""

WEIGHT_SQL = "CASE {c} WHEN 'GALAXY' THEN 1e0 WHEN 'QSO' THEN 3.2e0 WHEN 'STAR' THEN 4.6e0 END"
