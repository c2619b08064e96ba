"""Fixed values of the default (astronomy) profile.

These are values that must equal the workflow being re-implemented for
results to agree.  They are kept together, as plain text, in natural order.
"""

from __future__ import annotations

# --- fixed values: column names -------------------------------------------
ID_COL = "id"
LABEL_COL = "class"
CATEGORICAL_COLS = ["spectral_type", "galaxy_population"]
MAG_COLS = ["u", "g", "r", "i", "z"]

# --- fixed values: class domain (order matters: code = position) ----------
CLASSES = ["GALAXY", "QSO", "STAR"]

# --- fixed values: default class weights for weighted accuracy ------------
DEFAULT_CLASS_WEIGHTS = {"GALAXY": 1.0, "QSO": 3.2, "STAR": 4.6}

# --- fixed values: filter effective wavelengths (Angstrom) ----------------
FILTER_WAVELENGTHS = {"u": 3543.0, "g": 4770.0, "r": 6231.0, "i": 7625.0, "z": 9134.0}

# --- fixed values: slice thresholds of the public-safe evaluation ---------
SLICE_LOWZ_REDSHIFT_ABS_MAX = 0.144
SLICE_COMPACT_COLOR_SCORE_MAX = 1.30
SLICE_LOW_MAG_STD_MAX = 0.75
SLICE_BASE_NAMES = ["lowz", "Blue_Cloud", "compact_color", "low_mag_std", "wide_color_false"]

# --- fixed values: wide-colour ("hard star") cut --------------------------
HARD_STAR_GR = 1.037
HARD_STAR_UZ = 3.834
HARD_STAR_RANGE = 3.949
HARD_STAR_STD = 1.624
HARD_STAR_STD_MID = 1.118

# --- fixed values: default threshold-search ranges (start:stop:step) ------
DEFAULT_QSO_STEPS = ("0.40", "0.60", "0.02")
DEFAULT_STAR_STEPS = ("0.40", "0.60", "0.02")
DEFAULT_REPLACE_STEPS = ("0.50", "0.95", "0.03")

# --- fixed values: numeric guards ------------------------------------------
PROBA_CLIP = 1e-12
FEATURE_EPS = 1e-3
LOGLOSS_EPS = 1e-15

# --- fixed values: missing-value sentinels for group keys ------------------
KEY_NA_STRING = "__NA__"
KEY_NA_NUMBER = -999999.0
KEY_NA_BIN = -1
