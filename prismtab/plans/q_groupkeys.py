"""Registered group-key queries (E-07..E-09, E-12..E-16, F-01, F-03, G-05, D-08)
with DuckDB oracles."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from prismtab.constants import CLASSES
from prismtab.operators import groupkeys as GK
from prismtab.plans.catalog import register, rounded
from prismtab.plans.common import with_views
from prismtab.sources.fixtures import load_obs, read_table

CAT_KEYS = ["spectral_type", "galaxy_population"]
BIN_KEYS = ["qbin__redshift__5", "qbin__u__10", "qbin__z__5", "round__alpha__0", "round__redshift__1"]
CANDIDATES = GK.group_candidates(CAT_KEYS, BIN_KEYS)  # G-05: 53 candidates
PROFILE_CANDIDATES = GK.group_candidates(CAT_KEYS, BIN_KEYS[:2], max_degree=2)


def _keyed(spark, sf_dir):
    obs = load_obs(spark, sf_dir)
    train = obs.where(F.col("split") == "train")
    test = obs.where(F.col("split") == "test").drop("class")
    (train, test), _ = GK.key_columns([train, test], CAT_KEYS + BIN_KEYS)
    return train, test


# ------------------------------------------------------------------ SQL side
def _fr(q: int) -> str:
    return "[" + ", ".join(repr(float(v)) for v in np.linspace(0.0, 1.0, q + 1)) + "]"


def _edges_sql(col: str, q: int) -> str:
    return (f"list_distinct(list_transform(quantile_cont({col}, {_fr(q)}), lambda e: round(e, 9))) "
            f"AS e_{col}_{q}")


def _bin_sql(col: str, q: int) -> str:
    e = f"e_{col}_{q}"
    return (f"CAST(CASE WHEN {col} IS NULL THEN -1 ELSE len(list_filter({e}, lambda v: v > list_min({e}) "
            f"AND v < {col})) END AS VARCHAR) AS qbin__{col}__{q}")


KEYED_SQL = ("edges AS (SELECT " + ", ".join([_edges_sql("redshift", 5), _edges_sql("u", 10), _edges_sql("z", 5)])
             + " FROM obs),\nkeyed AS (\n  SELECT o.id, o.class, o.split,\n    coalesce(o.spectral_type, '__NA__') "
             "AS spectral_type, coalesce(o.galaxy_population, '__NA__') AS galaxy_population,\n    "
             + ",\n    ".join([_bin_sql("redshift", 5), _bin_sql("u", 10), _bin_sql("z", 5)])
             + ",\n    CAST(CAST(round_even(coalesce(o.alpha, -999999e0), 0) + 0e0 AS FLOAT) AS VARCHAR) AS round__alpha__0"
             ",\n    CAST(CAST(round_even(coalesce(o.redshift, -999999e0), 1) + 0e0 AS FLOAT) AS VARCHAR) "
             "AS round__redshift__1\n  FROM obs o CROSS JOIN edges\n)")

GLOBAL_SQL = """gtot AS (
  SELECT count(*) AS n_all, sum(CASE WHEN class = 'GALAXY' THEN 1 ELSE 0 END) AS ng,
    sum(CASE WHEN class = 'QSO' THEN 1 ELSE 0 END) AS nq, sum(CASE WHEN class = 'STAR' THEN 1 ELSE 0 END) AS ns
  FROM keyed WHERE split = 'train'
), gtest AS (SELECT count(*) AS nt FROM keyed WHERE split = 'test')"""


def _cells_sql(keys: tuple[str, ...]) -> str:
    ks = ", ".join(keys)
    return (f"SELECT {ks}, sum(CASE WHEN split = 'train' AND class = 'GALAXY' THEN 1 ELSE 0 END) AS cg, "
            f"sum(CASE WHEN split = 'train' AND class = 'QSO' THEN 1 ELSE 0 END) AS cq, "
            f"sum(CASE WHEN split = 'train' AND class = 'STAR' THEN 1 ELSE 0 END) AS cs, "
            f"sum(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS tr, "
            f"sum(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS te FROM keyed GROUP BY {ks}")


_H = ("(CASE WHEN {c} > 0 THEN -({c} / tr) * log2({c} / tr) ELSE 0e0 END)")
ENT_SQL = "((" + " + ".join(_H.format(c=c) for c in ("cg", "cq", "cs")) + f") / log2(3e0))"
MI_SQL = " + ".join(
    f"(CASE WHEN {c} > 0 THEN ({c} / n_all) * ln({c} * n_all / (tr * {n})) ELSE 0e0 END)"
    for c, n in (("cg", "ng"), ("cq", "nq"), ("cs", "ns"))
)
HY_SQL = " + ".join(f"(CASE WHEN {n} > 0 THEN -({n} / n_all) * ln({n} / n_all) ELSE 0e0 END)" for n in ("ng", "nq", "ns"))


def _score_sql(keys: tuple[str, ...]) -> str:
    return f"""SELECT '{"|".join(keys)}' AS keys, {len(keys)} AS degree,
  CAST(count(*) FILTER (WHERE tr > 0) AS INTEGER) AS n_train_groups,
  CAST(count(*) FILTER (WHERE te > 0) AS INTEGER) AS n_test_groups,
  round(quantile_cont(tr, 0.5) FILTER (WHERE tr > 0), 6) AS median_train_group_size,
  round(CAST(min(tr) FILTER (WHERE tr > 0) AS DOUBLE), 6) AS min_train_group_size,
  round(CAST(max(tr) FILTER (WHERE tr > 0) AS DOUBLE), 6) AS max_train_group_size,
  round(coalesce(sum(tr) FILTER (WHERE tr > 0 AND tr < 30), 0) / any_value(n_all), 6) AS small_group_row_rate,
  round(coalesce(coalesce(sum(te) FILTER (WHERE tr = 0), 0) / any_value(nt), 0e0), 6) AS test_unseen_row_rate,
  round(0.5e0 * sum(abs(tr / n_all - te / nt)), 6) AS train_test_frequency_tvd,
  round(sum(greatest(cg, cq, cs)) FILTER (WHERE tr > 0) / any_value(n_all), 6) AS weighted_purity,
  round(sum(tr * {ENT_SQL}) FILTER (WHERE tr > 0) / any_value(n_all), 6) AS weighted_entropy,
  round(sum({MI_SQL}) FILTER (WHERE tr > 0), 6) AS mi_target,
  round(CASE WHEN any_value({HY_SQL}) > 0 THEN sum({MI_SQL}) FILTER (WHERE tr > 0) / any_value({HY_SQL})
        ELSE 0e0 END, 6) AS normalized_mi,
  round(sum(greatest(cg, cq, cs)) FILTER (WHERE tr > 0) / any_value(n_all)
        - any_value(greatest(ng, nq, ns) / n_all), 6) AS purity_lift
FROM ({_cells_sql(keys)}) c CROSS JOIN gtot CROSS JOIN gtest"""


SCORES_SQL = with_views(KEYED_SQL, GLOBAL_SQL) + "\nUNION ALL\n".join(_score_sql(k) for k in CANDIDATES)


# ---------------------------------------------------------------- E-08 / G-05 / E-16
@register("e08_group_key_scores", SCORES_SQL)
def q_group_key_scores(spark, sf_dir):
    train, test = _keyed(spark, sf_dir)
    cells = GK.group_cells(train, test, "class", CANDIDATES)
    return rounded(GK.group_key_scores(cells, CLASSES, 30))


# ---------------------------------------------------------------- E-07 / E-09
def _profile_sql(keys: tuple[str, ...], lead: str = "") -> str:
    k2 = keys[1] if len(keys) > 1 else "CAST(NULL AS VARCHAR)"
    return f"""SELECT {lead}'{"|".join(keys)}' AS keys, {keys[0]} AS k1, {k2} AS k2,
  CAST(cg AS BIGINT) AS count_GALAXY, CAST(cq AS BIGINT) AS count_QSO, CAST(cs AS BIGINT) AS count_STAR,
  CAST(tr AS BIGINT) AS train_count, CAST(te AS BIGINT) AS test_count,
  round(cg / tr, 6) AS rate_GALAXY, round(cq / tr, 6) AS rate_QSO, round(cs / tr, 6) AS rate_STAR,
  CASE WHEN cg >= cq AND cg >= cs THEN 'GALAXY' WHEN cq >= cs THEN 'QSO' ELSE 'STAR' END AS dominant_class,
  round(greatest(cg, cq, cs) / tr, 6) AS dominant_rate, round({ENT_SQL}, 6) AS target_entropy_norm
FROM ({_cells_sql(keys)}) c WHERE tr > 0"""


PROFILE_SQL = with_views(KEYED_SQL) + "\nUNION ALL\n".join(_profile_sql(k, f"'{'__'.join(k)}' AS key_name, ") for k in PROFILE_CANDIDATES)


def profile_frame(spark, sf_dir):
    train, test = _keyed(spark, sf_dir)
    cells = GK.group_cells(train, test, "class", PROFILE_CANDIDATES)
    return rounded(GK.group_profile(cells, CLASSES))


@register("e07_group_key_profile", PROFILE_SQL)
def q_group_profile(spark, sf_dir):
    profile = profile_frame(spark, sf_dir)
    return profile.select(F.replace("keys", F.lit("|"), F.lit("__")).alias("key_name"), *profile.columns)


# ---------------------------------------------------------------- F-03
@register("f03_top_groups_per_key", with_views(KEYED_SQL, "prof AS (" + "\nUNION ALL\n".join(
    _profile_sql(k) for k in PROFILE_CANDIDATES) + ")") + """SELECT keys, k1, k2, dominant_class, dominant_rate,
  train_count FROM (
  SELECT *, row_number() OVER (PARTITION BY keys ORDER BY dominant_rate DESC, train_count DESC,
    k1 ASC NULLS FIRST, k2 ASC NULLS FIRST) AS rn FROM prof) WHERE rn <= 3""")
def q_top_groups(spark, sf_dir):
    top = GK.top_groups(profile_frame(spark, sf_dir), 3)
    return top.select("keys", "k1", "k2", "dominant_class", "dominant_rate", "train_count")


# ---------------------------------------------------------------- E-14 / E-15
def _li_edges(col: str, q: int) -> str:
    return (f"list_distinct(list_transform(quantile_cont({col}, {_fr(q)}), lambda e: round(e, 9))) AS e_{col}")


def _li_bin(col: str) -> str:
    e = f"e_{col}"
    return (f"CAST(CASE WHEN {col} IS NULL THEN -1 ELSE len(list_filter({e}, lambda v: v > list_min({e}) "
            f"AND v < {col})) END AS SMALLINT)")


@register("e14_quantile_bins", "WITH edges AS (SELECT " + ", ".join(
    [_li_edges("l_quantity", 10), _li_edges("l_extendedprice", 5), _li_edges("l_discount", 5)])
    + " FROM lineitem)\nSELECT l_orderkey, l_linenumber, "
    + f"{_li_bin('l_quantity')} AS qbin__l_quantity__10, {_li_bin('l_extendedprice')} AS qbin__l_extendedprice__5, "
    + f"{_li_bin('l_discount')} AS qbin__l_discount__5 FROM lineitem CROSS JOIN edges")
def q_quantile_bins(spark, sf_dir):
    """Quantile bins with many ties (quantity, discount): duplicate edges are
    dropped and labels are right-closed, like ``pd.qcut``."""
    li = read_table(spark, sf_dir, "lineitem")
    specs = ["qbin__l_quantity__10", "qbin__l_extendedprice__5", "qbin__l_discount__5"]
    (out,), _ = GK.key_columns([li], specs)
    return out.select("l_orderkey", "l_linenumber", *specs)


@register("e15_rounded_keys", """SELECT c_custkey,
  CAST(round_even(coalesce(c_acctbal, -999999e0), 0) AS FLOAT) AS round__c_acctbal__0,
  CAST(round_even(coalesce(c_acctbal, -999999e0), -2) AS FLOAT) AS round__c_acctbal__m2,
  CAST(round_even(coalesce(c_acctbal, -999999e0), 1) AS FLOAT) AS round__c_acctbal__1
FROM customer""")
def q_rounded_keys(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    return c.select("c_custkey",
                    GK.rounded_key(F.col("c_acctbal"), 0).alias("round__c_acctbal__0"),
                    GK.rounded_key(F.col("c_acctbal"), -2).alias("round__c_acctbal__m2"),
                    GK.rounded_key(F.col("c_acctbal"), 1).alias("round__c_acctbal__1"))


# ---------------------------------------------------------------- E-12 / D-08
@register("e12_group_stats_attach", with_views("""fit AS (
  SELECT spectral_type, galaxy_population, avg(redshift) AS m, stddev_samp(redshift) AS s, count(redshift) AS c,
    quantile_cont(redshift, 0.5) AS md
  FROM obs WHERE split = 'train' GROUP BY ALL
), g AS (SELECT avg(redshift) AS gm, stddev_samp(redshift) AS gs, quantile_cont(redshift, 0.5) AS gmd FROM obs WHERE split = 'train')""")
          + """SELECT o.id, round(coalesce(f.m, g.gm), 6) AS redshift__mean, round(coalesce(f.s, g.gs), 6) AS redshift__std,
  round(coalesce(CAST(f.c AS DOUBLE), 0e0), 6) AS redshift__count,
  round(coalesce(f.md, g.gmd), 6) AS redshift__median
FROM obs o LEFT JOIN fit f ON o.spectral_type IS NOT DISTINCT FROM f.spectral_type
  AND o.galaxy_population IS NOT DISTINCT FROM f.galaxy_population
CROSS JOIN g WHERE o.split = 'test'""")
def q_group_stats(spark, sf_dir):
    obs = load_obs(spark, sf_dir)
    train = obs.where(F.col("split") == "train")
    test = obs.where(F.col("split") == "test")
    keys = ["spectral_type", "galaxy_population"]
    stats = ("mean", "std", "count", "median")
    fitted = GK.fit_group_stats(train, keys, "redshift", stats)
    glob = GK.global_stats(train, "redshift", stats)
    out = GK.attach_group_stats(test, fitted, glob, keys, "redshift", stats)
    return rounded(out.select("id", *[f"redshift__{s}" for s in stats]))


# ---------------------------------------------------------------- F-01
@register("f01_group_transform", """SELECT event_id,
  round(coalesce(avg(value) OVER w, 0e0), 6) AS value__mean,
  round(coalesce(stddev_samp(value) OVER w, 0e0), 6) AS value__std,
  round(CAST(count(value) OVER w AS DOUBLE), 6) AS value__count
FROM events WINDOW w AS (PARTITION BY user_id)""")
def q_group_transform(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    out = GK.transform_group_stats(ev, ["user_id"], "value")
    return rounded(out.select("event_id", "value__mean", "value__std", "value__count"))


# ---------------------------------------------------------------- E-13
ANOVA_FEATURES = ["u", "g", "r", "i", "z", "redshift", "alpha", "delta"]


def _anova_sql(f: str) -> str:
    return f"""SELECT '{f}' AS feature, round((ssb / (k - 1)) / (ssw / (n - k)), 6) AS f_score, (ssb / (k - 1)) / (ssw / (n - k)) AS f_exact,
  CAST(k - 1 AS INTEGER) AS df_between, CAST(n - k AS BIGINT) AS df_within
FROM (SELECT sum(nc * (mc - gm) * (mc - gm)) AS ssb, sum((nc - 1) * coalesce(vc, 0e0)) AS ssw,
        any_value(n) AS n, count(*) AS k
      FROM (SELECT class, count({f}) AS nc, avg({f}) AS mc, var_samp({f}) AS vc FROM obs
            WHERE split = 'train' AND {f} IS NOT NULL GROUP BY class) per
      CROSS JOIN (SELECT count({f}) AS n, avg({f}) AS gm FROM obs WHERE split = 'train' AND {f} IS NOT NULL) t)"""


#: with three classes the tail of the F distribution has a closed form
@register("e13_anova_f", "SELECT * EXCLUDE (f_exact), round(CASE WHEN f_score <= 0 THEN 1e0 ELSE pow(1e0 + 2e0 * f_exact / df_within, -df_within / 2e0) END, 6) AS p_value FROM ("
          + with_views() + "\nUNION ALL\n".join(_anova_sql(f) for f in ANOVA_FEATURES) + ")")
def q_anova(spark, sf_dir):
    obs = load_obs(spark, sf_dir).where(F.col("split") == "train")
    return rounded(GK.anova_with_pvalues(obs, "class", ANOVA_FEATURES))
