"""Registered probability-table queries (B-21, B-22, B-25..B-32) with DuckDB
oracles over the synthetic model table ``pro``."""

from __future__ import annotations

from pyspark.sql import functions as F

from prismtab.constants import CLASSES
from prismtab.functions import proba as P
from prismtab.plans.catalog import register, rounded
from prismtab.plans.common import model_cols, with_views
from prismtab.sources.fixtures import load_pro

G, Q, S = CLASSES


def _pro(spark, sf_dir):
    return load_pro(spark, sf_dir)


def _r(expr: str, name: str) -> str:
    return f"round({expr}, 6) + 0e0 AS {name}"


# SQL helpers -----------------------------------------------------------------
def _norm_sql(cols: list[str], clip: str = "1e-12") -> list[str]:
    c = [f"greatest({x}, {clip})" for x in cols]
    tot = "(" + " + ".join(c) + ")"
    return [f"({x} / {tot})" for x in c]


def _argmax_sql(p: list[str]) -> str:
    return (f"CASE WHEN {p[0]} >= {p[1]} AND {p[0]} >= {p[2]} THEN 'GALAXY' "
            f"WHEN {p[1]} >= {p[2]} THEN 'QSO' ELSE 'STAR' END")


def _mid_sql(a: str, b: str, c: str) -> str:
    return f"greatest(least({a}, {b}), least(greatest({a}, {b}), {c}))"


# ---------------------------------------------------------------- B-21 / B-22
_N3 = _norm_sql(["m3__GALAXY", "m3__QSO", "m3__STAR"])


@register("b21_b22_normalize_argmax", with_views() + "SELECT id, " + ", ".join(
    _r(x, f"p_{c}") for x, c in zip(_N3, CLASSES)) + f", {_argmax_sql(_N3)} AS pred FROM pro")
def q_normalize_argmax(spark, sf_dir):
    p = P.normalize(model_cols("m3"))
    return rounded(_pro(spark, sf_dir).select("id", *[x.alias(f"p_{c}") for x, c in zip(p, CLASSES)],
                                              P.argmax_class(p).alias("pred")))


# ---------------------------------------------------------------- B-24
@register("b24_staged_confidence", with_views() + """SELECT id, round(CASE
  WHEN m1__QSO >= 0.46 THEN m1__QSO
  WHEN m1__STAR / greatest(m1__GALAXY + m1__STAR, 1e-12) >= 0.38 THEN m1__STAR / greatest(m1__GALAXY + m1__STAR, 1e-12)
  ELSE m1__GALAXY / greatest(m1__GALAXY + m1__STAR, 1e-12) END, 6) AS staged_confidence FROM pro""")
def q_staged_confidence(spark, sf_dir):
    g, q, s = (F.col(c) for c in model_cols("m1"))
    _, staged, _ = P.two_stage(g, q, s, 0.46, 0.38, 0.5)
    return rounded(_pro(spark, sf_dir).select("id", P.staged_confidence(g, q, s, staged).alias("staged_confidence")))


# ---------------------------------------------------------------- B-25
_PQ = "least(greatest(m1__QSO, 1e-8), 1e0 - 1e-8)"
_PS = "least(greatest(m2__STAR / (m2__GALAXY + m2__STAR), 1e-8), 1e0 - 1e-8)"
_B25 = _norm_sql([f"(1e0 - {_PQ}) * (1e0 - {_PS})", _PQ, f"(1e0 - {_PQ}) * {_PS}"])


@register("b25_combined_two_stage", with_views() + "SELECT id, " + ", ".join(
    _r(x, f"p_{c}") for x, c in zip(_B25, CLASSES)) + " FROM pro")
def q_combined_two_stage(spark, sf_dir):
    p = P.combined_two_stage(F.col("m1__QSO"), F.col("m2__STAR") / (F.col("m2__GALAXY") + F.col("m2__STAR")))
    return rounded(_pro(spark, sf_dir).select("id", *[x.alias(f"p_{c}") for x, c in zip(p, CLASSES)]))


# ---------------------------------------------------------------- B-26
LOGIT_WEIGHTS = {"m1": 1.0, "m2": 0.5, "m3": 1.0}


def _logit_sql(m: str, w: float) -> list[str]:
    c = [f"least(greatest({m}__{k}, 1e-5), 1e0 - 1e-5)" for k in CLASSES]
    tot = "(" + " + ".join(c) + ")"
    p = [f"({x} / {tot})" for x in c]
    out = [_r(f"ln({x} / (1e0 - {x})) * {w!r}e0", f"logit__{m}__{k}") for x, k in zip(p, CLASSES)]
    out.append(_r("-(" + " + ".join(f"{x} * ln({x})" for x in p) + f") * {w!r}e0", f"entropy__{m}"))
    out.append(_r(f"(greatest({p[0]}, {p[1]}, {p[2]}) - {_mid_sql(*p)}) * {w!r}e0", f"margin__{m}"))
    return out


@register("b26_logit_features", with_views() + "SELECT id, " + ",\n  ".join(
    x for m, w in LOGIT_WEIGHTS.items() for x in _logit_sql(m, w)) + " FROM pro")
def q_logit_features(spark, sf_dir):
    blocks = {m: model_cols(m) for m in LOGIT_WEIGHTS}
    return rounded(P.logit_features(_pro(spark, sf_dir), blocks, eps=1e-5, weights=LOGIT_WEIGHTS))


# ---------------------------------------------------------------- B-27
_N1 = _norm_sql(["m1__GALAXY", "m1__QSO", "m1__STAR"])
_PRED2 = _argmax_sql(["m2__GALAXY", "m2__QSO", "m2__STAR"])
_PRED3 = _argmax_sql(["m3__GALAXY", "m3__QSO", "m3__STAR"])
B27_SQL = with_views(f"b AS (SELECT id, {_N1[0]} AS g, {_N1[1]} AS q, {_N1[2]} AS s, {_PRED2} AS pm2, {_PRED3} AS pm3 FROM pro)") + f"""
SELECT id, {_r(f"greatest(g, q, s) - {_mid_sql('g', 'q', 's')}", "stack_margin")},
  {_r("-(g * ln(greatest(g, 1e-12)) + q * ln(greatest(q, 1e-12)) + s * ln(greatest(s, 1e-12)))", "stack_entropy")},
  {_r("g / greatest(g + s, 1e-12)", "stack_galaxy_given_galaxy_star")},
  {_r("s / greatest(g + s, 1e-12)", "stack_star_given_galaxy_star")},
  {_r("g / greatest(g + q, 1e-12)", "stack_galaxy_given_galaxy_qso")},
  {_r("q - g", "stack_qso_margin_vs_galaxy")}, {_r("s - g", "stack_star_margin_vs_galaxy")},
  CAST(CASE WHEN g >= q AND g >= s THEN 0 WHEN q >= s THEN 1 ELSE 2 END AS TINYINT) AS stack_pred_code,
  CAST(CASE WHEN g >= q AND g >= s THEN 1 ELSE 0 END AS TINYINT) AS stack_pred_is_GALAXY,
  CAST(CASE WHEN NOT (g >= q AND g >= s) AND q >= s THEN 1 ELSE 0 END AS TINYINT) AS stack_pred_is_QSO,
  CAST(CASE WHEN NOT (g >= q AND g >= s) AND NOT q >= s THEN 1 ELSE 0 END AS TINYINT) AS stack_pred_is_STAR,
  CAST(CASE pm2 WHEN 'GALAXY' THEN 0 WHEN 'QSO' THEN 1 WHEN 'STAR' THEN 2 ELSE -1 END AS TINYINT) AS pm2_code,
  CAST(pm2 = 'GALAXY' AS TINYINT) AS pm2_is_GALAXY, CAST(pm2 = 'QSO' AS TINYINT) AS pm2_is_QSO,
  CAST(pm2 = 'STAR' AS TINYINT) AS pm2_is_STAR,
  CAST(CASE pm3 WHEN 'GALAXY' THEN 0 WHEN 'QSO' THEN 1 WHEN 'STAR' THEN 2 ELSE -1 END AS TINYINT) AS pm3_code,
  CAST(pm3 = 'GALAXY' AS TINYINT) AS pm3_is_GALAXY, CAST(pm3 = 'QSO' AS TINYINT) AS pm3_is_QSO,
  CAST(pm3 = 'STAR' AS TINYINT) AS pm3_is_STAR,
  CAST(pm2 IS DISTINCT FROM pm3 AS TINYINT) AS pm2_ne_pm3
FROM b"""


@register("b27_prediction_meta_features", B27_SQL)
def q_meta_features(spark, sf_dir):
    pro = _pro(spark, sf_dir).select("id", *model_cols("m1"), P.argmax_class(model_cols("m2")).alias("pm2"),
                                     P.argmax_class(model_cols("m3")).alias("pm3"))
    out = P.prediction_meta_features(pro, model_cols("m1"), pred_cols=["pm2", "pm3"], prefix="stack")
    return rounded(out.drop(*model_cols("m1"), "pm2", "pm3"))


# ---------------------------------------------------------------- B-28..B-30
ALPHA = 0.35


def _pair_sql() -> str:
    base = _norm_sql(["m1__GALAXY", "m1__QSO", "m1__STAR"])
    gs = "(m2__GALAXY / (m2__GALAXY + m2__STAR))"
    gq = "(m3__GALAXY / (m3__GALAXY + m3__QSO))"
    # B-28: reallocate the GALAXY+STAR mass of base by p(G | G,S)
    tot = f"({base[0]} + {base[2]})"
    rea = _norm_sql([f"{tot} * {gs}", base[1], f"{tot} * (1e0 - {gs})"])

    def lg(x):
        return (f"ln(least(greatest({x}, 1e-6), 1e0 - 1e-6) / least(greatest(1e0 - {x}, 1e-6), 1e0 - 1e-6))")
    sc = ["0e0", f"-{lg(gq)}", f"-{lg(gs)}"]
    top = f"greatest({sc[0]}, {sc[1]}, {sc[2]})"
    pair = _norm_sql([f"exp({x} - {top})" for x in sc])
    b2 = _norm_sql(base)
    p2 = _norm_sql(pair)
    bl = _norm_sql([f"pow({x}, {1 - ALPHA!r}e0) * pow({y}, {ALPHA!r}e0)" for x, y in zip(b2, p2)])
    cols = ([_r(x, f"realloc_{c}") for x, c in zip(rea, CLASSES)] + [_r(x, f"pair_{c}") for x, c in zip(pair, CLASSES)]
            + [_r(x, f"blend_{c}") for x, c in zip(bl, CLASSES)])
    return with_views() + "SELECT id, " + ",\n  ".join(cols) + " FROM pro"


@register("b28_b30_pair_reallocation_blend", _pair_sql())
def q_pair_blocks(spark, sf_dir):
    pro = _pro(spark, sf_dir)
    base = P.normalize(model_cols("m1"))
    gs = F.col("m2__GALAXY") / (F.col("m2__GALAXY") + F.col("m2__STAR"))
    gq = F.col("m3__GALAXY") / (F.col("m3__GALAXY") + F.col("m3__QSO"))
    rea = P.reallocate_pair(base, gs, CLASSES.index(G), CLASSES.index(S))
    pair = P.pair_margin_scores(gs, gq)
    bl = P.blend(base, pair, ALPHA)
    return rounded(pro.select("id", *[x.alias(f"realloc_{c}") for x, c in zip(rea, CLASSES)],
                              *[x.alias(f"pair_{c}") for x, c in zip(pair, CLASSES)],
                              *[x.alias(f"blend_{c}") for x, c in zip(bl, CLASSES)]))


# ---------------------------------------------------------------- B-31
ENS_WEIGHTS = {"m1": 1.0, "m2": 0.55, "m3": 1.35}


def _wavg_sql() -> str:
    tw = sum(ENS_WEIGHTS.values())
    acc = ["((" + " + ".join(f"{m}__{c} * {w!r}e0" for m, w in ENS_WEIGHTS.items()) + f") / {tw!r}e0)" for c in CLASSES]
    tot = "(" + " + ".join(acc) + ")"
    return with_views() + "SELECT id, " + ", ".join(_r(f"{a} / {tot}", f"ens_{c}") for a, c in zip(acc, CLASSES)) + " FROM pro"


@register("b31_weighted_average", _wavg_sql())
def q_weighted_average(spark, sf_dir):
    pro = _pro(spark, sf_dir)
    blocks = {m: model_cols(m) for m in ["m1", "m2", "m3", "absent_model"]}
    ens = P.weighted_average(pro, blocks, ENS_WEIGHTS)
    return rounded(pro.select("id", *[x.alias(f"ens_{c}") for x, c in zip(ens, CLASSES)]))


# ---------------------------------------------------------------- B-32
def _blend_sql() -> str:
    mix = [f"(0.2e0 * m1__{c} + 0.8e0 * m2__{c})" for c in CLASSES]
    tot = "(" + " + ".join(mix) + ")"
    p = [f"({x} / {tot})" for x in mix]
    n = _norm_sql(p)
    base = _argmax_sql(n)
    sgo = f"({n[2]} / greatest({n[0]} + {n[2]}, 1e-12))"
    staged = f"(CASE WHEN {n[1]} >= 0.305 THEN 'QSO' WHEN {sgo} >= 0.185 THEN 'STAR' ELSE 'GALAXY' END)"
    return with_views() + f"SELECT id, CASE WHEN {staged} <> {base} THEN {staged} ELSE {base} END AS class FROM pro"


@register("b32_linear_blend_thresholds", _blend_sql())
def q_linear_blend(spark, sf_dir):
    from prismtab.operators.search import apply_threshold_row

    pro = _pro(spark, sf_dir)
    mix = P.linear_blend([F.col(c) for c in model_cols("m1")], [F.col(c) for c in model_cols("m2")], 0.2)
    pro = pro.select("id", *[x.alias(f"mix__{c}") for x, c in zip(mix, CLASSES)])
    row = {"qso_threshold": 0.305, "star_threshold": 0.185, "replace_threshold": 0.0}
    return apply_threshold_row(pro, [f"mix__{c}" for c in CLASSES], row, out="class").select("id", "class")
