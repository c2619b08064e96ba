"""Registered grid-search queries (I-01..I-05, G-02, G-03, B-23/B-24).

Spark: rank histogram + running sums (no row x grid pairing).
Oracle: the naive form — every row against every grid point — in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from prismtab.constants import CLASSES, DEFAULT_QSO_STEPS, DEFAULT_REPLACE_STEPS, DEFAULT_STAR_STEPS
from prismtab.functions.features import astronomy_features, guard_features_v2
from prismtab.functions.proba import argmax_class
from prismtab.operators import search as S
from prismtab.plans.catalog import register, rounded
from prismtab.plans.common import argmax_sql, model_cols, with_views
from prismtab.sources.fixtures import load_obs, load_pro

QT = S.steps(*DEFAULT_QSO_STEPS)
ST = S.steps(*DEFAULT_STAR_STEPS)
RT = S.steps(*DEFAULT_REPLACE_STEPS)


def _vals(name: str, vals) -> str:
    return f"{name} AS (SELECT * FROM (VALUES " + ", ".join(f"({float(v)!r})" for v in vals) + f") t(v))"


def threshold_results(spark, sf_dir):
    pro = load_pro(spark, sf_dir).where(F.col("split") == "train")
    return S.search_threshold_grid(pro, "class", model_cols("m1"))


X_SQL = """r AS (
  SELECT id, class, greatest(m1__GALAXY, 1e-12) AS g0, greatest(m1__QSO, 1e-12) AS q0, greatest(m1__STAR, 1e-12) AS s0
  FROM pro WHERE split = 'train'
), nrm AS (
  SELECT id, class, g0 / (g0 + q0 + s0) AS pg, q0 / (g0 + q0 + s0) AS pq, s0 / (g0 + q0 + s0) AS ps FROM r
), x AS (
  SELECT id, class, pq,
    CASE WHEN pg >= pq AND pg >= ps THEN 'GALAXY' WHEN pq >= ps THEN 'QSO' ELSE 'STAR' END AS base,
    ps / greatest(pg + ps, 1e-12) AS sgo, pg / greatest(pg + ps, 1e-12) AS ggo
  FROM nrm
)"""

Y_SQL = """y AS (
  SELECT qt, st, rt, class, base, staged,
    CASE WHEN staged <> base AND (CASE staged WHEN 'QSO' THEN pq WHEN 'STAR' THEN sgo ELSE ggo END) >= rt
         THEN staged ELSE base END AS final,
    (staged <> base AND (CASE staged WHEN 'QSO' THEN pq WHEN 'STAR' THEN sgo ELSE ggo END) >= rt) AS replaced
  FROM (
    SELECT q.v AS qt, s.v AS st, rr.v AS rt, x.*,
      CASE WHEN pq >= q.v THEN 'QSO' WHEN sgo >= s.v THEN 'STAR' ELSE 'GALAXY' END AS staged
    FROM x CROSS JOIN qg q CROSS JOIN sg s CROSS JOIN rg rr
  )
)"""


def _bal(pred: str) -> str:
    terms = [
        f"coalesce(sum(CASE WHEN class = '{c}' AND {pred} = '{c}' THEN 1 ELSE 0 END) / "
        f"nullif(sum(CASE WHEN class = '{c}' THEN 1 ELSE 0 END), 0), 0e0)"
        for c in CLASSES
    ]
    return "(" + " + ".join(terms) + ") / 3e0"


_W = "CASE class WHEN 'GALAXY' THEN 1e0 WHEN 'QSO' THEN 3.2e0 WHEN 'STAR' THEN 4.6e0 END"


def _wacc(pred: str) -> str:
    return f"sum(CASE WHEN {pred} = class THEN {_W} ELSE 0e0 END) / sum({_W})"


def _cnt(a: str, b: str, pred: str) -> str:
    return f"sum(CASE WHEN class = '{a}' AND {pred} = '{b}' THEN 1 ELSE 0 END)"


BASE_SQL = f"""bl AS (
  SELECT avg(CASE WHEN base = class THEN 1e0 ELSE 0e0 END) AS acc, {_bal('base')} AS bal, {_wacc('base')} AS wacc,
    sum(CASE WHEN base <> class THEN 1 ELSE 0 END) AS err,
    {_cnt('STAR', 'GALAXY', 'base')} + {_cnt('GALAXY', 'STAR', 'base')} AS swaps
  FROM x
)"""

THRESHOLD_SQL = with_views(X_SQL, _vals("qg", QT), _vals("sg", ST), _vals("rg", RT), Y_SQL, BASE_SQL) + f"""
SELECT qt AS qso_threshold, st AS star_threshold, rt AS replace_threshold,
  round(avg(CASE WHEN final = class THEN 1e0 ELSE 0e0 END), 6) AS accuracy,
  round({_bal('final')}, 6) AS balanced_accuracy,
  round({_wacc('final')}, 6) AS weighted_accuracy,
  CAST(sum(CASE WHEN final <> class THEN 1 ELSE 0 END) AS BIGINT) AS errors,
  round(avg(CASE WHEN final = class THEN 1e0 ELSE 0e0 END) - any_value(bl.acc), 6) AS delta_accuracy,
  round({_bal('final')} - any_value(bl.bal), 6) AS delta_balanced_accuracy,
  round({_wacc('final')} - any_value(bl.wacc), 6) AS delta_weighted_accuracy,
  CAST(sum(CASE WHEN final <> class THEN 1 ELSE 0 END) - any_value(bl.err) AS BIGINT) AS delta_errors,
  CAST({_cnt('STAR', 'GALAXY', 'final')} AS BIGINT) AS star_to_galaxy,
  CAST({_cnt('GALAXY', 'STAR', 'final')} AS BIGINT) AS galaxy_to_star,
  CAST({_cnt('STAR', 'GALAXY', 'final')} + {_cnt('GALAXY', 'STAR', 'final')} AS BIGINT) AS star_galaxy_swaps,
  CAST({_cnt('STAR', 'GALAXY', 'final')} + {_cnt('GALAXY', 'STAR', 'final')} - any_value(bl.swaps) AS BIGINT)
    AS delta_star_galaxy_swaps,
  CAST({_cnt('QSO', 'GALAXY', 'final')} AS BIGINT) AS qso_to_galaxy,
  CAST({_cnt('GALAXY', 'QSO', 'final')} AS BIGINT) AS galaxy_to_qso,
  CAST({_cnt('QSO', 'STAR', 'final')} AS BIGINT) AS qso_to_star,
  CAST({_cnt('STAR', 'QSO', 'final')} AS BIGINT) AS star_to_qso,
  CAST(sum(CASE WHEN replaced THEN 1 ELSE 0 END) AS BIGINT) AS replaced,
  round(avg(CASE WHEN replaced THEN 1e0 ELSE 0e0 END), 6) AS replacement_rate,
  round(avg(CASE WHEN staged = class THEN 1e0 ELSE 0e0 END), 6) AS staged_accuracy_without_replace_threshold,
  round({_bal('staged')}, 6) AS staged_balanced_accuracy_without_replace_threshold,
  CAST(sum(CASE WHEN staged <> base THEN 1 ELSE 0 END) AS BIGINT) AS staged_diff_from_argmax
FROM y CROSS JOIN bl
GROUP BY qt, st, rt"""


@register("i01_threshold_grid_search", THRESHOLD_SQL)
def q_threshold_grid(spark, sf_dir):
    return rounded(threshold_results(spark, sf_dir))


# ---------------------------------------------------------------- G-02
#: unrounded metrics of every grid point; ranks compare them at 12 decimals
RES_SQL = f"""res AS (
  SELECT qt, st, rt, {_wacc('final')} AS wa, {_bal('final')} AS ba, avg(CASE WHEN final = class THEN 1e0 ELSE 0e0 END) AS ac,
    CAST(sum(CASE WHEN final <> class AND class IN ('STAR', 'GALAXY') AND final IN ('STAR', 'GALAXY') THEN 1 ELSE 0 END) AS BIGINT) AS swaps,
    CAST(sum(CASE WHEN replaced THEN 1 ELSE 0 END) AS BIGINT) AS replaced
  FROM y GROUP BY qt, st, rt
)"""
BOARD_SQL = {
    "balanced": "round(ba, 12) DESC, round(ac, 12) DESC, swaps",
    "accuracy": "round(ac, 12) DESC, round(ba, 12) DESC, swaps",
    "weighted": "round(wa, 12) DESC, round(ba, 12) DESC, round(ac, 12) DESC, swaps",
    "swaps": "swaps, round(ba, 12) DESC, round(ac, 12) DESC",
}
LEADER_SQL = with_views(X_SQL, _vals("qg", QT), _vals("sg", ST), _vals("rg", RT), Y_SQL, RES_SQL) + "\nUNION ALL\n".join(
    f"""SELECT * FROM (SELECT '{board}' AS board, CAST(row_number() OVER (ORDER BY {order}, qt, st, rt) AS INT) AS rank, qt AS qso_threshold,
  st AS star_threshold, rt AS replace_threshold, round(wa, 6) AS weighted_accuracy, round(ba, 6) AS balanced_accuracy,
  round(ac, 6) AS accuracy, swaps AS star_galaxy_swaps, replaced FROM res) WHERE rank <= 200"""
    for board, order in BOARD_SQL.items())


@register("g02_threshold_leaderboard", LEADER_SQL)
def q_leaderboard(spark, sf_dir):
    """All four orderings, ranked on the unrounded metrics."""
    from prismtab.session import cut_lineage

    boards = S.leaderboards(cut_lineage(threshold_results(spark, sf_dir)), 200)  # a row per grid point, read by every board
    return rounded(boards).select("board", "rank", "qso_threshold", "star_threshold", "replace_threshold", "weighted_accuracy",
                                  "balanced_accuracy", "accuracy", "star_galaxy_swaps", "replaced")


# ---------------------------------------------------------------- I-04 / B-23
_APPLY_SQL = """a AS (
  SELECT id, class, base, staged,
    CASE WHEN staged <> base AND (CASE staged WHEN 'QSO' THEN pq WHEN 'STAR' THEN sgo ELSE ggo END) >= 0.5 THEN staged
         ELSE base END AS final
  FROM (SELECT *, CASE WHEN pq >= 0.46 THEN 'QSO' WHEN sgo >= 0.38 THEN 'STAR' ELSE 'GALAXY' END AS staged FROM x)
)"""


@register("b23_two_stage_predict", with_views(X_SQL, _APPLY_SQL) + """SELECT id, final AS class, staged AS staged_class,
  (final <> base) AS replaced FROM a""")
def q_two_stage(spark, sf_dir):
    pro = load_pro(spark, sf_dir).where(F.col("split") == "train")
    row = {"qso_threshold": 0.46, "star_threshold": 0.38, "replace_threshold": 0.5}
    out = S.apply_threshold_row(pro, model_cols("m1"), row)
    return out.select("id", "class", "staged_class", "replaced")


@register("i04_materialize_best_threshold", with_views(X_SQL, _vals("qg", QT), _vals("sg", ST), _vals("rg", RT),
                                                        Y_SQL, RES_SQL) + """
, best AS (SELECT * FROM res ORDER BY """ + BOARD_SQL["weighted"] + """, qt, st, rt LIMIT 1),
xt AS (
  SELECT id, pq, sgo, ggo,
    CASE WHEN pg >= pq AND pg >= ps THEN 'GALAXY' WHEN pq >= ps THEN 'QSO' ELSE 'STAR' END AS base
  FROM (SELECT id, g0 / (g0 + q0 + s0) AS pg, q0 / (g0 + q0 + s0) AS pq, s0 / (g0 + q0 + s0) AS ps,
          s0 / (g0 + q0 + s0) / greatest(g0 / (g0 + q0 + s0) + s0 / (g0 + q0 + s0), 1e-12) AS sgo,
          g0 / (g0 + q0 + s0) / greatest(g0 / (g0 + q0 + s0) + s0 / (g0 + q0 + s0), 1e-12) AS ggo
        FROM (SELECT id, greatest(m1__GALAXY, 1e-12) AS g0, greatest(m1__QSO, 1e-12) AS q0,
                     greatest(m1__STAR, 1e-12) AS s0 FROM pro WHERE split = 'test'))
)
SELECT xt.id, CASE WHEN st2 <> base AND (CASE st2 WHEN 'QSO' THEN pq WHEN 'STAR' THEN sgo ELSE ggo END) >= best.rt
  THEN st2 ELSE base END AS class
FROM (SELECT xt.*, CASE WHEN pq >= best.qt THEN 'QSO' WHEN sgo >= best.st THEN 'STAR' ELSE 'GALAXY' END AS st2
      FROM xt CROSS JOIN best) xt CROSS JOIN best""")
def q_materialize_threshold(spark, sf_dir):
    """I-04: pick the best weighted row on train, apply it to the test split.
    The chosen row (one row of a parameter-sized table) is read on the driver."""
    res = threshold_results(spark, sf_dir)
    best = S.best_row(res, "weighted").first().asDict()
    test = load_pro(spark, sf_dir).where(F.col("split") == "test")
    out = S.apply_threshold_row(test, model_cols("m1"), best, out="pred")
    return out.select("id", F.col("pred").alias("class"))


# ---------------------------------------------------------------- I-02 / G-03 / I-03
GUARD_GRIDS = S.GUARD_DEFAULTS


def guard_frame(spark, sf_dir):
    obs = guard_features_v2(astronomy_features(load_obs(spark, sf_dir).where(F.col("split") == "train")))
    obs = obs.select("id", "redshift_abs", "compact_color_rms", "mag_std", "is_blue_cloud")
    pro = load_pro(spark, sf_dir).where(F.col("split") == "train")
    preds = pro.select(
        "id",
        "class",
        argmax_class(model_cols("m1")).alias("base_pred"),
        argmax_class(model_cols("m2")).alias("other_pred"),
        (F.col("m3__GALAXY") / (F.col("m3__GALAXY") + F.col("m3__STAR"))).alias("p_galaxy"),
    )
    return obs.join(preds, "id")


GF_SQL = """gf AS (
  SELECT o.id, p.class, abs(o.redshift) AS za,
    sqrt(((o.u-o.g)*(o.u-o.g) + (o.g-o.r)*(o.g-o.r) + (o.r-o.i)*(o.r-o.i) + (o.i-o.z)*(o.i-o.z))/4) AS rms,
    sqrt(((o.u-mm)*(o.u-mm) + (o.g-mm)*(o.g-mm) + (o.r-mm)*(o.r-mm) + (o.i-mm)*(o.i-mm) + (o.z-mm)*(o.z-mm))/4) AS mstd,
    o.galaxy_population = 'Blue_Cloud' AS blue,
    """ + argmax_sql("m1").replace("m1__", "p.m1__") + """ AS base,
    """ + argmax_sql("m2").replace("m2__", "p.m2__") + """ AS other,
    p.m3__GALAXY / (p.m3__GALAXY + p.m3__STAR) AS pgal
  FROM (SELECT *, (u+g+r+i+z)/5 AS mm FROM obs WHERE split = 'train') o JOIN pro p USING (id)
)"""

GUARD_SQL = with_views(
    GF_SQL,
    _vals("pg_", GUARD_GRIDS["p_galaxy_threshold"]),
    _vals("zg", GUARD_GRIDS["redshift_abs_max"]),
    _vals("cg", GUARD_GRIDS["compact_color_score_max"]),
    _vals("mg", GUARD_GRIDS["mag_std_max"]),
    "bg AS (SELECT * FROM (VALUES (false), (true)) t(v))",
    f"""bl AS (
  SELECT count(*) AS n, sum(CASE WHEN base = class THEN 1 ELSE 0 END) AS ok, sum({_W}) AS w,
    sum(CASE WHEN base = class THEN {_W} ELSE 0e0 END) AS wok,
    {_cnt('STAR', 'GALAXY', 'base')} AS s2g, {_cnt('QSO', 'GALAXY', 'base')} AS q2g,
    {_cnt('GALAXY', 'STAR', 'base')} AS g2s, {_cnt('GALAXY', 'QSO', 'base')} AS g2q
  FROM gf
), ch AS (
  SELECT p.v AS pt, z.v AS zt, c.v AS ct, m.v AS mt, b.v AS bt, gf.*
  FROM gf CROSS JOIN pg_ p CROSS JOIN zg z CROSS JOIN cg c CROSS JOIN mg m CROSS JOIN bg b
  WHERE gf.base IN ('STAR', 'QSO') AND gf.pgal >= p.v AND gf.za <= z.v AND gf.rms <= c.v AND gf.mstd <= m.v
    AND (NOT b.v OR gf.blue)
), agg AS (
  SELECT pt, zt, ct, mt, bt, count(*) AS changed,
    sum(CASE WHEN class = 'GALAXY' THEN 1 WHEN base = class THEN -1 ELSE 0 END) AS dc,
    sum(CASE WHEN class = 'GALAXY' THEN {_W} WHEN base = class THEN -{_W} ELSE 0e0 END) AS dw,
    sum(CASE WHEN class = 'GALAXY' THEN 1 ELSE 0 END) AS chg, sum(CASE WHEN class = 'QSO' THEN 1 ELSE 0 END) AS chq,
    sum(CASE WHEN class = 'STAR' THEN 1 ELSE 0 END) AS chs,
    sum(CASE WHEN class <> 'GALAXY' AND base = class THEN 1 ELSE 0 END) AS inj,
    sum(CASE WHEN class <> 'GALAXY' AND other = class AND base <> class THEN 1 ELSE 0 END) AS inj_o,
    sum(CASE WHEN class = 'GALAXY' AND other = class AND base <> class THEN 1 ELSE 0 END) AS rec_o,
    sum(CASE WHEN class = 'GALAXY' AND base = 'STAR' THEN 1 ELSE 0 END) AS gfs,
    sum(CASE WHEN class = 'GALAXY' AND base = 'QSO' THEN 1 ELSE 0 END) AS gfq
  FROM ch GROUP BY ALL
), grid AS (
  SELECT p.v AS pt, z.v AS zt, c.v AS ct, m.v AS mt, b.v AS bt
  FROM pg_ p CROSS JOIN zg z CROSS JOIN cg c CROSS JOIN mg m CROSS JOIN bg b
), full_ AS (
  SELECT g.*, coalesce(changed, 0) AS changed, coalesce(dc, 0) AS dc, coalesce(dw, 0e0) AS dw,
    coalesce(chg, 0) AS chg, coalesce(chq, 0) AS chq, coalesce(chs, 0) AS chs, coalesce(inj, 0) AS inj,
    coalesce(inj_o, 0) AS inj_o, coalesce(rec_o, 0) AS rec_o, coalesce(gfs, 0) AS gfs, coalesce(gfq, 0) AS gfq
  FROM grid g LEFT JOIN agg a USING (pt, zt, ct, mt, bt)
)""",
) + """SELECT pt AS p_galaxy_threshold, zt AS redshift_abs_max, ct AS compact_color_score_max, mt AS mag_std_max,
  bt AS blue_cloud_required,
  round((wok + dw) / w, 6) AS weighted_accuracy, round((ok + dc) / n, 6) AS accuracy,
  CAST(n - ok - dc AS BIGINT) AS errors, round((wok + dw) / w - wok / w, 6) AS delta_weighted_accuracy,
  round((ok + dc) / n - ok / n, 6) AS delta_accuracy, CAST(-dc AS BIGINT) AS delta_errors,
  round((wok + dw) / w - 2e0 * inj_o / greatest(n, 1) + 0.25e0 * rec_o / greatest(n, 1), 6) AS guard_objective,
  CAST(changed AS BIGINT) AS changed_to_galaxy, round(changed / n, 6) AS changed_rate,
  CAST(chg AS BIGINT) AS recovered_to_galaxy, CAST(inj AS BIGINT) AS injured_base_correct,
  CAST(inj_o AS BIGINT) AS injured_other_only_correct, CAST(rec_o AS BIGINT) AS recovered_other_only_correct_true_galaxy,
  CAST(chg AS BIGINT) AS changed_true_galaxy, CAST(chq AS BIGINT) AS changed_true_qso,
  CAST(chs AS BIGINT) AS changed_true_star, CAST(s2g + chs AS BIGINT) AS star_to_galaxy,
  CAST(q2g + chq AS BIGINT) AS qso_to_galaxy, CAST(g2s - gfs AS BIGINT) AS galaxy_to_star,
  CAST(g2q - gfq AS BIGINT) AS galaxy_to_qso
FROM full_ CROSS JOIN bl"""


def guard_results(spark, sf_dir):
    df = guard_frame(spark, sf_dir)
    return S.search_guard_grid(df, "class", "base_pred", "other_pred", "p_galaxy")


@register("i02_guard_grid_search", GUARD_SQL)
def q_guard_grid(spark, sf_dir):
    return rounded(guard_results(spark, sf_dir))


#: the order of the guard search: weighted accuracy, injuries, recoveries, objective, changes
GUARD_BOARD = """, bd AS (
  SELECT *, (wok + dw) / w AS wa, (wok + dw) / w - 2e0 * inj_o / greatest(n, 1) + 0.25e0 * rec_o / greatest(n, 1) AS obj,
    row_number() OVER (ORDER BY round((wok + dw) / w, 12) DESC, inj_o, rec_o DESC,
      round((wok + dw) / w - 2e0 * inj_o / greatest(n, 1) + 0.25e0 * rec_o / greatest(n, 1), 12) DESC, changed, pt, zt, ct, mt, bt) AS rank
  FROM full_ CROSS JOIN bl
) SELECT CAST(rank AS INT) AS rank, """


@register("g03_guard_leaderboard", GUARD_SQL.replace("SELECT pt AS p_galaxy_threshold", GUARD_BOARD + "pt AS p_galaxy_threshold", 1)[: -len("FROM full_ CROSS JOIN bl")] + "FROM bd WHERE rank <= 300")
def q_guard_leaderboard(spark, sf_dir):
    from pyspark.sql import Window

    res = guard_results(spark, sf_dir)
    order = Window.orderBy(*S.order_cols(S.GUARD_ORDER + S.GUARD_KEYS, res))
    return rounded(S.guard_leaderboard(res, 300).select(F.row_number().over(order).alias("rank"), "*"))


@register("i03_apply_guard", with_views(GF_SQL) + """SELECT id,
  CASE WHEN base IN ('STAR', 'QSO') AND za <= 0.144 AND rms <= 1.3 AND mstd <= 0.75 AND blue AND pgal >= 0.6
       THEN 'GALAXY' ELSE base END AS class
FROM gf""")
def q_apply_guard(spark, sf_dir):
    row = {"p_galaxy_threshold": 0.6, "redshift_abs_max": 0.144, "compact_color_score_max": 1.3,
           "mag_std_max": 0.75, "blue_cloud_required": True}
    return S.apply_guard(guard_frame(spark, sf_dir), "base_pred", "p_galaxy", row).select("id", "class")
