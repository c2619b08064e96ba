"""Classification metrics as aggregates (E-01..E-06, E-10, E-11, E-17..E-22,
E-27, E-28).

Design: every metric is one or two small aggregations.  Row-level work is a
projection feeding a map-side partial aggregate, so the shuffle carries at
most (classes x classes x slices) cells per candidate regardless of the row
count.  Nothing is collected to the driver.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prismtab.constants import CLASSES, DEFAULT_CLASS_WEIGHTS, LOGLOSS_EPS
from prismtab.operators.checks import in_domain
from prismtab.operators.ranking import range_id, range_splits


def weight_of(label: Column, weights: dict[str, float], default: float | None = None) -> Column:
    """J-05: class → weight lookup as a literal map (stays in codegen)."""
    m = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))])
    w = F.element_at(m, label) if default is None else F.coalesce(F.element_at(m, label), F.lit(float(default)))
    return w


def _class_grid(spark: SparkSession, classes, names=("true_class", "pred_class")) -> DataFrame:
    rows = [(a, b) for a in classes for b in classes]
    return spark.createDataFrame(rows, T.StructType([T.StructField(n, T.StringType(), False) for n in names]))


# ---------------------------------------------------------------- E-01
def confusion(df: DataFrame, truth: str, pred: str, classes=CLASSES, by=()) -> DataFrame:
    """Dense confusion counts (zero-filled) per ``by`` group; a NULL or unknown class is an error."""
    cells = df.groupBy(*by, in_domain(F.col(truth), truth, classes).alias("true_class"),
                       in_domain(F.col(pred), pred, classes).alias("pred_class")).agg(F.count(F.lit(1)).alias("n"))
    if by:
        # zero-fill grid: every present group x every (true, pred) class pair,
        # generated per group row (no join)
        pairs = F.array(*[F.struct(F.lit(a).alias("true_class"), F.lit(b).alias("pred_class"))
                          for a in classes for b in classes])
        grid = cells.select(*by).distinct().select(*by, F.inline(pairs))
    else:
        grid = F.broadcast(_class_grid(df.sparkSession, classes))
    keys = [*by, "true_class", "pred_class"]
    return grid.join(cells, keys, "left").select(*keys, F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))


# ---------------------------------------------------------------- E-02
FLOW_NAMES = [
    ("STAR", "GALAXY", "star_to_galaxy"),
    ("GALAXY", "STAR", "galaxy_to_star"),
    ("QSO", "GALAXY", "qso_to_galaxy"),
    ("GALAXY", "QSO", "galaxy_to_qso"),
    ("QSO", "STAR", "qso_to_star"),
    ("STAR", "QSO", "star_to_qso"),
]


def metrics_from_cells(cells: DataFrame, by=(), weights=None, classes=CLASSES, absent: str = "zero",
                       truth: str = "true_class", pred: str = "pred_class", n: str = "n",
                       extra_aggs=(), extra_cols=()) -> DataFrame:
    """E-02: accuracy, balanced/weighted accuracy, errors and the six directed
    flows from (truth, pred, n) cells.  ``absent='zero'`` divides the recall
    sum by the number of classes; ``'skip'`` averages present classes only."""
    weights = weights or DEFAULT_CLASS_WEIGHTS
    t, p, cnt = F.col(truth), F.col(pred), F.col(n)
    ok = t == p
    w = weight_of(t, weights, default=1.0)
    agg = [
        F.sum(cnt).alias("_n"),
        F.sum(F.when(ok, cnt).otherwise(0)).alias("_ok"),
        F.sum(w * cnt).alias("_wn"),
        F.sum(F.when(ok, w * cnt).otherwise(0.0)).alias("_wok"),
    ]
    for c in classes:
        agg.append(F.sum(F.when(t == c, cnt).otherwise(0)).alias(f"_sup_{c}"))
        agg.append(F.sum(F.when((t == c) & ok, cnt).otherwise(0)).alias(f"_tp_{c}"))
    for a, b, name in FLOW_NAMES:
        agg.append(F.sum(F.when((t == a) & (p == b), cnt).otherwise(0)).cast("bigint").alias(name))
    g = cells.groupBy(*by).agg(*agg, *extra_aggs)
    recalls = [F.when(F.col(f"_sup_{c}") > 0, F.col(f"_tp_{c}") / F.col(f"_sup_{c}")) for c in classes]
    present = [F.when(F.col(f"_sup_{c}") > 0, 1).otherwise(0) for c in classes]
    rec_sum = sum((F.coalesce(r, F.lit(0.0)) for r in recalls[1:]), F.coalesce(recalls[0], F.lit(0.0)))
    n_present = sum(present[1:], present[0])
    if absent == "zero":
        bal = rec_sum / F.lit(float(len(classes)))
    else:
        bal = F.when(n_present > 0, rec_sum / n_present)
    return g.select(
        *by,
        F.col("_n").cast("bigint").alias("n"),
        (F.col("_ok") / F.col("_n")).alias("accuracy"),
        bal.alias("balanced_accuracy"),
        F.when(F.col("_wn") > 0, F.col("_wok") / F.col("_wn")).otherwise(F.lit(0.0)).alias("weighted_accuracy"),
        (F.col("_n") - F.col("_ok")).cast("bigint").alias("errors"),
        *[F.col(name) for _, _, name in FLOW_NAMES],
        (F.col("star_to_galaxy") + F.col("galaxy_to_star")).alias("star_galaxy_swaps"),
        *extra_cols,
    )


def prediction_metrics(df: DataFrame, truth: str, pred: str, by=(), weights=None, classes=CLASSES,
                       absent: str = "zero") -> DataFrame:
    """E-03: metrics straight from a prediction table (cells built map-side)."""
    cells = df.groupBy(*by, F.col(truth).alias("true_class"), F.col(pred).alias("pred_class")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return metrics_from_cells(cells, by=by, weights=weights, classes=classes, absent=absent)


# ---------------------------------------------------------------- E-04
def per_class_metrics(df: DataFrame, truth: str, pred: str, by=(), classes=CLASSES) -> DataFrame:
    """E-04: recall, precision, pred_count, fn, fp per class (0 when empty)."""
    t, p = F.col(truth), F.col(pred)
    agg = []
    for c in classes:
        agg += [
            F.sum(F.when(t == c, 1).otherwise(0)).alias(f"_sup_{c}"),
            F.sum(F.when(p == c, 1).otherwise(0)).cast("bigint").alias(f"pred_count_{c}"),
            F.sum(F.when((t == c) & (p == c), 1).otherwise(0)).alias(f"_tp_{c}"),
            F.sum(F.when((t != c) & (p == c), 1).otherwise(0)).cast("bigint").alias(f"fp_{c}"),
            F.sum(F.when((t == c) & (p != c), 1).otherwise(0)).cast("bigint").alias(f"fn_{c}"),
        ]
    g = df.groupBy(*by).agg(*agg)
    out = list(by)
    for c in classes:
        out += [
            F.when(F.col(f"_sup_{c}") > 0, F.col(f"_tp_{c}") / F.col(f"_sup_{c}")).otherwise(0.0).alias(f"recall_{c}"),
            F.when(F.col(f"pred_count_{c}") > 0, F.col(f"_tp_{c}") / F.col(f"pred_count_{c}"))
            .otherwise(0.0)
            .alias(f"precision_{c}"),
            F.col(f"pred_count_{c}"),
            F.col(f"fn_{c}"),
            F.col(f"fp_{c}"),
        ]
    return g.select(*out)


# ---------------------------------------------------------------- E-05
def true_class_probability(truth: Column, prob_cols: list[str], classes=CLASSES) -> Column:
    expr = F.when(truth == classes[0], F.col(prob_cols[0]))
    for c, pc in zip(classes[1:], prob_cols[1:]):
        expr = expr.when(truth == c, F.col(pc))
    return expr


def row_log_loss(truth: str, prob_cols: list[str], classes=CLASSES, eps: float = LOGLOSS_EPS,
                 normalize_rows: bool = True) -> Column:
    """-ln(clip(p_true)) of a row, renormalised first like sklearn."""
    ps = [F.col(c) for c in prob_cols]
    if normalize_rows:
        tot = sum(ps[1:], ps[0])
        ps = [p / tot for p in ps]
    pt = F.when(F.col(truth) == classes[0], ps[0])
    for c, p in zip(classes[1:], ps[1:]):
        pt = pt.when(F.col(truth) == c, p)
    return -F.ln(F.least(F.greatest(pt, F.lit(eps)), F.lit(1.0 - eps)))


def log_loss(df: DataFrame, truth: str, prob_cols: list[str], by=(), classes=CLASSES, eps: float = LOGLOSS_EPS,
             normalize_rows: bool = True) -> DataFrame:
    """E-05: mean of -ln(clip(p_true)); rows renormalised first like sklearn."""
    return df.groupBy(*by).agg(F.avg(row_log_loss(truth, prob_cols, classes, eps, normalize_rows)).alias("log_loss"))


# ---------------------------------------------------------------- E-06
def binary_metrics(df: DataFrame, label: str, prob: str, by=(), eps: float = LOGLOSS_EPS) -> DataFrame:
    """E-06: binary log loss, accuracy at 0.5, positive rate."""
    y = F.col(label).cast("double")
    p = F.least(F.greatest(F.col(prob), F.lit(eps)), F.lit(1.0 - eps))
    ll = -(y * F.ln(p) + (F.lit(1.0) - y) * F.ln(F.lit(1.0) - p))
    pred = F.when(F.col(prob) >= 0.5, 1.0).otherwise(0.0)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(ll).alias("log_loss"),
        F.avg(F.when(pred == y, 1.0).otherwise(0.0)).alias("accuracy_at_050"),
        F.avg(y).alias("positive_rate"),
    )


# ---------------------------------------------------------------- E-27
def roc_auc(df: DataFrame, label: str, score: str, by=(), partitions: int | None = None) -> DataFrame:
    """E-27: exact ROC AUC via the Mann-Whitney statistic with tie-averaged ranks.

    Rows are first aggregated to distinct (group, score) values with positive
    and negative counts; AUC = sum over values of pos(v) * (neg below v +
    neg(v)/2) / (P*N).  "neg below v" is a running sum computed without a
    per-group window over all scores: the distinct values are
    cut into ranges of (group, score) at literal split points, summed inside each range, and
    offset by the negatives of earlier ranges of the same group (a table
    of at most ranges + groups rows)."""
    from pyspark.sql import Window as W

    by = list(by)
    y = F.col(label).cast("int")
    vals = df.groupBy(*by, F.col(score).alias("_s")).agg(
        F.sum(y).alias("_pos"), F.sum(F.lit(1) - y).alias("_neg")
    )
    # split points from the raw rows' keys; a range is a pure function of (group, score)
    keys = df.select(*by, F.col(score).alias("_s"))
    order = [*by, "_s"]
    ranged = vals.withColumn("_rid", range_id(vals, order, range_splits(keys, order, partitions)))
    part = ranged.groupBy("_rid", *by).agg(F.sum("_neg").alias("_pn"))
    w_off = W.partitionBy(*by).orderBy("_rid").rowsBetween(W.unboundedPreceding, -1) if by else \
        W.orderBy("_rid").rowsBetween(W.unboundedPreceding, -1)
    offs = part.select("_rid", *by, F.coalesce(F.sum("_pn").over(w_off), F.lit(0)).alias("_off"))
    offs = offs.select("_rid", "_off", *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)])
    w_in = W.partitionBy("_rid", *by).orderBy("_s").rowsBetween(W.unboundedPreceding, -1)
    same = ranged["_rid"] == offs["_rid"]
    for i, c in enumerate(by):
        same = same & ranged[c].eqNullSafe(offs[f"_by{i}"])
    # offsets: ranges x groups rows, and a range holds few groups
    below = (ranged.join(F.broadcast(offs), same).drop(offs["_rid"])
             .withColumn("_neg_below", F.coalesce(F.sum("_neg").over(w_in), F.lit(0)) + F.col("_off")))
    g = below.groupBy(*by).agg(
        F.sum(F.col("_pos") * (F.col("_neg_below") + F.col("_neg") / 2.0)).alias("_u"),
        F.sum("_pos").alias("_P"),
        F.sum("_neg").alias("_N"),
    )
    return g.select(
        *by,
        F.when((F.col("_P") > 0) & (F.col("_N") > 0), F.col("_u") / (F.col("_P") * F.col("_N"))).alias("roc_auc"),
    )


# ---------------------------------------------------------------- E-10/E-11
def slice_names(base_names) -> list[tuple[str, tuple[str, ...]]]:
    """C-04: ``ALL`` + every non-empty AND-combination in list order."""
    out = [("ALL", ())]
    for size in range(1, len(base_names) + 1):
        for combo in combinations(base_names, size):
            out.append(("&".join(combo), combo))
    return out


def _long_predictions(df: DataFrame, truth: str, candidates: dict[str, str], keep) -> DataFrame:
    """Wide candidate columns → (candidate, pred) rows (an Expand, no shuffle)."""
    if len(candidates) == 1:
        (name, colname), = candidates.items()
        return df.select(*keep, F.col(truth).alias("true_class"), F.lit(name).alias("candidate"),
                         F.col(colname).alias("pred_class"))
    arr = F.array(*[F.struct(F.lit(n).alias("candidate"), F.col(c).alias("pred_class")) for n, c in candidates.items()])
    return df.select(*keep, F.col(truth).alias("true_class"), F.inline(arr))


def _slice_cells(df: DataFrame, truth: str, candidates: dict[str, str], masks: dict[str, Column], weights,
                 extra_keys=("pred_class",)) -> DataFrame:
    """Map-side aggregation to (candidate, mask bits, truth, pred) cells, then
    grouping sets over the mask columns.  Each output row is one slice's cell:
    a slice keeps rows whose mask columns in the set are all true."""
    names = list(masks)
    flag_cols = [f"_m{j}" for j in range(len(names))]
    base = df.select(
        F.col(truth).alias("_truth"),
        *[F.col(c).alias(f"_cand_{j}") for j, c in enumerate(candidates.values())],
        *[F.coalesce(m, F.lit(False)).alias(f) for f, m in zip(flag_cols, masks.values())],
    )
    cand_map = {n: f"_cand_{j}" for j, n in enumerate(candidates)}
    long = _long_predictions(base, "_truth", cand_map, keep=flag_cols)
    cells = long.groupBy("candidate", "true_class", *extra_keys, *flag_cols).agg(F.count(F.lit(1)).alias("n"))
    sets = []
    for size in range(0, len(flag_cols) + 1):
        for combo in combinations(flag_cols, size):
            sets.append(["candidate", "true_class", *extra_keys, *combo])
    grouping_cols = ["candidate", "true_class", *extra_keys, *flag_cols]
    rolled = cells.groupingSets(sets, *grouping_cols).agg(
        F.sum("n").alias("n"), *[F.grouping(f).alias(f"_g{j}") for j, f in enumerate(flag_cols)]
    )
    keep = None
    for j, f in enumerate(flag_cols):
        cond = (F.col(f"_g{j}") == 1) | F.col(f)
        keep = cond if keep is None else keep & cond
    slice_name = F.concat_ws("&", *[F.when(F.col(f"_g{j}") == 0, F.lit(n)) for j, n in enumerate(names)])
    return rolled.where(keep).select(
        "candidate",
        F.when(slice_name == "", F.lit("ALL")).otherwise(slice_name).alias("slice"),
        "true_class",
        *extra_keys,
        "n",
    )


def slice_metrics(df: DataFrame, truth: str, candidates: dict[str, str], masks: dict[str, Column],
                  weights=None, classes=CLASSES, absent: str = "skip", include_empty: bool = True) -> DataFrame:
    """E-11: metrics of every candidate over the AND-lattice of slice masks.

    ``candidates`` maps candidate name → prediction column of ``df``;
    ``masks`` maps base mask name → boolean Column (NULL counts as false).
    Output: candidate, slice, n, accuracy, balanced_accuracy,
    weighted_accuracy, errors, weighted_errors.

    Plan: one partial aggregate to (candidate, truth, prediction, mask bits)
    cells, then one grouping-sets aggregate over the mask bits with
    class-conditional sums, which yields each slice's metrics directly.  A
    zero-count cell with every mask true per candidate makes empty slices
    appear (n = 0) without a join against a slice grid."""
    weights = weights or DEFAULT_CLASS_WEIGHTS
    names = list(masks)
    flag_cols = [f"_m{j}" for j in range(len(names))]
    base = df.select(
        F.col(truth).alias("_truth"),
        *[F.col(c).alias(f"_cand_{j}") for j, c in enumerate(candidates.values())],
        *[F.coalesce(m, F.lit(False)).alias(f) for f, m in zip(flag_cols, masks.values())],
    )
    long = _long_predictions(base, "_truth", {n: f"_cand_{j}" for j, n in enumerate(candidates)}, keep=flag_cols)
    cells = long.groupBy("candidate", "true_class", "pred_class", *flag_cols).agg(F.count(F.lit(1)).alias("n"))
    if include_empty:
        schema = "candidate string, true_class string, pred_class string, " + ", ".join(
            f"{f} boolean" for f in flag_cols) + ", n bigint"
        dummy = df.sparkSession.createDataFrame(
            [(c, None, None, *([True] * len(flag_cols)), 0) for c in candidates], schema)
        cells = cells.unionByName(dummy)
    t, p, n = F.col("true_class"), F.col("pred_class"), F.col("n")
    aggs = [F.sum(n).alias("_n"), F.sum(F.when(t == p, n).otherwise(0)).alias("_ok")]
    for c in classes:
        aggs.append(F.sum(F.when(t == c, n).otherwise(0)).alias(f"_sup_{c}"))
        aggs.append(F.sum(F.when((t == c) & (p == c), n).otherwise(0)).alias(f"_tp_{c}"))
    aggs += [F.grouping(f).alias(f"_g{j}") for j, f in enumerate(flag_cols)]
    sets = [["candidate", *combo] for size in range(len(flag_cols) + 1) for combo in combinations(flag_cols, size)]
    rolled = cells.groupingSets(sets, "candidate", *flag_cols).agg(*aggs)
    keep = None
    for j, f in enumerate(flag_cols):
        cond = (F.col(f"_g{j}") == 1) | F.col(f)
        keep = cond if keep is None else keep & cond
    sname = F.concat_ws("&", *[F.when(F.col(f"_g{j}") == 0, F.lit(nm)) for j, nm in enumerate(names)])
    col = F.col
    wn = sum((F.lit(float(weights.get(c, 0.0))) * col(f"_sup_{c}") for c in classes[1:]),
             F.lit(float(weights.get(classes[0], 0.0))) * col(f"_sup_{classes[0]}"))
    wok = sum((F.lit(float(weights.get(c, 0.0))) * col(f"_tp_{c}") for c in classes[1:]),
              F.lit(float(weights.get(classes[0], 0.0))) * col(f"_tp_{classes[0]}"))
    rec = [F.when(col(f"_sup_{c}") > 0, col(f"_tp_{c}") / col(f"_sup_{c}")) for c in classes]
    present = sum((F.when(col(f"_sup_{c}") > 0, 1).otherwise(0) for c in classes[1:]),
                  F.when(col(f"_sup_{classes[0]}") > 0, 1).otherwise(0))
    rsum = sum((F.coalesce(r, F.lit(0.0)) for r in rec[1:]), F.coalesce(rec[0], F.lit(0.0)))
    if absent == "skip":
        bal = F.when(present > 0, rsum / present)
    else:
        bal = F.when(col("_n") > 0, rsum / F.lit(float(len(classes))))
    return rolled.where(keep).select(
        "candidate",
        F.when(sname == "", F.lit("ALL")).otherwise(sname).alias("slice"),
        col("_n").cast("bigint").alias("n"),
        F.when(col("_n") > 0, col("_ok") / col("_n")).alias("accuracy"),
        bal.alias("balanced_accuracy"),
        F.when(wn != 0, wok / wn).alias("weighted_accuracy"),
        (col("_n") - col("_ok")).cast("bigint").alias("errors"),
        (wn - wok).alias("weighted_errors"),
    )


def slice_error_flows(df: DataFrame, truth: str, candidates: dict[str, str], masks: dict[str, Column],
                      weights=None) -> DataFrame:
    """E-10: per candidate x slice x (true, pred): n, errors, weighted_n, weighted_errors."""
    weights = weights or DEFAULT_CLASS_WEIGHTS
    cells = _slice_cells(df, truth, candidates, masks, weights)
    t, p = F.col("true_class"), F.col("pred_class")
    w = weight_of(t, weights, default=0.0)
    return cells.select(
        "candidate",
        "slice",
        "true_class",
        "pred_class",
        F.col("n").cast("bigint").alias("n"),
        F.when(t != p, F.col("n")).otherwise(0).cast("bigint").alias("errors"),
        (w * F.col("n")).alias("weighted_n"),
        F.when(t != p, w * F.col("n")).otherwise(0.0).alias("weighted_errors"),
    )


def slice_disagreement(df: DataFrame, pairs: dict[tuple[str, str], tuple[str, str]], masks: dict[str, Column]) -> DataFrame:
    """E-18: candidate vs reference disagreement count/rate per slice.

    ``pairs`` maps (candidate_name, reference_name) → (candidate_col, reference_col).
    One partial aggregate to (pair, mask bits) cells, one grouping-sets
    aggregate over the bits; a zero-count all-true cell per pair makes empty
    slices appear without a join."""
    names = list(masks)
    flag_cols = [f"_m{j}" for j in range(len(names))]
    arr = F.array(
        *[
            F.struct(F.lit(cn).alias("candidate"), F.lit(rn).alias("reference"),
                     (~F.col(cc).eqNullSafe(F.col(rc))).cast("int").alias("_ne"))
            for (cn, rn), (cc, rc) in pairs.items()
        ]
    )
    base = df.select(*[F.coalesce(m, F.lit(False)).alias(f) for f, m in zip(flag_cols, masks.values())], F.inline(arr))
    cells = base.groupBy("candidate", "reference", *flag_cols).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_ne").cast("bigint").alias("d")
    )
    schema = "candidate string, reference string, " + ", ".join(f"{f} boolean" for f in flag_cols) + \
        ", n bigint, d bigint"
    dummy = df.sparkSession.createDataFrame([(cn, rn, *([True] * len(flag_cols)), 0, 0) for cn, rn in pairs], schema)
    cells = cells.unionByName(dummy)
    sets = [["candidate", "reference", *combo] for size in range(len(flag_cols) + 1)
            for combo in combinations(flag_cols, size)]
    rolled = cells.groupingSets(sets, "candidate", "reference", *flag_cols).agg(
        F.sum("n").alias("n"), F.sum("d").alias("d"), *[F.grouping(f).alias(f"_g{j}") for j, f in enumerate(flag_cols)]
    )
    keep = None
    for j, f in enumerate(flag_cols):
        cond = (F.col(f"_g{j}") == 1) | F.col(f)
        keep = cond if keep is None else keep & cond
    sname = F.concat_ws("&", *[F.when(F.col(f"_g{j}") == 0, F.lit(n)) for j, n in enumerate(names)])
    return rolled.where(keep).select(
        "candidate",
        "reference",
        F.when(sname == "", "ALL").otherwise(sname).alias("slice"),
        F.col("n").cast("bigint").alias("n"),
        F.col("d").cast("bigint").alias("disagreements"),
        F.when(F.col("n") > 0, F.col("d") / F.col("n")).alias("disagreement_rate"),
        F.when(F.col("n") > 0, F.lit(1.0) - F.col("d") / F.col("n")).alias("agreement_rate"),
    )


# ---------------------------------------------------------------- E-17
def class_distribution(df: DataFrame, pred: str, by=(), classes=CLASSES) -> DataFrame:
    """E-17: n and rate per class, zero-filled to the class list."""
    spark = df.sparkSession
    counts = df.groupBy(*by, F.col(pred).alias("class")).agg(F.count(F.lit(1)).alias("_c"))
    cls = spark.createDataFrame([(c,) for c in classes], "class string")
    if by:
        grid = counts.select(*by).distinct().select(*by, F.explode(F.array(*[F.lit(c) for c in classes])).alias("class"))
    else:
        grid = F.broadcast(cls)
    keys = [*by, "class"]
    joined = grid.join(counts, keys, "left").select(*keys, F.coalesce(F.col("_c"), F.lit(0)).cast("bigint").alias("n"))
    tot = counts.where(F.col("class").isin(*classes)).groupBy(*by).agg(F.sum("_c").alias("_tot"))
    if by:
        joined = joined.join(tot, list(by), "left")
    else:
        joined = joined.withColumn("_tot", tot.select("_tot").scalar())
    return joined.select(*keys, "n", F.when(F.col("_tot") > 0, F.col("n") / F.col("_tot")).alias("rate"))


# ---------------------------------------------------------------- E-19
def crosstab(df: DataFrame, reference: str, candidate: str, classes=CLASSES, by=()) -> DataFrame:
    """E-19: zero-filled reference x candidate class counts."""
    c = confusion(df, reference, candidate, classes, by=by)
    return c.select(*by, F.col("true_class").alias("reference_class"), F.col("pred_class").alias("candidate_class"), "n")


# ---------------------------------------------------------------- E-20/E-21
#: models of one block of a cross-product matrix
GRAM_BLOCK = 64


SUMS = ("n", "xy", "sx", "sy", "sxx", "syy")


def cross_sums(df: DataFrame, positions: list[list[str]], shift: float = 0.0) -> DataFrame:
    """a, b, n, xy, sx, sy, sxx, syy for all models a <= b, over all rows and positions where both have a value.

    ``positions``: for each position one numeric column per model; ``shift`` is taken off all values.
    A task multiplies whole Arrow batches, keeps matrices of models x models, and gives them out in blocks of
    ``GRAM_BLOCK`` models a side; Spark adds the blocks up entry by entry."""
    n = len(positions[0])
    columns = list(dict.fromkeys(c for group in positions for c in group))
    places = [[columns.index(c) for c in group] for group in positions]

    def run(frames):
        import numpy as np
        import pyarrow as pa

        total = {name: np.zeros((n, n)) for name in SUMS}
        for batch in frames:
            if not batch.num_rows:
                continue
            table = np.stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in batch.columns], 1) - shift
            for at in places:
                x = table[:, at]
                gap = np.isnan(x)
                if gap.any():
                    own = (~gap).astype(float)
                    x = np.where(gap, 0.0, x)
                    parts = own.T @ own, x.T @ x, x.T @ own, own.T @ x, (x * x).T @ own, own.T @ (x * x)
                else:
                    one, two = x.sum(0), (x * x).sum(0)
                    parts = float(len(x)), x.T @ x, one[:, None], one[None, :], two[:, None], two[None, :]
                for name, part in zip(SUMS, parts):
                    total[name] += part
        for i in range(0, n, GRAM_BLOCK):
            for j in range(i, n, GRAM_BLOCK):
                block = (slice(i, i + GRAM_BLOCK), slice(j, j + GRAM_BLOCK))
                a, b = (x.ravel() + at for x, at in zip(np.indices(total["n"][block].shape), (i, j)))
                keep = a <= b
                values = [total[name][block].ravel()[keep] for name in SUMS]
                yield pa.RecordBatch.from_arrays([pa.array(a[keep].astype(np.int32)), pa.array(b[keep].astype(np.int32)), *map(pa.array, values)], ["a", "b", *SUMS])

    parts = df.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(run, "a int, b int, " + ", ".join(f"{name} double" for name in SUMS))
    return parts.groupBy("a", "b").agg(*[F.sum(name).alias(name) for name in SUMS])


def _both_ways(pairs: DataFrame, names: list[str], value: str) -> DataFrame:
    """Rows of a <= b to (model_a, model_b, value) for all ordered pairs."""
    label = F.array(*[F.lit(n) for n in names])
    mirrored = F.array(F.struct(F.col("a").alias("i"), F.col("b").alias("j")), F.struct(F.col("b").alias("i"), F.col("a").alias("j")))
    all_pairs = pairs.select(F.col(value), F.explode(F.when(F.col("a") == F.col("b"), F.slice(mirrored, 1, 1)).otherwise(mirrored)).alias("_p"))
    return all_pairs.select(F.get(label, F.col("_p.i")).alias("model_a"), F.get(label, F.col("_p.j")).alias("model_b"), value)


def probability_correlation(df: DataFrame, blocks: dict[str, list[str]]) -> DataFrame:
    """E-20: Pearson correlation of models' flattened N x classes probabilities: model_a, model_b, corr.

    From cross-product sums of all models at once.  Values are moved by the mean of a
    class (1 / classes), so the sums do not cancel.  A pair uses the places where both models have a value."""
    names, k = list(blocks), len(next(iter(blocks.values())))
    both = cross_sums(df, [[blocks[n][j] for n in names] for j in range(k)], 1.0 / k)
    over = F.col("n") * F.col("xy") - F.col("sx") * F.col("sy")
    under = F.sqrt(F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")) * F.sqrt(F.col("n") * F.col("syy") - F.col("sy") * F.col("sy"))
    corr = F.when(F.col("a") == F.col("b"), F.lit(1.0)).when(under > 0, over / under)
    return _both_ways(both.withColumn("corr", corr), names, "corr")


def prediction_agreement(df: DataFrame, pred_cols: dict[str, str]) -> DataFrame:
    """E-21: pairwise mean(pred_a == pred_b): model_a, model_b, agreement (of all rows; a NULL agrees with nothing).

    One-hot codes make it a sum of cross products, one position per class that occurs."""
    names = list(pred_cols)
    values = df.select(F.explode(F.array_distinct(F.array(*[F.col(f"`{c}`").cast("string") for c in pred_cols.values()]))).alias("v")).where("v is not null")
    classes = sorted(r.v for r in values.distinct().collect())  # one row per class
    if not classes:
        classes = [""]
    hot = df.select(*[F.when(F.col(f"`{c}`").cast("string") == v, 1.0).otherwise(0.0).alias(f"h_{i}_{j}") for i, c in enumerate(pred_cols.values()) for j, v in enumerate(classes)])
    group = [[f"h_{i}_{j}" for i in range(len(names))] for j in range(len(classes))]
    rows = df.select(F.count(F.lit(1))).scalar()
    pairs = cross_sums(hot, group).withColumn("agreement", F.when(F.col("a") == F.col("b"), F.lit(1.0)).otherwise(F.col("xy") / rows))
    return _both_ways(pairs, names, "agreement")


# ---------------------------------------------------------------- E-22
def scoreboard(df: DataFrame, truth: str, blocks: dict[str, list[str]], weights=None, classes=CLASSES,
               eps: float = LOGLOSS_EPS) -> DataFrame:
    """E-22: per model accuracy, balanced, weighted accuracy and log loss.

    Models are unpivoted into rows (one Expand); one grouped aggregate builds
    (model, truth, prediction) cells that also carry the summed negative log
    likelihood, so all metrics come from a single pass over the rows."""
    weights = weights or DEFAULT_CLASS_WEIGHTS
    arr = F.array(
        *[F.struct(F.lit(n).alias("model"), *[F.col(c).alias(f"_p{j}") for j, c in enumerate(cols)])
          for n, cols in blocks.items()]
    )
    long = df.select(F.col(truth).alias("_t"), F.inline(arr))
    pcols = [f"_p{j}" for j in range(len(classes))]
    ps = [F.col(c) for c in pcols]
    tot = sum(ps[1:], ps[0])
    pt = F.when(F.col("_t") == classes[0], ps[0] / tot)
    for c, p in zip(classes[1:], ps[1:]):
        pt = pt.when(F.col("_t") == c, p / tot)
    nll = -F.ln(F.least(F.greatest(pt, F.lit(eps)), F.lit(1.0 - eps)))
    cells = long.groupBy("model", F.col("_t").alias("true_class"), argmax_of(pcols, classes).alias("pred_class")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(nll).alias("_nll"))
    m = metrics_from_cells(cells, by=("model",), weights=weights, classes=classes, absent="skip",
                           extra_aggs=[F.sum("_nll").alias("_nll_sum")],
                           extra_cols=[(F.col("_nll_sum") / F.col("_n")).alias("log_loss")])
    return m.select("model", "n", "accuracy", "balanced_accuracy", "weighted_accuracy", "log_loss")


def argmax_of(cols, classes=CLASSES) -> Column:
    from prismtab.functions.proba import argmax_class

    return argmax_class(cols, classes)
