"""Disagreement arbitration between two prediction tables (J-01..J-04, G-04).

A *flow* is a (base prediction, other prediction) pair with base != other.
Its utility is the weighted change in correct labels if the other
prediction were taken on those rows.  Flows are at most classes x classes
rows, so the selected-flow table is broadcast with a proven size bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prismtab.constants import CLASSES, DEFAULT_CLASS_WEIGHTS
from prismtab.operators.metrics import prediction_metrics, weight_of


def flow_utility(train: DataFrame, truth: str, base: str, other: str, weights=None, min_n: int = 1,
                 min_delta: float = 0.0) -> DataFrame:
    """J-01: per (base_pred, other_pred) with base != other: n, weighted
    utility delta, mean delta, and ``selected = n >= min_n and delta > min_delta``.

    One filter + one grouped aggregate (map-side partial aggregation)."""
    weights = weights or DEFAULT_CLASS_WEIGHTS
    t, b, o = F.col(truth), F.col(base), F.col(other)
    w = weight_of(t, weights)
    after = F.when(o == t, 1).otherwise(0)
    before = F.when(b == t, 1).otherwise(0)
    # disagreement is counted inside the aggregate and groups with n = 0 are
    # dropped after it: a filter on the derived prediction columns would be
    # pushed below their projection and re-expand them at the scan
    dis = b != o
    g = (
        train.groupBy(b.alias("base_pred"), o.alias("other_pred"))
        .agg(F.sum(F.when(dis, 1).otherwise(0)).alias("n"),
             F.sum(F.when(dis, w * (after - before)).otherwise(0.0)).alias("delta_weighted_correct"))
        .where(F.col("n") > 0)
    )
    return g.select(
        "base_pred",
        "other_pred",
        "n",
        "delta_weighted_correct",
        (F.col("delta_weighted_correct") / F.col("n")).alias("mean_delta_weighted_correct"),
        ((F.col("n") >= min_n) & (F.col("delta_weighted_correct") > float(min_delta))).alias("selected"),
    )


def rank_flows(flows: DataFrame) -> DataFrame:
    """G-04: selected first, then delta and n descending (an empty flow table
    stays empty instead of failing)."""
    return flows.orderBy(F.desc("selected"), F.desc("delta_weighted_correct"), F.desc("n"),
                         F.asc("base_pred"), F.asc("other_pred"))


def apply_flows(df: DataFrame, base: str, other: str, flows: DataFrame, out: str = "arb_pred") -> DataFrame:
    """J-02/J-04: take ``other`` where (base, other) is a selected flow.

    Flows are applied simultaneously on the original base prediction.  The
    selected-flow table has at most classes^2 rows → broadcast."""
    sel = flows.where(F.col("selected")).select(
        F.col("base_pred").alias("_fb"), F.col("other_pred").alias("_fo"), F.lit(True).alias("_take")
    )
    j = df.join(F.broadcast(sel), (F.col(base) == F.col("_fb")) & (F.col(other) == F.col("_fo")), "left")
    return j.withColumn(out, F.when(F.col("_take"), F.col(other)).otherwise(F.col(base))).drop("_fb", "_fo", "_take")


def arbitration_scores(train: DataFrame, truth: str, candidates: dict[str, str], weights=None,
                       classes=CLASSES) -> DataFrame:
    """J-03: accuracy / balanced / weighted / errors of a, b and arbitrated.

    Candidates are unpivoted into rows (one Expand) → one grouped aggregate."""
    arr = F.array(*[F.struct(F.lit(n).alias("candidate"), F.col(c).alias("_pred")) for n, c in candidates.items()])
    long = train.select(F.col(truth).alias("_t"), F.inline(arr))
    m = prediction_metrics(long, "_t", "_pred", by=("candidate",), weights=weights, classes=classes,
                           absent="zero")
    return m.select("candidate", "accuracy", "balanced_accuracy", "weighted_accuracy", "errors")


def test_differences(test: DataFrame, a: str, b: str, arb: str) -> DataFrame:
    """J-03: how many test rows the arbitrated prediction changes vs a and b."""
    return test.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col(arb) != F.col(a), 1).otherwise(0)).cast("bigint").alias("diff_vs_a"),
        F.sum(F.when(F.col(arb) != F.col(b), 1).otherwise(0)).cast("bigint").alias("diff_vs_b"),
        F.sum(F.when(F.col(a) != F.col(b), 1).otherwise(0)).cast("bigint").alias("a_vs_b"),
    )
