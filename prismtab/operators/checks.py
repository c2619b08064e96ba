"""Run-time contract checks and validated joins (C-08, C-09, D-01..D-11).

Checks are single aggregates whose result is a handful of numbers (or at
most ``limit`` offending values) read back on the driver; the data itself
never moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prismtab.constants import CLASSES


class ContractError(ValueError):
    """A data contract (domain, completeness, uniqueness) is violated."""


def require_columns(df: DataFrame, cols, what: str = "frame") -> None:
    """A-02 / A-05: plan-time required-column check."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ContractError(f"{what} is missing columns: {missing}")


def unknown_classes(df: DataFrame, col: str, classes=CLASSES) -> DataFrame:
    """C-08: distinct values outside the class domain (NULL excluded)."""
    c = F.col(col)
    return df.where(c.isNotNull() & ~c.isin(*classes)).select(c.alias("value")).distinct()


def check_class_domain(df: DataFrame, col: str, classes=CLASSES, limit: int = 20) -> DataFrame:
    """C-08: raise if any value of ``col`` is outside ``classes``; returns ``df``."""
    bad = [r["value"] for r in unknown_classes(df, col, classes).limit(limit + 1).collect()]
    if bad:
        more = f" and more than {limit - 1} others" if len(bad) > limit else ""
        raise ContractError(f"unknown classes in {col}: {sorted(bad)[:limit]}{more}")
    return df


def in_domain(col: Column, what: str, classes=CLASSES) -> Column:
    """C-08 inside a job: the class itself; a NULL or unknown one ends the job with an error, without a further pass."""
    said = F.concat(F.lit(f"unknown class in {what}: "), F.coalesce(col.cast("string"), F.lit("NULL")))
    return F.when(col.isin(*classes), col).otherwise(F.raise_error(said).cast("string"))


def null_counts(df: DataFrame, cols=None) -> DataFrame:
    """C-09: one row, one null count per column (single pass)."""
    cols = cols or df.columns
    return df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("bigint").alias(c) for c in cols])


def check_complete(df: DataFrame, cols, what: str = "frame") -> DataFrame:
    """C-09: raise when any of ``cols`` has NULLs (e.g. after an alignment join)."""
    row = null_counts(df, cols).first().asDict()
    bad = {k: v for k, v in row.items() if v}
    if bad:
        raise ContractError(f"{what} has missing values after alignment: {bad}")
    return df


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys occurring more than once (D-06 pre-check)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).count().where(F.col("count") > 1)


def check_unique(df: DataFrame, keys, what: str = "frame") -> DataFrame:
    if duplicate_keys(df, keys).limit(1).count():
        raise ContractError(f"{what} has duplicate keys on {keys}")
    return df


# ---------------------------------------------------------------- joins
def join_runs(runs: list[DataFrame], on=("id",)) -> DataFrame:
    """D-01: inner equi-join of several OOF runs on their keys."""
    out = runs[0]
    for r in runs[1:]:
        out = out.join(r, list(on), "inner")
    return out


def label_mismatches(a: DataFrame, b: DataFrame, key: str = "id", label: str = "class") -> DataFrame:
    """D-02: keys whose labels differ between two runs (NULL-safe)."""
    j = a.select(key, F.col(label).alias("_la")).join(b.select(key, F.col(label).alias("_lb")), key, "inner")
    return j.where(~F.col("_la").eqNullSafe(F.col("_lb"))).select(key, "_la", "_lb")


def check_labels_consistent(a: DataFrame, b: DataFrame, key: str = "id", label: str = "class") -> None:
    if label_mismatches(a, b, key, label).limit(1).count():
        raise ContractError("label mismatch between runs")


def attach_labels(pred: DataFrame, labels: DataFrame, key: str = "id", label: str = "class",
                  check: bool = True) -> DataFrame:
    """D-03: left join of labels onto predictions, completeness checked."""
    out = pred.join(labels.select(key, label), key, "left")
    return check_complete(out, [label], "label alignment") if check else out


def one_to_one(left: DataFrame, right: DataFrame, key: str = "id", how: str = "left",
               check: bool = True) -> DataFrame:
    """D-06: validated one-to-one join (duplicate keys on either side → error).
    A right join is expressed as a left join from the right side."""
    if check:
        check_unique(left, key, "left side")
        check_unique(right, key, "right side")
    if how == "right":
        return right.join(left, key, "left")
    return left.join(right, key, how)


def row_preserving_inner(a: DataFrame, b: DataFrame, key: str = "id") -> DataFrame:
    """D-05: inner join that must keep every row of both sides.

    One full-outer join + one aggregate counts keys missing on either side."""
    probe = a.select(key, F.lit(1).alias("_a")).join(b.select(key, F.lit(1).alias("_b")), key, "full_outer")
    miss = probe.agg(
        F.sum(F.when(F.col("_b").isNull(), 1).otherwise(0)).alias("only_a"),
        F.sum(F.when(F.col("_a").isNull(), 1).otherwise(0)).alias("only_b"),
    ).first()
    if miss["only_a"] or miss["only_b"]:
        raise ContractError(f"join changes row count: {miss['only_a']} left-only, {miss['only_b']} right-only")
    return a.join(b, key, "inner")


def membership_flag(df: DataFrame, ids: DataFrame, key: str = "id", name: str = "in_set") -> DataFrame:
    """D-09: flag rows whose key is in ``ids`` (left join on distinct keys;
    Spark broadcasts the id side when AQE measures it small)."""
    marks = ids.select(key).distinct().withColumn(name, F.lit(True))
    return df.join(marks, key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str = "left") -> DataFrame:
    """Join on composite keys where NULL matches NULL (``<=>``), e.g. group
    keys of D-08/D-10.  Each key is one column of the output; rows of the right side alone keep theirs."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond: Column | None = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = c if cond is None else cond & c
    joined = left.join(r, cond, how)
    if how.replace("_", "") in ("right", "rightouter", "full", "fullouter", "outer"):
        joined = joined.withColumns({k: F.coalesce(F.col(k), F.col(f"_r_{k}")) for k in keys})
    return joined.drop(*[f"_r_{k}" for k in keys])
