"""Reproducible stratified folds and samples (F-02, L-01..L-03).

Rows are ordered within their class by ``md5("<seed>:<id>")`` (ties by id).
A class can hold a third of all rows, so a window partitioned by class alone
would sort that third in one task.  Instead the order key's first hex
characters form a bucket: buckets are contiguous ranges of the order, so the
global in-class rank = rank inside (class, bucket) + number of class rows in
earlier buckets.  How many characters is read off the largest class, so that
a bucket holds about ``BUCKET_ROWS`` rows at any size; ranks do not depend on it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prismtab.operators.ranking import global_row_number


def order_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


#: rows that a bucket of one class aims at
BUCKET_ROWS = 1 << 18


def prefix_length(df: DataFrame, label: str) -> int:
    """Hash characters that cut the largest class into buckets of at most about ``BUCKET_ROWS``; one at least."""
    largest = df.groupBy(label).count().agg(F.max("count")).first()[0] or 1
    return max(1, math.ceil(math.log(largest / BUCKET_ROWS, 16)))


def class_rank(df: DataFrame, label: str, id_col: str = "id", seed: int = 42, prefix_len: int | None = None,
               name: str = "class_rank") -> DataFrame:
    """0-based rank of each row inside its class by the seeded hash order."""
    prefix_len = prefix_len or prefix_length(df, label)
    keyed = df.withColumn("_ok", order_key(id_col, seed)).withColumn("_bk", F.substring("_ok", 1, prefix_len))
    counts = keyed.groupBy(F.col(label).alias("_lab"), "_bk").agg(F.count(F.lit(1)).alias("_cnt"))
    w_off = Window.partitionBy("_lab").orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_lab", F.col("_bk").alias("_obk"),
                            F.coalesce(F.sum("_cnt").over(w_off), F.lit(0)).alias("_off"))
    # no hint: the offsets are a row per bucket, and the join is on the keys that the window needs anyway
    j = keyed.join(offsets, F.col(label).eqNullSafe(F.col("_lab")) & (F.col("_bk") == F.col("_obk")))
    w = Window.partitionBy(label, "_bk").orderBy("_ok", id_col)
    return j.select(*df.columns, (F.row_number().over(w) - 1 + F.col("_off")).alias(name), "_ok")


def stratified_folds(df: DataFrame, label: str, k: int = 5, id_col: str = "id", seed: int = 42,
                     prefix_len: int | None = None, name: str = "fold") -> DataFrame:
    """F-02: fold = in-class rank mod k; per-class fold sizes differ by <= 1
    and every row is in exactly one validation fold."""
    r = class_rank(df, label, id_col, seed, prefix_len)
    return r.withColumn(name, (F.col("class_rank") % k).cast("int")).drop("class_rank", "_ok")


def train_valid_split(df: DataFrame, label: str, valid_fraction: float = 0.2, id_col: str = "id", seed: int = 42,
                      name: str = "is_valid") -> DataFrame:
    """L-03: stratified split; validation = fold 0 of round(1/fraction) folds."""
    k = max(2, int(round(1.0 / valid_fraction)))
    out = stratified_folds(df, label, k, id_col, seed, name="_fold")
    return out.withColumn(name, F.col("_fold") == 0).drop("_fold")


def _class_counts(df: DataFrame, label: str) -> dict:
    # one row per class: a bounded result read on the driver
    return {r[0]: r[1] for r in df.groupBy(label).count().collect()}


def stratified_quota(counts: dict, n: int) -> dict:
    """Per-class quotas summing to n: floor of the proportional share, the
    remainder to the largest fractional parts (ties by class order)."""
    total = sum(counts.values())
    if n < len(counts):
        raise ValueError(f"sample size {n} is smaller than the number of classes ({len(counts)})")
    keys = sorted(counts, key=lambda c: (c is None, c))
    base = {c: math.floor(n * counts[c] / total) for c in keys}
    rem = n - sum(base.values())
    order = sorted(keys, key=lambda c: (-(n * counts[c] / total - base[c]), keys.index(c)))
    for c in order[:rem]:
        base[c] += 1
    return base


def _quota(label: str, quota: dict) -> Column:
    """Rows to take of a row's class; NULL is a class of its own."""
    known = [x for c, q in quota.items() if c is not None for x in (F.lit(c), F.lit(q))]
    found = F.element_at(F.create_map(*known), F.col(label)) if known else F.lit(0)
    return F.when(F.col(label).isNull(), F.lit(quota.get(None, 0))).otherwise(found)


def stratified_sample(df: DataFrame, label: str, n: int, id_col: str = "id", seed: int = 42,
                      prefix_len: int = 3) -> DataFrame:
    """L-01: exactly ``n`` rows with per-class quotas proportional to the
    class sizes (error if n < number of classes); whole table if n >= rows."""
    counts = _class_counts(df, label)
    if n <= 0 or n >= sum(counts.values()):
        return df
    quota = stratified_quota(counts, n)
    r = class_rank(df, label, id_col, seed, prefix_len)
    return r.where(F.col("class_rank") < _quota(label, quota)).drop("class_rank", "_ok")


def proportional_sample(df: DataFrame, label: str, n: int, id_col: str = "id", seed: int = 42,
                        prefix_len: int = 3) -> DataFrame:
    """L-02: per class max(1, round(n * share)) rows (half-even rounding, capped
    at the class size); if that exceeds n, keep the n first rows of the
    seeded order."""
    counts = _class_counts(df, label)
    total = sum(counts.values())
    if n <= 0 or n >= total:
        return df
    quota = {c: min(max(1, int(round(n * cnt / total))), cnt) for c, cnt in counts.items()}
    r = class_rank(df, label, id_col, seed, prefix_len)
    picked = r.where(F.col("class_rank") < _quota(label, quota))
    if sum(quota.values()) <= n:
        return picked.drop("class_rank", "_ok")
    ranked = global_row_number(picked, ["_ok", id_col], name="_grn")
    return ranked.where(F.col("_grn") <= n).drop("class_rank", "_ok", "_grn")
