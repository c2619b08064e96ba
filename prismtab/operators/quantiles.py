"""Exact quantiles inside groups (E-08, E-12) without collecting a group.

Values are counted per group first.  Literal split points cut the values into
ranges; running counts over a group's ranges tell which of them hold its target
ranks, and only those are opened, each in a window of its own.  A group
with a third of all rows is as many windows as there are ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prismtab.operators.checks import null_safe_join
from prismtab.operators.ranking import range_id, range_splits


def group_quantile(df: DataFrame, keys: list[str], value: str, fraction: float = 0.5, name: str = "median", ranges: int | None = None) -> DataFrame:
    """The ``fraction`` quantile (linear between neighbours) of ``value`` per group of ``keys``, as (keys, name).

    NULL values do not count; a group without others has no row; NULL keys are a group.
    ``ranges``: how many ranges the values are cut into (by the number of rows, if not given)."""
    rows = df.select(*keys, F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    counts = rows.groupBy(*keys, "_x").agg(F.count(F.lit(1)).alias("_c"))
    counts = counts.withColumn("_rid", range_id(counts, ["_x"], range_splits(rows, ["_x"], ranges)))
    per = counts.groupBy(*keys, "_rid").agg(F.sum("_c").alias("_in"))
    upto = Window.partitionBy(*keys).orderBy("_rid").rowsBetween(Window.unboundedPreceding, 0)
    per = per.withColumns({"_end": F.sum("_in").over(upto), "_n": F.sum("_in").over(Window.partitionBy(*keys))})
    per = per.withColumn("_pos", F.lit(float(fraction)) * (F.col("_n") - 1))
    per = per.withColumns({"_low": F.floor("_pos") + 1, "_high": F.ceil("_pos") + 1, "_before": F.col("_end") - F.col("_in")})
    per = per.where((F.col("_before") < F.col("_high")) & (F.col("_end") >= F.col("_low")))
    opened = null_safe_join(counts, per.select(*keys, "_rid", "_before", "_pos", "_low", "_high"), [*keys, "_rid"], "inner")
    inside = Window.partitionBy(*keys, "_rid").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    opened = opened.withColumn("_to", F.sum("_c").over(inside) + F.col("_before"))

    def at(rank: str):
        return F.max(F.when((F.col(rank) <= F.col("_to")) & (F.col(rank) > F.col("_to") - F.col("_c")), F.col("_x")))

    found = opened.groupBy(*keys).agg(at("_low").alias("_a"), at("_high").alias("_b"), F.max(F.col("_pos") - F.col("_low") + 1).alias("_part"))
    between = F.when(F.col("_part") > 0, (F.col("_b") - F.col("_a")) * F.col("_part")).otherwise(0.0)
    return found.select(*keys, (F.col("_a") + between).alias(name))
