"""Registry of named queries (Spark) and their independent SQL oracles.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the test tables (or
views Spark derives from them).  The oracle is hand-written DuckDB SQL over
the raw tables; CTE text for the stand-in views lives in
``prismtab.sources.fixtures``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def round_half_up(x: Column, digits: int) -> Column:
    """``round(x, digits)`` of a double, bit for bit.  Away from ties the nearest integer over a power of ten is that
    number; only values near a tie and very large ones go through the decimal arithmetic of ``round``."""
    scale = 10.0**digits
    moved = x * F.lit(scale)
    near = F.rint(moved)
    return F.when((F.abs(moved) < float(1 << 40)) & (F.abs(moved - near) < 0.499), near / F.lit(scale)).otherwise(F.round(x, digits))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double/float column (sum order differs between engines);
    adding 0.0 turns -0.0 into 0.0."""
    cols = []
    for name, typ in df.dtypes:
        if typ in ("double", "float"):
            cols.append((round_half_up(F.col(name).cast("double"), digits) + F.lit(0.0)).alias(name))
        else:
            cols.append(F.col(name))
    return df.select(*cols)


def load_all() -> None:
    """Import every query module so that they register themselves."""
    from prismtab.plans import (  # noqa: F401
        q_feature_sets,
        q_features,
        q_folds,
        q_metrics,
        q_search,
        q_groupkeys,
        q_misc,
        q_models,
        q_proba,
        q_registry,
    )
