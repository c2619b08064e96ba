"""Cleaning and encoding of model inputs (B-20, B-34..B-38).

Encoders are fitted with aggregates (distinct values, medians) whose output
size is bounded by the column's cardinality, and applied with literal
medians and joins that broadcast the levels if their measured size allows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prismtab.constants import KEY_NA_STRING

NUMERIC_TYPES = (T.DoubleType, T.FloatType)
#: most bytes of category levels that go to every task
BROADCAST_BYTES = 32 << 20


def small_side(df: DataFrame, text: str) -> DataFrame:
    """``df``, marked for broadcast if its ``text`` column and 32 bytes a row come to ``BROADCAST_BYTES`` at most.

    Beyond it the join shuffles, and AQE splits the partitions of frequent values."""
    size = df.agg(F.sum(F.octet_length(text) + 32)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def clean_numeric(df: DataFrame, columns=None) -> DataFrame:
    """B-20: NaN and +/-inf → NULL for every floating column (or ``columns``)."""
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]
    exprs = {}
    for n in names:
        c = F.col(n)
        bad = F.isnan(c) | (c == F.lit(float("inf"))) | (c == F.lit(float("-inf")))
        exprs[n] = F.when(bad, F.lit(None).cast("double")).otherwise(c.cast("double"))
    return df.withColumns(exprs) if exprs else df


def fill_na_string(col: str, token: str = KEY_NA_STRING):
    return F.coalesce(F.col(col).cast("string"), F.lit(token))


def category_levels(frames: list[DataFrame], col: str, token: str = KEY_NA_STRING) -> DataFrame:
    """B-34: sorted union of categories over several frames, NULL → token.

    Returns (value, code) with code = 0-based position in sorted order.
    The distinct step shuffles only distinct values; the rank runs on that
    bounded set."""
    from prismtab.operators.ranking import dense_codes

    vals = None
    for f in frames:
        v = f.select(fill_na_string(col, token).alias("value"))
        vals = v if vals is None else vals.unionByName(v)
    return dense_codes(vals.distinct(), "value")


def encode_categoricals(frames: list[DataFrame], cols: list[str], token: str = KEY_NA_STRING,
                        unseen: int = -1) -> list[DataFrame]:
    """B-35/B-36: replace each categorical column by its integer code (codes
    fitted on the union of ``frames``; values missing from the fit → ``unseen``)."""
    out = list(frames)
    for c in cols:
        if not all(c in f.columns for f in frames):
            continue
        from prismtab.session import cut_lineage

        levels = cut_lineage(category_levels(frames, c, token))
        lv = levels.select(F.col("value").alias(f"_v_{c}"), F.col("code").cast("int").alias(f"_code_{c}"))
        lv = small_side(lv, f"_v_{c}")
        new = []
        for f in out:
            joined = f.withColumn(f"_v_{c}", fill_na_string(c, token)).join(lv, f"_v_{c}", "left")
            new.append(
                joined.withColumn(c, F.coalesce(F.col(f"_code_{c}"), F.lit(unseen).cast("int"))).drop(
                    f"_v_{c}", f"_code_{c}"
                )
            )
        out = new
    return out


def median_impute(train: DataFrame, others: list[DataFrame], cols: list[str]):
    """B-36: fill NULL numerics with the exact train median (0 when all NULL); all columns in one pass."""
    from prismtab.operators.groupkeys import exact_quantiles_multi

    if not cols:
        return train, others
    found = exact_quantiles_multi(train, {c: [0.5] for c in cols})
    fill = {c: float(found[c][0] or 0.0) for c in cols}

    def apply(df):
        return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(fill[c])) for c in cols})

    return apply(train), [apply(o) for o in others]


def align_columns(train: DataFrame, test: DataFrame, drop=("id", "class", "source_index")):
    """B-37: drop ids/labels, union-align both frames' columns (missing → NULL)."""
    t = train.drop(*[d for d in drop if d != "id"])
    s = test.drop(*[d for d in drop if d != "id"])
    cols = [c for c in t.columns] + [c for c in s.columns if c not in t.columns]
    types = dict(t.dtypes) | {k: v for k, v in s.dtypes if k not in dict(t.dtypes)}

    def fill(df):
        have = set(df.columns)
        return df.select(*[F.col(c) if c in have else F.lit(None).cast(types[c]).alias(c) for c in cols])

    return fill(t), fill(s)


def drop_non_features(df: DataFrame, extra=()) -> DataFrame:
    """B-38: drop id, target and source index (plus ``extra``)."""
    return df.drop("id", "class", "source_index", *extra)
