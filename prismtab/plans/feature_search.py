"""Feature search (K-13): generated candidate columns, screened by counts, refitted if they survive.

The generators cover every numeric column: values rounded to some decimals, single digits,
quantile bins, and crosses of two of the coarse columns.  All candidates
are screened in one pass: from the table of (candidate, value, fold, class)
counts follows how often a value's majority class in the other folds is right in a
fold.  Only candidates that beat the class majority enter the forward search, where
each costs one k-fold fit.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prismtab.constants import CLASSES
from prismtab.operators.cuboids import lattice_cells
from prismtab.operators.folds import stratified_folds
from prismtab.operators.groupkeys import key_columns

#: what the generators make of a numeric column
ROUNDING, DIGITS, BINS = (-1, 0, 1), (0, 1), (5, 10)


def numeric_columns(df: DataFrame, skip=("id", "class", "split", "fold", "source_index")) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def single_specs(columns: list[str], rounding=ROUNDING, digits=DIGITS, bins=BINS) -> list[str]:
    """Names in the key grammar (E-16) of all generated columns."""
    return [f"{kind}__{c}__{p}" for c in columns for kind, places in (("round", rounding), ("digit", digits), ("qbin", bins)) for p in places]


def candidate_keys(numeric: list[str], categorical: list[str], rounding=ROUNDING, digits=DIGITS, bins=BINS) -> list[tuple[str, ...]]:
    """All candidates: every generated column, and every cross of two of the categoricals and coarsest bins."""
    coarse = list(categorical) + [f"qbin__{c}__{min(bins)}" for c in numeric] if bins else list(categorical)
    return [(s,) for s in single_specs(numeric, rounding, digits, bins)] + list(combinations(coarse, 2))


def _sum(columns: list[Column]) -> Column:
    return sum(columns[1:], columns[0])


def screen(train: DataFrame, keys: list[tuple[str, ...]], label: str = "class", k: int = 3, seed: int = 42, id_col: str = "id",
           classes=CLASSES, min_gain: float = 1e-5) -> DataFrame:
    """candidate, degree, n_values, accuracy, gain, survives; a row per key.

    A row is predicted as the commonest class of its value in the other folds (the first in class order on
    ties, the commonest class of the other folds for a value that they lack); gain is the accuracy above that of the
    commonest class alone."""
    folded = stratified_folds(train, label, k, id_col, seed)
    (rows,), _ = key_columns([folded], sorted({c for key in keys for c in key}))
    cell = {(f, c): f"n_{f}_{i}" for f in range(k) for i, c in enumerate(classes)}
    measures = {name: F.when((F.col("fold") == f) & (F.col(label) == c), 1).otherwise(0) for (f, c), name in cell.items()}
    cells = lattice_cells(rows, keys, measures)
    whole = folded.agg(*[F.sum(m).alias(n) for n, m in measures.items()]).first()  # folds x classes numbers

    def commonest(f: int) -> str:
        others = {c: sum(whole[cell[g, c]] for g in range(k) if g != f) for c in classes}
        return max(classes, key=lambda c: (others[c], -classes.index(c)))

    def right(f: int) -> Column:
        others = {c: _sum([F.col(cell[g, c]) for g in range(k) if g != f]) for c in classes}
        best = F.greatest(*others.values())
        out = F.when(best == 0, F.col(cell[f, commonest(f)]))
        for c in classes:
            out = out.when(others[c] == best, F.col(cell[f, c]))
        return out

    base = sum(whole[cell[f, commonest(f)]] for f in range(k))
    total = sum(whole[n] for n in cell.values())
    # a value's row can only be right if it is of a known class; rows of other labels count for nothing
    found = cells.groupBy("keys").agg(F.count(F.lit(1)).alias("n_values"), F.sum(_sum([right(f) for f in range(k)])).alias("_right"))
    accuracy = F.col("_right") / F.lit(max(total, 1))
    gain = (F.col("_right") - F.lit(base)) / F.lit(max(total, 1))
    return found.select(F.col("keys").alias("candidate"), F.size(F.split("keys", r"\|")).alias("degree"), "n_values", accuracy.alias("accuracy"), gain.alias("gain"), (gain > min_gain).alias("survives"))


def candidate_columns(train: DataFrame, keys: list[tuple[str, ...]], classes=CLASSES) -> dict[str, Column]:
    """Model columns of the candidates: the generated numbers, and for a cross both codes in one number."""
    _, made = key_columns([train], sorted({c for key in keys for c in key}))
    plain = {f.name for f in train.schema.fields if isinstance(f.dataType, T.StringType)}

    def number(spec: str) -> Column:
        return F.pmod(F.crc32(made[spec].cast("binary")), F.lit(997)).cast("double") if spec in plain else made[spec].cast("double")

    return {"|".join(key): number(key[0]) if len(key) == 1 else number(key[0]) * 1000 + number(key[1]) for key in keys}


def feature_search(train: DataFrame, base_features: list[str], keys: list[tuple[str, ...]], family: str = "lr", params: dict | None = None,
                   label: str = "class", k: int = 3, seed: int = 42, min_gain: float = 1e-5, id_col: str = "id", metric: str = "accuracy",
                   refits: int | None = None) -> tuple[list[str], DataFrame]:
    """K-13: (kept features, trace).  Candidates that survive the screen are tried by descending gain
    and kept when the k-fold OOF ``metric`` improves by more than ``min_gain``; the trace lists every candidate
    with its gain, and its score if it was refitted.  ``refits`` limits the fits (none by default)."""
    from prismtab.plans.oof import run_oof

    screened = [r.asDict() for r in screen(train, keys, label, k, seed, id_col, min_gain=min_gain).orderBy(F.desc("gain"), "candidate").collect()]  # a row per candidate
    chosen = [r["candidate"] for r in screened if r["survives"]][:refits]
    columns = candidate_columns(train, [tuple(c.split("|")) for c in chosen]) if chosen else {}
    frame = train.withColumns(columns)

    def score(features: list[str]) -> float:
        found = run_oof(frame, None, features, family, params, "search", label, k, seed, id_col=id_col)
        return found.scores.where(F.col("fold") == "overall").first()[metric]

    current = list(base_features)
    best = score(current)
    trace = [("<base>", None, best, True)]
    for r in screened:
        name, found, keep = r["candidate"], None, False
        if name in columns:
            found = score(current + [name])
            keep = found > best + min_gain
        trace.append((name, r["gain"], found, keep))
        if keep:
            current.append(name)
            best = found
    return current, train.sparkSession.createDataFrame(trace, f"candidate string, gain double, {metric} double, kept boolean")
