"""Cells of many group keys at once (E-07, E-08, G-05, K-13) by a lattice of key sets.

Counting every key over the rows would multiply the rows by the number of
keys.  Instead a few key sets, the bases, are counted over the rows, one aggregate
each, and every key is summed up from the smallest base that holds its columns.
A base is grown as long as it is expected to stay well below the rows in
number of cells; a key that no such base can hold is counted on its own.  On a
large table nearly all keys share one base; on a small one with columns
of many values more of them go back to the rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prismtab.constants import KEY_NA_STRING

#: a grown base may have this share of the rows in cells; sets of one GROUPING SETS aggregate over cells
SHARE, SETS = 0.25, 30


def plan_bases(keys: Iterable[tuple[str, ...]], distinct: dict[str, int], rows: int, share: float = SHARE) -> dict[tuple[str, ...], list[tuple[str, ...]]]:
    """base (sorted columns) → keys that are summed up from it.

    ``distinct``: values of each column; a set's cells are taken to be their product, ``rows`` at most."""

    def cells(columns) -> int:
        return min(rows, math.prod(max(1, distinct[c]) for c in columns))

    keys = list(dict.fromkeys(keys))
    bases: list[frozenset] = []
    for key in sorted(keys, key=lambda k: (-len(k), -cells(k), k)):
        own = frozenset(key)
        if any(own <= b for b in bases):
            continue
        grown = min(((cells(b | own), i) for i, b in enumerate(bases)), default=None)
        if grown and grown[0] <= share * rows:
            bases[grown[1]] |= own
        else:
            bases.append(own)
    bases = [b for b in dict.fromkeys(bases) if not any(b < other and cells(other) <= share * rows for other in bases)]
    out: dict[tuple[str, ...], list[tuple[str, ...]]] = {}
    for key in keys:
        best = min((b for b in bases if b >= frozenset(key)), key=lambda b: (cells(b), sorted(b)))
        out.setdefault(tuple(sorted(best)), []).append(key)
    return out


def key_values(df: DataFrame, columns: Iterable[str]) -> list[Column]:
    """The columns as they are grouped on: strings with NULL → token, other types as they are."""
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return [F.coalesce(F.col(c), F.lit(KEY_NA_STRING)).alias(c) if c in strings else F.col(c) for c in columns]


def lattice_cells(rows: DataFrame, keys: list[tuple[str, ...]], measures: dict[str, Column], share: float = SHARE) -> DataFrame:
    """keys (``a|b``), k1..kd (values as strings, NULL → token; NULL beyond the key's columns) and the measures, a row per cell.

    ``measures`` are row-level numbers that are summed.  The narrow table of keys and
    measures is written once to the shared folder and read column by column."""
    from prismtab.session import store

    columns = sorted({c for k in keys for c in k})
    depth = max(map(len, keys))
    narrow = store(rows.select(*key_values(rows, columns), *[m.cast("bigint").alias(f"_m_{n}") for n, m in measures.items()]))
    seen = narrow.agg(F.count(F.lit(1)).alias("_rows"), *[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    plan = plan_bases(keys, {c: seen[c] for c in columns}, max(1, seen["_rows"]), share)
    sums = [F.sum(f"_m_{n}").alias(f"_m_{n}") for n in measures]
    out = None
    for base, own in plan.items():
        cells = narrow.groupBy(*base).agg(*sums)
        for at in range(0, len(own), SETS):
            part = _of_base(cells, base, own[at : at + SETS], sums, depth, list(measures))
            out = part if out is None else out.unionByName(part)
    return out


def _of_base(cells: DataFrame, base: tuple[str, ...], keys: list[tuple[str, ...]], sums: list[Column], depth: int, names: list[str]) -> DataFrame:
    def text(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(KEY_NA_STRING))

    measures = [F.col(f"_m_{n}").alias(n) for n in names]
    if [tuple(sorted(k)) for k in keys] == [base]:
        values = [text(keys[0][d]) if d < len(keys[0]) else F.lit(None).cast("string") for d in range(depth)]
        return cells.select(F.lit("|".join(keys[0])).alias("keys"), *[v.alias(f"k{d + 1}") for d, v in enumerate(values)], *measures)
    rolled = cells.groupingSets([list(k) for k in keys], *base).agg(*sums, F.grouping_id().alias("_set"))
    # grouping_id has a bit for every column that a set leaves out; each set has a label and its columns' places
    number = {k: sum(1 << (len(base) - 1 - i) for i, c in enumerate(base) if c not in k) for k in keys}
    places = ", ".join(f"{number[k]}L, array({', '.join(str(base.index(c)) for c in k)})" for k in keys)
    texts = F.array(*[text(c) for c in base]).alias("_texts")
    named = rolled.select(F.expr(f"element_at(map({places}), _set)").alias("_places"), texts, *measures)
    names_sql = ", ".join("'" + c.replace("\\", "\\\\").replace("'", "\\'") + "'" for c in base)
    values = [F.expr(f"get(_texts, get(_places, {d}))").alias(f"k{d + 1}") for d in range(depth)]
    return named.select(F.expr(f"array_join(transform(_places, i -> get(array({names_sql}), i)), '|')").alias("keys"), *values, *names)
