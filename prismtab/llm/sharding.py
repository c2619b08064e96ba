"""Uniform shuffle into shards of exact size through a hypergeometric communication matrix.

Rows fall into logical partitions by a hash of their content.  The driver
draws, without replacement, how many rows each partition sends to each shard
(one small matrix), so shard sizes are exact before any row moves.  Each
partition permutes its rows and cuts the permutation by its matrix row; after
the exchange each shard permutes what it received and numbers its slots.

Only counts reach the driver: at most ``MAX_PARTITIONS`` of them, and as many
offsets.  All random choices are functions of the seed and of row content, so
a task that runs again after a lost executor makes the same choices.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: rows that one logical partition (or one run of slots) aims at, and how many of them there may be
ROWS_PER_PARTITION = 4096
MAX_PARTITIONS = 1 << 16


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` rows taken without replacement are good ones."""
    if draws <= 0 or good <= 0:
        return 0
    if bad <= 0:
        return draws
    if good < 10**9 and bad < 10**9:
        return int(rng.hypergeometric(good, bad, draws))
    # beyond the library's range: walk outward from the mode
    low, high = max(0, draws - bad), min(draws, good)
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    at_mode = math.exp(log_choose(good, mode) + log_choose(bad, draws - mode) - log_choose(good + bad, draws))
    u = rng.random() - at_mode
    up = down = mode
    p_up = p_down = at_mode
    while u > 0 and (up < high or down > low):
        if up < high:
            p_up *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            u -= p_up
            if u <= 0:
                return up
        if down > low:
            p_down *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            u -= p_down
            if u <= 0:
                return down
    return mode


def communication_matrix(counts: list[int], n_shards: int, seed: int) -> np.ndarray:
    """Rows that partition i sends to shard s: row sums are ``counts``, column sums differ by one at most."""
    rng = np.random.default_rng(seed)
    total = sum(counts)
    room = np.full(n_shards, total // n_shards, np.int64)
    room[rng.permutation(n_shards)[: total % n_shards]] += 1
    matrix = np.zeros((len(counts), n_shards), np.int64)
    for i, count in enumerate(counts):
        rest, left = int(room.sum()), count
        for s in range(n_shards):
            rest -= int(room[s])
            matrix[i, s] = hypergeometric(rng, int(room[s]), rest, left) if s < n_shards - 1 else left
            left -= int(matrix[i, s])
        room -= matrix[i]
    return matrix


def shard_rows(df: DataFrame, n_shards: int, seed: int = 0, rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    """All rows of ``df`` with ``shard`` (int, 0 to n_shards - 1) and ``slot`` (long, gapless from 0 in each shard).

    Every row order is equally likely; shard sizes differ by one at most.  Input
    columns named shard or slot are replaced.  Nulls and empty texts are
    ordinary values.  Fully equal rows each get a place of their own (which of
    them gets which is open).  An empty table gives an empty result.
    """
    df = df.drop("shard", "slot")
    names = df.columns
    total = df.count()
    n_parts = min(MAX_PARTITIONS, max(1, math.ceil(total / rows_per_partition)))
    bits = max(0, min(int(math.log2(MAX_PARTITIONS / n_shards)), math.ceil(math.log2(max(1, total / n_shards / rows_per_partition)))))
    content = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in names])

    def dealt(rows: DataFrame) -> DataFrame:
        """rows with __h, after the local permutation: __shard and the second random key __r."""
        rows = rows.withColumn("__part", F.pmod("__h", F.lit(n_parts)).cast("int"))
        local = Window.partitionBy("__part").orderBy(F.xxhash64(F.lit(seed + 1), "__h"), "__h")
        ranked = rows.withColumn("__rank", F.row_number().over(local).cast("long"))
        return (
            ranked.join(F.broadcast(cuts), "__part")
            .withColumn("__shard", F.size(F.filter("__cuts", lambda c: c < F.col("__rank"))))
            .withColumn("__r", F.xxhash64(F.lit(seed + 2), "__h"))
            # the leading bits of __r, in its own (signed) order
            .withColumn("__run", F.shiftright("__r", 64 - bits).cast("int") if bits else F.lit(0))
        )

    counts = dict(df.select(F.pmod(content, F.lit(n_parts)).cast("int").alias("p")).groupBy("p").count().collect())
    matrix = communication_matrix([counts.get(p, 0) for p in range(n_parts)], n_shards, seed)
    ends = np.cumsum(matrix, axis=1)
    spark = df.sparkSession
    cuts = spark.createDataFrame(
        [(p, ends[p, :-1].tolist()) for p in range(n_parts)],
        T.StructType([T.StructField("__part", T.IntegerType()), T.StructField("__cuts", T.ArrayType(T.LongType()))]),
    )
    runs = dealt(df.select(content.alias("__h"))).groupBy("__shard", "__run").count().collect()
    offsets, at = [], {}
    for shard, run, count in sorted(map(tuple, runs)):
        offsets.append((shard, run, at.get(shard, 0)))
        at[shard] = at.get(shard, 0) + count
    places = spark.createDataFrame(offsets, "__shard int, __run int, __before long")
    second = Window.partitionBy("__shard", "__run").orderBy("__r", "__h")
    return (
        dealt(df.withColumn("__h", content))
        .withColumn("__place", F.row_number().over(second))
        .join(F.broadcast(places), ["__shard", "__run"])
        .select(
            *[F.col(f"`{c}`") for c in names],
            F.col("__shard").cast("int").alias("shard"),
            (F.col("__before") + F.col("__place") - 1).alias("slot"),
        )
    )
