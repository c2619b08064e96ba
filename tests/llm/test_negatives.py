import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from prismtab.llm import negatives

COLUMNS = "vec_id long, embedding array<float>, label int, id int, place string, score string, folder int"


def brute(rows, every=50, positives=5, negatives=3):
    live = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        live.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    key = lambda e: (-e[0], e[1] is None, e[1] or 0)
    out = []
    for i, v, label in live:
        if i is None or i % every:
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), j, l) for j, w, l in live if j != i]
        own = sorted((s for s in scored if s[2] == label), key=key)[:positives]
        for p in own:
            good = sorted((s for s in scored if s[2] != label and 50 * p[0] <= 100 * s[0] <= 95 * p[0]), key=key)[:negatives]
            out += [(i, p[1], rank, n[1], p[0], n[0]) for rank, n in enumerate(good, 1)]
    return sorted(out, key=str)


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], COLUMNS)
    return sorted((tuple(r) for r in negatives.mine(df, **options).collect()), key=str)


def rows_of(seed, n=1500, dims=8):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    rows = [(i, [c + rng.gauss(0, 0.5) for c in centres[rng.randrange(6)]], rng.randrange(4)) for i in range(n)]
    same = [0.5] * dims
    rows += [(n + i, same, rng.randrange(4)) for i in range(400)]  # a very common vector
    nan, inf = float("nan"), float("inf")
    rows += [(None, same, 1), (None, [0.1] * dims, 2), (50, same, None), (100, None, 1), (150, [nan] * dims, 1), (200, [inf, 1.0], 1), (250, [1.0, None], 1),
             (300, [], 1), (350, [1.0], 2), (400, same, 3), (400, same, 3), (-50, [2.0] * (dims + 2), 0), (450, [-1.0] * dims, 77)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_negatives_are_those_of_brute_force(spark, seed):
    rows = rows_of(seed)
    assert found(spark, rows) == brute(rows)


def test_blocks_folders_and_batches_change_nothing(spark, monkeypatch):
    for name, value in (("BLOCK", 16), ("FOLDER", 64), ("BATCH_ROWS", 7)):
        monkeypatch.setattr(negatives, name, value)
    rows = rows_of(3, 300)
    assert found(spark, rows, every=30) == brute(rows, 30)


def test_bounds_let_whole_blocks_unread(spark, monkeypatch):
    """Well parted clusters: an anchor's questions need few of the folders."""
    monkeypatch.setattr(negatives, "BLOCK", 16)
    monkeypatch.setattr(negatives, "FOLDER", 16)
    rng = random.Random(4)
    rows = [(i, [8.0 * (i % 8 == d) + rng.gauss(0, 0.1) for d in range(8)], i % 16) for i in range(2000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    path = f"{spark.sparkContext.getCheckpointDir()}/zones"
    held = negatives.write_blocks(negatives.usable(df, "vec_id", "embedding", F.col("label")), path, 50)
    blocks = spark.read.schema(negatives.STORED).parquet(path)
    own = negatives.Batch(np.array([0]), np.array([0]), np.array([[2048, 0, 0, 0, 0, 0, 0, 0]]), held["store"], 5)
    own.floor[:] = 2048 * 2000
    need = negatives.needed(blocks, spark.sparkContext.broadcast(own), held["dims"], negatives.for_positives)
    assert 0 < len(need) < len(held["anchors"]) / 3
    assert found(spark, rows) == brute(rows)


def test_no_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(50, None, 1), (100, [1.0], None)]) == []
    assert found(spark, [(0, [], 1), (1, [], 1), (2, [], 2)]) == [(0, 1, 1, 2, 0, 0)]


@pytest.mark.parametrize("dims, bits", [(1, 5), (2, 4), (3, 3), (4, 2)])
def test_hilbert_neighbours_touch(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    place = negatives.hilbert(cells, bits)
    assert sorted(place.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(1) == 1).all()
