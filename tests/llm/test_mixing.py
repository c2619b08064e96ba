import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from brute import words
from prismtab.llm import mixing


def seats(targets, sizes, blocks, block, most=3):
    """Seats one after the other, by highest quotient."""
    won, order = [0] * len(targets), []
    for _ in range(blocks):
        best = max(((t / (2 * s + 1), -i) for i, (t, s) in enumerate(zip(targets, won)) if t > 0 and (s + 1) * block <= most * sizes[i]), default=None)
        if best is None:
            break
        won[-best[1]] += 1
        order.append(-best[1])
    return order


def water(sizes, weights, most=3):
    """Targets by resharing the excess until none is above."""
    total, full = sum(sizes), set()
    while True:
        rest = [i for i in range(len(sizes)) if i not in full]
        free = total - sum(most * sizes[i] for i in full)
        share = {i: free * weights[i] / sum(weights[j] for j in rest) for i in rest}
        over = {i for i in rest if share[i] >= most * sizes[i]}
        if not over:
            return [share.get(i, float(most * sizes[i])) for i in range(len(sizes))]
        full |= over


def brute(rows, shards, seed=13, most=3):
    rows = [(k, s, len(words(t))) for k, s, t in rows]
    names = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, (s or "").encode()))
    size = Counter()
    for _, s, n in rows:
        size[s] += n
    sizes = [size[s] for s in names]
    aims = water(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))])
    block = max(1, min(1024, int(min([a for a in aims if a > 0], default=0) // 256)))
    order = seats(aims, sizes, sum(sizes) // block, block)
    h = sum(sizes) // block
    out = []
    for i, name in enumerate(names):
        line = sorted((hashlib.md5(f"{seed}:{'' if k is None else k}".encode()).hexdigest(), k is not None, k or 0, n, k) for k, s, n in rows if s == name)
        stream = [(place, copy) for copy in range(most) for place, own in enumerate(line) for _ in range(own[3])]
        taken, pieces = Counter(), defaultdict(set)
        at = 0
        for shard in range(shards):
            for _ in range(order[h * shard // shards : h * (shard + 1) // shards].count(i)):
                for place, copy in stream[at : at + block]:
                    taken[place] += 1
                    pieces[place].add((shard, copy))
                at += block
        out += [(own[4], name, own[3], sizes[i], round(aims[i], 6), taken[place], len(pieces[place])) for place, own in enumerate(line)]
    return Counter(out)


def rows_of(seed, n=120):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["a", "b", "B", "é", "", None, "z", "one", "tiny"][: rng.randint(1, 9)]), "w " * rng.choice([0, 1, 3, 30, 300])) for i in range(n)]
    return rows + [(None, "a", "x y"), (None, "a", "x y"), (5, "a", None), (7, "tiny", "one\ttwo\x0bthree"), (8, "long", "w " * 50_000), (9, "none", "")]


@pytest.mark.parametrize("seed", range(4))
def test_mix_is_that_of_brute_force(spark, seed):
    rows = rows_of(seed)
    docs = spark.createDataFrame([(*r, 1, "o") for r in rows], "doc_id long, source string, text string, size int, order string").withColumn("target", F.lit(1)).withColumn("slice", F.lit("x"))
    mixed = mixing.mix(docs, mixing.word_count(F.col("text")), shards=7)
    got = Counter((r.doc_id, r.source, r.size, r.source_size, round(r.target, 6), r.taken, len({(p.shard, p.copy) for p in r.pieces})) for r in mixed.collect())
    assert got == brute(rows, 7)


def test_sources_come_near_their_targets_and_pieces_add_up(spark):
    rows = rows_of(9, 3000)
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), mixing.word_count(F.col("text")), shards=5)
    found = mixed.collect()
    for r in found:
        assert r.taken == sum(p.words for p in r.pieces) <= 3 * r["size"]
        assert all(0 <= p.first and p.first + p.words <= r["size"] for p in r.pieces)
    for source in {r.source for r in found}:
        own = [r for r in found if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(1, 0.01 * own[0].target)
    shards = Counter()
    for r in found:
        for p in r.pieces:
            shards[p.shard] += p.words
    assert max(shards.values()) <= 1.05 * min(shards.values())
    again = mixing.mix(spark.createDataFrame(rows[::-1], "doc_id long, source string, text string").repartition(13), mixing.word_count(F.col("text")), shards=5)
    assert Counter(map(str, again.collect())) == Counter(map(str, found))


def test_no_rows_and_no_words(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.mix(docs, mixing.word_count(F.col("text"))).collect() == []
    docs = spark.createDataFrame([(1, None, None), (2, "a", "")], "doc_id long, source string, text string")
    assert [(r.taken, r.pieces, r.target) for r in mixing.mix(docs, mixing.word_count(F.col("text"))).collect()] == [(0, [], 0.0)] * 2


def test_only_built_in_expressions(spark):
    docs = spark.createDataFrame(rows_of(1), "doc_id long, source string, text string")
    plan = mixing.mix(docs, mixing.word_count(F.col("text")))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian"))
