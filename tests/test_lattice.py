"""Key lattice and quantiles inside groups against plain forms."""

import random
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from prismtab.operators import groupkeys as GK
from prismtab.operators.cuboids import lattice_cells, plan_bases
from prismtab.operators.quantiles import group_quantile


def test_every_key_has_a_base_that_holds_it():
    rng = random.Random(1)
    for _ in range(200):
        columns = [f"c{i}" for i in range(rng.randint(1, 9))]
        distinct = {c: rng.choice([1, 2, 5, 30, 1000, 10**6]) for c in columns}
        every = [k for d in (1, 2, 3) for k in combinations(columns, d)]
        keys = rng.sample(every, rng.randint(1, len(every)))
        plan = plan_bases(keys, distinct, rng.choice([10, 10**4, 10**9]))
        assert sorted(k for own in plan.values() for k in own) == sorted(keys)
        assert all(set(k) <= set(base) for base, own in plan.items() for k in own)
    few = plan_bases(list(combinations("abcdef", 3)), dict.fromkeys("abcdef", 10), 10**9)
    assert len(few) == 1  # a large table is read once


def test_cells_are_those_of_single_aggregates(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["x", "y", None, "__NA__"]), rng.randrange(400), rng.choice([0.5, -0.0, 0.0, None]), rng.randrange(3), rng.randrange(2)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "a string, b int, c double, d int, m int")
    keys = [k for n in (1, 2, 3) for k in combinations("abcd", n)]
    for share in (0.0, 0.25, 10.0):
        got = lattice_cells(df, keys, {"n": F.lit(1), "m": F.col("m")}, share).collect()
        found = {(r["keys"], r.k1, r.k2, r.k3): (r.n, r.m) for r in got}
        assert len(found) == len(got)
        want: dict = {}
        text = [[("__NA__" if v is None else str(v).replace("-0.0", "0.0")) for v in r[:4]] for r in rows]
        for key in keys:
            at = ["abcd".index(c) for c in key]
            for r, t in zip(rows, text):
                place = ("|".join(key), *[t[i] for i in at], *[None] * (3 - len(at)))
                n, m = want.get(place, (0, 0))
                want[place] = (n + 1, m + r[4])
        assert found == want


def test_group_quantiles_are_numpys(spark):
    rng = random.Random(3)
    rows = [("hot", rng.choice([rng.random(), 0.25, 7.0, None])) for _ in range(6000)] + [(g, rng.random()) for g in ("a", "b", None) for _ in range(rng.randint(1, 40))]
    rows += [("one", 3.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    for fraction, ranges in ((0.5, None), (0.5, 1), (0.5, 16), (0.1, 16), (0.0, 3), (1.0, 3)):
        got = {r.g: r.q for r in group_quantile(df, ["g"], "x", fraction, "q", ranges).collect()}
        own = {g: [x for h, x in rows if h == g and x is not None] for g in {g for g, _ in rows}}
        assert set(got) == {g for g, x in own.items() if x}
        assert all(np.isclose(got[g], np.quantile(own[g], fraction)) for g in got)


def test_medians_among_group_statistics(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", None), (None, 5.0)], "g string, x double")
    got = {r.g: (r.x__median, r.x__count) for r in GK.fit_group_stats(df, ["g"], "x", ("median", "count")).collect()}
    assert got == {"a": (1.5, 2), "b": (None, 0), None: (5.0, 1)}
    assert GK.global_stats(df, "x", ("median",)).first()[0] == 2.0


def test_levels_beyond_the_bound_are_joined_without_a_broadcast(spark, monkeypatch):
    from prismtab.functions import cleaning

    df = spark.createDataFrame([(str(i % 50),) for i in range(500)] + [(None,)], "c string")
    want = sorted(r.c for r in cleaning.encode_categoricals([df], ["c"])[0].collect())
    monkeypatch.setattr(cleaning, "BROADCAST_BYTES", 10)
    assert sorted(r.c for r in cleaning.encode_categoricals([df], ["c"])[0].collect()) == want


def test_profile_rows_carry_the_key_name(spark, tmp_path):
    from prismtab.plans import q_groupkeys as Q

    rows = [(i, i * 3, "FOP"[i % 3], ("1-URGENT", "2-HIGH", None)[i % 3]) for i in range(60)]
    spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string").write.parquet(str(tmp_path / "orders.parquet"))
    got = Q.q_group_profile(spark, str(tmp_path))
    assert got.columns[:2] == ["key_name", "keys"]
    assert {(r.key_name, r["keys"]) for r in got.collect()} == {("__".join(k), "|".join(k)) for k in Q.PROFILE_CANDIDATES}
