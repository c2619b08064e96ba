import numpy as np

from brute import frame
from prismtab.llm.sharding import communication_matrix, hypergeometric, shard_rows


def test_matrix_has_the_given_sums():
    counts = [5, 0, 1000, 37, 2]
    m = communication_matrix(counts, 7, 3)
    assert m.sum(1).tolist() == counts
    assert m.sum(0).max() - m.sum(0).min() <= 1 and (m >= 0).all()
    assert (m == communication_matrix(counts, 7, 3)).all()


def test_hypergeometric_beyond_the_library_has_the_right_moments():
    rng = np.random.default_rng(1)
    good, bad, draws = 2 * 10**9, 6 * 10**9, 4000
    x = np.array([hypergeometric(rng, good, bad, draws) for _ in range(400)])
    assert abs(x.mean() - draws / 4) < 6 and 20 < x.std() < 35
    assert hypergeometric(rng, good, bad, 0) == 0 and hypergeometric(rng, good, 0, 9) == 9


def test_shards_are_exact_and_slots_gapless(spark):
    rows = [(i, f"text {i}") for i in range(997)] + [(None, None), (None, ""), (5, "text 5"), (5, "text 5"), (7, "x" * 100_000)]
    df = frame(spark, rows)
    out = shard_rows(df, 40, seed=1, rows_per_partition=64)
    assert out.columns == [c for c in df.columns if c != "shard"] + ["shard", "slot"]
    got = out.select("doc_id", "text", "shard", "slot").collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in got) == sorted((a is None, a or 0, t or "") for a, t in rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert set(by) == set(range(40))
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    sizes = [len(x) for x in by.values()]
    assert max(sizes) - min(sizes) <= 1
    again = shard_rows(df.repartition(5), 40, seed=1, rows_per_partition=64).select("doc_id", "text", "shard", "slot").where("doc_id > 7").collect()
    assert {(r.doc_id, r.shard, r.slot) for r in again} == {(r.doc_id, r.shard, r.slot) for r in got if r.doc_id and r.doc_id > 7}
    # neighbours are spread: the order within shards has nothing to do with the ids
    one = [r.doc_id for r in sorted((r for r in got if r.shard == 3 and r.doc_id is not None), key=lambda r: r.slot)]
    assert one != sorted(one)


def test_empty_table_and_fewer_rows_than_shards(spark):
    assert shard_rows(frame(spark, []), 40).count() == 0
    got = shard_rows(frame(spark, [(1, "a"), (2, "b")]), 40).select("shard", "slot").collect()
    assert len({r.shard for r in got}) == 2 and {r.slot for r in got} == {0}
