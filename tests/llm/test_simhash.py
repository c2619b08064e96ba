import random

import numpy as np
import pyarrow as pa

from brute import frame, groups, simhash
from prismtab.llm import simhash as simhash_module
from prismtab.llm.components import components
from prismtab.llm.simhash import chain_keys, linked, near_duplicates, segments, text_fingerprints

EDGES = [None, "", "  \t\n", "One", "one two", "A b C d", "a b c d", "a  b\nc\td e", "é " * 50, "x" * 5000, "word " * 40_000]


def test_fingerprints_match_the_definition():
    random.seed(1)
    texts = EDGES + [" ".join(random.choice(["Of", "the", "réé", "x" * 40, "and,"]) for _ in range(random.randint(0, 60))) for _ in range(60)]
    assert text_fingerprints(pa.array(texts), 4).tolist() == [simhash(t) for t in texts]


def test_every_close_pair_shares_a_key_and_passes_its_chain():
    rng = np.random.default_rng(2)
    for bits in range(0, 7):
        a = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
        flip = np.array([sum(1 << int(b) for b in rng.choice(64, bits, replace=False)) for _ in range(3000)], np.uint64)
        found = np.zeros(3000, bool)
        for (row, ka), (_, kb) in [(chain_keys(a, 4), chain_keys(a ^ flip, 4))]:
            same = np.flatnonzero(ka == kb)
            start = ((ka[same] & np.uint64(255)) >> np.uint64(1)).astype(np.int64)
            found[row[same][linked(a[row[same]], (a ^ flip)[row[same]], start, 4)]] = True
        assert found.all() if bits <= 4 else not found.any()


def one_key(rows: int, close: int, seed: int):
    """Sorted keys and distinct fingerprints that share the key of the first segment and half; ``close`` of them have a partner."""
    rng = np.random.default_rng(seed)
    low, width = segments(4)[0]
    size = width + segments(4)[1][1] // 2
    fp = np.unique(rng.integers(0, 1 << 63, rows, dtype=np.uint64) << np.uint64(size))
    flip = np.array([sum(1 << int(b) for b in rng.choice(np.arange(size, 64), rng.integers(1, 5), replace=False)) for _ in range(close)], np.uint64)
    fp = np.unique(np.concatenate([fp, fp[:close] ^ flip]))
    return np.zeros(len(fp), np.uint64), fp


def test_long_keys_of_unlinked_fingerprints_are_divided(monkeypatch):
    """The components of one key are those of all its pairs that pass the chain; pairs asked for stay far below all."""
    asked = 0

    def counted(a, b, start, distance):
        nonlocal asked
        asked += len(a)
        return linked(a, b, start, distance)

    monkeypatch.setattr(simhash_module, "linked", counted)
    for long, rows, close in ((512, 16_000, 300), (8, 1_500, 200)):
        monkeypatch.setattr(simhash_module, "LONG", long)
        keys, fp = one_key(rows, close, rows)
        asked = 0
        found = simhash_module._forest(keys, fp, 4)
        assert asked < len(fp) ** 2 / 30
        want = set()
        for i in range(len(fp) - 1):
            near = np.flatnonzero(linked(np.repeat(fp[i], len(fp) - 1 - i), fp[i + 1 :], np.zeros(len(fp) - 1 - i, np.int64), 4))
            want |= {(int(fp[i]), int(fp[i + 1 + j])) for j in near}
        assert len(want) > close / 4

        def classes(pairs):
            root = {}

            def find(x):
                while root.setdefault(x, x) != x:
                    x = root[x]
                return x

            for a, b in pairs:
                a, b = find(a), find(b)
                root[max(a, b)] = min(a, b)
            return {x: find(x) for x in list(root)}

        assert classes(found) == classes(want)
        assert all((a ^ b).bit_count() <= 4 for a, b in found)


def test_components_are_those_of_brute_force(spark):
    random.seed(3)
    base = [[random.choice("abcdefghijklmnop") * random.randint(1, 4) for _ in range(150)] for _ in range(12)]
    rows = []
    for i, w in enumerate(base):
        for copy in range(8):
            own = list(w)
            for _ in range(copy):
                own[random.randrange(150)] = f"new{random.randint(0, 99)}"
            rows.append((1000 - 10 * i - copy, " ".join(own)))
    rows += [(i, t) for i, t in enumerate(EDGES)] + [(900, rows[0][1]), (900, rows[0][1])]
    got = near_duplicates(frame(spark, rows).select("doc_id", "text", "language"), "doc_id", "text").collect()
    rows.sort(key=lambda r: r[0])
    fps = [simhash(t) for _, t in rows]
    want = sorted((rows[i][0], fps[i], rows[g][0]) for i, g in enumerate(groups(fps)))
    assert sorted((r.key, r.fp % (1 << 64), r.component) for r in got) == want
    assert len({w[2] for w in want}) < len(want)


def test_null_keys_and_empty_table(spark):
    got = near_duplicates(frame(spark, [(None, "a b c d e f"), (3, "a b c d e f"), (None, "something else, alone here")])).collect()
    assert sorted((r.key or 0, r.component or 0) for r in got) == [(0, 0), (0, 3), (3, 3)]
    assert near_duplicates(frame(spark, [])).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(10, 60)] + [(500, i) for i in range(501, 540)] + [(7, 7), (-4, 700)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 10 for i in range(10, 61)} | {i: 500 for i in range(500, 540)} | {-4: -4, 700: -4}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
