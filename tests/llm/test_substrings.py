import random

from brute import frame, without_repeats
from prismtab.llm import substrings


def check(spark, rows, size):
    got = substrings.remove_repeats(frame(spark, rows), "doc_id", "text", size=size)
    assert {"n_words", "n_removed", "kept", "key", "row", "bucket"} <= set(got.columns)
    want = without_repeats(rows, size)
    found = sorted((r.doc_id is None, r.doc_id or 0, r.text or "", r.n_words, r.n_removed, r.kept) for r in got.collect())
    assert found == sorted((k is None, k or 0, t or "", *w) for (k, t), w in zip(rows, want))
    return sum(w[1] for w in want)


def test_removal_matches_brute_force(spark):
    random.seed(4)
    passages = [" ".join(random.choice("abcdefgh") for _ in range(30)) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = [" ".join(f"w{random.randint(0, 400)}" for _ in range(random.randint(0, 40)))]
        if random.random() < 0.5:
            parts.insert(random.randrange(2), random.choice(passages))
        rows.append((random.randint(-50, 100), random.choice([" ", "\n", "\t  "]).join(parts)))
    rows += [(None, passages[0]), (None, None), (3, None), (4, ""), (5, " \n "), (200, passages[1]), (200, passages[1]), (201, passages[1] + " " + passages[1])]
    rows += [(300, "r " * 3000), (301, "r " * 700), (302, "é x " * 40), (303, "é x " * 40)]
    assert check(spark, rows, 12) > 1000


def test_long_texts_cross_chunks(spark, monkeypatch):
    monkeypatch.setattr(substrings, "CHUNK", 64)
    monkeypatch.setattr(substrings, "LONGEST", 5)
    random.seed(5)
    long = " ".join(random.choice("abcd") for _ in range(900))
    rows = [(1, long), (2, "x " + long[300:900] + " y"), (3, " ".join(random.choice("abcd") for _ in range(600)))]
    assert sum(len(x) for _, x in rows) and check(spark, rows, 9) > 200


def test_empty_table(spark):
    assert substrings.remove_repeats(frame(spark, [])).count() == 0
