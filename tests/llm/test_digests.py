import random

import numpy as np
import pyarrow as pa

from brute import frame
from pyspark.sql import functions as F
from prismtab.llm import digests

RANKS = np.arange(digests.CLASSES, dtype=np.int32)[::-1].copy()


def entropy(window):
    n = np.bincount(window)
    n = n[n > 0] / len(window)
    return -(n * np.log2(n)).sum()


def test_entropy_classes_match_the_definition():
    rng = np.random.default_rng(8)
    raw = np.concatenate([rng.integers(97, 123, 400), rng.integers(0, 256, 300), np.full(200, 65), rng.integers(97, 99, 200)]).astype(np.uint8)
    got = digests.entropy_classes(raw)
    want = [entropy(raw[i : i + 64]) / 6 * 1000 for i in range(len(raw) - 63)]
    assert np.abs(got - np.floor(np.array(want) + 1e-9)).max() <= 1


def chosen(data, ranks):
    """Places of the selected windows, from the definition."""
    raw = np.frombuffer(data, np.uint8)
    classes = digests.entropy_classes(raw)
    votes = {}
    for i in range(len(classes) - 63):
        best = min((int(ranks[classes[j]]), j) for j in range(i, i + 64) if classes[j] >= digests.WEAK)
        votes[best[1]] = votes.get(best[1], 0) + 1
    return sorted(j for j, v in votes.items() if v >= digests.VOTES)


def test_digests_do_not_depend_on_the_batch_and_hold_the_selected_windows():
    random.seed(9)
    texts = ["", None, "a", "abcdefgh", "x" * 63, "x" * 1000] + [" ".join(random.choice("the of and été longer words come here".split()) + random.choice("xyz") for _ in range(n)) for n in (5, 30, 60, 200, 900, 5000)]
    together = digests.digests(pa.array(texts), RANKS)
    assert together == [digests.digests(pa.array([t]), RANKS)[0] for t in texts]
    assert together[0] == together[1] == "" and all(together[2:])
    import base64

    import xxhash

    for t, d in zip(texts[-4:], together[-4:]):
        data = t.encode()
        at = chosen(data, RANKS)
        bits = np.unpackbits(np.frombuffer(base64.b64decode(d), np.uint8)).reshape(-1, digests.BITS)
        assert len(bits) == -(-len(at) // digests.CAPACITY)
        want = np.zeros_like(bits)
        for i, p in enumerate(at):
            h = xxhash.xxh64_intdigest(data[p : p + 64])
            for k in range(5):
                want[i // digests.CAPACITY, h >> 11 * k & 2047] = 1
        assert (bits == want).all()


def test_likeness_orders_edits():
    random.seed(10)
    voc = ["".join(random.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(random.randint(2, 9))) for _ in range(800)]
    text = " ".join(random.choice(voc) for _ in range(1500))
    other = " ".join(random.choice(voc) for _ in range(1500))
    edits = [text, text[:9000] + other[9000:], text[:3000] + other[3000:], other]
    made = digests.digests(pa.array(edits), RANKS)
    like = [digests.overlap(made[0], d) for d in made]
    assert like[0] == 1 and like[0] > like[1] > like[2] > like[3] and like[3] < 0.05
    assert [digests.overlap(d, made[0]) for d in made] == like
    assert digests.overlap("", "") == 1 and digests.overlap("", made[0]) == 0


def follows(rows):
    """The next row's text in the defined order, apart from how texts of equal keys are ordered."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    return [(a[0], a[1], b[1]) for a, b in zip(order, order[1:] + order[:1])]


def test_next_texts(spark, monkeypatch):
    monkeypatch.setattr(digests, "RANGE_BYTES", 60)
    rows = [(i * 3 - 40, f"text {i}") for i in range(60)] + [(None, "n"), (10**12, None)]
    df = frame(spark, rows)
    got = digests.with_next(df)
    assert got.columns == [*df.columns, "next_text"]
    assert sorted(((r.doc_id or 0, r.text or "", r.next_text or "") for r in got.collect())) == sorted((a or 0, t or "", n or "") for a, t, n in follows(rows))
    nulls = [(None, f"{i}") for i in range(40)] + [(5, "a"), (5, "b"), (5, "b")]
    got = [(r.text, r.next_text) for r in digests.with_next(frame(spark, nulls)).collect()]
    assert sorted(a for a, _ in got) == sorted(b for _, b in got) == sorted(t for _, t in nulls)
    assert [tuple(r) for r in digests.with_next(frame(spark, [(1, "only")])).select("text", "next_text").collect()] == [("only", "only")]
    assert digests.with_next(frame(spark, [])).count() == 0


def test_columns_through_spark(spark):
    rows = [(1, "some text " * 50), (2, None), (3, ""), (1, "some text " * 50), (4, "é" * 70_000)]
    df = frame(spark, rows)
    ranks = digests.entropy_ranks(df)
    assert sorted(ranks) == list(range(digests.CLASSES))
    out = digests.fingerprints(df, {"text": "language"}, ranks).withColumn("like", digests.likeness("language", "language"))
    got = out.select("doc_id", "language", "like").collect()
    assert all(r.like == 1 for r in got) and len({r.language for r in got if r.doc_id == 1}) == 1
    assert [r.language for r in got if r.doc_id in (2, 3)] == ["", ""]
    assert digests.fingerprints(df.limit(0), {"text": "f"}, digests.entropy_ranks(df.limit(0))).where(F.lit(True)).count() == 0
