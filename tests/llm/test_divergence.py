import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from prismtab.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, least=10, top=10):
    rows = [(t or "", l or "", s or "") for t, l, s in rows]
    out = []
    for lang in {l for _, l, _ in rows}:
        docs = [(TERM.findall(t.translate(LOWER)), s) for t, l, s in rows if l == lang]
        df = Counter(x for ts, _ in docs for x in set(ts))
        kept = sorted((x for x in df if df[x] >= least), key=str.encode)
        v, sources = len(kept), {s for _, s in docs}
        count = {s: Counter(x for ts, o in docs if o == s for x in ts if df[x] >= least) for s in sources}
        whole = sum(count.values(), Counter())

        def share(c):
            n = sum(c.values())
            return {x: 1 + 10**9 * (c[x] + 2) // (n + 2 * v) for x in kept}

        p, q = {s: share(c) for s, c in count.items()}, share(whole)
        gap = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(o, sum(gap(p[s][x], p[o][x]) for x in kept)) for o in sources - {s}]
            terms = [(x, gap(p[s][x], q[x])) for x in kept if count[s][x] and p[s][x] > q[x]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda e: (-e[1], e[0].encode()))
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(found[:most], 1)]
    return sorted(out)


def rows_of(seed, n=400):
    rng = random.Random(seed)
    words = ["the", "The", "été", "Été", "x1y", "don't", "日本", "𝒳", "ß", "a_b"] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]
    rows = []
    for _ in range(n):
        source = rng.choice(["s1", "s2", "s10", "", None, "é", "S"])
        own = words[: 20 + 30 * len(source or "")]
        rows.append((" ".join(rng.choices(own, k=rng.randint(0, 25))), rng.choice(["en", "fr", None, ""]), source))
    return rows + [(None, "en", "empty"), ("", "de", "a"), ("only once", "de", "b"), ("hot " * 60_000, "en", "s1"), (None, None, None)]


def found(spark, rows, **options):
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "text string, lang string, source string, place int, item string, value string")
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in divergence.audit(docs, **options).collect())


def test_audit_is_that_of_brute_force(spark):
    for seed in (1, 2):
        rows = rows_of(seed)
        assert found(spark, rows) == brute(rows)
    assert found(spark, rows, least=3, top=2) == brute(rows, 3, 2)


def test_blocks_of_sources_and_stretches_change_nothing(spark, monkeypatch):
    rows = rows_of(3)
    monkeypatch.setattr(divergence, "SOURCES", 2)
    monkeypatch.setattr(divergence, "STRETCH", 16)
    assert found(spark, rows) == brute(rows)


def test_no_rows_and_no_terms(spark):
    assert found(spark, []) == []
    assert found(spark, [("rare", "en", "a"), (None, "en", "b")]) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_sparse_sums_are_dense_ones():
    rng = np.random.default_rng(1)
    for n, width in ((1, 1), (5, 40), (9, 3)):
        none = rng.integers(1, 50, n)
        at = np.argwhere(rng.random((n, width)) < 0.3)
        shares = rng.integers(1, 10**9, len(at))
        dense = np.repeat(none[:, None], width, 1)
        dense[at[:, 0], at[:, 1]] = shares
        want = np.array([[divergence.gap(a, b).sum() for b in dense] for a in dense])
        assert (divergence.pair_sums(at, none, shares, width) == want).all()


def test_bags_hold_each_term_of_a_group_once_per_power_of_two():
    texts, groups = ["a b a", "b", "a a a a", None, "c"], [7, 7, 7, 7, 9]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["en"] * 5), pa.array(groups)], ["text", "lang", "group"])
    bags = [row for out in divergence.term_bags([batch]) for row in out.to_pylist()]
    assert sorted((r["group"], r["weight"], sorted(x.split("\0")[1] for x in r["terms"])) for r in bags) == [(7, 2, ["a", "b"]), (7, 4, ["a"]), (9, 1, ["c"])]
    assert [sorted(r["terms"]) for out in divergence.term_lists([batch]) for r in out.to_pylist()] == [["en\0a", "en\0b"], ["en\0b"], ["en\0a"], [], ["en\0c"]]


def test_lists_hold_a_term_once_per_text_up_to_the_minimum():
    texts = ["a b", "a a c", "a", "a b", None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["en"] * 4 + ["de"]), pa.array([7] * 5)], ["text", "lang", "group"])
    for least, want in ((1, ["abc"]), (2, ["abc", "ab"]), (3, ["abc", "ab", "a"]), (9, ["abc", "ab", "a", "a"])):
        rows = [r["terms"] for out in divergence.term_lists([batch], least) for r in out.to_pylist()]
        assert [sorted(r) for r in rows] == [[f"en\0{x}" for x in w] for w in want]
    empty = batch.slice(4)
    assert [r for out in divergence.term_lists([empty], 3) for r in out.to_pylist()] == []


def test_vocabulary_is_that_of_all_texts_across_slices(spark, monkeypatch):
    rows = rows_of(4)
    seen, plain = [], divergence.CountVectorizer.fit

    def fit(self, df):
        seen.append(df.select(F.sum(F.size("terms"))).first()[0])
        return plain(self, df)

    monkeypatch.setattr(divergence.CountVectorizer, "fit", fit)
    assert found(spark, rows, least=2) == brute(rows, 2)
    whole = seen[-1]
    monkeypatch.setattr(divergence, "SLICE", 64)  # a few texts a slice: a term's texts add up over slices
    assert found(spark, rows, least=2) == brute(rows, 2)
    pairs = sum(len(set(TERM.findall((t or "").translate(LOWER)))) for t, _, _ in rows)
    assert whole < pairs  # fewer than one entry per text and term reach the fit


def test_bags_come_from_texts_of_a_group_side_by_side(spark, monkeypatch):
    words = [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(" ".join(words), f"l{g % 2}", f"s{g}") for _ in range(8) for g in range(8)]
    seen, plain = [], divergence.CountVectorizer.fit

    def fit(self, df):
        model = plain(self, df)
        monkeypatch.setattr(model, "transform", lambda bags, own=model.transform: seen.append(bags) or own(bags))
        return model

    monkeypatch.setattr(divergence.CountVectorizer, "fit", fit)
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(8)
    assert sorted(tuple(r) for r in divergence.audit(docs).collect()) == brute(rows)
    # 8 occurrences a group, one power of two: each term of a group once, however the rows are spread
    assert seen[0].select(F.sum(F.size("terms"))).first()[0] == 8 * len(words)


def test_rows_by_group_are_all_rows_also_of_a_large_group(spark):
    rows = [(f"{i} " + "x" * 500, "en", 0 if i % 4 else i) for i in range(2000)]
    texts = spark.createDataFrame(rows, "text string, lang string, group long").repartition(16)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "2k")
    try:
        got = divergence.by_group(texts).withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.set(size, before)
    assert sorted((r.text, r.lang, r.group) for r in got) == sorted(rows)
    assert len({r.part for r in got if r.group == 0}) > 1          # no one task has to take a large group
    for part in {r.part for r in got}:
        own = [r.group for r in got if r.part == part]
        assert own == sorted(own)


def test_shares_are_exact_up_to_the_largest_counts(spark):
    edge = 2**63 // divergence.SCALE
    counts = [0, 1, 9, *range(edge - 5, edge + 4), 10**15]
    rows = [(c, t, v) for c in counts for t in (max(c, 1), 3 * c + 7, 10**16) for v in (1, 977)]
    df = spark.createDataFrame(rows, "count long, total long, terms long").selectExpr("*", divergence.share("count", "total") + " as p", divergence.share("0", "total") + " as none")
    assert dict(df.dtypes)["p"] == "bigint"
    for r in df.collect():
        assert r.p == 1 + divergence.SCALE * (r["count"] + 2) // (r.total + 2 * r.terms)
        assert r.none == 1 + divergence.SCALE * 2 // (r.total + 2 * r.terms)
