import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brute import frame
from conftest import SF_MID
from prismtab.llm import language


def test_held_out_accuracy_from_the_text_alone(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").where(F.length("text") > 100)
    learned = language.fit(docs.where("doc_id % 2 = 0"), "text", "lang")
    got = language.identify(docs.where("doc_id % 2 = 1"), "text", model=learned).select("lang", "language", "accepted").collect()
    assert sum(r.lang == r.language and r.accepted for r in got) >= 0.98 * len(got)


def test_declared_language_and_hosts_decide_short_texts(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    learned = language.fit(docs, "text", "lang")
    names = {"en": "a.example.co", "fr": "b.example.fr"}
    known = docs.where(F.col("lang").isin("en", "fr")).select("doc_id", "text", F.col("lang").alias("said"), F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[F.col("lang")].alias("at"))
    # "on" and "en" alone say little; a new host of a French suffix, a host, and a declaration tell
    short = spark.createDataFrame(
        [(-1, "est on", "", "new.other.fr"), (-2, "est on", "", "a.example.co"), (-3, "ouon", "fr", ""), (-4, "ouon", "en", ""), (-5, "12 ... 34", "fr", "b.example.fr"), (-6, None, "fr", None), (-7, "", None, "")],
        known.schema)
    got = {r.doc_id: r for r in language.identify(known.unionAll(short), "text", F.col("said"), F.col("at"), model=learned).where("doc_id < 0").collect()}
    assert got[-2].language == "en" and got[-1].language == "fr"
    assert (got[-3].language, got[-4].language) == ("fr", "en")
    assert all(got[i].language == "und" and not got[i].accepted and got[i].probability == 1 for i in (-5, -6, -7))


def test_clashing_columns_repeated_rows_and_empty_tables(spark):
    rows = [(i, "the and of with that this from") for i in range(5)] + [(9, "le la les des que qui dans")] * 3 + [(None, "x" * 100_000)]
    df = frame(spark, rows).withColumn("lang", F.when(F.col("text").startswith("the"), "en").when(F.col("text").startswith("le"), "fr"))
    out = language.identify(df, "text", F.col("lang"), F.col("host"), label="lang")
    assert out.count() == len(rows) and out.columns.count("language") == 1
    assert {(r.lang, r.language) for r in out.where("lang is not null").collect()} == {("en", "en"), ("fr", "fr")}
    none = language.identify(df.drop("lang").withColumn("lang", F.lit(None).cast("string")), "text", F.col("lang"), F.col("host"), label="lang")
    assert {r.language for r in none.collect()} == {"und"}
    assert language.identify(df.limit(0), "text", F.col("lang"), F.col("host"), label="lang").count() == 0


def test_hosts_and_declarations_are_read_from_addresses_and_markup(spark):
    rows = [("https://user:x@Blog.Example.COM:81/fr?q", "<!doctype html><HTML class=x lang='de-AT'>"), ("src7", "<html><p lang=fr>"), (None, None), ("http://", "")]
    got = spark.createDataFrame(rows, "u string, h string").select(language.host_of(F.col("u")).alias("a"), language.declared_of(F.col("h")).alias("b")).collect()
    assert [tuple(r) for r in got] == [("blog.example.com", "de"), ("src7", ""), ("", ""), ("", "")]


def test_many_hosts_are_joined_without_a_broadcast(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").where("doc_id < 100")
    args = (docs, "text", F.col("lang"), F.col("source"))
    wide = sorted(map(tuple, language.identify(*args, label="lang").select("doc_id", "language").collect()))
    monkeypatch.setattr(language, "BROADCAST_HOSTS", 0)
    assert sorted(map(tuple, language.identify(*args, label="lang").select("doc_id", "language").collect())) == wide


def test_texts_too_short_for_a_trigram_are_decided_by_the_other_evidence(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").where(F.col("lang").isin("en", "fr"))
    known = docs.select("doc_id", "text", F.col("lang").alias("said"), F.concat(F.col("lang"), F.lit(".example")).alias("at"))
    short = [(-1, "A.", "en", "en.example"), (-2, "é", "fr", "fr.example"), (-3, "y", "", "fr.example"), (-4, "A", "en", None),
             (-5, "1.", "en", "en.example"), (-6, "²", "en", "en.example"), (-7, " ", "en", "en.example"), (-8, None, "en", "en.example"), (-9, "1234 5678", "en", "en.example")]
    rows = known.unionAll(spark.createDataFrame(short, known.schema))
    found = language.identify(rows, "text", F.col("said"), F.col("at"), model=language.fit(docs, "text", "lang")).where("doc_id < 0").collect()
    got = {r.doc_id: r for r in found}
    assert [(got[-i].language, got[-i].accepted) for i in range(1, 5)] == [("en", True), ("fr", True), ("fr", True), ("en", True)]
    assert all(0.5 <= got[-i].probability < 1 for i in range(1, 5))
    assert all((got[-i].language, got[-i].accepted, got[-i].probability) == ("und", False, 1) for i in range(5, 10))


def test_the_pipeline_keeps_short_documents_with_a_letter(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    first = docs.where("lang = 'en'").limit(1)
    short = first.withColumn("doc_id", F.lit(-1).cast("long")).withColumn("text", F.lit("A."))
    kept = corpus_pipeline.language_id(spark, docs.unionByName(short.select(docs.columns)), SF_MID)
    assert [r.text for r in kept.where("doc_id = -1").collect()] == ["A."]


def fused(rows, temper=0.3, und=0.01, strength=20.0):
    """(language, probability) of each (text, declared, host) row, written out: counts, evidence and priors by plain loops."""

    def grams(text):
        own = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in (text or "").lower().encode())
        return [((own[i] << 16 | own[i + 1] << 8 | own[i + 2]) * 2654435761 % (1 << 32)) >> 16 for i in range(len(own) - 2) if own[i : i + 3] != b"   "]

    counts = defaultdict(Counter)
    for text, said, _ in rows:
        if said:
            counts[said].update(grams(text))
    names = sorted(counts)
    k, every = len(names) + 1, Counter()
    for own in counts.values():
        every.update(own)
    total, flat = sum(every.values()), -math.log(1 << 16)
    shared = lambda g: (every[g] + 0.5) / (total + 0.5 * (1 << 16))

    def likelihood(text):
        own = grams(text)
        return [temper * sum(math.log((counts[n][g] + 200 * shared(g)) / (sum(counts[n].values()) + 200)) for g in own) for n in names] + [temper * flat * len(own)]

    def normal(logs):
        top = max(logs)
        own = [math.exp(x - top) for x in logs]
        return [x / sum(own) for x in own]

    kind = lambda said: names.index(said) + 1 if said in names else 0
    mass, hosts = [[0.0] * k for _ in range(k + 2)], defaultdict(lambda: [0.0] * k)
    for text, said, host in rows:
        if grams(text):
            alone = normal([x + math.log((1 - und) / (k - 1)) for x in likelihood(text)[:-1]] + [likelihood(text)[-1] + math.log(und)])
            for i, p in enumerate(alone):
                mass[kind(said)][i] += p
                hosts[host or ""][i] += p
        else:
            hosts[host or ""]
    add = lambda many: [sum(x) for x in zip(*many)]
    world = [(x + 1) / (sum(map(sum, mass)) + k) for x in add(mass)]
    declared = add(mass[1:])
    given = [[0.0] * k] + [[math.log((row[i] + 0.05 * declared[i] + 1) / (declared[i] * (1 + 0.05 * (k + 1)) + k + 1)) for i in range(k)] for row in mass[1:]]
    smooth = lambda own, above: [(x + strength * y) / (sum(own) + strength) for x, y in zip(own, above)]
    suffix, domain = (lambda h: h.split(".")[-1]), (lambda h: ".".join(h.split(".")[-2:]))

    def prior(host):
        if not host:
            return world
        above = smooth(add(v for h, v in hosts.items() if suffix(h) == suffix(host)), world)
        above = smooth(add(v for h, v in hosts.items() if domain(h) == domain(host)), above)
        return smooth(hosts[host], above)

    out = []
    for text, said, host in rows:
        if not any(c.isalpha() for c in text or ""):
            out.append(("und", 1.0))
            continue
        post = normal([a + b + math.log(c) for a, b, c in zip(likelihood(text), given[kind(said)], prior(host))])
        best = max(range(k), key=lambda i: (post[i], -i))
        out.append(((*names, "und")[best], post[best]))
    return out


def test_posteriors_are_those_written_out(spark):
    said = ["en", "fr", "de", "", None]
    words = {"en": "the of and that with", "fr": "le des que qui dans", "de": "der und die nicht mit"}
    rows = [(" ".join(words[n].split()[i % 5 :] + [f"w{i}", "on"]), said[(i + j) % 5] if i % 4 == 0 else n, ["a.x.fr", "b.x.fr", "c.y.fr", "d.de", "", None][(i + 2 * j) % 6])
            for j, n in enumerate(words) for i in range(12)]
    rows += [("on", "fr", "new.x.fr"), ("A", "", "d.de"), ("12", "en", "d.de"), (None, "en", ""), ("", None, None), ("on on", "", ""), ("on on", "", "")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, text string, said string, host string")
    got = language.identify(df, "text", F.col("said"), F.col("host"), label="said").orderBy("i").collect()
    want = fused(rows)
    assert [r.language for r in got] == [w[0] for w in want]
    assert np.allclose([r.probability for r in got], [w[1] for w in want], atol=1e-5)
    assert len({w[0] for w in want}) == 4


def test_long_texts_are_read_in_chunks(monkeypatch):
    column = pa.array(["", "Aé b, c!", None, "x", "the end " * 50, "ab", "", "1 2"])
    want = [(row, edges.tolist(), bucket.tolist()) for row, edges, bucket in language.trigrams(column)]
    assert len(want) == 1
    _, offsets, whole = want[0]
    offsets = [0, *offsets]  # the first row is empty
    for chunk in (1, 2, 7, 64):
        monkeypatch.setattr(language, "CHUNK", chunk)
        parts = list(language.trigrams(column))
        assert [x for _, _, bucket in parts for x in bucket] == whole
        of_row = defaultdict(list)
        for row, edges, bucket in parts:
            for r, (a, b) in enumerate(zip(edges, edges[1:])):
                of_row[row + r] += bucket[a:b].tolist()
        for r in range(len(column)):
            assert of_row[r] == whole[offsets[r] : (offsets + [len(whole)])[r + 1]]


def test_more_labels_than_allowed_are_refused(spark):
    df = spark.createDataFrame([(f"l{i}", f"text number {i}") for i in range(5)], "label string, text string")
    assert len(language.fit(df, "text", "label", max_languages=5)[0]) == 5
    with pytest.raises(ValueError):
        language.fit(df, "text", "label", max_languages=4)
