"""Source divergence audit: how the term shares of the sources of a language differ.

One ``CountVectorizer`` (minimum document frequency, largest integer as vocabulary size)
learns the vocabularies of all languages in one pass: every term carries its
language in front, and a document has terms of one language only, so document
frequencies are those of a fit per language, however many languages
there are.  It is fitted on each text's distinct terms.  Its sparse vectors of bags, each the terms that occur in some
texts of one (language, source) a number of times that has one power of two in it, made from texts shuffled by
(language, source), are summed with that weight per
(language, source): one row per term that occurs there.  Pairs of sources are evaluated over stretches of
the vocabulary: only the columns in which one of the two has a count are
visited, and all others add one constant each.

All shares are integers, so the results are exact.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prismtab.llm.arrays import LOWER, batches, small_batches, text_buffer
from prismtab.session import cut_lineage

#: bytes of a term, ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]``: ASCII letters, which are lower-cased, and all of UTF-8 beyond ASCII
TERM = np.ones(256, bool)
TERM[0x00:0x41] = TERM[0x5B:0x61] = TERM[0x7B:0x80] = False
#: stands between language and term; no term holds it
TAG = "\0"
#: terms of a stretch of the vocabulary, and sources of a block, that one task evaluates at a time
STRETCH, SOURCES = 2048, 256
#: text bytes whose terms are combined at a time
SLICE = 4 << 20
#: shares are in units of 1 / SCALE
SCALE = 1_000_000_000


def text_terms(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct terms of the texts of a batch of (text, lang, group), each behind its language; row, term and
    occurrences of each term of each text, by row): all texts at once, byte by byte."""
    raw, offsets = text_buffer(batch.column(0))
    raw = LOWER[raw]
    own = TERM[raw]
    border = np.zeros(len(raw) + 1, bool)
    border[offsets] = True
    first, last = own.copy(), own.copy()
    first[1:] &= ~own[:-1] | border[1:-1]
    last[:-1] &= ~own[1:] | border[1:-1]
    starts = np.flatnonzero(first)
    ends = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(np.flatnonzero(last) + 1 - starts, out=ends[1:])
    coded = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw[own].tobytes())]).dictionary_encode()
    kinds = max(1, len(coded.dictionary))
    row = np.repeat(np.arange(batch.num_rows), np.diff(np.searchsorted(starts, offsets)))
    pair, count = np.unique(row * kinds + coded.indices.to_numpy(), return_counts=True)
    row, term = np.divmod(pair, kinds)
    langs = batch.column(1).dictionary_encode()
    tagged, term = np.unique(langs.indices.to_numpy()[row].astype(np.int64) * kinds + term, return_inverse=True)
    lang, plain = np.divmod(tagged, kinds)
    return pc.binary_join_element_wise(langs.dictionary.take(pa.array(lang)), coded.dictionary.take(pa.array(plain)), TAG), row, term, count


def term_lists(frames, least: int | None = None):
    """Arrow batches of (text, lang, group) to (terms): each text's distinct terms, behind their language.

    With ``least`` the terms of a slice come in rows that hold a term as often as texts of the slice have it, but at
    most ``least`` times.  Whether ``least`` texts have a term is the same in these rows: a term is
    cut only where the slice alone has ``least`` texts with it."""
    for batch in batches(frames, size=SLICE):
        terms, row, term, _ = text_terms(batch)
        upto = np.searchsorted(row, np.arange(batch.num_rows + 1))
        if least is not None:
            texts = np.minimum(np.bincount(term, minlength=len(terms)), least)
            # row i holds the terms of more than i texts: the first ones by descending number of texts
            order = np.argsort(-texts)
            sizes = np.searchsorted(-texts[order], -np.arange(texts.max(initial=0)))
            upto = np.append(0, sizes.cumsum())
            term = order[np.arange(upto[-1]) - np.repeat(upto[:-1], sizes)]
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), terms.take(pa.array(term)))], ["terms"])


def term_bags(frames):
    """Arrow batches of (text, lang, group) to (group, weight, terms): the terms of all texts of a group in a slice, each
    in the rows whose weights, powers of two, add up to its occurrences there."""
    for batch in batches(frames, size=SLICE):
        terms, row, term, count = text_terms(batch)
        if not len(row):
            continue
        groups, place = np.unique(batch.column(2).to_numpy(), return_inverse=True)
        key, again = np.unique(place[row] * len(terms) + term, return_inverse=True)
        count = np.bincount(again, count).astype(np.int64)
        place, term = np.divmod(key, len(terms))
        for bit in range(int(count.max()).bit_length()):
            at = np.flatnonzero(count >> bit & 1)
            if not len(at):
                continue
            begin = np.flatnonzero(np.diff(place[at], prepend=-1))
            lists = pa.ListArray.from_arrays(pa.array(np.append(begin, len(at)).astype(np.int32)), terms.take(pa.array(term[at])))
            yield pa.RecordBatch.from_arrays([pa.array(groups[place[at[begin]]]), pa.array(np.full(len(begin), 1 << bit)), lists], ["group", "weight", "terms"])


def numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(groups: lang, source, group; docs with group): a 64-bit hash that is sure to tell the groups apart."""
    groups = cut_lineage(docs.select("lang", "source").distinct())
    for seed in range(100):
        number = F.xxhash64(F.lit(seed), "lang", "source")
        if not groups.groupBy(number).count().where("count > 1").limit(1).count():
            return groups.withColumn("group", number), docs.withColumn("group", number)
    raise ValueError("no hash tells the groups apart")


def by_group(texts: DataFrame) -> DataFrame:
    """``texts`` with each group's rows side by side, so that a slice holds few groups and a term seldom comes in many bags.

    Large groups are split over tasks of the advisory partition size."""
    return texts.hint("rebalance", "group").sortWithinPartitions("group")


def term_counts(docs: DataFrame, least: int = 10) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(groups, counts, vocabulary) of documents with text, lang and source.

    groups: lang, source, place in the language (from 0, by name), terms
    (the vocabulary's size), total (all counts of kept terms); counts: lang,
    place, term_place, count; vocabulary: lang, term_place (from 0, by UTF-8), term.  The
    vocabulary is the one thing that passes the driver: CountVectorizer
    collects it and hands it to the executors."""
    spark = docs.sparkSession
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    groups, docs = numbered(docs)
    texts = small_batches(docs).select("text", "lang", "group")
    # the vocabulary needs a term in ``least`` rows, if so many texts have it; counts need it once per group and power of two
    # texts of a language side by side: fewer terms a slice
    once = texts.sortWithinPartitions("lang").mapInArrow(lambda frames: term_lists(frames, max(1, least)), "terms array<string>")
    bags = by_group(texts).mapInArrow(term_bags, "group long, weight long, terms array<string>")
    # an empty vocabulary is an error to CountVectorizer: the empty term, which no document has, is always kept
    always = spark.range(max(1, least)).select(F.array(F.lit("")).alias("terms"))
    model = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(least), vocabSize=2**31 - 1).fit(once.unionByName(always))
    entries = [(*term.rpartition(TAG)[::2], i) for i, term in enumerate(model.vocabulary) if term]
    entries.sort(key=lambda e: (e[0].encode(), e[1].encode()))
    frame = pd.DataFrame(entries, columns=["lang", "term", "index"])
    frame["term_place"] = frame.groupby("lang", sort=False).cumcount() if len(frame) else []
    schema = "lang string, term string, index int, term_place int"
    vocabulary = spark.createDataFrame(frame, schema) if len(frame) else spark.createDataFrame([], schema)

    vector = F.unwrap_udt("vector")
    sparse = model.transform(bags).select("group", "weight", F.explode(vector["indices"]).alias("index"))
    sums = sparse.groupBy("group", "index").agg(F.sum("weight").alias("count"))
    sums = cut_lineage(sums.join(vocabulary.select("index", "term_place"), "index").drop("index"))
    groups = groups.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    groups = groups.join(vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("terms")), "lang", "left")
    groups = groups.join(sums.groupBy("group").agg(F.sum("count").alias("total")), "group", "left")
    groups = cut_lineage(groups.fillna(0, ["terms", "total"]))
    counts = sums.join(groups.select("lang", "group", "place"), "group").drop("group")
    return groups.drop("group"), counts, vocabulary.select("lang", "term_place", "term")


def share(count: str, total: str, terms: str = "terms") -> str:
    """SQL of a smoothed share in units of 1 / SCALE, from 1 up; decimals only where the product may leave a long."""
    exact = f"1 + ((cast({count} as decimal(20, 0)) + 2) * {SCALE}BD) div ({total} + 2 * {terms})"
    return f"if({count} < {2**63 // SCALE - 2}, 1 + ((cast({count} as bigint) + 2) * {SCALE}L) div ({total} + 2 * {terms}), {exact})"


def gap(p, q):
    """The integer distance of two shares."""
    return (p - q) * (p - q) // (p + q)


def pair_sums(counts: np.ndarray, none: np.ndarray, shares: np.ndarray, width: int) -> np.ndarray:
    """Distances of all pairs of sources, summed over ``width`` terms.

    counts: (source, column, share) triples as rows of occurring terms in columns
    below ``width``; none: each source's share of a term that it lacks."""
    n = len(none)
    dense = np.repeat(none[:, None], width, 1)
    has = np.zeros((n, width), bool)
    dense[counts[:, 0], counts[:, 1]] = shares
    has[counts[:, 0], counts[:, 1]] = True
    own, both, common = (np.zeros((n, n), np.int64) for _ in range(3))
    for i in range(n):
        at = np.flatnonzero(has[i])
        value = gap(dense[:, at], dense[i, at])
        own[i], both[i], common[i] = value.sum(1), (value * has[:, at]).sum(1), has[:, at].sum(1)
    held = has.sum(1)
    either = held[:, None] + held[None, :] - common
    return own + own.T - both + (width - either) * gap(none[:, None], none[None, :])


def source_pairs(groups: DataFrame, counts: DataFrame) -> DataFrame:
    """lang, place, other, value of every two different sources of a language, both ways round.

    A task evaluates two blocks of at most ``SOURCES`` sources over one
    ``STRETCH`` of the vocabulary.  Only sums of pairs leave it."""
    blocks = Window.partitionBy("lang")
    known = groups.withColumn("blocks", F.max("place").over(blocks).cast("int") / SOURCES).withColumn("blocks", F.floor("blocks").cast("int") + 1)
    known = known.withColumn("none", F.expr(f"if(terms = 0, 1, {share('0', 'total')})"))
    stretches = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.col("terms") - 1) / STRETCH)).cast("int"))
    heads = known.select("lang", "place", "blocks", "terms", F.col("none").alias("share"), F.lit(-1).alias("column"), F.explode(stretches).alias("stretch"))
    rows = counts.join(known.select("lang", "place", "blocks", "terms", "total"), ["lang", "place"])
    rows = rows.select("lang", "place", "blocks", "terms", F.expr(share("count", "total")).alias("share"), (F.col("term_place") % STRETCH).alias("column"), F.floor(F.col("term_place") / STRETCH).cast("int").alias("stretch"))
    rows = rows.unionByName(heads).withColumn("block", F.floor(F.col("place") / SOURCES).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("a", F.least("block", "with")).withColumn("b", F.greatest("block", "with"))

    def evaluate(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        _, a, b, stretch = key
        heads = frame[frame["column"] < 0].sort_values("place")
        places = heads["place"].to_numpy(np.int64)
        width = int(min(STRETCH, max(0, heads["terms"].iloc[0] - stretch * STRETCH)))
        rows = frame[frame["column"] >= 0]
        at = np.stack([np.searchsorted(places, rows["place"].to_numpy(np.int64)), rows["column"].to_numpy(np.int64)], 1)
        sums = pair_sums(at, heads["share"].to_numpy(np.int64), rows["share"].to_numpy(np.int64), width)
        of = places // SOURCES
        i, j = np.nonzero(((of[:, None] == a) & (of[None, :] == b) | (of[:, None] == b) & (of[None, :] == a)) & (places[:, None] != places[None, :]))
        return pd.DataFrame({"lang": key[0], "place": places[i], "other": places[j], "value": sums[i, j]})

    parts = rows.groupBy("lang", "a", "b", "stretch").applyInPandas(evaluate, "lang string, place int, other int, value long")
    return parts.groupBy("lang", "place", "other").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank for documents with text, lang and source.

    Part ``pair`` compares the source with every other source of its language over all
    kept terms, part ``term`` names the ``top`` terms that it uses more than its language.
    A term is kept if ``least`` documents of the language have it.  Nulls are empty
    strings; a null or empty text has no terms, but its source is a group. A
    language without kept terms has pairs of value 0 and no terms.  Equal
    values rank by the item's UTF-8.  An empty input gives an empty result; other
    columns are not read."""
    groups, counts, vocabulary = term_counts(docs, least)
    names = groups.select("lang", F.col("place").alias("other"), F.col("source").alias("item"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = source_pairs(groups, counts).join(names, ["lang", "other"]).join(groups.select("lang", "place", "source"), ["lang", "place"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))

    totals = groups.withColumn("all", F.sum("total").over(Window.partitionBy("lang"))).select("lang", "place", "source", "terms", "total", "all")
    rows = counts.withColumn("lang_count", F.sum("count").over(Window.partitionBy("lang", "term_place")))
    rows = rows.join(totals, ["lang", "place"])
    rows = rows.withColumn("p", F.expr(share("count", "total"))).withColumn("q", F.expr(share("lang_count", "`all`")))
    rows = rows.where("p > q").withColumn("value", F.expr("((p - q) * (p - q)) div (p + q)"))
    by_place = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term_place")
    rows = rows.withColumn("rank", F.row_number().over(by_place)).where(F.col("rank") <= top)
    terms = rows.join(vocabulary, ["lang", "term_place"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    return pairs.unionByName(terms)
