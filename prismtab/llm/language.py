"""Language identification by Bayesian evidence fusion.

Four kinds of evidence meet in one log posterior per language:

* the text's likelihood under a byte-trigram model of each language,
* the language that the page or row declares, through P(declared | language),
* the address suffix and the host, as priors: the shares of the languages among
  a host's texts, smoothed towards those of its domain, these towards those of
  the suffix, and these towards the global shares.

The shares and P(declared | language) are grouped sums, over all rows, of the posteriors
that the texts alone give.  Only the trigram model is fitted on a
bounded sample of labelled rows (``SAMPLE_ROWS`` for each label).  One more
class, ``und``, has flat trigrams and takes texts that look like none of the languages.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prismtab.llm.arrays import SPACE, batches, small_batches, text_buffer
from prismtab.session import cut_lineage

#: labelled rows (about) that the trigram model is fitted on, for each label; labels beyond which fitting is refused
SAMPLE_ROWS, MAX_LANGUAGES = 2000, 1024
#: bytes of text whose trigrams are held at a time
CHUNK = 1 << 20
BUCKETS = 1 << 16
#: weight of a trigram's log-likelihood (neighbours overlap), prior of und, weight of a parent's shares, least posterior
TEMPER, UNDETERMINED, STRENGTH, ACCEPT = 0.3, 0.01, 20.0, 0.5
UND = "und"
#: hosts up to this count are broadcast, more are joined by a shuffle
BROADCAST_HOSTS = 50_000

_LETTER = np.full(256, 32, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def trigrams(column):
    """Stretches of at most ``CHUNK`` bytes of a text column, as (first row, edges of its rows, bucket of the trigram at every byte).

    Edges count from the stretch's first byte.  Bucket ``BUCKETS`` is none: no letter, or a row's end.
    """
    raw, offsets = text_buffer(pc.utf8_lower(column.cast(pa.large_string())))
    ends = offsets[1:][np.diff(offsets) > 0]
    for a in range(0, len(raw), CHUNK):
        b = min(a + CHUNK, len(raw))
        x = _LETTER[raw[a : b + 2]].astype(np.uint32)
        out = np.full(b - a, BUCKETS, np.int32)
        if len(x) > 2:
            bucket = ((x[:-2] << np.uint32(16) | x[1:-1] << np.uint32(8) | x[2:]) * np.uint32(2654435761)) >> np.uint32(16)
            letter = x != 32
            out[: len(bucket)] = np.where(letter[:-2] | letter[1:-1] | letter[2:], bucket, BUCKETS)
        for back in (1, 2):
            at = ends - back
            out[at[(at >= a) & (at < b)] - a] = BUCKETS
        row, upto = int(np.searchsorted(offsets, a, "right")) - 1, int(np.searchsorted(offsets, b))
        yield row, np.clip(offsets[row : upto + 1], a, b) - a, out


def fit(df: DataFrame, text: str, label: str, sample_rows: int = SAMPLE_ROWS, max_languages: int = MAX_LANGUAGES) -> tuple[list[str], np.ndarray]:
    """(languages, log-likelihood of every bucket by language, und last) from a bounded sample of labelled rows.

    About ``sample_rows`` rows of each label, chosen by a hash of label and text, are read whole.  Every label is
    modelled; the model grows by 256 KB a label, so more than ``max_languages`` labels are an error.
    """
    labelled = small_batches(df).where(F.col(label).isNotNull() & (F.col(label) != "")).select(F.col(label).alias("label"), F.col(text).alias("text"))
    counts = labelled.groupBy("label").count().limit(max_languages + 1).collect()
    if len(counts) > max_languages:
        raise ValueError(f"more than {max_languages} labels in {label}; raise max_languages to model them all")
    languages = sorted(r[0] for r in counts if r[0] != UND)
    if not languages:
        return [], np.zeros((1, BUCKETS + 1))
    share = F.create_map(*[F.lit(x) for r in counts for x in (r[0], min(1.0, sample_rows / r[1]))])
    drawn = F.pmod(F.xxhash64("label", "text"), F.lit(1 << 30)) < share[F.col("label")] * (1 << 30)
    place = {name: i for i, name in enumerate(languages)}

    def count(frames):
        sums = {}
        for batch in batches(frames):
            labels = batch.column(0).to_pylist()
            for row, edges, bucket in trigrams(batch.column(1)):
                for name, x, y in zip(labels[row:], edges, edges[1:]):
                    own = sums.setdefault(name, np.zeros(BUCKETS + 1, np.int64))
                    own += np.bincount(bucket[x:y], minlength=BUCKETS + 1)
        for name, own in sums.items():
            at = np.flatnonzero(own[:BUCKETS])
            yield pa.RecordBatch.from_arrays([pa.array([place[name]] * len(at), pa.int32()), pa.array(at, pa.int32()), pa.array(own[at])], ["language", "bucket", "n"])

    sampled = labelled.where(F.col("label").isin(languages) & drawn)
    table = sampled.mapInArrow(count, "language int, bucket int, n long").groupBy("language", "bucket").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros((len(languages), BUCKETS))
    n[table.language, table.bucket] = table.n
    shared = (n.sum(0) + 0.5) / (n.sum() + 0.5 * BUCKETS)
    logs = np.zeros((len(languages) + 1, BUCKETS + 1))
    logs[:-1, :BUCKETS] = np.log((n + 200.0 * shared) / (n.sum(1, keepdims=True) + 200.0))
    logs[-1, :BUCKETS] = -np.log(BUCKETS)
    return languages, logs


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def host_of(address: Column) -> Column:
    """Host of a URL; anything without a scheme is a host itself; lower case, null becomes empty."""
    host = F.regexp_extract(F.coalesce(address, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(host)


def declared_of(html: Column) -> Column:
    """Primary subtag of the lang attribute of a page's html element; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([A-Za-z]+)", 1))


def identify(df: DataFrame, text: str = "text", declared: Column | None = None, address: Column | None = None,
             model: tuple[list[str], np.ndarray] | None = None, label: str | None = None) -> DataFrame:
    """All rows and columns of ``df`` with ``language``, ``probability`` and ``accepted``.

    ``declared`` and ``address`` are columns of declared languages and of URLs
    or hosts; either may be missing, null or empty, which is no evidence.
    ``model`` comes from ``fit``; without it, it is fitted on ``label`` (a
    column of ``df``).  ``accepted`` is false for und, for a probability under
    ``ACCEPT`` and for texts without a letter (null and empty ones
    included), whose language is und with probability 1.  Texts too short for a trigram
    are decided by the declared language and the host.  Ties go to the
    language that sorts first.  Without any labelled row all are und.  Long texts
    are read whole, a ``CHUNK`` at a time.  Input
    columns of the three names are replaced.
    """
    df = small_batches(df).drop("language", "probability", "accepted")
    languages, logs = model if model is not None else fit(df, text, label)
    names, k = [*languages, UND], len(languages) + 1
    spark = df.sparkSession
    held = spark.sparkContext.broadcast(logs.astype(np.float32))
    place = df.columns.index(text)
    code = F.lower(F.coalesce(declared, F.lit(""))) if declared is not None else F.lit("")
    host = host_of(address) if address is not None else F.lit("")
    # declared languages that are not modelled are one kind, none at all another
    kind = F.when(code == "", -1).otherwise(F.coalesce(F.array_position(F.array(*[F.lit(x) for x in names]), code) - 1, F.lit(-1)))
    kind = F.when((code != "") & (kind < 0), k).otherwise(kind).cast("int")
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(text).alias("text"), host.alias("host"), kind.alias("kind"))

    def likelihoods(column) -> tuple[np.ndarray, np.ndarray]:
        out, seen = np.zeros((len(column), k)), np.zeros(len(column), np.int64)
        for row, edges, bucket in trigrams(column):
            rows = slice(row, row + len(edges) - 1)
            for i in range(k):
                upto = np.concatenate([[0.0], np.cumsum(held.value[i][bucket], dtype=np.float64)])
                out[rows, i] += np.diff(upto[edges])
            upto = np.concatenate([[0], np.cumsum(bucket < BUCKETS)])
            seen[rows] += np.diff(upto[edges])
        return TEMPER * out, seen

    flat = np.log(np.append(np.full(k - 1, (1 - UNDETERMINED) / max(1, k - 1)), UNDETERMINED if k > 1 else 1.0))

    def alone(frames):
        """Sums of the posteriors that the texts alone give, by host and declared kind."""
        sums: dict = {}
        for batch in batches(frames):
            loglik, seen = likelihoods(batch.column(0))
            post = _softmax(loglik + flat)
            post[seen == 0] = 0
            for h, d, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), post):
                own = sums.get((h, d))
                if own is None:
                    own = sums[h, d] = np.zeros(k)
                own += p
            if len(sums) > 100_000:
                yield flushed(sums)
                sums = {}
        yield flushed(sums)

    def flushed(sums):
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in sums], pa.string()), pa.array([x[1] for x in sums], pa.int32()), pa.array([x.tolist() for x in sums.values()], pa.list_(pa.float64()))],
            ["host", "kind", "mass"])

    each = [F.sum(F.col("mass")[i]).alias(f"m{i}") for i in range(k)]
    counted = cut_lineage(rows.select("text", "host", "kind").mapInArrow(alone, "host string, kind int, mass array<double>").groupBy("host", "kind").agg(*each))
    again = [F.sum(f"m{i}").alias(f"m{i}") for i in range(k)]
    # P(declared | language): a table of (languages + 2) x languages
    table = np.zeros((k + 2, k))
    for r in counted.groupBy("kind").agg(*again).collect():
        table[r.kind + 1] = list(r)[1:]
    world = table.sum(0)
    world = (world + 1.0) / (world.sum() + k)
    given = (table[1:] + 0.05 * table[1:].sum(0) + 1.0) / (table[1:].sum(0) * (1 + 0.05 * (k + 1)) + k + 1)
    log_given = np.vstack([np.zeros(k), np.log(given)])

    # shares of the languages by suffix, domain and host, each smoothed towards the level above
    part = F.split("host", r"\.")
    levels = counted.groupBy("host").agg(*again).withColumn("suffix", F.element_at(part, -1)).withColumn("domain", F.when(F.size(part) > 1, F.concat_ws(".", F.element_at(part, -2), F.element_at(part, -1))).otherwise(F.col("host")))

    def smoothed(frame: DataFrame, above, prefix: str) -> DataFrame:
        total = sum((F.col(f"m{i}") for i in range(1, k)), F.col("m0"))
        return frame.withColumns({f"{prefix}{i}": (F.col(f"m{i}") + STRENGTH * above(i)) / (total + STRENGTH) for i in range(k)})

    suffixes = smoothed(levels.groupBy("suffix").agg(*again), lambda i: F.lit(float(world[i])), "s").drop(*[f"m{i}" for i in range(k)])
    domains = levels.groupBy("suffix", "domain").agg(*again).join(suffixes, "suffix")
    domains = smoothed(domains, lambda i: F.col(f"s{i}"), "d").select("domain", *[f"d{i}" for i in range(k)])
    hosts = smoothed(levels.join(domains, "domain"), lambda i: F.col(f"d{i}"), "h")
    hosts = cut_lineage(hosts.select("host", F.array(*[F.col(f"h{i}") for i in range(k)]).alias("prior")))
    small = hosts.count() <= BROADCAST_HOSTS
    # a row without a host has the global shares
    joined = rows.join(F.broadcast(hosts) if small else hosts, "host", "left").select("row", "kind", F.when(F.col("host") != "", F.col("prior")).alias("prior"))
    schema = T.StructType([
        T.StructField("row", rows.schema["row"].dataType), T.StructField("language", T.StringType()),
        T.StructField("probability", T.DoubleType()), T.StructField("accepted", T.BooleanType())])

    def decide(frames):
        for batch in batches(frames):
            texts = batch.column(0).flatten()[place]
            loglik, seen = likelihoods(texts)
            # a text without a trigram has flat likelihoods
            bare = np.flatnonzero(seen == 0)
            bare = bare[~pc.match_substring_regex(texts.take(pa.array(bare)), r"\p{L}").fill_null(False).to_numpy(zero_copy_only=False).astype(bool)]
            prior = np.array([p if p is not None else world for p in batch.column(2).to_pylist()]).reshape(-1, k)
            post = _softmax(loglik + log_given[batch.column(1).to_numpy() + 1] + np.log(prior))
            best = post.argmax(axis=1)
            top = post[np.arange(len(best)), best]
            best[bare], top[bare] = k - 1, 1.0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([names[b] for b in best], pa.string()), pa.array(top), pa.array((best < k - 1) & (top >= ACCEPT))],
                ["row", "language", "probability", "accepted"])

    return joined.mapInArrow(decide, schema).select("row.*", "language", "probability", "accepted")
