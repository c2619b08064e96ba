"""Improbable-feature digests of documents: rare byte windows in chained Bloom filters.

A feature is a window of ``FEATURE`` bytes.  Its class is its byte entropy;
how rare each class is, is counted over all windows of all documents, and a
window of a rarer class ranks before one of a commoner class.  Within each run of
``FEATURE`` neighbouring windows the first-ranking one gets a vote, and windows
with ``VOTES`` votes are selected.  Selected windows enter Bloom filters of 2048
bits (five bits each, ``CAPACITY`` windows a filter), chained in text order.  Two
digests are compared by the normalised overlap of their filters' bits.

Windows of a whole batch are handled together: the entropy of the next window
follows from how often the bytes that leave and enter occur in it.
"""

from __future__ import annotations

import base64

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prismtab.llm.arrays import batches, sliding_min, small_batches, span_hashes, text_buffer

FEATURE, CLASSES, VOTES, CAPACITY, BITS = 64, 1001, 16, 160, 2048
#: windows below this class (near-constant bytes) are never selected
WEAK = 100
#: texts below SHORT bytes use all their windows of 16 bytes, below TINY all of 4 bytes
SHORT, TINY = 256, 64
#: sort ranges aim at so many bytes, and there are at most so many
RANGE_BYTES, MAX_RANGES = 16 << 20, 10_000

_COUNT = np.arange(FEATURE + 1, dtype=np.float64)
_CLOGC = np.where(_COUNT > 0, _COUNT * np.log2(np.maximum(_COUNT, 1)), 0.0)
#: growth of the sum of c log2 c when a byte that the window has c times comes in, in 1/2^16
_STEP = np.rint(np.diff(_CLOGC) * 65536).astype(np.int64)


def entropy_classes(raw: np.ndarray) -> np.ndarray:
    """Entropy class (0 to 1000) of every window of ``FEATURE`` bytes; row borders are not seen."""
    n = len(raw) - FEATURE + 1
    if n <= 0:
        return np.empty(0, np.int16)
    behind, ahead = np.zeros(len(raw), np.uint8), np.zeros(len(raw), np.uint8)
    for k in range(1, FEATURE):
        same = (raw[:-k] == raw[k:]).view(np.uint8)
        ahead[:-k] += same
        behind[k:] += same
    total = np.empty(n, np.int64)
    total[0] = _STEP[[int((raw[:j] == raw[j]).sum()) for j in range(FEATURE)]].sum()
    np.cumsum(_STEP[behind[FEATURE:]] - _STEP[ahead[: n - 1]], out=total[1:])
    total[1:] += total[0]
    top = int(_CLOGC[FEATURE] * 65536)
    return np.clip((top - total) * 1000 // top, 0, 1000).astype(np.int16)


def _window_rows(offsets: np.ndarray, n: int) -> np.ndarray:
    """Whether the window at each byte lies within one row."""
    ok = np.zeros(n + 1, np.int32)
    length = np.diff(offsets)
    full = np.flatnonzero(length >= FEATURE)
    ok[offsets[full]] += 1
    np.add.at(ok, offsets[full + 1] - FEATURE + 1, -1)
    return np.cumsum(ok[:n]) > 0


def entropy_ranks(df: DataFrame, text: str = "text") -> np.ndarray:
    """Rank of every entropy class, the rarest first, over all windows of all texts of ``df``."""

    def count(frames):
        sums = np.zeros(CLASSES, np.int64)
        for batch in batches(frames):
            raw, offsets = text_buffer(batch.column(0))
            classes = entropy_classes(raw)
            if len(classes):
                sums += np.bincount(classes[_window_rows(offsets, len(classes))], minlength=CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES, dtype=np.int32)), pa.array(sums)], ["class", "n"])

    counts = np.zeros(CLASSES, np.int64)
    for r in small_batches(df).select(text).mapInArrow(count, "class int, n long").groupBy("class").agg(F.sum("n").alias("n")).collect():
        counts[r["class"]] = r.n
    ranks = np.empty(CLASSES, np.int32)
    ranks[np.lexsort([np.arange(CLASSES), counts])] = np.arange(CLASSES)
    return ranks


def digests(column, ranks: np.ndarray) -> list[str]:
    """The digest of every text of an Arrow string column: base64 of its filters, empty for an empty text."""
    raw, offsets = text_buffer(column)
    rows = len(offsets) - 1
    length = np.diff(offsets)
    classes = entropy_classes(raw)
    chosen = np.empty(0, np.int64)
    n = len(classes)
    if n:
        within = _window_rows(offsets, n)
        key = ranks[classes].astype(np.int64) << 32 | np.arange(n)
        key[~within | (classes < WEAK)] |= 1 << 60
        if n >= FEATURE:
            first = sliding_min(key, FEATURE)
            # runs of windows that lie in one row, and their first-ranking window
            whole = within[: len(first)] & within[FEATURE - 1 :] & (np.searchsorted(offsets, np.arange(len(first)), "right") == np.searchsorted(offsets, np.arange(len(first)) + FEATURE - 1, "right"))
            best = first[whole]
            best = best[best < 1 << 60] & 0xFFFFFFFF
            chosen = np.flatnonzero(np.bincount(best, minlength=n) >= VOTES)
    row_of = np.searchsorted(offsets, chosen, "right") - 1
    chosen = chosen[length[row_of] >= SHORT]
    starts, ends = [chosen], [chosen + FEATURE]
    picked = np.bincount(np.searchsorted(offsets, chosen, "right") - 1, minlength=rows)
    for r in np.flatnonzero((length > 0) & ((length < SHORT) | (picked == 0))).tolist():
        a, b = int(offsets[r]), int(offsets[r + 1])
        if b - a >= SHORT:  # no window had the votes: the first-ranking one
            at = np.array([a + int(np.argmin(key[a : b - FEATURE + 1]))])
            starts.append(at)
            ends.append(at + FEATURE)
        else:
            size = 4 if b - a < TINY else 16
            at = np.arange(a, max(a + 1, b - size + 1))
            starts.append(at)
            ends.append(np.minimum(at + size, b))
    start, end = np.concatenate(starts), np.concatenate(ends)
    order = np.argsort(start, kind="stable")
    start, end = start[order], end[order]
    row = np.searchsorted(offsets, start, "right") - 1
    count = np.bincount(row, minlength=rows)
    filters = -(-count // CAPACITY)
    before = np.cumsum(filters) - filters
    nth = np.arange(len(start)) - (np.cumsum(count) - count)[row]
    bits = np.zeros((int(filters.sum()), BITS), bool)
    hashed = span_hashes(raw, start, end)
    for k in range(5):
        bits[before[row] + nth // CAPACITY, ((hashed >> np.uint64(11 * k)) & np.uint64(BITS - 1)).astype(np.int64)] = True
    packed = np.packbits(bits, axis=1)
    return [base64.b64encode(packed[a : a + f].tobytes()).decode() for a, f in zip(before.tolist(), filters.tolist())]


def overlap(left: str, right: str) -> float:
    """Likeness of two digests, 0 to 1: the mean over the smaller one's filters of the best normalised bit overlap.

    An overlap that chance alone gives, and three tenths of the way from there to
    a full one, count as 0.  Equal digests have 1, and an empty digest has 0 to any other.
    """
    if left == right:
        return 1.0
    if not left or not right:
        return 0.0
    a, b = (np.frombuffer(base64.b64decode(x), np.uint64).reshape(-1, BITS // 64) for x in sorted((left, right), key=lambda x: (len(x), x)))
    own, others = np.bitwise_count(a).sum(1, dtype=np.int64), np.bitwise_count(b).sum(1, dtype=np.int64)
    total = 0.0
    for x, ones in zip(a, own):
        both = np.bitwise_count(b & x).sum(1, dtype=np.int64)
        least = np.minimum(others, ones)
        chance = others * ones / BITS
        floor = chance + 0.3 * (least - chance)
        total += float(np.max(np.clip((both - floor) / np.maximum(least - floor, 1e-9), 0.0, 1.0)))
    return total / len(a)


def fingerprints(df: DataFrame, columns: dict[str, str], ranks: np.ndarray) -> DataFrame:
    """All rows and columns of ``df`` with the digest of each text column, under the names that ``columns`` gives.

    Null and empty texts have the empty digest; equal texts have equal digests; whole texts are read, however long.
    Input columns of the new names are replaced.
    """
    df = small_batches(df).drop(*columns.values())
    places = [df.columns.index(c) for c in columns]
    schema = T.StructType([*df.schema.fields, *[T.StructField(c, T.StringType()) for c in columns.values()]])

    def run(frames):
        for batch in batches(frames):
            made = [pa.array(digests(batch.column(p), ranks), pa.string()) for p in places]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=schema.names)

    return df.mapInArrow(run, schema)


def likeness(left: str, right: str) -> Column:
    """Column form of ``overlap`` for two digest columns; a null digest counts as an empty one."""

    def compare(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([overlap(x or "", y or "") for x, y in zip(a, b)], dtype="float64")

    return F.pandas_udf(compare, T.DoubleType())(left, right)


def with_next(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns of ``df`` with ``next_text``: the text of the row that follows in descending key order.

    After the last row comes the first.  Equal keys are ordered by their
    texts' hashes; null keys come last; a single row follows itself.  Keys are cut into ranges at quantiles,
    rows travel once to their range, and the first row of each range also
    travels to the range before it.
    """
    df = small_batches(df).drop("next_text")
    own = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.select(own.alias("row"), F.col(text).alias("text"), F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("hash"))
    total, count, known = rows.agg(F.sum(F.octet_length("text")), F.count("*"), F.count("id")).first()
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(1, min(MAX_RANGES, max(least, -(-(total or 0) // RANGE_BYTES))))
    cuts = sorted(set(rows.approxQuantile("id", [i / ranges for i in range(1, ranges)], 0.1 / ranges))) if ranges > 1 and known else []
    bounds = np.array(cuts, np.float64)
    nulls = max(1, -(-ranges * (count - known) // max(1, count)))

    @F.pandas_udf(T.IntegerType())
    def place(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        missing = ids.isna().to_numpy()
        out = len(bounds) - np.searchsorted(bounds, ids.fillna(0).to_numpy(np.float64), "right")
        behind = ((hashes.to_numpy(np.float64) / 2.0**64 + 0.5) * nulls).astype(np.int64).clip(0, nulls - 1)
        return pd.Series(np.where(missing, len(bounds) + 1 + behind, out).astype(np.int32))

    placed = rows.withColumn("place", place("id", "hash"))
    heads = placed.groupBy("place").agg(F.min(F.struct(F.coalesce(-F.col("id"), F.lit(0)).alias("id"), F.col("hash"))).alias("h")).select("place", "h.id", "h.hash").orderBy("place").collect()
    if not heads:
        return df.withColumn("next_text", F.lit(None).cast("string"))
    before = [(heads[i].place, heads[i].id, heads[i].hash, heads[i - 1].place) for i in range(len(heads))]
    head = F.broadcast(df.sparkSession.createDataFrame(before, "at int, low long, h long, target int"))
    found = placed.join(head, (F.col("place") == F.col("at")) & (F.coalesce(-F.col("id"), F.lit(0)) == F.col("low")) & (F.col("hash") == F.col("h")), "left")
    stops = F.array(F.struct(F.col("place"), F.lit(0).alias("extra")), F.struct(F.col("target").alias("place"), F.lit(1).alias("extra")))
    spread = found.select("row", "id", "hash", F.explode(F.filter(stops, lambda s: s["place"].isNotNull())).alias("s"))
    ordered = spread.select("row", "id", "hash", "s.place", "s.extra").repartitionById(len(cuts) + 1 + nulls, "place").sortWithinPartitions("place", "extra", F.col("id").desc_nulls_last(), "hash")
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("next_text", T.StringType())])

    def follow(frames):
        held = None
        for batch in frames:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            now = batch.slice(0, batch.num_rows - 1)
            out = pa.RecordBatch.from_arrays([now.column(0), batch.column(1).slice(1)], ["row", "next_text"])
            yield out.filter(pc.equal(now.column(2), 0))
            held = batch.slice(batch.num_rows - 1)

    return ordered.select("row", F.col("row")[text].alias("text"), "extra").mapInArrow(follow, schema).select("row.*", "next_text")
