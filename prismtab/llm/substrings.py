"""Repeated word windows removed across documents, by super-k-mer partitioning.

A window is ``size`` consecutive words of one document.  Its minimiser is the
least hash of the runs of ``MINIMISER`` words inside it, so equal windows have
equal minimisers.  Consecutive windows that share one travel as a single
packed string (a super-k-mer) to the minimiser's bucket; there the windows of
each minimiser are sorted as text, so equal windows meet and the least
document key of each window is exact.

Equal super-k-mers of one flush of a map task are combined before they
travel.  A bucket's size follows from the input bytes, runs of windows are cut at
``LONGEST`` windows, and a reducer holds one bucket at a time.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prismtab.llm.arrays import batches, mix, norm_words, sliding_min, small_batches, span_hashes, text_buffer, word_spans

MINIMISER = 8
LONGEST = 256
#: words handled at a time, bytes of packed strings held before a flush, text bytes that a bucket aims at
CHUNK, FLUSH, BUCKET = 1 << 16, 24 << 20, 8 << 20


def super_kmers(hashes: np.ndarray, row_of: np.ndarray, size: int):
    """(first window, windows, minimiser) of the runs of windows that share a minimiser.

    ``hashes`` are word hashes, ``row_of`` the row of each word; windows across rows do not exist.
    """
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    m = min(MINIMISER, size)
    with np.errstate(over="ignore"):
        grams = hashes[: len(hashes) - m + 1].copy()
        for j in range(1, m):
            grams *= np.uint64(0x9E3779B97F4A7C15)
            grams += hashes[j : len(hashes) - m + 1 + j]
    least = sliding_min(mix(grams), size - m + 1)
    real = row_of[:n] == row_of[size - 1 :]
    change = np.ones(n, bool)
    change[1:] = (least[1:] != least[:-1]) | (real[1:] != real[:-1]) | (row_of[1:n] != row_of[: n - 1])
    begin = np.flatnonzero(change)
    count = np.diff(np.append(begin, n))
    keep = real[begin]
    begin, count = begin[keep], count[keep]
    pieces = -(-count // LONGEST)
    part = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = np.repeat(begin, pieces) + part * LONGEST
    return first, np.minimum(LONGEST, np.repeat(begin + count, pieces) - first), least[first]


def _pack(entries: dict, buckets: int):
    """One row (bucket, blob) for each bucket that the held super-k-mers fall into."""
    words = list(entries)
    least = np.array([entries[w][0] for w in words], np.uint64)
    bucket = (mix(least) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0)).tolist() + [len(order)]
    squeeze = zstandard.ZstdCompressor(level=1)
    for a, b in zip(edges, edges[1:]):
        own = order[a:b].tolist()
        texts = [words[i] for i in own]
        seen = [entries[texts[j]][1] for j in range(len(own))]
        blob = (least[own], np.array([len(x) for x in texts], np.uint32), np.array([len(x) // 3 for x in seen], np.uint32),
                np.array([y for x in seen for y in x], np.int64), b"".join(texts))
        yield int(bucket[own[0]]), squeeze.compress(pickle.dumps(blob, 5))


def _map(frames, size: int, buckets: int):
    """Arrow batches (key, row, text) to (bucket, blob)."""

    def flushed():
        rows = list(_pack(entries, buckets))
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["bucket", "blob"])

    entries: dict = {}
    held = 0
    for batch in batches(frames):
        keys, rows = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy()
        raw, offsets = text_buffer(batch.column(2))
        starts, ends, first = word_spans(raw, offsets)
        joined, at = norm_words(raw, starts, ends)
        row_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
        data = joined.tobytes()
        for c in range(0, len(starts), CHUNK):
            upto = min(len(starts), c + CHUNK + size - 1)
            where, count, least = super_kmers(span_hashes(raw, starts[c:upto], ends[c:upto]), row_of[c:upto], size)
            where += c
            row = row_of[where]
            for x, y, h, k, r, s in zip(at[where].tolist(), (at[where + count + size - 1] - 1).tolist(), least.tolist(),
                                        keys[row].tolist(), rows[row].tolist(), (where - first[row]).tolist()):
                text = data[x:y]
                entry = entries.get(text)
                if entry is None:
                    entries[text] = (h, [k, r, s])
                    held += len(text) + 200
                else:
                    entry[1].extend((k, r, s))
                    held += 24
            if held > FLUSH:
                yield flushed()
                entries, held = {}, 0
    if entries:
        yield flushed()


def repeated_windows(texts: list[bytes], least: list[int], size: int) -> list[np.ndarray]:
    """For each distinct super-k-mer, the least key over all equal windows, window by window."""
    windows, owner, keys = [], [], []
    for i, text in enumerate(texts):
        gaps = np.flatnonzero(np.frombuffer(text, np.uint8) == 32).tolist()
        begin, end = [0] + [g + 1 for g in gaps], gaps + [len(text)]
        own = [text[a:b] for a, b in zip(begin, end[size - 1 :])]
        windows += own
        owner.append(len(own))
        keys += [least[i]] * len(own)
    order = sorted(range(len(windows)), key=windows.__getitem__)
    best = np.array(keys, np.int64)
    ordered = best[order]
    new = np.ones(len(order), bool)
    new[1:] = [windows[a] != windows[b] for a, b in zip(order, order[1:])]
    begin = np.flatnonzero(new)
    best[order] = np.repeat(np.minimum.reduceat(ordered, begin), np.diff(np.append(begin, len(order))))
    return np.split(best, np.cumsum(owner)[:-1])


def _ranges(blobs: list[bytes], size: int):
    """Covered word ranges (key, row, from, to) that one bucket's windows give."""
    least, texts, seen = [], [], []
    for blob in blobs:
        h, lengths, counts, occurrences, data = pickle.loads(zstandard.decompress(blob))
        cut = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).tolist()
        texts += [data[a:b] for a, b in zip(cut, cut[1:])]
        least.append(h)
        seen += np.split(occurrences.reshape(-1, 3), np.cumsum(counts)[:-1])
    least = np.concatenate(least)
    order = np.argsort(least, kind="stable")
    edges = np.flatnonzero(np.append(True, least[order][1:] != least[order][:-1])).tolist() + [len(order)]
    for a, b in zip(edges, edges[1:]):
        own: dict[bytes, list] = {}
        for i in order[a:b].tolist():
            own.setdefault(texts[i], []).append(seen[i])
        places = [np.concatenate(x) if len(x) > 1 else x[0] for x in own.values()]
        low, high = min(int(x[:, 0].min()) for x in places), max(int(x[:, 0].max()) for x in places)
        if low == high:
            continue  # one document alone has this minimiser
        distinct = list(own)
        mins = [int(x[:, 0].min()) for x in places]
        if len(distinct) == 1:
            best = [np.full(distinct[0].count(b" ") + 2 - size, mins[0], np.int64)]
        else:
            best = repeated_windows(distinct, mins, size)
        for where, lowest in zip(places, best):
            steps = np.flatnonzero(np.append(True, lowest[1:] != lowest[:-1]))
            stop = np.append(steps[1:], len(lowest))
            hit_row, hit_step = np.nonzero(lowest[steps][None, :] < where[:, :1])
            if len(hit_row):
                yield where[hit_row, 0], where[hit_row, 1], where[hit_row, 2] + steps[hit_step], where[hit_row, 2] + stop[hit_step] + size - 1


def _reduce(frames, size: int):
    """Rows (bucket, blob) in bucket order to covered ranges."""

    def out(blobs):
        found = list(_ranges(blobs, size))
        for a in range(0, len(found), 4096):
            cols = [np.concatenate(x) for x in zip(*found[a : a + 4096])]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["key", "row", "start", "stop"])

    held, current = [], None
    for batch in frames:
        for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if bucket != current and held:
                yield from out(held)
                held = []
            current = bucket
            held.append(blob)
    if held:
        yield from out(held)


def covered_ranges(rows: DataFrame, size: int) -> DataFrame:
    """(key, row, start, stop): word ranges covered by windows that also start in a row with a smaller key."""
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / BUCKET))
    packed = rows.where("key is not null and text is not null").mapInArrow(lambda f: _map(f, size, buckets), "bucket int, blob binary")
    dealt = packed.repartitionById(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(lambda f: _reduce(f, size), "key long, row long, start long, stop long")


def _apply(frames):
    """(row, text, ranges) to (row, n_words, n_removed, kept)."""
    for batch in batches(frames):
        raw, offsets = text_buffer(batch.column(1))
        starts, ends, first = word_spans(raw, offsets)
        gone = np.zeros(len(starts), bool)
        spans = batch.column(2)
        if spans.null_count < len(spans):
            for r, own in enumerate(spans.to_pylist()):
                for span in own or ():
                    gone[first[r] + span["start"] : first[r] + span["stop"]] = True
        kept = ~gone
        upto = np.concatenate([[0], np.cumsum(kept)])
        joined, at = norm_words(raw, starts[kept], ends[kept])
        data = joined.tobytes()
        edge = upto[first]
        texts = [data[at[a] : max(at[a], at[b] - 1)].decode() for a, b in zip(edge, edge[1:])]
        n_words = np.diff(first)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words.astype(np.int64)), pa.array((n_words - np.diff(edge)).astype(np.int64)), pa.array(texts, pa.string())],
            ["row", "n_words", "n_removed", "kept"])


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 50) -> DataFrame:
    """All rows and columns of ``df`` with ``n_words``, ``n_removed`` and ``kept``.

    A word goes if a window of ``size`` words that covers it also starts in a
    row with a smaller key.  ``kept`` has the remaining words joined by one
    space.  Windows are judged on the input.  A null or empty text has no
    words; a null key neither loses words nor takes any from others; rows with
    equal keys do not take from each other, and each is judged by its own text.
    Input columns of the three names are replaced.  An empty table gives an
    empty result.
    """
    df = small_batches(df).drop("n_words", "n_removed", "kept")
    own = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.select(own.alias("row"), F.col(text).alias("text"), F.col(key).cast("long").alias("key"), F.xxhash64(key, text).alias("hash"))
    ranges = covered_ranges(rows.select("key", F.col("hash").alias("row"), "text"), size)
    ranges = ranges.groupBy("key", F.col("row").alias("hash")).agg(F.collect_set(F.struct("start", "stop")).alias("ranges"))
    # the text travels once, inside its row
    joined = rows.drop("text").join(ranges, ["key", "hash"], "left").select("row", F.col("row")[text].alias("text"), "ranges")
    schema = T.StructType([
        T.StructField("row", rows.schema["row"].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
    return joined.mapInArrow(_apply, schema).select("row.*", "n_words", "n_removed", "kept")
