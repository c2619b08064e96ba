"""Vectorised helpers on Arrow string buffers: word spans, XXH64 of spans, sliding minima.

A text column of one Arrow batch is one byte buffer plus row offsets.  Words
are maximal runs of bytes other than space and the controls 9 to 13, so they
can be found in the whole buffer at once; a row border always ends a word.
Everything here works on one batch inside one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# fixed values: the five primes of XXH64
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of every word and, per row, the index of its first word (n_rows + 1 entries)."""
    word = np.empty(len(raw) + 1, bool)
    np.logical_not(SPACE[raw], out=word[:-1])
    word[-1] = False
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    ends = np.zeros(len(raw) + 1, bool)
    ends[1:] = word[:-1] & ~word[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(raw))]
    begins[inner] = word[inner]
    ends[inner] |= word[inner - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends), np.searchsorted(starts, offsets)


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """XXH64 of raw[start:end] for every span, as uint64."""
    n = len(starts)
    if n == 0:
        return np.empty(0, np.uint64)
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))
    four = np.ndarray((len(padded) - 3,), "<u4", padded, 0, (1,))
    length = (ends - starts).astype(np.int64)
    seed = np.uint64(seed)
    at, left = starts.astype(np.int64).copy(), length.copy()
    with np.errstate(over="ignore"):
        h = np.full(n, seed + P5, np.uint64)
        long = np.flatnonzero(length >= 32)
        if len(long):
            one = np.ones(len(long), np.uint64)
            acc = [one * (seed + P1 + P2), one * (seed + P2), one * seed, one * (seed - P1)]
            live = np.arange(len(long))
            while len(live):
                rows = long[live]
                for k in range(4):
                    lane = eight[at[rows] + 8 * k]
                    acc[k][live] = _rotl(acc[k][live] + lane * P2, 31) * P1
                at[rows] += 32
                left[rows] -= 32
                live = live[left[rows] >= 32]
            v = _rotl(acc[0], 1) + _rotl(acc[1], 7) + _rotl(acc[2], 12) + _rotl(acc[3], 18)
            for k in range(4):
                v = (v ^ (_rotl(acc[k] * P2, 31) * P1)) * P1 + P4
            h[long] = v
        h += length.astype(np.uint64)
        rows = np.flatnonzero(left >= 8)
        while len(rows):
            lane = _rotl(eight[at[rows]] * P2, 31) * P1
            h[rows] = _rotl(h[rows] ^ lane, 27) * P1 + P4
            at[rows] += 8
            left[rows] -= 8
            rows = rows[left[rows] >= 8]
        rows = np.flatnonzero(left >= 4)
        h[rows] = _rotl(h[rows] ^ (four[at[rows]].astype(np.uint64) * P1), 23) * P2 + P3
        at[rows] += 4
        left[rows] -= 4
        rows = np.flatnonzero(left > 0)
        while len(rows):
            h[rows] = _rotl(h[rows] ^ (padded[at[rows]].astype(np.uint64) * P5), 11) * P1
            at[rows] += 1
            left[rows] -= 1
            rows = rows[left[rows] > 0]
        h ^= h >> np.uint64(33)
        h *= P2
        h ^= h >> np.uint64(29)
        h *= P3
        h ^= h >> np.uint64(32)
    return h


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(31))
        x = x * P3
        x = x ^ (x >> np.uint64(29))
        x = x * P1
        return x ^ (x >> np.uint64(32))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` values (len(x) - width + 1 of them), by doubling."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def norm_words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All words joined by one space each: (bytes, start of every word, plus one closing entry).

    Word i is out[at[i] : at[i + 1] - 1].
    """
    length = ends - starts
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(length + 1, out=at[1:])
    out = np.empty(at[-1], np.uint8)
    for a in range(0, len(starts), 1 << 15):  # the index of a byte takes eight bytes
        b = min(a + (1 << 15), len(starts))
        # every word plus the byte behind it, which becomes a space
        source = np.arange(at[a], at[b]) + np.repeat(starts[a:b] - at[a:b], length[a:b] + 1)
        if source[-1] >= len(raw):
            source[-1] = 0
        out[at[a] : at[b]] = raw[source]
    out[at[1:] - 1] = 32
    return out, at


#: bytes of one Arrow batch between Spark and a task's Python
BATCH_BYTES = 4 << 20


def small_batches(df):
    """``df``, after its session's Arrow batches were held to ``BATCH_BYTES``: the default is made for narrow rows, not for texts."""
    conf = df.sparkSession.conf
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(str(conf.get(name, "67108864b")).rstrip("bB")) > BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))
    return df


def batches(frames, rows: int = 1 << 30, size: int = 1 << 19):
    """Cut Arrow batches into slices of about ``size`` bytes (at least one row each)."""
    for batch in frames:
        if batch.num_rows == 0:
            continue
        weight = np.zeros(batch.num_rows, np.int64)
        for column in [c for own in batch.columns for c in ([own] if not pa.types.is_struct(own.type) else own.flatten())]:
            if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
                o = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
                weight += np.diff(o.astype(np.int64))
        total = np.cumsum(weight)
        at = 0
        while at < batch.num_rows:
            base = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, base + size, side="right")))
            end = min(end, at + rows, batch.num_rows)
            yield batch.slice(at, end - at)
            at = end
        del batch
    pa.default_memory_pool().release_unused()  # a worker lives on after its task
