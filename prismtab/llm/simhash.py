"""SimHash near-duplicates: links between fingerprints found by pigeonring filtering.

A fingerprint's 64 bits are cut into ``distance + 1`` consecutive segments on a
ring.  If two fingerprints differ in at most ``distance`` bits, some start
exists from which every chain of l consecutive segments differs in at most
l * distance / segments bits, rounded down, that is l - 1.  So the first
segment of the chain is equal, and of the second one, which may differ in one
bit, one half is equal: (start, first segment, that half) is the join key.
Within a key, pairs must pass the chains of three and more segments before the
full distance is taken.

Equal fingerprints are one node from the start, so copies are never paired.
A key's rows yield a spanning forest of its links, not all pairs: pairs that
are already connected are not looked at again, and a key of many rows that are not connected
is divided: its rows meet again under longer keys, which add one of
``distance + 1`` parts of the other bits, as often as it takes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prismtab.llm.arrays import LOWER, batches, norm_words, small_batches, span_hashes, text_buffer, word_spans
from prismtab.llm.components import components
from prismtab.session import cut_lineage

HASH_SEED = 42
BLOCK = 1 << 14
#: neighbours that every key's rows are compared with, and rows from which a key is divided further
NEAR, LONG = 32, 512


def text_fingerprints(column, shingle: int) -> np.ndarray:
    """SimHash of every text of an Arrow string column, as uint64."""
    raw, offsets = text_buffer(column)
    raw = LOWER[raw]
    starts, ends, first = word_spans(raw, offsets)
    joined, at = norm_words(raw, starts, ends)
    words = np.diff(first)
    count = np.where(words >= shingle, words - shingle + 1, (words > 0).astype(np.int64))
    upto = np.concatenate([[0], np.cumsum(count)])
    ones = np.zeros((len(words), 64), np.int64)
    for a in range(0, upto[-1], BLOCK):
        b = min(a + BLOCK, upto[-1])
        r0, r1 = np.searchsorted(upto, a, side="right") - 1, np.searchsorted(upto, b, side="left")
        edge = np.clip(upto[r0 : r1 + 1], a, b)
        row = np.repeat(np.arange(r0, r1), np.diff(edge))
        begin = first[row] + np.arange(a, b) - upto[row]
        end = begin + np.minimum(shingle, words[row])
        hashes = span_hashes(joined, at[begin], at[end] - 1, HASH_SEED)
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        for r in range(r0, r1):
            x, y = edge[r - r0] - a, edge[r - r0 + 1] - a
            if y > x:
                ones[r] += bits[x:y].sum(axis=0, dtype=np.int32)
    return np.packbits(2 * ones > count[:, None], axis=1).view(">u8").astype(np.uint64).ravel()


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """(key, fp): the 64-bit SimHash of every text as a signed long.

    A-Z count as a-z; words are runs of anything but space and the controls 9
    to 13; shingles of ``shingle`` words with repeats, joined by one space (a
    shorter text is one shingle).  A bit is set if it is set in over half of
    the shingles' XXH64 (seed 42).  Null, empty and blank texts have
    fingerprint zero.
    """
    rows = small_batches(df).select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {rows.schema['key'].dataType.simpleString()}, fp long"

    def run(frames):
        for batch in batches(frames):
            fp = text_fingerprints(batch.column(1), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], ["key", "fp"])

    return rows.mapInArrow(run, schema)


def segments(distance: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of the ring's segments."""
    n = distance + 1
    cut = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cut, cut[1:])]


def _bits(fp: np.ndarray, low: int, width: int) -> np.ndarray:
    return (fp >> np.uint64(low)) & np.uint64((1 << width) - 1)


def chain_keys(fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Join keys of every fingerprint, two for each start: (row, key)."""
    ring, keys = segments(distance), []
    for i, (low, width) in enumerate(ring):
        next_low, next_width = ring[(i + 1) % len(ring)]
        head = _bits(fp, low, width)
        half = next_width // 2
        for part, (at, size) in enumerate(((next_low, half), (next_low + half, next_width - half))):
            keys.append((((head << np.uint64(size)) | _bits(fp, at, size)) << np.uint64(8)) | np.uint64(2 * i + part))
    return np.tile(np.arange(len(fp)), len(keys)), np.concatenate(keys)


def linked(a: np.ndarray, b: np.ndarray, start: np.ndarray, distance: int) -> np.ndarray:
    """Whether the pairs pass every chain budget from their start, then the full distance."""
    differ, ring = a ^ b, segments(distance)
    n = len(ring)
    if distance and n > 2:
        each = np.stack([np.bitwise_count(_bits(differ, low, width)) for low, width in ring]).astype(np.int64)
        so_far = np.zeros(len(a), np.int64)
        keep = np.ones(len(a), bool)
        for length in range(1, n):
            so_far += each[(start + length - 1) % n, np.arange(len(a))]
            keep &= so_far <= length * distance // n
    else:
        keep = np.ones(len(a), bool)
    keep[keep] = np.bitwise_count(differ[keep]) <= distance
    return keep


def _gather(fp: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The bits at the given places, side by side."""
    out = np.zeros(len(fp), np.uint64)
    for j, place in enumerate(places.tolist()):
        out |= ((fp >> np.uint64(place)) & np.uint64(1)) << np.uint64(j)
    return out


class _Forest:
    """A spanning forest of the links among fingerprints that share keys."""

    def __init__(self, fp: np.ndarray, distance: int):
        self.fp, self.distance, self.root, self.found = fp, distance, np.arange(len(fp)), []

    def find(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def walk(self, rows: np.ndarray, label: np.ndarray, start: np.ndarray, long: int):
        """Link rows of equal labels (which are neighbours).  Returns the labels' numbers and which rows are left over.

        After ``NEAR`` neighbours a label whose rows are all connected needs no more pairs, and
        one of more than ``long`` rows is left over, to be divided.
        """
        change = np.append(True, label[1:] != label[:-1])[: len(label)]
        begin, group = np.flatnonzero(change), np.cumsum(change) - 1
        size = np.diff(np.append(begin, len(rows)))
        left_over = np.zeros(len(rows), bool)
        live, step = np.arange(len(rows)), 1
        while len(live):
            live = live[live + step < len(rows)]
            live = live[group[live] == group[live + step]]
            if step >= NEAR and step & (step - 1) == 0 and len(live):
                while True:
                    top = self.root[self.root]
                    if (top == self.root).all():
                        break
                    self.root = top
                own = self.root[rows]
                whole = np.minimum.reduceat(own, begin) == np.maximum.reduceat(own, begin)
                if step == NEAR:
                    left_over = (~whole & (size > long))[group]
                live = live[~whole[group[live]] & ~left_over[live]]
            ask = live[self.root[rows[live]] != self.root[rows[live + step]]]
            if len(ask):
                near = linked(self.fp[rows[ask]], self.fp[rows[ask + step]], start[ask], self.distance)
                for x, y in zip(rows[ask[near]].tolist(), rows[ask[near] + step].tolist()):
                    p, q = self.find(x), self.find(y)
                    if p != q:
                        self.root[max(p, q)] = min(p, q)
                        self.found.append((int(self.fp[x]), int(self.fp[y])))
            step += 1
        return group, left_over

    def divide(self, rows: np.ndarray, group: np.ndarray, start: np.ndarray, free: np.ndarray) -> None:
        """Link rows of long groups by the bits at the ``free`` places.

        Rows that differ in at most ``distance`` bits are equal in one of ``distance + 1`` parts of
        them, so each part continues the key; groups that are still long are divided by the other parts.
        """
        parts = [part for part in np.array_split(free, self.distance + 1) if len(part)]
        for k, part in enumerate(parts):
            more = _gather(self.fp[rows], part)
            order = np.lexsort((more, group))
            both = np.stack([group[order].astype(np.uint64), more[order]])
            label = np.cumsum(np.append(False, (both[:, 1:] != both[:, :-1]).any(axis=0)))
            others = parts[:k] + parts[k + 1 :]
            own, left_over = self.walk(rows[order], label, start[order], LONG if others else len(rows))
            if left_over.any():
                self.divide(rows[order][left_over], own[left_over], start[order][left_over], np.concatenate(others))


def _forest(keys: np.ndarray, fp: np.ndarray, distance: int) -> list:
    """Links that connect the rows of equal (sorted) keys, a spanning forest of each key's links."""
    forest, ring = _Forest(fp, distance), segments(distance)
    kind = (keys & np.uint64(255)).astype(np.int64)
    group, left_over = forest.walk(np.arange(len(keys)), keys, kind >> 1, LONG)
    found = forest.found
    for one in np.unique(kind[left_over]).tolist():
        # the bits of the first segment and of the key's half of the second are equal within a key
        rows = np.flatnonzero(left_over & (kind == one))
        low, width = ring[one >> 1]
        at, size = ring[((one >> 1) + 1) % len(ring)]
        at, size = (at + size // 2, size - size // 2) if one & 1 else (at, size // 2)
        free = np.array([x for x in range(64) if not low <= x < low + width and not at <= x < at + size], np.int64)
        deeper = _Forest(fp[rows], distance)
        deeper.divide(np.arange(len(rows)), group[rows], kind[rows] >> 1, free)
        found += deeper.found
    return found


def links(prints: DataFrame, distance: int) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect whatever differs in ``distance`` bits or fewer."""

    def spread(frames):
        for batch in frames:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            row, key = chain_keys(fp, distance)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(fp[row].view(np.int64))], ["k", "fp"])

    def pair(frames):
        def out(keys, fp):
            found = _forest(keys, fp, distance)
            both = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["a", "b"])

        held = []  # batches of the last key, which may go on
        for batch in frames:
            if not batch.num_rows:
                continue
            keys, fp = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy().view(np.uint64)
            cut = int(np.searchsorted(keys.view(np.int64), keys.view(np.int64)[-1]))
            if held and (cut or held[-1][0][-1] != keys[0]):
                held.append((keys[:cut], fp[:cut]))
                yield out(*map(np.concatenate, zip(*held)))
                held = []
            elif cut:
                yield out(keys[:cut], fp[:cut])
            held.append((keys[cut:], fp[cut:]))
        if held:
            yield out(*map(np.concatenate, zip(*held)))

    spreaded = prints.select("fp").distinct().mapInArrow(spread, "k long, fp long")
    return spreaded.repartition("k").sortWithinPartitions("k", "fp").mapInArrow(pair, "a long, b long")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, distance: int = 4) -> DataFrame:
    """(key, fp, component): component is the least key reachable over links of ``distance`` bits or fewer.

    Texts with equal fingerprints are linked.  A row with a null key takes part and may
    carry a component; a component whose keys are all null has null.  Repeated
    rows stay.  An empty table gives an empty result.
    """
    prints = cut_lineage(fingerprints(df, key, text, shingle))
    classes = prints.groupBy("fp").agg(F.min("key").alias("least"))
    rooted = components(links(classes, distance)).withColumnsRenamed({"node": "fp"})
    joined = classes.join(rooted, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = joined.groupBy("root").agg(F.min("least").alias("component"))
    named = joined.join(least, "root").select("fp", "component")
    return prints.join(named, "fp").select("key", "fp", "component")
