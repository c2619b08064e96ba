"""Word n-gram language model of any order with interpolated modified Kneser-Ney smoothing.

Counting: map tasks combine the n-grams of their texts and send them, packed,
to the partition that the token before the last gives (if that one is hot, with four bits of the last, so that it
spreads).  There equal n-grams meet, and with them all that share a suffix of
two or more tokens, so the partition has the counts of every order from two on; it
stores each order's sorted hashes with their counts in the shared folder, and the sums of contexts
whose last token is not hot, which are whole there.  Sums of words and of the other contexts go on; a second exchange
adds these up and stores their sorted hash arrays.  All of the model beyond a few totals stays in those files.

The words of a bounded sample serve as codes of packed n-grams and name the hot words; they change the
bytes sent and where rows meet, never a count.

A file holds sorted 64-bit keys as an index of their first bits and 32 further bits of each (about 48 bits in all), and
values only of keys that differ from the usual ones.  A context is seen if it is an n-gram itself, so contexts
with the usual sums (followed once) are not stored.

Scoring: workers memory-map the arrays and look up the sorted, distinct words, contexts and
n-grams of a chunk of texts, so lookups walk through the arrays in order.

A token is a word (A-Z count as a-z) or the end that closes each text; before the
first word stand order - 1 start marks, which are no tokens.  Words are known by 48
bits of their XXH64, contexts and n-grams by 64 bits.

    p(w | u) = max(c(u w) - D(c), 0) / c(u) + g(u) p(w | u')
    p(w)     = max(a(w) - E(a), 0) / A + h / (V + 1)

u' is u without its first token.  c are counts at the model's order, and at lower orders the number of distinct
tokens (or start marks) before the n-gram; c(u) is their sum.  a(w) is the number of distinct contexts of w, A their sum, V the number
of distinct tokens (one more for all unknown ones); D and E are the three modified discounts
of each order, g and h the masses that they free.  A context that was never seen leaves it to u'.
"""

from __future__ import annotations

import math
import mmap
import os
import pickle
import tempfile
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prismtab.llm.arrays import LOWER, P1, batches, mix, small_batches, span_hashes, text_buffer, word_spans
from prismtab.session import ensure_checkpoint_dir

END, START = np.uint64(0), np.uint64(1)
#: parts that one context may spread over, text bytes that a part aims at, n-grams held before a flush, text bytes scored at once
SPREAD, PART_BYTES, HELD, SCORED = 16, 16 << 20, 2 << 20, 2 << 20
BIG = 255
#: text bytes of the sample, and words kept of it (one MB)
SAMPLE_BYTES, CODES = 16 << 20, 1 << 17
#: values that files leave out: an n-gram's count; a context's sum and how many n-grams of count 1, 2 and more it has; a word's
#: sums as a context, the distinct contexts before it, its occurrences
GRAM, CONTEXT, WORD = (1,), (1, 1, 0, 0), (1, 1, 0, 0, 1, 1)


def _words(column) -> tuple[np.ndarray, np.ndarray]:
    """(48-bit hash of every word, index of each row's first word)."""
    raw, offsets = text_buffer(column)
    raw = LOWER[raw]
    starts, ends, first = word_spans(raw, offsets)
    out = np.empty(len(starts), np.uint64)
    for a in range(0, len(starts), 1 << 15):
        out[a : a + (1 << 15)] = span_hashes(raw, starts[a : a + (1 << 15)], ends[a : a + (1 << 15)]) >> np.uint64(16)
    out[out < 2] += np.uint64(2)
    return out, first


def grams(column, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(the n-gram that ends at each token of the texts, oldest token first; index of each row's first token)."""
    words, first = _words(column)
    rows = len(first) - 1
    at = first + np.arange(rows + 1)  # one more token in each row
    token = np.empty(len(words) + rows, np.uint64)
    place = np.arange(len(words)) + np.repeat(np.arange(rows), np.diff(first))
    token[place] = words
    token[at[1:] - 1] = END
    since = np.arange(len(token)) - np.repeat(at[:-1], np.diff(at))
    out = [token]
    for back in range(1, order):
        own = np.full_like(token, START)
        inside = np.flatnonzero(since >= back)
        own[inside] = token[inside - back]
        out.append(own)
    return out[::-1], at


def pair_hash(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(context * P1 + mix(token))


def gram_hash(columns: list[np.ndarray]) -> np.ndarray:
    """A single token is its own hash."""
    out = columns[0]
    for token in columns[1:]:
        out = pair_hash(out, token)
    return out


def is_in(words: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether each word is one of the sorted ``known``, its place there)."""
    if not len(known):
        return np.zeros(len(words), bool), np.zeros(len(words), np.int64)
    at = np.searchsorted(known, words)
    at[at == len(known)] = 0
    return known[at] == words, at


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(an index of each distinct key, by key; the place of every key among them; their counts).  Unlike ``np.unique``
    it may name any of equal keys, so the sort need not be stable."""
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.append(True, ranked[1:] != ranked[:-1]) if len(keys) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    return order[begin], place, np.diff(begin, append=len(keys))


def part_of(context: np.ndarray, token: np.ndarray, parts: int, hot: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        slot = np.where(is_in(context, hot)[0], mix(token) & np.uint64(SPREAD - 1), np.uint64(0))
        return (mix(context * np.uint64(SPREAD) + slot) % np.uint64(parts)).astype(np.int64)


def range_of(words: np.ndarray, parts: int) -> np.ndarray:
    return ((words >> np.uint64(16)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _squeeze(*arrays) -> bytes:
    """Integer arrays, byte plane by byte plane."""
    planes = [(a.dtype.str, len(a), np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes()) for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(planes, 5))


def _unsqueeze(blob: bytes) -> list[np.ndarray]:
    out = []
    for kind, n, data in pickle.loads(zstandard.decompress(blob)):
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, n).T).reshape(-1).view(kind))
    return out


def _pack(columns: list[np.ndarray], count: np.ndarray, ranked: np.ndarray, order: np.ndarray) -> bytes:
    """N-grams with their counts: each token by its place in the codes (``ranked`` sorted, ``order`` their places), or
    behind them in a list of the blob's other tokens."""
    words = np.concatenate(columns)
    known, at = is_in(words, ranked)
    other, place = np.unique(words[~known], return_inverse=True)
    code = np.empty(len(words), np.uint32)
    code[known], code[~known] = order[at[known]], len(ranked) + place
    code = code.reshape(len(columns), -1)
    by = np.argsort(code[-2].astype(np.uint64) << np.uint64(32) | code[-1])
    code = np.ascontiguousarray(code[:, by])
    code[-2] = np.diff(code[-2], prepend=np.uint32(0))
    count = count[by].astype(np.min_scalar_type(int(count.max())))
    return _squeeze(np.diff(other, prepend=np.uint64(0)), count, *code)


def _unpack(blob: bytes, codes: np.ndarray) -> list[np.ndarray]:
    """The count and then the tokens."""
    delta, count, *code = _unsqueeze(blob)
    words = np.concatenate([codes, np.cumsum(delta, dtype=np.uint64)])
    code[-2] = np.cumsum(code[-2], dtype=np.uint32)
    return [count.astype(np.int64), *[words[c] for c in code]]


def _sample(frames, every: int):
    """(token, count) of every so many texts of a task."""
    seen, found = 0, []
    for batch in batches(frames):
        rows = np.arange(-seen % every, batch.num_rows, every)
        seen += batch.num_rows
        if len(rows):
            found.append(grams(batch.column(0).take(pa.array(rows)), 1)[0][0])
    if found:
        words, count = np.unique(np.concatenate(found), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(count)], ["token", "n"])


def sampled_words(df: DataFrame, text: str, size: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(the most frequent tokens of a sample of the texts, most frequent first; the start mark and those that may fill a quarter of a part, sorted)."""
    every = max(1, math.ceil(size / SAMPLE_BYTES))
    found = df.select(text).mapInArrow(lambda f: _sample(f, every), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = found.orderBy(F.desc("n"), "token").limit(CODES).toArrow()
    words, n = top.column(0).to_numpy().astype(np.int64).view(np.uint64), top.column(1).to_numpy()
    return words, np.unique(np.append(words[n * 4 * parts >= n.sum()], START))


def _count(frames, parts: int, order: int, codes: np.ndarray, hot: np.ndarray):
    """Texts to (part, blob): the distinct n-grams of some texts with their counts, by part."""

    def flushed(held):
        columns = [np.concatenate(x) for x in zip(*held)]
        at, _, count = distinct(gram_hash(columns))
        columns = [c[at] for c in columns]
        part = part_of(columns[-2], columns[-1], parts, hot)
        by = np.argsort(part.astype(np.min_scalar_type(parts)), kind="stable")
        part, columns, count = part[by], [c[by] for c in columns], count[by]
        edge = np.flatnonzero(np.append(True, part[1:] != part[:-1])).tolist() + [len(part)]
        blobs = [_pack([c[a:b] for c in columns], count[a:b], ranked, rank) for a, b in zip(edge, edge[1:])]
        return pa.RecordBatch.from_arrays([pa.array(part[edge[:-1]].astype(np.int32)), pa.array(blobs, pa.binary())], ["part", "blob"])

    rank = np.argsort(codes)  # once for all blobs of the task
    ranked = codes[rank]
    held, n = [], 0
    for batch in batches(frames):
        columns, _ = grams(batch.column(0), order)
        held.append(columns)
        n += len(columns[0])
        if n > HELD:
            yield flushed(held)
            held, n = [], 0
    if n:
        yield flushed(held)


class Store:
    """Files of one model in the shared folder; a folder of another store than the local one goes through Arrow's file systems."""

    def __init__(self, uri: str):
        self.uri = uri

    def local(self) -> str | None:
        for scheme in ("file://", "file:"):
            if self.uri.startswith(scheme):
                return self.uri[len(scheme) :]
        return None if "://" in self.uri else self.uri

    def write(self, name: str, *arrays: np.ndarray) -> None:
        """Whole or not at all, so a task that runs twice does no harm."""
        head = pickle.dumps([(a.dtype.str, len(a)) for a in arrays])
        head = len(head).to_bytes(8, "little") + head
        data = [head + bytes(-len(head) % 8), *(x for a in arrays for x in (a.tobytes(), bytes(-a.nbytes % 8)))]
        folder = self.local()
        if folder is None:
            from pyarrow import fs

            system, path = fs.FileSystem.from_uri(self.uri)
            system.create_dir(path, recursive=True)
            with system.open_output_stream(f"{path}/{name}") as out:
                for x in data:
                    out.write(x)
            return
        os.makedirs(folder, exist_ok=True)
        with tempfile.NamedTemporaryFile(dir=folder, delete=False) as out:
            for x in data:
                out.write(x)
        os.replace(out.name, f"{folder}/{name}")

    def map(self, name: str) -> list[np.ndarray]:
        """The arrays of a file, memory-mapped."""
        folder = self.local()
        if folder is None:  # a nameless local copy
            from pyarrow import fs

            system, path = fs.FileSystem.from_uri(self.uri)
            with tempfile.TemporaryFile() as copy, system.open_input_stream(f"{path}/{name}") as source:
                while piece := source.read(1 << 20):
                    copy.write(piece)
                copy.flush()
                data = mmap.mmap(copy.fileno(), 0, access=mmap.ACCESS_READ)
        else:
            with open(f"{folder}/{name}", "rb") as source:
                data = mmap.mmap(source.fileno(), 0, access=mmap.ACCESS_READ)
        size = int.from_bytes(data[:8], "little")
        at, out = 8 + size + (-(8 + size) % 8), []
        for kind, n in pickle.loads(data[8 : 8 + size]):
            out.append(np.frombuffer(data, kind, n, at))
            at += out[-1].nbytes + (-out[-1].nbytes % 8)
        return out


def table(keys: np.ndarray, columns: list[np.ndarray], usual: tuple[int, ...]) -> list[np.ndarray]:
    """Arrays of a file: sorted keys, spread evenly over 64 bits, with the columns of those that differ from ``usual``."""
    bits = max(1, (len(keys) >> 3).bit_length())
    edge = np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.uint32)
    rest = ((keys << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
    odd = np.flatnonzero(np.any([c != u for c, u in zip(columns, usual)], axis=0))
    own = [c[odd] for c in columns]
    big = np.flatnonzero(np.any([c >= BIG for c in own], axis=0))
    return [edge, rest, odd.astype(np.uint32), *[np.minimum(c, BIG).astype(np.uint8) for c in own], big.astype(np.uint32), *[c[big].astype(np.int64) for c in own]]


def look_up(arrays: list[np.ndarray], keys: np.ndarray, usual: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(which keys a file has, their columns)."""
    edge, rest, odd = arrays[:3]
    bits = max(1, (len(rest) >> 3).bit_length())
    first = (keys >> np.uint64(64 - bits)).astype(np.int64)
    key = ((keys << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
    low, high = edge[first].astype(np.int64), edge[first + 1].astype(np.int64)
    end, last = high, max(0, len(rest) - 1)
    for _ in range(int((high - low).max(initial=0)).bit_length() if len(rest) else 0):
        mid = (low + high) >> 1
        less = (low < high) & (rest[np.minimum(mid, last)] < key)
        low, high = np.where(less, mid + 1, low), np.where(less, high, mid)
    hit = np.flatnonzero((low < end) & (rest[np.minimum(low, last)] == key)) if len(rest) else np.empty(0, np.int64)
    out = np.repeat(np.array(usual, np.int64)[:, None], len(hit), axis=1)
    unusual, at = is_in(low[hit].astype(np.uint32), odd)
    k, at = len(usual), at[unusual]
    values = [c[at].astype(np.int64) for c in arrays[3 : 3 + k]]
    own, place = is_in(at.astype(np.uint32), arrays[3 + k])
    for v, c in zip(values, arrays[4 + k :]):
        v[own] = c[place[own]]
    out[:, unusual] = values
    return hit, out


def _group(keys: np.ndarray, *values: np.ndarray):
    """Distinct keys in order, with the sums of their values."""
    order = np.argsort(keys)
    keys = keys[order]
    begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return keys[begin], *[np.add.reduceat(v[order], begin) if len(begin) else v[:0] for v in values]


def _by_range(kind: int, where: np.ndarray, key: np.ndarray, *sums: np.ndarray) -> list[tuple[int, int, bytes]]:
    """(range, kind, blob) rows of sorted keys with their sums."""
    edge = np.flatnonzero(np.append(True, where[1:] != where[:-1])).tolist() + [len(where)]
    small = [x.astype(np.min_scalar_type(int(x.max(initial=0)))) for x in sums]
    return [(int(where[a]), kind, _squeeze(np.diff(key[a:b], prepend=np.uint64(0)), *[c[a:b] for c in small])) for a, b in zip(edge, edge[1:]) if b > a]


def _store_table(store: Store, name: str, keys: np.ndarray, *columns: np.ndarray, usual: tuple[int, ...]) -> None:
    """Distinct keys and their columns; contexts with the usual ones are left out."""
    if usual is CONTEXT:
        odd = np.any([c != u for c, u in zip(columns, usual)], axis=0)
        keys, columns = keys[odd], [c[odd] for c in columns]
    keys = mix(keys)
    by = np.argsort(keys)
    store.write(name, *table(keys[by], [c[by] for c in columns], usual))


def _store_grams(frames, store: Store, ranges: int, codes: np.ndarray, hot: np.ndarray):
    """One part's blobs to a sorted array for each order.

    Out go (range, kind, blob): per-word sums as kind 1, per-context sums of an order from three on as
    that order, and how many n-grams of an order have which count as minus the order.
    """
    part, found = None, []
    for batch in frames:
        for p, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            part = p
            found.append(_unpack(blob, codes))
    if part is None:
        return
    count, *columns = (np.concatenate(x) for x in zip(*found))
    del found
    rows = []
    heard, raw = _group(columns[-1], count)
    for order in range(len(columns), 1, -1):
        key = gram_hash(columns)
        by = np.argsort(key)
        key = key[by]
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        key, count = key[begin], np.add.reduceat(count[by], begin)
        columns = [c[by][begin] for c in columns]
        store.write(f"grams{order}-{part}", *table(key, [count], GRAM))
        rows.append((part % ranges, -order, _squeeze(np.bincount(np.minimum(count, 5), minlength=6))))
        key, sums = gram_hash(columns[:-1]), [count, *[(count == k).astype(np.int64) for k in (1, 2)], (count > 2).astype(np.int64)]
        if order > 2:
            whole = ~is_in(columns[-2], hot)[0]
            _store_table(store, f"contexts{order}-{part}", *_group(key[whole], *[x[whole] for x in sums]), usual=CONTEXT)
            context = _group(key[~whole], *[x[~whole] for x in sums])
            rows += _by_range(order, range_of(context[0] >> np.uint64(16), ranges), *context)
            columns, count = columns[1:], np.ones(len(count), np.int64)
        else:
            context = _group(key, *sums)
    after, contexts = _group(columns[-1], np.ones(len(columns[-1]), np.int64))
    groups = [(context[0], *context[1:], None, None), (after, None, None, None, None, contexts, None), (heard, None, None, None, None, None, raw)]
    sums = [[np.zeros(len(g[0]), np.int64) if x is None else x for x in g] for g in groups]
    words = _group(*[np.concatenate(x) for x in zip(*sums)])
    rows += _by_range(1, range_of(words[0], ranges), *words)
    for a in range(0, len(rows), 256):
        cols = list(zip(*rows[a : a + 256]))
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary())], ["range", "kind", "blob"])


def _store_sums(frames, store: Store, order: int):
    """One range's sums to its sorted arrays; out go its totals and the counts of counts of each order."""
    where, found, counts = None, {}, np.zeros((order, 6), np.int64)
    for batch in frames:
        for r, kind, blob in zip(*(batch.column(i).to_pylist() for i in range(3))):
            where = r
            if kind < 0:
                counts[-kind - 1] += _unsqueeze(blob)[0]
            else:
                delta, *sums = _unsqueeze(blob)
                found.setdefault(kind, []).append((np.cumsum(delta, dtype=np.uint64), *sums))
    if where is None:
        return
    totals = np.zeros(3, np.int64)
    for kind in sorted(found):
        keys, *sums = (np.concatenate(x) for x in zip(*found.pop(kind)))
        key, *sums = _group(keys, *[x.astype(np.int64) for x in sums])
        if kind == 1:
            _store_table(store, f"words-{where}", key, *sums, usual=WORD)
            contexts, raw = sums[4:]
            counts[0] = np.bincount(np.minimum(contexts[contexts > 0], 5), minlength=6)
            totals[:] = [(contexts > 0).sum(), raw.sum(), contexts.sum()]
        else:
            _store_table(store, f"hot{kind}-{where}", key, *sums, usual=CONTEXT)
    yield pa.RecordBatch.from_arrays([pa.array([where], pa.int32()), pa.array([[*totals.tolist(), *counts.ravel().tolist()]], pa.list_(pa.int64()))], ["range", "totals"])


def discounts(counts: np.ndarray) -> tuple[float, float, float]:
    """The three modified discounts from how many entries have the counts 0, 1, 2, 3 and 4."""
    n1, n2, n3, n4 = (float(x) for x in counts[1:5])
    if not n1 or not n2:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(found, 1))


@dataclass
class Model:
    """A trained model: its files, and totals over the training tokens."""

    uri: str
    parts: int
    ranges: int
    order: int
    tokens: int
    distinct: int
    contexts: int
    context_counts: tuple[int, ...]
    discounts: tuple[tuple[float, float, float], ...]  # of order 1 first
    hot: np.ndarray  # sorted words whose n-grams are spread over parts


def train(df: DataFrame, text: str = "text", order: int = 2) -> Model:
    """Count the n-grams of all texts of ``df`` (null: empty) up to ``order`` (at least 2) and store the model in the shared checkpoint folder."""
    if order < 2:
        raise ValueError("order must be at least 2")
    spark = df.sparkSession
    store = Store(f"{ensure_checkpoint_dir(spark).rstrip('/')}/ngrams-{uuid.uuid4().hex}")
    size = small_batches(df).agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / PART_BYTES))
    codes, hot = sampled_words(df, text, size, parts)
    counted = df.select(text).mapInArrow(lambda f: _count(f, parts, order, codes, hot), "part int, blob binary").repartitionById(parts, "part")
    summed = counted.mapInArrow(lambda f: _store_grams(f, store, parts, codes, hot), "range int, kind int, blob binary").repartitionById(parts, "range")
    totals = np.zeros(3 + 6 * order, np.int64)
    for r in summed.mapInArrow(lambda f: _store_sums(f, store, order), "range int, totals array<long>").collect():
        totals += r.totals
    distinct, tokens, contexts = totals[:3].tolist()
    counts = totals[3:].reshape(order, 6)
    return Model(store.uri, parts, parts, order, tokens, distinct, contexts, tuple(counts[0].tolist()), tuple(discounts(c) for c in counts), hot)


class Lookup:
    """A worker's view of a model's files, mapped when first asked for."""

    def __init__(self, model: Model):
        self.model, self.store, self.files = model, Store(model.uri), {}
        d, n = model.discounts[0], model.context_counts
        freed = d[0] * n[1] + d[1] * n[2] + d[2] * (n[3] + n[4] + n[5])
        self.floor = freed / model.contexts / (model.distinct + 1) if model.contexts else 1.0 / (model.distinct + 1)

    def file(self, name: str) -> list[np.ndarray] | None:
        if name not in self.files:
            try:
                self.files[name] = self.store.map(name)
            except FileNotFoundError:  # nothing fell into it
                self.files[name] = None
        return self.files[name]

    def find(self, kind: str, where: np.ndarray, keys: np.ndarray, usual: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        """(whether a key is in its file of this kind, its columns; zeros if not)."""
        found, out = np.zeros(len(keys), bool), np.zeros((len(usual), len(keys)), np.int64)
        order = np.arange(len(keys)) if np.all(keys[1:] >= keys[:-1]) else np.argsort(keys)
        # small integers are sorted by their digits
        order = order[np.argsort(where[order].astype(np.min_scalar_type(max(self.model.parts, self.model.ranges))), kind="stable")]
        edge = np.flatnonzero(np.diff(where[order], prepend=-1)).tolist() + [len(keys)]
        for a, b in zip(edge, edge[1:]):
            rows = order[a:b]
            arrays = self.file(f"{kind}-{int(where[rows[0]])}")
            if arrays is not None:
                hit, columns = look_up(arrays, keys[rows], usual)
                found[rows[hit]] = True
                out[:, rows[hit]] = columns
        return found, out

    def words(self, words: np.ndarray):
        """(count as a token, sum as a context, freed share, p(w)) of distinct words."""
        m = self.model
        _, (total, *n, contexts, count) = self.find("words", range_of(words, m.ranges), mix(words), WORD)
        freed = sum(d * x for d, x in zip(m.discounts[1], n))
        less = np.array([0.0, *m.discounts[0]])[np.minimum(contexts, 3)]
        alone = np.maximum(contexts - less, 0.0) / max(1, m.contexts) + self.floor
        return count, total, freed / np.maximum(total, 1), alone

    def contexts(self, columns: list[np.ndarray]):
        """(sum, freed share) of distinct contexts of two tokens or more."""
        m, order = self.model, len(columns) + 1
        keys, hot = gram_hash(columns), is_in(columns[-1], m.hot)[0]
        found, sums = np.zeros(len(keys), bool), np.zeros((len(CONTEXT), len(keys)), np.int64)
        for kind, rows in ((f"contexts{order}", np.flatnonzero(~hot)), (f"hot{order}", np.flatnonzero(hot))):
            where = range_of(keys[rows] >> np.uint64(16), m.ranges) if kind[0] == "h" else part_of(columns[-1][rows], columns[-1][rows], m.parts, m.hot)
            found[rows], sums[:, rows] = self.find(kind, where, mix(keys[rows]), CONTEXT)
        # what is not stored was followed once if it was there at all; before start marks nothing stands, so they are no n-grams
        rest = np.flatnonzero(~found)
        seen = self.grams([c[rest] for c in columns]) > 0
        seen |= (columns[-1][rest] == START) & (m.tokens > 0)
        sums[:, rest[seen]] = np.array(CONTEXT)[:, None]
        freed = sum(d * x for d, x in zip(m.discounts[order - 1], sums[1:]))
        return sums[0], freed / np.maximum(sums[0], 1)

    def grams(self, columns: list[np.ndarray]) -> np.ndarray:
        """Counts of the n-grams."""
        m = self.model
        return self.find(f"grams{len(columns)}", part_of(columns[-2], columns[-1], m.parts, m.hot), gram_hash(columns), GRAM)[1][0]


_OPEN: dict[str, Lookup] = {}


def opened(model: Model) -> Lookup:
    if model.uri not in _OPEN:
        _OPEN.clear()
        _OPEN[model.uri] = Lookup(model)
    return _OPEN[model.uri]


def token_scores(lookup: Lookup, columns: list[np.ndarray]):
    """(training count, log10 of the base probability, log10 p(token | context)) of the tokens that n-grams end with."""
    m = lookup.model
    # the token before is the one at the place before, unless a text or the piece begins here
    words = np.concatenate([columns[-1], columns[-2][:1], [START]])
    first, place, _ = distinct(words)
    right = place[:-2]
    left = np.where(columns[-2] == START, place[-1], np.append(place[-2], right[:-1]))
    count, sums, freed, alone = lookup.words(words[first])
    chance, total, free = alone[right], sums[left], freed[left]
    for order in range(2, m.order + 1):
        own = columns[-order:]
        if order > 2:
            first, place, _ = distinct(gram_hash(own[:-1]))
            sums, freed = lookup.contexts([c[first] for c in own[:-1]])
            total, free = sums[place], freed[place]
        # each n-gram once
        first, again, _ = distinct(gram_hash(own))
        seen = lookup.grams([c[first] for c in own])[again]
        less = np.array([0.0, *m.discounts[order - 1]])[np.minimum(seen, 3)]
        chance = np.where(total > 0, np.maximum(seen - less, 0.0) / np.maximum(total, 1) + free * chance, chance)
    base = np.log10((count + 0.1) / (m.tokens + 0.1 * (m.distinct + 1)))
    return count[right], base[right], np.log10(chance)


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All rows and columns of ``df`` with ``n_tokens``, ``n_known``, ``base_score`` and ``score``.

    Scores are log10 probabilities of the whole text with its end; a null or
    empty text is the end alone.  ``n_known`` tokens occur in the training
    texts; ``base_score`` is that of the word frequencies smoothed by 0.1.
    A model of no text gives every token the same probability.  Input columns of these names are replaced.
    """
    names = ["n_tokens", "n_known", "base_score", "score"]
    df = small_batches(df).drop(*names)
    place = df.columns.index(text)
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, k) for n, k in zip(names, (T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType()))]])

    def run(frames):
        lookup = opened(model)
        for batch in batches(frames, size=SCORED):
            columns, at = grams(batch.column(place), model.order)
            rows, n = np.diff(at), len(columns[0])
            known, base, chance = np.empty(n, np.int64), np.empty(n), np.empty(n)
            for a in range(0, n, 1 << 20):  # a very long text comes in pieces
                b = a + (1 << 20)
                known[a:b], base[a:b], chance[a:b] = token_scores(lookup, [c[a:b] for c in columns])
            sums = [np.add.reduceat(x, at[:-1]) for x in ((known > 0).astype(np.int64), base, chance)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows.astype(np.int64)), *map(pa.array, sums)], names=schema.names)

    return df.mapInArrow(run, schema)
