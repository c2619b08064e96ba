"""Benchmark decontamination by spaced-seed hashing.

A mask keeps some token positions of a window and ignores the others, so a
window still hashes alike when ignored positions were substituted.  The
hashes of all windows of the benchmark (for each mask) are a sorted array; the
windows of each document are looked up in it, and around each hit document and
item are compared token by token along the hit's diagonal.  A run of hits on one diagonal
is taken up once, where it begins, so a passage that many items
share (a common prompt) costs a document as many comparisons as it has matches.

The benchmark is the stated query set.  It is taken in blocks of about
``BLOCK_BYTES`` of text (one block for usual sizes); each block's index is
broadcast, and a larger benchmark means more blocks, which run one after
another within the same tasks.  Documents are neither shuffled nor paired.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prismtab.llm.arrays import batches, mix, small_batches, span_hashes, text_buffer, word_spans

#: 1: the token counts, 0: it is ignored.  Whichever two tokens of a window of thirteen
#: are substituted, one of these masks hits at some place inside the window.
MASKS = ("1110101011", "10010110111", "11111001001", "1101001100011")
SPAN = 13
#: shorter items count only when they are a whole document
LEAST_TOKENS = 5
BLOCK_BYTES = 2 << 20
CHUNK = 1 << 16

# letters in lower case, digits and all bytes beyond ASCII are word characters
_WORD = np.full(256, 32, np.uint8)
_WORD[48:58] = np.arange(48, 58)
_WORD[97:123] = np.arange(97, 123)
_WORD[128:] = np.arange(128, 256)
_WEIGHTS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)

MATCH = T.ArrayType(T.StructType([
    T.StructField("item", T.LongType()),
    T.StructField("matched", T.IntegerType()),
    T.StructField("item_tokens", T.IntegerType()),
    T.StructField("first_token", T.LongType()),
    T.StructField("last_token", T.LongType()),
]))


def tokens(column) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every token, index of each row's first token); case and punctuation do not count."""
    raw, offsets = text_buffer(pc.utf8_lower(column.cast(pa.large_string())))
    raw = _WORD[raw]
    starts, ends, first = word_spans(raw, offsets)
    out = np.empty(len(starts), np.uint64)
    for a in range(0, len(starts), CHUNK):
        out[a : a + CHUNK] = span_hashes(raw, starts[a : a + CHUNK], ends[a : a + CHUNK])
    return out, first


def spaced(hashes: np.ndarray, mask: str) -> np.ndarray:
    """Hash of every window under the mask."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j, one in enumerate(mask):
            if one == "1":
                out += hashes[j : j + n] * _WEIGHTS[j % 64]
    return mix(out)


def short_masks(n: int) -> list[str]:
    """Masks over a whole item of n < SPAN tokens: one more than the substitutions that it may have."""
    if n < LEAST_TOKENS:
        return ["1" * n]
    parts = n - math.ceil(0.8 * n - 1e-9) + 1
    return ["".join("1" if j % parts == p else "0" for j in range(n)) for p in range(parts)]


class Index:
    """Masked windows of one block of items; plain arrays, so that it can be broadcast."""

    def __init__(self, ids: list, texts: list):
        self.ids = ids
        self.hashes, self.first = tokens(pa.array(texts, pa.string()))
        length = np.diff(self.first)
        item_of = np.repeat(np.arange(len(ids)), length)
        self.tables = []
        masks = [(m, None) for m in MASKS]
        for n in sorted(set(length[(length > 0) & (length < SPAN)].tolist())):
            masks += [(m, n) for m in short_masks(n)]
        for mask, only in masks:
            h = spaced(self.hashes, mask)
            at = np.flatnonzero(item_of[: len(h)] == item_of[len(mask) - 1 :][: len(h)])
            at = at[length[item_of[at]] == only] if only else at[length[item_of[at]] >= SPAN]
            if not len(at):
                continue
            keys, known = np.unique(h[at], return_inverse=True)
            # places of one hash stand by the hash of the window before theirs; the first window of an item has none
            before = np.where(item_of[at - 1] == item_of[at], np.append(len(keys), known[:-1]), len(keys))
            code = known * (len(keys) + 1) + before
            order = np.argsort(code, kind="stable")
            bits = max(10, min(26, int(8 * len(keys)).bit_length()))
            seen = np.zeros(1 << bits, bool)
            seen[(keys >> np.uint64(64 - bits)).astype(np.int64)] = True
            self.tables.append((mask, keys, code[order], at[order], seen, bits, bool(only and only < LEAST_TOKENS)))
        self.item_of = item_of

    def hits(self, hashes: np.ndarray, row_of: np.ndarray, alone: np.ndarray):
        """(token of the document side, token of the benchmark side) where equal masked windows begin.

        Of windows that are equal one after another on one diagonal only the first counts: if a
        document's previous window is in the index too, the places behind that
        window are left out.  So a passage that many items share costs a document
        one pair per item, not one per item and window.
        """
        for mask, keys, codes, at, seen, bits, whole in self.tables:
            h = spaced(hashes, mask)
            if not len(h):
                continue
            maybe = np.flatnonzero(seen[(h >> np.uint64(64 - bits)).astype(np.int64)])
            maybe = maybe[row_of[maybe] == row_of[maybe + len(mask) - 1]]
            if whole:  # the window is the whole document
                maybe = maybe[alone[row_of[maybe]] == len(mask)]
            known = np.minimum(np.searchsorted(keys, h[maybe]), len(keys) - 1)
            sure = keys[known] == h[maybe]
            maybe, known = maybe[sure], known[sure]
            code, none = known * (len(keys) + 1), len(keys)
            low, high = np.searchsorted(codes, code), np.searchsorted(codes, code + none, "right")
            follows = np.zeros(len(maybe), bool)
            follows[1:] = (maybe[1:] == maybe[:-1] + 1) & (row_of[maybe[1:]] == row_of[maybe[:-1]])
            before = np.where(follows, np.append(none, known[:-1])[: len(known)], none)
            skip = np.where(follows, np.searchsorted(codes, code + before), low)
            resume = np.where(follows, np.searchsorted(codes, code + before, "right"), low)
            for a, b in ((low, skip), (resume, high)):
                many = b - a
                left = np.repeat(maybe, many)
                yield left, at[np.repeat(a, many) + np.arange(len(left)) - np.repeat(np.cumsum(many) - many, many)]

    def matches(self, hashes: np.ndarray, first: np.ndarray, window: int, similarity: float) -> dict[int, dict]:
        """row: {item: (matched, first token, last token)} for the verified overlaps."""
        length = np.diff(first)
        row_of = np.repeat(np.arange(len(length)), length)
        asked = []
        for a in range(0, len(hashes), CHUNK):
            b = min(len(hashes), a + CHUNK + SPAN - 1)
            for left, right in self.hits(hashes[a:b], row_of[a:b], length):
                left = left + a
                row, item = row_of[left], self.item_of[right]
                diagonal = (left - first[row]) - (right - self.first[item])
                if len(left):
                    asked.append(np.unique(np.stack([row, item, diagonal], 1), axis=0))
        found: dict[int, dict] = {}
        if not asked:
            return found
        row, item, diagonal = np.unique(np.concatenate(asked), axis=0).T
        own = np.diff(self.first)[item]
        low, high = np.maximum(0, -diagonal), np.minimum(own, length[row] - diagonal)
        size = np.minimum(window, own)
        enough = np.flatnonzero(high - low >= size)
        upto = np.cumsum((high - low)[enough])
        at = 0
        while at < len(enough):
            # pairs of together about a chunk of tokens
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + CHUNK * 8, "right")))
            some = enough[at:end]
            at = end
            n, edge = (high - low)[some], np.concatenate([[0], np.cumsum((high - low)[some])])
            step = np.arange(edge[-1]) - np.repeat(edge[:-1], n)
            mine = self.hashes[np.repeat(self.first[item[some]] + low[some], n) + step]
            text = hashes[np.repeat(first[row[some]] + low[some] + diagonal[some], n) + step]
            equal = np.concatenate([[0], np.cumsum(mine == text)])
            # windows by the place where they begin; those that would leave their pair are none
            width = np.repeat(size[some], n)
            inside = np.flatnonzero(step + width <= np.repeat(n, n))
            need = np.ceil(similarity * size[some] - 1e-9).astype(np.int64)
            pair = np.repeat(np.arange(len(some)), n)[inside]
            good = equal[inside + width[inside]] - equal[inside] >= need[pair]
            inside, pair = inside[good], pair[good]
            if not len(pair):
                continue
            change = np.append(True, pair[1:] != pair[:-1])
            one, begin = pair[change], inside[change]
            last = inside[np.append(change[1:], True)] + size[some][one]
            shift = low[some][one] + diagonal[some][one] - edge[one]
            for r, i, best in zip(row[some][one].tolist(), item[some][one].tolist(),
                                  zip((equal[last] - equal[begin]).tolist(), (begin + shift).tolist(), (last - 1 + shift).tolist())):
                before = found.setdefault(r, {}).get(i)
                if before is None or (best[0], -best[1]) > (before[0], -before[1]):
                    found[r][i] = best
        return found


def overlaps(df: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
             window: int = 13, similarity: float = 0.8) -> DataFrame:
    """All rows and columns of ``df`` with ``matches``, an array of the benchmark items that the row's text overlaps.

    A match is an item (long id), the equal tokens on its best alignment, the item's
    token count, and the first and last token of the overlap in the document
    (from 0).  It needs ``window`` aligned tokens (the whole item, if shorter)
    of which at least ``similarity`` are equal, found through a mask hit.
    Items of under ``LEAST_TOKENS`` tokens match only a document that they
    equal; items without tokens match none.  A null or empty text has no
    matches.  An input column named matches is replaced.  Items with equal
    texts each match under their own id.
    """
    df = small_batches(df).drop("matches")
    spark = df.sparkSession
    items = benchmark.select(F.col(item_id).cast("long").alias("id"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    width = len(df.columns)
    place = [f.name for f in df.schema].index(text)
    schema = T.StructType([*df.schema.fields, T.StructField("matches", MATCH)])
    arrow = pa.list_(pa.struct([("item", pa.int64()), ("matched", pa.int32()), ("item_tokens", pa.int32()), ("first_token", pa.int64()), ("last_token", pa.int64())]))

    def scan(index):
        def run(frames):
            block = index.value
            for batch in batches(frames):
                hashes, first = tokens(batch.column(place))
                found = block.matches(hashes, first, window, similarity)
                own = [
                    [{"item": block.ids[i], "matched": m, "item_tokens": int(block.first[i + 1] - block.first[i]), "first_token": a, "last_token": b}
                     for i, (m, a, b) in sorted(found.get(r, {}).items())]
                    for r in range(batch.num_rows)
                ]
                columns = list(batch.columns)
                if len(columns) > width:  # matches of earlier blocks
                    own = [x + y for x, y in zip(columns.pop().to_pylist(), own)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(own, arrow)], schema.names)

        return run

    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).collect()
        rows.sort(key=lambda r: (r.id is None, r.id or 0, r.text))
        index = spark.sparkContext.broadcast(Index([r.id for r in rows], [r.text for r in rows]))
        df = df.mapInArrow(scan(index), schema)
    return df
