"""SentencePiece encoding and decoding by a streaming Viterbi.

The encoder walks over a text once.  At every position it keeps one
backpointer, and only positions within the longest piece ahead can still be
reached from behind, so the paths that survive end in a window of that
length.  Whenever all of them run through one boundary, the ids up to it are
committed and everything before it is forgotten: at once where no path has gone
beyond a position, and by following the backpointers where paths have parted for longer.

For a unigram model the backpointer of a position is the best-scoring path to
it.  For a BPE model it is the merge result of the text up to there, which is unique: a
piece may follow another exactly if merging the two pieces' characters from
scratch gives these two pieces again, and a row of pieces is the model's own
result if that holds for each adjacent pair.  Thus both kinds give the model's ids.

No path crosses a pair of neighbouring characters that no piece holds, such as
the start of a word in usual vocabularies; stretches between such places are coded apart
and remembered (a bounded memory).  Only the model's bytes, of a checked size, are broadcast.
"""

from __future__ import annotations

import re
import struct
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prismtab.llm.arrays import batches, small_batches

MARK = "▁"
MODEL_BYTES = 64 << 20
#: positions between looks for a common boundary behind paths that have parted; positions after which committed ones are forgotten
STRIDE, HELD = 16, 1024
#: remembered stretches (in each of two generations) and their length
REMEMBERED, SHORT = 1 << 18, 48
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes):
    """(number, value) of the fields of a serialised message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value, at
            shift += 7

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 1:
            value, at = data[at : at + 8], at + 8
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at : at + size], at + size
        else:
            value, at = data[at : at + 4], at + 4
        yield tag >> 3, value


class Remembered(dict):
    """Ids (as bytes) of stretches; the older half goes when the memory is full."""

    def __init__(self, pieces: "Pieces"):
        self.pieces, self.older = pieces, {}

    def __missing__(self, stretch: str) -> bytes:
        found = self.older.get(stretch)
        if found is None:
            # no path crosses two neighbours that no piece holds
            inside = self.pieces.inside
            cuts = [k for k, pair in enumerate(zip(stretch, stretch[1:]), 1) if pair not in inside]
            if cuts:
                found = b"".join([self.part(stretch[a:b]) for a, b in zip([0, *cuts], [*cuts, len(stretch)])])
            else:
                found = array("i", self.pieces.viterbi(stretch)).tobytes()
        self.keep(stretch, found)
        return found

    def part(self, stretch: str) -> bytes:
        """As for any stretch, but it holds no place to cut."""
        found = self.get(stretch) or self.older.get(stretch)
        if found is None:
            found = array("i", self.pieces.viterbi(stretch)).tobytes()
            self.keep(stretch, found)
        return found

    def keep(self, stretch: str, found: bytes) -> None:
        if len(stretch) <= SHORT:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[stretch] = found


class Pieces:
    """A model's pieces with its encoder and decoder."""

    def __init__(self, model: bytes):
        self.model = model
        pieces, self.kind, fallback, prefix, extra, charsmap = [], UNIGRAM, False, True, True, b""
        for number, value in _fields(model):
            if number == 1:
                own = dict(_fields(value))
                pieces.append((own[1].decode(), struct.unpack("<f", own[2])[0] if 2 in own else 0.0, own.get(3, NORMAL)))
            elif number == 2:
                spec = dict(_fields(value))
                self.kind, fallback = spec.get(3, UNIGRAM), bool(spec.get(35, 0))
            elif number == 3:
                spec = dict(_fields(value))
                prefix, extra, charsmap = bool(spec.get(3, 1)), bool(spec.get(4, 1)), spec.get(2, b"")
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models have paths to choose from")
        self.prefix, self.plain = prefix, not charsmap and not extra
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER_DEFINED)}
        self.score = [s for _, s, _ in pieces]
        self.text = [p for p, _, _ in pieces]
        self.unknown = next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), 0)
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE} if fallback else {}
        self.longest = max(map(len, self.ids), default=1)
        # nested by character; a piece's id stands under the empty string
        self.trie: dict = {}
        for p, i in self.ids.items():
            node = self.trie
            for c in p:
                node = node.setdefault(c, {})
            node[""] = i
        self.inside = {pair for p in self.ids for pair in zip(p, p[1:])}
        normal = [s for _, s, kind in pieces if kind == NORMAL]
        self.unknown_score = min(normal, default=0.0) - 10.0
        given = sorted((p for p, _, kind in pieces if kind == USER_DEFINED), key=len, reverse=True)
        self.given = re.compile("(" + "|".join(map(re.escape, given)) + ")") if given else None
        self.surface = [
            bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else " ⁇ ".encode() if kind == UNKNOWN else p.replace(MARK, " ").encode()
            for p, _, kind in pieces
        ]
        crossed = any(MARK in p.lstrip(MARK) for p in self.ids)
        alone = "".join(c for c in "\n\t\r" if not any(c in p for p in self.ids))
        self.stretches = None if crossed else re.compile(f"{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+" + (f"|[{alone}]" if alone else ""))
        self.follows: dict[int, bool] = {}
        self.remembered = Remembered(self)
        self.library = None

    def normalise(self, text: str) -> str:
        if self.plain:
            return (MARK if self.prefix and text else "") + text.replace(" ", MARK)
        if self.library is None:
            import sentencepiece

            self.library = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        return self.library.normalize(text)

    def merged(self, text: str) -> list[int]:
        """Pieces of a short text when the best-scoring adjacent pair, the leftmost of equals, is merged first."""
        parts = list(text)
        while len(parts) > 1:
            best = max(((self.score[self.ids[a + b]], -k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.ids), default=None)
            if best is None:
                break
            k = -best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return [self.ids.get(p, -1) for p in parts]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether a BPE model would leave these two pieces side by side (left is -1 at the start of a stretch)."""
        pair = (left + 1) << 32 | right
        known = self.follows.get(pair)
        if known is None:
            if len(self.follows) >= 2 * REMEMBERED:
                self.follows.clear()
            text = self.text[right]
            known = self.merged(text) == [right] if left < 0 else self.merged(self.text[left] + text) == [left, right]
            self.follows[pair] = known
        return known

    def viterbi(self, text: str) -> list[int]:
        """Ids of a normalised stretch.

        ``last`` and ``came`` hold, for each position that is kept, the piece that ends there and
        where it begins: -2 is not reached, -1 a start or an unknown
        character.  Paths go through ``base``, the last committed boundary;
        ``reach`` is the furthest position that any path has come to.
        """
        n, bpe, out = len(text), self.kind == BPE, []
        trie, follows, score, longest = self.trie, self.follows, self.score, self.longest
        room = min(n, HELD)
        last, came, best = [-1] + [-2] * room, [0] * (room + 1), [0.0] * (room + 1)
        first = base = at = reach = 0
        while first + at < n:
            if at == reach:
                if at > base:  # no path has gone beyond, so all of them end here
                    self._commit(text, first, base, at, last, came, out)
                    base = at
            elif at - base >= STRIDE and (at - base) % STRIDE == 0:
                # the boundary that the paths to all positions ahead run through
                ends = {p for p in range(at, reach + 1) if last[p] != -2}
                while len(ends) > 1:
                    furthest = max(ends)
                    ends.remove(furthest)
                    ends.add(came[furthest])
                furthest = ends.pop()
                if furthest > base:
                    self._commit(text, first, base, furthest, last, came, out)
                    base = furthest
            if at + longest > room and first + room < n:
                # what lies before the boundary is forgotten
                more = min(n - first - room, base + HELD)
                last, came, best = last[base:] + [-2] * more, [x - base for x in came[base:]] + [0] * more, best[base:] + [0.0] * more
                room, first, at, reach, base = room - base + more, first + base, at - base, reach - base, 0
            left = last[at]
            if left != -2:
                node, to, before = trie, at, (left + 1) << 32
                for c in text[first + at : first + at + longest]:
                    node = node.get(c)
                    if node is None:
                        break
                    to += 1
                    if "" not in node:
                        continue
                    piece = node[""]
                    if bpe:
                        if last[to] == -2:
                            known = follows.get(before | piece)
                            if known or known is None and self.may_follow(left, piece):
                                last[to], came[to] = piece, at
                                if to > reach:
                                    reach = to
                    else:
                        value = best[at] + score[piece]
                        if last[to] == -2 or value > best[to]:
                            last[to], came[to], best[to] = piece, at, value
                            if to > reach:
                                reach = to
                if last[at + 1] == -2 if bpe else "" not in trie.get(text[first + at], trie):
                    value = best[at] + self.unknown_score
                    if last[at + 1] == -2 or value > best[at + 1]:
                        last[at + 1], came[at + 1], best[at + 1] = -1, at, value
                        if at >= reach:
                            reach = at + 1
            at += 1
        self._commit(text, first, base, at, last, came, out)
        return out

    def _commit(self, text: str, first: int, base: int, upto: int, last: list, came: list, out: list) -> None:
        """Append the ids of the path from the committed boundary ``base`` to ``upto`` (both counted from ``first``)."""
        path = []
        while upto > base:
            path.append((last[upto], came[upto], upto))
            upto = came[upto]
        for piece, a, b in reversed(path):
            if piece >= 0:
                out.append(piece)
            elif self.bytes:
                out.extend(self.bytes[x] for x in text[first + a : first + b].encode())
            else:
                out.append(self.unknown)

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian 32-bit integers; a run of unknown characters is one id."""
        if not text:
            return b""
        coded = self._coded(text)
        if not self.bytes:
            ids = np.frombuffer(coded, np.int32)
            unknown = ids == self.unknown
            unknown[1:] &= unknown[:-1].copy()
            unknown[:1] = False
            coded = ids[~unknown].tobytes()
        return coded

    def _coded(self, text: str) -> bytes:
        whole = self.normalise(text)
        if self.given is None:
            parts = self.stretches.findall(whole) if self.stretches else [whole]
            return b"".join(map(self.remembered.__getitem__, parts))
        out = []
        for k, part in enumerate(self.given.split(whole)):
            if k % 2:
                out.append(np.int32(self.ids[part]).tobytes())
            elif part:
                out += map(self.remembered.__getitem__, self.stretches.findall(part) if self.stretches else [part])
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of the ids; ill-formed byte runs become replacement characters."""
        data = b"".join(map(self.surface.__getitem__, ids))
        if self.prefix and data[:1] == b" " and ids and self.text[ids[0]][:1] == MARK:
            data = data[1:]
        return data.decode("utf-8", "replace")


_LOADED: dict[bytes, Pieces] = {}


def loaded(model: bytes) -> Pieces:
    """The worker's own copy of a model, with what it remembers."""
    if model not in _LOADED:
        _LOADED.clear()
        _LOADED[model] = Pieces(model)
    return _LOADED[model]


def read_model(spark: SparkSession, path: str) -> bytes:
    """The model's bytes, read by Spark (any store); a file beyond ``MODEL_BYTES`` is refused."""
    files = spark.read.format("binaryFile").load(path)
    if files.select(F.max("length")).first()[0] > MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MODEL_BYTES} bytes")
    return bytes(files.select("content").first()[0])


def encode(df: DataFrame, model_path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """All rows and columns of ``df`` with the text's piece ids, array<int>, and if wanted with the text that they decode to.

    Null and empty texts have no ids.  Texts of any length are coded whole, in
    memory of a few times the text.  Input columns named as ``ids`` or ``decoded`` are replaced
    (``decoded`` may be the text's own column).
    """
    df = small_batches(df).drop(ids)
    place = df.columns.index(text)
    kept = [i for i, c in enumerate(df.columns) if c != decoded]
    fields = [*(df.schema.fields[i] for i in kept), T.StructField(ids, T.ArrayType(T.IntegerType(), False))]
    schema = T.StructType([*fields, T.StructField(decoded, T.StringType())] if decoded else fields)
    model = df.sparkSession.sparkContext.broadcast(read_model(df.sparkSession, model_path))

    def run(frames):
        pieces = loaded(model.value)
        for batch in batches(frames):
            coded = [pieces.encode(t) if t else b"" for t in batch.column(place).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])])
            item = pa.field("element", pa.int32(), False)
            values = pa.array(np.frombuffer(b"".join(coded), np.int32))
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values, type=pa.list_(item))
            columns = [batch.column(i) for i in kept] + [lists]
            if decoded:
                values = values.to_numpy()
                columns.append(pa.array([pieces.decode(values[a:b].tolist()) for a, b in zip(offsets, offsets[1:])], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, model_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All rows and columns of ``df`` with the text of the ids; a null list gives null, an empty one an empty text."""
    df = small_batches(df).drop(text)
    place = df.columns.index(ids)
    schema = T.StructType([*df.schema.fields, T.StructField(text, T.StringType())])
    model = df.sparkSession.sparkContext.broadcast(read_model(df.sparkSession, model_path))

    def run(frames):
        pieces = loaded(model.value)
        for batch in batches(frames):
            column = batch.column(place)
            values = column.values.to_numpy(zero_copy_only=False)
            offsets = column.offsets.to_numpy()
            valid = column.is_valid().to_pylist()
            texts = [pieces.decode(values[a:b].tolist()) if ok else None for ok, a, b in zip(valid, offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return df.mapInArrow(run, schema)
