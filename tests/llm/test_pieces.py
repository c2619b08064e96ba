import random

import pyarrow.parquet as pq
import pytest
import sentencepiece

from brute import frame
from prismtab.llm import pieces

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHARACTERS = "abc  deT\n\t漢é😀=-*/#▁1 "


def as_unigram(model: bytes) -> bytes:
    """The same pieces and scores under the other model type."""
    out, at = bytearray(), 0

    def varint(at):
        value = shift = 0
        while True:
            byte = model[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value, at
            shift += 7

    while at < len(model):
        start = at
        tag, at = varint(at)
        size, body = varint(at)
        own = model[body : body + size]
        at = body + size
        out += model[start:body] + (own.replace(b"\x18\x02", b"\x18\x01", 1) if tag >> 3 == 2 else own)
    return bytes(out)


@pytest.fixture(scope="module")
def model():
    with open(MODEL, "rb") as f:
        return f.read()


def texts():
    random.seed(7)
    made = ["".join(random.choice(CHARACTERS) for _ in range(random.randint(0, 120))) for _ in range(300)]
    return made + ["a" * 500, " " * 90, "=" * 300, "ab" * 300, "the" * 200, "<s></s><0x0A><unk>", "", " ", "Hello, world. It was the best of times"]


def ids(own, text):
    return [int.from_bytes(x, "little") for x in zip(*[iter(own.encode(text))] * 4)]


def test_bpe_ids_are_the_librarys(model):
    own, library = pieces.Pieces(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    for t in texts():
        found = library.encode(t)
        assert ids(own, t) == found
        assert own.decode(found) == library.decode(found)


def test_unigram_paths_have_the_best_score(model):
    """The best score over all segmentations, and never less than the library's segmentation has."""
    model = as_unigram(model)
    own, library = pieces.Pieces(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    assert own.kind == pieces.UNIGRAM

    def total(row):
        """Of a row of ids; the bytes of one character count as one unknown."""
        bytes_ = set(own.bytes.values())
        first = {i for b, i in own.bytes.items() if b < 128 or b >= 192}
        return sum((own.unknown_score if i in first else 0.0) if i in bytes_ else own.score[i] for i in row)

    for t in texts():
        whole = own.normalise(t)
        best = [0.0] + [float("-inf")] * len(whole)
        for j in range(1, len(whole) + 1):
            for i in range(max(0, j - own.longest), j):
                piece = own.ids.get(whole[i:j])
                if piece is not None:
                    best[j] = max(best[j], best[i] + own.score[piece])
            if whole[j - 1] not in own.ids:
                best[j] = max(best[j], best[j - 1] + own.unknown_score)
        found = ids(own, t)
        assert total(found) == best[-1], t
        assert total(found) >= total(library.encode(t))
        assert own.decode(found) == t.replace(pieces.MARK, " ")


def whole_path(own, text):
    """Ids of a stretch by a table over all its positions, read back once from its end."""
    n = len(text)
    last, came, best = [-1] + [-2] * n, [0] * (n + 1), [0.0] * (n + 1)
    for i in range(n):
        for j in range(i + 1, min(n, i + own.longest) + 1):
            piece = own.ids.get(text[i:j])
            if piece is None or last[i] == -2:
                continue
            if own.kind == pieces.BPE:
                better = last[j] == -2 and own.may_follow(last[i], piece)
            else:
                better = last[j] == -2 or best[i] + own.score[piece] > best[j]
            if better:
                last[j], came[j], best[j] = piece, i, best[i] + own.score[piece]
        if text[i] not in own.ids and (last[i + 1] == -2 or best[i] + own.unknown_score > best[i + 1]):
            last[i + 1], came[i + 1], best[i + 1] = -1, i, best[i] + own.unknown_score
    out, j = [], n
    while j:
        out[:0] = [last[j]] if last[j] >= 0 else [own.bytes[x] for x in text[came[j] : j].encode()]
        j = came[j]
    return out


@pytest.mark.parametrize("change", [bytes, as_unigram])
@pytest.mark.parametrize("stride, held", [(16, 1024), (1, 20), (4, 64)])
def test_streaming_commits_give_the_whole_path(model, change, stride, held, monkeypatch):
    """One stretch for the whole text, committed as paths meet, against one that never commits."""
    own = pieces.Pieces(change(model))
    monkeypatch.setattr(pieces, "STRIDE", stride)
    monkeypatch.setattr(pieces, "HELD", held)
    for t in texts():
        text = own.normalise(t)
        assert own.viterbi(text) == whole_path(own, text)


def test_the_given_documents_are_committed_early_in_a_bounded_window(model, monkeypatch):
    """Commits before a stretch's end on ``documents``, ids as the library's; open paths stay short."""
    table = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"])["text"].to_pylist()
    own, library = pieces.Pieces(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    early, longest, commit = 0, 0, pieces.Pieces._commit

    def counted(self, text, first, base, upto, *rest):
        nonlocal early, longest
        early += first + upto < len(text)
        longest = max(longest, upto - base)
        commit(self, text, first, base, upto, *rest)

    monkeypatch.setattr(pieces.Pieces, "_commit", counted)
    for t in table:
        assert ids(own, t or "") == library.encode(t or "")
        # the whole text as one stretch, without the memory
        assert own.viterbi(own.normalise(t or "")) == library.encode(t or "")
    assert early > 10_000
    assert longest <= 2 * own.longest + pieces.STRIDE


def test_round_trip_through_spark(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, None), (1, "again"), (1, "again"), (9, "word " * 60_000), (10, "x" * 200_000)]
    coded = pieces.encode(frame(spark, rows), MODEL)
    back = pieces.decode(coded, MODEL)
    assert coded.columns.count("ids") == 1 and "key" in coded.columns
    got = back.select("doc_id", "text", "ids", "decoded").collect()
    once = pieces.encode(frame(spark, rows), MODEL, decoded="decoded")
    assert sorted(map(str, once.select("doc_id", "text", "ids", "decoded").collect())) == sorted(map(str, got))
    assert pieces.encode(frame(spark, rows), MODEL, decoded="text").columns[-2:] == ["ids", "text"]
    assert len(got) == len(rows)
    for r in got:
        assert r.decoded == (r.text or "").replace("▁", " ")
        assert bool(r.ids) == bool(r.text)
    assert pieces.encode(frame(spark, []), MODEL).count() == 0
    assert [r.decoded for r in pieces.decode(spark.createDataFrame([(None,), ([],), ([1, 2],)], "ids array<int>"), MODEL).collect()] == [None, "", ""]


def test_unknown_characters_without_byte_fallback(model):
    own = pieces.Pieces(model)
    own.bytes = {}
    row = ids(own, "a\ue000\ue001\ue002b\ue000")
    assert row.count(own.unknown) == 2 and len(row) == 4
