import itertools
import random

import numpy as np
import pyarrow as pa

from brute import contaminated, frame
from prismtab.llm import decontaminate


def test_masks_hit_every_window_with_two_substitutions():
    for n in (*range(5, 13), 13):
        masks = decontaminate.MASKS if n == 13 else decontaminate.short_masks(n)
        allowed = n - -(-8 * n // 10)
        for gone in itertools.combinations(range(n), allowed):
            assert any(
                all(at + j not in gone for j, one in enumerate(mask) if one == "1")
                for mask in masks for at in range(n - len(mask) + 1)), (n, gone)


def overlap_rows(spark, docs, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.overlaps(frame(spark, docs), bench)
    assert out.columns[-1] == "matches" and out.columns.count("matches") == 1
    return out.select("doc_id", "text", "matches").collect()


def corpus():
    random.seed(6)
    voc = [f"w{i}" for i in range(60)] + ["the", "of", "Élan", "été"]
    item = lambda n: [random.choice(voc) for _ in range(n)]
    items = [(i, " ".join(item(n))) for i, n in enumerate([1, 3, 5, 6, 8, 10, 12, 13, 14, 20, 30, 45])]
    items += [(50, None), (51, ""), (52, "..."), (None, " ".join(item(25))), (60, items[9][1])]
    docs = []
    for i in range(150):
        around = [random.choice(voc) for _ in range(random.randint(0, 30))]
        own = (random.choice(items)[1] or "").split()
        for _ in range(random.choice([0, 0, 1, 2, 3, 5])):
            if own:
                own[random.randrange(len(own))] = "changed"
        at = random.randint(0, len(around))
        text = " ".join(around[:at] + own + around[at:])
        docs.append((i, random.choice([str, str.upper, lambda t: t.replace(" ", ", ")])(text)))
    docs += [(500, None), (501, ""), (502, items[0][1]), (503, items[1][1] + "!"), (504, items[1][1] + " more"), (504, items[9][1]), (None, items[10][1]), (505, "the " * 20000)]
    return docs, items


def test_matches_are_those_of_brute_force(spark):
    docs, items = corpus()
    want = sorted((d is None, d or 0, i is None, i or 0) for d, t in docs for i, x in items if contaminated(t, x))
    got = overlap_rows(spark, docs, items)
    assert len(got) == len(docs)
    assert sorted((r.doc_id is None, r.doc_id or 0, m.item is None, m.item or 0) for r in got for m in r.matches) == want
    assert len(want) > 80


def test_a_prompt_that_many_items_share_is_paired_once_per_item():
    """Hits grow with items times documents, not with the prompt's windows; the matches are those of every alignment."""
    random.seed(8)
    word = lambda: f"v{random.randrange(500)}"
    prompt = [word() for _ in range(80)]
    prompt[30:33] = prompt[10:13]
    items = [" ".join(prompt + [word() for _ in range(15)]) for _ in range(400)]
    docs = [" ".join([word() for _ in range(k)] + prompt[: 80 - k] + prompt[5:] + ["end"]) for k in range(6)] + [" ".join(prompt[:40] + ["x"] + prompt[41:])]
    index = decontaminate.Index(list(range(len(items))), items)
    hashes, first = decontaminate.tokens(pa.array(docs))
    length = np.diff(first)
    pairs = sum(len(left) for left, _ in index.hits(hashes, np.repeat(np.arange(len(docs)), length), length))
    # two copies of the prompt, four masks and few breaks; every window of every item would be 85 times as much
    assert pairs < 30 * len(items) * len(docs)
    found = index.matches(hashes, first, 13, 0.8)
    for r, doc in enumerate(docs):
        assert sorted(found[r]) == list(range(len(items)))
        for i in (0, 17, 399):
            own, text = items[i].split(), doc.split()
            best = None
            for diagonal in range(-len(own), len(text)):
                same = [text[x + diagonal] == own[x] if 0 <= x + diagonal < len(text) else None for x in range(len(own))]
                good = [x for x in range(len(own) - 12) if None not in same[x : x + 13] and sum(same[x : x + 13]) >= 11]
                if good:
                    now = (sum(same[good[0] : good[-1] + 13]), -(good[0] + diagonal), good[-1] + 12 + diagonal)
                    best = max(best or now, now)
            assert found[r][i] == (best[0], -best[1], best[2])


def test_a_benchmark_of_several_blocks_gives_the_same(spark, monkeypatch):
    docs, items = corpus()
    whole = {(r.doc_id, r.text): sorted(map(str, r.matches)) for r in overlap_rows(spark, docs, items)}
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 400)
    assert {(r.doc_id, r.text): sorted(map(str, r.matches)) for r in overlap_rows(spark, docs, items)} == whole


def test_empty_tables(spark):
    assert overlap_rows(spark, [], [(1, "a b c d e f")]) == []
    assert [r.matches for r in overlap_rows(spark, [(1, "a b c d e f")], [])] == [[]]
