import collections
import math

import numpy as np
import pyarrow as pa

from brute import frame, words
from conftest import SF_MID
from prismtab.llm import ngrams


class Brute:
    """The model's formulas over plain counters."""

    def __init__(self, texts):
        self.pair, self.count, self.context = collections.Counter(), collections.Counter(), collections.Counter()
        for t in texts:
            before = "start"
            for w in self.tokens(t):
                self.pair[before, w] += 1
                self.count[w] += 1
                self.context[before] += 1
                before = w
        self.kinds, self.before = collections.defaultdict(lambda: [0, 0, 0]), collections.Counter()
        for (u, w), c in self.pair.items():
            self.kinds[u][min(c, 3) - 1] += 1
            self.before[w] += 1
        many = lambda c: np.bincount(np.minimum(list(c.values()) or [0], 5), minlength=6)
        self.d, self.e = ngrams.discounts(many(self.pair)), ngrams.discounts(many(self.before))
        a, n = sum(self.before.values()), many(self.before)
        self.total, self.distinct, self.contexts = sum(self.count.values()), len(self.count), a
        self.free = (self.e[0] * n[1] + self.e[1] * n[2] + self.e[2] * n[3:].sum()) / a if a else 1.0

    @staticmethod
    def tokens(text):
        return [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in words(text)] + [b""]

    def alone(self, w):
        a = self.before.get(w, 0)
        return max(a - [0, *self.e][min(a, 3)], 0) / max(1, self.contexts) + self.free / (self.distinct + 1)

    def p(self, u, w):
        if not self.context.get(u):
            return self.alone(w)
        c = self.pair.get((u, w), 0)
        return max(c - [0, *self.d][min(c, 3)], 0) / self.context[u] + sum(x * y for x, y in zip(self.d, self.kinds[u])) / self.context[u] * self.alone(w)

    def scores(self, text):
        own = self.tokens(text)
        base = sum(math.log10((self.count[w] + 0.1) / (self.total + 0.1 * (self.distinct + 1))) for w in own)
        return len(own), sum(w in self.count for w in own), base, sum(math.log10(self.p(u, w)) for u, w in zip(["start", *own], own))


def check(spark, train, scored):
    model = ngrams.train(frame(spark, train))
    out = ngrams.score(frame(spark, scored), model)
    brute = Brute([t for _, t in train])
    assert (model.tokens, model.distinct) == (brute.total, brute.distinct)
    got = sorted((r.doc_id or 0, r.text or "", r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in out.collect())
    want = sorted((i or 0, t or "", n, k, round(b, 6), round(s, 6)) for i, t in scored for n, k, b, s in [brute.scores(t)])
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:4] == w[:4] and abs(g[4] - w[4]) < 1e-5 * max(1, -w[4]) and abs(g[5] - w[5]) < 1e-5 * max(1, -w[5])
    return brute


def test_scores_match_the_formulas_on_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").where("doc_id < 300").collect()]
    train = [r for r in rows if r[0] % 10]
    brute = check(spark, train, rows)
    held = [brute.scores(t) for i, t in rows if i % 10 == 0]
    assert sum(x[3] for x in held) > sum(x[2] for x in held)
    # probabilities over all tokens and one unknown add up to one
    for u in ["start", b"the", b"of", b"never seen"]:
        assert abs(sum(brute.p(u, w) for w in brute.count) + brute.p(u, b"?unknown?") - 1) < 1e-9


def test_edge_rows_large_counts_and_repeated_rows(spark):
    train = [(1, "a b " * 3000), (2, None), (3, ""), (4, "A b\tC \n"), (4, "A b\tC \n"), (None, "d e f"), (5, "é x")]
    check(spark, train, train + [(7, "unseen words only"), (8, "a " * 70_000), (None, None)])


def test_a_model_of_nothing(spark):
    check(spark, [], [(1, "x y"), (2, None)])
    assert ngrams.score(frame(spark, []), ngrams.train(frame(spark, [(1, "a")]))).count() == 0


def test_files_of_another_store_are_mapped_from_a_nameless_copy(tmp_path):
    store = ngrams.Store(f"file://{tmp_path}/m")
    store.write("x", np.arange(5, dtype=np.uint64), np.array([1, 2], np.uint8))
    far = ngrams.Store(f"file://{tmp_path}/m")
    far.local = lambda: None
    assert [a.tolist() for a in far.map("x")] == [a.tolist() for a in store.map("x")] == [[0, 1, 2, 3, 4], [1, 2]]


class BruteOrder(Brute):
    """Any order: every level's counts as a counter, the lower ones from distinct n-grams."""

    def __init__(self, texts, order):
        super().__init__(texts)
        self.order, top = order, collections.Counter()
        for t in texts:
            own = ["start"] * (order - 1) + self.tokens(t)
            top.update(tuple(own[i : i + order]) for i in range(len(own) - order + 1))
        self.levels = {order: top}
        for k in range(order - 1, 0, -1):
            self.levels[k] = collections.Counter(g[1:] for g in self.levels[k + 1])
        self.before = collections.Counter({g[0]: n for g, n in self.levels[1].items()})
        many = {k: np.bincount(np.minimum(list(c.values()) or [0], 5), minlength=6) for k, c in self.levels.items()}
        self.less = {k: [0, *ngrams.discounts(n)] for k, n in many.items()}
        self.e, n = self.less[1][1:], many[1]
        self.contexts = sum(self.before.values())
        self.free = (self.e[0] * n[1] + self.e[1] * n[2] + self.e[2] * n[3:].sum()) / self.contexts if self.contexts else 1.0
        self.after = {k: collections.defaultdict(list) for k in range(2, order + 1)}
        for k in self.after:
            for g, c in self.levels[k].items():
                self.after[k][g[:-1]].append(c)

    def p(self, u, w):
        if not u:
            return self.alone(w)
        k = len(u) + 1
        found, lower = self.after[k].get(u), self.p(u[1:], w)
        if not found:
            return lower
        less, c = self.less[k], self.levels[k].get((*u, w), 0)
        return max(c - less[min(c, 3)], 0) / sum(found) + sum(less[min(x, 3)] for x in found) / sum(found) * lower

    def scores(self, text):
        own = self.tokens(text)
        base = sum(math.log10((self.count[w] + 0.1) / (self.total + 0.1 * (self.distinct + 1))) for w in own)
        padded = ["start"] * (self.order - 1) + own
        chances = [self.p(tuple(padded[i : i + self.order - 1]), w) for i, w in enumerate(own)]
        return len(own), sum(w in self.count for w in own), base, sum(map(math.log10, chances))


def test_higher_orders_match_the_formulas(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").where("doc_id < 60").collect()]
    train = [r for r in rows if r[0] % 10] + [(900, "a b " * 3000), (901, None), (902, ""), (903, "A b\tC \n"), (903, "A b\tC \n"), (None, "d")]
    scored = [*rows, (901, None), (904, "never a b d never seen"), (905, "a b a c")]
    for order in (3, 4):
        model, brute = ngrams.train(frame(spark, train), order=order), BruteOrder([t for _, t in train], order)
        assert (model.tokens, model.distinct) == (brute.total, brute.distinct)
        got = {(r.doc_id, r.text): r for r in ngrams.score(frame(spark, scored), model).collect()}
        for i, t in scored:
            n, known, base, score = brute.scores(t)
            r = got[i, t]
            assert (r.n_tokens, r.n_known) == (n, known) and abs(r.base_score - base) < 1e-5 * max(1, -base) and abs(r.score - score) < 1e-5 * max(1, -score)
        for u in (("start",) * (order - 1), (b"a", b"b", b"a")[: order - 1], (b"never",) * (order - 2) + (b"a",)):
            assert abs(sum(brute.p(u, w) for w in brute.count) + brute.p(u, b"?unknown?") - 1) < 1e-9


def test_a_word_two_back_tells(spark):
    train = [(i, "one b c" if i % 2 else "two b d") for i in range(40)]
    scored = frame(spark, [(1, "one b c"), (2, "one b d")])
    score = lambda order: {r.doc_id: r.score for r in ngrams.score(scored, ngrams.train(frame(spark, train), order=order)).collect()}
    pair, triple = score(2), score(3)
    assert abs(pair[1] - pair[2]) < 1e-9 and triple[1] > triple[2] + 1


def test_the_sampled_words_change_no_score(spark, monkeypatch):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").where("doc_id < 40").collect()]
    brute = BruteOrder([t for _, t in rows], 3)
    for codes, hot in ((0, 0), (3, 3), (5000, 5000)):  # none, some, all words
        def chosen(df, text, size, parts, codes=codes, hot=hot):
            words = np.unique(np.concatenate([ngrams.grams(df.select(text).toArrow().column(0).combine_chunks(), 1)[0][0]]))
            return words[::-1][:codes], np.unique(np.append(words[:hot], ngrams.START))

        monkeypatch.setattr(ngrams, "sampled_words", chosen)
        model = ngrams.train(frame(spark, rows), order=3)
        for r in ngrams.score(frame(spark, rows), model).collect():
            assert abs(r.score - brute.scores(r.text)[3]) < 1e-5 * max(1, -r.score)


def test_tables_give_back_every_value():
    rng = np.random.default_rng(3)
    for n in (0, 1, 7, 8, 5000):
        keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        columns = [rng.choice([1, 1, 1, 2, 254, 255, 256, 1 << 40], len(keys)), np.ones(len(keys), np.int64)]
        arrays = ngrams.table(keys, columns, (1, 1))
        asked = np.concatenate([keys, rng.integers(0, 1 << 63, 100, dtype=np.uint64)])
        hit, found = ngrams.look_up(arrays, asked, (1, 1))
        assert set(range(len(keys))) <= set(hit.tolist()) and np.isin(asked[hit] >> np.uint64(20), keys >> np.uint64(20)).all()
        assert (found[:, : len(keys)] == np.array(columns)).all()


def test_distinct_is_unique_in_any_order():
    rng = np.random.default_rng(5)
    for n in (0, 1, 7, 5000):
        keys = rng.integers(0, 900, n).astype(np.uint64) << np.uint64(50)
        at, place, count = ngrams.distinct(keys)
        want, again, n_each = np.unique(keys, return_inverse=True, return_counts=True)
        assert (keys[at] == want).all() and (place == again).all() and (count == n_each).all()


def test_codes_are_sorted_once_for_all_parts_of_a_task(monkeypatch):
    texts = pa.RecordBatch.from_arrays([pa.array([f"w{i} w{i % 7} x" for i in range(500)])], ["text"])
    codes = np.arange(10, 5000, dtype=np.uint64)
    seen, sort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda x, *a, **k: seen.append(x is codes) or sort(x, *a, **k))
    out = list(ngrams._count([texts], 32, 3, codes, np.array([1], np.uint64)))
    assert sum(len(b) for b in out) > 16 and sum(seen) == 1
