"""Plain Python forms of the operators, for small inputs."""

import math
import re

import numpy as np
import xxhash

EXTRA = "key long, row string, text2 string, ids string, matches string, language string, shard string, bucket int, host string, place int, kind int"


def frame(spark, rows, columns="doc_id long, text string"):
    """Rows of (doc_id, text) with more columns whose names clash with those that operators use or return."""
    filler = (1, "r", "t", "i", "m", "l", "s", 2, "h", 3, 4)
    return spark.createDataFrame([(*r, *filler) for r in rows], f"{columns}, {EXTRA}")


def words(text):
    return (text or "").encode().split()


def simhash(text, shingle=4):
    w = words((text or ""))
    w = [bytes(b + 32 if 65 <= b <= 90 else b for b in x) for x in w]
    own = [b" ".join(w[k : k + shingle]) for k in range(len(w) - shingle + 1)] if len(w) >= shingle else [b" ".join(w)] * bool(w)
    total = [0] * 64
    for s in own:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            total[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * total[b] > len(own))


def groups(fps, distance=4):
    """Index of the least linked entry, for each entry."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def without_repeats(rows, size):
    """(number of words, removed, kept text) of each (key, text)."""
    least = {}
    for key, text in rows:
        w = words(text)
        for k in range(len(w) - size + 1):
            if key is not None:
                s = tuple(w[k : k + size])
                least[s] = min(least.get(s, key), key)
    out = []
    for key, text in rows:
        w = words(text)
        gone = set()
        for k in range(len(w) - size + 1):
            if key is not None and least[tuple(w[k : k + size])] < key:
                gone.update(range(k, k + size))
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def tokens(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())


def contaminated(text, item, window=13, similarity=0.8):
    t, i = tokens(text), tokens(item)
    if not i or len(i) < 5:
        return bool(i) and t == i
    size = min(window, len(i))
    need = math.ceil(similarity * size - 1e-9)
    if len(t) < size:
        return False
    number = {w: n for n, w in enumerate(dict.fromkeys(t + i))}
    same = (np.array([number[w] for w in i])[:, None] == np.array([number[w] for w in t])[None, :]).astype(np.int16)
    n, m = len(i) - size + 1, len(t) - size + 1
    return bool((sum(same[k : k + n, k : k + m] for k in range(size)) >= need).any())
