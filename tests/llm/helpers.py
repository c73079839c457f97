"""Small documents with every awkward case, and plain Python versions of the operators."""

import hashlib
import random
import re

import pytest

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Other columns, with names that operators use inside.
OTHERS = ("id", "key", "n", "sha", "row", "gone", "expected_grade", "p_1", "k_id", "size", "start", "words", "rep", "root", "f", "number", "runs")
SCHEMA = "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in OTHERS)


def words(text, lower=False):
    data = (text or "").encode()
    if lower:
        data = bytes(b + 32 if 65 <= b <= 90 else b for b in data)
    return WORD.findall(data)


def prose(rng, n, vocabulary=3000):
    out = []
    for i in range(n):
        out.append(f"w{rng.randrange(vocabulary)}" + ("é" if i % 7 == 0 else ""))
        out.append("\n" if i % 23 == 22 else " ")
    return "".join(out).strip()


def awkward_texts(seed=1):
    """(doc_id, text) with nulls, blanks, copies, near copies, shared passages and a long text."""
    rng = random.Random(seed)
    texts = [None, None, "", "   \t\n ", "one", "one", "One", "two words", "two  words\n", "a b c", "日本語 テキスト", " x\u0085y \x1c z"]
    base = prose(rng, 200)
    texts += [base, base, base.replace(" ", "  "), base.upper()]
    for share in (0.005, 0.02, 0.05, 0.3):
        for _ in range(4):
            texts.append(" ".join(w if rng.random() > share else f"x{rng.randrange(10**6)}" for w in base.split()))
    passage = " ".join(f"p{i}" for i in range(60))
    for i in range(6):
        texts.append(f"{prose(rng, 30)} {passage[: 400 - 40 * (i % 2)]} {prose(rng, 40 + i)}")
    texts += [prose(rng, 6000), "same " * 300, "same " * 120, prose(rng, 49), prose(rng, 50), prose(rng, 51)]
    texts += [prose(rng, rng.randrange(1, 120)) for _ in range(30)]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts))


def frame(spark, rows, parts=3):
    """Documents with columns whose names operators use inside, too."""
    full = [(i, t, "ab"[(i or 0) % 2], None if (i or 0) % 5 == 4 else f"s{(i or 0) % 4}", *OTHERS) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


class Union:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text, k):
    w = words(text, lower=True)
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def near(rows, k, percent=80):
    """{id: (set size, component)} by all pairs."""
    sets = {i: shingles(t, k) for i, t in rows}
    u = Union(sets)
    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if y < x and sets[x] and sets[y]:
                both = len(sets[x] & sets[y])
                if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                    u.join(x, y)
    return {i: (len(sets[i]), u.find(i)) for i in ids}


def repeats(rows, window):
    """{id: (words, removed, sha of the kept)} by a dictionary of windows."""
    first, out = {}, {}
    for i, t in sorted(rows):
        w = words(t)
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            k = tuple(w[j : j + window])
            if first.setdefault(k, i) < i:
                gone[j : j + window] = [True] * window
        out[i] = (len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def lines(rows, percent=80):
    """{id: (lines, removed, sha of the kept)} by all pairs."""
    before, out = [], {}
    for i, t in sorted(rows):
        kept, removed = [], 0
        split = t.encode().split(b"\n") if t else []
        for line in split:
            s = frozenset(WORD.findall(line))
            if s and any(100 * len(s & o) >= percent * len(s | o) for o in before):
                removed += 1
            else:
                kept.append(line)
            if s:
                before.append(s)
        out[i] = (len(split), removed, sha(b"\n".join(kept)))
    return out


approx = pytest.approx
