"""Periodic runs against all periods of all stretches."""

import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from routekpi.llm import periodic, queries
from routekpi.llm import words as W
from tests.llm.helpers import awkward_texts, frame, prose, sha, words


def all_runs(w, least=24, times=3):
    out = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least, times * q) and (i, length) not in out:  # a smaller period came first
                if not any(i0 <= i and i + length <= i0 + n0 and q % q0 == 0 for (i0, n0), q0 in out.items()):
                    out[i, length] = q
            i = max(j, i + 1)
            while i > 0 and i + q < len(w) and w[i - 1] == w[i - 1 + q]:
                i += 1
    return sorted((i, n, q) for (i, n), q in out.items())


def planted(i, text):
    w = words(text)
    if i is None or not w:
        return w
    h = zlib.crc32(str(i).encode())
    g, n = h // 10, len(w)
    if h % 10:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]


def digests(w):
    runs = sorted(all_runs(w), key=lambda r: (r[0], r[2]))
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    milli = 1000 * best[1] // best[2] if runs else None
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
    return (len(runs), *best, milli, sha(lines), sha(b" ".join(x for k, x in enumerate(w) if k not in gone)))


def test_agreements_of_suffixes():
    rng = random.Random(1)
    for _ in range(30):
        text = [rng.randrange(3) for _ in range(rng.randrange(2, 80))]
        n = len(text)
        tree = periodic.SuffixTree(text, 3)
        assert tree.leaves.tolist() == sorted(range(n + 1), key=lambda i: [*text[i:], 3])
        pairs = [(i, j) for i in range(n) for j in range(n) if i != j]
        got = tree.agree(np.array([i for i, _ in pairs]), np.array([j for _, j in pairs])).tolist()
        want = [next((k for k in range(n) if max(i, j) + k >= n or text[i + k] != text[j + k]), n) for i, j in pairs]
        assert got == want


def test_range_least():
    values = np.array([random.Random(2).randrange(100) for _ in range(300)])
    a, b = np.triu_indices(300)
    assert periodic.RangeLeast(values)(a, b).tolist() == [values[i : j + 1].min() for i, j in zip(a, b)]


@pytest.mark.parametrize("least,times", [(24, 3), (4, 2), (6, 3), (2, 2)])
def test_runs_of_small_alphabets(least, times):
    rng = random.Random(3)
    total = 0
    for k in range(150):
        text = [rng.randrange(1 + k % 3) for _ in range(rng.randrange(0, 60))]
        if k % 4 == 0:
            text = (text[:7] * 12)[: rng.randrange(1, 80)] + text
        got = [tuple(r) for r in periodic.runs_of(text, least, times).tolist()]
        want = sorted(all_runs(text, least, times), key=lambda r: (r[0], r[2]))
        assert got == want, text
        total += len(got)
    assert total > 50


def test_stretches_hold_every_run():
    assert periodic.gram_words(24, 3) == 9 and periodic.gram_words(24, 2) == 1
    import pyarrow as pa

    rng = random.Random(4)
    texts = []
    for _ in range(60):
        w = prose(rng, 60, 8).split()
        q = rng.randrange(1, 12)
        w += [w[k % q] for k in range(max(24, 3 * q) + rng.randrange(3))] + prose(rng, 20, 8).split()
        texts.append(" ".join(w))
    hashes, _, _, first = W.word_hashes(W.texts(pa.array(texts)))
    held = periodic.stretches(hashes, first, 9, 24)
    for d, text in enumerate(texts):
        for s, n, _ in all_runs(text.split()):
            assert any(x == d and b - first[d] <= s and s + n <= e - first[d] for x, b, e in held)


def rows():
    rng = random.Random(5)
    out = awkward_texts()
    for k in range(150):
        w = prose(rng, rng.randrange(1, 200)).split()
        for _ in range(rng.randrange(3)):
            q = rng.randrange(1, 20)
            at = rng.randrange(len(w))
            part = [f"r{rng.randrange(3)}" for _ in range(q)]
            w[at:at] = [part[x % q] for x in range(rng.randrange(20, 90))]
        out.append((1000 + k, rng.choice([" ", "\n", " \t "]).join(w)))
    out += [(5000, "a b " * 400 + "a"), (5001, "x " * 23), (5002, "x " * 24), (5003, " ".join(f"u{k % 8}" for k in range(24))), (5004, " ".join(f"u{k % 9}" for k in range(26)))]
    return out + [(None, "n " * 40), (None, None), out[-1]]


def test_query_equals_brute_force(spark, scratch):
    held = rows()
    frame(spark, held).write.parquet(f"{scratch}/documents.parquet")
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    df = queries.QUERIES["op13_periodic"](spark, scratch)
    assert df.columns == columns
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    want = sorted(((i, *digests(planted(i, t))) for i, t in held), key=repr)
    assert got == want and sum(w[1] for w in want) > 100


def test_find_runs_keeps_texts_and_spans(spark, monkeypatch):
    monkeypatch.setattr(periodic, "TREE_WORDS", 64)
    held = rows()
    got = sorted(((r.doc_id, r.n_words, tuple(tuple(x) for x in r.runs), r.collapsed) for r in periodic.find_runs(frame(spark, held)).collect()), key=repr)
    want = []
    for i, t in held:
        w = words(t)
        runs = sorted(all_runs(w), key=lambda r: (r[0], r[2]))
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        want.append((i, len(w), tuple(runs), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    assert got == sorted(want, key=repr)
    assert periodic.find_runs(frame(spark, held).limit(0)).count() == 0
