"""Spelling variants against all pairs of words."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from routekpi.llm import queries, spelling
from tests.llm.helpers import awkward_texts, frame


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(rows, altered=True):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if altered and h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def grouped(n):
    near = {w: [] for w in n}
    for a, b in itertools.combinations(n, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n)


def got(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def vocabulary(seed, words=500, letters="abcé"):
    rng = random.Random(seed)
    made = {"".join(rng.choice(letters) for _ in range(rng.randrange(6, 10))) for _ in range(words)}
    made |= {w[:i] + rng.choice(letters) + w[i + rng.randrange(2) :] for w in list(made)[:100] for i in (0, 3, len(w) - 1, len(w))}
    made |= {"prefix" * 20 + "".join(rng.choice("xyz") for _ in range(5)) for _ in range(60)}  # far longer words
    return {w: 5 * 6 ** rng.randrange(6) + rng.randrange(3) for w in made if len(w) >= 6}


@pytest.mark.parametrize("group_words", [4096, 20, 1])
def test_groups_equal_all_pairs(spark, group_words, monkeypatch):
    if group_words == 20:
        monkeypatch.setattr(spelling, "BATCH_WORDS", 64)
    n = vocabulary(3)
    df = spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)
    want = grouped(n)
    assert sum(w[4] for w in want) > 400 and len({w[2] for w in want if w[1] and w[1] != w[2]}) > 3
    assert got(spelling.group_variants(df, group_words=group_words)) == want


def test_scan_skips_and_reuses_rows():
    words = sorted({"".join(p) for k in (3, 4) for p in itertools.product("ab", repeat=k)})
    import numpy as np

    begin, end = np.zeros(len(words), np.int64), np.full(len(words), len(words))
    a, b = spelling.scan(words, begin, end, np.array([len(w) == 3 for w in words]))
    found = sorted((words[i], words[j]) for i, j in zip(a, b))
    want = sorted((x, y) for x in words for y in words if len(x) == 3 and one_edit(x, y) and (len(y) == 4 or y > x))
    assert found == want


def typical(seed=5):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(6, 11))) for _ in range(60)]
    texts = awkward_texts()
    for k in range(120):
        words = [rng.choice(base) for _ in range(120)]
        for _ in range(6):
            i = rng.randrange(len(words))
            at = rng.randrange(len(words[i]))
            words[i] = rng.choice([words[i].upper(), words[i][:at] + "x" + words[i][at:], words[i][:at] + words[i][at + 1 :], "É" + words[i]])
        texts.append((1000 + k, rng.choice([" ", ", ", "1", "Ā"]).join(words)))
    return texts + [(7, "Straße× Straße÷ " * 5), (None, "Nullid nullid " * 300)] + texts[-1:] * 2


def test_words_of_documents(spark):
    rows = typical()
    assert sorted(tuple(r) for r in spelling.count_words(frame(spark, rows), alter=spelling.every_199th).collect()) == sorted(counted(rows).items())
    assert sorted(tuple(r) for r in spelling.count_words(frame(spark, rows)).collect()) == sorted(counted(rows, False).items())
    assert counted(rows) != counted(rows, False)


def test_query_equals_brute_force(spark, scratch):
    rows = typical()
    frame(spark, rows).write.parquet(f"{scratch}/documents.parquet")
    want = grouped(counted(rows))
    assert sum(w[1] is not None for w in want) > 10
    assert got(queries.QUERIES["op12_spelling"](spark, scratch)) == want


def test_empty_null_and_repeated_rows(spark):
    df = spark.createDataFrame([("abcdef", 5), ("abcdef", 7), (None, 9), ("abcdeg", None), ("abcdex", 60)], "word string, n long")
    assert got(spelling.group_variants(df)) == [("abcdef", "abcdex", "abcdex", 12, 1, 60), ("abcdex", None, "abcdex", 60, 1, None)]
    assert got(spelling.group_variants(df.limit(0))) == []
    assert got(spelling.spelling_variants(frame(spark, [(1, None), (2, ""), (3, "short words")]))) == []
