"""Exact, near, substring and line dedup against plain Python, on every awkward case."""

import random
from types import SimpleNamespace as Some

import numpy as np
import pyarrow as pa
import pytest

from routekpi.llm import exact_dedup, line_dedup, near_dedup, substrings
from routekpi.llm.bloom import build, may_hold
from routekpi.llm.components import components
from tests.llm.helpers import awkward_texts, frame, lines, near, repeats, rows_of, sha, words
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def texts():
    return awkward_texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    return frame(spark, texts).cache()


def normal(text):
    out, space = [], False
    for ch in text or "":
        if ch in " \t\n\x0b\x0c\r":
            if not space:
                out.append(" ")
            space = True
        else:
            out.append(ch)
            space = False
    return "".join(out).encode()


def test_exact_marks(spark, texts, docs):
    groups = {}
    for i, t in texts:
        groups.setdefault(normal(t), []).append(i)
    want = sorted(((i, min(groups[normal(t)]), len(groups[normal(t)]), i == min(groups[normal(t)]), sha(normal(t))) for i, t in texts), key=repr)
    got = exact_dedup.mark_exact(docs)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert rows_of(got, *got.columns) == want
    # a filter far too small only costs work
    assert rows_of(exact_dedup.mark_exact(docs, max_filter_bytes=1), *got.columns) == want


def test_exact_drop_keeps_columns_and_repeated_rows_once(spark, texts, docs):
    twice = docs.unionByName(docs)
    got = exact_dedup.drop_exact(twice)
    assert got.columns == docs.columns
    firsts = {}
    for i, t in sorted(texts):
        firsts.setdefault(normal(t), i)
    assert rows_of(got, "doc_id") == sorted(((i,) for i in firsts.values()), key=repr)


def test_exact_null_ids(spark):
    df = frame(spark, [(None, "x"), (3, "x"), (None, "alone")])
    got = {(r.doc_id, r.group_size): (r.keep_id, r.kept) for r in exact_dedup.mark_exact(df).collect()}
    assert got == {(None, 2): (3, False), (3, 2): (3, True), (None, 1): (None, True)}


@pytest.mark.parametrize("k", [4, 5])
def test_near(spark, texts, docs, k):
    want = sorted(((i, n, c, i == c) for i, (n, c) in near(texts, k).items()), key=repr)
    got = near_dedup.near_duplicates(docs, shingle_words=k, part=4 if k == 4 else 512)  # tiny parts: hubs play in rounds
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == want


def test_near_group_of_copies_changed_apart(spark):
    """A large group whose members are similar to its origin but not to each other, and strays."""
    rng = random.Random(4)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(160):
        copy = list(base)
        for at in rng.sample(range(150), rng.choice((1, 2, 3, 5, 9))):
            copy[at] = f"n{rng.randrange(10**7)}"
        rows.append((1000 - i, " ".join(copy)))
    want = sorted(((i, n, c, i == c) for i, (n, c) in near(rows, 5).items()), key=repr)
    got = near_dedup.near_duplicates(frame(spark, rows), part=32)
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == want


def test_near_drop(spark, texts, docs):
    kept = {i for i, (_, c) in near(texts, 5).items() if i == c}
    got = near_dedup.drop_near(docs)
    assert got.columns == docs.columns
    assert {r.doc_id for r in got.collect()} == kept


def test_near_drop_goes_by_row_not_by_id(spark):
    base, other = " ".join(f"w{i}" for i in range(200)), " ".join(f"v{i}" for i in range(200))
    clean = [" ".join(f"c{i}x{j}" for j in range(60)) for i in range(3)]
    df = spark.createDataFrame([(1, base), (None, base + " more"), (None, clean[0]), (None, clean[1]), (None, None),
                                (2, other), (7, other + " more"), (7, clean[2])], "doc_id long, text string").repartition(3)
    got = rows_of(near_dedup.drop_near(df), "doc_id", "text")
    assert got == sorted([(1, base), (None, clean[0]), (None, clean[1]), (None, None), (2, other), (7, clean[2])], key=repr)


def test_signature_index_guarantee():
    """Any two signatures within the distance share a key; farther ones aren't compared."""
    import pyarrow as pa

    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 16, (200, near_dedup.SYMBOLS)).astype(np.uint16)
    b = a.copy()
    for row in b:
        at = rng.permutation(near_dedup.SYMBOLS)[: near_dedup.MAX_DISTANCE]
        row[at] ^= 1
    keys = []
    for m in (a, b):
        batch = pa.RecordBatch.from_pydict({"rep": pa.array(range(200), pa.int64()), "sig": pa.array([r.tobytes() for r in m], pa.binary())})
        out = next(near_dedup._keys(iter([batch])))
        keys.append(set(zip(np.asarray(out["key"]).tolist(), np.asarray(out["rep"]).tolist())))
    assert {r for _, r in keys[0] & keys[1]} == set(range(200))


def test_near_links_whose_signatures_are_far_apart(spark):
    """Similarity 0.8 or more and a common key, but more than MAX_DISTANCE differing symbols."""
    import pyarrow as pa

    from routekpi.llm import words as W

    pairs = [[" ".join(f"w{i}x{j}" for j in range(10 if whole else 8)) for whole in (0, 1)] for i in range(60_000)]
    parts = [near_dedup.shingle_sets(W.texts(pa.array([t for p in pairs[i : i + 10_000] for t in p])), 1) for i in range(0, len(pairs), 10_000)]
    sig = np.concatenate([near_dedup.signatures(*part) for part in parts])
    differ = sig[::2] != sig[1::2]
    meets = (differ.reshape(len(pairs), near_dedup.CHUNKS, near_dedup.WIDTH).sum(axis=2) <= 1).any(axis=1)
    far = np.flatnonzero(meets & (differ.sum(axis=1) > near_dedup.MAX_DISTANCE))
    assert len(far)
    df = frame(spark, [(2 * i + j, pairs[k][j]) for i, k in enumerate(far.tolist()) for j in (0, 1)])
    got = rows_of(near_dedup.near_duplicates(df, shingle_words=1), "doc_id", "component_id")
    assert got == sorted([(x, x - x % 2) for x in range(2 * len(far))], key=repr)


@pytest.mark.parametrize("window", [50, 7])
def test_substrings(spark, texts, docs, window):
    want = sorted(((i, *x) for i, x in repeats(texts, window).items()), key=repr)
    got = substrings.remove_repeats(docs, window=window, with_text=window == 7)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_sha256") == want
    if window == 7:
        assert all(sha(r.kept_text.encode()) == r.kept_sha256 for r in got.collect())


def test_substrings_null_and_repeated_ids(spark):
    text = " ".join(f"t{i}" for i in range(80))
    got = rows_of(substrings.remove_repeats(frame(spark, [(5, text), (5, text), (5, "x " + text), (None, text), (9, "y " + text)])), "doc_id", "n_words", "n_removed")
    assert got == sorted([(5, 80, 0), (5, 80, 0), (5, 81, 0), (None, 80, 0), (9, 81, 80)], key=repr)


def test_automaton_matches():
    rng = random.Random(2)
    for _ in range(30):
        refs = [[rng.randrange(3) for _ in range(rng.randrange(1, 25))] for _ in range(4)]
        automaton = substrings.Automaton()
        for r in refs:
            automaton.add(r)
        text = [rng.randrange(3) for _ in range(40)]
        covered = set()
        for i in range(len(text) - 4):
            if any(text[i : i + 5] == r[j : j + 5] for r in refs for j in range(len(r) - 4)):
                covered.update(range(i, i + 5))
        assert {x for a, b in automaton.matched(text, 5) for x in range(a, b)} == covered


def test_lines(spark, texts, docs):
    want = sorted(((i, *x) for i, x in lines(texts).items()), key=repr)
    got = line_dedup.dedup_lines(docs, with_text=True)
    assert rows_of(got, "doc_id", "n_lines", "n_removed", "kept_sha256") == want
    assert all(sha(r.kept_text.encode()) == r.kept_sha256 for r in got.collect())


@pytest.mark.parametrize("setting, value", [("COMMON", 4096), ("COMMON", 2), ("LENGTH_BITS", 4)])
def test_lines_similar_not_equal(spark, monkeypatch, setting, value):
    """Also with words that meet by length class, and with lines longer than fit beside a key."""
    monkeypatch.setattr(line_dedup, setting, value)
    rng = random.Random(8)
    base = [f"l{i}" for i in range(20)]
    rows = []
    for i in range(40):
        out = []
        for _ in range(3):
            line = list(base)
            for at in rng.sample(range(20), rng.choice((0, 1, 2, 3, 4))):
                line[at] = f"m{rng.randrange(60)}"
            rng.shuffle(line)
            out.append(" ".join(line))
        rows.append((i, "\n".join(out) + "\n\n"))
    want = sorted(((i, *x) for i, x in lines(rows).items()), key=repr)
    assert rows_of(line_dedup.dedup_lines(frame(spark, rows)), "doc_id", "n_lines", "n_removed", "kept_sha256") == want


def test_met_entries_of_one_template():
    """Many alike lines of one key, in several batches: every one but the first has an earlier partner."""
    size = 20000
    rng = np.random.default_rng(3)
    sets = np.column_stack([np.tile(np.arange(9) + 1, (size, 1)), np.arange(size) + 100]).astype(np.uint64).ravel()
    maps = line_dedup.parity_maps(sets, np.arange(size + 1) * 10).view(np.int64)
    ids, f = rng.permutation(size), np.arange(size)
    data = {"at": np.full(size, (7 << line_dedup.LENGTH_BITS) | 10), "f": f, "meta": np.full(size, 10 << 32), "id": ids, "number": np.zeros(size, np.int32)}
    table = pa.table(data | {f"m{k}": maps[:, k] for k in range(line_dedup.MAPS)})
    pairs = [r for b in line_dedup._meet(80)(iter(table.to_batches(3000))) for r in zip(b["a"].to_pylist(), b["b"].to_pylist())]
    assert all(ids[b] < ids[a] for a, b in pairs)
    assert {a for a, _ in pairs} == set(f[ids > 0].tolist())
    assert len(pairs) < 20 * size


@pytest.mark.parametrize("close, batch", [(1, 7), (2, 1000)])
def test_met_entries_of_one_key(monkeypatch, close, batch):
    """Sets of one key: each later one has its pairs, or some of them and the sign that there are more."""
    rng = np.random.default_rng(close)
    sets = [np.unique(np.concatenate([np.arange(20 * (i % 3), 20 * (i % 3) + 12), rng.integers(1000, 4000, i % 4)])).astype(np.uint64) for i in range(60)]
    f, n = np.arange(60) + 500, np.array([len(s) for s in sets])
    ids = rng.permutation(60)
    at = np.concatenate([[0], np.cumsum(n)])
    maps = line_dedup.parity_maps(np.concatenate(sets), at).view(np.int64)
    order = np.argsort(n, kind="stable")
    data = {"at": (1 << line_dedup.LENGTH_BITS) | n, "f": f, "meta": n << 32, "id": ids, "number": np.zeros(60, np.int32)} | {f"m{k}": maps[:, k] for k in range(line_dedup.MAPS)}
    table = pa.table({c: np.asarray(v)[order] for c, v in data.items()})
    rows = lambda wanted=None: [r for b in line_dedup._meet(80, wanted)(iter(table.to_batches(batch))) for r in b.to_pylist()]
    monkeypatch.setattr(line_dedup, "CLOSE", 1000)
    monkeypatch.setattr(line_dedup.bloom, "holds", lambda _, x: np.ones(len(x), bool) if _ == "all" else x % 2 == 0)
    every = {(r["a"], r["b"]) for r in rows(Some(value="all"))}
    monkeypatch.setattr(line_dedup, "CLOSE", close)
    assert len(every) > 300
    assert {(r["a"], r["b"]) for r in rows(Some(value="all"))} == every
    assert {(r["a"], r["b"]) for r in rows(Some(value="even"))} == {(a, b) for a, b in every if a % 2 == 0}
    tried = rows()
    pairs = {(r["a"], r["b"]) for r in tried}
    assert pairs <= every and {a for a, _ in pairs} == {a for a, _ in every}
    more = {r["a"] for r in tried if r["more"]}
    assert all(a in more for a, b in every - pairs)



def test_empty_tables(spark):
    none = frame(spark, [])
    assert exact_dedup.mark_exact(none).count() == 0
    assert exact_dedup.drop_exact(none).count() == 0
    assert near_dedup.near_duplicates(none).count() == 0
    assert substrings.remove_repeats(none).count() == 0
    assert line_dedup.dedup_lines(none).count() == 0


def test_bloom_planes(spark):
    keys = spark.createDataFrame([(i,) for i in range(5000)] + [(i,) for i in range(0, 5000, 50)] + [(None,)], "k long")
    again = build(keys, "k", keys.count())
    flagged = {r.k for r in keys.where(may_hold(again, F.col("k"))).collect()}
    assert set(range(0, 5000, 50)) <= flagged and len(flagged) < 400
    seen = build(keys.where("k < 100"), "k", 102, plane="seen")
    assert {r.k for r in keys.where(may_hold(seen, F.col("k"))).collect()} >= set(range(100))


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in up if find(x) != x}


def test_words_match_plain_python(texts):
    import pyarrow as pa

    from routekpi.llm import words as W

    b = W.texts(pa.array([t for _, t in texts]))
    h, starts, ends, first = W.word_hashes(b)
    raw = b.data.tobytes()
    seen = {}
    for i, (_, t) in enumerate(texts):
        mine = [raw[s:e] for s, e in zip(starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]])]
        assert mine == words(t)
        for w, x in zip(mine, h[first[i] : first[i + 1]].tolist()):
            assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)
