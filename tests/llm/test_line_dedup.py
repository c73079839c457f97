"""Blocks of entries, word hashes and proposals of the line join."""

import numpy as np
import pyarrow as pa
import pytest

from routekpi.llm import line_dedup
from routekpi.llm import words as W


def _met(sets, ids):
    """What one key's sets of equal length propose."""
    size, n = len(sets), len(sets[0])
    maps = line_dedup.parity_maps(np.concatenate(sets).astype(np.uint64), np.arange(size + 1) * n).view(np.int64)
    data = {"at": np.full(size, (1 << line_dedup.LENGTH_BITS) | n), "f": np.arange(size), "meta": np.full(size, n << 32), "id": ids, "number": np.zeros(size, np.int32)}
    table = pa.table(data | {f"m{k}": maps[:, k] for k in range(line_dedup.MAPS)})
    return [r for b in line_dedup._meet(80)(iter(table.to_batches())) for r in b.to_pylist()]


def test_few_partners_are_all_proposed():
    """Five candidates need no second pass: each is proposed at once, and none is left over."""
    sets = [np.concatenate([np.arange(19), [100 + i]]) for i in range(6)]
    rows = _met(sets, np.arange(6))
    assert {(r["a"], r["b"]) for r in rows} == {(a, b) for a in range(6) for b in range(a)}
    assert not any(r["more"] for r in rows)


def test_many_partners_are_said_to_be_more():
    size = line_dedup.ENOUGH + 5
    rows = _met([np.concatenate([np.arange(19), [100 + i]]) for i in range(size)], np.arange(size))
    assert {r["a"] for r in rows if r["more"]} == set(range(line_dedup.ENOUGH, size))
    assert {(r["a"], r["b"]) for r in rows} >= {(a, b) for a in range(line_dedup.ENOUGH) for b in range(a)}


@pytest.mark.parametrize("rows_at_once", [1, 3, 1000])
def test_blocks_give_every_entry_back(monkeypatch, rows_at_once):
    """From several tasks, sorted by key and length; keys without bound have blocks of their own."""
    monkeypatch.setattr(line_dedup, "MET", 50)
    rng = np.random.default_rng(rows_at_once)
    tables, want = [], []
    for _ in range(3):
        rows = np.zeros(400, line_dedup.ENTRY)
        key = rng.integers(0, 40, 400).astype(np.uint64)
        rows["at"] = (key << np.uint64(line_dedup.LENGTH_BITS)) | rng.integers(1, 9, 400).astype(np.uint64)
        for c in ("f", "meta", "id"):
            rows[c] = rng.integers(-(1 << 62), 1 << 62, 400)
        rows["number"] = rng.integers(0, 1 << 31, 400)
        rows["maps"] = rng.integers(-(1 << 62), 1 << 62, (400, line_dedup.MAPS))
        tables.append(pa.Table.from_batches([line_dedup._blocks(rows, key % np.uint64(7) == 0, 8)]))
        want += [tuple(r[c] for c in line_dedup.ENTRY.names[:-1]) + tuple(r["maps"]) for r in rows]
    blocks = pa.concat_tables(tables).sort_by([("part", "ascending"), ("n", "ascending")]).combine_chunks()
    assert blocks.num_rows < 3 * 400
    batches = list(line_dedup._unpacked(iter(blocks.to_batches(rows_at_once))))
    assert all(b.num_rows <= 50 for b in batches)
    got = pa.Table.from_batches(batches)
    assert sorted(zip(*(got[c].to_pylist() for c in got.column_names))) == sorted(tuple(int(x) for x in r) for r in want)
    at = got["at"].to_numpy()
    key = at >> line_dedup.LENGTH_BITS
    turns = np.flatnonzero(np.diff(key)) + 1
    assert len(turns) + 1 == len(np.unique(key))  # a key's entries lie together
    assert all((np.diff(x) >= 0).all() for x in np.split(at, turns))


def test_word_keys_go_by_the_bytes_of_a_word():
    texts = ["ab", "ab cd\x0bab", "", "abcdefgh abcdefghi abcdefghij\n abcdefgh  ", "x" * 40 + " " + "x" * 41, "é é ab", None, "abcdefghabcdefgh", "abcdefgh"]
    b = W.texts(pa.array(texts))
    key, starts = line_dedup.word_keys(b)
    _, want, ends, _ = W.word_hashes(b)
    assert starts.tolist() == want.tolist()
    words = [b.data[i:j].tobytes() for i, j in zip(want, ends)]
    assert len({(k, w) for k, w in zip(key.tolist(), words)}) == len(set(words)) == len(set(key.tolist()))
    assert not len(line_dedup.word_keys(W.texts(pa.array([], pa.string())))[0])


def _table(at, f, meta, maps):
    data = {"at": at, "f": f, "meta": meta, "id": f, "number": np.zeros(len(f), np.int32)}
    return pa.table(data | {f"m{k}": maps[:, k] for k in range(line_dedup.MAPS)})


@pytest.mark.parametrize("positions, met", [((0, 0), True), ((2, 2), True), ((2, 3), False), ((4, 4), False)])
def test_entries_with_too_few_words_left_are_not_met(positions, met):
    """A pair is met at its first shared word: 20 words each need 18 from there on."""
    sets = [np.arange(i, i + 20).astype(np.uint64) for i in (0, 1)]
    maps = line_dedup.parity_maps(np.concatenate(sets), np.array([0, 20, 40])).view(np.int64)
    table = _table(np.full(2, (1 << line_dedup.LENGTH_BITS) | 20), np.arange(2), (20 << 32) | (np.array(positions) << 1), maps)
    got = [(r["a"], r["b"]) for b in line_dedup._meet(80)(iter(table.to_batches())) for r in b.to_pylist()]
    assert got == [(1, 0)] * met


@pytest.mark.parametrize("block, pairs, common", [(1 << 16, 1 << 20, 4096), (7, 10, 4096), (50, 100, 3)])
def test_similar_sets_are_met(monkeypatch, block, pairs, common):
    """Each similar pair is met at one of its prefix words at least, whatever is compared or held at once."""
    for name, value in (("BLOCK", block), ("PAIRS", pairs), ("COMMON", common), ("CLOSE", 4)):
        monkeypatch.setattr(line_dedup, name, value)
    rng = np.random.default_rng(block)
    bases = [rng.integers(1, 1 << 44, n) for n in (5, 9, 14, 20, 33)]
    sets = []
    for i in range(150):
        base = bases[i % 5]
        sets.append(np.unique(np.concatenate([base[rng.random(len(base)) > 0.06], rng.integers(1, 1 << 44, rng.integers(0, 3)), base[:1]])).astype(np.uint64))
    n = np.array([len(s) for s in sets])
    at = np.concatenate([[0], np.cumsum(n)])
    words = np.concatenate(sets)
    counts = np.bincount((words & np.uint64(line_dedup.COUNTERS - 1)).astype(np.int64), minlength=line_dedup.COUNTERS).astype(np.uint16)
    maps = line_dedup.parity_maps(words, at).view(np.int64)
    line, key, pos, low, _ = line_dedup.prefix_keys(*line_dedup.prefix_words(words, at, counts, 80), n, 80)
    place = (key << np.uint64(line_dedup.LENGTH_BITS)) | n[line].astype(np.uint64)
    order = np.argsort(place)
    line, pos, low = line[order], pos[order], low[order]
    table = _table(place[order].view(np.int64), line, (n[line] << 32) | (pos << 1) | low, maps[line])
    rows = [r for b in line_dedup._meet(80)(iter(table.to_batches(100))) for r in b.to_pylist()]
    met, more = {(r["a"], r["b"]) for r in rows}, {r["a"] for r in rows if r["more"]}
    like = [(a, b) for a in range(150) for b in range(a) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b])) and (sets[a].tolist() != sets[b].tolist())]
    assert len(like) > 300
    assert all(p in met or p[0] in more for p in like)


def test_lines_with_words_of_some_counters():
    rng = np.random.default_rng(5)
    texts = ["\n".join(" ".join(f"w{x}" for x in rng.integers(0, 300, rng.integers(0, 6))) for _ in range(20)) for _ in range(10)]
    b = W.texts(pa.array(texts))
    every = line_dedup.line_sets(b)
    counters = np.zeros(line_dedup.COUNTERS, bool)
    counters[(every["set"][::40] & np.uint64(line_dedup.COUNTERS - 1)).astype(np.int64)] = True
    rows = lambda x: [(d, k, x["set"][i:j].tolist()) for d, k, i, j in zip(x["doc"].tolist(), x["number"].tolist(), x["at"], x["at"][1:])]
    want = [r for r in rows(every) if any(counters[w & (line_dedup.COUNTERS - 1)] for w in r[2])]
    assert 0 < len(want) < len(rows(every))
    assert rows(line_dedup.line_sets(b, counters)) == want


def test_wanted_entries_come_from_saved_sets(spark):
    """The second pass takes keys and counters from the open classes' sets, without their texts."""
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 1 << 44, n)).astype(np.uint64) for n in (1, 7, 30, 31)]
    words, n = np.concatenate(sets), np.array([len(s) for s in sets])
    at = np.concatenate([[0], np.cumsum(n)])
    counts = np.zeros(line_dedup.COUNTERS, np.uint16)
    counts[(words & np.uint64(line_dedup.COUNTERS - 1)).astype(np.int64)] = rng.choice([1, 2, 50, 6000], len(words), p=[0.1, 0.4, 0.2, 0.3])
    ranks, begin = line_dedup.prefix_words(words, at, counts, 80)
    keys = line_dedup.prefix_keys(ranks, begin, n, 80)[1]
    frame = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(sets)], "f long, set binary")
    filt, bits = line_dedup._wanted(frame, spark.sparkContext.broadcast(counts), 80).value
    assert line_dedup.bloom.holds(filt, keys).all()
    prefix = {w for s, i, j in zip(sets, begin, begin[1:]) for w in s.tolist() if line_dedup.word_ranks(np.array([w], np.uint64), counts)[0] in ranks[i:j]}
    got = np.flatnonzero(np.unpackbits(bits, bitorder="little"))
    assert got.tolist() == sorted({w & (line_dedup.COUNTERS - 1) for w in prefix}) and len(got) > 5


def test_full_sets_are_compared():
    rng = np.random.default_rng(9)
    sets = [np.unique(rng.integers(0, 6, rng.integers(1, 14)) * ((1 << 41) - 7)).astype(np.uint64) for _ in range(10000)]
    a, b = sets[::2], sets[1::2]
    binary = lambda x: pa.array([s.tobytes() for s in x], pa.binary())
    batch = pa.RecordBatch.from_pydict({"a": np.arange(5000), "b": -np.arange(5000), "set_a": binary(a), "set_b": binary(b)})
    got = [r["a"] for x in line_dedup._similar(80)(iter([batch.slice(0, 0), batch.slice(10)])) for r in x.to_pylist()]
    want = [i for i in range(10, 5000) if 100 * len(np.intersect1d(a[i], b[i])) >= 80 * len(np.union1d(a[i], b[i]))]
    assert got == want and 50 < len(got) < 4900
