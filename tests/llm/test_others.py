"""Packing, embeddings, mixing, classifiers and the pipeline."""

import math
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from routekpi.llm import embeddings, labelled, language, mixing, packing, quality, queries, toxicity
from routekpi.llm import words as W
from tests.llm.helpers import awkward_texts, frame, rows_of, words

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_encoder_equals_tokenizers():
    plain, own = Tokenizer.from_file(TOKENIZER), packing.Encoder(TOKENIZER)
    for text in [t for _, t in awkward_texts() if t] + ["x<|endoftext|>y", "I'll we've 12abc 😀 a   b\n\n c  ", "\x00\x1c é"]:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("capacity", [1024, 64])
def test_pack_round_trip(spark, capacity):
    texts = awkward_texts()
    plain = Tokenizer.from_file(TOKENIZER)
    got = packing.pack(frame(spark, texts), TOKENIZER, max_tokens=capacity, block_pieces=40, with_ids=True).collect()
    docs, bins = {}, {}
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length <= capacity and zlib.crc32(r.ids) == r.ids_crc32
        docs.setdefault(r.doc_id, []).append((r.piece, r.start, ids))
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, t in texts:
        want = (plain.encode(t, add_special_tokens=False).ids if t else []) + [2]
        pieces = sorted(docs[i])
        assert [p for p, _, _ in pieces] == list(range(len(pieces)))
        assert [x for _, _, ids in pieces for x in ids] == want
        assert len(pieces) == math.ceil(len(want) / capacity) and all(len(ids) == capacity for _, _, ids in pieces[1:])
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(bins) <= math.ceil(sum(r.length for r in got) / capacity) * 1.1 + 1


def test_bin_completion_is_optimal_on_small_cases():
    rng = random.Random(6)

    def fewest(items, capacity):
        best = len(items)

        def go(k, rooms):
            nonlocal best
            if len(rooms) >= best:
                return
            if k == len(items):
                best = len(rooms)
                return
            for i in range(len(rooms)):
                if rooms[i] >= items[k]:
                    go(k + 1, rooms[:i] + [rooms[i] - items[k]] + rooms[i + 1 :])
            go(k + 1, rooms + [capacity - items[k]])

        go(0, [])
        return best

    exact = 0
    for _ in range(40):
        items = sorted((rng.randrange(1, 21) for _ in range(9)), reverse=True)
        counts = np.bincount(items, minlength=21)
        bins = packing.bin_completion(counts, 20)
        assert sorted((x for b in bins for x in b), reverse=True) == items and all(sum(b) <= 20 for b in bins)
        want = fewest(items, 20)
        assert packing.lower_bound(counts, 20) <= want <= len(bins)
        exact += len(bins) == want
    assert exact >= 38


def vectors(seed=0, n=400, dim=24):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for i in range(60):
        x[200 + i] = x[i] + rng.normal(size=dim) * 0.2 * rng.random()
    x[300:330] = x[5]
    x[330:360] = x[7] + rng.normal(size=(30, dim)) * 0.05
    rows = [(int(i), [float(v) for v in row]) for i, row in enumerate(x)]
    rows += [(900, None), (901, [0.0] * dim), (902, [float("nan")] + [1.0] * (dim - 1)), (903, [None] + [1.0] * (dim - 1)), (904, []), (905, [1.0] * 3),
             (906, [float("inf")] * dim), (907, (2.5 * x[5]).tolist()), (908, (-x[5]).tolist())]
    return rows


def test_embeddings_against_all_pairs(spark):
    rows = vectors()
    good = {i: np.array(v) for i, v in rows if i < 900 or i in (907, 908)}
    ids = sorted(good)
    x = np.array([good[i] / np.sqrt((good[i] ** 2).sum()) for i in ids])
    near = x @ x.T >= 0.9
    root = {i: i for i, _ in rows}
    root.update(zip(ids, np.array(ids)[embeddings.forest(*np.nonzero(near), len(ids))].tolist()))
    links = {i: 0 for i, _ in rows} | dict(zip(ids, (near.sum(axis=1) - 1).tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as rep", "'x' as cell", "2 as weight").repartition(3)
    got = embeddings.near_vectors(df).collect()
    assert len(got) == len(rows)
    found, true = sum(r.n_links for r in got), sum(links.values())
    assert true > 1000 and 0.9 * true <= found <= true  # recall of the visited cells
    assert all(r.n_links <= links[r.vec_id] for r in got)
    assert {r.vec_id: r.component_id for r in got} == root
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_embeddings_lose_no_link_with_many_cells(spark):
    rng = np.random.default_rng(31)
    x = rng.normal(size=(3000, 4))  # links reach over more cells than a few
    unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    near = unit @ unit.T >= 0.9
    root = embeddings.forest(*np.nonzero(near), len(x))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>").repartition(3)
    got = {r.vec_id: r for r in embeddings.near_vectors(df, cell_size=8).collect()}  # 375 cells
    assert [got[i].n_links for i in range(len(x))] == (near.sum(axis=1) - 1).tolist()
    assert [got[i].component_id for i in range(len(x))] == root.tolist()


def test_embeddings_of_each_dimension_link_among_themselves(spark, monkeypatch):
    rng = np.random.default_rng(32)
    x, y = rng.normal(size=(40, 16)), rng.normal(size=(6, 5))
    x[20:] = x[:20] + rng.normal(size=(20, 16)) * 0.02
    y[3:] = 2 * y[:3]
    rows = [*x.tolist(), *y.tolist(), [1.0] * 17]  # the longest is alone
    monkeypatch.setattr(embeddings, "SAMPLE", 4)  # leaves dimensions out of the sample
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(df).collect()}
    assert got == {i: (1, i % 20) for i in range(40)} | {40 + i: (1, 40 + i % 3) for i in range(6)} | {46: (0, 46)}


def test_embeddings_of_huge_and_tiny_values_link(spark):
    near = np.array([[1.0, 0.0, 0.2, 0.0], [1.0, 0.1, 0.2, 0.0]])
    rows = [(v * scale).tolist() for scale in (1e160, 1e-170, 1.0) for v in near]
    rows += [[-1e308, 1e308, 0.0, 5.0], [5e-324, 0.0, 0.0, 0.0]]  # the last one is subnormal and links with the near ones
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>").repartition(2)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(df).collect()}
    assert got == {i: (6, 0) for i in range(6)} | {6: (0, 6), 7: (6, 0)}


def test_coded_products_leave_every_link(spark):
    rng = np.random.default_rng(33)
    for dim, noise in ((3, 0.4), (8, 0.15), (21, 0.1)):
        base = rng.normal(size=(200, dim))
        x = embeddings._unit(np.concatenate([base, base + noise * rng.normal(size=base.shape)]))
        index = embeddings.Index(x[::5], 6)
        cell = embeddings._nearest(x, index.centres, 1)[:, 0]
        for min_cosine in (-0.5, 0.0, 0.5, 0.9, 1.0):
            codes, need = index.encode(x, cell, min_cosine)
            tables = index.tables(x)
            for c in range(6):
                held = np.flatnonzero(cell == c)
                passed = embeddings.looked_up(tables, codes[held], x @ index.centres[c]) >= (need[held] - index.slack())[:, None]
                assert passed[(x @ x[held].T >= min_cosine).T].all()


@needs_data
def test_embedding_recall_on_the_given_table(spark):
    sf = "/root/testdata/sf0.1" if os.path.isdir("/root/testdata/sf0.1") else SF
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    x = np.array([r.embedding for r in rows], float)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    true = int((x @ x.T >= 0.9).sum()) - len(x)
    found = queries.QUERIES["op2_embeddings"](spark, sf).agg({"n_links": "sum"}).first()[0]
    assert 0.9 * true <= found <= true


def test_targets_are_filled_by_weight(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, None: 985}
    totals = spark.createDataFrame([(s, 1, n) for s, n in sizes.items()], "source string, n long, source_size long")
    got = {r.source: (r.weight, r.target) for r in mixing.targets(totals).collect()}
    # share again by weight until none is above three times its size
    weight = {"a": 1, "b": 2, "c": 3, None: 1}
    target, open_ = {}, dict(weight)
    left = float(sum(sizes.values()))
    while True:
        level = left / sum(open_.values())
        full = [s for s in open_ if level * weight[s] > 3 * sizes[s]]
        if not full:
            break
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            del open_[s]
    target |= {s: level * weight[s] for s in open_}
    assert {s: w for s, (w, _) in got.items()} == weight
    for s in sizes:
        assert got[s][1] == pytest.approx(target[s])


def test_mix_takes_the_targets(spark):
    texts = awkward_texts()
    df = frame(spark, texts)
    rows = mixing.mix(df, bucket_rows=5).collect()
    assert len(rows) == len(texts)
    size = {i: len(words(t)) for i, t in texts}
    by = {}
    for r in rows:
        assert r.size == size[r.doc_id] and 0 <= r.taken <= 3 * r.size
        by.setdefault(r.source, []).append(r)
    for held in by.values():
        assert sum(r.taken for r in held) == math.floor(held[0].target + 0.5)
        assert {r.source_size for r in held} == {sum(r.size for r in held)}
    assert rows_of(mixing.mix(df.repartition(7)), "doc_id", "taken", "position") == rows_of(mixing.mix(df, bucket_rows=5), "doc_id", "taken", "position")
    at = [r.position for r in rows if r.position is not None]
    assert at == sorted(at) and all(0 <= p <= 1 for p in at)
    taken = mixing.take(df).collect()
    assert set(taken[0].asDict()) == set(df.columns)
    got = {}
    for r in taken:
        got[r.doc_id] = got.get(r.doc_id, 0) + len(words(r.text))
    assert got == {r.doc_id: r.taken for r in rows if r.taken}


def test_position_inverts_the_schedule(spark):
    knots = ((0.0, 2.0), (0.25, 0.0), (0.5, 1.0), (1.0, 3.0))
    t = np.linspace(0, 1, 100_001)
    rate = np.interp(t, *zip(*knots))
    area = np.concatenate([[0], np.cumsum((rate[1:] + rate[:-1]) / 2 * np.diff(t))])
    df = spark.range(0, 200).selectExpr("id / 200D as u")
    for u, p in df.select("u", mixing.position(df.u, knots)).collect():
        assert np.interp(p, t, area / area[-1]) == pytest.approx(u, abs=1e-6)


def rated(spark):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(600):
        kind = i % 3
        body = [f"{rng.choice(('en', 'ti', 'ou'))}{rng.choice(('ra', 'lo', 'mi'))}{rng.randrange(40)}" for _ in range(rng.randrange(20, 90))]
        if kind == 0:
            body = [w.upper() + "!!" for w in body]
        elif kind == 1:
            for at in range(0, len(body), 8):
                body[at] = rng.choice(("scum", "moron", "vexuly", "vexuta"))
        docs.append((i, " ".join(body)))
        labels.append((i, int(kind > 0), int(kind == 1)))
    docs += [(700, None), (701, ""), (702, " \n "), (703, "123 456")]
    labels += [(700, 1, None), (999, None, 1), (None, 1, 1), (5, None, None)]
    return frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), docs


def test_quality_on_held_out_documents(spark):
    df, labels, docs = rated(spark)
    got = {r.doc_id: r for r in quality.classify(df, labels).collect()}
    assert len(got) == len(docs)
    test = [r for i, r in got.items() if i < 600 and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert np.mean([r.selected == (r.doc_id % 3 > 0) for r in test]) > 0.97
    mean = [np.mean([r.expected_grade for r in test if r.doc_id % 3 == k]) for k in range(3)]
    assert mean[0] < mean[1] < mean[2]
    assert all(got[i].p_good == 0 and not got[i].selected for i in (700, 701, 702))
    kept = quality.select(df, labels)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.selected}
    assert quality.classify(df, labels.limit(0)).count() == len(docs) and quality.classify(df.limit(0), labels).count() == 0


def test_ordinal_gradient_fits_thresholds():
    rng = np.random.default_rng(1)
    y = rng.integers(0, 3, 600)
    index = [np.array([10 + k]) for k in y]
    model = quality.OrdinalModel(3).fit(index, [np.ones(1)] * 600, y)
    tails = model.tails(model.weights[10:13])
    assert (np.diff(model.thresholds) >= 0).all()
    assert (1 + (tails > 0.5).sum(axis=1) - 1).tolist() == [0, 1, 2]


def test_toxicity_on_held_out_documents(spark):
    df, labels, docs = rated(spark)
    got = {r.doc_id: r for r in toxicity.score_toxicity(df, labels).collect()}
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got.values())
    test = [r for i, r in got.items() if i < 600 and r.held_out]
    assert np.mean([r.predicted == (r.doc_id % 3 == 1) for r in test]) > 0.97
    assert all(not got[i].predicted and got[i].evidence == [] for i in (700, 701, 702, 703))
    assert all(zlib.crc32(str(i).encode()) % 4 != 2 for r in got.values() for i in r.evidence)
    assert {(r.predicted, r.score) for r in toxicity.score_toxicity(df, labels.limit(0)).collect()} == {(0, toxicity.UNKNOWN_RATE)}  # nothing known
    assert toxicity.score_toxicity(df.limit(0), labels).count() == 0


def test_block_max_search_is_exact():
    rng = np.random.default_rng(5)
    dense = rng.random((700, 40)) * (rng.random((700, 40)) < 0.1)
    dense[np.arange(700), rng.integers(0, 40, 700)] += 0.1
    dense /= np.sqrt((dense**2).sum(axis=1, keepdims=True))
    example, term = np.nonzero(dense)
    index = toxicity.BlockMaxIndex(example, term, dense[example, term], np.arange(700), np.zeros(700, int), 40)
    for row in dense[::13]:
        t = np.flatnonzero(row)
        ids, cosine = index.nearest(t, row[t], 9)
        assert cosine == pytest.approx(np.sort(dense @ row)[::-1][:9])
        assert dense[index.ids[ids]] @ row == pytest.approx(cosine)


def test_toxicity_equals_brute_force(spark, monkeypatch):
    """Vectors, neighbours and votes of every text, from dictionaries; a copy of an example is its nearest, at cosine 1."""
    monkeypatch.setattr(toxicity, "BLOCK", 16)
    monkeypatch.setattr(toxicity, "FREQUENT", 8)
    df, labels, docs = rated(spark)
    rng = random.Random(3)
    rare = [(1000 + i, " ".join(f"q{chr(97 + i % 26)}{chr(97 + k % 26)}{chr(97 + k // 26)}z" for k in range(i % 26, i % 26 + 30))) for i in range(40)]  # words of few examples
    docs, more = docs + rare, [(i, 1, int(i % 4 == 0)) for i, _ in rare]
    docs += [(i + 1000, t + " " + rng.choice(("", "!"))) for i, t in rare] + docs[:3] * 2
    got = {}
    for r in toxicity.score_toxicity(frame(spark, docs), labels.union(spark.createDataFrame(more, labels.schema))).collect():
        got.setdefault(r.doc_id, []).append(r)
    texts = {i: [w.lower() for w in "".join(c if c.isascii() and c.isalpha() else " " for c in t or "").split()] for i, t in docs}
    y = {i: int(i % 3 == 1) for i in range(600)} | {700: None, 5: int(5 % 3 == 1)} | {i: v for i, _, v in more}
    examples = sorted(i for i, v in y.items() if v is not None and i in texts and zlib.crc32(str(i).encode()) % 4 != 2)
    features = lambda words: [(0, w) for w in words] + [(n, w[:n]) for n in (4, 5, 6) for w in words if len(w) > n]
    count, bad = {}, {}
    for i in examples:
        for f in set(features(texts[i])):
            count[f] = count.get(f, 0) + 1
            bad[f] = bad.get(f, 0) + y[i]
    rate = sum(y[i] for i in examples) / len(examples)

    def toxic(f):
        n, b = count[f], bad[f]
        if b < toxicity.MIN_COUNT or b <= n * rate:
            return False
        return 2 * (b * math.log(b / (n * rate)) + ((n - b) * math.log((n - b) / (n * (1 - rate))) if n > b else 0)) >= toxicity.MIN_G

    boost = {f: toxicity.BOOST if toxic(f) else 1.0 for f in count if f[0] == 0 or toxic(f)}
    frequency = {}
    for _, t in docs:
        for f in set(features([w.lower() for w in "".join(c if c.isascii() and c.isalpha() else " " for c in t or "").split()])):
            frequency[f] = frequency.get(f, 0) + 1

    def vector(words):
        tf = {}
        for f in features(words):
            if f in boost:
                tf[f] = tf.get(f, 0) + 1
        v = {f: (1 + math.log(n)) * (math.log((len(docs) + 1) / (frequency[f] + 1)) + 1) * boost[f] for f, n in tf.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {f: x / norm for f, x in v.items()}

    own = {i: vector(texts[i]) for i in examples}
    plain = [y[i] for i in examples if not any(boost[f] > 1 for f in own[i])]
    base = (sum(plain) + 0.1) / (len(plain) + 1)
    for i, held in got.items():
        v = vector(texts[i])
        cosine = {e: sum(x * own[e].get(f, 0) for f, x in v.items()) for e in examples}
        top = sorted((c for c in cosine.values() if c > 1e-9), reverse=True)[: toxicity.NEIGHBOURS]
        for r in held:
            assert sorted((cosine[e] for e in r.evidence), reverse=True) == pytest.approx(top)
            vote = sum(cosine[e] ** 2 * y[e] for e in r.evidence)
            assert r.score == pytest.approx((vote + toxicity.BACKGROUND * base) / (sum(c * c for c in top) + toxicity.BACKGROUND))
            if i >= 2000 and i - 1000 in own:
                assert cosine[r.evidence[0]] == pytest.approx(1)


def test_labelled_sample_is_bounded_by_rows(spark):
    docs = spark.createDataFrame([(1, f"text {i % 50}") for i in range(500)] + [(2, None), (2, "b"), (3, "c")], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (3, 1), (4, 1), (None, 1)], "doc_id long, toxic int")
    rows = labelled.sample(docs, labels, labels.toxic, 10, exclude_held_out=False).collect()
    assert sorted(r.id for r in rows) == [1, 2, 3] and {r.y for r in rows} == {1}
    assert rows_of(labelled.sample(docs.repartition(7), labels, labels.toxic, 10, exclude_held_out=False), "id", "text") == sorted(((r.id, r.text) for r in rows), key=repr)


def test_ordinal_model_against_numbers():
    """The likelihood's gradient, row by row, against differences of the likelihood."""
    rng = np.random.default_rng(4)
    weights, cuts = rng.normal(size=6), np.array([-0.7, 0.9])
    rows = [(rng.integers(0, 6, 4), rng.random(4), int(rng.integers(0, 3))) for _ in range(12)]
    sigmoid = lambda z: 1 / (1 + math.exp(-z))

    def loss(w, c):
        total = 0.0
        for index, value, grade in rows:
            s = sum(w[i] * v for i, v in zip(index, value))
            tails = [1.0, *[sigmoid(s - t) for t in c], 0.0]
            total -= math.log(tails[grade] - tails[grade + 1])
        return total

    model = quality.OrdinalModel(3)
    model.thresholds = cuts
    for index, value, _ in rows:
        s = sum(weights[i] * v for i, v in zip(index, value))
        assert model.tails(np.array([s]))[0] == pytest.approx([sigmoid(s - t) for t in cuts])
    # a fitted model is a minimum: no coordinate's derivative points far off, and the likelihood beats a constant's
    y = np.array([g for _, _, g in rows] * 30)
    fitted = quality.OrdinalModel(3).fit([r[0] + 10 for r in rows] * 30, [r[1] for r in rows] * 30, y)
    at = fitted.weights[10:16].astype(float)
    assert loss(at, fitted.thresholds) < loss(np.zeros(6), np.array([-math.log(2), math.log(2)]))


def test_more_languages_than_samples_of_each(spark):
    rng = random.Random(12)
    rows = [(i, " ".join(f"{chr(97 + i % 20)}{chr(97 + i // 20 % 20)}{rng.choice('xyzw')}{rng.choice('aeiou')}" for _ in range(30)), f"l{i % 60:02d}") for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    chain = language.train(df, "doc_id", "text", "lang", rows=80)
    assert chain.labels == sorted({r[2] for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2})


def test_take_delivers_what_the_mix_takes(spark):
    rows = [(None, f"w{i} x y", "s") for i in range(30)] + [(None, "same same", "s")] * 9 + [(1, "a b c d", "s"), (1, "e f g h", "s"), (1, "a b c d", None)]
    rows += [(10 + i, "u v w x y z", "t") for i in range(30)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string, size string").repartition(5)
    mixed = mixing.mix(df).collect()
    want = {}
    for r in mixed:
        want[r.source] = want.get(r.source, 0) + r.taken
        assert r.taken <= 3 * r.size
    got = {}
    out = mixing.take(df)
    assert out.columns == df.columns
    for r in out.collect():
        got[r.source] = got.get(r.source, 0) + len(words(r.text))
    assert got == want and len(mixed) == len(rows)
    assert {s: math.floor(next(r.target for r in mixed if r.source == s) + 0.5) for s in want} == want
    # rows without an id lie all over their source's axis
    many = spark.range(20_000).selectExpr("cast(null as long) as doc_id", "concat('t', id) as text", "'s' as source")
    placed = mixing.place(many, "doc_id", "text", "source", (1,), 3, 100)
    assert placed.select("order").distinct().count() == 20_000


def test_fillings_come_by_waste_and_leave_none_out():
    rng = random.Random(8)
    for _ in range(40):
        counts = np.zeros(31, np.int64)
        for _ in range(rng.randrange(1, 7)):
            counts[rng.randrange(1, 31)] += 1
        made = list(packing.fillings(counts, 30))
        pieces = [x for x in range(31) for _ in range(counts[x])]
        every = {tuple(sorted((p for k, p in enumerate(pieces) if bits >> k & 1), reverse=True)) for bits in range(1 << len(pieces))}
        assert sorted(made) == sorted(f for f in every if sum(f) <= 30) and [sum(f) for f in made] == sorted(map(sum, made), reverse=True)
        kept = [f for f in packing.completions(counts, 30) if f is not None]
        assert all(any(packing.dominates(k, f) for k in kept) for f in made if len(f) <= packing.TESTED)
    counts = np.zeros(1025, np.int64)
    counts[[250, 170, 100, 74]] = 1
    assert next(packing.fillings(counts, 424)) == (250, 100, 74)


def spoken(rng, lang, n):
    stems = {"a": ("keit", "ung", "sch", "ver"), "b": ("tion", "ing", "the", "ly"), "c": ("ado", "ción", "que", "los")}[lang]
    return " ".join("".join(rng.choice(stems) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_language(spark):
    rng = random.Random(11)
    rows = [(i, spoken(rng, "abc"[i % 3], rng.randrange(1, 60)), "abc"[i % 3], "s") for i in range(300)]
    rows += [(400, None, "a", "s"), (401, "", "a", "s"), (402, "12 !? 3", "b", "s"), (403, "“…” 123 — ±", "b", "s"), (404, "ción ción", None, "s"),
             (405, spoken(rng, "a", 40) + "\n" + spoken(rng, "c", 12), "c", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "1 as id", "2 as score").repartition(3)
    got = {r.doc_id: r for r in language.identify(df).collect()}
    assert len(got) == len(rows)
    test = [r for i, r in got.items() if i < 300 and r.held_out]
    assert np.mean([r.lang_pred == "abc"[r.doc_id % 3] for r in test]) > 0.97
    assert {got[i].lang_pred for i in (400, 401, 402, 403)} == {"und"} and got[402].score == 0
    assert got[404].lang_pred == "c" and got[405].lang_pred == "a"
    assert got[405].word_share[2] > 0.15  # the switched line is seen
    nothing = language.identify(df.withColumn("lang", df.lang.substr(5, 1)).selectExpr("doc_id", "text", "nullif(lang, '') as lang"))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}
    assert language.identify(df.limit(0)).count() == 0


def test_forward_backward_against_enumeration():
    import itertools

    rng = np.random.default_rng(2)
    chain = language.Chain(["a", "b", "c"])
    chain.switch = rng.normal(size=(3, 3))
    lengths = [4, 1, 3]
    first = np.concatenate([[0], np.cumsum(lengths)])
    scores = rng.normal(size=(first[-1], 3))
    got = chain.marginals(scores, first)
    for begin, n in zip(first, lengths):
        want, total = np.zeros((n, 3)), 0
        for path in itertools.product(range(3), repeat=n):
            p = math.exp(sum(scores[begin + t, y] for t, y in enumerate(path)) + sum(chain.switch[a, b] for a, b in zip(path, path[1:])))
            total += p
            for t, y in enumerate(path):
                want[t, y] += p
        assert got[begin : begin + n] == pytest.approx(want / total)


def test_empty_tables(spark):
    none = frame(spark, [])
    assert packing.pack(none, TOKENIZER).count() == 0
    assert mixing.mix(none).count() == 0 and mixing.take(none).count() == 0
    assert embeddings.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_held_out_rule(spark):
    df = spark.createDataFrame([(i,) for i in [*range(40), None, -7]], "doc_id long")
    for r in df.select("doc_id", labelled.held_out(df.doc_id).alias("h")).collect():
        assert r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_chunks_cover_every_row():
    batch = pa.RecordBatch.from_pydict({"text": pa.array([None, "a" * 10, "", "b" * 100, "c", None])})
    parts = list(W.chunks(batch, "text", limit=16))
    assert [x for p in parts for x in p.column(0).to_pylist()] == batch.column(0).to_pylist()


@needs_data
def test_pipeline_stages(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(P.STAGES)
    assert [n for n, _ in P.STAGES] == ["quality_classifier", "exact_dedup", "near_dedup", "mixing", "packing"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = stages["quality_classifier"](spark, docs, SF)
    assert good.columns == docs.columns
    kept = {r.doc_id for r in good.collect()}
    assert sum(q == 1 and i not in kept for i, q in labels.items()) <= 0.05 * len(labels)
    out = P.run(spark, SF)
    assert out.count() > 0 and {r.doc_id for r in out.collect()} <= kept


@needs_data
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_match_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.sql(queries.ORACLE[name])
    df = queries.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df, *df.columns) == sorted((tuple(r) for r in rel.select(", ".join(df.columns)).fetchall()), key=repr)


def test_language_of_short_unspaced_and_long_texts(spark):
    rng = random.Random(41)
    made = {"la": [f"{a}{b}um" for a in "bcdfg" for b in ("or", "ip", "es")], "mu": [f"{a}{b}ja" for a in "klmnp" for b in ("uu", "yk", "aa")], "xx": [f"z{a}{b}" for a in "hrtvw" for b in ("oth", "iq", "ax")]}
    say = lambda lang, n: " ".join(rng.choice(made[lang]) for _ in range(n))
    rows = [(say("la", rng.randrange(1, 6)), "la") for _ in range(60)]  # no text of 12 words
    rows += [("".join(chr(rng.randrange(0x4E00, 0x4E80)) for _ in range(200)), "zh") for _ in range(60)]  # a text is one run
    rows += [("".join(chr(rng.randrange(0x0E01, 0x0E2F)) for _ in range(200)), "th") for _ in range(60)]
    rows += [(say("mu", 40), "mu") for _ in range(60)]
    rows += [(say("xx", 15_000), "xx") for _ in range(6)]  # above SAMPLE_BYTES
    df = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(rows)], "doc_id long, text string, lang string").repartition(3)
    got = {r.doc_id: r.lang_pred for r in language.identify(df).collect()}
    assert [got[i] for i in range(len(rows))] == [x for _, x in rows]


def test_language_learns_from_a_few_rows(spark):
    rows = [("the cat and the dog", "en"), ("the house and the tree", "en"), ("der hund und die katze", "de"), ("das haus und der baum", "de")]
    rows = [(i, t, x) for i, (t, x) in enumerate(rows * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language.identify(df).collect()}
    assert got == {i: x for i, _, x in rows}
