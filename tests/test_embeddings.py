"""Embeddings from counts and nearest tokens, against plain computations."""
import random
from collections import Counter
from math import log

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bagwise.operators import embeddings as em
from bagwise.operators import nearest as ne
from bagwise.plans import catalog
from bagwise.plans import models as mdl
from conftest import SF_SMALL


def bags(spark, rng, n=60):
    words = [f"w{i}" for i in range(40)]
    rows = [(i, ["hot" if rng.random() < 0.3 else rng.choice(words[i % 3 * 13:][:14]) for _ in range(rng.randrange(0, 30))]) for i in range(n)]
    return rows + [(n, None), (n + 1, []), (n + 2, ["alone"]), (n + 3, ["rare", "hot", "rare", "rare"])]


def plain_counts(rows, window, least):
    seen = Counter(t for _, b in rows for t in b or ())
    out = Counter()
    for _, b in rows:
        for i, a in enumerate(b or ()):
            for j, c in enumerate(b):
                if i != j and abs(i - j) <= window and min(seen[a], seen[c]) >= least:
                    out[a, c] += 1
    return out


@pytest.mark.parametrize("window,least", [(1, 1), (3, 2), (50, 5)])
def test_cooccurrence(spark, window, least):
    rows = bags(spark, random.Random(4))
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    got = {(r[0], r[1]): r[2] for r in em.cooccurrence(df, "tokens", window, least).collect()}
    assert got == dict(plain_counts(rows, window, least))


def ratios(counts, shift=1.0):
    of, total = Counter(), sum(counts.values())
    for (a, _), n in counts.items():
        of[a] += n
    return {p: w for p, n in counts.items() if (w := log(n * total / (of[p[0]] * of[p[1]])) - log(shift)) > 0}


def test_log_ratios(spark):
    counts = plain_counts(bags(spark, random.Random(5)), 2, 1)
    df = spark.createDataFrame([(*p, n) for p, n in counts.items()], "token string, context string, n long")
    for shift in (1.0, 2.0):
        got = {(r[0], r[1]): r[2] for r in em.log_ratios(df, shift).collect()}
        want = ratios(counts, shift)
        assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-9 for p in got)


@pytest.mark.parametrize("chunk", [4096, 7])
def test_axes_are_those_of_the_dense_matrix(spark, monkeypatch, chunk):
    monkeypatch.setattr(em, "CHUNK", chunk)
    rng = np.random.default_rng(2)
    n, dims = 30, 3
    base = rng.normal(size=(n, dims)) * [9, 5, 3]
    dense = np.round(base @ base.T * (rng.random((n, n)) < 0.95), 3)
    dense = np.tril(dense) + np.tril(dense, -1).T
    dense[-1] = dense[:, -1] = 0   # a token without entries
    rows = [(f"t{i:02d}", f"t{j:02d}", float(dense[i, j])) for i in range(n) for j in range(n) if dense[i, j]]
    got = {r[0]: r[1] for r in em.leading_axes(spark.createDataFrame(rows, "token string, context string, weight double"), dims, 15).collect()}
    assert f"t{n - 1}" not in got and len(got) == n - 1
    values, vectors = np.linalg.eigh(dense)
    top = np.argsort(-np.abs(values))[:dims]
    assert np.sort(np.abs(values))[-dims] > 1.4 * np.sort(np.abs(values))[-dims - 1]   # the axes are apart from the next
    want = (vectors[:, top] * np.abs(values[top])) @ vectors[:, top].T
    found = np.array([got[f"t{i:02d}"] for i in range(n - 1)])
    assert np.allclose(found @ found.T, want[:-1, :-1], atol=1e-3 * np.abs(values).max())


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, tokens array<string>")
    assert em.cooccurrence(df).count() == 0
    assert em.log_ratios(em.cooccurrence(df)).count() == 0


def test_as_a_feature_kind(spark):
    prep = mdl.prepare_training(catalog.doc_bags(spark, SF_SMALL), "doc_id", "lang")
    cooc = dict(dims=8, window=2, min_count=3, rounds=2)
    for classifier in (mdl.logistic_regression(max_iter=5), mdl.random_forest(3, 4, "weight", seed=1)):
        model = mdl.fit(mdl.build_pipeline(mdl.FEATURES_COOC, classifier, prep.train, "lang", "tokens", cooc=cooc), prep.train)
        assert mdl.evaluate(model, prep.valid).first()["accuracy"] > 0.6
    stage = model.stages[1]
    vectors = {r[0]: np.array(r[1].toArray()) for r in stage.getVectors().collect()}
    bag, got = stage.transform(prep.valid).select("tokens", "features").first()
    assert np.allclose(got.toArray(), sum(vectors.get(t, np.zeros(8)) for t in bag) / len(bag), atol=1e-5)


def plain_nearest(vectors, n):
    unit = {t: np.array(v, float) / np.linalg.norm(np.array(v, float)) for t, v in vectors.items()
            if v is not None and np.isfinite(np.array(v, float)).all() and np.linalg.norm(np.array(v, float)) > 0}
    out = {}
    for t, x in unit.items():
        best = sorted((-round(float(x @ y), ne.DIGITS), o) for o, y in unit.items() if o != t)[:n]
        for k, (c, o) in enumerate(best, 1):
            out[t, k] = (o, -c)
    return out


@pytest.mark.parametrize("block,pivots", [(8192, 1024), (16, 1024), (16, 2)])
def test_nearest_tokens(spark, monkeypatch, block, pivots):
    monkeypatch.setattr(ne, "PIVOTS", pivots)
    monkeypatch.setattr(ne, "ROWS", 5)
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(6, 5)) * 4
    vectors = {f"t{i:03d}": (centres[i % 6] + rng.normal(size=5)).tolist() for i in range(150)}
    vectors |= {f"same{i}": vectors["t000"] for i in range(20)}      # ties and a crowd at one place
    vectors |= {"zero": [0.0] * 5, "none": None, "nan": [float("nan")] + [1.0] * 4, "inf": [float("inf")] + [1.0] * 4, "minus": [-v for v in vectors["t001"]]}
    df = spark.createDataFrame(list(vectors.items()), "token string, vector array<double>").repartition(5)
    got = {(r[0], r[1]): (r[2], r[3]) for r in ne.nearest_tokens(df, 7, block).collect()}
    want = plain_nearest(vectors, 7)
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-8 for k in got)


def test_a_tile_leaves_what_its_tokens_may_keep():
    """Tokens of another block below a token's n-th best in its own block stay out; equal cosines rank by token."""
    def unit(*degrees):
        return np.array([[np.cos(np.radians(d)), np.sin(np.radians(d))] for d in degrees])

    x, y = unit(0, 1, 40), unit(80, 39, 41, *[40] * 100)
    names = ["o", "l", "m", *[f"z{k:03}" for k in range(99, -1, -1)]]
    wanted = next(ne._wanted_rows(["X"], unit(13), np.array([1.0]), 2, True)(iter([pa.RecordBatch.from_arrays([pa.array(["X"]), pa.array([x.tobytes()])], names=["block", "matrix"])])))
    floors = wanted.column(2)[0].as_py()
    assert np.allclose(np.frombuffer(floors, float), np.cos(np.radians([40, 39, 40])))
    tile = pa.RecordBatch.from_pydict({"same": [False], "tokens": [["a", "b", "c"]], "matrix": [x.tobytes()], "floors": [floors], "others": [names], "other": [y.tobytes()]})
    got = {r["token"]: [(p["neighbour"], round(-p["less"], 6)) for p in r["near"]] for b in ne._tile_rows(2)(iter([tile])) for r in b.to_pylist()}
    cos = {d: round(float(np.cos(np.radians(d))), 6) for d in (38, 39)}
    assert got == {"a": [("l", cos[39]), ("z000", round(float(np.cos(np.radians(40))), 6))], "b": [("l", cos[38]), ("z000", cos[39])], "c": [("z000", 1.0), ("z001", 1.0)]}
    far = pa.RecordBatch.from_pydict({"same": [False], "tokens": [["a", "b", "c"]], "matrix": [x.tobytes()], "floors": [floors], "others": [["o"]], "other": [unit(100).tobytes()]})
    assert not list(ne._tile_rows(2)(iter([far])))


def test_nearest_of_few(spark):
    empty = spark.createDataFrame([], "token string, vector array<double>")
    assert ne.nearest_tokens(empty).count() == 0
    one = spark.createDataFrame([("a", [1.0])], "token string, vector array<double>")
    assert ne.nearest_tokens(one).count() == 0
    two = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 2.0])], "token string, vector array<double>")
    assert sorted(map(tuple, ne.nearest_tokens(two).collect())) == [("a", 1, "b", 0.0), ("b", 1, "a", 0.0)]


def test_blocks_far_away_are_skipped(spark):
    """Two tight groups at a right angle: no block of one is wanted by the other."""
    rng = np.random.default_rng(1)
    x = np.vstack([[1, 0, 0] + rng.normal(size=(40, 3)) * 0.01, [0, 1, 0] + rng.normal(size=(40, 3)) * 0.01])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centres = np.array([[1.0, 0, 0], [0, 1.0, 0]])
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(["a"]), pa.array([x[:40].tobytes()], pa.binary())], names=["block", "matrix"])
    got = next(ne._wanted_rows(["a", "b"], centres, np.array([0.05, 0.05]), 10)(iter([batch]))).to_pylist()
    assert got == [{"block": "a", "wanted": ["a"]}]


def test_hashed_pairs_stand_once_and_rare_tokens_leave(spark, monkeypatch):
    """Few slots, so that rare tokens share one with frequent ones and go by the joins; and few pairs at a time."""
    monkeypatch.setattr(em, "SLOT_BITS", 13)
    monkeypatch.setattr(em, "PAIRS", 64)
    rng = random.Random(8)
    rows = bags(spark, rng) + [(1000 + i, [f"rare{i}x{j}" if j % 2 else "hot" for j in range(12)]) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>").repartition(3)
    pairs, words = em.hashed_cooccurrence(df, "tokens", 3, 2)
    token = {r["h"]: r["token"] for r in words.collect()}
    want = {p: n for p, n in plain_counts(rows, 3, 2).items()}
    found = {(r[0], r[1]): r[2] for r in pairs.collect()}
    assert len(found) == pairs.count() and all(a <= b for a, b in found)
    assert {(token[a], token[b]): n * (2 if a == b else 1) for (a, b), n in found.items()}.items() <= want.items()
    assert 2 * len(found) - sum(a == b for a, b in found) == len(want)
    ratio = {(token[r[0]], token[r[1]]): r[2] for r in em.log_ratios(pairs, once=True).collect()}
    of_all = ratios(want)
    assert all(abs(of_all[p] - w) < 1e-9 for p, w in ratio.items()) and {frozenset(p) for p in ratio} == {frozenset(p) for p in of_all}


def test_a_product_sends_a_vector_to_few_chunks(spark, monkeypatch):
    """The product's rows are whole sums, one for each token: none is added up again in another exchange."""
    monkeypatch.setattr(em, "CHUNK", 5)
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([0, 0, 1]), pa.array([np.array([1.0, 2.0]).tobytes(), np.array([3.0, 4.0]).tobytes(), np.array([1.0, 1.0]).tobytes()], pa.binary()),
                                        pa.array([[0, 2], [2], [1]]), pa.array([[1.0, 10.0], [1.0], [5.0]])], names=["chunk", "vec", "tokens", "weights"])
    got = [r for b in em._product_rows(2, 2, 3)(iter([batch])) for r in b.to_pylist()]
    assert {r["idx"]: np.frombuffer(r["vec"], float).tolist() for r in got} == {0: [1.0, 2.0], 2: [13.0, 24.0], 1: [5.0, 5.0]} and len(got) == 3


def test_written_tables_go(spark):
    from bagwise.session import _WRITTEN, discard, materialize
    table = materialize(spark.range(3), "t")
    before = len(_WRITTEN)
    discard(table)
    assert len(_WRITTEN) == before - 1 and not any(table._written_to == p for p in _WRITTEN)


def test_a_product_has_as_many_chunks_as_cores_at_most(spark, monkeypatch):
    """A vector goes to each chunk: their number follows the cores, not the tokens; and each has a partition of its own."""
    cores = spark.sparkContext.defaultParallelism
    made, product = [], em._product_rows
    monkeypatch.setattr(em, "LEAST", 2)
    monkeypatch.setattr(em, "_product_rows", lambda dims, chunks, tokens: made.append((chunks, tokens)) or product(dims, chunks, tokens))
    n = 40 * cores
    rows = [(f"t{i:04d}", f"t{(i + k) % n:04d}", 1.0) for i in range(n) for k in (1, n - 1)]
    got = em.leading_axes(spark.createDataFrame(rows, "token string, context string, weight double"), 2, 1)
    assert got.count() == n and made == [(cores, n)]
    for n in (1, 3, 12):
        key = F.element_at(em._keys_of_partitions(spark, n), (F.col("id") % n + 1).cast("int"))
        dealt = spark.range(40).repartition(n, key).select((F.col("id") % n).alias("chunk"), F.spark_partition_id().alias("at")).distinct().collect()
        assert len(dealt) == len({r["at"] for r in dealt}) == len({r["chunk"] for r in dealt}) == n
