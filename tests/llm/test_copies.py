import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from bagwise.llm import graph, imatch, line_dedup, ngram_join, nn_descent
from tests.llm.conftest import frame, prose


def components(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(50, 60), (60, 55), (70, 70)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 50: 50, 55: 50, 60: 50}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_texts(rng, n=40):
    texts = []
    for _ in range(n):
        words = prose(rng, rng.choice([1, 3, 8, 40, 120])).split()
        for _ in range(rng.choice([1, 1, 2, 4])):
            copy = list(words)
            for _ in range(rng.choice([0, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = rng.choice(["changed", "other", "word"])
            texts.append(" ".join(copy))
    return texts


def grams(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()}


def test_ngram_join(spark, odd, rng):
    texts = near_texts(rng)
    for size, percent in ((4, 85), (5, 80)):
        sets = [grams(t, size) for t in texts]
        links = [(i, j) for j in range(len(sets)) for i in range(j) if sets[i] and sets[j]
                 and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
        want = components(len(sets), links)
        got = ngram_join.ngram_jaccard_components(frame(spark, texts), size, percent).orderBy("doc_id").collect()
        assert [g.n_shingles for g in got] == [len(x) for x in sets]
        assert [g.component_id for g in got] == want
    got = ngram_join.ngram_jaccard_components(odd)
    assert got.count() == odd.count()
    ids = {r.doc_id: r.component_id for r in got.collect()}
    assert ids[4] == ids[5] == 4 and ids[6] == ids[7] == 6 and ids[0] == 0 and ids[1] == 1 and ids[None] is None
    assert ngram_join.ngram_jaccard_components(odd.limit(0)).count() == 0


def variants(rng, length, n, most):
    """Texts with changed words, mostly at two places each: many pairs near the threshold."""
    words = [f"w{i}" for i in range(length)]
    texts = []
    for _ in range(n):
        copy = list(words)
        for at in rng.sample(range(length), rng.randrange(most)):
            copy[at] = f"v{rng.randrange(40)}"
        texts.append(" ".join(copy))
    return texts


def test_ngram_join_on_a_dense_group(spark, rng):
    """Many sets around one text: links and near misses by the square of the group."""
    texts = variants(rng, 150, 90, 5) + variants(rng, 40, 60, 3) + [prose(rng, 50) for _ in range(10)]
    sets = [grams(t, 4) for t in texts]
    links = [(i, j) for j in range(len(sets)) for i in range(j)
             if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    got = ngram_join.ngram_jaccard_components(frame(spark, texts), 4, 85).orderBy("doc_id").collect()
    assert [g.component_id for g in got] == components(len(sets), links)


def test_a_tile_names_its_pairs_once_and_few(rng):
    sets = ngram_join.ngram_sets(variants(rng, 150, 60, 5), 4)
    keys = [ngram_join.prefix(s, np.zeros(0, np.uint64), 85).view(np.int64) for s in sets]
    tiles = {}
    for rep, own in enumerate(keys):
        for key in own.tolist():
            tiles.setdefault(key, []).append(rep)

    def rows(key, members):
        lead = [np.array([keys[r][k] for r in members]) for k in range(ngram_join.LEAD)]
        same = len(members)
        return pa.record_batch([np.full(same, key), np.full(same, key), np.array([len(sets[r]) for r in members], np.int32), np.array(members),
                                np.array(members), np.zeros(same, bool), pa.array([ngram_join.bitmap(sets[r]) for r in members]), *lead],
                               names=["tile", "key", "n", "rep", "component", "upper", "bits", *(f"lead{k}" for k in range(ngram_join.LEAD))])
    whole = []
    for key, members in tiles.items():
        for out in ngram_join.tile_rows(85, 0, True)(iter([rows(key, members)])):
            assert out.column(2).null_count == len(out)
            whole += zip(out.column(0).to_pylist(), out.column(1).to_pylist())
        for turn in (0, 1):
            few = [out for out in ngram_join.tile_rows(85, turn, False)(iter([rows(key, members)]))]
            assert sum(map(len, few)) <= len(members)
            assert {(a, b) for out in few for a, b in zip(out.column(0).to_pylist(), out.column(1).to_pylist())} <= set(whole)
    links = {(j, i) for j in range(len(sets)) for i in range(j)
             if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))}
    assert links and links <= set(whole)
    assert len(whole) <= 1.2 * len(set(whole))


def test_bitmap_bound_never_drops_a_link(rng):
    r = np.random.default_rng(1)
    for _ in range(100):
        a = np.unique(r.integers(0, 1 << 60, rng.choice([5, 60, 300])).astype(np.uint64))
        b = np.unique(np.concatenate([a[:int(len(a) * rng.uniform(0.7, 1))], r.integers(0, 1 << 60, rng.choice([0, 2, 20])).astype(np.uint64)]))
        x, y = (np.frombuffer(ngram_join.bitmap(s), np.uint8) for s in (a, b))
        width = min(len(x), len(y))
        x, y = ngram_join.folded(x, width), ngram_join.folded(y, width)
        same = ngram_join.overlap(a, b)
        assert same == len(set(a.tolist()) & set(b.tolist()))
        if 100 * same >= 85 * (len(a) + len(b) - same):
            assert ngram_join.admitted(x[None], np.array([len(a)]), y.tobytes(), len(b), 85)[0]


def plain_line_dedup(rows, percent=80):
    seen, gone = [], set()
    for doc, text in sorted(rows):
        for k, line in enumerate((text or "").split("\n")):
            words = grams(line, 1)
            if words:
                if any(100 * len(words & s) >= percent * len(words | s) for s in seen):
                    gone.add((doc, k))
                seen.append(words)
    return gone


def test_line_dedup(spark, odd, rng):
    pool = near_texts(rng, 25)
    texts = ["\n".join(rng.choice(pool + ["", "of the", "the of"]) for _ in range(rng.choice([1, 3, 8]))) for _ in range(60)]
    docs = frame(spark, texts)
    gone = line_dedup.duplicate_lines(docs)
    want = plain_line_dedup(list(enumerate(texts)))
    assert {(r.doc_id, r.line) for r in gone.collect()} == want
    left = {r.doc_id: r.text for r in line_dedup.without_lines(docs, gone).collect()}
    for i, text in enumerate(texts):
        kept = [x for k, x in enumerate(text.split("\n")) if (i, k) not in want]
        if any(kept) or not any(d == i for d, _ in want):
            assert left[i] == "\n".join(kept)
        else:
            assert i not in left
    found = line_dedup.duplicate_lines(odd)
    rest = line_dedup.without_lines(odd, found)
    assert rest.columns == odd.columns
    assert {r.doc_id for r in rest.collect()} >= {None, 0, 1, 2, 3, 4, 6, 8}
    assert line_dedup.duplicate_lines(odd.limit(0)).count() == 0


def test_line_dedup_settles_many_candidates(spark, rng):
    """Variants of one line around the threshold, a third of all lines: first candidates often fail, others match."""
    texts = []
    for length in (12, 60, 90):  # the last ones' words aren't carried into the tiles
        words = [f"w{length}x{i}" for i in range(length)]
        for _ in range(120):
            copy = list(words)
            for at in rng.sample(range(length), rng.randrange(length // 5)):
                copy[at] = f"v{rng.randrange(60)}"
            texts.append(" ".join(copy))
    texts += [prose(rng, 9) for _ in range(300)]
    rng.shuffle(texts)
    docs = ["\n".join(texts[i:i + 3]) for i in range(0, len(texts), 3)]
    want = plain_line_dedup(list(enumerate(docs)))
    assert 100 < len(want) < len(texts)
    assert {(r.doc_id, r.line) for r in line_dedup.duplicate_lines(frame(spark, docs)).collect()} == want


def test_line_dedup_leaves_texts_in_place(spark, rng, monkeypatch):
    """Neither the texts nor sorted classes are exchanged, ids of any size stay whole, and a small bit table loses no line."""
    pool = near_texts(rng, 12)
    ids = [-(1 << 63), -5, -1, 0, 3, 1 << 40, (1 << 63) - 1]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(6))) for i in ids]
    want = plain_line_dedup(docs)
    assert want and len(want) < 6 * len(docs)
    plans, written = {}, line_dedup.written

    def noted(df, name, *rest):
        plans[name] = df._jdf.queryExecution().sparkPlan().toString()
        return written(df, name, *rest)
    monkeypatch.setattr(line_dedup, "written", noted)
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for bits in (line_dedup.BITS, 64):
            monkeypatch.setattr(line_dedup, "BITS", bits)
            assert {(r.doc_id, r.line) for r in line_dedup.duplicate_lines(rows).collect()} == want
            assert "Join" not in plans["words"]
            assert "SortAggregate" not in plans["classes"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lone_rows_of_a_tile_are_left_out():
    tile, n = np.array([1, 4, 4, 7, 9, 9, 9]), np.array([5, 6, 4, 5, 3, 3, 2], np.int32)
    doc, none = np.arange(7), np.zeros(7, np.int64)
    rows, _ = line_dedup.in_tiles([tile, n, none, np.zeros((7, 8), np.uint64), doc, none], 80)
    assert rows[0].tolist() == [4, 4, 9, 9, 9] and rows[4].tolist() == [2, 1, 6, 4, 5]
    rows, pairs = line_dedup.in_tiles([x[:1] for x in (tile, n, none, np.zeros((7, 8), np.uint64), doc, none)], 80)
    assert not len(rows[0]) and not list(pairs)


def test_line_words_come_by_count(spark):
    common, few, more = [f"x{k}" for k in range(40)], [f"w{k}" for k in range(10)], [f"v{k}" for k in range(10)]
    texts = [" ".join(6 * few + 7 * more), *(" ".join(1000 * common) for _ in range(20))]  # of 800,130 words: shares below BANDED
    known, place, banded = line_dedup.frequent_words(frame(spark, texts))
    of = dict(zip(known.tolist(), place.tolist()))
    rank = [[of[h] for h in line_dedup.word_hashes([w])[0].tolist()] for words in (few, more, common) for w in words]
    assert sorted(rank[:10]) == [[k] for k in range(10)] and sorted(rank[10:20]) == [[k] for k in range(10, 20)]
    assert banded == 20 and min(rank[20:]) == [20]


def test_passing_names_the_admitted_pairs():
    rng, size = np.random.default_rng(3), 400
    tile, n = rng.integers(0, 8, size), rng.integers(1, 30, size)
    order = np.lexsort((n, tile))
    tile, n = tile[order], n[order]
    place = rng.integers(0, n - -(-80 * n // 100) + 1) + 1
    place = np.where(rng.random(size) < 0.3, -place, place)
    parity = np.zeros((size, 8), np.uint64)
    parity[:, 0] = np.uint64(1) << rng.integers(0, 3, size).astype(np.uint64)
    got = [pair for i, j in line_dedup.passing(tile, n, place, parity, 80) for pair in zip(i.tolist(), j.tolist())]
    want = set()
    for i in range(size):
        for j in range(i + 1, size):
            need = -(-80 * int(n[i] + n[j]) // 180)
            left = min(int(n[k]) - abs(int(place[k])) + 1 for k in (i, j))
            differ = 0 if parity[i, 0] == parity[j, 0] else 2
            if tile[i] == tile[j] and 80 * n[j] <= 100 * n[i] and left >= need and (place[i] > 0 or place[j] > 0) and differ <= n[i] + n[j] - 2 * need:
                want.add((i, j))
    assert want and len(got) == len(want) and set(got) == want
    none = [x[:0] for x in (tile, n, place, parity)]
    assert list(line_dedup.passing(*none, 80)) == []


def test_nn_descent(spark):
    r = np.random.default_rng(3)
    rows, x, labels = [], [], []
    for c in range(30):  # clusters, among them one much larger than a list
        centre = r.normal(size=32)
        for _ in range(80 if c == 0 else r.integers(1, 6)):
            x.append(centre + r.normal(size=32) * 0.05)
            labels.append(c % 3)
    x += [x[0]] * 4
    labels += [labels[0]] * 4
    rows = [(i, [float(v) for v in e], l) for i, (e, l) in enumerate(zip(x, labels))]
    bad = [(1000, None, 0), (1001, [0.0] * 32, 0), (1002, [1.0, None], 0), (1003, [float("nan")] * 32, 0), (1004, [float(v) for v in x[0]], None),
           (1005, [], 1), (1006, [1.0, 2.0], 0)]
    unit = np.stack(x) / np.linalg.norm(x, axis=1, keepdims=True)
    link = (unit @ unit.T >= 0.93) & (np.array(labels)[:, None] == np.array(labels)[None, :])
    np.fill_diagonal(link, False)
    want = components(len(x), list(zip(*np.nonzero(np.triu(link)))))
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label int").withColumn("rep", F.lit("x"))
    got = {g.vec_id: (g.n_links, g.component_id) for g in nn_descent.embedding_links(df, k=4).collect()}
    assert len(got) == len(x) + len(bad)
    assert [got[i] for i in range(len(x))] == list(zip(link.sum(1).tolist(), want))
    assert all(got[b[0]] == (0, b[0]) for b in bad)
    again = {g.vec_id: (g.n_links, g.component_id) for g in nn_descent.embedding_links(df.unionAll(df.limit(5)), k=4).collect()}
    assert again == got
    assert nn_descent.embedding_links(df.limit(0)).count() == 0


def test_imatch(spark, odd, rng):
    texts = [" ".join(f"word{rng.randrange(900)}" for _ in range(rng.choice([40, 100, 400]))) for _ in range(60)]
    texts += [texts[3], texts[4]]
    ids = [1000 * i * i for i in range(len(texts))]
    got = imatch.fingerprints(frame(spark, texts, ids=ids)).orderBy("doc_id").collect()
    import hashlib
    for i, g in enumerate(got):
        m = len(texts[i]) // 4
        edited = texts[i][:len(texts[i]) - m] + texts[(i + 1) % len(texts)][:m]
        assert g.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and g.n_chars == len(texts[i])
        assert 0 <= g.near_edited <= 1 and 0 <= g.near_next <= 1
    assert got[3].fingerprint == got[-2].fingerprint and got[4].fingerprint == got[-1].fingerprint
    assert np.mean([g.near_edited for g in got]) > np.mean([g.near_next for g in got])
    out = imatch.fingerprints(odd)
    assert out.count() == odd.count()
    by_id = {}
    for g in out.collect():
        by_id.setdefault(g.doc_id, set()).add(g.fingerprint)
    assert all(len(v) == 1 for k, v in by_id.items() if k is not None) and by_id[6] == by_id[7]
    assert imatch.fingerprints(odd.limit(0)).count() == 0


def test_following(spark):
    ids = [-5, 0, 1, 4095, 4096, 10**6, 2**40, 2**62]
    df = spark.createDataFrame([(i, i) for i in ids], "key long, first long")
    got = {r.key: r.next for r in imatch.following(df).collect()}
    assert got == dict(zip(ids, ids[1:] + [None]))


def test_nn_descent_settles_small_links_beside_a_large_component(spark, monkeypatch):
    """Poor blocks and short lists; the pairs' links are few beside those of the large component."""
    for name, value in (("BLOCK", 4), ("TABLES", 1), ("TILE", 64)):
        monkeypatch.setattr(nn_descent, name, value)
    r = np.random.default_rng(8)
    centre = r.normal(size=32)
    x = [centre + r.normal(size=32) * 0.05 for _ in range(150)]
    for _ in range(150):
        one = r.normal(size=32)
        x += [one, one + r.normal(size=32) * 0.3]
    unit = np.stack(x) / np.linalg.norm(x, axis=1, keepdims=True)
    link = unit @ unit.T >= 0.93
    np.fill_diagonal(link, False)
    assert link[150:].sum() > 100
    df = spark.createDataFrame([(i, [float(v) for v in e], 0) for i, e in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {g.vec_id: g.n_links for g in nn_descent.embedding_links(df, k=2).collect()}
    found = np.array([got[i] for i in range(len(x))])
    for at in (slice(0, 150), slice(150, None)):
        assert found[at].sum() >= 0.95 * link[at].sum()


def test_imatch_sees_every_term(spark):
    """Each word of the lexicon alone makes a difference, and each short text has a fingerprint of terms."""
    words = [f"term{i}" for i in range(60)]
    texts = [w for w in words] + [f"{w} {words[(i + 1) % 60]}" for i, w in enumerate(words)]
    got = imatch.fingerprints(frame(spark, texts)).orderBy("doc_id").collect()
    assert not any(g.fingerprint.startswith("text:") for g in got)
    assert len({g.fingerprint for g in got}) == len(texts)
    assert all(g.near_next < 1 for g in got)
    member = spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w").alias("t")).select(F.array(*imatch.members(F.col("t"))).alias("m"))
    assert all(r.m[0] and len(r.m) == imatch.N_SUBSETS for r in member.collect())
    shares = np.mean([r.m for r in member.collect()], axis=0)
    assert all(0.2 < s < 0.8 for s in shares[1:5])
