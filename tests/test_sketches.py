import random

from bagwise.operators import sketches
from bagwise.session import materialize

SCHEMA = "id long, lang string, day int, tokens array<string>"


def bags(spark, n=3000):
    rng = random.Random(5)
    rows = [(i, "hot" if i % 3 else "cold", i % 7, [f"t{rng.randrange(20000)}" for _ in range(rng.randrange(40))]) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA), rows


def test_stored_sketches_merge_within_their_error(spark):
    df, rows = bags(spark)
    daily = materialize(sketches.bag_sketches(df, ["lang", "day"]), "daily")
    assert daily.count() == 14
    quantiles = (0.1, 0.5, 0.9)
    whole = {r.lang: r for r in sketches.estimates(sketches.merged(daily, ["lang"]), ["lang"], quantiles).collect()}
    direct = {r.lang: r for r in sketches.estimates(sketches.bag_sketches(df, ["lang"]), ["lang"], quantiles).collect()}
    for lang in ("hot", "cold"):
        own = [r[3] for r in rows if r[1] == lang]
        distinct, sizes = len({t for b in own for t in b}), [len(b) for b in own]
        for got in (whole[lang], direct[lang]):
            assert got.n_bags == len(own)
            assert abs(got.n_distinct_tokens - distinct) <= 0.06 * distinct
            for q, size in zip(quantiles, got.sizes):
                assert sum(s < size for s in sizes) / len(sizes) <= q + 0.03
                assert sum(s <= size for s in sizes) / len(sizes) >= q - 0.03
    found = sketches.exact_beside(df, sketches.estimates(sketches.merged(daily, ["lang"]), ["lang"]), "lang").collect()
    assert len(found) == 2 and all(r.count_within and r.sizes_within for r in found)


def test_a_wrong_estimate_is_told(spark):
    df, _ = bags(spark, 300)
    wrong = spark.createDataFrame([("hot", 200, 5, [1, 2]), ("cold", 100, 5, [39, 39])], "lang string, n_bags long, n_distinct_tokens long, sizes array<long>")
    assert not any(r.count_within or r.sizes_within for r in sketches.exact_beside(df, wrong, "lang").collect())


def test_odd_bags(spark):
    rows = [(1, "a", 0, None), (2, "a", 0, []), (3, "a", 0, ["x", "x", "y"]), (4, None, 0, ["x"]), (5, "none", 0, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.lang: r for r in sketches.estimates(sketches.merged(sketches.bag_sketches(df, ["lang", "day"]), ["lang"]), ["lang"], (0.0, 1.0)).collect()}
    assert (got["a"].n_bags, got["a"].n_distinct_tokens, got["a"].sizes) == (3, 2, [0, 3])
    assert (got[None].n_bags, got[None].n_distinct_tokens, got[None].sizes) == (1, 1, [1, 1])
    assert (got["none"].n_bags, got["none"].n_distinct_tokens, got["none"].sizes) == (1, 0, None)
    beside = {r.lang: r for r in sketches.exact_beside(df, sketches.estimates(sketches.bag_sketches(df, ["lang"]), ["lang"]), "lang").collect()}
    assert {k: r.n_distinct_tokens for k, r in beside.items()} == {"a": 2, None: 1, "none": 0}
    assert all(r.count_within and r.sizes_within for r in beside.values())
    assert sketches.estimates(sketches.bag_sketches(df.limit(0), ["lang"]), ["lang"]).count() == 0
