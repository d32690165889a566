import hashlib
import math
import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as s

from bagwise.llm import resample
from tests.llm.conftest import frame, prose


@settings(max_examples=200, deadline=None)
@given(s.lists(s.binary(max_size=40), max_size=30), s.binary(min_size=1, max_size=3))
def test_crcs(features, more):
    features = features + [more * 900, b"", more * resample.COLUMNS]
    assert resample.crcs(features).tolist() == [zlib.crc32(f) for f in features]


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@settings(max_examples=200, deadline=None)
@given(s.text(s.one_of(s.characters(max_codepoint=300, exclude_categories=["Cs"]), s.sampled_from("AZ09 _-{\x7f\xa0\u2003\U0001f600"))))
def test_words(text):
    assert [w.decode() for w in resample.words(text)] == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def plain(docs, target, longest, buckets, least, percent, seed):
    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))
        return w, [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, longest + 1) for i in range(len(w) - k + 1)]
    a, b = Counter(), Counter()
    for _, text in docs:
        a.update(features(text)[1])
    for text in target:
        b.update(features(text)[1])
    n, m = sum(a.values()), sum(b.values())
    out = []
    for i, text in docs:
        w, f = features(text)
        weight = sum(math.floor(1000 * math.log((b[x] + 1) * (n + buckets) / ((a[x] + 1) * (m + buckets)))) for x in f)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w)])
    open_ = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {id(r): k for k, r in enumerate(open_[:percent * len(open_) // 100], 1)}
    return sorted(((r[0], *r[1:4], ranks.get(id(r))) for r in out), key=repr)


def test_equals_plain(spark, rng):
    texts = [prose(rng, rng.randrange(1, 60)) + rng.choice(["", " Größe 日本", " X_y", "!!"]) for _ in range(300)]
    texts += [None, "", "--", "w" * 5000, "a " * 3000, texts[0], texts[0]]
    docs = frame(spark, texts, ids=[*range(len(texts) - 2), 7, None])
    target = [prose(rng, 30) + " Größe" for _ in range(9)] + [None]
    aims = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    for longest, buckets, least, percent in ((1, 10_000, 20, 10), (2, 97, 0, 50)):
        got = resample.importance_resample(docs, aims, longest, buckets, least, percent, 2024).collect()
        want = plain([(r.doc_id, r.text) for r in docs.collect()], target, longest, buckets, least, percent, 2024)
        by_rank = [r for r in got if r["rank"]]
        assert sorted(r["rank"] for r in by_rank) == list(range(1, len(by_rank) + 1))
        assert sorted(map(tuple, got), key=repr) == want


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert resample.importance_resample(empty, empty).count() == 0
    one = frame(spark, ["word " * 30] * 20)
    assert resample.importance_resample(one, empty).filter("rank is not null").count() == 2
