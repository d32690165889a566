import re
import zlib
from collections import Counter
from itertools import combinations
from math import log

from hypothesis import given, settings
from hypothesis import strategies as s

from bagwise.llm import url_filter as uf
from bagwise.llm.queries import URL_RULES

COLUMNS = "page_id long, url string, html string, host string, path string, word string, words array<string>, name string, n int"


def pages(spark, urls, ids=None):
    return spark.createDataFrame([(i, u, "<p>", "x", "y", "z", ["w"], "v", 3) for i, u in zip(ids or range(len(urls)), urls)], COLUMNS)


def texts(spark, *found):
    return spark.createDataFrame([(i, t) for i, t in enumerate(found)], "doc_id long, text string")


def plain_parts(url):
    m = re.search("://", url or "")
    rest = url[m.end():] if m else ""
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host):])[0]


def plain_rule(host, path):
    fits = []
    for action, rule in URL_RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), rule, action))
    return max(fits)[1:] if fits else (None, None)


def cheapest(name, known, total):
    """Over all cuts: cost, pieces, and then the longer last pieces."""
    def cost(a, b):
        return known.get((a, b - a), log(total) + (b - a - 1) * uf.LETTER)
    cuts = [(0, *c, len(name)) for k in range(len(name)) for c in combinations(range(1, len(name)), k)]
    return min((sum(cost(a, b) for a, b in zip(c, c[1:])), len(c)) for c in cuts)


@settings(max_examples=150, deadline=None)
@given(s.text("abc", min_size=1, max_size=9), s.dictionaries(s.text("abc", min_size=1, max_size=4), s.integers(1, 900), max_size=8))
def test_segment_is_the_cheapest_cut(name, counts):
    total = 1000.0
    known = {(i, j - i): log(total / counts[name[i:j]]) for i in range(len(name)) for j in range(i + 1, len(name) + 1) if name[i:j] in counts}
    got = uf.segment(name, known, total)
    assert "".join(got) == name
    at, cost = 0, 0.0
    for w in got:
        cost += known.get((at, len(w)), log(total) + (len(w) - 1) * uf.LETTER)
        at += len(w)
    assert abs(cost - cheapest(name, known, total)[0]) < 1e-9


def test_concatenated_names_are_cut(spark):
    words = uf.word_counts(texts(spark, "green garden green house river", "garden house house blue"))
    hosts = spark.createDataFrame([("www.greengarden-house.example.com",), ("bluehousecasino.net",), ("q" * 70 + ".de",), ("1.2.3.4",)], "host string")
    got = {r.host: r.words for r in uf.host_words(hosts, words).collect()}
    assert got["www.greengarden-house.example.com"][1:4] == ["green", "garden", "house"]
    assert got["bluehousecasino.net"][:3] == ["blue", "house", "casino"]
    assert got["q" * 70 + ".de"][0] == "q" * 70 and "1.2.3.4" not in got


URLS = ["http://a.example.net/en/1?x=/fr/", "HTTP://Shop.NET/x", "https://net/", "https://net", "http://b.example.com/de/2", "http://example.com/DE/2",
        "http://x.org/fr/", "http://org/fr/", "http://xorg/fr/", "://h/p#f", "nothing", None, "", "http://", "http://?q", "ftp://u@H:80/p://q/r",
        "http://example.net/en", "http://EXAMPLE.net/en/\nx?y", "http://köln.example.org/straße/ß?z", "a://b://c/d", "http://" + "k" * 9000 + "/" + "p/" * 9000]


def test_rules_and_parts(spark):
    words = uf.word_counts(texts(spark, "the quick shop", None, ""))
    got = {r.page_id: r for r in uf.url_verdicts(pages(spark, URLS), words, URL_RULES).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path = plain_parts(url)
        rule, verdict = plain_rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), url
        assert got[i].verdict == (verdict or "allow")  # no listed host: nothing to learn from


def plain_odds(rows, listed):
    """Naive Bayes with counts in plain dictionaries."""
    count, urls = [Counter(), Counter()], [0, 0]
    for host, path, words in rows:
        if host:
            label = int(bool(set(words or ()) & set(listed)))
            urls[label] += 1
            count[label].update(zlib.crc32(t.encode()) % uf.BUCKETS for t in uf.tokens(words, host, path))
    used = len(count[0] | count[1])

    def share(label, bucket):
        return log(count[label][bucket] + uf.SMOOTHING) - log(sum(count[label].values()) + uf.SMOOTHING * used)
    return [log(urls[1] / urls[0]) + sum(share(1, b) - share(0, b) for b in (zlib.crc32(t.encode()) % uf.BUCKETS for t in uf.tokens(words, host, path)))
            for host, path, words in rows]


def test_bayes_equals_plain_counts(spark):
    urls = [f"http://{h}.example.com/{lang}/{i}" for i in range(30) for lang in ("en", "es")
            for h in ("www.garden-house", "m.casino-win", "riverhouse", "casinowin", "free-win")]
    found = pages(spark, urls + [None, "http://freewin.example.com/es/9"])
    words = uf.word_counts(texts(spark, "garden house river win free win garden", "house"))
    got = uf.url_verdicts(found, words, URL_RULES).orderBy("page_id").collect()
    want = plain_odds([(r.host, r.path, r.words) for r in got], uf.UNWANTED)
    assert all(abs(r.odds - w) < 1e-6 for r, w in zip(got, want))
    assert {r.verdict for r in got if "casino" in r.host} == {"block"}
    assert {r.verdict for r in got if "garden" in r.host or "river" in r.host} == {"allow"}


def test_repeated_and_missing_ids_and_empty(spark):
    words = uf.word_counts(texts(spark, "a"))
    got = uf.url_verdicts(pages(spark, ["http://a.net/x"] * 3, [1, 1, None]), words, URL_RULES).collect()
    assert sorted((r.page_id or 0, r.verdict) for r in got) == [(0, "block"), (1, "block"), (1, "block")]
    assert uf.url_verdicts(pages(spark, []), uf.word_counts(texts(spark).limit(0)), URL_RULES).count() == 0


def test_a_hot_host(spark):
    urls = [f"http://same.example.com/{i}" for i in range(3000)] + [f"http://h{i}x.example.com/{i}" for i in range(1500)]
    got = uf.url_verdicts(pages(spark, urls), uf.word_counts(texts(spark, "same")), URL_RULES)
    assert got.count() == 4500 and got.filter("words[0] = 'same'").count() == 3000
