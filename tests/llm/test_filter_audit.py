import re
from fractions import Fraction
from itertools import permutations
from math import factorial

from hypothesis import given, settings
from hypothesis import strategies as s

from bagwise.llm import filter_audit as fa
from tests.llm.conftest import frame, prose


@settings(max_examples=60, deadline=None)
@given(s.integers(2, 5).flatmap(lambda n: s.tuples(s.just(n), s.lists(s.integers(-50, 50), min_size=1 << n, max_size=1 << n))))
def test_least_squares_are_the_shapley_values(game):
    n, values = game
    want = [Fraction(0)] * n
    for order in permutations(range(n)):
        seen = 0
        for i in order:
            want[i] += Fraction(values[seen | 1 << i] - values[seen], factorial(n))
            seen |= 1 << i
    assert fa.shapley(values, n) == want


def fails(docs):
    """Per row: part and the letters of the filters that it fails."""
    for i, lang, text in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        found = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
                 "D": bool(re.search("[#$%&*|]", text)), "E": any((t or "") == text and j is not None and i is not None and j < i for j, _, t in docs)}
        yield i, lang or "", {k for k, v in found.items() if v}


def plain(docs, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    rows = list(fails(docs))
    out = {}
    for part in {p for _, p, _ in rows}:
        own = [(i, f) for i, p, f in rows if p == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, x in enumerate(order, 1):
                here = [(i, f) for i, f in left if x in f]
                left = [(i, f) for i, f in left if x not in f]
                total[x] += len(here)
                out[part, "".join(order), step] = [
                    len(left), len(here), sum(x in f for _, f in own) - len(here), sum(f == {x} for _, f in own),
                    sum(i in good for i, _ in here), sum(i in toxic for i, _ in here)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_equals_plain(spark, rng):
    texts = [None, "", "", " \n", "A B C", "a" * 4000, "x\u00a0y # z"]
    texts += [prose(rng, rng.randrange(150, 260)) + rng.choice(["", "", " $", " ABCDEFGHIJKLMNOPQRSTUVWXYZ" * 5]) for _ in range(60)]
    texts += [" ".join(f"w{k}" for k in range(300)), " ".join(f"w{k % 140}" for k in range(300))]
    texts += [texts[20]] * 9 + [texts[68]] * 2
    ids = [*range(len(texts) - 3), 25, 25, None]
    langs = [rng.choice(["en", "fr", None, ""]) for _ in texts]
    docs = frame(spark, texts, ids, langs)
    rows = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 70, 2)] + [(4, 1, 1), (None, 1, 1), (9999, 1, 0)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    got = {tuple(r)[:3]: tuple(r)[3:] for r in fa.filter_audit(docs, labels).collect()}
    assert got == plain([(r.doc_id, r.lang, r.text) for r in docs.collect()], [r for r in rows if r[0] is not None])
    assert len(got) == 600 * 3


def test_empty_and_hot_text(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fa.filter_audit(frame(spark, []), labels).count() == 0
    got = fa.filter_audit(frame(spark, ["same"] * 500), labels).filter("filter_order = 'EABCD'").orderBy("step").collect()
    assert [(r.kept, r.removed) for r in got] == [(1, 499), (0, 1), (0, 0), (0, 0), (0, 0)]
    assert {(r.shapley, r.unique_fails) for r in got if r.step in (1, 2)} == {(60 * 499, 0), (60 * 499 + 120, 1)}
