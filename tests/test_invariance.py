"""Results do not depend on the partitioning of the input."""
from bagwise.operators import prepare, profile
from bagwise.plans import catalog
from conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_top_tokens_per_class_invariant(spark):
    b = catalog.doc_bags(spark, SF_SMALL)
    a = _rows(profile.top_tokens_per_class(b, "lang", 5))
    c = _rows(profile.top_tokens_per_class(b.repartition(3), "lang", 5))
    assert a == c


def test_dedup_invariant(spark):
    b = catalog.doc_bags(spark, SF_SMALL)
    a = sorted(r["doc_id"] for r in prepare.dedup_bags(b, "doc_id").collect())
    c = sorted(r["doc_id"] for r in prepare.dedup_bags(b.repartition(5), "doc_id").collect())
    assert a == c


def test_vocabulary_invariant(spark):
    from bagwise.operators.features import vocabulary
    b = catalog.doc_bags(spark, SF_SMALL)
    assert _rows(vocabulary(b, vocab_size=100)) == _rows(vocabulary(b.repartition(6), vocab_size=100))
