import zlib

from pyspark.sql import functions as F

import corpus_pipeline
from bagwise.llm import language_id, toxicity
from tests.llm.conftest import frame, prose

INSULTS = ["blockhead", "numbskull", "halfwit"]


def test_toxicity_finds_insults_and_their_misspellings(spark, odd, rng):
    texts, toxic = [], []
    for i in range(600):
        words = prose(rng, rng.choice([20, 80, 300])).split()
        bad = i % 3 == 0
        for _ in range(3 * bad):
            words[rng.randrange(len(words))] = rng.choice(INSULTS)
        texts.append(" ".join(words))
        toxic.append(int(bad))
    texts += ["you are a blockheads and a numbskul here, said the old man in the garden", "the river under the bright window"]
    docs = frame(spark, texts).unionAll(odd.withColumn("doc_id", F.col("doc_id") + 5000))
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int").withColumn("text", F.lit("x"))
    got = toxicity.toxicity_scores(docs, labels).collect()
    assert len(got) == docs.count()
    by_id = {g.doc_id: g for g in got}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(by_id[i].held_out for i in held) and sum(g.held_out for g in got if g.doc_id is not None and g.doc_id < 600) == len(held)
    right = sum((by_id[i].score >= 0.3) == bool(toxic[i]) for i in held)
    assert right >= 0.97 * len(held)
    assert by_id[600].score >= 0.3 > by_id[601].score
    assert all(0 <= g.score <= 1 for g in got) and by_id[5000].score == 0
    assert toxicity.toxicity_scores(docs.limit(0), labels).count() == 0
    assert max(g.score for g in toxicity.toxicity_scores(docs, labels.limit(0)).collect()) < 1e-9


FRENCH = "le la les une des avec pour dans rivière fenêtre maison était toujours jardin lumière".split()


def test_language_evidence(spark, rng):
    def french(n):
        return " ".join(rng.choice(FRENCH) for _ in range(n))
    train = [(i, prose(rng, 60) if i % 2 else french(60), "en" if i % 2 else "fr") for i in range(200)]
    labelled = spark.createDataFrame(train, "doc_id long, text string, label string")
    rows = [(i, french(40) if i % 3 == 0 else prose(rng, 40), "fr" if i % 3 == 0 else "en", "fr" if i % 3 == 0 else "com",
             "h.site.fr" if i % 3 == 0 else "h.site.com", "site.fr" if i % 3 == 0 else "site.com") for i in range(120)]
    rows += [(500, "", "fr", "fr", "h.site.fr", "site.fr"), (501, None, None, None, None, None), (502, "12345 !!", None, None, None, None),
             (503, french(50), "en", "com", "h.site.com", "site.com"), (504, "la", "fr", "fr", "new.site.fr", "site.fr"),
             (None, prose(rng, 30), "en", None, None, None), (3, french(40), "fr", "fr", "h.site.fr", "site.fr")]
    df = spark.createDataFrame(rows, "doc_id long, text string, declared string, suffix string, host string, domain string")
    got = language_id.languages(df.withColumn("n", F.lit("x")), labelled).collect()
    assert len(got) == len(rows)
    by_id = {g.doc_id: g for g in got}
    assert all(by_id[i].language == ("fr" if i % 3 == 0 else "en") and by_id[i].accepted for i in range(120))
    assert not any(by_id[i].accepted for i in (500, 501, 502)) and by_id[500].language == "fr"
    assert by_id[503].language == "fr" and by_id[504].language == "fr"  # a long text outweighs the rest; a short one needs it
    assert language_id.languages(df.limit(0), labelled).count() == 0
    assert not any(g.accepted for g in language_id.languages(df, labelled.limit(0)).collect())


def test_pages(spark):
    pages = spark.createDataFrame([(1, "https://u@Blog.Site.example.FR:80/x?y", "<!DOCTYPE html><html class=a lang='fr-CA'><script>var x='<p>'</script><p>bon</p>"),
                                   (2, None, None), (3, "nonsense", "plain")], "page_id long, url string, html string")
    got = {r.doc_id: r for r in language_id.page_evidence(pages).collect()}
    assert (got[1].declared, got[1].suffix, got[1].host, got[1].domain) == ("fr", "fr", "blog.site.example.fr", "example.fr")
    assert "var" not in got[1].text and "bon" in got[1].text
    assert got[2].host is None and got[3].suffix is None


def test_pipeline_stages(spark, rng, tmp_path):
    base = [prose(rng, 80) for _ in range(12)]
    texts = base + [base[0], base[1] + " one more", base[2] + "\n" + base[3], "call +1 (766) 555-7744 " + prose(rng, 60), None, "", "12345"]
    docs = frame(spark, texts)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    columns, seen = docs.columns, {}
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, str(tmp_path))
        if name != "packing":
            assert now.columns == columns
            now = corpus_pipeline.written(now, name)
        seen[name] = now
    kept = {r.doc_id for r in seen["language"].collect()}
    assert kept == set(range(16))  # texts without letters go
    assert 12 not in {r.doc_id for r in seen["lines"].collect()}
    last = {r.doc_id: r.text for r in seen["personal_data"].collect()}
    assert set(last) == set(range(12)) | {15} and "[phone]" in last[15] and "555" not in last[15]
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(run.collect()) == sorted(seen["packing"].collect())
    assert {r.doc_id for r in run.collect()} == set(last)


def test_rare_language_has_a_class(spark, rng):
    """One row in about 4500 is labelled with it; a sample of 4000 rows would miss most of them."""
    greek = "η γάτα κοιμάται στον κήπο κάτω από το παράθυρο".split()
    rows = [(i, " ".join(rng.choice(greek) for _ in range(30)) if i % 4500 == 0 else prose(rng, 5), "el" if i % 4500 == 0 else "en") for i in range(9000)]
    rows += [(9000, "one row alone", "xx")]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, label string")
    names, table = language_id.fitted(labelled)
    assert names == ["el", "en", "xx"] and table.shape == (language_id.BUCKETS, 3)
    some = spark.createDataFrame([(1, " ".join(rng.choice(greek) for _ in range(30)))], "doc_id long, text string")
    some = some.selectExpr("*", *(f"cast(null as string) {c}" for c in ("declared", "suffix", "host", "domain")))
    got = language_id.languages(some, labelled).first()
    assert got.language == "el" and got.accepted
