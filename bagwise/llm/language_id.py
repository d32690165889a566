"""Operator 6: language ID by Bayesian evidence fusion.

The posterior of a language is the product of
- the likelihood of the text: hashed letter trigrams, smoothed; as trigrams of
  one text aren't independent, it counts for at most `EVIDENCE` of them;
- the likelihood of the language that the markup declares, and of the address
  suffix, from counts of (value, language of the text) over all rows;
- a prior of the host: its own counts, smoothed by its domain's, smoothed by
  those of all rows (`SMOOTH` rows of the level above each).
All counts are grouped aggregations, partial before the shuffle. A row is
accepted if it has letters, its best language fits it better than even
chances for all trigrams do, and has a posterior of `least` or more.

The trigram model counts all labelled rows, so every language that some row is
labelled with has a class.

Defined cases: null and empty texts and texts without letters are rejected,
with the language that the other evidence favours; null declared languages,
suffixes, hosts and domains are no evidence; repeated rows and repeated or null
ids are judged row by row; without labelled rows all is rejected, without
language; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bagwise.llm.common import TEXTS, map_rows, slices, written

BUCKETS = 1 << 14
EVIDENCE = 150.0     # trigrams that a text's likelihood counts for at most
SMOOTH = 20.0
LEAST = 0.5
LETTERS = np.array([chr(c).isalpha() for c in range(0x250)])


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the texts' letter trigrams, flat, and how many each text has."""
    codes = np.frombuffer("".join(f"  {t.lower()}  " for t in texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    lengths = np.array([len(t.lower()) + 4 for t in texts], np.int64)
    letter = (codes >= 0x250) | LETTERS[np.minimum(codes, 0x24F).astype(np.int64)]
    codes = np.where(letter, codes, np.uint64(32))
    owner = np.repeat(np.arange(len(texts)), lengths)[:max(0, len(codes) - 2)]
    grams = (codes[:-2] * np.uint64(0x9E3779B97F4A7C15) + codes[1:-1] * np.uint64(0xBF58476D1CE4E5B9) + codes[2:] * np.uint64(0x94D049BB133111EB))
    keep = letter[1:-1]  # around a letter: never over two texts
    return (grams[keep] >> np.uint64(50)).astype(np.int64), np.bincount(owner[keep], minlength=len(texts))


def count_rows(batches):
    for batch, texts in slices(batches):
        labels = batch.column(batch.schema.get_field_index("label")).to_pylist()
        grams, counts = trigrams(texts)
        owner = np.repeat(np.arange(len(texts)), counts)
        for label in sorted(set(labels)):
            own = np.bincount(grams[np.array([x == label for x in labels])[owner]], minlength=BUCKETS)
            some = np.flatnonzero(own)
            yield pa.record_batch([pa.array([label] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(own[some], pa.int64())],
                                  names=["label", "bucket", "n"])


def fitted(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages, and their log probabilities of each bucket; from (doc_id, text, label)."""
    some = labelled.filter("label is not null").select("text", "label")
    counted = written(map_rows(some, count_rows, "label string, bucket int, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n")),
                      "trigrams", TEXTS)
    counts = counted.toArrow()  # languages x BUCKETS at most
    labels = sorted(set(counts["label"].unique().to_pylist()))
    table = np.full((BUCKETS, len(labels)), 0.1)
    if labels:
        at = pc.index_in(counts["label"], pa.array(labels, pa.string())).to_numpy()
        table[counts["bucket"].to_numpy(), at] += counts["n"].to_numpy()
    return labels, np.log(table / table.sum(axis=0))


def likelihood_rows(table: np.ndarray):
    """Appends the number of trigrams and each language's log likelihood of a trigram, on average."""
    def run(batches):
        for batch, texts in slices(batches):
            grams, counts = trigrams(texts)
            total = np.zeros((len(texts), table.shape[1]))
            some = np.flatnonzero(counts)
            if len(some):
                starts = np.concatenate([[0], np.cumsum(counts)[:-1]])[some]
                total[some] = np.add.reduceat(table[grams], starts, axis=0) / counts[some][:, None]
            at = batch.schema.get_field_index("text")
            rest = batch.remove_column(at)
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(counts, pa.int64()), pa.array(list(total), pa.list_(pa.float64()))],
                                             names=[*rest.schema.names, "grams", "likelihood"])
    return run


def added(arrays: list[Column], size: int) -> Column:
    return F.array(*(sum((F.coalesce(a[i], F.lit(0.0)) for a in arrays), F.lit(0.0)) for i in range(size)))


def languages(rows: DataFrame, labelled: DataFrame, least: float = LEAST) -> DataFrame:
    """(doc_id, declared, host, language, posterior, accepted) of each row.

    rows: (doc_id, text, declared, suffix, host, domain); labelled: (doc_id, text, label).
    """
    names, table = fitted(labelled)
    if not names:
        return rows.select("doc_id", "declared", "host", F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("posterior"),
                           F.lit(False).alias("accepted"))
    size = len(names)
    kinds = ["declared", "suffix", "host", "domain"]
    rows = rows.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), *(F.col(k).cast("string") for k in kinds))
    judged = written(map_rows(rows, likelihood_rows(table), "doc_id long, declared string, suffix string, host string, domain string, "
                              "grams long, likelihood array<double>"), "likelihoods", TEXTS)
    best = F.array_position("likelihood", F.array_max("likelihood")).cast("int") - 1
    known = judged.filter("grams > 0").withColumn("best", best)
    numbers = [F.sum((F.col("best") == i).cast("double")) for i in range(size)]
    overall = known.agg(*numbers).first()
    total = sum(x or 0.0 for x in overall)
    shares = [((x or 0.0) + 1) / (total + size) for x in overall]

    def counts(kind: str) -> DataFrame:
        also = [F.min("domain").alias("above")] if kind == "host" else []
        return known.filter(F.col(kind).isNotNull()).groupBy(kind).agg(F.array(*numbers).alias("n"), *also)

    def smoothed(n: Column, above: list[Column]) -> Column:
        held = sum((n[i] for i in range(size)), F.lit(0.0))
        return F.array(*((n[i] + SMOOTH * above[i]) / (held + SMOOTH) for i in range(size)))

    def likelihoods(kind: str) -> DataFrame:
        """log P(value | language), up to a constant: how much more often than the language's share."""
        one = smoothed(F.col("n"), [F.lit(s) for s in shares])
        return counts(kind).select(kind, F.array(*(F.log(one[i] / shares[i]) for i in range(size))).alias(f"{kind}_log"))

    domains = counts("domain").select("domain", smoothed(F.col("n"), [F.lit(s) for s in shares]).alias("p"))
    level = F.coalesce("p", F.array(*map(F.lit, shares)))
    hosts = (counts("host").join(domains.withColumnRenamed("domain", "above"), "above", "left")
             .select("host", smoothed(F.col("n"), [level[i] for i in range(size)]).alias("host_p")))
    joined = (judged.join(likelihoods("declared"), "declared", "left").join(likelihoods("suffix"), "suffix", "left")
              .join(domains, "domain", "left").join(hosts, "host", "left"))
    prior = F.coalesce("host_p", level)
    weight = F.least(F.col("grams").cast("double"), F.lit(EVIDENCE))
    logs = added([F.transform("likelihood", lambda x: x * weight), F.col("declared_log"), F.col("suffix_log"), F.transform(prior, lambda x: F.log(x))], size)
    scored = joined.withColumn("logs", logs).withColumn("most", F.array_max("logs"))
    chosen = F.array_position("logs", F.col("most")).cast("int")
    posterior = 1 / F.aggregate("logs", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("most")))
    fits = F.element_at("likelihood", chosen) > math.log(1 / BUCKETS)
    return (scored.withColumn("posterior", posterior)
            .select("doc_id", "declared", "host", F.element_at(F.array(*map(F.lit, names)), chosen).alias("language"), "posterior",
                    ((F.col("grams") > 0) & fits & (F.col("posterior") >= least)).alias("accepted")))


def labelled_documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), F.lower("lang").alias("label"))


def page_evidence(pages: DataFrame) -> DataFrame:
    """The evidence of raw web pages (page_id, url, html)."""
    host = F.lower(F.regexp_extract("url", "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    text = F.regexp_replace(F.regexp_replace("html", "(?is)<(script|style)\\b.*?</\\1>", " "), "<[^>]*>", " ")
    declared = F.lower(F.regexp_extract("html", "(?i)<html[^>]*\\blang=[\"']?([a-z]{2,3})", 1))

    def known(c: Column) -> Column:
        return F.when(c != "", c)
    return pages.select(F.col("page_id").alias("doc_id"), text.alias("text"), known(declared).alias("declared"),
                        known(F.regexp_extract(host, "\\.([a-z]+)$", 1)).alias("suffix"), known(host).alias("host"),
                        known(F.regexp_extract(host, "([^.]+\\.[^.]+)$", 1)).alias("domain"))


def document_evidence(docs: DataFrame) -> DataFrame:
    """The evidence of documents (doc_id, text, lang, source): the source stands for the host."""
    return docs.select("doc_id", "text", F.lower("lang").alias("declared"), F.lit(None).cast("string").alias("suffix"),
                       F.col("source").alias("host"), F.lit(None).cast("string").alias("domain"))
