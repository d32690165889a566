"""URL filters: rules, and behind them naive Bayes over segmented hosts and paths.

A rule is a verdict with a host and a path; it fits its host and all subdomains
where the url's path starts with the rule's, and of those that fit the longest
holds. All other urls get the verdict of a multinomial naive Bayes over their
tokens. Host names run words together, so a name (a run of letters) is cut into
words first: the unigram Viterbi path, where a word costs the negative logarithm
of its share in a table of word counts and a piece that isn't in it costs more
with each letter. All cuts of a name are considered.

The classes are learned from the urls themselves: a url counts as unwanted if a
word of its segmented host is on a list (`UNWANTED`, a parameter), and as wanted
otherwise. The list alone decides nothing; a listed word weighs as much as the
urls say, and so does any other word that goes with it. Tokens are counted in
hashed buckets, so the model has a fixed size whatever the number of urls.

Names go to the word table by their substrings, which are joined to it by value:
no task holds the word table. Joins on host, name and substring treat the keys
that many rows share apart (`operators.joins.join_hot`).

Defined cases: a null url, and one without `://`, has an empty host and path, no
tokens and the verdict of the prior; rules never fit an empty host; a rule's path
starts with `/`, so it doesn't fit an empty path; a letter run of over 63
characters (the most that a host label may have) is one word; each row counts,
also where it repeats a page_id; without any listed host all verdicts are allow;
an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bagwise.llm.common import map_rows, written
from bagwise.operators.joins import join_hot

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NAME = r"[a-z[^\x00-\x7F]]+"
LABEL = 63            # characters of a host label at most
BUCKETS = 1 << 16     # of the classifier's tokens
SMOOTHING = 0.1
LISTED = 1e-5         # share that a listed word has at least among all words
LETTER = log(10)      # what a letter of an unknown piece costs

#: Words of hosts that mostly aren't wanted. Fixed values.
UNWANTED = ("ads", "adult", "bets", "betting", "casino", "casinos", "cheap", "clickbait", "escort", "gambling", "jackpot", "keygen",
            "loans", "lottery", "pills", "poker", "porn", "replica", "slots", "spam", "torrent", "tracker", "viagra", "warez", "xxx")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (after the first `://`, A-Z lower-cased) and path."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; the first of equal length."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, rule in sorted(rules, key=lambda r: len(r[1])):
        rule_host, slash, rule_path = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rule_path)
        longer = name.isNull() | (F.length(name) < len(rule))
        name, verdict = F.when(fits & longer, F.lit(rule)).otherwise(name), F.when(fits & longer, F.lit(action)).otherwise(verdict)
    return name, verdict


def word_counts(docs: DataFrame, listed: tuple[str, ...] = UNWANTED) -> DataFrame:
    """(word, n, total) of all texts, A-Z lower-cased; listed words have `LISTED` of all at least."""
    words = (docs.select(F.explode(F.regexp_extract_all(lower_ascii(F.coalesce("text", F.lit(""))), F.lit(NAME), F.lit(0))).alias("word"))
             .groupBy("word").agg(F.count("*").alias("n")))
    table = written(words, "words")
    total = table.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] + 1
    least = max(1, round(LISTED * total))
    more = docs.sparkSession.createDataFrame([(w, least) for w in listed], "word string, n long")
    return (table.filter(F.length("word") <= LABEL).unionByName(more)
            .groupBy("word").agg(F.max("n").alias("n"), F.lit(total).alias("total")))


def segment(name: str, known: dict[tuple[int, int], float], total: float) -> list[str]:
    """The cheapest cut of `name`: `known` has the costs of its words by start and length, all other pieces cost by length.

    Of equal cuts the one with fewer pieces, then the longer last piece.
    """
    best: list[tuple[float, int, int]] = [(0.0, 0, 0)]
    for end in range(1, len(name) + 1):
        best.append(min((best[start][0] + known.get((start, end - start), log(total) + (end - start - 1) * LETTER),
                         best[start][1] + 1, start) for start in range(end)))
    out, end = [], len(name)
    while end:
        out.append(name[best[end][2]:end])
        end = best[end][2]
    return out[::-1]


def segment_rows(total: float):
    def run(batches):
        for batch in batches:
            names, cuts = batch.column(0).to_pylist(), []
            for name, found in zip(names, batch.column(1).to_pylist()):
                known = {(w["start"], w["length"]): log(total / w["n"]) for w in found or ()}
                cuts.append(segment(name, known, total) if len(name) <= LABEL else [name])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(cuts, pa.list_(pa.string()))], names=["name", "words"])
    return run


def segmented(names: DataFrame, words: DataFrame) -> DataFrame:
    """(name, words) of a table of distinct names."""
    starts = F.explode(F.sequence(F.lit(0), F.length("name") - 1)).alias("start")
    each = names.filter(F.length("name") <= LABEL).select("name", starts)
    lengths = F.explode(F.sequence(F.lit(1), F.length("name") - F.col("start"))).alias("length")
    parts = written(each.select("name", "start", lengths)
                    .withColumn("word", F.substring(F.col("name"), F.col("start") + 1, F.col("length"))), "substrings")
    total = words.agg(F.max("total")).first()[0] or 1
    found = (join_hot(parts, words.select("word", "n"), "word").groupBy("name")
             .agg(F.collect_list(F.struct("start", "length", "n")).alias("found")))  # of 63 letters: 2016 at most
    return map_rows(names.join(found, "name", "left").select("name", "found"), segment_rows(float(total)), "name string, words array<string>")


def host_words(hosts: DataFrame, words: DataFrame) -> DataFrame:
    """(host, words): the words of a host's names, in order, of a table of distinct hosts."""
    names = written(hosts.select("host", F.posexplode(F.regexp_extract_all("host", F.lit(NAME), F.lit(0))).alias("at", "name")), "names")
    cuts = written(segmented(names.select("name").distinct(), words), "cuts")
    return (join_hot(names, cuts, "name").groupBy("host")
            .agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "words"))), lambda x: x["words"])).alias("words")))


TOKEN = re.compile(r"[a-z0-9]+|[^\x00-\x7F]+")
DIGITS = re.compile("[0-9]+")
TO_LOWER = {ord(a): b for a, b in zip(UPPER, LOWER)}


def tokens(words: list[str] | None, host: str, path: str) -> list[str]:
    """Tokens of the classifier: host words, and the path's runs with each number as one digit."""
    out = [f"host {w}" for w in words or ()] + ["host 0"] * len(DIGITS.findall(host))
    return out + [f"path {DIGITS.sub('0', t)}" for t in TOKEN.findall(path.translate(TO_LOWER))]


def buckets(found: list[str]) -> np.ndarray:
    return np.array([zlib.crc32(t.encode("utf-8", "surrogatepass")) % BUCKETS for t in found], np.int64)


def count_rows(listed: frozenset[str]):
    """(bucket, unwanted, n); bucket -1 counts urls."""
    def run(batches):
        total = np.zeros((2, BUCKETS + 1), np.int64)
        for batch in batches:
            for words, host, path in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if host:
                    unwanted = int(not listed.isdisjoint(words or ()))
                    np.add.at(total[unwanted], buckets(tokens(words, host, path)), 1)
                    total[unwanted, BUCKETS] += 1
        unwanted, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.where(bucket == BUCKETS, -1, bucket)), pa.array(unwanted), pa.array(total[unwanted, bucket])],
                                         names=["bucket", "unwanted", "n"])
    return run


class Bayes:
    """Log odds of unwanted against wanted: a prior and a weight for each bucket."""

    def __init__(self, counts: list[tuple[int, int, int]]):
        table, urls = np.zeros((2, BUCKETS)), [0, 0]
        for bucket, unwanted, n in counts:
            if bucket < 0:
                urls[unwanted] = n
            else:
                table[unwanted, bucket] = n
        self.known = min(urls) > 0
        self.prior = log(urls[1] / urls[0]) if self.known else 0.0
        used = max(1, np.count_nonzero(table.sum(0)))
        share = np.log(table + SMOOTHING) - np.log(table.sum(1, keepdims=True) + SMOOTHING * used)
        self.weights = share[1] - share[0]

    def odds(self, found: list[str]) -> float:
        return float(self.prior + self.weights[buckets(found)].sum()) if self.known else -1.0


def verdict_rows(model: Bayes):
    def run(batches):
        for batch in batches:
            odds = [model.odds(tokens(*row)) for row in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist()
                                                              for c in ("words", "host", "path")))]
            said = [v or ("block" if o > 0 else "allow") for v, o in zip(batch.column(batch.schema.get_field_index("verdict")).to_pylist(), odds)]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("page_id", "host", "path", "rule")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(said, pa.string()), pa.array(odds, pa.float64()),
                                              batch.column(batch.schema.get_field_index("words"))],
                                             names=["page_id", "host", "path", "rule", "verdict", "odds", "words"])
    return run


def url_verdicts(pages: DataFrame, words: DataFrame, rules: list[tuple[str, str]], listed: tuple[str, ...] = UNWANTED,
                 id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, odds, words) of every row.

    `words`: (word, n, total) as `word_counts` gives it. `odds`: the
    classifier's log odds of unwanted, also where a rule decides; `words`: the
    host's.
    """
    host, path = url_parts(F.col(url_col))
    split = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    name, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    urls = written(split.select("page_id", "host", "path", name.alias("rule"), verdict.alias("verdict")), "urls")
    hosts = urls.filter("host != ''").select("host").distinct()
    cut = written(host_words(hosts, words), "hosts")
    table = written(join_hot(urls, cut, "host", "left"), "urls")
    counts = (map_rows(table.select("words", "host", "path"), count_rows(frozenset(listed)), "bucket long, unwanted long, n long")
              .groupBy("bucket", "unwanted").agg(F.sum("n")).collect())  # two for each bucket at most
    return map_rows(table, verdict_rows(Bayes(sorted(map(tuple, counts)))),
                    "page_id long, host string, path string, rule string, verdict string, odds double, words array<string>")
