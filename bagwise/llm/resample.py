"""Target-distribution importance resampling on hashed runs of words.

The features of a text are its runs of consecutive words, hashed into buckets by
CRC-32. The buckets' shares in a target table against those in all documents
give each bucket a gain, a document weighs the sum of the gains of its features,
and the documents of the highest weights plus Gumbel noise are drawn: a sample
without replacement in proportion to the importance weights.

CRCs are computed for a slice of texts at once. Its distinct features are grouped
by their length in bytes; those of one length form a two-dimensional array of
bytes, whose CRCs are all updated column by column, and the buckets are then put
back to the features' places. A feature of over `COLUMNS` bytes has no others of
its length to share the columns with and is given to zlib whole: the same CRC.

Bucket counts and gains are the only things that pass through the driver: as
many numbers as there are buckets, a parameter.

Defined cases: null text has no words; a document without words weighs 0 and is
drawn only if no words are asked for; each row counts, also where it repeats a
doc_id; rows without doc_id hash as if it were empty and come after all others
of their score; an empty target table leaves gains by the documents alone; an
empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bagwise.llm.common import id_text, map_rows, slices, written
from bagwise.operators.rank import ranked

COLUMNS = 1 << 10     # longer features go to zlib: the same CRC
NOISE = 1 << 32

# A-Z to a-z; digits, a-z and all bytes of characters beyond ASCII stay; the rest separates words
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def crc_table() -> np.ndarray:
    """The CRC-32 of each byte: eight shifts, each with the polynomial where a one falls out."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


CRC = crc_table()


def crcs(features: list[bytes]) -> np.ndarray:
    """CRC-32 of every feature, by matrices of equal length."""
    lengths = np.fromiter(map(len, features), np.int64, len(features))
    out = np.zeros(len(features), np.uint32)
    order = np.argsort(lengths, kind="stable")
    edges = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
    for low, high in zip(edges, edges[1:]):
        own = order[low:high]
        length = int(lengths[own[0]])
        if length > COLUMNS:
            out[own] = [zlib.crc32(features[i]) for i in own]
            continue
        matrix = np.frombuffer(b"".join([features[i] for i in own]), np.uint8).reshape(len(own), length)
        crc = np.full(len(own), 0xFFFFFFFF, np.uint32)
        for column in matrix.T:
            crc = CRC[(crc ^ column) & np.uint32(255)] ^ (crc >> np.uint32(8))
        out[own] = ~crc
    return out


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def runs(found: list[bytes], longest: int) -> list[bytes]:
    """All runs of 1 to `longest` consecutive words, joined by a space."""
    out = list(found)
    for size in range(2, longest + 1):
        out += map(b" ".join, zip(*(found[k:] for k in range(size))))
    return out


def hashed(texts: list[str], longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """The bucket of every feature of all texts, in order, the features' number in each text, and its words'."""
    index: dict[bytes, int] = {}
    places, n_features, n_words = [], [], []
    for text in texts:
        found = words(text)
        features = runs(found, longest)
        n_words.append(len(found))
        n_features.append(len(features))
        places += [index.setdefault(f, len(index)) for f in features]
    bucket = (crcs(list(index)) % np.uint32(buckets)).astype(np.int64)
    return bucket[np.array(places, np.int64)], np.array(n_features, np.int64), n_words


def count_rows(longest: int, buckets: int):
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for _, texts in slices(batches):
            total += np.bincount(hashed(texts, longest, buckets)[0], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])
    return run


def bucket_counts(rows: DataFrame, longest: int, buckets: int) -> list[int]:
    """Features of the whole table in each bucket: one number a bucket reaches the driver."""
    counts = map_rows(rows, count_rows(longest, buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect()
    out = [0] * buckets
    for bucket, n in counts:
        out[bucket] = n
    return out


def gains(source: list[int], target: list[int]) -> list[int]:
    """Thousandths of the log ratio of the smoothed shares in the target and in the source."""
    n, s, t = len(source), sum(source), sum(target)
    return [math.floor(1000 * math.log((b + 1) * (s + n) / ((a + 1) * (t + n)))) for a, b in zip(source, target)]


def weight_rows(gain: np.ndarray, longest: int):
    def run(batches):
        for batch, texts in slices(batches):
            bucket, n_features, n_words = hashed(texts, longest, len(gain))
            upto = np.concatenate([[0], np.cumsum(gain[bucket])])
            ends = np.cumsum(n_features)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_features),
                                              pa.array(upto[ends] - upto[ends - n_features])],
                                             names=["doc_id", "n_words", "n_features", "weight"])
    return run


def importance_resample(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, least_words: int = 20,
                        percent: int = 10, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row; those drawn have a rank.

    Of the documents of `least_words` words or more, `percent` in 100 are drawn.
    """
    rows = id_text(docs, id_col, text_col)
    aims = target.select(F.lit(None).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    gain = np.array(gains(bucket_counts(rows, longest, buckets), bucket_counts(aims, longest, buckets)), np.int64)
    weighed = map_rows(rows, weight_rows(gain, longest), "doc_id long, n_words long, n_features long, weight long")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / NOISE)))
    scored = weighed.select("doc_id", "n_features", "weight", (F.col("weight") + noise).alias("score"),
                            (F.col("n_words") >= least_words).alias("open"))
    table = written(ranked(scored, [F.desc("open"), F.desc("score"), F.asc_nulls_last("doc_id")], "place"), "places")
    drawn = percent * table.filter("open").count() // 100
    return table.select("doc_id", "n_features", "weight", "score", F.when(F.col("place") <= drawn, F.col("place")).alias("rank"))


SQL = r"""
WITH tab AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc
  FROM (SELECT unnest(range(256)) AS i)),
low AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
aim AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
one AS (SELECT doc_id, unnest(words) AS word FROM low),
dist AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM one UNION SELECT word FROM aim)),
bytes AS (SELECT word, list_transform(range(0, len(h) // 2), lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS INT), 2) AS BIGINT)) AS b FROM dist),
buck AS (SELECT word, xor(list_reduce(list_prepend(4294967295, b),
    lambda c, x: xor(c >> 8, tab.crc[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM bytes, tab),
src AS (SELECT bucket, count(*) AS s FROM one JOIN buck USING (word) GROUP BY bucket),
tgt AS (SELECT bucket, count(*) AS t FROM aim JOIN buck USING (word) GROUP BY bucket),
tot AS (SELECT (SELECT count(*) FROM one) AS s_all, (SELECT count(*) FROM aim) AS t_all),
gain AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (s_all + 10000) / ((s + 1.0::DOUBLE) * (t_all + 10000)))) AS BIGINT) AS g
  FROM src LEFT JOIN tgt USING (bucket), tot),
w AS (SELECT doc_id, sum(g) AS g FROM one JOIN buck USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (SELECT low.doc_id, CAST(len(words) AS BIGINT) AS n_features, CAST(coalesce(g, 0) AS BIGINT) AS weight,
    CAST(coalesce(g, 0) AS BIGINT) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || low.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
    / 4294967296))) AS BIGINT) AS score FROM low LEFT JOIN w USING (doc_id)),
place AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS p FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN p <= 10 * (SELECT count(p) FROM place) // 100 THEN p END AS rank FROM place
"""
