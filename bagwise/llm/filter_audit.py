"""Filter interaction audit: what each of five filters removes alone, together and in every order.

Every document has a mask of the filters that it fails. The documents of a
part (a language) are counted by mask, and those counts give the removals of
all 32 coalitions of filters: a coalition removes what any of its filters
fails. From the 32 numbers follows all else. A step of an order adds one filter
to the coalition before it, so its counts are differences of two coalitions.
The filters' Shapley values are the solution of a least-squares problem: the
additive game nearest to the removals, each coalition weighted by the Shapley
kernel, with the values adding up to the removal of all filters. Its normal
equations are solved in rationals, so the values are exact.

A document is identical to an earlier one if its text isn't the first of its
digest. The first of each digest is a partially aggregated minimum and the
other cells follow as all less first, so a text that a third of the documents
share needs no join and no task of its own.

Defined cases: null text is empty; a null part is the empty string; rows that
repeat a doc_id count each, and none of them is earlier than the other; rows
without doc_id are earlier than none and have no labels; labels of a doc_id
count if any of its rows has them; an empty table has no parts and no rows.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import permutations
from math import comb

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bagwise.llm.common import map_rows, written

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
FIRST = FILTERS.index("E")   # its bit comes from the whole table, all others from the text


def text_mask(text):
    """The bits of A to D."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    failed = [F.size(words) < 200,
              100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
              100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 3 * F.char_length(text).cast("long"),
              text.rlike("[#$%&*|]")]
    return sum(F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failed))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, digest, mask, good, toxic, parts): a row for each doc_id and text, `parts` with the number of rows."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"))
    rows = rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), text_mask(F.col("text")).alias("mask"))
    rows = (rows.groupBy("doc_id", "digest", "mask", "part").agg(F.count("*").alias("n"))
            .groupBy("doc_id", "digest", "mask").agg(F.collect_list(F.struct("part", "n")).alias("parts")))
    flags = labels.groupBy("doc_id").agg(*(F.max(F.coalesce((F.col(c) == 1), F.lit(False)).cast("long")).alias(name)
                                           for c, name in (("quality", "good"), ("toxic", "toxic"))))
    return (rows.join(flags, "doc_id", "left")
            .select("doc_id", "digest", "mask", "parts", F.coalesce("good", F.lit(0)).cast("long").alias("good"),
                    F.coalesce("toxic", F.lit(0)).cast("long").alias("toxic")))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by the set of filters that they fail, at most 32 rows a part."""
    table = written(judged(docs, labels), "judged")
    fields = ("doc_id", "mask", "good", "toxic", "parts")
    named = table.filter("doc_id is not null")
    firsts = named.groupBy("digest").agg(F.min(F.struct(*fields)).alias("first")).select("first.*")
    # of each digest's documents all fail E but the first
    later = 1 << FIRST
    moved = [named.select(*fields, F.lit(1).alias("sign"), F.lit(later).alias("bit")),
             firsts.select(*fields, F.lit(-1).alias("sign"), F.lit(later).alias("bit")),
             firsts.select(*fields, F.lit(1).alias("sign"), F.lit(0).alias("bit")),
             table.filter("doc_id is null").select(*fields, F.lit(1).alias("sign"), F.lit(0).alias("bit"))]
    every = moved[0].unionByName(moved[1]).unionByName(moved[2]).unionByName(moved[3])
    rows = every.select((F.col("mask") + F.col("bit")).alias("mask"), "good", "toxic", "sign", F.inline("parts"))
    n = F.col("n") * F.col("sign")
    return (rows.groupBy("part", "mask").agg(F.sum(n).alias("n"), F.sum(n * F.col("good")).alias("good"),
                                             F.sum(n * F.col("toxic")).alias("toxic")))


def coalitions(found: DataFrame) -> DataFrame:
    """(part, n, removed, good, toxic): documents, and the removals of all coalitions 0 to 31 as arrays."""
    def tabulated(value):
        return F.array(*(F.sum(F.when(F.col("mask").bitwiseAND(F.lit(c)) != 0, F.col(value)).otherwise(0)) for c in range(ALL + 1)))
    return found.groupBy("part").agg(F.sum("n").alias("n"), tabulated("n").alias("removed"),
                                     tabulated("good").alias("good"), tabulated("toxic").alias("toxic"))


def solved(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """The solution of a regular system, by elimination."""
    rows = [list(row) + [value] for row, value in zip(matrix, right)]
    for i in range(len(rows)):
        pivot = next(k for k in range(i, len(rows)) if rows[k][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for k, row in enumerate(rows):
            if k != i and row[i]:
                rows[k] = [x - row[i] * y for x, y in zip(row, rows[i])]
    return [row[-1] for row in rows]


def shapley(values: list[int], n: int) -> list[Fraction]:
    """Shapley values of the game `values` (by coalition, a bit for each of n players), by constrained least squares.

    Minimise the kernel-weighted squares of v(S) - v(0) - sum of x over S, where
    x adds up to v(all) - v(0): the gradient and the constraint with its
    multiplier are n + 1 linear equations in rationals.
    """
    full = (1 << n) - 1
    matrix = [[Fraction(0)] * (n + 1) for _ in range(n + 1)]
    right = [Fraction(0)] * (n + 1)
    for s in range(1, full):
        size = s.bit_count()
        weight = Fraction(n - 1, comb(n, size) * size * (n - size))
        inside = [i for i in range(n) if s >> i & 1]
        for i in inside:
            right[i] += weight * (values[s] - values[0])
            for j in inside:
                matrix[i][j] += weight
    for i in range(n):
        matrix[i][n] = matrix[n][i] = Fraction(1)
    right[n] = Fraction(values[full] - values[0])
    return solved(matrix, right)[:n]


def step_rows(batches):
    """The steps of all orders of each part."""
    n = len(FILTERS)
    orders = [(order, [FILTERS.index(f) for f in order]) for order in map("".join, permutations(FILTERS))]
    for batch in batches:
        for part in batch.to_pylist():
            removed, good, toxic = part["removed"], part["good"], part["toxic"]
            share = [x * len(orders) for x in shapley(removed, n)]
            out = []
            for order, filters in orders:
                before = 0
                for step, f in enumerate(filters, 1):
                    after = before | 1 << f
                    here = removed[after] - removed[before]
                    out.append((part["part"], order, step, part["n"] - removed[after], here, removed[1 << f] - here,
                                removed[ALL] - removed[ALL ^ 1 << f], good[after] - good[before], toxic[after] - toxic[before], int(share[f])))
                    before = after
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string() if k < 2 else pa.int32() if k == 2 else pa.int64()) for k, c in enumerate(zip(*out))],
                names=[c.split()[0] for c in STEPS.split(", ")])


STEPS = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
         "good_lost long, toxic_lost long, shapley long")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each part, order of the filters and step; `shapley` is the exact value times the number of orders."""
    return map_rows(coalitions(cells(docs, labels)), step_rows, STEPS)


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
  CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
  + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
  + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) THEN 4 ELSE 0 END
  + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
  + CASE WHEN first_id < doc_id THEN 16 ELSE 0 END AS mask
  FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT p.letter || q.letter || r.letter || s.letter || u.letter AS filter_order, [p.bit, q.bit, r.bit, s.bit, u.bit] AS bits
  FROM x p, x q, x r, x s, x u WHERE (p.bit | q.bit | r.bit | s.bit | u.bit) = 31),
i AS (SELECT filter_order, step, bits[step] AS bit, list_sum(bits[1:step - 1])::INT AS before
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
m AS (SELECT part, filter_order, step, bit,
  sum(CASE WHEN (mask & (coalesce(before, 0) | bit)) = 0 THEN n ELSE 0 END) AS kept,
  sum(CASE WHEN (mask & coalesce(before, 0)) = 0 AND (mask & bit) > 0 THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN (mask & coalesce(before, 0)) > 0 AND (mask & bit) > 0 THEN n ELSE 0 END) AS redundant,
  sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN (mask & coalesce(before, 0)) = 0 AND (mask & bit) > 0 THEN good ELSE 0 END) AS good_lost,
  sum(CASE WHEN (mask & coalesce(before, 0)) = 0 AND (mask & bit) > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, i GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM m
"""
