"""Operator 10: harmonic packing.

Class k of a sequence of `capacity` tokens holds pieces of one length, and k
of them fill a sequence. A document is cut into whole sequences, then into
the largest slot floor(capacity / k) that fits, again and again, until less
than `small` tokens remain; a rest of l tokens joins class floor(capacity / l)
of rests with that length. So the place of a piece follows from its number in
its class: no piece waits for another, and tasks number their pieces on their
own; a small table of counts by (task, class) then shifts the numbers.

At most one sequence of each class, over all tasks, is not full. Their pieces,
fewer than the slots of the classes whatever the input, are packed together
by decreasing length, first fit.

Defined cases: a null or empty text is the end id alone; repeated rows and
repeated or null ids are packed row by row; an empty table packs to nothing;
other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bagwise.llm.bpe import encoder_of
from bagwise.llm.common import TEXTS, id_text, map_rows, slices, written

CAPACITY = 2048
SMALL = 64           # a rest below this many tokens isn't cut further
END_ID = 1           # closes each document

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "part int, number long, ids binary")
PIECES_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                          ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("part", pa.int32()),
                          ("number", pa.int64()), ("ids", pa.binary())])


def cut_lengths(n: int, capacity: int = CAPACITY, small: int = SMALL) -> list[int]:
    """Lengths of the pieces of a document of n tokens, in order."""
    lengths = [capacity] * (n // capacity)
    rest = n % capacity
    while rest >= small:
        lengths.append(capacity // -(-capacity // rest))
        rest -= lengths[-1]
    return lengths + [rest] * (rest > 0)


def cut_rows(tokenizer: str, capacity: int, small: int, end_id: int, keep_ids: bool):
    def run(batches):
        encoder, part = encoder_of(tokenizer), TaskContext.get().partitionId()
        end, numbers = np.array([end_id], "<u4").tobytes(), {}
        for batch, texts in slices(batches):
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode_many(texts)):
                ids, start = ids + end, 0
                for length in cut_lengths(len(ids) // 4, capacity, small):
                    piece = ids[4 * start:4 * (start + length)]
                    number = numbers.get(length, 0)
                    numbers[length] = number + 1
                    rows.append((doc_id, start, length, zlib.crc32(piece), len(ids) // 4, part, number,
                                 piece if keep_ids else None))
                    start += length
            yield pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*rows), PIECES_ARROW)],
                                  schema=PIECES_ARROW)
    return run


def first_fit(left: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """(length, number among the rest, bin, offset) of the pieces that fill no sequence of their class."""
    used: list[int] = []
    out = []
    for length in sorted(left, reverse=True):
        number, at = 0, 0
        while number < left[length]:
            if at == len(used):
                used.append(0)
            if used[at] + length <= capacity:
                out.append((length, number, at, used[at]))
                used[at] += length
                number += 1
            else:
                at += 1
    return out


def harmonic_pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, small: int = SMALL,
                  end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text",
                  keep_ids: bool = True) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    `ids` (little-endian unsigned 32-bit integers) is there if `keep_ids`.
    """
    spark = docs.sparkSession
    pieces = written(map_rows(id_text(docs, id_col, text_col),
                              cut_rows(tokenizer, capacity, small, end_id, keep_ids), PIECES), "pieces", TEXTS)
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = written(counts.withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0))), "shifts")
    # one row for each length that a piece can have: at most `small` rests and capacity / small slots
    totals = {r["length"]: r["n"] for r in shifts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    classes = [(length, capacity // length, n // (capacity // length) * (capacity // length), i)
               for i, (length, n) in enumerate(sorted(totals.items()))]
    fit = first_fit({length: totals[length] - full for length, _, full, _ in classes}, capacity)
    known = spark.createDataFrame(classes, "length long, slots long, full long, class long")
    # fewer rows than slots of all classes (about 10,000 at 2048 and 64), whatever the input
    rest = spark.createDataFrame(fit, "length long, over long, bin long, place long")
    numbered = (pieces.join(shifts.select("length", "part", "shift"), ["length", "part"])
                .join(F.broadcast(known), "length")
                .withColumn("index", F.col("number") + F.col("shift"))
                .withColumn("over", F.when(F.col("index") >= F.col("full"), F.col("index") - F.col("full")))
                .join(F.broadcast(rest), ["length", "over"], "left"))
    stride = len(classes) + 1  # sequence ids of different classes never meet; the last are those of the rest
    out = numbered.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        F.when(F.col("over").isNull(), F.expr("index div slots") * stride + F.col("class"))
        .otherwise(F.col("bin") * stride + len(classes)).alias("sequence_id"),
        F.when(F.col("over").isNull(), (F.col("index") % F.col("slots")) * F.col("length"))
        .otherwise(F.col("place")).alias("offset"), "ids")
    return out if keep_ids else out.drop("ids")
