"""Token and bag embeddings from counts (M6).

Skip-gram training passes its whole vocabulary through one process per
partition again and again. The same kind of vectors follow from counts: how
often two tokens stand within a window of each other, the logarithm of that
count against chance, and the leading axes of that sparse symmetric matrix. The
counts are a grouped aggregation, the axes a block power iteration whose steps
are a join and a grouped sum; only Gram matrices, as large as the number of
dimensions squared, reach the driver.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Word2VecModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bagwise.functions.tokens import token_rows
from bagwise.operators.joins import counted_hot_keys, join_hot
from bagwise.operators.rank import ranked
from bagwise.session import discard, materialize, scratch_path

CHUNK = 1 << 16       # tokens of a chunk of the matrix, at most: what a task sums at a time
LEAST = 4096          # tokens of a chunk where there are fewer chunks than cores
SLOT_BITS = 24        # of the bit table that keeps most rare tokens out of the pairs
PAIRS = 1 << 21       # pairs that a task counts at a time
ROWS = 1000           # rows (a vector and weights of a chunk) in a batch for Python
BAGS = 1000           # bags in a batch for Python


def _slots(table: DataFrame) -> bytes:
    """A bit for each of 2 ** SLOT_BITS slots: whether a hash `h` of the table falls there. So many bits at any size."""
    slot = F.col("h").bitwiseAND((1 << SLOT_BITS) - 1)
    held = (table.select(F.shiftright(slot, 12).alias("part"), slot.bitwiseAND(4095).cast("short").alias("at"))
            .groupBy("part").agg(F.collect_set("at").alias("at")).collect())
    bits = np.zeros(1 << SLOT_BITS, bool)
    for part, at in held:
        bits[(part << 12) + np.array(at, np.int64)] = True
    return np.packbits(bits).tobytes()


def _pair_rows(window: int, slots: bytes):
    """Pairs (a, b, n), a <= b, of the hashes within `window` places of each other in a list, if both fall into a slot.

    Pairs are counted `PAIRS` at a time; one that comes again later has another row.
    """
    def run(batches: Iterator[pa.RecordBatch]):
        known, held, size = np.unpackbits(np.frombuffer(slots, np.uint8)).view(bool), [], 0

        def counted():
            a, b = np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held])
            # equal pairs come together; different ones with one key may part them into more rows
            order = np.argsort(a.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.view(np.uint64))
            a, b = a[order], b[order]
            starts = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
            return pa.RecordBatch.from_arrays([pa.array(a[starts]), pa.array(b[starts]), pa.array(np.diff(starts, append=len(a)))], names=["a", "b", "n"])
        for batch in batches:
            lists = batch.column(0)
            edges = lists.offsets.to_numpy()
            hashes = lists.flatten().to_numpy()
            bag = np.repeat(np.arange(len(lists)), np.diff(edges))
            at = np.flatnonzero(known[hashes & ((1 << SLOT_BITS) - 1)])
            hashes, bag = hashes[at], bag[at]
            for step in range(1, min(window, len(at) - 1) + 1):
                near = (at[step:] - at[:-step] <= window) & (bag[step:] == bag[:-step])
                if not near.any():
                    break
                x, y = hashes[:-step][near], hashes[step:][near]
                held.append((np.minimum(x, y), np.maximum(x, y)))
                size += len(x)
                if size >= PAIRS:
                    yield counted()
                    held, size = [], 0
        if size:
            yield counted()
    return run


def _join_counted(big: DataFrame, table: DataFrame, key: str) -> DataFrame:
    return join_hot(big, table, key, hot=counted_hot_keys(big, key))


def hashed_cooccurrence(df: DataFrame, bag_col: str = "tokens", window: int = 5, min_count: int = 5) -> tuple[DataFrame, DataFrame]:
    """`cooccurrence` with tokens as 64-bit hashes and each pair once, token <= context; and the table (h, token) of the hashes.

    A vocabulary in which two tokens share a hash is refused. The many rare
    tokens are mostly left out before they are paired, by a bit table of the
    frequent ones' hashes; those that share a slot go by a join.
    """
    seen = token_rows(df, bag_col).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    words = materialize(seen.where(F.col("n") >= min_count).select(F.xxhash64("token").alias("h"), "token"), "tokens")
    if words.groupBy("h").count().where("count > 1").limit(1).count():
        raise ValueError("two tokens share a hash")
    hashes = df.select(F.transform(bag_col, lambda t: F.xxhash64(t)).alias("x")).where(F.size("x") > 1)
    pairs = hashes.mapInArrow(_pair_rows(window, _slots(words)), "a long, b long, n long")
    counts = materialize(pairs.groupBy("a", "b").agg(F.sum("n").alias("n")), "pairs", BAGS)
    first = materialize(_join_counted(counts, words.select(F.col("h").alias("a")), "a"), "pairs")
    discard(counts)
    known = materialize(_join_counted(first, words.select(F.col("h").alias("b")), "b").select(F.col("a").alias("token"), F.col("b").alias("context"), "n"), "pairs")
    discard(first)
    return known, words


def both_ways(pairs: DataFrame, value: str, of_itself: Column) -> DataFrame:
    """Pairs that stand once as rows from both sides; a token's pair with itself has one row, with the value `of_itself`."""
    same = F.col("token") == F.col("context")
    rows = F.when(same, F.array(F.struct("token", "context", of_itself.alias(value)))).otherwise(
        F.array(F.struct("token", "context", value), F.struct(F.col("context").alias("token"), F.col("token").alias("context"), value)))
    return pairs.select(F.inline(rows))


def named(pairs: DataFrame, words: DataFrame, value: str) -> DataFrame:
    """Hashed pairs (token, context, value) with the tokens of `words` in their hashes' place; `pairs` is a written table."""
    first = materialize(_join_counted(pairs, words.select(F.col("h").alias("token"), F.col("token").alias("_token")), "token")
                        .select(F.col("_token").alias("token"), "context", value), "named")
    return (_join_counted(first, words.select(F.col("h").alias("context"), F.col("token").alias("_context")), "context")
            .select("token", F.col("_context").alias("context"), value))


def cooccurrence(df: DataFrame, bag_col: str = "tokens", window: int = 5, min_count: int = 5) -> DataFrame:
    """(token, context, n): how often `context` stands within `window` places of `token`, both ways.

    Tokens with fewer than `min_count` occurrences are left out of the table
    but keep their places.
    """
    pairs, words = hashed_cooccurrence(df, bag_col, window, min_count)
    # a pair of one token with itself counts once from each side
    return both_ways(named(pairs, words, "n"), "n", 2 * F.col("n"))


def log_ratios(counts: DataFrame, shift: float = 1.0, once: bool = False) -> DataFrame:
    """(token, context, weight): ln(n * all / (n_token * n_context)) - ln(shift), where it is positive.

    `once`: the table has each pair once, not from both sides, and so has the result (`hashed_cooccurrence`).
    """
    counts = counts if hasattr(counts, "_written_to") else materialize(counts, "counts")
    ends, n = counts.select("token", "n"), F.col("n")
    if once:
        ends = ends.union(counts.select("context", "n"))
        n = F.when(F.col("token") == F.col("context"), 2 * n).otherwise(n)
    sums = materialize(ends.groupBy("token").agg(F.sum("n").alias("of_token")), "sums")
    total = sums.agg(F.sum("of_token")).first()[0] or 0
    first = materialize(_join_counted(counts, sums, "token"), "counts")
    both = _join_counted(first, sums.select(F.col("token").alias("context"), F.col("of_token").alias("of_context")), "context")
    ratio = F.log(n * F.lit(float(total)) / (F.col("of_token").cast("double") * F.col("of_context"))) - F.log(F.lit(float(shift)))
    return both.select("token", "context", ratio.alias("weight")).where("weight > 0")


def _start_rows(dims: int):
    """A fixed random vector of each number."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            vectors = [np.random.default_rng(i).standard_normal(dims).tobytes() for i in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vectors, pa.binary())], names=["idx", "vec"])
    return run


def _product_rows(dims: int, chunks: int, tokens: int):
    """Sums of weight times vector for the tokens of the rows (chunk, vec, tokens, weights), which come chunk by chunk.

    A chunk's tokens have a small number each, and a row has each token once.
    """
    def run(batches: Iterator[pa.RecordBatch]):
        total, held, at = np.zeros((tokens // chunks + 1, dims)), np.zeros(tokens // chunks + 1, bool), None

        def sums():
            own = np.flatnonzero(held)
            return pa.RecordBatch.from_arrays([pa.array(own * chunks + at), pa.array([v.tobytes() for v in total[own]], pa.binary())], names=["idx", "vec"])
        for batch in batches:
            vecs = np.frombuffer(b"".join(batch.column(1).to_pylist()), float).reshape(-1, dims)
            edges = batch.column(2).offsets.to_numpy() - batch.column(2).offsets[0].as_py()
            place, weight = batch.column(2).flatten().to_numpy() // chunks, batch.column(3).flatten().to_numpy()[:, None]
            for row, chunk in enumerate(batch.column(0).to_pylist()):
                if chunk != at:
                    if at is not None:
                        yield sums()
                    at = chunk
                    total[:], held[:] = 0, False
                own = place[edges[row]:edges[row + 1]]
                total[own] += weight[edges[row]:edges[row + 1]] * vecs[row]
                held[own] = True
        if at is not None:
            yield sums()
    return run


def _keys_of_partitions(spark, n: int) -> Column:
    """An array of `n` keys, each of which `repartition(n, key)` sends to a partition of its own."""
    place = F.pmod(F.hash("id"), F.lit(n))
    found = spark.range(64 * n + 1024).groupBy(place.alias("place")).agg(F.min("id")).orderBy("place").collect()
    return F.array(*(F.lit(key).cast("long") for _, key in found))


def _gram_rows(dims: int):
    def run(batches: Iterator[pa.RecordBatch]):
        total = np.zeros((dims, dims))
        for batch in batches:
            if batch.num_rows:
                x = np.frombuffer(b"".join(batch.column(0).to_pylist()), float).reshape(-1, dims)
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims * dims)), pa.array(total.ravel())], names=["cell", "value"])
    return run


def _turn_rows(matrix: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if batch.num_rows:
                x = np.frombuffer(b"".join(batch.column(1).to_pylist()), float).reshape(batch.num_rows, -1) @ matrix
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v.tobytes() for v in x], pa.binary())], names=["idx", "vec"])
    return run


def _gram(table: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (descending) and vectors of the sum of outer products; dims * dims numbers reach the driver."""
    cells = (table.select("vec").mapInArrow(_gram_rows(dims), "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect())
    gram = np.zeros(dims * dims)
    for cell, value in cells:
        gram[cell] = value
    values, vectors = np.linalg.eigh(gram.reshape(dims, dims))
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(dims)])
    return values[::-1], vectors[:, ::-1]


def leading_axes(weights: DataFrame, dims: int = 64, rounds: int = 6, words: DataFrame | None = None) -> DataFrame:
    """(token, vector): each token's place on the `dims` leading axes of the symmetric table (token, context, weight).

    Block power iteration: from fixed random vectors, `rounds` times multiply
    by the matrix and orthonormalise by the Gram matrix of the product. The
    last product is turned to its principal axes, each scaled by the square
    root of the size of its eigenvalue. Tokens without an entry have no row.

    A product is summed chunk by chunk of tokens: a vector goes once to each chunk
    that needs it, with its weights there, and a chunk's sums are whole in its task.
    So there are no more chunks than the cores and a task's memory ask for.

    `words`: the table has hashes, each pair once (`hashed_cooccurrence`), and these are their tokens.
    """
    weights = materialize(weights, "weights")
    if words is None:
        names = weights.select("token").distinct().withColumn("key", F.col("token"))
    else:
        ends = weights.select(F.col("token").alias("h")).union(weights.select("context")).distinct()
        names = words.join(ends, "h").select("token", F.col("h").alias("key"))
    numbered = materialize(ranked(names, [F.asc("token")], "idx"), "numbers")
    n = numbered.count()
    spark = weights.sparkSession
    chunks = max(1, -(-n // CHUNK), min(spark.sparkContext.defaultParallelism, n // LEAST))
    keys = _keys_of_partitions(spark, chunks)
    number = numbered.select(F.col("key").alias("token"), "idx")
    first = materialize(_join_counted(weights, number, "token").select(F.col("idx").alias("t"), F.col("context").alias("token"), "weight"), "weights")
    discard(weights)
    entries = _join_counted(first, number, "token").select("idx", "t", "weight")
    if words is not None:
        entries = both_ways(entries.toDF("token", "context", "weight"), "weight", F.col("weight")).toDF("idx", "t", "weight")
    matrix = materialize(entries.withColumn("t", F.col("t").cast("int")).groupBy("idx", (F.col("t") % chunks).alias("chunk"))
                         .agg(F.collect_list("t").alias("tokens"), F.collect_list("weight").alias("weights")), "matrix")
    discard(first)
    schema = "idx long, vec binary"
    block = materialize(numbered.select("idx").mapInArrow(_start_rows(dims), schema), "block")
    for k in range(rounds):
        part = (matrix.join(block, "idx").select("chunk", "vec", "tokens", "weights").repartition(chunks, F.element_at(keys, F.col("chunk") + 1))
                .sortWithinPartitions("chunk").mapInArrow(_product_rows(dims, chunks, n), schema))
        product = materialize(part, "product", ROWS)
        discard(block)
        values, vectors = _gram(product, dims)
        kept = values > 1e-12 * max(values[0], 1e-300)
        power = -0.25 if k == rounds - 1 else -0.5   # the product's Gram values are the squares of the matrix's
        scale = np.where(kept, np.where(kept, values, 1.0) ** power, 0.0)
        block = product.mapInArrow(_turn_rows(vectors * scale), schema)
        if k < rounds - 1:
            block = materialize(block, "block")
            discard(product)
    discard(matrix)
    vectors = block.mapInArrow(_float_rows, "idx long, vector array<float>")
    return numbered.join(vectors, "idx").select("token", "vector")


def _float_rows(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([np.frombuffer(v, float).astype(np.float32) for v in batch.column(1).to_pylist()],
                                                                    pa.list_(pa.float32()))], names=["idx", "vector"])


def count_embeddings(df: DataFrame, bag_col: str = "tokens", dims: int = 64, window: int = 5, min_count: int = 5,
                     shift: float = 1.0, rounds: int = 6) -> DataFrame:
    """(token, vector) of all tokens with `min_count` occurrences and a positive log ratio with some other."""
    pairs, words = hashed_cooccurrence(df, bag_col, window, min_count)
    return leading_axes(log_ratios(pairs, shift, once=True), dims, rounds, words)


def embedding_model(vectors: DataFrame, bag_col: str, out: str = "features") -> Word2VecModel:
    """A table (token, vector) as MLlib's embedding stage: a bag is the mean of its tokens' vectors.

    The table is written in the model's own format and loaded, so it never
    passes through Python. MLlib holds a loaded model's vectors on the driver
    and ships them to the tasks, as it does with its own.
    """
    spark = vectors.sparkSession
    path = scratch_path(spark, "embedding")
    vectors.select(F.col("token").alias("word"), "vector").write.parquet(f"{path}/data")
    size = spark.read.parquet(f"{path}/data").select(F.max(F.size("vector"))).first()[0] or 0
    meta = {"class": "org.apache.spark.ml.feature.Word2VecModel", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version,
            "uid": "count_embedding", "paramMap": {"inputCol": bag_col, "outputCol": out, "vectorSize": size}, "defaultParamMap": {}}
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return Word2VecModel.load(path)
