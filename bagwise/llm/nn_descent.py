"""Operator 8: near-duplicate embeddings by NN-descent.

Vectors are compared within a label, by cosine in double precision. A graph
holds the `k` nearest vectors found so far for each vector; it starts from
blocks of a random-hyperplane hash. Each round joins neighbours of neighbours:
all vectors that point to a vector, or that it points to, meet in a tile and
are compared; better ones enter the lists. No number of rounds ends this: a
group of vectors that may link (label and length) is settled by its audit.

The audit follows when a round brings no new link (a cosine of `least` or more),
and after every `STEPS` rounds. Of each group it takes a bounded sample of the
vectors of every component size found, those without link included, and compares
them with the whole group by brute force. Each vector counts by the share of its
links that its component holds, weighted for the sampling, and vectors are
averaged by their number of links (powers of two): each average must reach
`recall`, so that a large component can't outvote small ones. Groups that don't
pass go on, once their lists are final with lists twice as long and further hash
tables. Those that still fail with lists of `LONGEST`, and groups of at most
`TILE` vectors, are compared pair by pair.

The lists of linked vectors are enlarged to their whole component, compared
exactly in tiles, which yields every link within it.

Exact copies are one vector with a count. A tile holds a bounded number of
vectors: what a much-cited vector gathers is dealt out over several tiles.

Defined cases: null, empty and zero vectors, those with null or non-finite
components and those without label link with nothing and are kept; vectors of
different length don't link; rows that share an id count as one vector; rows
without id keep a null component; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bagwise.llm.common import map_rows, written
from bagwise.llm.graph import components
from bagwise.llm.ngram_join import runs

LEAST = 0.93
K = 8
BLOCK = 256          # vectors of a first block, about
TILE = 512           # vectors of a tile of a component, about
CITED = 64           # citing vectors in a tile, about
PLANES = 40          # of a hash table; of them, as many are used as give blocks of about half of BLOCK
TABLES = 3
AUDITED = 100        # vectors of a group and component size that the audit compares with all others of the group
AUDIT_TILE = 2048    # ... in tiles of so many, about
STEPS = 6
LONGEST = 64

VECTORS = "vec_id long, grp string, copy long, x binary"


def vector_rows():
    """Unit vectors."""
    def run(batches):
        for batch in batches:
            rows = []
            for vec_id, x, label in zip(*(c.to_pylist() for c in batch.columns)):
                if vec_id is None or label is None or not x or any(v is None for v in x):
                    continue
                x = np.array(x, np.float64)
                size = np.linalg.norm(x / np.abs(x).max()) * np.abs(x).max() if np.isfinite(x).all() and x.any() else 0.0
                if not size or not np.isfinite(size):
                    continue
                x = x / size
                raw = x.tobytes()
                rows.append((vec_id, f"{label}:{len(x)}", np.int64(np.uint64(xxhash.xxh3_64_intdigest(raw)).view(np.int64)), raw))
            kind = pa.schema([("vec_id", pa.int64()), ("grp", pa.string()), ("copy", pa.int64()), ("x", pa.binary())])
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 4, kind)], schema=kind)
    return run


def code_rows(seed: int, tables: int):
    """Appends hashes of the side of random hyperplanes on which the vectors lie."""
    def run(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            codes = []
            for raw in batch.column(batch.schema.get_field_index("x")).to_pylist():
                x = np.frombuffer(raw)
                if len(x) not in planes:
                    planes[len(x)] = np.random.default_rng(seed + len(x)).normal(size=(tables * PLANES, len(x)))
                side = (planes[len(x)] @ x > 0).reshape(tables, PLANES)
                codes.append((side @ (1 << np.arange(PLANES))).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.list_(pa.int64()))], names=[*batch.schema.names, "codes"])
    return run


def compared(x: np.ndarray) -> np.ndarray:
    """Cosines, rounded so that a pair has the same one in every tile."""
    x = np.stack([np.frombuffer(v) for v in x])
    return np.round(x @ x.T, 12)


def best_rows(k: int):
    """Of each tile: the best partners of each member that beat its list so far."""
    def run(batches):
        for _, rep, low, x in runs(batches, ["tile", "rep", "low", "x"]):
            rep, first = np.unique(rep, return_index=True)
            if len(rep) < 2:
                continue
            low, cosine = low[first], compared(x[first])
            np.fill_diagonal(cosine, -2.0)
            top = min(k, len(rep) - 1)
            at = np.argpartition(-cosine, top - 1, axis=1)[:, :top]
            value = np.take_along_axis(cosine, at, 1)
            good = value > low[:, None]
            yield pa.record_batch([np.repeat(rep, top)[good.ravel()], rep[at][good], value[good]], names=["a", "b", "cosine"])
    return run


def degree_rows(least: float):
    """Of each pair of chunks of a component: how many links each member has there."""
    def run(batches):
        for _, rep, copies, chunk, x in runs(batches, ["tile", "rep", "copies", "chunk", "x"]):
            link = compared(x) >= least
            np.fill_diagonal(link, False)
            if (chunk != chunk[0]).any():  # pairs within a chunk belong to its own tile
                link &= chunk[:, None] != chunk[None, :]
            yield pa.record_batch([rep, link.astype(np.int64) @ copies], names=["rep", "n"])
    return run


def edge_rows(least: float):
    """Of each tile: links that join the same vectors as all of its links do, one fewer than vectors at most."""
    def run(batches):
        for _, rep, x in runs(batches, ["tile", "rep", "x"]):
            rep, first = np.unique(rep, return_index=True)
            link = compared(x[first]) >= least
            left, a, b = np.ones(len(rep), bool), [], []
            for i in range(len(rep)):
                front = [i] if left[i] else []
                left[i] = False
                while front:
                    at = front.pop()
                    new = np.flatnonzero(link[at] & left)
                    left[new] = False
                    a += [rep[at]] * len(new)
                    b += rep[new].tolist()
                    front += new.tolist()
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return run


def audit_rows(least: float):
    """Of each asked vector: its links in the tile, and how many of them are in its component."""
    def run(batches):
        for _, rep, component, asked, x in runs(batches, ["tile", "rep", "component", "asked", "x"]):
            unit = np.stack([np.frombuffer(v) for v in x])
            one, own = asked == 1, asked == 0
            link = np.round(unit[one] @ unit[own].T, 12) >= least
            link &= rep[one][:, None] != rep[own][None, :]
            same = component[one][:, None] == component[own][None, :]
            yield pa.record_batch([rep[one], link.sum(axis=1).astype(np.int64), (link & same).sum(axis=1).astype(np.int64)], names=["rep", "n", "got"])
    return run


def failing_groups(members: DataFrame, found: DataFrame, least: float, recall: float, attempt: int = 0) -> DataFrame:
    """(grp) of the groups of members (rep, grp, x) that the components (node, component) don't settle; see above."""
    sizes = found.groupBy("component").agg(F.floor(F.log2(F.count("*"))).cast("int").alias("stratum"))
    known = (members.select("rep", "grp", "x").join(found.join(sizes, "component").withColumnRenamed("node", "rep"), "rep", "left")
             .withColumns({"component": F.coalesce("component", "rep"), "stratum": F.coalesce("stratum", F.lit(0))}))
    order = Window.partitionBy("grp", "stratum").orderBy(F.xxhash64("rep", F.lit(attempt)), "rep")
    strata = known.groupBy("grp", "stratum").agg(F.greatest(F.lit(1.0), F.count("*") / AUDITED).alias("weight"))
    asked = written(known.withColumn("number", F.row_number().over(order)).filter(F.col("number") <= AUDITED).drop("number")
                    .join(strata, ["grp", "stratum"]), "asked")
    parts = members.groupBy("grp").agg(F.ceil(F.count("*") / AUDIT_TILE).cast("int").alias("parts"))
    tiles = (known.join(parts, "grp").withColumn("part", F.pmod(F.xxhash64("rep"), "parts").cast("int")).withColumn("asked", F.lit(0))
             .unionByName(asked.drop("weight").join(parts, "grp").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
                          .withColumn("asked", F.lit(1)))
             .select(F.xxhash64("grp", "part").alias("tile"), "rep", "component", "asked", "x"))
    seen = (map_rows(tiles.repartition("tile").sortWithinPartitions("tile"), audit_rows(least), "rep long, n long, got long")
            .groupBy("rep").agg(F.sum("n").alias("n"), F.sum("got").alias("got")).filter("n > 0"))
    shares = (asked.select("rep", "grp", "weight").join(seen, "rep").groupBy("grp", F.floor(F.log2("n")).alias("size"))
              .agg((F.sum(F.col("weight") * F.col("got") / F.col("n")) / F.sum("weight")).alias("share")))
    return written(shares.filter(F.col("share") < recall - 1e-9).select("grp").distinct(), "failing")


def nearest(found: DataFrame, k: int) -> DataFrame:
    """The k best of each a; Spark cuts to k before the shuffle already."""
    order = Window.partitionBy("a").orderBy(F.desc("cosine"), "b")
    return found.withColumn("rank", F.dense_rank().over(order)).filter(F.col("rank") <= k).select("a", "b", "cosine").distinct()


def embedding_links(vectors: DataFrame, least: float = LEAST, k: int = K, recall: float = 0.95, seed: int = 11,
                    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id) of each id."""
    ids = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("x"), F.col(label_col).alias("label"))
    every = written(map_rows(ids, vector_rows(), VECTORS), "vectors")
    classes = written(every.groupBy("grp", "copy").agg(F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("copies")), "classes")
    reps = written(every.join(classes, ["grp", "copy"]).filter("vec_id = rep").dropDuplicates(["rep"])
                   .select("rep", "grp", "copies", "x"), "reps")
    sizes = reps.groupBy("grp").agg(F.count("*").alias("size"))

    def tiles(members: DataFrame, size: int) -> DataFrame:
        return map_rows(members.select("tile", "rep", "low", "x").repartition("tile").sortWithinPartitions("tile"),
                        best_rows(size), "a long, b long, cosine double")

    def blocks(members: DataFrame, attempt: int) -> DataFrame:
        """Those with the same hash, in chunks of about BLOCK."""
        used = sizes.select("grp", F.greatest(F.lit(0), F.ceil(F.log2(F.col("size") / (BLOCK / 2)))).cast("int").alias("used"))
        hashed = map_rows(members.select("rep", "grp", "x"), code_rows(seed + 1000003 * attempt, TABLES), "rep long, grp string, x binary, codes array<long>")
        coded = (hashed.join(used, "grp").select("rep", "grp", "x", "used", F.posexplode("codes").alias("table", "code"))
                 .withColumn("code", F.expr("code & (shiftleft(1L, used) - 1)")))
        held = coded.groupBy("grp", "table", "code").agg(F.count("*").alias("held"))
        return (coded.join(held, ["grp", "table", "code"])
                .select(F.xxhash64("grp", "table", "code", F.pmod(F.xxhash64("rep", "table", F.lit(attempt)), F.ceil(F.col("held") / BLOCK))).alias("tile"),
                        "rep", F.lit(-2.0).alias("low"), "x"))

    def edges(members: DataFrame) -> DataFrame:
        """Links that join what all links do, from all pairs of chunks of a group, a tile each."""
        chunked = (members.join(sizes.select("grp", F.ceil(F.col("size") / TILE).cast("int").alias("parts")), "grp")
                   .withColumn("chunk", F.pmod(F.xxhash64("rep"), "parts").cast("int"))
                   .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
                   .select(F.xxhash64("grp", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("tile"), "rep", "x"))
        return written(map_rows(chunked.repartition("tile").sortWithinPartitions("tile"), edge_rows(least), "a long, b long"), "settled")

    def links(graph: DataFrame) -> DataFrame:
        return graph.filter(F.col("cosine") >= least).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def refined(graph: DataFrame, members: DataFrame, k: int) -> DataFrame:
        """One round; a much-cited vector's neighbours are dealt over several tiles, its own list in each."""
        low = graph.groupBy("a").agg(F.min("cosine").alias("low"), F.count("*").alias("n")) \
            .select(F.col("a").alias("rep"), F.when(F.col("n") < k, -2.0).otherwise(F.col("low")).alias("low"))
        cited = graph.groupBy("b").agg(F.ceil(F.count("*") / CITED).cast("int").alias("parts")).withColumnRenamed("b", "center")
        citing = (graph.select(F.col("b").alias("center"), F.col("a").alias("rep")).join(cited, "center")
                  .select("center", "rep", F.pmod(F.xxhash64("rep"), "parts").cast("int").alias("part")))
        own = (graph.select(F.col("a").alias("center"), F.col("b").alias("rep"))
               .unionAll(members.select(F.col("rep").alias("center"), "rep")).join(cited, "center", "left")
               .select("center", "rep", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")))
        dealt = (citing.unionAll(own).select(F.xxhash64("center", "part").alias("tile"), "rep")
                 .join(members.select("rep", "x").join(low, "rep", "left"), "rep")
                 .withColumn("low", F.coalesce("low", F.lit(-2.0))))
        return written(nearest(graph.unionAll(tiles(dealt, k)), k), "graph")

    settled = edges(reps.join(sizes.filter(F.col("size") <= TILE).select("grp"), "grp", "left_semi"))
    members = written(reps.join(sizes.filter(F.col("size") > TILE).select("grp"), "grp", "left_semi"), "open")
    if not members.isEmpty():
        graph = written(nearest(tiles(blocks(members, 0), k), k), "graph")
        before, rounds, attempt = None, 0, 0
        while True:
            now = links(graph).agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
            final, before, rounds = now == before, now, rounds + 1
            if final or rounds % STEPS == 0:
                attempt += 1
                failing = failing_groups(members, written(components(links(graph)), "components"), least, recall, attempt)
                passed = members.join(failing, "grp", "left_anti").select(F.col("rep").alias("a"))
                settled = settled.unionAll(links(graph).join(passed, "a", "left_semi"))
                if failing.isEmpty():
                    break
                members = written(members.join(failing, "grp", "left_semi"), "open")
                graph = written(graph.join(members.select(F.col("rep").alias("a")), "a", "left_semi"), "graph")
                before = None
                if final:
                    k *= 2
                    if k > LONGEST:
                        settled = settled.unionAll(edges(members))
                        break
                    graph = written(nearest(graph.unionAll(tiles(blocks(members, attempt), k)), k), "graph")
            graph = refined(graph, members, k)
    found = written(components(settled), "components")

    # the lists of linked vectors, enlarged to their components: all pairs of chunks, a tile each
    members = reps.join(found.withColumnRenamed("node", "rep"), "rep")
    parts = members.groupBy("component").agg(F.ceil(F.count("*") / TILE).cast("int").alias("parts"))
    chunked = (members.join(parts, "component")
               .withColumn("chunk", F.pmod(F.xxhash64("rep"), "parts").cast("int"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
               .select(F.xxhash64("component", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("tile"),
                       "rep", "copies", "chunk", "x"))
    degrees = (map_rows(chunked.repartition("tile").sortWithinPartitions("tile"), degree_rows(least), "rep long, n long")
               .groupBy("rep").agg(F.sum("n").alias("n")))
    named = (classes.join(degrees, "rep", "left").join(found.withColumnRenamed("node", "rep"), "rep", "left")
             .select("grp", "copy", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component", "rep").alias("component_id")))
    linked = every.join(named, ["grp", "copy"]).groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    return (ids.select("vec_id").distinct().join(linked, "vec_id", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id")))
