"""Operator 7: n-gram Jaccard join over size-banded tiles with hashed bitmaps.

A document's set holds the 64-bit hashes of its distinct word n-grams. Equal
sets form a class with one representative. For similarity t, two sets of
sizes n <= m can only link if m <= n / t and if they share one of their first
n - ceil(t n) + 1 n-grams in any order that is the same for all; here n-grams
that very many documents hold come last, the rest go by hash. Such a shared
n-gram is a key.

1. Within a key, sorted by size, each set is paired with the first set that
   its size admits: links by stars, as many pairs as rows at most.
2. Where a key still joins several components, tiles of neighbouring size
   bands compare the sets of different components, all of them. A pair counts
   only in the tile of the first key it shares, as far as the `LEAD` first keys
   of both show that. A tile names each set's best partner, so it leaves as many
   pairs as rows at most. Linked sets are one component then, and the tiles that
   had more to name are compared again, until a round links less than half of
   its pairs; what is left there is named whole.

A pair has to pass a bound first: a bitmap holds for each bit the parity of
the n-grams that hash there, so differing bits of two bitmaps are at most the
n-grams that only one set has; that bounds the intersection from above. What
passes is decided by intersecting the sorted arrays of both whole texts.

Defined cases: null and empty texts have the empty set and link with nothing;
with fewer than n words the whole sequence is the one n-gram; rows that share
an id count as one document; rows without id keep a null component; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bagwise.llm.common import TEXTS, id_text, map_rows, slices, written
from bagwise.llm.graph import components

#: An n-gram that more than this share of documents hold comes last in the order; at most
#: (mean set size / share) n-grams can be that frequent, whatever the number of documents.
FREQUENT = 1 / 500
#: ... and it is looked for in blocks of about so many n-grams.
BLOCK = 1 << 20

#: The first keys of a set that go along into its tiles.
LEAD = 4

ODD = np.uint64(0x9E3779B97F4A7C15)
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit number over all its bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """ODD ** i and its inverse modulo 2 ** 64."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((ODD, np.uint64(pow(int(ODD), -1, 1 << 64)))):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _powers[i] = np.cumprod(x, dtype=np.uint64)
    return _powers[0], _powers[1]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word of the texts, A-Z as a-z, and the number of words of each text."""
    raw = [t.encode().lower() for t in texts]
    data = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    word = ~SPACES[data]
    edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = powers(len(data) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], dtype=np.uint64)])
    hashes = mix(mix((total[end] - total[start]) * down[start]) + (end - start).astype(np.uint64))
    ends = np.cumsum([len(r) + 1 for r in raw])
    counts = np.diff(np.concatenate([[0], np.searchsorted(start, ends)]))
    return hashes, counts


def ngram_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's word n-grams."""
    hashes, counts = word_hashes(texts)
    rolled = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    for k in range(size):
        rolled = mix(rolled + hashes[k:k + len(rolled)] + np.uint64(k + 1))
    out, at = [], 0
    for n in counts.tolist():
        if n >= size:
            own = rolled[at:at + n - size + 1]
        else:
            own = np.zeros(min(n, 1), np.uint64)
            for k in range(n):
                own = mix(own * ODD + hashes[at + k] + np.uint64(k + 1))
        out.append(np.unique(own))
        at += n
    return out


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0


def bitmap(ngrams: np.ndarray) -> bytes:
    """Parities of the n-grams by hash; as many bits as n-grams, rounded up to a power of two."""
    bits = 64
    while bits < len(ngrams):
        bits *= 2
    parity = np.bincount((mix(ngrams) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8)).tobytes()


def folded(bits: np.ndarray, width: int) -> np.ndarray:
    """The bitmap with fewer bits: parities add up."""
    while len(bits) > width:
        half = len(bits) // 2
        bits = bits[:half] ^ bits[half:]
    return bits


def prefix(ngrams: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """The keys: rare n-grams first, by hash; one of them is in each set that links."""
    n = len(ngrams)
    late = np.zeros(n, bool)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, ngrams), len(frequent) - 1)
        late = frequent[at] == ngrams
    order = np.concatenate([ngrams[~late], ngrams[late]])
    return order[:n - -(-percent * n // 100) + 1] if n else order


def frequent_rows(size: int, share: float):
    """N-grams held by many documents of one block, with counts."""
    def run(batches):
        held, documents, total = [], 0, 0

        def found():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            many = counts >= max(4, share * documents)
            return pa.record_batch([values[many].view(np.int64), counts[many].astype(np.int64)], names=["gram", "n"])

        for _, texts in slices(batches):
            for own in ngram_sets(texts, size):
                held.append(own)
                documents += 1
                total += len(own)
            if total >= BLOCK:
                yield found()
                held, documents, total = [], 0, 0
        if held:
            yield found()
    return run


def frequent_ngrams(rows: DataFrame, size: int, share: float = FREQUENT) -> np.ndarray:
    """Sorted; a bounded number of them, as each is in at least `share` of the documents."""
    least = max(16.0, share * rows.count())
    found = (map_rows(rows.select("text"), frequent_rows(size, share), "gram long, n long")
             .groupBy("gram").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("gram"))
    return np.sort(np.array([r[0] for r in found.toLocalIterator()], np.int64).view(np.uint64))


SETS = "doc_id long, n int, hi long, lo long, bits binary, keys array<long>"


def set_rows(size: int, percent: int, frequent: np.ndarray):
    kind = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("hi", pa.int64()), ("lo", pa.int64()),
                      ("bits", pa.binary()), ("keys", pa.list_(pa.int64()))])

    def run(batches):
        for batch, texts in slices(batches):
            rows = []
            for doc_id, own in zip(batch.column(0).to_pylist(), ngram_sets(texts, size)):
                digest = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), np.int64).tolist()
                rows.append((doc_id, len(own), *digest, bitmap(own), prefix(own, frequent, percent).view(np.int64)))
            yield pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*rows), kind)], schema=kind)
    return run


def runs(batches, columns: list[str]):
    """Groups of rows with equal first column, each as a list of arrays; rows come sorted by it."""
    carry = None
    for batch in batches:
        now = [batch.column(batch.schema.get_field_index(c)) for c in columns]
        now = [c.to_numpy(zero_copy_only=False) for c in now]
        if carry is not None:
            now = [np.concatenate([a, b]) for a, b in zip(carry, now)]
        if not len(now[0]):
            continue
        edges = np.flatnonzero(np.any([x[1:] != x[:-1] for x in now[:1]], axis=0)) + 1
        last = int(edges[-1]) if len(edges) else 0
        if last:
            starts = np.concatenate([[0], edges[:-1]])
            many = edges - starts > 1
            for s, e in zip(starts[many].tolist(), edges[many].tolist()):
                yield [c[s:e] for c in now]
        carry = [c[last:] for c in now]
    if carry is not None and len(carry[0]) > 1:
        yield carry


def star_rows(percent: int):
    """Sets that share a key with others, each with the first that its size admits."""
    def run(batches):
        held, n_held = [], 0
        for key, n, rep in runs(batches, ["key", "n", "rep"]):
            leader, at = np.empty_like(rep), 0
            while at < len(n):
                end = int(np.searchsorted(n, int(n[at]) * 100 // percent, "right"))
                leader[at:end] = rep[at]
                at = max(end, at + 1)
            held.append((key, n, rep, leader))
            n_held += len(key)
            if n_held > 50_000:
                yield pa.record_batch([np.concatenate(c) for c in zip(*held)], names=["key", "n", "rep", "leader"])
                held, n_held = [], 0
        if held:
            yield pa.record_batch([np.concatenate(c) for c in zip(*held)], names=["key", "n", "rep", "leader"])
    return run


def most_shared(bits: np.ndarray, n: np.ndarray, own: bytes, own_n: int) -> np.ndarray:
    """Of bitmaps (rows of uint8, the same width as own), the most n-grams that both sets can hold."""
    differ = np.bitwise_count(bits ^ np.frombuffer(own, np.uint8)).sum(axis=1)
    return (n.astype(np.int64) + own_n - differ) // 2


def admitted(bits: np.ndarray, n: np.ndarray, own: bytes, own_n: int, percent: int) -> np.ndarray:
    """Those whose bound on the intersection suffices."""
    most = most_shared(bits, n, own, own_n)
    return 100 * most >= percent * (n.astype(np.int64) + own_n - most)


def earlier_keys(key: int, lead: np.ndarray) -> np.ndarray:
    """The first keys (a row of them for each set, 0 for none) that come before `key`; 0 in place of the others."""
    found = lead == key
    place = np.where(found.any(axis=1), found.argmax(axis=1), lead.shape[1])
    return np.where(np.arange(lead.shape[1]) < place[:, None], lead, 0)


def met_before(earlier: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Of rows of earlier keys, those that share one with `own`: such a pair belongs to that key's tile."""
    own = own[own != 0]
    return (earlier[:, :, None] == own).any(axis=(1, 2)) if len(own) else np.zeros(len(earlier), bool)


def tile_rows(percent: int, turn: int, whole: bool):
    """Pairs of one tile, from different components, that size and bitmaps admit: each set's best, or all.

    The best has the highest bound in the first turn; in later ones a hash chooses, so that a pair that
    failed isn't named for ever. `key` is null in the rows of a tile that has named all its pairs.
    """
    names = ["tile", "key", "n", "rep", "component", "upper", "bits", *(f"lead{k}" for k in range(LEAD))]

    def run(batches):
        for _, key, *columns in runs(batches, names):
            order = np.argsort(columns[0], kind="stable")
            n, rep, component, upper, bits, *lead = (x[order] for x in columns)
            if (component == component[0]).all():
                continue
            width = min(len(b) for b in bits)
            flat = np.stack([folded(np.frombuffer(b, np.uint8), width) for b in bits])
            earlier = earlier_keys(int(key[0]), np.stack(lead, axis=1))
            ends = np.searchsorted(n, n.astype(np.int64) * 100 // percent, "right")
            best, partner, total, a, b = np.full(len(n), -1.0), np.zeros(len(n), np.int64), 0, [], []
            for i in np.flatnonzero(ends > np.arange(len(n)) + 1).tolist():
                at = np.arange(i + 1, int(ends[i]))
                at = at[(component[at] != component[i]) & ~(upper[at] & upper[i])]
                if len(at):
                    at = at[~met_before(earlier[at], earlier[i])]
                if not len(at):
                    continue
                both = n[at].astype(np.int64) + int(n[i])
                most = most_shared(flat[at], n[at], flat[i].tobytes(), int(n[i]))
                good = 100 * most >= percent * (both - most)
                at, total = at[good], total + int(good.sum())
                if whole:
                    a.append(np.full(len(at), i))
                    b.append(at)
                elif len(at):
                    if turn:
                        chance = mix(mix(rep[at].view(np.uint64) ^ np.uint64(turn)) ^ mix(rep[i:i + 1].view(np.uint64)))
                        score = (chance >> np.uint64(11)).astype(np.float64)
                    else:
                        score = most[good] / both[good]
                    better = score > best[at]
                    best[at[better]], partner[at[better]] = score[better], i
                    top = int(score.argmax())
                    if score[top] > best[i]:
                        best[i], partner[i] = score[top], at[top]
            if not total:
                continue
            if whole:
                x, y = rep[np.concatenate(a)], rep[np.concatenate(b)]
            else:
                some = np.flatnonzero(best >= 0)
                x, y = rep[some], rep[partner[some]]
            pairs = np.unique(np.stack([np.maximum(x, y), np.minimum(x, y)], axis=1), axis=0)
            named = pa.array(np.full(len(pairs), key[0])) if len(pairs) < total else pa.nulls(len(pairs), pa.int64())
            yield pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), named], names=["a", "b", "key"])
    return run


def bound_rows(percent: int):
    """Pairs whose bitmaps admit a link."""
    def run(batches):
        for batch in batches:
            a_n, b_n = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("a_n", "b_n"))
            a_bits, b_bits = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("a_bits", "b_bits"))
            good = np.zeros(len(a_n), bool)
            for i, (x, y) in enumerate(zip(a_bits, b_bits)):
                width = min(len(x), len(y))
                x, y = (folded(np.frombuffer(z, np.uint8), width) for z in (x, y))
                good[i] = admitted(x[None], a_n[i:i + 1], y.tobytes(), int(b_n[i]), percent)[0]
            yield pa.record_batch([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good))
    return run


def exact_rows(size: int, percent: int):
    """Pairs whose whole texts' n-gram sets are similar enough."""
    def run(batches):
        last, own = None, None
        for batch, firsts in slices(batches, "a_text"):
            seconds = batch.column(batch.schema.get_field_index("b_text")).to_pylist()
            good = []
            for x, text in zip(ngram_sets(firsts, size), seconds):
                if text != last:
                    last, own = text, ngram_sets([text], size)[0]
                same = overlap(x, own)
                good.append(100 * same >= percent * (len(x) + len(own) - same))
            yield pa.record_batch([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good))
    return run


def ngram_jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
                             text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id): links are similarities of `percent` / 100 or more."""
    rows = id_text(docs, id_col, text_col)
    frequent = frequent_ngrams(rows, size)
    sets = written(map_rows(rows, set_rows(size, percent, frequent), SETS), "sets", TEXTS)
    some = sets.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = written(some.groupBy("hi", "lo").agg(F.min("doc_id").alias("rep")), "classes")
    first = some.join(classes.select("hi", "lo", F.col("rep").alias("doc_id")), ["hi", "lo", "doc_id"], "left_semi")
    first = first.withColumnRenamed("doc_id", "rep")
    lead = [F.coalesce(F.get("keys", F.lit(k)), F.lit(0)).alias(f"lead{k}") for k in range(LEAD)]
    bits = written(first.select("rep", "n", "bits", *lead), "bits")

    def linked(pairs: DataFrame) -> DataFrame:
        """(a, b) of those that link; the more frequent side is b, so that its set is made once."""
        a, b = (bits.select(F.col("rep").alias(x), F.col("n").alias(f"{x}_n"), F.col("bits").alias(f"{x}_bits")) for x in "ab")
        pairs = map_rows(pairs.join(a, "a").join(b, "b").select("a", "b", "a_n", "b_n", "a_bits", "b_bits"),
                         bound_rows(percent), "a long, b long")
        pairs = written(pairs, "bounded")
        a, b = (rows.select(F.col("doc_id").alias(x), F.col("text").alias(f"{x}_text")) for x in "ab")
        both = pairs.join(a, "a").join(b, "b").select("a", "b", "a_text", "b_text")
        return written(map_rows(both, exact_rows(size, percent), "a long, b long"), "links", TEXTS // 5)  # two texts each

    keyed = (first.select("rep", "n", F.explode("keys").alias("key")).repartition("key")
             .sortWithinPartitions("key", "n", "rep"))
    shared = written(map_rows(keyed, star_rows(percent), "key long, n int, rep long, leader long"), "shared")
    stars = linked(shared.filter("rep != leader").select(F.col("rep").alias("a"), F.col("leader").alias("b")).distinct())
    band = F.floor(F.log(F.col("n").cast("double")) / np.log(100 / percent) + 1e-9)
    lead = [f"lead{k}" for k in range(LEAD)]

    def tiles(open_rows: DataFrame, found: DataFrame) -> DataFrame:
        """The sets of each key that joins several components, dealt by key and size band."""
        grouped = (open_rows.join(found.withColumnRenamed("node", "rep"), "rep", "left")
                   .select("key", "n", "rep", F.coalesce("component", "rep").alias("component")))
        several = (grouped.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
                   .filter("low < high").select("key"))
        return (grouped.join(several, "key").join(bits.select("rep", "bits", *lead), "rep")
                .select("key", "n", "rep", "component", "bits", *lead,
                        F.explode(F.array(F.struct(band.alias("band"), F.lit(False).alias("upper")),
                                          F.struct((band - 1).alias("band"), F.lit(True).alias("upper")))).alias("t"))
                .select("key", F.xxhash64("key", "t.band").alias("tile"), "n", "rep", "component", "t.upper", "bits", *lead)
                .repartition("tile").sortWithinPartitions("tile", "key", "n"))

    links, open_rows, turn, whole = stars, shared.select("key", "n", "rep"), 0, False
    while True:
        found = written(components(links), "components")
        named = written(map_rows(tiles(open_rows, found), tile_rows(percent, turn, whole), "a long, b long, key long"), "pairs")
        pairs = written(named.select("a", "b").distinct(), "distinct")
        n_pairs = pairs.count()
        if not n_pairs:
            break
        more = linked(pairs)
        links = links.unionAll(more)
        left = named.filter("key is not null").select("key").distinct()
        if whole or left.isEmpty():
            found = written(components(links), "components")
            break
        open_rows = written(open_rows.join(left, "key", "left_semi"), "open")
        whole, turn = 2 * more.count() < n_pairs, turn + 1
    named = (classes.join(found.withColumnRenamed("node", "rep"), "rep", "left")
             .select("hi", "lo", F.coalesce("component", "rep").alias("component_id")))
    return (sets.join(named, ["hi", "lo"], "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id"))
                    .otherwise(F.col("doc_id")).alias("component_id")))
