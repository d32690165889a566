"""Operator 9: line dedup by an exact set-similarity join.

A line's set holds its distinct lower-cased words. A line goes if an earlier
line (by document id, then line number) has a Jaccard similarity of
`percent` / 100 or more with it; blank lines stay.

The words of a set are ordered by rarity: words that many lines hold come
last, by their counts over all documents, the others first, by hash. Two
similar sets share a word among the first n - ceil(t n) + 1 of either
(prefix filter), their sizes differ by a factor of t at most (length filter),
and the words behind a shared one must suffice for the overlap (positional
filter); a sketch, 64 to 512 parities by the size of the set, bounds the difference.
Equal sets are one class with its first line. What passes is verified on the
words of the whole lines.

A line needs one earlier match only. So each line is first verified against
the earliest that passes. Lines which that doesn't settle meet again in their
tiles, with no other lines than those that passed the filters beside a line of
several candidates; there they carry their words, are compared until one
matches, and leave a tile as one row at most. Words of lines beyond `CARRIED`
words aren't carried: pairs that hold such a line are verified by joins.

Defined cases: null and empty texts have no lines to remove; a document that
loses all its lines has none left; rows that share an id count as one
document; rows without id are kept whole; an empty table gives an empty one;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bagwise.llm.common import TEXTS, discard, id_text, map_rows, slices, written
from bagwise.llm.ngram_join import mix, overlap, word_hashes

#: A word counts as frequent from this share of all words on: fewer than 1 / FREQUENT words can be.
FREQUENT = 1e-6
#: From this share on, the tiles of a frequent word are cut into bands of sizes.
BANDED = 1e-5
BLOCK = 1 << 20
#: Longer lines have too many tiles to take their words along.
CARRIED = 64
#: Bits of the table of the lines that are verified: for each of them, and in all at most.
SLOTS = 32
BITS = 1 << 27
#: Lines of a document, for one number of its id and a line's.
LINE = 1 << 32
HIGH = np.uint64(1 << 63)


def frequent_rows(share: float):
    def run(batches):
        held, total = [], 0

        def found():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            many = counts >= max(4, share * total)
            return pa.record_batch([values[many].view(np.int64), counts[many].astype(np.int64)], names=["word", "n"])

        for _, texts in slices(batches):
            held.append(word_hashes(texts)[0])
            total += len(held[-1])
            if total >= BLOCK:
                yield found()
                held, total = [], 0
        if held:
            yield found()
    return run


def frequent_words(rows: DataFrame, share: float = FREQUENT, banded: float = BANDED) -> tuple[np.ndarray, np.ndarray, int]:
    """Sorted hashes of the frequent words, their places by count, rarest first, and the first place of a share of `banded`."""
    counted = written(map_rows(rows.select("text"), frequent_rows(share), "word long, n long")
                      .groupBy("word").agg(F.sum("n").alias("n")), "words")
    total = counted.agg(F.sum("n")).first()[0] or 0
    found = counted.filter(F.col("n") >= max(4.0, share * total)).orderBy("n", "word").toArrow()
    words = found["word"].to_numpy().view(np.uint64)
    order = np.argsort(words)
    return words[order], order.astype(np.uint64), int(np.searchsorted(found["n"].to_numpy(), max(4.0, banded * total)))


def line_sets(texts: list[str], frequent: tuple[np.ndarray, np.ndarray, int]):
    """Of the lines that hold words: text, line, size, and all their words by rarity, flat."""
    lines = [t.split("\n") for t in texts]
    hashes, counts = word_hashes([x for own in lines for x in own])
    text_of = np.repeat(np.arange(len(texts)), [len(own) for own in lines])
    line_of = np.concatenate([np.arange(len(own)) for own in lines] or [np.zeros(0, np.int64)])
    values, number = np.unique(hashes, return_inverse=True)  # a word's place is looked up once, however often it stands here
    words = values >> np.uint64(1)
    known, place, _ = frequent
    if len(known):
        at = np.minimum(np.searchsorted(known, values), len(known) - 1)
        often = known[at] == values
        words = np.where(often, HIGH | place[at], words)
    words, rank = np.unique(words, return_inverse=True)
    owner = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    both = np.sort(owner << np.uint64(32) | rank[number].astype(np.uint64))  # line, then rarity, in one number
    new = np.ones(len(both), bool)
    new[1:] = both[1:] != both[:-1]
    both = both[new]
    words, owner = words[both & np.uint64((1 << 32) - 1)], (both >> np.uint64(32)).astype(np.int64)
    sizes = np.bincount(owner, minlength=len(counts))
    some = np.flatnonzero(sizes)
    return text_of[some], line_of[some], sizes[some], words


def width_of(n: np.ndarray) -> np.ndarray:
    """64-bit words of a sketch: more parities than words of the line, 512 at most."""
    return np.minimum(8, 1 << np.ceil(np.log2(np.maximum(1, n / 50))).astype(np.int64))


def sketches(words: np.ndarray, starts: np.ndarray, n: np.ndarray):
    """Of each set: its parities by hash, as bytes, and two sums that name it."""
    spread, width = mix(words), width_of(n)
    line = np.repeat(np.arange(len(n)), n)
    word = ((spread >> np.uint64(6)) & np.repeat(width - 1, n).astype(np.uint64)).astype(np.int64)
    parities = np.zeros((len(n), 8), np.uint64)
    np.bitwise_xor.at(parities, (line, word), np.uint64(1) << (spread & np.uint64(63)))
    used = np.arange(8) < width[:, None]
    offsets = np.concatenate([[0], np.cumsum(8 * width)]).astype(np.int32)
    parity = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(parities[used].tobytes())])
    return (parity, np.add.reduceat(spread, starts, dtype=np.uint64),
            np.add.reduceat(mix(spread + np.uint64(1)), starts, dtype=np.uint64))


def unpacked(parity: pa.Array) -> np.ndarray:
    """A sketch in each row, filled up with zeros."""
    offsets = np.frombuffer(parity.buffers()[1], np.int32)[parity.offset:parity.offset + len(parity) + 1]
    full = np.zeros((len(parity), 8), np.uint64)
    if offsets[-1] > offsets[0]:
        data = np.frombuffer(parity.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        full[np.arange(8) < (np.diff(offsets) // 8)[:, None]] = np.ascontiguousarray(data).view(np.uint64)
    return full


def folds(full: np.ndarray) -> dict[int, np.ndarray]:
    """For each width the sketches folded to it (parities add up)."""
    folded = {8: full}
    for w in (4, 2, 1):
        folded[w] = folded[2 * w][:, :w] ^ folded[2 * w][:, w:]
    return folded


LINES = pa.schema([("doc_id", pa.int64()), ("line", pa.int32()), ("n", pa.int32()), ("hi", pa.int64()),
                   ("lo", pa.int64()), ("parity", pa.binary()), ("keys", pa.list_(pa.int64()))])


def line_rows(percent: int, frequent: tuple[np.ndarray, np.ndarray, int]):
    def run(batches):
        for batch, texts in slices(batches):
            text_of, line, n, words = line_sets(texts, frequent)
            if not len(n):
                continue
            starts = np.concatenate([[0], np.cumsum(n)[:-1]])
            parity, hi, lo = sketches(words, starts, n)
            keys = n - -(-percent * n // 100) + 1
            offsets = np.concatenate([[0], np.cumsum(keys)])
            at = np.repeat(starts - offsets[:-1], keys) + np.arange(offsets[-1])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(words[at].view(np.int64)))
            ids = batch.column(0).take(pa.array(text_of))
            yield pa.record_batch([ids, pa.array(line, pa.int32()), pa.array(n, pa.int32()), pa.array(hi.view(np.int64)),
                                   pa.array(lo.view(np.int64)), parity, lists], schema=LINES)
    return run


PAIRS = "doc_id long, line int, by_doc long, by_line int, more boolean"
NAMES = ["doc_id", "line", "by_doc", "by_line", "more"]
BY_TILE = ["tile", "n", "place", "parity", "doc_id", "line"]


def whole_tiles(batches, columns: list[str]):
    """Arrays of whole tiles, some thousand rows at a time; rows come sorted by tile."""
    carry = None
    for batch in batches:
        now = [batch.column(batch.schema.get_field_index(c)) for c in columns]
        now = [unpacked(x) if c == "parity" else x.to_numpy(zero_copy_only=False) for c, x in zip(columns, now)]
        if carry is not None:
            now = [np.concatenate([a, b]) for a, b in zip(carry, now)]
        if not len(now[0]):
            continue
        edges = np.flatnonzero(now[0][1:] != now[0][:-1]) + 1
        last = int(edges[-1]) if len(edges) else 0
        if last:
            yield [c[:last] for c in now]
        carry = [c[last:] for c in now]
    if carry is not None and len(carry[0]):
        yield carry


def passing(tile: np.ndarray, n: np.ndarray, place: np.ndarray, parity: np.ndarray, percent: int):
    """Pairs of rows of a tile that pass the filters, in blocks; rows come sorted by tile, then size.

    Each row admits larger ones up to a size: by similarity, and by the words that it has
    from the shared one on. So its partners are the rows behind it up to a place that is
    looked up once, and a round compares all rows that have so many partners with the row
    `step` behind: the work follows the admitted pairs.
    """
    upper, place, n = place < 0, np.abs(place) - 1, n.astype(np.int64)
    most_n = (100 + percent) * (n - place) // percent - n                       # largest partner that the words left suffice for
    of = np.cumsum(np.concatenate([[False], tile[1:] != tile[:-1]])) << 32
    partners = np.searchsorted(of | n, of | np.clip(most_n, 0, 100 * n // percent), side="right") - np.arange(1, len(n) + 1)
    order = np.argsort(-partners)
    least, ends = n[order], np.sort(partners)
    width, folded = width_of(n), folds(parity)
    narrowest = folded[1][:, 0].copy()
    for step in range(1, int(ends[-1]) + 1 if len(ends) else 0):
        at = order[:len(ends) - np.searchsorted(ends, step)]
        good = np.flatnonzero(least[:len(at)] <= most_n[at + step])
        i = at[good]
        j = i + step
        both = n[i] + n[j]
        most = both - 2 * -(-percent * both // (100 + percent))                 # words beyond the least overlap
        good = np.flatnonzero((np.bitwise_count(narrowest[i] ^ narrowest[j]) <= most) & ~(upper[i] & upper[j]))
        i, j, most = i[good], j[good], most[good]
        for w in (2, 4, 8):  # the narrow sketches first: few pairs are left for the wide ones
            if len(i):
                narrow = np.minimum(width[i], width[j]) < w
                good = narrow | (np.bitwise_count(folded[w][i] ^ folded[w][j]).sum(axis=1, dtype=np.int64) <= most)
                i, j, most = i[good], j[good], most[good]
        if len(i):
            yield i, j


def before(doc: np.ndarray, line: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (doc[a] < doc[b]) | ((doc[a] == doc[b]) & (line[a] < line[b]))


def in_tiles(columns: list[np.ndarray], percent: int):
    """Rows in the order of `passing`, less those alone in their tile, and (late, early) of its pairs; a step has a row as late once at most."""
    same = columns[0][1:] == columns[0][:-1]
    some = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))
    of = np.cumsum(np.concatenate([[False], ~same]))[some] << 32  # number of the tile: one key to sort by, almost in order
    some = some[np.argsort(of | columns[1][some], kind="stable")]
    rows = [x[some] for x in columns]
    tile, n, place, parity, doc, line = rows[:6]

    def pairs():
        for i, j in passing(tile, n, place, parity, percent):
            for late, early in ((i, j), (j, i)):
                good = before(doc, line, early, late)
                yield late[good], early[good]
    return rows, pairs()


def earlier_rows(percent: int):
    """Of each line in a tile the earliest earlier line that passes the filters, and whether more do.

    Rows without a line `by_doc` name those that pass beside a line of several.
    """
    def run(batches):
        for columns in whole_tiles(batches, BY_TILE):
            (_, n, _, _, doc, line), pairs = in_tiles(columns, percent)
            best, seen, number = (np.zeros(len(n), np.int64) for _ in range(3))
            beside = np.zeros(len(n), bool)
            for late, early in pairs:
                new = number[late] == 0
                better = new | before(doc, line, early, best[late])
                best[late[better]] = early[better]
                seen[late[new]] = early[new]
                beside[early[~new]] = True
                number[late] += 1
            beside[seen[number > 1]] = True
            late = np.flatnonzero(number)
            early = best[late]
            if len(late):
                yield pa.record_batch([doc[late], line[late], doc[early], line[early], number[late] > 1], names=NAMES)
                some = np.flatnonzero(beside)
                none = pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.int32())
                yield pa.record_batch([pa.array(doc[some]), pa.array(line[some]), *none, pa.array(np.ones(len(some), bool))], names=NAMES)
    return run


def settled_rows(percent: int):
    """Of open lines in a tile: those that an earlier line matches, without `by_doc`, and the pairs that hold a line without words."""
    def run(batches):
        for columns in whole_tiles(batches, [*BY_TILE, "open", "words"]):
            (_, n, _, _, doc, line, still, words), pairs = in_tiles(columns, percent)
            still, matched, a, b = still.copy(), np.zeros(len(n), bool), [], []
            long = n > CARRIED
            for late, early in pairs:
                late, early = late[still[late]], early[still[late]]
                known = ~(long[late] | long[early])
                a.append(late[~known])
                b.append(early[~known])
                for x, y in zip(late[known].tolist(), early[known].tolist()):
                    same = overlap(words[x], words[y])
                    if same * 100 >= (len(words[x]) + len(words[y]) - same) * percent:
                        still[x], matched[x] = False, True
            some = np.flatnonzero(matched)
            a, b = (np.concatenate([*c, np.zeros(0, np.int64)]) for c in (a, b))
            for late, by_doc, by_line in ((some, pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.int32())), (a, doc[b], line[b])):
                if len(late):
                    yield pa.record_batch([pa.array(doc[late]), pa.array(line[late]), pa.array(by_doc), pa.array(by_line),
                                           pa.array(np.zeros(len(late), bool))], names=NAMES)
    return run


def slots(doc: np.ndarray, line: np.ndarray, bits: int) -> np.ndarray:
    return mix(mix(doc.astype(np.int64).view(np.uint64)) + line.astype(np.uint64)) & np.uint64(bits - 1)


def slot_rows(bits: int):
    def run(batches):
        for batch in batches:
            at = slots(batch.column(0).to_numpy(), batch.column(1).to_numpy(), bits)
            cell, bit = (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))
            yield pa.record_batch([pa.array(cell), pa.array(bit.view(np.int64))], names=["cell", "bit"])
    return run


def slot_table(lines: DataFrame) -> np.ndarray:
    """A bit table of lines (doc_id, line), `SLOTS` bits for each and `BITS` at most at any size; other lines share some of their bits."""
    bits = min(BITS, max(1 << 16, 1 << (SLOTS * lines.count()).bit_length()))
    found = map_rows(lines, slot_rows(bits), "cell long, bit long").groupBy("cell").agg(F.bit_or("bit").alias("bit")).toArrow()
    table = np.zeros(bits >> 6, np.uint64)
    table[found["cell"].to_numpy()] = found["bit"].to_numpy().view(np.uint64)
    return table


def wanted_rows(table: np.ndarray):
    """The sorted words of the lines whose bits are set."""
    def run(batches):
        for batch, texts in slices(batches):
            lines = [t.split("\n") for t in texts]
            text_of = np.repeat(np.arange(len(texts)), [len(own) for own in lines])
            line_of = np.concatenate([np.arange(len(own)) for own in lines])
            doc = batch.column(0).to_numpy()[text_of]
            at = slots(doc, line_of, len(table) << 6)
            some = np.flatnonzero(table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1))
            if len(some):
                flat = [x for own in lines for x in own]
                hashes, counts = word_hashes([flat[k] for k in some])
                words = [np.unique(part.view(np.int64)) for part in np.split(hashes, np.cumsum(counts)[:-1])]
                yield pa.record_batch([pa.array(doc[some], pa.int64()), pa.array(line_of[some], pa.int32()),
                                       pa.array(words, pa.list_(pa.int64()))], names=["doc_id", "line", "words"])
    return run


def duplicate_lines(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, line): the lines that an earlier one matches, numbered from 0."""
    rows = id_text(docs, id_col, text_col).filter(F.col("doc_id").isNotNull())
    frequent = frequent_words(rows)
    lines = written(map_rows(rows, line_rows(percent, frequent),
                             "doc_id long, line int, n int, hi long, lo long, parity binary, keys array<long>"), "lines", TEXTS)
    # equal sets have equal keys; one number for a line's place lets Spark aggregate by hash, not by sorting
    place = F.col("doc_id").cast("decimal(19,0)") * F.lit(LINE).cast("decimal(10,0)") + F.col("line").cast("decimal(10,0)")
    by_line = F.pmod("first", F.lit(LINE).cast("decimal(10,0)"))
    by_doc = F.expr(f"(first - by_line) div {LINE}bd")
    classes = written(lines.groupBy("hi", "lo", "n", "parity", "keys").agg(F.min(place).alias("first"), F.count("*").alias("copies"))
                      .withColumn("by_line", by_line).withColumn("by_doc", by_doc)
                      .select("hi", "lo", F.col("by_doc").alias("doc_id"), F.col("by_line").cast("int").alias("line"), "n", "parity", "keys", "copies"), "classes")
    several = classes.filter("copies > 1").select("hi", "lo", F.col("doc_id").alias("by_doc"), F.col("line").alias("by_line"))
    copies = written(lines.select("doc_id", "line", "hi", "lo").join(several, ["hi", "lo"])
                     .filter("doc_id != by_doc or line != by_line").select("doc_id", "line").distinct(), "copies")
    discard(lines)
    first_of_class = classes.select("doc_id", "line", "n", "parity", "keys")
    band = F.floor(F.log(F.col("n").cast("double")) / np.log(100 / percent) + 1e-9)
    # a word is one tile; a very frequent one has a tile for each two neighbouring size bands,
    # where a negative place marks the upper band, whose own pairs belong to the next tile
    place = F.col("place") + 1
    tiles = F.when((F.col("key") >= 0) | (F.col("key") < frequent[2] - (1 << 63)), F.array(F.struct(F.col("key").alias("tile"), place.alias("place")))).otherwise(
        F.array(F.struct(F.xxhash64("key", band).alias("tile"), place.alias("place")),
                F.struct(F.xxhash64("key", band - 1).alias("tile"), (-place).alias("place"))))

    def tiled(some: DataFrame, *more: str) -> DataFrame:
        return (some.select("doc_id", "line", "n", "parity", *more, F.posexplode("keys").alias("place", "key"))
                .select("doc_id", "line", "n", "parity", *more, F.explode(tiles).alias("t"))
                .select("t.tile", "n", "t.place", "parity", "doc_id", "line", *more))

    def dealt(these: DataFrame) -> DataFrame:
        return these.repartition("tile").sortWithinPartitions("tile")

    def verified(pairs: DataFrame) -> DataFrame:
        """(doc_id, line) of those that match."""
        by = words.select(F.col("doc_id").alias("by_doc"), F.col("line").alias("by_line"), F.col("words").alias("by_words"))
        same = F.size(F.array_intersect("words", "by_words"))
        return (pairs.join(words, ["doc_id", "line"]).join(by, ["by_doc", "by_line"])
                .filter(same * 100 >= (F.size("words") + F.size("by_words") - same) * percent)
                .select("doc_id", "line").distinct())

    theirs = F.col("by_doc").alias("doc_id"), F.col("by_line").alias("line")
    pairs = written(map_rows(dealt(tiled(first_of_class)), earlier_rows(percent), PAIRS).distinct(), "pairs")
    late = pairs.filter("by_doc is not null")
    # all words that are asked for below, in one reading of the texts, which stay where they are; the
    # few further lines that share a bit find no partner in the joins
    wanted = slot_table(pairs.select("doc_id", "line").unionAll(late.select(*theirs)))
    words = written(map_rows(rows, wanted_rows(wanted), "doc_id long, line int, words array<long>"), "words", TEXTS)
    first = written(late.groupBy("doc_id", "line")
                    .agg(F.min(F.struct("by_doc", "by_line")).alias("by"), F.max("more").alias("more"), F.max(F.struct("by_doc", "by_line")).alias("last"))
                    .select("doc_id", "line", "by.by_doc", "by.by_line", (F.col("more") | (F.col("by") != F.col("last"))).alias("more")), "first")
    gone = written(copies.unionAll(verified(first)), "gone")
    discard(copies)
    unsettled = written(first.filter("more").join(gone, ["doc_id", "line"], "left_anti").select("doc_id", "line"), "unsettled")
    if not unsettled.isEmpty():
        beside = (pairs.filter("by_doc is null").select("doc_id", "line")
                  .unionAll(late.join(unsettled, ["doc_id", "line"], "left_semi").select(*theirs)))
        members = written(beside.withColumn("open", F.lit(False)).unionAll(unsettled.withColumn("open", F.lit(True)))
                          .groupBy("doc_id", "line").agg(F.max("open").alias("open")), "members")
        few = (first_of_class.join(members, ["doc_id", "line"]).join(words, ["doc_id", "line"])
               .withColumn("words", F.when(F.col("n") <= CARRIED, F.col("words"))))
        rest = written(map_rows(dealt(tiled(few, "open", "words")), settled_rows(percent), PAIRS).distinct(), "rest")
        found = rest.filter("by_doc is null").select("doc_id", "line")
        open_pairs = rest.filter("by_doc is not null").join(found.distinct(), ["doc_id", "line"], "left_anti").drop("more")
        gone = gone.unionAll(found)
        if not open_pairs.isEmpty():
            gone = gone.unionAll(verified(open_pairs))
    return gone.distinct()


def without_lines(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs`, with the same columns, less the lines of `gone`; documents that keep no line go."""
    listed = gone.groupBy("doc_id").agg(F.collect_list("line").alias("__gone")).withColumnRenamed("doc_id", "__id")
    lost = F.coalesce("__gone", F.array().cast("array<int>"))
    kept = F.filter(F.split(F.col(text_col), "\n", -1), lambda _, k: ~F.array_contains(lost, k))
    return (docs.join(listed, F.col(id_col) == F.col("__id"), "left")
            .withColumn("__kept", kept).filter("__gone is null or size(filter(__kept, x -> x != '')) > 0")
            .withColumn(text_col, F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(F.array_join("__kept", "\n")))
            .drop("__gone", "__id", "__kept"))
