"""Operator 5: I-Match fingerprints, with DataFrame functions only.

A document's terms are its distinct lower-cased words whose inverse document
frequency lies in a band: words of at least `MIN_DF` documents, and of at most
`MAX_SHARE` of them. These terms are the lexicon. Its subsets are the whole
lexicon and randomised ones of several sizes, drawn by hashes of a term, that
overlap: every term is in the first and by chance in others. The fingerprint
holds a hash of the set of terms of each subset that are in the document (the
exclusive or of their hashes); a subset without any stands as "-". Two
fingerprints are alike by the share of equal hashes among the subsets that
either has terms of: long texts agree or differ in the small subsets, short
ones in the large.

No (document, term) pair is shuffled but into the counts. Of a document's own
words only two kinds are outside the lexicon: the frequent ones, fewer than
(mean distinct terms / MAX_SHARE), which a broadcast list drops, and those that
no other document has, which the counts send back to their one document as a
list. The edited text holds words of the document, words of the next one, and
the few that the cuts make; only these are looked up. So the terms are taken,
sifted and hashed where the texts are dealt by id.

Each document is also compared with its edited text and with the next
document; see `fingerprints`.

Defined cases: null and empty texts, and texts without a term of the lexicon,
have the hash of the whole text as fingerprint; such fingerprints are alike
(1) or not (0); rows that share an id have the fingerprint of all their terms,
and the first of their texts is the one that the previous document's edited
text takes; rows without id have no next document, no fingerprint terms and so
the hash of the whole text; an empty table gives an empty table; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bagwise.llm.common import id_text, written
from bagwise.operators.joins import join_hot

MIN_DF = 2
MAX_SHARE = 0.1
LEAST_MAX = 8        # documents that a term of a small collection may be in anyway
#: (subsets, bits): each holds one in 2 ** bits terms of the lexicon
SUBSETS = ((1, 0), (4, 1), (8, 3), (8, 5), (8, 7))
N_SUBSETS = sum(n for n, _ in SUBSETS)
SEPARATORS = "[\\s.,;:!?\"()]+"
BITS = 12            # ids are ordered in blocks of 2 ** BITS ids, those in blocks of as many, ...


def members(term: Column) -> list[Column]:
    """Of each subset: whether a hashed term belongs to it."""
    out = []
    for n, bits in SUBSETS:
        drawn = F.xxhash64(term, F.lit(bits))  # n * bits of its bits
        out += [F.shiftright(drawn, i * bits).bitwiseAND((1 << bits) - 1) == 0 for i in range(n)]
    return out


def terms(text: Column) -> Column:
    """The distinct hashed words."""
    words = F.split(F.lower(text), SEPARATORS)
    return F.array_distinct(F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w)))


def following(keys: DataFrame, levels: int = 4) -> DataFrame:
    """(key, next) for distinct longs: `next` is the `first` of the next larger key.

    Windows are over blocks of at most 2 ** BITS keys; a block's last key takes the
    first of the next block, by the same rule. The last level has at most
    2 ** (64 - levels * BITS) keys.
    """
    if levels == 0:
        return keys.select("key", F.lead("first").over(Window.orderBy("key")).alias("next"))
    blocked = keys.withColumn("block", F.shiftright("key", BITS))
    blocks = following(blocked.groupBy("block").agg(F.min("first").alias("first")).withColumnRenamed("block", "key"), levels - 1)
    near = blocked.withColumn("near", F.lead("first").over(Window.partitionBy("block").orderBy("key")))
    return (near.join(blocks.select(F.col("key").alias("block"), "next"), "block")
            .select("key", F.coalesce("near", "next").alias("next")))


def hashes(pairs: DataFrame) -> DataFrame:
    """(doc_id, parts, edited_parts) from (doc_id, term, flags): of each subset, in order, the hash of its terms, or "-".

    `pairs` dealt by doc_id stay as they are.
    """
    # a term counts once for an id, so that equal ones of several rows don't cancel
    once = pairs.groupBy("doc_id", "term").agg(F.bit_or("flags").alias("flags"))
    drawn = once.select("doc_id", "term", "flags", *(m.alias(f"in_{j}") for j, m in enumerate(members(F.col("term")))))

    def one(flag: int, j: int) -> Column:
        return F.bit_xor(F.when(F.col(f"in_{j}") & (F.col("flags").bitwiseAND(flag) != 0), F.col("term")))

    def parts(name: str) -> Column:
        return F.array(*(F.coalesce(F.lower(F.lpad(F.hex(f"{name}_{j}"), 16, "0")), F.lit("-")) for j in range(N_SUBSETS)))
    by_id = drawn.groupBy("doc_id").agg(*(one(flag, j).alias(f"{name}_{j}") for flag, name in ((1, "own"), (2, "other")) for j in range(N_SUBSETS)))
    return by_id.select("doc_id", parts("own").alias("parts"), parts("other").alias("edited_parts"))


def fingerprint(parts: Column, text_hash: Column) -> Column:
    empty = parts.isNull() | ~F.exists(parts, lambda p: p != "-")
    return F.when(empty, F.concat(F.lit("text:"), text_hash)).otherwise(F.array_join(parts, "."))


def likeness(a: Column, b: Column) -> Column:
    """Of two fingerprints, 0 to 1."""
    x, y = F.split(a, "\\."), F.split(b, "\\.")
    both = F.zip_with(x, y, lambda p, q: F.struct(p.alias("p"), q.alias("q")))
    either = F.filter(both, lambda z: (z["p"] != "-") | (z["q"] != "-"))
    same = F.filter(either, lambda z: z["p"] == z["q"])
    whole = a.startswith("text:") | b.startswith("text:")
    return F.when(a == b, F.lit(1.0)).when(whole | a.isNull() | b.isNull(), F.lit(0.0)).otherwise(F.size(same) / F.size(either))


def edited_texts(rows: DataFrame, after: DataFrame, lone: DataFrame | None = None) -> DataFrame:
    """(doc_id, next_id, text, edited, piece) of the rows with an id: the last quarter replaced by `piece`, the first
    as many code points of the next document. With `lone` (doc_id, lone) also the lists of both: lone, next_lone.

    Dealt by doc_id. The texts are shuffled once: both joins take them as they are dealt, and lag() marks the
    first text of an id.
    """
    # as many code points of the next text as any row of this id needs
    need = (rows.groupBy("doc_id").agg(F.max(F.floor(F.length("text") / 4)).alias("need")).join(after, "doc_id")
            .select(F.col("doc_id").alias("of"), F.col("next_id").alias("doc_id"), "need"))
    known = rows.filter("doc_id is not null").repartition("doc_id")
    firsts = known.withColumn("before", F.lag("doc_id").over(Window.partitionBy("doc_id").orderBy("text"))).filter("before is null").drop("before")
    heads = firsts.join(need, "doc_id")
    lists = []
    if lone is not None:
        heads = heads.join(lone.withColumnRenamed("lone", "next_lone"), "doc_id", "left")
        known = known.join(lone, "doc_id", "left")
        lists = ["lone", "next_lone"]
    heads = heads.select(F.col("of").alias("doc_id"), F.col("doc_id").alias("next_id"),
                         F.substr("text", F.lit(1), F.col("need").cast("int")).alias("head"), *lists[1:])
    cut = F.floor(F.length("text") / 4).cast("int")
    piece = F.substr(F.coalesce("head", F.lit("")), F.lit(1), cut)
    return (known.join(heads, "doc_id", "left").withColumn("piece", piece)
            .select("doc_id", "next_id", "text", F.concat(F.substr("text", F.lit(1), F.length("text") - cut), "piece").alias("edited"), "piece", *lists))


def next_ids(rows: DataFrame) -> DataFrame:
    """(doc_id, next_id): the next larger id; after the last, the first."""
    ids = rows.filter("doc_id is not null").select(F.col("doc_id").alias("key")).distinct()
    first = ids.agg(F.min("key")).first()[0]
    return following(ids.withColumn("first", F.col("key"))).select(
        F.col("key").alias("doc_id"), F.coalesce("next", F.lit(first).cast("long")).alias("next_id"))


def cut_terms() -> Column:
    """Terms of an edited text that may be in neither document: not the document's nor the piece's, and the piece's last."""
    own, other, piece = (terms(F.col(c)) for c in ("text", "edited", "piece"))
    words = F.filter(F.split(F.lower("piece"), SEPARATORS), lambda w: w != "")
    last = F.transform(F.slice(words, -1, 1), lambda w: F.xxhash64(w))
    return F.array_union(F.array_except(other, F.array_union(own, piece)), F.when(F.size(words) > 0, last).otherwise(F.array().cast("array<long>")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each row."""
    rows = id_text(docs, id_col, text_col)
    total = rows.count()
    most = max(LEAST_MAX, MAX_SHARE * total)
    counts = written(rows.select("doc_id", F.explode(terms(F.col("text"))).alias("term")).groupBy("term")
                     .agg(F.count("*").alias("df"), F.min("doc_id").alias("only")), "counts")
    frequent = counts.filter(F.col("df") > most).select("term")  # bounded: see above
    band = counts.filter((F.col("df") >= MIN_DF) & (F.col("df") <= most)).select("term")
    lone = written(counts.filter(F.col("df") < MIN_DF).groupBy(F.col("only").alias("doc_id"))
                   .agg(F.collect_list("term").alias("lone")).filter("doc_id is not null"), "lone")
    after = written(next_ids(rows), "after")
    sizes = (F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("sha256"))
    info = (edited_texts(rows, after).select("doc_id", "next_id", *sizes, F.sha2("edited", 256).alias("edited_sha256"), cut_terms().alias("cut")))
    kept = F.substr("text", F.lit(1), F.length("text") - F.floor(F.length("text") / 4).cast("int"))
    without_id = rows.filter("doc_id is null").select(
        "doc_id", F.lit(None).cast("long").alias("next_id"), *sizes, F.sha2(kept, 256).alias("edited_sha256"), F.array().cast("array<long>").alias("cut"))
    info = written(info.unionByName(without_id), "info")
    asked = written(info.filter("doc_id is not null").select("doc_id", F.explode("cut").alias("term")).distinct(), "asked")
    found = join_hot(asked, band, "term").groupBy("doc_id").agg(F.collect_set("term").alias("held"))
    unheld = written(asked.groupBy("doc_id").agg(F.collect_set("term").alias("cut")).join(found, "doc_id", "left")
                     .select("doc_id", F.array_except("cut", F.coalesce("held", F.array().cast("array<long>"))).alias("unheld")), "unheld")

    def marked(held: Column, flags: int) -> Column:
        return F.transform(held, lambda t: F.struct(t.alias("term"), F.lit(flags).alias("flags")))
    none = F.array().cast("array<long>")
    outside = F.array_union(F.coalesce("lone", none), F.array_union(F.coalesce("next_lone", none), F.coalesce("unheld", none)))
    sifted = (edited_texts(rows, after, lone).join(unheld, "doc_id", "left")
              .select("doc_id", F.array_except(terms(F.col("text")), F.coalesce("lone", none)).alias("own"),
                      F.array_except(terms(F.col("edited")), outside).alias("other")))
    flagged = F.concat(marked(F.array_intersect("own", "other"), 3), marked(F.array_except("own", "other"), 1),
                       marked(F.array_except("other", "own"), 2))
    pairs = (sifted.select("doc_id", F.explode(flagged).alias("t")).select("doc_id", "t.term", "t.flags")
             .join(F.broadcast(frequent), "term", "left_anti").select("doc_id", "term", "flags"))
    parts = written(hashes(pairs), "parts")
    known = written(info.drop("cut").join(parts, "doc_id", "left")
                    .select("doc_id", "next_id", "n_chars", "edited_sha256", fingerprint(F.col("parts"), F.col("sha256")).alias("fingerprint"),
                            fingerprint(F.col("edited_parts"), F.col("edited_sha256")).alias("edited_fingerprint")), "known")
    following_one = known.groupBy(F.col("doc_id").alias("next_id")).agg(F.min("fingerprint").alias("next_fingerprint"))
    return known.join(following_one, "next_id", "left").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
