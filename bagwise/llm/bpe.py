"""Operator 2: BPE encoding and decoding by tree concatenation.

A long text is halved until its leaves hold at most `leaf` characters, cut
anywhere, inside words too. The leaves are encoded, and each join re-encodes
a window around the cut that grows until its tokens agree with the tokens of
both sides.

Why agreement is enough: a token sequence is the BPE encoding of its text
when each adjacent pair of tokens is, since merges depend on nothing farther
away. Pairs before the agreed tokens are pairs of the left side, those inside
the window are pairs of the window's own encoding, those after it belong to
the right side. Ids tell where words end, so several agreed tokens also fix
the state of the word splitter.

Defined cases: null and empty texts have no ids and decode to the empty text;
repeated rows and repeated or null ids are encoded row by row; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bagwise.llm.common import id_text, map_rows, slices

LEAF = 8192          # characters of a leaf
WINDOW = 64          # characters of the first window on either side of a cut
AGREE = 4            # tokens that must agree on either side
SPREAD = 1 << 20     # texts with more characters are encoded by several tasks
CACHED = 300_000     # words whose ids a worker remembers

#: A word of small letters and its punctuation: two words for the tokenizer, with the same ids side by side.
PLAIN = re.compile("([a-z\u00df-\u00f6\u00f8-\u00ff]+)([.,;:!?*%$#&]*)")
SPACE = re.compile("[ \t\n\r\x0b\x0c]+")
#: str.split() also splits here, the tokenizer doesn't.
SEPARATORS = re.compile("[\x1c-\x1f]")


class Encoder:
    """The tokenizer of `path`, asked once for each word that it hasn't met yet.

    White space always ends a word for it, so a text's ids are its words' ids.
    """

    def __init__(self, path: str, cached: int = CACHED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on each core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cached, self.known = cached, {}
        # the byte-level alphabet: bytes that can't be printed stand at 256 and up
        odd = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
        shown = {b: chr(256 + odd.index(b)) if b in odd else chr(b) for b in range(256)}
        self.bytes = {c: "".join(shown[b] for b in chr(c).encode()) for c in range(128, 256)}
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.tokens = [self.tokenizer.id_to_token(i) or "" for i in range(size)]

    @staticmethod
    def words(text: str) -> list[str]:
        if SEPARATORS.search(text):
            return [w for w in SPACE.split(text) if w]
        if "<|" not in text:  # a special token in capitals is none
            try:
                text.encode("latin-1")
                text = text.lower()  # as the tokenizer does: more words are known
            except UnicodeEncodeError:
                pass
        return text.split()

    def lookup(self, words: list[str]) -> list[bytes]:
        """The ids of words that aren't known."""
        model, known, out, others = self.tokenizer.model, self.known, [], []
        for i, word in enumerate(words):
            plain = PLAIN.fullmatch(word)
            if plain is None:
                others.append(i)
                out.append(b"")
                continue
            ids = b""
            for part in filter(None, plain.groups()):
                found = known.get(part)
                if found is None:
                    found = np.array([t.id for t in model.tokenize(part.translate(self.bytes))], "<u4").tobytes()
                    if part is not word and len(known) < self.cached and len(part) <= 64:
                        known[part] = found
                ids += found
            out.append(ids)
        for i, e in zip(others, self.tokenizer.encode_batch_fast([words[i] for i in others], add_special_tokens=False)):
            out[i] = np.array(e.ids, "<u4").tobytes()
        return out

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        known, out, open_texts, new = self.known, [], [], {}
        for text in texts:
            words = self.words(text)
            ids = list(map(known.get, words))
            if None in ids:
                open_texts.append((len(out), words, ids))
                new.update((w, b"") for w, x in zip(words, ids) if x is None)
            out.append(ids)
        for word, ids in zip(list(new), self.lookup(list(new))):
            new[word] = ids
            if len(known) < self.cached and len(word) <= 64:
                known[word] = ids
        for i, words, ids in open_texts:
            out[i] = [new[w] if x is None else x for w, x in zip(words, ids)]
        return [b"".join(ids) for ids in out]

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode_many([text])[0], "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """As the library joins tokens for a file without a decoder."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def join_at(text: str, lo: int, cut: int, hi: int, left: np.ndarray, right: np.ndarray,
            encode: Callable[[str], np.ndarray], window: int = WINDOW, agree: int = AGREE) -> np.ndarray:
    """Ids of text[lo:hi] from those of text[lo:cut] and text[cut:hi]."""
    while True:
        a, b = max(lo, cut - window), min(hi, cut + window)
        whole = encode(text[a:b])
        if (a, b) == (lo, hi):
            return whole
        first, last = 0, len(whole)  # what is taken of the window
        keep_left, keep_right = 0, len(right)
        good = True
        if a > lo:
            own = encode(text[a:cut])
            same = common(own[::-1], left[::-1])   # from here on the window's left part is in step
            first, keep_left = len(own) - same, len(left) - same
            good = common(whole, own) - first >= agree
        if good and b < hi:
            own = encode(text[cut:b])
            keep_right = common(own, right)
            after = len(own) - keep_right
            last = len(whole) - after
            good = common(whole[::-1], own[::-1]) - after >= agree
        if good and first < last:
            tail = right[keep_right:] if b < hi else right[:0]
            return np.concatenate([left[:keep_left], whole[first:last], tail])
        window *= 2


def leaves(lo: int, hi: int, leaf: int) -> list[tuple[int, int]]:
    if hi - lo <= leaf:
        return [(lo, hi)]
    cut = (lo + hi) // 2
    return leaves(lo, cut, leaf) + leaves(cut, hi, leaf)


def concatenate(text: str, lo: int, hi: int, leaf: int, ids: Iterator[np.ndarray],
                encode: Callable[[str], np.ndarray], window: int = WINDOW) -> np.ndarray:
    """Join the ids of the leaves of text[lo:hi], up the tree."""
    if hi - lo <= leaf:
        return next(ids)
    cut = (lo + hi) // 2
    left = concatenate(text, lo, cut, leaf, ids, encode, window)
    right = concatenate(text, cut, hi, leaf, ids, encode, window)
    return join_at(text, lo, cut, hi, left, right, encode, window)


def tree_encode_many(texts: list[str], encoder: Encoder, leaf: int = LEAF, window: int = WINDOW) -> list[np.ndarray]:
    spans = [leaves(0, len(t), leaf) for t in texts]
    parts = encoder.encode_many([t[lo:hi] for t, own in zip(texts, spans) for lo, hi in own])
    ids = (np.frombuffer(p, "<u4") for p in parts)
    return [concatenate(t, 0, len(t), leaf, ids, encoder.encode, window) for t in texts]


_encoders: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """One for each Python worker and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


OUT = "doc_id long, ids binary, decoded string"
OUT_ARROW = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])


def encode_rows(path: str, leaf: int, window: int):
    def run(batches):
        encoder = encoder_of(path)
        for batch, texts in slices(batches):
            ids = tree_encode_many(texts, encoder, leaf, window)
            yield pa.record_batch([batch.column(0), pa.array([x.tobytes() for x in ids], pa.binary()),
                                   pa.array([encoder.decode(x) for x in ids], pa.string())], schema=OUT_ARROW)
    return run


def encode_parts(path: str, leaf: int, window: int):
    """Parts of very long texts: the ids of each."""
    def run(batches):
        encoder = encoder_of(path)
        for batch, texts in slices(batches, "part"):
            ids = tree_encode_many(texts, encoder, leaf, window)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x.tobytes() for x in ids], pa.binary())],
                                             names=[*batch.schema.names, "ids"])
    return run


def join_parts(path: str, window: int):
    """The parts of a text, in order, two by two up to the whole."""
    def run(batches):
        encoder = encoder_of(path)
        for batch in batches:
            for row in batch.to_pylist():
                parts = [(p["part"], np.frombuffer(p["ids"], "<u4")) for p in row["parts"]]
                while len(parts) > 1:
                    up = [(a + b, join_at(a + b, 0, len(a), len(a) + len(b), x, y, encoder.encode, window))
                          for (a, x), (b, y) in zip(parts[::2], parts[1::2])]
                    parts = up + parts[2 * len(up):]
                ids = parts[0][1]
                yield pa.record_batch([pa.array([row["doc_id"]], pa.int64()), pa.array([ids.tobytes()], pa.binary()),
                                       pa.array([encoder.decode(ids)], pa.string())], schema=OUT_ARROW)
    return run


def bpe_encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                      leaf: int = LEAF, window: int = WINDOW, spread: int = SPREAD) -> DataFrame:
    """(doc_id, ids, decoded) of every row.

    `ids` holds little-endian unsigned 32-bit integers. A text of up to
    `spread` characters is encoded inside the task that has read it; parts of
    longer ones are dealt out to all tasks and joined afterwards.
    """
    rows = id_text(docs, id_col, text_col)
    usual = map_rows(rows.filter(F.length("text") <= spread), encode_rows(tokenizer, leaf, window), OUT)
    parts = (rows.filter(F.length("text") > spread)
             .select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
             .withColumn("k", F.explode(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / spread).cast("int"))))
             .select("doc_id", "row", "k", F.substr("text", F.col("k") * spread + 1, F.lit(spread)).alias("part"))
             .repartition("row", "k"))
    parts = map_rows(parts, encode_parts(tokenizer, leaf, window), "doc_id long, row long, k int, part string, ids binary")
    whole = (parts.groupBy("doc_id", "row")
             .agg(F.sort_array(F.collect_list(F.struct("k", "part", "ids"))).alias("parts"))
             .select("doc_id", "parts"))
    return usual.unionByName(map_rows(whole, join_parts(tokenizer, window), OUT))
