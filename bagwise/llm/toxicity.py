"""Operator 4: toxicity from subword-bag embeddings averaged into a linear softmax.

A word's vector is the mean of the vectors of its character n-grams (3 to 6,
with word ends, hashed), a window's vector the mean over its words, where a
repeated word counts once and missing ones as zero, and a linear softmax on it
tells the class. Embeddings and softmax are trained
jointly in numpy, with Adagrad, so an unseen misspelling shares most of its
n-grams with the word it stands for. A document's score is that of its most
toxic window: a few words in a long text are not averaged away. In training, a
toxic document's windows are toxic, of which each epoch keeps the more toxic
half; a clean document has only clean ones.

Every fifth row of the fit is kept from the training and sets the scale and
offset of the scores by logistic regression (all rows do if those are too few).

The fit takes at most `fit_rows` labelled rows of each class, chosen by a hash
of their ids, on the driver; scoring runs over every whole text.

For two classes the softmax needs one number of each n-gram (its embedding
times the difference of the class weights), and only those go to the tasks.

Defined cases: null and empty texts, and texts without words, score 0;
repeated rows are scored row by row; rows without id are scored and not held
out; without labelled rows of both classes no score exceeds 1e-9; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bagwise.llm.common import id_text, map_rows, slices
from bagwise.llm.ngram_join import mix

BUCKETS = 1 << 17    # hashed n-grams
SIZES = (3, 4, 5, 6)
DIMENSION = 16
WINDOW, STEP = 48, 24    # words
LEAST = 24               # a shorter window is averaged over so many words
FIT_ROWS = 2500          # labelled rows of a class that the fit sees at most
EPOCHS = 10           # and up to three times as many over few rows
#: Of Adagrad's sums for n-grams: what one n-gram in a few bags adds is small beside it, so rare ones move little.
START = 2e-9
CACHED = 400_000
EDGES = ".,;:!?*%$#&\"'()[]{}<>-_"


def words_of(text: str) -> list[str]:
    return [w.strip(EDGES) for w in text.lower().split()]


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Flat n-gram buckets of the words and where each word's begin; every word has one at least."""
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), "<u4").astype(np.uint64)
    lengths = np.array([len(w) + 2 for w in words], np.int64)
    ends, word = np.cumsum(lengths), np.repeat(np.arange(len(words)), lengths)
    owners, grams = [], []
    rolled = np.zeros(len(codes), np.uint64)
    for size in range(1, max(SIZES) + 1):
        n = len(codes) - size + 1
        if n <= 0:
            break
        rolled = mix(rolled[:n] * np.uint64(0x9E3779B97F4A7C15) + codes[size - 1:] + np.uint64(size))
        inside = np.arange(n) + size <= ends[word[:n]]
        if size in SIZES or size == 2:
            keep = inside if size in SIZES else inside & (lengths[word[:n]] == 2)
            owners.append(word[:n][keep])
            grams.append((rolled[keep] >> np.uint64(40)).astype(np.int64) % BUCKETS)
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner, gram = np.concatenate(owners), np.concatenate(grams)
    order = np.argsort(owner, kind="stable")
    return gram[order], np.searchsorted(owner[order], np.arange(len(words)))


@dataclass
class Model:
    """A number of each n-gram, and scale and offset of a window's mean."""
    grams: np.ndarray
    scale: float
    bias: float

    def word_scores(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(0, np.float32)
        grams, starts = subwords(words)
        return np.add.reduceat(self.grams[grams], starts) / np.diff(np.append(starts, len(grams)))

    def score(self, words: np.ndarray, per_word: np.ndarray) -> float:
        """Of the most toxic window; words as numbers."""
        if not len(words):
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(self.scale * most_toxic(words, per_word) + self.bias, -50, 50))))


def most_toxic(words: np.ndarray, per_word: np.ndarray) -> float:
    total, sizes = sums(words, per_word)
    return float((total / sizes).max())


def calibrated(values: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Scale and offset that turn values into probabilities (Platt's targets, Newton steps, a small ridge)."""
    n1, n0 = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([values / max(1e-9, np.abs(values).max()), np.ones(len(values))], axis=1)
    beta, ridge = np.zeros(2), np.array([1e-3, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9), x.T @ (target - p) - ridge * beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return max(1e-9, beta[0] / max(1e-9, np.abs(values).max())), beta[1]


def sums(words: np.ndarray, per_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each window: the sum over its words, without those that the WINDOW words before them hold, and its size."""
    n = len(words)
    order = np.argsort(words, kind="stable")
    again = np.zeros(n, bool)
    again[order[1:]] = (words[order[1:]] == words[order[:-1]]) & (order[1:] - order[:-1] < WINDOW)
    total = np.concatenate([[0.0], np.cumsum(np.where(again, 0.0, per_word), dtype=np.float64)])
    start = np.arange(0, max(1, n - WINDOW + STEP), STEP)
    end = np.minimum(start + WINDOW, n)
    return total[end] - total[start], np.maximum(LEAST, end - start)


def windows(n: int) -> list[tuple[int, int]]:
    return [(s, min(s + WINDOW, n)) for s in range(0, max(1, n - WINDOW + STEP), STEP)]


def fit(texts: list[str], toxic: list[int], epochs: int = EPOCHS, seed: int = 7, rate: float = 0.3) -> Model:
    """Embeddings, class weights and bias, trained jointly."""
    if len(set(toxic)) < 2:
        return Model(np.zeros(BUCKETS, np.float32), 1.0, -50.0)
    random = np.random.default_rng(seed)
    index: dict[str, int] = {}
    docs = [np.array([index.setdefault(w, len(index)) for w in words_of(t)], np.int64) for t in texts]
    toxic, back = np.array(toxic), np.arange(len(texts)) % 5 == 4
    if min((toxic[back] == 1).sum(), (toxic[back] == 0).sum()) < 10:
        back[:] = False
    grams, starts = subwords(list(index))
    counts = np.diff(np.append(starts, len(grams)))
    table = random.normal(0, 0.1, (BUCKETS, DIMENSION)).astype(np.float32)
    weight, bias = random.normal(0, 0.1, DIMENSION).astype(np.float32), np.zeros(1, np.float32)
    seen, seen_w, seen_b = np.full(BUCKETS, START, np.float32), np.full(DIMENSION, 1e-6, np.float32), np.full(1, 1e-6, np.float32)

    def step(bags: list[np.ndarray], labels: np.ndarray) -> None:
        sizes = np.array([max(LEAST, len(b)) for b in bags])
        bags = [np.unique(b) for b in bags]
        flat = np.concatenate(bags)
        used, at = np.unique(flat, return_inverse=True)
        own = counts[used]
        gram = grams[np.repeat(starts[used] - np.concatenate([[0], np.cumsum(own)[:-1]]), own) + np.arange(own.sum())]
        edges = np.concatenate([[0], np.cumsum(own)[:-1]])
        vectors = np.add.reduceat(table[gram], edges, axis=0) / own[:, None]
        held = np.array([len(b) for b in bags])
        bag_of = np.repeat(np.arange(len(bags)), held)
        mean = np.add.reduceat(vectors[at], np.concatenate([[0], np.cumsum(held)[:-1]]), axis=0) / sizes[:, None]
        p = 1 / (1 + np.exp(-np.clip(mean @ weight + bias[0], -30, 30)))
        error = ((p - labels) / len(labels)).astype(np.float32)
        # one number of each word: its part in the bags' errors; its n-grams share it
        part = np.bincount(at, weights=error[bag_of] / sizes[bag_of], minlength=len(used)) / own
        per_gram = np.bincount(gram, weights=np.repeat(part, own), minlength=BUCKETS).astype(np.float32)
        touched = np.flatnonzero(per_gram)
        gradient_w, gradient_b = mean.T @ error, error.sum()
        seen[touched] += per_gram[touched] ** 2 * (weight @ weight)
        table[touched] -= rate * (per_gram[touched] / np.sqrt(seen[touched]))[:, None] * weight
        seen_w[:] += gradient_w ** 2
        seen_b[:] += gradient_b ** 2
        weight[:] -= rate * gradient_w / np.sqrt(seen_w)
        bias[:] -= rate * gradient_b / np.sqrt(seen_b)

    def per_word() -> np.ndarray:
        return np.add.reduceat((table @ weight)[grams], starts) / counts

    for epoch in range(int(np.clip(30_000 // len(docs), epochs, 3 * epochs))):
        bags, labels = [], []
        scores = per_word() if epoch else None
        for words, label, kept_back in zip(docs, toxic, back):
            if kept_back or not len(words):
                continue
            if epoch == 0:
                bags.append(words)
                labels.append(label)
                continue
            spans = windows(len(words))
            total, sizes = sums(words, scores[words])
            worst = np.argsort(-total / sizes)
            # of a toxic document half of the windows, then a quarter, ... at last the most toxic one;
            # of a clean one the three that look most toxic, and two others
            picked = worst[:max(1, len(spans) >> min(epoch, 30))] if label else np.unique([*worst[:3], *random.integers(len(spans), size=2)])
            for k in picked.tolist():
                bags.append(words[slice(*spans[k])])
                labels.append(label)
        order, labels = random.permutation(len(bags)), np.array(labels)
        size = int(np.clip(len(order) // 40, 8, 256))  # some steps for small samples too
        for i in range(0, len(order), size):
            some = order[i:i + size]
            step([bags[k] for k in some], labels[some])
    scores = per_word()
    some = [i for i in (np.flatnonzero(back) if back.any() else range(len(docs))) if len(docs[i])]
    scale, offset = calibrated(np.array([most_toxic(docs[i], scores[docs[i]]) for i in some]), toxic[some])
    return Model((table @ weight).astype(np.float32), scale, offset)


def score_rows(model: Model):
    def run(batches):
        known: dict[str, int] = {}
        scores = np.zeros(0)
        for batch, texts in slices(batches):
            split = [words_of(t) for t in texts]
            if len(known) > CACHED:
                known, scores = {}, np.zeros(0)
            new = list({w for words in split for w in words if w not in known})
            known.update(zip(new, range(len(known), len(known) + len(new))))
            scores = np.concatenate([scores, model.word_scores(new)])
            numbers = [np.array([known[w] for w in words], np.int64) for words in split]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([model.score(x, scores[x]) for x in numbers], pa.float64())],
                                  names=["doc_id", "held_out", "score"])
    return run


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, fit_rows: int) -> list:
    """At most `fit_rows` rows of each class that aren't held out."""
    known = labels.filter(F.col("doc_id").isNotNull() & ~held_out())
    picked = None
    for label in (0, 1):
        own = (known.filter(F.col("toxic") == label).select("doc_id", "toxic").distinct()
               .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows))
        picked = own if picked is None else picked.unionAll(own)
    return id_text(docs).join(F.broadcast(picked), "doc_id").select("text", "toxic").collect()


def toxicity_scores(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, held_out, score) of every row."""
    rows = sorted(labelled_sample(docs, labels, fit_rows), key=lambda r: hashlib.md5(r[0].encode()).digest())
    model = fit([r[0] for r in rows], [r[1] for r in rows])
    return map_rows(id_text(docs).select("doc_id", held_out().alias("held_out"), "text"), score_rows(model),
                    "doc_id long, held_out boolean, score double")
