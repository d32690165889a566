"""Operator 1: personal data by patterns and a skip-chain conditional random field.

Patterns find e-mail addresses, IP addresses, card numbers and phone numbers;
these spans always stay. The field labels a document's mentions: runs of digits
with separators, and words with digits or "@". Neighbouring mentions form a
chain; skip edges tie distant mentions that are the same or similar (the same
last digits, the same name before the "@"), so a number that a pattern
recognises in one place gets the same label where it is written otherwise.
Loopy belief propagation computes each mention's label; mentions of patterns
are observed. A mention becomes a further span if a skip edge ties it to
others and its label is an entity with probability `least` or more. Mentions
that neither a pattern nor a skip edge knows can't get a label and stand in no
chain, and a document in which no pattern finds anything has no further spans.

The factors (shape of a mention, label pairs along the chain, label pairs
along skip edges) are estimated piecewise from smoothed counts over all rows,
with the patterns' labels.

Defined cases: null and empty texts have no spans; repeated rows and repeated
or null ids are searched row by row; an empty table gives an empty table; other
columns are ignored. All patterns run in time linear in the text.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bagwise.llm.common import id_text, map_rows, slices

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
ROUNDS = 40          # of damped message passing, at most; it ends when the messages stand still
LEAST = 0.9
MISSED = 0.05        # how often a pattern misses an entity
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NUMBER = re.compile(r"[+(]?[0-9](?:[ ().-]{0,2}[0-9])*")
MARK = re.compile(r"[0-9@]")
EDGE = ".,;:!?()[]{}<>\"'"


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """From each "@": the characters before it, back to the last match, and the domain behind it."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            out.append((start, last))
        else:
            last = max(last, at)  # what comes before this sign can't belong to a later one
        at = text.find("@", max(last, at + 1))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """By kind, then start."""
    if not MARK.search(text):
        return []
    out = [("email", *s) for s in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", *m.span()))
    return out


def mentions(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, label) in order: the patterns' spans, and other numbers of 7 digits or more and words with marks."""
    taken = sorted((s, e, LABELS.index(kind)) for kind, s, e in base)
    nodes, last = [], 0
    for s, e, label in taken:
        if s >= last:
            nodes.append((s, e, label))
            last = e
    found, end = [], 0
    for m in MARK.finditer(text):
        if m.start() < end:
            continue
        number = NUMBER.match(text, m.start())
        s, e = number.span() if number else m.span()
        if number and sum(map(str.isdigit, number[0])) >= 7 and not text[e:e + 1].isalnum() and not text[s - 1:s].isalnum():
            end = e
        else:  # the word around it
            low = end
            while s > low and not text[s - 1].isspace():
                s -= 1
            while e < len(text) and not text[e].isspace():
                e += 1
            end = e
            while s < e and text[s] in EDGE:
                s += 1
            while e > s and text[e - 1] in EDGE:
                e -= 1
            if e - s < 5:
                continue
        found.append((s, e, 0))
    at = 0
    for s, e, _ in found:  # both in order: keep those that touch no span of a pattern
        while at < len(taken) and taken[at][1] <= s:
            at += 1
        if at == len(taken) or taken[at][0] >= e:
            nodes.append((s, e, 0))
    return sorted(nodes)


def shape(mention: str) -> str:
    digits = sum(c.isdigit() for c in mention)
    size = next(k for k, most in enumerate((0, 3, 6, 7, 15, 19, 1 << 62)) if digits <= most)
    return f"{size}{'@' * ('@' in mention)}{'a' * any(c.isalpha() for c in mention)}{'.' * (mention.count('.') == 3)}"


def keys(mention: str) -> list[str]:
    """What similar mentions have in common."""
    low = mention.lower()
    digits = "".join(c for c in low if c.isdigit())
    if "@" in low:
        return [f"word {low}", f"word {low.partition('@')[0]}"]
    if any(c.isalpha() for c in low):
        return [f"word {low}"]
    return [f"word {low}", f"digits {digits[-10:]}"] if len(digits) >= 7 else [f"word {low}"]


def skip_edges(texts: list[str]) -> list[tuple[int, int]]:
    """Each mention with the one before it that shares a key: as many edges as keys."""
    last: dict[str, int] = {}
    edges = {}
    for i, t in enumerate(texts):
        for key in dict.fromkeys(keys(t)):
            if key in last:
                edges[last[key], i] = None
            last[key] = i
    return list(edges)


def connected(nodes: list[tuple[int, int, int]], words: list[str]) -> tuple[list[tuple[int, int, int]], list[str], list[tuple[int, int]]]:
    """The mentions that a pattern labels or a skip edge ties, and the skip edges between them.

    Any other mention can't get a label, nor does it say anything of its
    neighbours', so it stands in no chain.
    """
    edges = skip_edges(words)
    tied = {i for e in edges for i in e}
    kept = [i for i, (_, _, label) in enumerate(nodes) if label or i in tied]
    at = {i: k for k, i in enumerate(kept)}
    return [nodes[i] for i in kept], [words[i] for i in kept], [(at[i], at[j]) for i, j in edges]


def count_rows(batches):
    """Counts of (factor, its value, label, label)."""
    for batch, texts in slices(batches):
        counts: dict[tuple[str, str, int, int], int] = defaultdict(int)
        for text in texts:
            nodes = mentions(text, base_spans(text))
            words = [text[s:e] for s, e, _ in nodes]
            for (_, _, label), w in zip(nodes, words):
                counts["shape", shape(w), label, 0] += 1
            nodes, _, edges = connected(nodes, words)
            for (_, _, a), (_, _, b) in zip(nodes, nodes[1:]):
                counts["chain", "", a, b] += 1
            for i, j in edges:
                counts["skip", "", nodes[i][2], nodes[j][2]] += 1
        if counts:
            yield pa.record_batch([*(pa.array(c) for c in zip(*counts)), pa.array(list(counts.values()))],
                                  names=["factor", "value", "a", "b", "n"])


class Field:
    """Log factors: by shape, along the chain, along skip edges."""

    def __init__(self, counts: list[tuple[str, str, int, int, int]]):
        size = len(LABELS)
        shapes = defaultdict(lambda: np.full(size, 0.5))
        # a skip edge ties equal or similar mentions: equal labels have a prior weight of some documents
        pairs = {"chain": np.full((size, size), 1.0), "skip": np.full((size, size), 0.1) + 20 * np.eye(size)}
        for factor, value, a, b, n in counts:
            if factor == "shape":
                shapes[value][a] += n
            elif a == b or factor == "chain":  # a differing label at a skip edge is one that a pattern missed
                pairs[factor][a, b] += n
        total = sum(shapes.values(), np.full(size, 0.5))
        self.shapes = {k: np.log(v / v.sum()) for k, v in shapes.items()}
        self.other = np.log(total / total.sum())
        self.missed = np.log([1.0] + [MISSED] * len(KINDS))
        for name, table in pairs.items():
            table = table + table.T
            alone = table.sum(1) / table.sum()
            setattr(self, name, np.log(table / table.sum() / np.outer(alone, alone)))

    def labels(self, nodes: list[tuple[int, int, int]], words: list[str], skips: list[tuple[int, int]]) -> np.ndarray:
        """Each mention's marginal probabilities, by loopy message passing along the chain and the skip edges."""
        n, size = len(nodes), len(LABELS)
        own = np.stack([self.shapes.get(shape(w), self.other) + self.missed for w in words])
        for i, (_, _, label) in enumerate(nodes):
            if label:
                own[i] = np.where(np.arange(size) == label, 0.0, -30.0)
        edges = {(i, i + 1): self.chain for i in range(n - 1)}
        edges |= {e: self.skip for e in skips}
        if not edges:
            return np.exp(own - np.logaddexp.reduce(own, axis=1, keepdims=True))
        a = np.array([e[0] for e in edges] + [e[1] for e in edges])
        b = np.array([e[1] for e in edges] + [e[0] for e in edges])
        tables = np.stack([*edges.values(), *(t.T for t in edges.values())])
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        sent = np.zeros((len(a), size))
        for _ in range(ROUNDS):
            belief = own.copy()
            np.add.at(belief, b, sent)
            out = np.logaddexp.reduce((belief[a] - sent[back])[:, :, None] + tables, axis=1)
            out -= np.logaddexp.reduce(out, axis=1, keepdims=True)
            done = np.abs(out - sent).max() < 1e-4
            sent = 0.5 * sent + 0.5 * out
            if done:
                break
        belief = own.copy()
        np.add.at(belief, b, sent)
        return np.exp(belief - np.logaddexp.reduce(belief, axis=1, keepdims=True))


def further_spans(text: str, base: list[tuple[str, int, int]], field: Field, least: float = LEAST) -> list[tuple[str, int, int]]:
    if not base:
        return []  # nothing in the document is observed to be an entity
    nodes = mentions(text, base)
    if all(label for _, _, label in nodes):
        return []
    nodes, words, skips = connected(nodes, [text[s:e] for s, e, _ in nodes])
    tied = {i for e in skips for i in e}
    if not tied:
        return []
    marginal = field.labels(nodes, words, skips)
    best = marginal[:, 1:].argmax(1) + 1
    return [(LABELS[best[i]], s, e) for i, (s, e, label) in enumerate(nodes)
            if not label and i in tied and marginal[i, best[i]] >= least]


SPANS = "doc_id long, spans array<struct<kind:string,start:int,end:int,base:boolean>>"
SPAN_KIND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


def span_rows(field: Field, least: float):
    def run(batches):
        for batch, texts in slices(batches):
            out = []
            for text in texts:
                base = base_spans(text)
                every = [(*s, True) for s in base] + [(*s, False) for s in further_spans(text, base, field, least)]
                every.sort(key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
                out.append([dict(zip(("kind", "start", "end", "base"), s)) for s in every])
            yield pa.record_batch([batch.column(0), pa.array(out, SPAN_KIND)], names=["doc_id", "spans"])
    return run


def fitted(rows: DataFrame) -> Field:
    counts = (map_rows(rows, count_rows, "factor string, value string, a long, b long, n long")
              .groupBy("factor", "value", "a", "b").agg(F.sum("n")).collect())  # shapes and labels: some hundred rows
    return Field(sorted(map(tuple, counts)))


def find_personal_data(docs: DataFrame, least: float = LEAST, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """(doc_id, spans) of every row: spans by kind as listed, then start; code points, end exclusive."""
    rows = id_text(docs, id_col, text_col)
    return map_rows(rows, span_rows(fitted(rows), least), SPANS)


def mask_rows(field: Field, least: float):
    """Texts with each span replaced by its kind in brackets."""
    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = []
            for text in batch.column(at).to_pylist():
                base = base_spans(text or "")
                last = 0
                parts = []
                for kind, s, e in sorted(base + further_spans(text or "", base, field, least), key=lambda x: (x[1], -x[2])):
                    if s >= last:
                        parts += [text[last:s], f"[{kind}]"]
                    elif e > last:
                        parts.append(f"[{kind}]")
                    last = max(last, e)
                texts.append(text if not last else "".join(parts) + text[last:])
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
    return run


def without_personal_data(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """`docs`, with the same columns, personal data in `text` masked."""
    return map_rows(docs, mask_rows(fitted(id_text(docs)), least), docs.schema)
