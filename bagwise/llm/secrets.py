"""Operator 3: secrets by patterns, and by the cost of guessing a credential's value.

Patterns find assignments to credential names, access keys and long runs of
hexadecimal digits; these spans always stay. Further, what stands behind a
wider range of credential words is cut into words, dates, repeats, keyboard
walks and brute-force stretches so that guessing it piece by piece costs the
least (dynamic programming over all cuts). Every such value is costed, those of
assignments too; one outside the patterns' spans that still needs 10 ** `least`
guesses or more is a secret, of kind "value".

A word costs its inverse frequency in all documents: all their words are
counted, and the counts meet the parts of the values in a join. Words as pieces
have `WORD_LENGTHS` letters; a repeat, a walk or a repeated piece has `LOOK_BACK`
characters at most (a longer one is cut there), so a very long value takes time
and memory in proportion to its length. Its parts leave a task a block at a time.

Defined cases: null and empty texts have no spans; repeated rows and repeated
or null ids are searched row by row; an empty table gives an empty table; other
columns are ignored. All patterns run in time linear in the text.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bagwise.llm.common import TEXTS, id_text, map_rows, slices, written
from bagwise.operators.joins import join_hot

KINDS = ("assign", "access", "hex")
LEAST = 10.0         # log10 of the guesses from which on a value is a secret
WORD_LENGTHS = range(3, 17)   # of the pieces that are looked up as words
LOOK_BACK = 2048     # characters of a repeat, a keyboard walk or a repeated piece at most
PART_STARTS = 4096   # starts of parts that a batch holds

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]\x20*+[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
#: Credential words, and what may stand between one and its value.
STEMS = ("pass", "pwd", "secret", "token", "key", "login", "auth", "bearer", "credential", "contrase", "motdepasse", "kennwort")
CONTEXT = re.compile(
    r"(?:pass(?:word|wd|phrase|code|wort)?|pwd|secret|token|(?:api|access|private|auth)[_ -]?key|credentials?|login|"
    r"auth(?:orization)?|bearer|contrase\xf1a|mot[_ -]?de[_ -]?passe|kennwort)[\"']?(?:\x20?(?:is|ist|es|est)\x20|\x20{0,4}(?:[:=]>?|->)\x20{0,4}|\x20(?=[^ ]*[0-9]))[\"']?"
    r"([!-&(-~]{6,})", re.I)
#: Rows of the usual keyboard.
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
BESIDE = {a + b for row in ROWS for a, b in zip(row, row[1:])} | {b + a for row in ROWS for a, b in zip(row, row[1:])}
DATE = re.compile(r"(?:19|20)[0-9]{2}(?:([-./]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12][0-9]|3[01]))?|"
                  r"(?:0[1-9]|[12][0-9]|3[01])([-./]?)(?:0[1-9]|1[0-2])\2(?:19|20)[0-9]{2}")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    return out + [("hex", *m.span()) for m in HEX.finditer(text)]


def values(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int, str]]:
    """Credential values that touch no span of a pattern."""
    return [(s, e, v) for s, e, v, free in costed(text, base) if free]


def costed(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int, str, bool]]:
    """(start, end, value, free) of the credential values of a text, those behind credential words and those of the
    assign spans; free are those that touch no span of a pattern."""
    low = text.lower()
    if not any(stem in low for stem in STEMS):
        return []
    out, taken, at = [], sorted((s, e) for _, s, e in base), 0
    for m in CONTEXT.finditer(text):
        value = m[1].rstrip(".,;:!?)\"'")
        s, e = m.start(1), m.start(1) + len(value)
        while at < len(taken) and taken[at][1] <= s:
            at += 1
        if len(value) >= 6:
            out.append((s, e, value, at == len(taken) or taken[at][0] >= e))
    out += [(*m.span(2), m[2], False) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    return sorted(set(out))


def guess_cost(value: str, words: dict[str, float]) -> float:
    """log10 of the guesses for the cheapest of all cuts of the value into pieces.

    Repeats of one character, keyboard walks and pieces that the one before
    them repeats may have up to `LOOK_BACK` characters each, words the lengths
    of `WORD_LENGTHS`; so time and memory are linear in the value.
    """
    low, n = value.lower(), len(value)
    codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32) if len(low) == n else np.array([ord(c) for c in value])
    low = low if len(low) == n else value
    least = np.full(n + 1, math.inf)
    least[0] = 0.0
    pool = math.log10(max(10, 26 * any(c.islower() for c in value) + 26 * any(c.isupper() for c in value)
                          + 10 * any(c.isdigit() for c in value) + 33 * any(not c.isalnum() for c in value)))
    dates = {}
    for m in filter(None, (DATE.match(value, start) for start in range(n))):
        dates.setdefault(m.end(), []).append(m.start())
        if value[m.start():m.start() + 2] in ("19", "20"):
            dates.setdefault(m.start() + 4, []).append(m.start())
    join = math.log10(2)     # each further piece
    run = walk = 0           # lengths of the repeat and of the keyboard walk that end here
    same = np.zeros(LOOK_BACK, np.int64)   # at k - 1: how many characters up to here equal those k before
    lengths = np.arange(1, LOOK_BACK + 1)
    count_cost = np.log10(lengths)[::-1]   # of the starts LOOK_BACK to 1 before the end
    for end in range(1, n + 1):
        run = run + 1 if end > 1 and low[end - 1] == low[end - 2] else 1
        walk = walk + 1 if end > 1 and low[end - 2:end] in BESIDE else 1
        best = least[end - 1] + pool
        for length in WORD_LENGTHS:
            if length > end:
                break
            cost = words.get(low[end - length:end])
            if cost is not None:
                capitals = sum(c.isupper() for c in value[end - length:end])
                best = min(best, least[end - length] + cost + join * (1 + min(capitals, length - capitals)))
        for length in {run, walk}:
            if length >= 3:   # one of 95 characters to start with, then how many
                k = min(length, LOOK_BACK)
                best = min(best, float((least[end - k:end - 2] + count_cost[LOOK_BACK - k:LOOK_BACK - 2]).min()) + 1.98 + join)
        for start in dates.get(end, ()):
            best = min(best, least[start] + math.log10(365 * 120 if end - start > 4 else 200) + join)
        back = min(end - 1, LOOK_BACK)
        if back >= 1:        # a piece that the one before it repeats costs the count only
            equal = codes[end - 1 - back:end - 1][::-1] == codes[end - 1]
            same[:back] = np.where(equal, same[:back] + 1, 0)
            whole = np.flatnonzero(same[1:back] >= lengths[1:back]) + 2
            if len(whole):
                best = min(best, float(least[end - whole].min()) + join)
        least[end] = best
    return float(least[n])


FOUND = ("row long, doc_id long, base array<struct<kind:string,start:int,end:int>>, "
         "asked array<struct<start:int,end:int,value:string,free:boolean>>")


def found_rows(batches):
    base_kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    asked_kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()), ("free", pa.bool_())]))
    row = TaskContext.get().partitionId() << 36
    for batch, texts in slices(batches):
        base = [base_spans(t) for t in texts]
        asked = [costed(t, b) for t, b in zip(texts, base)]
        yield pa.record_batch([
            pa.array(range(row, row + len(texts)), pa.int64()), batch.column(0),
            pa.array([[dict(zip(("kind", "start", "end"), s)) for s in b] for b in base], base_kind),
            pa.array([[dict(zip(("start", "end", "value", "free"), s)) for s in a] for a in asked], asked_kind)],
            names=["row", "doc_id", "base", "asked"])
        row += len(texts)


def part_rows(batches):
    """The parts of each value that can be words, with the value's digest: a block of starts at a time."""
    for batch in batches:
        for digest, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            low = value.lower()
            for first in range(0, len(low), PART_STARTS):
                parts = {low[i:i + n] for i in range(first, min(first + PART_STARTS, len(low))) for n in WORD_LENGTHS if i + n <= len(low)}
                parts = sorted(p for p in parts if p.isalpha())
                if parts:
                    yield pa.record_batch([pa.array([digest] * len(parts)), pa.array(parts)], names=["digest", "word"])


def cost_rows(batches):
    for batch in batches:
        rows = batch.to_pylist()
        yield pa.record_batch([pa.array([r["digest"] for r in rows], pa.string()),
                               pa.array([guess_cost(r["value"], {w["word"]: w["cost"] for w in r["words"] or ()}) for r in rows], pa.float64())],
                              names=["digest", "cost"])


def find_secrets(docs: DataFrame, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans, costs) of every row: spans by start, then kind as listed; code points, end exclusive.

    `costs` has (start, end, cost) of every credential value, also of those in an assign span.
    """
    rows = id_text(docs, id_col, text_col)
    found = written(map_rows(rows, found_rows, FOUND), "found", TEXTS)
    asked = found.select("row", F.explode("asked").alias("a")).select("row", "a.start", "a.end", "a.free", F.sha2("a.value", 256).alias("digest"), "a.value")
    asked = written(asked, "asked")
    one = written(asked.groupBy("digest").agg(F.min("value").alias("value")), "values")
    parts = written(map_rows(one.select("digest", "value"), part_rows, "digest string, word string").distinct(), "parts", TEXTS)
    words = (rows.select(F.explode(F.split(F.lower("text"), "[^\\p{L}]+")).alias("word"))
             .filter(F.length("word").between(min(WORD_LENGTHS), max(WORD_LENGTHS)))
             .groupBy("word").agg(F.count("*").alias("n")))
    if parts.isEmpty():
        known = parts.select("digest", F.array().cast("array<struct<word:string,cost:double>>").alias("words"))
    else:
        counts = written(words, "counts")
        total = float(counts.agg(F.sum("n")).first()[0] or 1)
        known = (join_hot(parts, counts, "word").groupBy("digest")
                 .agg(F.collect_list(F.struct("word", F.log10(total / F.col("n")).alias("cost"))).alias("words")))
    costs = written(map_rows(one.join(known, "digest", "left").select("digest", "value", "words"), cost_rows, "digest string, cost double"), "costs", TEXTS)
    priced = join_hot(asked.drop("value"), costs, "digest")
    more = priced.groupBy("row").agg(
        F.collect_set(F.when(F.col("free") & (F.col("cost") >= least), F.struct(F.lit("value").alias("kind"), "start", "end"))).alias("more"),
        F.array_sort(F.collect_set(F.struct("start", "end", "cost"))).alias("costs"))
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    place = F.create_map(*(F.lit(x) for i, k in enumerate((*KINDS, "value")) for x in (k, i)))

    def tagged(spans, base):
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), place[s["kind"]].alias("place"), s["end"].alias("end"),
                                                     s["kind"].alias("kind"), F.lit(base).alias("base")))
    spans = F.array_sort(F.concat(tagged(F.col("base"), True), tagged(F.coalesce("more", none), False)))
    return found.join(more, "row", "left").select("doc_id", F.transform(
        spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base"))).alias("spans"),
        F.coalesce("costs", F.array().cast("array<struct<start:int,end:int,cost:double>>")).alias("costs"))
