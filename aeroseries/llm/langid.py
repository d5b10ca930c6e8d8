"""Language identification by cross-parsing entropy (operator 2).

Per language, a bounded sample of labelled text becomes a suffix automaton,
which accepts exactly the sample's substrings.  A text is parsed greedily into
phrases, each the longest match in the automaton; the language that needs the
fewest phrases, weighed by the logarithm of its sample's length, wins.

The automata are written as one dense transition table whose missing entries
already hold the step that starts the next phrase, so parsing is a table lookup
a character.  Texts are cut into blocks of ``BLOCK`` symbols, all parsed from
the start state; thousands of blocks advance together, in numpy, for all
languages at once.  The table's size is bounded by the sample; it is broadcast.

Letters are lower-cased; every run of other characters is one separator.

Defined results: ``und`` with score 0 for a null text, a text without a letter,
or a model without languages; ties go to the first language by name; repeated
rows get equal results; other columns pass through unread.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroseries.llm import kernels as K

K.ship_by_value(__name__)
BLOCK = 512
SEPARATOR, OTHER_LETTER, FIRST_LETTER = 0, 1, 2
#: An entry is twice a place in the table and one bit, in 32 bits.
MOST_ENTRIES = (1 << 30) - 1


@dataclass
class Model:
    languages: list[str]
    symbols: np.ndarray  # code point -> symbol
    table: np.ndarray  # 2 * (first entry of the next state) + 1 if a phrase begins
    start: np.ndarray  # first entry of each language's start state
    weight: np.ndarray  # bits to name a phrase


def sample(docs: DataFrame, max_docs: int, max_chars: int) -> dict[str, list[str]]:
    """Texts by language: the first ``max_docs`` documents by hash, ``max_chars`` of each at most."""
    labelled = docs.where("lang is not null and text is not null")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = labelled.select("lang", "doc_id").withColumn("r", F.row_number().over(order)).where(F.col("r") <= max_docs)
    rows = labelled.select("doc_id", "lang", F.substring("text", 1, max_chars).alias("text")).join(F.broadcast(chosen.select("doc_id", "lang").distinct()), ["doc_id", "lang"])
    # A doc_id that repeats gives one text, so that the driver gets max_docs a language.
    rows = rows.groupBy("lang", "doc_id").agg(F.min("text").alias("text"))
    out: dict[str, list[str]] = {}
    for r in sorted(rows.collect(), key=lambda r: (r["lang"], r["doc_id"], r["text"])):
        out.setdefault(r["lang"], []).append(r["text"])
    return out


def symbol_table(texts: list[str], most: int = 200) -> np.ndarray:
    """Symbol of every code point; the ``most`` commonest letters get their own."""
    seen = Counter(c for t in texts for c in t.lower() if c.isalpha())
    own = {c: FIRST_LETTER + i for i, (c, _) in enumerate(sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:most])}
    out = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            out[code] = own.get(c.lower(), OTHER_LETTER)
    return out


def coded(texts: list[str], symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, runs of separators folded, and the texts' offsets."""
    size = np.array([len(t) for t in texts], np.int64)
    raw = symbols[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)]
    off = np.concatenate([[0], np.cumsum(size)])
    stay = np.ones(raw.size, bool)
    stay[1:] = (raw[1:] != SEPARATOR) | (raw[:-1] != SEPARATOR)
    stay[off[:-1][size > 0]] = True
    return raw[stay], np.concatenate([[0], np.cumsum(stay)])[off]


def automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the start."""
    steps, link, length, last = [{}], [-1], [0], 0
    for c in text:
        state = len(steps)
        steps.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in steps[p]:
            steps[p][c] = state
            p = link[p]
        if p != -1:
            q = steps[p][c]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                twin = len(steps)
                steps.append(dict(steps[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and steps[p].get(c) == q:
                    steps[p][c] = twin
                    p = link[p]
                link[q] = link[state] = twin
        last = state
    return steps


def train(docs: DataFrame, max_docs: int = 200, max_chars: int = 2000, max_symbols: int = 24_000) -> Model:
    """Fit on labelled rows (doc_id, text, lang); the sample is bounded by all three limits, a language."""
    return fit(sample(docs, max_docs, max_chars), max_symbols)


def fit(texts: dict[str, list[str]], max_symbols: int = 24_000, max_entries: int = MOST_ENTRIES) -> Model:
    """The model of sampled texts; ValueError where its table, which is broadcast, would pass ``max_entries`` (of 4 bytes)."""
    symbols = symbol_table([t for ts in texts.values() for t in ts])
    width = int(symbols.max()) + 1
    parts, start, weight, names, at = [], [], [], [], 0
    for name in sorted(texts):
        text, _ = coded([t + " " for t in texts[name]], symbols)
        text = text[:max_symbols]
        if not (text > SEPARATOR).any():
            continue
        steps = automaton(text.tolist())
        if at + len(steps) * width > min(max_entries, MOST_ENTRIES):
            raise ValueError(f"{len(texts)} languages pass {min(max_entries, MOST_ENTRIES)} table entries at {max_symbols} symbols each; lower max_symbols")
        goes = np.full((len(steps), width), -1, np.int64)
        for s, out in enumerate(steps):
            goes[s, list(out)] = list(out.values())
        begin = np.maximum(goes[0], 0)  # a symbol the sample lacks is a phrase of its own
        begins = goes < 0
        begins[0] = True
        goes = np.where(begins, begin, goes)
        parts.append((2 * (at + goes * width) + begins).astype(np.int32).ravel())
        names.append(name)
        start.append(at)
        weight.append(math.log2(text.size + 1))
        at += goes.size
    return Model(names, symbols, np.concatenate(parts) if parts else np.zeros(0, np.int32), np.array(start, np.int32), np.array(weight))


def phrases(model: Model, text: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Phrases of each text in each language."""
    size = np.diff(off)
    blocks = -(-size // BLOCK)
    owner, k = K.ragged(np.zeros(size.size, np.int64), blocks)
    begin = off[owner] + k * BLOCK
    length = np.minimum(BLOCK, off[owner + 1] - begin)
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    value = np.repeat(2 * model.start[:, None], begin.size, axis=1)
    count = np.zeros(value.shape, np.int32)
    active = np.searchsorted(-length, -np.arange(1, BLOCK + 1), "right")
    for t in range(int(length[0]) if length.size else 0):
        a = active[t]
        now = model.table.take((value[:, :a] >> 1) + text[begin[:a] + t])
        count[:, :a] += now & 1
        value[:, :a] = now
    out = np.zeros((size.size, len(model.languages)), np.int64)
    for j in range(len(model.languages)):
        out[:, j] = np.bincount(owner[order], weights=count[j], minlength=size.size)
    return out


def predict(model: Model, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text; the score is the winner's margin, 1 - best / second."""
    text, off = coded(texts, model.symbols)
    letters = K.totals(text > SEPARATOR, off) > 0
    if not model.languages:
        return ["und"] * len(texts), np.zeros(len(texts))
    bits = phrases(model, text, off) * model.weight
    best = bits.argmin(axis=1)
    ordered = np.sort(bits, axis=1)
    margin = 1 - ordered[:, 0] / np.maximum(ordered[:, 1], 1e-9) if len(model.languages) > 1 else np.ones(len(texts))
    return [model.languages[b] if ok else "und" for b, ok in zip(best, letters)], np.where(letters, margin, 0.0)


def predictor(docs: DataFrame, model: Model, slice_bytes: int = 1 << 20):
    """A column function: text to struct (lang_pred, score)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.symbols, model.table, model.start, model.weight))

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def language(text: pa.Array) -> pa.Array:
        names, scores = [], []
        batch = pa.RecordBatch.from_arrays([text], ["text"])
        for part in K.slices(batch, "text", slice_bytes):
            a, b = predict(Model(*shared.value), [t or "" for t in part.column(0).to_pylist()])
            names += a
            scores.append(b)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())], ["lang_pred", "score"])

    return language


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Every row of ``docs`` with ``lang_pred`` and ``score``, which replace columns of these names."""
    own = [c for c in docs.columns if c not in ("lang_pred", "score")]
    found = docs.select(F.struct(*[docs[c] for c in own]).alias("row"), predictor(docs, model)(F.col("text")).alias("found"))
    return found.select("row.*", "found.lang_pred", "found.score")


def with_language(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` in a learned language, all their columns."""
    found = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), predictor(docs, model)(F.col("text")).alias("found"))
    return found.where(F.col("found.lang_pred") != "und").select("row.*")


def held_out(doc_id: Column) -> Column:
    """Whether the id's crc32, modulo 4, is 2; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
