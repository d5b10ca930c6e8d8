"""Operator 1 against a plain count with the same hash."""

import math
import re

import pytest
import xxhash
from odd_rows import odd_rows

from aeroseries.llm import quality

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def h64(text, seed=42):
    return xxhash.xxh64(text.encode(), seed=seed).intdigest()


def bucket(words, buckets):
    seed = 42
    for w in words:
        seed = h64(w, seed)
    return (seed - (1 << 64) if seed >> 63 else seed) % buckets


def grams(words, buckets):
    return [bucket([w], buckets) for w in words] + [bucket(p, buckets) for p in zip(words, words[1:])]


def base(text):
    w = SPACE.findall(text or "")
    lines = [x for x in (text or "").split("\n") if SPACE.search(x)]
    seen, cover = {}, set()
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i:i + 8]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            cover |= {i + j for i in places for j in range(8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover)


def expected(rows, trusted, buckets, threshold, prior):
    raw, target = [0] * buckets, [0] * buckets
    for k, text, *_ in rows:
        for b in grams(SPACE.findall(text or ""), buckets):
            raw[b] += 1
            target[b] += k in trusted
    out = []
    weights = [0] * buckets
    if sum(target):
        q = [(r + 1) / (sum(raw) + buckets) for r in raw]
        weights = [round(1e6 * math.log((t + prior * p) / (sum(target) + prior) / p)) for t, p in zip(target, q)]
    for k, text, *_ in rows:
        figures = base(text)
        g = grams(SPACE.findall(text or ""), buckets)
        failed = figures[0] < 20 or 100 * figures[4] > 30 * figures[0]
        out.append((k, *figures, failed, not failed and sum(weights[b] for b in g) >= round(threshold * 1e6) * len(g)))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


@pytest.mark.parametrize("trusted", [{6, 9, 10}, set()])
def test_matches_brute_force(spark, docs, trusted, monkeypatch):
    ids = spark.createDataFrame([(k,) for k in trusted], "doc_id long")
    monkeypatch.setattr(quality.gram_weights, "__defaults__", (50, 20_000, 1000.0))
    got = quality.quality_rules(docs, ids, threshold=-0.01, buckets=50)
    rows = sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=str)
    assert rows == expected(odd_rows(), trusted, 50, -0.01, 1000.0)


def test_empty_and_clashing(spark, empty, docs, clashing):
    ids = spark.createDataFrame([(6,), (None,)], "doc_id long")
    assert quality.quality_rules(empty, ids).count() == 0
    a, b = (sorted((tuple(r) for r in quality.quality_rules(d, ids).collect()), key=str) for d in (docs, clashing))
    assert a == b


def test_repeated_windows_overlap(spark):
    text = " ".join(["a b c d e f g h i"] * 2 + ["x"] + ["a b c d e f g h"] + ["y"] * 12)
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = df.select(quality.repeat_words(quality.words_of(df["text"])).alias("n")).first()
    assert row["n"] == base(text)[4]
