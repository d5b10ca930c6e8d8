"""Operators 3 and 4 against brute force, with small windows and every path."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from odd_rows import SCHEMA, odd_rows

from aeroseries.llm import kernels as K
from aeroseries.llm import substring_dedup, suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def plain_bytes(rows, length):
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    seen = Counter(b[i:i + length] for _, b in texts for i in range(len(b) - length + 1))
    out = []
    for k, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((k, len(b), sum(gone), runs, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return sorted(out, key=str)


def plain_words(rows, length):
    low = lambda k: -(1 << 63) if k is None else k
    first = {}
    for r in sorted(rows, key=lambda r: low(r[0])):
        w = WORD.findall(r[1] or "")
        for i in range(len(w) - length + 1):
            first.setdefault(tuple(w[i:i + length]), low(r[0]))
    out = []
    for r in rows:
        w = WORD.findall(r[1] or "")
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if first[tuple(w[i:i + length])] < low(r[0]):
                gone[i:i + length] = [True] * length
        out.append((r[0], len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g).encode())))
    return sorted(out, key=str)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("length, gram, most", [(200, 48, 6000), (40, 12, 6000), (40, 12, 1)])
def test_bytes(docs, length, gram, most):
    got = suffix_dedup.digest(suffix_dedup.suffix_dedup(docs, length, gram, most))
    assert collected(got) == plain_bytes(odd_rows(), length)


@pytest.mark.parametrize("length, gram", [(50, 10), (8, 3)])
def test_words(docs, length, gram):
    got = substring_dedup.digest(substring_dedup.substring_dedup(docs, length, gram))
    assert collected(got) == plain_words(odd_rows(), length)


def test_random_texts_share_everything(spark):
    rng = random.Random(3)
    parts = ["".join(rng.choice("ab ") for _ in range(30)) for _ in range(6)]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 8))), None, None, None) for k in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert collected(suffix_dedup.digest(suffix_dedup.suffix_dedup(df, 25, 6))) == plain_bytes(rows, 25)
    assert collected(substring_dedup.digest(substring_dedup.substring_dedup(df, 4, 2))) == plain_words(rows, 4)


def test_empty_and_clashing(empty, docs, clashing):
    assert suffix_dedup.suffix_dedup(empty).count() == substring_dedup.substring_dedup(empty).count() == 0
    assert collected(substring_dedup.substring_dedup(clashing)) == collected(substring_dedup.substring_dedup(docs))
    assert collected(suffix_dedup.digest(suffix_dedup.suffix_dedup(clashing))) == plain_bytes(odd_rows(), 200)


def test_interval_expansion_is_the_prefix_array():
    """Boundaries found by backward extension, against prefixes compared directly."""
    rng = np.random.default_rng(5)
    for depth in (2, 3, 7, 20):
        parts = [rng.integers(97, 100, n).astype(np.uint8) for n in (1, 5, 40, 60, 60)]
        parts.append(parts[2].copy())
        n = len(parts)
        symbols = np.concatenate([np.append(p.astype(np.int64) + n, i) for i, p in enumerate(parts)])
        order = suffix_dedup.suffix_order(symbols, depth)
        starts = [tuple(symbols[i:i + depth]) for i in order]
        assert starts == sorted(starts)
        want = [True] + [a != b for a, b in zip(starts, starts[1:])]
        assert suffix_dedup.common_prefix_boundaries(symbols, order, n, depth).tolist() == want


def test_segments_cover_every_window_once():
    rng = np.random.default_rng(1)
    units = K.mix(rng.integers(0, 3, 500).astype(np.uint64))
    off = np.array([0, 0, 7, 100, 100, 101, 500])
    doc, at, n, m, s = K.segments(units, off, 12, 4)
    got = sorted((d, a + i) for d, a, c in zip(doc, at, n) for i in range(c))
    assert got == [(d, i) for d in range(6) for i in range(max(0, off[d + 1] - off[d] - 11))]
