"""Operator 12 against plain counts, sums and a sort."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from odd_rows import SCHEMA, odd_rows, sentence
from pyspark.sql import types as T

from aeroseries.llm import resampling as R

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def grams(text, ngrams):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return [" ".join(w[i:i + n]) for n in range(1, ngrams + 1) for i in range(len(w) - n + 1)], len(w)


def plain(rows, target, share=10, least=20, ngrams=1, buckets=10_000, seed=2024):
    """(doc_id, n_features, weight, score, rank) of each row, in no order."""
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s = Counter(bucket(g) for _, x in rows for g in grams(x, ngrams)[0])
    t = Counter(bucket(g) for x in target for g in grams(x, ngrams)[0])
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets))))
    out = []
    for k, x in rows:
        g, n = grams(x, ngrams)
        w = sum(gain(bucket(y)) for y in g)
        h = int(hashlib.sha256(f"{seed}:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        out.append([k, len(g), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= least])
    order = sorted((i for i, x in enumerate(out) if x[4]), key=lambda i: (-out[i][3], out[i][0] is not None, out[i][0] or 0, out[i][1], out[i][2]))
    rank = {i: r for r, i in enumerate(order[:share * len(order) // 100], 1)}
    return [(*x[:4], rank.get(i)) for i, x in enumerate(out)]


def got(df):
    return sorted(map(str, map(tuple, df.select("doc_id", "n_features", "weight", "score", "rank").collect())))


@pytest.mark.parametrize("ngrams", [1, 2])
def test_matches_plain(spark, ngrams):
    rows = odd_rows() + [(100 + i, sentence(i % 29, 15 + i), "en", "a", 0) for i in range(80)] + [(500, "Ab1 é漢字 " * 30_000, None, None, 0), (501, "x" * 100_000 + " " + "yz" * 40, None, None, 0)]
    target = [sentence(3, 300), None, "", sentence(9, 40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    goal = spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id long, text string")
    want = plain([(r[0], r[1]) for r in rows], target, share=30, ngrams=ngrams)
    assert got(R.resample(docs, goal, share_pct=30, ngrams=ngrams)) == sorted(map(str, want))


def test_repeated_rows_at_the_end_of_the_draw(spark):
    rows = [(7, sentence(1, 40), None, None, 0)] * 10 + [(8, sentence(2, 40), None, None, 0)] * 10
    goal = spark.createDataFrame([(1, sentence(1, 40))], "item_id long, text string")
    ranks = sorted(r["rank"] for r in R.resample(spark.createDataFrame(rows, SCHEMA), goal, share_pct=25).collect() if r["rank"])
    assert ranks == [1, 2, 3, 4, 5]


def test_kth_key_of_many_ties(spark):
    rng = random.Random(4)
    rows = [(rng.randint(-30, 30), rng.choice([None, *range(40)]), 1, 1) for _ in range(3000)]
    frame = spark.createDataFrame(rows, "score long, doc_id long, n_features long, weight long")
    keys = frame.select(R._key(frame).alias("key"))
    order = sorted((-s, d is not None, d or 0, n, w) for s, d, n, w in rows)
    for k in (1, 2, 777, 1500, 2999, 3000):
        assert R.kth_key(keys, k, pivots=5) == order[k - 1]
    assert R.kth_key(keys, 3001, pivots=50) is None


def test_checksums():
    rng = np.random.default_rng(1)
    buf = rng.integers(0, 256, 5000, np.uint8)
    start = rng.integers(0, 4000, 300)
    end = start + np.concatenate([np.arange(0, 100), rng.integers(0, 12, 199), [900]])
    assert R.checksums(buf, start, end).tolist() == [zlib.crc32(buf[a:b].tobytes()) for a, b in zip(start, end)]


def test_empty_and_clashing(spark, empty, docs, clashing):
    goal = spark.createDataFrame([(1, sentence(1, 40))], "item_id long, text string")
    assert R.resample(empty, goal).count() == 0
    assert got(R.resample(docs, goal.limit(0), share_pct=50)) == sorted(map(str, plain([(r[0], r[1]) for r in odd_rows()], [], share=50)))
    more = T.StructType([T.StructField(c, T.StringType()) for c in ("rank", "weight", "key", "fit", "row", "p")])
    both = spark.createDataFrame([("x",) * 6], more).crossJoin(docs)
    assert got(R.resample(both, goal, 50)) == got(R.resample(docs, goal, 50)) == got(R.resample(clashing, goal, 50))
