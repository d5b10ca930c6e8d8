"""Operator 9 and the connected components against brute force."""

import random
import re

import pyarrow as pa
import pytest
from odd_rows import SCHEMA, odd_rows, sentence

from aeroseries.llm import jaccard_join as J
from aeroseries.llm import kernels as K
from aeroseries.llm.components import components

WORD = re.compile("[0-9a-z\x80-\U0010ffff]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOW))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def plain(rows):
    """(class, links) of every row."""
    low = [r[0] if r[0] is not None else -(1 << 63) for r in rows]
    sets = [shingles(r[1]) for r in rows]
    near = [[j for j, b in enumerate(sets) if j != i and a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9] for i, a in enumerate(sets)]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        first = min(low[j] for j in seen)
        out.append((rows[i][0], first if first != -(1 << 63) else None, len(near[i])))
    return sorted(out, key=str)


def family(n):
    """Near copies of one text, each with a word of its own."""
    rng = random.Random(2)
    rows = []
    for k in range(n):
        w = sentence(42, 90).split(" ")
        w[rng.randrange(90)] = f"own{k}"
        rows.append((1000 + k, " ".join(w), None, None, None))
    return rows


@pytest.mark.parametrize("block", [400, 7])
def test_matches_brute_force(spark, block):
    rows = odd_rows() + family(40)
    got = J.near_duplicates(spark.createDataFrame(rows, SCHEMA), block=block)
    assert sorted((tuple(r) for r in got.select("doc_id", "class_id", "n_links").collect()), key=str) == plain(rows)


@pytest.mark.parametrize("total", [15, 30, 35, 50, 4995])
def test_ties_are_links(total):
    """Texts of ``total`` shingles and of their first four fifths, and of one less."""
    words = [f"w{i}" for i in range(total + 4)]
    cut = total * 4 // 5 + 4
    texts = [" ".join(words), " ".join(words[:cut]), " ".join(["v", *words[1:cut - 1]])]
    h, first, _, _ = J.shingles(*K.flat(pa.array(texts)), 5)
    sets = [shingles(t) for t in texts]
    want = [[5 * len(a & b) >= 4 * len(a | b) for b in sets] for a in sets]
    assert want[0][1] and not want[0][2]
    got = J.linked(h, first, 0.8)
    assert all(got[i, j] == want[i][j] for i in range(3) for j in range(3) if i != j)


def test_a_tie_is_one_class(spark):
    words = [f"w{i}" for i in range(19)]
    rows = [(1, " ".join(words), None, None, None), (2, " ".join(words[:16]), None, None, None)]
    got = J.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert sorted(tuple(r) for r in got.select("doc_id", "class_id", "n_links").collect()) == plain(rows) == [(1, 1, 1), (2, 1, 1)]


def test_keep_first(spark, docs, clashing, empty):
    want = plain(odd_rows())
    kept = J.keep_first(clashing)
    assert kept.columns == clashing.columns
    rows = [r["doc_id"] for r in kept.collect()]
    ids = {c for _, c, _ in want}
    assert set(rows) == ids
    assert sum(r is not None for r in rows) == len({i for i in ids if i is not None})
    assert J.near_duplicates(empty).count() == J.keep_first(empty).count() == 0


def test_depth_falls_until_the_recall():
    assert J.prefix_depth(20, 8, 0.8, 0.999) == 5
    for trees, recall in [(5, 0.9), (50, 0.999), (1, 0.5)]:
        d = J.prefix_depth(trees, 8, 0.8, recall)
        assert d == 1 or 1 - (1 - 0.8**d) ** trees >= recall
        assert d == 8 or 1 - (1 - 0.8 ** (d + 1)) ** trees < recall


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100 + i, 100) for i in range(30)] + [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)] + [(7, 7), (None, 3)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert dict((r["node"], r["root"]) for r in got.collect()) == {x: find(x) for x in list(root)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
