"""Operator 10 against brute force, for phrases and for proximity."""

import hashlib
import re

import pytest
from odd_rows import SCHEMA, odd_rows, sentence

from aeroseries.llm import decontaminate as D

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def items():
    passage = sentence(77, 70)
    return [
        (1, passage[5:200]), (2, "ONE"), (3, None), (4, ""), (5, "x x x x x x x x x x x x"), (6, "line-one, HERE"), (7, passage[5:200]), (None, "漢字 x y"), (10, "é É ñ"),
        (11, sentence(500, 30)), (12, "!!! ..."), (7, passage[5:200]), (20, sentence(3, 12) + " unseen words here"),
    ]


def plain(rows, tests, window):
    wins = {}
    for k, text in tests:
        w = words(text)
        n = min(len(w), window)
        for i in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[i:i + n]), set()).add(k)
    out = []
    for r in rows:
        w = words(r[1])
        hit, names = set(), set()
        for n in {len(x) for x in wins}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in wins:
                    hit |= set(range(i, i + n))
                    names |= {k for k in wins[tuple(w[i:i + n])] if k is not None}
        text = ",".join(sorted(map(str, names)))
        out.append((r[0], len(w), len(hit), len(names), hashlib.sha256(text.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("window, most", [(10, 1_000_000), (3, 1_000_000), (10, 1)])
def test_matches_brute_force(spark, docs, window, most):
    tests = spark.createDataFrame(items(), "item_id long, text string")
    got = D.decontaminate(docs, tests, window, max_broadcast=most).select(*D.DIGEST)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(odd_rows(), items(), window)


def test_clean_keeps_the_rest(spark, clashing, empty):
    tests = spark.createDataFrame(items(), "item_id long, text string")
    kept = D.clean(clashing, tests)
    assert kept.columns == clashing.columns
    want = sorted(str(r[0]) for r in odd_rows() if not {p[-1] for p in plain([r], items(), 10)} == {True})
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == want
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.clean(clashing, none).count() == clashing.count()
    assert D.clean(empty, tests).count() == D.decontaminate(empty, tests).count() == 0


def test_proximity_finds_passages_with_changed_words(spark):
    passage = sentence(9, 40).split(" ")
    loose = list(passage)
    for i in range(4, 40, 8):
        loose[i] = f"other{i}"
    loose.insert(20, "added")
    rows = [(1, " ".join(passage), None, None, None), (2, "before it " + " ".join(loose), None, None, None), (3, " ".join(sorted(passage)), None, None, None), (4, sentence(10, 60), None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = D.Matches(docs, spark.createDataFrame([(1, " ".join(passage))], "item_id long, text string"))
    near = {r["doc_id"]: r["place"] for r in found.proximity().collect()}
    assert set(near) == {1, 2} and near[1] == 0 and near[2] in (2, 3)
    exact = D.decontaminate(docs, spark.createDataFrame([(1, " ".join(passage))], "item_id long, text string"))
    assert {r["doc_id"] for r in exact.where("contaminated").collect()} == {1}


def plain_near(rows, tests, slop=4, share=0.6, rarest=3, window=10):
    """Items of whose anchors enough lie in one bucket of places, by document."""
    freq = {}
    for r in rows:
        for w in words(r[1]):
            freq[w] = freq.get(w, 0) + 1
    out = {}
    for k, text in tests:
        w = words(text)
        n = min(len(w), window)
        qs = set()
        for i in range(len(w) - n + 1 if n else 0):
            qs |= set(sorted((q for q in range(i, i + n) if w[q] in freq), key=lambda q: (freq[w[q]], q))[:rarest])
        for j, r in enumerate(rows):
            buckets = {}
            for p, word in enumerate(words(r[1])):
                for q in qs:
                    if w[q] == word:
                        d = p - q
                        for b in (("even", d // (2 * slop)), ("odd", (d + slop) // (2 * slop))):
                            buckets.setdefault(b, set()).add(q)
            if any(len(b) >= share * len(qs) for b in buckets.values()):
                out.setdefault(j, set()).add(k)
    return {j: len(ks) for j, ks in out.items()}


def test_proximity_matches_brute_force(spark):
    passages = {1: sentence(9, 40), 2: sentence(10, 25), 3: "x y z", 4: sentence(12, 9) + " unheardof " + sentence(13, 9)}
    rows = []
    for k, text in enumerate([*passages.values(), sentence(99, 80), "x q z", "x q q q q q y z", ""]):
        w = text.split(" ")
        rows.append((2 * k, text.replace("unheardof ", "changed "), None, None, None))
        rows.append((2 * k + 1, " ".join(["lead"] * k + [x if i % 9 else f"other{i}" for i, x in enumerate(w)]), None, None, None))
    items = list(passages.items())
    got = D.decontaminate(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id long, text string"))
    want = plain_near(rows, items)
    assert {r["doc_id"]: r["n_near"] for r in got.collect()} == {r[0]: want.get(j, 0) for j, r in enumerate(rows)}
    # One word that no document has doesn't lose a window's match.
    assert want[6] and not any(r["n_hit"] for r in got.where("doc_id = 7").collect())


def test_a_very_long_text_of_two_words(spark):
    """A text of a million words, half of whose places begin a window; item 2 repeats its only two windows."""
    text = " ".join(["a b"] * 500_000)
    tests = spark.createDataFrame([(1, "a b a b a b a b a b"), (2, " ".join(["a b"] * 100))], "item_id long, text string")
    got = D.decontaminate(spark.createDataFrame([(1, text, None, None, None)], SCHEMA), tests).select(*D.FIGURES).first()
    assert (got["n_words"], got["n_hit"], got["n_items"], got["n_near"]) == (1_000_000, 1_000_000, 2, 2)
