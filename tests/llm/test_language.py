"""Operator 2: the parse against a plain one, held-out accuracy, odd rows."""

import random

import pytest
from odd_rows import odd_rows

from aeroseries.llm import langid
from pyspark.sql import functions as F

TEXTS = {
    "en": ["the quick brown fox jumps over the lazy dog and then the dog sleeps in the warm sun while the birds sing in the trees " * 3],
    "de": ["der schnelle braune fuchs springt über den faulen hund und dann schläft der hund in der warmen sonne während die vögel singen " * 3],
    "fr": ["le renard brun rapide saute par-dessus le chien paresseux et puis le chien dort au soleil pendant que les oiseaux chantent " * 3],
}


def plain_phrases(sample: str, text: str) -> int:
    """Greedy phrases of a coded text: the longest match each time, one symbol at least."""
    at = n = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at:at + size + 1] in sample:
            size += 1
        at, n = at + size, n + 1
    return n


def test_phrases_match_a_plain_parse():
    model = langid.fit(TEXTS, 300)
    rng = random.Random(7)
    words = " ".join(t for ts in TEXTS.values() for t in ts).split()
    texts = [" ".join(rng.choice(words) for _ in range(n)) for n in (0, 1, 3, 40, 400)] + ["ZZZ 漢字 x9!! y"]
    coded, off = langid.coded(texts, model.symbols)
    got = langid.phrases(model, coded, off)
    for j, name in enumerate(model.languages):
        sample, _ = langid.coded([t + " " for t in TEXTS[name]], model.symbols)
        sample = "".join(map(chr, sample[:300]))
        for i in range(len(texts)):
            text = "".join(map(chr, coded[off[i]:off[i + 1]]))
            blocks = [text[k:k + langid.BLOCK] for k in range(0, len(text), langid.BLOCK)]
            assert got[i, j] == sum(plain_phrases(sample, b) for b in blocks)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    found = langid.identify(docs.where(langid.held_out(F.col("doc_id"))), model)
    right, total = found.select(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert total > 20 and right >= 0.95 * total
    assert found.where("score < 0 or score > 1").count() == 0


def test_odd_rows(spark, docs, clashing, empty):
    model = langid.train(docs)
    got = langid.identify(docs, model).collect()
    assert len(got) == len(odd_rows())
    for r in got:
        if r["text"] is None or not any(c.isalpha() for c in r["text"]):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("en", "fr")
    key = lambda rows: sorted((str(r["doc_id"]), str(r["text"]), r["lang_pred"], r["score"]) for r in rows)
    assert key(langid.identify(clashing, model).collect()) == key(got)
    kept = langid.with_language(clashing, model)
    assert kept.columns == clashing.columns and kept.where("lang_pred = 'x'").count() == kept.count() > 0
    assert langid.identify(empty, model).count() == 0
    nothing = langid.train(empty)
    assert {r["lang_pred"] for r in langid.identify(docs, nothing).collect()} == {"und"}


def test_a_repeated_id_gives_one_text(spark):
    rows = [(1, f"text {i}", "en") for i in range(50)] + [(2, "other words", "en"), (1, "ein text", "de")]
    got = langid.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 200, 2000)
    assert {k: sorted(v) for k, v in got.items()} == {"en": ["other words", "text 0"], "de": ["ein text"]}


def test_a_table_beyond_its_bound_is_refused():
    many = {f"l{i:03}": [f"{t} l{i}" for t in TEXTS["en"]] for i in range(150)}
    assert len(langid.fit(many, 50).languages) == 150
    with pytest.raises(ValueError, match="lower max_symbols"):
        langid.fit(many, 50, max_entries=100_000)
