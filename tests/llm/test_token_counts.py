"""Operator 13 against the library on whole texts."""

import random

import numpy as np
import pytest
from odd_rows import SCHEMA, odd_rows, sentence
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from aeroseries.llm import token_counts as C
from aeroseries.llm.vocab import public

PATH = public("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


def plain(rows, path=PATH):
    t = Tokenizer.from_file(path)
    return sorted((str(k), len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False).ids)) for k, x in rows)


def got(df):
    return sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in df.collect())


def hard_texts():
    """Texts whose boundaries are few, or hard to find."""
    rng = random.Random(13)
    alphabet = list("aB3 '\n.é漢　 \t<|") + ["'re", "'s", "<|endoftext|>", "endoftext", "  ", "\U0001f600"]
    texts = ["".join(rng.choice(alphabet) for _ in range(n)) for n in (70, 100, 300, 1000, 4000)]
    texts += ["ab" * 400, "漢字" * 300, " " * 900, "a" + " " * 500 + "b" * 700, "x" * 300 + "'" + "s" * 300, "<|endoftext|>" * 60, "<|endoftext" * 60, "1" * 200 + "a" * 200 + "!" * 200 + "\n" * 200, "word " * 500, "don't we'll they've " * 90]
    return texts


def test_matches_the_library_in_small_chunks(spark):
    rows = odd_rows() + [(100 + i, x, None, None, 0) for i, x in enumerate(hard_texts())]
    docs = spark.createDataFrame(rows, SCHEMA)
    for chunk, overlap in ((64, 16), (200, 40)):
        assert got(C.token_counts(docs, PATH, chunk=chunk, overlap=overlap, widen=3)) == plain([(r[0], r[1]) for r in rows])


def test_very_long_texts_and_repeated_rows(spark):
    texts = [sentence(5, 60_000), "ab" * 60_000, "漢" * 50_000 + " x" * 20_000, "\n".join(sentence(i, 9) for i in range(4000))]
    rows = [(1, texts[0], None, None, 0)] * 3 + [(2 + i, x, None, None, 0) for i, x in enumerate(texts)] + [(None, texts[3], None, None, 0)]
    assert got(C.token_counts(spark.createDataFrame(rows, SCHEMA), PATH)) == plain([(r[0], r[1]) for r in rows])


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    found = C.token_counts(docs, PATH)
    assert got(found) == plain(rows)
    assert found.where(F.col("over_limit") != (F.col("n_tokens") > 512)).count() == 0


def test_stable_places_are_boundaries_of_the_whole_text():
    counter = C.Counter(PATH, True)
    for text in hard_texts():
        starts, ends = counter.offsets(text)
        inside = {p for a, b in zip(starts, ends) for p in range(a + 1, b)}
        places = [p for p in range(1, len(text)) if C.stable(text, p, counter.literals)]
        assert not inside & set(places)
        for p in places[:: max(1, len(places) // 25)]:
            # What stands left of it and right of it is encoded by itself.
            assert counter.whole(text) == counter.whole(text[:p]) + counter.whole(text[p:])
            assert int(np.searchsorted(starts, p)) == counter.whole(text[:p])


def test_other_tokenizers_encode_whole(spark):
    path = public("word_bpe_49k.json")
    rows = [(i, x, None, None, 0) for i, x in enumerate(hard_texts())]
    assert not C.byte_level(path) and C.byte_level(PATH)
    assert got(C.token_counts(spark.createDataFrame(rows, SCHEMA), path, chunk=64)) == plain([(r[0], r[1]) for r in rows], path)


@pytest.mark.parametrize("chunk", [64, C.CHUNK])
def test_empty_and_clashing(empty, docs, clashing, chunk):
    assert C.token_counts(empty, PATH, chunk=chunk).count() == 0
    assert got(C.token_counts(clashing, PATH, chunk=chunk)) == got(C.token_counts(docs, PATH, chunk=chunk))
