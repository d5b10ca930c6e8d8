"""Operator 5 against the library: its own ids for merges, no worse sums for unigrams; round trips."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from odd_rows import odd_rows
from pyspark.sql import functions as F

from aeroseries.llm import kernels as K
from aeroseries.llm import sentencepiece_codec as S

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return S.load(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts(library):
    rng = random.Random(3)
    pieces = [library.id_to_piece(i) for i in range(259, library.get_piece_size())]
    made = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 6))).replace("▁", " ") for _ in range(3000)]
    return made + ["", " ", "  a", "漢字☃\U0001F600x", "\t\n\x00 ", "a" * 700, "x  y   z ", " " * 40 + "q"] + [r[1] for r in odd_rows() if r[1] and "▁" not in r[1]]


def encoded(rows, model):
    ids, off = S.encode(*K.flat(pa.array(rows)), model, K.WordCache())
    return [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])]


def test_the_librarys_ids(model, library):
    rows = texts(library)
    assert encoded(rows, model) == library.encode(rows)


def test_unigram_sums_are_the_best(model, library):
    """Every segmentation of short words, by brute force."""
    unigram = dict(model, kind=np.array(S.UNIGRAM))
    pieces = {library.id_to_piece(i): library.get_score(i) for i in range(259, library.get_piece_size())}

    def best(word):
        top = [0.0] + [-1e30] * len(word)
        for end in range(1, len(word) + 1):
            for start in range(max(0, end - 16), end):
                if word[start:end] in pieces:
                    top[end] = max(top[end], top[start] + pieces[word[start:end]])
        return top[-1]

    for word in ["the", "theatre", "lereanan", "ungerung", "international", "zzzqq"]:
        assert sum(library.get_score(i) for i in encoded([word], unigram)[0]) == best("▁" + word)


def test_round_trip(spark, docs, clashing, empty):
    got = S.encode_documents(docs, PATH)
    back = got.withColumn("back", S.decoder(docs, PATH)(F.col("ids")))
    rows = back.collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        if r["text"] is None:
            assert r["ids"] is None and r["round_trip"] is None and r["back"] is None
        else:
            assert r["round_trip"] == (r["back"] == r["text"]) == ("▁" not in r["text"])
            assert r["back"] == r["text"].replace("▁", " ")
    assert S.encode_documents(empty, PATH).count() == 0
    other = S.encode_documents(clashing, PATH)
    assert other.columns.count("ids") == 1
    assert sorted(str(r["ids"]) for r in other.collect()) == sorted(str(r["ids"]) for r in rows)
