"""Operator 8 against the library, and the file format's round trip."""

import io
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from odd_rows import odd_rows
from tokenizers import Tokenizer

from aeroseries.llm import kernels as K
from aeroseries.llm import token_store as T

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_the_librarys_ids(library):
    rng = random.Random(5)
    plain = ["'", " ", "\n", "\t", "s", "t", "re", "ll", "ve", "d", "m", "é", "Ñ", "²", "1", "23", "!", "\x1c", "\x85", "\xa0", "\x00", "ß", "A", " '", "''"]
    texts = ["".join(rng.choice(plain) for _ in range(rng.randint(0, 14))) for _ in range(6000)]
    texts += ["".join(rng.choice(plain + ["漢", "☃", "\U0001F600", "\u2003"]) for _ in range(rng.randint(0, 14))) for _ in range(500)] + ["<|endoftext|> a", ""]
    ids, off = T.Encoder(PATH, 2, cache=500)(*K.flat(pa.array(texts)))
    assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])] == [e.ids + [2] for e in library.encode_batch(texts, add_special_tokens=False)]


def test_added_tokens_as_the_library_has_them(spark):
    default = Tokenizer.from_file(PATH)
    texts = ["<|endoftext|> a", "one<|endoftext|>two <|endoftext|>", "<|endof", "text|>", "漢 <|endoftext|>", "plain", "", "<|endoftext|>"]
    want = [default.encode(x, add_special_tokens=False).ids + [2] for x in texts]
    assert want[-1] == [50256, 2]
    ids, off = T.Encoder(PATH, 2, split_special=False)(*K.flat(pa.array(texts)))
    assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])] == want
    got = T.store_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), PATH).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in got} == {i: (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in enumerate(want)}


@pytest.mark.parametrize("n", [1, 7, 8, 9, 1000])
def test_planes(n):
    ids = np.random.default_rng(n).integers(0, 1 << 20, n).astype(np.uint32)
    assert np.array_equal(T.from_planes(T.planes(ids), n), ids)
    assert len(T.planes(np.zeros(n, np.uint32))) == 1


def test_file_has_random_access(tmp_path):
    rng = np.random.default_rng(2)
    path = tmp_path / "a.bpl"
    counts = [0, 5, T.BLOCK - 5, 3 * T.BLOCK + 17, 1]
    ids = rng.integers(0, 50257, sum(counts)).astype(np.int32)
    with open(path, "wb") as f:
        w = T.ShardWriter(f)
        at = 0
        for k, c in enumerate(counts):
            w.add([k if k else None], ids[at:at + c], np.array([0, c]))
            at += c
        assert w.close() == (len(counts), ids.size)
    with pa.OSFile(str(path)) as f:
        r = T.ShardReader(f)
        assert r.counts.tolist() == counts and r.null.tolist() == [1, 0, 0, 0, 0] and r.docs.tolist()[1:] == [1, 2, 3, 4]
        for k in reversed(range(r.sizes.size)):
            assert np.array_equal(r.chunk(k), ids[k * T.BLOCK:(k + 1) * T.BLOCK])


def test_documents(docs, clashing, empty, library):
    def plain():
        rows = sorted(((r[0] is not None, r[0] or 0), r[1] or "") for r in odd_rows())
        out = []
        for (known, k), text in rows:
            ids = library.encode(text, add_special_tokens=False).ids + [2]
            out.append((k if known else None, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        return out

    for df in (docs, clashing):
        got = T.store_tokens(df, PATH).collect()
        assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=str) == sorted(plain(), key=str)
        got.sort(key=lambda r: r["start"])
        assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1].tolist()]
        order = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in got]
        assert order == sorted(order)
    assert T.store_tokens(empty, PATH).count() == 0
    assert io.BytesIO(T.MAGIC).read() == b"BPLANES1"
