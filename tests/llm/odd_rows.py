"""One small table with every odd case, for the training-data tests."""

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
#: Names that the operators use themselves.
CLASHES = ["k", "t", "row", "node", "words", "removed", "n_lines", "lang_pred", "score", "ids", "round_trip", "spans", "m", "s", "first", "w", "url_tokens"]


def sentence(seed: int, n: int) -> str:
    """Words from a rule: no two seeds share five in a row."""
    return " ".join("".join(chr(97 + (seed * 31 + i * 7 + j * j * (seed + 3)) % 26) for j in range(2 + (seed + i) % 6)) + str((seed * 1009 + i * i) % 97) for i in range(n))


def odd_rows() -> list[tuple]:
    long = sentence(5, 3000)
    passage = sentence(77, 70)
    base = sentence(11, 120)
    near = base.split(" ")
    near[60] = "changed"
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, "   \n\t ", "en", None, 6), (4, "!!! ... 123", "de", "a", 11), (5, "one", "en", "b", 3),
        (6, base, "en", "a", len(base)), (7, base, "en", "a", len(base)), (8, " ".join(near), "en", "a", 0), (9, long, "en", "a", len(long)),
        (10, "a b " + passage + " c d", "en", "b", 0), (11, "e f g " + passage + " h", "en", None, 0), (12, passage, None, "b", 0),
        (13, "Line one here.\nline ONE here\nLine one, here!\nsomething else", "en", "c", 0), (13, "Line one here.\nline ONE here\nLine one, here!\nsomething else", "en", "c", 0),
        (None, base, "en", "a", 0), (None, None, None, None, None), (14, "é É ñ 漢字 \U0001F600 ▁ x y 'tis we'll can't  two  spaces", "fr", "d", 0),
        (15, "x " * 400, "en", "d", 800), (16, "ab" * 600, "en", "d", 1200), (17, sentence(3, 40) + "\n" + sentence(4, 40), "en", "d", 0), (18, sentence(4, 40) + "\n" + sentence(3, 40), "en", "d", 0),
    ]
    return rows
