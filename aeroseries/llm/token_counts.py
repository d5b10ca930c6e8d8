"""Token counts by overlap resynchronisation (operator 13).

Every text is counted as the ``tokenizers`` library encodes it.  Texts of up to
``chunk`` characters are counted in batches: byte-level BPE merges inside
pre-tokens only, so each different pre-token is merged by the library once
(``kernels.WordCache``); texts beyond the tabled characters, or with an added
token in them, go through the library whole.

A longer text is cut into chunks that overlap, each a row of its own, so that a
huge document is encoded by many tasks and none holds its encoding whole.  The
library encodes a chunk with offsets.  In the overlap of two neighbours both
report the places where a token ends and another starts, with the tokens before
each, if the place is proven stable (``stable``): the pre-tokenising pattern
ends a match there whatever stands further left or right, so the encoding of
the whole text has the same boundary, the first chunk's tokens up to it and the
second one's from it.  The neighbours are spliced at the first place that both
report.  Where they have none, the document's chunks are cut anew with overlaps
``widen`` times as long, until they align or one chunk holds the text.

Proven are: a character that is no white space before white space; and two
neighbours of different classes (letter, number, other) among the tabled
characters, unless an apostrophe comes before a letter (a contraction may span
them).  Neither counts inside an added token's literal.  A tokenizer with
another pre-tokenizer, or with a normalizer, has no such proof here: its texts
are encoded whole.

Defined results: a null text is empty (no bytes, no tokens); each of repeated
rows is counted by itself; an empty table gives an empty result; other columns
pass through unread.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroseries.llm import kernels as K
from aeroseries.llm import token_store as S
from aeroseries.llm.store import remove, write_table

K.ship_by_value(__name__)
CHUNK, OVERLAP, WIDEN = 1 << 15, 256, 8
UNKNOWN = 9


def byte_level(path: str) -> bool:
    """Whether the tokenizer is byte-level BPE by the usual pattern, without a normalizer."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    pre = spec.get("pre_tokenizer") or {}
    return spec["model"]["type"] == "BPE" and not spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")


def literals(tokenizer) -> list[str]:
    """The strings of the added tokens, which the library looks for before all else."""
    return [t.content for t in tokenizer.get_added_tokens_decoder().values()]


class Counter:
    """The library's token counts of texts, and its boundaries in chunks."""

    def __init__(self, path: str, plain: bool, cache: int = 400_000):
        from tokenizers import Tokenizer, processors

        self.encoder = S.Encoder(path, 0, split_special=False) if plain else None
        self.tokenizer = self.encoder.tokenizer if plain else Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.literals = literals(self.tokenizer)
        if plain:
            # Offsets with the leading space; ids stay as they are.
            self.tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
        self.cache = K.WordCache(cache)

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def counts(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Tokens of each UTF-8 text."""
        data = buf.tobytes()
        text = lambda d: data[off[d]:off[d + 1]].decode()
        if self.encoder is None:
            return np.array([self.whole(text(d)) for d in range(off.size - 1)], np.int64)
        plain = S.plain_documents(buf, off)
        plain[self.encoder._with_literals(data, off)] = False
        start = S.pretokens(buf, off) if plain.all() else self.encoder._plain_starts(buf, off, plain)
        end = np.append(start[1:], buf.size)
        if start.size:
            end = np.minimum(end, off[np.searchsorted(off, start, "right")])
        out = np.zeros(off.size - 1, np.int64)
        if start.size:
            def compute(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                sizes = [len(self.encoder.model.tokenize(data[a:b].decode("latin-1").translate(self.encoder.alphabet))) for a, b in zip(start[places].tolist(), end[places].tolist())]
                return np.array(sizes, np.int32), np.arange(len(sizes) + 1)

            each, _ = self.cache.lookup(K.window_hash(K.prefix(K.byte_units(buf)), start, end), compute)
            out = K.totals(each, np.searchsorted(start, off))
        for d in np.flatnonzero(~plain):
            out[d] = self.whole(text(d))
        return out

    def boundaries(self, text: str, lo: int, hi: int, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
        """(place, tokens before) of the stable places lo <= place < hi of ``text`` where this encoding has a boundary."""
        found = [p for p in range(max(lo, 1), min(hi, len(text))) if stable(text, p, self.literals)]
        before = np.searchsorted(starts, found, "left")
        return [(p, int(n)) for p, n in zip(found, before) if n and ends[n - 1] <= p]

    def offsets(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        spans = np.array(self.tokenizer.encode(text, add_special_tokens=False).offsets, np.int64).reshape(-1, 2)
        return spans[:, 0], spans[:, 1]


def _class(c: str) -> int:
    code = ord(c)
    if code < S.PLAIN:
        return int(S.CLASSES[code])
    # U+180E was white space in older tables.
    return S.SPACE if c.isspace() or code == 0x180E else UNKNOWN


def stable(text: str, p: int, literals: list[str]) -> bool:
    """Whether every encoding of a text with ``text[p-1]``, ``text[p]`` in it has a boundary between the two."""
    a, b = _class(text[p - 1]), _class(text[p])
    if a == S.SPACE or a == b:
        return False
    if b != S.SPACE and (a == UNKNOWN or b == UNKNOWN or (text[p - 1] == "'" and b == S.LETTER)):
        return False
    return not any(text.find(x, max(p - len(x) + 1, 0), p + len(x) - 1) >= 0 for x in literals if len(x) > 1)


def _counted(docs: DataFrame, path: str, plain: bool) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path, plain)
        for batch in batches:
            for part in K.slices(batch, "text"):
                buf, off = K.flat(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(off)), pa.array(counter.counts(buf, off))], ["doc_id", "n_bytes", "n_tokens"])

    return docs.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")


def _cut(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(row, i, last, start, text): overlapping chunks of each text; chunk i holds the places from i * chunk up to (i + 1) * chunk + overlap."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                # A rest shorter than an overlap stays with the chunk before it.
                count = max(1, (len(text) - overlap + chunk - 1) // chunk)
                for i in range(count):
                    stop = (i + 1) * chunk + overlap if i + 1 < count else len(text)
                    yield pa.RecordBatch.from_pydict({"row": [row.as_py()], "i": [i], "last": [i + 1 == count], "start": [i * chunk], "text": [text[i * chunk:stop]]}, schema=schema)

    schema = pa.schema([("row", pa.int64()), ("i", pa.int64()), ("last", pa.bool_()), ("start", pa.int64()), ("text", pa.string())])
    return texts.select("row", "text").mapInArrow(cut, "row long, i long, last boolean, start long, text string")


_PLACES = "array<struct<place: long, before: long>>"


def _encoded(chunks: DataFrame, path: str, overlap: int) -> DataFrame:
    """(row, i, last, n, head, tail): tokens of each chunk, its boundaries in the overlap before it and in the one after it."""
    place = pa.list_(pa.struct([("place", pa.int64()), ("before", pa.int64())]))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path, True)
        for batch in batches:
            for part in K.slices(batch, "text"):
                for row, i, last, start, text in zip(*(c.to_pylist() for c in part.columns)):
                    head, tail, alone = [], [], last and not i
                    if not alone:
                        starts, ends = counter.offsets(text)
                        head = counter.boundaries(text, 0, overlap, starts, ends) if i else []
                        tail = [] if last else counter.boundaries(text, len(text) - overlap, len(text), starts, ends)
                    held = [pa.array([[{"place": start + p, "before": n} for p, n in x]], place) for x in (head, tail)]
                    n = counter.whole(text) if alone else starts.size
                    yield pa.RecordBatch.from_arrays([pa.array([row], pa.int64()), pa.array([i], pa.int64()), pa.array([last]), pa.array([n], pa.int64()), *held], ["row", "i", "last", "n", "head", "tail"])

    spread = chunks.repartition(F.xxhash64("row", "i"))
    return spread.mapInArrow(encode, f"row long, i long, last boolean, n long, head {_PLACES}, tail {_PLACES}")


def _spliced(encoded: DataFrame) -> DataFrame:
    """(row, n_tokens): the sum of a text's chunks up to and from their common boundaries; null where two neighbours have none."""
    left = encoded.where("not last").select("row", (F.col("i") + 1).alias("i"), "n", "tail")
    right = encoded.where("i > 0").select("row", "i", "head")
    first = F.array_min(F.array_intersect(F.transform("tail", lambda x: x["place"]), F.transform("head", lambda x: x["place"])))
    at = left.join(right, ["row", "i"]).select("row", "n", first.alias("p"), "head", "tail")
    before = lambda c: F.get(F.filter(c, lambda x: x["place"] == F.col("p")), F.lit(0))["before"]
    # The first chunk's tokens behind the boundary and the second one's before it are not the text's.
    over = at.select("row", (F.col("n") - before("tail") + before("head")).alias("over"))
    lost = over.groupBy("row").agg(F.sum("over").alias("over"), F.count_if(F.col("over").isNull()).alias("open"))
    total = encoded.groupBy("row").agg(F.sum("n").alias("n"))
    return total.join(lost, "row", "left").select("row", F.when(F.coalesce("open", F.lit(0)) == 0, F.col("n") - F.coalesce("over", F.lit(0))).alias("n_tokens"))


def token_counts(docs: DataFrame, path: str, limit: int = 512, chunk: int = CHUNK, overlap: int = OVERLAP, widen: int = WIDEN) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs`` (doc_id, text).

    ``path`` is a tokenizers file; ``chunk`` and ``overlap`` count characters. An
    overlap is at least as long as each added token's literal, so that one of
    two neighbours sees it whole, and a chunk at least as long as four overlaps.
    """
    from tokenizers import Tokenizer

    plain = byte_level(path)
    overlap = max([overlap, *map(len, literals(Tokenizer.from_file(path)))])
    chunk = max(chunk, 4 * overlap)
    texts = docs.select("doc_id", F.col("text"))
    huge = (F.coalesce(F.length("text"), F.lit(0)) > chunk + overlap) if plain else F.lit(False)
    parts = [_counted(texts.where(~huge), path, plain)]
    if plain:
        # Few texts; written once, so that each keeps its number in every round.
        kept, _ = write_table(texts.where(huge).select("doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"), F.monotonically_increasing_id().alias("row")), "huge-texts")
        left = kept
        while left.limit(1).count():
            # Read three times below; encoded once.
            encoded, encoded_path = write_table(_encoded(_cut(left, chunk, overlap), path, overlap), "chunk-counts")
            found, _ = write_table(_spliced(encoded), "spliced")
            remove(docs.sparkSession, encoded_path)
            parts.append(kept.join(found.where("n_tokens is not null"), "row").select("doc_id", "n_bytes", "n_tokens"))
            left = left.join(found.where("n_tokens is null").select("row"), "row", "left_semi")
            overlap *= widen
            chunk = max(chunk, 4 * overlap)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
