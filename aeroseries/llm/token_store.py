"""Token ids in bit-plane files (operator 8).

Encoding uses the ``tokenizers`` library's byte-level BPE.  Its pre-tokenising
pattern is applied to whole batches as array operations on character classes,
and each different word is merged by the library once (``kernels.WordCache``);
texts with characters beyond U+027F go through the library whole, so that
Unicode tables never matter.

A file is written for each range of doc_id, in ascending order:

    b"BPLANES1"
    chunks: fixed-size blocks of ids, transposed into bit planes, low bit
        first, as many as the block's greatest id needs; each plane is packed
        eight ids to a byte and compressed with zstandard
    index, compressed: a line of JSON (block, chunks, planes, docs), then
        little-endian arrays: ids in each chunk, planes in each chunk, bytes of
        each plane, doc_id of each document (and whether it is null), ids of
        each document
    length of the compressed index (8 bytes), b"BPLANES1"

The index gives any chunk's place without reading the others.  A task writes
under a name of its own attempt and then moves the file, so a repeated or lost
task leaves one whole file.

Defined results: a null text is empty (it has the end id alone); null ids come
first; rows with one doc_id stand in the order of their texts' hashes; other
columns pass through unread.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroseries.llm import kernels as K
from aeroseries.llm.store import new_path

K.ship_by_value(__name__)
MAGIC = b"BPLANES1"
BLOCK = 1 << 16
OTHER, LETTER, NUMBER, SPACE = range(4)
PLAIN = 0x280  # code points whose classes are tabled


def _classes() -> np.ndarray:
    import unicodedata

    out = np.full(PLAIN, OTHER, np.uint8)
    for code in range(PLAIN):
        kind = unicodedata.category(chr(code))[0]
        out[code] = SPACE if code in (9, 10, 11, 12, 13, 32, 0x85, 0xA0) else LETTER if kind == "L" else NUMBER if kind == "N" else OTHER
    return out


CLASSES = _classes()


def plain_documents(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Which documents have only characters below ``PLAIN``."""
    return K.totals(buf >= 0xC0 + (PLAIN >> 6), off) == 0


def pretokens(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Byte places where the tokens of the pre-tokenising pattern start, for plain documents.

    The pattern is
    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
    so tokens are runs of one class; the last space before a run goes with it,
    and an apostrophe with nothing before it takes certain letters.
    """
    place = np.flatnonzero((buf & 0xC0) != 0x80)
    if not place.size:
        return place
    code = buf[place].astype(np.int64)
    two = code >= 0xC0
    code[two] = ((code[two] & 31) << 6) | (buf[place[two] + 1] & 63)
    kind = CLASSES[code]
    n = place.size
    edge = np.zeros(n + 1, bool)
    edge[np.searchsorted(place, off)] = True
    starts = edge[:-1].copy()
    starts[0] = True
    starts[1:] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(starts)
    end = np.append(run[1:], n)
    before = (kind[run] == SPACE) & ~edge[end]
    last = end[before] - 1
    starts[last] = True
    starts[end[before][code[last] == 32]] = False
    quote = run[(kind[run] == OTHER) & (end - run == 1) & ~edge[end]]
    quote = quote[(code[quote] == 39) & starts[quote] & (kind[quote + 1] == LETTER)]
    a = code[quote + 1]
    inner = (quote + 2 < n) & ~edge[np.minimum(quote + 2, n)]
    b = np.where(inner, code[np.minimum(quote + 2, n - 1)], 0)
    size = np.where(np.isin(a, [ord(c) for c in "stmd"]), 1, np.where(((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l")), 2, 0))
    quote, size = quote[size > 0], size[size > 0]
    starts[quote + 1] = False
    after = quote + 1 + size
    after = after[(after < n) & ~edge[np.minimum(after, n)]]
    starts[after[kind[after] == LETTER]] = True
    return place[starts]


class Encoder:
    """The library's ids of whole batches; with ``split_special`` special tokens in a text are ordinary text."""

    def __init__(self, path: str, end_id: int, cache: int = 1_000_000, split_special: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = split_special
        self.literals = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values() if not (split_special and t.special)]
        self.model, self.end_id = self.tokenizer.model, end_id
        # The library's byte alphabet: bytes that aren't printable become characters from U+0100 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.alphabet = {b: b for b in shown} | {b: 256 + k for k, b in enumerate(hidden)}
        self.cache = K.WordCache(cache)

    def __call__(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of UTF-8 texts, the end id after each."""
        plain = plain_documents(buf, off)
        data = buf.tobytes()
        plain[self._with_literals(data, off)] = False
        start = pretokens(buf, off) if plain.all() else self._plain_starts(buf, off, plain)
        end = np.append(start[1:], buf.size)
        if not plain.all():
            end = np.minimum(end, off[np.searchsorted(off, start, "right")]) if start.size else end[:0]

        def compute(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            ids, off = [], [0]
            for a, b in zip(start[places].tolist(), end[places].tolist()):
                ids += [t.id for t in self.model.tokenize(data[a:b].decode("latin-1").translate(self.alphabet))]
                off.append(len(ids))
            return np.array(ids, np.int32), np.array(off)

        ids, at = self.cache.lookup(K.window_hash(K.prefix(K.byte_units(buf)), start, end), compute) if start.size else (np.zeros(0, np.int32), np.zeros(1, np.int64))
        at = at[np.searchsorted(start, off)]
        whole = {int(d): self.tokenizer.encode(data[off[d]:off[d + 1]].decode(), add_special_tokens=False).ids for d in np.flatnonzero(~plain)}
        if whole:
            parts = [np.array(whole[d], np.int32) if d in whole else ids[at[d]:at[d + 1]] for d in range(off.size - 1)]
            ids, at = np.concatenate(parts), np.concatenate([[0], np.cumsum([p.size for p in parts])])
        return np.insert(ids, at[1:], self.end_id), at + np.arange(at.size)

    def _with_literals(self, data: bytes, off: np.ndarray) -> list[int]:
        """The documents that hold an added token's literal, which the library takes as one id."""
        found = []
        for literal in self.literals:
            at = data.find(literal)
            while at >= 0:
                doc = int(np.searchsorted(off, at, "right")) - 1
                inside = at + len(literal) <= off[doc + 1]
                if inside:
                    found.append(doc)
                at = data.find(literal, int(off[doc + 1]) if inside else at + 1)
        return found

    @staticmethod
    def _plain_starts(buf: np.ndarray, off: np.ndarray, plain: np.ndarray) -> np.ndarray:
        use = np.repeat(plain, np.diff(off))
        size = np.where(plain, np.diff(off), 0)
        return np.flatnonzero(use)[pretokens(buf[use], np.concatenate([[0], np.cumsum(size)]))]


def planes(ids: np.ndarray) -> list[bytes]:
    """Bit planes of a block, low bit first, packed."""
    count = max(1, int(ids.max()).bit_length())
    return [np.packbits((ids >> p).astype(np.uint8) & 1).tobytes() for p in range(count)]


def from_planes(parts: list[bytes], n: int) -> np.ndarray:
    out = np.zeros(n, np.uint32)
    for p, part in enumerate(parts):
        out |= np.unpackbits(np.frombuffer(part, np.uint8), count=n).astype(np.uint32) << np.uint32(p)
    return out


class ShardWriter:
    def __init__(self, sink, level: int = 3):
        import zstandard

        self.sink, self.pack = sink, zstandard.ZstdCompressor(level=level).compress
        self.sink.write(MAGIC)
        self.rest, self.sizes, self.planes, self.bytes = [], [], [], []
        self.waiting, self.docs, self.counts = 0, [], []

    def add(self, doc_ids: list, ids: np.ndarray, off: np.ndarray) -> None:
        self.docs += doc_ids
        self.counts.append(np.diff(off))
        self.rest.append(ids)
        self.waiting += ids.size
        if self.waiting >= BLOCK:
            ids = np.concatenate(self.rest)
            whole = ids.size // BLOCK * BLOCK
            for at in range(0, whole, BLOCK):
                self._chunk(ids[at:at + BLOCK])
            self.rest, self.waiting = [ids[whole:]], ids.size - whole

    def _chunk(self, ids: np.ndarray) -> None:
        parts = [self.pack(p) for p in planes(ids.astype(np.uint32))]
        self.sizes.append(ids.size)
        self.planes.append(len(parts))
        self.bytes += map(len, parts)
        for part in parts:
            self.sink.write(part)

    def close(self) -> tuple[int, int]:
        """(documents, ids) written."""
        if self.waiting:
            self._chunk(np.concatenate(self.rest))
        counts = np.concatenate(self.counts) if self.counts else np.zeros(0, np.int64)
        head = {"block": BLOCK, "chunks": len(self.sizes), "planes": len(self.bytes), "docs": len(self.docs)}
        arrays = [np.array(self.sizes, "<i4"), np.array(self.planes, "<i4"), np.array(self.bytes, "<i4"), np.array([d if d is not None else 0 for d in self.docs], "<i8"), np.array([d is None for d in self.docs], "u1"), counts.astype("<i8")]
        index = self.pack(json.dumps(head).encode() + b"\n" + b"".join(a.tobytes() for a in arrays))
        self.sink.write(index + len(index).to_bytes(8, "little") + MAGIC)
        return len(self.docs), int(counts.sum())


class ShardReader:
    """Random access to a file's chunks by its index."""

    def __init__(self, source):
        import zstandard

        self.source, self.unpack = source, zstandard.ZstdDecompressor().decompress
        size = source.size()
        tail = self._at(size - 16, 16)
        if tail[8:] != MAGIC or self._at(0, 8) != MAGIC:
            raise ValueError("not a bit-plane file")
        length = int.from_bytes(tail[:8], "little")
        line, _, raw = self.unpack(self._at(size - 16 - length, length)).partition(b"\n")
        head, at = json.loads(line), 0

        def array(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out

        self.sizes, self.planes, self.bytes = array("<i4", head["chunks"]), array("<i4", head["chunks"]), array("<i4", head["planes"])
        self.docs, self.null, self.counts = array("<i8", head["docs"]), array("u1", head["docs"]), array("<i8", head["docs"])
        self.first = np.concatenate([[0], np.cumsum(self.planes)])
        self.place = len(MAGIC) + np.concatenate([[0], np.cumsum(self.bytes, dtype=np.int64)])

    def _at(self, place: int, size: int) -> bytes:
        self.source.seek(place)
        return self.source.read(size)

    def chunk(self, k: int) -> np.ndarray:
        """The ids of chunk k."""
        a, b = self.first[k], self.first[k + 1]
        raw = self._at(int(self.place[a]), int(self.place[b] - self.place[a]))
        cut = self.place[a:b + 1] - self.place[a]
        return from_planes([self.unpack(raw[x:y]) for x, y in zip(cut[:-1], cut[1:])], int(self.sizes[k]))


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> list[tuple[str, int]]:
    """Write the ids of (doc_id, text) under ``path``; each file with the number of ids before it, in order."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        where, folder = fs.FileSystem.from_uri(path)
        where.create_dir(folder, recursive=True)
        task = TaskContext.get()
        own = f"{folder}/.shard-{task.partitionId():05d}-{task.taskAttemptId()}"
        writer = sink = None
        encode = Encoder(tokenizer, end_id, split_special=False)
        for batch in batches:
            for part in K.slices(batch, "text", 1 << 21):
                if writer is None:
                    sink = where.open_output_stream(own)
                    writer = ShardWriter(sink)
                writer.add(part.column(0).to_pylist(), *encode(*K.flat(part.column(1))))
        if writer is not None:
            n_docs, n_ids = writer.close()
            sink.close()
            name = f"shard-{task.partitionId():05d}.bpl"
            where.move(own, f"{folder}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([task.partitionId()], pa.int32()), pa.array([name]), pa.array([n_docs]), pa.array([n_ids])], ["shard", "name", "n_docs", "n_ids"])

    ordered = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    shards = sorted(ordered.mapInArrow(write, "shard int, name string, n_docs long, n_ids long").collect())
    before, out = 0, []
    for s in shards:
        out.append((f"{path}/{s['name']}", before))
        before += s["n_ids"]
    return out


def read_tokens(spark: SparkSession, shards: list[tuple[str, int]]) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for path, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                where, name = fs.FileSystem.from_uri(path)
                with where.open_input_file(name) as source:
                    shard = ShardReader(source)
                    end = np.cumsum(shard.counts)
                    crc = np.zeros(shard.counts.size, np.int64)
                    at = doc = 0
                    for k in range(shard.sizes.size):
                        ids = memoryview(shard.chunk(k).astype("<u4").tobytes())
                        stop = at + int(shard.sizes[k])
                        while doc < end.size:
                            lo, hi = max(int(end[doc] - shard.counts[doc]), at), min(int(end[doc]), stop)
                            crc[doc] = zlib.crc32(ids[4 * (lo - at):4 * (hi - at)], int(crc[doc]))
                            if end[doc] > stop:
                                break
                            doc += 1
                        at = stop
                    yield pa.RecordBatch.from_arrays([pa.array(shard.docs, mask=shard.null.astype(bool)), pa.array(before + end - shard.counts), pa.array(shard.counts), pa.array(crc)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    rows = spark.createDataFrame(shards, "path string, before long").repartition(max(1, len(shards)))
    return rows.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def store_tokens(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write all ids in the shared folder, and read them back."""
    spark = docs.sparkSession
    return read_tokens(spark, write_tokens(docs, new_path(spark, "tokens"), tokenizer, end_id))
