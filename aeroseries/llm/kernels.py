"""Vectorised text kernels over Arrow string columns (numpy, inside tasks).

A batch of texts is one UTF-8 byte array with document offsets; units (bytes or
words) become arrays of 64-bit hashes, and windows over them are hashed with
the Rabin-Karp identity on prefix sums, modulo 2**64.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def ship_by_value(name: str) -> None:
    """Executors get this module's functions by value and need no installed package."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


ship_by_value(__name__)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next call."""
    have = _POWERS.get(base)
    if have is None or have.size < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        out, filled = np.ones(size, U64), 1
        while filled < size:
            step = U64(pow(base, filled, 1 << 64))
            out[filled:2 * filled] = out[:filled] * step
            filled *= 2
        _POWERS[base] = have = out
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit of a 64-bit number."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, text: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``most`` bytes of text, or one row."""
    _, off = flat(batch.column(batch.schema.get_field_index(text)))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def runs(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of ``inside`` that don't cross documents."""
    n = inside.size
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edge = off[(off > 0) & (off < n)]
    before[edge], after[edge - 1] = False, False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and each document's first word (with the total at the end)."""
    start, end = runs(~_SPACE[buf], off)
    return start, end, np.searchsorted(start, off)


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values times rising powers: the state of all Rabin-Karp windows."""
    out = np.zeros(values.size + 1, U64)
    np.cumsum(values * powers(BASE, values.size), out=out[1:])
    return out


def window_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rabin-Karp hashes of the spans start..end, the same wherever they stand."""
    return mix((sums[end] - sums[start]) * powers(INVERSE, sums.size)[start] + U64(0xD6E8FEB86659FD93) * (end - start).astype(U64))


def byte_units(buf: np.ndarray) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U64))[buf]


def word_units(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return window_hash(prefix(byte_units(buf)), start, end)


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost least value of every window; values compare by their upper 38 bits."""
    n = values.size - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    low = U64((1 << 26) - 1)
    if values.size > int(low):
        raise ValueError("a text of over 2**26 units")
    best = (values & ~low) | np.arange(values.size, dtype=U64)
    done = 1
    while 2 * done <= width:
        best = np.minimum(best[:-done], best[done:])
        done *= 2
    if done < width:
        best = np.minimum(best[:best.size - (width - done)], best[width - done:])
    return (best[:n] & low).astype(np.int64)


def segments(units: np.ndarray, off: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Cut every document's windows of ``length`` units into segments by minimiser.

    Of each window, the least ``gram`` units long hash inside is its minimiser;
    neighbouring windows with the same one form a segment.  Equal windows have
    equal minimisers, wherever they stand, so they meet by minimiser.
    Returns (document, first window, windows, minimiser hash, segment hash).
    """
    empty = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U64),) * 2
    if units.size < length:
        return empty
    sums = prefix(units)
    grams = mix((sums[gram:] - sums[:-gram]) * powers(INVERSE, sums.size - gram))
    least = sliding_argmin(grams, length - gram + 1)
    # The windows of a document are its first size - length + 1 places.
    windows = np.maximum(np.diff(off) - length + 1, 0)
    held = np.flatnonzero(windows)
    if not held.size:
        return empty
    cut = np.ones(least.size, bool)
    np.not_equal(least[1:], least[:-1], out=cut[1:])
    cut[off[held]] = True
    beyond = off[held] + windows[held]
    end = np.zeros(least.size + 1, bool)
    end[beyond] = True
    mark = np.flatnonzero(cut | end[:-1])
    doc = np.searchsorted(off, mark, "right") - 1
    # Marks past a document's last window only end the segment before them.
    inside = mark < off[doc] + windows[doc]
    stop = np.minimum(np.append(mark[1:], least.size), off[doc] + windows[doc])
    start, doc = mark[inside], doc[inside]
    count = stop[inside] - start
    return doc, start - off[doc], count, grams[least[start]], window_hash(sums, start, start + count - 1 + length)


def ragged(start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, value) of the ranges start .. start+count-1, one after the other."""
    total = int(count.sum())
    owner = np.repeat(np.arange(count.size), count)
    before = np.cumsum(count) - count
    return owner, np.arange(total) - before[owner] + start[owner]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of spans as maximal runs, in order; touching spans join."""
    if not start.size:
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.ones(start.size, bool)
    new[1:] = start[1:] > end[:-1]
    first = np.flatnonzero(new)
    return start[first], end[np.append(first[1:], start.size) - 1]


def string_array(data: np.ndarray, off: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Strings or binaries of one byte array and offsets."""
    wide = pa.large_string() if pa.types.is_string(kind) else pa.large_binary()
    out = pa.Array.from_buffers(wide, off.size - 1, [None, pa.py_buffer(off.astype(np.int64).tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())])
    return out.cast(kind) if data.size < 1 << 31 else out


def covered(size: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Which of ``size`` units lie in one of the spans."""
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, lo, 1)
    np.add.at(step, hi, -1)
    return np.cumsum(step)[:-1] > 0


def totals(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` in each document."""
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[off[1:]] - sums[off[:-1]]


def joined_words(buf: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray, keep: np.ndarray) -> pa.Array:
    """Each document's kept words, joined by one space."""
    size = np.where(keep, end - start + 1, 0)
    owner, at = ragged(start, size)
    out = np.append(buf, np.uint8(32))[at]
    last = np.cumsum(size)[keep] - 1
    out[last] = 32
    # The space after a document's last kept word goes.
    off = np.concatenate([[0], np.cumsum(size)])[first]
    tail = off[1:][np.diff(off) > 0] - 1
    stay = np.ones(out.size, bool)
    stay[tail] = False
    return string_array(out[stay], off - np.concatenate([[0], np.cumsum(np.diff(off) > 0)]), pa.string())


class WordCache:
    """Id lists of words by their hash; starts anew beyond ``most`` words."""

    def __init__(self, most: int = 400_000):
        self.most = most
        self.key, self.place = np.zeros(0, U64), np.zeros(0, np.int64)
        self.ids, self.off = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def lookup(self, key: np.ndarray, compute) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the words with these hashes; ``compute(places)`` gives (ids, offsets) of those not seen yet."""
        unique, first, same = np.unique(key, return_index=True, return_inverse=True)
        if self.key.size + unique.size > self.most:
            self.__init__(self.most)
        at = np.minimum(np.searchsorted(self.key, unique), max(self.key.size - 1, 0))
        known = self.key[at] == unique if self.key.size else np.zeros(unique.size, bool)
        if not known.all():
            new = np.flatnonzero(~known)
            ids, off = compute(first[new])
            place = np.arange(new.size) + self.off.size - 1
            self.ids, self.off = np.concatenate([self.ids, ids]), np.concatenate([self.off, off[1:] + self.off[-1]])
            where = np.searchsorted(self.key, unique[new])
            self.key, self.place = np.insert(self.key, where, unique[new]), np.insert(self.place, where, place)
            at = np.searchsorted(self.key, unique)
        word = self.place[at][same]
        count = self.off[word + 1] - self.off[word]
        _, at = ragged(self.off[word], count)
        return self.ids[at], np.concatenate([[0], np.cumsum(count)])
