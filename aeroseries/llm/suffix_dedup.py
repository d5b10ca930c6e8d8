"""Suffix-array deduplication by threshold-bounded interval expansion (operator 3).

Documents are UTF-8 bytes.  Their windows of ``length`` bytes are cut into
segments by minimiser (``repeats``), so that equal windows meet under one key;
different segments with one minimiser are gathered, packed into texts of about
a megabyte, and each text gets a suffix array and its Burrows-Wheeler
transform.  Breadth-first backward extension of the transform's intervals then
derives the common prefixes of neighbouring suffixes by increasing value and
stops at ``length``: suffixes with no boundary between them begin with the same
window.  A window goes if its interval, with the copies of every segment
counted, has two starts or more.

A minimiser with more than ``max_group`` different segments isn't gathered; the
hashes of its windows are counted in Spark instead, with the same result.

Defined results: a null text is empty; texts under ``length`` bytes stay
whole; repeated rows are separate documents, so their windows go; null ids are
kept; other columns pass through unread.  One text must fit into a task's
memory about a hundred times over.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroseries.llm import kernels as K
from aeroseries.llm import repeats as R

K.ship_by_value(__name__)


def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, dense ranks) of 64-bit keys."""
    order = np.argsort(keys)
    ordered = keys[order]
    rank = np.empty(keys.size, np.int64)
    rank[order] = np.cumsum(np.concatenate([[0], (ordered[1:] != ordered[:-1]).astype(np.int64)]))
    return order, rank


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` symbols, by prefix multiplication."""
    n = symbols.size
    order, rank = ranked(symbols)
    have = 1
    while have < depth:
        bits = int(rank.max() + 1).bit_length()
        ways = min(63 // bits, 4)
        shifts = [min(j * have, depth - have) for j in range(ways)]
        key = np.zeros(n, np.int64)
        for shift in shifts:
            key <<= bits
            key[:n - shift] |= rank[shift:] + 1 if shift < n else 0
        order, rank = ranked(key)
        have += shifts[-1]
    return order


def common_prefix_boundaries(symbols: np.ndarray, order: np.ndarray, separators: int, depth: int) -> np.ndarray:
    """Rows whose common prefix with the row before is shorter than ``depth``.

    Level by level, each interval (the rows that begin with one string) is
    extended backwards by every symbol before its rows; the interval reached
    starts a boundary of the level's value if none has been found there.
    Symbols under ``separators`` are unique and extend nothing.
    """
    n = order.size
    before = symbols[order - 1]
    before[before < separators] = 0
    before[before > 0] -= separators - 1
    by_symbol = np.argsort(before.astype(np.uint16), kind="stable")
    to = np.empty(n, np.int64)
    to[by_symbol] = np.arange(n)
    grouped = before[by_symbol]
    earlier, later = np.full(n, -1), np.full(n, n)
    same = np.flatnonzero(grouped[1:] == grouped[:-1])
    earlier[by_symbol[same + 1]] = by_symbol[same]
    later[by_symbol[same]] = by_symbol[same + 1]
    real = before > 0
    leading = symbols[order]
    boundary = np.concatenate([[True], leading[1:] != leading[:-1]])
    lo = np.flatnonzero(boundary)
    hi = np.append(lo[1:], n)
    for _ in range(1, depth):
        if not lo.size:
            break
        owner, row = K.ragged(lo, hi - lo)
        use = real[row]
        owner, row = owner[use], row[use]
        begins = np.sort(to[row[earlier[row] < lo[owner]]])
        ends = np.sort(to[row[later[row] >= hi[owner]]]) + 1
        new = ~boundary[begins]
        lo, hi = begins[new], ends[new]
        boundary[lo] = True
    return boundary


def repeated_windows(text: np.ndarray, off: np.ndarray, copies: np.ndarray, length: int) -> np.ndarray:
    """For each byte of the segments: does the window that starts there occur twice or more?"""
    count = off.size - 1
    size = np.diff(off)
    symbols = np.empty(text.size + count, np.int64)
    place = np.arange(text.size) + np.repeat(np.arange(count), size)
    symbols[place] = text.astype(np.int64) + count
    symbols[off[1:] + np.arange(count)] = np.arange(count)
    order = suffix_order(symbols, length)
    group = np.cumsum(common_prefix_boundaries(symbols, order, count, length)) - 1
    weight = np.repeat(copies, size + 1)
    starts = np.bincount(group, weights=weight[order])
    often = np.empty(symbols.size, bool)
    often[order] = starts[group] >= 2
    return often[place]


def payload(length: int):
    """(text, segs) to the bytes of each representative segment or, of a hot one, the hash w of each window i."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, "text"):
                buf, off = K.flat(part.column(0))
                owner, seg = R.lists(part, "segs")
                place, hot = off[owner] + seg["at"], seg["hot"].astype(bool)
                cold = np.flatnonzero(~hot)
                size = seg["n"][cold] + (length - 1)
                _, at = K.ragged(place[cold], size)
                data = K.string_array(buf[at], np.concatenate([[0], np.cumsum(size)]), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(seg["m"][cold]), pa.array(seg["s"][cold]), pa.array(seg["copies"][cold]), data, pa.nulls(cold.size, pa.int64()), pa.nulls(cold.size, pa.int32())], FIELDS)
                if hot.any():
                    which, start = K.ragged(place[hot], seg["n"][hot])
                    w = K.window_hash(K.prefix(K.byte_units(buf)), start, start + length)
                    which = np.flatnonzero(hot)[which]
                    yield pa.RecordBatch.from_arrays([pa.array(seg["m"][which]), pa.array(seg["s"][which]), pa.array(seg["copies"][which]), pa.nulls(which.size, pa.binary()), pa.array(K.signed(w)), pa.array((start - place[which]).astype(np.int32))], FIELDS)
    return work


FIELDS = ["m", "s", "copies", "data", "w", "i"]


def expanded(length: int, most: int):
    """Of each packed group: (m, s, lo, hi), the byte runs of a segment whose windows repeat."""
    def work(group: pa.Table) -> pa.Table:
        rows = group.sort_by([("m", "ascending"), ("s", "ascending")]).combine_chunks()
        m, s, copies = (rows.column(c).to_numpy() for c in ("m", "s", "copies"))
        # A repeated row of documents hands its representatives in twice.
        fresh = np.ones(m.size, bool)
        fresh[1:] = (m[1:] != m[:-1]) | (s[1:] != s[:-1])
        data = rows.column("data").combine_chunks()
        data = data.chunk(0) if isinstance(data, pa.ChunkedArray) else data
        data, m, s, copies = data.filter(pa.array(fresh)), m[fresh], s[fresh], copies[fresh]
        out = []
        buf, off = K.flat(data)
        family = np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]]))
        at = 0
        while at < m.size:
            # Whole families of one minimiser, about `most` bytes of them.
            far = int(np.searchsorted(off[family], off[at] + most, "right")) - 1
            end = max(int(family[far]), at)
            if end == at:
                k = int(np.searchsorted(family, at, "right"))
                end = int(family[k]) if k < family.size else m.size
            elif off[m.size] <= off[at] + most:
                end = m.size
            text, part = buf[off[at]:off[end]], off[at:end + 1] - off[at]
            often = repeated_windows(text, part, copies[at:end], length)
            lo, hi = K.runs(often, part)
            which = np.searchsorted(part, lo, "right") - 1
            out.append((m[at:end][which], s[at:end][which], lo - part[which], hi - part[which] + length - 1))
            at = end
        return pa.table([np.concatenate(x) for x in zip(*out)], names=["m", "s", "lo", "hi"])
    return work


def repeated_runs(docs: DataFrame, length: int = 200, gram: int = 48, max_group: int = 6000, pack_bytes: int = 1 << 20) -> DataFrame:
    """(k, t, spans): each keyed row's removed byte intervals [lo, hi), not merged yet."""
    repeated = R.repeated_segments(docs, "byte", length, gram)
    distinct, _ = R.write_table(R.distinct_segments(repeated), "byte-distinct")
    family = distinct.groupBy("m").agg(F.count("*").alias("c"), F.sum(F.col("n") + (length - 1)).alias("b")).where("c > 1")
    gathered = distinct.join(family.select("m", (F.col("c") > max_group).alias("hot")), "m").drop("first")
    reps, _ = R.write_table(R.of_representatives(docs, gathered, payload(length), "m long, s long, copies long, data binary, w long, i int"), "byte-representatives")
    packs = math.ceil((reps.agg(F.sum(F.octet_length("data"))).first()[0] or 1) / pack_bytes)
    cold = reps.where("data is not null").select("m", "s", "copies", "data")
    found = cold.groupBy(F.pmod(F.xxhash64("m"), F.lit(packs)).alias("pack")).applyInArrow(expanded(length, pack_bytes), "m long, s long, lo long, hi long")
    windows = reps.where("w is not null").select("m", "s", "copies", "w", "i").dropDuplicates(["m", "s", "i"])
    often = windows.groupBy("m", "w").agg(F.sum("copies").alias("c")).where("c > 1")
    single = windows.join(often.select("m", "w"), ["m", "w"], "left_semi")
    found = found.unionByName(single.select("m", "s", F.col("i").cast("long").alias("lo"), (F.col("i") + length).cast("long").alias("hi")))
    runs = found.groupBy("m", "s").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
    verdict = distinct.select("m", "s", "copies").join(runs, ["m", "s"], "left")
    held = repeated.join(verdict, ["m", "s"])
    whole = F.array(F.struct(F.lit(0).cast("long").alias("lo"), (F.col("n") + (length - 1)).cast("long").alias("hi")))
    spans = held.select(*R.KEY, "at", F.explode(F.when(F.col("copies") > 1, whole).otherwise(F.col("runs"))).alias("x"))
    return R.spans_by_document(spans.select(*R.KEY, (F.col("at") + F.col("x.lo")).alias("lo"), (F.col("at") + F.col("x.hi")).alias("hi")))


def kept_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, spans) to (doc_id, n_bytes, n_removed, n_spans, kept)."""
    for batch in batches:
        for part in K.slices(batch, "text"):
            buf, off = K.flat(part.column(1))
            owner, span = R.lists(part, "spans")
            gone = K.covered(buf.size, span["lo"] + off[owner], span["hi"] + off[owner])
            removed = K.totals(gone, off)
            first, _ = K.runs(gone, off)
            spans = np.bincount(np.searchsorted(off, first, "right") - 1, minlength=part.num_rows)
            kept = K.string_array(buf[~gone], off - np.concatenate([[0], np.cumsum(removed)]), pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(off)), pa.array(removed), pa.array(spans), kept], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def suffix_dedup(docs: DataFrame, length: int = 200, gram: int = 48, max_group: int = 6000) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans and the kept bytes."""
    rows = R.keyed(docs)
    spans = repeated_runs(rows, length, gram, max_group)
    return rows.join(spans, R.KEY, "left").select("doc_id", "text", "spans").mapInArrow(kept_bytes, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
