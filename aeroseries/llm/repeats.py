"""Windows that repeat across a corpus: the stages that operators 3 and 4 share.

A corpus has as many windows as units, too many to shuffle.  So the windows are
cut into segments by minimiser (``kernels.segments``), and a segment travels as
one small row until Spark has counted which minimisers occur twice; only
segments of those can hold a repeated window.  Copies of a whole segment fold
into one representative with a count.  Every step is a partially aggregated
count or a join whose large side Spark may split, so a hot passage loads no
single task; no group of rows is ever collected.

A row of documents is known by (doc_id, a hash of its text): repeated rows and
null ids stay apart from each other or fold together with equal results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroseries.llm import kernels as K
from aeroseries.llm.store import remove, write_table

K.ship_by_value(__name__)
NO_ID = -(1 << 63)
KEY = ["k", "t"]


def keyed(docs: DataFrame) -> DataFrame:
    """(k, t, doc_id, text): the key is never null, so both joins share one exchange of the texts."""
    return docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("k"), F.xxhash64("text").alias("t"), "doc_id", "text")


def boxed(docs: DataFrame) -> DataFrame:
    """(row, k, t, text): whole rows as one column, so that no name of theirs meets one of ours."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.coalesce("doc_id", F.lit(NO_ID)).alias("k"), F.xxhash64("text").alias("t"), "text")


def units_of(unit: str, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a batch's units and each document's first unit."""
    if unit == "byte":
        return K.byte_units(buf), off
    start, end, first = K.words(buf, off)
    return K.word_units(buf, start, end), first


def segment_table(docs: DataFrame, unit: str, length: int, gram: int) -> tuple[DataFrame, str]:
    """(m, s, k, t, at, n): every document's segments, written in the shared folder."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, "text"):
                units, off = units_of(unit, *K.flat(part.column(2)))
                doc, at, n, m, s = K.segments(units, off, length, gram)
                if doc.size:
                    yield pa.RecordBatch.from_arrays([pa.array(K.signed(m)), pa.array(K.signed(s)), part.column(0).take(pa.array(doc)), part.column(1).take(pa.array(doc)), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))], ["m", "s", "k", "t", "at", "n"])

    rows = docs.select("k", "t", "text").mapInArrow(cut, "m long, s long, k long, t long, at int, n int")
    return write_table(rows, f"{unit}-segments")


def repeated_segments(docs: DataFrame, unit: str, length: int, gram: int) -> DataFrame:
    """The segments whose minimiser occurs more than once, written in the shared folder."""
    segments, path = segment_table(docs, unit, length, gram)
    counted = segments.groupBy("m").agg(F.count("*").alias("c")).where("c > 1").select("m")
    repeated, _ = write_table(segments.join(counted, "m", "left_semi"), f"{unit}-repeated")
    remove(docs.sparkSession, path)
    return repeated


def distinct_segments(repeated: DataFrame) -> DataFrame:
    """(m, s, n, copies, first, rep): one row for each different segment; ``first`` is the least document."""
    return repeated.groupBy("m", "s").agg(F.first("n").alias("n"), F.count("*").alias("copies"), F.min("k").alias("first"), F.min(F.struct("k", "t", "at")).alias("rep"))


def contested(distinct: DataFrame) -> DataFrame:
    """The different segments whose minimiser has another segment too; elsewhere a window lies in copies of one segment only."""
    several = distinct.groupBy("m").agg(F.count("*").alias("c")).where("c > 1").select("m")
    return distinct.join(several, "m", "left_semi")


def of_representatives(docs: DataFrame, distinct: DataFrame, work: Callable, schema: str) -> DataFrame:
    """Run ``work`` over the texts that hold representatives.

    Each batch has (text, segs), segs the list of the representatives inside:
    ``at`` and the columns of ``distinct`` but ``rep``.
    """
    seg = F.struct(*[c for c in distinct.columns if c != "rep"], F.col("rep.at").alias("at"))
    held = distinct.groupBy(F.col("rep.k").alias("k"), F.col("rep.t").alias("t")).agg(F.collect_list(seg).alias("segs"))
    return docs.join(held, KEY).select("text", "segs").mapInArrow(work, schema)


def lists(part: pa.RecordBatch, name: str) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """(owner row, fields) of a list-of-struct column."""
    column = part.column(part.schema.get_field_index(name))
    if column.null_count == len(column):
        return np.zeros(0, np.int64), {f.name: np.zeros(0, np.int64) for f in column.type.value_type}
    owner = pc.list_parent_indices(column)
    inner = column.flatten()
    return owner.to_numpy(zero_copy_only=False), {f.name: inner.field(i).to_numpy(zero_copy_only=False) for i, f in enumerate(column.type.value_type)}


def window_rows(docs: DataFrame, distinct: DataFrame, unit: str, length: int) -> DataFrame:
    """(m, w, s, i, copies, first): the Rabin-Karp hash w of every window i of every different segment."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, "text"):
                units, off = units_of(unit, *K.flat(part.column(0)))
                owner, seg = lists(part, "segs")
                which, start = K.ragged(off[owner] + seg["at"], seg["n"])
                w = K.window_hash(K.prefix(units), start, start + length)
                i = start - (off[owner] + seg["at"])[which]
                yield pa.RecordBatch.from_arrays([pa.array(seg["m"][which]), pa.array(K.signed(w)), pa.array(seg["s"][which]), pa.array(i.astype(np.int32)), pa.array(seg["copies"][which]), pa.array(seg["first"][which])], ["m", "w", "s", "i", "copies", "first"])

    return of_representatives(docs, distinct, hashed, "m long, w long, s long, i int, copies long, first long")


def spans_by_document(spans: DataFrame) -> DataFrame:
    """(k, t, spans) of rows (k, t, lo, hi) in units."""
    return spans.groupBy(*KEY).agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
