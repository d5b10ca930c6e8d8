"""Substring deduplication by Rabin-Karp hashes of fixed-length token windows (operator 4).

Every window of ``length`` words has a Rabin-Karp hash.  Runs of windows with
one minimiser travel as segments, whose own rolling hash stands for all their
windows at once (``repeats``); where different segments share a minimiser, the
hash of every single window is counted in Spark.  The least document of each
window decides: a window goes wherever it starts in a later document.
Overlapping windows merge into maximal removal intervals.

Defined results: a null text has no words; texts shorter than a window stay
whole; a null doc_id counts as less than all others; rows that repeat a doc_id
don't remove each other; other columns pass through unread.  One text must fit
into a task's memory about sixty times over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroseries.llm import kernels as K
from aeroseries.llm import repeats as R

K.ship_by_value(__name__)


def window_intervals(docs: DataFrame, length: int = 50, gram: int = 10) -> DataFrame:
    """(k, t, spans): each keyed row's removed word intervals [lo, hi), not merged yet."""
    repeated = R.repeated_segments(docs, "word", length, gram)
    distinct, _ = R.write_table(R.distinct_segments(repeated), "word-distinct")
    windows, _ = R.write_table(R.window_rows(docs, R.contested(distinct), "word", length), "word-windows")
    counted = windows.groupBy("m", "w").agg(F.count("*").alias("c"), F.min("first").alias("least")).where("c > 1")
    earlier = windows.join(counted, ["m", "w"]).where("least < first").groupBy("m", "s").agg(F.collect_set(F.struct("i", "least")).alias("over"))
    verdict = distinct.select("m", "s", F.col("first").alias("seg_first")).join(earlier, ["m", "s"], "left")
    found = repeated.join(verdict, ["m", "s"])
    whole = F.array(F.struct(F.col("at").alias("lo"), (F.col("at") + F.col("n") + (length - 1)).alias("hi")))
    single = F.transform(F.filter("over", lambda o: o["least"] < F.col("k")), lambda o: F.struct((F.col("at") + o["i"]).alias("lo"), (F.col("at") + o["i"] + length).alias("hi")))
    spans = F.when(F.col("k") > F.col("seg_first"), whole).otherwise(single)
    return R.spans_by_document(found.select(*R.KEY, F.explode(spans).alias("x")).select(*R.KEY, "x.lo", "x.hi"))


def kept_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, spans) to (doc_id, n_words, n_removed, spans, kept text)."""
    for batch in batches:
        for part in K.slices(batch, "text"):
            buf, off = K.flat(part.column(1))
            start, end, first = K.words(buf, off)
            owner, span = R.lists(part, "spans")
            gone = K.covered(start.size, span["lo"] + first[owner], span["hi"] + first[owner])
            texts = K.joined_words(buf, start, end, first, ~gone)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(first)), pa.array(K.totals(gone, first)), texts], ["doc_id", "n_words", "n_removed", "kept_text"])


def substring_dedup(docs: DataFrame, length: int = 50, gram: int = 10) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_text (kept words joined by one space)."""
    rows = R.keyed(docs)
    spans = window_intervals(rows, length, gram)
    return rows.join(spans, R.KEY, "left").select("doc_id", "text", "spans").mapInArrow(kept_words, "doc_id long, n_words long, n_removed long, kept_text string")


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
