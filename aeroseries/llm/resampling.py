"""Target-distribution importance resampling (operator 12).

Hashed n-gram features of the raw corpus and of a target are counted into a
fixed number of buckets; a bucket's gain is the log ratio of the two smoothed
multinomials, in whole thousandths.  A document's weight is the sum of its
features' gains, its score adds Gumbel noise from a hash of its id, and the
highest scores are drawn: a sample without replacement, with odds by weight.

Both passes over the texts are array code on batches: byte runs are words, the
features' checksums advance together, byte by byte, and the gains are one array
of ``buckets`` numbers, looked up by bucket.  A task sends on at most ``buckets``
counts, so the corpus' counts are a bounded table.

The draw is a distributed quickselect over composite keys (score down, doc_id
up).  Each round takes a few random keys of the open interval as pivots, counts
exactly how many rows lie below, at and above each in one pass, and keeps the
interval that holds the k-th key; it ends at the key itself.  Only the winners
are sorted and ranked.  The scored rows are written once in the shared folder,
so rounds read a narrow table, and a lost executor costs its own tasks.

Defined results: doc_id is a whole number; a null text has no words; a null id hashes as an empty one and
comes before all others in ties; each of repeated rows is drawn by itself (of
rows with one key at the end of the draw as many as are left to draw); an empty
table gives an empty result; other columns pass through unread.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroseries.llm import kernels as K
from aeroseries.llm.store import write_table

K.ship_by_value(__name__)
BUCKETS = 10_000
#: A feature of more bytes gets its checksum from the library, one by one.
WIDE = 48


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower case of each byte, whether it stands in words, and the checksum's table."""
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    word = np.zeros(256, bool)
    word[48:58] = word[97:123] = word[128:] = True
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, np.uint32(0xEDB88320) ^ (crc >> np.uint32(1)), crc >> np.uint32(1))
    return low, word, crc


LOWER, IN_WORD, CRC = _tables()


def checksums(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """crc32 of the spans start..end, all of them advancing together."""
    size = end - start
    out = np.full(start.size, 0xFFFFFFFF, np.uint32)
    order = np.argsort(-np.minimum(size, WIDE + 1), kind="stable")
    # Longest first, so the spans that still have a byte are a prefix.
    place, left, state = start[order], size[order], out[order]
    first = int(np.searchsorted(-left, -WIDE, "left"))
    more = np.searchsorted(-np.minimum(left, WIDE + 1), -np.arange(1, WIDE + 1), "right")
    for j in range(WIDE):
        n = int(more[j])
        if n <= first:
            break
        x = state[first:n]
        state[first:n] = CRC[(x ^ buf[place[first:n] + j]) & 0xFF] ^ (x >> np.uint32(8))
    state ^= np.uint32(0xFFFFFFFF)
    for i in range(first):
        state[i] = zlib.crc32(buf[place[i]:place[i] + left[i]])
    out[order] = state
    return out


def features(buf: np.ndarray, off: np.ndarray, ngrams: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every feature, each document's first feature, words of each document); a document's features stand together."""
    buf = LOWER[buf]
    start, end = K.runs(IN_WORD[buf], off)
    first = np.searchsorted(start, off)
    words = np.diff(first)
    if ngrams == 1:
        return checksums(buf, start, end) % np.uint32(buckets), first, words
    # Words joined by one space, so that a run of words is one span.
    size = end - start + 1
    _, at = K.ragged(start, size)
    joined = np.append(buf, np.uint8(32))[at]
    stop = np.cumsum(size) - 1
    joined[stop] = 32
    begin = stop - size + 1
    doc = np.repeat(np.arange(words.size), words)
    spans = []
    for n in range(1, ngrams + 1):
        head = np.arange(max(start.size - n + 1, 0))
        head = head[doc[head] == doc[head + n - 1]]
        spans.append((doc[head], begin[head], stop[head + n - 1]))
    owner, a, b = (np.concatenate(x) for x in zip(*spans))
    order = np.argsort(owner, kind="stable")
    found = checksums(joined, a[order], b[order]) % np.uint32(buckets)
    return found, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=words.size))]), words


def bucket_counts(docs: DataFrame, ngrams: int = 1, buckets: int = BUCKETS) -> list[int]:
    """How many features of all texts lie in each bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in K.slices(batch, "text"):
                held += np.bincount(features(*K.flat(part.column(0)), ngrams, buckets)[0], minlength=buckets)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], ["bucket", "n"])

    out = [0] * buckets
    for r in docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: list[int], target: list[int]) -> list[int]:
    """floor(1000 ln(target share / raw share)) of every bucket, both smoothed by one feature a bucket."""
    s, t, n = float(sum(raw)), float(sum(target)), len(raw)
    return [math.floor(1000 * math.log((y + 1.0) * (s + n) / ((x + 1.0) * (t + n)))) for x, y in zip(raw, target)]


def weigh(docs: DataFrame, gain: list[int], ngrams: int = 1) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    table, kind = np.array(gain, np.int64), docs.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, "text"):
                bucket, first, words = features(*K.flat(part.column(1)), ngrams, table.size)
                weight = K.totals(table[bucket], first)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(words.astype(np.int64)), pa.array(np.diff(first).astype(np.int64)), pa.array(weight)], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in whole thousandths from a hash of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


#: The least key is the best; the rest of the key tells rows of one id apart.
KEY = ["down", "has_id", "id", "n_features", "weight"]


def _key(table: DataFrame) -> Column:
    return F.struct((-F.col("score")).alias("down"), F.col("doc_id").isNotNull().alias("has_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), "n_features", "weight")


def _literal(key: tuple) -> Column:
    return F.struct(*[F.lit(v).cast("boolean" if n == "has_id" else "long").alias(n) for n, v in zip(KEY, key)])


def kth_key(keys: DataFrame, k: int, pivots: int = 24, seed: int = 0) -> tuple | None:
    """The k-th least ``key`` (1 is the least) by distributed quickselect; None where there are fewer.

    Every round rules out its pivots at least; about log(rows) / log(pivots)
    rounds are expected.
    """
    low = high = None
    n = -1
    while True:
        n += 1
        inside = F.lit(True)
        if low is not None:
            inside &= F.col("key") > _literal(low)
        if high is not None:
            inside &= F.col("key") < _literal(high)
        # A hash of key and round deals out the pivots: random, yet the same when a task is run again.
        open_keys = keys.where(inside).select("key", F.xxhash64("key", F.lit(seed + n)).alias("o"))
        taken = sorted({tuple(r["key"]) for r in open_keys.orderBy("o", "key").limit(pivots).collect()})
        if not taken:
            return None
        counts = keys.agg(*[f(F.when(c, 1)).alias(f"{s}{i}") for i, p in enumerate(taken) for s, f, c in (("b", F.count, F.col("key") < _literal(p)), ("a", F.count, F.col("key") == _literal(p)))]).first()
        for i, p in enumerate(taken):
            if counts[f"b{i}"] >= k:
                high = p
                break
            if counts[f"b{i}"] + counts[f"a{i}"] >= k:
                return p
            low = p


def ranked(winners: DataFrame) -> DataFrame:
    """``winners`` with their place by ``key`` (1, 2, 3 ...); sorted in ranges, never in one task."""
    marked, path = write_table(winners.repartitionByRange("key").sortWithinPartitions("key").withColumn("row", F.monotonically_increasing_id()), "winners")
    # The upper bits of such an id are the partition, the lower ones the place in it.
    part, place = F.shiftright("row", 33), F.col("row").bitwiseAND(F.lit((1 << 33) - 1))
    counts = sorted((r["p"], r["n"]) for r in marked.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    before, rows = 0, []
    for p, n in counts:
        rows.append((p, before))
        before += n
    # One row a partition, so its size is bounded by their number.
    starts = F.broadcast(marked.sparkSession.createDataFrame(rows, "p long, before long"))
    return marked.join(starts, part == F.col("p")).withColumn("rank", F.col("before") + place + 1).drop("row", "p", "before")


def resample(docs: DataFrame, target: DataFrame, share_pct: int = 10, min_words: int = 20, ngrams: int = 1, buckets: int = BUCKETS, seed: int = 2024) -> DataFrame:
    """Every row of ``docs`` (doc_id, text): n_features, weight, score, and the rank of those drawn.

    ``share_pct`` percent of the rows with ``min_words`` words or more are
    drawn; ``target`` (text) holds the texts whose distribution they follow.
    """
    gain = gains(bucket_counts(docs, ngrams, buckets), bucket_counts(target, ngrams, buckets))
    rows = weigh(docs, gain, ngrams)
    scored, _ = write_table(rows.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "scored")
    scored = scored.withColumn("fit", F.col("n_words") >= min_words)
    k = share_pct * scored.where("fit").count() // 100
    none = F.lit(None).cast("long").alias("rank")
    out = ["doc_id", "n_features", "weight", "score"]
    if not k:
        return scored.select(*out, none)
    keyed = scored.withColumn("key", _key(scored))
    last = _literal(kth_key(keyed.where("fit").select("key"), k))
    won = ranked(keyed.where(F.col("fit") & (F.col("key") <= last)))
    won = won.select(*out, F.when(F.col("rank") <= k, F.col("rank")).alias("rank"))
    return won.unionByName(keyed.where(~F.col("fit") | (F.col("key") > last)).select(*out, none))


_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
#: The checksum of a word, bit by bit: -1 stands for one step of the polynomial.
CRC_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(cast(length(hx) // 2 AS BIGINT)),
    lambda i: [(instr('0123456789ABCDEF', substr(hx, cast(2 * i + 1 AS BIGINT), 1)) - 1) * 16 + instr('0123456789ABCDEF', substr(hx, cast(2 * i + 2 AS BIGINT), 1)) - 1, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))"""
SQL = f"""
WITH dw AS (SELECT doc_id, unnest({_WORDS}) AS w FROM documents),
tw AS (SELECT unnest({_WORDS}) AS w FROM benchmark),
seen AS (SELECT w, hex(encode(w)) AS hx FROM (SELECT DISTINCT w FROM dw UNION SELECT DISTINCT w FROM tw) x),
coded AS (SELECT w, {CRC_SQL} % {BUCKETS} AS b FROM seen),
db AS (SELECT doc_id, b FROM dw JOIN coded USING (w)),
s AS (SELECT b, count(*) AS s FROM db GROUP BY b), t AS (SELECT b, count(*) AS t FROM tw JOIN coded USING (w) GROUP BY b),
al AS (SELECT (SELECT count(*) FROM dw)::DOUBLE AS sn, (SELECT count(*) FROM tw)::DOUBLE AS tn),
gain AS (SELECT b, cast(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (sn + {BUCKETS}) / ((s + 1)::DOUBLE * (tn + {BUCKETS})))) AS BIGINT) AS g FROM s LEFT JOIN t USING (b), al),
per AS (SELECT doc_id, count(*) AS n, cast(sum(g) AS BIGINT) AS weight FROM db JOIN gain USING (b) GROUP BY doc_id),
sc AS (SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM documents d LEFT JOIN per p ON d.doc_id = p.doc_id),
rk AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM sc WHERE n_features >= 20)
SELECT sc.doc_id, n_features, weight, score, CASE WHEN r <= (SELECT count(*) * 10 // 100 FROM rk) THEN r END AS rank FROM sc LEFT JOIN rk ON sc.doc_id = rk.doc_id"""
