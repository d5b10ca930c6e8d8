"""Quality rules: hashed n-gram log-likelihood ratio (operator 1, native).

Word unigrams and bigrams are hashed into a fixed number of buckets.  Two
multinomials are counted over the buckets: the raw corpus (every document) and
a trusted target (labelled documents).  A document's score is the mean, over
its n-grams, of log(target / raw); documents under a fixed threshold go.  The
log ratios are whole micro-nats, so sums and verdicts never depend on the order
of addition.

Everything is a Spark expression: the counting pass is one generated pipeline
(split, explode, hash, partial count), whose shuffle holds at most ``buckets``
rows a task; the scoring pass needs no shuffle at all.

Defined results: a null text has no words; a text without n-grams scores 0 and
falls under the base rules; without trusted documents every weight is 0;
repeated rows are scored one by one; other columns pass through unread.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
MICRO = 1_000_000


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; none of a null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _upto(n: Column) -> Column:
    """0 .. n-1; empty for n < 1."""
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def repeat_words(words: Column, size: int = 8) -> Column:
    """Words inside ``size``-word windows that occur twice or more in the text.

    Windows are 64-bit hashes; the positions of repeated ones are sorted, and
    each adds the words that its follower doesn't cover.
    """
    n = F.size(words)
    hashes = F.transform(_upto(n - (size - 1)), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))

    def covered(sorted_pairs: Column) -> Column:
        at = lambda j: F.get(sorted_pairs, j)
        twins = F.filter(_upto(F.size(sorted_pairs)), lambda j: F.coalesce(at(j)["h"] == at(j - 1)["h"], F.lit(False)) | F.coalesce(at(j)["h"] == at(j + 1)["h"], F.lit(False)))
        places = F.sort_array(F.transform(twins, lambda j: at(j)["i"]))
        return _let(places, lambda p: F.aggregate(_upto(F.size(p)), F.lit(0).cast("long"), lambda acc, k: acc + F.least(F.lit(size), F.coalesce(F.get(p, k + 1) - F.get(p, k), F.lit(size)))))

    found = _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(_let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), covered)))
    return F.when(n <= size, F.lit(0).cast("long")).otherwise(found)


def base_columns(text: Column, words: Column) -> dict[str, Column]:
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")).cast("long"),
        "n_symbols": F.coalesce(F.regexp_count(text, F.lit(r"[#*$%&|<>]")), F.lit(0)).cast("long"),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeat_words(words),
    }


def _gram(words: Column, n: Column, j: Column, buckets: int) -> Column:
    """Bucket of n-gram j: unigrams for j < n, then bigrams."""
    one = F.xxhash64(F.get(words, j))
    two = F.xxhash64(F.get(words, j - n), F.get(words, j - n + 1))
    return F.pmod(F.when(j < n, one).otherwise(two), F.lit(buckets))


def gram_counts(docs: DataFrame, trusted: DataFrame, buckets: int = 10_000, max_trusted: int = 20_000) -> DataFrame:
    """(bucket, raw, target): n-gram counts over all documents and over the trusted ones.

    ``trusted`` holds the ``doc_id`` of trusted documents; at most
    ``max_trusted`` of them, the first by hash, fit the target, and so their ids
    may be broadcast.
    """
    ids = trusted.select(F.col("doc_id").alias("_id")).where("_id is not null").distinct().orderBy(F.xxhash64("_id"), "_id").limit(max_trusted)
    marked = docs.select("doc_id", words_of(F.col("text")).alias("w")).join(F.broadcast(ids.withColumn("_t", F.lit(1))), F.col("doc_id") == F.col("_id"), "left")
    marked = marked.select("w", F.size("w").alias("n"), F.coalesce("_t", F.lit(0)).alias("t"))
    grams = marked.select("w", "n", "t", F.explode(_upto(2 * F.col("n") - 1)).alias("j"))
    return grams.groupBy(_gram(F.col("w"), F.col("n"), F.col("j"), buckets).alias("bucket")).agg(F.count("*").alias("raw"), F.sum("t").alias("target"))


def gram_weights(docs: DataFrame, trusted: DataFrame, buckets: int = 10_000, max_trusted: int = 20_000, prior: float = 100_000.0) -> list[int]:
    """log(target / raw) of every bucket in micro-nats: ``buckets`` numbers, whatever the corpus.

    The target is smoothed towards the raw corpus by ``prior`` n-grams, so a
    few trusted documents move the weights little.
    """
    counted = {r["bucket"]: (r["raw"], r["target"]) for r in gram_counts(docs, trusted, buckets, max_trusted).collect()}
    raw_all, target_all = (sum(x[k] for x in counted.values()) for k in (0, 1))
    if not target_all:
        return [0] * buckets

    def ratio(b: int) -> int:
        raw, target = counted.get(b, (0, 0))
        q = (raw + 1) / (raw_all + buckets)
        p = (target + prior * q) / (target_all + prior)
        return round(MICRO * math.log(p / q))

    return [ratio(b) for b in range(buckets)]


def quality_rules(docs: DataFrame, trusted: DataFrame, threshold: float = -0.1, min_words: int = 20, max_repeat_pct: int = 30, buckets: int = 10_000, max_trusted: int = 20_000) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its base figures, its score and its verdict.

    ``score`` is the mean log ratio in nats; ``kept`` is false where the base
    rules fail or the score is under ``threshold``.
    """
    weights = gram_weights(docs, trusted, buckets, max_trusted)
    # A text that constant folding turns into one array; its length is `buckets`.
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<bigint>")
    rows = docs.select("doc_id", "text", words_of(F.col("text")).alias("_w"))
    w, n = F.col("_w"), F.size("_w")
    total = F.aggregate(_upto(2 * n - 1), F.lit(0).cast("long"), lambda acc, j: acc + F.get(table, _gram(w, n, j, buckets).cast("int")))
    rows = rows.select("doc_id", *[c.alias(k) for k, c in base_columns(F.col("text"), w).items()], total.alias("_total"), F.greatest(2 * n - 1, F.lit(0)).cast("long").alias("n_grams"))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    passed = F.col("_total") >= F.lit(round(threshold * MICRO)) * F.col("n_grams")
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & passed).alias("kept"),
        F.when(F.col("n_grams") > 0, F.col("_total") / F.col("n_grams") / MICRO).otherwise(F.lit(0.0)).alias("score"),
    )
