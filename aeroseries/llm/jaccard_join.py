"""N-gram Jaccard self-join through MinHash bands (operator 9).

Words are runs of ASCII letters and digits and all characters beyond ASCII,
with A-Z lower-cased; a document is the set of its five-word shingles (all its
words where they are fewer).  Documents with equal word sequences fold into one
node.  Fixed banding stands in for an LSH forest: of up to ``max_depth`` MinHash
values a tree, only the longest prefix is computed that finds the pairs at the
threshold with the target recall (``prefix_depth``, from the parameters alone),
and compared by its hash.  Nodes that share such a prefix in any
tree form groups, and inside a group every pair is verified exactly by its
shared shingles; groups beyond ``block`` nodes are verified in pairs of blocks.
No pair leaves its task: a node hands on its number of links and one edge.

Documents without words stand alone.  Repeated rows are copies of each other.
A null doc_id is kept; it counts as less than all others.  Other columns pass
through unread.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroseries.llm import kernels as K
from aeroseries.llm.components import components
from aeroseries.llm.repeats import KEY, NO_ID, boxed, keyed
from aeroseries.llm.store import write_table

K.ship_by_value(__name__)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = (np.arange(256) >= 128) | ((_LOWER >= 97) & (_LOWER <= 122)) | ((_LOWER >= 48) & (_LOWER <= 57))


def prefix_depth(trees: int, max_depth: int, threshold: float, recall: float) -> int:
    """The longest matched prefix that finds pairs at the threshold with the target recall."""
    depth = max_depth
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def shingles(buf: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(shingle hashes, each text's first, hash of each text's words, its number of words)."""
    buf = _LOWER[buf]
    start, end = K.runs(_WORD[buf], off)
    first = np.searchsorted(start, off)
    sums = K.prefix(K.word_units(buf, start, end))
    n = np.diff(first)
    whole = K.window_hash(sums, first[:-1], first[1:])
    owner, at = K.ragged(first[:-1], np.where(n >= size, n - size + 1, np.minimum(n, 1)))
    stop = np.minimum(at + size, first[1:][owner])
    return K.window_hash(sums, at, stop), np.searchsorted(owner, np.arange(n.size + 1)), whole, n


def signatures(size: int, trees: int, depth: int):
    """Tasks' work: (k, t, text) to (k, t, node, words, keys): each tree's matched prefix as one hash."""
    multiply = K.mix(np.arange(1, trees * depth + 1, dtype=K.U64)) | K.U64(1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, "text"):
                h, first, whole, n = shingles(*K.flat(part.column(2)), size)
                full = np.flatnonzero(n)
                keys = np.zeros((trees, n.size), K.U64)
                if full.size:
                    begin = first[:-1][full]
                    for tree in range(trees):
                        for d in range(depth):
                            least = np.minimum.reduceat(h * multiply[tree * depth + d], begin)
                            keys[tree, full] = keys[tree, full] * K.U64(K.BASE) + K.mix(least)
                    keys = K.mix(keys + K.mix(np.arange(trees, dtype=K.U64))[:, None])
                empty = n == 0
                columns = [pa.array(K.signed(row), mask=empty) for row in keys]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(K.signed(whole), mask=empty), pa.array(n), *columns], ["k", "t", "node", "words", *names(trees)])
    return work


def names(trees: int) -> list[str]:
    return [f"p{i}" for i in range(trees)]


def linked(h: np.ndarray, first: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of texts have a Jaccard similarity of ``threshold`` or more, by exact counts."""
    n = first.size - 1
    owner = np.repeat(np.arange(n), np.diff(first))
    order = np.lexsort((owner, h))
    h, owner = h[order], owner[order]
    fresh = np.ones(h.size, bool)
    fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[fresh], owner[fresh]
    size = np.bincount(owner, minlength=n)
    group = np.cumsum(np.concatenate([[0], h[1:] != h[:-1]]).astype(np.int64))
    shared = np.bincount(group)[group] > 1
    owner, group = owner[shared], np.unique(group[shared], return_inverse=True)[1]
    common = np.zeros((n, n), np.float32)
    width = max(256, (1 << 21) // max(n, 1))
    for lo in range(0, int(group[-1]) + 1 if group.size else 0, width):
        a, b = np.searchsorted(group, [lo, lo + width])
        table = np.zeros((n, int(group[b - 1]) - lo + 1), np.float32)
        table[owner[a:b], group[a:b] - lo] = 1
        common += table @ table.T
    # Whole counts below 2**24 are exact in float32; the comparison isn't.
    least = threshold / (1 + threshold) * (size[:, None] + size[None, :])
    return common.astype(np.float64) >= least * (1 - 1e-9)


def verifier(size: int, threshold: float):
    """Work on packed groups: rows (grp, i, j, side, node, copies, text) to (node, links, root)."""
    def work(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("grp", "ascending"), ("i", "ascending"), ("j", "ascending"), ("node", "ascending")]).combine_chunks()
        grp, i, j, side, node, copies = (rows.column(c).to_numpy() for c in ("grp", "i", "j", "side", "node", "copies"))
        text = rows.column("text").combine_chunks()
        text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
        same = (grp[1:] == grp[:-1]) & (i[1:] == i[:-1]) & (j[1:] == j[:-1])
        # A repeated row of documents stands here twice.
        keep = np.concatenate([[True], ~(same & (node[1:] == node[:-1]))])
        start = np.flatnonzero(np.concatenate([[True], ~same]))
        out = [[], [], []]
        for a, b in zip(start, np.append(start[1:], node.size)):
            use = np.flatnonzero(keep[a:b]) + a
            h, first, _, _ = shingles(*K.flat(text.take(pa.array(use))), size)
            pairs = linked(h, first, threshold)
            if i[a] != j[a]:
                pairs &= side[use][:, None] != side[use][None, :]
            np.fill_diagonal(pairs, False)
            links = pairs @ copies[use]
            np.fill_diagonal(pairs, True)
            root = np.arange(use.size)
            while True:
                least = np.where(pairs, root[None, :], use.size).min(axis=1)
                least = least[least]
                if np.array_equal(least, root):
                    break
                root = least
            for x, y in zip(out, (node[use], links, node[use][root])):
                x.append(y)
        return pa.table([np.concatenate(x) for x in out], names=["node", "links", "root"])
    return work


def near_duplicates(docs: DataFrame, size: int = 5, threshold: float = 0.8, trees: int = 20, max_depth: int = 8, recall: float = 0.999, block: int = 400) -> DataFrame:
    """One row per row of ``docs``: (doc_id, k, t, class_id, first, n_links, n_copies).

    class_id is the least doc_id among documents that links connect; ``first``
    is the (k, t) of that document; n_links counts the other documents whose
    similarity is ``threshold`` or more, n_copies those with equal words.
    """
    rows = keyed(docs)
    depth = prefix_depth(trees, max_depth, threshold, recall)
    p = names(trees)
    signed, _ = write_table(rows.select(*KEY, "text").mapInArrow(signatures(size, trees, depth), "k long, t long, node long, words long, " + ", ".join(f"{c} long" for c in p)), "signatures")
    nodes, _ = write_table(signed.where("node is not null").groupBy("node").agg(F.count("*").alias("copies"), F.min(F.struct(*KEY)).alias("rep"), *[F.min(c).alias(c) for c in p]), "nodes")
    members = nodes.select("node", F.explode(F.array(*p)).alias("p"))
    hubs = members.groupBy("p").agg(F.min("node").alias("hub"), F.count("*").alias("c")).where("c > 1").select("p", "hub")
    near = components(members.join(hubs, "p").select(F.col("node").alias("a"), F.col("hub").alias("b")))
    near, _ = write_table(near.select("node", F.col("root").alias("grp")), "near")
    groups = near.groupBy("grp").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks"))
    packs = math.ceil((near.count() + 1) / block)
    placed = near.join(groups, "grp").withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    placed = placed.select("node", "grp", "side", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"), "blocks")
    placed = placed.select("node", "grp", "side", F.least("side", "o").alias("i"), F.greatest("side", "o").alias("j"), "blocks")
    pack = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("grp"), F.lit(packs))).otherwise(F.xxhash64("grp", "i", "j"))
    wanted = placed.withColumn("pack", pack).join(nodes.select("node", "copies", F.col("rep.k").alias("k"), F.col("rep.t").alias("t")), "node")
    texts = rows.join(wanted, KEY).select("pack", "grp", "i", "j", "side", "node", "copies", "text")
    verified, _ = write_table(texts.groupBy("pack").applyInArrow(verifier(size, threshold), "node long, links long, root long"), "verified")
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(verified.select(F.col("node").alias("a"), F.col("root").alias("b")))
    reps = nodes.select("node", "rep", "copies")
    own = reps.join(links, "node", "left").join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = own.groupBy("root").agg(F.min("rep").alias("first"))
    verdict = own.join(first, "root").select("node", "first", "copies", F.coalesce("links", F.lit(0)).alias("links"))
    found = signed.select(*KEY, "node").join(verdict, "node", "left")
    alone = F.struct(*KEY)
    return found.select(
        F.when(F.col("k") != NO_ID, F.col("k")).alias("doc_id"), *KEY,
        F.when(F.coalesce("first", alone)["k"] != NO_ID, F.coalesce("first", alone)["k"]).alias("class_id"), F.coalesce("first", alone).alias("first"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"), (F.coalesce("copies", F.lit(1)) - 1).alias("n_copies"),
    )


def keep_first(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each class, all their columns."""
    kept = near_duplicates(docs, **parameters).where("k = first.k and t = first.t").select(*KEY).distinct()
    # Repeated rows share a key; one of them stays.
    return boxed(docs).join(kept, KEY, "left_semi").groupBy(*KEY).agg(F.first("row").alias("row")).select("row.*")
