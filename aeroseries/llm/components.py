"""Connected components of an edge table, by alternating large and small stars.

Each round hangs every node's greater (then smaller) neighbours on the least
node around it (Kiveris et al., "Connected Components in MapReduce and
Beyond"); a fixed point is one star a component.  Rounds are partially
aggregated minima and joins whose large side Spark may split, each written to
the shared folder; no component is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroseries.llm.store import release, remove, write_table


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b); root is the component's least node.

    Edges with a null or with equal ends add nothing.  An empty table gives an
    empty result.
    """
    spark = edges.sparkSession
    table, path = write_table(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _state(table)
    while before[0]:
        both = table.unionByName(table.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        small = small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
        new, new_path = write_table(small, "edges")
        remove(spark, path)
        release(spark)
        table, path = new, new_path
        now = _state(table)
        if now == before:
            break
        before = now
    roots = table.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return table.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
