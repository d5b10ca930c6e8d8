"""Structured Streaming operators (K1-K4).

Sources are file streams (parquet folders) so they can be replayed from the
shared storage; every query keeps its progress in a checkpoint location under
``spark.checkpoint.dir`` and writes to a parquet sink, so a restarted driver or
a lost executor resumes from the last committed micro-batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from pyspark import cloudpickle

from aeroseries.operators.score import score_daily, score_daily_resolved
from aeroseries.session import drop_tables, ensure_checkpoint_dir, scratch_table
from aeroseries.streaming import state_fn
from aeroseries.streaming.state_fn import OrderedDays, running_update

# The state function is the only Python that runs inside tasks.  It is pickled
# by value, so executors need numpy / pandas only, not this package installed.
cloudpickle.register_pickle_by_value(state_fn)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/aeroseries-{name}-{uuid.uuid4().hex[:12]}"


def file_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def state_partitions(spark: SparkSession) -> int:
    """A state-partition count from the cluster's parallelism (2 x cores)."""
    return max(2, 2 * spark.sparkContext.defaultParallelism)


def run_to_sink(df: DataFrame, sink: str, checkpoint: str, mode: str = "append",
                partitions: int | None = None) -> StreamingQuery:
    """Process everything available, write parquet, stop (``availableNow``).

    Stateful operators fix their partition count from
    ``spark.sql.shuffle.partitions`` when the query first starts (it is kept
    in the checkpoint; AQE cannot coalesce stateful stages).  ``partitions``
    sets it for this query only: the stream clones the session conf at start,
    and the session's own value is restored right after."""
    w = df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
    return _run(df, w.trigger(availableNow=True), partitions, sink)


def _run(df: DataFrame, writer, partitions: int | None, *where: str) -> StreamingQuery:
    """Start with settings of this query's own, restore the session's, and wait for the end."""
    spark = df.sparkSession
    own = {ROCKS: ROCKS_PROVIDER}
    if partitions:
        own["spark.sql.shuffle.partitions"] = str(partitions)
    old = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        q = writer.start(*where)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    q.awaitTermination()
    return q


#: State on the executors' disks instead of their heaps; timers need it.
ROCKS = "spark.sql.streaming.stateStore.providerClass"
ROCKS_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def _replace_partitions(df: DataFrame, sink: str, column: str) -> None:
    """Write ``df``; the partitions that it has replace their old ones, each by one move."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(sink)


# K1 ---------------------------------------------------------------------------
def stream_score(requests: DataFrame, model, feature_names: Sequence[str] | None = None) -> DataFrame:
    """Stateless scoring of arriving requests: the batch J1 function applied to
    a streaming frame (features need only the row and its arrays)."""
    return score_daily(requests, model, feature_names)


def stream_score_resolved(requests: DataFrame, registry, sink: str, checkpoint: str) -> StreamingQuery:
    """Score arriving requests by the model that the registry resolves when
    their micro-batch starts, so a model published meanwhile serves from the
    next batch on.  Rows land in the partition of their batch; a batch that is
    run again finds its partition and adds nothing."""
    w = requests.writeStream.foreachBatch(score_batch(registry, sink)).option("checkpointLocation", checkpoint)
    return _run(requests, w.trigger(availableNow=True), None)


def score_batch(registry, sink: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        if not _path_exists(batch.sparkSession, f"{sink}/batch={batch_id}"):
            _replace_partitions(score_daily_resolved(batch, registry).withColumn("batch", F.lit(batch_id)), sink, "batch")
    return write


# K2 ---------------------------------------------------------------------------
def stream_daily_aggregate(readings: DataFrame, delay: str = "1 hour", ts: str = "ts",
                           by: Sequence[str] = ("site_id", "metric"), value: str = "value") -> DataFrame:
    """Daily mean and count per site and metric with an event-time watermark.
    In append mode a day is emitted once the watermark passes its end.  Rows
    within ``delay`` of the newest event are always kept; rows older than the
    watermark are dropped (Spark checks input against the watermark of the
    previous micro-batch, so a late row can still join a day that is not yet
    emitted)."""
    s = readings.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    g = s.groupBy(F.window(ts, "1 day"), *by).agg(F.avg(value).alias("mean_value"),
                                                  F.count(F.lit(1)).alias("n"))
    return g.select(F.to_date(F.col("window.start")).alias("day"), *by, "mean_value", "n")


def stream_daily_current(readings: DataFrame, sink: str, checkpoint: str, delay: str = "1 hour", ts: str = "ts",
                         by: Sequence[str] = ("site_id", "metric"), value: str = "value",
                         partitions: int | None = None) -> StreamingQuery:
    """Like ``stream_daily_aggregate``, but open days are there as well, as of
    the last micro-batch: updated rows replace their old ones in the day's
    partition.  A row is the whole aggregate of its key, so running a batch
    again changes nothing."""
    agg = stream_daily_aggregate(readings, delay, ts, by, value)
    w = agg.writeStream.outputMode("update").foreachBatch(merge_days(sink, ["day", *by])).option("checkpointLocation", checkpoint)
    return _run(readings, w.trigger(availableNow=True), partitions)


def merge_days(sink: str, keys: Sequence[str]):
    """Merge rows into ``sink`` by ``keys``; reads and rewrites the days of the batch only."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new, new_path = scratch_table(batch, "new-days")
        # One value a calendar day of the batch.
        days = [r["day"] for r in new.select("day").distinct().collect()]
        if days:
            merged, merged_path = new, None
            if _path_exists(spark, sink):
                old = spark.read.schema(new.schema).parquet(sink).where(F.col("day").isin(days))
                kept = old.join(new.select(*keys), list(keys), "left_anti").select(*new.columns)
                # Partitions can't be replaced while they are read.
                merged, merged_path = scratch_table(kept.unionByName(new), "merged-days")
            _replace_partitions(merged.repartition("day", F.pmod(F.xxhash64(*keys), F.lit(8))), sink, "day")
            if merged_path:
                drop_tables(spark, merged_path)
        drop_tables(spark, new_path)
    return merge


# K3 ---------------------------------------------------------------------------
def stream_dedupe(readings: DataFrame, keys: Sequence[str] = ("site_id", "ts"), delay: str = "1 hour",
                  ts: str = "ts") -> DataFrame:
    """Each (station, time) once, or each combination of ``keys``: duplicates
    within the watermark delay are dropped."""
    s = readings.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return s.dropDuplicatesWithinWatermark(list(keys)).withColumn(ts, F.col(ts).cast("timestamp_ntz"))


# K4 ---------------------------------------------------------------------------
RUNNING_OUT = "site_id int, date date, GDD_cumsum double, Days_Since_Rain int, is_late boolean"
RUNNING_STATE = "year int, gdd_cum double, since_rain int, last_day int"


def stream_running_features(days: DataFrame, by: str = "site_id") -> DataFrame:
    """Yearly running GDD (base 5) and rows since the last rain, carried per
    site in state across micro-batches.  The days of one micro-batch are sorted
    (a site's days of one trigger are in memory together: bound them with
    ``maxFilesPerTrigger``); a day at or before the site's last one comes out
    with ``is_late`` and without values, and changes no state."""
    return days.groupBy(by).applyInPandasWithState(
        running_update, RUNNING_OUT, RUNNING_STATE, "append", GroupStateTimeout.NoTimeout)


def stream_ordered_features(days: DataFrame, delay: str = "7 days", by: str = "site_id") -> DataFrame:
    """The same features for days that arrive in any order: each is held until
    the watermark, ``delay`` behind the newest day of all sites, has passed its
    end, and then computed in calendar order (``state_fn.OrderedDays``).  State
    is a site's days of the last ``delay``.  Rows behind the watermark are
    dropped by Spark; days held at the end of the stream come with the next
    ones."""
    timed = days.select(by, "date", "TAVG", "PRCP", F.to_timestamp("date").alias("__at")).withWatermark("__at", delay)
    return timed.groupBy(by).transformWithStateInPandas(OrderedDays(), RUNNING_OUT, "Append", "EventTime")
