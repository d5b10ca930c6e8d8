"""Streaming semantics on small written feeds: watermark drops late rows,
append mode emits a day once the watermark passes its end, dedupe keeps one
copy, and the stateful running features continue across micro-batches."""

import datetime as dt

from pyspark.sql import functions as F

from aeroseries.streaming import stream as K

SCHEMA = "event_id long, site_id int, ts timestamp_ntz, metric string, value double"


def _rows(day, hour, eid, value=1.0):
    return (eid, 1, dt.datetime(2024, 1, day, hour), "temp", value)


def test_watermark_drops_late_rows(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    src = K.scratch_path(spark, "t-k2-src")
    # Late input is filtered with the watermark of the batch before last, so the
    # late day-2 row arrives two batches after the watermark passed day 2.
    batches = [[_rows(d, 12, d) for d in range(1, 6)],                # days 1-5
               [_rows(6, 12, 6)],                                    # day 6
               [_rows(2, 13, 100, 50.0), _rows(7, 12, 101)]]         # late day 2, day 7
    for b in batches:
        spark.createDataFrame(b, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    out = K.stream_daily_aggregate(K.file_stream(spark, src, SCHEMA, max_files=1))
    sink = K.scratch_path(spark, "t-k2-sink")
    K.run_to_sink(out, sink, K.scratch_path(spark, "t-k2-ckpt"))
    got = {r["day"]: (r["n"], r["mean_value"]) for r in spark.read.parquet(sink).collect()}
    assert got[dt.date(2024, 1, 2)] == (1, 1.0)          # the late day-2 row was dropped
    assert dt.date(2024, 1, 7) not in got                 # last day still open in append mode
    assert set(got) == {dt.date(2024, 1, d) for d in range(1, 7)}   # day 6 closed by day 7's watermark


def test_dedupe_keeps_one_copy(spark):
    src = K.scratch_path(spark, "t-k3-src")
    rows = [_rows(1, h, h) for h in range(5)]
    df = spark.createDataFrame(rows, SCHEMA)
    df.unionAll(df).coalesce(1).write.parquet(src)
    out = K.stream_dedupe(K.file_stream(spark, src, SCHEMA), keys=("event_id",))
    sink = K.scratch_path(spark, "t-k3-sink")
    K.run_to_sink(out, sink, K.scratch_path(spark, "t-k3-ckpt"))
    assert spark.read.parquet(sink).count() == 5


def test_running_state_continues_across_batches(spark):
    src = K.scratch_path(spark, "t-k4-src")
    schema = "site_id int, date date, TAVG double, PRCP double"
    days = [(1, dt.date(2020, 1, 1) + dt.timedelta(days=i), 10.0, 0.0 if i != 2 else 1.0) for i in range(6)]
    for chunk in (days[:3], days[3:]):                   # two micro-batches
        spark.createDataFrame(chunk, schema).coalesce(1).write.mode("append").parquet(src)
    out = K.stream_running_features(K.file_stream(spark, src, schema, max_files=1))
    sink = K.scratch_path(spark, "t-k4-sink")
    K.run_to_sink(out, sink, K.scratch_path(spark, "t-k4-ckpt"))
    got = spark.read.parquet(sink).orderBy("date").collect()
    assert [r["GDD_cumsum"] for r in got] == [5.0, 10.0, 15.0, 20.0, 25.0, 30.0]
    assert [r["Days_Since_Rain"] for r in got] == [0, 1, 0, 1, 2, 3]


def test_late_days_come_out_marked(spark):
    src = K.scratch_path(spark, "t-k4-late")
    schema = "site_id int, date date, TAVG double, PRCP double"
    day = lambda i: (1, dt.date(2020, 1, 1) + dt.timedelta(days=i), 10.0, 0.0)
    for chunk in ([day(0), day(2)], [day(1), day(3), day(3)]):
        spark.createDataFrame(chunk, schema).coalesce(1).write.mode("append").parquet(src)
    out = K.stream_running_features(K.file_stream(spark, src, schema, max_files=1))
    sink = K.scratch_path(spark, "t-k4-late-sink")
    K.run_to_sink(out, sink, K.scratch_path(spark, "t-k4-late-ckpt"))
    got = sorted((r["date"].day, r["is_late"], r["GDD_cumsum"]) for r in spark.read.parquet(sink).collect())
    assert [g[:2] for g in got] == [(1, False), (2, True), (3, False), (4, False), (4, True)]
    assert [g[2] for g in got if not g[1]] == [5.0, 10.0, 15.0]


def test_station_and_time_are_the_default_key(spark):
    src = K.scratch_path(spark, "t-k3-key")
    rows = [_rows(1, 1, 1), _rows(1, 1, 2), _rows(1, 2, 3)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(src)
    sink = K.scratch_path(spark, "t-k3-key-sink")
    K.run_to_sink(K.stream_dedupe(K.file_stream(spark, src, SCHEMA)), sink, K.scratch_path(spark, "t-k3-key-ckpt"))
    assert spark.read.parquet(sink).count() == 2


DAYS = "site_id int, date date, TAVG double, PRCP double"


def _days(spark, path, chunks):
    for i, chunk in enumerate(chunks):
        spark.createDataFrame(chunk, DAYS).coalesce(1).write.mode("append").parquet(path)


def test_days_in_any_order_come_out_in_order(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    first = dt.date(2020, 12, 1)
    rain = {3, 17, 40}
    day = lambda s, i: (s, first + dt.timedelta(days=i), None if i == 11 else 5.0 + s + i % 4, None if i == 20 else float(i in rain))
    order = [7, 2, 0, 5, 1, 3, 4, 6, 12, 9, 8, 11, 10, 13, 20, 16, 15, 17, 14, 19, 18, *range(21, 60)]
    chunks = [[day(s, i) for i in order[a:a + 7] for s in (1, 2)] for a in range(0, 60, 7)]
    chunks[4].append((1, first + dt.timedelta(days=order[30]), 99.0, 9.0))  # a held day again
    src, sink = K.scratch_path(spark, "t-k4o"), K.scratch_path(spark, "t-k4o-sink")
    _days(spark, src, chunks)
    q = K.stream_ordered_features(K.file_stream(spark, src, DAYS, max_files=1), "10 days")
    K.run_to_sink(q, sink, K.scratch_path(spark, "t-k4o-ckpt"), partitions=2)
    rows = spark.read.parquet(sink).collect()
    late = [(r["site_id"], r["date"]) for r in rows if r["is_late"]]
    assert late == [(1, first + dt.timedelta(days=order[30]))]
    for s in (1, 2):
        got = sorted((r["date"], r["GDD_cumsum"], r["Days_Since_Rain"]) for r in rows if r["site_id"] == s and not r["is_late"])
        want, gdd, since, year = [], 0.0, -1, None
        for i in range(49):  # the watermark is ten days behind the 60th day
            _, date, tavg, prcp = day(s, i)
            gdd = 0.0 if date.year != year else gdd
            year, gdd = date.year, gdd + (max(tavg - 5.0, 0.0) if tavg is not None else 0.0)
            since = 0 if prcp else since + 1
            want.append((date, gdd if tavg is not None else None, since))
        assert got == want


def test_open_days_are_current_and_merged_once(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    src, sink = K.scratch_path(spark, "t-k2u"), K.scratch_path(spark, "t-k2u-sink")
    batches = [[_rows(1, 1, 1, 2.0), _rows(2, 1, 2, 4.0)], [_rows(2, 5, 3, 8.0)], [_rows(3, 2, 4, 1.0), _rows(2, 9, 5, 0.0)]]
    for b in batches:
        spark.createDataFrame(b, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    K.stream_daily_current(K.file_stream(spark, src, SCHEMA, max_files=1), sink, K.scratch_path(spark, "t-k2u-ckpt"), delay="5 days", partitions=2)
    read = lambda: {r["day"].day: (r["mean_value"], r["n"]) for r in spark.read.parquet(sink).collect()}
    assert read() == {1: (2.0, 1), 2: (4.0, 3), 3: (1.0, 1)}
    again = spark.read.parquet(sink).where("day = date'2024-01-02'").select(F.col("day").cast("date"), "site_id", "metric", "mean_value", "n")
    K.merge_days(sink, ["day", "site_id", "metric"])(again, 99)
    assert read() == {1: (2.0, 1), 2: (4.0, 3), 3: (1.0, 1)}
