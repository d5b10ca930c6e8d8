"""Readers and writers.

Readers take explicit schemas (no inference pass over the data) and fail early
when the path does not exist (a metadata call on the driver).  Writers cluster
rows by site and sort by date inside each file, so downstream per-site windows
read pre-grouped data and parquet min/max statistics prune by date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroseries.functions.scalars import first_truthy

WEATHER_SCHEMA = T.StructType(
    [T.StructField("STATION", T.StringType()), T.StructField("NAME", T.StringType()),
     T.StructField("DATE", T.DateType())]
    + [T.StructField(c, T.DoubleType()) for c in ("TMAX", "TMIN", "TAVG", "PRCP", "AWND", "WSF2", "WSF5")])
POLLEN_SCHEMA = T.StructType(
    [T.StructField("Date_Standard", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in ("Total_Pollen", "Tree", "Grass", "Weed", "Ragweed")])


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def _reader(spark, path, fmt, schema):
    if not _exists(spark, path):
        raise FileNotFoundError(path)
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", True).schema(schema)
    return r.load(path)


# A1 ---------------------------------------------------------------------------
def read_station_weather(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return _reader(spark, path, fmt, WEATHER_SCHEMA)


# A2 ---------------------------------------------------------------------------
def read_pollen(spark: SparkSession, path: str, fmt: str = "csv", date_format: str | None = None,
                with_site: bool = False) -> DataFrame:
    """Daily pollen counts; ``Date_Standard`` parsed to ``date``.  Multi-site
    files carry a leading ``site_id`` column (``with_site``)."""
    schema = (T.StructType([T.StructField("site_id", T.IntegerType())] + POLLEN_SCHEMA.fields)
              if with_site else POLLEN_SCHEMA)
    df = _reader(spark, path, fmt, schema)
    d = F.col("Date_Standard")
    return df.withColumn("date", F.to_date(d, date_format) if date_format else F.to_date(d)).drop("Date_Standard")


# A3 ---------------------------------------------------------------------------
def read_joined(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    df = _reader(spark, path, fmt, None)
    return df.withColumn("date", F.to_date("date"))


def date_range(df: DataFrame, date_col: str = "date", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"),
                               F.count(F.lit(1)).alias("rows"))


# A5 ---------------------------------------------------------------------------
def write_daily(df: DataFrame, path: str, fmt: str = "parquet", site: Sequence[str] = ("site_id",),
                date_col: str = "date", partition_cols: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Cluster by site, sort by date within each file, write (optionally
    partitioned into folders, e.g. by year).  Range partitioning on
    (site, date) splits a hot site into date ranges across tasks instead of
    sending all its rows to one writer."""
    out = (df.repartitionByRange(*site, date_col) if site else df).sortWithinPartitions(*site, date_col)
    w = out.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.save(path)


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, site: str = "site_id", date_col: str = "date") -> DataFrame:
    """Store daily rows as a table of ``buckets`` buckets by site, sorted by date,
    and read it.  Windows by site, and joins of tables with as many buckets, then
    need no exchange.  Rows go to their bucket's task first, so a bucket is one
    file.  One row a calendar day bounds a site's rows; choose the buckets from
    the number of sites.

    Spark matches a join's keys exactly unless
    ``spark.sql.requireAllClusterKeysForCoPartition`` is false; set that to join
    bucketed tables by site and date.
    """
    spark = df.sparkSession
    (df.repartition(buckets, site).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, site).sortBy(site, date_col).saveAsTable(table))
    return spark.table(table)


# A9 ---------------------------------------------------------------------------
def reconcile(source: DataFrame, target: DataFrame, date_col: str = "DATE", station_col: str = "STATION",
              variables: Sequence[str] = ("TMAX", "TMIN", "PRCP", "AWND")) -> DataFrame:
    """After a write: rows, stations, first / last day (as days since epoch)
    and completeness per variable on both sides; one row per check."""
    def stats(df, tag):
        aggs = [F.count(F.lit(1)).cast("double").alias("rows"),
                F.countDistinct(station_col).cast("double").alias("stations"),
                F.min(F.unix_date(date_col)).cast("double").alias("first_day"),
                F.max(F.unix_date(date_col)).cast("double").alias("last_day")]
        aggs += [(F.count(v) * 100.0 / F.count(F.lit(1))).alias(f"pct_{v}") for v in variables]
        g = df.agg(*aggs)
        names = ["rows", "stations", "first_day", "last_day"] + [f"pct_{v}" for v in variables]
        return g.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias(tag))
                                          for n in names])))
    s, t = stats(source, "source_value"), stats(target, "target_value")
    return s.join(t, "check").withColumn("ok", F.col("source_value") == F.col("target_value"))


# A7 ---------------------------------------------------------------------------
def write_metric_documents(metrics: DataFrame, path: str, style_col: str = "style",
                           model_col: str = "model") -> None:
    """One JSON document per model.  ``style`` picks the key names a training
    script writes: 'plain' (mae, rmse, r2, acc_within_1) or 'test' (test_mae,
    test_rmse, test_r2)."""
    plain = F.col(style_col) == "plain"
    doc = metrics.select(
        F.col(model_col).alias("doc"),
        F.when(plain, F.col("mae")).alias("mae"), F.when(plain, F.col("rmse")).alias("rmse"),
        F.when(plain, F.col("r2")).alias("r2"), F.when(plain, F.col("acc_within_1")).alias("acc_within_1"),
        F.when(~plain, F.col("mae")).alias("test_mae"), F.when(~plain, F.col("rmse")).alias("test_rmse"),
        F.when(~plain, F.col("r2")).alias("test_r2"), F.col("n").alias("n_test"),
        F.current_timestamp().cast("string").alias("written_at"))
    doc.repartition("doc").write.mode("overwrite").partitionBy("doc").json(path)


def write_metrics(metrics: DataFrame, path: str, id_cols: Sequence[str] = ("model",)) -> DataFrame:
    """Tidy metric records (ids..., metric, value) written as JSON lines."""
    vals = [c for c, t in metrics.dtypes if c not in id_cols and t in ("double", "bigint", "int")]
    tidy = metrics.select(*id_cols, *[F.col(c).cast("double").alias(c) for c in vals]).unpivot(
        list(id_cols), vals, "metric", "value")
    tidy.write.mode("overwrite").json(path)
    return tidy


# A6 ---------------------------------------------------------------------------
METRIC_ALIASES = {
    "mae": ["mae", "test_mae", "MAE"],
    "rmse": ["rmse", "test_rmse", "RMSE"],
    "r2": ["r2", "test_r2", "R2"],
    "acc_within_1": ["acc_within_1", "accuracy_within_1"],
    "acc_within_2": ["acc_within_2", "accuracy_within_2"],
    "train_time": ["train_time", "training_time"],
    "feature_count": ["feature_count", "n_features"],
    "high_mae": ["high_mae", "high_severity_mae"],
}


#: Metrics that every reading of documents has, null where no document holds them: a JSON writer leaves nulls out.
METRICS = ("mae", "rmse", "r2", "acc_within_1", "acc_within_2")


def _metric_columns(have: set[str]) -> list:
    """One column a metric: the first truthy of its aliases among the columns ``have``."""
    cols = []
    for out, aliases in METRIC_ALIASES.items():
        present = [F.col(a).cast("double") for a in aliases if a in have]
        if present:
            cols.append(first_truthy(*present).alias(out))
        elif out in METRICS:
            cols.append(F.lit(None).cast("double").alias(out))
    return cols


def read_metrics(spark: SparkSession, path: str, names: dict[str, str] | None = None) -> DataFrame:
    """Read metric documents (multi-line JSON allowed), name each by its file
    or folder, take the first truthy alias of every metric (0 counts as
    missing) and drop documents without MAE or R2, also where no document has
    one of them."""
    raw = spark.read.option("multiLine", True).json(path)
    have = set(raw.columns)
    if "doc" in have:
        name = F.col("doc")
    else:
        name = F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1)
    if names:
        m = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])
        name = F.coalesce(F.element_at(m, name), name)
    norm = raw.select(name.alias("model"), *_metric_columns(have))
    return norm.filter(F.col("mae").isNotNull() & F.col("r2").isNotNull())


def write_multitype_metrics(metrics: DataFrame, path: str, type_col: str = "pollen_type") -> None:
    """One document {type: {metrics}} as the multi-type training script writes it; one row a type comes in."""
    names = [c for c in metrics.columns if c != type_col]
    types = sorted(r[type_col] for r in metrics.select(type_col).distinct().collect())
    doc = metrics.agg(*[F.max(F.when(F.col(type_col) == t, F.struct(*names))).alias(t) for t in types])
    doc.coalesce(1).write.mode("overwrite").json(path)


def read_multitype_metrics(spark: SparkSession, path: str, model: str,
                           pollen_type: str = "Total_Pollen") -> DataFrame:
    """A per-type metrics document ({type: {metrics}}): only ``pollen_type``
    is comparable with single-target models."""
    raw = spark.read.option("multiLine", True).json(path)
    if pollen_type not in raw.columns:
        return spark.createDataFrame([], "model string, " + ", ".join(f"{c} double" for c in METRICS))
    inner = raw.select(F.col(f"{pollen_type}.*"))
    have = set(inner.columns)
    return inner.select(F.lit(model).alias("model"), *_metric_columns(have)).filter(F.col("mae").isNotNull() & F.col("r2").isNotNull())


# A8 ---------------------------------------------------------------------------
def save_model(model: PipelineModel, features: Sequence[str], path: str) -> None:
    model.write().overwrite().save(path)
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(i, f) for i, f in enumerate(features)], "pos int, feature string") \
        .coalesce(1).write.mode("overwrite").json(path.rstrip("/") + "_features")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, list[str]]:
    model = PipelineModel.load(path)
    rows = spark.read.json(path.rstrip("/") + "_features").orderBy("pos").collect()
    return model, [r["feature"] for r in rows]
