"""Reader / writer helpers on small written files."""

import json

from pyspark.sql import functions as F

from aeroseries.operators.metrics import metrics_full
from aeroseries.sources import io as IO

COLUMNS = ["model", "mae", "rmse", "r2", "acc_within_1"]


def test_read_metrics_aliases_and_multitype(spark, tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "forest.json").write_text(json.dumps({"test_mae": 0.715, "test_rmse": 0.98, "test_r2": 0.861}, indent=2))
    (docs / "boosted.json").write_text(json.dumps({"mae": 0.689, "rmse": 0.969, "r2": 0.864,
                                                   "acc_within_1": 0.756}, indent=2))
    (docs / "zero.json").write_text(json.dumps({"mae": 0.0, "r2": 0.5}, indent=2))
    names = {"forest": "Forest A", "boosted": "Boosted A"}
    got = {r["model"]: r for r in IO.read_metrics(spark, str(docs), names).collect()}
    assert set(got) == {"Forest A", "Boosted A"}   # zero MAE counts as missing
    assert got["Forest A"]["mae"] == 0.715
    assert got["Boosted A"]["acc_within_1"] == 0.756

    multi = tmp_path / "multi.json"
    multi.write_text(json.dumps({"Total_Pollen": {"mae": 0.517, "r2": 0.879}, "Tree": {"mae": 0.3, "r2": 0.9}}))
    r = IO.read_multitype_metrics(spark, str(multi), "Boosted per type (total)").collect()
    assert len(r) == 1 and r[0]["mae"] == 0.517


def test_missing_path_fails(spark, tmp_path):
    try:
        IO.read_station_weather(spark, str(tmp_path / "absent.csv"))
    except FileNotFoundError:
        return
    raise AssertionError("expected FileNotFoundError")


def test_documents_without_r2_read_as_none(spark, tmp_path):
    """Where every actual value is the same no model has an R2, and the writer leaves nulls out."""
    rows = spark.createDataFrame([(m, 10.0, 9.0 + i) for m in ("Rolling Mean 3", "Persistence Lag 1") for i in range(3)], "model string, actual double, predicted double")
    path = str(tmp_path / "constant")
    IO.write_metric_documents(metrics_full(rows, by=("model",)).withColumn("style", F.when(F.col("model").startswith("Rolling"), "plain").otherwise("test")), path)
    read = IO.read_metrics(spark, path).select(*COLUMNS)
    assert read.collect() == [] and dict(read.dtypes)["r2"] == "double"


def test_types_without_r2_read_as_none(spark, tmp_path):
    """A type whose actual values are all the same has no R2; one without any pair of values has no document."""
    rows = [("Tree", 1.0 + i, 2.5) for i in range(3)] + [("Total_Pollen", 10.0, 9.0 + i) for i in range(3)]
    for name, kept in (("constant", rows), ("absent", rows[:3])):
        frame = spark.createDataFrame(kept, "pollen_type string, actual double, predicted double")
        path = str(tmp_path / name)
        IO.write_multitype_metrics(metrics_full(frame, by=("pollen_type",)), path)
        assert IO.read_multitype_metrics(spark, path, "Multi-type").select(*COLUMNS, "acc_within_2").collect() == []
    tree = IO.read_multitype_metrics(spark, path, "Multi-type", "Tree").select(*COLUMNS).collect()
    assert [r["model"] for r in tree] == ["Multi-type"] and tree[0]["r2"] is not None
