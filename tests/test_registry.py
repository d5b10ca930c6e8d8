"""The model registry: publication, resolution by what is there, reload."""

import pytest
from pyspark.sql import functions as F

from aeroseries.operators import models as ML
from aeroseries.operators import score as J
from aeroseries.operators.boosting import BoostedModel, Tree
from aeroseries.session import drop_tables
from aeroseries.sources import fixtures as FX
from aeroseries.sources.registry import TOTAL, Registry
from aeroseries.streaming import stream as K
from data_paths import SF0001


def constant(value):
    return BoostedModel(["TMAX"], [[]], value, [Tree()])


@pytest.fixture()
def registry(spark):
    return Registry(spark, K.scratch_path(spark, "t-registry"))


def served(registry):
    return {t: (m.name, m.version) for t, m in registry.load().items()}


def test_empty_registry_resolves_nothing(spark, registry):
    assert registry.entries().count() == registry.resolve().count() == 0 and registry.load() == {}
    with pytest.raises(LookupError):
        J.score_daily_resolved(FX.requests(spark, SF0001), registry)
    with pytest.raises(ValueError):
        registry.publish("Tree", "guess", constant(1.0), ["TMAX"])


def test_versions_priority_and_fall_back(spark, registry):
    assert registry.publish("Tree", "multi_type", constant(1.0), ["TMAX"]) == 1
    assert registry.publish("Tree", "multi_type", constant(2.0), ["TMAX"]) == 2
    assert registry.publish("Tree", "random_forest", constant(9.0), ["TMAX"]) == 1
    assert registry.publish(TOTAL, "random_forest", constant(3.0), ["TMAX"]) == 1
    assert served(registry) == {"Tree": ("multi_type", 2), TOTAL: ("random_forest", 1)}
    kept = registry.load()["Tree"].model
    assert registry.load()["Tree"].model is kept and kept.base == 2.0
    registry.publish("Tree", "weather_only", constant(4.0), ["TMAX"])
    assert served(registry)["Tree"] == ("weather_only", 1)
    drop_tables(spark, registry.load()["Tree"].path)
    assert served(registry)["Tree"] == ("multi_type", 2)
    drop_tables(spark, registry.load()["Tree"].path)
    assert served(registry)["Tree"] == ("multi_type", 1) and registry.load()["Tree"].model.base == 1.0
    drop_tables(spark, registry.load()["Tree"].path)
    assert "Tree" not in served(registry)  # a forest may serve the total alone


def test_a_taken_version_is_not_replaced(spark, registry, monkeypatch):
    registry.publish("Grass", "multi_type", constant(1.0), ["TMAX"])
    with monkeypatch.context() as m:
        m.setattr(Registry, "_manifest", lambda self: [])  # a writer that read the manifest before the other's move
        assert registry.publish("Grass", "multi_type", constant(2.0), ["TMAX"]) == 2
    assert registry.load()["Grass"].version == 2 and registry.load()["Grass"].model.base == 2.0


def test_pipelines_and_trees_reload_equal(spark, registry):
    rows = spark.createDataFrame([(i, float(i % 7), float(i % 5)) for i in range(60)], "id long, TMAX double, y double")
    for kind, model in (("weather_only", ML.train_all_types(rows, ["TMAX"], ["y"], "refined", None, None, ["id"], rounds=3)["y"]), ("multi_type", ML.fit(rows, ["TMAX"], "y", "small_rf", numTrees=2, maxDepth=2))):
        registry.publish("Weed", kind, model, ["TMAX"])
        m = registry.load()["Weed"]
        both = model.transform(rows).select("id", "TMAX", F.col("prediction").alias("before"))
        assert m.features == ("TMAX",) and m.transform(both).where("before <> prediction").count() == 0
        drop_tables(spark, m.path)


def test_allergens_fall_back_to_the_season(spark, registry):
    requests = FX.requests(spark, SF0001)
    registry.publish(TOTAL, "multi_type", constant(4.0), ["TMAX"])
    season = J.score_allergens_resolved(requests, registry)
    assert {r["model"] for r in season.select("model").distinct().collect()} == {"season"}
    registry.publish("Grass", "multi_type", constant(1.5), ["TMAX"])
    own = J.score_allergens_resolved(requests, registry).select("allergen_type", "score", "model", "version").distinct().collect()
    assert [tuple(r) for r in own] == [("Grass", 1.5, "multi_type", 1)]


def test_a_batch_run_again_adds_nothing(spark, registry):
    registry.publish(TOTAL, "multi_type", constant(4.0), ["TMAX"])
    requests, sink = FX.requests(spark, SF0001), K.scratch_path(spark, "t-k1-sink")
    for batch in (0, 1, 1, 0):
        K.score_batch(registry, sink)(requests.where(F.pmod("request_id", F.lit(2)) == batch), batch)
    got = spark.read.parquet(sink)
    assert got.count() == requests.count() == got.select("request_id", "pos").distinct().count()
