"""Plan discipline: every feature set shares one site exchange for all of its
windows, and no batch plan evaluates Python."""

import re

import pytest

from aeroseries.operators import features as H
from aeroseries.sources import fixtures as FX
from data_paths import SF0001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(H.FEATURE_SETS))
def test_one_site_exchange_per_feature_set(spark, name):
    plan = _plan(H.build(FX.joined(spark, SF0001), name))
    site_only = re.findall(r"Exchange hashpartitioning\(site_id#\d+, \d+\)", plan)
    assert len(site_only) == 1, plan
    assert not re.search(r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas", plan)


def test_scan_is_pruned(spark):
    plan = _plan(H.build(FX.joined(spark, SF0001), "abiotic"))
    lineitem = [ln for ln in plan.splitlines() if "lineitem.parquet" in ln][0]
    # weather only needs quantity, line number, discount, tax, supplier and ship date
    assert "l_extendedprice" not in lineitem and "l_returnflag" not in lineitem


def test_scores_are_not_copied_into_filters(spark):
    # An inner generator over the computed array would push a size test, with the whole scoring expression in it, below every projection.
    from aeroseries.plans import QUERIES
    for name in ("allocate_by_season", "allergen_breakdown", "score_allergens_fixed"):
        filters = re.findall(r"Filter .*", _plan(QUERIES[name](spark, SF0001)))
        assert filters and max(map(len, filters)) < 2000, name


def _exchanges(df):
    return re.findall(r"Exchange hashpartitioning\([^)]*\)", _plan(df))


def test_features_over_buckets_need_no_site_exchange(spark):
    from aeroseries.operators.joins import join_daily
    from aeroseries.plans.q_io import bucketed_joined
    from aeroseries.sources.io import write_bucketed
    from aeroseries.streaming.stream import scratch_path
    joined = bucketed_joined(spark, SF0001)
    for name in sorted(H.FEATURE_SETS):
        assert not _exchanges(H.build(joined, name)), name
    sides = [write_bucketed(v(spark, SF0001), f"t_{i}", scratch_path(spark, f"t-buckets-{i}"), 8) for i, v in enumerate((FX.pollen, FX.weather_site))]
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    spark.conf.set(key, "false")
    try:
        assert not _exchanges(H.build(join_daily(*sides), "abiotic"))
    finally:
        spark.conf.unset(key)
    assert join_daily(*sides).count() == FX.joined(spark, SF0001).count() == joined.count()
