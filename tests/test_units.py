"""Unit checks of driver-side helpers and column lists."""

from aeroseries.operators import evaluate as EV
from aeroseries.operators import features as H
from aeroseries.operators import models as ML


def test_feature_set_sizes():
    assert len(H.H1_COLUMNS) == 35
    assert len(H.H2_COLUMNS) == 50
    assert len(H.H3_COLUMNS) == 73
    assert len(H.H4_COLUMNS) == 44
    assert len(H.H5_COLUMNS) == 55 == len(set(H.H5_COLUMNS))


def test_best_round_patience():
    errs = [5, 4, 3, 3.5, 3.2, 3.1, 3.05, 3.3]
    assert ML.best_round(errs, patience=3) == 3
    assert ML.best_round([3, 2, 1], patience=50) == 3


def test_sample_grid_deterministic():
    a = ML.sample_grid(ML.SEARCH_GRIDS["refined"][0], 5, seed=1)
    assert a == ML.sample_grid(ML.SEARCH_GRIDS["refined"][0], 5, seed=1)
    assert len({tuple(sorted(d.items())) for d in a}) == 5


def test_classify_features():
    w, h = EV.classify_features(H.H4_COLUMNS + ["TMAX"])
    assert "Pollen_lag_1" in h and "Pollen_roll_3" in h
    assert "TMAX" in w and w.count("TMAX") == 1
    assert len(w) + len(h) == len(H.H4_COLUMNS)
