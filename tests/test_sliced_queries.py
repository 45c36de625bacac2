"""Queries give the same result when every axis is cut and every quantile is bracketed."""

import pytest

from brackish.operators import ordered, quantiles
from brackish.plans.registry import ORACLES, QUERIES, load_all
from tests.oracle import compare, connect

load_all()
FOLDER = "/root/testdata/sf0.001"
NAMES = [
    "gaps_islands", "gap_fill_first_n", "fill_line", "resample_linear", "interpolate_guarded", "asof_join", "gap_guard",
    "block_mean", "running_flux", "every_nth", "consecutive_chunks", "minimal_lon_interval", "nearest_on_axis",
    "anomaly_stats", "nearest_rank_p95", "cumulative_storage", "gradation_ring", "covering_intervals", "time_chunks",
    "evenly_spaced", "regular_axis", "running_distance", "time_health", "psd_peaks", "energetic_window", "repair_axes",
    "axis_regularity", "ring_areas",
]


@pytest.mark.parametrize("name", NAMES)
def test_sliced(spark, monkeypatch, name):
    monkeypatch.setattr(ordered, "ROWS_PER_TASK", 60)
    monkeypatch.setattr(quantiles, "ACCURACY", 100)
    got = QUERIES[name](spark, FOLDER).toArrow()
    assert compare(got, connect(FOLDER).execute(ORACLES[name]).to_arrow_table()) == []
