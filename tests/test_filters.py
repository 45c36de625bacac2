"""Zero-phase filters against one sequential pass, whatever the slices."""

import numpy as np
import pytest

from brackish.operators import filters


def sequential(f, x):
    """One sample after the other, forwards then backwards, over the series turned about its ends."""
    p = f.pad
    if len(x) <= p:
        return np.full(len(x), np.nan)
    wide = np.r_[2 * x[0] - x[p:0:-1], x, 2 * x[-1] - x[-2 : -p - 2 : -1]]
    for _ in range(2):
        s, out = f.settled * wide[0], []
        for v in wide:
            out.append(f.c @ s + f.d * v)
            s = f.a @ s + f.b * v
        wide = np.array(out)[::-1]
    return wide[p : len(wide) - p]


@pytest.fixture(scope="module")
def tides():
    pick = np.random.default_rng(2)
    t = np.arange(1500)
    base = np.cos(2 * np.pi * t / 12.42) + 0.4 * np.cos(2 * np.pi * t / 200) + 0.001 * t
    return {"a": base + pick.normal(size=1500) / 5, "b": base[:400] * 3, "c": np.full(90, 2.5), None: base[700:760], "short": base[:20], "one": base[:1]}


@pytest.mark.parametrize("length, together", [(16_384, 1000), (100, 1000), (64, 3), (7, 2)])
def test_sliced_equals_sequential(spark, tides, monkeypatch, length, together):
    monkeypatch.setattr(filters, "TOGETHER", together)
    bands = filters.tide_bands(1.0)
    rows = [(k, i, float(v), "x") for k, x in tides.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "k string, t int, v double, tidal string").repartition(3)
    got = {(r.k, r.t): r for r in filters.filter_bands(df, ["k"], "t", "v", bands, length=length).collect()}
    assert len(got) == len(rows)
    most = max(f.pad for f in bands.values())
    for k, x in tides.items():
        for name, f in bands.items():
            found = [got[k, i][name] for i in range(len(x))]
            if len(x) <= most:
                assert found == [None] * len(x)
            else:
                assert np.abs(np.array(found) - sequential(f, x)).max() < 1e-9


def test_gaps_spoil_their_series_only(spark, tides):
    bands = {"low": filters.butterworth(4, None, 1 / 30, 1.0)}
    rows = [("a", i, None if i == 77 else float(v)) for i, v in enumerate(tides["b"])] + [("b", i, float("inf") if i == 3 else 1.0) for i in range(50)]
    rows += [("c", i, float(v)) for i, v in enumerate(tides["c"])]
    got = filters.filter_bands(spark.createDataFrame(rows, "k string, t int, v double"), ["k"], "t", "v", bands, length=50).collect()
    assert all((r.low is None) == (r.k != "c") for r in got) and len(got) == len(rows)
    assert all(abs(r.low - 2.5) < 1e-9 for r in got if r.k == "c")
    none = filters.filter_bands(spark.createDataFrame([], "k string, t int, v double"), ["k"], "t", "v", bands)
    assert none.count() == 0 and none.columns == ["k", "t", "low"]
    alone = filters.filter_bands(spark.createDataFrame([(i, float(v)) for i, v in enumerate(tides["c"])], "t int, v double"), [], "t", "v", bands)
    assert alone.count() == 90


@pytest.mark.parametrize("order, low, high", [(4, 1 / 34, 1 / 4), (4, None, 1 / 2160), (3, None, 0.1), (3, 0.05, 0.2), (4, 1 / 2160, 1 / 34)])
def test_response(order, low, high):
    """One in the middle of the band, the root of a half at its edges, little beyond."""
    f = filters.butterworth(order, low, high, 1.0)

    def gain(frequency):
        z = np.exp(2j * np.pi * frequency)
        return abs(f.c @ np.linalg.solve(z * np.eye(f.size) - f.a, f.b.astype(complex)) + f.d)

    edges = [high] if low is None else [low, high]
    assert all(abs(gain(e) - 0.5**0.5) < 1e-6 for e in edges)
    middle = 0.0 if low is None else np.arctan(np.sqrt(np.tan(np.pi * low) * np.tan(np.pi * high))) / np.pi
    assert abs(gain(middle) - 1) < 1e-6 and gain(min(0.499, 4 * high)) < 0.05


def test_bands_that_cannot_be():
    with pytest.raises(ValueError, match="resolve"):
        filters.tide_bands(20.0)
    with pytest.raises(ValueError, match="below"):
        filters.tide_bands(1.0, very_low_days=1.0)
    assert filters.tide_bands(3.0)["tidal"].pad == 27
