"""The sliced forms give what the plain window gives, whatever the skew."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from brackish.operators import nearest, series, spectra
from brackish.operators.ordered import Run, Slices, plan_slices, running
from brackish.operators.quantiles import with_quantiles

KINDS = ["row_index", "sum", "max", "min", "min_ahead", "last", "prev", "next", "next_or_here", "lag", "lead"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    n = 900
    key = np.where(rng.random(n) < 0.4, 1, rng.integers(0, 6, n))  # one key holds more than a third
    t = np.sort(rng.integers(0, 5000, n))
    t[:300] = np.sort(rng.integers(0, 60, 300))  # a dense stretch
    v, known, ident = np.round(rng.normal(size=n) * 8) / 4, rng.random(n) > 0.3, rng.permutation(n)
    data = [(None if key[i] == 5 else int(key[i]), int(t[i]), int(ident[i]), float(v[i]) if known[i] else None) for i in range(n)]
    df = spark.createDataFrame(data, "k long, t long, id long, v double")
    return df.repartition(4).cache()


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("width", [1.0, 37.0, 900.0])
def test_sliced_equals_plain(rows, keys, width):
    runs = {f"o_{kind}": Run(kind, None if kind == "row_index" else F.col("v")) for kind in KINDS}
    plain = running(rows, keys, ["t", "id"], runs, Slices("t", None))
    cut = running(rows, keys, ["t", "id"], runs, Slices("t", width))
    assert plain.columns == cut.columns
    a, b = ({r["id"]: r for r in df.collect()} for df in (plain, cut))
    assert a == b


def test_slices_follow_density(rows):
    assert plan_slices(rows, "t").width is None
    cut = plan_slices(rows, "t", rows_per_task=50)
    fullest = rows.groupBy(F.floor(F.col("t") / cut.width)).count().agg(F.max("count")).first()[0]
    assert fullest <= 150


def test_null_positions_come_first(spark):
    df = spark.createDataFrame([(None, 1, 5.0), (3, 2, 1.0), (9, 3, 2.0)], "t long, id long, v double")
    out = running(df, [], ["t", "id"], {"s": Run("sum", F.col("v"))}, Slices("t", 2.0))
    assert {r.id: r.s for r in out.collect()} == {1: 5.0, 2: 6.0, 3: 8.0}


@pytest.mark.parametrize("nearest_rank", [False, True])
def test_quantiles_by_bracket(rows, nearest_rank):
    for probs, accuracy in (([0.0, 0.05, 0.5, 0.95, 1.0], 20), ([0.0, 0.05, 0.5, 0.95, 1.0], 100_000), ([0.5], 40), ([0.3], 100)):
        big = with_quantiles(rows, ["k"], F.col("v"), probs, nearest_rank=nearest_rank, rows_per_task=1, accuracy=accuracy)
        small = with_quantiles(rows, ["k"], F.col("v"), probs, nearest_rank=nearest_rank)
        left, right = ({r.k: r.quantiles for r in d.collect()} for d in (big, small))
        assert left.keys() == right.keys()
        for k in left:
            np.testing.assert_allclose(left[k], right[k])


def test_quantiles_without_values(spark):
    df = spark.createDataFrame([("a", None), ("b", 2.0)], "k string, v double")
    out = with_quantiles(df, ["k"], F.col("v"), [0.5], rows_per_task=1)
    assert {r.k: r.quantiles for r in out.collect()} == {"a": None, "b": [2.0]}


@pytest.mark.parametrize("slices", [Slices("t", None), Slices("t", 2.0)])
def test_gap_fill_known_case(spark, slices):
    values = [None, 1, None, None, None, None, None, 7, None, None, None]
    df = spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(values)], "t long, v double")
    first = [r.filled for r in series.fill_gaps(df, [], ["t"], "v", 2, "first_n", slices=slices).orderBy("t").collect()]
    assert first == [None, 1, 2, 3, None, None, None, 7, 7, 7, None]
    whole = [r.filled for r in series.fill_gaps(df, [], ["t"], "v", 5, "whole_gap", slices=slices).orderBy("t").collect()]
    assert whole == [None, 1, 2, 3, 4, 5, 6, 7, None, None, None]


@pytest.mark.parametrize("slices", [Slices("t", None), Slices("t", 3.0)])
def test_line_fill_and_islands(spark, slices):
    df = spark.createDataFrame([(0, None), (2, 1.0), (6, None), (10, 5.0), (11, None)], "t long, v double")
    assert [r.filled for r in series.fill_line(df, [], "t", "v", slices=slices).orderBy("t").collect()] == [1, 1, 3, 5, 5]
    runs = series.run_lengths(df, [], ["t"], F.col("v").isNull(), slices).orderBy("first").collect()
    assert [(r.first, r.last, r.length) for r in runs] == [(0, 0, 1), (6, 6, 1), (11, 11, 1)]
    assert series.longest_run(df, [], ["t"], F.col("v").isNull(), slices).first().longest == 1


@pytest.mark.parametrize("width", [None, 7.0])
def test_interpolation_against_numpy(spark, width):
    rng = np.random.default_rng(3)
    x = np.sort(rng.choice(200, 40, replace=False)).astype(float)
    v = rng.normal(size=40)
    want = np.sort(rng.uniform(-10, 210, 60))
    src = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, v)], "x double, v double")
    tgt = spark.createDataFrame([(i, float(a)) for i, a in enumerate(want)], "id long, x double")
    cut = Slices("x", width)
    held = series.interpolate_at(tgt, src, [], "x", "v", "out", hold_ends=True, slices=cut).orderBy("id").collect()
    np.testing.assert_allclose([r.out for r in held], np.interp(want, x, v))
    bare = series.interpolate_at(tgt, src, [], "x", "v", "out", max_gap=6.0, slices=cut).orderBy("id").collect()
    for r, a in zip(bare, want):
        i = np.searchsorted(x, a)
        inside = 0 < i < len(x) and x[i] - x[i - 1] <= 6.0
        assert (r.out is not None) == (inside or a in x)


@pytest.mark.parametrize("width", [None, 5.0])
def test_asof_ties_take_the_last(spark, width):
    left = spark.createDataFrame([(1, "a", 10), (2, "a", 4), (3, "b", 50)], "id long, k string, t long")
    right = spark.createDataFrame([("a", 5, 1), ("a", 10, 2), ("a", 10, 3), ("b", 60, 4)], "k string, t long, r long")
    out = series.asof_join(left, right, ["k"], "t", ["r"], ["r"], Slices("t", width)).collect()
    assert {r.id: r.r for r in out} == {1: 3, 2: None, 3: None}


def test_block_means_and_every_nth(spark):
    df = spark.range(10).select(F.col("id").alias("t"), F.col("id").cast("double").alias("v"))
    for cut in (Slices("t", None), Slices("t", 3.0)):
        got = [(r["block"], r["mean"], r.rows, r.stamp) for r in series.block_means(df, [], ["t"], "v", 4, cut).orderBy("block").collect()]
        assert got == [(0, 1.5, 4, 2), (1, 5.5, 4, 6), (2, 8.5, 2, 9)]
        frames = series.every_nth(df, ["t"], 2, 3, cut).orderBy("t").collect()
        assert [r.t for r in frames] == [0, 4, 8]


def test_every_nth_matches_linspace(spark):
    df = spark.range(997).select(F.col("id").alias("t"))
    got = [r.frame for r in series.every_nth(df, ["t"], 1, 400).orderBy("t").collect()]
    assert got == sorted(set(np.rint(np.linspace(0, 996, 400)).astype(int)))


def test_nearest_on_axis(spark):
    rng = np.random.default_rng(1)
    a, b = np.round(rng.uniform(0, 50, 200), 1), np.round(rng.uniform(0, 50, 40), 1)
    left = spark.createDataFrame([(i, float(v)) for i, v in enumerate(a)], "l long, x double")
    right = spark.createDataFrame([(i, float(v)) for i, v in enumerate(b)], "r long, y double")
    got = {r.l: (r.r, round(r.distance, 9)) for r in nearest.nearest_on_axis(left, right, "x", "y", "r").collect()}
    for i, v in enumerate(a):
        d = np.round(np.abs(b - v), 9)
        assert got[i][1] == d.min() and d[got[i][0]] == d.min()


def test_repair_known_cases(spark):
    """One value in time fills its line (1), one layer its column (2), one node its arc (3)."""
    def run(known):
        rows = [(a, t, z, n, known.get((t, z, n))) for a in (0,) for t in range(3) for z in range(3) for n in range(2)]
        df = spark.createDataFrame(rows, "arc long, t long, layer long, node long, v double")
        passes = [(["arc", "layer", "node"], "t", 1), (["arc", "t", "node"], "layer", 2), (["arc", "t", "layer"], "node", 3)]
        return {(r.t, r.layer, r.node): (r.v, r.repair_code) for r in series.repair_axes(df, "v", passes).collect()}

    got = run({(1, 1, 0): 7.25})
    assert all(v == 7.25 for v, _ in got.values())
    assert got[(1, 1, 0)][1] == 0 and got[(0, 1, 0)][1] == 1 and got[(0, 0, 0)][1] == 2 and got[(2, 2, 1)][1] == 3
    assert all(v is None for v, _ in run({}).values())


def test_spectrum_finds_the_period(spark):
    t = np.arange(2048)
    df = spark.createDataFrame([("s", int(i), float(np.cos(2 * np.pi * i / 12.8) + 0.01 * i)) for i in t], "k string, t long, v double")
    peak = spectra.band_peaks(spectra.power_spectrum(df, ["k"], ["t"], "v", 1.0, 512), ["k"]).where("band = 'tidal'").first()
    assert abs(peak.period_hours - 12.8) < 0.4


def test_harmonic_fit_recovers_constants(spark):
    h = np.arange(0, 900.0)
    v = 0.3 + 1.2 * np.cos(np.radians(28.9841042 * h - 75)) + 0.4 * np.cos(np.radians(15.0410686 * h - 200))
    df = spark.createDataFrame([("s", float(a), float(b)) for a, b in zip(h, v)], "k string, h double, v double")
    got = {r.constituent: r for r in spectra.harmonic_fit(df, ["k"], "h", "v", {"M2": 28.9841042, "K1": 15.0410686}).collect()}
    assert abs(got["M2"].amplitude - 1.2) < 1e-6 and abs(got["M2"].phase - 75) < 1e-4 and abs(got["K1"].phase - 200) < 1e-4 and abs(got["M2"].mean - 0.3) < 1e-6


def _slice_sizes(df, keys, order, rows):
    """Rows of each slice that running() makes, and how many summary rows it needs."""
    from brackish.operators import ordered

    cut = plan_slices(df, order[0], rows_per_task=rows)
    grouped = df.withColumn(ordered._GROUP, F.struct(*keys) if keys else F.struct(F.lit(0).alias("all")))
    grouped = grouped.withColumn(ordered._TIE, F.xxhash64(*df.columns))
    grouped = grouped.withColumn(ordered._POSITION, F.struct(*order, ordered._TIE))
    bounds = cut.bounds(grouped, keys, order)
    if bounds is None:
        return None
    met = grouped.join(bounds, ordered._GROUP).withColumn("n", ordered._slice_number(F.col("_bounds"), F.col(ordered._POSITION)))
    return [r["count"] for r in met.groupBy(ordered._GROUP, "n").count().collect()]


@pytest.mark.parametrize("case", ["sentinel", "outlier", "ties"])
def test_no_slice_exceeds_its_bound(spark, case):
    n = 60_000
    at = {"sentinel": F.col("id") * 1000, "outlier": F.col("id"), "ties": F.col("id") % 97}[case]
    df = spark.range(n).select(at.alias("t"), F.col("id").alias("v"))
    far = {"sentinel": 253402214400000000, "outlier": 10**12, "ties": 96}[case]
    df = df.union(spark.createDataFrame([(far, -1)], "t long, v long"))
    sizes = _slice_sizes(df, [], ["t"], 1000)
    assert sum(sizes) == n + 1 and max(sizes) <= 2000 and len(sizes) < 200
    got = running(df, [], ["t"], {"s": Run("sum", F.lit(1))}, plan_slices(df, "t", 1000))
    assert got.agg(F.countDistinct("s"), F.max("s")).first()[:] == (n + 1, n + 1)


def test_small_groups_stay_whole(spark):
    df = spark.range(40_000).select((F.col("id") % 4000).alias("k"), F.col("id").alias("t"))
    assert _slice_sizes(df, ["k"], ["t"], 1000) is None
    one = df.union(spark.range(5000).select(F.lit(-1).cast("long"), F.col("id")))
    sizes = _slice_sizes(one, ["k"], ["t"], 1000)
    assert sum(sizes) == 5000 and max(sizes) <= 2000 and len(sizes) < 0.01 * 45_000


def test_quantiles_of_nothing_are_one_row(spark):
    df = spark.createDataFrame([(None,)] * 10, "v double")
    rows = [with_quantiles(df, [], F.col("v"), [0.5], rows_per_task=n).collect() for n in (1, 100)]
    assert len(rows[0]) == len(rows[1]) == 1


def test_repair_needs_many_passes_or_stops(spark):
    # A chain in which every pass reaches one column further: two known values fill a line of one axis, that lets
    # the other axis go on, so that far more than ten rounds are needed.
    known = [(i, j, float(i + j)) for i in range(14) for j in range(14) if abs(i - j) <= 1 and (i + j) % 2 == 1]
    cells = {(i, j) for i in range(14) for j in range(14) if abs(i - j) <= 1}
    rows = [(i, j, next((v for a, b, v in known if (a, b) == (i, j)), None)) for i, j in sorted(cells)]
    df = spark.createDataFrame(rows, "i long, j long, v double")
    passes = [(["i"], "j", 1), (["j"], "i", 2)]
    assert series.repair_axes(df, "v", passes).where("v is null").count() == 0
    empty = spark.createDataFrame([(0, 0, None), (1, 1, None)], "i long, j long, v double")
    with pytest.raises(ValueError):
        series.repair_axes(empty, "v", passes, unresolved="stop")
    assert series.repair_axes(empty, "v", passes).where("v is null").count() == 2
