"""Spectra and harmonic fits of regular series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brackish.operators.metrics import same_keys
from brackish.operators.ordered import Run, Slices, running

# Period bands in hours (longest, shortest).
TIDAL_HOURS = (34.0, 4.0)
VERY_LOW_DAYS = 90.0


def detrended(df: DataFrame, keys: Sequence[str], index: str, value: str) -> DataFrame:
    """Residual from the least-squares line; slope and level are sums of one pass."""
    known = F.col(value).isNotNull()
    i = F.when(known, F.col(index).cast("double"))
    line = df.groupBy(*keys).agg(
        F.coalesce(F.try_divide(F.covar_pop(i, value), F.var_pop(i)), F.lit(0.0)).alias("_slope"),
        F.avg(i).alias("_mi"), F.avg(value).alias("_mv"),
    )
    joined = same_keys(df, line, keys)
    rest = F.col(value) - (F.col("_mv") + F.col("_slope") * (F.col(index) - F.col("_mi")))
    return joined.withColumn("residual", rest).drop("_slope", "_mi", "_mv")


def power_spectrum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, dt_hours: float, segment: int,
    slices: Slices | None = None,
) -> DataFrame:
    """Averaged periodogram (half-overlapping Hann segments) of a regular series.

    A row belongs to at most two segments.  Each segment is transformed in its own
    task, so the memory needed is one segment, whatever the length of the series.
    """
    numbered = running(df.select(*keys, *order, value), keys, order, {"_i": Run("row_index")}, slices)
    flat = detrended(numbered.withColumn("_i", F.col("_i") - 1), keys, "_i", value)
    hop = segment // 2
    last = F.floor(F.col("_i") / F.lit(hop))
    parts = F.filter(F.array(last, last - 1), lambda s: (s >= 0))
    cut = flat.select(*keys, "_i", "residual", F.explode(parts).alias("_seg"))
    group = [*keys, "_seg"]
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(segment) / segment)
    scale = dt_hours / (window**2).sum()

    def transform(pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) < segment:  # an unfinished last segment, marked and dropped below
            return pd.DataFrame({**{k: [pdf[k].iloc[0]] for k in group}, "bin": [-1], "power": [0.0]})
        x = pdf.sort_values("_i")["residual"].to_numpy()
        power = np.abs(np.fft.rfft((x - x.mean()) * window)) ** 2 * scale
        power[1 : -1 if segment % 2 == 0 else None] *= 2
        return pd.DataFrame({**{k: pdf[k].iloc[0] for k in group}, "bin": np.arange(power.size), "power": power})

    types = dict(cut.dtypes)
    schema = ", ".join([f"`{k}` {types[k]}" for k in group] + ["bin long", "power double"])
    spectra = cut.groupBy(*group).applyInPandas(transform, schema).where("bin >= 0")
    return spectra.groupBy(*keys, "bin").agg(F.avg("power").alias("power"), F.count(F.lit(1)).alias("segments")).withColumn(
        "cycles_per_hour", F.col("bin") / F.lit(segment * dt_hours)
    )


def band_peaks(spectrum: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Strongest frequency of the tidal, subtidal and very low bands."""
    f = F.col("cycles_per_hour")
    slow, fast, lowest = 1.0 / TIDAL_HOURS[0], 1.0 / TIDAL_HOURS[1], 1.0 / (VERY_LOW_DAYS * 24.0)
    band = (
        F.when((f > slow) & (f <= fast), "tidal")
        .when((f > lowest) & (f <= slow), "subtidal")
        .when((f > 0) & (f <= lowest), "very_low")
    )
    best = F.max_by(F.struct("cycles_per_hour", "power"), F.struct("power", -F.col("bin")))
    return (
        spectrum.withColumn("band", band).where("band is not null").groupBy(*keys, "band").agg(best.alias("b"))
        .select(*keys, "band", (1.0 / F.col("b.cycles_per_hour")).alias("period_hours"), F.col("b.power").alias("power"))
    )


def harmonic_fit(df: DataFrame, keys: Sequence[str], hours: str, value: str, speeds: Mapping[str, float]) -> DataFrame:
    """Least-squares amplitude and phase lag per constituent, plus the mean.

    The normal equations are sums over rows, so any length of record reduces to
    one small matrix per series, and only that matrix is solved in Python.
    """
    names = list(speeds)
    basis = [F.lit(1.0)]
    for name in names:
        angle = F.radians(F.col(hours) * F.lit(float(speeds[name])))
        basis += [F.cos(angle), F.sin(angle)]
    known = df.where(F.col(value).isNotNull() & F.col(hours).isNotNull())
    n = len(basis)
    columns = known.select(*keys, F.col(value).cast("double").alias("_v"), *[b.alias(f"_b{k}") for k, b in enumerate(basis)])
    sums = [F.sum(F.col(f"_b{p}") * F.col(f"_b{q}")).alias(f"m{p}_{q}") for p in range(n) for q in range(p, n)]
    sums += [F.sum(F.col(f"_b{p}") * F.col("_v")).alias(f"r{p}") for p in range(n)]
    reduced = columns.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *sums)

    def solve(batches):
        for pdf in batches:
            m = np.stack([np.stack([pdf[f"m{min(p, q)}_{max(p, q)}"] for q in range(n)], axis=1) for p in range(n)], axis=1)
            r = np.stack([pdf[f"r{p}"] for p in range(n)], axis=1)
            # One call for all series of a batch; short records have many solutions, of which the smallest is taken.
            c = (np.linalg.pinv(m, rcond=n * np.finfo(float).eps, hermitian=True) @ r[:, :, None])[:, :, 0]
            a, b = c[:, 1::2], c[:, 2::2]
            each = pdf[[*keys, "rows"]].loc[pdf.index.repeat(len(names))].reset_index(drop=True)
            yield each.assign(
                mean=np.repeat(c[:, 0], len(names)), constituent=names * len(pdf), amplitude=np.hypot(a, b).ravel(), phase=(np.degrees(np.arctan2(b, a)) % 360.0).ravel(),
            )

    types = dict(reduced.dtypes)
    schema = ", ".join([f"`{k}` {types[k]}" for k in keys] + ["rows long", "mean double", "constituent string", "amplitude double", "phase double"])
    return reduced.mapInPandas(solve, schema)


def energetic_centre(
    df: DataFrame, keys: Sequence[str], time: str, energy: str, width: int, slices: Slices | None = None
) -> DataFrame:
    """Time at the middle of the most energetic ``width`` records.

    The centred mean is a difference of running sums, so no wide frame is kept.
    """
    summed = running(df.select(*keys, time, energy), keys, [time], {"_i": Run("row_index"), "_c": Run("sum", F.col(energy))}, slices)
    before, after = width // 2, (width - 1) // 2
    ends = summed.select(*keys, (F.col("_i") - after).alias("_i"), F.col("_c").alias("_hi"))
    begins = summed.select(*keys, (F.col("_i") + before + 1).alias("_i"), F.col("_c").alias("_lo"))
    met = summed.select(*keys, time, "_i").join(ends, [*keys, "_i"]).join(begins, [*keys, "_i"], "left")
    mean = (F.col("_hi") - F.coalesce("_lo", F.lit(0.0))) / F.lit(float(width))
    whole = met.where((F.col("_lo").isNotNull()) | (F.col("_i") == before + 1)).withColumn("_m", mean)
    return whole.groupBy(*keys).agg(F.max("_m").alias("energy"), F.min_by(time, F.struct(-F.col("_m"), F.col("_i"))).alias("centre"))
