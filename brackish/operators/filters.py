"""Zero-phase band filters of regular series of any length.

A recursive filter is an affine map of its state: over n samples the state s becomes
A^n s + b, where b depends on the samples alone.  So a series is cut into slices, every slice is reduced
to its b, these are composed along the series, and the slices are then filtered from the states
carried into them, all at once.  The same is done backwards, which takes out the phase.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brackish.operators.ordered import Run, Slices, running
from brackish.session import cut_lineage

SLICE = 16_384  # samples of a slice
TOGETHER = 1_000  # slices, or groups of slices, that are composed in one task
_BLOCK = 64


class Filter:
    """A recursive filter by its poles: every pole p has a state s' = p s + x, and y = d x + the real part of the sum of r s.

    Of a pair of conjugate poles one is held, and its residue counts twice.  Held apart like this the states
    do not disturb each other, so that powers of the map over many samples lose nothing.
    States go about as real numbers: real and imaginary part of each.
    """

    def __init__(self, poles: np.ndarray, residues: np.ndarray, d: float, pad: int):
        self.poles, self.residues, self.d, self.pad = poles, residues, d, pad
        #: State of a filter that has seen the value 1 for ever.
        self.settled = (1.0 / (1.0 - poles)).view(np.float64)
        # The same as a real system s' = a s + b x, y = c s + d x.
        self.a = np.kron(np.diag(poles.real), np.eye(2)) + np.kron(np.diag(poles.imag), np.array([[0.0, -1.0], [1.0, 0.0]]))
        self.b, self.c = np.tile([1.0, 0.0], len(poles)), residues.conj().view(np.float64)
        powers = poles ** np.arange(_BLOCK + 1)[:, None]
        impulse = np.r_[d, (powers[: _BLOCK - 1] @ residues).real]
        gap = np.subtract.outer(np.arange(_BLOCK), np.arange(_BLOCK))
        self._direct = np.where(gap >= 0, impulse[np.maximum(gap, 0)], 0.0)
        self._seen, self._drive, self._jump = powers[:_BLOCK] * residues, powers[_BLOCK - 1 :: -1], powers[_BLOCK]

    @property
    def size(self) -> int:
        return len(self.b)

    def over(self, samples: int, state: np.ndarray) -> np.ndarray:
        """The state after so many samples of zero."""
        return (self.poles**samples * state.view(np.complex128)).view(np.float64)

    def run(self, x: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Output and last state; blocks of samples are matrix products, and only states go from block to block."""
        whole = len(x) // _BLOCK
        blocks, rest = x[: whole * _BLOCK].reshape(-1, _BLOCK), x[whole * _BLOCK :]
        driven, states = blocks @ self._drive, np.zeros((whole + 1, len(self.poles)), np.complex128)
        states[0] = np.ascontiguousarray(state).view(np.complex128)
        for i in range(whole):
            states[i + 1] = self._jump * states[i] + driven[i]
        y = (blocks @ self._direct.T + (states[:-1] @ self._seen.T).real).ravel()
        n, last = len(rest), states[-1]
        if n:
            y = np.r_[y, self._direct[:n, :n] @ rest + (self._seen[:n] @ last).real]
            last = self.poles**n * last + rest @ self._drive[_BLOCK - n :]
        return y, last.view(np.float64)


def butterworth(order: int, low: float | None, high: float, rate: float) -> Filter:
    """Butterworth low-pass up to ``high``, or band-pass from ``low`` to ``high``, in cycles a unit of time sampled ``rate`` times."""
    if not 0 < (low or high) <= high < rate / 2:
        raise ValueError("band edges must ascend and lie below half the sampling rate")
    warped = lambda f: 2.0 * rate * np.tan(np.pi * f / rate)  # noqa: E731  the bilinear map bends frequencies
    circle = np.exp(1j * np.pi * (2 * np.arange(order) + order + 1) / (2 * order))
    if low is None:
        analog, centre = warped(high) * circle, 0.0
    else:
        half = (warped(high) - warped(low)) / 2 * circle
        middle = warped(low) * warped(high)
        split = np.sqrt(half**2 - middle)
        analog, centre = np.r_[half + split, half - split], 2 * np.arctan(np.sqrt(middle) / (2 * rate))
    poles = (2 * rate + analog) / (2 * rate - analog)
    zeros = np.full(order, -1.0) if low is None else np.r_[np.ones(order), -np.ones(order)]
    at = np.exp(1j * centre)
    gain = abs(np.prod(at - poles) / np.prod(at - zeros))
    apart = poles[:, None] - poles + np.eye(len(poles))
    residues = gain * np.prod(poles[:, None] - zeros, axis=1) / np.prod(apart, axis=1)
    real, upper = np.abs(poles.imag) <= 1e-12, poles.imag > 1e-12
    held = np.r_[poles[upper], poles[real].real]
    sections, single = (order + 1) // 2 if low is None else order, low is None and order % 2
    # At its ends a series is mirrored by three times the length of the filter, as is usual.
    return Filter(held.astype(np.complex128), np.r_[2 * residues[upper], residues[real].real].astype(np.complex128), gain, 3 * (2 * sections + 1 - int(single)))


def tide_bands(dt_hours: float, tidal_hours: tuple[float, float] = (34.0, 4.0), very_low_days: float = 90.0, order: int = 4) -> dict[str, Filter]:
    """Filters of the tidal, subtidal and very low bands; a tidal edge beyond half the sampling rate is drawn in to 0.95 of that."""
    rate = 1.0 / dt_hours
    slow, fast, lowest = 1.0 / tidal_hours[0], 1.0 / tidal_hours[1], 1.0 / (24.0 * very_low_days)
    if slow >= rate / 2:
        raise ValueError("the sampling step cannot resolve the tidal band")
    if lowest >= slow:
        raise ValueError("the very low band must lie below the tidal one")
    fast = fast if fast < rate / 2 else 0.95 * rate / 2
    return {"tidal": butterworth(order, slow, fast, rate), "subtidal": butterworth(order, lowest, slow, rate), "very_low": butterworth(order, None, lowest, rate)}


def _mirrored(df: DataFrame, keys: Sequence[str], order: str, value: str, pad: int, length: int, slices: Slices | None) -> DataFrame:
    """Slices of each series, which is turned about its end values beyond its ends: _series, _at, _n, xs, stamps.

    ``_n`` is the length of the series without what is added; to one too short to be turned nothing is added.
    """
    x = F.col(value).cast("double")
    x = F.when(F.abs(x) < float("inf"), x).otherwise(F.lit(float("nan")))
    numbered = running(df.select(*keys, order, x.alias("_x")), keys, [order, "_x"], {"_i": Run("row_index")}, slices)
    numbered = numbered.select(F.struct(*keys).alias("_series") if keys else F.struct(F.lit(0).alias("all")).alias("_series"), F.col(order).alias("_t"), "_x", (F.col("_i") - 1).alias("_i"))
    ends = numbered.groupBy("_series").agg(F.count(F.lit(1)).alias("_n"), F.min_by("_x", "_i").alias("_first"), F.max_by("_x", "_i").alias("_last"))
    met = numbered.join(ends, "_series")
    i, last, turned = F.col("_i"), F.col("_n") - 1, F.col("_n") > pad

    def row(there: Column, j: Column, x: Column, t: Column) -> Column:
        return F.when(there, F.struct(j.alias("j"), x.alias("x"), t.alias("t")))

    none = F.lit(None).cast(df.schema[order].dataType)
    copies = F.array(
        row(F.lit(True), i + F.when(turned, pad).otherwise(0), F.col("_x"), F.col("_t")),
        row(turned & i.between(1, pad), pad - i, 2 * F.col("_first") - F.col("_x"), none),
        row(turned & i.between(last - pad, last - 1), pad + 2 * last - i, 2 * F.col("_last") - F.col("_x"), none),
    )
    each = met.select("_series", "_n", F.explode(F.filter(copies, lambda c: c.isNotNull())).alias("c"))
    cut = each.groupBy("_series", "_n", F.floor(F.col("c.j") / length).alias("_at")).agg(F.array_sort(F.collect_list("c")).alias("c"))
    return cut.select("_series", "_n", "_at", F.col("c.x").alias("xs"), F.col("c.t").alias("stamps"))


class _Bands:
    """Filters side by side; their states lie in one array, one after the other."""

    def __init__(self, bands: Mapping[str, Filter], length: int):
        self.names, self.filters, self.length = list(bands), list(bands.values()), length
        self.pad = max(f.pad for f in self.filters)
        self.cuts = np.cumsum([0, *(f.size for f in self.filters)])

    def states(self, flat: np.ndarray) -> list[np.ndarray]:
        return [flat[a:b] for a, b in zip(self.cuts[:-1], self.cuts[1:], strict=True)]

    def part(self, f: Filter, at: int, n: int, size: int) -> tuple[int, int]:
        """Which samples of slice ``at`` the filter sees: it starts and ends ``f.pad`` samples beyond the series, or sees nothing of a short one."""
        if n <= self.pad:
            return 0, 0
        first = self.pad - f.pad - at * self.length
        return min(max(first, 0), size), max(min(first + n + 2 * f.pad, size), 0)

    def reduced(self, signals: list[np.ndarray], at: int, n: int, back: bool) -> tuple[np.ndarray, list[int]]:
        """b of the slice for each band, and the number of samples; where the series begins, its starting state is part of b."""
        out, counts = [], []
        for f, x in zip(self.filters, signals, strict=True):
            a, b = self.part(f, at, n, len(x))
            seen = x[a:b][::-1] if back else x[a:b]
            begins = len(seen) and (at * self.length + b == self.pad + n + f.pad if back else at * self.length + a == self.pad - f.pad)
            state = f.settled * seen[0] if begins else np.zeros(f.size)
            out.append(f.run(seen, state)[1])
            counts.append(len(seen))
        return np.concatenate(out), counts

    def filtered(self, signals: list[np.ndarray], at: int, n: int, carried: np.ndarray, back: bool) -> list[np.ndarray]:
        out = []
        for f, x, state in zip(self.filters, signals, self.states(carried), strict=True):
            a, b = self.part(f, at, n, len(x))
            seen = x[a:b][::-1] if back else x[a:b]
            begins = len(seen) and (at * self.length + b == self.pad + n + f.pad if back else at * self.length + a == self.pad - f.pad)
            y = np.full(len(x), np.nan)
            got = f.run(seen, f.settled * seen[0] if begins else state)[0]
            y[a:b] = got[::-1] if back else got
            out.append(y)
        return out

    def on(self, state: np.ndarray, b: np.ndarray, counts: list[int]) -> np.ndarray:
        """The state behind a slice from the state before it."""
        return np.concatenate([f.over(n, s) for f, n, s in zip(self.filters, counts, self.states(state), strict=True)]) + b


_STATE = "b array<double>, counts array<long>"


def _lists(parts: Sequence[np.ndarray]) -> pa.ListArray:
    """A list column of arrays of doubles."""
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]).astype(np.int32)), pa.array(flat))


def _carried(summary: DataFrame, bands: _Bands, most: int) -> DataFrame:
    """(_series, _place, carry): the state before each slice, from (_series, _place, b, counts), places counted from 0.

    Up to TOGETHER slices are composed in a task; more are first reduced to groups of slices, which are carried alike.
    """
    key = summary.schema["_series"].dataType
    width = max(2, TOGETHER)
    single = most <= width

    def walk(rows: pa.Table, state: np.ndarray):
        order = np.argsort(rows.column("_place").to_numpy())
        b, counts = rows.column("b").to_pylist(), rows.column("counts").to_pylist()
        before = [None] * len(order)
        for i in order.tolist():
            before[i] = state
            state = bands.on(state, np.array(b[i]), counts[i])
        return before, state, np.sum(counts, axis=0)

    def within(rows: pa.Table) -> pa.Table:
        start = np.zeros(bands.cuts[-1]) if single else np.array(rows.column("carry")[0].as_py())
        return pa.table([rows.column("_series"), rows.column("_place"), _lists(walk(rows, start)[0])], ["_series", "_place", "carry"])

    def whole(rows: pa.Table) -> pa.Table:
        _, state, counts = walk(rows, np.zeros(bands.cuts[-1]))
        return pa.table(
            [rows.column("_series")[:1], rows.column("_group")[:1], _lists([state]), pa.array([counts.tolist()], pa.list_(pa.int64()))],
            ["_series", "_place", "b", "counts"],
        )

    wide = T.StructType([T.StructField("_series", key), T.StructField("_place", T.LongType())])
    state = T.StructType([*wide.fields, T.StructField("carry", T.ArrayType(T.DoubleType()))])
    if single:
        return summary.groupBy("_series").applyInArrow(within, state)
    grouped = summary.withColumn("_group", F.floor(F.col("_place") / width))
    reduced = T.StructType([*wide.fields, *T.StructType.fromDDL(_STATE).fields])
    groups = _carried(cut_lineage(grouped.groupBy("_series", "_group").applyInArrow(whole, reduced)), bands, -(-most // width))
    met = grouped.join(groups.withColumnRenamed("_place", "_group"), ["_series", "_group"])
    return met.groupBy("_series", "_group").applyInArrow(within, state)


def filter_bands(
    df: DataFrame, keys: Sequence[str], order: str, value: str, bands: Mapping[str, Filter], slices: Slices | None = None, length: int | None = None,
) -> DataFrame:
    """Each band of each regular series: ``keys``, ``order`` and one column a band, filtered forwards and backwards.

    At both ends a series goes on turned about its last value, as far as each filter needs, and a filter
    starts as if the first value had been there for ever.  A value that is null or not finite makes its whole series null, so gaps are
    to be filled before; series no longer than the widest of these ends come out null.  Rows alike in keys and order are
    filtered one after the other, by value.

    Series are packed in slices of SLICE samples, each read twice in either direction: once for its b, once to be
    filtered.  No task holds more than a slice of samples or TOGETHER states, whatever the length of a series.
    """
    size = length or SLICE
    shape = _Bands(bands, size)
    packed = cut_lineage(_mirrored(df, keys, order, value, shape.pad, size, slices))
    total = F.ceil((F.col("_n") + 2 * shape.pad) / size)
    longest = packed.agg(F.max(total)).first()[0] or 0
    several = len(shape.filters)

    def signals(column: pa.Array, count: int) -> list[list[np.ndarray]]:
        flat, ends = np.asarray(column.flatten(), np.float64), np.cumsum(np.asarray(column.value_lengths()))
        parts = [flat[a:b] for a, b in zip(np.r_[0, ends[:-1]], ends, strict=True)]
        return [np.split(p, several) if count == several and several > 1 else [p] * several for p in parts]

    def numbers(batch: pa.RecordBatch):
        return batch.column("_at").to_pylist(), batch.column("_n").to_pylist()

    def summary(back: bool):
        def run(batches):
            for batch in batches:
                xs = signals(batch.column("ys" if back else "xs"), several if back else 1)
                found = [shape.reduced(x, at, n, back) for x, at, n in zip(xs, *numbers(batch), strict=True)]
                place = [-(-(n + 2 * shape.pad) // size) - 1 - at if back else at for at, n in zip(*numbers(batch), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_series"), pa.array(place, pa.int64()), _lists([b for b, _ in found]), pa.array([c for _, c in found], pa.list_(pa.int64()))],
                    ["_series", "_place", "b", "counts"],
                )

        return run

    def forward(batches):
        for batch in batches:
            found = [
                np.concatenate(shape.filtered(x, at, n, np.array(carry), False))
                for x, at, n, carry in zip(signals(batch.column("xs"), 1), *numbers(batch), batch.column("carry").to_pylist(), strict=True)
            ]
            columns = [batch.column(c) for c in ("_series", "_n", "_at", "stamps")] + [_lists(found)]
            yield pa.RecordBatch.from_arrays(columns, ["_series", "_n", "_at", "stamps", "ys"])

    def backward(batches):
        for batch in batches:
            rows, stamps, found = [], batch.column("stamps"), []
            starts = np.r_[0, np.cumsum(np.asarray(stamps.value_lengths()))]
            for r, (y, at, n, carry) in enumerate(zip(signals(batch.column("ys"), several), *numbers(batch), batch.column("carry").to_pylist(), strict=True)):
                z = shape.filtered(y, at, n, np.array(carry), True)
                ahead = shape.pad if n > shape.pad else 0
                first, last = max(0, ahead - at * size), min(len(z[0]), ahead + n - at * size)
                if last > first:
                    rows.append(np.c_[np.full(last - first, r), np.arange(starts[r] + first, starts[r] + last)])
                    found.append(np.stack([b[first:last] for b in z]))
            taken = np.concatenate(rows) if rows else np.zeros((0, 2), np.int64)
            bands_ = np.concatenate(found, axis=1) if found else np.zeros((several, 0))
            columns = [batch.column("_series").take(pa.array(taken[:, 0])), stamps.flatten().take(pa.array(taken[:, 1]))]
            columns += [pa.array(b, from_pandas=True) for b in bands_]  # NaN becomes null
            yield pa.RecordBatch.from_arrays(columns, ["_series", "_t", *[f"_b{k}" for k in range(several)]])

    key, time = packed.schema["_series"].dataType, df.schema[order].dataType
    state = T.StructType([T.StructField("_series", key), T.StructField("_place", T.LongType()), *T.StructType.fromDDL(_STATE).fields])
    ahead = cut_lineage(packed.select("_series", "_n", "_at", "xs").mapInArrow(summary(False), state))
    carry = _carried(ahead, shape, longest).withColumnRenamed("_place", "_at")
    passed = T.StructType([
        T.StructField("_series", key), T.StructField("_n", T.LongType()), T.StructField("_at", T.LongType()), T.StructField("stamps", T.ArrayType(time)), T.StructField("ys", T.ArrayType(T.DoubleType())),
    ])
    once = cut_lineage(packed.join(carry, ["_series", "_at"]).select("_series", "_n", "_at", "xs", "stamps", "carry").mapInArrow(forward, passed))
    behind = cut_lineage(once.select("_series", "_n", "_at", "ys").mapInArrow(summary(True), state))
    carry = _carried(behind, shape, longest)
    rows = T.StructType([T.StructField("_series", key), T.StructField("_t", time), *[T.StructField(f"_b{k}", T.DoubleType()) for k in range(several)]])
    met = once.withColumn("_place", total - 1 - F.col("_at")).join(carry, ["_series", "_place"]).select("_series", "_n", "_at", "stamps", "ys", "carry")
    out = met.mapInArrow(backward, rows)
    return out.select(*[F.col(f"_series.{k}").alias(k) for k in keys], F.col("_t").alias(order), *[F.col(f"_b{k}").alias(name) for k, name in enumerate(shape.names)])
