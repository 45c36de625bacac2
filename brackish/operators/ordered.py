"""Running and neighbouring values along an ordered axis, for groups of any size.

A plain window puts every row of a group into one task.  One gauge, one user or
the whole table (no key) may hold a third of 100 TB, so groups larger than a task
are cut into slices:

1. the heavy groups are counted out, with map-side combine;
2. a hash sample of their rows, sorted by the full order, gives the bounds of slices
   that hold a bounded number of rows, wherever they lie on the axis;
3. rows are windowed inside (group, slice); a group that fits a task is one slice;
4. each slice of a heavy group is reduced to one row, these few rows are windowed by group,
   and what was carried in from earlier (or later) slices is joined back.

Where no group is heavy the plan is a plain window.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brackish.session import cut_lineage

ROWS_PER_TASK = 2_000_000
SAMPLED = 32  # sampled rows a slice
MOST_BOUNDS = 1_000_000  # bounds that are sent to every task; beyond it slices grow
_PROBE_CELLS = 4096
_SLICE = "_slice"
_GROUP = "_group"
_POSITION = "_position"
_TIE = "_tie_break"


class Slices:
    """How one axis is cut.

    ``rows``: groups of more rows are cut at sampled bounds, which are kept for the frames
    that share this object.  Without it a ``width`` cuts all groups evenly, and a width of
    None says that everything fits one task.
    """

    def __init__(self, column: str, width: float | Callable[[], float] | None, rows: int | None = None):
        self.column, self.rows = column, rows
        self._width = width
        self._bounds: dict[tuple, DataFrame | None] = {}

    @property
    def width(self) -> float | None:
        if callable(self._width):
            self._width = self._width()
        return self._width

    def bounds(self, df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame | None:
        """Sorted bounds of the slices of each heavy group of ``df``; None if there is none."""
        name = (tuple(keys), tuple(order))
        if name not in self._bounds:
            self._bounds[name] = _sampled_bounds(df, self.rows)
        return self._bounds[name]


@dataclass(frozen=True)
class Run:
    """One running value: ``kind`` names the rule, ``column`` its input."""

    kind: str
    column: Column | None = None


def axis_number(df: DataFrame, column: str) -> Column:
    """The axis as a number: microseconds for times, the value itself otherwise."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    return F.col(column).cast("double")


def plan_slices(df: DataFrame, column: str, rows_per_task: int | None = None) -> Slices:
    """Whether groups can be larger than a task at all: one count, of footers only for a stored table."""
    rows_per_task = rows_per_task or ROWS_PER_TASK
    if df.count() <= rows_per_task:
        return Slices(column, None)
    return Slices(column, lambda: _even_width(df, column, rows_per_task), rows_per_task)


def _even_width(df: DataFrame, column: str, rows: int) -> float:
    """A width whose fullest stretch holds about ``rows`` rows of an axis without outliers."""
    axis = axis_number(df, column)
    low, high = df.agg(F.min(axis), F.max(axis)).first()
    cell = (high - low) / _PROBE_CELLS
    fullest = df.groupBy(F.floor((axis - F.lit(low)) / F.lit(cell))).count().agg(F.max("count")).first()[0]
    return cell * rows / fullest


def _sampled_bounds(df: DataFrame, rows: int) -> DataFrame | None:
    """(group, bounds) of the groups of more than ``rows`` rows, from a sample by hash of the position."""
    heavy = df.groupBy(_GROUP).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows)
    total = heavy.agg(F.sum("_n")).first()[0]
    if not total:
        return None
    rows = max(rows, total // MOST_BOUNDS)
    few = max(1, rows // SAMPLED)
    sample = df.where(F.pmod(F.xxhash64(_POSITION), F.lit(few)) == 0).select(_GROUP, _POSITION)
    sample = sample.join(F.broadcast(heavy.select(_GROUP)), _GROUP, "left_semi")
    place = F.row_number().over(W.partitionBy(_GROUP).orderBy(_POSITION))
    ends = sample.withColumn("_at", place).where(F.col("_at") % SAMPLED == 0)
    return cut_lineage(ends.groupBy(_GROUP).agg(F.array_sort(F.collect_list(_POSITION)).alias("_bounds")))


def _slice_number(bounds: Column, position: Column) -> Column:
    """How many of the sorted bounds lie at or before the position, found bit by bit."""

    def step(found: Column, bit: Column) -> Column:
        ahead = found + F.call_function("shiftleft", F.lit(1), bit)
        return F.when(F.get(bounds, ahead - 1) <= position, ahead).otherwise(found)

    return F.aggregate(F.sequence(F.lit(24), F.lit(0), F.lit(-1)), F.lit(0), step).cast("long")


_FORWARD_CARRY = {"row_index", "sum", "max", "min", "last", "prev", "lag"}


def _inside(run: Run, fwd, back) -> Column:
    upto, before = (W.unboundedPreceding, 0), (W.unboundedPreceding, -1)
    c = run.column
    # Values "ahead" run backwards: a frame to UNBOUNDED FOLLOWING is quadratic.
    return {
        "row_index": lambda: F.row_number().over(fwd).cast("long"),
        "sum": lambda: F.sum(c).over(fwd.rowsBetween(*upto)),
        "max": lambda: F.max(c).over(fwd.rowsBetween(*upto)),
        "min": lambda: F.min(c).over(fwd.rowsBetween(*upto)),
        "min_ahead": lambda: F.min(c).over(back.rowsBetween(*upto)),
        "last": lambda: F.last(c, ignorenulls=True).over(fwd.rowsBetween(*upto)),
        "prev": lambda: F.last(c, ignorenulls=True).over(fwd.rowsBetween(*before)),
        "next": lambda: F.last(c, ignorenulls=True).over(back.rowsBetween(*before)),
        "next_or_here": lambda: F.last(c, ignorenulls=True).over(back.rowsBetween(*upto)),
        "lag": lambda: F.lag(F.struct(c.alias("v"))).over(fwd),
        "lead": lambda: F.lead(F.struct(c.alias("v"))).over(fwd),
    }[run.kind]()


def _slice_summary(run: Run, position: Column) -> Column:
    c = run.column
    if run.kind == "row_index":
        return F.count(F.lit(1))
    if run.kind in ("sum", "max", "min"):
        return getattr(F, run.kind)(c)
    if run.kind == "min_ahead":
        return F.min(c)
    if run.kind in ("last", "prev"):
        return F.max_by(c, F.when(c.isNotNull(), position))
    if run.kind in ("next", "next_or_here"):
        return F.min_by(c, F.when(c.isNotNull(), position))
    boxed = F.struct(c.alias("v"))
    return F.max_by(boxed, position) if run.kind == "lag" else F.min_by(boxed, position)


def _carry(run: Run, name: str, fwd, back) -> Column:
    frame = (fwd if run.kind in _FORWARD_CARRY else back).rowsBetween(W.unboundedPreceding, -1)
    if run.kind in ("row_index", "sum"):
        return F.sum(name).over(frame)
    if run.kind in ("max", "min"):
        return getattr(F, run.kind)(name).over(frame)
    if run.kind == "min_ahead":
        return F.min(name).over(frame)
    return F.last(name, ignorenulls=True).over(frame)


def _merge(run: Run, here: Column, carried: Column) -> Column:
    if run.kind in ("row_index", "sum"):
        return F.coalesce(here + carried, here, carried)
    if run.kind == "max":
        return F.greatest(here, carried)
    if run.kind in ("min", "min_ahead"):
        return F.least(here, carried)
    merged = F.coalesce(here, carried)
    return merged["v"] if run.kind in ("lag", "lead") else merged


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    outputs: Mapping[str, Run],
    slices: Slices | None = None,
) -> DataFrame:
    """Add running columns per group, in ascending ``order`` (nulls first).

    Kinds: ``row_index`` (from 1); ``sum``/``max``/``min`` up to here;
    ``min_ahead`` from here on; ``last`` non-null up to here, ``prev`` strictly
    before; ``next`` non-null strictly after, ``next_or_here``; ``lag`` and
    ``lead``, which keep nulls.  ``order`` must be total for a repeatable result.
    """
    slices = slices or plan_slices(df, order[0])
    # A struct key equals itself with nulls inside, so null groups join back.
    grouped = df.withColumn(_GROUP, F.struct(*keys) if keys else F.struct(F.lit(0).alias("all")))
    ranks = list(order)
    if slices.rows is not None:
        # The hash of the row splits even rows that the order does not tell apart.
        hashed = [c for c, t in df.dtypes if "map<" not in t and "variant" not in t]
        ranks.append(_TIE)
        grouped = grouped.withColumn(_TIE, F.xxhash64(*hashed))
        grouped = grouped.withColumn(_POSITION, F.struct(*ranks))
        bounds = slices.bounds(grouped, keys, order)
        if bounds is not None:
            # At most MOST_BOUNDS positions, however large the input.
            met = grouped.join(F.broadcast(bounds), _GROUP, "left")
            sliced = met.withColumn(_SLICE, F.when(F.col("_bounds").isNotNull(), _slice_number(F.col("_bounds"), F.col(_POSITION)))).drop("_bounds")
    elif slices.width is not None:
        bounds = slices
        sliced = grouped.withColumn(
            _SLICE, F.coalesce(F.floor(axis_number(df, slices.column) / F.lit(slices.width)), F.lit(-(2**62)))
        )
    else:
        bounds = None
    if bounds is None:
        fwd = W.partitionBy(*keys).orderBy(*[F.col(c).asc() for c in order])
        back = W.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
        columns = {
            name: (_inside(r, fwd, back)["v"] if r.kind in ("lag", "lead") else _inside(r, fwd, back))
            for name, r in outputs.items()
        }
        return df.withColumns(columns)

    fwd = W.partitionBy(_GROUP, _SLICE).orderBy(*[F.col(c).asc() for c in ranks])
    back = W.partitionBy(_GROUP, _SLICE).orderBy(*[F.col(c).desc() for c in ranks])
    detail = sliced.withColumns({name: _inside(r, fwd, back) for name, r in outputs.items()})

    position = F.struct(*ranks)
    summary = sliced.where(F.col(_SLICE).isNotNull()).groupBy(_GROUP, _SLICE).agg(
        *[_slice_summary(r, position).alias(name) for name, r in outputs.items()]
    )
    by_slice = W.partitionBy(_GROUP).orderBy(F.col(_SLICE).asc())
    by_slice_back = W.partitionBy(_GROUP).orderBy(F.col(_SLICE).desc())
    carried = summary.select(
        _GROUP,
        _SLICE,
        *[_carry(r, name, by_slice, by_slice_back).alias("_c_" + name) for name, r in outputs.items()],
    )
    joined = detail.join(carried, [_GROUP, _SLICE], "left")
    merged = {name: _merge(r, F.col(name), F.col("_c_" + name)) for name, r in outputs.items()}
    return joined.withColumns(merged).select(*df.columns, *outputs)
