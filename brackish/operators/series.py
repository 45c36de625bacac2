"""Time-series operators: grids, gaps, islands, filling, resampling, as-of."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brackish.functions.timeaxis import floor_to_step, from_micros, micros, snap, snap_offset_seconds, steps_within
from brackish.operators.dedupe import earliest_source
from brackish.operators.metrics import same_keys
from brackish.operators.ordered import Run, Slices, axis_number, plan_slices, running
from brackish.operators.quantiles import with_quantiles


def time_grid(bounds: DataFrame, keys: Sequence[str], start: str, end: str, step_seconds: int, out: str = "t") -> DataFrame:
    """Every epoch-aligned step in [start, end) of each row of ``bounds``.

    A long span is opened day by day and then step by step, so no row carries an
    array longer than a day of steps and the second explode runs on many tasks.
    """
    day = 86400
    if step_seconds >= day:
        return bounds.select(*keys, F.explode(steps_within(F.col(start), F.col(end), step_seconds)).alias(out))
    first = F.greatest(F.col("_d"), micros(F.col(start)))
    last = F.least(F.col("_d") + day * 1_000_000, micros(F.col(end)))
    begin = micros(F.col(start))
    days = F.sequence(
        begin - F.pmod(begin, F.lit(day * 1_000_000)), micros(F.col(end)), F.lit(day * 1_000_000)
    )
    opened = bounds.select(*keys, start, end, F.explode(days).alias("_d"))
    return opened.where(first < last).select(
        *keys, F.explode(steps_within(from_micros(first), from_micros(last), step_seconds)).alias(out)
    )


def regular_axis(
    df: DataFrame, keys: Sequence[str], time: str, value: str, step_seconds: int, grid: DataFrame, slices: Slices | None = None
) -> DataFrame:
    """Records on a complete axis: the last record of a step wins, gaps are filled in time, ends held."""
    placed = df.groupBy(*keys, floor_to_step(F.col(time), step_seconds).alias(time)).agg(F.max_by(value, F.col(time)).alias(value))
    return fill_line(grid.join(placed, [*keys, time], "left"), keys, time, value, "filled", slices)


def axis_regularity(df: DataFrame, keys: Sequence[str], position: str, tolerance: float, slices: Slices | None = None) -> DataFrame:
    """Smallest and largest step of each axis, and whether they agree."""
    at = axis_number(df, position)
    stepped = running(df.select(*keys, position).distinct(), keys, [position], {"_prev": Run("lag", F.col(position))}, slices)
    step = at - axis_number(stepped, "_prev")
    out = stepped.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(step).alias("shortest"), F.max(step).alias("longest"))
    return out.withColumn("regular", F.coalesce(F.col("longest") - F.col("shortest") <= tolerance, F.lit(False)))


def missing_times(grid: DataFrame, available: DataFrame, on: Sequence[str]) -> DataFrame:
    """Expected times nothing was delivered for."""
    return grid.join(available.select(*on), list(on), "left_anti")


def snapped(df: DataFrame, time: str, cadence_seconds: int, tolerance_seconds: float, phase_seconds: int = 0) -> DataFrame:
    t = F.col(time)
    return df.withColumns(
        {
            "snapped": snap(t, cadence_seconds, tolerance_seconds, phase_seconds),
            "offset_seconds": snap_offset_seconds(t, cadence_seconds, tolerance_seconds, phase_seconds),
        }
    )


def load_series(
    files: Sequence[DataFrame], keys: Sequence[str], time: str, cadence_seconds: int,
    tolerance_seconds: float, start: Column, end: Column, phase_seconds: int = 0,
) -> DataFrame:
    """Union of files in order, snapped, earliest file kept at a doubled time, cropped to [start, end)."""
    schema = files[0].schema
    for f in files[1:]:
        if f.schema.simpleString() != schema.simpleString():
            raise ValueError("files of one series must share a schema")
    merged = None
    for i, f in enumerate(files):
        one = f.withColumn("source_file", F.lit(i))
        merged = one if merged is None else merged.unionByName(one)
    timed = merged.withColumn(time, snap(F.col(time), cadence_seconds, tolerance_seconds, phase_seconds))
    window = timed.where((F.col(time) >= start) & (F.col(time) < end))
    return earliest_source(window, keys, time, [F.col("source_file")])


def islands(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], flag: Column, slices: Slices | None = None
) -> DataFrame:
    """Number the runs of equal ``flag`` along the order, from 1."""
    slices = slices or plan_slices(df, order[0])
    marked = df.withColumn("_flag", F.coalesce(flag, F.lit(False)))
    changed = running(marked, keys, order, {"_was": Run("lag", F.col("_flag"))}, slices)
    step = F.when(F.col("_was").isNull() | (F.col("_was") != F.col("_flag")), 1).otherwise(0)
    numbered = running(changed.withColumn("_step", step), keys, order, {"island": Run("sum", F.col("_step"))}, slices)
    return numbered.withColumn("in_run", F.col("_flag")).drop("_flag", "_was", "_step")


def run_lengths(df: DataFrame, keys: Sequence[str], order: Sequence[str], flag: Column, slices=None) -> DataFrame:
    """One row per run where ``flag`` holds: first and last position, and length."""
    return (
        islands(df, keys, order, flag, slices)
        .where("in_run")
        .groupBy(*keys, "island")
        .agg(F.min(order[0]).alias("first"), F.max(order[0]).alias("last"), F.count(F.lit(1)).alias("length"))
    )


def longest_run(df: DataFrame, keys: Sequence[str], order: Sequence[str], flag: Column, slices=None) -> DataFrame:
    runs = run_lengths(df, keys, order, flag, slices).groupBy(*keys).agg(F.max("length").alias("longest"))
    everyone = df.select(*keys).distinct() if keys else df.agg(F.count(F.lit(1)).alias("_n")).select()
    if not keys:
        return runs.select(F.coalesce("longest", F.lit(0)).alias("longest"))
    return same_keys(everyone, runs, keys, "left").withColumn("longest", F.coalesce("longest", F.lit(0)))


def consecutive_chunks(df: DataFrame, number: str, size: int) -> DataFrame:
    """Split a distinct integer column into runs of consecutive values, at most ``size`` long."""
    rows = running(df.select(number).distinct(), [], [number], {"_i": Run("row_index")})
    rows = rows.withColumn("_run", F.col(number) - F.col("_i"))
    first = rows.groupBy("_run").agg(F.min(number).alias("_first"))
    piece = F.floor((F.col(number) - F.col("_first")) / F.lit(size))
    return (
        rows.join(first, "_run")
        .groupBy("_first", piece.alias("_piece"))
        .agg(F.min(number).alias("first"), F.max(number).alias("last"), F.count(F.lit(1)).alias("n"))
        .select("first", "last", "n")
    )


def fill_gaps(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, limit: int | None,
    mode: str = "first_n", out: str = "filled", slices: Slices | None = None,
) -> DataFrame:
    """Fill nulls on a line by row position between the known neighbours.

    ``first_n`` fills the first ``limit`` rows of every gap and carries the last
    value into a trailing gap; ``whole_gap`` fills only gaps of at most ``limit``
    rows and leaves longer ones alone.  Leading gaps stay null.
    """
    slices = slices or plan_slices(df, order[0])
    v = F.col(value)
    numbered = running(df, keys, order, {"_i": Run("row_index")}, slices)
    known = F.when(v.isNotNull(), F.struct(F.col("_i").alias("i"), v.alias("v")))
    sided = running(numbered, keys, order, {"_p": Run("last", known), "_n": Run("next_or_here", known)}, slices)
    i, p, n = F.col("_i"), F.col("_p"), F.col("_n")
    line = p["v"] + (n["v"] - p["v"]) * F.try_divide((i - p["i"]).cast("double"), (n["i"] - p["i"]).cast("double"))
    guess = F.when(n.isNull(), p["v"]).otherwise(line)
    if limit is None:
        allowed = F.lit(True)
    elif mode == "first_n":
        allowed = i - p["i"] <= limit
    elif mode == "whole_gap":
        allowed = n.isNotNull() & (n["i"] - p["i"] - 1 <= limit)
    else:
        raise ValueError("mode must be first_n or whole_gap")
    return sided.withColumn(out, F.coalesce(v, F.when(allowed, guess))).drop("_i", "_p", "_n")


def fill_line(
    df: DataFrame, keys: Sequence[str], position: str, value: str, out: str = "filled", slices: Slices | None = None
) -> DataFrame:
    """Fill nulls linearly along ``position``, holding the end values; one known value fills all."""
    at = axis_number(df, position)
    known = F.when(F.col(value).isNotNull(), F.struct(at.alias("x"), F.col(value).alias("v")))
    sided = running(df, keys, [position], {"_p": Run("last", known), "_n": Run("next_or_here", known)}, slices)
    return sided.withColumn(out, F.coalesce(F.col(value), on_line(at, F.col("_p"), F.col("_n")))).drop("_p", "_n")


def on_line(at: Column, before: Column, after: Column, hold_ends: bool = True) -> Column:
    """Value at ``at`` between two (x, v) structs."""
    share = F.try_divide((at - before["x"]).cast("double"), (after["x"] - before["x"]).cast("double"))
    between = F.when(share.isNull(), before["v"]).otherwise(before["v"] + (after["v"] - before["v"]) * share)
    inside = F.when(before.isNotNull() & after.isNotNull(), between)
    return F.coalesce(inside, before["v"], after["v"]) if hold_ends else inside


def interpolate_at(
    targets: DataFrame, source: DataFrame, keys: Sequence[str], position: str, value: str,
    out: str = "value", hold_ends: bool = False, max_gap: float | None = None, slices: Slices | None = None,
) -> DataFrame:
    """Linear value of each source series at the target positions.

    Both sides are laid on one axis and the neighbours carried over, so there is
    no join product: one shuffle of narrow rows, whatever the number of targets.
    ``max_gap`` (in axis units, microseconds for times) refuses wide brackets;
    positions outside the series are null unless ``hold_ends``.
    """
    at = axis_number(source, position)
    pair = F.struct(at.alias("x"), F.col(value).cast("double").alias("v"))
    rows = source.select(
        *keys, position, F.when(F.col(value).isNotNull(), pair).alias("_pair"), F.lit(0).alias("_side"),
        F.lit(None).cast("struct<" + ",".join(f"`{c}`:{t}" for c, t in targets.dtypes) + ">").alias("_row"),
    )
    wanted = targets.select(
        *keys, position, F.lit(None).cast("struct<x:" + ("bigint" if _is_time(source, position) else "double") + ",v:double>").alias("_pair"),
        F.lit(1).alias("_side"), F.struct(*targets.columns).alias("_row"),
    )
    both = rows.unionByName(wanted)
    sided = running(
        both, keys, [position, "_side"],
        {"_before": Run("last", F.col("_pair")), "_after": Run("next", F.col("_pair"))}, slices,
    )
    before, after = F.col("_before"), F.col("_after")
    here = axis_number(both, position)
    exact = before["x"] == here
    result = F.when(exact, before["v"]).otherwise(on_line(here, before, after, hold_ends))
    if max_gap is not None:
        result = F.when(exact | (after["x"] - before["x"] <= max_gap), result)
    return sided.where("_side = 1").select("_row.*", result.alias(out))


def _is_time(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName().startswith(("timestamp", "date"))


def asof_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, carry: Sequence[str],
    right_order: Sequence[str] = (), slices: Slices | None = None,
) -> DataFrame:
    """Each left row with the latest right row at or before its time (ties: last in ``right_order``)."""
    row_type = "struct<" + ",".join(f"`{c}`:{t}" for c, t in left.dtypes) + ">"
    right_type = "struct<" + ",".join(f"`{c}`:{dict(right.dtypes)[c]}" for c in carry) + ">"
    tie = F.struct(*right_order) if right_order else F.struct(F.lit(0).alias("none"))
    tie_type = (
        "struct<" + ",".join(f"`{c}`:{dict(right.dtypes)[c]}" for c in right_order) + ">"
        if right_order else "struct<none:int>"
    )
    rows = right.select(
        *keys, time, F.struct(*carry).alias("_right"), F.lit(None).cast(row_type).alias("_row"),
        F.lit(0).alias("_side"), tie.alias("_tie"),
    )
    wanted = left.select(
        *keys, time, F.lit(None).cast(right_type).alias("_right"), F.struct(*left.columns).alias("_row"),
        F.lit(1).alias("_side"), F.lit(None).cast(tie_type).alias("_tie"),
    )
    merged = running(
        rows.unionByName(wanted), keys, [time, "_side", "_tie"], {"_match": Run("last", F.col("_right"))}, slices
    )
    return merged.where("_side = 1").select("_row.*", *[F.col("_match")[c].alias(c) for c in carry])


def daily_to_hourly(
    df: DataFrame, keys: Sequence[str], day: str, value: str, targets: DataFrame, out: str = "value", slices: Slices | None = None
) -> DataFrame:
    """Daily values placed at noon, linear in time, ends held."""
    noon = df.withColumn("t", F.col(day).cast("timestamp_ntz") + F.expr("interval 12 hours")).select(*keys, "t", value)
    return interpolate_at(targets, noon, keys, "t", value, out, hold_ends=True, slices=slices)


def cadence(df: DataFrame, keys: Sequence[str], time: str, **sizing) -> DataFrame:
    """Median step per series in microseconds."""
    stepped = running(df.select(*keys, time), keys, [time], {"_prev": Run("lag", F.col(time))})
    step = micros(F.col(time)) - micros(F.col("_prev"))
    q = with_quantiles(stepped, keys, step, [0.5], rows=sizing.pop("rows", None) or df.count(), **sizing)
    return q.select(*keys, F.floor(F.col("quantiles")[0]).alias("cadence_us"))


def wide_gaps(df: DataFrame, keys: Sequence[str], time: str, factor: float = 3.0, **sizing) -> DataFrame:
    """Steps longer than ``factor`` times the median step of their series."""
    stepped = running(df.select(*keys, time), keys, [time], {"gap_start": Run("lag", F.col(time))})
    stepped = stepped.withColumn("_step", micros(F.col(time)) - micros(F.col("gap_start")))
    q = with_quantiles(stepped, keys, F.col("_step"), [0.5], rows=sizing.pop("rows", None) or df.count(), **sizing)
    median = q.select(*keys, F.floor(F.col("quantiles")[0]).alias("cadence_us"))
    joined = same_keys(stepped, median, keys)
    return joined.where(F.col("_step") > F.col("cadence_us") * factor).select(
        *keys, "gap_start", F.col(time).alias("gap_end"), (F.col("_step") / 1e6).alias("gap_seconds"),
        (F.col("cadence_us") / 1e6).alias("cadence_seconds"),
    )


def block_means(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, block: int, slices: Slices | None = None
) -> DataFrame:
    """Mean of every ``block`` rows; stamped with the row in the middle; a rest block is kept."""
    numbered = running(df, keys, order, {"_i": Run("row_index")}, slices)
    numbered = numbered.withColumns(
        {"block": F.floor((F.col("_i") - 1) / F.lit(block)), "_at": F.pmod(F.col("_i") - 1, F.lit(block))}
    )
    sized = numbered.groupBy(*keys, "block").agg(
        F.avg(value).alias("mean"),
        F.count(F.lit(1)).alias("rows"),
        F.sort_array(F.collect_list(F.struct("_at", order[0]))).alias("_stamps"),
    )
    return sized.withColumn("stamp", F.col("_stamps")[F.floor(F.col("rows") / 2).cast("int")][order[0]]).drop("_stamps")


def running_integral(df: DataFrame, keys: Sequence[str], time: str, rate: Column, slices: Slices | None = None) -> DataFrame:
    """Running sum of rate times the seconds since the previous record."""
    slices = slices or plan_slices(df, time)
    stepped = running(df, keys, [time], {"_prev": Run("lag", F.col(time))}, slices)
    seconds = (micros(F.col(time)) - micros(F.coalesce("_prev", time))) / 1e6
    part = stepped.withColumn("_part", rate * seconds)
    return running(part, keys, [time], {"cumulative": Run("sum", F.col("_part"))}, slices).drop("_prev", "_part")


def every_nth(df: DataFrame, order: Sequence[str], n: int, most: int | None = None, slices=None) -> DataFrame:
    """Every ``n``-th record in order, then evenly spaced down to at most ``most``."""
    slices = slices or plan_slices(df, order[0])
    kept = running(df, [], order, {"_i": Run("row_index")}, slices).where(F.pmod(F.col("_i") - 1, F.lit(n)) == 0)
    kept = kept.withColumn("frame", F.floor((F.col("_i") - 1) / F.lit(n))).drop("_i")
    if most is None:
        return kept
    total = df.count()
    frames = -(-total // n)
    if frames <= most:
        return kept
    # Position k survives if it is the rounded image of some j in 0..most-1.
    step = (frames - 1) / (most - 1)
    j = F.rint(F.col("frame") / F.lit(step))
    hit = None
    for shift in (-1, 0, 1):
        image = F.rint((j + shift) * F.lit(step)) == F.col("frame")
        valid = (j + shift).between(0, most - 1)
        hit = (image & valid) if hit is None else hit | (image & valid)
    return kept.where(hit)


def time_audit(
    records: DataFrame, grid: DataFrame, keys: Sequence[str], time: str, offset: str
) -> DataFrame:
    """Expected, delivered, missing and doubled times per series, and the largest snap."""
    per_time = records.groupBy(*keys, time).agg(F.count(F.lit(1)).alias("_n"), F.max(F.abs(offset)).alias("_off"))
    both = grid.select(*keys, time, F.lit(1).alias("_want")).join(per_time, [*keys, time], "full")
    return both.groupBy(*keys).agg(
        F.count("_want").alias("expected"),
        F.count("_n").alias("delivered"),
        F.count_if(F.col("_n").isNull()).alias("missing"),
        F.count_if(F.col("_n") > 1).alias("doubled"),
        F.count_if(F.col("_want").isNull()).alias("unexpected"),
        F.max("_off").alias("largest_offset"),
    )


def repair_axes(
    df: DataFrame, value: str, passes: Sequence[tuple[Sequence[str], str, int]], unresolved: str = "keep"
) -> DataFrame:
    """Fill nulls along several axes in turn, with the code of the axis that filled each.

    ``passes`` lists (keys of a line, position, code), for instance time, then
    depth, then along an arc.  Rounds repeat until one fills nothing.  Values that
    no line can fill then stay null, or stop the job with ``unresolved="stop"``.
    """
    from brackish.session import cut_lineage

    work = cut_lineage(df.withColumn("repair_code", F.lit(0)))
    left = work.where(F.col(value).isNull()).count()
    cuts = {position: plan_slices(work, position) for _, position, _ in passes}
    while left:
        for keys, position, code in passes:
            filled = fill_line(work, keys, position, value, "_new", cuts[position])
            work = filled.withColumns(
                {
                    "repair_code": F.when(
                        F.col(value).isNull() & F.col("_new").isNotNull(), F.lit(code)
                    ).otherwise(F.col("repair_code")),
                    value: F.col("_new"),
                }
            ).drop("_new")
        work = cut_lineage(work)
        now = work.where(F.col(value).isNull()).count()
        if now == left:
            break
        left = now
    if left and unresolved == "stop":
        raise ValueError(f"{left} values of {value} cannot be filled along any axis")
    return work


def matches(expected: Mapping[str, str], df: DataFrame) -> bool:
    """Do the columns have the expected simple types?"""
    have = dict(df.dtypes)
    return all(have.get(name) == kind for name, kind in expected.items())
