"""Time expressions.  Times are zone-less and mean UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
MJD_UNIX_EPOCH = 40587  # fixed value: 1970-01-01 as a Modified Julian Day


def micros(t: Column) -> Column:
    return F.unix_micros(t.cast("timestamp"))


def from_micros(m: Column) -> Column:
    return F.timestamp_micros(m.cast("long")).cast("timestamp_ntz")


def from_seconds(s: Column) -> Column:
    return from_micros(F.rint(s * float(MICROS_PER_SECOND)))


def seconds_between(later: Column, earlier: Column) -> Column:
    return (micros(later) - micros(earlier)) / float(MICROS_PER_SECOND)


def floor_to_step(t: Column, step_seconds: int) -> Column:
    m, step = micros(t), F.lit(step_seconds * MICROS_PER_SECOND)
    return from_micros(m - F.pmod(m, step))


def ceil_to_step(t: Column, step_seconds: int) -> Column:
    """First epoch-aligned step at or after ``t``."""
    m, step = micros(t), F.lit(step_seconds * MICROS_PER_SECOND)
    return from_micros(m + F.pmod(-m, step))


def steps_within(start: Column, end_exclusive: Column, step_seconds: int) -> Column:
    """Array of epoch-aligned times in [start, end); empty when none fall inside."""
    step = step_seconds * MICROS_PER_SECOND
    first = micros(ceil_to_step(start, step_seconds))
    last = micros(end_exclusive) - F.lit(1)
    return F.when(
        first <= last, F.transform(F.sequence(first, last, F.lit(step)), from_micros)
    ).otherwise(F.array().cast("array<timestamp_ntz>"))


def snapped_micros(t: Column, cadence_seconds: int, phase_seconds: int = 0) -> Column:
    """Nearest step of the cadence, ties to even."""
    step, phase = cadence_seconds * MICROS_PER_SECOND, phase_seconds * MICROS_PER_SECOND
    return (F.rint((micros(t) - phase) / float(step)) * float(step) + phase).cast("long")


def snap(t: Column, cadence_seconds: int, tolerance_seconds: float, phase_seconds: int = 0) -> Column:
    """Move a time to the cadence if it lies within the tolerance, else keep it."""
    nominal = snapped_micros(t, cadence_seconds, phase_seconds)
    near = F.abs(micros(t) - nominal) <= F.lit(tolerance_seconds * MICROS_PER_SECOND)
    return F.when(near, from_micros(nominal)).otherwise(t)


def snap_offset_seconds(t: Column, cadence_seconds: int, tolerance_seconds: float, phase_seconds: int = 0) -> Column:
    offset = (micros(t) - snapped_micros(t, cadence_seconds, phase_seconds)) / float(MICROS_PER_SECOND)
    return F.when(F.abs(offset) <= tolerance_seconds, offset).otherwise(F.lit(0.0))


def to_mjd(t: Column) -> Column:
    return micros(t) / 86400e6 + F.lit(float(MJD_UNIX_EPOCH))


def from_mjd(d: Column) -> Column:
    return from_seconds((d - float(MJD_UNIX_EPOCH)) * 86400.0)


def mjd_day(t: Column) -> Column:
    """Whole days of the Modified Julian Day."""
    return (F.floor(micros(t) / 86400e6) + MJD_UNIX_EPOCH).cast("int")


def millis_of_day(t: Column) -> Column:
    return F.pmod(F.unix_millis(t.cast("timestamp")), F.lit(86400000)).cast("int")


def from_day_and_millis(day: Column, millis: Column) -> Column:
    return from_micros((day.cast("long") - MJD_UNIX_EPOCH) * 86400000000 + millis.cast("long") * 1000)


def parse_utc(text: Column) -> Column:
    """ISO 8601 text that states UTC; text without a zone is refused (null)."""
    zoned = text.rlike(r"(Z|[+-]00:?00)$")
    bare = F.regexp_replace(text, r"(Z|[+-]00:?00)$", "")
    return F.when(zoned, bare.try_cast("timestamp_ntz"))


def parse_any(text: Column, formats: tuple[str, ...] = ()) -> Column:
    """First reading that works: ISO, then each given pattern."""
    plain = F.regexp_replace(F.trim(text), r"(Z|[+-]00:?00)$", "")
    readings = [plain.try_cast("timestamp_ntz")]
    readings += [F.try_to_timestamp(plain, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*readings)


def from_cf(value: Column, unit: str, origin: str) -> Column:
    """``value unit since origin``."""
    seconds = {"seconds": 1.0, "minutes": 60.0, "hours": 3600.0, "days": 86400.0}[unit]
    return from_micros(micros(F.lit(origin).cast("timestamp_ntz")) + F.rint(value * (seconds * 1e6)))


def decode_time(
    text: Column | None, day: Column | None, millis: Column | None, mjd: Column | None, text_first: bool = True
) -> Column:
    """Whichever time encoding a record carries, in the reader's order of trust."""
    whole = from_day_and_millis(day, millis) if day is not None else None
    number = from_mjd(mjd) if mjd is not None else None
    written = parse_any(text) if text is not None else None
    order = [written, number, whole] if text_first else [written, whole, number]
    return F.coalesce(*[c for c in order if c is not None])


def month_pieces(start: Column, end: Column) -> Column:
    """Cut [start, end] days into calendar months: array of (first_day, last_day)."""
    first, last = F.to_date(start), F.to_date(end)
    months = F.sequence(F.trunc(first, "MM"), last, F.expr("interval 1 month"))
    return F.transform(
        months,
        lambda m: F.struct(
            F.greatest(m, first).alias("first_day"), F.least(F.last_day(m), last).alias("last_day")
        ),
    )


def padded_prefixes(start: Column, end: Column, root: str) -> Column:
    """Daily then monthly folder prefixes for the window padded by a day each side."""
    first, last = F.date_sub(F.to_date(start), 1), F.date_add(F.to_date(end), 1)
    daily = F.transform(
        F.sequence(first, last), lambda d: F.concat(F.lit(root), F.date_format(d, "yyyy/MM/dd"), F.lit("/"))
    )
    monthly = F.transform(
        F.sequence(F.trunc(first, "MM"), last, F.expr("interval 1 month")),
        lambda d: F.concat(F.lit(root), F.date_format(d, "yyyyMM"), F.lit("/")),
    )
    return F.concat(daily, monthly)
