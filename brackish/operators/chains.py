"""Chains of points: what of a line lies away from others, and new points at a spacing that varies along it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brackish.operators.ordered import Run, Slices, plan_slices, running
from brackish.session import cut_lineage

_FINEST = 40


def _filed(segments: DataFrame, reach: float) -> DataFrame:
    """Segments with their box, widened by ``reach``, and the level of cells (powers of two) as long as it."""
    w, e = F.least("x1", "x2") - reach, F.greatest("x1", "x2") + reach
    s, n = F.least("y1", "y2") - reach, F.greatest("y1", "y2") + reach
    boxed = segments.withColumns({"w": w, "e": e, "s": s, "n": n})
    extent = F.greatest(F.col("e") - F.col("w"), F.col("n") - F.col("s"))
    # Cells no finer than what a double tells apart there.
    far = F.greatest(*[F.abs(F.col(c)) for c in ("w", "e", "s", "n")], F.lit(1.0))
    level = F.when(extent > 0, F.ceil(F.log2(extent))).otherwise(-_FINEST).cast("int")
    return boxed.withColumn("level", F.greatest(level, F.lit(-_FINEST), F.ceil(F.log2(far)).cast("int") - 50))


def _cell(x: Column, level: Column) -> Column:
    return F.floor(x / F.pow(F.lit(2.0), level)).cast("long")


def meeting(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs (a, b), as structs, of filed segments whose boxes meet, each once.

    Of a pair the one of the lower level looks up the few cells it touches on the level of the other; the pair
    counts in the cell that holds the lower corner of what both boxes share.
    """
    levels = sorted({r[0] for df in (a, b) for r in df.select("level").distinct().collect()}) or [0]
    parts = []
    for small, large, strict in (("a", "b", False), ("b", "a", True)):
        here, there = (a, b) if small == "a" else (b, a)
        asked = here.withColumn("at", F.explode(F.array(*map(F.lit, levels)))).where(F.col("at") > F.col("level") if strict else F.col("at") >= F.col("level"))
        sides = []
        for name, df in ((small, asked), (large, there.withColumn("at", F.col("level")))):
            cx, cy = (F.sequence(_cell(F.col(lo), F.col("at")), _cell(F.col(hi), F.col("at"))) for lo, hi in (("w", "e"), ("s", "n")))
            spread = df.withColumn("cx", F.explode(cx)).withColumn("cy", F.explode(cy))
            sides.append(spread.select(F.struct(*[c for c in here.columns if c in df.columns] if name == small else there.columns).alias(name), "at", "cx", "cy"))
        west, south = F.greatest("a.w", "b.w"), F.greatest("a.s", "b.s")
        meet = (west <= F.least("a.e", "b.e")) & (south <= F.least("a.n", "b.n"))
        met = sides[0].join(sides[1], ["at", "cx", "cy"])
        parts.append(met.where(meet & (F.col("cx") == _cell(west, F.col("at"))) & (F.col("cy") == _cell(south, F.col("at")))).select("a", "b"))
    return parts[0].union(parts[1])


def inside_capsule(pairs: DataFrame, a: Sequence[Column], b: Sequence[Column], radius: float) -> DataFrame:
    """Add ``t0`` and ``t1``: which share of segment a (x1, y1, x2, y2) lies within ``radius`` of segment b; null where nothing does.

    What lies near a segment is convex, so it is one interval: that inside the disc at either end and that
    inside the band between them, together.  Steps are columns of their own, as each is used several times.
    """
    c = F.col
    names = [f"_{s}{k}" for s in "ab" for k in ("x1", "y1", "x2", "y2")]
    own = pairs.withColumns(dict(zip(names, [*a, *b], strict=True)))
    own = own.withColumns({"_dx": c("_ax2") - c("_ax1"), "_dy": c("_ay2") - c("_ay1"), "_ux": c("_bx2") - c("_bx1"), "_uy": c("_by2") - c("_by1")})
    own = own.withColumns({"_size": c("_dx") * c("_dx") + c("_dy") * c("_dy"), "_long": F.sqrt(c("_ux") * c("_ux") + c("_uy") * c("_uy"))})
    safe = F.nullif("_long", F.lit(0.0))
    px, py = c("_ax1") - c("_bx1"), c("_ay1") - c("_by1")
    steps = {"_along": (px * c("_ux") + py * c("_uy")) / safe, "_along_d": (c("_dx") * c("_ux") + c("_dy") * c("_uy")) / safe,
             "_across": (py * c("_ux") - px * c("_uy")) / safe, "_across_d": (c("_dy") * c("_ux") - c("_dx") * c("_uy")) / safe}
    for k in (1, 2):
        qx, qy = c("_ax1") - c(f"_bx{k}"), c("_ay1") - c(f"_by{k}")
        steps |= {f"_half{k}": (c("_dx") * qx + c("_dy") * qy) / c("_size"), f"_off{k}": (qx * qx + qy * qy - radius * radius) / c("_size")}
    own = own.withColumns(steps)

    def between(at: Column, slope: Column, low: Column, high: Column) -> list[Column]:
        """Where at + t slope lies from low to high: from, to; everywhere or nowhere if it does not change."""
        first, last, endless = F.try_divide(low - at, slope), F.try_divide(high - at, slope), F.lit(float("inf"))
        everywhere = (slope == 0) & (at >= low) & (at <= high)
        return [F.when(everywhere, -endless).otherwise(F.least(first, last)), F.when(everywhere, endless).otherwise(F.greatest(first, last))]

    one, two = between(c("_along"), c("_along_d"), F.lit(0.0), c("_long")), between(c("_across"), c("_across_d"), F.lit(-radius), F.lit(radius))
    roots = {f"_root{k}": F.sqrt(F.when(c(f"_half{k}") * c(f"_half{k}") >= c(f"_off{k}"), c(f"_half{k}") * c(f"_half{k}") - c(f"_off{k}"))) for k in (1, 2)}
    own = own.withColumns({"_l0": one[0], "_l1": one[1], "_w0": two[0], "_w1": two[1], **roots})
    known = c("_l0").isNotNull() & c("_w0").isNotNull()
    own = own.withColumns({"_b0": F.when(known, F.greatest("_l0", "_w0")), "_b1": F.when(known, F.least("_l1", "_w1"))})
    band = c("_b0") <= c("_b1")
    own = own.withColumns({
        "_t0": F.greatest(F.least(F.when(band, c("_b0")), -c("_half1") - c("_root1"), -c("_half2") - c("_root2")), F.lit(0.0)),
        "_t1": F.least(F.greatest(F.when(band, c("_b1")), c("_root1") - c("_half1"), c("_root2") - c("_half2")), F.lit(1.0)),
    })
    # Without any of the three both are what the segment itself ends at.
    some = band | c("_root1").isNotNull() | c("_root2").isNotNull()
    near = some & (c("_t0") < c("_t1"))
    return own.select(*pairs.columns, F.when(near, c("_t0")).alias("t0"), F.when(near, c("_t1")).alias("t1"))


def away_from(lines: DataFrame, others: DataFrame, line: str, order: str, radius: float, least: float = 0.0) -> DataFrame:
    """The parts of ``lines`` farther than ``radius`` from any of ``others``: line, piece, order, from, to, x1, y1, x2, y2, length, piece_length.

    Both hold segments x1, y1, x2, y2; those of a line follow each other by ``order``.  Of each segment the shares near
    other segments are exact, and their union is found with a running maximum.  What is left joins over the
    ends of segments that meet into pieces, and pieces shorter than ``least`` are dropped.  Segments without length or with a null or
    non-finite end are left out, as are such of ``others`` but for those without length, which are points.
    """
    ends = ("x1", "y1", "x2", "y2")
    plain = lambda df, *more: df.select(*more, *[F.col(c).cast("double").alias(c) for c in ends]).where(F.greatest(*[F.abs(c) for c in ends]) < float("inf")).where(" and ".join(f"{c} is not null" for c in ends))
    own = plain(lines, line, order).where((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))
    own = cut_lineage(own.withColumn("_id", F.monotonically_increasing_id()))
    length = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    pairs = meeting(_filed(own.select("_id", *ends), radius), _filed(plain(others).distinct(), 0.0))
    shares = inside_capsule(pairs, [F.col(f"a.{c}") for c in ends], [F.col(f"b.{c}") for c in ends], radius)
    near = shares.select(F.col("a._id").alias("_id"), "t0", "t1")
    # An empty share at the end of each segment closes what is left of it.  The test for null comes after the
    # checkpoint: the planner would else write all steps into it, over and over.
    marked = cut_lineage(near.union(own.select("_id", F.lit(1.0), F.lit(1.0)))).where("t0 is not null")
    upto = running(marked, ["_id"], ["t0", "t1"], {"before": Run("lag", F.col("t1")), "reached": Run("max", F.col("t1"))}, plan_slices(marked, "t0"))
    upto = running(upto, ["_id"], ["t0", "t1"], {"open": Run("lag", F.col("reached"))}, plan_slices(marked, "t0"))
    start = F.coalesce("open", F.lit(0.0))
    left = upto.where(start < F.col("t0")).select("_id", start.alias("from"), F.col("t0").alias("to")).distinct()
    parts = left.join(own, "_id").withColumn("length", (F.col("to") - F.col("from")) * length)
    at = lambda a, b, t: F.col(a) + F.col(t) * (F.col(b) - F.col(a))
    placed = parts.select(
        line, order, "from", "to", at("x1", "x2", "from").alias("_x1"), at("y1", "y2", "from").alias("_y1"), at("x1", "x2", "to").alias("_x2"), at("y1", "y2", "to").alias("_y2"), "length"
    )
    placed = cut_lineage(placed)
    slices = plan_slices(placed, order)
    chained = running(placed, [line], [order, "from"], {"_px": Run("lag", F.col("_x2")), "_py": Run("lag", F.col("_y2")), "_pt": Run("lag", F.col("to"))}, slices)
    new = F.when((F.col("from") == 0) & (F.col("_pt") == 1) & (F.col("_px") == F.col("_x1")) & (F.col("_py") == F.col("_y1")), 0).otherwise(1)
    pieces = cut_lineage(running(chained.withColumn("_new", new), [line], [order, "from"], {"piece": Run("sum", F.col("_new"))}, slices))
    sums = pieces.groupBy(line, "piece").agg(F.sum("length").alias("piece_length")).where(F.col("piece_length") >= least)
    kept = pieces.join(sums.select(F.col(line).alias("_line"), F.col("piece").alias("_piece"), "piece_length"), F.col(line).eqNullSafe(F.col("_line")) & (F.col("piece") == F.col("_piece")))
    return kept.select(line, "piece", order, "from", "to", *[F.col(f"_{c}").alias(c) for c in ends], "length", "piece_length")


def respaced(df: DataFrame, keys: Sequence[str], order: str, x: str, y: str, spacing: str, slices: Slices | None = None) -> DataFrame:
    """New points along each chain at a spacing that follows ``spacing``: keys, n (from 0), x, y, along.

    The number of steps that a chain needs is the integral of 1 / spacing along it, where 1 / spacing changes evenly between points; it is rounded
    up, so that no step is longer than asked for, and the points lie at equal shares of the integral.  Both ends stay.  Points with a null or
    non-finite place or a spacing that is not above zero are left out; a chain of one place has one point.
    """
    finite = F.greatest(*[F.abs(F.col(c).cast("double")) for c in (x, y, spacing)]) < float("inf")
    good = df.select(*keys, order, *[F.col(c).cast("double").alias(n) for c, n in ((x, "_x"), (y, "_y"), (spacing, "_h"))]).where(
        finite & F.col("_x").isNotNull() & F.col("_y").isNotNull() & (F.col("_h") > 0)
    )
    slices = slices or plan_slices(good, order)
    total_order = [order, "_x", "_y", "_h"]
    here = running(good, keys, total_order, {"_px": Run("lag", F.col("_x")), "_py": Run("lag", F.col("_y")), "_ph": Run("lag", F.col("_h"))}, slices)
    step = F.coalesce(F.hypot(F.col("_x") - F.col("_px"), F.col("_y") - F.col("_py")), F.lit(0.0))
    needed = F.coalesce(step * (1 / F.col("_ph") + 1 / F.col("_h")) / 2, F.lit(0.0))
    summed = running(here.withColumns({"_d": step, "_c": needed}), keys, total_order, {"_s": Run("sum", F.col("_d")), "_n": Run("sum", F.col("_c"))}, slices)
    group = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    summed = cut_lineage(summed.withColumn("_chain", group))
    totals = summed.groupBy("_chain").agg(F.max("_n").alias("_all")).withColumn("_steps", F.greatest(F.ceil(F.col("_all") - 1e-9), F.when(F.col("_all") > 0, 1).otherwise(0)))
    met = summed.join(totals, "_chain")
    unit = F.try_divide(F.col("_all"), F.col("_steps"))
    first, last = F.floor(F.try_divide(F.col("_n") - F.col("_c"), unit) + 1e-9) + 1, F.floor(F.try_divide(F.col("_n"), unit) + 1e-9)
    # The first point of a chain has none before it; the others carry the points of the stretch that they end.
    numbers = F.when(F.col("_px").isNull(), F.array(F.lit(0).cast("long"))).when((F.col("_c") > 0) & (last >= first), F.sequence(first, last)).otherwise(F.array().cast("array<long>"))
    each = met.withColumn("n", F.explode(numbers))
    rest = F.coalesce(F.greatest(F.col("n") * unit - (F.col("_n") - F.col("_c")), F.lit(0.0)), F.lit(0.0))
    slope = F.try_divide(1 / F.col("_h") - 1 / F.col("_ph"), F.col("_d"))
    far = 2 * rest / (1 / F.col("_ph") + F.sqrt(F.greatest(1 / (F.col("_ph") * F.col("_ph")) + 2 * rest * slope, F.lit(0.0))))
    share = F.coalesce(F.least(F.try_divide(far, F.col("_d")), F.lit(1.0)), F.lit(1.0))
    back = 1 - share
    place = lambda p, c: F.col(c) - back * (F.col(c) - F.coalesce(F.col(p), F.col(c)))
    return each.select(*keys, "n", place("_px", "_x").alias("x"), place("_py", "_y").alias("y"), (F.col("_s") - back * F.col("_d")).alias("along"))
