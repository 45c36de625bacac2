"""Regular-grid operators on long tables: one row per cell (j, i)."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brackish.functions.geo import degree_cell_area_m2
from brackish.operators.nearest import k_nearest
from brackish.operators.ordered import Run, Slices, running
from brackish.session import cut_lineage, cut_rounds

GRAVITY = 9.807  # fixed value
BLOCK_CELLS = 1 << 20  # cells of a block that one task settles at a time
LONGEST_BLOCK = 1 << 14  # cells along a narrow block


def bilinear(
    points: DataFrame, grid: DataFrame, point_id: str, xy: tuple[str, str], origin: tuple[float, float],
    step: tuple[float, float], shape: tuple[int, int], values: Sequence[str], edge: str = "null",
    active: str | None = None,
) -> DataFrame:
    """Bilinear values at points from a grid with ``i`` along x and ``j`` along y.

    Outside the grid: ``null``, ``clamp`` (nearest edge) or ``extrapolate``.  With
    an ``active`` flag the weights are renormalised over active corners, and
    ``supported`` says whether there was one; otherwise a null corner gives null.
    Four corner rows per point meet the grid in one equi-join.
    """
    nx, ny = shape
    gx = (F.col(xy[0]) - origin[0]) / step[0]
    gy = (F.col(xy[1]) - origin[1]) / step[1]
    if edge == "clamp":
        gx = F.least(F.greatest(gx, F.lit(0.0)), F.lit(float(nx - 1)))
        gy = F.least(F.greatest(gy, F.lit(0.0)), F.lit(float(ny - 1)))
    placed = points.withColumns({"_gx": gx, "_gy": gy})
    i0 = F.least(F.greatest(F.floor("_gx"), F.lit(0)), F.lit(nx - 2))
    j0 = F.least(F.greatest(F.floor("_gy"), F.lit(0)), F.lit(ny - 2))
    placed = placed.withColumns({"_i0": i0, "_j0": j0})
    fx, fy = F.col("_gx") - F.col("_i0"), F.col("_gy") - F.col("_j0")
    inside = fx.between(0, 1) & fy.between(0, 1)
    corner = lambda di, dj, w: F.struct(
        (F.col("_i0") + di).cast("long").alias("i"), (F.col("_j0") + dj).cast("long").alias("j"), w.alias("w")
    )
    corners = F.array(
        corner(0, 0, (1.0 - fx) * (1.0 - fy)), corner(1, 0, fx * (1.0 - fy)),
        corner(0, 1, (1.0 - fx) * fy), corner(1, 1, fx * fy),
    )
    reach = placed if edge == "extrapolate" else placed.where(inside)
    spread = reach.select(F.col(point_id), F.inline(corners))
    cells = grid.select(
        F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), *values, *([active] if active else [])
    )
    met = spread.join(cells, ["i", "j"])
    if active:
        on = F.col(active) & (F.col("w") > 0)
        agg = [
            F.try_divide(F.sum(F.when(on, F.col("w") * F.col(v))), F.nullif(F.sum(F.when(on, F.col("w"))), F.lit(0.0))).alias(v)
            for v in values
        ]
        agg.append(F.bool_or(on).alias("supported"))
    else:
        agg = [F.when(F.count(v) == 4, F.sum(F.col("w") * F.col(v))).alias(v) for v in values]
    result = met.groupBy(point_id).agg(*agg)
    keep = [c for c in points.columns if c not in values]
    out = points.select(*keep).join(result, point_id, "left")
    return out.withColumn("supported", F.coalesce("supported", F.lit(False))) if active else out


def nearest_cell(points: DataFrame, xy: tuple[str, str], origin, step, shape) -> DataFrame:
    """Nearest grid line on each axis (ties to the lower index)."""
    def index(c, o, s, n):
        return F.least(F.greatest(F.ceil((F.col(c) - o) / s - 0.5), F.lit(0)), F.lit(n - 1)).cast("long")

    return points.withColumns(
        {"i": index(xy[0], origin[0], step[0], shape[0]), "j": index(xy[1], origin[1], step[1], shape[1])}
    )


def bilinear_complex(
    points: DataFrame, grid: DataFrame, point_id: str, xy, origin, step, shape, lat_scale: float = 1.0,
    most: float = 1.0,
) -> DataFrame:
    """Interpolated (re, im) with a bounded nearest-cell fallback.

    ``flag`` 0: bilinear; 1: nearest known cell within ``most``; 2: neither.
    """
    linear = bilinear(points, grid, point_id, xy, origin, step, shape, ["re", "im"])
    open_points = linear.where("re is null or im is null").select(
        point_id, (F.col(xy[0]) * lat_scale).alias("x"), F.col(xy[1]).alias("y")
    )
    known = grid.where("re is not null and im is not null").select(
        F.struct("j", "i").alias("_cell_id"),
        ((F.col("i") * step[0] + origin[0]) * lat_scale).alias("x"), (F.col("j") * step[1] + origin[1]).alias("y"),
        "re", "im",
    )
    near = k_nearest(open_points, known, point_id, "_cell_id").where(F.col("distance") <= most)
    filled = near.join(known, "_cell_id").select(point_id, F.col("re").alias("_re"), F.col("im").alias("_im"))
    joined = linear.join(filled, point_id, "left")
    good = F.col("re").isNotNull() & F.col("im").isNotNull()
    flag = F.when(good, 0).when(F.col("_re").isNotNull(), 1).otherwise(2)
    return joined.withColumns(
        {"flag": flag, "re": F.when(good, F.col("re")).otherwise(F.col("_re")),
         "im": F.when(good, F.col("im")).otherwise(F.col("_im"))}
    ).drop("_re", "_im")


def _offers(df: DataFrame, value: str, ways: Sequence[tuple[int, int, float]]) -> DataFrame:
    sent = F.array(
        *[
            F.struct((F.col("j") + dj).alias("j"), (F.col("i") + di).alias("i"), F.col(value).alias("other"), F.lit(float(d)).alias("reach"))
            for dj, di, d in ways
        ]
    )
    return df.select(F.inline(sent))


def neighbour_gradation(grid: DataFrame, value: str, dx: float, dy: float, connectivity: int = 8) -> DataFrame:
    """Largest absolute difference per distance between neighbours, as one row."""
    ways = [(0, 1, dx), (1, 0, dy)]
    if connectivity == 8:
        diagonal = float(np.hypot(dx, dy))
        ways += [(1, 1, diagonal), (1, -1, diagonal)]
    met = grid.join(_offers(grid, value, ways), ["j", "i"])
    slope = F.abs(F.col(value) - F.col("other")) / F.greatest(F.col("reach"), F.lit(1.0))
    return met.agg(F.coalesce(F.max(slope), F.lit(0.0)).alias("max_gradation"), F.count(slope).alias("pairs"))


def depth_gradient(grid: DataFrame, value: str, dx: float, dy: float) -> DataFrame:
    """Gradient magnitude: central inside, one-sided at the edges."""
    ways = [(0, 1, 1), (0, -1, 2), (1, 0, 3), (-1, 0, 4)]
    sent = _offers(grid, value, ways)
    side = lambda n: F.max(F.when(F.col("reach") == n, F.col("other")))
    sided = sent.groupBy("j", "i").agg(side(1).alias("w"), side(2).alias("e"), side(3).alias("s"), side(4).alias("n"))
    met = grid.join(sided, ["j", "i"], "left")
    v = F.col(value)

    def slope(a, b, d):
        span = F.when(a.isNotNull() & b.isNotNull(), 2.0 * d).otherwise(F.lit(float(d)))
        return (F.coalesce(b, v) - F.coalesce(a, v)) / span

    gx, gy = slope(F.col("w"), F.col("e"), dx), slope(F.col("s"), F.col("n"), dy)
    return met.withColumn("gradient", F.sqrt(gx * gx + gy * gy)).drop("w", "e", "s", "n")


def _doubled(free: np.ndarray) -> list[np.ndarray]:
    """For steps of 1, 2, 4, ... along rows: from which cells so many single steps in a row are free."""
    found, step = [], 1
    while free.shape[1] > 0:
        found.append(free)
        free, step = free[:, :-step] & free[:, step:], 2 * step
    return found


def _sweep(fresh: np.ndarray, pass_on: Callable[[int, int], bool]) -> None:
    """Down and up over the rows until ``pass_on(row, from row)`` changes none; only rows that changed are passed on."""
    down, up = fresh.tolist(), fresh.tolist()
    last = len(down) - 1
    while any(down) or any(up):
        for waiting, order, way in ((down, range(last + 1), 1), (up, range(last, -1, -1), -1)):
            for k in order:
                if waiting[k]:
                    waiting[k] = False
                    if 0 <= k + way <= last and pass_on(k + way, k):
                        down[k + way] = up[k + way] = True


def _lower_envelope(value: np.ndarray, opened: np.ndarray, along: float, across: float, slant: float | None) -> None:
    """Lowers each open value, in place, to the least other one plus the path length to it."""
    runs = _doubled(opened[:, :-1] & opened[:, 1:])

    def spread(j: int) -> None:
        row = value[j]
        for n, free in enumerate(runs):
            s, way = 1 << n, along * (1 << n)
            right, left = row[:-s] + way, row[s:] + way
            if n == 0 and not (free[j] & ((right < row[1:] - 1e-9) | (left < row[:-1] - 1e-9))).any():
                return
            np.minimum(row[:-s], left, out=row[:-s], where=free[j])
            np.minimum(row[s:], right, out=row[s:], where=free[j])

    def pass_on(j: int, k: int) -> bool:
        row, before = value[j], value[k]
        offer = before + across
        if slant is not None:
            np.minimum(offer[1:], before[:-1] + slant, out=offer[1:])
            np.minimum(offer[:-1], before[1:] + slant, out=offer[:-1])
        better = opened[j] & (offer < row - 1e-9)
        if not better.any():
            return False
        row[better] = offer[better]
        spread(j)
        return True

    known = np.isfinite(value).any(axis=1)
    for j in np.flatnonzero(known):
        spread(j)
    _sweep(known, pass_on)


def _envelope_labels(value: np.ndarray, mark: np.ndarray, along: float, across: float, slant: float | None) -> None:
    """Lowers each mark, in place, to the least one whose cell gives this cell its value."""
    with np.errstate(invalid="ignore"):
        slack = np.where(np.isfinite(value), np.maximum(1e-9, 64 * np.spacing(value)), -1.0)

        def gives(there, here, length):
            return np.abs(value[there] + length - value[here]) <= slack[here]

        every, low, high = slice(None), slice(None, -1), slice(1, None)
        right, left = _doubled(gives((every, low), (every, high), along)), _doubled(gives((every, high), (every, low), along))
        # Columns of a row and of the row it is passed on to.
        ways = [(every, every, across)] + ([(low, high, slant), (high, low, slant)] if slant is not None else [])
        down = [(there, here, gives((low, there), (high, here), d)) for there, here, d in ways]
        up = [(there, here, gives((high, there), (low, here), d)) for there, here, d in ways]

    def spread(j: int) -> None:
        row = mark[j]
        for n in range(len(right)):
            s = 1 << n
            np.minimum(row[s:], row[:-s], out=row[s:], where=right[n][j])
            np.minimum(row[:-s], row[s:], out=row[:-s], where=left[n][j])

    def pass_on(j: int, k: int) -> bool:
        row, before = mark[j], mark[j].copy()
        for there, here, free in down if j > k else up:
            np.minimum(row[here], mark[k][there], out=row[here], where=free[min(j, k)])
        if np.array_equal(row, before):
            return False
        spread(j)
        return True

    for j in range(len(mark)):
        spread(j)
    _sweep(np.ones(len(mark), bool), pass_on)


def _block_shape(rows: int, columns: int) -> tuple[int, int]:
    """Height and width of blocks of up to BLOCK_CELLS cells; a narrow grid is cut across only."""
    side = math.isqrt(BLOCK_CELLS)
    if min(rows, columns) >= side:
        return side, side
    narrow = max(min(rows, columns), 1)
    long = min(BLOCK_CELLS // narrow, LONGEST_BLOCK)
    return (narrow, long) if rows < columns else (long, narrow)


def relax(
    grid: DataFrame, cost: str, dx: float, dy: float, weight: float = 1.0, connectivity: int = 8,
    label: str | None = None, block: int | None = None,
) -> DataFrame:
    """Lower envelope: each cell becomes the least ``cost + weight * path length`` of any cell.

    Paths run over the cells of the table only.  The grid is cut into blocks (squares of ``block``
    cells a side, or large ones of a shape that suits the grid).  A round settles, each inside its own
    task, the blocks whose neighbours changed on their borders, and hands on only what
    changed on theirs; when no border changes, all cells are settled once.  So the number of
    rounds is the number of blocks a path crosses, and a round moves the cells of
    the blocks at work only.  ``label`` travels with the value (smallest on a
    tie).  Unreached cells keep a null cost.
    """
    lab = label or "_label"
    work = grid if label else grid.withColumn(lab, F.lit(0).cast("long"))
    work = work.withColumns({cost: F.col(cost).cast("double"), lab: F.col(lab).cast("long")})
    rest = [c for c in work.columns if c not in ("j", "i", cost, lab)]
    places = work.where("j is not null and i is not null").select(F.col("j").cast("long").alias("j"), F.col("i").cast("long").alias("i"), cost, lab)
    top, bottom, west, east = places.agg(F.min("j"), F.max("j"), F.min("i"), F.max("i")).first()
    if top is None:
        top = bottom = west = east = 0
    tall, wide = (block, block) if block else _block_shape(bottom - top + 1, east - west + 1)
    along, across = weight * dx, weight * dy
    slant = weight * float(np.hypot(dx, dy)) if connectivity == 8 else None

    def home(a: int, b: int) -> list[Column]:
        return [F.floor((F.col("j") - top + a) / F.lit(tall)).cast("long").alias("bj"), F.floor((F.col("i") - west + b) / F.lit(wide)).cast("long").alias("bi")]

    homes = F.array_distinct(F.array(*[F.struct(*home(a, b)) for a in (-1, 0, 1) for b in (-1, 0, 1)]))

    def settled(pdf: pd.DataFrame, whole: bool) -> pd.DataFrame:
        none = np.iinfo(np.int64).max
        j0, i0 = int(pdf["j"].min()), int(pdf["i"].min())
        rows, cols = pdf["j"].to_numpy() - j0, pdf["i"].to_numpy() - i0
        shape = int(rows.max()) + 1, int(cols.max()) + 1
        start, mark, opened = np.full(shape, np.inf), np.full(shape, none), np.zeros(shape, bool)
        given = pdf[cost].fillna(np.inf).to_numpy()
        names = pdf[lab].astype("Int64").fillna(none).to_numpy(np.int64)
        last = np.lexsort((names, given))[::-1]  # of several rows for a cell the least stays
        start[rows[last], cols[last]], mark[rows[last], cols[last]], opened[rows, cols] = given[last], names[last], True
        steps = along, across, slant
        turned = shape[0] < shape[1]  # rows are passed on along the longer side
        if turned:
            start, mark, opened = (np.ascontiguousarray(x.T) for x in (start, mark, opened))
            steps = across, along, slant
        value = start.copy()
        _lower_envelope(value, opened, *steps)
        if label:
            mark[value < start - 1e-9] = none
            _envelope_labels(value, mark, *steps)
        if turned:
            value, mark = value.T, mark.T
        if whole:
            own = pdf["own"].to_numpy()
            rows, cols = rows[own], cols[own]
        else:
            bj, bi = int(pdf["bj"].iloc[0]) * tall + top, int(pdf["bi"].iloc[0]) * wide + west
            j, i = np.arange(shape[0])[:, None] + j0 - bj, np.arange(shape[1])[None, :] + i0 - bi
            inside = (j >= 0) & (j < tall) & (i >= 0) & (i < wide)
            edge = (j == 0) | (j == tall - 1) | (i == 0) | (i == wide - 1)
            rows, cols = np.nonzero(inside & edge & np.isfinite(value))
        got, who = value[rows, cols], mark[rows, cols]
        known = np.isfinite(got)
        named = known & (who != none)
        return pd.DataFrame(
            {"j": rows + j0, "i": cols + i0, cost: np.where(known, got, np.nan), lab: pd.Series(np.where(named, who, 0)).astype("Int64").where(named)}
        )

    schema = f"j long, i long, `{cost}` double, `{lab}` long"
    facts = ["j", "i", cost, lab]

    def settle(cells: DataFrame, known: DataFrame | None, whole: bool) -> DataFrame:
        if known is not None:
            cells = cells.unionByName(known)
        return cells.groupBy("bj", "bi").applyInPandas(lambda pdf: settled(pdf, whole), schema)

    cells = places.select(*facts, *home(0, 0), F.lit(True).alias("own"))
    border = None
    if bottom - top >= tall or east - west >= wide or block:
        cells = cut_lineage(cells)
        active = cells.where(F.col(cost).isNotNull()).select("bj", "bi").distinct()
        border = cut_rounds(cells.select(*facts).limit(0))
        told = lambda: border.select(*facts, F.inline(homes), F.lit(False).alias("own"))
        while True:
            at_work = lambda df: df.join(active, ["bj", "bi"], "left_semi")
            old = border.select("j", "i", F.col(cost).alias("_cost"), F.col(lab).alias("_lab"))
            met = settle(at_work(cells), at_work(told()), whole=False).join(old, ["j", "i"], "left")
            lower = F.col("_cost").isNull() | (F.col(cost) < F.col("_cost") - 1e-9)
            renamed = (F.col(cost) <= F.col("_cost") + 1e-9) & (F.col(lab) < F.coalesce("_lab", F.lit(np.iinfo(np.int64).max)))
            changed = cut_rounds(met.where(lower | renamed).select("j", "i", F.least(cost, "_cost").alias(cost), lab))
            if changed.isEmpty():
                break
            border = cut_rounds(border.join(changed, ["j", "i"], "left_anti").unionByName(changed))
            active = changed.select(F.inline(F.array_except(homes, F.array(F.struct(*home(0, 0)))))).distinct()
    # A border cell tells its own block too, which then agrees with what its neighbours were told.
    state = settle(cells, told() if border is not None else None, whole=True)
    state = cut_lineage(state.withColumn(cost, F.when(~F.isnan(cost), F.col(cost))))
    done = state if label else state.drop(lab)
    kept = work.select(F.col("j").cast("long").alias("j"), F.col("i").cast("long").alias("i"), *rest)
    return kept.join(done, ["j", "i"]) if rest else done


def limit_gradation(grid: DataFrame, size: str, gradation: float, dx: float, dy: float, connectivity: int = 8, **kw) -> DataFrame:
    """Sizes lowered until no neighbour differs by more than ``gradation`` per unit distance."""
    known = grid.where(F.col(size).isNotNull())
    return relax(known, size, dx, dy, weight=gradation, connectivity=connectivity, **kw)


def wet_distance(grid: DataFrame, wet: Column, source: Column, dx: float, dy: float, columns: int, **kw) -> DataFrame:
    """Path length over wet cells to the nearest source, and the flat index of that source."""
    flat = F.col("j").cast("long") * columns + F.col("i").cast("long")
    start = grid.where(wet).withColumns(
        {"distance": F.when(source, F.lit(0.0)), "source": F.when(source, flat)}
    )
    return relax(start, "distance", dx, dy, label="source", **kw)


def limit_gradation_line(df: DataFrame, keys: Sequence[str], position: str, size: str, gradation: float) -> DataFrame:
    """The envelope along an open chain, from two running minima."""
    climb, g = F.col(position) * gradation, {
        "_left": Run("min", F.col(size) - F.col(position) * gradation),
        "_right": Run("min_ahead", F.col(size) + F.col(position) * gradation),
    }
    run = running(df, keys, [position], g)
    limited = F.least(F.col("_left") + climb, F.col("_right") - climb)
    return run.withColumn("limited", limited).drop("_left", "_right")


def limit_gradation_ring(df: DataFrame, keys: Sequence[str], position: str, size: str, total: Column, gradation: float) -> DataFrame:
    """The envelope around a closed chain of length ``total``: the chain laid out three times."""
    laps = df.withColumn("_lap", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))).withColumn(
        "_pos", F.col(position) + F.col("_lap") * total
    )
    return limit_gradation_line(laps, keys, "_pos", size, gradation).where("_lap = 0").drop("_lap", "_pos")


def node_budget(grid: DataFrame, lat: str, size: str, lon_width: float, lat_width: float, domain: Column | None = None) -> DataFrame:
    """Nodes a triangular lattice of the local size needs over the active cells."""
    active = F.col(size).isNotNull() & (F.col(size) > 0)
    if domain is not None:
        active = active & F.coalesce(domain, F.lit(False))
    area = degree_cell_area_m2(F.col(lat), lon_width, lat_width)
    density = 2.0 / (F.sqrt(F.lit(3.0)) * F.pow(F.greatest(F.col(size), F.lit(1e-9)), F.lit(2.0)))
    out = grid.agg(
        F.sum(F.when(active, area * density)).alias("estimate"),
        F.count_if(active).alias("active_cells"),
        F.sum(F.when(active, area)).alias("active_area_m2"),
    )
    return out.withColumn("nodes", F.ceil("estimate").cast("long"))


def stable_step(depth: Column, size: Column, cfl: float) -> Column:
    """Largest stable time step of an external gravity wave."""
    return F.lit(float(cfl)) * size / F.sqrt(F.greatest(depth, F.lit(1.0)) * GRAVITY)


def cfl_report(grid: DataFrame, depth: str, size: str, cfl: float, target: float) -> DataFrame:
    dt = stable_step(F.col(depth), F.col(size), cfl)
    return grid.agg(F.min(dt).alias("recommended_step"), F.count_if(dt < target).alias("cells_below_target"))


def cumulative_storage(grid: DataFrame, distance: str, flat: str, area: str, slices: Slices | None = None) -> DataFrame:
    """Area of all cells at least as far as each one, farthest first; unreachable stays null.

    Where nothing is reachable every cell gets the whole area.
    """
    far = grid.withColumns({"_far": -F.col(distance), "_tie": -F.col(flat)})
    reach = far.where(F.col(distance).isNotNull())
    summed = running(reach, [], ["_far", "_tie"], {"storage": Run("sum", F.col(area))}, slices).drop("_far", "_tie")
    rest = grid.where(F.col(distance).isNull())
    reachable, whole = grid.agg(F.count(distance), F.sum(area)).first()
    alone = rest.withColumn("storage", F.lit(None if reachable else whole).cast("double"))
    return summed.unionByName(alone)


def smootherstep(v: Column) -> Column:
    x = F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0))
    return x * x * x * (x * (x * 6.0 - 15.0) + 10.0)


def blend_log(near: Column, far: Column, share: Column) -> Column:
    """Size between two targets, evenly in the logarithm, by a smooth share."""
    a = smootherstep(share)
    return F.exp((1.0 - a) * F.log(near) + a * F.log(far))


def least_with_source(candidates: Sequence[tuple[int, Column]]) -> tuple[Column, Column]:
    """Pointwise minimum of candidate sizes and the code of the first that attains it."""
    entries = F.array(*[F.struct(v.alias("v"), F.lit(i).alias("i"), F.lit(code).alias("code")) for i, (code, v) in enumerate(candidates)])
    best = F.array_min(F.filter(entries, lambda e: e["v"].isNotNull()))
    return best["v"], best["code"]


def refine_cells(cells: DataFrame, target: Column, factor: float = 1.25, deepest: int = 18) -> DataFrame:
    """Quadtree leaves: a square (x, y, width) splits while wider than ``factor`` x its target.

    ``cut_short`` marks leaves of depth ``deepest`` that are still too wide.
    """
    open_, leaves = cells.withColumns({"depth": F.lit(0), "cut_short": F.lit(False)}), None
    for depth in range(deepest + 1):
        wide = F.coalesce(F.col("width") > target * factor, F.lit(False))
        split = wide if depth < deepest else F.lit(False)
        marked = cut_lineage(open_.withColumns({"cut_short": wide & F.lit(depth == deepest), "_split": split}))
        done = marked.where(~F.col("_split")).drop("_split")
        leaves = done if leaves is None else leaves.unionByName(done)
        rest = marked.where("_split")
        if rest.isEmpty():
            break
        half = F.col("width") / 2.0
        quarter = F.col("width") / 4.0
        kids = F.array(*[F.struct((F.col("x") + a * quarter).alias("x"), (F.col("y") + b * quarter).alias("y"), half.alias("width"))
                         for a in (-1, 1) for b in (-1, 1)])
        others = [c for c in cells.columns if c not in ("x", "y", "width")]
        open_ = rest.select(*others, F.inline(kids)).withColumns({"depth": F.lit(depth + 1), "cut_short": F.lit(False)}).select(*open_.columns)
    return leaves


def destagger(edges: DataFrame, axis: str, others: Sequence[str], value: str, last: int) -> DataFrame:
    """Edge values (0..last-1) to centres (0..last): mean of the known neighbours, ends copied."""
    sent = F.array(F.struct(F.col(axis).alias(axis), F.col(value).alias("v")), F.struct((F.col(axis) + 1).alias(axis), F.col(value).alias("v")))
    return edges.select(*others, F.inline(sent)).groupBy(*others, axis).agg(F.avg("v").alias(value)).where(F.col(axis).between(0, last))
