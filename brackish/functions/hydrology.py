"""Rivers: rating curves, channels, particle sizes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def sediment_load(flow: Column) -> Column:
    """Tonnes per day from discharge (m3/s)."""
    return F.pow(flow, F.lit(1.8)) * 0.01


def floc_concentration(flow: Column) -> Column:
    """g/l carried by the sediment load; 0 where nothing flows."""
    return F.when(flow > 0, sediment_load(flow) * 1e6 / (flow * 86400.0 * 1000.0)).when(flow.isNotNull(), F.lit(0.0))


def power_law(flow: Column, a: float, b: float) -> Column:
    return F.pow(flow, F.lit(float(b))) * float(a)


def area_to_cells(area_km2: Column, cell_area_m2: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(area_km2 * 1e6 / cell_area_m2)).cast("long")


# Upper area limits (m2) with channel width, and slope limits with
# first class number, depth, and effective width per area bin.
AREA_BINS = [(1e6, 0.5), (1e7, 1.0), (2e7, 2.0), (3e7, 3.0), (4e7, 4.0), (None, 4.5)]
SLOPE_BINS = [
    (0.002, 1, 0.03, [0.06, 0.09, 0.12, 0.15, 0.18, 0.21]),
    (0.1, 7, 0.05, [0.10, 0.15, 0.20, 0.25, 0.30, 0.35]),
    (None, 13, 0.10, [0.20, 0.30, 0.40, 0.50, 0.60, 0.70]),
]


def channel_class(slope: Column, area: Column) -> Column:
    """Struct (chanclass, width, depth, effwidth) from the slope and area bins."""
    def entry(first, depth, widths, i):
        return F.struct(
            F.lit(first + i).alias("chanclass"),
            F.lit(AREA_BINS[i][1]).alias("width"),
            F.lit(depth).alias("depth"),
            F.lit(widths[i]).alias("effwidth"),
        )

    def by_area(first, depth, widths):
        choice = None
        for i, (limit, _) in enumerate(AREA_BINS[:-1]):
            test = area <= limit
            picked = entry(first, depth, widths, i)
            choice = F.when(test, picked) if choice is None else choice.when(test, picked)
        return choice.otherwise(entry(first, depth, widths, len(AREA_BINS) - 1))

    (low, *gentle), (mid, *medium), (_, *steep) = SLOPE_BINS
    return F.when(slope <= low, by_area(*gentle)).when(slope <= mid, by_area(*medium)).otherwise(by_area(*steep))


# Particle size density parameters (micrometres).
SIZE_A, SIZE_BETA1, SIZE_BETA2, SIZE_X0 = 0.0016, 1.42, -3.02, 15.0
SOURCE_RANGE_UM, TARGET_RANGE_UM = (50.0, 2000.0), (0.1, 100.0)


def size_density(x):
    """Particle number density at size x (micrometres): A x^b1 (1 + x / x0)^b2 e^-b2; x is a column or an array."""
    return SIZE_A * x**SIZE_BETA1 * (1.0 + x / SIZE_X0) ** SIZE_BETA2 * float(np.exp(-SIZE_BETA2))


def size_share(low: float, high: float, nodes: int = 200) -> float:
    """The density integrated over a size range, by Gauss's rule along the logarithm of the size."""
    at, weight = np.polynomial.legendre.leggauss(nodes)
    half, middle = np.log(high / low) / 2, np.log(high * low) / 2
    x = np.exp(middle + half * at)
    return float(half * weight @ (x * size_density(x)))


def size_extrapolation(source=SOURCE_RANGE_UM, target=TARGET_RANGE_UM) -> float:
    """How many particles of the target range go with one of the source range."""
    return size_share(*target) / size_share(*source)


def particle_mass_kg(a_mm: float, b_mm: float, c_mm: float, density: float) -> float:
    """Mass of an ellipsoid given its full axes."""
    return float(np.pi / 6.0 * a_mm * b_mm * c_mm * 1e-9 * density)


def fibre_number_m3(total_per_ft3: Column, fraction: Column) -> Column:
    return total_per_ft3 * fraction / 0.028316846592
