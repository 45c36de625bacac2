"""Vertical coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def terrain_depth(s: Column, stretch: Column, h: Column, zeta: Column, hc: float, transform: int) -> Column:
    """Height of a terrain-following level under vertical transform 1 or 2."""
    if transform == 1:
        still = (s - stretch) * hc + stretch * h
        return still + zeta * (1.0 + still / h)
    if transform == 2:
        share = (s * hc + h * stretch) / (h + hc)
        return zeta + (zeta + h) * share
    raise ValueError("vertical transform must be 1 or 2")


def sigma_levels(levels: int, power: float = 1.0) -> list[float]:
    """Interface positions from 0 down to -1: uniform (1) or packed to the surface."""
    return [-((k / (levels - 1)) ** power) for k in range(levels)]


def coriolis_value(mode: str, y: Column, latitude: float | None = None) -> Column:
    """Per-node value written for the Coriolis setting: zero, one latitude, or the node's own."""
    key = mode.lower().replace("_", "-")
    if key == "zero":
        return F.lit(0.0)
    if key in ("latitude", "constant-latitude"):
        if latitude is None:
            raise ValueError("a constant latitude is needed")
        return F.lit(float(latitude))
    if key in ("y-coordinate", "node-y"):
        return y
    raise ValueError("unknown mode " + mode)
