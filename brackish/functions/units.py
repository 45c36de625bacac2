"""Unit conversion by field role."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit spelling -> (scale, offset) to the canonical unit of each role.
SPEED = {"m/s": (1.0, 0.0), "ms-1": (1.0, 0.0), "m.s-1": (1.0, 0.0), "metersecond-1": (1.0, 0.0),
         "meterssecond-1": (1.0, 0.0)}
STRESS = {"pa": (1.0, 0.0), "n/m2": (1.0, 0.0), "nm-2": (1.0, 0.0), "n.m-2": (1.0, 0.0)}
FLUX = {"w/m2": (1.0, 0.0), "wm-2": (1.0, 0.0), "w.m-2": (1.0, 0.0)}
TEMPERATURE = {"k": (1.0, -273.15), "kelvin": (1.0, -273.15), "degrees_k": (1.0, -273.15),
               "degree_k": (1.0, -273.15), "c": (1.0, 0.0), "degc": (1.0, 0.0), "degree_celsius": (1.0, 0.0),
               "degreescelsius": (1.0, 0.0), "celsius": (1.0, 0.0)}
HUMIDITY = {"1": (100.0, 0.0), "fraction": (100.0, 0.0), "unitless": (100.0, 0.0), "": (100.0, 0.0),
            "%": (1.0, 0.0), "percent": (1.0, 0.0), "percentage": (1.0, 0.0)}
PRESSURE = {"hpa": (100.0, 0.0), "mb": (100.0, 0.0), "mbar": (100.0, 0.0), "hectopascal": (100.0, 0.0),
            "hectopascals": (100.0, 0.0), "pa": (1.0, 0.0), "pascal": (1.0, 0.0), "pascals": (1.0, 0.0)}
WATER_FLUX = {"m/s": (1.0, 0.0), "ms-1": (1.0, 0.0), "m.s-1": (1.0, 0.0), "kgm-2s-1": (1e-3, 0.0),
              "kg/m2/s": (1e-3, 0.0), "kgm^-2s^-1": (1e-3, 0.0), "mm/hr": (1e-3 / 3600.0, 0.0),
              "mmh-1": (1e-3 / 3600.0, 0.0), "mm/hour": (1e-3 / 3600.0, 0.0), "mm/day": (1e-3 / 86400.0, 0.0),
              "mmd-1": (1e-3 / 86400.0, 0.0), "mmday-1": (1e-3 / 86400.0, 0.0)}
LENGTH = {"m": (1.0, 0.0), "meter": (1.0, 0.0), "meters": (1.0, 0.0), "metre": (1.0, 0.0), "metres": (1.0, 0.0),
          "cm": (0.01, 0.0), "centimeter": (0.01, 0.0), "centimeters": (0.01, 0.0), "centimetre": (0.01, 0.0),
          "centimetres": (0.01, 0.0), "mm": (0.001, 0.0), "millimeter": (0.001, 0.0), "millimeters": (0.001, 0.0),
          "millimetre": (0.001, 0.0), "millimetres": (0.001, 0.0)}
# Allowed range after conversion.
SAFE_RANGE = {"relative_humidity": (0.0, 100.0), "absolute_air_pressure": (50000.0, 120000.0),
              "air_temperature": (-100.0, 70.0), "precipitation": (0.0, None), "evaporation": (0.0, None)}
ROLE_UNITS = {"eastward_wind": SPEED, "northward_wind": SPEED, "eastward_stress": STRESS,
              "northward_stress": STRESS, "net_shortwave": FLUX, "total_net_heat_flux": FLUX,
              "downward_longwave": FLUX, "downward_shortwave": FLUX, "air_temperature": TEMPERATURE,
              "relative_humidity": HUMIDITY, "absolute_air_pressure": PRESSURE, "precipitation": WATER_FLUX,
              "evaporation": WATER_FLUX, "water_level": LENGTH}
CUBIC_METRES_PER_CUBIC_FOOT = 0.028316846592


def unit_key(units: Column) -> Column:
    return F.replace(F.replace(F.lower(F.trim(units)), F.lit(" "), F.lit("")), F.lit("**"), F.lit("^"))


def convert(role: str, value: Column, units: Column) -> Column:
    """Value in the canonical unit of its role; null where the unit is not known."""
    key = unit_key(units)
    result = None
    for name, (scale, offset) in ROLE_UNITS[role].items():
        converted = value * scale + offset
        result = F.when(key == name, converted) if result is None else result.when(key == name, converted)
    return result


def range_problem(role: str, converted: Column) -> Column:
    """Why a converted value is unfit: ``missing``, ``out_of_range`` or null."""
    low, high = SAFE_RANGE.get(role, (None, None))
    outside = F.lit(False)
    if low is not None:
        outside = outside | (converted < low)
    if high is not None:
        outside = outside | (converted > high)
    return F.when(converted.isNull(), "missing").when(outside, "out_of_range")


def require_converted(role: str, value: Column, units: Column) -> Column:
    """As ``convert``, but a value that fails its gate stops the job."""
    converted = convert(role, value, units)
    problem = range_problem(role, converted)
    return F.when(problem.isNull(), converted).otherwise(
        F.raise_error(F.concat(F.lit(role + ": "), problem)).cast("double")
    )


def departure_to_pascal(value: Column, base_hpa: float = 1000.0, in_hpa: bool = True) -> Column:
    """Pressure departure from a base to absolute pascal."""
    hpa = value if in_hpa else value / 100.0
    return (hpa + base_hpa) * 100.0


def cubic_feet_to_metres(value: Column) -> Column:
    return value * CUBIC_METRES_PER_CUBIC_FOOT


def required_roles(packages: set[str], wind: str = "speed", heat: str = "direct") -> list[str]:
    """Fields a set of forcing packages needs."""
    by_package = {
        "wind": ["eastward_wind", "northward_wind"] if wind == "speed" else ["eastward_stress", "northward_stress"],
        "heat": ["net_shortwave", "total_net_heat_flux"] if heat == "direct" else [
            "air_temperature", "relative_humidity", "absolute_air_pressure", "downward_longwave",
            "downward_shortwave"],
        "freshwater": ["precipitation", "evaporation"],
        "pressure": ["absolute_air_pressure"],
    }
    wanted = [role for name, roles in by_package.items() if name in packages for role in roles]
    return list(dict.fromkeys(wanted))
