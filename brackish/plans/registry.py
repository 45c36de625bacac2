"""Where queries and the SQL that states their expected result meet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brackish.session import in_utc

# Results are compared rounded.  Means and linear shares often end exactly half-way
# between two roundings, where the last bit decides; this shift moves them off it.
OFF_TIE = 3.1e-7

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the same result for DuckDB over the same tables."""

    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(in_utc(spark), folder)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def load_all() -> None:
    from brackish.plans import axes, cleaning, evaluation, grids, meshes, readers, selection, series, spatial, streams  # noqa: F401
