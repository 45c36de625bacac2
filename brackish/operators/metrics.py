"""Skill scores and distribution summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brackish.functions.cleaning import divide, fractions_valid, normalised_fraction, silt
from brackish.operators.quantiles import with_quantiles


def skill_scores(
    df: DataFrame, keys: Sequence[str], sim: str, obs: str, time: str | None = None
) -> DataFrame:
    """Agreement of pairs per group; scores that are undefined are null.

    Everything is a sum of one pass, so a group of any size combines map-side.
    Groups without a pair are kept with ``n_pairs`` 0.
    """
    s, o = F.col("_s"), F.col("_o")
    both = F.col(sim).isNotNull() & F.col(obs).isNotNull()
    pairs = df.withColumns(
        {"_s": F.when(both, F.col(sim).cast("double")), "_o": F.when(both, F.col(obs).cast("double"))}
    )
    dates = []
    if time:
        when = F.when(both, F.col(time))
        dates = [F.min(when).alias("date_start"), F.max(when).alias("date_end")]
    base = pairs.groupBy(*keys).agg(
        F.count(s).alias("n_pairs"),
        *dates,
        F.covar_pop(s, o).alias("_cov"),
        F.stddev_pop(s).alias("_sd_s"),
        F.stddev_pop(o).alias("_sd_o"),
        F.var_pop(o).alias("_var_o"),
        F.avg(s).alias("sim_mean"),
        F.avg(o).alias("obs_mean"),
        F.avg((s - o) * (s - o)).alias("_mse"),
        F.avg(F.abs(s - o)).alias("mae"),
        F.avg(s - o).alias("bias"),
        F.sum(s - o).alias("_sum_d"),
        F.sum(o).alias("_sum_o"),
    )
    r = F.when(F.col("n_pairs") > 1, divide(F.col("_cov"), F.col("_sd_s") * F.col("_sd_o")))
    scored = base.withColumns(
        {
            "r": r,
            "alpha": divide(F.col("_sd_s"), F.col("_sd_o")),
            "beta": divide(F.col("sim_mean"), F.col("obs_mean")),
            "rmse": F.sqrt("_mse"),
            "pbias": divide(F.col("_sum_d") * 100.0, F.col("_sum_o")),
            "nse": 1.0 - divide(F.col("_mse"), F.col("_var_o")),
        }
    )
    away = sum((F.pow(F.col(c) - 1.0, F.lit(2.0)) for c in ("r", "alpha", "beta")), F.lit(0.0))
    return scored.withColumn("kge", 1.0 - F.sqrt(away)).select(
        *keys, "n_pairs", *(["date_start", "date_end"] if time else []),
        "r", "alpha", "beta", "kge", "nse", "rmse", "mae", "bias", "pbias", "sim_mean", "obs_mean",
    )


def skill_by_comparison(
    df: DataFrame, keys: Sequence[str], sim: str, comparisons: dict[str, str], minimum_pairs: int = 5
) -> DataFrame:
    """Short scores for several observation columns; null below a minimum of pairs."""
    pairs = F.array(*[F.struct(F.lit(n).alias("comparison"), F.col(c).alias("o")) for n, c in comparisons.items()])
    long = df.select(*keys, F.col(sim).alias("s"), F.inline(pairs))
    both = F.col("s").isNotNull() & F.col("o").isNotNull()
    s, o = F.when(both, F.col("s")), F.when(both, F.col("o"))
    out = long.groupBy(*keys, "comparison").agg(
        F.count(s).alias("n"),
        F.covar_samp(s, o).alias("_cov"),
        F.stddev_samp(s).alias("_sd_s"),
        F.stddev_samp(o).alias("_sd_o"),
        F.avg(s - o).alias("_bias"),
        F.avg((s - o) * (s - o)).alias("_mse"),
        F.avg(s).alias("_ms"),
        F.avg(o).alias("_mo"),
    )
    enough = F.col("n") >= minimum_pairs
    return out.select(
        *keys,
        "comparison",
        "n",
        F.when(enough, divide(F.col("_cov"), F.col("_sd_s") * F.col("_sd_o"))).alias("corr"),
        F.when(enough, F.col("_bias")).alias("bias"),
        F.when(enough, F.sqrt("_mse")).alias("rmse"),
        F.when(enough, divide(F.col("_ms"), F.col("_mo"))).alias("ratio_mean"),
    )


def distribution_summary(df: DataFrame, keys: Sequence[str], value: Column, **sizing) -> DataFrame:
    """Count, moments, extremes and linear quantiles of the non-null values."""
    v = F.col("_x")
    narrow = df.select(*keys, value.cast("double").alias("_x"))
    moments = narrow.groupBy(*keys).agg(
        F.count(v).alias("n"),
        F.avg(v).alias("mean"),
        F.stddev_pop(v).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.sqrt(F.avg(v * v)).alias("rmse"),
    )
    quantiles = with_quantiles(narrow, keys, v, [0.5, 0.05, 0.25, 0.75, 0.95], **sizing)
    named = quantiles.select(
        *keys, *[F.col("quantiles")[i].alias(n) for i, n in enumerate(["median", "p05", "p25", "p75", "p95"])]
    )
    return same_keys(moments, named, keys).withColumn("bias", F.col("mean"))


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join two one-row-per-group tables; null keys match each other."""
    if not keys:  # one row each: lay them over each other
        both = left.unionByName(right, allowMissingColumns=True)
        return both.agg(*[F.max(c).alias(c) for c in both.columns])
    renamed = right.select(*[F.col(k).alias("_r_" + k) for k in keys], *[c for c in right.columns if c not in keys])
    condition = None
    for k in keys:
        test = left[k].eqNullSafe(renamed["_r_" + k])
        condition = test if condition is None else condition & test
    return left.join(renamed, condition, how).drop(*["_r_" + k for k in keys])


def ratio_summary(df: DataFrame, strata: Sequence[str], ratio: Column, thresholds: Sequence[float]) -> DataFrame:
    """Counts, maximum and exceedances per stratum, with a grand total row."""
    value = ratio.cast("double")
    good = F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)
    return (
        df.rollup(*strata)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count(good).alias("n_finite"),
            F.max(good).alias("maximum"),
            *[F.count_if(good > t).alias("above_" + str(t).replace(".", "_")) for t in thresholds],
            F.grouping_id().cast("long").alias("total_level"),
        )
        .withColumn("n_invalid", F.col("n") - F.col("n_finite"))
    )


def group_profile(
    df: DataFrame, keys: Sequence[str], means: Sequence[str], firsts: Sequence[str], order: Sequence[str], counted: str
) -> DataFrame:
    """Means, first known attributes in ``order``, and how many rows carry ``counted``.

    A null key is a group of its own.
    """
    position = F.struct(*order)
    return df.groupBy(*keys).agg(
        *[F.avg(c).alias("mean_" + c) for c in means],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), position)).alias("first_" + c) for c in firsts],
        F.count(counted).alias("observation_count"),
    )


def fraction_summary(
    df: DataFrame, keys: Sequence[str], location: str, gravel: str, sand: str, mud: str, clay: str, size: str, **sizing
) -> DataFrame:
    """Grain fractions per region: all-row means, valid-row normalised means, median size."""
    g, s, m, c = (F.col(x).cast("double") for x in (gravel, sand, mud, clay))
    valid = fractions_valid(g, s, m, c)
    classes = {"gravel": g, "sand": s, "silt": silt(m, c), "clay": c}
    summary = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("observations"),
        F.count_distinct(location).alias("locations"),
        F.count_if(valid).alias("valid_rows"),
        *[F.avg(x).alias(f"{n}_mean_pct") for n, x in [*classes.items(), ("mud", m)]],
        F.avg(size).alias("mean_size"),
        *[F.avg(normalised_fraction(x, list(classes.values()), valid)).alias(f"{n}_norm_pct") for n, x in classes.items()],
    )
    median = with_quantiles(df, keys, F.col(size), [0.5], **sizing)
    return same_keys(summary, median.select(*keys, F.col("quantiles")[0].alias("median_size")), keys)


def display_limits(df: DataFrame, keys: Sequence[str], value: Column, low: float = 0.02, high: float = 0.98, **sizing):
    """Quantile limits, widened where both fall together."""
    q = with_quantiles(df, keys, value, [low, high], **sizing)
    lo, hi = F.col("quantiles")[0], F.col("quantiles")[1]
    widen = F.when(lo == hi, F.greatest(F.abs(lo) * 0.01, F.lit(1e-12))).otherwise(F.lit(0.0))
    return q.select(*keys, (lo - widen).alias("vmin"), (hi + widen).alias("vmax"))


def display_limits_or_range(df: DataFrame, keys: Sequence[str], value: Column, low=0.02, high=0.98, **sizing):
    """Quantile limits; where they coincide the full range, and then one apart."""
    q = with_quantiles(df, keys, value, [low, high, 0.0, 1.0], **sizing)
    lo, hi, least, most = (F.col("quantiles")[i] for i in range(4))
    flat = lo == hi
    bottom = F.when(flat, least).otherwise(lo)
    top = F.when(flat, most).otherwise(hi)
    return q.select(*keys, bottom.alias("vmin"), F.when(bottom == top, bottom + 1.0).otherwise(top).alias("vmax"))
