"""Statistics of series."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.base import col
from ..functions.values import epoch_seconds
from ..session import shipped


def series_stats(df: DataFrame, keys: Sequence[str], value: str = "value", order: str = "timestamp") -> DataFrame:
    """n, mean, std, min, max, skew (population), kurt (excess), autocorr (lag 1), slope against the place; 0 where there are too few values."""
    over = Window.partitionBy(*keys).orderBy(order)
    rows = df.withColumn("__before", F.lag(value).over(over)).withColumn("__at", (F.row_number().over(over) - 1).cast("double"))
    v = F.col(value)
    n, spread = F.count(v), F.stddev_pop(v)
    enough = lambda least, x: F.when((n >= least) & (spread > 0), F.coalesce(x, F.lit(0.0))).otherwise(0.0)
    return rows.groupBy(*keys).agg(
        n.alias("n"),
        F.avg(v).alias("mean"),
        F.coalesce(F.stddev_samp(v), F.lit(0.0)).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        enough(3, F.skewness(v)).alias("skew"),
        enough(4, F.kurtosis(v)).alias("kurt"),
        enough(3, F.corr(v, F.col("__before"))).alias("autocorr"),
        enough(2, F.regr_slope(v, F.col("__at"))).alias("slope"),
    )


def counter_profile(df: DataFrame, keys: Sequence[str], value: str = "value", order: str = "timestamp") -> DataFrame:
    """series_stats of a counter's rises (after a reset the new value), with resets_per_hour."""
    over = Window.partitionBy(*keys).orderBy(order)
    step = F.col(value) - F.lag(value).over(over)
    rows = df.withColumn("__step", step).withColumn("rise", F.when(F.col("__step") < 0, F.col(value)).otherwise(F.col("__step"))).where("rise IS NOT NULL")
    stats = series_stats(rows.withColumn("rise", F.greatest("rise", F.lit(0.0))), keys, "rise", order)
    hours = (F.max(epoch_seconds(order)) - F.min(epoch_seconds(order))) / 3600
    resets = rows.groupBy(*keys).agg(F.sum((F.col("__step") < 0).cast("bigint")).alias("resets"), hours.alias("hours"))
    return stats.join(resets, list(keys)).withColumn("resets_per_hour", F.when(F.col("hours") > 0, F.col("resets") / F.col("hours")).otherwise(F.lit(0.0))).drop("hours")


def regime_profiles(df: DataFrame, keys: Sequence[str] = ("regime", "metric", "labels_key")) -> DataFrame:
    """series_stats of every series of every regime in one job: counters by their rises, all others by their values.

    A _count or _sum of a family without buckets in that regime is a gauge; with buckets it belongs to the histogram and is left out.
    """
    family, part = F.regexp_replace("metric", "_(bucket|count|sum)$", ""), F.regexp_extract("metric", "_(bucket|count|sum)$", 1)
    rows = df.withColumn("__family", family).withColumn("__part", part)
    known = rows.where("__part = 'bucket'").select(F.col("regime").alias("of_regime"), F.col("__family").alias("of_family")).distinct()
    rows = rows.join(known, (F.col("regime") == F.col("of_regime")) & (F.col("__family") == F.col("of_family")), "left").where("of_family IS NULL")
    is_counter = F.col("metric").endswith("_total")
    step = F.col("value") - F.lag("value").over(Window.partitionBy(*keys).orderBy("timestamp"))
    rise = F.when(step.isNotNull(), F.greatest(F.when(step < 0, F.col("value")).otherwise(step), F.lit(0.0)))
    rows = rows.withColumn("__value", F.when(is_counter, rise).otherwise(F.col("value"))).where("__value IS NOT NULL")
    return series_stats(rows, keys, "__value").withColumn("kind", F.when(F.col("metric").endswith("_total"), "counter").otherwise("gauge"))


def zscore_anomaly(value: Column | str, keys: Sequence[str], threshold: float = 3.0) -> Column:
    """Whether the value is more than so many deviations from its group's mean; false for one value or no spread."""
    over = Window.partitionBy(*keys)
    v = col(value)
    return F.coalesce(F.abs(F.try_divide(v - F.avg(v).over(over), F.stddev_samp(v).over(over))) > threshold, F.lit(False))


def regime_metadata(df: DataFrame, series: Sequence[str] = ("metric", "labels_key")) -> DataFrame:
    """duration_seconds, step_seconds (median distance of distinct timestamps), series."""
    at = df.select(epoch_seconds("timestamp").alias("t")).distinct()
    # distances inside a day, and from a day's last time to the next one's first: no task sorts all times
    days = at.withColumn("day", F.floor(F.col("t") / 86400))
    inside = days.select((F.col("t") - F.lag("t").over(Window.partitionBy("day").orderBy("t"))).alias("d"))
    edges = days.groupBy("day").agg(F.min("t").alias("first"), F.max("t").alias("last"))
    between = edges.select((F.col("first") - F.lag("last").over(Window.orderBy("day"))).alias("d"))
    steps = inside.unionByName(between).where("d IS NOT NULL").groupBy("d").agg(F.count("*").alias("n")).agg(F.percentile("d", F.lit(0.5), F.col("n")).alias("step_seconds"))
    whole = at.agg((F.max("t") - F.min("t")).alias("duration_seconds"))
    return whole.join(F.broadcast(steps)).join(F.broadcast(df.select(*series).distinct().agg(F.count("*").alias("series"))))


def bucket_rises(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per (keys, le): the summed rise of a cumulative bucket counter (value after a reset)."""
    over = Window.partitionBy(*keys, "le").orderBy("timestamp")
    step = F.col("value") - F.lag("value").over(over)
    return df.withColumn("__step", step).withColumn("__rise", F.when(F.col("__step") < 0, F.col("value")).otherwise(F.col("__step"))).groupBy(*keys, "le").agg(F.coalesce(F.sum("__rise"), F.lit(0.0)).alias("n"), F.count("__rise").alias("steps"))


def probit(p: np.ndarray) -> np.ndarray:
    """Inverse of the normal distribution, by bisection on erf."""
    from math import erf, sqrt

    def one(x: float) -> float:
        low, high = -9.0, 9.0
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if 0.5 * (1 + erf(mid / sqrt(2))) < x else (low, mid)
        return (low + high) / 2

    return np.array([one(x) for x in p])


def fit_lognormal(bounds: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """mu and sigma: least squares of the probit of the shares below finite bounds on the bounds' logarithms."""
    total = counts[-1] if len(counts) else 0.0
    usable = np.isfinite(bounds) & (bounds > 0) & (counts > 0) & (counts < total)
    if total <= 0 or usable.sum() < 2:
        usable = np.isfinite(bounds) & (bounds > 0)
        return (float(np.log(bounds[usable]).mean()), 1.0) if usable.any() else (0.0, 1.0)
    x, y = np.log(bounds[usable]), probit(counts[usable] / total)
    slope, intercept = np.polyfit(x, y, 1)
    sigma = 1 / max(slope, 1e-6)
    return float(-intercept * sigma), float(sigma)


def histogram_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, mu, sigma, observations a step of cumulative bucket counters (keys, le as number, timestamp, value)."""
    rises = bucket_rises(shipped(df), keys)
    kinds = dict(df.dtypes)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("le")
        mu, sigma = fit_lognormal(pdf["le"].to_numpy(float), pdf["n"].to_numpy(float))
        return pd.DataFrame({**{k: [pdf[k].iloc[0]] for k in keys}, "mu": [mu], "sigma": [sigma], "per_step": [float(pdf["n"].iloc[-1]) / max(1, int(pdf["steps"].max()))]})

    return rises.groupBy(*keys).applyInPandas(fit, ", ".join(f"{k} {kinds[k]}" for k in keys) + ", mu double, sigma double, per_step double")


def shrunk(s: np.ndarray, fourth: float, n: int) -> np.ndarray:
    """A covariance shrunk towards its scaled identity by the amount that the data's own spread tells (Ledoit and Wolf 2004).

    fourth: the sum over n centred rows of their squared length, squared; the rows' distances from s follow from it.
    """
    p = len(s)
    mu = np.trace(s) / p
    target = mu * np.eye(p)
    distance = ((s - target) ** 2).sum() / p
    if distance <= 0:
        return target
    noise = (fourth - n * (s**2).sum()) / (n * n * p)
    share = min(1.0, max(0.0, noise) / distance)
    return share * target + (1 - share) * s


def shrunk_covariance(x: np.ndarray) -> np.ndarray:
    """shrunk of the columns' covariance."""
    x = x - x.mean(axis=0)
    return shrunk(x.T @ x / len(x), float(((x * x).sum(axis=1) ** 2).sum()), len(x))


def service_covariance(df: DataFrame, service: str = "service", series: str = "series", chunk: int = 4096) -> DataFrame:
    """service, series (sorted), covariance (rows): counters as rises, gauges as values, trimmed to the shortest series.

    df: service, series, is_counter, timestamp, value.  Series of under 3 values are left out.  Sums of products are made of
    ``chunk`` times of a service at a time and added up, so no task gets a service's samples whole; the covariance of what a
    service has is shrunk as shrunk_covariance does it.
    """
    over = Window.partitionBy(service, series).orderBy("timestamp")
    step = F.col("value") - F.lag("value").over(over)
    rise = F.greatest(F.when(step < 0, F.col("value")).otherwise(step), F.lit(0.0))
    rows = df.withColumn("__v", F.when(F.col("is_counter"), F.when(step.isNotNull(), rise)).otherwise(F.col("value"))).where("__v IS NOT NULL")
    rows = rows.select(service, series, "__v", (F.row_number().over(over) - 1).alias("__i"))
    lengths = rows.groupBy(service, series).agg(F.count("*").alias("n")).where("n > 2")
    shortest = lengths.groupBy(F.col(service).alias("__of")).agg(F.min("n").alias("__n"), F.sort_array(F.collect_list(series)).alias("__names"))
    rows = rows.join(lengths.select(F.col(service).alias("__s"), F.col(series).alias("__r")), (F.col(service) == F.col("__s")) & (F.col(series) == F.col("__r")))
    rows = rows.join(shortest, F.col(service) == F.col("__of")).where("__i < __n")
    means = rows.groupBy(F.col(service).alias("__ms"), F.col(series).alias("__mr")).agg(F.avg("__v").alias("__mean"))
    rows = rows.join(means, (F.col(service) == F.col("__ms")) & (F.col(series) == F.col("__mr")))
    rows = rows.select(F.col(service), F.col(series), (F.col("__v") - F.col("__mean")).alias("v"), F.col("__i").alias("i"), F.floor(F.col("__i") / chunk).alias("part"))

    def products(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.pivot(index="i", columns=series, values="v").sort_index(axis=1).to_numpy(float)
        return pd.DataFrame({service: [pdf[service].iloc[0]], "products": [(x.T @ x).ravel()], "fourth": [float(((x * x).sum(axis=1) ** 2).sum())], "n": [len(x)]})

    parts = shipped(rows).groupBy(service, "part").applyInPandas(products, f"{service} string, products array<double>, fourth double, n bigint")
    cells = parts.select(service, F.posexplode("products").alias("at", "x")).groupBy(service, "at").agg(F.sum("x").alias("x"))
    sums = cells.groupBy(service).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda c: c["x"]).alias("products"))
    sizes = parts.groupBy(service).agg(F.sum("fourth").alias("fourth"), F.sum("n").alias("n"))
    names = shortest.select(F.col("__of").alias(service), F.col("__names").alias("series"))

    @F.pandas_udf("array<array<double>>")
    def shrink(products: pd.Series, fourth: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([shrunk(np.asarray(s, dtype=float).reshape(round(len(s) ** 0.5), -1) / k, f, k).tolist() for s, f, k in zip(products, fourth, n)])

    return sums.join(sizes, service).join(names, service).select(service, "series", shrink("products", "fourth", "n").alias("covariance"))


def load_statistics(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Per-endpoint statistics of load reports (JSON with stats), by requests a second; the total is marked."""
    schema = "stats array<struct<name: string, method: string, num_requests: bigint, num_failures: bigint, avg_response_time: double, current_rps: double>>"
    rows = df.select(F.explode(F.from_json(payload, schema)["stats"]).alias("s")).select("s.*")
    return rows.withColumn("is_total", F.col("name") == "Aggregated").orderBy("is_total", F.desc("current_rps"), "name")


def univariate(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).summary("count", "mean", "stddev", "min", "50%", "max")


def bivariate(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(F.corr(a, b).alias("corr"), F.covar_samp(a, b).alias("covariance"), F.regr_slope(b, a).alias("slope"))


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    return df.where(F.col(value).isNotNull()).groupBy(F.width_bucket(value, F.lit(low), F.lit(high), F.lit(bins)).alias("bin")).agg(F.count("*").alias("n"))
