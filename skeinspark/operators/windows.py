"""Time windows, resampling and lag features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.base import present
from ..functions.labels import labels_json
from ..functions.values import floor_time
from .frame import rolling

SERIES = ("metric", "labels_key")


def with_series(df: DataFrame) -> DataFrame:
    """df with labels_key, the labels' canonical text."""
    return df.withColumn("labels_key", labels_json("labels"))


def resample(df: DataFrame, step_seconds: float, keep: str = "last", keys: Sequence[str] = SERIES) -> DataFrame:
    """One row a (floored timestamp, series): the last raw sample's value (the larger of equals), or the first's."""
    pick = F.max_by if keep == "last" else F.min_by
    at = floor_time("timestamp", step_seconds)
    return df.groupBy(*keys, at.alias("timestamp")).agg(pick("value", F.struct("timestamp", "value")).alias("value"), pick("timestamp", F.struct("timestamp", "value")).alias("raw_timestamp"))


def slice_resample(df: DataFrame, names: Sequence[str], start: Column, end: Column, step_seconds: float) -> DataFrame:
    """Samples of some metrics, resampled, whose floored timestamp lies in [start, end]."""
    rows = resample(with_series(df.where(F.col("metric").isin(*names))), step_seconds)
    return rows.where(F.col("timestamp").between(start, end))


def instant(df: DataFrame, at: Column | None = None, keys: Sequence[str] = SERIES) -> DataFrame:
    """The latest sample of each series, at or before a time."""
    rows = df if at is None else df.where(F.col("timestamp") <= at)
    return rows.groupBy(*keys).agg(F.max("timestamp").alias("timestamp"), F.max_by("value", F.struct("timestamp", "value")).alias("value"))


def sample_by_time(df: DataFrame, step_seconds: float, keys: Sequence[str] = SERIES, columns: Sequence[str] = ("value",)) -> DataFrame:
    """First value that is set of each column, and the first raw timestamp, of each (step, series)."""
    at = floor_time("timestamp", step_seconds)
    firsts = [F.min_by(c, F.when(F.col(c).isNotNull(), F.struct("timestamp", c))).alias(c) for c in columns]
    return df.groupBy(*keys, at.alias("step")).agg(F.min("timestamp").alias("timestamp"), *firsts).drop("step")


def scrape_interval(df: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """seconds: the most frequent distance of neighbouring samples of a series (the smaller of equals).

    Distances are counted in whole microseconds; differences of seconds since the epoch would be several doubles for one distance.
    """
    at = F.unix_micros(F.col("timestamp").cast("timestamp"))
    step = at - F.lag(at).over(Window.partitionBy(*keys).orderBy(at))
    counts = df.select(step.alias("step")).where("step > 0").groupBy("step").agg(F.count("*").alias("n"))
    return counts.agg((F.min_by("step", F.struct(-F.col("n"), "step")) / 1_000_000).alias("seconds"))


def tumbling(df: DataFrame, minutes: float, step_seconds: float) -> DataFrame:
    """df with window_start and window_end: half-open windows from the first floored timestamp on; all windows in one table."""
    origin = df.agg(F.min(floor_time("timestamp", step_seconds)).alias("origin"))
    width = int(minutes * 60 * 1_000_000)
    rows = df.join(F.broadcast(origin))
    index = F.floor((F.unix_micros(F.col("timestamp").cast("timestamp")) - F.unix_micros("origin")) / width).cast("bigint")
    start = F.unix_micros("origin") + index * width
    return rows.withColumn("window_start", F.timestamp_micros(start)).withColumn("window_end", F.timestamp_micros(start + width)).drop("origin")


def cumulative(df: DataFrame, keys: Sequence[str] = SERIES, order: str = "timestamp", value: str = "value") -> DataFrame:
    return df.withColumn(value, F.sum(value).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))


def _over(entity: Sequence[str], order: str):
    return Window.partitionBy(*entity).orderBy(order)


def deltas(df: DataFrame, columns: Sequence[str], rows: Sequence[int] = (5, 60), entity: Sequence[str] = ("entity_key",), order: str = "timestamp") -> DataFrame:
    """x__delta_{k}m: x minus x of k rows before; the offset counts rows."""
    over = _over(entity, order)
    return df.withColumns({f"{c}__delta_{k}m": present(c) - F.lag(present(c), k).over(over) for c in columns for k in rows})


def pct_changes(df: DataFrame, columns: Sequence[str], rows: Sequence[int] = (60,), entity: Sequence[str] = ("entity_key",), order: str = "timestamp") -> DataFrame:
    """x__pct_change_{k}m: the change relative to the size of the value k rows before; from 0 null."""
    over = _over(entity, order)
    made = {}
    for c in columns:
        for k in rows:
            old = F.lag(present(c), k).over(over)
            made[f"{c}__pct_change_{k}m"] = F.try_divide(present(c) - old, F.abs(old))
    return df.withColumns(made)


def rollings(df: DataFrame, columns: Sequence[str], size: int = 5, entity: Sequence[str] = ("entity_key",), order: str = "timestamp") -> DataFrame:
    """x__rolling_mean_{n} (from 1 value on) and x__rolling_std_{n} (from 2)."""
    over = _over(entity, order)
    made = {f"{c}__rolling_mean_{size}": rolling(c, size, "mean", over, 1) for c in columns}
    return df.withColumns(made | {f"{c}__rolling_std_{size}": rolling(c, size, "std", over, 2) for c in columns})


def lags(df: DataFrame, columns: Sequence[str], rows: Sequence[int] = (1, 5), entity: Sequence[str] = ("entity_key",), order: str = "timestamp") -> DataFrame:
    over = _over(entity, order)
    return df.withColumns({f"{c}__lag_{k}": F.lag(c, k).over(over) for c in columns for k in rows})


def delta_features(df: DataFrame, columns: Sequence[str], entity: Sequence[str] = ("entity_key",), order: str = "timestamp", with_rolling: bool = False, pct_of_deltas: bool = True) -> DataFrame:
    """Deltas of 5 and 60 rows, percent changes of 60 rows (of the deltas too), and rolling columns if wanted."""
    out = deltas(df, columns, (5, 60), entity, order)
    new = [f"{c}__delta_{k}m" for c in columns for k in (5, 60)] if pct_of_deltas else []
    out = pct_changes(out, [*columns, *new], (60,), entity, order)
    return rollings(out, columns, 5, entity, order) if with_rolling else out


def long_deltas(long: DataFrame, rows: Sequence[int], entity: Sequence[str] = ("entity_key",), order: str = "timestamp") -> DataFrame:
    """The deltas of a long table (entity, timestamp, feature, value), for wide ones with very many features.

    Offsets count the entity's timestamps; each pairs a sample with that feature's value so many timestamps before.
    """
    places = long.select(*entity, order).distinct().withColumn("place", F.row_number().over(_over(entity, order)))
    at = long.join(places, [*entity, order])
    out = at.select(*entity, order, "feature", "value")
    for k in rows:
        old = at.select(*entity, "feature", (F.col("place") + k).alias("place"), F.col("value").alias("old"))
        made = at.join(old, [*entity, "feature", "place"])
        out = out.unionByName(made.select(*entity, order, F.concat("feature", F.lit(f"__delta_{k}m")).alias("feature"), (F.col("value") - F.col("old")).alias("value")))
    return out
