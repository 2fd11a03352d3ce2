"""Aggregation by metric type: counters, gauges, histograms, and the long feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.base import col, present
from ..functions.labels import service_name
from ..functions.names import TYPE_AGGREGATIONS, metric_family, metric_type
from ..functions.values import epoch_seconds, ratio

PERCENTILES = (0.5, 0.75, 0.9, 0.95, 0.99)
LONG_KEYS = ("timestamp", "entity_key", "metric_family", "signal_key")


def counter(value: Column | str, ts: Column | str, window_seconds: float) -> tuple[Column, Column]:
    """Aggregates (rate, count) of a cumulative counter: last minus first, or last after a reset; fewer than two points are 0."""
    v, at = present(value), epoch_seconds(ts)
    seen = F.when(v.isNotNull(), at)
    first, last = F.min_by(v, F.struct(seen, v)), F.max_by(v, F.struct(seen, v))
    delta = F.when(last < first, last).otherwise(last - first)
    span = F.max(seen) - F.min(seen)
    enough = F.count(v) >= 2
    rate = delta / F.when(span > 0, span).otherwise(float(window_seconds))
    return F.when(enough, rate).otherwise(0.0), F.when(enough, delta).otherwise(0.0)


def counter_rates(df: DataFrame, keys: Sequence[str], value: str = "value", ts: str = "timestamp", window_seconds: float = 60) -> DataFrame:
    rate, count = counter(value, ts, window_seconds)
    return df.groupBy(*keys).agg(rate.alias("rate_per_sec"), count.alias("count"))


def with_resets(df: DataFrame, keys: Sequence[str], order: str, value: str = "value", share: float = 1.0) -> DataFrame:
    """df with reset (value fell below share of the one before) and segment (resets so far)."""
    over = Window.partitionBy(*keys).orderBy(order)
    reset = F.coalesce(F.col(value) < F.lag(value).over(over) * share, F.lit(False))
    return df.withColumn("reset", reset).withColumn("segment", F.sum(F.col("reset").cast("bigint")).over(over))


def counter_with_resets(df: DataFrame, keys: Sequence[str], order: str = "timestamp", value: str = "value", share: float = 0.5) -> DataFrame:
    """Sum of each segment's rise, and how many resets there were."""
    parts = with_resets(df, keys, order, value, share).groupBy(*keys, "segment").agg((F.max_by(value, order) - F.min_by(value, order)).alias("rise"))
    return parts.groupBy(*keys).agg(F.sum(F.greatest(F.col("rise"), F.lit(0.0))).alias("count"), F.max("segment").alias("resets"))


def gauge(value: Column | str, ts: Column | str) -> dict[str, Column]:
    """Aggregates last (may be null), mean, min, max and stddev (0 for one value)."""
    v = present(value)
    return {"last": F.max_by(v, col(ts)), "mean": F.avg(v), "min": F.min(v), "max": F.max(v), "stddev": F.when(F.count(v) > 0, F.coalesce(F.stddev_samp(v), F.lit(0.0)))}


def gauge_stats(df: DataFrame, keys: Sequence[str], value: str = "value", ts: str = "timestamp") -> DataFrame:
    return df.groupBy(*keys).agg(*[x.alias(k) for k, x in gauge(value, ts).items()])


def bound(le: Column | str) -> Column:
    """A bucket's upper bound as a number."""
    return F.when(F.coalesce(col(le), F.lit("+Inf")).isin("+Inf", "Inf"), F.lit(float("inf"))).otherwise(col(le).try_cast("double"))


def percentile(buckets: Column, p: float) -> Column:
    """Percentile from an array of struct(le, n), in order of le, n cumulative: linear inside a bucket, the last finite bound in the open one."""
    total = F.element_at(buckets, -1)["n"]
    at = F.transform(buckets, lambda b, i: F.struct(b["le"].alias("le"), b["n"].alias("n"), F.when(i > 0, F.get(buckets, i - 1)["le"]).otherwise(0.0).alias("low"), F.when(i > 0, F.get(buckets, i - 1)["n"]).otherwise(0.0).alias("before")))
    hit = F.get(F.filter(at, lambda b: b["n"] >= p * total), 0)
    inside = hit["low"] + (p * total - hit["before"]) / F.nullif(hit["n"] - hit["before"], F.lit(0.0)) * (hit["le"] - hit["low"])
    value = F.when(hit["n"] == hit["before"], hit["le"]).when(hit["le"] == float("inf"), hit["low"]).otherwise(inside)
    return F.when(F.size(buckets) == 0, 0.0).when(total == 0, 0.0).otherwise(value)


def histograms(df: DataFrame, keys: Sequence[str], percentiles: Sequence[float] = PERCENTILES, service: str | None = None) -> DataFrame:
    """df (keys, metric, labels with le, or le, value) -> p50 ..., mean, count, sum, and the smallest service of a bucket row if wanted; keys without bucket rows give nothing.

    Counts of equal bounds are added first, so the number of series of a family does not meet in one group.
    """
    part = F.regexp_extract("metric", "_(bucket|sum|count)$", 1)
    le = F.col("le") if "le" in df.columns else F.col("labels")["le"]
    owner = (F.col(service) if service else F.lit(None).cast("string")).alias("owner")
    rows = df.select(*keys, part.alias("part"), F.when(part == "bucket", bound(le)).alias("le"), present("value").alias("v"), owner).where(part != "")
    merged = rows.groupBy(*keys, "part", "le").agg(F.sum("v").alias("n"), F.min("owner").alias("owner"))
    one = merged.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.when(F.col("part") == "bucket", F.struct("le", F.coalesce("n", F.lit(0.0)).alias("n"))))).alias("buckets"),
        F.max(F.when(F.col("part") == "sum", F.col("n"))).alias("s"),
        F.max(F.when(F.col("part") == "count", F.col("n"))).alias("c"),
        F.min(F.when(F.col("part") == "bucket", F.col("owner"))).alias("owner"),
    ).where(F.size("buckets") > 0)
    count = F.coalesce("c", F.element_at("buckets", -1)["n"])
    total = F.coalesce("s", F.lit(0.0))
    return one.select(*keys, *[percentile(F.col("buckets"), p).alias(f"p{round(100 * p)}") for p in percentiles], ratio(total, count).alias("mean"), count.alias("count"), total.alias("sum"), *([F.col("owner").alias(service)] if service else []))


def histograms_as_counters(df: DataFrame, keys: Sequence[str], window_seconds: float = 60) -> DataFrame:
    """rate and count from _count rows, sum_rate and sum from _sum rows, mean of the two rates."""
    per_time = df.groupBy(*keys, "timestamp").agg(F.sum(F.when(F.col("metric").endswith("_count"), F.col("value"))).alias("c"), F.sum(F.when(F.col("metric").endswith("_sum"), F.col("value"))).alias("s"))
    (rate, count), (sum_rate, total) = counter("c", "timestamp", window_seconds), counter("s", "timestamp", window_seconds)
    out = per_time.groupBy(*keys).agg(rate.alias("rate"), count.alias("count"), sum_rate.alias("sum_rate"), total.alias("sum"))
    return out.withColumn("mean", F.when(F.col("rate") > 0, F.col("sum_rate") / F.col("rate")))


def described(df: DataFrame) -> DataFrame:
    """df (metric, labels) with metric_family, kind, service and le, what a series' name and labels say, unless it has them."""
    made = {"metric_family": metric_family("metric"), "kind": metric_type("metric"), "service": service_name("labels"), "le": F.col("labels")["le"], "total": F.col("metric").endswith("_total")}
    return df.withColumns({k: x for k, x in made.items() if k not in df.columns})


def long_features(df: DataFrame, counters: Sequence[str] | None = ("count",), gauges: Sequence[str] | None = ("mean",), window_seconds: float = 60, counter_mode: str = "parity", with_histograms: bool = True) -> DataFrame:
    """Samples (timestamp, entity_key, signal_key, metric, labels, value) -> timestamp, entity_key, metric_family, signal_key, aggregation, value, service.

    Columns of ``described`` are taken as they are; without buckets (with_histograms) the histograms' pass falls away.

    A group with any histogram part is a histogram, else with any counter a counter, else a gauge. counter_mode
    "parity" sees a group's one timestamp, so counters are 0; "windowed" floors timestamps to the window first, so
    that a group spans it. One shuffle on the keys aggregates counters and gauges; histograms take one on keys and bound.
    """
    if counter_mode == "windowed":
        from ..functions.values import floor_time

        df = df.withColumn("at", F.col("timestamp")).withColumn("timestamp", floor_time("timestamp", window_seconds))
    else:
        df = df.withColumn("at", F.col("timestamp"))
    rows = described(df)
    # series of a family are added (counters) or averaged (gauges) at each timestamp before they are aggregated over time
    each = rows.groupBy(*LONG_KEYS, "at").agg(
        F.max(F.col("kind").isin("histogram", "histogram_component")).alias("is_histogram"),
        F.max(F.col("kind") == "counter").alias("is_counter"),
        F.sum(F.when(F.col("total"), present("value"))).alias("total"),
        F.avg(present("value")).alias("value"),
        F.min("service").alias("service"),
    )
    rate, count = counter("total", "at", window_seconds)
    stats = gauge("value", "at")
    wide = each.groupBy(*LONG_KEYS).agg(F.max("is_histogram").alias("is_histogram"), F.max("is_counter").alias("is_counter"), F.count("total").alias("totals"), F.min("service").alias("service"), rate.alias("c_rate"), count.alias("c_count"), *[x.alias(f"g_{k}") for k, x in stats.items()])
    made = lambda names, prefix: F.array(*[F.struct(F.lit(n).alias("aggregation"), F.col(f"{prefix}_{n}").cast("double").alias("value")) for n in names])
    none = F.array().cast("array<struct<aggregation:string,value:double>>")
    of_counter = made([n for n in TYPE_AGGREGATIONS["counter"] if n in counters], "c") if counters else none
    of_gauge = made([n for n in TYPE_AGGREGATIONS["gauge"] if n in gauges], "g") if gauges else none
    parts = F.when(F.col("is_counter"), F.when(F.col("totals") > 0, of_counter).otherwise(none)).otherwise(of_gauge)
    plain = wide.where("NOT is_histogram").select(*LONG_KEYS, "service", F.explode(parts).alias("x")).select(*LONG_KEYS, "x.aggregation", "x.value", "service")
    if not with_histograms:
        return plain
    found = histograms(rows, LONG_KEYS, service="service")
    names = TYPE_AGGREGATIONS["histogram"]
    buckets = found.select(*LONG_KEYS, "service", F.explode(F.array(*[F.struct(F.lit(n).alias("aggregation"), F.col(n).cast("double").alias("value")) for n in names])).alias("x"))
    return plain.unionByName(buckets.select(*LONG_KEYS, "x.aggregation", "x.value", "service"))


def status_rates(df: DataFrame, keys: Sequence[str], status: str = "status", count: str = "count") -> DataFrame:
    """total, error_rate, success_rate and availability of each group from counts by status class."""
    n = F.col(count)
    bad = F.sum(F.when(F.col(status).isin("client_error", "server_error", "error"), n).otherwise(0))
    good = F.sum(F.when(F.col(status) == "success", n).otherwise(0))
    out = df.groupBy(*keys).agg(F.sum(n).alias("total"), bad.alias("errors"), good.alias("successes"))
    return out.select(*keys, "total", ratio("errors", "total").alias("error_rate"), ratio("successes", "total").alias("success_rate"), (1.0 - ratio("errors", "total")).alias("availability"))


def reaggregate(df: DataFrame, step_seconds: float, keys: Sequence[str] = ("metric", "labels_key")) -> DataFrame:
    """Typed samples (keys, dd_type, timestamp, value) in windows from the oldest one on: gauges last, counts summed, rates averaged."""
    origin = df.agg(F.min(epoch_seconds("timestamp"))).first()[0] or 0.0
    index = F.floor((epoch_seconds("timestamp") - origin) / step_seconds)
    value = F.when(F.max("dd_type") == "count", F.sum("value")).when(F.max("dd_type") == "rate", F.avg("value")).otherwise(F.max_by("value", F.struct("timestamp", "value")))
    out = df.groupBy(*keys, index.alias("window")).agg(value.alias("value"), F.max("dd_type").alias("dd_type"))
    return out.withColumn("timestamp", F.timestamp_micros(((F.col("window") * step_seconds + origin) * 1_000_000).cast("bigint")))
