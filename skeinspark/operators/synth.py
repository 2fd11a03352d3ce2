"""Synthetic series, histograms and traces from profiles, and scenarios of regimes."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship, shipped
from .profile import compare

PHI_MOST, NOISE_LEAST, STD_LEAST = 0.99, 0.01, 0.01


def seeded(seed: int, *keys: object) -> np.random.Generator:
    """A generator that depends on the seed and the keys alone, on every machine."""
    return np.random.default_rng(int.from_bytes(hashlib.sha256(repr((seed, *keys)).encode()).digest()[:8], "big"))


def autoregressive(n: int, mean: float, std: float, phi: float, slope: float = 0.0, low: float | None = None, high: float | None = None, noise: np.ndarray | None = None, rng: np.random.Generator | None = None) -> np.ndarray:
    """n values with the given mean, spread, lag-1 correlation and trend, within the bounds."""
    phi = float(np.clip(phi, -PHI_MOST, PHI_MOST))
    noise = rng.standard_normal(n) if noise is None else noise
    scale = std * np.sqrt(max(NOISE_LEAST, 1 - phi * phi))
    out = np.empty(n)
    state = std * noise[0] if n else 0.0
    for i in range(n):
        state = phi * state + scale * noise[i] if i else state
        out[i] = state
    out += mean + slope * (np.arange(n) - (n - 1) / 2)
    return np.clip(out, low, high) if low is not None or high is not None else out


def correlated_noise(covariance: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """n rows of standard normal noise with the covariance's correlations; a matrix that is none is brought to the nearest by its eigenvalues."""
    spread = np.sqrt(np.clip(np.diag(covariance), 1e-12, None))
    corr = covariance / np.outer(spread, spread)
    values, vectors = np.linalg.eigh((corr + corr.T) / 2)
    fixed = vectors @ np.diag(np.clip(values, 1e-8, None)) @ vectors.T
    root = np.sqrt(np.diag(fixed))
    return rng.standard_normal((n, len(corr))) @ np.linalg.cholesky(fixed / np.outer(root, root) + 1e-10 * np.eye(len(corr))).T


def series(profiles: DataFrame, n: int, start: str, step_seconds: float, seed: int = 0) -> DataFrame:
    """Samples of profiles (metric, labels_key, kind, mean, std, autocorr, slope, min, max): gauges as they come, counters as running sums of rates."""
    at = pd.Timestamp(start)

    def run(frames):
        for pdf in frames:
            for p in pdf.itertuples():
                x = autoregressive(n, p.mean, p.std, p.autocorr, p.slope, p.min, p.max, rng=seeded(seed, p.metric, p.labels_key))
                if p.kind == "counter":
                    x = np.cumsum(np.clip(x, 0, None))
                yield pd.DataFrame({"timestamp": at + pd.to_timedelta(np.arange(n) * step_seconds, unit="s"), "metric": p.metric, "labels_key": p.labels_key, "value": x})

    wanted = shipped(profiles).select("metric", "labels_key", "kind", *[F.col(c).cast("double").alias(c) for c in ("mean", "std", "autocorr", "slope", "min", "max")])
    return wanted.mapInPandas(run, "timestamp timestamp, metric string, labels_key string, value double")


def correlated_series(profiles: DataFrame, covariances: DataFrame, n: int, start: str, step_seconds: float, seed: int = 0) -> DataFrame:
    """Samples of a service's series together: profiles (service, series, mean, std, autocorr, slope, min, max), covariances (service, series, covariance)."""
    at = pd.Timestamp(start)

    def one(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty:
            return pd.DataFrame({"timestamp": [], "service": [], "series": [], "value": []})
        service = left["service"].iloc[0]
        rng = seeded(seed, service)
        noise: dict[str, np.ndarray] = {}
        if not right.empty:
            cov = np.array([list(r) for r in right["covariance"].iloc[0]], dtype=float)
            noise = dict(zip(right["series"].iloc[0], correlated_noise(cov, n, rng).T))
        out = []
        for p in left.sort_values("series").itertuples():
            x = autoregressive(n, p.mean, p.std, p.autocorr, p.slope, p.min, p.max, noise.get(p.series), rng)
            out.append(pd.DataFrame({"timestamp": at + pd.to_timedelta(np.arange(n) * step_seconds, unit="s"), "service": service, "series": p.series, "value": x}))
        return pd.concat(out)

    return shipped(profiles).groupBy("service").cogroup(covariances.groupBy("service")).applyInPandas(one, "timestamp timestamp, service string, series string, value double")


def histograms(profiles: DataFrame, bounds: Sequence[float], n: int, start: str, step_seconds: float, seed: int = 0) -> DataFrame:
    """Cumulative bucket, sum and count samples of profiles (family, mu, sigma, per_step)."""
    at, edges = pd.Timestamp(start), np.array(sorted(bounds))

    def run(frames):
        for pdf in frames:
            for p in pdf.itertuples():
                rng = seeded(seed, p.family)
                buckets, total, count, out = np.zeros(len(edges)), 0.0, 0, []
                for i in range(n):
                    drawn = rng.lognormal(p.mu, p.sigma, max(0, round(rng.normal(p.per_step, np.sqrt(max(p.per_step, 0))))))
                    buckets += (drawn[:, None] <= edges).sum(axis=0)
                    total, count = total + drawn.sum(), count + len(drawn)
                    ts = at + pd.Timedelta(seconds=i * step_seconds)
                    out += [(ts, f"{p.family}_bucket", f"{e:g}", float(b)) for e, b in zip(edges, buckets)]
                    out += [(ts, f"{p.family}_bucket", "+Inf", float(count)), (ts, f"{p.family}_sum", None, total), (ts, f"{p.family}_count", None, float(count))]
                yield pd.DataFrame(out, columns=["timestamp", "metric", "le", "value"])

    return shipped(profiles).select("family", "mu", "sigma", "per_step").mapInPandas(run, "timestamp timestamp, metric string, le string, value double")


def spans(templates: DataFrame, start: str, seconds: int, rate: float, seed: int = 0) -> DataFrame:
    """Spans of traces that arrive at ``rate`` a second; templates: template, weight, spans (array of path, service_name, operation_name, mean_us, std_us, error_rate).

    A step of one second is a row, so that seconds spread over tasks; arrivals, templates and durations depend on the seed and the second.
    """
    kinds = [(r.template, r.weight, [s.asDict() for s in r.spans]) for r in templates.orderBy("template").collect()]  # a catalog
    at = pd.Timestamp(start)
    columns = ["trace_id", "span_id", "parent_span_id", "service_name", "operation_name", "start_time", "duration_us", "status_code"]

    def run(frames):
        weights = np.array([w for _, w, _ in kinds], dtype=float)
        for pdf in frames:
            out = []
            for second in pdf["id"]:
                rng = seeded(seed, int(second))
                for k in range(rng.poisson(rate)):
                    name, _, parts = kinds[rng.choice(len(kinds), p=weights / weights.sum())]
                    trace = hashlib.sha256(f"{seed}/{second}/{k}/{name}".encode()).hexdigest()[:32]
                    begun = at + pd.Timedelta(seconds=float(second) + rng.random())
                    ends: dict[str, tuple[pd.Timestamp, float]] = {}
                    for p in sorted(parts, key=lambda p: p["path"]):
                        parent = p["path"].rpartition(".")[0]
                        span = hashlib.sha256(f"{trace}/{p['path']}".encode()).hexdigest()[:16]
                        took = max(1.0, rng.normal(p["mean_us"], p["std_us"]))
                        if parent in ends:
                            took = min(took, ends[parent][1])
                            begun_at = ends[parent][0]
                            ends[parent] = (begun_at + pd.Timedelta(microseconds=took), ends[parent][1] - took)
                        else:
                            begun_at = begun
                        ends[p["path"]] = (begun_at, took)
                        of = hashlib.sha256(f"{trace}/{parent}".encode()).hexdigest()[:16] if parent else None
                        out.append((trace, span, of, p["service_name"], p["operation_name"], begun_at, int(took), "ERROR" if rng.random() < p["error_rate"] else "OK"))
            yield pd.DataFrame(out, columns=columns).astype({"start_time": "datetime64[us]", "duration_us": "int64"})

    schema = "trace_id string, span_id string, parent_span_id string, service_name string, operation_name string, start_time timestamp, duration_us bigint, status_code string"
    return ship(templates.sparkSession).range(seconds).mapInPandas(run, schema)


def regime_deltas(baseline: DataFrame, regime: DataFrame, keys: Sequence[str], values: Sequence[str] = ("mean", "std")) -> DataFrame:
    """What a regime changes: compare, with emergent and disappeared for added and removed keys."""
    names = F.when(F.col("state") == "added", "emergent").when(F.col("state") == "removed", "disappeared").otherwise("both")
    return compare(baseline, regime, keys, values).withColumn("state", names)


def superposed(baseline: DataFrame, deltas: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Baseline (keys, mean, std) under several regimes' deltas at once: deltas add up, the spread stays over STD_LEAST, emergent keys come in,
    and a key goes only if every regime that knows it says so."""
    rows = None
    for d in deltas:
        rows = d if rows is None else rows.unionByName(d)
    total = rows.groupBy(*keys).agg(
        F.sum(F.coalesce("mean_delta", F.lit(0.0))).alias("d_mean"),
        F.sum(F.coalesce("std_delta", F.lit(0.0))).alias("d_std"),
        F.bool_and(F.col("state") == "disappeared").alias("gone"),
        F.max(F.when(F.col("state") == "emergent", F.col("mean_new"))).alias("new_mean"),
        F.max(F.when(F.col("state") == "emergent", F.col("std_new"))).alias("new_std"),
    )
    out = baseline.select(*keys, "mean", "std").join(total, list(keys), "full_outer").where(~F.coalesce("gone", F.lit(False)))
    mean = F.when(F.col("mean").isNotNull(), F.col("mean") + F.coalesce("d_mean", F.lit(0.0))).otherwise(F.col("new_mean"))
    std = F.when(F.col("std").isNotNull(), F.greatest(F.col("std") + F.coalesce("d_std", F.lit(0.0)), F.lit(STD_LEAST))).otherwise(F.col("new_std"))
    return out.select(*keys, mean.alias("mean"), std.alias("std"))


def segments(spark, start: str, parts: Sequence[tuple[Sequence[str], float]]) -> DataFrame:
    """Ground truth of a scenario: start_time, end_time, regimes of consecutive parts (regimes, minutes)."""
    at, rows = pd.Timestamp(start, tz="UTC"), []
    for regimes, minutes in parts:
        end = at + pd.Timedelta(minutes=minutes)
        rows.append((at.to_pydatetime(), end.to_pydatetime(), list(regimes)))
        at = end
    return spark.createDataFrame(rows, "start_time timestamp, end_time timestamp, regimes array<string>")


def scenario_size(profiles: int, families: int, buckets: int, parts: Sequence[tuple[Sequence[str], float]], step_seconds: float) -> int:
    """Rows that a scenario will have, without making it."""
    points = sum(int(minutes * 60 // step_seconds) for _, minutes in parts)
    return points * (profiles + families * (buckets + 3))


def labelled(df: DataFrame, truth: DataFrame, ts: str = "timestamp", bucket_seconds: int = 3600) -> DataFrame:
    """df with the regimes of the interval that each timestamp is in: intervals are cut in buckets, so the range join is an equality join on them."""
    seconds = lambda c: F.unix_micros(c.cast("timestamp")) / 1_000_000
    pieces = truth.withColumn("__bucket", F.explode(F.sequence(F.floor(seconds(F.col("start_time")) / bucket_seconds), F.floor((seconds(F.col("end_time")) - 1e-6) / bucket_seconds))))
    rows = df.withColumn("__bucket", F.floor(seconds(F.col(ts)) / bucket_seconds))
    inside = (F.col(f"l.{ts}") >= F.col("r.start_time")) & (F.col(f"l.{ts}") < F.col("r.end_time"))
    return rows.alias("l").join(pieces.alias("r"), (F.col("l.__bucket") == F.col("r.__bucket")) & inside, "left").select(*[F.col(f"l.{c}") for c in df.columns], F.col("r.regimes").alias("regimes"))


def event_intervals(events: DataFrame) -> DataFrame:
    """Experiment events (ts, action, anomaly) as intervals until the next event."""
    return events.withColumn("end_time", F.lead("ts").over(Window.orderBy("ts"))).select(F.col("ts").alias("start_time"), "end_time", F.when(F.col("anomaly"), F.array("action")).otherwise(F.array().cast("array<string>")).alias("regimes"))


def flag_states(events: DataFrame, at: Column | None = None) -> DataFrame:
    """flag, variant: each flag's last variant, at or before a time."""
    rows = events.where("flag IS NOT NULL") if at is None else events.where("flag IS NOT NULL").where(F.col("ts") <= at)
    return rows.groupBy("flag").agg(F.max_by("variant", F.struct("ts", "variant")).alias("variant"))
