"""The feature table as a stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.labels import entity_key
from ..operators.aggregates import long_features
from ..operators.filters import by_service
from ..session import checkpointed, shipped
from ..sources import payloads, sinks
from ..plans.denormalize import Registry, denormalize, keyed, named_features, rewrite_labels


def window_deltas(current: DataFrame, previous: DataFrame | None, entity: str = "entity_key", order: str = "timestamp") -> DataFrame:
    """current with x__delta_1w: x minus the entity's latest x of the previous window; null for what it lacks."""
    names = [c for c in current.columns if c not in (entity, order)]
    if previous is None:
        return current
    known = [c for c in names if c in previous.columns]
    last = previous.groupBy(entity).agg(*[F.max_by(c, order).alias(f"{c}__prev") for c in known]) if known else previous.select(entity).distinct()
    out = current.join(last, entity, "left")
    made = {f"{c}__delta_1w": F.col(c) - F.col(f"{c}__prev") if c in known else F.lit(None).cast("double") for c in names}
    return out.withColumns(made).drop(*[f"{c}__prev" for c in known])


class Windows:
    """Batch-at-a-time processing: every window becomes a wide table, with deltas to the window before from the second one on."""

    def __init__(self, registry: Registry | None = None, registry_path: str | None = None, lookback: int = 1, **options):
        self.registry = registry or (Registry.load(registry_path) if registry_path else Registry())
        self.path, self.options, self.lookback = registry_path, options, lookback
        self.kept: list[DataFrame] = []
        self.windows = self.rows = 0

    def process(self, raw: DataFrame) -> DataFrame:
        wide = denormalize(raw, registry=self.registry, include_deltas=False, **self.options)
        out = window_deltas(wide, self.kept[-1] if self.kept else None)
        # the latest row of each entity, computed now: the window's own rows may be gone when the next one comes
        last = wide.groupBy("entity_key").agg(F.max_by(F.struct(*[c for c in wide.columns if c != "entity_key"]), "timestamp").alias("x"))
        self.kept = [*self.kept, checkpointed(last.select("entity_key", "x.*"))][-self.lookback :]
        self.windows += 1
        if self.path:
            self.registry.save(self.path)
        return out

    def stats(self) -> dict:
        return {"windows": self.windows, "columns": len(self.registry.columns)}


def run_continuous(stream: DataFrame, callback: Callable[[DataFrame, int], None], checkpoint: str, processor: Windows | None = None, interval: str | None = None):
    """Start a query that hands each micro-batch's features to callback(features, batch); without an interval it takes what is there and ends."""
    processor = processor or Windows()

    def each(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            callback(processor.process(batch), number)

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def long_stream(stream: DataFrame, window: str = "60 seconds", late: str = "10 minutes", entity_labels: Sequence[str] | None = None, names: Sequence[str] = ()) -> DataFrame:
    """Windowed gauge features of a stream (timestamp, metric, labels, value), with late data up to the watermark; label names are given, as a stream has no distinct pass."""
    rows = rewrite_labels(stream.withWatermark("timestamp", late), names=list(names))
    rows = rows.withColumn("entity_key", entity_key("labels", list(entity_labels) if entity_labels else None))
    return rows.groupBy(F.window("timestamp", window), "entity_key", "metric", "signal_key").agg(F.avg("value").alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"), F.count("value").alias("count"))


def stateful_deltas(stream: DataFrame, idle: str | None = None) -> DataFrame:
    """entity_key, feature, timestamp, value, delta to the feature's value before, kept in the stream's state (entity_key, feature, timestamp, value).

    A micro-batch's rows of a feature are put in order of time before deltas are taken, however many Arrow frames bring them; a
    row older than the state's is measured against the state's value all the same, and does not become the state.  State that
    gets no row for ``idle`` of processing time goes, if that is given.
    """
    limit = None if idle is None else int(pd.Timedelta(idle).total_seconds() * 1000)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last, at = state.get if state.exists else (None, None)
        held = list(frames)
        if held:
            pdf = pd.concat(held, ignore_index=True).sort_values("timestamp", kind="stable")
            before = pdf["value"].shift(1)
            if last is not None and len(before):
                before.iloc[0] = last
            if len(pdf) and (at is None or pdf["timestamp"].iloc[-1].value >= at):
                last, at = float(pdf["value"].iloc[-1]), int(pdf["timestamp"].iloc[-1].value)
            yield pdf.assign(delta=pdf["value"] - before)
        if last is not None:
            state.update((last, at))
            if limit:
                state.setTimeoutDuration(limit)

    out = "entity_key string, feature string, timestamp timestamp, value double, delta double"
    timeout = GroupStateTimeout.ProcessingTimeTimeout if limit else GroupStateTimeout.NoTimeout
    return shipped(stream).select("entity_key", "feature", "timestamp", "value").groupBy("entity_key", "feature").applyInPandasWithState(step, out, "last double, at bigint", "append", timeout)


def buffered(stream: DataFrame, retention: str = "24 hours") -> DataFrame:
    """A stream of typed samples without repeats; state older than the retention goes."""
    keyed = stream.withColumn("labels_key", F.to_json(F.map_from_entries(F.array_sort(F.map_entries("labels")))))
    return keyed.withWatermark("timestamp", retention).dropDuplicates(["timestamp", "metric", "labels_key"]).drop("labels_key")


def type_registry(samples: DataFrame) -> DataFrame:
    """metric, dd_type: the latest type of each metric."""
    return samples.groupBy("metric").agg(F.max_by("dd_type", F.struct("timestamp", "dd_type")).alias("dd_type"))


def checkpoint_row(samples: DataFrame) -> DataFrame:
    """last_event and rows: what a periodic checkpoint keeps, by event time."""
    return samples.agg(F.max("timestamp").alias("last_event"), F.count("*").alias("rows"))


def poll_window(samples: DataFrame, end, window_seconds: float) -> DataFrame:
    """Samples of [end - window, end]."""
    stop = F.lit(end).cast("timestamp")
    return samples.where(F.col("timestamp").between(stop - F.make_dt_interval(secs=F.lit(window_seconds)), stop))


def long_table(raw: DataFrame, **options) -> DataFrame:
    """The named long features of a batch, for stateful_deltas."""
    rows, buckets = keyed(raw)
    return named_features(long_features(rows, with_histograms=buckets, **options)).select("entity_key", "feature", "timestamp", "value")


def landing(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of typed samples of the intake bodies (JSON lines) that arrive as files in a folder."""
    return payloads.dd_intake(spark.readStream.text(folder).select(F.col("value").alias("payload")))


def collect_metrics(otlp_rows: DataFrame, services: Sequence[str] = (), prefix: str = "sml.", **options) -> DataFrame:
    """OTLP payloads in, OTLP payloads of the feature table out: one batch of the collector's processor, without memory of others."""
    rows = payloads.otlp(otlp_rows)
    if services:
        rows = by_service(rows, services)
    return sinks.wide_to_otlp(denormalize(rows, **options), prefix)
