"""Samples to a wide, schema-stable feature table (X1-X3, P9-P14, C32, R3), with the column registry and the label schema."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import INTERNAL, OTHER, classify_label, entity_key, signal_key
from ..functions.names import metric_family
from ..functions.operations import http_method, messaging_operation, operation_bucket, rpc_operation
from ..functions.routes import parameterize_route
from ..functions.status import CORE, status_bucket
from ..operators.aggregates import described, long_features
from ..operators.filters import by_service, salient_metrics
from ..operators.frame import align_columns, features_of, few, pivot
from ..operators.windows import delta_features, tumbling
from ..session import bounded, checkpointed

# Fixed value: labels that are dropped by default.
FORCE_DROP = ("otel_scope_name", "otel_scope_version", "telemetry_sdk_language", "telemetry_sdk_name", "telemetry_sdk_version")
#: Distinct label names and schema rules up to which the rewrite is one expression.
MAX_RULES = 400
#: Rules, and label names, that the driver takes.
MAX_SCHEMA = 200_000


@dataclass
class Registry:
    """Append-only list of columns; new ones come in sorted order."""

    index: list[str] = field(default_factory=lambda: ["timestamp", "entity_key"])
    columns: list[str] = field(default_factory=list)

    def register(self, names: Iterable[str]) -> list[str]:
        new = sorted(set(names) - set(self.columns) - set(self.index))
        self.columns.extend(new)
        return new

    def missing(self, names: Iterable[str]) -> list[str]:
        have = set(names)
        return [c for c in self.columns if c not in have]

    def diff(self, other: Registry) -> dict[str, list[str]]:
        return {"added": [c for c in self.columns if c not in other.columns], "removed": [c for c in other.columns if c not in self.columns]}

    def align(self, df: DataFrame, fill: float | None = None, register_new: bool = True) -> DataFrame:
        """Index columns and registered columns, missing ones filled, others dropped."""
        if register_new:
            self.register(df.columns)
        index = [c for c in self.index if c in df.columns]
        return align_columns(df.select(*index, *[c for c in df.columns if c in set(self.columns)]), [*index, *self.columns], fill)

    def save(self, path: str) -> None:
        Path(path).write_text(json.dumps({"index_cols": self.index, "columns": self.columns, "column_count": len(self.columns)}, indent=1))

    @classmethod
    def load(cls, path: str) -> Registry:
        if not Path(path).exists():
            return cls()
        held = json.loads(Path(path).read_text())
        return cls(held["index_cols"], held["columns"])


@dataclass(frozen=True)
class Rule:
    action: str = "keep"
    bucket_type: str | None = None
    top_values: tuple[str, ...] = ()


def rules_of(schema: DataFrame) -> dict[tuple[str, str], Rule]:
    """Rules by (family, label) of a schema table; one row a label of a family, not of a sample; more than MAX_SCHEMA are an error."""
    return {(r.family, r.label): Rule(r.action, r.bucket_type, tuple(r.top_values or ())) for r in few(schema, MAX_SCHEMA, "rules")}


def bucketed(value: Column, kind: str | None, label: str, more: bool = False) -> Column:
    """The value in its bucket; rpc and messaging values stay as they are unless ``more``."""
    known = {"status_code": lambda v: status_bucket(v, label), "http_method": http_method, "operation": operation_bucket, "route": parameterize_route}
    if more:
        known |= {"rpc_operation": rpc_operation, "messaging": messaging_operation}
    return known[kind](value) if kind in known else value


def label_names(df: DataFrame) -> list[str]:
    """Distinct label names of the data; a small job; more than MAX_SCHEMA are an error."""
    return sorted(r[0] for r in few(df.select(F.explode(F.map_keys("labels")).alias("k")).distinct(), MAX_SCHEMA, "label names"))


def rewrite_labels(df: DataFrame, rules: dict[tuple[str, str], Rule] | None = None, force_drop: Sequence[str] = FORCE_DROP, names: Sequence[str] | None = None, drop_correlation: bool = False, topn_before_bucket: bool = False, all_buckets: bool = False) -> DataFrame:
    """df with labels bucketed, cut to top values or dropped, and signal_key.

    A label that the schema has follows its rule for the family; any other is bucketed if it is a signal label. Buckets come before
    the top values are looked up, unless topn_before_bucket. le and quantile always stay.
    """
    rules = rules or {}
    names = label_names(df) if names is None else names
    if len(names) + len(rules) > MAX_RULES:
        return _rewrite_long(df, rules, force_drop, names, drop_correlation, topn_before_bucket, all_buckets)
    family = F.col("__family")
    kept = []
    for name in names:
        if name in force_drop and name not in INTERNAL:
            continue
        value = F.col("labels")[name]
        kind = classify_label(name)
        new = F.when(value.isNull(), F.lit(None).cast("string"))
        for (of, label), rule in rules.items():
            if label == name:
                new = new.when(family == of, _ruled(value, rule, name, topn_before_bucket, all_buckets))
        if drop_correlation and kind.category == "correlation":
            new = new.otherwise(F.lit(None).cast("string"))
        else:
            new = new.otherwise(bucketed(value, kind.bucket_type if kind.category == "signal" else None, name, all_buckets))
        kept.append(F.struct(F.lit(name).alias("key"), new.alias("value")))
    entries = F.filter(F.array(*kept), lambda e: e["value"].isNotNull()) if kept else F.array().cast("array<struct<key:string,value:string>>")
    out = df.withColumn("__family", metric_family("metric")).withColumn("labels", F.map_from_entries(entries)).drop("__family")
    return out.withColumn("signal_key", signal_key("labels"))


def _ruled(value: Column, rule: Rule, name: str, topn_first: bool, all_buckets: bool) -> Column:
    if rule.action == "drop" and name not in INTERNAL:
        return F.lit(None).cast("string")
    new = bucketed(value, rule.bucket_type, name, all_buckets)
    if rule.action == "top_n" and rule.top_values:
        return F.when(value.isin(*rule.top_values), value).otherwise(OTHER) if topn_first else F.when(new.isin(*rule.top_values), new).otherwise(OTHER)
    return new


def _rewrite_long(df, rules, force_drop, names, drop_correlation, topn_first, all_buckets) -> DataFrame:
    """The same for very many rules: distinct (family, label, value) are rewritten once each in a table that samples join."""
    spark = df.sparkSession
    rows = df.withColumn("__id", F.xxhash64("metric", F.to_json("labels")))
    series = rows.select("__id", metric_family("metric").alias("family"), "labels").dropDuplicates(["__id"])
    cells = series.select("__id", "family", F.explode("labels").alias("label", "value"))
    table = spark.createDataFrame([(f, n, r.action, r.bucket_type, list(r.top_values)) for (f, n), r in rules.items()], "family string, label string, action string, bucket_type string, top array<string>")
    kinds = {n: classify_label(n) for n in names}
    plain = spark.createDataFrame([(n, k.category, k.bucket_type if k.category == "signal" else None) for n, k in kinds.items()], "label string, category string, plain_bucket string")
    cells = cells.join(bounded(table), ["family", "label"], "left").join(bounded(plain), "label", "left")
    if force_drop:
        cells = cells.where(~F.col("label").isin(*force_drop) | F.col("label").isin(*INTERNAL))
    has_rule, value = F.col("action").isNotNull(), F.col("value")
    kind = F.when(has_rule, F.col("bucket_type")).otherwise(F.col("plain_bucket"))
    new = F.when((kind == "status_code") & F.lower("label").contains("grpc"), status_bucket(value, "grpc")).when((kind == "status_code") & F.lower("label").contains("http"), status_bucket(value, "http")).when(kind == "status_code", status_bucket(value))
    for k in ("http_method", "operation", "route", *(("rpc_operation", "messaging") if all_buckets else ())):
        new = new.when(kind == k, bucketed(value, k, "", all_buckets))
    new = new.otherwise(value)
    tested = value if topn_first else new
    new = F.when((F.col("action") == "top_n") & (F.size("top") > 0), F.when(F.array_contains("top", tested), tested).otherwise(OTHER)).otherwise(new)
    gone = (F.col("action") == "drop") & ~F.col("label").isin(*INTERNAL)
    if drop_correlation:
        gone = gone | (~has_rule & (F.col("category") == "correlation"))
    cells = cells.where(~F.coalesce(gone, F.lit(False)))
    maps = cells.groupBy("__id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("label").alias("key"), new.alias("value"))))).alias("__new"))
    empty = F.create_map().cast("map<string,string>")
    out = rows.join(maps, "__id", "left").withColumn("labels", F.coalesce("__new", empty)).drop("__id", "__new")
    return out.withColumn("signal_key", signal_key("labels"))


def keyed(df: DataFrame, rules: dict[tuple[str, str], Rule] | None = None, force_drop: Sequence[str] = FORCE_DROP, entity_labels: Sequence[str] | None = None, **options) -> tuple[DataFrame, bool]:
    """df (metric, labels, ...) with what its series say: rewritten labels, signal_key, entity_key and the columns of ``described``; and whether there is a bucket.

    Every distinct series is rewritten once, in a table of its own that the samples join: they are read once for it, and never
    rewritten themselves.  The table is broadcast if a count allows it.
    """
    entries = F.map_entries("labels")
    series = checkpointed(df.select("metric", "labels", F.xxhash64("metric", entries).alias("__id")).groupBy("__id", "metric").agg(F.first("labels").alias("labels")))
    made = rewrite_labels(series, rules, force_drop, **options)
    made = described(made.withColumn("entity_key", entity_key("labels", list(entity_labels) if entity_labels else None)))
    made = checkpointed(made.select(F.col("__id").alias("__of"), F.col("metric").alias("__metric"), "labels", "signal_key", "entity_key", "metric_family", "kind", "service", "le", "total"))
    buckets = not made.where("kind = 'histogram'").isEmpty()
    rows = df.withColumn("__id", F.xxhash64("metric", entries)).drop("labels")
    out = rows.join(bounded(made), (F.col("__id") == F.col("__of")) & (F.col("metric") == F.col("__metric"))).drop("__id", "__of", "__metric")
    return out, buckets


def named_features(long: DataFrame, with_service: bool = False) -> DataFrame:
    """long with feature: family__aggregation, then the signal key, with the service before it if wanted."""
    base = F.concat_ws("__", F.when(F.lit(with_service) & (F.col("service") != "unknown"), F.col("service")), "metric_family", "aggregation", F.nullif("signal_key", F.lit("")))
    return long.withColumn("feature", base)


def status_complete(names: Iterable[str]) -> list[str]:
    """The names, and those that other core status classes of the same feature would have."""
    names = list(names)
    bases = {n[: -len(s) - 2] for n in names for s in CORE if n.endswith(f"__{s}")}
    return sorted(set(names) | {f"{b}__{s}" for b in bases for s in CORE})


def add_error_flag(df: DataFrame, status: str, values: Sequence[str] = ("client_error", "server_error", "error")) -> DataFrame:
    return df.withColumn("is_error", F.col(status).isin(*values).cast("int")) if status in df.columns else df


def denormalize(
    raw: DataFrame,
    schema: DataFrame | dict | None = None,
    registry: Registry | None = None,
    window_seconds: float = 60,
    include_deltas: bool = True,
    entity_labels: Sequence[str] | None = None,
    unique_timestamps: bool = False,
    counters: Sequence[str] | None = ("count",),
    gauges: Sequence[str] | None = ("mean",),
    counter_mode: str = "parity",
    force_drop: Sequence[str] = FORCE_DROP,
    features: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """Wide table (timestamp, entity_key or not, a column a feature) of samples (timestamp, metric, labels, value).

    Labels are rewritten and keys made once a series.  The samples are then read once more (twice with histograms) and aggregated
    with one shuffle on the keys (histograms one more) into the long table, which is checkpointed: the list of features, unless
    it is given, and the pivot both come from there.
    """
    rules = rules_of(schema) if isinstance(schema, DataFrame) else schema
    rows, buckets = keyed(raw, rules, force_drop, entity_labels, **options)
    long = checkpointed(named_features(long_features(rows, counters, gauges, window_seconds, counter_mode, buckets), unique_timestamps))
    index = ["timestamp"] if unique_timestamps else ["timestamp", "entity_key"]
    if features is None:
        features = features_of(long.where("value IS NOT NULL"), "feature")
    features = list(features)
    if not features:
        return long.select(*index).distinct().limit(0)
    wide = pivot(long, index, "feature", "value", features, "first", "entity_key")
    wide = align_columns(wide, [*index, *status_complete(features)])
    if include_deltas:
        wide = delta_features(wide, [c for c in wide.columns if c not in index], index[1:])
    return registry.align(wide) if registry else wide


def windowed(raw: DataFrame, window_minutes: float, step_seconds: float, services: Sequence[str] | None = None, salient: bool = False, **options) -> DataFrame:
    """denormalize of all tumbling windows in one table: window_start is one more key, carried inside the entity key's group."""
    rows = raw
    if salient:
        names = raw.groupBy("metric").agg(F.count("*").alias("n")).select("metric", F.dense_rank().over(_by_name()).alias("place"))
        rows = rows.join(salient_metrics(names).select("metric"), "metric", "left_semi")
    if services:
        rows = by_service(rows, services)
    starts = tumbling(rows, window_minutes, step_seconds).withColumn("timestamp", F.col("window_start")).drop("window_start", "window_end")
    return denormalize(starts, window_seconds=window_minutes * 60, **options)


def _by_name():
    from pyspark.sql import Window

    return Window.orderBy("metric")
