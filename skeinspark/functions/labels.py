"""Label names, values and maps."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import col
from .names import sanitize_name


@dataclass(frozen=True)
class Kind:
    category: str
    handling: str
    bucket_type: str | None = None


# What label names mean.
KINDS: tuple[tuple[tuple[str, ...], Kind], ...] = (
    (("service", "service_name", "job", "app", "application"), Kind("resource", "keep")),
    (("instance", "host", "pod", "node", "container", "namespace", "pod_name", "container_name"), Kind("resource", "keep_or_aggregate")),
    (("env", "environment", "deployment", "cluster", "region", "zone", "dc", "datacenter"), Kind("resource", "keep")),
    (("status", "status_code", "http_status_code", "code", "grpc_code", "grpc_status", "response_code"), Kind("signal", "bucket", "status_code")),
    (("error", "exception", "error_type", "exception_type", "exception_class"), Kind("signal", "keep_type")),
    (("error_message", "exception_message", "error_msg"), Kind("signal", "drop")),
    (("method", "http_method", "request_method", "http_request_method"), Kind("dimension", "bucket", "http_method")),
    (("route", "http_route", "uri", "path", "url", "endpoint", "target", "http_target", "url_path"), Kind("dimension", "parameterize_or_top_n", "route")),
    (("operation", "db_operation", "db_statement", "command", "db_system"), Kind("dimension", "bucket", "operation")),
    (("rpc_method", "rpc_service", "grpc_method", "grpc_service"), Kind("dimension", "bucket", "rpc_operation")),
    (("messaging_operation", "messaging_destination", "messaging_system"), Kind("dimension", "bucket", "messaging")),
    (("trace_id", "span_id", "traceid", "spanid"), Kind("correlation", "drop")),
    (("user_id", "userid", "customer_id", "customerid", "account_id"), Kind("correlation", "drop")),
    (("request_id", "requestid", "correlation_id", "correlationid", "session_id", "sessionid"), Kind("correlation", "drop")),
    (("le", "quantile"), Kind("internal", "special")),
    (("version", "sdk_version", "library_version", "otel_scope_version"), Kind("metadata", "drop_or_resource")),
    (("otel_scope_name", "telemetry_sdk_name", "telemetry_sdk_language", "telemetry_sdk_version"), Kind("metadata", "drop")),
)
STATUS_PARTS = ("status_code", "status", "grpc_status", "grpc_code", "response_code")
CORRELATION_ENDS = ("_id", "_uuid", "_key")
ENTITY_LABELS = ("service", "service_name", "job", "app", "application", "instance", "host", "pod", "node", "namespace")
INTERNAL = ("le", "quantile")
TIERS = {1: 10, 2: 50, 3: 200}
ACTIONS = {1: "keep", 2: "bucket", 3: "top_n", 4: "drop"}
OTHER = "__other__"
# Tag keys of one vendor and the label names they become; endings that histograms' sub-metrics have there.
DD_TAGS = {"service": "service_name", "host": "instance", "env": "environment", "version": "service_version", "source": "telemetry_source"}
DD_HISTOGRAM_ENDS = (".avg", ".count", ".median", ".max", ".95percentile")


def classify_label(name: str) -> Kind:
    """Meaning of a label name: exact, then by a status part, then by its end, else a dimension."""
    plain = name.lower().replace("-", "_")
    for names, kind in KINDS:
        if plain in names:
            return kind
    if any(part in plain for part in STATUS_PARTS):
        return Kind("signal", "bucket", "status_code")
    if plain.endswith(CORRELATION_ENDS):
        return Kind("correlation", "drop")
    return Kind("dimension", "auto")


def label_kind(name: Column | str) -> Column:
    """classify_label as struct(category, handling, bucket_type)."""
    plain = F.translate(F.lower(col(name)), "-", "_")
    pack = lambda k: F.struct(F.lit(k.category).alias("category"), F.lit(k.handling).alias("handling"), F.lit(k.bucket_type).cast("string").alias("bucket_type"))
    out = F
    for names, kind in KINDS:
        out = out.when(plain.isin(*names), pack(kind))
    out = out.when(F.rlike(plain, F.lit("|".join(STATUS_PARTS))), pack(Kind("signal", "bucket", "status_code")))
    out = out.when(F.rlike(plain, F.lit("(" + "|".join(CORRELATION_ENDS) + ")$")), pack(Kind("correlation", "drop")))
    return out.otherwise(pack(Kind("dimension", "auto")))


def keeps(kind: Column, tier: Column) -> Column:
    """Whether a label of this kind and tier stays."""
    handling, category = kind["handling"], kind["category"]
    return (
        F.when((handling == "drop") | category.isin("correlation", "internal"), False)
        .when(handling == "keep", True)
        .when(handling == "keep_or_aggregate", tier <= 3)
        .otherwise(tier < 4)
    )


def bucket_type(kind: Column) -> Column:
    """How the label's values are bucketed, if they are."""
    return F.when(kind["handling"].isin("bucket", "parameterize_or_top_n"), kind["bucket_type"])


def is_entity_label(name: Column | str) -> Column:
    return F.translate(F.lower(col(name)), "-", "_").isin(*ENTITY_LABELS)


def tier(cardinality: Column | str, limits: dict[int, int] = TIERS) -> Column:
    """1 to 4 by how many values a label has."""
    out = F
    for n, limit in sorted(limits.items()):
        out = out.when(col(cardinality) <= limit, n)
    return out.otherwise(max(limits) + 1)


def action(tier_of: Column) -> Column:
    out = F
    for n, name in ACTIONS.items():
        out = out.when(tier_of == n, name)
    return out.otherwise("drop")


def top_or_other(value: Column | str, top: list[str] | Column) -> Column:
    """The value if it is one of the top ones, else __other__."""
    top = F.array(*map(F.lit, top)).cast("array<string>") if isinstance(top, list) else top
    return F.when(F.array_contains(top, col(value)), col(value)).otherwise(OTHER)


def entries(labels: Column | str) -> Column:
    """Label map as entries in order of name; a null map has none."""
    return F.array_sort(F.map_entries(F.coalesce(col(labels), F.create_map().cast("map<string,string>"))))


def labels_json(labels: Column | str) -> Column:
    """Canonical text of a label map: JSON with names in order."""
    return F.to_json(F.map_from_entries(entries(labels)))


def series_key(metric: Column | str, labels: Column | str) -> Column:
    return F.concat(col(metric), F.lit("|"), labels_json(labels))


def histogram_key(metric: Column | str, labels: Column | str) -> Column:
    """series_key of a histogram's family: without type suffix and without le."""
    from .names import metric_family

    return F.concat(metric_family(metric), F.lit("|"), labels_json(F.map_filter(col(labels), lambda k, _: k != "le")))


def entity_key(labels: Column | str, names: list[str] | None = None) -> Column:
    """k=v of the entity labels in order of name, joined by ``::``; without any, ``default``."""
    wanted = (lambda k: k.isin(*names)) if names else is_entity_label
    chosen = F.filter(entries(labels), lambda e: wanted(e["key"]) & e["value"].isNotNull())
    joined = F.array_join(F.transform(chosen, lambda x: F.concat(x["key"], F.lit("="), x["value"])), "::")
    return F.when(F.size(chosen) > 0, joined).otherwise("default")


def signal_key(labels: Column | str) -> Column:
    """Values of the signal labels that have buckets, in order of name, joined by ``__``."""
    chosen = F.filter(entries(labels), lambda e: (label_kind(e["key"])["category"] == "signal") & label_kind(e["key"])["bucket_type"].isNotNull())
    return F.array_join(F.transform(chosen, lambda e: e["value"]), "__")


def service_name(labels: Column | str) -> Column:
    """First that is set of service_name, service, job, container; else ``unknown``."""
    return F.coalesce(*[F.nullif(col(labels)[k], F.lit("")) for k in ("service_name", "service", "job", "container")], F.lit("unknown"))


def _last_wins(pairs: Column) -> Column:
    """A map from entries; of equal keys the last counts, whatever the session's policy."""
    last = F.filter(pairs, lambda e, i: ~F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs), F.lit(1))), lambda o: o["key"] == e["key"]))
    return F.map_from_entries(last)


def parse_tags(tags: Column | str) -> Column:
    """Map of ``key:value`` tags, split at the first colon; a bare tag is ``true``; later tags win."""
    pair = lambda t: F.struct(F.regexp_extract(t, "^([^:]*)", 1).alias("key"), F.when(t.contains(":"), F.regexp_replace(t, "^[^:]*:", "")).otherwise("true").alias("value"))
    return _last_wins(F.transform(F.filter(F.coalesce(col(tags), F.array().cast("array<string>")), lambda t: t.isNotNull() & (t != "")), pair))


def rename_tags(tags: Column | str, names: dict[str, str] | None = None) -> Column:
    """Tag map with keys renamed; others pass."""
    names = DD_TAGS if names is None else names
    renamed = F.transform(F.map_entries(col(tags)), lambda e: F.struct(_renamed(e["key"], names).alias("key"), e["value"].alias("value")))
    return _last_wins(renamed)


def _renamed(key: Column, names: dict[str, str]) -> Column:
    out = F
    for old, new in names.items():
        out = out.when(key == old, new)
    return out.otherwise(key)


def dd_metric_name(name: Column | str, kind: Column | str) -> Column:
    """Sanitised metric name; a histogram's sub-metric loses its ending unless it is a count or rate; counts end in _total."""
    ends = "(?:" + "|".join(e.replace(".", r"\.") for e in DD_HISTOGRAM_ENDS) + ")$"
    base = F.when(col(kind).isin("count", "rate"), col(name)).otherwise(F.regexp_replace(col(name), ends, ""))
    plain = sanitize_name(base)
    return F.when((col(kind) == "count") & ~plain.endswith("_total"), F.concat(plain, F.lit("_total"))).otherwise(plain)


def dd_labels(tags: Column | str, host: Column | str) -> Column:
    """Label map of a sample: parsed and renamed tags, the host as ``instance`` if no tag says it."""
    parsed = rename_tags(parse_tags(tags))
    host = F.nullif(col(host), F.lit(""))
    return F.when(host.isNotNull() & ~F.map_contains_key(parsed, F.lit("instance")), F.map_concat(parsed, F.create_map(F.lit("instance"), host))).otherwise(parsed)
