"""Metric and feature names as Column expressions (C1-C9) and the driver-side naming that pivots need."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import col

# Name suffixes in order, types by suffix, longest feature name.
SUFFIXES = ("_total", "_bucket", "_sum", "_count", "_info", "_created")
SUFFIX_TYPES = {"_total": "counter", "_bucket": "histogram", "_sum": "histogram_component", "_count": "histogram_component", "_info": "info", "_created": "timestamp"}
MAX_FEATURE_NAME = 128
#: Default aggregations of each type.
TYPE_AGGREGATIONS = {"counter": ("rate", "count"), "gauge": ("last", "mean", "min", "max", "stddev"), "histogram": ("p50", "p75", "p90", "p95", "p99", "mean", "count", "sum")}


def metric_family(name: Column | str) -> Column:
    """The name without its one type suffix."""
    return F.regexp_replace(col(name), "(?:" + "|".join(SUFFIXES) + ")$", "")


def metric_type(name: Column | str) -> Column:
    """counter, histogram, histogram_component, info, timestamp or gauge, by suffix."""
    out = F
    for suffix, kind in SUFFIX_TYPES.items():
        out = out.when(col(name).endswith(suffix), kind)
    return out.otherwise("gauge")


def coarse_type(name: Column | str) -> Column:
    """counter, histogram or gauge, as the synthesiser tells them apart."""
    return F.when(col(name).endswith("_total"), "counter").when(F.rlike(col(name), F.lit("_(bucket|sum|count)$")), "histogram").otherwise("gauge")


def detected_type(name: Column | str, labels: Column | str) -> Column:
    """struct(type, subtype) from the name and the labels: histogram parts by name, then le and quantile labels, then names with total."""
    n, has = col(name), lambda k: F.coalesce(F.map_contains_key(col(labels), F.lit(k)), F.lit(False))
    pair = lambda a, b: F.struct(F.lit(a).alias("type"), F.lit(b).cast("string").alias("subtype"))
    out = F
    for part in ("bucket", "count", "sum"):
        out = out.when(n.endswith(f"_{part}"), pair("histogram", part))
    out = out.when(has("le"), pair("histogram", "bucket")).when(has("quantile"), pair("summary", "quantile"))
    return out.when(F.lower(n).contains("total"), pair("counter", None)).otherwise(pair("gauge", None))


def _clean(x: Column, extra: str = "") -> Column:
    lowered = F.translate(F.lower(x), ".-" + extra, "_" * (2 + len(extra)))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(lowered, "[^a-z0-9_]", ""), "_+", "_"), "^_|_$", "")


def sanitize_name(name: Column | str, max_length: int | None = None) -> Column:
    """Lower case, dots and dashes as underscores, other signs dropped, underscores single and never at an end."""
    out = _clean(col(name))
    return F.regexp_replace(F.substring(out, 1, max_length), "_+$", "") if max_length else out


def sanitize_label_value(value: Column | str, max_length: int = 50) -> Column:
    """As sanitize_name, with slashes and colons as underscores; nothing left is ``empty``."""
    out = F.regexp_replace(F.substring(_clean(col(value), "/:"), 1, max_length), "_+$", "")
    return F.when(F.length(out) == 0, "empty").otherwise(out)


def _capped(name: Column) -> Column:
    cut = F.substring(name, 1, MAX_FEATURE_NAME)
    at_separator = F.regexp_replace(cut, "(?s)__(?:(?!__).)*$", "")
    return F.when(F.length(name) <= MAX_FEATURE_NAME, name).when(F.instr(cut, "__") > 1, at_separator).otherwise(cut)


def feature_name(family: Column | str, aggregation: Column | str, labels: Column | str | None = None) -> Column:
    """family__aggregation__label_value..., labels (a map) in order of name, cut at the last separator within 128 characters."""
    parts = [F.array(sanitize_name(family), sanitize_name(aggregation))]
    if labels is not None:
        entries = F.array_sort(F.map_entries(F.coalesce(col(labels), F.create_map().cast("map<string,string>"))))
        parts.append(F.transform(entries, lambda e: F.concat(sanitize_name(e["key"]), F.lit("_"), sanitize_label_value(e["value"]))))
    return _capped(F.array_join(F.concat(*parts), "__"))


def parsed_feature_name(name: Column | str) -> Column:
    """struct(family, aggregation, labels): label parts are split at their first underscore."""
    parts = F.split(col(name), "__")
    labels = F.transform(F.slice(parts, 3, F.greatest(F.size(parts), F.lit(3))), lambda p: F.struct(F.element_at(F.split(p, "_", 2), 1).alias("key"), F.coalesce(F.get(F.split(p, "_", 2), 1), F.lit("")).alias("value")))
    return F.struct(F.get(parts, 0).alias("family"), F.coalesce(F.get(parts, 1), F.lit("")).alias("aggregation"), F.map_from_entries(labels).alias("labels"))


def derived_name(base: str, modifier: str) -> str:
    """base__modifier, the base cut (at a separator if there is one) so that 128 characters suffice."""
    tail = f"__{modifier}"
    if len(base) + len(tail) > MAX_FEATURE_NAME:
        base = base[: MAX_FEATURE_NAME - len(tail)]
        if (at := base.rfind("__")) > 0:
            base = base[:at]
    return base + tail


def derived(name: Column | str, modifier: str) -> Column:
    """derived_name as a Column."""
    base, tail = col(name), f"__{modifier}"
    cut = F.substring(base, 1, MAX_FEATURE_NAME - len(tail))
    at_separator = F.regexp_replace(cut, "(?s)(?<=.)__(?:(?!__).)*$", "")
    return F.concat(F.when(F.length(base) + len(tail) <= MAX_FEATURE_NAME, base).otherwise(at_separator), F.lit(tail))


def metric_feature_names(families: DataFrame) -> DataFrame:
    """family, aggregation, feature of families (family, type): a name for each aggregation of the type; unknown types are gauges."""
    kind = F.when(F.col("type").isin(*TYPE_AGGREGATIONS), F.col("type")).otherwise("gauge")
    wanted = F.element_at(F.create_map(*[x for k, v in TYPE_AGGREGATIONS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))]), kind)
    return families.select("family", F.explode(wanted).alias("aggregation")).select("family", "aggregation", F.concat_ws("__", "family", "aggregation").alias("feature"))


def names_for_metric(family: str, kind: str, label_values: dict[str, list[str]] | None = None) -> list[str]:
    """All feature names of a metric: its type's aggregations times every combination of label values."""
    combos = [dict(zip(label_values, v)) for v in product(*label_values.values())] if label_values else [{}]
    return ["__".join([family, agg, *(f"{k}_{c[k]}" for k in sorted(c))]) for agg in TYPE_AGGREGATIONS.get(kind, TYPE_AGGREGATIONS["gauge"]) for c in combos]
