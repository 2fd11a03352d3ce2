"""Sinks (K1-K12): OTLP, JSON lines, CSV, typed frames for a learning server, flat exports."""

from __future__ import annotations

import hashlib
import hmac
import json
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import epoch_seconds
from ..operators.frame import melt
from ..operators.logs import SEVERITY_NUMBERS
from ..operators.traces import csv_projection
from ..session import shipped

INDEX = ("timestamp", "entity_key")


def datapoints(wide: DataFrame, index: Sequence[str] = INDEX) -> DataFrame:
    """A row for each set feature: index, feature, value."""
    index = [c for c in index if c in wide.columns]
    return melt(wide, index).where(F.col("value").isNotNull() & ~F.isnan("value"))


def wide_to_otlp(wide: DataFrame, prefix: str = "sml.") -> DataFrame:
    """payload: OTLP JSON of a gauge for each feature, a payload a row of wide."""
    nanos = (epoch_seconds("timestamp") * 1_000_000).cast("bigint").cast("string")
    entity = F.col("entity_key") if "entity_key" in wide.columns else F.lit("default")
    points = datapoints(wide).select(
        "timestamp",
        entity.alias("entity_key"),
        F.struct(
            F.concat(F.lit(prefix), "feature").alias("name"),
            F.struct(F.array(F.struct(F.concat(nanos, F.lit("000")).alias("timeUnixNano"), F.col("value").alias("asDouble"), F.array(F.struct(F.lit("entity_key").alias("key"), F.struct(entity.alias("stringValue")).alias("value"))).alias("attributes"))).alias("dataPoints")).alias("gauge"),
        ).alias("m"),
    )
    metrics = points.groupBy("timestamp", "entity_key").agg(F.array_sort(F.collect_list("m"), lambda a, b: F.when(a["name"] < b["name"], -1).otherwise(1)).alias("metrics"))
    payload = F.struct(F.array(F.struct(F.array(F.struct(F.col("metrics"))).alias("scopeMetrics"))).alias("resourceMetrics"))
    return metrics.select("timestamp", "entity_key", F.to_json(payload).alias("payload"))


def json_lines(wide: DataFrame) -> DataFrame:
    """value: a JSON line for each datapoint."""
    rows = datapoints(wide)
    return rows.select(F.to_json(F.struct(F.col("feature").alias("metric"), F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"), "value", *[c for c in rows.columns if c == "entity_key"])).alias("value"))


def feature_order(columns: Sequence[str]) -> list[str]:
    return [c for c in INDEX if c in columns] + sorted(c for c in columns if c not in INDEX)


def write_wide_csv(wide: DataFrame, folder: str) -> str:
    """Append CSV files with sorted features; tables with other columns go to a folder of their own, which is returned."""
    names = feature_order(wide.columns)
    to = f"{folder}/schema-{hashlib.sha256(','.join(names).encode()).hexdigest()[:12]}"
    wide.select(*names).write.mode("append").csv(to, header=True, nullValue="")
    return to


def json_rows(wide: DataFrame) -> DataFrame:
    """value: a JSON object a row, without the features that are not set."""
    return wide.select(F.to_json(F.struct(*feature_order(wide.columns)), {"ignoreNullFields": "true"}).alias("value"))


def column_kinds(df: DataFrame) -> dict[str, str]:
    """B (only 0 and 1), C (numbers), S (text) of each text column; one job."""
    tests = []
    for i, c in enumerate(df.columns):
        text, number = F.trim(F.col(c).cast("string")), F.col(c).cast("string").try_cast("double")
        given = F.col(c).isNotNull() & (text != "")
        tests += [F.bool_and(F.when(given, number.isin(0.0, 1.0) & number.isNotNull())).alias(f"b{i}"), F.bool_and(F.when(given, number.isNotNull())).alias(f"c{i}")]
    r = df.agg(*tests).first()
    return {c: "B" if r[f"b{i}"] else "C" if r[f"c{i}"] else "S" for i, c in enumerate(df.columns)}


def learning_frame(columns: Sequence[str], kinds: dict[str, str], rows: Iterable[Sequence]) -> dict:
    return {"attributeNames": list(columns), "attributeTypes": [kinds[c] for c in columns], "data": [[None if v is None else v if kinds[c] in "BC" else str(v) for c, v in zip(columns, r)] for r in rows]}


def signed_headers(secret: str, method: str, path: str, body: str, when: str) -> dict[str, str]:
    """Headers with an HMAC-SHA256 of method, path, time and the body's digest."""
    text = "\n".join((method, path, when, hashlib.sha256(body.encode()).hexdigest()))
    return {"X-Time": when, "X-Signature": hmac.new(secret.encode(), text.encode(), hashlib.sha256).hexdigest()}


def stream_frames(df: DataFrame, send: Callable[[str], None], chunk: int = 1000, kinds: dict[str, str] | None = None) -> None:
    """Send every row in frames of at most ``chunk`` rows, from the executors."""
    columns = shipped(df).columns
    kinds = kinds or {c: "C" if t in ("double", "float", "int", "bigint") else "S" for c, t in df.dtypes}

    def run(rows):
        held = []
        for r in rows:
            held.append(tuple(r))
            if len(held) == chunk:
                send(json.dumps(learning_frame(columns, kinds, held), default=str))
                held = []
        if held:
            send(json.dumps(learning_frame(columns, kinds, held), default=str))

    df.foreachPartition(run)


def _pairs(tags: Column) -> Column:
    return F.transform(F.array_sort(F.map_entries(tags)), lambda e: F.struct(e["key"].alias("key"), F.struct(e["value"].alias("stringValue")).alias("value")))


def traces_otlp(spans: DataFrame) -> DataFrame:
    """service_name, payload: OTLP JSON of each service's spans, in parts of one trace, so that no group follows the table."""
    start = (epoch_seconds("start_time") * 1e6).cast("bigint")
    nanos = lambda micros: F.concat(micros.cast("string"), F.lit("000"))
    code = F.when(F.upper("status_code") == "ERROR", 2).when(F.upper("status_code") == "OK", 1).otherwise(0)
    kind = F.when(F.col("parent_span_id").isNull(), 2).otherwise(1)
    span = F.struct(F.col("trace_id").alias("traceId"), F.col("span_id").alias("spanId"), F.coalesce("parent_span_id", F.lit("")).alias("parentSpanId"), F.col("operation_name").alias("name"), kind.alias("kind"), nanos(start).alias("startTimeUnixNano"), nanos(start + F.col("duration_us")).alias("endTimeUnixNano"), _pairs(F.col("tags")).alias("attributes"), F.struct(code.alias("code")).alias("status"))
    rows = spans.groupBy("service_name", "trace_id").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    service = F.array(F.struct(F.lit("service.name").alias("key"), F.struct(F.col("service_name").alias("stringValue")).alias("value")))
    payload = F.struct(F.array(F.struct(F.struct(service.alias("attributes")).alias("resource"), F.array(F.struct(F.col("spans"))).alias("scopeSpans"))).alias("resourceSpans"))
    return rows.select("service_name", "trace_id", F.to_json(payload).alias("payload"))


def severity_number(severity: Column | str) -> Column:
    s = F.upper(F.col(severity) if isinstance(severity, str) else severity)
    out = F
    for name, n in SEVERITY_NUMBERS.items():
        out = out.when(s == name, n)
    return out.otherwise(9)


def logs_otlp(logs: DataFrame) -> DataFrame:
    """service, payload: an OTLP log record a row."""
    nanos = F.concat((epoch_seconds("timestamp") * 1e6).cast("bigint").cast("string"), F.lit("000"))
    record = F.struct(nanos.alias("timeUnixNano"), severity_number("severity").alias("severityNumber"), F.col("severity").alias("severityText"), F.struct(F.col("message").alias("stringValue")).alias("body"), F.coalesce("trace_id", F.lit("")).alias("traceId"), F.coalesce("span_id", F.lit("")).alias("spanId"))
    service = F.array(F.struct(F.lit("service.name").alias("key"), F.struct(F.col("service").alias("stringValue")).alias("value")))
    payload = F.struct(F.array(F.struct(F.struct(service.alias("attributes")).alias("resource"), F.array(F.struct(F.array(record).alias("logRecords"))).alias("scopeLogs"))).alias("resourceLogs"))
    return logs.select("service", F.to_json(payload).alias("payload"))


def export(stem: str, metrics: DataFrame | None = None, spans: DataFrame | None = None, logs: DataFrame | None = None) -> list[str]:
    """CSV folders <stem>, <stem>_traces and <stem>_logs of what is given."""
    out = []
    if metrics is not None:
        metrics.select("timestamp", "metric", F.to_json("labels").alias("labels"), "value").write.mode("overwrite").csv(stem, header=True, escape='"')
        out.append(stem)
    if spans is not None:
        csv_projection(spans).write.mode("overwrite").csv(f"{stem}_traces", header=True, escape='"')
        out.append(f"{stem}_traces")
    if logs is not None:
        logs.select("timestamp", "service", "severity", "message", "trace_id", "span_id").write.mode("overwrite").csv(f"{stem}_logs", header=True, escape='"')
        out.append(f"{stem}_logs")
    return out
