"""Payloads of monitoring systems as samples."""

from __future__ import annotations

import gzip
import json
import struct
import zlib
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import dd_labels, dd_metric_name
from ..functions.names import sanitize_name
from ..session import shipped


def _at(seconds: Column) -> Column:
    return F.timestamp_micros((seconds * 1_000_000).cast("bigint"))


def prometheus_range(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Samples of query_range responses (JSON text); failed responses give nothing, "NaN" no value."""
    schema = "status string, data struct<result: array<struct<metric: map<string,string>, values: array<array<string>>, value: array<string>>>>"
    rows = df.select(F.from_json(payload, schema).alias("p")).where("p.status = 'success'").select(F.explode("p.data.result").alias("r"))
    points = F.coalesce("r.values", F.array("r.value"))
    cells = rows.select("r.metric", F.explode(points).alias("v")).where("v IS NOT NULL")
    labels = F.map_filter("metric", lambda k, _: k != "__name__")
    value = F.nanvl(F.element_at("v", 2).try_cast("double"), F.lit(None).cast("double"))
    return cells.select(_at(F.element_at("v", 1).cast("double")).alias("timestamp"), F.col("metric")["__name__"].alias("metric"), labels.alias("labels"), value.alias("value"))


def dd_query(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Samples of query responses with pointlists (milliseconds, value); points without a value are left out."""
    schema = "series array<struct<metric: string, tag_set: array<string>, pointlist: array<array<double>>>>"
    rows = df.select(F.explode(F.from_json(payload, schema)["series"]).alias("s")).select("s.metric", "s.tag_set", F.explode("s.pointlist").alias("p"))
    cells = rows.where(F.element_at("p", 2).isNotNull())
    return cells.select(_at(F.element_at("p", 1) / 1000).alias("timestamp"), sanitize_name("metric").alias("metric"), dd_labels("tag_set", F.lit(None).cast("string")).alias("labels"), F.element_at("p", 2).alias("value"))


DD_AGGREGATES: dict[str, Callable] = {"avg": F.avg, "sum": F.sum, "min": F.min, "max": F.max}


def prometheus_series(df: DataFrame, payload: str = "payload") -> DataFrame:
    """metric, labels of answers to a series request."""
    rows = df.select(F.explode(F.from_json(payload, "data array<map<string,string>>")["data"]).alias("s"))
    return rows.select(F.col("s")["__name__"].alias("metric"), F.map_filter("s", lambda k, _: k != "__name__").alias("labels"))


def dd_metric_names(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Distinct metric of metric lists, in order."""
    return df.select(F.explode(F.from_json(payload, "metrics array<string>")["metrics"]).alias("metric")).distinct().orderBy("metric")


def dd_metric_tags(df: DataFrame, payload: str = "payload") -> DataFrame:
    """metric, key, value of all-tags answers, distinct; a tag without a colon has an empty value."""
    got = F.from_json(payload, "data struct<id: string, attributes: struct<tags: array<string>>>")["data"]
    rows = df.select(got["id"].alias("metric"), F.explode(got["attributes"]["tags"]).alias("tag"))
    return rows.select("metric", F.split("tag", ":", 2)[0].alias("key"), F.coalesce(F.get(F.split("tag", ":", 2), 1), F.lit("")).alias("value")).distinct()


def dd_metadata(df: DataFrame, metric: str = "metric", payload: str = "payload") -> DataFrame:
    """metric, type, unit, per_unit, description, integration of metadata answers; what an answer lacks is null."""
    got = F.from_json(payload, "type string, unit string, per_unit string, description string, integration string")
    return df.select(metric, got.alias("m")).select(metric, "m.*")


def dd_rollup(df: DataFrame, names: Sequence[str], step_seconds: float, aggregation: str = "avg", group_by: Sequence[str] = ()) -> DataFrame:
    """``aggregation:metric{*} by {labels}.rollup(aggregation, step)`` over samples."""
    from ..functions.values import floor_time

    keys = [F.col("labels")[k].alias(k) for k in group_by]
    return df.where(F.col("metric").isin(*names)).groupBy(floor_time("timestamp", step_seconds).alias("timestamp"), "metric", *keys).agg(DD_AGGREGATES[aggregation]("value").alias("value"))


def _typed(rows: DataFrame) -> DataFrame:
    """timestamp, metric, labels, value, dd_type of (metric, tags, host, kind, t, v)."""
    kept = rows.where((F.coalesce("metric", F.lit("")) != "") & F.col("v").isNotNull() & F.col("t").isNotNull())
    return kept.select(_at(F.col("t")).alias("timestamp"), dd_metric_name("metric", "kind").alias("metric"), dd_labels("tags", "host").alias("labels"), F.col("v").alias("value"), F.col("kind").alias("dd_type"))


def dd_v1(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Typed samples of version 1 series payloads (JSON text); text that is none gives nothing."""
    schema = "series array<struct<metric: string, points: array<array<double>>, tags: array<string>, type: string, host: string>>"
    s = df.select(F.explode(F.from_json(payload, schema)["series"]).alias("s")).select("s.*")
    points = s.select("metric", "tags", "host", F.coalesce("type", F.lit("gauge")).alias("kind"), F.explode("points").alias("p"))
    return _typed(points.select("metric", "tags", "host", "kind", F.get("p", 0).alias("t"), F.get("p", 1).alias("v")))


KINDS = {0: "gauge", 1: "count", 2: "rate", 3: "gauge"}


def _kind(code: Column) -> Column:
    out = F
    for n, name in KINDS.items():
        out = out.when(code == n, name)
    return out.otherwise("gauge")


def dd_v2(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Typed samples of version 2 series payloads; points may be objects or pairs, the host is a resource."""
    schema = "series array<struct<metric: string, type: int, points: array<string>, tags: array<string>, resources: array<struct<type: string, name: string>>>>"
    s = df.select(F.explode(F.from_json(payload, schema)["series"]).alias("s")).select("s.*")
    host = F.get(F.filter("resources", lambda r: r["type"] == "host"), 0)["name"]
    rows = s.select("metric", "tags", host.alias("host"), _kind(F.col("type")).alias("kind"), F.explode("points").alias("p"))
    pair, thing = F.from_json("p", "array<double>"), F.from_json("p", "timestamp double, value double")
    is_pair = F.col("p").startswith("[")
    return _typed(rows.select("metric", "tags", "host", "kind", F.when(is_pair, F.get(pair, 0)).otherwise(thing["timestamp"]).alias("t"), F.when(is_pair, F.get(pair, 1)).otherwise(thing["value"]).alias("v")))


def dd_intake(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Version 2 if the first series' type is a number, else version 1."""
    kind = F.get_json_object(payload, "$.series[0].type")
    is_v2 = F.coalesce(F.rlike(kind, F.lit(r"^\d+$")), F.lit(False))
    return dd_v1(df.where(~is_v2), payload).unionByName(dd_v2(df.where(is_v2), payload))


def inflate(df: DataFrame, body: str = "body", encoding: str = "encoding") -> DataFrame:
    """payload: the text of a compressed body (gzip, deflate, zstd or none); a body that cannot be read is {}."""

    @F.pandas_udf("string")
    def read(bodies: pd.Series, kinds: pd.Series) -> pd.Series:
        def one(data, kind):
            try:
                if kind == "gzip":
                    data = gzip.decompress(data)
                elif kind == "deflate":
                    data = zlib.decompress(data)
                elif kind == "zstd":
                    import zstandard

                    data = zstandard.ZstdDecompressor().decompressobj().decompress(data)
                return data.decode()
            except Exception:  # noqa: BLE001  any broken body is an empty payload
                return "{}"

        return pd.Series([one(b, k) for b, k in zip(bodies, kinds)])

    return shipped(df).withColumn("payload", read(body, encoding))


# ---- protobuf wire format -------------------------------------------------------------------------------------------


def _fields(data: bytes) -> Iterator[tuple[int, int, int | bytes]]:
    """(field, wire type, value) of a message."""

    def varint(at: int) -> tuple[int, int]:
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 0x7F) << shift
            if b < 0x80:
                return out, at
            shift += 7

    at = 0
    while at < len(data):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at : at + size], at + size
        else:
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        yield key >> 3, kind, value


def protobuf_series(data: bytes) -> list[dict]:
    """Series of a metric payload message. series = 1; resources 1, metric 2, tags 3, points 4, type 5; a resource's type 1 and name 2; a point's value 1 and timestamp 2."""
    out = []
    for number, _, body in _fields(data):
        if number != 1:
            continue
        s: dict = {"metric": "", "tags": [], "points": [], "type": 0, "resources": []}
        for n, _, v in _fields(body):
            if n == 1:
                r = {k: x.decode() for k, _, x in _fields(v)}
                s["resources"].append({"type": r.get(1, ""), "name": r.get(2, "")})
            elif n == 2:
                s["metric"] = v.decode()
            elif n == 3:
                s["tags"].append(v.decode())
            elif n == 4:
                p = {k: struct.unpack("<d", x)[0] if w == 1 else x for k, w, x in _fields(v)}
                s["points"].append({"timestamp": p.get(2, 0), "value": p.get(1, 0.0)})
            elif n == 5:
                s["type"] = v
        out.append(s)
    return out


def dd_v2_protobuf(df: DataFrame, body: str = "body") -> DataFrame:
    """Typed samples of protobuf payloads: decoded to the JSON form, then read as version 2; broken messages give nothing."""

    @F.pandas_udf("string")
    def decode(bodies: pd.Series) -> pd.Series:
        def one(data):
            try:
                return json.dumps({"series": protobuf_series(bytes(data))})
            except (IndexError, ValueError, struct.error, AttributeError, TypeError):
                return "{}"

        return bodies.map(one)

    return dd_v2(shipped(df).withColumn("payload", decode(body)))


# ---- OTLP -----------------------------------------------------------------------------------------------------------

_ATTRIBUTES = "array<struct<key: string, value: struct<stringValue: string, intValue: string, doubleValue: double, boolValue: boolean>>>"
_POINT = f"timeUnixNano string, asDouble double, asInt string, attributes: {_ATTRIBUTES}, explicitBounds: array<double>, bucketCounts: array<string>, `sum`: double, `count`: string"
_POINT = _POINT.replace("timeUnixNano string", "timeUnixNano: string").replace("asDouble double", "asDouble: double").replace("asInt string", "asInt: string").replace("`sum`", "sum").replace("`count`", "count")
_METRIC = f"struct<name: string, gauge: struct<dataPoints: array<struct<{_POINT}>>>, sum: struct<isMonotonic: boolean, dataPoints: array<struct<{_POINT}>>>, histogram: struct<dataPoints: array<struct<{_POINT}>>>>"
OTLP = f"resourceMetrics array<struct<resource: struct<attributes: {_ATTRIBUTES}>, scopeMetrics: array<struct<metrics: array<{_METRIC}>>>>>"


def _attributes(pairs: Column) -> Column:
    text = lambda v: F.coalesce(v["stringValue"], v["intValue"], v["doubleValue"].cast("string"), v["boolValue"].cast("string"))
    return F.transform(F.coalesce(pairs, F.array().cast(_ATTRIBUTES.replace(": ", ":"))), lambda p: F.struct(p["key"].alias("key"), text(p["value"]).alias("value")))


def otlp(df: DataFrame, payload: str = "payload", sanitize: bool = True) -> DataFrame:
    """Samples of OTLP metrics (JSON text): gauges; sums, with _total if monotonic; histograms as cumulative buckets, sum and count.

    A point's attributes count before the resource's; other kinds of metric are left out.
    """
    resources = df.select(F.explode(F.from_json(payload, OTLP)["resourceMetrics"]).alias("r"))
    metrics = resources.select(_attributes(F.col("r.resource.attributes")).alias("of"), F.explode(F.flatten(F.transform("r.scopeMetrics", lambda s: s["metrics"]))).alias("m"))
    name = sanitize_name("m.name") if sanitize else F.col("m.name")
    total = F.when(F.col("m.sum.isMonotonic") & ~name.endswith("_total"), F.concat(name, F.lit("_total"))).otherwise(name)
    kinds = F.array(
        F.struct(name.alias("name"), F.lit("point").alias("kind"), F.col("m.gauge.dataPoints").alias("points")),
        F.struct(total.alias("name"), F.lit("point").alias("kind"), F.col("m.sum.dataPoints").alias("points")),
        F.struct(name.alias("name"), F.lit("histogram").alias("kind"), F.col("m.histogram.dataPoints").alias("points")),
    )
    points = metrics.select("of", F.explode(kinds).alias("k")).select("of", "k.name", "k.kind", F.explode("k.points").alias("p"))
    own = _attributes(F.col("p.attributes"))
    rest = F.filter("of", lambda e: ~F.exists(own, lambda o: o["key"] == e["key"]))
    rows = points.select(_at(F.col("p.timeUnixNano").cast("double") / 1e9).alias("timestamp"), "name", "kind", F.map_from_entries(F.concat(rest, own)).alias("labels"), "p")
    plain = rows.where("kind = 'point'").select("timestamp", F.col("name").alias("metric"), "labels", F.coalesce("p.asDouble", F.col("p.asInt").cast("double")).alias("value"))
    counts = F.transform("p.bucketCounts", lambda c: c.cast("double"))
    upto = F.transform(counts, lambda _, i: F.aggregate(F.slice(counts, 1, i + 1), F.lit(0.0), lambda a, b: a + b))
    bound = lambda i: F.when(i < F.size("p.explicitBounds"), F.get("p.explicitBounds", i).cast("string")).otherwise("+Inf")
    cells = F.concat(
        F.transform(upto, lambda n, i: F.struct(F.lit("_bucket").alias("part"), bound(i).alias("le"), n.alias("value"))),
        F.array(F.struct(F.lit("_sum").alias("part"), F.lit(None).cast("string").alias("le"), F.col("p.sum").alias("value")), F.struct(F.lit("_count").alias("part"), F.lit(None).cast("string").alias("le"), F.col("p.count").cast("double").alias("value"))),
    )
    parts = rows.where("kind = 'histogram'").select("timestamp", "name", "labels", F.explode(cells).alias("c"))
    buckets = parts.select("timestamp", F.concat("name", "c.part").alias("metric"), F.when(F.col("c.le").isNull(), F.col("labels")).otherwise(F.map_concat("labels", F.create_map(F.lit("le"), "c.le"))).alias("labels"), F.col("c.value").alias("value"))
    return plain.unionByName(buckets).where("value IS NOT NULL")


# ---- spans and logs -------------------------------------------------------------------------------------------------


def jaeger_spans(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Spans of trace API responses; the parent is the first CHILD_OF reference."""
    schema = "data array<struct<traceID: string, processes: map<string, struct<serviceName: string>>, spans: array<struct<traceID: string, spanID: string, operationName: string, startTime: bigint, duration: bigint, processID: string, references: array<struct<refType: string, spanID: string>>, tags: array<struct<key: string, value: string>>>>>>"
    rows = df.select(F.explode(F.from_json(payload, schema)["data"]).alias("t")).select("t.processes", F.explode("t.spans").alias("s"))
    parent = F.get(F.filter("s.references", lambda r: r["refType"] == "CHILD_OF"), 0)["spanID"]
    tags = F.map_from_entries(F.transform(F.coalesce("s.tags", F.array().cast("array<struct<key:string,value:string>>")), lambda t: F.struct(t["key"].alias("key"), t["value"].alias("value"))))
    return rows.select(
        F.col("s.traceID").alias("trace_id"),
        F.col("s.spanID").alias("span_id"),
        parent.alias("parent_span_id"),
        F.col("s.operationName").alias("operation_name"),
        F.col("processes")[F.col("s.processID")]["serviceName"].alias("service_name"),
        F.timestamp_micros("s.startTime").alias("start_time"),
        F.col("s.duration").alias("duration_us"),
        tags.alias("tags"),
    ).withColumn("status_code", F.col("tags")["otel.status_code"])


def log_records(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Logs of search hits (a JSON document a row), whatever spelling their fields have."""
    get = lambda *paths: F.coalesce(*[F.nullif(F.get_json_object(payload, p), F.lit("")) for p in paths])
    service = get("$.resource['service.name']", "$.resource.attributes['service.name']", "$.serviceName", "$.service", "$.service.name")
    return df.select(
        F.to_timestamp(get("$['@timestamp']", "$.observedTimestamp", "$.time", "$.timestamp")).alias("timestamp"),
        F.coalesce(service, F.lit("unknown")).alias("service"),
        F.upper(F.coalesce(get("$.severity.text", "$.severityText", "$.severity", "$.level"), F.lit("INFO"))).alias("severity"),
        get("$.body", "$.message", "$.log").alias("message"),
        get("$.traceId", "$.trace_id", "$.traceID", "$.trace.id").alias("trace_id"),
        get("$.spanId", "$.span_id", "$.spanID", "$.span.id").alias("span_id"),
    )


def chunks(spark, start: str, end: str, minutes: int) -> DataFrame:
    """(chunk_start, chunk_end) of [start, end) in pieces: a partition each for readers, so that a lost one is read again alone."""
    at = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("timestamp"), F.expr(f"timestamp'{end}' - interval 1 microsecond"), F.make_dt_interval(mins=F.lit(minutes)))).alias("chunk_start"))
    return at.select("chunk_start", F.least(F.col("chunk_start") + F.make_dt_interval(mins=F.lit(minutes)), F.lit(end).cast("timestamp")).alias("chunk_end"))


def fetch_chunks(pieces: DataFrame, fetch: Callable[[pd.Timestamp, pd.Timestamp], list[str]], retries: int = 3) -> DataFrame:
    """payload: what fetch(start, end) returns for each chunk, in as many tasks as there are chunks; a chunk is tried again."""

    def run(frames):
        for pdf in frames:
            for a, b in zip(pdf["chunk_start"], pdf["chunk_end"]):
                for left in range(retries - 1, -1, -1):
                    try:
                        found = fetch(a, b)
                        break
                    except Exception:
                        if not left:
                            raise
                yield pd.DataFrame({"chunk_start": [a] * len(found), "payload": found})

    spread = shipped(pieces).repartition(max(1, pieces.count()), "chunk_start")
    return spread.mapInPandas(run, "chunk_start timestamp, payload string")
