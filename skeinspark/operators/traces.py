"""Spans and traces.

Spans: trace_id, span_id, parent_span_id, service_name, operation_name, start_time (timestamp), duration_us, tags (map), status_code.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.values import epoch_seconds, is_error_span
from ..session import shipped


def list_services(spans: DataFrame) -> DataFrame:
    return spans.select("service_name").distinct().orderBy("service_name")


def list_operations(spans: DataFrame, service: str) -> DataFrame:
    return spans.where(F.col("service_name") == service).select("operation_name").distinct().orderBy("operation_name")


def find(
    spans: DataFrame,
    service: str | None = None,
    operation: str | None = None,
    start: Column | None = None,
    end: Column | None = None,
    min_ms: float | None = None,
    max_ms: float | None = None,
    tags: dict[str, str] | None = None,
    max_traces: int | None = None,
) -> DataFrame:
    """All spans of the traces that have a span meeting every condition; at most max_traces traces, the latest ones."""
    hit = F.lit(True)
    if service:
        hit = hit & (F.col("service_name") == service)
    if operation:
        hit = hit & (F.col("operation_name") == operation)
    if start is not None:
        hit = hit & (F.col("start_time") >= start)
    if end is not None:
        hit = hit & (F.col("start_time") <= end)
    if min_ms is not None:
        hit = hit & (F.col("duration_us") >= min_ms * 1000)
    if max_ms is not None:
        hit = hit & (F.col("duration_us") <= max_ms * 1000)
    for k, v in (tags or {}).items():
        hit = hit & (F.col("tags")[k] == v)
    found = spans.where(hit).groupBy("trace_id").agg(F.max("start_time").alias("latest"))
    if max_traces:
        found = found.orderBy(F.desc("latest"), "trace_id").limit(max_traces)
    return spans.join(found.select("trace_id"), "trace_id", "left_semi")


def by_id(spans: DataFrame, trace_id: str) -> DataFrame:
    return spans.where(F.col("trace_id") == trace_id)


def distinct_spans(spans: DataFrame) -> DataFrame:
    return spans.dropDuplicates(["trace_id", "span_id"])


def roll_up(spans: DataFrame) -> DataFrame:
    """A row a trace: its root (a span without parent, else the first one), start, summed and wall duration, counts, has_error."""
    first = F.struct(F.col("parent_span_id").isNotNull().alias("o"), "start_time", "span_id")
    bad = F.bool_or(is_error_span("status_code", "tags"))
    end = epoch_seconds("start_time") * 1000 + F.col("duration_us") / 1000
    return spans.groupBy("trace_id").agg(
        F.min_by("service_name", first).alias("root_service"),
        F.min_by("operation_name", first).alias("root_operation"),
        F.min("start_time").alias("start_time"),
        (F.sum("duration_us") / 1000).alias("total_duration_ms"),
        (F.max(end) - F.min(epoch_seconds("start_time") * 1000)).alias("wall_duration_ms"),
        F.count("*").alias("span_count"),
        F.size(F.collect_set("service_name")).cast("bigint").alias("service_count"),
        bad.alias("has_error"),
    )


def red_metrics(spans: DataFrame, start: Column, step_seconds: float, steps: int) -> DataFrame:
    """timestamp, service_name, requests and errors (cumulative), p50, p95, p99 of durations, on a full grid from a service's first step on.

    Later spans count in the last step.
    """
    index = F.least(F.floor((epoch_seconds("start_time") - epoch_seconds(start)) / step_seconds), F.lit(steps - 1)).cast("int")
    rows = spans.withColumn("step", index).where("step >= 0")
    # equal durations are counted first, so a cell's quantiles come from distinct durations with their counts
    each = rows.groupBy("step", "service_name", "duration_us").agg(F.count("*").alias("n"), F.sum(is_error_span("status_code", "tags").cast("bigint")).alias("bad"))
    quantiles = F.percentile(F.col("duration_us") / 1000, F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)), F.col("n"))
    cells = each.groupBy("step", "service_name").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), quantiles.alias("q"))
    grid = cells.groupBy("service_name").agg(F.min("step").alias("first")).select("service_name", F.explode(F.sequence("first", F.lit(steps - 1))).alias("step"))
    over = Window.partitionBy("service_name").orderBy("step")
    return grid.join(cells, ["service_name", "step"], "left").select(
        F.timestamp_micros(((epoch_seconds(start) + F.col("step") * step_seconds) * 1_000_000).cast("bigint")).alias("timestamp"),
        "service_name",
        F.sum(F.coalesce("n", F.lit(0))).over(over).alias("requests"),
        F.sum(F.coalesce("bad", F.lit(0))).over(over).alias("errors"),
        *[F.get("q", i).alias(name) for i, name in enumerate(("p50", "p95", "p99"))],
    )


def with_parents(spans: DataFrame) -> DataFrame:
    """spans with parent_service, parent_operation and is_root; a span whose parent is not in its trace is a root."""
    parents = distinct_spans(spans).select("trace_id", F.col("span_id").alias("parent_span_id"), F.col("service_name").alias("parent_service"), F.col("operation_name").alias("parent_operation"))
    return spans.join(parents, ["trace_id", "parent_span_id"], "left").withColumn("is_root", F.col("parent_service").isNull())


def gap_fractions(spans: DataFrame) -> DataFrame:
    """trace_id, span_id, gap_fraction of spans with children: the share of their time outside the children, 0 at least."""
    children = spans.groupBy("trace_id", "parent_span_id").agg(F.sum("duration_us").alias("inside")).where("parent_span_id IS NOT NULL").withColumnRenamed("parent_span_id", "span_id")
    return spans.join(children, ["trace_id", "span_id"]).where("duration_us > 0").select("trace_id", "span_id", F.greatest(F.lit(0.0), (F.col("duration_us") - F.col("inside")) / F.col("duration_us")).alias("gap_fraction"))


def sibling_relation(spans: DataFrame, least: float = 0.3) -> DataFrame:
    """parent service and operation, overlap (median share of neighbouring siblings' overlap in the shorter one), relation parallel or sequential."""
    rows = with_parents(spans).where("NOT is_root").withColumn("start", epoch_seconds("start_time") * 1e6).withColumn("end", epoch_seconds("start_time") * 1e6 + F.col("duration_us"))
    over = Window.partitionBy("trace_id", "parent_span_id").orderBy("start", "span_id")
    before = lambda c: F.lag(c).over(over)
    shared = F.greatest(F.lit(0.0), F.least("end", before("end")) - F.greatest("start", before("start")))
    part = F.try_divide(shared, F.least(F.col("duration_us"), before("duration_us")))
    each = rows.withColumn("share", part).where("share IS NOT NULL").groupBy("parent_service", "parent_operation", "share").agg(F.count("*").alias("n"))
    found = each.groupBy("parent_service", "parent_operation").agg(F.percentile("share", F.lit(0.5), F.col("n")).alias("overlap"))
    return found.withColumn("relation", F.when(F.col("overlap") > least, "parallel").otherwise("sequential"))


# ---- trees: a trace is small and its shape is recursive, so a trace is one value of an Arrow function -----------------


def trees(rows: Iterable[dict]) -> list[dict]:
    """Roots of a trace, each with children in order of start."""
    nodes = {r["span_id"]: {**r, "children": []} for r in rows}
    roots = []
    done: set[str] = set()
    for first in nodes:  # a ring of parents has its earliest span as a root
        chain, at = [], first
        while at in nodes and at not in done:
            done.add(at)
            chain.append(at)
            at = nodes[at]["parent_span_id"]
        if at in chain:
            top = min(chain[chain.index(at) :], key=lambda k: (nodes[k]["start_us"], k))
            nodes[top]["parent_span_id"] = None
    for node in sorted(nodes.values(), key=lambda r: (r["start_us"], r["span_id"])):
        parent = nodes.get(node["parent_span_id"])
        (roots if parent is None or parent is node else parent["children"]).append(node)
    return roots


def folded(parts: list) -> list:
    """A list whose beginning repeats, as (repeat, group, times) and the folded rest."""
    size = len(parts)
    best = (0, 0, 0)
    for k in range(1, size // 2 + 1) if size > 2 else ():
        times = 1
        while parts[times * k : (times + 1) * k] == parts[:k]:
            times += 1
        if times > 1 and times * k > best[0]:
            best = (times * k, k, times)
    covered, k, times = best
    return [["REPEAT", parts[:k], times], *folded(parts[covered:])] if covered else parts


def outline(span: dict) -> list:
    """[service, operation, folded outlines of the children]; kept with the span, children before parents, however deep."""
    waiting = [span]
    while waiting:
        s = waiting[-1]
        if "outline" not in s and (new := [c for c in s["children"] if "outline" not in c]):
            waiting += new
            continue
        waiting.pop()
        inner = folded([c["outline"] for c in s["children"]])
        s["outline"] = [s["service_name"], s["operation_name"], *([inner] if inner else [])]
    return span["outline"]


def signature(span: dict) -> str:
    return hashlib.sha256(json.dumps(outline(span), sort_keys=True).encode()).hexdigest()[:16]


def walk(span: dict, path: str = "0"):
    """(path, span) of a tree, parents first, in order."""
    waiting = [(path, span)]
    while waiting:
        path, span = waiting.pop()
        yield path, span
        waiting += [(f"{path}.{i}", c) for i, c in reversed(list(enumerate(span["children"])))]


def repeating_group(parts: Sequence[str]) -> tuple[int, int]:
    """(size, times) of the smallest group the list begins with three times, or twice if that is half of it; (0, 0) if none."""
    if len(parts) <= 2:
        return 0, 0
    for k in range(1, len(parts) // 2 + 1):
        times = 1
        while list(parts[times * k : (times + 1) * k]) == list(parts[:k]):
            times += 1
        if times >= 3 or (times == 2 and 2 * k * 2 >= len(parts)):
            return k, times
    return 0, 0


def _per_trace(spans: DataFrame, one: Callable[[list[dict]], list[tuple]], schema: str) -> DataFrame:
    """Rows that a function of its roots makes of each trace; traces are gathered by Spark and come to Python many at a time."""
    names = [c.split()[0] for c in schema.split(", ")]
    span = F.struct("trace_id", "span_id", "parent_span_id", "service_name", "operation_name", "start_us", "duration_us", "bad")
    narrow = distinct_spans(shipped(spans)).select("trace_id", "span_id", "parent_span_id", "service_name", "operation_name", (epoch_seconds("start_time") * 1e6).cast("bigint").alias("start_us"), F.col("duration_us").cast("bigint").alias("duration_us"), is_error_span("status_code", "tags").alias("bad"))

    def run(batches):
        for batch in batches:
            rows = [r for t in batch.column(0).to_pylist() for r in one(trees(t))]
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_pydict({n: list(c) for n, c in zip(names, columns)}, schema=arrow)

    arrow = to_arrow_schema(spans.sparkSession.createDataFrame([], schema).schema)
    return narrow.groupBy("trace_id").agg(F.collect_list(span).alias("spans")).select("spans").mapInArrow(run, schema)


def signatures(spans: DataFrame) -> DataFrame:
    """trace_id, signature, error_positions (path:service:operation, sorted) and spans of the first root of each trace."""

    def one(roots: list[dict]) -> list[tuple]:
        if not roots:
            return []
        nodes = list(walk(roots[0]))
        bad = sorted(f"{path}:{s['service_name']}:{s['operation_name']}" for path, s in nodes if s["bad"])
        return [(roots[0]["trace_id"], signature(roots[0]), bad, len(nodes))]

    return _per_trace(spans, one, "trace_id string, signature string, error_positions array<string>, spans bigint")


def positions(spans: DataFrame) -> DataFrame:
    """Path-coded spans of first roots: trace_id, signature, path, parent_path, service, operation, duration_us, bad, children, group_size, group_times."""

    def one(roots: list[dict]) -> list[tuple]:
        out = []
        for root in roots[:1]:
            name = signature(root)
            for path, s in walk(root):
                k, times = repeating_group([json.dumps(outline(c)) for c in s["children"]])
                out.append((s["trace_id"], name, path, path.rpartition(".")[0], s["service_name"], s["operation_name"], s["duration_us"], bool(s["bad"]), len(s["children"]), k, times))
        return out

    return _per_trace(spans, one, "trace_id string, signature string, path string, parent_path string, service_name string, operation_name string, duration_us bigint, bad boolean, children int, group_size int, group_times int")


def templates(spans: DataFrame) -> DataFrame:
    """signature, error_positions, traces, weight: the kinds of trace and their shares."""
    kinds = signatures(spans).groupBy("signature", "error_positions").agg(F.count("*").alias("traces"))
    return kinds.withColumn("weight", F.col("traces") / F.sum("traces").over(Window.partitionBy()))


def trace_profile(spans: DataFrame) -> DataFrame:
    """traces, services, operations, request rate a second of root starts."""
    roots = spans.where("parent_span_id IS NULL").agg(F.count("*").alias("traces"), (F.max(epoch_seconds("start_time")) - F.min(epoch_seconds("start_time"))).alias("seconds"))
    names = spans.agg(F.count_distinct("service_name").alias("services"), F.count_distinct("operation_name").alias("operations"))
    return roots.join(F.broadcast(names)).withColumn("request_rate", F.when(F.col("seconds") > 0, F.col("traces") / F.col("seconds")).otherwise(F.lit(0.0)))


def position_profile(spans: DataFrame) -> DataFrame:
    """Statistics of each span position of each kind of trace."""
    return positions(spans).groupBy("signature", "path", "parent_path", "service_name", "operation_name").agg(
        F.count("*").alias("n"), F.avg("duration_us").alias("mean_us"), F.coalesce(F.stddev_samp("duration_us"), F.lit(0.0)).alias("std_us"), F.min("duration_us").alias("min_us"), F.max("duration_us").alias("max_us"), F.avg(F.col("bad").cast("double")).alias("error_rate"), F.max("group_times").alias("repeats")
    )


def span_events(spans: DataFrame) -> DataFrame:
    """operation, event, n, mean offset in the span: of spans with logs (array of timestamp and fields)."""
    rows = spans.select("operation_name", "start_time", "duration_us", F.explode("logs").alias("e"))
    name = F.coalesce(F.col("e.fields")["event"], F.col("e.fields")["message"], F.lit("log"))
    offset = (epoch_seconds("e.timestamp") - epoch_seconds("start_time")) * 1e6 / F.greatest(F.col("duration_us"), F.lit(1))
    return rows.select("operation_name", name.alias("event"), offset.alias("offset")).groupBy("operation_name", "event").agg(F.count("*").alias("n"), F.avg("offset").alias("mean_offset"))


def csv_projection(spans: DataFrame) -> DataFrame:
    """Flat columns for CSV: epoch microseconds, status from tags, tags and logs as JSON."""
    tags = F.col("tags")
    status = F.coalesce(tags["otel.status_code"], tags["status.code"], F.when(F.lower(tags["error"]) == "true", "ERROR"), F.lit("OK"))
    logs = F.to_json("logs") if "logs" in spans.columns else F.lit("[]")
    return spans.select("trace_id", "span_id", "parent_span_id", "operation_name", "service_name", (epoch_seconds("start_time") * 1e6).cast("bigint").alias("start_time"), "duration_us", status.alias("status_code"), F.to_json("tags").alias("tags_json"), logs.alias("logs_json"))
