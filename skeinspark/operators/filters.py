"""Filters on labels, metrics and families, and the choice of salient metrics."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.base import first_match
from ..functions.names import metric_family
from ..session import shipped


def by_labels(df: DataFrame, **wanted: str | Sequence[str]) -> DataFrame:
    """Rows whose labels have one of the wanted values, for every label named."""
    for name, values in wanted.items():
        df = df.where(F.col("labels")[name].isin([values] if isinstance(values, str) else list(values)))
    return df


def without_labels(df: DataFrame, **unwanted: str | Sequence[str]) -> DataFrame:
    """Rows without any of the values; a row that lacks the label stays."""
    for name, values in unwanted.items():
        value = F.col("labels")[name]
        df = df.where(value.isNull() | ~value.isin([values] if isinstance(values, str) else list(values)))
    return df


def by_service(df: DataFrame, services: Sequence[str], label: str = "service_name") -> DataFrame:
    return by_labels(df, **{label: list(services)})


def any_pattern(patterns: Sequence[str]) -> str:
    return "|".join(f"(?:{p})" for p in patterns) if patterns else r"\b\B"


def by_metrics(df: DataFrame, patterns: Sequence[str], exclude: bool = False) -> DataFrame:
    """Rows whose metric matches any pattern, or none of them; without patterns nothing matches."""
    found = F.rlike("metric", F.lit(any_pattern(patterns)))
    return df.where(~found if exclude else found)


def by_condition(df: DataFrame, condition: Column | Callable[[dict], bool]) -> DataFrame:
    """Rows that meet a Column, or a function of the row as a dict, which runs in Python, in Arrow batches."""
    if isinstance(condition, Column):
        return df.where(condition)
    return shipped(df).where(F.udf(lambda r: bool(condition(r.asDict())), "boolean", useArrow=True)(F.struct("*")))


def families(df: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """Rows of families (column family) that match any include pattern, if there are any, and no exclude pattern."""
    if include:
        df = df.where(F.rlike("family", F.lit(any_pattern(include))))
    return df.where(~F.rlike("family", F.lit(any_pattern(exclude)))) if exclude else df


def of_type(df: DataFrame, kind: str) -> DataFrame:
    return df.where(F.col("type") == kind)


def recent(df: DataFrame, hours: float, now: Column | None = None, ts: str = "timestamp") -> DataFrame:
    """Rows of the last hours before now, by default before the newest row."""
    if now is None:
        now = F.lit(df.agg(F.max(ts)).first()[0])
    return df.where(F.col(ts) >= now - F.make_dt_interval(secs=F.lit(hours * 3600)))


def gap(df: DataFrame, now: Column, max_seconds: float, ts: str = "timestamp") -> DataFrame:
    """(last_seen, now) if the newest row is older than max_seconds, else no row."""
    found = df.agg(F.max(ts).alias("last_seen")).select("last_seen", now.alias("now"))
    return found.where(F.unix_micros(F.col("now").cast("timestamp")) - F.unix_micros(F.col("last_seen").cast("timestamp")) > int(max_seconds * 1e6))


def min_tier(cardinality: DataFrame, tier: int) -> DataFrame:
    return cardinality.where(F.col("tier") >= tier).orderBy(F.desc("cardinality"), "label")


# Prefixes of one word, patterns of families that are preferred (best first) and of those that are dropped.
ONE_WORD = ("go", "dotnet", "jvm", "nodejs", "v8js", "cpython", "process", "system", "kestrel", "aspnetcore", "traces", "feature", "postgresql", "redis", "nginx", "otelcol", "otlp", "jaeger", "container", "httpcheck", "gen")
LATENCY, THROUGHPUT = ("duration", "latency", "time_seconds"), ("calls_total$", "requests_total$", "_total$")
PREFER = ("duration", "latency", "calls_total$", "requests_total", "exceptions", "errors", "memory_usage", "memory_used", "gc_collections")
DROP = (
    "^target_info$", "^target$", "_size_bytes", "_per_rpc", "^go_memory_(?!used)", "^go_config", "^go_processor", "^aspnetcore_",
    "^dotnet_assembly", "^dotnet_jit", "^dotnet_monitor", "^dotnet_thread_pool", "^dotnet_timer", "^dotnet_process_cpu",
    "^jvm_class", "^jvm_cpu_(?!recent_utilization)", "^jvm_thread_count$", "^nodejs_eventloop_(?!delay_(p90|p99))", "^nodejs_eventloop_time",
    "^v8js_memory_(?!heap_used)", "^cpython_gc_(?!collections_total)", "^process_cpu_count", "^process_thread_count", "^process_open_file",
    "^process_context_switches", "^process_runtime_", "^process_disk", "^system_cpu_(?!(utilization|load_average))", "^system_disk_",
    "^system_filesystem_", "^system_paging_", "^system_processes_", "^system_swap_", "^system_thread_count", "^system_uptime",
    "^system_memory_(?!usage)", "^system_network_(?!(errors|dropped))", "^kestrel_queued", "^kestrel_active", "^feature_flag_",
    "^traces_span_metrics_", "^otelcol_", "^otlp_exporter", "^processedLogs", "^processedSpans", "^queueSize", "^container_",
    "^httpcheck_", "^nginx_", "^jaeger_storage_", "^kafka_consumer_(?!(records_lag|fetch_latency|records_consumed))", "^kafka_controller",
    "^kafka_isr", "^kafka_leaderElection", "^kafka_logs", "^kafka_message_count", "^kafka_network_io", "^kafka_partition_(?!offline)",
    "^kafka_purgatory", "^kafka_request_(?!(time_99p|failed))", "^postgresql_bgwriter", "^postgresql_blks", "^postgresql_blocks",
    "^postgresql_database_count", "^postgresql_index_(?!scans)", "^postgresql_table_(?!size)", "^postgresql_tup_",
    "^redis_clients_(?!connected)", "^redis_cpu", "^redis_db_(?!keys)", "^redis_keys_(?!evicted|expired)", "^redis_keyspace_(?!hits|misses)",
    "^redis_latest_fork", "^redis_memory_(?!used)", "^redis_net_", "^redis_rdb_", "^redis_replication_", "^redis_slaves", "^redis_uptime",
)


def broad_prefix(family: Column | str) -> Column:
    """First word of a runtime's family, else the first two."""
    parts = F.split(F.col(family) if isinstance(family, str) else family, "_")
    return F.when(parts[0].isin(*ONE_WORD), parts[0]).otherwise(F.array_join(F.slice(parts, 1, 2), "_"))


def salient_families(names: DataFrame, prefer: Sequence[str] = PREFER, drop: Sequence[str] = DROP, one_per_group: bool = True, complement: bool = True) -> DataFrame:
    """names (metric, place) -> family, prefix, score, selected, dropped.

    Of each prefix's families that are not dropped, the best by preference (the earlier of equals) is selected; with
    complement also the next best throughput family beside a latency family, or the reverse.
    """
    catalog = names.select(metric_family("metric").alias("family"), "place").groupBy("family").agg(F.min("place").alias("place"))
    score = F
    for i, pattern in enumerate(prefer):
        score = score.when(F.rlike("family", F.lit(pattern)), i)
    catalog = catalog.select(
        "family",
        "place",
        broad_prefix("family").alias("prefix"),
        score.otherwise(len(prefer) + 1).alias("score"),
        F.rlike("family", F.lit(any_pattern(drop))).alias("dropped"),
        F.rlike("family", F.lit(any_pattern(LATENCY))).alias("latency"),
        F.rlike("family", F.lit(any_pattern(THROUGHPUT))).alias("throughput"),
    )
    group = Window.partitionBy("prefix", "dropped").orderBy("score", "place")
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rank = F.row_number().over(group)
    ranked = catalog.withColumns({"rank": rank, "best_latency": F.first("latency").over(whole), "best_throughput": F.first("throughput").over(whole)})
    if one_per_group:
        other = ((F.col("best_latency") & F.col("throughput")) | (F.col("best_throughput") & F.col("latency"))) & (F.col("rank") > 1)
        first_other = F.min(F.when(other, F.col("rank"))).over(Window.partitionBy("prefix", "dropped"))
        chosen = (F.col("rank") == 1) | (F.lit(complement) & F.coalesce(F.col("rank") == first_other, F.lit(False)))
    else:
        matched = F.col("score") < len(prefer)
        chosen = matched | ((F.col("rank") == 1) & ~F.max(matched).over(Window.partitionBy("prefix", "dropped")))
    return ranked.select("family", "prefix", "score", "dropped", (chosen & ~F.col("dropped")).alias("selected"))


def salient_metrics(names: DataFrame, **options) -> DataFrame:
    """The rows of names (metric, place) whose family is selected."""
    chosen = salient_families(names, **options).where("selected").select(F.col("family").alias("__family"))
    return names.join(chosen, metric_family("metric") == F.col("__family"), "left_semi")


def explain_salient(names: DataFrame, **options) -> DataFrame:
    """prefix, families and selected (sorted lists)."""
    return salient_families(names, **options).groupBy("prefix").agg(F.sort_array(F.collect_set("family")).alias("families"), F.sort_array(F.collect_set(F.when(F.col("selected"), F.col("family")))).alias("selected"))


def metric_families(names: DataFrame) -> DataFrame:
    return names.groupBy(metric_family("metric").alias("family")).agg(F.sort_array(F.collect_set("metric")).alias("metrics"))


def chosen_families(names: DataFrame, ask: Callable[[str], str], max_families: int = 10) -> tuple[DataFrame, str]:
    """Families chosen by a function from a prompt to a JSON list, or to {"selected": [...], "explanation": ...}; few families pass as they are."""
    known = [r.family for r in metric_families(names).orderBy("family").select("family").collect()]  # a catalog, not samples
    if len(known) <= max_families:
        return names, ""
    answer = ask(f"Choose at most {max_families} of these metric families, the most telling ones. Answer with a JSON list.\n" + "\n".join(known))
    found = re.search(r"\{.*\}|\[.*\]", answer, re.S)
    try:
        parsed = json.loads(found[0])
    except (TypeError, ValueError) as e:
        raise ValueError("the answer holds no JSON list of families") from e
    selected, why = (parsed, "") if isinstance(parsed, list) else (parsed["selected"], parsed.get("explanation", ""))
    return names.where(metric_family("metric").isin([x for x in selected if x in known])), why
