"""Registered queries: an operator of the inventory each, over its whole table, with SQL that gives the same rows.

Keys begin with the operators' ids.  Times are microseconds since the epoch; floating results are rounded to six digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import names as N
from ..functions import operations as O
from ..functions import routes as R
from ..functions import status as S
from ..functions import values as V
from ..operators import aggregates as A
from ..operators import filters as P
from ..operators import frame as X
from ..operators import logs as G
from ..operators import profile as Q
from ..operators import stats as T
from ..operators import synth as Y
from ..operators import traces as J
from ..operators import windows as W
from ..sources import payloads, raw, sinks
from ..streaming import features as streams
from . import denormalize as D

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

#: The samples that event_samples makes, in SQL.
RAW = """raw AS (SELECT ts, epoch_us(ts) AS us, 'event_value' AS metric, CAST(user_id % 10 AS VARCHAR) AS instance, event_type AS service,
 CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS status, value, event_id, user_id FROM events)"""


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def us(ts: Column | str) -> Column:
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp")).alias("us")


def r6(x: Column | str) -> Column:
    return F.round(F.col(x) if isinstance(x, str) else x, 6)


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily value of each instance and service: a small regular table for windows."""
    e = raw.event_samples(spark, sf_dir)
    return e.groupBy(V.floor_time("timestamp", 86400).alias("timestamp"), (F.col("user_id") % 10).cast("string").alias("entity_key")).agg(F.round(F.avg("value"), 6).alias("x"), F.count("*").alias("n"))


DAYS = "days AS (SELECT (us // 86400000000) * 86400000000 AS us, instance AS entity_key, round(avg(value), 6) AS x, count(*) AS n FROM raw GROUP BY 1, 2)"


# ---- flagship ------------------------------------------------------------------------------------------------------


def _flagship_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = raw.event_samples(spark, sf_dir)
    return e.withColumn("timestamp", V.floor_time("timestamp", 86400)).select("timestamp", "metric", F.map_filter("labels", lambda k, _: k != "service_name").alias("labels"), "value")


@query(f"""WITH {RAW}, d AS (SELECT (us // 86400000000) * 86400000000 AS us, 'instance=' || instance AS entity_key,
 avg(value) FILTER (status = '200') AS ok, avg(value) FILTER (status = '500') AS bad FROM raw GROUP BY 1, 2)
SELECT us, entity_key, round(ok, 6) AS event_value__mean__success, round(bad, 6) AS event_value__mean__server_error,
 CAST(NULL AS DOUBLE) AS event_value__mean__client_error,
 round(ok - lag(ok, 5) OVER w, 6) AS success_delta_5m, round(bad - lag(bad, 5) OVER w, 6) AS server_error_delta_5m FROM d WINDOW w AS (PARTITION BY entity_key ORDER BY us)""")
def X1_denormalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = D.denormalize(_flagship_rows(spark, sf_dir))
    base = "event_value__mean__"
    return wide.select(us("timestamp"), "entity_key", *[r6(base + s).alias(base + s) for s in S.CORE], r6(base + "success__delta_5m").alias("success_delta_5m"), r6(base + "server_error__delta_5m").alias("server_error_delta_5m"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X1_denormalize(spark, sf_dir)


@query(f"""WITH {RAW}, o AS (SELECT min(us) AS o FROM (SELECT (us // 60000000) * 60000000 AS us FROM raw WHERE service IN ('click', 'error')))
SELECT o + ((us - o) // 21600000000) * 21600000000 AS us, 'instance=' || instance || '::service_name=' || service AS entity_key,
 round(max(value) FILTER (status = '200'), 6) AS event_value__max__success, round(max(value) FILTER (status = '500'), 6) AS event_value__max__server_error,
 CAST(NULL AS DOUBLE) AS event_value__max__client_error FROM raw, o WHERE service IN ('click', 'error') GROUP BY 1, 2""")
def X2_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    # distinct timestamps of a window are kept apart by the raw data's own order, so that the gauge's maximum is over samples
    rows = W.tumbling(P.by_service(raw.event_samples(spark, sf_dir), ["click", "error"]), 360, 60)
    rows = D.rewrite_labels(rows.withColumn("at", F.col("timestamp")).withColumn("timestamp", F.col("window_start")))
    rows = rows.withColumn("entity_key", L.entity_key("labels"))
    long = rows.groupBy("timestamp", "entity_key", N.metric_family("metric").alias("metric_family"), "signal_key").agg(*[x.alias(k) for k, x in A.gauge("value", "at").items()])
    long = long.select("timestamp", "entity_key", "metric_family", "signal_key", F.lit("max").alias("aggregation"), F.col("max").alias("value"), F.lit("unknown").alias("service"))
    named = D.named_features(long)
    names = D.status_complete(X.features_of(named, "feature"))
    wide = X.pivot(named, ["timestamp", "entity_key"], "feature", "value", names)
    return wide.select(us("timestamp"), "entity_key", *[r6(n).alias(n) for n in names])


@query(f"""WITH {RAW}, d AS (SELECT (us // 86400000000) * 86400000000 AS us, 'instance=' || instance AS entity_key, status, avg(value) AS m FROM raw GROUP BY ALL)
SELECT us, entity_key, CASE status WHEN '200' THEN 'success' ELSE 'server_error' END AS signal_key, 'event_value' AS metric_family, 'mean' AS aggregation, round(m, 6) AS value FROM d""")
def A18_long_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, buckets = D.keyed(_flagship_rows(spark, sf_dir))
    return A.long_features(rows, with_histograms=buckets).select(us("timestamp"), "entity_key", "signal_key", "metric_family", "aggregation", r6("value").alias("value"))


# ---- sources -------------------------------------------------------------------------------------------------------


@query("SELECT DISTINCT 'event_' || event_type || CASE WHEN user_id % 2 = 0 THEN '_total' ELSE '' END AS metric FROM events")
def S2_metric_names(spark, sf_dir):
    e = raw.event_samples(spark, sf_dir)
    name = F.concat(F.lit("event_"), F.col("labels")["service_name"], F.when(F.col("user_id") % 2 == 0, "_total").otherwise(""))
    return e.withColumn("metric", name).select("metric").distinct()


@query("SELECT unnest(['instance', 'service_name', 'status_code']) AS label")
def S3_label_names(spark, sf_dir):
    return Q.discover_labels(raw.event_samples(spark, sf_dir)).select("label")


@query("SELECT DISTINCT event_type AS value FROM events")
def S4_label_values(spark, sf_dir):
    return Q.label_values(raw.event_samples(spark, sf_dir), "service_name")


@query(f"WITH {RAW} SELECT instance, service, max(us) AS us, round(arg_max(value, (us, value)), 6) AS value FROM raw GROUP BY 1, 2")
def S5_instant_query(spark, sf_dir):
    rows = W.with_series(raw.event_samples(spark, sf_dir))
    latest = W.instant(rows).withColumn("labels", F.from_json("labels_key", "map<string,string>"))
    return latest.select(F.col("labels")["instance"].alias("instance"), F.col("labels")["service_name"].alias("service"), us("timestamp"), r6("value").alias("value"))


SLICE = f"""WITH {RAW}, f AS (SELECT (us // 3600000000) * 3600000000 AS us, instance, service, arg_max(value, (us, value)) AS value FROM raw GROUP BY 1, 2, 3)
SELECT us, instance, service, round(value, 6) AS value FROM f"""


def _series(rows: DataFrame) -> DataFrame:
    labels = F.from_json("labels_key", "map<string,string>")
    return rows.select(us("timestamp"), labels["instance"].alias("instance"), labels["service_name"].alias("service"), r6("value").alias("value"))


@query(SLICE + " WHERE us BETWEEN epoch_us(TIMESTAMP '2024-01-05') AND epoch_us(TIMESTAMP '2024-01-09')")
def S33_slice_resample(spark, sf_dir):
    day = lambda d: F.lit(f"2024-01-0{d} 00:00:00").cast("timestamp")
    return _series(W.slice_resample(raw.event_samples(spark, sf_dir), ["event_value"], day(5), day(9), 3600))


@query(SLICE)
def W11_resample_last(spark, sf_dir):
    return _series(W.resample(W.with_series(raw.event_samples(spark, sf_dir)), 3600))


@query(f"""WITH {RAW} SELECT min(us) AS us, instance, service, round(arg_min(value, (us, value)), 6) AS value FROM raw GROUP BY (us // 3600000000), instance, service""")
def W12_downsample_first(spark, sf_dir):
    return _series(W.sample_by_time(W.with_series(raw.event_samples(spark, sf_dir)), 3600))


@query("SELECT DISTINCT 'event_value' AS metric, CAST(user_id % 10 AS VARCHAR) AS instance, event_type AS service FROM events")
def S7_series_listing(spark, sf_dir):
    e = W.with_series(raw.event_samples(spark, sf_dir)).select("metric", "labels_key").distinct()
    labels = F.from_json("labels_key", "map<string,string>")
    return e.select("metric", labels["instance"].alias("instance"), labels["service_name"].alias("service"))


@query("SELECT epoch_us(ts) // 1000000 * 1000000 AS us, 'event_value' AS metric, event_type AS service, round(value, 6) AS value, event_id FROM events")
def S8_prometheus_payload(spark, sf_dir):
    e = raw.event_samples(spark, sf_dir)
    labels = F.map_concat("labels", F.create_map(F.lit("__name__"), "metric", F.lit("event"), F.col("event_id").cast("string")))
    second = F.floor(V.epoch_seconds("timestamp")).cast("string")
    p = F.to_json(F.struct(F.lit("success").alias("status"), F.struct(F.array(F.struct(labels.alias("metric"), F.array(F.array(second, F.col("value").cast("string"))).alias("values"))).alias("result")).alias("data")))
    out = payloads.prometheus_range(e.select(p.alias("payload")))
    return out.select(us("timestamp"), "metric", F.col("labels")["service_name"].alias("service"), r6("value").alias("value"), F.col("labels")["event"].cast("bigint").alias("event_id"))


@query("SELECT event_id, round(value, 6) AS value FROM events WHERE event_type IN ('click', 'view')")
def S9_services_latest(spark, sf_dir):
    e = raw.event_samples(spark, sf_dir)
    return e.where(L.service_name("labels").isin("click", "view")).select("event_id", r6("value").alias("value"))


@query("SELECT event_type AS service, 'event_value' AS metric, 'gauge' AS type FROM events GROUP BY 1")
def A20_metric_catalog(spark, sf_dir):
    return Q.metric_catalog(raw.event_samples(spark, sf_dir)).select("service", "metric", "type")


@query(f"""WITH {RAW}, s AS (SELECT DISTINCT instance, us FROM raw), d AS (SELECT us - lag(us) OVER (PARTITION BY instance ORDER BY us) AS d FROM s), c AS (SELECT d, count(*) AS n FROM d WHERE d > 0 GROUP BY 1)
SELECT round(arg_min(d, (-n, d)) / 1000000.0, 6) AS seconds FROM c""")
def S12_scrape_interval(spark, sf_dir):
    rows = raw.event_samples(spark, sf_dir).select(F.col("labels")["instance"].alias("instance"), "timestamp").distinct()
    return W.scrape_interval(rows, ["instance"]).select(r6("seconds").alias("seconds"))


DD = """SELECT epoch_us(ts) // 1000000 * 1000000 AS us, CASE WHEN event_type = 'view' THEN 'app_hits_total' ELSE 'app_hits' END AS metric,
 event_type AS service, CAST(user_id % 10 AS VARCHAR) AS instance, 'true' AS bare, round(value, 6) AS value, CASE WHEN event_type = 'view' THEN 'count' ELSE 'gauge' END AS dd_type, event_id FROM events"""


def _dd(spark, sf_dir, version: int) -> DataFrame:
    e = raw.event_samples(spark, sf_dir)
    name = F.when(F.col("labels")["service_name"] == "view", "app.hits").otherwise("app.hits.avg")
    is_count = F.col("labels")["service_name"] == "view"
    tags = F.array(F.concat(F.lit("service:"), F.col("labels")["service_name"]), F.lit("bare"), F.concat(F.lit("event:"), F.col("event_id").cast("string")))
    second = F.floor(V.epoch_seconds("timestamp")).cast("double")
    if version == 1:
        series = F.struct(name.alias("metric"), F.array(F.array(second, F.col("value"))).alias("points"), tags.alias("tags"), F.when(is_count, "count").otherwise("gauge").alias("type"), F.col("labels")["instance"].alias("host"))
    else:
        series = F.struct(name.alias("metric"), F.when(is_count, 1).otherwise(3).alias("type"), F.array(F.struct(second.alias("timestamp"), "value")).alias("points"), tags.alias("tags"), F.array(F.struct(F.lit("host").alias("type"), F.col("labels")["instance"].alias("name"))).alias("resources"))
    return e.select(F.to_json(F.struct(F.array(series).alias("series"))).alias("payload"))


def _dd_out(out: DataFrame) -> DataFrame:
    get = lambda k: F.col("labels")[k]
    return out.select(us("timestamp"), "metric", get("service_name").alias("service"), get("instance").alias("instance"), get("bare").alias("bare"), r6("value").alias("value"), "dd_type", get("event").cast("bigint").alias("event_id"))


@query(DD)
def S23_dd_v1(spark, sf_dir):
    return _dd_out(payloads.dd_v1(_dd(spark, sf_dir, 1)))


@query(DD)
def S24_dd_v2(spark, sf_dir):
    return _dd_out(payloads.dd_v2(_dd(spark, sf_dir, 2)))


@query(f"SELECT * FROM ({DD}) UNION ALL SELECT * FROM ({DD})")
def S26_dd_intake(spark, sf_dir):
    both = _dd(spark, sf_dir, 1).unionByName(_dd(spark, sf_dir, 2))
    packed = both.select(F.encode("payload", "UTF-8").alias("body"), F.lit("none").alias("encoding"))
    return _dd_out(payloads.dd_intake(payloads.inflate(packed).select("payload")))


@query("SELECT epoch_us(date_trunc('day', ts)) AS us, event_type AS service, round(sum(value), 4) AS value FROM events GROUP BY 1, 2")
def S15_dd_rollup(spark, sf_dir):
    out = payloads.dd_rollup(raw.event_samples(spark, sf_dir), ["event_value"], 86400, "sum", ["service_name"])
    return out.select(us("timestamp"), F.col("service_name").alias("service"), F.round("value", 4).alias("value"))


@query(f"""WITH {RAW}, c AS (SELECT event_id, us, service, value, unnest([0, 1, 2, 3, 4]) AS i FROM raw)
SELECT event_id, 'req_bucket' AS metric, ['10.0', '100.0', '+Inf'][i + 1] AS le, CAST([1, 3, 6][i + 1] AS DOUBLE) AS value FROM c WHERE i < 3
UNION ALL SELECT event_id, CASE i WHEN 3 THEN 'req_sum' ELSE 'req_count' END, NULL, CASE i WHEN 3 THEN value ELSE 6 END FROM c WHERE i >= 3
UNION ALL SELECT event_id, 'hits_total', NULL, value FROM raw""")
def S28_otlp(spark, sf_dir):
    e = raw.event_samples(spark, sf_dir)
    nanos = F.concat(F.unix_micros("timestamp").cast("string"), F.lit("000"))
    attribute = F.array(F.struct(F.lit("event").alias("key"), F.struct(F.col("event_id").cast("string").alias("stringValue")).alias("value")))
    point = lambda *x: F.array(F.struct(nanos.alias("timeUnixNano"), attribute.alias("attributes"), *x))
    total = F.struct(F.lit("hits").alias("name"), F.struct(F.lit(True).alias("isMonotonic"), point(F.col("value").alias("asDouble")).alias("dataPoints")).alias("sum"), F.lit(None).cast("struct<dataPoints:array<struct<sum:double>>>").alias("histogram"))
    histogram = point(F.array(F.lit(10.0), F.lit(100.0)).alias("explicitBounds"), F.array(F.lit("1"), F.lit("2"), F.lit("3")).alias("bucketCounts"), F.col("value").alias("sum"), F.lit("6").alias("count"))
    req = F.struct(F.lit("req").alias("name"), F.struct(histogram.alias("dataPoints")).alias("histogram"))
    wrap = lambda m: F.to_json(F.struct(F.array(F.struct(F.array(F.struct(F.array(m).alias("metrics"))).alias("scopeMetrics"))).alias("resourceMetrics")))
    out = payloads.otlp(e.select(F.explode(F.array(wrap(total), wrap(req))).alias("payload")))
    return out.select(F.col("labels")["event"].cast("bigint").alias("event_id"), "metric", F.col("labels")["le"].alias("le"), "value")


@query("SELECT n_nationkey AS key, CAST(n_nationkey AS DOUBLE) AS value, '{\"name\":\"' || n_name || '\",\"region\":\"' || n_regionkey || '\"}' AS labels FROM nation")
def S31_wide_labels(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.lit("2024-01-01").cast("timestamp").alias("timestamp"), F.lit("m").alias("metric"), F.col("n_nationkey").alias("value"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"), F.lit(None).cast("string").alias("gone"))
    out = raw.wide_labels(n)
    return out.select(F.col("value").cast("int").alias("key"), "value", L.labels_json("labels").alias("labels"))


@query("SELECT event_id, round(value, 6) AS value, event_type AS service, 'it''s' AS quoted FROM events")
def S29_label_repr(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    text = F.concat(F.lit("{'service_name': '"), "event_type", F.lit("', 'q': \"it's\"}"))
    labels = raw.parse_label_repr(text)
    return e.select("event_id", r6("value").alias("value"), labels["service_name"].alias("service"), labels["q"].alias("quoted"))


@query("SELECT DISTINCT epoch_us(ts) // 86400000000 * 86400000000 AS us, epoch_us(ts) // 86400000000 * 86400000000 + 86400000000 AS until FROM (SELECT unnest(range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS ts)")
def S22_chunks(spark, sf_dir):
    return payloads.chunks(spark, "2024-01-01", "2024-01-31", 1440).select(us("chunk_start"), F.unix_micros("chunk_end").alias("until"))


# ---- spans and logs of the driver's tables -------------------------------------------------------------------------


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as roots and their lines as children: a trace an order."""
    o, l = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    none = F.create_map().cast("map<string,string>")
    root = o.select(F.col("o_orderkey").cast("string").alias("trace_id"), F.lit("0").alias("span_id"), F.lit(None).cast("string").alias("parent_span_id"), F.col("o_orderpriority").alias("service_name"), F.lit("order").alias("operation_name"), F.col("o_orderdate").cast("timestamp").alias("start_time"), F.lit(1000000).cast("bigint").alias("duration_us"), none.alias("tags"), F.when(F.col("o_orderstatus") == "F", "ERROR").otherwise("OK").alias("status_code"))
    child = l.select(F.col("l_orderkey").cast("string").alias("trace_id"), F.concat(F.col("l_linenumber").cast("string"), F.lit("-"), F.col("l_partkey").cast("string"), F.lit("-"), F.col("l_suppkey").cast("string"), F.lit("-"), F.col("l_quantity").cast("string")).alias("span_id"), F.lit("0").alias("parent_span_id"), F.col("l_returnflag").alias("service_name"), F.concat(F.lit("ship-"), "l_linestatus").alias("operation_name"), F.col("l_shipdate").cast("timestamp").alias("start_time"), (F.col("l_quantity") * 1000).cast("bigint").alias("duration_us"), none.alias("tags"), F.lit("OK").alias("status_code"))
    return root.unionByName(child)


SPANS = """spans AS (SELECT CAST(o_orderkey AS VARCHAR) AS trace_id, '0' AS span_id, NULL AS parent, o_orderpriority AS service, 'order' AS operation, epoch_us(o_orderdate) AS us, 1000000 AS dur, o_orderstatus = 'F' AS bad FROM orders
 UNION ALL SELECT CAST(l_orderkey AS VARCHAR), l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(l_quantity AS VARCHAR), '0', l_returnflag, 'ship-' || l_linestatus, epoch_us(l_shipdate), CAST(l_quantity * 1000 AS BIGINT), false FROM lineitem)"""


@query(f"WITH {SPANS} SELECT DISTINCT service AS service_name FROM spans")
def S16_services(spark, sf_dir):
    return J.list_services(spans(spark, sf_dir))


@query(f"WITH {SPANS}, hit AS (SELECT DISTINCT trace_id FROM spans WHERE service = 'R' AND dur >= 49000) SELECT trace_id, count(*) AS n FROM spans SEMI JOIN hit USING (trace_id) GROUP BY 1")
def S17_find_traces(spark, sf_dir):
    return J.find(spans(spark, sf_dir), service="R", min_ms=49).groupBy("trace_id").agg(F.count("*").alias("n"))


@query(f"WITH {SPANS} SELECT service, operation, dur FROM spans WHERE trace_id = '7'")
def S18_trace_by_id(spark, sf_dir):
    return J.by_id(spans(spark, sf_dir), "7").select(F.col("service_name").alias("service"), F.col("operation_name").alias("operation"), F.col("duration_us").alias("dur"))


@query(f"""WITH {SPANS} SELECT trace_id, min(us) AS us, round(sum(dur) / 1000, 6) AS total_ms, round((max(us + dur) - min(us)) / 1000, 3) AS wall_ms, count(*) AS spans, count(DISTINCT service) AS services, bool_or(bad) AS has_error,
 coalesce(max(service) FILTER (parent IS NULL), arg_min(service, (us, span_id))) AS root_service FROM spans GROUP BY 1""")
def A26_trace_roll_up(spark, sf_dir):
    t = J.roll_up(spans(spark, sf_dir))
    return t.select("trace_id", us("start_time"), r6("total_duration_ms").alias("total_ms"), F.round("wall_duration_ms", 3).alias("wall_ms"), F.col("span_count").alias("spans"), F.col("service_count").alias("services"), "has_error", "root_service")


@query(f"""WITH {SPANS}, s AS (SELECT *, least((us - epoch_us(TIMESTAMP '1992-01-01')) // (365 * 86400000000), 9) AS step FROM spans WHERE parent IS NULL AND us >= epoch_us(TIMESTAMP '1992-01-01')),
c AS (SELECT step, service, count(*) AS n, count(*) FILTER (bad) AS bad, quantile_cont(dur / 1000, 0.95) AS p95 FROM s GROUP BY 1, 2),
g AS (SELECT service, unnest(range(min(step), 10)) AS step FROM c GROUP BY 1)
SELECT g.step, g.service, CAST(sum(coalesce(n, 0)) OVER w AS BIGINT) AS requests, CAST(sum(coalesce(bad, 0)) OVER w AS BIGINT) AS errors, round(p95, 6) AS p95 FROM g LEFT JOIN c USING (service, step) WINDOW w AS (PARTITION BY service ORDER BY step)""")
def A29_red_metrics(spark, sf_dir):
    start = F.lit("1992-01-01").cast("timestamp")
    out = J.red_metrics(spans(spark, sf_dir).where("parent_span_id IS NULL"), start, 365 * 86400, 10)
    step = F.floor((V.epoch_seconds("timestamp") - V.epoch_seconds(start)) / (365 * 86400)).cast("bigint")
    return out.select(step.alias("step"), F.col("service_name").alias("service"), "requests", "errors", r6("p95").alias("p95"))


@query(f"""WITH {SPANS}, d AS (SELECT DISTINCT ON (trace_id, span_id) * FROM spans) SELECT s.service, s.operation, p.service AS parent_service, count(*) AS n FROM spans s LEFT JOIN d p ON p.trace_id = s.trace_id AND p.span_id = s.parent GROUP BY ALL""")
def J3_parent_join(spark, sf_dir):
    rows = J.with_parents(spans(spark, sf_dir))
    return rows.groupBy(F.col("service_name").alias("service"), F.col("operation_name").alias("operation"), "parent_service").agg(F.count("*").alias("n"))


@query(f"WITH {SPANS}, c AS (SELECT trace_id, sum(dur) AS inside FROM spans WHERE parent = '0' GROUP BY 1) SELECT trace_id, round(greatest(0.0, (dur - inside) / dur), 6) AS gap FROM spans JOIN c USING (trace_id) WHERE parent IS NULL")
def W16_gap_fractions(spark, sf_dir):
    return J.gap_fractions(spans(spark, sf_dir)).select("trace_id", r6("gap_fraction").alias("gap"))


@query()
def L1_signatures(spark, sf_dir):
    return J.signatures(spans(spark, sf_dir))


@query()
def L3_templates(spark, sf_dir):
    return J.templates(spans(spark, sf_dir))


@query()
def L4_position_profile(spark, sf_dir):
    return J.position_profile(spans(spark, sf_dir))


@query(f"""WITH {SPANS} SELECT (SELECT count(*) FROM orders) AS traces, count(DISTINCT service) AS services, count(DISTINCT operation) AS operations,
 round((SELECT count(*) / ((epoch_us(max(o_orderdate)) - epoch_us(min(o_orderdate))) / 1000000) FROM orders), 9) AS rate FROM spans""")
def L6_trace_profile(spark, sf_dir):
    return J.trace_profile(spans(spark, sf_dir)).select("traces", "services", "operations", F.round("request_rate", 9).alias("rate"))


@query(f"WITH {SPANS} SELECT trace_id, us AS start_time, dur AS duration_us, 'OK' AS status_code, '{{}}' AS tags_json FROM spans WHERE parent IS NULL")
def C44_span_projection(spark, sf_dir):
    return J.csv_projection(spans(spark, sf_dir).where("parent_span_id IS NULL")).select("trace_id", "start_time", "duration_us", "status_code", "tags_json")


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as logs; each of a span of an order."""
    e = table(spark, sf_dir, "events")
    message = F.concat(F.lit("user="), F.col("user_id").cast("string"), F.lit(" paid $"), F.format_string("%.2f", "value"), F.lit(" from 10.0.0."), (F.col("user_id") % 5).cast("string"))
    return e.select(F.col("ts").cast("timestamp").alias("timestamp"), F.col("event_type").alias("service"), F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO").alias("severity"), message.alias("message"), (F.col("event_id") % 2000).cast("string").alias("trace_id"), F.lit("0").alias("span_id"), "event_id")


LOGS = "logs AS (SELECT ts, event_type AS service, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS severity, CAST(event_id % 2000 AS VARCHAR) AS trace_id, event_id, user_id FROM events)"


@query(f"WITH {LOGS} SELECT event_id FROM logs WHERE service IN ('error', 'click') AND severity = 'ERROR'")
def S19_fetch_logs(spark, sf_dir):
    return G.fetch(logs(spark, sf_dir), ["error", "click"], ["error"]).select("event_id")


@query(f"WITH {LOGS} SELECT event_id FROM logs WHERE user_id % 5 = 3 AND (service = 'view' OR service = 'click')")
def S20_search_logs(spark, sf_dir):
    return G.search(logs(spark, sf_dir), '"10.0.0.3" AND paid AND (service:view OR service:click)').select("event_id")


@query("SELECT event_id, event_type AS service, 'INFO' AS severity, 'm' || event_id AS message FROM events")
def S21_log_records(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    doc = F.to_json(F.struct(F.lit("2024-01-01T00:00:00Z").alias("@timestamp"), F.concat(F.lit("m"), "event_id").alias("body"), F.col("event_type").alias("serviceName"), F.col("event_id").cast("string").alias("traceId")))
    out = payloads.log_records(e.select(doc.alias("payload")))
    return out.select(F.col("trace_id").cast("bigint").alias("event_id"), "service", "severity", "message")


@query(f"WITH {LOGS} SELECT service, severity, count(*) AS n FROM logs GROUP BY 1, 2")
def A27_log_statistics(spark, sf_dir):
    return G.statistics(logs(spark, sf_dir))


@query(f"WITH {LOGS} SELECT service, severity, 'user=<NUMBER> paid <AMOUNT> from <IP>' AS template, count(*) AS n FROM logs GROUP BY 1, 2")
def A28_log_templates(spark, sf_dir):
    return G.template_counts(logs(spark, sf_dir)).select("service", "severity", "template", "n")


@query(f"WITH {LOGS} SELECT event_id, coalesce(o_orderpriority, service) AS span_service, CASE WHEN o_orderkey IS NULL THEN '' ELSE 'order' END AS span_operation FROM logs LEFT JOIN orders ON CAST(o_orderkey AS VARCHAR) = trace_id")
def J2_logs_to_spans(spark, sf_dir):
    s = spans(spark, sf_dir).where("parent_span_id IS NULL")
    return G.with_spans(logs(spark, sf_dir), s).select("event_id", "span_service", "span_operation")


@query(f"""WITH {LOGS}, j AS (SELECT coalesce(o_orderpriority, service) AS s, CASE WHEN o_orderkey IS NULL THEN '' ELSE 'order' END AS o FROM logs LEFT JOIN orders ON CAST(o_orderkey AS VARCHAR) = trace_id),
c AS (SELECT s, o, count(*) AS n FROM j GROUP BY 1, 2), p AS (SELECT o_orderpriority AS s, 'order' AS o, count(*) AS m FROM orders GROUP BY 1)
SELECT s AS service, o AS operation, n AS logs, round(coalesce(least(1.0, n / m), 1.0), 6) AS rate FROM c LEFT JOIN p USING (s, o)""")
def A30_emission_rates(spark, sf_dir):
    s = spans(spark, sf_dir).where("parent_span_id IS NULL")
    return G.emission_rates(logs(spark, sf_dir), s).select(F.col("service_name").alias("service"), F.col("operation_name").alias("operation"), "logs", r6("rate").alias("rate"))


# ---- sinks ---------------------------------------------------------------------------------------------------------


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return days(spark, sf_dir).select("timestamp", "entity_key", "x", F.col("n").cast("double").alias("n"))


@query(f"WITH {RAW}, {DAYS} SELECT us, entity_key, 'sml.n' AS first_name, CAST(n AS DOUBLE) AS first_value FROM days")
def K1_wide_to_otlp(spark, sf_dir):
    out = sinks.wide_to_otlp(wide(spark, sf_dir))
    at = "$.resourceMetrics[0].scopeMetrics[0].metrics[0]"
    return out.select(us("timestamp"), "entity_key", F.get_json_object("payload", f"{at}.name").alias("first_name"), r6(F.get_json_object("payload", f"{at}.gauge.dataPoints[0].asDouble").cast("double")).alias("first_value"))


@query(f"WITH {RAW}, {DAYS} SELECT 'x' AS metric, entity_key, round(x, 6) AS value FROM days UNION ALL SELECT 'n', entity_key, n FROM days")
def K2_json_lines(spark, sf_dir):
    got = F.from_json("value", "metric string, entity_key string, value double")
    return sinks.json_lines(wide(spark, sf_dir)).select(got.alias("g")).select("g.metric", "g.entity_key", r6("g.value").alias("value"))


@query(f"WITH {RAW}, {DAYS} SELECT entity_key, count(*) AS n FROM days GROUP BY 1")
def K6_json_rows(spark, sf_dir):
    return sinks.json_rows(wide(spark, sf_dir)).groupBy(F.get_json_object("value", "$.entity_key").alias("entity_key")).agg(F.count("*").alias("n"))


@query(f"WITH {SPANS} SELECT trace_id, service AS service_name, count(*) AS n FROM spans GROUP BY 1, 2")
def K7_traces_otlp(spark, sf_dir):
    out = sinks.traces_otlp(spans(spark, sf_dir))
    got = F.from_json("payload", "resourceSpans array<struct<scopeSpans: array<struct<spans: array<struct<spanId: string>>>>>>")
    return out.select("trace_id", "service_name", F.size(got["resourceSpans"][0]["scopeSpans"][0]["spans"]).cast("bigint").alias("n"))


@query(f"WITH {LOGS} SELECT service, CASE severity WHEN 'ERROR' THEN 17 ELSE 9 END AS number, count(*) AS n FROM logs GROUP BY ALL")
def K7_logs_otlp(spark, sf_dir):
    out = sinks.logs_otlp(logs(spark, sf_dir))
    number = F.get_json_object("payload", "$.resourceLogs[0].scopeLogs[0].logRecords[0].severityNumber").cast("int")
    return out.groupBy("service", number.alias("number")).agg(F.count("*").alias("n"))


@query("SELECT unnest(['c_custkey', 'c_name', 'c_acctbal', 'flag']) AS name, unnest(['C', 'S', 'C', 'B']) AS kind")
def K5_column_kinds(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", (F.col("c_nationkey") % 2).alias("flag"))
    return spark.createDataFrame(list(sinks.column_kinds(c).items()), "name string, kind string")


@query("SELECT round(corr(c_acctbal, c_nationkey), 6) AS corr, round(covar_samp(c_acctbal, c_nationkey), 4) AS covariance FROM customer")
def K12_bivariate(spark, sf_dir):
    return T.bivariate(table(spark, sf_dir, "customer"), "c_acctbal", "c_nationkey").select(r6("corr").alias("corr"), F.round("covariance", 4).alias("covariance"))


@query("SELECT CAST(CASE WHEN l_quantity < 0 THEN 0 WHEN l_quantity >= 50 THEN 11 ELSE floor(l_quantity / 5) + 1 END AS BIGINT) AS bin, count(*) AS n FROM lineitem GROUP BY 1")
def K12_histogram(spark, sf_dir):
    return T.histogram(table(spark, sf_dir, "lineitem"), "l_quantity", 0, 50, 10)


# ---- columns and predicates ----------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def P1_select(spark, sf_dir):
    return X.select_cols(table(spark, sf_dir, "orders"), ["o_orderkey", "missing", "o_orderstatus"])


@query("SELECT o_orderkey, o_totalprice * 2 AS double_price, o_orderstatus AS state FROM orders")
def P2_set_rename_drop(spark, sf_dir):
    o = X.rename_col(X.set_col(table(spark, sf_dir, "orders"), "double_price", F.col("o_totalprice") * 2), "o_orderstatus", "state")
    return X.reorder_cols(o, ["state"]).drop("nothing", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")


@query("SELECT r_regionkey, r_name, CAST(0 AS DOUBLE) AS added FROM region")
def P9_align(spark, sf_dir):
    return X.align_columns(table(spark, sf_dir, "region"), ["added", "r_name"], 0.0)


@query(f"WITH {RAW}, {DAYS} SELECT us, entity_key, x, CAST(NULL AS DOUBLE) AS later FROM days")
def P10_registry(spark, sf_dir):
    registry = D.Registry(columns=["later", "x"])
    out = registry.align(wide(spark, sf_dir), register_new=False)
    return out.select(us("timestamp"), "entity_key", "x", "later")


@query("SELECT unnest(['a', 'b', 'c__success', 'c__client_error', 'c__server_error']) AS name")
def P12_status_columns(spark, sf_dir):
    return spark.createDataFrame([(n,) for n in D.status_complete(["a", "b", "c__success"])], "name string")


@query("SELECT event_id, CAST(event_type = 'error' AS INTEGER) AS is_error FROM events")
def P15_error_flag(spark, sf_dir):
    return D.add_error_flag(table(spark, sf_dir, "events"), "event_type").select("event_id", "is_error")


@query("SELECT p_partkey, coalesce(p_name LIKE '%green%', false) AS has, coalesce(starts_with(p_type, 'ST'), false) AS begins, coalesce(p_brand = 'Brand#13', false) AS same FROM part")
def F2_text_tests(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", X.contains("p_name", "green").alias("has"), X.starts_with("p_type", "ST").alias("begins"), X.eq("p_brand", "Brand#13").alias("same"))


@query("SELECT event_id, event_id % 3 = 0 AS missing FROM events")
def F3_null_tests(spark, sf_dir):
    x = F.when(F.col("event_id") % 3 == 0, float("nan")).otherwise(F.col("value"))
    return table(spark, sf_dir, "events").select("event_id", X.is_null(x).alias("missing"))


@query(f"WITH {RAW} SELECT event_id FROM raw WHERE service IN ('click', 'view') AND status = '200' AND instance <> '3'")
def F4_label_filters(spark, sf_dir):
    rows = P.by_labels(raw.event_samples(spark, sf_dir), service_name=["click", "view"], status_code="200")
    return P.without_labels(rows, instance="3", absent="x").select("event_id")


@query("SELECT event_id FROM events")
def F7_metric_filter(spark, sf_dir):
    return P.by_metrics(P.by_metrics(raw.event_samples(spark, sf_dir), ["^event_", "^http_"]), ["^http_"], exclude=True).select("event_id")


@query("SELECT event_id FROM events WHERE value > 400")
def F8_callback_filter(spark, sf_dir):
    from ..session import shipped

    return P.by_condition(shipped(table(spark, sf_dir, "events").select("event_id", "value")), lambda r: r["value"] > 400).select("event_id")


METRICS = ("http_server_duration_bucket", "http_server_duration_count", "http_server_requests_total", "http_server_body_size_bytes", "go_memory_used_bytes", "go_config_gogc", "redis_uptime", "app_cart_latency_seconds_sum", "app_cart_calls_total", "app_cart_items", "kafka_consumer_records_lag", "kafka_consumer_other", "plain", "db_client_operation_duration_bucket")


def metric_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(METRICS)), "place int, metric string")


@query("SELECT unnest(['http_server_duration_bucket', 'http_server_duration_count', 'go_memory_used_bytes', 'app_cart_latency_seconds_sum', 'kafka_consumer_records_lag', 'plain', 'db_client_operation_duration_bucket']) AS metric")
def F11_salient_metrics(spark, sf_dir):
    return P.salient_metrics(metric_names(spark)).select("metric")


@query("SELECT unnest(['http_server', 'go', 'redis', 'app_cart', 'kafka_consumer', 'plain', 'db_client']) AS prefix")
def F12_broad_prefix(spark, sf_dir):
    return metric_names(spark).select(P.broad_prefix(N.metric_family("metric")).alias("prefix")).distinct()


@query("SELECT event_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOUR")
def F17_retention(spark, sf_dir):
    return P.recent(raw.event_samples(spark, sf_dir), 24).select("event_id")


@query("SELECT epoch_us(max(ts)) AS us FROM events")
def F18_gap(spark, sf_dir):
    return P.gap(raw.event_samples(spark, sf_dir), F.lit("2030-01-01").cast("timestamp"), 60).select(us("last_seen"))


# ---- scalar functions ----------------------------------------------------------------------------------------------


@query("SELECT * FROM (VALUES ('a_total', 'a', 'counter'), ('b_bucket', 'b', 'histogram'), ('c_sum', 'c', 'histogram_component'), ('d_info', 'd', 'info'), ('e_created', 'e', 'timestamp'), ('f', 'f', 'gauge'), ('g_total_count', 'g_total', 'histogram_component')) t(metric, family, kind)")
def C1_C2_family_and_type(spark, sf_dir):
    rows = spark.createDataFrame([(m,) for m in ("a_total", "b_bucket", "c_sum", "d_info", "e_created", "f", "g_total_count")], "metric string")
    return rows.select("metric", N.metric_family("metric").alias("family"), N.metric_type("metric").alias("kind"))


@query("SELECT * FROM (VALUES ('x_total', 'counter', NULL), ('x_count', 'histogram', 'count'), ('x', 'gauge', NULL), ('Total_x', 'counter', NULL)) t(metric, type, subtype)")
def C3_detected_type(spark, sf_dir):
    rows = spark.createDataFrame([(m,) for m in ("x_total", "x_count", "x", "Total_x")], "metric string")
    kind = N.detected_type("metric", F.create_map().cast("map<string,string>"))
    return rows.select("metric", kind["type"].alias("type"), kind["subtype"].alias("subtype"))


@query("""SELECT p_partkey, trim(regexp_replace(regexp_replace(translate(lower(p_type), '.-', '__'), '[^a-z0-9_]', '', 'g'), '_+', '_', 'g'), '_') AS plain,
 trim(regexp_replace(regexp_replace(translate(lower(p_brand || '/' || p_type), '.-/:', '____'), '[^a-z0-9_]', '', 'g'), '_+', '_', 'g'), '_') AS value FROM part""")
def C4_C5_sanitize(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", N.sanitize_name("p_type").alias("plain"), N.sanitize_label_value(F.concat("p_brand", F.lit("/"), "p_type")).alias("value"))


@query("SELECT n_nationkey, 'http_x__p99__a_' || lower(replace(n_name, ' ', '')) || '__b_1' AS feature FROM nation")
def C6_feature_name(spark, sf_dir):
    labels = F.create_map(F.lit("b"), F.lit("1"), F.lit("A"), F.col("n_name"))
    return table(spark, sf_dir, "nation").select("n_nationkey", N.feature_name(F.lit("http.x"), F.lit("p99"), labels).alias("feature"))


@query("SELECT n_nationkey, 'f' AS family, 'p50' AS aggregation, '{\"a\":\"' || n_nationkey || '_z\"}' AS labels FROM nation")
def C8_parse_feature_name(spark, sf_dir):
    name = N.parsed_feature_name(F.concat(F.lit("f__p50__a_"), F.col("n_nationkey").cast("string"), F.lit("_z")))
    return table(spark, sf_dir, "nation").select("n_nationkey", name["family"].alias("family"), name["aggregation"].alias("aggregation"), F.to_json(name["labels"]).alias("labels"))


CODE = "(CASE event_id % 9 WHEN 0 THEN ' 200 ' WHEN 1 THEN '404' WHEN 2 THEN '503' WHEN 3 THEN '302' WHEN 4 THEN '101' WHEN 5 THEN 'all ok' WHEN 6 THEN 'not found' WHEN 7 THEN '13' ELSE '200.0' END)"


def codes(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.expr(CODE.replace("%", "%")).alias("code"))


@query("""SELECT event_id, ['success', 'client_error', 'server_error', 'redirect', 'informational', 'success', 'client_error', 'unknown', 'success'][1 + event_id % 9] AS http,
 ['unknown', 'unknown', 'unknown', 'unknown', 'unknown', 'success', 'client_error', 'server_error', 'success'][1 + event_id % 9] AS grpc,
 ['success', 'client_error', 'server_error', 'redirect', 'informational', 'success', 'client_error', 'server_error', 'success'][1 + event_id % 9] AS smart,
 event_id % 9 IN (1, 2, 6, 7) AS bad FROM events""")
def C10_C14_status(spark, sf_dir):
    return codes(spark, sf_dir).select("event_id", S.http_status("code").alias("http"), S.grpc_status("code").alias("grpc"), S.status_bucket("code").alias("smart"), S.is_error("code").alias("bad"))


@query("""SELECT event_id, ['read', 'write', 'other', 'unknown'][1 + event_id % 4] AS method FROM events""")
def C15_http_method(spark, sf_dir):
    m = F.element_at(F.array(F.lit(" get"), F.lit("DELETE"), F.lit("connect"), F.lit("WEIRD")), (F.col("event_id") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", O.http_method(m).alias("method"))


@query("""SELECT event_id, ['read', 'write', 'ddl', 'transaction', 'metadata', 'other', 'other', 'other'][1 + event_id % 8] AS sql,
 ['other', 'other', 'other', 'other', 'other', 'read', 'stream', 'other'][1 + event_id % 8] AS rpc,
 ['other', 'other', 'other', 'other', 'other', 'other', 'other', 'publish'][1 + event_id % 8] AS messaging,
 ['read', 'write', 'ddl', 'other', 'other', 'other', 'stream', 'other'][1 + event_id % 8] AS smart FROM events""")
def C16_C19_operations(spark, sf_dir):
    texts = ("select * from t", "INSERT INTO t", "create table t", "start transaction", "SHOW tables", "pkg.Svc/GetUser", "StreamEvents", "x publish y")
    op = F.element_at(F.array(*map(F.lit, texts)), (F.col("event_id") % 8 + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", O.sql_operation(op).alias("sql"), O.rpc_operation(op).alias("rpc"), O.messaging_operation(op).alias("messaging"), O.operation_bucket(op).alias("smart"))


@query("""SELECT event_id, event_type AS service, 'prod' AS env, 'a:b' AS rest, 'true' AS bare FROM events""")
def C20_C23_tags(spark, sf_dir):
    tags = F.array(F.lit("service:first"), F.concat(F.lit("service:"), "event_type"), F.lit("env:prod"), F.lit("x:a:b"), F.lit("bare"))
    m = L.dd_labels(tags, F.lit("h"))
    return table(spark, sf_dir, "events").select("event_id", m["service_name"].alias("service"), m["environment"].alias("env"), m["x"].alias("rest"), m["bare"].alias("bare"))


ROUTE_SQL = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(u, '\d{4}-\d{2}-\d{2}', '{date}', 'g'), '/\d{10,13}(/|$)', '/{timestamp}\1', 'g'), '/\d+(/|$)', '/{id}\1', 'g'), '/[a-zA-Z0-9_-]{20,}(/|$)', '/{slug}\1', 'g')"""


@query(rf"SELECT page_id, {ROUTE_SQL} AS route FROM (SELECT page_id, '/api/' || page_id || '/on/2024-01-15/x' AS u FROM pages)")
def C24_parameterized_routes(spark, sf_dir):
    u = F.concat(F.lit("/api/"), F.col("page_id").cast("string"), F.lit("/on/2024-01-15/x"))
    return table(spark, sf_dir, "pages").select("page_id", R.parameterize_route(u).alias("route"))


@query("SELECT '/u/{id}/abc' AS template, count(*) AS n FROM pages")
def C26_route_groups(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.concat(F.lit("/u/"), F.col("page_id").cast("string"), F.lit("/abc")).alias("route"))
    return R.routes_by_template(pages, "route").select("template", "n")


@query("SELECT c_custkey, CASE WHEN c_mktsegment IN (SELECT c_mktsegment FROM customer GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 2) THEN c_mktsegment ELSE '__other__' END AS segment FROM customer")
def C28_top_n(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    top = Q.top_values_of(c.groupBy(F.col("c_mktsegment").alias("value")).agg(F.count("*").alias("n")), 2)
    return c.select("c_custkey", L.top_or_other("c_mktsegment", top).alias("segment"))


@query("""SELECT * FROM (VALUES ('service_name', 'resource', 'keep', true), ('http-status-code', 'signal', 'bucket', false), ('x_response_code_y', 'signal', 'bucket', false), ('trace_id', 'correlation', 'drop', false), ('order_id', 'correlation', 'drop', false),
 ('le', 'internal', 'special', false), ('zone', 'resource', 'keep', false), ('instance', 'resource', 'keep_or_aggregate', true), ('anything', 'dimension', 'auto', false)) t(label, category, handling, entity)""")
def C29_C30_label_kinds(spark, sf_dir):
    names = ("service_name", "http-status-code", "x_response_code_y", "trace_id", "order_id", "le", "zone", "instance", "anything")
    rows = spark.createDataFrame([(n,) for n in names], "label string")
    kind = L.label_kind("label")
    return rows.select("label", kind["category"].alias("category"), kind["handling"].alias("handling"), L.is_entity_label("label").alias("entity"))


@query(f"""WITH {RAW} SELECT event_id, '{{"instance":"' || instance || '","service_name":"' || service || '","status_code":"' || CASE status WHEN '500' THEN 'server_error' ELSE 'success' END || '"}}' AS labels,
 CASE status WHEN '500' THEN 'server_error' ELSE 'success' END AS signal_key, 'instance=' || instance || '::service_name=' || service AS entity_key FROM raw""")
def C32_C34_rewrite(spark, sf_dir):
    rows = D.rewrite_labels(raw.event_samples(spark, sf_dir))
    return rows.select("event_id", L.labels_json("labels").alias("labels"), "signal_key", L.entity_key("labels").alias("entity_key"))


@query("SELECT event_id, epoch_us(ts) // 300000000 * 300000000 AS us FROM events")
def C36_floor(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", us(V.floor_time("ts", V.step_seconds("5m"))))


@query("SELECT event_id, round(CASE WHEN event_id % 4 = 0 THEN NULL ELSE value / (event_id % 4) END, 6) AS quotient, round(abs(value - 100), 6) AS away FROM events")
def C37_arithmetic(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", r6(V.divided("value", F.col("event_id") % 4)).alias("quotient"), r6(F.abs(V.added("value", F.lit(-100.0)))).alias("away"))


@query("SELECT event_id, CASE WHEN event_id % 5 = 0 THEN -1 ELSE round(value, 6) END AS value FROM events")
def C38_replace_inf(spark, sf_dir):
    x = F.when(F.col("event_id") % 5 == 0, F.lit(float("inf"))).otherwise(F.col("value"))
    return table(spark, sf_dir, "events").select("event_id", r6(V.finite(x, -1.0)).alias("value"))


@query("SELECT l_returnflag, round(count(*) FILTER (l_linestatus = 'F') / count(*), 6) AS error_rate, round(count(*) / 3600, 6) AS throughput FROM lineitem GROUP BY 1")
def C40_ratios(spark, sf_dir):
    g = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum((F.col("l_linestatus") == "F").cast("int")).alias("bad"))
    return g.select("l_returnflag", r6(V.ratio("bad", "n")).alias("error_rate"), r6(V.throughput("n", F.lit(3600))).alias("throughput"))


@query(f"WITH {RAW}, {DAYS} SELECT us, entity_key, round(x - lag(x) OVER w, 6) AS delta, round(100 * (x - lag(x) OVER w) / abs(lag(x) OVER w), 4) AS pct FROM days WINDOW w AS (PARTITION BY entity_key ORDER BY us)")
def C41_change(spark, sf_dir):
    over = Window.partitionBy("entity_key").orderBy("timestamp")
    rows = days(spark, sf_dir).withColumn("old", F.lag("x").over(over))
    c = V.change("x", "old")
    return rows.select(us("timestamp"), "entity_key", r6(c["delta"]).alias("delta"), F.round(c["pct"], 4).alias("pct"))


@query("SELECT event_id, 'user=<NUMBER> paid <AMOUNT> from <IP>' AS template FROM events")
def C42_log_template(spark, sf_dir):
    return logs(spark, sf_dir).select("event_id", V.log_template("message").alias("template"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS k FROM events")
def C43_tags_json(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", V.parse_tags_json("props")["k"].alias("k"))


@query(f"WITH {RAW} SELECT event_id, 'event_value|{{\"instance\":\"' || instance || '\",\"service_name\":\"' || service || '\",\"status_code\":\"' || status || '\"}}' AS key FROM raw")
def C45_series_key(spark, sf_dir):
    return raw.event_samples(spark, sf_dir).select("event_id", L.series_key("metric", "labels").alias("key"))


# ---- aggregates ----------------------------------------------------------------------------------------------------


@query("""SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 6) AS l_quantity__mean, round(stddev_samp(l_quantity), 6) AS l_quantity__std, min(l_quantity) AS l_quantity__min, max(l_quantity) AS l_quantity__max,
 round(sum(l_quantity), 2) AS l_quantity__sum, CAST(count(DISTINCT l_suppkey) AS DOUBLE) AS l_suppkey__nunique, CAST(count(*) AS DOUBLE) AS l_suppkey__count FROM lineitem GROUP BY 1, 2""")
def A1_A2_group_aggregates(spark, sf_dir):
    g = X.aggregate(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], {"l_quantity": ["mean", "std", "min", "max", "sum"], "l_suppkey": ["nunique", "count"]})
    return g.withColumns({"l_quantity__mean": r6("l_quantity__mean"), "l_quantity__std": r6("l_quantity__std"), "l_quantity__sum": F.round("l_quantity__sum", 2)})


@query("SELECT event_type, round(arg_min(value, event_id), 6) AS value__first, round(arg_max(value, event_id), 6) AS value__last FROM events GROUP BY 1")
def A6_first_last(spark, sf_dir):
    g = X.aggregate(table(spark, sf_dir, "events"), ["event_type"], {"value": ["first", "last"]}, order="event_id")
    return g.select("event_type", r6("value__first").alias("value__first"), r6("value__last").alias("value__last"))


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A running count of each user's events modulo 20: a counter with resets."""
    e = table(spark, sf_dir, "events")
    over = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return e.select("user_id", F.col("ts").cast("timestamp").alias("timestamp"), "event_id", (F.row_number().over(over) % 20).cast("double").alias("value"))


COUNTERS = "counters AS (SELECT user_id, epoch_us(ts) AS us, event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) % 20 AS DOUBLE) AS value FROM events)"


@query(f"""WITH {COUNTERS}, a AS (SELECT user_id, arg_min(value, (us, value)) AS f, arg_max(value, (us, value)) AS l, (max(us) - min(us)) / 1000000 AS t, count(*) AS n FROM counters GROUP BY 1)
SELECT user_id, CASE WHEN n < 2 THEN 0 WHEN l < f THEN l ELSE l - f END AS count, round(CASE WHEN n < 2 THEN 0 ELSE (CASE WHEN l < f THEN l ELSE l - f END) / CASE WHEN t > 0 THEN t ELSE 60 END END, 12) AS rate_per_sec FROM a""")
def A7_A8_counter_rates(spark, sf_dir):
    return A.counter_rates(counters(spark, sf_dir), ["user_id"]).select("user_id", "count", F.round("rate_per_sec", 12).alias("rate_per_sec"))


@query(f"""WITH {COUNTERS}, f AS (SELECT *, coalesce(value < 0.5 * lag(value) OVER w, false) AS reset FROM counters WINDOW w AS (PARTITION BY user_id ORDER BY event_key)), g AS (SELECT *, sum(CAST(reset AS INT)) OVER (PARTITION BY user_id ORDER BY event_key ROWS UNBOUNDED PRECEDING) AS seg FROM f),
s AS (SELECT user_id, seg, arg_max(value, event_key) - arg_min(value, event_key) AS rise FROM g GROUP BY 1, 2) SELECT user_id, sum(greatest(rise, 0)) AS count, CAST(max(seg) AS BIGINT) AS resets FROM s GROUP BY 1""".replace("FROM events)", "FROM events), keyed AS (SELECT *, row_number() OVER (ORDER BY us, event_id) AS event_key FROM counters)").replace("AS reset FROM counters", "AS reset FROM keyed"))
def A9_counter_resets(spark, sf_dir):
    c = counters(spark, sf_dir).withColumn("at", F.struct("timestamp", "event_id"))
    return A.counter_with_resets(c, ["user_id"], "at")


@query("SELECT event_type, round(arg_max(value, (ts, event_id)), 6) AS last, round(avg(value), 6) AS mean, min(value) AS min, max(value) AS max, round(coalesce(stddev_samp(value), 0), 6) AS stddev FROM events GROUP BY 1")
def A10_gauge_stats(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("at", F.struct("ts", "event_id"))
    g = A.gauge_stats(e, ["event_type"], "value", "at")
    return g.select("event_type", r6("last").alias("last"), r6("mean").alias("mean"), "min", "max", r6("stddev").alias("stddev"))


BOUNDS = (10.0, 50.0, 100.0, 250.0, 500.0)


def buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative histogram samples of event values by service; a series an instance."""
    e = raw.event_samples(spark, sf_dir).select(F.col("labels")["service_name"].alias("service"), F.col("labels")["instance"].alias("instance"), "value")
    counts = e.groupBy("service", "instance").agg(*[F.sum((F.col("value") <= b).cast("double")).alias(f"b{i}") for i, b in enumerate(BOUNDS)], F.count("*").cast("double").alias("inf"), F.sum("value").alias("s"))
    cells = [F.struct(F.lit("req_bucket").alias("metric"), F.lit(f"{b:g}").alias("le"), F.col(f"b{i}").alias("value")) for i, b in enumerate(BOUNDS)]
    cells += [F.struct(F.lit("req_bucket").alias("metric"), F.lit("+Inf").alias("le"), F.col("inf").alias("value")), F.struct(F.lit("req_sum").alias("metric"), F.lit(None).cast("string").alias("le"), F.col("s").alias("value")), F.struct(F.lit("req_count").alias("metric"), F.lit(None).cast("string").alias("le"), F.col("inf").alias("value"))]
    rows = counts.select("service", "instance", F.explode(F.array(*cells)).alias("c"))
    labels = F.map_filter(F.create_map(F.lit("service_name"), F.col("service"), F.lit("instance"), F.col("instance"), F.lit("le"), F.col("c.le")), lambda _, v: v.isNotNull())
    return rows.select("service", F.lit("2024-01-01").cast("timestamp").alias("timestamp"), "c.metric", labels.alias("labels"), "c.value")


def _percentile_sql(p: float) -> str:
    parts, low, before = [], "0.0", "0.0"
    for i, b in enumerate(BOUNDS):
        parts.append(f"WHEN b{i} >= {p} * n THEN CASE WHEN b{i} = {before} THEN {b} ELSE {low} + ({p} * n - {before}) / (b{i} - {before}) * ({b} - {low}) END")
        low, before = str(b), f"b{i}"
    return f"CASE {' '.join(parts)} ELSE {low} END"


_HISTOGRAM = f"""WITH h AS (SELECT event_type AS service, {', '.join(f'CAST(count(*) FILTER (value <= {b}) AS DOUBLE) AS b{i}' for i, b in enumerate(BOUNDS))}, CAST(count(*) AS DOUBLE) AS n, sum(value) AS s FROM events GROUP BY 1)
SELECT service, round({_percentile_sql(0.5)}, 6) AS p50, round({_percentile_sql(0.9)}, 6) AS p90, round({_percentile_sql(0.99)}, 6) AS p99, round(s / n, 6) AS mean, n AS count FROM h"""


@query(_HISTOGRAM)
def A12_histograms(spark, sf_dir):
    h = A.histograms(buckets(spark, sf_dir), ["service"])
    return h.select("service", r6("p50").alias("p50"), r6("p90").alias("p90"), r6("p99").alias("p99"), r6("mean").alias("mean"), "count")


@query(_HISTOGRAM)
def A13_histograms_by_labels(spark, sf_dir):
    rows = buckets(spark, sf_dir).withColumn("key", L.labels_json(F.map_filter("labels", lambda k, _: ~k.isin("le", "instance"))))
    h = A.histograms(rows, ["key"]).withColumn("service", F.get_json_object("key", "$.service_name"))
    return h.select("service", r6("p50").alias("p50"), r6("p90").alias("p90"), r6("p99").alias("p99"), r6("mean").alias("mean"), "count")


@query("SELECT event_type AS service, 0.0::DOUBLE AS rate, 0.0::DOUBLE AS count FROM events GROUP BY 1")
def A15_histograms_as_counters(spark, sf_dir):
    return A.histograms_as_counters(buckets(spark, sf_dir), ["service"]).select("service", "rate", "count")


@query("SELECT l_shipdate IS NOT NULL AS k, count(*) AS total, round(count(*) FILTER (l_returnflag = 'R') / count(*), 6) AS error_rate, round(count(*) FILTER (l_returnflag = 'N') / count(*), 6) AS success_rate, round(1 - count(*) FILTER (l_returnflag = 'R') / count(*), 6) AS availability FROM lineitem GROUP BY 1")
def A19_status_rates(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    c = l.groupBy(F.col("l_shipdate").isNotNull().alias("k"), F.when(F.col("l_returnflag") == "R", "server_error").when(F.col("l_returnflag") == "N", "success").otherwise("redirect").alias("status")).agg(F.count("*").alias("count"))
    return A.status_rates(c, ["k"]).select("k", "total", r6("error_rate").alias("error_rate"), r6("success_rate").alias("success_rate"), r6("availability").alias("availability"))


@query(f"""WITH {RAW}, k AS (SELECT service, us, value, CASE service WHEN 'view' THEN 'count' WHEN 'click' THEN 'rate' ELSE 'gauge' END AS dd FROM raw), o AS (SELECT min(us) AS o FROM raw)
SELECT service, dd AS dd_type, CAST((us - o) // 86400000000 AS BIGINT) AS w, round(CASE dd WHEN 'count' THEN sum(value) WHEN 'rate' THEN avg(value) ELSE arg_max(value, (us, value)) END, 4) AS value FROM k, o GROUP BY 1, 2, 3""")
def A25_reaggregate(spark, sf_dir):
    e = raw.event_samples(spark, sf_dir).withColumn("service", F.col("labels")["service_name"])
    e = e.withColumn("dd_type", F.when(F.col("service") == "view", "count").when(F.col("service") == "click", "rate").otherwise("gauge"))
    return A.reaggregate(e, 86400, ["service"]).select("service", "dd_type", F.col("window").alias("w"), F.round("value", 4).alias("value"))


@query("""WITH l AS (SELECT 'instance' AS label, count(DISTINCT user_id % 10) AS c FROM events UNION ALL SELECT 'service_name', count(DISTINCT event_type) FROM events UNION ALL SELECT 'status_code', count(DISTINCT event_type = 'error') FROM events UNION ALL SELECT 'user', count(DISTINCT user_id) FROM events)
SELECT label, c AS cardinality, CASE WHEN c <= 10 THEN 1 WHEN c <= 50 THEN 2 WHEN c <= 200 THEN 3 ELSE 4 END AS tier, CASE WHEN c <= 10 THEN 'keep' WHEN c <= 50 THEN 'bucket' WHEN c <= 200 THEN 'top_n' ELSE 'drop' END AS action FROM l""")
def A22_cardinality(spark, sf_dir):
    e = raw.event_samples(spark, sf_dir)
    e = e.withColumn("labels", F.map_concat("labels", F.create_map(F.lit("user"), F.col("user_id").cast("string"))))
    return Q.cardinality(e).select("label", "cardinality", "tier", "action")


@query("SELECT value, place FROM (SELECT CAST(user_id AS VARCHAR) AS value, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(user_id AS VARCHAR)) AS INTEGER) - 1 AS place FROM events GROUP BY 1) WHERE place < 20 AND (SELECT count(DISTINCT user_id) FROM events) BETWEEN 51 AND 200")
def O4_top_values(spark, sf_dir):
    e = raw.event_samples(spark, sf_dir)
    e = e.withColumn("labels", F.create_map(F.lit("user"), F.col("user_id").cast("string")))
    return Q.cardinality(e).where("action = 'top_n'").select(F.posexplode("top_values").alias("place", "value")).select("value", "place")


@query("""SELECT * FROM (VALUES ('instance', 'keep', NULL, 'resource'), ('service_name', 'keep', NULL, 'resource'), ('status_code', 'keep', 'status_code', 'signal')) t(label, action, bucket_type, category)""")
def G3_schema(spark, sf_dir):
    return Q.profile(raw.event_samples(spark, sf_dir)).select("label", "action", "bucket_type", "category")


@query("SELECT * FROM (VALUES ('event_value', 'gauge'), ('req', 'histogram')) t(family, type)")
def G1_families(spark, sf_dir):
    both = raw.event_samples(spark, sf_dir).select("metric", "labels").unionByName(buckets(spark, sf_dir).select("metric", "labels"))
    return Q.discover_families(both).select("family", "type")


@query("SELECT n_regionkey AS k, CASE WHEN n_regionkey < 2 THEN 'removed' ELSE 'both' END AS state, count(*) AS n_old, CASE WHEN n_regionkey >= 2 THEN count(*) END AS n_new, CASE WHEN n_regionkey >= 2 THEN 0::BIGINT END AS n_delta FROM nation GROUP BY 1 UNION ALL SELECT 9, 'added', NULL, 1, NULL")
def J7_G5_compare(spark, sf_dir):
    old = table(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").alias("k")).agg(F.count("*").alias("n"))
    new = old.where("k >= 2").unionByName(spark.range(1).select(F.lit(9).alias("k"), F.lit(1).cast("bigint").alias("n")))
    return Q.compare(old, new, ["k"], ["n"])


@query("""WITH c AS (SELECT c_mktsegment AS value, count(*) AS n FROM customer GROUP BY 1), o AS (SELECT *, sum(n) OVER (ORDER BY n DESC, value) AS upto, sum(n) OVER () AS total FROM c) SELECT value, n, round(upto / total, 6) AS covered FROM o WHERE (upto - n) / total < 0.5""")
def A39_coverage(spark, sf_dir):
    c = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("value")).agg(F.count("*").alias("n"))
    return Q.coverage(c, 0.5).select("value", "n", r6("covered").alias("covered"))


@query(f"WITH {RAW} SELECT 'instance=' || instance || '::service_name=' || service AS entity_key, count(*) AS n FROM raw GROUP BY 1")
def A41_entities(spark, sf_dir):
    return Q.entities(raw.event_samples(spark, sf_dir))


@query("SELECT 'o_clerk' AS \"column\", round(count(CASE WHEN o_orderkey % 3 = 0 THEN 1 END) / count(*), 6) AS completeness FROM orders UNION ALL SELECT 'o_orderkey', 1.0 FROM orders GROUP BY 1")
def A31_completeness(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("o_clerk", F.when(F.col("o_orderkey") % 3 == 0, 1))
    return Q.column_completeness(o, ["o_clerk", "o_orderkey"]).select("column", r6("completeness").alias("completeness"))


@query(f"""WITH {RAW}, {DAYS}, b AS (SELECT *, lag(x) OVER w AS before, CAST(row_number() OVER w - 1 AS DOUBLE) AS pos FROM days WINDOW w AS (PARTITION BY entity_key ORDER BY us)),
m AS (SELECT entity_key, avg(x) AS mu FROM days GROUP BY 1)
SELECT entity_key, count(*) AS n, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, round(avg((x - mu) ** 3) / power(avg((x - mu) ** 2), 1.5), 6) AS skew, round(avg((x - mu) ** 4) / power(avg((x - mu) ** 2), 2) - 3, 6) AS kurt,
 round(corr(x, before), 6) AS autocorr, round(regr_slope(x, pos), 6) AS slope FROM b JOIN m USING (entity_key) GROUP BY 1""")
def A32_series_stats(spark, sf_dir):
    s = T.series_stats(days(spark, sf_dir), ["entity_key"], "x")
    return s.select("entity_key", "n", *[r6(c).alias(c) for c in ("mean", "std", "skew", "kurt", "autocorr", "slope")])


@query(f"""WITH {COUNTERS}, k AS (SELECT *, value - lag(value) OVER w AS step FROM counters WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)) SELECT user_id, count(*) AS n, round(avg(CASE WHEN step < 0 THEN value ELSE step END), 6) AS mean, count(*) FILTER (step < 0) AS resets FROM k WHERE step IS NOT NULL GROUP BY 1""")
def A33_counter_profile(spark, sf_dir):
    c = counters(spark, sf_dir)
    c = c.withColumn("timestamp", F.timestamp_micros(F.unix_micros("timestamp") + F.row_number().over(Window.partitionBy("user_id").orderBy("timestamp", "event_id"))))
    return T.counter_profile(c, ["user_id"]).select("user_id", "n", r6("mean").alias("mean"), "resets")


@query()
def A34_histogram_profile(spark, sf_dir):
    h = buckets(spark, sf_dir).where("metric = 'req_bucket'").groupBy("service", A.bound(F.col("labels")["le"]).alias("le")).agg(F.sum("value").alias("value"))
    times = F.explode(F.array(F.struct(F.lit("2024-01-01").cast("timestamp").alias("timestamp"), F.lit(0.0).alias("f")), F.struct(F.lit("2024-01-02").cast("timestamp").alias("timestamp"), F.lit(1.0).alias("f"))))
    rows = h.select("service", "le", "value", times.alias("t")).select("service", "le", "t.timestamp", (F.col("value") * F.col("t.f")).alias("value"))
    return T.histogram_profile(rows, ["service"])


@query()
def A35_service_covariance(spark, sf_dir):
    e = raw.event_samples(spark, sf_dir)
    rows = e.groupBy(F.col("labels")["service_name"].alias("service"), F.col("labels")["instance"].alias("series"), V.floor_time("timestamp", 86400).alias("timestamp")).agg(F.avg("value").alias("value"))
    return T.service_covariance(rows.withColumn("is_counter", F.lit(False)))


@query(f"""WITH {RAW}, {DAYS}, t AS (SELECT DISTINCT us FROM days), d AS (SELECT us - lag(us) OVER (ORDER BY us) AS d FROM t) SELECT round((SELECT (max(us) - min(us)) / 1000000 FROM t), 3) AS duration_seconds, round((SELECT median(d) / 1000000 FROM d), 3) AS step_seconds, (SELECT count(DISTINCT entity_key) FROM days) AS series""")
def A38_regime_metadata(spark, sf_dir):
    m = T.regime_metadata(days(spark, sf_dir), ["entity_key"])
    return m.select(F.round("duration_seconds", 3).alias("duration_seconds"), F.round("step_seconds", 3).alias("step_seconds"), "series")


@query("WITH s AS (SELECT event_type, avg(value) AS m, stddev_samp(value) AS d FROM events GROUP BY 1) SELECT event_id, abs((value - m) / d) > 1.5 AS odd FROM events JOIN s USING (event_type)")
def A43_anomalies(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", T.zscore_anomaly("value", ["event_type"], 1.5).alias("odd"))


# ---- windows, order, joins, sets, reshape --------------------------------------------------------------------------

OVER = "WINDOW w AS (PARTITION BY entity_key ORDER BY us)"


@query(f"WITH {RAW}, {DAYS} SELECT us, entity_key, lag(x, 2) OVER w AS back, lead(x, 1) OVER w AS ahead FROM days {OVER}")
def W1_W2_shift(spark, sf_dir):
    over = Window.partitionBy("entity_key").orderBy("timestamp")
    return days(spark, sf_dir).select(us("timestamp"), "entity_key", X.shift("x", 2, over).alias("back"), X.shift("x", -1, over).alias("ahead"))


@query(f"WITH {RAW}, {DAYS} SELECT us, entity_key, round(x - avg(x) OVER (PARTITION BY entity_key), 6) AS centred FROM days")
def W3_transform(spark, sf_dir):
    out = X.transform(days(spark, sf_dir), ["entity_key"], "x", lambda x, w: x - F.avg(x).over(w), "centred")
    return out.select(us("timestamp"), "entity_key", r6("centred").alias("centred"))


@query(f"""WITH {RAW}, {DAYS} SELECT us, entity_key, CASE WHEN count(x) OVER r >= 3 THEN round(avg(x) OVER r, 6) END AS mean3, CASE WHEN count(x) OVER r >= 2 THEN round(stddev_samp(x) OVER r, 5) END AS std3, CASE WHEN count(x) OVER r >= 1 THEN max(x) OVER r END AS max3
 FROM days WINDOW r AS (PARTITION BY entity_key ORDER BY us ROWS 2 PRECEDING)""")
def W4_W7_rolling(spark, sf_dir):
    over = Window.partitionBy("entity_key").orderBy("timestamp")
    return days(spark, sf_dir).select(us("timestamp"), "entity_key", r6(X.rolling("x", 3, "mean", over)).alias("mean3"), F.round(X.rolling("x", 3, "std", over, 2), 5).alias("std3"), X.rolling("x", 3, "max", over, 1).alias("max3"))


@query(f"WITH {RAW}, {DAYS} SELECT us, entity_key, round(x - lag(x, 5) OVER w, 6) AS x__delta_5m, round(x - lag(x, 60) OVER w, 6) AS x__delta_60m FROM days {OVER}")
def W5_deltas(spark, sf_dir):
    d = W.deltas(days(spark, sf_dir), ["x"])
    return d.select(us("timestamp"), "entity_key", r6("x__delta_5m").alias("x__delta_5m"), r6("x__delta_60m").alias("x__delta_60m"))


@query(f"WITH {RAW}, {DAYS}, l AS (SELECT us, entity_key, 'x' AS feature, x AS value, row_number() OVER w AS p FROM days {OVER}) SELECT us, entity_key, feature, value FROM l UNION ALL SELECT a.us, a.entity_key, 'x__delta_5m', round(a.value - b.value, 6) FROM l a JOIN l b ON a.entity_key = b.entity_key AND a.p = b.p + 5")
def W5_long_deltas(spark, sf_dir):
    long = days(spark, sf_dir).select("timestamp", "entity_key", F.lit("x").alias("feature"), F.col("x").alias("value"))
    return W.long_deltas(long, [5]).select(us("timestamp"), "entity_key", "feature", r6("value").alias("value"))


@query(f"WITH {RAW}, {DAYS} SELECT us, entity_key, round((x - lag(x, 3) OVER w) / nullif(abs(lag(x, 3) OVER w), 0), 6) AS x__pct_change_3m FROM days {OVER}")
def W6_pct_change(spark, sf_dir):
    d = W.pct_changes(days(spark, sf_dir), ["x"], [3])
    return d.select(us("timestamp"), "entity_key", r6("x__pct_change_3m").alias("x__pct_change_3m"))


@query(f"WITH {RAW}, {DAYS} SELECT us, entity_key, lag(x, 1) OVER w AS x__lag_1, lag(x, 5) OVER w AS x__lag_5 FROM days {OVER}")
def W8_lags(spark, sf_dir):
    return W.lags(days(spark, sf_dir), ["x"]).select(us("timestamp"), "entity_key", "x__lag_1", "x__lag_5")


@query(f"""WITH {RAW}, {DAYS}, d AS (SELECT us, entity_key, x - lag(x, 5) OVER w AS d5 FROM days {OVER}) SELECT us, entity_key, round(d5, 6) AS d5, round((d5 - lag(d5, 60) OVER w) / nullif(abs(lag(d5, 60) OVER w), 0), 6) AS d5_pct FROM d {OVER}""")
def W9_delta_features(spark, sf_dir):
    d = W.delta_features(days(spark, sf_dir), ["x"])
    return d.select(us("timestamp"), "entity_key", r6("x__delta_5m").alias("d5"), r6("x__delta_5m__pct_change_60m").alias("d5_pct"))


@query(f"WITH {RAW}, o AS (SELECT min(us // 60000000 * 60000000) AS o FROM raw) SELECT CAST(o + (us - o) // 5400000000 * 5400000000 AS BIGINT) AS us, count(*) AS n FROM raw, o GROUP BY 1")
def W10_tumbling(spark, sf_dir):
    return W.tumbling(raw.event_samples(spark, sf_dir), 90, 60).groupBy(us("window_start")).agg(F.count("*").alias("n"))


@query("SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY event_id), 4) AS total FROM events")
def W13_cumulative(spark, sf_dir):
    return W.cumulative(table(spark, sf_dir, "events"), ["user_id"], "event_id").select("event_id", F.round("value", 4).alias("total"))


@query("SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_totalprice NULLS LAST, o_orderkey) - 1 AS INTEGER) AS place FROM orders")
def O1_O2_argsort(spark, sf_dir):
    return X.argsort(table(spark, sf_dir, "orders"), "o_totalprice", "o_orderkey", "place").select("o_orderkey", "place")


@query("SELECT 'head' AS part, o_orderkey FROM (SELECT o_orderkey FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 5) UNION ALL SELECT 'tail', o_orderkey FROM (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 5)")
def O3_head_tail(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    part = lambda f, n: f(o, 5, "o_totalprice", "o_orderkey").select(F.lit(n).alias("part"), "o_orderkey")
    return part(X.head, "head").unionByName(part(X.tail, "tail"))


@query("SELECT o_orderpriority, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r <= 3")
def O6_top_per_group(spark, sf_dir):
    return X.top_n(table(spark, sf_dir, "orders"), ["o_orderpriority"], 3, F.desc("o_totalprice"), F.col("o_orderkey")).select("o_orderpriority", "o_orderkey")


@query(f"""WITH {RAW}, {DAYS}, a AS (SELECT entity_key, arg_max(x, us) AS x FROM days WHERE us < epoch_us(TIMESTAMP '2024-01-10') GROUP BY 1) SELECT us, entity_key, round(days.x - a.x, 6) AS x__delta_1w FROM days LEFT JOIN a USING (entity_key) WHERE us >= epoch_us(TIMESTAMP '2024-01-10')""")
def J1_T3_window_deltas(spark, sf_dir):
    d = days(spark, sf_dir).select("timestamp", "entity_key", "x")
    cut = F.lit("2024-01-10").cast("timestamp")
    out = streams.window_deltas(d.where(F.col("timestamp") >= cut), d.where(F.col("timestamp") < cut))
    return out.select(us("timestamp"), "entity_key", r6("x__delta_1w").alias("x__delta_1w"))


@query("SELECT r_regionkey, r_name, n_name FROM (SELECT *, row_number() OVER (ORDER BY r_regionkey) AS p FROM region) JOIN (SELECT n_name, row_number() OVER (ORDER BY n_nationkey) AS p FROM nation) USING (p)")
def J8_concat_columns(spark, sf_dir):
    r = table(spark, sf_dir, "region").withColumn("k", F.col("r_regionkey"))
    n = table(spark, sf_dir, "nation").select("n_name", F.col("n_nationkey").alias("k"))
    return X.concat_columns(r, n, "k").select("r_regionkey", "r_name", "n_name")


@query("SELECT c_custkey FROM customer ANTI JOIN orders ON c_custkey = o_custkey")
def J9_anti_join(spark, sf_dir):
    return table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT n_nationkey AS k, n_name AS a, NULL AS b FROM nation UNION ALL SELECT r_regionkey, NULL, r_name FROM region")
def U1_concat_rows(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("a"))
    return X.concat_rows([n, table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("b"))])


@query("SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY 1, 2")
def U2_distinct_first(spark, sf_dir):
    return X.distinct_first(table(spark, sf_dir, "events"), ["user_id", "event_type"], "event_id").select("user_id", "event_type", "event_id")


PIVOT = f"WITH {RAW} SELECT us // 86400000000 * 86400000000 AS us, " + ", ".join(f"round(avg(value) FILTER (service = '{s}'), 6) AS \"{s}\"" for s in ("click", "error", "purchase", "signup", "view")) + " FROM raw GROUP BY 1"


@query(PIVOT)
def R1_pivot(spark, sf_dir):
    e = raw.event_samples(spark, sf_dir).select(V.floor_time("timestamp", 86400).alias("timestamp"), F.col("labels")["service_name"].alias("service"), "value")
    names = X.features_of(e, "service")
    return X.pivot(e, ["timestamp"], "service", "value", names, "mean").select(us("timestamp"), *[r6(n).alias(n) for n in names])


@query(f"WITH {RAW}, {DAYS} SELECT us, entity_key, 'x' AS feature, x AS value FROM days UNION ALL SELECT us, entity_key, 'n', n FROM days")
def R2_melt(spark, sf_dir):
    return X.melt(days(spark, sf_dir), ["timestamp", "entity_key"]).select(us("timestamp"), "entity_key", "feature", "value")


# ---- more of the inventory -----------------------------------------------------------------------------------------


@query("SELECT DISTINCT event_type AS service FROM events")
def A21_services(spark, sf_dir):
    return Q.services(raw.event_samples(spark, sf_dir))


@query(f"""WITH {COUNTERS}, k AS (SELECT user_id, event_id, us, value, user_id % 7 AS g FROM counters), a AS (SELECT user_id, g, arg_min(value, (us, value)) AS f, arg_max(value, (us, value)) AS l, (max(us) - min(us)) / 1000000 AS t, count(*) AS n FROM k GROUP BY 1, 2)
SELECT CAST(g AS VARCHAR) AS value, round(sum(CASE WHEN n < 2 THEN 0 ELSE (CASE WHEN l < f THEN l ELSE l - f END) / CASE WHEN t > 0 THEN t ELSE 60 END END), 9) AS rate FROM a GROUP BY 1""")
def A23_top_values_by_rate(spark, sf_dir):
    c = counters(spark, sf_dir).withColumn("metric", F.lit("c_total")).withColumn("labels_key", F.col("user_id").cast("string"))
    c = c.withColumn("labels", F.create_map(F.lit("g"), (F.col("user_id") % 7).cast("string")))
    return Q.rates_by_label(c, "g").select("value", F.round("rate", 9).alias("rate"))


@query("SELECT unnest(['instance', 'service_name', 'status_code']) AS label, 'counter' AS type")
def A24_dd_profile(spark, sf_dir):
    return Q.dd_profile(raw.event_samples(spark, sf_dir).withColumn("dd_type", F.lit("count"))).select("label", "type")


@query("SELECT 'r' || n_regionkey AS label, 1::BIGINT AS families FROM nation GROUP BY 1 UNION ALL SELECT 'all', 5")
def A40_common_labels(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.concat(F.lit("f"), "n_regionkey").alias("family"), F.explode(F.array(F.lit("all"), F.concat(F.lit("r"), "n_regionkey"))).alias("label")).distinct()
    return Q.common_labels(n, 0.2)


@query("SELECT 'f' || n_regionkey AS family, 'r' || n_regionkey AS label FROM nation GROUP BY ALL")
def A40_unique_labels(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.concat(F.lit("f"), "n_regionkey").alias("family"), F.explode(F.array(F.lit("all"), F.concat(F.lit("r"), "n_regionkey"))).alias("label")).distinct()
    return Q.unique_labels(n)


@query("SELECT event_type AS name, round(value, 6) AS rps, event_type = 'Aggregated' AS is_total FROM events")
def A42_load_statistics(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    stats = F.array(F.struct(F.col("event_type").alias("name"), F.lit("GET").alias("method"), F.col("event_id").alias("num_requests"), F.lit(0).alias("num_failures"), F.lit(1.0).alias("avg_response_time"), F.col("value").alias("current_rps")))
    return T.load_statistics(e.select(F.to_json(F.struct(stats.alias("stats"))).alias("payload"))).select("name", r6("current_rps").alias("rps"), "is_total")


@query("SELECT 'order' AS operation, 'created' AS event, count(*) AS n, 0.5::DOUBLE AS mean_offset FROM orders")
def A37_span_events(spark, sf_dir):
    s = spans(spark, sf_dir).where("parent_span_id IS NULL")
    at = F.timestamp_micros(F.unix_micros("start_time") + 500000)
    s = s.withColumn("logs", F.array(F.struct(at.alias("timestamp"), F.create_map(F.lit("event"), F.lit("created")).alias("fields"))))
    return J.span_events(s).select(F.col("operation_name").alias("operation"), "event", "n", r6("mean_offset").alias("mean_offset"))


@query("SELECT DISTINCT event_type AS family, 'gauge' AS type FROM events WHERE event_type IN ('view', 'purchase', 'signup') AND event_type LIKE '%i%'")
def F9_F10_families(spark, sf_dir):
    """Families by their names' suffixes: click counters, error histograms, gauges; those with an i that are no counters or histograms."""
    e = raw.event_samples(spark, sf_dir)
    service = F.col("labels")["service_name"]
    e = e.withColumn("metric", F.concat(service, F.when(service == "click", "_total").when(service == "error", "_bucket").otherwise("")))
    return P.of_type(P.families(Q.discover_families(e), ["i", "error"], ["^zz"]), "gauge").select("family", "type")


@query("SELECT 'user' AS label, count(DISTINCT user_id) AS cardinality FROM events HAVING count(DISTINCT user_id) > 50")
def F19_min_tier(spark, sf_dir):
    e = raw.event_samples(spark, sf_dir)
    e = e.withColumn("labels", F.map_concat("labels", F.create_map(F.lit("user"), F.col("user_id").cast("string"))))
    return P.min_tier(Q.cardinality(e), 3).select("label", "cardinality")


@query("SELECT epoch_us(ts) // 1000000 * 1000000 AS us, 'm_x' AS metric, event_type AS service, round(value, 6) AS value, event_id FROM events WHERE event_id % 4 > 0")
def S14_dd_query(spark, sf_dir):
    e = raw.event_samples(spark, sf_dir)
    point = F.array(F.floor(V.epoch_seconds("timestamp")).cast("double") * 1000, F.when(F.col("event_id") % 4 > 0, F.col("value")))
    tags = F.array(F.concat(F.lit("service:"), F.col("labels")["service_name"]), F.concat(F.lit("event:"), F.col("event_id").cast("string")))
    series = F.struct(F.lit("m.x").alias("metric"), tags.alias("tag_set"), F.array(point).alias("pointlist"))
    out = payloads.dd_query(e.select(F.to_json(F.struct(F.array(series).alias("series"))).alias("payload")))
    return out.select(us("timestamp"), "metric", F.col("labels")["service_name"].alias("service"), r6("value").alias("value"), F.col("labels")["event"].cast("bigint").alias("event_id"))


@query("SELECT trace_id, span_id, parent, service AS service_name, us, dur, 'v' AS tag FROM (SELECT CAST(o_orderkey AS VARCHAR) AS trace_id, 's' AS span_id, 'p' AS parent, o_orderpriority AS service, epoch_us(o_orderdate) AS us, 7::BIGINT AS dur FROM orders)")
def S17_jaeger_payload(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    refs = F.array(F.struct(F.lit("FOLLOWS_FROM").alias("refType"), F.lit("q").alias("spanID")), F.struct(F.lit("CHILD_OF").alias("refType"), F.lit("p").alias("spanID")))
    span = F.struct(key.alias("traceID"), F.lit("s").alias("spanID"), F.lit("op").alias("operationName"), F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("startTime"), F.lit(7).alias("duration"), F.lit("p1").alias("processID"), refs.alias("references"), F.array(F.struct(F.lit("k").alias("key"), F.lit("v").alias("value"))).alias("tags"))
    trace = F.struct(key.alias("traceID"), F.create_map(F.lit("p1"), F.struct(F.col("o_orderpriority").alias("serviceName"))).alias("processes"), F.array(span).alias("spans"))
    out = payloads.jaeger_spans(o.select(F.to_json(F.struct(F.array(trace).alias("data"))).alias("payload")))
    return out.select("trace_id", "span_id", F.col("parent_span_id").alias("parent"), "service_name", us("start_time"), F.col("duration_us").alias("dur"), F.col("tags")["k"].alias("tag"))


@query(f"""WITH {COUNTERS}, r AS (SELECT user_id % 2 AS regime, user_id, us, event_id, value, value - lag(value) OVER w AS step FROM counters WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id))
SELECT 'r' || regime AS regime, CAST(user_id AS VARCHAR) AS labels_key, 'counter' AS kind, count(*) AS n, round(avg(greatest(CASE WHEN step < 0 THEN value ELSE step END, 0)), 6) AS mean FROM r WHERE step IS NOT NULL GROUP BY 1, 2""")
def N1_regime_profiles(spark, sf_dir):
    c = counters(spark, sf_dir)
    c = c.withColumn("timestamp", F.timestamp_micros(F.unix_micros("timestamp") + F.row_number().over(Window.partitionBy("user_id").orderBy("timestamp", "event_id"))))
    c = c.select(F.concat(F.lit("r"), (F.col("user_id") % 2).cast("string")).alias("regime"), F.lit("c_total").alias("metric"), F.col("user_id").cast("string").alias("labels_key"), "timestamp", "value")
    return T.regime_profiles(c).select("regime", "labels_key", "kind", "n", r6("mean").alias("mean"))


@query("SELECT n_nationkey AS k, length(n_name) AS size, CASE WHEN n_regionkey = 1 THEN 1.0::DOUBLE END AS one FROM nation")
def P14_wide_from_features(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    k = n.select(F.col("n_nationkey").alias("k"))
    size = n.select(F.col("n_nationkey").alias("k"), F.length("n_name").cast("bigint").alias("value"))
    one = n.where("n_regionkey = 1").select(F.col("n_nationkey").alias("k"), F.lit(1.0).alias("value"))
    return X.wide_from_features(k, {"size": size, "one": one}, ["k"])


@query("SELECT n_nationkey AS k, upper(n_name) || n_regionkey AS made FROM nation")
def V2_row_function(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), "n_name", "n_regionkey")
    return X.apply_rows(n, lambda r: f"{r['n_name'].upper()}{r['n_regionkey']}", "made", "string").select("k", "made")


@query("SELECT n_regionkey AS r, count(*) AS n, max(n_nationkey) - min(n_nationkey) AS width, string_agg(n_name, '/' ORDER BY n_name) AS names FROM nation GROUP BY 1")
def V3_W14_group_function(spark, sf_dir):
    import pandas as pd

    n = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("r"), "n_nationkey", "n_name")
    one = lambda g: pd.DataFrame({"r": [g["r"].iloc[0]], "n": [len(g)], "width": [g["n_nationkey"].max() - g["n_nationkey"].min()], "names": ["/".join(sorted(g["n_name"]))]})
    return X.apply_groups(n, ["r"], one, "r int, n bigint, width bigint, names string")


@query("SELECT epoch_us(ts) AS us, epoch_us(lead(ts) OVER (ORDER BY ts)) AS until, CASE WHEN event_type = 'error' THEN 'error' ELSE '' END AS regimes FROM (SELECT DISTINCT ON (ts) ts, event_type FROM events ORDER BY ts, event_id)")
def Z5_event_intervals(spark, sf_dir):
    e = X.distinct_first(table(spark, sf_dir, "events"), ["ts"], "event_id")
    out = Y.event_intervals(e.select("ts", F.col("event_type").alias("action"), (F.col("event_type") == "error").alias("anomaly")))
    return out.select(us("start_time"), F.unix_micros(F.col("end_time").cast("timestamp")).alias("until"), F.array_join("regimes", ",").alias("regimes"))


# ---- synthesis, scenarios, streams ---------------------------------------------------------------------------------


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = T.series_stats(days(spark, sf_dir), ["entity_key"], "x")
    return s.select(F.lit("event_value").alias("metric"), F.col("entity_key").alias("labels_key"), F.lit("gauge").alias("kind"), "mean", "std", "autocorr", "slope", "min", "max")


@query()
def N2_N5_generated_series(spark, sf_dir):
    return Y.series(_profiles(spark, sf_dir), 100, "2024-02-01", 60)


@query()
def N3_correlated_series(spark, sf_dir):
    p = _profiles(spark, sf_dir).select(F.lit("events").alias("service"), F.col("labels_key").alias("series"), "mean", "std", "autocorr", "slope", "min", "max")
    d = days(spark, sf_dir).select(F.lit("events").alias("service"), F.col("entity_key").alias("series"), F.lit(False).alias("is_counter"), "timestamp", F.col("x").alias("value"))
    return Y.correlated_series(p, T.service_covariance(d), 50, "2024-02-01", 60)


@query()
def N4_generated_histograms(spark, sf_dir):
    p = A34_histogram_profile(spark, sf_dir).select(F.concat(F.col("service"), F.lit("_req")).alias("family"), "mu", "sigma", (F.col("per_step") / 100).alias("per_step"))
    return Y.histograms(p, BOUNDS, 20, "2024-02-01", 60)


@query()
def N6_generated_spans(spark, sf_dir):
    parts = F.array(*[F.struct(F.lit(p).alias("path"), F.lit(s).alias("service_name"), F.lit(o).alias("operation_name"), F.lit(m).alias("mean_us"), F.lit(m / 10).alias("std_us"), F.lit(0.1).alias("error_rate")) for p, s, o, m in (("0", "web", "GET /", 5000.0), ("0.0", "db", "SELECT", 2000.0), ("0.1", "cache", "get", 500.0))])
    return Y.spans(spark.range(1).select(F.lit("t").alias("template"), F.lit(1.0).alias("weight"), parts.alias("spans")), "2024-02-01", 60, 2.0)


@query("""WITH b AS (SELECT c_nationkey AS k, avg(c_acctbal) AS mean, stddev_samp(c_acctbal) AS std FROM customer WHERE c_nationkey < 20 GROUP BY 1),
o AS (SELECT c_nationkey AS k, avg(c_acctbal) AS mean, stddev_samp(c_acctbal) / 3 AS std FROM customer WHERE c_nationkey > 4 AND c_custkey % 5 > 0 GROUP BY 1),
t AS (SELECT c_nationkey AS k, 2 * avg(c_acctbal) AS mean, stddev_samp(c_acctbal) / 4 AS std FROM customer WHERE c_nationkey BETWEEN 3 AND 19 GROUP BY 1)
SELECT k, round(CASE WHEN b.k IS NULL THEN o.mean ELSE b.mean + coalesce(o.mean - b.mean, 0) + coalesce(t.mean - b.mean, 0) END, 6) AS mean,
 round(CASE WHEN b.k IS NULL THEN o.std ELSE greatest(b.std + coalesce(o.std - b.std, 0) + coalesce(t.std - b.std, 0), 0.01) END, 6) AS std
FROM b FULL JOIN o USING (k) FULL JOIN t USING (k) WHERE NOT (b.k IS NOT NULL AND o.k IS NULL AND t.k IS NULL)""")
def J10_superposed(spark, sf_dir):
    """Two regimes over a baseline: nations 20 on come in with the first, 0 to 2 go in both, 3 and 4 in one only."""
    c = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "k")
    stats = lambda rows, scale, share: rows.groupBy("k").agg((F.avg("c_acctbal") * scale).alias("mean"), (F.stddev_samp("c_acctbal") / share).alias("std"))
    base = stats(c.where("k < 20"), 1.0, 1.0)
    one = Y.regime_deltas(base, stats(c.where("k > 4 AND c_custkey % 5 > 0"), 1.0, 3.0), ["k"])
    two = Y.regime_deltas(base, stats(c.where("k BETWEEN 3 AND 19"), 2.0, 4.0), ["k"])
    return Y.superposed(base, [one, two], ["k"]).select("k", r6("mean").alias("mean"), r6("std").alias("std"))


@query("""SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-05' THEN 'base' WHEN ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-06' THEN 'spike,leak' END AS regimes FROM events""")
def N7_D20_labelled(spark, sf_dir):
    truth = Y.segments(spark, "2024-01-03", [(["base"], 2880), (["spike", "leak"], 1440)])
    return Y.labelled(raw.event_samples(spark, sf_dir).select("event_id", "timestamp"), truth).select("event_id", F.array_join("regimes", ",").alias("regimes"))


@query("SELECT event_type AS flag, CAST(arg_max(user_id, (ts, user_id)) AS VARCHAR) AS variant FROM events GROUP BY 1")
def Z4_flag_states(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return Y.flag_states(e.select("ts", F.col("event_type").alias("flag"), F.col("user_id").alias("variant"))).select("flag", F.col("variant").cast("string").alias("variant"))


@query("SELECT 'event_value' AS metric, CASE WHEN event_type = 'view' THEN 'count' ELSE 'gauge' END AS dd_type FROM events ORDER BY ts DESC, 2 DESC LIMIT 1")
def T6_type_registry(spark, sf_dir):
    e = raw.event_samples(spark, sf_dir).withColumn("dd_type", F.when(F.col("labels")["service_name"] == "view", "count").otherwise("gauge"))
    return streams.type_registry(e)


@query("SELECT epoch_us(max(ts)) AS us, count(*) AS rows FROM events")
def T7_checkpoint(spark, sf_dir):
    return streams.checkpoint_row(raw.event_samples(spark, sf_dir)).select(us("last_event"), "rows")


@query("SELECT event_id FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-09' AND TIMESTAMP '2024-01-10'")
def T1_poll_window(spark, sf_dir):
    return streams.poll_window(raw.event_samples(spark, sf_dir), "2024-01-10 00:00:00", 86400).select("event_id")


@query(f"""WITH {RAW} SELECT service, us + event_id AS us, round(value - lag(value) OVER (PARTITION BY service ORDER BY us + event_id), 6) AS delta FROM raw""")
def T3_stateful_stream(spark, sf_dir):
    """The events as a stream through stateful deltas, into files; event numbers as microseconds make times distinct."""
    schema = table(spark, sf_dir, "events").schema
    e = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")  # a pattern, as the table may be a file or a folder
    at = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.col("event_id"))
    rows = e.select(F.col("event_type").alias("entity_key"), F.lit("value").alias("feature"), at.alias("timestamp"), "value")
    out, state = inventory.folder(spark), inventory.folder(spark)
    run = streams.stateful_deltas(rows).writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.parquet(out).select(F.col("entity_key").alias("service"), us("timestamp"), r6("delta").alias("delta"))


from . import inventory  # noqa: E402  registers its queries here
