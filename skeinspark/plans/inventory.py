"""More registered queries: functions, state, streams, sources and sinks that ``catalog`` does not reach otherwise."""

from __future__ import annotations

import json
import struct
import tempfile
import threading
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from datetime import timezone
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import routes as R
from ..functions import values as V
from ..operators import filters as P
from ..operators import frame as X
from ..operators import logs as G
from ..operators import profile as Q
from ..operators import stats as T
from ..operators import synth as Y
from ..operators import traces as J
from ..session import checkpointed, checkpoints, ship
from ..sources import http, payloads, raw, sinks
from ..streaming import features as streams
from . import commands
from . import denormalize as D
from .catalog import BOUNDS, DAYS, LOGS, RAW, SPANS, _flagship_rows, _profiles, buckets, days, logs, metric_names, query, r6, spans, table, us, wide


def folder(spark: SparkSession) -> str:
    """A new folder that all executors see."""
    return f"{checkpoints(spark).sparkContext._jsc.sc().getCheckpointDir().get()}/{uuid.uuid4().hex}"


@contextmanager
def served(answer: Callable[[str, dict, bytes], dict]):
    """A server on this machine for the duration of a query; answer(path, parameters, body) gives its JSON."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            size = int(self.headers.get("Content-Length") or 0)
            found = urlparse(self.path)
            body = json.dumps(answer(found.path, parse_qs(found.query), self.rfile.read(size))).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        do_POST = do_GET

        def log_message(self, *_):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        yield f"http://127.0.0.1:{server.server_port}"
    finally:
        server.shutdown()


# ---- sources -------------------------------------------------------------------------------------------------------


@query(f"WITH {RAW}, {DAYS} SELECT us, entity_key, x FROM days")
def S1_S6_prometheus_server(spark, sf_dir):
    """The daily values through a server's range queries, a partition for each metric and week."""
    rows = [(r.timestamp.replace(tzinfo=timezone.utc).timestamp(), r.entity_key, r.x) for r in days(spark, sf_dir).select(F.to_timestamp_ntz(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")).alias("timestamp"), "entity_key", "x").collect()]
    first, last = min(t for t, *_ in rows), max(t for t, *_ in rows)

    def answer(path, given, _):
        if path.endswith("/values"):
            return {"status": "success", "data": ["event_value"]}
        low, high = float(given["start"][0]), float(given["end"][0])
        found: dict = {}
        for t, key, x in rows:
            if low <= t <= high:
                found.setdefault(key, []).append([t, str(x)])
        return {"status": "success", "data": {"result": [{"metric": {"__name__": given["query"][0], "instance": k}, "values": v} for k, v in found.items()]}}

    ship(spark).dataSource.register(http.PrometheusSource)
    with served(answer) as url:
        got = spark.read.format("prometheus").option("url", url).option("start", str(first)).option("end", str(last + 1)).option("chunk_seconds", str(7 * 86400)).load()
        got = checkpointed(got)
    return got.select(us("timestamp"), F.col("labels")["instance"].alias("entity_key"), F.col("value").alias("x"))


@query("SELECT DISTINCT event_type AS service, 'm_' || event_type || CASE user_id % 2 WHEN 0 THEN '_total' ELSE '_count' END AS metric, CASE user_id % 2 WHEN 0 THEN 'counter' ELSE 'histogram' END AS type FROM events")
def S10_remote_catalog(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    name = F.concat(F.lit("m_"), "event_type", F.when(F.col("user_id") % 2 == 0, "_total").otherwise("_count"))
    payload = F.to_json(F.struct(F.array(F.create_map(F.lit("__name__"), name, F.lit("service"), F.col("event_type"), F.lit("user"), F.col("user_id").cast("string"))).alias("data")))
    got = payloads.prometheus_series(e.select(payload.alias("payload"))).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    return Q.metric_catalog(got).select("service", "metric", "type")


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_custkey WHEN 1 THEN 60 * c_custkey ELSE 60 END AS seconds FROM customer")
def S11_configured_interval(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey").cast("string")
    text = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("global:\n  scrape_interval: "), k, F.lit("s\n"))).when(F.col("c_custkey") % 4 == 1, F.concat(F.lit("scrape_interval: '"), k, F.lit("m'"))).when(F.col("c_custkey") % 4 == 2, "evaluation_interval: 5s")
    return c.select("c_custkey", raw.scrape_interval_of(text).cast("bigint").alias("seconds"))


@query("SELECT DISTINCT 'app.' || event_type AS metric FROM events")
def S13_datadog_names(spark, sf_dir):
    e = table(spark, sf_dir, "events").groupBy((F.col("event_id") % 7).alias("page")).agg(F.collect_set(F.concat(F.lit("app."), "event_type")).alias("metrics"))
    return payloads.dd_metric_names(e.select(F.to_json(F.struct("metrics")).alias("payload")))


@query("SELECT DISTINCT 'app.' || event_type AS metric, unnest(['user', 'plain']) AS key, unnest([CAST(user_id AS VARCHAR), '']) AS value FROM events")
def S13_datadog_tags(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    tags = F.array(F.concat(F.lit("user:"), F.col("user_id").cast("string")), F.lit("plain"))
    payload = F.to_json(F.struct(F.struct(F.concat(F.lit("app."), "event_type").alias("id"), F.struct(tags.alias("tags")).alias("attributes")).alias("data")))
    return payloads.dd_metric_tags(e.select(payload.alias("payload")))


@query("SELECT p_name AS metric, CASE WHEN p_size % 2 = 0 THEN 'gauge' END AS type, p_brand AS unit FROM part")
def S13_datadog_metadata(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    payload = F.to_json(F.struct(F.when(F.col("p_size") % 2 == 0, "gauge").alias("type"), F.col("p_brand").alias("unit")))
    return payloads.dd_metadata(p.select(F.col("p_name").alias("metric"), payload.alias("payload"))).select("metric", "type", "unit")


def _varint(n: int) -> bytes:
    out = b""
    while n > 0x7F:
        out += bytes([n & 0x7F | 0x80])
        n >>= 7
    return out + bytes([n])


def _part(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


@query("SELECT event_id, epoch_us(ts) // 1000000 * 1000000 AS us, round(value, 6) AS value, event_type AS service, CASE event_id % 2 WHEN 0 THEN 'gauge' ELSE 'count' END AS dd_type FROM events")
def S25_dd_v2_protobuf(spark, sf_dir):
    @F.pandas_udf("binary")
    def packed(at: pd.Series, value: pd.Series, service: pd.Series, event: pd.Series) -> pd.Series:
        def one(t, v, s, e):
            point = b"\x09" + struct.pack("<d", v) + b"\x10" + _varint(int(t))
            return _part(1, _part(2, b"app.value") + _part(3, f"service:{s}".encode()) + _part(3, f"event:{e}".encode()) + _part(4, point) + b"\x28" + _varint(3 if e % 2 == 0 else 1))

        return pd.Series([one(*x) for x in zip(at, value, service, event)])

    e = table(ship(spark), sf_dir, "events")
    body = packed(F.floor(V.epoch_seconds("ts")), "value", "event_type", "event_id")
    out = payloads.dd_v2_protobuf(e.select(body.alias("body")))
    labels = F.col("labels")
    found = F.array_max(F.filter(F.map_values("labels"), lambda v: F.rlike(v, F.lit("^[0-9]+$"))).cast("array<bigint>"))
    service = F.filter(F.map_entries(labels), lambda x: x["key"].isin("service", "service_name"))[0]["value"]
    return out.select(found.alias("event_id"), us("timestamp"), r6("value").alias("value"), service.alias("service"), "dd_type")


@query("SELECT event_id, epoch_us(ts) // 1000000 * 1000000 AS us, round(value, 6) AS value FROM events")
def S27_landing_stream(spark, sf_dir):
    """Intake bodies as files of a folder, read as a stream."""
    e = table(spark, sf_dir, "events")
    series = F.struct(F.lit("app.value").alias("metric"), F.array(F.array(F.floor(V.epoch_seconds("ts")).cast("double"), F.col("value"))).alias("points"), F.array(F.concat(F.lit("event:"), F.col("event_id").cast("string"))).alias("tags"), F.lit("gauge").alias("type"))
    at, out = folder(spark), folder(spark)
    e.select(F.to_json(F.struct(F.array(series).alias("series"))).alias("value")).write.text(at)
    run = streams.landing(spark, at).writeStream.format("parquet").option("path", out).option("checkpointLocation", folder(spark)).trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.parquet(out).select(F.col("labels")["event"].cast("bigint").alias("event_id"), us("timestamp"), r6("value").alias("value"))


@query("SELECT CAST(r_regionkey AS DOUBLE) AS key, r_name AS name, CASE WHEN r_regionkey > 1 THEN r_regionkey * 0.5::DOUBLE END AS half FROM region")
def S30_records(spark, sf_dir):
    records = [{"key": r.r_regionkey, "name": r.r_name, **({"half": r.r_regionkey / 2} if r.r_regionkey > 1 else {})} for r in table(spark, sf_dir, "region").collect()]
    return raw.from_records(spark, records)


SCHEMA = """SELECT label, tier, cardinality, action FROM (SELECT 'instance' AS label, CASE WHEN n <= 10 THEN 1 WHEN n <= 50 THEN 2 WHEN n <= 200 THEN 3 ELSE 4 END AS tier, n AS cardinality, 'keep' AS action FROM (SELECT count(DISTINCT user_id % 10) AS n FROM events)
 UNION ALL SELECT 'service_name', 1, count(DISTINCT event_type), 'keep' FROM events UNION ALL SELECT 'status_code', 1, count(DISTINCT event_type = 'error'), 'keep' FROM events)"""


@query(SCHEMA)
def S32_K10_G4_saved_schema(spark, sf_dir):
    """Profile the samples, save the schema as JSON, read it again."""
    with tempfile.TemporaryDirectory() as at:
        with open(f"{at}/schema.json", "w") as f:
            json.dump(commands.profile(raw.event_samples(spark, sf_dir), ["^event"]), f)
        config = raw.load_config(f"{at}/schema.json")
    return raw.schema_frame(spark, config).select("label", "tier", "cardinality", "action")


@query("SELECT event_type AS service, ['event_value', 'm_' || event_type] AS metrics, 2::BIGINT AS n FROM events GROUP BY event_type")
def X3_discover(spark, sf_dir):
    e = raw.event_samples(spark, sf_dir).select("timestamp", "metric", "labels", "value")
    more = e.withColumn("metric", F.concat(F.lit("m_"), F.col("labels")["service_name"]))
    return commands.discover(e.unionByName(more))


@query(SCHEMA)
def X3_profile(spark, sf_dir):
    other = raw.event_samples(spark, sf_dir).withColumn("metric", F.lit("other_total"))
    both = raw.event_samples(spark, sf_dir).unionByName(other)
    return commands.profile_table(both, exclude=["^other"]).select("label", "tier", "cardinality", "action")


# ---- sinks ---------------------------------------------------------------------------------------------------------


@query(f"WITH {RAW}, {DAYS} SELECT us, entity_key, round(x, 6) AS x, CAST(n AS DOUBLE) AS n FROM days")
def K3_wide_csv(spark, sf_dir):
    to = sinks.write_wide_csv(wide(spark, sf_dir), folder(spark))
    got = spark.read.csv(to, header=True, schema="timestamp timestamp, entity_key string, n double, x double")
    return got.select(us("timestamp"), "entity_key", r6("x").alias("x"), "n")


@query(f"WITH {RAW}, {DAYS} SELECT entity_key, round(x, 6) AS x, CAST(n AS DOUBLE) AS n FROM days")
def K4_learning_server(spark, sf_dir):
    """Every row in frames to a server, which keeps what it gets."""
    frames: list[dict] = []
    with served(lambda path, given, body: frames.append(json.loads(body)) or {}) as url:

        def send(text: str) -> None:
            from urllib.request import Request, urlopen

            headers = sinks.signed_headers("secret", "POST", "/learn", text, "0")
            urlopen(Request(f"{url}/learn", text.encode(), headers), timeout=30).read()

        sinks.stream_frames(wide(spark, sf_dir).select("entity_key", "x", "n"), send, 20)
    rows = [tuple(r) for f in frames for r in f["data"]]
    return spark.createDataFrame(rows, "entity_key string, x double, n double").select("entity_key", r6("x").alias("x"), "n")


@query(f"WITH {SPANS} SELECT trace_id, span_id, service, operation, us, dur FROM spans")
def K8_spans_csv(spark, sf_dir):
    (to,) = sinks.export(folder(spark), spans=spans(spark, sf_dir))
    got = spark.read.csv(to, header=True, escape='"')
    return got.select("trace_id", "span_id", F.col("service_name").alias("service"), F.col("operation_name").alias("operation"), F.col("start_time").cast("bigint").alias("us"), F.col("duration_us").cast("bigint").alias("dur"))


@query("SELECT event_id, epoch_us(ts) // 1000 * 1000 AS us, round(value, 6) AS value, event_type AS service FROM events")
def K9_metrics_csv(spark, sf_dir):
    e = raw.event_samples(spark, sf_dir)
    e = e.withColumn("labels", F.map_concat("labels", F.create_map(F.lit("event"), F.col("event_id").cast("string"))))
    (to,) = sinks.export(folder(spark), e.withColumn("timestamp", F.date_trunc("millisecond", "timestamp")))
    got = raw.read_csv(spark, to)
    return got.select(F.col("labels")["event"].cast("bigint").alias("event_id"), us("timestamp"), r6("value").alias("value"), F.col("labels")["service_name"].alias("service"))


@query(f"WITH {LOGS} SELECT service, severity, trace_id, count(*) AS n FROM logs GROUP BY ALL")
def K9_logs_csv(spark, sf_dir):
    (to,) = sinks.export(folder(spark), logs=logs(spark, sf_dir))
    got = spark.read.csv(to, header=True, escape='"')
    return got.groupBy("service", "severity", "trace_id").agg(F.count("*").alias("n"))


TRUTH = "epoch_us(TIMESTAMP '2024-02-01')"


@query(f"""WITH {RAW}, {DAYS}, t AS (SELECT unnest([0, 60, 120]) AS low, unnest([60, 120, 180]) AS high, unnest(['base', 'spike', 'base']) AS regimes)
SELECT entity_key AS labels_key, regimes, count(*) AS n, min({TRUTH} + i * 60000000) AS first_us FROM (SELECT DISTINCT entity_key FROM days), range(180) x(i), t WHERE i >= low AND i < high GROUP BY 1, 2, low""")
def K11_scenario_files(spark, sf_dir):
    """Generated samples and the scenario's truth as CSV, read again and joined."""
    at, truth = folder(spark), folder(spark)
    Y.series(_profiles(spark, sf_dir), 180, "2024-02-01", 60).orderBy("timestamp", "metric", "labels_key").write.csv(at, header=True)
    segments = Y.segments(spark, "2024-02-01", [(["base"], 60), (["spike"], 60), (["base"], 60)])
    segments.select("start_time", "end_time", F.array_join("regimes", ",").alias("regimes")).write.csv(truth, header=True)
    got = spark.read.csv(at, header=True, schema="timestamp timestamp, metric string, labels_key string, value double")
    known = spark.read.csv(truth, header=True, schema="start_time timestamp, end_time timestamp, regimes string")
    rows = Y.labelled(got, known.withColumn("regimes", F.struct("regimes", "start_time")))
    return rows.groupBy("labels_key", F.col("regimes.regimes").alias("regimes"), F.col("regimes.start_time").alias("start")).agg(F.count("*").alias("n"), us(F.min("timestamp")).alias("first_us")).drop("start")


# ---- frame and names -----------------------------------------------------------------------------------------------


@query("SELECT n_name, n_regionkey, n_nationkey FROM nation")
def P5_reorder(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    out = X.reorder_cols(n, ["n_name", "n_regionkey", "gone"])
    assert out.columns == ["n_name", "n_regionkey", "n_nationkey"]
    return out


@query("SELECT 'o_orderkey' AS name, count(*) AS n, 2 AS columns FROM orders UNION ALL SELECT 'o_clerk', count(*), 2 FROM orders")
def P6_introspection(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.lit("x").alias("o_clerk"))
    n, wide_by = X.shape(o)
    return spark.createDataFrame([(name, n, wide_by) for name in X.dtypes(o)], "name string, n bigint, columns int")


@query("SELECT o_orderkey, p FROM (SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS BIGINT) AS p FROM orders) WHERE p IN (0, 7, 40)")
def P7_rows_at(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    parts = [X.row_at(o, ["o_orderdate", "o_orderkey"], [p]).select("o_orderkey", F.lit(p).cast("bigint").alias("p")) for p in (0, 7, 40)]
    return X.concat_rows(parts)


@query("SELECT r_regionkey + 100 AS r_regionkey, r_name FROM region UNION ALL SELECT r_regionkey, r_name FROM region")
def P8_copies(spark, sf_dir):
    """A frame is immutable: what is made of it leaves it as it was."""
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return X.set_col(r, "r_regionkey", F.col("r_regionkey") + 100).unionByName(r)


@query("SELECT o_orderkey FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'")
def F1_mask(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    mask = X.holds(F.col("o_totalprice") > 100000) & X.eq("o_orderstatus", "F")
    return o.where(mask).select("o_orderkey")


@query("""SELECT c_custkey, CASE WHEN length(b) + 10 <= 128 THEN b ELSE substr(substr(b, 1, 118), 1, 118 - instr(reverse(substr(b, 1, 118)), '__') - 1) END || '__delta_5m' AS name
FROM (SELECT c_custkey, 'http__' || repeat('part' || c_custkey % 100 || '__', CAST(c_custkey % 23 + 1 AS INT)) || 'end' AS b FROM customer)""")
def C7_derived_names(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    base = F.concat(F.lit("http__"), F.repeat(F.concat(F.lit("part"), (F.col("c_custkey") % 100).cast("string"), F.lit("__")), (F.col("c_custkey") % 23 + 1).cast("int")), F.lit("end"))
    return c.select("c_custkey", N.derived(base, "delta_5m").alias("name"))


@query("""SELECT p_name AS family, a AS aggregation, p_name || '__' || a AS feature FROM (SELECT p_name, unnest(CASE p_size % 4 WHEN 0 THEN ['rate', 'count'] WHEN 1 THEN ['p50', 'p75', 'p90', 'p95', 'p99', 'mean', 'count', 'sum'] ELSE ['last', 'mean', 'min', 'max', 'stddev'] END) AS a FROM part)""")
def C9_names_of_types(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    kind = F.when(F.col("p_size") % 4 == 0, "counter").when(F.col("p_size") % 4 == 1, "histogram").when(F.col("p_size") % 4 == 2, "gauge").otherwise("odd")
    return N.metric_feature_names(p.select(F.col("p_name").alias("family"), kind.alias("type")))


@query("SELECT o_orderkey, '/shop/' || o_orderstatus || '/{order}/lines' AS route FROM orders")
def C27_V5_own_rules(spark, sf_dir):
    own = R.parameterizer([(r"/order_[0-9]+x", "/{order}")])
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", own(F.concat(F.lit("/shop/"), "o_orderstatus", F.lit("/order_"), F.col("o_orderkey").cast("string"), F.lit("x/lines"))).alias("route"))


@query("""SELECT n_nationkey AS k, round(CASE n_nationkey % 6 WHEN 0 THEN n_nationkey WHEN 1 THEN n_nationkey * 60 WHEN 2 THEN n_nationkey * 3600 WHEN 3 THEN n_nationkey / 1000 WHEN 4 THEN n_nationkey * 86400 ELSE 60 END, 6)::DOUBLE AS seconds FROM nation""")
def C35_steps(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    unit = F.element_at(F.array(*map(F.lit, ("", "m", " h ", "ms", "d", " fortnights"))), (F.col("n_nationkey") % 6 + 1).cast("int"))
    return n.select(F.col("n_nationkey").alias("k"), r6(V.step_seconds_of(F.concat(F.col("n_nationkey").cast("string"), unit))).alias("seconds"))


@query("SELECT event_id, round(value * 2 + 1, 6) AS made FROM events")
def C39_V1_series_function(spark, sf_dir):
    twice = X.apply_series(_twice, "double")
    return table(ship(spark), sf_dir, "events").select("event_id", r6(twice("value")).alias("made"))


def _twice(x: pd.Series) -> pd.Series:
    return x * 2 + 1


@query("""SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'localhost' ELSE 'host' || s_suppkey END AS host, CASE s_suppkey % 3 WHEN 1 THEN s_suppkey + 1000 ELSE 16686 END::INT AS port FROM supplier""")
def C47_addresses(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey").cast("string")
    url = F.when(F.col("s_suppkey") % 3 == 0, "").when(F.col("s_suppkey") % 3 == 1, F.concat(F.lit("HTTP://user:pw@Host"), k, F.lit(":"), (F.col("s_suppkey") + 1000).cast("string"), F.lit("/a:b/c"))).otherwise(F.concat(F.lit("//host"), k, F.lit("/api")))
    found = V.host_port(url)
    return s.select("s_suppkey", found["host"].alias("host"), found["port"].alias("port"))


@query("""WITH f AS (SELECT DISTINCT lower(replace(p_type, ' ', '_')) AS family FROM part), c AS (SELECT family FROM f ORDER BY family LIMIT 2) SELECT family || '_total' AS metric FROM c""")
def F14_V7_asked_families(spark, sf_dir):
    names = table(spark, sf_dir, "part").select(F.concat(F.lower(F.translate("p_type", " ", "_")), F.lit("_total")).alias("metric")).distinct()
    ask = lambda prompt: "Sure: " + json.dumps({"selected": prompt.split("\n")[1:3], "explanation": "the first"})
    return P.chosen_families(names, ask, max_families=2)[0]


@query(f"WITH {RAW} SELECT service, 'event_value' AS metric FROM raw GROUP BY 1 ORDER BY 1 LIMIT 3")
def O5_catalog_order(spark, sf_dir):
    return Q.metric_catalog(raw.event_samples(spark, sf_dir)).select("service", "metric").limit(3)


TYPES = "SELECT DISTINCT replace(p_type, ' ', '_') AS c, p_partkey % 2 = 0 AS even FROM part WHERE p_partkey <= 100"


@query(f"WITH t AS ({TYPES}), a AS (SELECT c FROM t WHERE even), b AS (SELECT c FROM t WHERE NOT even) SELECT c AS name, 'added' AS state FROM (FROM b EXCEPT FROM a) UNION ALL SELECT c, 'removed' FROM (FROM a EXCEPT FROM b)")
def U4_P11_registry_diff(spark, sf_dir):
    """Registered columns of two tables, compared; the registries are saved and read on the way."""
    rows = table(spark, sf_dir, "part").where("p_partkey <= 100").select(F.translate("p_type", " ", "_").alias("c"), (F.col("p_partkey") % 2 == 0).alias("even")).distinct().collect()
    a, b = D.Registry(), D.Registry()
    a.register(r.c for r in rows if r.even)
    b.register(r.c for r in rows if not r.even)
    with tempfile.TemporaryDirectory() as at:
        a.save(f"{at}/a.json")
        a = D.Registry.load(f"{at}/a.json")
    found = b.diff(a)
    assert set(found["removed"]) == set(a.missing(b.columns))
    return spark.createDataFrame([(c, s) for s in ("added", "removed") for c in found[s]], "name string, state string")


# ---- streams and state ---------------------------------------------------------------------------------------------

WINDOW = f"""{RAW}, d AS (SELECT (us // 86400000000) * 86400000000 AS us, 'instance=' || instance AS entity_key, avg(value) FILTER (status = '200') AS ok, avg(value) FILTER (status = '500') AS bad FROM raw GROUP BY 1, 2)"""


@query(f"""WITH {WINDOW}, p AS (SELECT entity_key, arg_max(coalesce(ok, 'nan'::DOUBLE), us) AS ok, arg_max(coalesce(bad, 'nan'::DOUBLE), us) AS bad FROM d WHERE us < epoch_us(TIMESTAMP '2024-01-10') GROUP BY 1)
SELECT us, entity_key, round(d.ok, 6) AS ok, round(d.ok - CASE WHEN NOT isnan(p.ok) THEN p.ok END, 6) AS ok_delta, round(d.bad - CASE WHEN NOT isnan(p.bad) THEN p.bad END, 6) AS bad_delta FROM d LEFT JOIN p USING (entity_key) WHERE us >= epoch_us(TIMESTAMP '2024-01-10')""")
def T2_T5_two_windows(spark, sf_dir):
    """Two windows, one after the other; the registry is saved after the first and read by the second's processor."""
    rows, cut = _flagship_rows(spark, sf_dir), F.lit("2024-01-10").cast("timestamp")
    with tempfile.TemporaryDirectory() as at:
        one = streams.Windows(registry_path=f"{at}/columns.json")
        one.process(rows.where(F.col("timestamp") < cut))
        two = streams.Windows(registry_path=f"{at}/columns.json")
        assert two.stats()["columns"] == one.stats()["columns"] > 0
    two.path, two.kept = None, one.kept
    out = two.process(rows.where(F.col("timestamp") >= cut))
    base = "event_value__mean__"
    return out.select(us("timestamp"), "entity_key", r6(base + "success").alias("ok"), r6(base + "success__delta_1w").alias("ok_delta"), r6(base + "server_error__delta_1w").alias("bad_delta"))


@query(f"WITH {WINDOW} SELECT us, entity_key, round(ok, 6) AS ok, round(bad, 6) AS bad FROM d")
def T4_V6_continuous(spark, sf_dir):
    """The samples as files of a stream; each batch's features go to a callback, which writes them."""
    at, out = folder(spark), folder(spark)
    _flagship_rows(spark, sf_dir).write.parquet(at)
    stream = spark.readStream.schema(spark.read.parquet(at).schema).parquet(at)
    base = "event_value__mean__"
    keep = lambda wide, number: wide.select(us("timestamp"), "entity_key", r6(base + "success").alias("ok"), r6(base + "server_error").alias("bad")).write.mode("append").parquet(out)
    run = streams.run_continuous(stream, keep, folder(spark))
    run.awaitTermination()
    return spark.read.parquet(out)


@query(f"WITH {WINDOW} SELECT us, entity_key, 'sml_event_value_mean_success' AS metric, round(ok, 6) AS value FROM d WHERE ok IS NOT NULL UNION ALL SELECT us, entity_key, 'sml_event_value_mean_server_error', round(bad, 6) FROM d WHERE bad IS NOT NULL")
def X4_collector(spark, sf_dir):
    """OTLP in, OTLP of the features out, read again."""
    rows = _flagship_rows(spark, sf_dir)
    nanos = F.concat(F.unix_micros("timestamp").cast("string"), F.lit("000"))
    pairs = F.transform(F.map_entries("labels"), lambda e: F.struct(e["key"].alias("key"), F.struct(e["value"].alias("stringValue")).alias("value")))
    gauge = F.struct(F.lit("event_value").alias("name"), F.struct(F.array(F.struct(nanos.alias("timeUnixNano"), F.col("value").alias("asDouble"), pairs.alias("attributes"))).alias("dataPoints")).alias("gauge"))
    payload = F.to_json(F.struct(F.array(F.struct(F.array(F.struct(F.array(gauge).alias("metrics"))).alias("scopeMetrics"))).alias("resourceMetrics")))
    out = payloads.otlp(streams.collect_metrics(rows.select(payload.alias("payload")), include_deltas=False))
    return out.select(us("timestamp"), F.col("labels")["entity_key"].alias("entity_key"), "metric", r6("value").alias("value"))


@query(f"""WITH {RAW}, h AS (SELECT us // 3600000000 AS h, instance, round(avg(value), 6) AS x FROM raw GROUP BY 1, 2),
d AS (SELECT (h // 24) * 86400000000 AS us, CAST(instance AS INT) + 1 AS k, instance, count(*) AS n, max(h) - min(h) AS hours, avg(x) AS mean, max(x) AS top FROM h GROUP BY ALL)
SELECT us, 'instance=' || instance AS entity_key, round(CASE WHEN n > 1 THEN k / 3600 ELSE 0 END, 6) AS c__rate, round(CASE WHEN n > 1 THEN k * hours ELSE 0 END, 6)::DOUBLE AS c__count,
 round(mean, 6) AS g__mean, round(top, 6) AS g__max, 100.0::DOUBLE AS h__p50, 100.0::DOUBLE AS h__p75, 10.0::DOUBLE AS h__mean, 6.0::DOUBLE * n AS h__count FROM d""")
def X1_all_types(spark, sf_dir):
    """One wide table of a counter, a gauge and a histogram a instance and day, from hourly samples."""
    e = raw.event_samples(spark, sf_dir)
    hour = V.floor_time("timestamp", 3600)
    h = e.groupBy(hour.alias("timestamp"), F.col("labels")["instance"].alias("instance")).agg(F.round(F.avg("value"), 6).alias("x"))
    at = F.floor(V.epoch_seconds("timestamp") / 3600).cast("double")
    sample = lambda metric, value, le=None: F.struct(F.lit(metric).alias("metric"), F.lit(le).cast("string").alias("le"), value.cast("double").alias("value"))
    samples = F.array(sample("c_total", at * (F.col("instance").cast("int") + 1)), sample("g", F.col("x")), *[sample("h_bucket", F.lit(n), le) for le, n in (("10", 1), ("100", 3), ("+Inf", 6))], sample("h_sum", F.lit(60)), sample("h_count", F.lit(6)))
    rows = h.select("timestamp", "instance", F.explode(samples).alias("s"))
    labels = F.map_filter(F.create_map(F.lit("instance"), F.col("instance"), F.lit("le"), F.col("s.le")), lambda _, v: v.isNotNull())
    wide = D.denormalize(rows.select("timestamp", "s.metric", labels.alias("labels"), "s.value"), window_seconds=86400, counters=("rate", "count"), gauges=("mean", "max"), counter_mode="windowed", include_deltas=False)
    return wide.select(us("timestamp"), "entity_key", *[r6(c).alias(c) for c in ("c__rate", "c__count", "g__mean", "g__max", "h__p50", "h__p75", "h__mean", "h__count")])


# ---- statistics and synthesis --------------------------------------------------------------------------------------


@query("""WITH s AS (SELECT event_type AS service, unnest([10.0, 100.0, 'inf'::DOUBLE]) AS le FROM events), c AS (SELECT service, le, count(*) AS n FROM s GROUP BY 1, 2) SELECT service, le, sum(n * CASE le WHEN 10 THEN 1 WHEN 100 THEN 3 ELSE 6 END)::DOUBLE AS n FROM c GROUP BY 1, 2""")
def A34_bucket_rises(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    cells = F.explode(F.array(*[F.struct(F.lit(le).alias("le"), F.lit(n).alias("n")) for le, n in ((10.0, 1.0), (100.0, 3.0), (float("inf"), 6.0))]))
    counts = e.select(F.col("event_type").alias("service"), cells.alias("c")).groupBy("service", "c.le").agg(F.sum("c.n").alias("total"))
    times = F.explode(F.array(*[F.struct(F.lit(d).cast("timestamp").alias("timestamp"), F.lit(f).alias("f")) for d, f in (("2024-01-01", 0.25), ("2024-01-02", 1.0), ("2024-01-03", 0.25))]))
    rows = counts.select("service", "le", "total", times.alias("t")).select("service", "le", "t.timestamp", (F.col("total") * F.col("t.f")).alias("value"))
    return T.bucket_rises(rows, ["service"]).select("service", "le", F.col("n").alias("n"))


@query(f"WITH {RAW}, {DAYS} SELECT count(*) AS series, round(sum(v), 6) AS spread FROM (SELECT entity_key, var_pop(x) AS v FROM (SELECT *, row_number() OVER (PARTITION BY entity_key ORDER BY us) AS i FROM days) WHERE i <= (SELECT min(c) FROM (SELECT count(*) AS c FROM days GROUP BY entity_key)) GROUP BY 1)")
def A35_total_spread(spark, sf_dir):
    """Shrinking a covariance keeps its trace: the sum of the series' variances."""
    d = days(spark, sf_dir).select(F.lit("events").alias("service"), F.col("entity_key").alias("series"), F.lit(False).alias("is_counter"), "timestamp", F.col("x").alias("value"))
    c = T.service_covariance(d)
    trace = F.aggregate(F.sequence(F.lit(0), F.size("series") - 1), F.lit(0.0), lambda t, i: t + F.get(F.get("covariance", i), i))
    return c.select(F.size("series").cast("bigint").alias("series"), r6(trace).alias("spread"))


@query("""WITH n AS (SELECT event_type AS value, count(*) AS n FROM events GROUP BY 1), t AS (SELECT count(*) AS all_of FROM events)
SELECT 'type' AS key, 'categorical' AS kind, value, round(n / all_of, 6) AS share FROM n, t UNION ALL SELECT 'amount', 'numeric', NULL, NULL UNION ALL SELECT 'same', 'constant', NULL, NULL""")
def A36_attribute_kinds(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    pairs = F.array(F.struct(F.lit("type").alias("key"), F.col("event_type").alias("value")), F.struct(F.lit("amount").alias("key"), F.col("value").cast("string").alias("value")), F.struct(F.lit("same").alias("key"), F.lit("x").alias("value")))
    kinds = Q.attribute_kinds(e.select(F.explode(pairs).alias("p")).select("p.*"))
    return kinds.select("key", "kind", F.explode_outer("values").alias("v")).select("key", "kind", "v.value", r6("v.share").alias("share"))


def _grid(n: int) -> str:
    return f"WITH {RAW}, {DAYS} SELECT DISTINCT entity_key AS series, {n}::BIGINT AS n, {TRUTH} AS first_us, {TRUTH} + {(n - 1) * 60000000} AS last_us FROM days"


def _grid_of(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy(F.col(name).alias("series")).agg(F.count("value").alias("n"), us(F.min("timestamp")).alias("first_us"), us(F.max("timestamp")).alias("last_us"))


@query(_grid(100))
def N2_N5_grid(spark, sf_dir):
    """What is generated at random has its profile's grid; values within the profile's bounds are counted."""
    p = _profiles(spark, sf_dir)
    rows = Y.series(p, 100, "2024-02-01", 60).join(p.select("labels_key", "min", "max"), "labels_key")
    return _grid_of(rows.where("value BETWEEN min - 1e-9 AND max + 1e-9"), "labels_key")


@query(_grid(50))
def N3_grid(spark, sf_dir):
    p = _profiles(spark, sf_dir).select(F.lit("events").alias("service"), F.col("labels_key").alias("series"), "mean", "std", "autocorr", "slope", "min", "max")
    d = days(spark, sf_dir).select(F.lit("events").alias("service"), F.col("entity_key").alias("series"), F.lit(False).alias("is_counter"), "timestamp", F.col("x").alias("value"))
    return _grid_of(Y.correlated_series(p, T.service_covariance(d), 50, "2024-02-01", 60), "series")


@query(f"SELECT DISTINCT event_type || '_req' AS family, 20::BIGINT AS steps, true AS cumulative, true AS rising FROM events")
def N4_cumulative(spark, sf_dir):
    """Generated buckets rise with their bound and with time, and the open one is the count."""
    p = table(spark, sf_dir, "events").select(F.concat("event_type", F.lit("_req")).alias("family"), F.lit(2.0).alias("mu"), F.lit(1.0).alias("sigma"), F.lit(25.0).alias("per_step")).distinct()
    rows = Y.histograms(p, BOUNDS, 20, "2024-02-01", 60).withColumn("family", N.metric_family("metric"))
    bound = F.when(F.col("le") == "+Inf", float("inf")).otherwise(F.col("le").try_cast("double"))
    cells = rows.groupBy("family", "timestamp").agg(F.array_sort(F.collect_list(F.when(F.col("metric").endswith("_bucket"), F.struct(bound.alias("le"), "value")))).alias("b"), F.max(F.when(F.col("metric").endswith("_count"), F.col("value"))).alias("n"))
    values = F.transform("b", lambda x: x["value"])
    good = (F.array_sort(values) == values) & (F.element_at(values, -1) == F.col("n"))
    cells = cells.select("family", "timestamp", good.alias("good"), "n")
    times = cells.groupBy("family").agg(F.count("*").alias("steps"), F.bool_and("good").alias("cumulative"), F.array_sort(F.collect_list(F.struct("timestamp", "n"))).alias("t"))
    counts = F.transform("t", lambda x: x["n"])
    return times.select("family", "steps", "cumulative", (F.array_sort(counts) == counts).alias("rising"))


@query("SELECT 60::BIGINT AS seconds, 3::BIGINT AS spans_a_trace, true AS inside, true AS again")
def N6_trace_shapes(spark, sf_dir):
    """Generated traces: all seconds, whole templates, children inside their parents, and the same again."""
    parts = F.array(*[F.struct(F.lit(p).alias("path"), F.lit(s).alias("service_name"), F.lit(o).alias("operation_name"), F.lit(m).alias("mean_us"), F.lit(m / 10).alias("std_us"), F.lit(0.1).alias("error_rate")) for p, s, o, m in (("0", "web", "GET /", 5000.0), ("0.0", "db", "SELECT", 2000.0), ("0.1", "cache", "get", 500.0))])
    made = lambda: Y.spans(spark.range(1).select(F.lit("t").alias("template"), F.lit(1.0).alias("weight"), parts.alias("spans")), "2024-02-01", 60, 12.0)
    s = checkpointed(made())
    end = lambda p: F.unix_micros(F.col(f"{p}.start_time")) + F.col(f"{p}.duration_us")
    both = s.alias("c").join(s.alias("p"), (F.col("c.parent_span_id") == F.col("p.span_id")) & (F.col("c.trace_id") == F.col("p.trace_id")))
    inside = both.agg(F.bool_and((F.col("c.start_time") >= F.col("p.start_time")) & (end("c") <= end("p") + 1)).alias("inside"))
    a_trace = s.groupBy("trace_id").agg(F.count("*").alias("n")).agg(F.min("n").alias("low"), F.max("n").alias("spans_a_trace")).where("low = spans_a_trace")
    seconds = s.agg(F.count_distinct(F.date_trunc("second", "start_time")).alias("seconds"))
    again = spark.range(1).select(F.lit(s.exceptAll(made()).isEmpty()).alias("again"))
    return seconds.join(F.broadcast(a_trace)).join(F.broadcast(inside)).join(F.broadcast(again)).select("seconds", "spans_a_trace", "inside", "again")


# ---- traces and logs -----------------------------------------------------------------------------------------------


@query(f"""WITH {SPANS}, c AS (SELECT trace_id, us, us + dur AS e, dur, lag(us) OVER w AS us0, lag(us + dur) OVER w AS e0, lag(dur) OVER w AS dur0 FROM spans WHERE parent IS NOT NULL WINDOW w AS (PARTITION BY trace_id ORDER BY us, span_id)),
p AS (SELECT o_orderpriority AS parent_service, 'order' AS parent_operation, greatest(0, least(e, e0) - greatest(us, us0)) / least(dur, dur0) AS share FROM c JOIN orders ON CAST(o_orderkey AS VARCHAR) = trace_id WHERE us0 IS NOT NULL)
SELECT parent_service, parent_operation, round(quantile_cont(share, 0.5), 6) AS overlap, CASE WHEN quantile_cont(share, 0.5) > 0.3 THEN 'parallel' ELSE 'sequential' END AS relation FROM p GROUP BY 1, 2""")
def W15_sibling_relation(spark, sf_dir):
    return J.sibling_relation(spans(spark, sf_dir)).select("parent_service", "parent_operation", r6("overlap").alias("overlap"), "relation")


CHILDREN = f"""{SPANS}, c AS (SELECT trace_id, service, operation, dur, CAST(row_number() OVER (PARTITION BY trace_id ORDER BY us, span_id) - 1 AS INT) AS i FROM spans WHERE parent IS NOT NULL)"""


@query(f"""WITH {CHILDREN}, k AS (SELECT trace_id, string_agg(service || ',' || operation, ';' ORDER BY i) AS shape, count(*) AS n FROM c GROUP BY 1), r AS (SELECT r.service, r.bad, coalesce(shape, '') AS shape FROM spans r LEFT JOIN k USING (trace_id) WHERE parent IS NULL AND coalesce(n, 0) <= 2)
SELECT count(*) AS traces, CASE WHEN bad THEN '0:' || service || ':order' ELSE '' END AS errors FROM r GROUP BY service, shape, bad""")
def L1_L3_kinds(spark, sf_dir):
    """How often each kind of trace with at most two children occurs; a kind is a signature and its error positions."""
    s = J.signatures(spans(spark, sf_dir)).where("spans <= 3")
    return s.groupBy("signature", "error_positions").agg(F.count("*").alias("traces")).select("traces", F.array_join("error_positions", ",").alias("errors"))


@query(f"WITH {SPANS} SELECT trace_id, count(*) AS spans, coalesce(max(CASE WHEN bad THEN '0:' || service || ':' || operation END), '') AS errors FROM spans GROUP BY 1")
def L2_error_positions(spark, sf_dir):
    return J.signatures(spans(spark, sf_dir)).select("trace_id", "spans", F.array_join("error_positions", ",").alias("errors"))


@query(f"""WITH {CHILDREN} SELECT '0.' || i AS path, service, operation, count(*) AS n, round(avg(dur), 4) AS mean_us, min(dur)::DOUBLE AS min_us FROM c GROUP BY 1, 2, 3 UNION ALL SELECT '0', service, operation, count(*), 1000000, 1000000 FROM spans WHERE parent IS NULL GROUP BY 2, 3""")
def L4_positions(spark, sf_dir):
    p = J.position_profile(spans(spark, sf_dir))
    return p.groupBy("path", F.col("service_name").alias("service"), F.col("operation_name").alias("operation")).agg(F.sum("n").alias("n"), F.round(F.sum(F.col("mean_us") * F.col("n")) / F.sum("n"), 4).alias("mean_us"), F.min("min_us").cast("double").alias("min_us"))


@query(f"""WITH {CHILDREN}, f AS (SELECT trace_id, i, service = first_value(service) OVER w AND operation = first_value(operation) OVER w AS same FROM c WINDOW w AS (PARTITION BY trace_id ORDER BY i)),
r AS (SELECT trace_id, count(*) AS n, coalesce(min(i) FILTER (NOT same), count(*)) AS run FROM f GROUP BY 1) SELECT trace_id, 1 AS size, run::INT AS times FROM r WHERE n > 2 AND run >= 3""")
def L5_repeated_children(spark, sf_dir):
    p = J.positions(spans(spark, sf_dir)).where("path = '0' AND group_size = 1 AND group_times >= 3")
    return p.select("trace_id", F.col("group_size").alias("size"), F.col("group_times").alias("times"))


@query(f"""WITH {LOGS} SELECT service, severity, 'user=<NUMBER> paid <AMOUNT> from <IP>' AS template, CASE WHEN count(o_orderkey) > 0 THEN 'order' ELSE '' END AS operation, count(*) AS n FROM logs LEFT JOIN orders ON CAST(o_orderkey AS VARCHAR) = trace_id GROUP BY 1, 2""")
def L7_log_profile(spark, sf_dir):
    return G.log_profile(logs(spark, sf_dir), spans(spark, sf_dir).where("parent_span_id IS NULL"))


@query("""SELECT prefix, families FROM (VALUES ('http_server', 'http_server_body_size_bytes,http_server_duration,http_server_requests'), ('go', 'go_config_gogc,go_memory_used_bytes'), ('redis', 'redis_uptime'), ('app_cart', 'app_cart_calls,app_cart_items,app_cart_latency_seconds'),
 ('kafka_consumer', 'kafka_consumer_other,kafka_consumer_records_lag'), ('plain', 'plain'), ('db_client', 'db_client_operation_duration')) t(prefix, families)""")
def F13_explain_salient(spark, sf_dir):
    return P.explain_salient(metric_names(spark)).select("prefix", F.array_join("families", ",").alias("families"))

