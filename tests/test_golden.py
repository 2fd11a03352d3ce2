"""Golden cases of the data model: small inputs with known results."""

import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from skeinspark.functions import labels as L
from skeinspark.functions import names as N
from skeinspark.functions import operations as O
from skeinspark.functions import routes as R
from skeinspark.functions import status as S
from skeinspark.functions import values as V
from skeinspark.operators import aggregates as A
from skeinspark.operators import filters as P
from skeinspark.operators import frame as X
from skeinspark.operators import logs as G
from skeinspark.operators import profile as Q
from skeinspark.operators import stats as T
from skeinspark.operators import traces as J
from skeinspark.operators import windows as W
from skeinspark.plans import denormalize as D
from skeinspark.sources import payloads, raw, sinks
from skeinspark.streaming import features as streams

SAMPLE = "timestamp string, metric string, labels map<string,string>, value double"


def samples(spark, rows):
    return spark.createDataFrame(rows, SAMPLE).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def values(spark, fn, inputs, kind="string"):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r.y for r in rows.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


def test_status_buckets(spark):
    assert values(spark, lambda x: S.status_bucket(x, "http_status"), ["200", "404", "500"]) == ["success", "client_error", "server_error"]
    assert values(spark, lambda x: S.status_bucket(x, "grpc_status"), ["0", "13", "16", "99", "-1"]) == ["success", "server_error", "client_error", "unknown", "unknown"]
    assert values(spark, S.status_bucket, ["200", "0", "x error", None, "99"]) == ["success", "success", "server_error", None, "unknown"]


def test_methods_and_operations(spark):
    assert values(spark, O.http_method, ["GET", "POST", "DELETE", "HEAD", "CONNECT", "WEIRD", None]) == ["read", "write", "write", "read", "other", "unknown", "unknown"]
    assert values(spark, O.operation_bucket, ["SELECT * FROM users", "INSERT INTO orders", "GetUser", "CreateOrder", "StreamEvents", "", None]) == ["read", "write", "read", "write", "stream", "other", "other"]


def test_routes(spark):
    got = values(spark, R.parameterize_route, ["/api/users/550e8400-e29b-41d4-a716-446655440000/profile", "/api/orders/12345/items", "/api/reports/2024-01-15", "/api/health", "/a/1/2", "/x/1234567890", "/f/deadbeefdeadbeef12"])
    assert got == ["/api/users/{uuid}/profile", "/api/orders/{id}/items", "/api/reports/{date}", "/api/health", "/a/{id_id}", "/x/{timestamp}", "/f/{hex_id}"]
    assert values(spark, R.route_template, ["/k/deadbeef/x"]) == ["/k/{hex_id}/x"]
    assert values(spark, R.parameterizer([(r"v\d+", "{version}")]), ["/api/v2/x"]) == ["/api/{version}/x"]


def test_label_kinds(spark):
    names = ["service_name", "status_code", "http_method", "trace_id", "le"]
    assert values(spark, lambda x: L.label_kind(x)["category"], names) == ["resource", "signal", "dimension", "correlation", "internal"] == [L.classify_label(n).category for n in names]
    assert values(spark, L.is_entity_label, ["service_name", "instance", "trace_id", "http_method"]) == [True, True, False, False]


def test_entity_key_is_in_order_of_name(spark):
    rows = spark.createDataFrame([({"service_name": "checkout", "instance": "10.0.1.5"},), ({"x": "y"},), (None,)], "labels map<string,string>")
    assert [r[0] for r in rows.select(L.entity_key("labels")).collect()] == ["instance=10.0.1.5::service_name=checkout", "default", "default"]


def test_percentiles(spark):
    le = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10, float("inf")]
    n = [0, 0, 0, 2, 5, 15, 45, 80, 95, 99, 100, 100]
    b = F.array(*[F.struct(F.lit(float(x)).alias("le"), F.lit(float(c)).alias("n")) for x, c in zip(le, n)])
    got = spark.range(1).select(*[A.percentile(b, p).alias(str(p)) for p in (0.5, 0.9, 0.99)]).first()
    assert [round(x, 10) for x in got] == [0.5714285714, 2.0, 5.0]


def test_names(spark):
    assert values(spark, N.sanitize_name, ["Http.Server-Duration (ms)", "__a__b__"]) == ["http_server_durationms", "a_b"]
    assert values(spark, N.sanitize_label_value, ["/a/b:c", "!!"]) == ["a_b_c", "empty"]
    assert len(N.derived_name("a" * 200, "delta_5m")) == 128
    assert N.names_for_metric("m", "counter", {"s": ["ok", "bad"]}) == ["m__rate__s_ok", "m__rate__s_bad", "m__count__s_ok", "m__count__s_bad"]
    long = "x" * 60 + "__" + "y" * 60 + "__" + "z" * 60
    assert values(spark, N._capped, [long]) == ["x" * 60 + "__" + "y" * 60]


def test_arithmetic_nulls(spark):
    rows = spark.createDataFrame([(1.0, 4.0), (2.0, 0.0), (3.0, 6.0), (None, 7.0)], "a double, b double")
    got = rows.select((F.col("a") - F.col("b")).alias("s"), V.divided("a", "b").alias("q")).collect()
    assert [r.s for r in got] == [-3.0, 2.0, -3.0, None] and [r.q for r in got] == [0.25, None, 0.5, None]


def test_series_aggregates(spark):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate([1.0, 2.0, 3.0, float("nan"), 5.0])], "i int, x double")
    got = X.aggregate(rows, [], {"x": ["mean", "sum", "min", "max", "count", "first", "last"]}, "i").first()
    assert list(got) == [2.75, 11.0, 1.0, 5.0, 4.0, 1.0, 5.0]
    one = X.aggregate(rows.limit(1), [], {"x": "std"}).first()
    assert one[0] == 0.0


def test_rolling_and_shift(spark):
    rows = spark.createDataFrame([(i, float(i)) for i in range(1, 6)], "i int, x double")
    over = Window.orderBy("i")
    got = rows.select("i", X.rolling("x", 3, "mean", over, 1).alias("m"), X.rolling("x", 3, "std", over, 2).alias("s"), X.shift("x", 2, over).alias("b"), X.shift("x", -1, over).alias("f")).orderBy("i").collect()
    assert [r.m for r in got] == [1.0, 1.5, 2.0, 3.0, 4.0]
    assert got[0].s is None and round(got[1].s, 4) == 0.7071 and got[2].s == 1.0
    assert [r.b for r in got] == [None, None, 1.0, 2.0, 3.0] and [r.f for r in got] == [2.0, 3.0, 4.0, 5.0, None]


def test_pivot_and_melt(spark):
    rows = spark.createDataFrame([(t, f, v) for t, vs in ((1, (0.5, 0.8, 0.3)), (2, (0.6, 0.7, 0.4))) for f, v in zip(("cpu", "mem", "disk"), vs)], "t int, feature string, value double")
    wide = X.pivot(rows, ["t"], "feature", "value", X.features_of(rows, "feature"))
    assert [tuple(r) for r in wide.orderBy("t").collect()] == [(1, 0.5, 0.3, 0.8), (2, 0.6, 0.4, 0.7)]
    assert X.melt(wide, ["t"]).count() == 6


def test_sort_puts_nulls_last_and_first(spark):
    rows = spark.createDataFrame([("B", 2), ("A", 1), (None, 3), ("A", 0)], "a string, b int")
    assert [tuple(r) for r in X.sort_by(rows, "a", "b").collect()] == [("A", 0), ("A", 1), ("B", 2), (None, 3)]
    assert X.sort_by(rows, "a", descending=True).first().a is None


def test_counter_rules(spark):
    rows = samples(spark, [(f"2024-01-01 00:0{i}:00", m, {}, v) for m, vs in (("up", (1.0, 4.0)), ("reset", (9.0, 2.0)), ("one", (5.0,))) for i, v in enumerate(vs)])
    got = {r.metric: (r["rate_per_sec"], r["count"]) for r in A.counter_rates(rows, ["metric"]).collect()}
    assert got == {"up": (0.05, 3.0), "reset": (2 / 60, 2.0), "one": (0.0, 0.0)}


DENORMALIZE = [
    *[(f"2024-01-01 00:0{m}:00", "cpu", {"service_name": "web", "instance": "i-1"}, v) for m, v in ((0, 45.0), (1, 50.0))],
    *[(f"2024-01-01 00:0{m}:00", "mem", {"service_name": "web", "instance": "i-1"}, v) for m, v in ((0, 70.0), (1, 72.0))],
    *[(f"2024-01-01 00:0{m}:00", "http_requests_total", {"service_name": "web", "status_code": s}, v) for m, s, v in ((0, "200", 100.0), (1, "200", 150.0), (0, "500", 5.0), (1, "500", 6.0))],
    *[("2024-01-01 00:00:00", "dur_bucket", {"service_name": "web", "le": le}, v) for le, v in (("0.05", 5.0), ("0.075", 20.0), ("0.1", 50.0), ("0.5", 85.0), ("1.0", 95.0), ("+Inf", 100.0))],
    ("2024-01-01 00:00:00", "dur_sum", {"service_name": "web"}, 45.5),
    ("2024-01-01 00:00:00", "dur_count", {"service_name": "web"}, 100.0),
    ("2024-01-01 00:00:00", "plain_count", {"service_name": "web"}, 3.0),
]


def test_denormalize(spark):
    registry = D.Registry()
    wide = D.denormalize(samples(spark, DENORMALIZE), registry=registry, include_deltas=False, counters=("rate", "count"), gauges=("last", "mean", "min", "max", "stddev"))
    rows = {(r.timestamp.minute, r.entity_key): r for r in wide.collect()}
    assert set(rows) == {(m, e) for m in (0, 1) for e in ("service_name=web", "instance=i-1::service_name=web")}
    first = rows[0, "service_name=web"]
    assert first.dur__p50 == pytest.approx(0.1) and first.dur__p90 == pytest.approx(0.75) and first.dur__p99 == pytest.approx(1.0)
    assert first.dur__mean == pytest.approx(0.455) and first.dur__count == 100.0 and first.dur__sum == 45.5
    assert first.http_requests__count__success == first.http_requests__rate__server_error == 0.0
    assert first.http_requests__count__client_error is None
    assert rows[1, "instance=i-1::service_name=web"].mem__mean == 72.0 and rows[0, "instance=i-1::service_name=web"].cpu__stddev == 0.0
    assert not [c for c in wide.columns if c.startswith("plain")]  # counts without buckets emit nothing
    again = D.denormalize(samples(spark, DENORMALIZE[:1]), registry=registry, include_deltas=False)
    assert again.columns[: len(wide.columns)] == wide.columns and "cpu__mean" in again.columns


def test_denormalize_windowed_counters(spark):
    wide = D.denormalize(samples(spark, DENORMALIZE[4:8]), include_deltas=False, counter_mode="windowed", window_seconds=120)
    (r,) = wide.collect()
    assert r.http_requests__count__success == 50.0 and r.http_requests__count__server_error == 1.0


def test_denormalize_of_nothing(spark):
    assert D.denormalize(samples(spark, [])).count() == 0


def test_rules_in_both_forms(spark, monkeypatch):
    rows = samples(spark, [("2024-01-01", "m_total", {"path": p, "trace_id": "t", "otel_scope_name": "s", "status_code": "404", "zone": "z"}, 1.0) for p in ("/a/1", "/b")])
    rules = {("m", "path"): D.Rule("bucket", "route"), ("m", "zone"): D.Rule("drop"), ("other", "path"): D.Rule("drop")}
    show = lambda df: sorted((L.labels_json("labels"), r) for r in []) or sorted(tuple(r) for r in df.select(L.labels_json("labels"), "signal_key").collect())
    wanted = [('{"path":"/a/{id}","status_code":"client_error","trace_id":"t"}', "client_error"), ('{"path":"/b","status_code":"client_error","trace_id":"t"}', "client_error")]
    assert show(D.rewrite_labels(rows, rules)) == wanted
    monkeypatch.setattr(D, "MAX_RULES", 0)
    assert show(D.rewrite_labels(rows, rules)) == wanted
    top = {("m", "path"): D.Rule("top_n", None, ("/b",))}
    assert [json.loads(x[0])["path"] for x in show(D.rewrite_labels(rows, top))] == ["/b", "__other__"]


def test_profile_and_schema_round_trip(spark):
    rows = samples(spark, [("2024-01-01", "req_total", {"service_name": f"s{i % 2}", "status_code": str(200 + i), "user": f"u{i}"}, 1.0) for i in range(60)])
    schema = Q.profile(rows)
    got = {r.label: r for r in schema.collect()}
    assert got["service_name"].cardinality == 2 and got["service_name"].tier == 1
    assert got["status_code"].action == "bucket" and got["user"].action == "top_n" and len(got["user"].top_values) == 20
    config = raw.schema_config(schema)
    assert sorted(map(tuple, raw.schema_frame(spark, config).select("family", "label", "action").collect())) == sorted(map(tuple, schema.select("family", "label", "action").collect()))
    with pytest.raises(ValueError):
        Q.profile(rows.limit(0))


def test_label_filters(spark):
    rows = samples(spark, [("2024-01-01", "http_a", {"service_name": "web", "status_code": "200"}, 1.0), ("2024-01-01", "http_b", {"service_name": "web"}, 1.0), ("2024-01-01", "cpu", {"service_name": "api"}, 1.0), ("2024-01-01", "mem", {"service_name": "api"}, 1.0)])
    assert P.by_service(rows, ["web"]).count() == 2 and P.by_labels(rows, status_code="200").count() == 1
    assert P.without_labels(rows, service_name="api").count() == 2 and P.without_labels(rows, status_code="200").count() == 3
    assert P.by_metrics(rows, ["^http_"]).count() == 2 and P.by_metrics(rows, ["^http_"], exclude=True).count() == 2 and P.by_metrics(rows, []).count() == 0


def test_chosen_families(spark):
    names = spark.createDataFrame([(i, f"m{i}_total") for i in range(12)], "place int, metric string")
    assert P.chosen_families(names.limit(3), lambda _: "x", 10)[0].count() == 3
    kept, why = P.chosen_families(names, lambda _: 'Sure: {"selected": ["m1", "m2", "zz"], "explanation": "e"}', 10)
    assert kept.count() == 2 and why == "e"
    with pytest.raises(ValueError):
        P.chosen_families(names, lambda _: "no list", 10)


def test_log_queries_and_templates(spark):
    rows = spark.createDataFrame([(1, "Payment failed for order 12", "a"), (2, "payment ok", "b"), (3, "cart failed", "a")], "i int, message string, service string")
    find = lambda q: sorted(r.i for r in G.search(rows, q).collect())
    assert find("payment AND failed") == [1] and find("payment OR cart") == [1, 2, 3] and find('"payment ok" OR service:a') == [1, 2, 3] and find("failed AND NOT (service:a AND cart)") == [1] and find("pay*") == [1, 2]
    assert values(spark, V.log_template, ["id=550E8400-e29b-41d4-a716-446655440000 from 10.0.0.1 paid $12.50 for ABCDE12345 n=7"]) == ["id=<UUID> from <IP> paid <AMOUNT> for <PRODUCT_ID> n=<NUMBER>"]


SPAN = "trace_id string, span_id string, parent_span_id string, service_name string, operation_name string, start_us bigint, duration_us bigint, status_code string"


def test_traces(spark):
    rows = [("t", "r", None, "web", "GET", 0, 100, "OK")] + [("t", f"c{i}", "r", "db", "q", 10 + i, 20, "ERROR" if i == 1 else "OK") for i in range(4)] + [("u", "x", "gone", "web", "GET", 5, 10, "OK")]
    spans = spark.createDataFrame(rows, SPAN).withColumn("start_time", F.timestamp_micros("start_us")).withColumn("tags", F.create_map().cast("map<string,string>"))
    got = {r.trace_id: r for r in J.signatures(spans).collect()}
    assert got["t"].error_positions == ["0.1:db:q"] and got["t"].spans == 5 and got["u"].spans == 1
    assert J.folded([["a"], ["b"], ["a"], ["b"], ["c"]]) == [["REPEAT", [["a"], ["b"]], 2], ["c"]]
    assert J.repeating_group(["a"] * 4) == (1, 4) and J.repeating_group(["a", "b"]) == (0, 0)
    assert J.roll_up(spans).where("trace_id = 't'").first().total_duration_ms == pytest.approx(0.18)
    assert J.positions(spans).where("trace_id = 't'").count() == 5
    assert J.sibling_relation(spans).first().relation == "parallel"


def test_payload_edges(spark):
    bad = spark.createDataFrame([("not json",), ("{}",), ('{"series":[{"metric":"","points":[[1,2]]},{"metric":"a.b","points":[[1,null],[2,3.5]],"tags":["k:v"],"host":"h"}]}',)], "payload string")
    (r,) = payloads.dd_v1(bad).collect()
    assert (r.metric, r.value, r.labels, r.dd_type) == ("a_b", 3.5, {"k": "v", "instance": "h"}, "gauge")
    v2 = spark.createDataFrame([('{"series":[{"metric":"m","type":1,"points":[[1,2.0]]},{"metric":"n","type":3,"points":[{"timestamp":1,"value":2.0}]}]}',)], "payload string")
    assert sorted((r.metric, r.dd_type) for r in payloads.dd_intake(v2).collect()) == [("m_total", "count"), ("n", "gauge")]


def test_protobuf(spark):
    import struct

    field = lambda n, data: bytes([n << 3 | 2, len(data)]) + data
    point = bytes([1 << 3 | 1]) + struct.pack("<d", 2.5) + bytes([2 << 3, 100])
    series = field(1, field(1, b"host") + field(2, b"h1")) + field(2, b"a.count") + field(3, b"env:p") + field(4, point) + bytes([5 << 3, 1])
    rows = spark.createDataFrame([(bytearray(field(1, series)),), (bytearray(b"\xff\xff"),)], "body binary")
    (r,) = payloads.dd_v2_protobuf(rows).collect()
    assert (r.metric, r.value, r.labels) == ("a_count_total", 2.5, {"environment": "p", "instance": "h1"})


def test_compressed_bodies(spark):
    import gzip
    import zlib

    text = b'{"series":[]}'
    rows = spark.createDataFrame([(bytearray(gzip.compress(text)), "gzip"), (bytearray(zlib.compress(text)), "deflate"), (bytearray(text), "none"), (bytearray(b"x"), "gzip")], "body binary, encoding string")
    assert [r.payload for r in payloads.inflate(rows).collect()] == [text.decode()] * 3 + ["{}"]


def test_fetch_chunks_retries(spark):
    seen = payloads.fetch_chunks(payloads.chunks(spark, "2024-01-01 00:00:00", "2024-01-01 02:30:00", 60), lambda a, b: [f"{a:%H:%M}-{b:%H:%M}"])
    assert sorted(r.payload for r in seen.collect()) == ["00:00-01:00", "01:00-02:00", "02:00-02:30"]


def test_csv_and_records(spark, tmp_path):
    (tmp_path / "m.csv").write_text("timestamp,metric,labels,value\n2024-01-01 00:00:00,m,\"{'a': 'b'}\",1.5\n2024-01-01 00:00:00,m,\"{'a': \"\"it's\"\"}\",2\n2024-01-01 00:00:00,m,oops,x\n2024-01-01 00:00:00,m,oops,3\n")
    assert sorted((r.value, r.labels.get("a")) for r in raw.read_csv(spark, str(tmp_path / "m.csv")).collect()) == [(1.5, "b"), (2.0, "it's"), (3.0, None)]
    df = raw.from_records(spark, [{"a": 1, "b": "x"}, {"a": None, "c": True}])
    assert dict(df.dtypes) == {"a": "double", "b": "string", "c": "boolean"}


def test_sinks(spark, tmp_path):
    wide = D.denormalize(samples(spark, DENORMALIZE[:4]), include_deltas=False)
    a = sinks.write_wide_csv(wide, str(tmp_path))
    b = sinks.write_wide_csv(wide.withColumn("new", F.lit(1.0)), str(tmp_path))
    assert a != b and spark.read.csv(a, header=True).count() == 2
    assert sinks.signed_headers("k", "POST", "/p", "{}", "t") == sinks.signed_headers("k", "POST", "/p", "{}", "t")
    assert sinks.learning_frame(["a"], {"a": "S"}, [(1,), (None,)])["data"] == [["1"], [None]]
    sinks.export(str(tmp_path / "x"), metrics=samples(spark, DENORMALIZE))
    assert spark.read.csv(str(tmp_path / "x"), header=True).count() == len(DENORMALIZE)


def test_registry_file(tmp_path):
    registry = D.Registry()
    assert registry.register(["b", "a"]) == ["a", "b"] and registry.register(["c", "a"]) == ["c"]
    registry.save(str(tmp_path / "r.json"))
    assert D.Registry.load(str(tmp_path / "r.json")).columns == ["a", "b", "c"]
    assert registry.diff(D.Registry(columns=["a", "z"])) == {"added": ["b", "c"], "removed": ["z"]}


def test_windows_processor(spark, tmp_path):
    first = samples(spark, [("2024-01-01 00:00:00", "cpu", {"service_name": "a"}, 1.0)])
    second = samples(spark, [("2024-01-01 00:01:00", "cpu", {"service_name": "a"}, 4.0), ("2024-01-01 00:01:00", "mem", {"service_name": "b"}, 2.0)])
    run = streams.Windows(registry_path=str(tmp_path / "r.json"))
    assert "cpu__mean__delta_1w" not in run.process(first).columns
    got = {r.entity_key: r for r in run.process(second).collect()}
    assert got["service_name=a"]["cpu__mean__delta_1w"] == 3.0 and got["service_name=b"]["mem__mean__delta_1w"] is None
    assert run.stats() == {"windows": 2, "columns": 2}


def test_stream_of_windows(spark, tmp_path):
    samples(spark, [(f"2024-01-01 00:00:{s:02d}", "cpu", {"service_name": "a"}, float(s)) for s in range(10)]).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).parquet(str(tmp_path / "in"))
    seen = []
    streams.run_continuous(stream, lambda df, n: seen.append(df.count()), str(tmp_path / "cp")).awaitTermination()
    assert seen == [10]
    query = streams.long_stream(stream, names=["service_name"]).writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("windows").first()["count"] == 10


def test_statistics(spark):
    import numpy as np

    mu, sigma = T.fit_lognormal(np.array([1.0, 2.0, 4.0, 8.0, np.inf]), np.array([16, 50, 84, 97.7, 100.0]))
    assert abs(mu - np.log(2)) < 0.05 and abs(sigma - np.log(2)) < 0.1
    x = np.random.default_rng(0).standard_normal((50, 3))
    shrunk, plain = T.shrunk_covariance(x), np.cov(x.T, bias=True)
    assert abs(shrunk[0, 1]) <= abs(plain[0, 1]) and np.trace(shrunk) == pytest.approx(np.trace(plain))


def test_resample(spark):
    times = ["00:00:05", "00:00:30", "00:01:10", "00:02:00"]
    rows = samples(spark, [(f"2024-01-01 {t}", "m", {"a": "b"}, float(i)) for i, t in enumerate(times)])
    got = W.resample(W.with_series(rows), 60).orderBy("timestamp").collect()
    assert [r.value for r in got] == [1.0, 2.0, 3.0]
    assert W.scrape_interval(W.with_series(rows)).first().seconds in (25.0, 40.0, 50.0)


def test_scrape_interval_in_microseconds(spark):
    # a tenth of a second three times, which are three different differences of doubles; a quarter twice, which are one
    times = ["00:00:01.000000", "00:00:01.100000", "00:07:05.300000", "00:07:05.400000", "01:11:02.700000", "01:11:02.800000", "02:00:00.250000", "02:00:00.500000", "02:00:00.750000"]
    rows = samples(spark, [(f"2024-01-01 {t}", "m", {"a": "b"}, 1.0) for t in times])
    assert W.scrape_interval(W.with_series(rows)).first().seconds == 0.1
    assert W.scrape_interval(W.with_series(rows.limit(0))).first().seconds is None


def test_prometheus_source(spark):
    import json as j
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer
    from urllib.parse import parse_qs, urlsplit

    from skeinspark.session import ship
    from skeinspark.sources.http import PrometheusSource

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            q = parse_qs(urlsplit(self.path).query)
            data = ["m"] if "label" in self.path else {"result": [{"metric": {"__name__": "m", "a": "b"}, "values": [[float(q["start"][0]), "1.5"], [float(q["start"][0]) + 60, "NaN"]]}]}
            self.send_response(200)
            self.end_headers()
            self.wfile.write(j.dumps({"status": "success", "data": data}).encode())

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    ship(spark).dataSource.register(PrometheusSource)
    df = spark.read.format("prometheus").option("url", f"http://127.0.0.1:{server.server_port}").option("start", "0").option("end", "7200").load()
    rows = df.collect()
    server.shutdown()
    assert len(rows) == 4 and {r.value for r in rows} == {1.5, None} and rows[0].labels == {"a": "b"}
