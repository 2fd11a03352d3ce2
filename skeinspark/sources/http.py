"""A Prometheus server as a Spark data source (S1-S11): one partition for each metric and time chunk.

    spark.dataSource.register(PrometheusSource)
    spark.read.format("prometheus").option("url", ...).option("metrics", "a,b").option("start", 0).option("end", 3600).load()
"""

from __future__ import annotations

import json
from urllib.parse import urlencode
from urllib.request import urlopen

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.values import step_seconds

TIMEOUT = 30


def request(url: str, endpoint: str, params: dict | None = None) -> dict:
    """GET of an API endpoint; anything but success is an error."""
    with urlopen(f"{url.rstrip('/')}/api/v1/{endpoint}" + (f"?{urlencode(params, doseq=True)}" if params else ""), timeout=TIMEOUT) as answer:
        found = json.load(answer)
    if found.get("status") != "success":
        raise OSError(f"{endpoint}: {found.get('error', 'failed')}")
    return found


def metric_names(url: str) -> list[str]:
    return request(url, "label/__name__/values")["data"]


class Chunk(InputPartition):
    def __init__(self, metric: str, start: float, end: float):
        self.metric, self.start, self.end = metric, start, end


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.url, self.step = options["url"], step_seconds(options.get("step", "60s"))
        self.metrics = [m for m in options.get("metrics", "").split(",") if m]
        self.start, self.end = float(options["start"]), float(options["end"])
        self.width = float(options.get("chunk_seconds", 3600))

    def partitions(self):
        out = []
        for metric in self.metrics or metric_names(self.url):
            at = self.start
            while at < self.end:
                out.append(Chunk(metric, at, min(self.end, at + self.width)))
                at += self.width
        return out

    def read(self, part):
        from datetime import datetime, timezone

        found = request(self.url, "query_range", {"query": part.metric, "start": part.start, "end": part.end - (part.end < self.end) * 1e-3, "step": self.step})
        for series in found["data"]["result"]:
            labels = {k: v for k, v in series["metric"].items() if k != "__name__"}
            for t, v in series["values"]:
                value = float(v)
                yield datetime.fromtimestamp(float(t), timezone.utc), part.metric, labels, None if value != value else value


class PrometheusSource(DataSource):
    @classmethod
    def name(cls):
        return "prometheus"

    def schema(self):
        return "timestamp timestamp, metric string, labels map<string,string>, value double"

    def reader(self, schema):
        return _Reader(self.options)
