"""Samples from files and records (S29-S32), and the driver's events as samples."""

from __future__ import annotations

import ast
import json
from collections.abc import Sequence
from pathlib import Path
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship

SAMPLES = "timestamp timestamp, metric string, labels map<string,string>, value double"


def parse_label_repr(text: Column | str) -> Column:
    """Label map of a dict's repr; text that is none gives no labels. Quotes are turned for JSON; what has quotes inside goes through Python."""
    c = F.col(text) if isinstance(text, str) else text
    simple = F.from_json(F.translate(c, "'", '"'), "map<string,string>")
    hard = F.rlike(c, F.lit("\"|\\\\"))
    ship(SparkSession.active())
    return F.coalesce(F.when(hard, F.pandas_udf(_literal, "map<string,string>")(c)).otherwise(simple), F.create_map().cast("map<string,string>"))


def _literal(texts: pd.Series) -> pd.Series:
    def one(t):
        try:
            found = ast.literal_eval(t)
        except (ValueError, SyntaxError, TypeError):
            return {}
        return {str(k): str(v) for k, v in found.items() if v is not None} if isinstance(found, dict) else {}

    return texts.map(one)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Samples of CSV files with timestamp, metric, labels (repr) and value; values that are no numbers are left out, NaN too."""
    rows = spark.read.csv(path, header=True, escape='"', multiLine=False)
    if missing := {"timestamp", "metric", "labels", "value"} - set(rows.columns):
        raise ValueError(f"missing columns: {sorted(missing)}")
    value = F.col("value").try_cast("double")
    out = rows.select(F.try_to_timestamp("timestamp").alias("timestamp"), "metric", parse_label_repr("labels").alias("labels"), F.nanvl(value, F.lit(None).cast("double")).alias("value"))
    return out.where("value IS NOT NULL")


def from_records(spark: SparkSession, records: Sequence[dict[str, Any]], schema: str | None = None) -> DataFrame:
    """A frame of dicts; missing keys are null; without a schema, types follow each column's first value, double if there is none."""
    names = list(dict.fromkeys(k for r in records for k in r))
    if schema is None:
        kinds = {bool: "boolean", int: "double", float: "double", str: "string", dict: "map<string,string>", pd.Timestamp: "timestamp"}
        first = {n: next((r[n] for r in records if r.get(n) is not None), None) for n in names}
        schema = ", ".join(f"`{n}` {next((t for k, t in kinds.items() if type(first[n]) is k), 'timestamp' if hasattr(first[n], 'isoformat') else 'double')}" for n in names)
    numbers = {n for n in names if f"`{n}` double" in schema}
    rows = [tuple(float(r[n]) if n in numbers and r.get(n) is not None else r.get(n) for n in names) for r in records]
    return spark.createDataFrame(rows, schema)


def wide_labels(df: DataFrame, ts: str = "timestamp", metric: str = "metric", value: str = "value") -> DataFrame:
    """Samples of a table with a column a label; nulls are no labels."""
    names = [c for c in df.columns if c not in (ts, metric, value)]
    every = F.create_map(*[x for c in names for x in (F.lit(c), F.col(c).cast("string"))]) if names else F.create_map()
    labels = F.map_filter(every.cast("map<string,string>"), lambda _, v: v.isNotNull())
    return df.select(F.col(ts).cast("timestamp").alias("timestamp"), F.col(metric).alias("metric"), labels.alias("labels"), F.col(value).cast("double").alias("value"))


def load_config(path: str) -> dict | None:
    """A JSON or (where the library is there) YAML file on the driver; none if it does not exist."""
    if not Path(path).exists():
        return None
    text = Path(path).read_text()
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("YAML files need a YAML library; save the schema as JSON") from e
    return yaml.safe_load(text)


def schema_frame(spark: SparkSession, config: dict) -> DataFrame:
    """The table of a label schema: metrics{family: {type, labels{label: rule}}}."""
    rows = [
        (family, m.get("type"), label, r.get("tier"), r.get("cardinality"), r.get("action", "keep"), r.get("bucket_type"), r.get("top_values"), r.get("semantic_category"))
        for family, m in config.get("metrics", {}).items()
        for label, r in m.get("labels", {}).items()
    ]
    return spark.createDataFrame(rows, "family string, type string, label string, tier int, cardinality bigint, action string, bucket_type string, top_values array<string>, category string")


def schema_config(schema: DataFrame, hours: float = 1.0) -> dict:
    """The config of a schema table."""
    out: dict = {"profiling_window_hours": hours, "cardinality_thresholds": {"tier1_max": 10, "tier2_max": 50, "tier3_max": 200}, "metrics": {}}
    for r in schema.orderBy("family", "label").collect():
        labels = out["metrics"].setdefault(r.family, {"type": r.type, "labels": {}})["labels"]
        labels[r.label] = {"tier": r.tier, "cardinality": r.cardinality, "action": r.action, "bucket_type": r.bucket_type, "top_values": r.top_values, "semantic_category": r.category}
    return out


def scrape_interval(config: str, otherwise: int = 60) -> int:
    """Seconds of scrape_interval in a configuration text."""
    import re

    found = re.search(r"scrape_interval:\s*[\"']?(\d+)(s|m)", config or "")
    return int(found[1]) * (60 if found[2] == "m" else 1) if found else otherwise


def scrape_interval_of(config: Column, otherwise: int = 60) -> Column:
    """scrape_interval as a Column."""
    pattern = r"scrape_interval:\s*[\"']?(\d+)(s|m)"
    number = F.regexp_extract(config, pattern, 1).try_cast("int")
    return F.coalesce(number * F.when(F.regexp_extract(config, pattern, 2) == "m", 60).otherwise(1), F.lit(otherwise))


def event_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as samples of the gauge event_value, with event_id as a unique order."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    labels = F.create_map(F.lit("instance"), (F.col("user_id") % 10).cast("string"), F.lit("service_name"), F.col("event_type"), F.lit("status_code"), F.when(F.col("event_type") == "error", "500").otherwise("200"))
    return e.select(F.col("ts").cast("timestamp").alias("timestamp"), F.lit("event_value").alias("metric"), labels.alias("labels"), "value", "event_id", "user_id")
