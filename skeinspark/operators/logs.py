"""Logs (S19, S20, A27, A28, A30, J2, L7). Logs: timestamp, service, severity, message, trace_id, span_id."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import log_template, template_fields
from .traces import distinct_spans

# Severity numbers of the log protocol.
SEVERITY_NUMBERS = {"TRACE": 1, "DEBUG": 5, "INFO": 9, "WARN": 13, "WARNING": 13, "ERROR": 17, "FATAL": 21, "CRITICAL": 21}


def first_set(*names: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(n, F.lit("")) for n in names])


def fetch(logs: DataFrame, services: Sequence[str] = (), severities: Sequence[str] = (), start: Column | None = None, end: Column | None = None, limit: int | None = None) -> DataFrame:
    """Matching logs, the newest first."""
    if services:
        logs = logs.where(F.col("service").isin(*services))
    if severities:
        logs = logs.where(F.upper("severity").isin(*[s.upper() for s in severities]))
    if start is not None:
        logs = logs.where(F.col("timestamp") >= start)
    if end is not None:
        logs = logs.where(F.col("timestamp") <= end)
    return logs.orderBy(F.desc("timestamp"), "service", "message").limit(limit) if limit else logs


def query_condition(query: str, body: str = "message") -> Column:
    """Condition of a query: words and "phrases" in the body, field:value, AND, OR, NOT and parentheses; neighbours without a word between are OR."""
    words = re.findall(r'\(|\)|(?:\w+:)?"[^"]*"|[^\s()]+', query)
    at = 0

    def atom() -> Column:
        nonlocal at
        word = words[at]
        at += 1
        if word == "(":
            inside = either()
            at += 1
            return inside
        if word == "NOT":
            return ~atom()
        name, _, value = word.partition(":") if re.match(r"\w+:", word) else (body, "", word)
        value = value.strip('"')
        if name != body:
            return F.coalesce(F.lower(F.col(name)) == value.lower(), F.lit(False))
        pattern = r"(?i)(?<!\w)" + re.escape(value).replace(r"\*", r"\w*").replace(r"\?", r"\w") + r"(?!\w)"
        return F.coalesce(F.rlike(body, F.lit(pattern)), F.lit(False))

    def both() -> Column:
        nonlocal at
        out = atom()
        while at < len(words) and words[at] == "AND":
            at += 1
            out = out & atom()
        return out

    def either() -> Column:
        nonlocal at
        out = both()
        while at < len(words) and words[at] != ")":
            at += words[at] == "OR"
            out = out | both()
        return out

    return either() if words else F.lit(True)


def search(logs: DataFrame, query: str, limit: int | None = None) -> DataFrame:
    found = logs.where(query_condition(query))
    return found.orderBy(F.desc("timestamp"), "service", "message").limit(limit) if limit else found


def statistics(logs: DataFrame, services: int = 100, severities: int = 20) -> DataFrame:
    """service, severity, n of the services and severities with most logs."""
    counts = logs.groupBy("service", "severity").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("service"))
    ranked = counts.withColumn("all", total).withColumn("at", F.row_number().over(Window.partitionBy("service").orderBy(F.desc("n"), "severity")))
    top = ranked.withColumn("place", F.dense_rank().over(Window.orderBy(F.desc("all"), "service")))
    return top.where((F.col("place") <= services) & (F.col("at") <= severities)).select("service", "severity", "n")


def template_counts(logs: DataFrame, samples: int = 5) -> DataFrame:
    """service, severity, template, fields, n, samples (the first in order of text)."""
    rows = logs.select("service", "severity", "message", log_template("message").alias("template"))
    each = rows.groupBy("service", "severity", "template", "message").agg(F.count("*").alias("n"))
    ranked = each.withColumn("at", F.row_number().over(Window.partitionBy("service", "severity", "template").orderBy("message")))
    out = ranked.groupBy("service", "severity", "template").agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(F.when(F.col("at") <= samples, F.col("message")))).alias("samples"))
    return out.select("service", "severity", "template", template_fields("template").alias("fields"), "n", "samples")


def with_spans(logs: DataFrame, spans: DataFrame) -> DataFrame:
    """logs with span_service and span_operation of their span; without one, the log's service and an empty operation."""
    known = distinct_spans(spans).select("trace_id", "span_id", F.col("service_name").alias("of_service"), F.col("operation_name").alias("of_operation"))
    rows = logs.join(known, ["trace_id", "span_id"], "left")
    return rows.withColumn("span_service", F.coalesce("of_service", "service")).withColumn("span_operation", F.coalesce("of_operation", F.lit(""))).drop("of_service", "of_operation")


def emission_rates(logs: DataFrame, spans: DataFrame) -> DataFrame:
    """service, operation, template, logs, spans, rate: logs a span, 1 at most; 1 without a span."""
    rows = with_spans(logs, spans).withColumn("template", log_template("message"))
    counts = rows.groupBy(F.col("span_service").alias("service_name"), F.col("span_operation").alias("operation_name"), "template").agg(F.count("*").alias("logs"))
    per_span = distinct_spans(spans).groupBy("service_name", "operation_name").agg(F.count("*").alias("spans"))
    return counts.join(per_span, ["service_name", "operation_name"], "left").withColumn("rate", F.when(F.col("spans") > 0, F.least(F.lit(1.0), F.col("logs") / F.col("spans"))).otherwise(F.lit(1.0)))


def log_profile(logs: DataFrame, spans: DataFrame) -> DataFrame:
    """service, severity, template, n, operation (the most frequent span operation; of equals the first by name)."""
    rows = with_spans(logs, spans).withColumn("template", log_template("message"))
    each = rows.groupBy("service", "severity", "template", "span_operation").agg(F.count("*").alias("n"))
    return each.groupBy("service", "severity", "template").agg(F.min_by("span_operation", F.struct((F.col("span_operation") == "").alias("o"), (-F.col("n")).alias("m"), "span_operation")).alias("operation"), F.sum("n").alias("n"))
