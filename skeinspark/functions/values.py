"""Numbers, times and texts."""

from __future__ import annotations

import re
from urllib.parse import urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import col, present

UNITS = {"ms": 0.001, "s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}
# What placeholders of log templates stand for, in order.
LOG_RULES = (
    (r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", "<UUID>"),
    (r"(?i)\b[0-9a-f]{32}\b", "<TRACE_ID>"),
    (r"(?i)\b[0-9a-f]{16}\b", "<SPAN_ID>"),
    (r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b", "<IP>"),
    (r"\$?\d+\.\d{2}\b", "<AMOUNT>"),
    (r"\b[A-Z0-9]{10}\b", "<PRODUCT_ID>"),
    (r"(?<=[=:\s])\d+(?:\.\d+)?(?=[\s,;\]\})]|$)", "<NUMBER>"),
)


STEP = r"^(\d+(?:\.\d+)?)\s*(ms|s|m|h|d|w)?$"


def step_seconds(step: str | float, otherwise: float = 60) -> float:
    """Seconds of 60, "60s", "5m", "1h", "1d"."""
    if not isinstance(step, str):
        return float(step)
    found = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*(ms|s|m|h|d|w)?\s*", step)
    return float(found[1]) * UNITS[found[2] or "s"] if found else otherwise


def step_seconds_of(step: Column | str, otherwise: float = 60) -> Column:
    """step_seconds as a Column."""
    text = F.trim(col(step))
    number, unit = F.regexp_extract(text, STEP, 1), F.regexp_extract(text, STEP, 2)
    scale = F.lit(1.0)
    for name, seconds in UNITS.items():
        scale = F.when(unit == name, F.lit(float(seconds))).otherwise(scale)
    return F.when(F.rlike(text, F.lit(STEP)), number.try_cast("double") * scale).otherwise(F.lit(float(otherwise)))


def floor_time(ts: Column | str, seconds: float) -> Column:
    """The timestamp floored to a multiple of the step since the epoch; a zone-less timestamp stays one."""
    micros = int(seconds * 1_000_000)
    x = col(ts)
    return F.timestamp_micros(F.floor(F.unix_micros(x.cast("timestamp")) / micros).cast("bigint") * micros)


def epoch_seconds(ts: Column | str) -> Column:
    return F.unix_micros(col(ts).cast("timestamp")) / 1_000_000


def added(a, b) -> Column:
    return present(col(a) + col(b))


def divided(a, b) -> Column:
    """a / b; null where b is 0."""
    return present(F.try_divide(col(a), col(b)))


def finite(x: Column | str, instead: float | None = None) -> Column:
    """x with infinities replaced."""
    return F.when(col(x).isin(float("inf"), float("-inf")), F.lit(instead).cast("double")).otherwise(col(x))


def ratio(part, total) -> Column:
    """part / total, 0 where total is not positive."""
    return F.when(col(total) > 0, col(part) / col(total)).otherwise(F.lit(0.0))


def availability(errors, total) -> Column:
    return 1.0 - ratio(errors, total)


def throughput(total, seconds) -> Column:
    return ratio(total, seconds)


def budget_consumption(error_rate, budget) -> Column:
    """Error rate over budget; with no budget, infinite for any error and else 0."""
    return F.when(col(budget) > 0, col(error_rate) / col(budget)).when(col(error_rate) > 0, F.lit(float("inf"))).otherwise(0.0)


def change(new, old) -> Column:
    """struct(delta, pct): relative to abs(old); from 0 it is infinite, or null if both are 0."""
    n, o = col(new), col(old)
    pct = F.when(o != 0, (n - o) / F.abs(o) * 100).when((o == 0) & (n != 0), F.lit(float("inf")))
    return F.struct((n - o).alias("delta"), pct.alias("pct"))


def log_template(message: Column | str) -> Column:
    """The message with variable parts as placeholders."""
    out = col(message)
    for pattern, name in LOG_RULES:
        out = F.regexp_replace(out, pattern, name)
    return out


def template_fields(template: Column | str) -> Column:
    """Placeholders that a template has, in the rules' order."""
    return F.array_compact(F.array(*[F.when(col(template).contains(name), name) for _, name in LOG_RULES]))


def parse_tags_json(tags: Column | str) -> Column:
    """Tag map of a JSON text; anything else has no tags."""
    return F.coalesce(F.from_json(col(tags), "map<string,string>"), F.create_map().cast("map<string,string>"))


def is_error_span(status: Column | str, tags: Column | str) -> Column:
    """By the span's status, or by its tags error and otel.status_code."""
    bad = ("ERROR", "2", "STATUS_CODE_ERROR")
    flag = lambda x: F.coalesce(F.upper(F.trim(x)).isin(*bad), F.lit(False))
    return flag(col(status).cast("string")) | flag(col(tags)["otel.status_code"]) | F.coalesce(F.lower(col(tags)["error"]) == "true", F.lit(False))


def jaeger_port(url: str, otherwise: int = 16686) -> tuple[str, int]:
    """Host and port of an address with or without a scheme."""
    parts = urlsplit(url if "//" in url else f"//{url}")
    return parts.hostname or "localhost", parts.port or otherwise


def host_port(url: Column | str, otherwise: int = 16686) -> Column:
    """jaeger_port as a Column: struct(host, port)."""
    address = F.regexp_extract(F.regexp_replace(col(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://|^//", ""), r"^([^/?#]*)", 1)
    host = F.lower(F.regexp_extract(address, r"^(?:.*@)?([^:@]*)", 1))
    port = F.regexp_extract(address, r":(\d+)$", 1)
    return F.struct(F.when(host == "", "localhost").otherwise(host).alias("host"), F.when(port == "", F.lit(otherwise)).otherwise(port.try_cast("int")).alias("port"))
