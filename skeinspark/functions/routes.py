"""Routes with placeholders."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import col

# What a placeholder stands for, in order.
RULES: tuple[tuple[str, str], ...] = (
    (r"[a-fA-F0-9]{8}-[a-fA-F0-9]{4}-[a-fA-F0-9]{4}-[a-fA-F0-9]{4}-[a-fA-F0-9]{12}", "{uuid}"),
    (r"(?<=/)[a-fA-F0-9]{16,}(?=/|$)", "{hex_id}"),
    (r"(?<=/)[a-fA-F0-9]{24}(?=/|$)", "{object_id}"),
    (r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}", "{email}"),
    (r"\d{4}-\d{2}-\d{2}", "{date}"),
    (r"(?<=/)\d{10,13}(?=/|$)", "{timestamp}"),
    (r"(?<=/)\d+(?=/|$)", "{id}"),
    (r"(?<=/)[a-zA-Z0-9_-]{20,}(?=/|$)", "{slug}"),
)
JOINED = (r"/\{([^}]+)\}/\{([^}]+)\}", "/{$1_$2}")
# Rules of whole segments for templates.
SEGMENTS = ((r"^\d+$", "{id}"), (r"^[a-fA-F0-9]{8,}$", "{hex_id}"), (r"^[a-zA-Z0-9_-]{20,}$", "{slug}"))


def parameterize_route(route: Column | str, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """Dynamic parts as placeholders; two neighbouring placeholders become one."""
    out = col(route)
    for pattern, name in rules:
        out = F.regexp_replace(out, pattern, name)
    return F.regexp_replace(out, *JOINED)


def route_template(route: Column | str) -> Column:
    """parameterize_route, then every segment that looks dynamic."""

    def segment(s: Column) -> Column:
        out = F.when((s == "") | (s.startswith("{") & s.endswith("}")), s)
        for pattern, name in SEGMENTS:
            out = out.when(F.rlike(s, F.lit(pattern)), name)
        return out.otherwise(s)

    return F.array_join(F.transform(F.split(parameterize_route(route), "/"), segment), "/")


def routes_by_template(df: DataFrame, route: str) -> DataFrame:
    """template, routes (distinct, in order) and how many rows have them."""
    return df.groupBy(route_template(route).alias("template")).agg(F.sort_array(F.collect_set(route)).alias("routes"), F.count("*").alias("n"))


def parameterizer(extra: Sequence[tuple[str, str]]) -> Callable[[Column | str], Column]:
    """parameterize_route with more rules after the standing ones."""
    rules = (*RULES, *extra)
    return lambda route: parameterize_route(route, rules)
