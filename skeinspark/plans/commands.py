"""What the commands do (X3, G4): discover, profile and run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import profile as Q
from ..operators.filters import families
from ..sources.raw import load_config, schema_config, schema_frame
from .denormalize import denormalize


def discover(samples: DataFrame) -> DataFrame:
    """service, metrics (sorted) and their number; the list of a service's metrics is a catalog, not samples."""
    found = Q.metric_catalog(samples)
    return found.groupBy("service").agg(F.sort_array(F.collect_set("metric")).alias("metrics"), F.count("*").alias("n")).orderBy("service")


def profile_table(samples: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """The label schema of the wanted families."""
    found = families(Q.discover_families(samples), include, exclude)
    rows = samples.withColumn("family", Q.metric_family("metric")).join(found.select("family"), "family", "left_semi").drop("family")
    return Q.schema(found, Q.cardinality(rows))


def profile(samples: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> dict:
    """profile_table as a config that run takes."""
    return schema_config(profile_table(samples, include, exclude))


def run(samples: DataFrame, schema: str | None = None, **options) -> DataFrame:
    """The feature table, by the label schema of a config file if there is one."""
    config = load_config(schema) if schema else None
    return denormalize(samples, schema_frame(samples.sparkSession, config) if config else None, **options)
