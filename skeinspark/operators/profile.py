"""Profiling of families, labels and cardinalities, and the schema that follows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import OTHER, TIERS, action, bucket_type, entity_key, is_entity_label, keeps, label_kind, service_name, tier
from ..functions.names import detected_type, metric_family, metric_type
from .aggregates import counter_rates
from .frame import numbered

TOP_N = 20
#: Shares in which a label's values are ranked.
SPREAD = 256


def metric_catalog(df: DataFrame, order: str = "timestamp") -> DataFrame:
    """service, metric, type, subtype of every distinct (service, metric), by the labels of its first row."""
    rows = df.select(service_name("labels").alias("service"), "metric", "labels", order)
    first = rows.groupBy("service", "metric").agg(F.min_by(F.to_json("labels"), F.struct(order, F.to_json("labels"))).alias("labels"))
    kind = detected_type("metric", F.from_json("labels", "map<string,string>"))
    return first.select("service", "metric", kind["type"].alias("type"), kind["subtype"].alias("subtype")).orderBy("service", "metric")


def label_values(df: DataFrame, label: str) -> DataFrame:
    return df.select(F.col("labels")[label].alias("value")).where("value IS NOT NULL").distinct().orderBy("value")


def services(df: DataFrame) -> DataFrame:
    return df.select(service_name("labels").alias("service")).distinct().orderBy("service")


def discover_families(df: DataFrame) -> DataFrame:
    """family, type, metrics: the first metric's type, histogram if any part of one is there; sum and count alone are a histogram's."""
    metrics = df.groupBy("metric").agg(F.count("*").alias("n"))
    kind = metric_type("metric")
    rows = metrics.select(metric_family("metric").alias("family"), "metric", F.when(kind == "histogram_component", "histogram").otherwise(kind).alias("kind"))
    is_histogram = F.max(F.col("kind") == "histogram")
    return rows.groupBy("family").agg(F.when(is_histogram, "histogram").otherwise(F.min_by("kind", "metric")).alias("type"), F.sort_array(F.collect_list("metric")).alias("metrics"))


def discover_labels(df: DataFrame) -> DataFrame:
    """family, label of all labels but le and quantile."""
    return df.select(metric_family("metric").alias("family"), F.explode(F.map_keys("labels")).alias("label")).distinct().where(~F.col("label").isin("le", "quantile"))


def value_counts(df: DataFrame, label: str) -> DataFrame:
    return df.select(F.col("labels")[label].alias("value")).where("value IS NOT NULL").groupBy("value").agg(F.count("*").alias("n"))


def label_counts(df: DataFrame) -> DataFrame:
    """family, label, value, n: rows are counted by series first, so that labels are exploded once a series."""
    series = df.groupBy("metric", F.map_from_entries(F.array_sort(F.map_entries("labels"))).alias("labels")).agg(F.count("*").alias("n"))
    return series.select(metric_family("metric").alias("family"), "n", F.explode("labels").alias("label", "value")).groupBy("family", "label", "value").agg(F.sum("n").alias("n"))


def cardinality(df: DataFrame, top: int = TOP_N, limits: dict[int, int] = TIERS) -> DataFrame:
    """family, label, cardinality, tier, action, top_values (most frequent first; only for top_n) of all labels."""
    counts = label_counts(df)
    # the best of each of SPREAD shares first, so that no task sorts all values of a label
    share = F.pmod(F.xxhash64("value"), F.lit(SPREAD))
    parts = counts.groupBy("family", "label", share.alias("share")).agg(F.count("*").alias("values"), F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "value"))), 1, top).alias("best"))
    found = parts.groupBy("family", "label").agg(F.sum("values").alias("cardinality"), F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, top).alias("best"))
    found = found.withColumn("tier", tier("cardinality", limits)).withColumn("action", action(F.col("tier")))
    return found.select("family", "label", "cardinality", "tier", "action", F.when(F.col("action") == "top_n", F.transform("best", lambda b: b["value"])).alias("top_values"))


def rates_by_label(df: DataFrame, label: str, top: int = TOP_N) -> DataFrame:
    """value, rate: a label's values by the summed rate of the counters that have them, the fastest first (of equals the first by name)."""
    rates = counter_rates(df.withColumn("value_of", F.col("labels")[label]).where("value_of IS NOT NULL"), ["metric", "labels_key", "value_of"])
    return rates.groupBy(F.col("value_of").alias("value")).agg(F.sum("rate_per_sec").alias("rate")).orderBy(F.desc("rate"), "value").limit(top)


def schema(families: DataFrame, found: DataFrame) -> DataFrame:
    """family, type, label, tier, cardinality, action, bucket_type, top_values, category: what happens to each label of each family."""
    kind = label_kind("label")
    bucket = bucket_type(F.col("kind"))
    rows = found.join(families.select("family", "type"), "family", "left").withColumn("kind", kind)
    decided = (
        F.when(~keeps(F.col("kind"), F.col("tier")), "drop")
        .when(bucket.isNotNull() & (F.col("tier") >= 2), "bucket")
        .when(F.col("tier") == 3, "top_n")
        .otherwise(action(F.col("tier")))
    )
    return rows.select("family", "type", "label", "tier", "cardinality", decided.alias("action"), bucket.alias("bucket_type"), F.when(decided == "top_n", F.col("top_values")).alias("top_values"), F.col("kind.category").alias("category"))


def profile(df: DataFrame, top: int = TOP_N, limits: dict[int, int] = TIERS) -> DataFrame:
    """The schema of samples (metric, labels); an empty table is an error."""
    if df.isEmpty():
        raise ValueError("an empty table has no profile")
    return schema(discover_families(df), cardinality(df, top, limits))


def dd_profile(df: DataFrame, **options) -> DataFrame:
    """profile, with families that come as dd_type count made counters."""
    counts = df.where("dd_type = 'count'").select(metric_family("metric").alias("family")).distinct().withColumn("is_count", F.lit(True))
    return profile(df, **options).join(counts, "family", "left").withColumn("type", F.when(F.col("is_count"), "counter").otherwise(F.col("type"))).drop("is_count")


def compare(left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Full outer comparison: keys, state (both, added, removed), the values of both sides and, of numbers, their difference."""
    a = left.select(*keys, *[F.col(v).alias(f"{v}_old") for v in values], F.lit(True).alias("__a"))
    b = right.select(*keys, *[F.col(v).alias(f"{v}_new") for v in values], F.lit(True).alias("__b"))
    state = F.when(F.col("__a") & F.col("__b"), "both").when(F.col("__b"), "added").otherwise("removed")
    numbers = {n for n, t in left.dtypes if t in ("int", "bigint", "double", "float")}
    deltas = [(F.col(f"{v}_new") - F.col(f"{v}_old")).alias(f"{v}_delta") for v in values if v in numbers]
    return a.join(b, list(keys), "full_outer").select(*keys, state.alias("state"), *[f"{v}_{s}" for v in values for s in ("old", "new")], *deltas)


def common_labels(found: DataFrame, share: float = 0.5) -> DataFrame:
    """Labels that at least int(share * families) families have."""
    total = found.agg(F.count_distinct("family").alias("all"))
    counts = found.groupBy("label").agg(F.count_distinct("family").alias("families"))
    return counts.join(F.broadcast(total)).where(F.col("families") >= F.floor(F.col("all") * share)).select("label", "families")


def unique_labels(found: DataFrame) -> DataFrame:
    return found.groupBy("label").agg(F.count_distinct("family").alias("n"), F.min("family").alias("family")).where("n = 1").select("family", "label")


def coverage(counts: DataFrame, share: float = 0.8, vip: Sequence[str] = ()) -> DataFrame:
    """value, n, covered: vip values, then the most frequent ones until they cover the share."""
    first = F.col("value").isin(*vip) if vip else F.lit(False)
    whole = counts.agg(F.sum("n").alias("total"))
    rows = numbered(counts, "upto", first.desc(), F.desc("n"), F.col("value").asc(), total="n").join(F.broadcast(whole))
    return rows.where(((F.col("upto") - F.col("n")) / F.col("total") < share) | first).select("value", "n", (F.col("upto") / F.col("total")).alias("covered"))


def entities(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """entity_key of every entity and how many samples it has."""
    return df.groupBy(entity_key("labels", list(names) if names else None).alias("entity_key")).agg(F.count("*").alias("n"))


def inferred_entity_labels(found: DataFrame, most: int = 10) -> DataFrame:
    """Entity labels with at most so many values, fewest first."""
    return found.where(is_entity_label("label")).groupBy("label").agg(F.max("cardinality").alias("cardinality")).where(F.col("cardinality") <= most).orderBy("cardinality", "label")


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """df with row_completeness: the share of columns that are set; 1 without columns."""
    have = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    return df.withColumn("row_completeness", have / len(columns) if columns else F.lit(1.0))


def column_completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, completeness."""
    one = df.agg(*[(F.count(c) / F.greatest(F.count("*"), F.lit(1))).alias(c) for c in columns])
    return one.unpivot([], list(columns), "column", "completeness")


UUID = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def attribute_kinds(df: DataFrame, key: str = "key", value: str = "value", top: int = 200) -> DataFrame:
    """key, kind (uuid, product_id, constant, numeric, categorical), values (of categories: the top ones with shares, the rest as __other__)."""
    v = F.col(value)
    counts = df.where(v.isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), value))
    rows = counts.withColumn("rank", rank)
    kind = (
        F.when(F.bool_and(F.rlike(v, F.lit(UUID))), "uuid")
        .when(F.bool_and(F.rlike(v, F.lit("^[A-Z0-9]{10}$"))), "product_id")
        .when(F.count("*") == 1, "constant")
        .when(F.bool_and(v.try_cast("double").isNotNull()), "numeric")
        .otherwise("categorical")
    )
    named = F.when(F.col("rank") <= top, v).otherwise(OTHER)
    kinds = rows.groupBy(key).agg(kind.alias("kind"), F.sum("n").alias("total"))
    shares = rows.groupBy(key, named.alias("name")).agg(F.sum("n").alias("n")).join(kinds, key).where("kind = 'categorical'")
    lists = shares.groupBy(key).agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "name", (F.col("n") / F.col("total")).alias("share")))).alias("x"))
    return kinds.join(lists, key, "left").select(key, "kind", F.transform("x", lambda e: F.struct(e["name"].alias("value"), e["share"].alias("share"))).alias("values"))


def top_values_of(counts: DataFrame, n: int) -> Column:
    """Literal array of the n most frequent values; n bounds what reaches the driver."""
    rows = counts.orderBy(F.desc("n"), "value").limit(n).collect()
    return F.array(*[F.lit(r.value) for r in rows]).cast("array<string>")
