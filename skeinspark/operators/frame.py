"""Frame primitives: columns, predicates, aggregates, windows, order, reshape and sets (P, F1-F3, A1-A6, W1-W4, O, U, R)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.base import col, present
from ..session import checkpointed, shipped

# ---- columns -------------------------------------------------------------------------------------------------------


def select_cols(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns that exist."""
    return df.select([c for c in names if c in df.columns])


def set_col(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df.withColumn(name, value)


def rename_col(df: DataFrame, old: str, new: str) -> DataFrame:
    """Renamed; a column that does not exist is an error."""
    if old not in df.columns:
        raise KeyError(old)
    return df.withColumnRenamed(old, new)


def reorder_cols(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns first, the others after them."""
    first = [c for c in names if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])


def shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)


def dtypes(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


def row_at(df: DataFrame, order: Sequence[str], places: Sequence[int]) -> DataFrame:
    """Rows at positions (from 0) of the given order; only rows up to the last position are numbered."""
    df = df.orderBy(*order).limit(max(places, default=-1) + 1)
    numbered = df.withColumn("__at", F.row_number().over(Window.orderBy(*order)) - 1)
    return numbered.where(F.col("__at").isin(*places)).drop("__at")


def align_columns(df: DataFrame, expected: Sequence[str], fill: float | None = None) -> DataFrame:
    """Expected columns first, missing ones filled; further columns after them."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(fill).cast("double").alias(c) for c in expected], *[c for c in df.columns if c not in set(expected)])


# ---- predicates ----------------------------------------------------------------------------------------------------


def holds(condition: Column) -> Column:
    """The condition, false where it is null."""
    return F.coalesce(condition, F.lit(False))


def eq(x, value) -> Column:
    return holds(col(x) == F.lit(value))


def starts_with(x, prefix: str) -> Column:
    return holds(col(x).startswith(prefix))


def ends_with(x, suffix: str) -> Column:
    return holds(col(x).endswith(suffix))


def contains(x, part: str) -> Column:
    return holds(col(x).contains(part))


def is_null(x, number: bool = True) -> Column:
    """Null, or NaN in a number."""
    return present(x).isNull() if number else col(x).isNull()


# ---- aggregates ----------------------------------------------------------------------------------------------------

AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "mean": F.avg,
    "sum": lambda x: F.coalesce(F.sum(x), F.lit(0.0)),
    "min": F.min,
    "max": F.max,
    "std": lambda x: F.when(F.count(x) > 0, F.coalesce(F.stddev_samp(x), F.lit(0.0))),
    "count": lambda x: F.count(x).cast("double"),
    "nunique": lambda x: F.count_distinct(x).cast("double"),
}


def aggregate(df: DataFrame, keys: Sequence[str], wanted: dict[str, str | Sequence[str]], order: str | None = None) -> DataFrame:
    """Named aggregates a group: {column: name or names} gives column__name. first and last are those of the order column."""
    out = []
    for name, kinds in wanted.items():
        x = present(name) if dict(df.dtypes)[name] in ("double", "float") else F.col(name)
        for kind in [kinds] if isinstance(kinds, str) else kinds:
            if kind in ("first", "last"):
                at = F.when(x.isNotNull(), F.col(order))
                made = (F.min_by if kind == "first" else F.max_by)(x, at)
            else:
                made = AGGREGATES[kind](x)
            out.append(made.alias(f"{name}__{kind}"))
    return df.groupBy(*keys).agg(*out)


# ---- windows -------------------------------------------------------------------------------------------------------


def shift(x, n: int, over: WindowSpec) -> Column:
    """Rows back (positive) or ahead (negative)."""
    return F.lag(col(x), n).over(over) if n >= 0 else F.lead(col(x), -n).over(over)


def rolling(x, size: int, kind: str, over: WindowSpec, min_periods: int = 0) -> Column:
    """mean, std, sum, min or max of the last ``size`` rows; null below min_periods non-null values (0: all)."""
    rows = over.rowsBetween(-(size - 1), 0)
    value = present(x)
    made = {"mean": F.avg, "std": F.stddev_samp, "sum": F.sum, "min": F.min, "max": F.max}[kind](value).over(rows)
    return F.when(F.count(value).over(rows) >= (min_periods if min_periods > 0 else size), made)


def transform(df: DataFrame, keys: Sequence[str], name: str, fn: Callable[[Column, WindowSpec], Column], out: str) -> DataFrame:
    """A column made per group by a window expression."""
    return df.withColumn(out, fn(F.col(name), Window.partitionBy(*keys)))


# ---- order ---------------------------------------------------------------------------------------------------------


def sort_by(df: DataFrame, *names: str, descending: bool = False) -> DataFrame:
    """Ascending with nulls last, or descending with nulls first."""
    return df.orderBy(*[F.col(c).desc_nulls_first() if descending else F.col(c).asc_nulls_last() for c in names])


def numbered(df: DataFrame, out: str, *order: Column, total: str | None = None) -> DataFrame:
    """df with each row's place (from 0) in an order, or with the sum of ``total`` up to each row.

    Rows are dealt by ranges, each range is numbered by itself and begins where those before it end, so no task gets all rows.
    """
    parts = checkpointed(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    one = F.col(total) if total else F.lit(1).cast("bigint")
    own = F.sum(one).over(Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    sizes = parts.groupBy(F.col("__part").alias("__of")).agg(F.sum(one).alias("__size"))  # a row a range
    before = sizes.select("__of", (F.sum("__size").over(Window.orderBy("__of")) - F.col("__size")).alias("__before"))
    rows = parts.withColumn("__own", own).join(F.broadcast(before), F.col("__part") == F.col("__of"))
    return rows.select(*df.columns, (F.col("__before") + F.col("__own") - (0 if total else 1)).alias(out))


def argsort(df: DataFrame, name: str, tie: str, out: str = "rank") -> DataFrame:
    """Place (from 0) of each row in the order of a column, nulls last."""
    return numbered(df, out, F.col(name).asc_nulls_last(), F.col(tie).asc())


def head(df: DataFrame, n: int, *order: str) -> DataFrame:
    return sort_by(df, *order).limit(n)


def tail(df: DataFrame, n: int, *order: str) -> DataFrame:
    return sort_by(df, *order, descending=True).limit(n)


def top_n(df: DataFrame, keys: Sequence[str], n: int, *order: Column) -> DataFrame:
    """The first n rows of each group."""
    return df.withColumn("__at", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__at") <= n).drop("__at")


# ---- sets and reshape ----------------------------------------------------------------------------------------------


def concat_rows(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows; columns are united by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def concat_columns(left: DataFrame, right: DataFrame, order: str) -> DataFrame:
    """Columns side by side, rows paired by their place in the order column; right's columns win."""
    number = lambda df: numbered(df, "__at", F.col(order).asc())
    kept = [c for c in left.columns if c not in right.columns]
    return number(left).select(*kept, "__at").join(number(right), "__at").drop("__at")


def distinct_first(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The first row of each key."""
    return top_n(df, keys, 1, *map(F.col, order))


def pivot(df: DataFrame, index: Sequence[str], names: str, value: str, features: Sequence[str], how: str = "first", order: str | None = None) -> DataFrame:
    """Long to wide over a given list of features; null values make no row. first and last follow the order column."""
    v = present(value)
    made = {"mean": F.avg(v), "sum": F.sum(v), "min": F.min(v), "max": F.max(v), "count": F.count(v).cast("double")}
    if how in made:
        agg = made[how]
    elif order:
        agg = (F.max_by if how == "last" else F.min_by)(v, F.col(order))
    else:
        agg = F.first(v, ignorenulls=True)
    return df.where(v.isNotNull()).groupBy(*index).pivot(names, list(features)).agg(agg)


#: Columns that a wide table may have; beyond them the long form is the one to use.
MAX_FEATURES = 50_000


def few(df: DataFrame, most: int, what: str) -> list:
    """The rows of df on the driver; more than ``most`` are an error."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} {what}")
    return rows


def features_of(df: DataFrame, names: str, extra: Iterable[str] = ()) -> list[str]:
    """Sorted feature names, those in the data and others; one small job. They are columns of the result: more than MAX_FEATURES are an error."""
    return sorted({r[0] for r in few(df.select(names).distinct(), MAX_FEATURES, "features: use the long form")} | set(extra))


def melt(df: DataFrame, ids: Sequence[str], names: str = "feature", value: str = "value") -> DataFrame:
    """Wide to long; nulls stay."""
    others = [c for c in df.columns if c not in ids]
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in others]).unpivot(list(ids), others, names, value)


def fill_null(df: DataFrame, value: float, *names: str) -> DataFrame:
    return df.withColumns({c: F.coalesce(present(c), F.lit(value)) for c in names})


# ---- functions of the caller ---------------------------------------------------------------------------------------


def apply_series(fn: Callable, kind: str) -> Callable[..., Column]:
    """A vectorised function of Series as a Column function; prefer built-in expressions where there are any."""
    return F.pandas_udf(fn, kind)


def apply_rows(df: DataFrame, fn: Callable[[dict], object], name: str, kind: str) -> DataFrame:
    """df with a column that a function makes of each row as a dict, in Arrow batches; its type is declared."""
    return shipped(df).withColumn(name, F.udf(lambda r: fn(r.asDict()), kind, useArrow=True)(F.struct(*df.columns)))


def apply_groups(df: DataFrame, keys: Sequence[str], fn: Callable, schema: str) -> DataFrame:
    """What a function makes of each group as a pandas frame; a group is in one task's memory."""
    return shipped(df).groupBy(*keys).applyInPandas(fn, schema)


def wide_from_features(index: DataFrame, features: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """index with a column for each feature table (keys, value): left joins, missing values null."""
    out = index
    for name, rows in features.items():
        out = out.join(rows.select(*keys, F.col("value").alias(name)), list(keys), "left")
    return out
