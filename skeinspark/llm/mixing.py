"""Mixing sources to target weights by entropy balancing.

Targets: sources in code point order (null last) weigh 5, 2, 1, repeating, and share all words; no target
is over ``cap`` times its source, and what that frees is shared again by weight until none is above.

Rates: of all rates between 0 and ``cap`` whose words meet the target, those nearest to 1 a document in
relative entropy are ``min(cap, exp(multiplier * size / mean size))``.  The source's multiplier solves the
convex dual; all sources take their Newton steps together, each step one pre-aggregated sum over the
histogram of (source, size), kept inside a bracket that halves whenever a step would leave it.

Copies: rows that repeat one another (source, doc_id and text) are one group, and copies are given to groups.  A rate's
whole part is taken; the fraction is rounded systematically along a hash order of groups in buckets of bounded size, so a
source's error is about one document; then groups of falling size change by some copies if that brings the source
nearer.  A group's copies are dealt to its rows as evenly as they go.

All sums are of integers, which do not depend on the order of addition, so reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.frame import numbered
from .runtime import bounded, cut, marked, ready

WEIGHTS = (5, 2, 1)
CAP = 3
#: Documents of a rounding bucket, rounds of Newton steps, size classes' candidates for the last correction.
BUCKET, ROUNDS, CHOICES = 4096, 60, 8
MILLI, MICRO = 1000, 1_000_000
#: Bounds of a multiplier, and the share of the target that rates may miss before rounding.
WIDEST, CLOSE = 64.0, 1e-3


def exact(x: Column, unit: int) -> Column:
    """x in whole units of 1 / unit: sums of integers are the same in any order."""
    return F.round(x * unit).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """sizes (source, source_size), a row a source -> with target.  Sources are ranked by ranges, so any number of them will do."""
    ranked = numbered(sizes, "__place", F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("__place") % len(weights) + 1).cast("int"))
    rows = cut(ranked.select("source", "source_size", weight.cast("double").alias("weight")))
    total, open_weight = rows.agg(F.sum("source_size"), F.sum(F.when(F.col("source_size") > 0, F.col("weight")))).first()
    level, free = 0.0, float(total or 0)
    capped = -1
    while open_weight:
        # words for one unit of weight among the sources not yet at their cap
        level = free / open_weight
        above = F.col("weight") * level >= cap * F.col("source_size")
        n, taken, open_weight = rows.where("source_size > 0").agg(F.count(F.when(above, 1)), F.sum(F.when(above, cap * F.col("source_size"))), F.sum(F.when(~above, F.col("weight")))).first()
        if n == capped:
            break
        capped, free = n, float(total - (taken or 0))
    return rows.select("source", "source_size", F.least(F.col("weight") * level, (cap * F.col("source_size")).cast("double")).alias("target"))


def multipliers(histogram: DataFrame, goals: DataFrame, cap: int = CAP) -> DataFrame:
    """(source, mean, m): the dual's solution for each source; histogram has (source, size, n), goals (source, source_size, target, n_docs).

    The first multiplier is that of the rate at the source's mean over words; a source whose target is its cap needs no steps.
    """
    spread = histogram.groupBy("source").agg(F.sum(F.col("size").cast("double") * F.col("size") * F.col("n")).alias("squares")).withColumnRenamed("source", "of")
    state = goals.where("source_size > 0").join(spread, F.col("source").eqNullSafe(F.col("of")))
    mean = F.col("source_size") / F.greatest(F.col("n_docs"), F.lit(1))
    at_cap = F.col("target") >= (1 - 1e-9) * cap * F.col("source_size")
    guess = F.ln(F.col("target") / F.col("source_size")) * mean * F.col("source_size") / F.col("squares")
    first = F.when(at_cap, F.lit(WIDEST)).otherwise(F.round(F.greatest(F.lit(-WIDEST), F.least(F.lit(WIDEST), guess)), 9))
    state = cut(state.select("source", "target", "source_size", mean.alias("mean"), first.alias("m"), F.lit(-WIDEST).alias("low"), F.lit(WIDEST).alias("high"), at_cap.alias("done")))
    for _ in range(ROUNDS):
        s = state.where("NOT done").withColumnRenamed("source", "of")
        x = F.col("size") / F.col("mean")
        rate = F.least(F.lit(float(cap)), F.exp(F.least(F.col("m") * x, F.lit(50.0))))
        rows = histogram.join(s, F.col("source").eqNullSafe(F.col("of"))).where("size > 0")
        sums = rows.groupBy("source").agg(
            (F.sum(exact(rate * F.col("size") * F.col("n"), MILLI)) / MILLI).alias("words"),
            F.sum(F.when(F.col("m") * x < math.log(cap), exact(rate * F.col("size") * F.col("n") * x, 1))).cast("double").alias("slope"),
        ).withColumnRenamed("source", "of")
        joined = state.join(sums, F.col("source").eqNullSafe(F.col("of")), "left")
        gap = F.col("words") - F.col("target")
        low, high = F.when(gap < 0, F.col("m")).otherwise(F.col("low")), F.when(gap > 0, F.col("m")).otherwise(F.col("high"))
        newton = F.col("m") - gap / F.when(F.col("slope") > 0, F.col("slope"))
        inside = (newton > low) & (newton < high)
        step = F.round(F.when(F.coalesce(inside, F.lit(False)), newton).otherwise((low + high) / 2), 12)
        over = F.col("done") | (F.abs(gap) <= CLOSE * F.col("target") + 0.5) | (high - low < 1e-9)
        state = cut(joined.select("source", "target", "source_size", "mean", F.when(over, F.col("m")).otherwise(step).alias("m"), F.when(over, F.col("low")).otherwise(low).alias("low"), F.when(over, F.col("high")).otherwise(high).alias("high"), F.coalesce(over, F.lit(True)).alias("done")))
        if not state.where("NOT done").limit(1).count():
            break
    return state.select("source", "mean", "m")


def copies_of(groups: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """groups (source, place, doc_id, size, n rows) with source_size, target, rate and total, the copies of all its rows together."""
    histogram = cut(groups.groupBy("source", "size").agg(F.sum("n").alias("n")))
    sources = cut(histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs")))
    goals = targets(sources.select("source", "source_size"), weights, cap)
    goals = cut(goals.join(sources.select(F.col("source").alias("of"), "n_docs"), F.col("source").eqNullSafe(F.col("of"))).drop("of"))
    found = multipliers(histogram, goals, cap)
    per_source = cut(goals.join(found.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left").select(F.col("source").alias("of"), "source_size", "target", "n_docs", "mean", "m"))

    # a multiplier at its bound is a source at its cap
    rate = F.when(F.col("size") == 0, 1.0).when(F.col("m") >= WIDEST, float(cap)).otherwise(F.least(F.lit(float(cap)), F.exp(F.least(F.col("m") * F.col("size") / F.col("mean"), F.lit(50.0)))))
    rated = groups.join(per_source, F.col("source").eqNullSafe(F.col("of"))).withColumn("rate", F.round(rate, 8))
    # systematic rounding: the running sum of fractional copies passes whole numbers now and then
    bucket = F.pmod(F.xxhash64("place"), F.ceil(F.col("n_docs") / BUCKET))
    part = rated.withColumn("bucket", bucket).withColumn("fraction", F.col("n") * exact(F.col("rate") - F.floor("rate"), MICRO))
    klass = F.when(F.col("size") == 0, -1).otherwise(F.floor(F.log2(F.col("size"))))
    running = F.sum("fraction").over(Window.partitionBy("source", "bucket").orderBy(klass, "size", "place", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    offset = F.pmod(F.xxhash64("source", "bucket"), F.lit(MICRO))
    part = part.withColumn("upto", running + offset)
    up = F.floor(F.col("upto") / MICRO) - F.floor((F.col("upto") - F.col("fraction")) / MICRO)
    rounded = cut(part.select("source", "place", "doc_id", "size", "n", "source_size", "target", "rate", (F.col("n") * F.floor("rate") + up).cast("bigint").alias("total")))

    # last correction: a few groups of each size class, those with the smallest hash, may change
    words = rounded.groupBy("source").agg(F.sum(F.col("size") * F.col("total")).alias("words"), F.max("target").alias("goal"))
    choice = rounded.where("size > 0").groupBy("source", F.floor(F.log2("size")).alias("klass"), F.pmod("place", F.lit(CHOICES)).alias("k")).agg(F.min(F.struct("place", "doc_id", "size", "n", "total")).alias("c"))
    choice = choice.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("c.size", "c.place", "c.doc_id", "c.n", "c.total")), asc=False).alias("choices"))  # at most CHOICES a class
    start = F.struct((F.col("goal") - F.col("words")).alias("gap"), F.array().cast("array<struct<place: bigint, doc_id: bigint, change: bigint>>").alias("changes"))

    def step(a, c):
        near = F.round(a["gap"] / c["size"]).cast("bigint")
        change = F.greatest(-c["total"], F.least(cap * c["n"] - c["total"], near))
        done = F.struct((a["gap"] - change * c["size"]).cast("double").alias("gap"), F.concat(a["changes"], F.array(F.struct(c["place"].alias("place"), c["doc_id"].alias("doc_id"), change.alias("change")))).alias("changes"))
        return F.when(change != 0, done).otherwise(a)

    changes = choice.withColumnRenamed("source", "of").join(words, F.col("of").eqNullSafe(F.col("source"))).select("source", F.explode(F.aggregate("choices", start, step, lambda a: a["changes"])).alias("x")).select(F.col("source").alias("of"), F.col("x.place").alias("of_place"), F.col("x.doc_id").alias("of_doc"), "x.change")
    out = rounded.join(changes, F.col("source").eqNullSafe(F.col("of")) & (F.col("place") == F.col("of_place")) & F.col("doc_id").eqNullSafe(F.col("of_doc")), "left")
    return out.select("source", "place", "doc_id", "size", "n", "source_size", "target", "rate", (F.col("total") + F.coalesce("change", F.lit(0))).alias("total"))


def dealt(rows: DataFrame) -> DataFrame:
    """rows with copies: of a group's ``total``, each of its ``n`` rows gets as many as any other, or one more.

    Rows of a group are numbered by partition, then inside each, so no task gets a group whole.
    """
    keys = ["source", "place", "doc_id"]
    odd = rows.withColumn("__part", F.spark_partition_id())
    odd = cut(odd.withColumn("__at", F.row_number().over(Window.partitionBy(*keys, "__part").orderBy(F.lit(0)))))
    held = odd.groupBy(*keys, "__part").agg(F.count("*").alias("held"))
    before = held.withColumn("before", F.sum("held").over(Window.partitionBy(*keys).orderBy("__part")) - F.col("held"))
    before = before.select(*(F.col(k).alias(f"in_{k}") for k in keys), F.col("__part").alias("in_part"), "before")
    same = F.col("__part") == F.col("in_part")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"in_{k}"))
    more = F.col("before") + F.col("__at") <= F.col("total") % F.col("n")
    return odd.join(before, same).withColumn("copies", (F.floor(F.col("total") / F.col("n")) + more.cast("int")).cast("bigint")).select(*rows.columns, "copies")


ADDED = ("size", "source_size", "target", "rate", "copies", "taken")


def mix(docs: DataFrame, source: str = "source", weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, whole: bool = False) -> DataFrame:
    """doc_id, source, mark (text hash), size, source_size, target, rate, copies, taken of every row.

    size counts the words of the text (null: 0).  Documents without words have rate 1, one copy and take nothing.  Rows that
    repeat one another get as many copies, up to one.  No copy count is over ``cap``.  Other columns are ignored; an empty
    table gives no rows.  With ``whole``: the rows with all columns of docs, besides those whose names clash with ADDED, and ADDED.
    """
    ready(docs.sparkSession)
    rows, at = marked(docs)
    rows = rows.withColumn("source", (F.lit(None) if at(source) is None else F.col(at(source))).cast("string"))
    own = [(n, f"c{i}") for i, n in enumerate(docs.columns) if n.lower() not in ADDED] if whole else []
    size = F.coalesce(F.regexp_count("__text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")
    rows = rows.select(F.col("__doc").alias("doc_id"), "source", F.col("__mark").alias("mark"), size.alias("size"), F.xxhash64("__doc", "__mark").alias("place"), *(c for _, c in own))
    if not whole:
        rows = cut(rows)
    groups = cut(rows.groupBy("source", "place", "doc_id", "size").agg(F.count("*").alias("n")))
    found = copies_of(groups, weights, cap).select(F.col("source").alias("of"), F.col("place").alias("of_place"), F.col("doc_id").alias("of_doc"), "n", "source_size", "target", "rate", "total")
    same = (F.col("place") == F.col("of_place")) & F.col("doc_id").eqNullSafe(F.col("of_doc")) & F.col("source").eqNullSafe(F.col("of"))
    found = cut(found)
    uneven = (F.col("n") > 1) & (F.col("total") % F.col("n") != 0)
    out = rows.join(found.where(~uneven), same).withColumn("copies", (F.col("total") / F.col("n")).cast("bigint"))
    if not (some := found.where(uneven)).isEmpty():  # only where rows repeat one another
        out = out.unionByName(dealt(rows.join(bounded(some), same)))
    out = out.withColumn("taken", F.col("copies") * F.col("size"))
    if whole:
        return out.select(*(c for _, c in own), *ADDED).toDF(*(n for n, _ in own), *ADDED)
    return out.select("doc_id", "source", "mark", *ADDED)
