"""Session helpers that the operators share: scratch space, lineage cuts, column selection, bounded broadcasts."""

from __future__ import annotations

import contextlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import BROADCAST_ROWS, bounded, checkpoints, ship

#: Rows of an Arrow batch; documents are long, so fewer than Spark's default.
ARROW_ROWS, DEFAULT_ROWS = 512, "10000"


def ready(spark: SparkSession) -> SparkSession:
    """Point checkpoints at the cluster's shared folder and, unless the session sets it, size Arrow batches for long texts."""
    checkpoints(spark)
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == DEFAULT_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))
    return spark


def scratch(spark: SparkSession) -> str:
    """The folder for tables that a job writes for itself."""
    return ready(spark).sparkContext._jsc.sc().getCheckpointDir().get()


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder that a job has written for itself, in whatever store it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """Compute df once and cut its lineage with a checkpoint in the shared folder, which survives lost executors."""
    ready(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Select columns by their exact names, whatever other columns (even equal up to case) the table has; key = new name, value = type.

    A column that the table lacks becomes null.
    """
    plain, at = numbered(df)
    chosen = [(F.lit(None) if at(name) is None else F.col(at(name))).cast(kind).alias(name) for name, kind in columns.items()]
    return plain.select(*chosen)


def numbered(df: DataFrame) -> tuple[DataFrame, Callable[[str], str | None]]:
    """df with its columns named c0, c1, ..., and the new name of a column: the one of exactly that name, or equal to it up to case, or None."""
    names = df.columns

    def at(name: str) -> str | None:
        exact = next((i for i, n in enumerate(names) if n == name), None)
        if exact is None:
            exact = next((i for i, n in enumerate(names) if n.lower() == name.lower()), None)
        return None if exact is None else f"c{exact}"

    return df.toDF(*[f"c{i}" for i in range(len(names))]), at


def marked(df: DataFrame) -> tuple[DataFrame, Callable[[str], str | None]]:
    """numbered(df) with __doc, __text and __mark besides: doc_id, text and the text's hash, as ``documents`` and ``mark`` have them."""
    plain, at = numbered(df)
    value = lambda name, kind: (F.lit(None) if at(name) is None else F.col(at(name))).cast(kind)
    plain = plain.withColumns({"__doc": value("doc_id", "bigint"), "__text": value("text", "string")})
    return plain.withColumn("__mark", F.xxhash64("__text")), at


def only(df: DataFrame, keep: Callable[[], Callable[[pa.Array], list[bool]]]) -> DataFrame:
    """The rows of df, all columns as they were, whose texts pass; keep() makes the test of a batch's texts in each task.  A missing text column is all null."""
    plain, at = numbered(df)
    place = -1 if at("text") is None else int(at("text")[1:])

    def run(batches):
        test = keep()
        for batch in batches:
            column = batch.column(place) if place >= 0 else pa.nulls(batch.num_rows, pa.string())
            yield batch.filter(pa.array(test(column), pa.bool_()))

    return plain.mapInArrow(lean(run), plain.schema).toDF(*df.columns)


def documents(df: DataFrame, **more: str) -> DataFrame:
    return pick(df, doc_id="bigint", text="string", **more)


def held_out() -> Column:
    """True for the quarter of documents from which nothing is learned; a null doc_id is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def trim() -> None:
    """Give the memory that a Python process has freed back to the machine; a reused worker, or the driver, would keep it."""
    import ctypes
    import gc

    gc.collect(0)
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def lean(run):
    """run(batches) for mapInArrow, such that its worker keeps no memory between tasks."""

    def wrapped(batches):
        pa.set_memory_pool(pa.system_memory_pool())
        try:
            yield from run(batches)
        finally:
            trim()

    return wrapped


def let(value: Column, body) -> Column:
    """body(value) with value computed once; plain references would be inlined and computed again at each use."""
    return F.transform(F.array(value), body)[0]
