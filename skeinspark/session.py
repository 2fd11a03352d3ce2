"""What a session needs for functions that run in Python on the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()
#: Rows up to which a side may be broadcast, counted before the hint is given.
BROADCAST_ROWS = 200_000


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors this package, which need not be installed there; once an application."""
    if (app := spark.sparkContext.applicationId) not in _SHIPPED:
        root = Path(__file__).resolve().parent
        with zipfile.ZipFile(Path(tempfile.mkdtemp(prefix="skein-code-")) / f"{root.name}.zip", "w") as out:
            for p in sorted(root.rglob("*.py")):
                out.write(p, p.relative_to(root.parent))
        spark.sparkContext.addPyFile(out.filename)
        _SHIPPED.add(app)
    return spark


def shipped(df: DataFrame) -> DataFrame:
    """df, whose session's executors have this package."""
    ship(df.sparkSession)
    return df


def checkpoints(spark: SparkSession) -> SparkSession:
    """Point checkpoints at the cluster's shared folder.

    Where none is configured, a folder of our own is taken on one machine (a local master); on a cluster, which would not
    see it, that is an error.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="skein-checkpoint-"))
    return spark


def checkpointed(df: DataFrame) -> DataFrame:
    """df computed once and without its lineage, in the shared folder, which survives lost executors."""
    checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df, marked for broadcast if a count shows that it has at most so many rows; else as it is, for a shuffled join that AQE may split."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
