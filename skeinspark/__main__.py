"""Commands: discover, profile and run over sample files.

    python -m skeinspark discover SAMPLES            services and their metrics
    python -m skeinspark profile SAMPLES --out FILE  the label schema, as JSON
    python -m skeinspark run SAMPLES --out FOLDER    the feature table, as Parquet
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from .plans.commands import discover, profile, run
from .sources.raw import read_csv


def samples(spark: SparkSession, path: str) -> DataFrame:
    """CSV files with labels as a dict's text, or anything else as Parquet."""
    return read_csv(spark, path) if path.endswith(".csv") else spark.read.parquet(path)


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="skeinspark", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("command", choices=("discover", "profile", "run"))
    parser.add_argument("samples")
    parser.add_argument("--out")
    parser.add_argument("--include", nargs="*", default=[], help="patterns of families that are wanted")
    parser.add_argument("--exclude", nargs="*", default=[], help="patterns of families that are not")
    parser.add_argument("--schema", help="a label schema that profile has written")
    given = parser.parse_args(arguments)
    spark = SparkSession.builder.getOrCreate()
    rows = samples(spark, given.samples)
    if given.command == "discover":
        for r in discover(rows).collect():
            print(f"{r.service}: {', '.join(r.metrics)}")
    elif given.command == "profile":
        config = profile(rows, given.include, given.exclude)
        if given.out:
            with open(given.out, "w") as f:
                json.dump(config, f, indent=1)
        else:
            json.dump(config, sys.stdout, indent=1)
    else:
        table = run(rows, given.schema)
        table.write.mode("overwrite").parquet(given.out) if given.out else table.show()
    return 0


if __name__ == "__main__":
    sys.exit(main())
