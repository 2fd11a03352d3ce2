"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinspark.llm import decontamination, mixing, secrets, similarity, toxicity
from skeinspark.llm.runtime import bounded, cut, marked, ready, remove, scratch, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text scores below the threshold; the model is learned from the stage's own documents.

    Null, empty and very long texts are scored like any other, whole; repeated rows fare alike; without labels all stay; an
    empty table stays empty.  Columns are taken by their exact names and all are returned, clashing ones too.
    """
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at 0.8 over 5-word shingles: the one with the smallest doc_id, then text hash.

    Texts without a word are in no group and stay; of rows that repeat the doc_id and text that stay, one does.  Columns
    whose names clash are kept.
    """
    found = cut(similarity.groups(docs, k=5, percent=80))
    first = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("mark") == F.col("component_mark"))
    rows, _ = marked(docs)
    keys = [F.col("doc_id").alias("of_doc"), F.col("mark").alias("of_mark")]
    same = F.col("__doc").eqNullSafe(F.col("of_doc")) & (F.col("__mark") == F.col("of_mark"))
    other = bounded(cut(found.where(~first).select(*keys).distinct()))
    left = rows.join(other, same, "left_anti")
    again = bounded(cut(found.where(first & (F.col("n_shingles") > 0)).groupBy(*keys).agg(F.count("*").alias("times")).where("times > 1").drop("times")))
    if not again.isEmpty():  # rows that repeat both doc_id and text
        once = left.join(again, same, "left_semi").dropDuplicates(["__doc", "__mark"])
        left = left.join(again, same, "left_anti").unionByName(once)
    return left.drop("__doc", "__text", "__mark").toDF(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    Null and empty texts stay; very long texts are searched whole; repeated rows fare alike; an empty benchmark takes nothing,
    and an empty table stays empty.  All columns are returned, clashing ones too.
    """
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts, the longest first, and n_chars brought up to date.

    Null and empty texts stay as they are; very long texts are scanned whole; repeated rows change alike; an empty table stays
    empty.  All columns are returned, clashing ones too.
    """
    words = secrets.dictionary(docs)
    return secrets.redact(docs, secrets.train(secrets.generated_findings(spark, words), words), words)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, text and all, with the copies of each that the mix takes (0 to 3) and their words.

    Null and empty texts have no words, one copy and take nothing; rows that repeat one another get as many copies, up to
    one; a null source is a source, the last; an empty table stays empty.  A column whose name equals an added one, up to
    case, gives way to it.
    """
    return mixing.mix(docs, whole=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]
#: Forests, automata of links and Newton steps are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage.  A stage's table goes once the next one's is written; the last is needed by what is returned."""
    ready(spark)
    docs, done = table(spark, sf_dir, "documents"), None
    folder = f"{scratch(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        if done:
            remove(spark, done)
        done = f"{folder}/{name}"
        docs = spark.read.parquet(done)
    return STAGES[-1][1](spark, docs, sf_dir)
