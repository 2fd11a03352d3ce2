import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from skeinspark.llm import decontamination, secrets, similarity, toxicity

from . import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def test_stages():
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "mixing"]


@pytest.mark.parametrize(("name", "stage"), P.STAGES[:-1])
def test_columns_and_empty_input(spark, sf, docs, name, stage):
    assert stage(spark, docs, sf).columns == COLUMNS
    none = stage(spark, docs.limit(0), sf)
    assert none.columns == COLUMNS and none.count() == 0


def odd_rows(spark):
    """Nulls in every column, empty and blank texts, ties, repeated rows, a very long text, and columns whose names clash."""
    long = " ".join(f"w{i % 5000}" for i in range(60_000))
    rows = [(1, None, "en", "a", None), (2, "", None, None, 0), (3, " \t\n", "en", "a", 3), (None, None, None, None, None), (4, long, "en", None, len(long)), (5, "one two three", "fr", "b", 13), (5, "one two three", "fr", "b", 13), (6, "one two three four five six seven eight", None, "b", 39)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return df.selectExpr("*", "1 AS TEXT", "'z' AS Doc_Id", "2 AS cls", "'m' AS mark", "3 AS component_id", "4 AS SOURCE", "5 AS n", "6 AS root")


@pytest.mark.parametrize(("name", "stage"), P.STAGES)
def test_odd_rows(spark, sf, name, stage):
    docs = odd_rows(spark)
    out = stage(spark, docs, sf)
    assert out.columns[: len(docs.columns)] == docs.columns
    got = sorted(str(tuple(r)[:13]) for r in out.collect())
    want = sorted(str(tuple(r)) for r in docs.collect())
    if name == "near_duplicates":  # one of the repeated rows goes
        want.remove(next(r for r in want if r.startswith("(5,")))
    assert got == want


def test_toxicity_stage(spark, sf, docs):
    model = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    wanted = {r.doc_id for r in toxicity.passages(docs, model).where("score < 0.3").collect()}
    assert {r.doc_id for r in P.drop_toxic(spark, docs, sf).collect()} == wanted


def test_near_duplicate_stage(spark, sf, docs):
    rows = docs.orderBy("doc_id").collect()
    ids = [r.doc_id for r in rows]
    roots = brute.groups(ids, [r.text for r in rows], 5, 80)
    assert sorted(r.doc_id for r in P.drop_near_duplicates(spark, docs, sf).collect()) == sorted(set(roots))


def test_near_duplicates_of_repeated_rows(spark, sf, docs):
    some = docs.limit(5)
    odd = spark.createDataFrame([(900, None), (900, None), (901, ""), (None, "p q r s t u v"), (None, "p q r s t u v"), (902, "P q r s t u v")], "doc_id bigint, text string").selectExpr("*", "'en' AS lang", "'s' AS source", "0L AS n_chars")
    left = P.drop_near_duplicates(spark, some.unionByName(some).unionByName(odd), sf)
    ids = [r.doc_id for r in left.collect()]
    assert sorted(x for x in ids if x is not None) == sorted([r.doc_id for r in some.collect()] + [900, 900, 901, 902]) and ids.count(None) == 0


def test_near_duplicates_keep_unrelated_texts_under_one_id(spark, sf):
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(12)) for x in "abcde")
    rows = [(None, a), (None, b), (None, b), (7, c), (7, d), (7, d), (8, c), (None, e), (None, e + " more")]
    left = P.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'en' AS lang", "'s' AS source", "0L AS n_chars"), sf).collect()
    assert sorted((r.doc_id or 0, r.text[:1]) for r in left) == [(0, "a"), (0, "b"), (0, "e"), (7, "c"), (7, "d")]


def test_decontamination_stage(spark, sf, docs):
    hit = {r.doc_id for r in decontamination.leaks(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    assert hit and {r.doc_id for r in P.drop_leaks(spark, docs, sf).collect()} == {r.doc_id for r in docs.collect()} - hit


def test_secret_stage(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")  # the smallest table that has secrets
    out = {r.doc_id: r for r in P.redact_secrets(spark, docs, sf).collect()}
    assert len(out) == docs.count()
    assert all(out[r.doc_id].text == r.text for r in docs.collect() if not secrets.MARK in out[r.doc_id].text)
    assert any(secrets.MARK in r.text for r in out.values()) and all(r.n_chars == len(r.text) for r in out.values() if secrets.MARK in r.text)


def test_run_and_rerun(spark, sf):
    first, second = (sorted(tuple(r) for r in P.run(spark, sf).collect()) for _ in range(2))
    assert first == second and first
    totals = {}
    for r in P.run(spark, sf).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("size").alias("longest")).collect():
        totals[r.source] = r
        assert abs(r.taken - r.target) <= max(0.1 * r.target, r.longest)
