"""Quality rules and cross-document line frequency, in DataFrame functions only.

Base rules look at one text.  The frequency rule hashes normalised lines, counts in how many distinct
documents of a host each occurs, takes the lines above the limit out and rejects documents that are left with
too little.  Copies under different ids are different documents; rows that repeat doc_id and text are one.

Line rows carry numbers only and are pre-aggregated before each shuffle; the (host, line, document) level
keeps a line that a third of all documents share from meeting in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import BROADCAST_ROWS, bounded, cut, documents, let, ready

BLANKS = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"
#: Distinct documents of a host that may share a line: the larger of this number and this share of the host's documents.
MAX_DOCS, MAX_SHARE = 20, 0.01
#: Share of its words that a document must keep, and words.
MIN_LEFT, MIN_WORDS = 0.5, 10
GRAM = 5


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))


def lines_of(text: Column) -> Column:
    """The text's \\n-separated lines that have a word."""
    return F.filter(F.split(text, "\n", -1), lambda x: F.rlike(x, F.lit(WORDS)))


def repeated_words(words: Column) -> Column:
    """Words inside 5-word windows that the text holds twice or more; hashes of windows are sorted, never compared pairwise."""

    def windows(w: Column) -> Column:
        return F.when(F.size(w) >= GRAM, F.transform(F.sequence(F.lit(1), F.size(w) - (GRAM - 1)), lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(GRAM)]))).otherwise(F.array().cast("array<bigint>"))

    def covered(hashes: Column) -> Column:
        order = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            same = lambda e, j: (F.get(s, j - 1)["h"] == e["h"]) | (F.get(s, j + 1)["h"] == e["h"])
            return F.array_sort(F.transform(F.filter(s, lambda e, j: F.coalesce(F.when(j > 0, same(e, j)).otherwise(F.get(s, j + 1)["h"] == e["h"]), F.lit(False))), lambda e: e["i"]))

        zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-GRAM).alias("last"))
        step = lambda a, i: F.struct((a["n"] + F.least(F.lit(GRAM), i - a["last"])).cast("bigint").alias("n"), i.alias("last"))
        return let(order, lambda s: F.aggregate(starts(s), zero, step, lambda a: a["n"]))

    return let(words, lambda w: let(windows(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(covered(h))))


def base_rules(docs: DataFrame) -> DataFrame:
    """docs (doc_id, host, text) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.withColumn("text", text)
    lines = lambda t: let(lines_of(t), lambda x: F.size(x) - F.size(F.array_distinct(x)))
    rows = rows.select(
        "*",
        F.regexp_count("text", F.lit(WORDS)).cast("bigint").alias("n_words"),
        F.length(F.regexp_replace("text", BLANKS, "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.when(F.col("text").contains("\n"), lines(F.col("text"))).otherwise(0).cast("bigint").alias("n_dup_lines"),
        repeated_words(words_of(F.col("text"))).alias("n_repeat_words"),
    )
    return rows.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def line_hash(line: Column) -> Column:
    """Hash of the normalised line: blanks collapsed, lower case."""
    return F.xxhash64(F.lower(F.trim(F.regexp_replace(line, BLANKS, " "))))


def without_lines(text: Column, lines: Column) -> Column:
    """The text without the lines whose hashes are in the array ``lines``; lines without a word stay."""
    return F.array_join(F.filter(F.split(text, "\n", -1), lambda x: ~(F.rlike(x, F.lit(WORDS)) & F.array_contains(lines, line_hash(x)))), "\n")


def line_rows(docs: DataFrame) -> DataFrame:
    """docs with a row, ``line``, for the hash of each line that has a word, once a document."""
    kept = [c for c in docs.columns if c != "text"]
    return docs.where("text IS NOT NULL").select(*kept, F.explode(F.array_distinct(F.transform(lines_of(F.col("text")), line_hash))).alias("line"))


def frequent_lines(docs: DataFrame, max_docs: int = MAX_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """host, line of every line that more distinct documents of the host hold than the limit allows."""
    rows = docs.select("host", F.xxhash64("doc_id", "text").alias("doc"), "text")
    total = rows.where("text IS NOT NULL").groupBy("host", "doc").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("docs"))
    seen = line_rows(rows).groupBy("host", "line", "doc").agg(F.lit(1).alias("one"))
    often = seen.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") > max_docs).toDF("often_host", "often_line", "n")
    return often.join(total, F.col("often_host").eqNullSafe(F.col("host"))).where(F.col("n") > max_share * F.col("docs")).select("often_host", "often_line")


def quality(docs: DataFrame, host: str = "source", max_docs: int = MAX_DOCS, max_share: float = MAX_SHARE, min_left: float = MIN_LEFT) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_line_words, left of every row.

    left: the text without its lines above the limit; n_line_words: words that it lost.  kept is false if a base rule fails, or the words left are under
    ``min_left`` of all or fewer than 10.  Null texts are empty and fail the base rules; a null host is a host; rows
    that repeat another one get the same verdict; other columns are ignored.
    """
    ready(docs.sparkSession)
    rows = documents(docs, **{host: "string"}).withColumnRenamed(host, "host")
    often = cut(frequent_lines(rows, max_docs, max_share))
    marked = rows.withColumn("mark", F.xxhash64("text"))
    found = line_rows(marked.select("host", "mark", "text"))
    often = bounded(often)
    hits = found.join(often, F.col("host").eqNullSafe(F.col("often_host")) & (F.col("line") == F.col("often_line")))
    lost = hits.groupBy("host", "mark").agg(F.collect_set("line").alias("lines")).toDF("lost_host", "lost_mark", "lines")
    lost = cut(lost)
    if lost.agg(F.coalesce(F.sum(1 + F.size("lines")), F.lit(0))).first()[0] <= BROADCAST_ROWS:  # texts and their lines together
        lost = F.broadcast(lost)
    out = base_rules(marked).join(lost, F.col("host").eqNullSafe(F.col("lost_host")) & (F.col("mark") == F.col("lost_mark")), "left")
    out = out.withColumn("left", F.when(F.col("lines").isNull(), F.col("text")).otherwise(without_lines(F.col("text"), F.col("lines"))))
    out = out.withColumn("n_left", F.when(F.col("lines").isNull(), F.col("n_words")).otherwise(F.regexp_count("left", F.lit(WORDS)).cast("bigint")))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("n_left") >= min_left * F.col("n_words")) & (F.col("n_left") >= MIN_WORDS)).alias("kept"),
        (F.col("n_words") - F.col("n_left")).alias("n_line_words"),
        "left",
    )
