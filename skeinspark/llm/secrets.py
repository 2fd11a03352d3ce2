"""Secret scans: candidate strings, judged by a random forest, in DataFrame functions and JVM-side trees only.

A candidate is a run of at least 16 key characters with a digit, or, where a secret word assigns it, any run of at least
8; a word of the text may hold several.  Its features are its length, its character transitions, how much of it the
dictionary covers, whether it looks like a path, and the words before and after it.  The dictionary holds the words
that many documents of the corpus use, counted over all of them.  The forest learns from labelled findings (before,
before2, word, candidate, after, label); where none are given, from findings generated by rule, of a fixed number.
Training never follows the corpus; every document is scanned.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .runtime import bounded, cut, documents, let, marked, ready

#: Runs that are looked at wherever they stand, and those that are where a secret word assigns them.
RUN, SHORT = r"[A-Za-z0-9_\-+/=.]{16,}", r"[A-Za-z0-9_\-+/=.]{8,}"
#: What may surround a name or a value, and what stands between a name and the value that is assigned to it, inside a word.
QUOTES = r"[\\\"'`]*"
NAMED = f"^{QUOTES}[:=>]+{QUOTES}$"
#: A short name at the end of what stands before a run, with what assigns.
NAME = r"[A-Za-z0-9_.\-]+[\\\"'`]{0,4}[:=]{1,4}[\\\"'`]{0,4}$"
#: Labelled findings generated where none are given, and words of the dictionary that they use.
FINDINGS, USED = 4096, 400
#: Letters of a dictionary word, and the documents that use it: this number at least, and this share of all.
LETTERS, MIN_DOCS, MIN_SHARE = 3, 5, 1e-4
TREES, DEPTH, THRESHOLD = 24, 8, 0.5
MARK = "[SECRET]"
# Words that stand before credentials, words that stand before other long strings, frequent English letter groups.
SECRET_WORDS = ("token", "secret", "password", "passwd", "pwd", "key", "apikey", "auth", "bearer", "credential", "credentials", "private", "access")
OTHER_WORDS = ("commit", "sha", "sha1", "sha256", "md5", "hash", "checksum", "digest", "uuid", "guid", "id", "card", "account", "phone", "order", "path", "file", "url", "version", "build", "rev")
PIECES = ("the", "and", "ing", "ion", "ent", "tion", "for", "ter", "est", "ers", "ati", "hat", "ate", "all", "eth", "his", "ver", "con", "com", "per", "user", "file", "name", "data", "test", "http", "www", "html", "index", "config", "value", "version", "example", "service", "server", "local", "home", "lib", "usr", "bin", "src")
#: A secret word, what may follow it in a name, and what assigns a value to the name.
SECRET_NAME = "(?i)(?:" + "|".join(SECRET_WORDS) + ")"
ASSIGNED = SECRET_NAME + r"[A-Za-z0-9_.\-]*" + QUOTES + "[:=]+>?" + QUOTES
AFTER_SECRET = ("expires", "expired", "revoked", "leaked", "valid", "rotated", "grants")
AFTER_OTHER = ("bytes", "merged", "checksum", "signed", "received", "released", "lines", "built", "delivered")
FEATURES = ("f_length", "f_digits", "f_upper", "f_lower", "f_hex", "f_transitions", "f_vowels", "f_distinct", "f_longest", "f_dictionary", "f_path", "f_dots", "f_secret_word", "f_other_word", "f_assigned", "f_quoted", "f_pieces", "f_after_secret", "f_after_other")


def plain(word: Column) -> Column:
    """Letters and digits of a neighbouring word, in lower case."""
    return F.regexp_replace(F.lower(F.coalesce(word, F.lit(""))), "[^a-z0-9_]", "")


def parts(x: Column) -> Column:
    """The letter groups of a string, in lower case, that can be dictionary words; a change of case ends a group."""
    return F.filter(F.transform(F.regexp_extract_all(x, F.lit("[A-Z]?[a-z]+|[A-Z]+"), F.lit(0)), F.lower), lambda p: F.length(p) >= LETTERS)


def dictionary(docs: DataFrame, min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE) -> DataFrame:
    """(dictionary_word, docs): the words of ASCII letters that enough documents of the whole table use, and PIECES.

    Null texts use none; repeated rows count once each; an empty table leaves PIECES.
    """
    spark = ready(docs.sparkSession)
    rows = documents(docs).where("text IS NOT NULL")
    least = max(min_docs, int(min_share * rows.count()))
    own = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(rf"\b[a-z]{{{LETTERS},24}}\b"), F.lit(0)))
    used = rows.select(F.explode(own).alias("dictionary_word")).groupBy("dictionary_word").agg(F.count("*").alias("docs")).where(F.col("docs") >= least)
    fixed = spark.range(1).select(F.explode(F.array(*map(F.lit, PIECES))).alias("dictionary_word"), F.lit(0).cast("bigint").alias("docs"))
    return cut(used.unionByName(fixed).groupBy("dictionary_word").agg(F.max("docs").alias("docs")))


def covered(rows: DataFrame, words: DataFrame) -> DataFrame:
    """rows with f_dictionary, the share of the candidate's characters that lie in dictionary words; each distinct candidate is looked up once."""
    each = rows.select("candidate").distinct().select("candidate", F.explode_outer(parts(F.col("candidate"))).alias("part"))
    found = each.join(words.select("dictionary_word"), F.col("part") == F.col("dictionary_word"), "left").groupBy("candidate").agg(F.coalesce(F.sum(F.when(F.col("dictionary_word").isNotNull(), F.length("part"))), F.lit(0)).alias("letters"))
    found = bounded(cut(found.select(F.col("candidate").alias("of_candidate"), (F.col("letters") / F.greatest(F.length("candidate"), F.lit(1))).alias("f_dictionary"))))
    return rows.join(found, F.col("candidate") == F.col("of_candidate")).drop("of_candidate")


def features(rows: DataFrame, words: DataFrame) -> DataFrame:
    """rows (before, before2, word, after, candidate) with the forest's features."""
    rows = covered(rows, words)
    c = F.col("candidate")
    n = F.greatest(F.length(c), F.lit(1)).cast("double")
    share = lambda pattern: F.length(F.regexp_replace(c, pattern, "")) / n
    near = F.split(F.concat_ws("_", plain(F.col("before2")), plain(F.col("before")), F.regexp_replace(F.lower(F.regexp_extract("word", "^(.*?)[:=]+" + QUOTES + SHORT, 1)), "[^a-z0-9_]", "")), "_")
    names = lambda words: F.arrays_overlap(near, F.array(*map(F.lit, words))).cast("double")
    groups = "(?i)(" + "|".join(sorted(PIECES, key=len, reverse=True)) + ")"
    return rows.select(
        "*",
        F.length(c).cast("double").alias("f_length"),
        share("[^0-9]").alias("f_digits"),
        share("[^A-Z]").alias("f_upper"),
        share("[^a-z]").alias("f_lower"),
        F.rlike(c, F.lit(r"^(?:[0-9a-f]+|[0-9A-F]+)$")).cast("double").alias("f_hex"),
        (F.regexp_count(c, F.lit(r"(?<=[0-9])[A-Za-z]|(?<=[A-Za-z])[0-9]|(?<=[a-z])[A-Z]")) / n).alias("f_transitions"),
        (F.regexp_count(c, F.lit("(?i)[aeiou]")) / n).alias("f_vowels"),
        (F.size(F.array_distinct(F.split(c, ""))) / n).alias("f_distinct"),
        F.array_max(F.transform(F.split(c, "[^A-Za-z]+"), F.length)).cast("double").alias("f_longest"),
        (1 - F.length(F.regexp_replace(c, groups, "")) / n).alias("f_pieces"),
        F.array_contains(F.array(*map(F.lit, AFTER_SECRET)), plain(F.col("after"))).cast("double").alias("f_after_secret"),
        F.array_contains(F.array(*map(F.lit, AFTER_OTHER)), plain(F.col("after"))).cast("double").alias("f_after_other"),
        F.regexp_count(c, F.lit(r"/")).cast("double").alias("f_path"),
        F.regexp_count(c, F.lit(r"\.")).cast("double").alias("f_dots"),
        names(SECRET_WORDS).alias("f_secret_word"),
        names(OTHER_WORDS).alias("f_other_word"),
        (F.rlike(F.concat_ws(" ", "before2", "before"), F.lit("(?:=|:|:=|=>)$")) | F.rlike("word", F.lit("[A-Za-z]" + QUOTES + "[:=]+" + QUOTES + SHORT))).cast("double").alias("f_assigned"),
        F.rlike("word", F.lit(r"[\"'`]" + SHORT)).cast("double").alias("f_quoted"),
    )


def generated_findings(spark: SparkSession, words: DataFrame | None = None, n: int = FINDINGS) -> DataFrame:
    """n labelled findings by rule, with their kind: keys and passwords that something assigns; digests, numbers, addresses, paths,
    identifiers and prose.  Names are made of PIECES and, if given, of the USED words of the dictionary that most documents use."""
    common = [] if words is None else [r[0] for r in words.orderBy(F.desc("docs"), "dictionary_word").limit(USED).collect()]
    pieces_of = tuple(sorted({*PIECES, *common}))
    i = F.col("id")
    listed = lambda values: F.split(F.lit("\x01".join(values)), "\x01", -1)  # noqa: E731  one literal, however many values
    pick_of = lambda values, salt: F.element_at(listed(values), (F.pmod(F.xxhash64(i, F.lit(salt)), F.lit(len(values))) + 1).cast("int"))
    prose = ("that", "the", "with", "une", "der", "los", "on", "is", "", "of")
    base = spark.range(n // 21).select(
        "id",
        F.sha2(F.concat(F.lit("finding"), i.cast("string")), 256).alias("digest"),
        pick_of(("20", "24", "32", "40", "40", "64"), 1).cast("int").alias("length"),
        pick_of(SECRET_WORDS, 3).alias("name"),
        pick_of(OTHER_WORDS, 14).alias("other"),
        pick_of(prose, 11).alias("prose"),
        pick_of(prose, 12).alias("prose2"),
        F.when(F.pmod(i, F.lit(4)) == 0, F.concat(*[F.initcap(pick_of(pieces_of, k)) for k in (5, 6, 7, 8, 9)])).otherwise(F.concat_ws("_", *[pick_of(pieces_of, k) for k in (5, 6, 7, 8, 9)])).alias("pieces"),
        pick_of(pieces_of, 16).alias("piece"),
        pick_of(("", "the", "is", "", *AFTER_SECRET), 18).alias("after_secret"),
        pick_of(("", "the", "is", "", *AFTER_OTHER), 19).alias("after_other"),
        pick_of(("8", "9", "10", "12", "14", "15"), 20).cast("int").alias("short"),
    )
    digest, length, name, other, before2, before, pieces, piece = map(F.col, ("digest", "length", "name", "other", "prose", "prose2", "pieces", "piece"))
    mixed = F.regexp_replace(F.base64(F.unhex(digest)), "[+/=]", "x")
    base = base.select(
        "*",
        F.when(F.pmod(i, F.lit(3)) > 0, F.substring(digest, F.lit(1), length)).otherwise(F.substring(mixed, F.lit(1), F.least(length, F.lit(40)))).alias("key"),
        F.substring(F.regexp_replace(F.conv(F.substring(digest, 1, 15), 16, 10), "^0*", "4"), 1, 16).alias("number"),
        F.concat_ws("-", *[F.substring(digest, a, b) for a, b in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]).alias("uuid"),
    )
    base = cut(base.coalesce(2))  # the findings below refer to these columns many times
    key, number, uuid = F.col("key"), F.col("number"), F.col("uuid")
    any_case = lambda x: F.when(F.pmod(F.xxhash64(i, F.lit(2)), F.lit(5)) == 0, F.upper(x)).otherwise(x)
    text = F.lit
    brief = F.substring(F.regexp_replace(F.base64(F.unhex(F.reverse(digest))), "[+/=]", "7"), F.lit(1), F.col("short"))
    letters = F.substring(F.translate(F.base64(F.unhex(digest)), "+/=0123456789", "xyzabcdefghij"), F.lit(1), length)
    spoken = F.substring(F.concat(piece, F.substring(number, F.lit(2), F.pmod(i, F.lit(3)).cast("int") + 1), pick_of(pieces_of, 27), pick_of(pieces_of, 28)), F.lit(1), F.greatest(F.col("short"), F.lit(10)))
    ordinary = F.concat_ws("_", piece, pick_of(pieces_of, 21), pick_of(pieces_of, 22))
    mail, path, label = F.concat(pieces, text("."), F.substring(number, 1, 2)), F.concat(text("/usr/lib/"), pieces, text("/"), piece, text("2.html")), F.concat(pieces, text("_"), piece, text("_v1"))
    kinds = [
        # label, before2, before, word, candidate
        (1, name, text("="), F.concat(text('"'), key, text('"'), pick_of(("", ".", "!!", ",", "###", ";"), 10)), key),
        (1, before2, F.concat(name, text(":")), key, key),
        (1, before2, before, F.concat(name, text("="), key), F.concat(name, text("="), key)),
        (1, pick_of(("export", "set", "api", "my"), 13), F.concat(text("api_"), name, text(" =")), F.concat(text("'"), key, text("',")), key),
        (0, before2, other, F.substring(digest, 1, 40), F.substring(digest, 1, 40)),
        (0, other, pick_of(("=", ":"), 15), F.substring(digest, F.lit(1), length), F.substring(digest, F.lit(1), length)),
        (0, before2, before, number, number),
        (0, before2, before, uuid, uuid),
        (0, before2, before, F.concat(mail, text("@mail5.example.com")), mail),
        (0, before2, before, path, path),
        (0, before2, pick_of(("=", "", "the"), 17), label, label),
        (0, name, pick_of(("=", ":"), 15), F.concat(text('"'), pieces, text('1-here"')), F.concat(pieces, text("1-here"))),
        (1, name, pick_of(("=", ":"), 15), F.concat(text('"'), brief, text('"')), brief),
        (1, before2, before, F.concat(name, text("="), brief), F.concat(name, text("="), brief)),
        (1, name, pick_of(("=", ":"), 15), F.concat(text('"'), letters, text('"')), letters),
        (0, name, pick_of(("=", ":"), 15), F.concat(text('"'), ordinary, text('"')), ordinary),
        (1, before2, before, F.concat(name, pick_of(('="', "='", '":"', ":"), 24), brief, text('"')), brief),
        (1, before2, before, F.concat(name, pick_of(('="', "='", '":"', ":"), 25), key, text('"')), key),
        (0, before2, before, F.concat(name, pick_of(('="', "='", '":"', ":"), 26), ordinary, text('"')), ordinary),
        (1, before2, before, F.concat(name, pick_of(('="', "='", '":"', ":"), 29), spoken, text('"')), spoken),
        (1, name, pick_of(("=", ":"), 30), F.concat(text('"'), spoken, text('"')), spoken),
    ]
    after = lambda y: F.when(F.pmod(F.xxhash64(i, F.lit(23)), F.lit(6)) == 0, F.col("after_other" if y else "after_secret")).otherwise(F.col("after_secret" if y else "after_other"))
    rows = F.array(*[F.struct(F.lit(y).cast("double").alias("label"), F.lit(k).alias("kind"), b2.alias("before2"), b.alias("before"), any_case(w).alias("word"), any_case(c).alias("candidate"), after(y).alias("after")) for k, (y, b2, b, w, c) in enumerate(kinds)])
    return base.select(F.explode(rows).alias("x")).select("x.*")


def train(findings: DataFrame, words: DataFrame, trees: int = TREES, depth: int = DEPTH) -> RandomForestClassificationModel:
    """A forest on labelled findings (label, before2, before, word, candidate, after); rows without a label are left out."""
    ready(findings.sparkSession)
    # the findings' and the features' plans are large and the forest reads its rows many times
    rows = features(cut(findings.where("label IS NOT NULL")), words)
    rows = cut(rows.select("label", *FEATURES))
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows).select("features", "label")
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=7, maxBins=64, subsamplingRate=0.8).fit(rows.coalesce(2))


def ahead(before: Column, before2: Column) -> Column:
    """Whether the words before assign something to a secret word: ``token =``, ``password:``."""
    return F.coalesce(F.rlike(before, F.lit(SECRET_NAME + r"[^A-Za-z0-9]*[:=]$")) | (F.rlike(before, F.lit("^[:=]+>?$")) & F.rlike(before2, F.lit(SECRET_NAME + "[^A-Za-z0-9]*$"))), F.lit(False))


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, word_at, run_at, before2, before, word, after, candidate) for every candidate in every word of docs (doc_id, text).

    A word may hold many runs, as JSON without blanks does; run_at counts them, from 0.  word is the part of the word
    that belongs to the candidate: the name that the word gives it, or else what stands between it and the run before,
    and the candidate.  The words before belong to the first run of a word, or to the one that the first names.
    Runs without a digit, or of under 16 characters, count only if a secret word assigns them: before them in their word, in
    the words ahead of it, or, as ``=`` is a key character, inside the run.
    """
    rows = docs.where(F.rlike("text", F.lit(RUN)) | F.rlike("text", F.lit(SECRET_NAME + r"[^:=]{0,60}[:=]"))).select("doc_id", F.xxhash64("text").alias("mark"), F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)).alias("w"))
    at = F.filter(F.transform("w", lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: F.rlike(s["x"], F.lit(SHORT)))
    near = F.transform(at, lambda s: F.struct(s["i"].alias("word_at"), F.get("w", s["i"] - 2).alias("before2"), F.get("w", s["i"] - 1).alias("before"), F.get("w", s["i"] + 1).alias("after"), s["x"].alias("word")))
    near = F.filter(near, lambda s: F.rlike(s["word"], F.lit(RUN)) & F.rlike(s["word"], F.lit("[0-9]")) | F.rlike(s["word"], F.lit(ASSIGNED)) | ahead(s["before"], s["before2"]))
    rows = rows.select("doc_id", "mark", F.explode(near).alias("x")).select("doc_id", "mark", "x.*")
    rows = rows.withColumn("ahead", ahead(F.col("before"), F.col("before2")))

    def each(p: Column) -> Column:
        def one(c: Column, j: Column) -> Column:
            gap = F.get(p["gaps"], j)
            given = (j > 0) & (F.rlike(gap, F.lit(NAMED)) | (F.endswith(F.get(p["runs"], j - 1), F.lit("=")) & F.rlike(gap, F.lit(f"^{QUOTES}$"))))
            first = (j == 0) | ((j == 1) & given)
            return F.struct(
                j.alias("run_at"),
                F.when(first, F.col("before2")).alias("before2"),
                F.when(first, F.col("before")).alias("before"),
                F.concat(F.when(given, F.concat(F.get(p["runs"], j - 1), gap)).otherwise(F.coalesce(F.nullif(F.regexp_extract(gap, NAME, 0), F.lit("")), gap)), c).alias("word"),
                c.alias("candidate"),
                (((j == 0) & F.col("ahead")) | F.rlike(F.concat(F.coalesce(F.get(p["runs"], j - 1), F.lit("")), gap), F.lit(ASSIGNED + "$")) | F.rlike(c, F.lit(ASSIGNED + "[^=]{8}"))).alias("assigned"),
            )

        return F.filter(F.transform(p["runs"], one), lambda s: s["assigned"] | (F.length(s["candidate"]) >= 16) & F.rlike(s["candidate"], F.lit("[0-9]")))

    # gaps[j] stands before runs[j]
    pieces = F.struct(F.regexp_extract_all("word", F.lit(SHORT), F.lit(0)).alias("runs"), F.split("word", SHORT, -1).alias("gaps"))
    rows = rows.select("doc_id", "mark", "word_at", "after", F.explode(let(pieces, each)).alias("x"))
    return rows.select("doc_id", "mark", "word_at", "x.run_at", "x.before2", "x.before", "x.word", "after", "x.candidate")


def findings(docs: DataFrame, model: RandomForestClassificationModel, words: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, mark, word_at, run_at, candidate, probability, is_secret) of every candidate of every text.

    Null and empty texts have none; repeated rows and null ids are scanned like any other; very long texts are scanned
    whole; candidates of equal probability fare alike; other columns are ignored.
    """
    ready(docs.sparkSession)
    rows = features(cut(candidates(documents(docs))), words)
    judged = model.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep").transform(rows))
    return judged.select("doc_id", "mark", "word_at", "run_at", "candidate", F.round(vector_to_array("probability")[1], 6).alias("probability")).withColumn("is_secret", F.col("probability") >= threshold)


def redact(docs: DataFrame, model: RandomForestClassificationModel, words: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs with every secret in the text replaced by MARK, the longest first, and, where there is such a column, n_chars brought up to date.

    Null and empty texts stay as they are; repeated rows change alike; a text column is taken by its exact name, and columns
    whose names clash with it are kept.
    """
    found = findings(docs, model, words, threshold).where("is_secret").groupBy("doc_id", "mark").agg(F.collect_set(F.struct(F.length("candidate").alias("n"), "candidate")).alias("found"))
    longest_first = F.transform(F.sort_array("found", asc=False), lambda x: x["candidate"])
    found = bounded(cut(found.select(F.col("doc_id").alias("of_doc"), F.col("mark").alias("of_mark"), longest_first.alias("__secrets"))))
    rows, at = marked(docs)
    rows = rows.join(found, F.col("__doc").eqNullSafe(F.col("of_doc")) & (F.col("__mark") == F.col("of_mark")), "left")
    hit = F.col("__secrets").isNotNull()
    rows = rows.withColumn("__new", F.when(hit, F.aggregate("__secrets", F.col("__text"), lambda t, s: F.replace(t, s, F.lit(MARK)))))
    out = []
    for i, field in enumerate(docs.schema.fields):
        c = F.col(f"c{i}")
        if f"c{i}" == at("text"):
            c = F.when(hit, F.col("__new").cast(field.dataType)).otherwise(c)
        elif f"c{i}" == at("n_chars"):
            c = F.when(hit, F.length("__new").cast(field.dataType)).otherwise(c)
        out.append(c.alias(f"c{i}"))
    return rows.select(*out).toDF(*docs.columns)
