"""Toxic passages by maximum-scoring segment search.

Tokens score their log-odds between toxic and clean training texts under an informative Dirichlet prior
(the tokens' overall shares); those that are not significant score nothing, and every token pays a small
drift, so the score of clean text falls.  One linear scan finds all maximal scoring segments of a text.
Segment scores of clean text follow an extreme-value law whose decay solves ``E[exp(decay * score)] = 1``
over clean tokens and whose scale is fitted to the clean training texts; the law turns scores into
chances, sum statistics join the significant segments of a text, and a monotone fit turns the text's evidence
into the probability of label 1.  Scale and monotone fit see a training text only by a lexicon that the other
folds have taught (FOLDS folds, by text), so neither is fitted on what the lexicon has learned by heart.

The fit uses at most ``fit_rows`` labelled rows a class (those with the smallest hash of doc_id), a bound
that does not follow the corpus; scoring covers every text whole.
"""

from __future__ import annotations

import collections
import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import documents, held_out, lean, only, pick, ready, trim

FIT_ROWS, FOLDS = 10_000, 3
#: Prior observations for each one seen, smallest z of a scoring token, cost of each token, smallest share of toxic tokens that a scoring token has.
PRIOR, Z, DRIFT, MIN_SHARE = 0.1, 3.2, 0.25, 2e-6
#: Expected number of as good segments in clean text, up to which a segment is significant.
E_MAX = 0.05
THRESHOLD = 0.3
TOKEN = re.compile(r"[^\W_]+")


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def segments(scores: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a token sequence, in linear time.

    scores: positions, ascending, and scores of the tokens that score anything; all tokens cost ``drift`` besides.
    Each stack entry has the sums left of it and at its end; a segment absorbs earlier ones as long as that raises it.
    """
    stack: list[tuple[int, int, float, float]] = []
    total, before = 0.0, 0
    for at, gain in scores:
        total -= drift * (at - before)
        before = at + 1
        low, total = total, total + gain - drift
        if gain - drift <= 0:
            continue
        start = at
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= low:
                j -= 1
            # entries above j start no lower than this one does, so they can never be extended by it
            if j < 0 or stack[j][3] >= total:
                stack.append((start, at + 1, low, total))
                break
            start, _, low, _ = stack[j]
            del stack[j:]
    return [(s, e, high - low) for s, e, low, high in stack]


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    decay: float = 1.0
    scale: float = 0.1
    steps: list[tuple[float, float]] = field(default_factory=lambda: [(-math.inf, 0.0)])

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        if not text:
            return 0, []
        words = tokens(text)
        get = self.weights.get
        scored = [(i, s) for i, s in enumerate(map(get, words)) if s is not None]
        return len(words), segments(scored, DRIFT) if scored else []

    def expected(self, n: int, score: float) -> float:
        """Segments of at least this score to be expected in n clean tokens."""
        return self.scale * max(n, 1) * math.exp(-self.decay * score)

    def evidence(self, n: int, found: list[tuple[int, int, float]]) -> float:
        """-ln of the chance that clean text has segments as good: the best of the sum statistics of the r best significant segments."""
        good = sorted((self.decay * s - math.log(self.scale * max(n, 1)) for *_, s in found if self.expected(n, s) <= E_MAX), reverse=True)
        best, total = 0.0, 0.0
        for r, x in enumerate(good, 1):
            total += x
            best = max(best, total - (r - 1) * math.log(max(total, 1.0)) + math.lgamma(r + 1) + math.lgamma(r))
        return best

    def probability(self, evidence: float) -> float:
        lo, hi = 0, len(self.steps)
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if self.steps[mid][0] <= evidence else (lo, mid)
        return self.steps[lo][1]

    def score(self, text: str | None) -> float:
        return self.probability(self.evidence(*self.scan(text)))


def monotone(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> list[tuple[float, float]]:
    """Steps (from, value) of the weighted increasing fit of y on x; equal x share a step."""
    blocks: list[list[float]] = []
    order = np.argsort(x, kind="stable")
    for v, label, weight in zip(x[order], y[order], w[order]):
        if blocks and blocks[-1][0] == v:
            blocks[-1][1] += label * weight
            blocks[-1][2] += weight
        else:
            blocks.append([float(v), float(label * weight), float(weight)])
    out: list[list[float]] = []
    for b in blocks:
        out.append(b)
        while len(out) > 1 and out[-2][1] * out[-1][2] >= out[-1][1] * out[-2][2]:
            last = out.pop()
            out[-1][1] += last[1]
            out[-1][2] += last[2]
    return [(b[0] if i else -math.inf, b[1] / b[2]) for i, b in enumerate(out)] or [(-math.inf, 0.0)]


def decay_of(gains: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum(shares * exp(root * gains)) = 1; gains need a negative mean and a positive value."""
    f = lambda x: float((shares * np.exp(np.minimum(x * gains, 500.0))).sum()) - 1.0
    low, high = 0.0, 1.0
    while f(high) < 0 and high < 1e3:
        low, high = high, high * 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return max(high, 1e-3)


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Learn from labels (doc_id, toxic) of documents that are not held out; null labels and labels other than 0 and 1 say nothing."""
    spark = ready(docs.sparkSession)
    known = pick(labels, doc_id="bigint", toxic="int").where("toxic IN (0, 1) AND doc_id IS NOT NULL").where(~held_out())
    size = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(size) < 2:
        return Model()
    chosen = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows) for y in (0, 1)]
    chosen = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most 2 * fit_rows rows of two numbers
    # copies of a text are in one fold
    sample = documents(docs).join(chosen, "doc_id").select("toxic", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold"), "text")

    def count(batches):
        counts: dict[tuple[int, str], int] = {}  # documents of label 0 and 1 and tokens of label 0, packed
        for batch in batches:
            for y, fold, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                for w, times in collections.Counter(tokens(text.as_py() or "")).items():
                    counts[fold, w] = counts.get((fold, w), 0) + (1 << 24 * y) + ((1 - y) * times << 48)
            if len(counts) > 40_000:
                yield rows(counts)
                counts = {}
        yield rows(counts)

    def rows(counts):
        return pa.RecordBatch.from_arrays([pa.array([w for _, w in counts], pa.string()), pa.array([f for f, _ in counts], pa.int32()), *(pa.array([n >> s & m for n in counts.values()], pa.int64()) for s, m in ((0, 0xFFFFFF), (24, 0xFFFFFF), (48, (1 << 62) - 1)))], names=["w", "fold", "c", "t", "m"])

    # a token counts once a text and a text once, so neither repetition inside a text nor copies make evidence
    distinct = sample.dropDuplicates(["toxic", "text"])
    # sums over all folds but one, and over all: the last
    views = range(FOLDS + 1)
    sums = [F.sum(F.when(F.col("fold") != v, F.col(x)).otherwise(0)).alias(f"{x}{v}") for v in views for x in "ctm"]
    words = distinct.mapInArrow(lean(count), "w string, fold int, c bigint, t bigint, m bigint").groupBy("w").agg(*sums).persist()
    try:
        total = words.agg(*(F.sum(f"{x}{v}").alias(f"{x}{v}") for v in views for x in "ctm")).first()
        picked, keep = [], F.lit(False)
        for v in views:
            nc, nt = float(total[f"c{v}"] or 0), float(total[f"t{v}"] or 0)
            if not nc or not nt:
                if v == FOLDS:
                    return Model()
                picked.append(F.lit(None).cast("double").alias(f"odds{v}"))
                continue
            prior = PRIOR * (nc + nt)
            a = PRIOR * (F.col(f"c{v}") + F.col(f"t{v}"))
            t, c = (F.nullif(F.col(f"{x}{v}") + a, F.lit(0.0)) for x in "tc")  # null where the view has no such token
            odds = F.log(t / (nt + prior - t)) - F.log(c / (nc + prior - c))
            z = odds / F.sqrt(1 / t + 1 / c)
            # at most 2 / MIN_SHARE tokens can pass
            often = (F.col(f"t{v}") >= MIN_SHARE * nt) & (odds > 0) | (F.col(f"c{v}") >= MIN_SHARE * nc) & (odds < 0)
            good = (F.abs(z) >= Z) & often & (F.col(f"c{v}") + F.col(f"t{v}") > 0)
            keep = keep | F.coalesce(good, F.lit(False))
            picked.append(F.when(good, odds).alias(f"odds{v}"))
        kept = words.where(keep).select("w", *(f"m{v}" for v in views), *picked).collect()
    finally:
        words.unpersist()

    def model_of(v: int) -> Model:
        own = [(r.w, r[f"odds{v}"], r[f"m{v}"]) for r in kept if r[f"odds{v}"] is not None]
        model = Model(weights={w: x for w, x, _ in own})
        if any(x > DRIFT for x in model.weights.values()):
            gains = np.array([x for _, x, _ in own] + [0.0]) - DRIFT
            rest = max(0, (total[f"m{v}"] or 0) - sum(m for *_, m in own))
            shares = np.array([m + 0.5 for *_, m in own] + [rest])  # half a sighting more, for tokens that clean texts lack
            model.decay = decay_of(gains, shares / shares.sum())
        else:
            model.weights = {}
        return model

    models = [model_of(v) for v in views]
    model = models[FOLDS]
    if not model.weights:
        return Model()
    held = spark.sparkContext.broadcast(models)

    def scan(batches):
        models = held.value
        for batch in batches:
            # a text is scanned with what the other folds' texts have taught
            found = [models[f].scan(x.as_py()) for f, x in zip(batch.column(1).to_pylist(), batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([n for n, _ in found], pa.int64()), pa.array([[s for *_, s in x] for _, x in found], pa.list_(pa.float64()))], names=["toxic", "fold", "n", "scores"])

    seen = sample.mapInArrow(lean(scan), "toxic int, fold int, n bigint, scores array<double>").collect()  # at most 2 * fit_rows documents
    clean = [(r.n, models[r.fold].decay * max(r.scores, default=0.0)) for r in seen if r.toxic == 0 and r.n]
    # with the decay known, the likeliest scale of maxima that follow exp(-scale * n * exp(-decay * score))
    model.scale = min(1.0, max(1e-6, len(clean) / max(1e-9, sum(n * math.exp(-s) for n, s in clean))))
    for m in models:
        m.scale = model.scale
    used = {y: sum(r.toxic == y for r in seen) for y in (0, 1)}
    x = np.array([models[r.fold].evidence(r.n, [(0, 0, s) for s in r.scores]) for r in seen])
    y = np.array([r.toxic for r in seen], dtype=float)
    w = np.array([size[r.toxic] / used[r.toxic] for r in seen])
    model.steps = monotone(x, y, w)
    del seen, kept
    trim()
    return model


def passages(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted, and the significant passages (token start, token end, score) of every row.

    Null and empty texts score as texts without evidence.  Repeated rows and null ids: a row each; other columns are ignored.
    """
    spark = ready(docs.sparkSession)
    held = spark.sparkContext.broadcast(model)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(batches):
        model = held.value
        for batch in batches:
            scores, spans = [], []
            for x in batch.column(2):
                n, found = model.scan(x.as_py())
                scores.append(model.probability(model.evidence(n, found)))
                spans.append([{"start": s, "end": e, "score": v} for s, e, v in found if model.expected(n, v) <= E_MAX])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array(spans, pa.list_(span))], names=["doc_id", "held_out", "score", "passages"])

    rows = documents(docs).select("doc_id", held_out().alias("held_out"), "text").mapInArrow(lean(run), "doc_id bigint, held_out boolean, score double, passages array<struct<start: bigint, end: bigint, score: double>>")
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "passages")


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all columns as they were, whose text scores below the threshold.

    Null and empty texts score as texts without evidence; repeated rows fare alike; columns whose names clash are kept.
    """
    held = ready(docs.sparkSession).sparkContext.broadcast(model)
    return only(docs, lambda: lambda column: [held.value.score(x.as_py()) < threshold for x in column])
