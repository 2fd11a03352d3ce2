"""Language identification with language-bitmask n-gram filters.

Every language keeps the character trigrams that make up at least ``share`` of its training trigrams.
They go into one bit-sliced Bloom filter: each position holds a bitmask of languages, so the AND of a
trigram's positions names at once every language that (perhaps falsely) contains it.  A text's
per-language popcounts are corrected by each language's own false-positive rate and the largest decides.

Training reads all given rows in one pass; only trigrams above ``share`` reach the driver, at most
1 / share per language, which bounds the filter and its broadcast whatever the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import documents, held_out, lean, ready
from .textnp import U, mix

SHARE = 5e-5
HASHES = 2
_LETTER: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTER[0]


def trigrams(text: str) -> np.ndarray:
    """Trigrams of the lower-cased text around each letter, other characters read as one blank; exact 63-bit keys."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
    is_letter = letters()[points]
    points = np.where(is_letter, points, 0x20)
    return (points[:-2] << 42 | points[1:-1] << 21 | points[2:])[is_letter[1:-1]]


@dataclass
class Filter:
    languages: list[str]
    slots: np.ndarray = field(default_factory=lambda: np.zeros((1, 1), U))
    false_rate: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @staticmethod
    def positions(grams: np.ndarray, size: int) -> list[np.ndarray]:
        with np.errstate(over="ignore"):
            h = mix(grams.astype(U) + U(0x9E3779B97F4A7C15))
            return [((h >> U(32 * k)) & U(size - 1)).astype(np.int64) for k in range(HASHES)]

    @classmethod
    def build(cls, languages: list[str], sets: list[np.ndarray]) -> Filter:
        size = 1 << max(10, int(16 * sum(map(len, sets)) + 1).bit_length())
        slots = np.zeros(((len(languages) + 63) // 64 or 1, size), U)
        rate = np.zeros(len(languages))
        for i, grams in enumerate(sets):
            for at in cls.positions(grams, size):
                slots[i // 64, at] |= U(1) << U(i % 64)
            rate[i] = float(np.count_nonzero(slots[i // 64] >> U(i % 64) & U(1)) / size) ** HASHES
        return cls(languages, slots, rate)

    def masks(self, grams: np.ndarray) -> np.ndarray:
        first, *rest = self.positions(grams, self.slots.shape[1])
        out = self.slots[:, first]
        for at in rest:
            out = out & self.slots[:, at]
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        grams = trigrams(text) if text else np.zeros(0, np.int64)
        if not len(grams) or not self.languages:
            return "und", 0.0
        masks, count = self.masks(grams), np.zeros(len(self.languages))
        for w, row in enumerate(masks):
            values, times = np.unique(row, return_counts=True)
            for i in range(64 * w, min(64 * w + 64, len(self.languages))):
                count[i] = times[(values >> U(i - 64 * w) & U(1)) == 1].sum()
        share = (count / len(grams) - self.false_rate) / (1 - self.false_rate)
        best = int(np.argmax(share))  # languages stand in order of training size: ties go to the larger
        return self.languages[best], float(min(1.0, max(0.0, share[best])))


def fit(rows: DataFrame, share: float = SHARE) -> Filter:
    """Learn from all rows (text, lang); rows with a null in either are left out."""

    def run(batches):
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(parts):
            grams = np.concatenate([g for g, _ in parts])
            keys, at = np.unique(grams, return_inverse=True)
            return keys, np.bincount(at, weights=np.concatenate([n for _, n in parts])).astype(np.int64)

        for batch in batches:
            texts: dict[str, list[np.ndarray]] = {}
            for text, lang in zip(batch.column(0), batch.column(1)):
                texts.setdefault(lang.as_py(), []).append(trigrams(text.as_py()))
            for lang, arrays in texts.items():
                parts = held.setdefault(lang, [])
                parts.append(np.unique(np.concatenate(arrays), return_counts=True))
                if len(parts) >= 16:
                    held[lang] = [merged(parts)]
        for lang, parts in held.items():
            grams, counts = merged(parts)
            for i in range(0, len(grams), 50_000):
                n = len(grams[i : i + 50_000])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), pa.array(grams[i : i + n]), pa.array(counts[i : i + n])], names=["lang", "gram", "n"])

    ready(rows.sparkSession)
    known = rows.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL").mapInArrow(lean(run), "lang string, gram bigint, n bigint")
    counts = known.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rare = F.struct(F.sum("n").alias("total"), F.count("*").alias("grams"))
    counts = counts.persist()
    try:
        total = {r.lang: r.t.total for r in counts.groupBy("lang").agg(rare.alias("t")).collect()}
        floor = F.create_map(*[x for lang, n in total.items() for x in (F.lit(lang), F.lit(share * n))]) if total else None
        kept = counts.where(F.col("n") >= floor[F.col("lang")]).select("lang", "gram").collect() if total else []
    finally:
        counts.unpersist()
    languages = sorted(total, key=lambda x: (-total[x], x))
    sets: dict[str, list[int]] = {x: [] for x in languages}
    for r in kept:
        sets[r.lang].append(r.gram)
    return Filter.build(languages, [np.array(sets[x], dtype=np.int64) for x in languages])


def identify(docs: DataFrame, model: Filter) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row, from the text alone.

    Null texts and texts without a letter: ``und`` with score 0; the same if nothing could be learned.  Repeated rows
    and null ids get a row each; other columns are ignored.
    """
    spark = ready(docs.sparkSession)
    held = spark.sparkContext.broadcast(model)

    def run(batches):
        model = held.value
        for batch in batches:
            found = [model.predict(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = documents(docs).select("doc_id", held_out().alias("held_out"), "text")
    return rows.mapInArrow(lean(run), "doc_id bigint, held_out boolean, lang_pred string, score double")


def learn_and_identify(docs: DataFrame, share: float = SHARE) -> DataFrame:
    """Learn from the rows of docs that are not held out, then label every row."""
    return identify(docs, fit(documents(docs, lang="string").where(~held_out()), share))
