"""Benchmark passages in documents, by SimHash over item-sized windows.

A window has as many words as the item it is compared with.  Windows that could be similar enough at all -
enough of their shingles occur in items of that size - get a 64-bit SimHash of their weighted shingles.
A multi-index over four 16-bit blocks finds every item fingerprint within RADIUS bits: two fingerprints
that near differ by at most RADIUS // 4 bits in some block, and all block values that near are looked up.
Candidates are verified by exact weighted Jaccard similarity of the shingles, weights being counts.

The benchmark is the query set: it is read in slices of at most ``SLICE_ITEMS`` items and each slice is held
against all documents in one narrow pass, without a shuffle; the driver has one slice at a time.
"""

from __future__ import annotations

import itertools
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import documents, lean, only, pick, ready
from .textnp import U, document_words, mix, shingles

SHINGLE, SIMILARITY, RADIUS, SLICE_ITEMS = 5, 0.8, 19, 20_000
BLOCKS, BLOCK_BITS = 4, 16
#: Windows of one text that are fingerprinted at a time.
PRINTS = 1 << 14
_BITS = np.arange(64, dtype=np.uint64)


def bit_signs(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of each hash."""
    return ((hashes[:, None] >> _BITS) & U(1)).astype(np.int8) * np.int8(2) - np.int8(1)


def simhashes(found: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """SimHash of each run of ``width`` shingles; a shingle weighs as often as it occurs."""
    sums = np.zeros((len(found) + 1, 64), dtype=np.int32)
    np.cumsum(bit_signs(mix(found)), axis=0, dtype=np.int32, out=sums[1:])
    bits = (sums[starts + width] - sums[starts] > 0).astype(np.uint64)
    return (bits << _BITS).sum(axis=1, dtype=np.uint64)


def near_values(radius: int) -> np.ndarray:
    """All block values within radius bits of 0."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in itertools.combinations(range(BLOCK_BITS), r)], dtype=np.int64)


class Index:
    """Multi-index over fingerprints."""

    def __init__(self, fingerprints: np.ndarray, radius: int):
        self.fingerprints, self.radius, self.near = fingerprints, radius, near_values(radius // BLOCKS)
        self.heads, self.items = [], []
        for b in range(BLOCKS):
            value = self.block(fingerprints, b)
            order = np.argsort(value, kind="stable")
            self.items.append(order)
            self.heads.append(np.searchsorted(value[order], np.arange((1 << BLOCK_BITS) + 1)))

    @staticmethod
    def block(x: np.ndarray, b: int) -> np.ndarray:
        return ((x >> U(b * BLOCK_BITS)) & U((1 << BLOCK_BITS) - 1)).astype(np.int64)

    def within(self, fingerprint: int) -> np.ndarray:
        """Places of all fingerprints within the radius, each once."""
        found = []
        one = np.array([fingerprint], dtype=U)
        for b in range(BLOCKS):
            values = self.block(one, b)[0] ^ self.near
            heads = self.heads[b]
            values = values[heads[values + 1] > heads[values]]
            found.extend(self.items[b][heads[v] : heads[v + 1]] for v in values.tolist())
        if not found:
            return np.zeros(0, np.int64)
        places = np.unique(np.concatenate(found))
        return places[np.bitwise_count(self.fingerprints[places] ^ one) <= self.radius]


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of smaller over sum of larger counts of the shingles in either."""
    keys, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = np.bincount(at[: len(a)], minlength=len(keys)), np.bincount(at[len(a) :], minlength=len(keys))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum()) if len(keys) else 0.0


class Benchmark:
    """Items (id, text) ready to be searched for."""

    def __init__(self, items: list[tuple[int, str]], similarity: float = SIMILARITY, radius: int = RADIUS):
        self.similarity = similarity
        column = pa.array([t for _, t in items], pa.string())
        self.groups: dict[int, tuple[int, list[int], list[np.ndarray], Index]] = {}
        self.own: dict[int, np.ndarray] = {}
        by_length: dict[int, list[tuple[int, np.ndarray]]] = {}
        for (item, _), (words, _, _) in zip(items, document_words(column, lower=True)):
            if len(words):
                by_length.setdefault(len(words), []).append((item, shingles(words, min(SHINGLE, len(words)))))
        for length, found in sorted(by_length.items()):
            prints = np.concatenate([simhashes(s, np.zeros(1, np.int64), len(s)) for _, s in found])
            self.own[length] = np.unique(np.concatenate([s for _, s in found]))
            self.groups[length] = (min(SHINGLE, length), [i for i, _ in found], [s for _, s in found], Index(prints, radius))
        self.known = {k: np.unique(np.concatenate([s for kk, _, ss, _ in self.groups.values() if kk == k for s in ss])) for k in {g[0] for g in self.groups.values()}}
        self.filter = {}
        for k, values in self.known.items():
            bits = np.zeros(1 << max(16, int(16 * len(values)).bit_length()), dtype=bool)
            bits[(values & U(len(bits) - 1)).astype(np.int64)] = True
            self.filter[k] = bits

    def known_shingles(self, words: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """All k-word shingles, and places of those that the benchmark has."""
        found = shingles(words, k)
        bits, known = self.filter[k], self.known[k]
        at = np.flatnonzero(bits[(found & U(len(bits) - 1)).astype(np.int64)])
        return found, at[known[np.minimum(np.searchsorted(known, found[at]), len(known) - 1)] == found[at]]

    def search(self, words: np.ndarray) -> list[tuple[int, int, int, float]]:
        """(item, first word, words, similarity) of the best window of each item that is similar enough."""
        out: dict[int, tuple[int, int, float]] = {}
        ready = {k: self.known_shingles(words, k) for k in self.known}
        for length, (k, items, sets, index) in self.groups.items():
            found, hits = ready[k]
            if not len(hits):
                continue
            width = min(length - k + 1, len(found))  # a document shorter than the item is one window
            need = math.ceil(self.similarity * (length - k + 1) - 1e-9)
            if len(hits) < need:
                continue
            own = self.own[length]
            hits = hits[own[np.minimum(np.searchsorted(own, found[hits]), len(own) - 1)] == found[hits]]
            if len(hits) < need:
                continue
            # starts of windows that hold enough shingles of items of this length
            if not (hits[need - 1 :] - hits[: len(hits) - need + 1] < width).any():
                continue
            total = np.zeros(len(found) + 1, dtype=np.int64)
            total[hits + 1] = 1
            total = np.cumsum(total)
            starts = np.flatnonzero(total[width:] - total[: len(total) - width] >= need)
            runs = [part for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1) for part in np.split(run, range(PRINTS, len(run), PRINTS))]
            for run in runs:
                if not len(run):
                    continue
                base = int(run[0])
                prints = simhashes(found[base : int(run[-1]) + width], run - base, width)
                for start, fingerprint in zip(run.tolist(), prints.tolist()):
                    for place in index.within(fingerprint).tolist():
                        score = weighted_jaccard(found[start : start + width], sets[place])
                        if score >= self.similarity and score > out.get(items[place], (0, 0, 0.0))[2]:
                            out[items[place]] = (start, width + k - 1, score)
        return [(i, *x) for i, x in sorted(out.items())]


def slices(benchmark: DataFrame, rows: int = SLICE_ITEMS) -> Iterator[list[tuple[int | None, str]]]:
    """The items in lists of about ``rows``, one list at a time, by a hash of id and text; null texts are left out."""
    items = pick(benchmark, item_id="bigint", text="string").where("text IS NOT NULL").distinct()
    n = max(1, math.ceil(items.count() / rows))
    for i in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).collect()
        yield sorted(((r.item_id, r.text) for r in part), key=lambda x: (x[0] is None, x[0] or 0, x[1]))


_INDEXED: dict[str, Benchmark] = {}


def indexed(name: str, held, similarity: float, radius: int) -> Benchmark:
    """The broadcast items of this name, indexed once a Python worker, which holds one index."""
    if name not in _INDEXED:
        _INDEXED.clear()
        _INDEXED[name] = Benchmark(held.value, similarity, radius)
    return _INDEXED[name]


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, word_start, n_words, similarity): the best window of every item found in a document.

    Null and blank texts hold nothing; repeated rows and null ids of documents are searched like any other; items that
    repeat under one id are one, those without an id too, and are reported with a null item_id; other columns are ignored.
    An empty benchmark finds nothing.  Very long texts are searched whole, PRINTS sums at a time.
    """
    spark = ready(docs.sparkSession)
    out = None
    for items in slices(benchmark):
        held, name = spark.sparkContext.broadcast(items), uuid.uuid4().hex  # at most about SLICE_ITEMS items

        def run(batches, held=held, name=name):
            bench = indexed(name, held, similarity, radius)
            for batch in batches:
                rows = []
                for doc, (words, _, _) in zip(batch.column(0).to_pylist(), document_words(batch.column(1), lower=True)):
                    rows += [(doc, *x) for x in bench.search(words)] if len(words) and bench.groups else []
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["doc_id", "item_id", "word_start", "n_words", "similarity"])

        found = documents(docs).mapInArrow(lean(run), "doc_id bigint, item_id bigint, word_start bigint, n_words bigint, similarity double")
        out = found if out is None else out.unionByName(found)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """The rows of docs, all columns as they were, in whose text no item is found.

    Null and blank texts stay; repeated rows fare alike; columns whose names clash are kept.
    """
    spark = ready(docs.sparkSession)
    for items in slices(benchmark):
        held, name = spark.sparkContext.broadcast(items), uuid.uuid4().hex

        def keep(held=held, name=name):
            bench = indexed(name, held, similarity, radius)
            return lambda column: [not (len(words) and bench.groups and bench.search(words)) for words, _, _ in document_words(column, lower=True)]

        docs = only(docs, keep)
    return docs
