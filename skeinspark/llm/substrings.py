"""Removal of recurring passages with sharded Aho-Corasick automata.

A window is ``span`` consecutive words; every word is removed that lies in a window whose words also start
anywhere else.  Four steps, each over all documents, dealt into blocks of a bounded size:

1. Anchors.  Of each window, the phrase of GRAM words with the smallest hash (the last of equals) is its
   anchor, so equal windows have equal anchors, and only about one phrase in twelve is one.  Anchors are
   counted per block, then over blocks; those that occur once are dropped.
2. Confirmation.  Windows whose anchor recurs are counted the same way, by anchor and window hash together.
   What occurs twice or more is a confirmed recurring window.
3. Automata.  Every block compiles the phrases of the confirmed passages that occur in it into automata of at most
   ``SHARD`` phrases, each with the confirmed windows that it anchors, and streams each of its documents through
   them, so automata stay bounded and each document is streamed once, whatever the corpus.
4. Every occurrence that an automaton reports names its phrase; the windows anchored there that the phrase has among
   its confirmed ones are recurring windows, and their words go.  Words that no occurrence leads to stay.

A passage that very many documents share is one row a block in the shuffles, not one a document.
The texts' one shuffle is the same exchange in all steps, and Spark reuses it.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import documents, ready, trim
from .textnp import OTHER_POWERS, document_words, last_minimum, mix, shingles, signed, unsigned

SPAN = 35
#: Words of an anchor phrase, phrases of an automaton, bytes of text in a block.
GRAM, SHARD, BLOCK_BYTES = 12, 50_000, 3 << 20


def anchors(words: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all phrases, and for each window the position of its anchor."""
    grams = shingles(words, gram)
    return grams, last_minimum(grams, span - gram + 1)


def pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One key for two; used within a block only."""
    with np.errstate(over="ignore"):
        return mix(a * np.uint64(0x9E3779B97F4A7C15) + b)


def count_anchors(block: pa.Table, span: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    found = []
    for words, _, _ in document_words(block.column("text").combine_chunks()):
        grams, at = anchors(words, span, gram)
        if len(at):
            found.append(grams[np.unique(at)])
    return np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def count_windows(block: pa.Table, recurring: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, window hash and count of every window whose anchor recurs."""
    first, second = [], []
    for words, _, _ in document_words(block.column("text").combine_chunks()):
        grams, at = anchors(words, span, gram)
        if not len(at):
            continue
        anchor = grams[at]
        keep = np.flatnonzero(member(anchor, recurring))
        if len(keep):
            first.append(anchor[keep])
            second.append(shingles(words, span, OTHER_POWERS)[keep])
    if not first:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    a, b = np.concatenate(first), np.concatenate(second)
    _, at, n = np.unique(pairs(a, b), return_index=True, return_counts=True)
    return a[at], b[at], n


def member(x: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Whether each x is in the sorted array."""
    if not len(among):
        return np.zeros(len(x), dtype=bool)
    return among[np.minimum(np.searchsorted(among, x), len(among) - 1)] == x


class Automata:
    """Aho-Corasick automata over word numbers, in shards of bounded size; a phrase's value is its place."""

    def __init__(self, phrases: list[tuple[int, ...]]):
        import ahocorasick

        self.shards = []
        for i in range(0, len(phrases), SHARD):
            shard = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
            for j, phrase in enumerate(phrases[i : i + SHARD], i):
                shard.add_word(phrase, j)
            shard.make_automaton()
            self.shards.append(shard)

    def hits(self, words: tuple[int, ...]) -> np.ndarray:
        """(position of the last word, phrase) of all occurrences."""
        return np.array([hit for shard in self.shards for hit in shard.iter(words)], dtype=np.int64).reshape(-1, 2)


def occurrences(words: np.ndarray, at: np.ndarray, hits: np.ndarray, phrases: np.ndarray, confirmed: np.ndarray, span: int, gram: int) -> np.ndarray:
    """Starts of the recurring windows that the hits lead to.

    at: where each window's anchor stands; phrases: the hash of each phrase; confirmed: its windows, as sorted pairs.  A window
    recurs if the automata report a phrase at its anchor and the phrase has the window among its confirmed ones.
    """
    phrase = np.full(len(words), -1, dtype=np.int64)
    phrase[hits[:, 0] - (gram - 1)] = hits[:, 1]
    starts = np.flatnonzero(phrase[at] >= 0)
    if not len(starts):
        return starts
    return starts[member(pairs(phrases[phrase[at[starts]]], shingles(words, span, OTHER_POWERS)[starts]), confirmed)]


def remove(block: pa.Table, anchor: np.ndarray, window: np.ndarray, span: int, gram: int) -> pa.Table:
    """The block's documents, without the words of confirmed windows."""
    texts = block.column("text").combine_chunks()
    docs = [w for w, _, _ in document_words(texts)]
    covered: list[np.ndarray | None] = [None] * len(docs)
    if len(anchor):
        anchor_set, confirmed = np.unique(anchor), np.unique(pairs(anchor, window))
        vocabulary, numbers = np.unique(np.concatenate(docs), return_inverse=True)
        cuts = np.cumsum([0, *map(len, docs)])
        phrases: dict[int, tuple[int, ...]] = {}
        selected = []
        for k, words in enumerate(docs):  # the words of each phrase, from where it first stands
            grams, at = anchors(words, span, gram)
            selected.append(at)
            used = np.unique(at)
            for p in used[member(grams[used], anchor_set)].tolist():
                if (h := int(grams[p])) not in phrases:
                    phrases[h] = tuple(numbers[cuts[k] + p : cuts[k] + p + gram].tolist())
        automata, names = Automata(list(phrases.values())), np.array(list(phrases), dtype=np.uint64)
        for k, words in enumerate(docs):
            if not len(selected[k]):
                continue
            starts = occurrences(words, selected[k], automata.hits(tuple(numbers[cuts[k] : cuts[k + 1]].tolist())), names, confirmed, span, gram)
            if len(starts):
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                edge[starts] += 1
                np.add.at(edge, starts + span, -1)
                covered[k] = np.cumsum(edge[:-1]) > 0
    n_words, n_removed, kept, spans = [], [], [], []
    for text, words, gone in zip(texts, docs, covered):
        own = (text.as_py() or "").encode().split()
        n_words.append(len(own))
        if gone is None:
            n_removed.append(0)
            spans.append([])
        else:
            own = list(itertools.compress(own, ~gone))
            n_removed.append(int(gone.sum()))
            edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
            spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edge[0::2], edge[1::2])])
        kept.append(b" ".join(own).decode())
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.table({"doc_id": block.column("doc_id"), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "spans": pa.array(spans, span_type), "kept": pa.array(kept, pa.string())})


def without_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, spans (word ranges that go), kept (the words left, joined by one space) of every row.

    Null and empty texts: 0 words.  A repeated row is another document, so its windows recur.  Null ids are kept.
    Other columns are ignored.  A block has the documents of one hash value of doc_id and text; a text is never cut.
    """
    ready(docs.sparkSession)
    rows = documents(docs)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, math.ceil(size / block_bytes))
    rows = rows.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).alias("block"), "doc_id", "text")

    def step_anchors(block: pa.Table) -> pa.Table:
        anchor, n = count_anchors(block, span, gram)
        return pa.table({"block": pa.array(np.full(len(anchor), block.column("block")[0].as_py())), "anchor": pa.array(signed(anchor)), "n": pa.array(n)})

    def step_windows(block: pa.Table, recurring: pa.Table) -> pa.Table:
        if not block.num_rows or not recurring.num_rows:
            a = b = np.zeros(0, np.uint64)
            n = np.zeros(0, np.int64)
        else:
            a, b, n = count_windows(block, np.sort(unsigned(recurring.column("anchor").to_numpy())), span, gram)
        number = block.column("block")[0].as_py() if block.num_rows else 0
        return pa.table({"block": pa.array(np.full(len(a), number, dtype=np.int64)), "anchor": pa.array(signed(a)), "window": pa.array(signed(b)), "n": pa.array(n)})

    def step_remove(block: pa.Table, confirmed: pa.Table) -> pa.Table:
        try:
            return remove(block, unsigned(confirmed.column("anchor").to_numpy()), unsigned(confirmed.column("window").to_numpy()), span, gram)
        finally:
            trim()

    times = F.sum("n").over(Window.partitionBy("anchor"))
    recurring = rows.groupBy("block").applyInArrow(step_anchors, "block bigint, anchor bigint, n bigint").withColumn("times", times).where("times > 1").select("block", "anchor")
    counted = rows.groupBy("block").cogroup(recurring.groupBy("block")).applyInArrow(step_windows, "block bigint, anchor bigint, window bigint, n bigint")
    times = F.sum("n").over(Window.partitionBy("anchor", "window"))
    confirmed = counted.withColumn("times", times).where("times > 1").select("block", "anchor", "window")
    out = "doc_id bigint, n_words bigint, n_removed bigint, spans array<struct<start: bigint, end: bigint>>, kept string"
    return rows.groupBy("block").cogroup(confirmed.groupBy("block")).applyInArrow(step_remove, out)
