"""Token counts with prefix tables.

The exact token count of every prefix follows a recurrence over the text: with b the last boundary at or before i,
``count[i] = count[b] + tokens(text[b:i])``.  A boundary is a place across which the tokenizer never joins, so the value
at b is the count of a shorter prefix that is already stored, and only the short tail is new.  A prefix table keeps
(end offset, count) at every boundary: the total, the count of a stored prefix and the longest stored prefix within a
budget are then read by binary search, and nothing is encoded again.  Only a prefix that ends inside a run of
non-blanks needs the tokens of that run's beginning.

Where a tokenizer's tokens never span blanks (``blank_safe``, tried on loading), boundaries are the ends of runs of
non-blanks, and runs are counted once and memoised, within a bound, per Python worker.  Other tokenizers files, and
sentencepiece models, encode a text once, whole, and take the boundaries of their own words.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import documents, lean, ready
from .textnp import word_bounds

#: Runs whose counts a worker remembers, and the longest run that is remembered.
MEMO, MEMO_BYTES = 1_000_000, 64
#: Bytes of one text that are split at a time.
PIECE = 1 << 22
#: Entries of prefix tables that a batch of rows gathers.
ENTRIES = 1 << 20


#: What stands between runs that are encoded together, and how many are.
SIGN, TOGETHER = "|", 256
#: Texts on which a tokenizer shows whether it joins across blanks.
PROBES = ("a b", " a  b ", "don't  stop", "x\ny\tz", "one, two; 3 4", "The\n\n end .", "é à\u0301 中 文", "a\x0bb\x0cc", "<|endoftext|> a <|endoftext|>", "<s> a </s> b", "1 000 000", "'s 's", "it 's", "() [] {}")


class Counter:
    """Counts tokens of runs of non-blanks with a tokenizers file; special strings in a text count as the library's default has it."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memo: dict[bytes, int] = {}
        # words of ASCII letters add up with the punctuation after them, and letters' case says nothing
        self.splits = all(self.whole(a.lower()) + self.whole(b) == self.whole(a + b) for a, b in itertools.product(("Word", "a", "ENGINE", "don", "s"), (".", ",", "...", "!?", ";:")))

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def blank_safe(self) -> bool:
        """Whether tokens never span ASCII blanks, on all PROBES and their prefixes."""
        return all(self.whole(t) == sum(self.whole(x.decode()) for x in t.encode().split()) for probe in PROBES for t in (probe[:i] for i in range(1, len(probe) + 1)))

    def lengths(self, texts: list[str]) -> list[int]:
        """Tokens of each text without blanks, many texts to an encoding: between them stands a sign that is one token and that none of them has."""
        mark = self.tokenizer.encode(SIGN, add_special_tokens=False).ids
        if len(mark) != 1 or not getattr(self, "runs", False) or any(SIGN in x for x in texts):
            return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        groups = [texts[i : i + TOGETHER] for i in range(0, len(texts), TOGETHER)]
        out: list[int] = []
        for e in self.tokenizer.encode_batch_fast([f" {SIGN} ".join(g) for g in groups], add_special_tokens=False):
            ids = np.array(e.ids)
            out += (np.diff(np.flatnonzero(ids == mark[0]), prepend=-1, append=len(ids)) - 1).tolist()
        return out

    def table(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ends, in code points, of the pre-tokenizer's words that end with a non-blank, and the count of the prefix up to each, from one encoding."""
        found = self.tokenizer.encode(text, add_special_tokens=False)
        words, ends = found.word_ids, [end for _, end in found.offsets]
        last = [i for i in range(len(ends)) if i + 1 == len(ends) or (words[i + 1] != words[i] or words[i] is None) and not text[ends[i] - 1].isspace()]
        return np.array([ends[i] for i in last], dtype=np.int64), np.array([i + 1 for i in last], dtype=np.int64)

    def count(self, runs: list[bytes]) -> list[int]:
        memo = self.memo
        if new := set(runs).difference(memo):
            if len(memo) + len(new) > MEMO:
                memo = self.memo = {}
                new = set(runs)
            # ASCII letters and a run of plain punctuation after them are words of their own for the pre-tokenizer,
            # which also lower-cases: their counts add up
            parts = {}
            for r in new:
                core = r.rstrip(b".,!?;:") if self.splits else b""
                parts[r] = (core.lower(), r[len(core) :]) if core.isalpha() else (r, b"")
            need = [x for x in {x for p in parts.values() for x in p} if x not in memo]
            memo.update(zip(need, self.lengths([x.decode() for x in need])))
            for r, (core, tail) in parts.items():
                memo[r] = memo[core] + memo[tail] if tail else memo[core]
        out = list(map(memo.__getitem__, runs))
        for r in new:
            if len(r) > MEMO_BYTES:
                memo.pop(r, None)
        return out


class Pieces:
    """Prefix tables with a sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def whole(self, text: str) -> int:
        return len(self.model.encode(text, num_threads=1))

    def table(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ends, in code points, of the pieces after which a new word begins, and the count of the prefix up to each, from one encoding."""
        if not text:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        found = self.model.encode(text, return_type="proto", num_threads=1).pieces
        last = [i for i in range(len(found)) if i + 1 == len(found) or found[i + 1].piece.startswith("\u2581") and found[i].piece.strip("\u2581")]
        points = np.cumsum((np.frombuffer(text.encode(), dtype=np.uint8) & 0xC0) != 0x80)  # pieces' ends are in bytes
        return points[np.array([found[i].end for i in last], dtype=np.int64) - 1], np.array([i + 1 for i in last], dtype=np.int64)


def counter_of(path: str) -> Counter | Pieces:
    """The counter of a tokenizers file (.json) or sentencepiece model (.model); other files are refused."""
    if path.endswith(".model"):
        return Pieces(path)
    if not path.endswith(".json"):
        raise ValueError(f"neither a tokenizers file nor a sentencepiece model: {path}")
    counter = Counter(path)
    counter.runs = counter.blank_safe()
    return counter


def pieces(data: bytes) -> Iterator[bytes]:
    """data in pieces of about PIECE bytes, cut where a blank stands."""
    at = 0
    while len(data) - at > PIECE:
        end = at + PIECE
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield data[at:end]
        at = end
    yield data[at:] if at else data


def prefix_table(counter: Counter | Pieces, text: str | bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ends, in code points, of the text's prefixes up to each boundary, and the token count of each; with a blank-safe tokenizer built a piece at a time."""
    if not getattr(counter, "runs", False):
        return counter.table(text if isinstance(text, str) else text.decode())
    ends, counts, at, done = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0, 0
    for piece in pieces(text.encode() if isinstance(text, str) else text):
        data = np.frombuffer(piece, dtype=np.uint8)
        stops = word_bounds(data)[1]
        points = None if piece.isascii() else np.cumsum((data & 0xC0) != 0x80)  # code points up to each byte
        if len(stops):
            ends.append(at + (stops if points is None else points[stops - 1]))
            counts.append(done + np.cumsum(np.array(counter.count(piece.split()), dtype=np.int64)))
            done = int(counts[-1][-1])
        at += len(piece) if points is None else int(points[-1])
    return np.concatenate(ends), np.concatenate(counts)


def total(counter: Counter | Pieces, text: str | bytes) -> int:
    counts = prefix_table(counter, text)[1]
    return int(counts[-1]) if len(counts) else 0


def within(ends: np.ndarray, counts: np.ndarray, budget: int) -> tuple[int, int]:
    """(code points, tokens) of the longest stored prefix of at most ``budget`` tokens, by binary search; nothing is encoded."""
    k = int(np.searchsorted(counts, budget, "right"))
    return (int(ends[k - 1]), int(counts[k - 1])) if k else (0, 0)


def windows(ends: np.ndarray, counts: np.ndarray, budget: int) -> list[tuple[int, int]]:
    """(start, end), in code points, of pieces of at most ``budget`` tokens by the table, cut at boundaries; a longer run stands alone.  Nothing is encoded."""
    out, start, done, k = [], 0, 0, 0
    while k < len(ends):
        j = max(k + 1, int(np.searchsorted(counts, done + budget, "right")))
        out.append((start, int(ends[j - 1])))
        start, done, k = int(ends[j - 1]), int(counts[j - 1]), j
    return out


def tokens_at(counter: Counter, text: str, ends: np.ndarray, counts: np.ndarray, i: int) -> int:
    """Exact token count of text[:i] with a blank-safe tokenizer: from the table alone at a boundary, else with the beginning of one run."""
    k = int(np.searchsorted(ends, i, "right"))
    done = int(counts[k - 1]) if k else 0
    tail = text[int(ends[k - 1]) if k else 0 : i].encode().split()
    return done + sum(counter.count(tail)) if tail else done


def prefix_counts(counter: Counter, text: str, ends: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The count of every prefix, from the empty one to the whole text."""
    return np.array([tokens_at(counter, text, ends, counts, i) for i in range(len(text) + 1)], dtype=np.int64)


def longest_prefix(counter: Counter, text: str, ends: np.ndarray, counts: np.ndarray, budget: int) -> int:
    """Code points of the longest prefix of at most ``budget`` tokens, with a blank-safe tokenizer.

    Whole runs come from the table.  Inside the run that breaks the budget, a longer beginning may have fewer tokens than
    a shorter one, so beginnings are looked at from the longest down, up to MEMO_BYTES characters of it; a longer run is
    cut at its start, as ``within`` cuts it.
    """
    k = int(np.searchsorted(counts, budget, "right"))
    if k == len(ends):
        return len(text)
    start = int(ends[k - 1]) if k else 0
    if int(ends[k]) - start <= MEMO_BYTES:
        for i in range(int(ends[k]) - 1, start, -1):
            if tokens_at(counter, text, ends, counts, i) <= budget:
                return i
    return start


def token_counts(docs: DataFrame, path: str, limit: int = 2048, tables: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row, from its prefix table; with ``tables`` also the table: prefix_ends and prefix_tokens (arrays of bigint).

    path: a tokenizers file (.json) or a sentencepiece model (.model).  Null and empty texts: 0 bytes, 0 tokens.  Repeated
    rows and null ids: a row each.  Other columns of docs are ignored.  One narrow pass; texts are split in pieces, memory follows one batch, ENTRIES and the largest table, and the memo.
    """
    ready(docs.sparkSession)
    schema = "doc_id bigint, n_bytes bigint, n_tokens bigint" + ", prefix_ends array<bigint>, prefix_tokens array<bigint>" * tables

    def run(batches):
        counter = counter_of(path)

        def rows(ids, n_bytes, n_tokens, ends, counts):
            arrays = [ids, pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())]
            names = ["doc_id", "n_bytes", "n_tokens"]
            if tables:
                cuts = pa.array(np.cumsum([0, *map(len, ends)]), pa.int32())
                arrays += [pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(x), pa.int64())) for x in (ends, counts)]
                names += ["prefix_ends", "prefix_tokens"]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            column = batch.column(1).cast(pa.binary() if pa.types.is_string(batch.column(1).type) else pa.large_binary())
            first, held, n_bytes, n_tokens, ends, counts = 0, 0, [], [], [], []
            for i, x in enumerate(column):
                data = x.as_py() or b""
                e, c = prefix_table(counter, data)
                n_bytes.append(len(data))
                n_tokens.append(int(c[-1]) if len(c) else 0)
                if tables:
                    ends.append(e)
                    counts.append(c)
                    held += len(e)
                if held >= ENTRIES or i + 1 == len(column):
                    yield rows(batch.column(0).slice(first, i + 1 - first), n_bytes, n_tokens, ends, counts)
                    first, held, n_bytes, n_tokens, ends, counts = i + 1, 0, [], [], [], []

    return documents(docs).mapInArrow(lean(run), schema).withColumn("over_limit", F.col("n_tokens") > limit)
