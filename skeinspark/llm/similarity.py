"""Size-aware heavy-light Jaccard join over word shingles, and the groups it links.

Two sets link when 100 * intersection >= percent * union.  Equal sets are one class, so copies cost one.

Signatures.  Shingles are put in one order, rare before common.  Sets that link share at least l shingles
among the first (size - required overlap + l) of either.  Light sets emit every 2-subset of that prefix
(l = 2); heavy sets are read through inverted lists of its single shingles (l = 1); light sets near the
boundary emit both, as they may link with heavy ones.  The boundary is the size at which the summed cost of
subsets and lists is least.  A fixed-size table of counters, filled from all documents, tells rare
from common; it decides only the order and the cost, never the result.

Candidates.  A list never becomes all its pairs.  Rounds, each on lists that still span several components only:

1. each task, then each bucket, ties the members of a list to the member with the smallest class number; then lists
   are cut where neighbouring sizes cannot link, and members that are alone are left out;
2. as long as comparing in blocks would cost more than WIDE rows an entry, members are tied to another hub, one of
   small hash, if they are not in its component;
3. members are compared across components, but of the candidates a task finds only those go on that tie
   components it has not tied yet, so a list gives fewer candidates than it has members;
4. in the lists where round 3 found or passed over a candidate, all that are left across components go on.

After each round candidates are verified and components merged.  In rounds 3 and 4 the members outside a list's
largest component meet all members, in blocks, so no list is in one task and its largest component is not compared
with itself.  A sketch of parities, a lower bound of the difference, rules most candidates out; the texts of the
others are read again and whole sets intersected.  Rounds 3 and 4 leave out only pairs that the sketch rules out or
that are in one component already, so no link between components is lost.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .runtime import BROADCAST_ROWS, bounded, cut, documents, lean, ready, trim
from .textnp import U, document_words, mix, shingles, signed, unsigned, whole

#: Counters of the frequency table, in SLICES of a row each.
COUNTERS, SLICES = 1 << 22, 64
#: Signatures that a task gathers before it ties them, and that a bucket gets.
FLUSH, BUCKET = 600_000, 300_000
#: Members of a block of a list that spans components, rows of blocks that a task gets.
BLOCK, MEET = 1024, 50_000
#: Pairs of a group up to which they are looked at together with other groups'.
SMALL = 256
#: Rows of blocks for each entry beyond which members are tied to hubs first, and rounds of that at most.
WIDE, HUBS = 8, 16
#: Least bits of the parity sketch that rules candidates out before whole sets are read.
PARITIES = 1024


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct k-word shingles; fewer words are one shingle, none is none."""
    if len(words) >= k:
        return np.unique(shingles(words, k))
    return np.array([whole(words)] if len(words) else [], dtype=U)


def class_of(found: np.ndarray) -> int:
    """A number for a set, whatever the order; 0 for the empty one."""
    with np.errstate(over="ignore"):
        return int(mix(np.array([mix(found ^ U(0x5851F42D4C957F2D)).sum(dtype=U) + U(len(found))], dtype=U)).view(np.int64)[0]) if len(found) else 0


def parities(found: np.ndarray, least: int = 0) -> np.ndarray:
    """For each part of the shingles, whether the set has an odd number of them, 64 parts a long: about 1.5 to 3 parts a shingle, at least PARITIES.

    Sets that differ in n shingles differ in at most n parities. Halves laid over each other (exclusive or) give the parities of half as many parts.
    """
    parts = least or max(PARITIES, 1 << int(1.5 * len(found)).bit_length())
    odd = np.bincount(((found >> U(20)) & U(parts - 1)).astype(np.int64), minlength=parts) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


@dataclass
class Plan:
    percent: int
    boundary: int = 0

    def overlap(self, size: int) -> int:
        """Smallest overlap of a set of this size with any that it links with."""
        return -(-self.percent * size // 100)

    def prefix(self, size: int, common: int) -> int:
        return min(size, size - self.overlap(size) + common)

    def alone(self, size: int) -> bool:
        """No other set can link with one of this size: neither with one more shingle nor with one less."""
        return 100 * size < self.percent * (size + 1) and 100 * (size - 1) < self.percent * size

    def light(self, size: int) -> bool:
        return size <= self.boundary

    def singles(self, size: int) -> bool:
        return size > self.boundary or 100 * size >= self.percent * (self.boundary + 1)

    def cost(self, size: int, penalty: float) -> float:
        p = self.prefix(size, 2)
        return (p * (p - 1) / 2 if self.light(size) else 0.0) + (self.prefix(size, 1) * penalty if self.singles(size) else 0.0)

    @classmethod
    def cheapest(cls, percent: int, sizes: dict[int, int], penalty: float) -> Plan:
        """The boundary with the least total cost; penalty: rows that an inverted list costs for each of its entries."""
        best = cls(percent, 0)
        least = sum(n * best.cost(s, penalty) for s, n in sizes.items())
        for boundary in range(1, 129):
            plan = cls(percent, boundary)
            if (total := sum(n * plan.cost(s, penalty) for s, n in sizes.items())) < least:
                best, least = plan, total
        return best

    def signatures(self, found: np.ndarray, level: np.ndarray) -> np.ndarray:
        size = len(found)
        if not size or self.alone(size):
            return np.zeros(0, dtype=U)
        rank = level[(found & U(COUNTERS - 1)).astype(np.int64)].astype(U) << U(58) | found >> U(6)
        order = found[np.argsort(rank, kind="stable")[: self.prefix(size, 2)]]
        out = []
        with np.errstate(over="ignore"):
            if self.light(size):
                i, j = np.triu_indices(len(order), 1)
                out.append(mix(order[i] * U(0x9E3779B97F4A7C15) ^ mix(order[j])))
            if self.singles(size):
                out.append(mix(order[: self.prefix(size, 1)]))
        return np.concatenate(out)


def tie(sig: np.ndarray, cls: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """Lists of equal signatures: the first (smallest class) entry of each, and (signature, first's place, member's place) of the others."""
    order = np.lexsort((cls, sig))
    sig, cls, size = sig[order], cls[order], size[order]
    if not len(sig):
        return sig, cls, size, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    new = np.concatenate(([True], sig[1:] != sig[:-1]))
    again = np.concatenate(([False], (sig[1:] == sig[:-1]) & (cls[1:] == cls[:-1])))
    head = np.flatnonzero(new)
    first = head[np.cumsum(new) - 1]
    member = np.flatnonzero(~new & ~again)
    return sig, cls, size, first[member], member, new


STAR = "sig bigint, a bigint, b bigint, na bigint, nb bigint"
PAIR = "a bigint, b bigint, na bigint, nb bigint, ra bigint, rb bigint"


def _stars(sig, cls, size, first, member) -> dict:
    return {"sig": pa.array(signed(sig[member])), "a": pa.array(cls[first]), "b": pa.array(cls[member]), "na": pa.array(size[first]), "nb": pa.array(size[member])}


@dataclass
class Join:
    """docs (doc_id, text, mark) linked at ``percent`` over k-word shingles."""

    docs: DataFrame
    k: int
    percent: int

    def members(self) -> tuple[DataFrame, np.ndarray, float]:
        """One row a document (doc_id, mark, n, cls); the level of each counter; the mean list length beyond noise."""
        k = self.k

        def run(batches):
            counts = np.zeros(COUNTERS, dtype=np.uint32)
            waiting, held = [], 0
            for batch in batches:
                n, cls, bits, brief = [], [], [], []
                for words, _, _ in document_words(batch.column(1), lower=True):
                    found = shingle_set(words, k)
                    n.append(len(found))
                    bits.append(parities(found))
                    brief.append(parities(found, PARITIES))
                    cls.append(class_of(found))
                    waiting.append((found & U(COUNTERS - 1)).astype(np.int64))
                    held += len(found)
                    if held > COUNTERS // 2:
                        counts += np.bincount(np.concatenate(waiting), minlength=COUNTERS).astype(np.uint32)
                        waiting, held = [], 0
                size = batch.num_rows
                yield pa.RecordBatch.from_arrays([pa.array([-1] * size, pa.int32()), batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(bits, pa.list_(pa.int64())), pa.array(brief, pa.list_(pa.int64())), pa.nulls(size, pa.binary())], names=names)
            if waiting:
                counts += np.bincount(np.concatenate(waiting), minlength=COUNTERS).astype(np.uint32)
            for i, part in enumerate(counts.reshape(SLICES, -1)):
                if part.any():
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), *(pa.array([None], pa.int64()) for _ in range(4)), *(pa.array([None], pa.list_(pa.int64())) for _ in range(2)), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], names=names)

        names = ["slice", "doc_id", "mark", "n", "cls", "bits", "brief", "blob"]
        both = cut(self.docs.select("doc_id", "text", "mark").mapInArrow(lean(run), "slice int, doc_id bigint, mark bigint, n bigint, cls bigint, bits array<bigint>, brief array<bigint>, blob binary"))
        members = both.where("slice < 0").select("doc_id", "mark", "n", "cls", "bits", "brief")
        total = members.agg(F.sum("n")).first()[0] or 0
        mean = total / COUNTERS

        def add(batches):
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for i, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                    sums[i] = sums.get(i, 0) + np.frombuffer(zlib.decompress(blob.as_py()), dtype=np.uint32).astype(np.int64)
            for i, part in sums.items():
                clear = part > mean + 4 * mean**0.5 + 2
                level = np.where(clear, np.minimum(np.log2(np.maximum(part, 1)).astype(np.int64), 62), 0).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([level.tobytes()], pa.binary()), pa.array([float((part.astype(np.float64) ** 2).sum())], pa.float64())], names=["slice", "level", "squares"])

        level, squares = np.zeros((SLICES, COUNTERS // SLICES), dtype=np.uint8), 0.0
        # a slice's tables meet in one partition and become one row: 4 MB reach the driver at any size of input
        for r in both.where("slice >= 0").select("slice", "blob").repartition(8, "slice").mapInArrow(lean(add), "slice int, level binary, squares double").collect():
            level[r.slice] = np.frombuffer(r.level, dtype=np.uint8)
            squares += r.squares
        beyond = (squares - total * mean - total) / max(1, total)
        return members, level.reshape(-1), min(64.0, max(1.0, 1.0 + beyond))

    def stars(self, plan: Plan, level: np.ndarray, n_buckets: int) -> DataFrame:
        """(sig, a, b, na, nb): every list with two classes or more, tied to its smallest ones."""
        spark, k = self.docs.sparkSession, self.k
        held = spark.sparkContext.broadcast(level)  # COUNTERS bytes

        def run(batches):
            level, seen = held.value, set()
            sigs, classes, sizes, waiting = [], [], [], 0

            def flush():
                sig, cls, size = np.concatenate(sigs), np.repeat(np.array(classes, dtype=np.int64), [len(x) for x in sigs]), np.repeat(np.array(sizes, dtype=np.int64), [len(x) for x in sigs])
                sig, cls, size, first, member, new = tie(sig, cls, size)
                tied = _stars(sig, cls, size, first, member)
                out = [(int(0), np.stack([np.asarray(tied[c], dtype=np.int64) for c in ("sig", "a", "b", "na", "nb")]))] if len(member) else []
                sig, cls, size = sig[new], cls[new], size[new]
                bucket = (sig % U(n_buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1)) if n_buckets < len(order) else None
                edges = [(b, order[cuts[b] : cuts[b + 1]]) for b in range(n_buckets)] if cuts is not None else [(int(bucket[g[0]]), g) for g in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1)]
                parts, blobs, kinds = [], [], []
                for b, at in edges:
                    if len(at):
                        parts.append(b)
                        kinds.append(0)
                        blobs.append(sig[at].tobytes() + cls[at].tobytes() + size[at].astype(np.int32).tobytes())
                for _, rows in out:
                    for i in range(0, rows.shape[1], 200_000):  # already tied: any bucket passes them on
                        parts.append(int(abs(int(rows[0, i])) % n_buckets))
                        kinds.append(1)
                        blobs.append(np.ascontiguousarray(rows[:, i : i + 200_000]).tobytes())
                for i in range(0, len(parts), 64):
                    yield pa.RecordBatch.from_arrays([pa.array(parts[i : i + 64], pa.int64()), pa.array(kinds[i : i + 64], pa.int32()), pa.array(blobs[i : i + 64], pa.binary())], names=["bucket", "kind", "blob"])

            for batch in batches:
                for words, _, _ in document_words(batch.column(0), lower=True):
                    found = shingle_set(words, k)
                    cls = class_of(found)
                    if cls in seen:  # copies of a set that this task has emitted
                        continue
                    seen.add(cls)
                    sig = plan.signatures(found, level)
                    if len(sig):
                        sigs.append(sig)
                        classes.append(cls)
                        sizes.append(len(found))
                        waiting += len(sig)
                    if waiting >= FLUSH:
                        yield from flush()
                        sigs, classes, sizes, waiting = [], [], [], 0
                if len(seen) > 2_000_000:  # only saves work: a class that is emitted again is the same list entry
                    seen = set()
            if sigs:
                yield from flush()

        def meet(bucket: pa.Table) -> pa.Table:
            sig, cls, size, done = [], [], [], []
            for kind, blob in zip(bucket.column("kind").to_pylist(), bucket.column("blob")):
                data = blob.as_py()
                if kind:
                    done.append(np.frombuffer(data, dtype=np.int64).reshape(5, -1))
                    continue
                n = len(data) // 20
                sig.append(np.frombuffer(data, dtype=U, count=n))
                cls.append(np.frombuffer(data, dtype=np.int64, offset=8 * n, count=n))
                size.append(np.frombuffer(data, dtype=np.int32, offset=16 * n, count=n).astype(np.int64))
            out = np.concatenate(done, axis=1) if done else np.zeros((5, 0), np.int64)
            if sig:
                s, c, z, first, member, _ = tie(np.concatenate(sig), np.concatenate(cls), np.concatenate(size))
                tied = np.stack([signed(s[member]), c[first], c[member], z[first], z[member]]) if len(member) else np.zeros((5, 0), np.int64)
                out = np.concatenate((out, tied), axis=1)
            trim()
            return pa.table({name: pa.array(np.ascontiguousarray(row)) for name, row in zip(("sig", "a", "b", "na", "nb"), out)})

        rows = self.docs.select("text").mapInArrow(lean(run), "bucket bigint, kind int, blob binary")
        return rows.groupBy("bucket").applyInArrow(meet, STAR)

    def hubs(self, entries: DataFrame, number: int) -> DataFrame:
        """Pairs (a, b, na, nb, ra, rb) of each list's members with the member of the smallest hash, across components."""
        one = F.min(F.struct(F.xxhash64("c", F.lit(number)).alias("h"), F.col("c").alias("c2"), F.col("n").alias("n2"), F.col("root").alias("r2"))).alias("hub")
        hub = bounded(cut(entries.groupBy("sig").agg(one).select(F.col("sig").alias("of_sig"), "hub.c2", "hub.n2", "hub.r2")))
        fits = 100 * F.least("n", "n2") >= self.percent * F.greatest("n", "n2")
        rows = entries.join(hub, F.col("sig") == F.col("of_sig")).where((F.col("root") != F.col("r2")) & fits)
        first = F.col("c") < F.col("c2")
        pick = lambda x, y: F.when(first, F.col(x)).otherwise(F.col(y))
        return rows.select(pick("c", "c2").alias("a"), pick("c2", "c").alias("b"), pick("n", "n2").alias("na"), pick("n2", "n").alias("nb"), pick("root", "r2").alias("ra"), pick("r2", "root").alias("rb"))

    def fitting(self, entries: DataFrame) -> DataFrame:
        """The entries (sig, c, n, root) of lists that are cut, in order of size, where two neighbours' sizes cannot link, without those then alone.

        Members that link are in one part, as all sizes between theirs fit both; each part gets a signature of its own.
        """
        over = Window.partitionBy("sig").orderBy("n", "c")
        fits = lambda less, more: F.coalesce(100 * less >= self.percent * more, F.lit(False))
        rows = entries.select("sig", "c", "n", "root", fits(F.lag("n").over(over), F.col("n")).alias("below"), fits(F.col("n"), F.lead("n").over(over)).alias("above"))
        first = F.last(F.when(~F.col("below"), F.col("n")), ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, 0))
        return rows.withColumn("first", first).where("below OR above").select(F.xxhash64("sig", "first").alias("sig"), "c", "n", "root")

    def layout(self, entries: DataFrame) -> tuple[DataFrame, int, int]:
        """The largest component and the blocks of each list that spans several; these lists' entries, and the rows that their blocks get."""
        by_root = entries.groupBy("sig", "root").agg(F.count("*").alias("m"))
        size = by_root.groupBy("sig").agg(F.sum("m").alias("m"), F.max(F.struct("m", "root")).alias("top"))
        rest = F.col("m") - F.col("top.m")
        size = cut(size.where(rest > 0).select(F.col("sig").alias("of_sig"), F.col("top.root").alias("top"), "m", rest.alias("rest"), F.ceil(F.col("m") / BLOCK).cast("int").alias("lefts"), F.ceil(rest / BLOCK).cast("int").alias("rights")))
        total, work = size.agg(F.sum("m"), F.sum(F.col("m") * F.col("rights") + F.col("rest") * F.col("lefts"))).first()
        return size, total or 0, work or 0

    def meetings(self, entries: DataFrame, size: DataFrame, work: int, classes: DataFrame) -> DataFrame:
        """Each member of each list that spans several components, with its sketch, for each meeting (sig, x, y) of two blocks that it goes to, and its side.

        Side 0 is left, 1 right; 2, a member on both sides of a list with a single block, is sent once.
        """
        keys = work // MEET + 1
        rows = entries.join(size, F.col("sig") == F.col("of_sig"))
        own = lambda blocks: F.pmod(F.xxhash64("c"), F.col(blocks)).cast("int")
        all_of = lambda blocks: F.sequence(F.lit(0), F.col(blocks) - 1)
        left = F.transform(all_of("rights"), lambda o: F.struct(own("lefts").alias("x"), o.alias("y"), F.lit(0).alias("side")))
        right = F.transform(all_of("lefts"), lambda o: F.struct(o.alias("x"), own("rights").alias("y"), F.lit(1).alias("side")))
        both = F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit(2).alias("side")))
        rows = rows.withColumn("outer", F.col("root") != F.col("top"))
        rows = rows.select("sig", "c", "n", "root", "outer", F.explode(F.when(~F.col("outer"), left).when(F.col("lefts") == 1, both).otherwise(F.concat(left, right))).alias("at"))
        rows = rows.join(classes.select(F.col("cls").alias("c"), F.col("brief").alias("bits")), "c")
        return rows.select(F.pmod(F.xxhash64("sig", "at.x", "at.y"), F.lit(keys)).alias("key"), "sig", "at.x", "at.y", "at.side", "c", "n", "root", "outer", "bits")

    def across(self, entries: DataFrame, size: DataFrame, work: int, classes: DataFrame, forest: bool) -> DataFrame:
        """Pairs (a, b, na, nb, ra, rb) of entries (sig, c, n, root) that share a signature, have different roots and
        sizes that fit, and whose parities do not rule them out; with ``forest`` only those that tie roots not yet tied in
        a task, and besides, in rows without a pair, the sig of each list with a candidate.

        A list's members are its left side, those outside its largest component its right side.  Both are cut into blocks
        of BLOCK members, and each left block meets each right block in some task.  A pair of two right members is looked
        at where the one with the smaller class is on the left.
        """
        percent = self.percent
        rows = self.meetings(entries, size, work, classes)

        def meet(part: pa.Table) -> pa.Table:
            sig, x, y, side, c, n, root, outer = (part.column(k).to_numpy() for k in ("sig", "x", "y", "side", "c", "n", "root", "outer"))
            bits = part.column("bits").combine_chunks().flatten().to_numpy().view(U).reshape(len(c), -1)
            twice = np.flatnonzero(side == 2)
            at = np.concatenate((np.arange(len(c)), twice))
            sig, x, y, c, n, root, outer, bits = (z[at] for z in (sig, x, y, c, n, root, outer, bits))
            side = np.concatenate((side % 2, np.ones(len(twice), side.dtype)))
            distinct, of = np.unique(root, return_inverse=True)
            label = np.arange(len(distinct))  # equal for roots that candidates have tied, in a forest
            order = np.lexsort((side, y, x, sig))
            group = np.concatenate(([0], np.flatnonzero((np.diff(sig[order]) != 0) | (np.diff(x[order]) != 0) | (np.diff(y[order]) != 0)) + 1, [len(c)]))
            lo, nl = group[:-1], np.add.reduceat((side[order] == 0).astype(np.int64), group[:-1]) if len(c) else np.zeros(0, np.int64)
            nr = np.diff(group) - nl
            first, second, again = [], [], []

            def near(i, j):
                """Whether left and right members may link, by roots, sizes and parities."""
                ok = (root[i] != root[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])) & (~outer[i] | (c[j] > c[i]))
                at = np.flatnonzero(ok)
                differ = np.bitwise_count(bits[i[at]] ^ bits[j[at]]).sum(axis=1, dtype=np.int64)
                ok[at] = (100 + percent) * differ <= (100 - percent) * (n[i[at]] + n[j[at]])
                return ok

            # small groups: all their pairs together
            small = np.flatnonzero(nl * nr <= SMALL)
            done = np.concatenate(([0], np.cumsum((nl * nr)[small])))
            cuts = [0]
            while cuts[-1] < len(small):
                cuts.append(max(cuts[-1] + 1, int(np.searchsorted(done, done[cuts[-1]] + 100_000, "right")) - 1))
            for at, until in zip(cuts[:-1], cuts[1:]):
                g = np.repeat(small[at:until], (nl * nr)[small[at:until]])
                t = np.arange(len(g)) - np.repeat(done[at:until] - done[at], (nl * nr)[small[at:until]])
                i, j = order[lo[g] + t // nr[g]], order[lo[g] + nl[g] + t % nr[g]]
                ok = near(i, j)
                g, i, j = g[ok], i[ok], j[ok]
                if forest:
                    again.append(sig[order[lo[np.unique(g)]]])
                    new = np.zeros(len(i), dtype=bool)
                    for k, (x, y) in enumerate(zip(of[i].tolist(), of[j].tolist())):
                        if label[x] != label[y]:
                            new[k] = True
                            label[label == label[y]] = label[x]
                    i, j = i[new], j[new]
                first.append(i)
                second.append(j)

            # others: a left member against all right ones at a time
            for g in np.flatnonzero(nl * nr > SMALL).tolist():
                at = order[group[g] : group[g + 1]]
                lefts, rights, open_list = at[: nl[g]], at[nl[g] :], False
                for i in lefts.tolist():
                    j = rights
                    if forest:
                        tied = label[of[j]] == label[of[i]]
                        open_list |= bool((tied & (root[j] != root[i])).any())
                        j = j[~tied]
                    j = j[near(np.full(len(j), i), j)]
                    if not len(j):
                        continue
                    open_list = True
                    if forest:
                        tied, once = np.unique(label[of[j]], return_index=True)
                        j = j[once]
                        label[np.isin(label, tied)] = label[of[i]]
                    first.append(np.full(len(j), i))
                    second.append(j)
                if forest and open_list:
                    again.append(sig[at[:1]])
            u, v = (np.concatenate(z) if z else np.zeros(0, np.int64) for z in (first, second))
            swap = c[u] > c[v]
            u, v = np.where(swap, v, u), np.where(swap, u, v)
            once = np.unique(np.stack((c[u], c[v])), axis=1, return_index=True)[1] if len(u) else u
            u, v = u[once], v[once]
            trim()
            again = np.unique(np.concatenate([np.zeros(0, np.int64), *again]))
            columns = {k: pa.array(np.concatenate((x, again)), mask=np.arange(len(x) + len(again)) >= len(x)) for k, x in (("a", c[u]), ("b", c[v]), ("na", n[u]), ("nb", n[v]), ("ra", root[u]), ("rb", root[v]))}
            return pa.table(columns | {"sig": pa.array(np.concatenate((c[u], again)), mask=np.arange(len(u) + len(again)) < len(u))})

        return rows.groupBy("key").applyInArrow(meet, f"{PAIR}, sig bigint")

    def linked(self, pairs: DataFrame, classes: DataFrame, every: bool = False) -> DataFrame:
        """The pairs (a, b, na, nb, ra, rb) that link, as (ra, rb), or, without ra and rb, as (a, b); every: most classes are in some pair.

        Parities give a lower bound of how many shingles a pair differs in, and rule out pairs that differ in too many;
        the sets of the others are read again from one document of each class and intersected.
        """
        k, percent = self.k, self.percent
        ends = [c for c in pairs.columns if c in ("ra", "rb")]
        pairs = cut(pairs.distinct())
        nodes = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("need")).distinct()
        known = classes
        if not every and pairs.limit(BROADCAST_ROWS // 2 + 1).count() <= BROADCAST_ROWS // 2:
            known = classes.join(F.broadcast(nodes(pairs)), F.col("cls") == F.col("need"), "left_semi")
        sketch = known.select("cls", "bits")
        pairs = pairs.join(sketch.toDF("a", "bits_a"), "a").join(sketch.toDF("b", "bits_b"), "b")
        half = lambda x: F.zip_with(F.slice(x, 1, (F.size(x) / 2).cast("int")), F.slice(x, (F.size(x) / 2).cast("int") + 1, F.size(x)), lambda u, v: u.bitwiseXOR(v))
        a, b = F.col("bits_a"), F.col("bits_b")  # sizes that fit differ by less than 2, so at most one is halved
        a, b = F.when(F.size(a) > F.size(b), half(a)).otherwise(a), F.when(F.size(b) > F.size(a), half(b)).otherwise(b)
        differ = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
        pairs = cut(pairs.where((100 + percent) * differ <= (100 - percent) * (F.col("na") + F.col("nb"))).select("a", "b", "na", "nb", *ends))
        wanted = classes.join(bounded(cut(nodes(pairs))), F.col("cls") == F.col("need"), "left_semi").select("cls", F.col("doc_id").alias("of_doc"), F.col("mark").alias("of_mark"))
        wanted = bounded(cut(wanted))

        def run(batches):
            for batch in batches:
                sets = [shingle_set(words, k) for words, _, _ in document_words(batch.column(1), lower=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([signed(x) for x in sets], pa.list_(pa.int64()))], names=["cls", "found"])

        texts = self.docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("mark") == F.col("of_mark"))).select("cls", "text")
        sets = texts.mapInArrow(lean(run), "cls bigint, found array<bigint>").dropDuplicates(["cls"])  # rows may repeat a doc_id and a text
        whole_pairs = pairs.join(sets.toDF("b", "found_b"), "b").join(sets.toDF("a", "found_a"), "a")
        inter = F.size(F.array_intersect("found_a", "found_b"))
        return whole_pairs.where(100 * inter >= percent * (F.col("na") + F.col("nb") - inter)).select(*(ends or ("a", "b")))

    def prepare(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """members, classes (a row a set: its first document and sketches) and stars."""
        members, level, penalty = self.members()
        classes = cut(members.where("n > 0").groupBy("cls").agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "mark", "bits", "brief")).alias("of"), F.min("n").alias("n")).select("cls", "n", "of.none", "of.doc_id", "of.mark", "of.bits", "of.brief"))
        # sizes over 256 count as their power of 1.1: the driver gets a few hundred rows
        sizes = classes.groupBy(F.when(F.col("n") <= 256, F.col("n")).otherwise(F.pow(F.lit(1.1), F.round(F.ln("n") / math.log(1.1))).cast("bigint")).alias("n")).agg(F.count("*").alias("classes"))
        sizes = {r.n: r.classes for r in sizes.collect()}
        plan = Plan.cheapest(self.percent, sizes, penalty)
        total = sum(n * plan.cost(s, 1.0) for s, n in sizes.items())
        stars = cut(self.stars(plan, level, max(8, int(total / BUCKET) + 1)))
        return members, classes, stars

    def links(self) -> tuple[DataFrame, DataFrame]:
        """(a, b), a < b: every two classes that link; and (doc_id, mark, n, cls) of every row.

        All members of all lists are compared, in blocks; the pairs follow the links themselves, not the copies.
        """
        members, classes, stars = self.prepare()
        ends = stars.select("sig", F.col("a").alias("c"), F.col("na").alias("n")).union(stars.select("sig", "b", "nb"))
        entries = cut(ends.distinct().withColumn("root", F.col("c")))
        size, _, work = self.layout(entries)
        found = self.linked(self.across(entries, size, work, classes, forest=False).drop("sig"), classes)
        return found.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), members.select("doc_id", "mark", "n", "cls")

    def run(self) -> DataFrame:
        members, classes, stars = self.prepare()
        fits = 100 * F.least("na", "nb") >= self.percent * F.greatest("na", "nb")
        near = stars.where(fits).select("a", "b", "na", "nb")
        roots = components(self.linked(near, classes, every=True))
        # lists that still span several components
        rooted = self._rooted(self._rooted(stars, roots, "a"), roots, "b")
        entries = rooted.join(rooted.where("root_a <> root_b").select("sig").distinct(), "sig", "left_semi")
        end = lambda c: F.struct(F.col(c).alias("c"), F.col(f"n{c}").alias("n"), F.col(f"root_{c}").alias("root"))
        entries = entries.select("sig", F.explode(F.array(end("a"), end("b"))).alias("end")).select("sig", "end.*").distinct()
        entries = cut(self.fitting(entries))  # one shuffle by sig serves the join, distinct and fitting
        steps = [roots]

        def merge(pairs: DataFrame, lists: DataFrame | None = None) -> DataFrame:
            """The entries, of these lists only, with their roots after the pairs' links."""
            steps.append(components(self.linked(pairs, classes).toDF("a", "b")))
            rows = entries if lists is None else entries.join(lists, F.col("sig") == F.col("of_sig"), "left_semi")
            rows = self._rooted(rows.withColumnRenamed("root", "was"), steps[-1], "was").withColumnRenamed("root_was", "root")
            return cut(rows.select("sig", "c", "n", "root"))

        size, count, work = self.layout(entries)
        for number in range(HUBS):
            if work <= WIDE * count:
                break
            before = work
            entries = merge(self.hubs(entries, number))
            size, count, work = self.layout(entries)
            if work > 0.9 * before:
                break
        if count:
            found = cut(self.across(entries, size, work, classes, forest=True))
            entries = merge(found.where("sig IS NULL").drop("sig"), found.where("sig IS NOT NULL").select(F.col("sig").alias("of_sig")).distinct())
            size, count, work = self.layout(entries)
        if count:
            steps.append(components(self.linked(self.across(entries, size, work, classes, forest=False).drop("sig"), classes).toDF("a", "b")))
        owned = classes.select("cls", "none", "doc_id", "mark").withColumn("root", F.col("cls"))
        for step in steps:
            owned = self._rooted(owned.withColumnRenamed("root", "was"), step, "was").withColumnRenamed("root_was", "root").drop("was")
        owned = cut(owned)
        least = owned.groupBy("root").agg(F.min(F.struct("none", "doc_id", "mark")).alias("least"), F.count("*").alias("classes")).where("classes > 1").select(F.col("root").alias("of"), "least")
        found = owned.join(bounded(cut(least)), F.col("root") == F.col("of"), "left")
        found = found.select("cls", F.coalesce("least.doc_id", F.when(F.col("least").isNull(), F.col("doc_id"))).alias("component_id"), F.coalesce("least.mark", "mark").alias("component_mark"))
        own = lambda first, column: F.when(F.col("n") > 0, F.col(first)).otherwise(F.col(column)).alias(first)
        return members.join(found, "cls", "left").select("doc_id", "mark", F.col("n").alias("n_shingles"), own("component_id", "doc_id"), own("component_mark", "mark"))

    @staticmethod
    def _rooted(rows: DataFrame, roots: DataFrame, column: str) -> DataFrame:
        """rows with the root of a class column, itself if it has no link."""
        known = bounded(roots.toDF("node", f"known_{column}"))
        return rows.join(known, F.col(column) == F.col("node"), "left").select(*rows.columns, F.coalesce(f"known_{column}", column).alias(f"root_{column}"))


def links(docs: DataFrame, k: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """All links: (a, b) of classes of equal sets that link, and (doc_id, mark, n, cls) of every row.

    Rows without words have class 0 and no link; other rules as for ``groups``.  The result may grow with the square of a
    family of texts that all link; ``groups`` does not.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be over 50 and at most 100")
    ready(docs.sparkSession)
    return Join(documents(docs).withColumn("mark", F.xxhash64("text")), k, percent).links()


def groups(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, mark (text hash), n_shingles, component_id (smallest doc_id reachable by links) and component_mark of every row.

    Words are lower-cased in A-Z.  Null, empty and blank texts have an empty set and are linked with nothing; their
    component is their own doc_id.  Repeated rows are copies of each other.  A null doc_id is never the smallest
    unless a component has no other.  component_mark is the smallest text hash under component_id in the component:
    the two tell its first text from others under the same, or no, doc_id.  Other columns are ignored.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be over 50 and at most 100")
    ready(docs.sparkSession)
    rows = documents(docs).withColumn("mark", F.xxhash64("text"))
    return Join(rows, k, percent).run()
