import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skeinspark.llm import chat, components, decontamination, langid, mixing, quality, queries, runtime, secrets, similarity, substrings, textnp, tokens, toxicity

from . import brute

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, texts, source="s", lang="en"):
    return spark.createDataFrame([(i, t, lang, source if isinstance(source, str) else source[i], len(t) if t is not None else None) for i, t in enumerate(texts)], DOCS)


def odd(spark):
    """Nulls in every column, empty and blank texts, a very long one, repeated rows, and columns whose names clash."""
    long = " ".join(f"w{i % 5000}" for i in range(60_000))
    rows = [(1, None, "en", "a"), (2, "", None, None), (3, " \t\n\x0b ", "en", "a"), (None, "one two three four five six seven eight nine ten eleven", "en", "a"), (4, long, "en", None), (5, "naïve café ☕ 中文字", "fr", "b"), (5, "naïve café ☕ 中文字", "fr", "b"), (6, "x", None, "b")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    return df.selectExpr("*", "'q' AS n_words", "1 AS TEXT", "'z' AS score", "2 AS cls", "3 AS host", "'m' AS mark")


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


# ---- text primitives ------------------------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB é中 \n\t\x1c "), max_size=30), max_size=8))
def test_document_words(texts):
    column = pa.array([*texts, None])
    known = {}
    for text, (hashes, starts, ends) in zip([*texts, ""], textnp.document_words(column)):
        own = brute.words(text)
        assert [text.encode()[a:b].decode() for a, b in zip(starts, ends)] == own
        for w, h in zip(own, hashes.tolist()):
            assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = " ".join(f"word{i}" for i in range(3000))
    whole = list(textnp.document_words(pa.array([text, "b c"])))
    monkeypatch.setattr(textnp, "PIECE", 100)
    parts = list(textnp.document_words(pa.array([text, "b c"])))
    assert all((a[0] == b[0]).all() and (a[1] == b[1]).all() for a, b in zip(whole, parts))


def test_sliced_arrays():
    column = pa.array(["a b", None, "c", "d e f"])[1:]
    assert [len(w) for w, _, _ in textnp.document_words(column)] == [0, 1, 3]


# ---- 1 toxicity -----------------------------------------------------------------------------------------------------


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([0.0, 0.0, 1.0, 2.5, -1.0, 0.625]), max_size=24))
def test_segments_are_the_maximal_ones(gains):
    found = toxicity.segments([(i, g) for i, g in enumerate(gains) if g], 0.25)
    assert [(a, b) for a, b, _ in found] == brute.segments([g - 0.25 for g in gains])
    assert all(abs(s - sum(g - 0.25 for g in gains[a:b])) < 1e-9 for a, b, s in found)


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.passages(docs, toxicity.fit(docs, labels)).where("held_out").join(labels, "doc_id")
    r = {(x.toxic, x.predicted): x["count"] for x in scored.groupBy("toxic", "predicted").count().collect()}
    assert r[1, 1] / (r[1, 1] + r.get((0, 1), 0)) > 0.85 and r[1, 1] / (r[1, 1] + r[1, 0]) > 0.75


def test_toxicity_passage_is_found(spark):
    rng = random.Random(1)
    rows = [(i, words(rng, 60) + (" vile nasty foul " if i % 3 == 0 else "")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.passages(docs, model).collect()}
    assert got[0].passages[0][:2] == (60, 63) and got[0].predicted == 1 and got[1].predicted == 0 and got[1].passages == []
    kept = toxicity.keep_clean(docs.withColumn("score", F.lit("x")), model)
    assert kept.columns == ["doc_id", "text", "score"] and {r.doc_id for r in kept.collect()} == {i for i, _ in rows if i % 3}


def test_toxicity_edges(spark):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (4, 7)], "doc_id bigint, toxic int")
    for known in (none, labels):
        rows = toxicity.passages(odd(spark), toxicity.fit(odd(spark), known)).collect()
        assert len(rows) == 8 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert toxicity.passages(odd(spark).limit(0), toxicity.Model()).count() == 0


# ---- 2 decontamination ----------------------------------------------------------------------------------------------


def test_multi_index_finds_all_within_radius():
    rng = np.random.default_rng(0)
    prints = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    index = decontamination.Index(prints, 19)
    for p in prints[:40].tolist():
        q = p
        for b in rng.choice(64, 17, replace=False):
            q ^= 1 << int(b)
        wanted = np.flatnonzero(np.bitwise_count(prints ^ np.uint64(q)) <= 19)
        assert index.within(q).tolist() == wanted.tolist()


def test_leaks(spark):
    rng = random.Random(2)
    items = [words(rng, n, 5000) for n in (30, 45, 60, 3)]
    near = items[2].split()
    near[30] = "changed"
    texts = [words(rng, 100, 5000) + " " + items[0] + " " + words(rng, 50, 5000), items[1].upper(), words(rng, 200, 5000), " ".join(near), words(rng, 80, 5000) + " " + " ".join(items[1].split()[:20]), "x " + items[3] + " y"]
    bench = spark.createDataFrame([*enumerate(items), (9, None), (None, "a b c")], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): r for r in decontamination.leaks(frame(spark, texts), bench).collect()}
    assert set(got) == {(0, 0), (1, 1), (3, 2), (5, 3)}
    assert got[0, 0].word_start == 100 and got[0, 0].n_words == 30 and got[0, 0].similarity == 1.0 and 0.8 <= got[3, 2].similarity < 1
    kept = decontamination.without_leaks(frame(spark, texts), bench)
    assert {r.doc_id for r in kept.collect()} == {2, 4} and kept.columns == [c.split()[0] for c in DOCS.split(", ")]


def test_leaks_match_brute_force(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    found = {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, bench).collect()}
    items = [(r.item_id, brute.words(r.text, True)) for r in bench.collect()]
    wanted = set()
    for r in docs.collect():
        w = brute.words(r.text, True)
        five = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        for item, v in items:
            own = {tuple(v[i : i + 5]) for i in range(len(v) - 4)}
            n = len(v) - 4
            if len(own & set(five)) < 0.8 * len(own):
                continue
            for s in range(max(1, len(five) - n + 1)):
                a, b = five[s : s + n], [tuple(v[i : i + 5]) for i in range(n)]
                both = sum(min(a.count(x), b.count(x)) for x in set(a))
                if both >= 0.8 * (len(a) + len(b) - both):
                    wanted.add((r.doc_id, item))
    assert found == wanted and wanted


@pytest.mark.parametrize("length", [13, 20, 40, 100, 300])
@pytest.mark.parametrize("kind", ["tail", "insert", "delete", "scatter"])
def test_recall_near_the_threshold(length, kind):
    """Items of each length, changed as far as the similarity allows, inside longer texts: nearly all are found."""
    rng = random.Random(f"{length} {kind}")
    items = [(i, words(rng, length, 10**6)) for i in range(60)]
    bench, found, wanted = decontamination.Benchmark(items), 0, 0
    for i, text in items:
        w = text.split()
        best = None
        for n in range(1, length):  # the largest change that keeps a window of the item's size similar enough
            v = list(w)
            if kind == "tail":
                v[length - n :] = [f"t{x}" for x in range(n)]
            elif kind == "delete":
                v[length // 2 : length // 2 + n] = []
            else:
                for x in range(n):
                    at = rng.randrange(1, len(v))
                    v[at : at + (kind == "scatter")] = [f"t{x}"]
            around = words(rng, 200, 10**6).split() + v + words(rng, 200, 10**6).split()
            hashes = next(textnp.document_words(pa.array([" ".join(around)]), lower=True))[0]
            item = textnp.shingles(next(textnp.document_words(pa.array([text]), lower=True))[0], 5)
            every = textnp.shingles(hashes, 5)
            if max(decontamination.weighted_jaccard(every[s : s + len(item)], item) for s in range(190, 215)) < 0.8:
                break
            best = hashes
        if best is not None:
            wanted += 1
            found += any(x[0] == i for x in bench.search(best))
    assert found >= 0.95 * wanted, (found, wanted)


def test_leaks_edges(spark):
    empty = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.leaks(odd(spark), empty).count() == 0
    twice = spark.createDataFrame([(1, "one two three four five six seven")] * 2, "item_id bigint, text string")
    assert [(r.doc_id, r.item_id) for r in decontamination.leaks(odd(spark), twice).collect()] == [(None, 1)]


# ---- 3 quality ------------------------------------------------------------------------------------------------------


def test_base_rules(spark):
    rng = random.Random(3)
    texts = [words(rng, 40, 8), "a b c d e a b c d e", "x " * 30, "l1 a\nl2\n\nl1 a\n \nl1 a", None, "", "#$ %& | <> *", words(rng, 300, 20) + "\n" + words(rng, 30, 3)]
    got = {r.doc_id: r for r in quality.quality(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality(t)


def test_base_rules_on_data(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in quality.quality(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality(text[r.doc_id])


def test_line_frequency(spark):
    rng = random.Random(4)
    menu = "home about contact terms privacy help login sign up today"
    texts = [f"{words(rng, 30)}\n{menu.upper()}\n{words(rng, 30)}" for _ in range(30)]  # keep most of their words
    texts += [f"{menu}\n{words(rng, 8, 9999)}" for _ in range(5)]  # depleted
    copy = "\n".join(words(rng, 12) for _ in range(5))
    texts += [copy] * 15  # fewer than the limit
    got = {r.doc_id: r for r in quality.quality(frame(spark, texts)).collect()}
    assert all(got[i].n_line_words == 10 and got[i].kept for i in range(30))
    assert all(got[i].n_line_words == 10 and not got[i].kept and not got[i].base_failed for i in range(30, 35))
    assert all(got[i].kept and got[i].n_line_words == 0 for i in range(35, 50))
    other = quality.quality(frame(spark, texts, source=[f"h{i}" for i in range(len(texts))]))
    assert other.where("n_line_words > 0").count() == 0


def test_verdicts_match_brute_force(spark, sf):
    rng = random.Random(9)
    lines = [words(rng, rng.randrange(1, 12), 30) for _ in range(40)]
    rows = [(i, ("a", "b", None)[i % 3], "\n".join(rng.choice(lines) if rng.random() < 0.4 else words(rng, 9, 9999) + "\t " for _ in range(rng.randrange(9)))) for i in range(240)]
    rows += [(900 + i, "a", rows[0][2]) for i in range(30)] + [rows[1]] * 40 + [(None, "a", "x y\n" + lines[0]), (None, "a", None), (5, None, " \n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    table = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "text")
    for df in (docs, table):
        every = [tuple(r) for r in df.collect()]
        want = sorted((str(r[0]), *map(str, v)) for r, v in zip(every, brute.line_verdicts(every)))
        assert sorted((str(r.doc_id), str(r.kept), str(r.n_line_words), str(r.left)) for r in quality.quality(df).collect()) == want


def test_frequent_lines_are_taken_out(spark):
    rng = random.Random(14)
    menu = "home about contact terms privacy help"
    bodies = [(words(rng, 30, 9999), words(rng, 30, 9999)) for _ in range(25)]
    texts = [f"{a}\n\n  {menu.upper()} \n{b}\n{menu}" for a, b in bodies] + [f"{bodies[0][0]}\n"] * 2
    got = {r.doc_id: r for r in quality.quality(frame(spark, texts)).collect()}
    assert all(got[i].left == f"{a}\n\n{b}" and got[i].n_line_words == 12 and got[i].kept for i, (a, b) in enumerate(bodies))
    assert got[25].left == got[26].left == texts[25] and got[25].n_line_words == 0


def test_quality_edges(spark):
    assert quality.quality(odd(spark)).count() == 8 and quality.quality(odd(spark).limit(0)).count() == 0
    assert quality.quality(odd(spark)).where("doc_id IN (1, 2, 3)").where("base_failed AND NOT kept AND n_words = 0").count() == 3


# ---- 4 substrings ---------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("block", [1 << 20, 400])
def test_repeats(spark, block):
    rng = random.Random(5)
    shared = [words(rng, n, 9999) for n in (34, 35, 36, 80)]
    texts = [" ".join([words(rng, rng.randrange(60), 9999), *rng.sample(shared, rng.randrange(3)), words(rng, rng.randrange(50), 9999)]) for _ in range(40)]
    texts += ["a " * 36, "b " * 35, words(rng, 90, 2), None, "", shared[3], shared[3] + "\n" + shared[3], "x y " + shared[1]]
    got = {r.doc_id: r for r in substrings.without_repeats(frame(spark, texts), block_bytes=block).collect()}
    for i, kept in enumerate(brute.repeats(texts, 35)):
        assert got[i].kept == " ".join(kept) and got[i].n_removed == got[i].n_words - len(kept) == sum(s.end - s.start for s in got[i].spans)


def test_automata_in_shards(monkeypatch):
    phrases = [(i, i + 1, i + 2) for i in range(50)]
    one = substrings.Automata(phrases)
    monkeypatch.setattr(substrings, "SHARD", 7)
    many = substrings.Automata(phrases)
    text = tuple(random.Random(6).choices(range(55), k=200)) + tuple(range(20))
    assert len(many.shards) == 8 and sorted(map(tuple, one.hits(text))) == sorted(map(tuple, many.hits(text))) and len(one.hits(text)) >= 18


def test_occurrences_come_from_the_automata(monkeypatch):
    rng = random.Random(8)
    shared = words(rng, 150, 9999)
    block = pa.table({"doc_id": pa.array([1, 2, 3], pa.int64()), "text": [f"{words(rng, 20, 9999)} {shared}", f"{shared} {words(rng, 20, 9999)}", words(rng, 80, 9999)]})
    anchor, _ = substrings.count_anchors(block, 35, 12)
    a, b, n = substrings.count_windows(block, anchor, 35, 12)
    run = lambda: substrings.remove(block, a[n > 1], b[n > 1], 35, 12).column("n_removed").to_pylist()
    assert run() == [150, 150, 0]
    hits = substrings.Automata.hits
    for broken in (lambda self, w: hits(self, w)[:0], lambda self, w: hits(self, w)[:, [0, 1]] * [1, 0], lambda self, w: hits(self, w)[:1]):
        monkeypatch.setattr(substrings.Automata, "hits", broken)
        assert run() != [150, 150, 0]


def test_repeats_edges(spark):
    got = substrings.without_repeats(odd(spark))
    assert got.count() == 8 and substrings.without_repeats(odd(spark).limit(0)).count() == 0
    long = got.where("doc_id = 4").first()
    assert long.n_removed == long.n_words == 60_000  # it repeats itself


# ---- 5 chat ---------------------------------------------------------------------------------------------------------


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "a\n[INST]"]), st.text(st.sampled_from("a\\n[]<>/sINST()\n{é"), max_size=20)), max_size=6))
def test_template_round_trip(turns):
    text, at = chat.spans(chat.instruct, turns)
    assert [(read := chat.read_instruct(text[a:b]), (read[0], chat.unescape(text[a + read[1] : a + read[2]])))[1] for a, b in at] == turns
    for _, t in turns:
        assert not any(c in chat.escape(t) for c in chat.CONTROL)


def test_templates_that_rewrite_history(spark):
    turns = [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")]
    assert chat.rewrites_history(chat.trimmed, [turns]) and not chat.rewrites_history(chat.instruct, [turns])
    rows = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)], "conv_id bigint, turn bigint, role string, text string")
    (r,) = chat.format_chats(rows, chat.trimmed).collect()
    assert r.turns is None and "changes earlier output" in r.error


def test_chat_digests(spark, sf):
    got = {r.conv_id: r for r in queries.op5_chat_spans(spark, sf).collect()}
    rows = {}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        rows.setdefault(r.conv_id, []).append((r.turn, r.role, r.text or ""))
    own = "</s>[INST] ok [/INST]"
    rows[-1] = [(0, "user", own), (1, "assistant", own)]
    assert set(got) == set(rows)
    for k, turns in rows.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert got[k].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        assert (got[k].n_turns, got[k].loss_chars, got[k].loss_sha256) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_edges(spark):
    rows = spark.createDataFrame([(1, 2, "user", None), (1, 1, None, "x"), (None, 1, "assistant", "y"), (1, 1, None, "x"), (2, None, "assistant", "")], "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: r for r in chat.digests(chat.format_chats(rows.selectExpr("*", "1 AS turns"))).collect()}
    assert got[1].n_turns == 3 and got[None].loss_chars == 1 and got[2].loss_chars == 0
    assert chat.format_chats(rows.limit(0)).count() == 0


def test_long_conversations(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"turn {i} [INST] </s>") for i in range(3000)] + [(2, 0, "assistant", "x " * 500_000), (2, 0, "assistant", "x " * 500_000)]
    got = {r.conv_id: r for r in chat.digests(chat.format_chats(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))).collect()}
    assert got[1].n_turns == 3000 and got[1].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in rows[:3000]).encode()).hexdigest()
    assert got[1].loss_chars == sum(len(t) for _, _, r, t in rows[:3000] if r == "assistant") and got[2].loss_chars == 2_000_000


# ---- 6 similarity ---------------------------------------------------------------------------------------------------


def family(rng, n, size, edits):
    base = words(rng, size, 99999).split()
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(99999)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80), (2, 60)])
def test_groups(spark, k, percent):
    rng = random.Random(7 * k)
    texts = [t for size, edits in ((6, 1), (12, 1), (25, 2), (60, 3), (200, 8), (700, 12), (1500, 30)) for _ in range(2) for t in family(rng, 6, size, edits)]
    texts += ["a b", "A  B", "a b c", "a", None, "", " \n", "a b", words(rng, 30, 2), words(rng, 31, 2)] + [texts[0].upper()] * 3
    order = list(range(len(texts)))
    rng.shuffle(order)
    texts = [texts[i] for i in order]
    got = {r.doc_id: r for r in similarity.groups(frame(spark, texts), k, percent).collect()}
    assert [got[i].component_id for i in range(len(texts))] == brute.groups(list(range(len(texts))), texts, k, percent)
    assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in brute.sets(texts, k)]


@pytest.mark.parametrize("block", [3, 1024])
def test_all_links(spark, monkeypatch, block):
    monkeypatch.setattr(similarity, "BLOCK", block)
    rng = random.Random(21)
    texts = family(rng, 14, 120, 5) + family(rng, 9, 60, 2) + ["", None, "a b"] + [words(rng, 50)] * 4
    pairs, members = similarity.links(frame(spark, texts), 3, 80)
    cls = {r.doc_id: r.cls for r in members.collect()}
    sets = brute.sets(texts, 3)
    want = set()
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and sets[i] != sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                want.add((min(cls[i], cls[j]), max(cls[i], cls[j])))
        assert (cls[i] == 0) == (not sets[i])
    got = [(r.a, r.b) for r in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 40


def test_groups_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK", 7)
    monkeypatch.setattr(similarity, "MEET", 40)
    monkeypatch.setattr(similarity, "WIDE", 0)  # hubs first
    monkeypatch.setattr(components, "HELD", 5)
    rng = random.Random(11)
    texts = family(rng, 40, 100, 9) + family(rng, 40, 150, 4) + [words(rng, 40)] * 3
    rows = frame(spark, texts).union(frame(spark, texts[:20]))  # rows that repeat another
    got = {r.doc_id: r.component_id for r in similarity.groups(rows, 3, 90).collect()}
    assert [got[i] for i in range(len(texts))] == brute.groups(list(range(len(texts))), texts, 3, 90)


@pytest.mark.parametrize("percent", [90, 60])
def test_lists_hold_members_that_fit(spark, monkeypatch, percent):
    """Texts of unlike sizes share passages: of their lists only members go on whose size fits another's; no link is lost."""
    seen, layout = [], similarity.Join.layout

    def watched(self, entries):
        seen.append([(r.sig, r.n) for r in entries.select("sig", "n").collect()])
        return layout(self, entries)

    monkeypatch.setattr(similarity.Join, "layout", watched)
    rng = random.Random(31)
    passages = [words(rng, 40, 10**9) for _ in range(20)]  # in two texts each: rare, so among the first shingles of both
    texts = [f"{p} {words(rng, n, 10**9)}" for p in passages for n in (20, 200)]
    texts += family(rng, 12, 40, 6) + family(rng, 12, 90, 12)
    got = {r.doc_id: r.component_id for r in similarity.groups(frame(spark, texts), 3, percent).collect()}
    assert [got[i] for i in range(len(texts))] == brute.groups(list(range(len(texts))), texts, 3, percent)
    lists = collections.defaultdict(list)
    for sig, n in seen[0]:
        lists[sig].append(n)
    assert lists
    for sizes in map(sorted, lists.values()):
        assert len(sizes) > 1 and all(100 * x >= percent * y for x, y in zip(sizes, sizes[1:]))


@pytest.mark.parametrize(("block", "sent"), [(1024, 50), (7, 50 * 7 + 45 * 8)])
def test_a_member_is_sent_once_to_a_block(spark, monkeypatch, block, sent):
    monkeypatch.setattr(similarity, "BLOCK", block)
    entries = spark.createDataFrame([(1, i, 100, max(0, i - 4)) for i in range(50)], "sig bigint, c bigint, n bigint, root bigint")
    classes = spark.createDataFrame([(i, [0] * 16) for i in range(50)], "cls bigint, brief array<bigint>")
    join = similarity.Join(frame(spark, []), 3, 90)
    size, _, work = join.layout(entries)
    rows = join.across(entries, size, work, classes, forest=False).select("a", "b").collect()
    assert sorted({(r.a, r.b) for r in rows}) == [(i, j) for i in range(50) for j in range(i + 1, 50) if j > 4]
    assert join.meetings(entries, size, work, classes).count() == sent


@settings(max_examples=60, deadline=None)
@given(st.sampled_from([60, 80, 90]), st.integers(0, 20), st.sets(st.integers(0, 40), min_size=1, max_size=40), st.sets(st.integers(0, 40), max_size=4))
def test_linked_sets_share_a_signature(percent, boundary, a, change):
    b = a ^ change
    both = len(a & b)
    if not b or a == b or 100 * both < percent * len(a | b):
        return
    plan, level = similarity.Plan(percent, boundary), np.zeros(similarity.COUNTERS, np.uint8)
    make = lambda s: np.unique(textnp.mix(np.array(sorted(s), dtype=np.uint64) + np.uint64(1)))
    assert set(plan.signatures(make(a), level).tolist()) & set(plan.signatures(make(b), level).tolist())


def test_parities_bound_the_difference():
    rng = np.random.default_rng(1)
    for n in (5, 50, 500):
        a = np.unique(rng.integers(0, 1 << 62, 800, dtype=np.uint64))
        b = np.concatenate((a[n:], rng.integers(0, 1 << 62, n, dtype=np.uint64)))
        differ = sum(int(x).bit_count() for x in (similarity.parities(a) ^ similarity.parities(b)).view(np.uint64).tolist())
        assert differ <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("held", [4, 10**6])
def test_components(spark, monkeypatch, held):
    monkeypatch.setattr(components, "HELD", held)
    rng = random.Random(8)
    links = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 20)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(7, 7)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    root = {x: x for e in links for x in e if e[0] != e[1]}
    for _ in range(300):
        for a, b in links:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert got == root
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_groups_edges(spark):
    rows = similarity.groups(odd(spark), 3, 90).collect()
    assert len(rows) == 8 and all(r.component_id == r.doc_id for r in rows)
    assert similarity.groups(odd(spark).limit(0)).count() == 0
    with pytest.raises(ValueError):
        similarity.groups(odd(spark), 3, 50)


# ---- 7 mixing -------------------------------------------------------------------------------------------------------


def wanted_targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped and sizes[s]]
        level = (total - sum(capped.values())) / sum(w[s] for s in free) if free else 0
        above = [s for s in free if w[s] * level > cap * sizes[s]]
        if not above:
            return {s: capped.get(s, w[s] * level if sizes[s] else 0) for s in names}
        capped |= {s: cap * sizes[s] for s in above}


@pytest.mark.parametrize("counts", [{"a": 200, "b": 50, "c": 300, None: 100}, {"a": 5, "b": 400, "c": 400, "d": 3, "e": 100}])
def test_mix(spark, counts):
    rng = random.Random(9)
    rows = [(s, words(rng, rng.choice((5, 40, 200, 900)))) for s, n in counts.items() for _ in range(n)]
    docs = spark.createDataFrame([(i, t, s) for i, (s, t) in enumerate(rows)], "doc_id bigint, text string, source string")
    got, again = (sorted((r.doc_id, r.size, r.source_size, r.target, r.copies, r.taken) for r in mixing.mix(d).collect()) for d in (docs, docs.repartition(7)))
    assert got == again and all(0 <= c <= 3 and t == c * s for _, s, _, _, c, t in got)
    sizes, taken, target = {}, {}, {}
    for (s, _), r in zip(rows, got):
        sizes[s], taken[s], target[s] = sizes.get(s, 0) + r[1], taken.get(s, 0) + r[5], r[3]
    for s, want in wanted_targets(sizes).items():
        assert abs(target[s] - want) < 1e-6 * want + 1e-6 and abs(taken[s] - want) <= max(0.02 * want, 5)


@pytest.mark.parametrize("documents", [1, 4, 40])
def test_mix_of_repeated_rows(spark, documents):
    rows = [(i % documents, " ".join(f"w{i % documents}" for _ in range(10)), ("a", "b", "c")[i % documents % 3]) for i in range(25 * documents)] + [(None, "x y z", "d")] * 31
    got, again = (sorted((str(r.doc_id), r.copies, r.taken, r.target, str(r.source)) for r in mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(n)).collect()) for n in (3, 5))
    assert got == again and len(got) == len(rows) and all(0 <= c <= 3 for _, c, *_ in got)
    by_id, taken, target = {}, {}, {}
    for d, c, t, goal, s in got:
        by_id.setdefault((d, s), []).append(c)
        taken[s], target[s] = taken.get(s, 0) + t, goal
    assert all(max(c) - min(c) <= 1 for c in by_id.values())
    assert all(abs(taken[s] - target[s]) <= 10 for s in taken), (taken, target)


def test_mix_of_whole_rows(spark):
    rows = odd(spark).selectExpr("*", "9 AS taken")
    out = mixing.mix(rows, whole=True)
    assert out.columns == [c for c in rows.columns if c != "taken"] + list(mixing.ADDED) and len(out.collect()) == 8


def test_mix_edges(spark):
    rows = mixing.mix(odd(spark)).collect()
    assert len(rows) == 8 and all(r.taken <= 3 * r["size"] for r in rows)
    assert mixing.mix(odd(spark).limit(0)).count() == 0
    assert mixing.mix(odd(spark).where("doc_id < 4")).agg(F.sum("taken")).first()[0] == 0


# ---- 8 secrets ------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def dictionary(spark):
    return secrets.dictionary(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


@pytest.fixture(scope="module")
def forest(spark, dictionary):
    return secrets.train(secrets.generated_findings(spark, dictionary), dictionary)


def test_secrets(spark, forest, dictionary):
    key = hashlib.sha1(b"k").hexdigest()
    texts = [f'see token = "{key}" there', f"commit {key} fixes it", "card 4242424242424242 used", "mail john.smith.1234@mail5.example.com now", f"PASSWORD = \"{key.upper()}\"!!", "/usr/lib/python3/dist-packages/a.html", None, "", f'x token = "{key}"\ny api_key={key}z']
    rows = secrets.findings(frame(spark, texts), forest, dictionary).collect()
    assert {r.doc_id for r in rows if r.is_secret} == {0, 4, 8} and {r.doc_id for r in rows} >= {0, 1, 2, 3, 4, 5, 8}
    out = {r.doc_id: r for r in secrets.redact(frame(spark, texts), forest, dictionary).collect()}
    assert out[0].text == 'see token = "[SECRET]" there' and out[0].n_chars == len(out[0].text) and out[1].text == texts[1] and out[6].text is None and key not in out[8].text


def test_every_run_of_a_word_is_a_candidate(spark, forest, dictionary):
    key, commit = hashlib.sha1(b"k").hexdigest(), hashlib.sha1(b"c").hexdigest()
    texts = [f'{{"aws_secret_access_key":"{key}"}}', f"https://api.example.com/v1/users?access_token={key}", f'{{"commit":"{commit}","token":"{key}"}}', f'{{"long_name_without_digit":"none","token":"{key}","more":["{key}"]}}']
    rows = secrets.findings(frame(spark, texts), forest, dictionary).collect()
    assert sorted((r.doc_id, r.word_at, r.run_at, r.candidate) for r in rows) == [(0, 0, 1, key), (1, 0, 0, "//api.example.com/v1/users"), (1, 0, 1, f"access_token={key}"), (2, 0, 0, commit), (2, 0, 1, key), (3, 0, 1, key), (3, 0, 2, key)]
    judged = {(r.doc_id, r.run_at): r.is_secret for r in rows}
    assert {k for k, secret in judged.items() if secret} >= {(0, 1), (1, 1), (2, 1), (3, 1)} and not judged[1, 0] and not judged[2, 0], [(r.doc_id, r.run_at, r.probability) for r in rows]
    out = {r.doc_id: r.text for r in secrets.redact(frame(spark, texts), forest, dictionary).collect()}
    assert not any(key in t for t in out.values()) and commit in out[2]


def test_longer_secrets_go_first(spark, forest, dictionary):
    a, b = hashlib.sha1(b"a").hexdigest(), hashlib.sha1(b"b").hexdigest()
    text = f'token = "{a}" and secret = "{a}{b}" and key = "{b}"'
    assert secrets.redact(frame(spark, [text]), forest, dictionary).first().text == 'token = "[SECRET]" and secret = "[SECRET]" and key = "[SECRET]"'


def test_forest_on_findings_it_has_not_seen(spark, forest, dictionary):
    from pyspark.ml.feature import VectorAssembler

    rows = secrets.features(secrets.generated_findings(spark, dictionary, 16_000).withColumn("n", F.monotonically_increasing_id()).where("n % 5 = 0"), dictionary)
    judged = forest.transform(VectorAssembler(inputCols=list(secrets.FEATURES), outputCol="features").transform(rows))
    assert judged.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0] > 0.95


@pytest.mark.parametrize("kind", [0, 4, 13])
def test_kinds_held_out(spark, dictionary, kind):
    """A kind of finding that the forest has not learned from is judged by what it shares with others."""
    from pyspark.ml.feature import VectorAssembler

    every = secrets.generated_findings(spark, dictionary)
    model = secrets.train(every.where(F.col("kind") != kind), dictionary)
    rows = secrets.features(every.where(F.col("kind") == kind), dictionary)
    judged = model.transform(VectorAssembler(inputCols=list(secrets.FEATURES), outputCol="features").transform(rows))
    assert judged.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0] > 0.7


def test_dictionary_counts_documents(spark):
    texts = ["alpha Beta beta gamma2 ab"] * 2 + ["ALPHA beta"] * 3 + [None, "", "gamma naïve"]
    got = {r.dictionary_word: r.docs for r in secrets.dictionary(frame(spark, texts), min_docs=5).collect()}
    assert got == {w: 0 for w in secrets.PIECES} | {"alpha": 5, "beta": 5}
    rows = frame(spark, ["x"]).selectExpr("explode(array('alphaBeta-12345678', 'ALPHA_zzz_alpha', '0123456789abcdef', 'alpha_beta')) AS candidate")
    got = {r.candidate: round(r.f_dictionary, 3) for r in secrets.covered(rows, secrets.dictionary(frame(spark, texts), min_docs=5)).collect()}
    assert got == {"alphaBeta-12345678": 0.5, "ALPHA_zzz_alpha": 0.667, "0123456789abcdef": 0.0, "alpha_beta": 0.9}


def test_short_secrets_that_are_assigned(spark, forest, dictionary):
    texts = ['password="hunter2pass" and more', "token = Xk29dkQw7Zp1", "the hunter2pass stays, as no one assigns it", 'secret: "QmvZkWpLtRsXnYqBdFgH"', "password field required below"]
    out = {r.doc_id: r.text for r in secrets.redact(frame(spark, texts), forest, dictionary).collect()}
    assert "hunter2pass" not in out[0] and "Xk29dkQw7Zp1" not in out[1] and out[2] == texts[2] and "QmvZ" not in out[3] and out[4] == texts[4], out


def test_candidates_match_brute_force(spark):
    rng = random.Random(12)
    bits = ["token", "password", "=", ":", '"', "'", " ", " ", "\n", "abc", "key_1", "/", "0123456789", "QWERTYuiop", "-", ",", "{", "}", "commit", "é", "x" * 9]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(300)] + [None, ""]
    got = sorted((r.doc_id, r.word_at, r.run_at, r.candidate) for r in secrets.candidates(frame(spark, texts)).collect())
    name = "(?i:" + "|".join(secrets.SECRET_WORDS) + ")"
    given = name + r"[A-Za-z0-9_.\-]*" + secrets.QUOTES + "[:=]+>?" + secrets.QUOTES
    want = []
    for d, t in enumerate(texts):
        w = brute.words(t)
        for i, x in enumerate(w):
            b, b2 = w[i - 1] if i else "", w[i - 2] if i > 1 else ""
            ahead = re.search(name + r"[^A-Za-z0-9]*[:=]$", b) or (re.search("^[:=]+>?$", b) and re.search(name + "[^A-Za-z0-9]*$", b2))
            runs = list(re.finditer(secrets.SHORT, x))
            for j, m in enumerate(runs):
                front = x[runs[j - 1].start() if j else 0 : m.start()]
                assigned = (j == 0 and ahead) or re.search(given + "$", front) or re.search(given + "[^=]{8}", m[0])
                want += [(d, i, j, m[0])] * bool(assigned or len(m[0]) >= 16 and re.search("[0-9]", m[0]))
    assert got == sorted(want) and len(got) > 100


def test_secrets_edges(spark, forest, dictionary):
    clash = runtime.pick(odd(spark), doc_id="bigint", text="string").selectExpr("doc_id", "text", "'k' AS candidate", "1 AS probability", "2 AS word")
    assert secrets.findings(clash, forest, dictionary).count() == 0 and secrets.findings(clash.limit(0), forest, dictionary).count() == 0
    plan = secrets.findings(clash, forest, dictionary)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---- 9 language -----------------------------------------------------------------------------------------------------


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = langid.learn_and_identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.98


def test_filter_has_no_false_negatives():
    rng = np.random.default_rng(2)
    sets = [rng.integers(0, 1 << 60, 500) for _ in range(70)]  # more languages than a word has bits
    model = langid.Filter.build([f"l{i}" for i in range(70)], sets)
    for i in (0, 63, 64, 69):
        assert (model.masks(sets[i])[i // 64] >> np.uint64(i % 64) & np.uint64(1)).all()
    assert (model.false_rate < 0.02).all()


def test_languages_by_exact_sets(spark):
    """Predictions by exact sets of n-grams, counted here, instead of the bit-sliced filters."""
    rows = [r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    held = lambda r: zlib.crc32(str(r.doc_id).encode()) % 4 == 2
    counts = {}
    for r in rows:
        if not held(r) and r.text is not None and r.lang is not None:
            counts.setdefault(r.lang, collections.Counter()).update(langid.trigrams(r.text).tolist())
    total = {x: sum(c.values()) for x, c in counts.items()}
    sets = {x: {g for g, n in c.items() if n >= langid.SHARE * total[x]} for x, c in counts.items()}
    got = {r.doc_id: r for r in langid.learn_and_identify(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()}
    same = off = n = 0
    for r in rows:
        grams = langid.trigrams(r.text or "").tolist()
        assert got[r.doc_id].held_out == held(r)
        if not grams:
            assert got[r.doc_id].lang_pred == "und"
            continue
        share = {x: sum(g in s for g in grams) / len(grams) for x, s in sets.items()}
        best = max(share, key=lambda x: (share[x], total[x]))
        n, same, off = n + 1, same + (best == got[r.doc_id].lang_pred), off + abs(share[best] - got[r.doc_id].score)
    assert same >= 0.995 * n and off / n < 0.01, (same, n, off / n)


def test_language_edges(spark):
    got = {r.doc_id: r for r in langid.learn_and_identify(odd(spark)).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3)) and got[5].lang_pred in ("fr", "en") and 0 <= got[5].score <= 1
    assert langid.learn_and_identify(odd(spark).limit(0)).count() == 0
    unknown = odd(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.learn_and_identify(unknown).collect()} == {"und"}
    assert langid.trigrams("12 ²½ .").size == 0


# ---- 10 tokens ------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def counter():
    import public_tokenizers

    return tokens.counter_of(public_tokenizers.path(queries.TOKENIZER))


@settings(max_examples=120, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aB'srel. ,!?;:12é́\x1c \n<|>"), st.characters(codec="utf-8")), max_size=40), st.integers(0, 12))
def test_every_prefix(counter, text, budget):
    text = text + "<|endoftext|>don't" if budget % 3 == 0 else text
    encode = lambda t: len(counter.tokenizer.encode(t, add_special_tokens=False).ids)
    ends, counts = tokens.prefix_table(counter, text)
    every = [encode(text[:i]) for i in range(len(text) + 1)]
    assert tokens.prefix_counts(counter, text, ends, counts).tolist() == every
    assert tokens.total(counter, text.encode()) == every[-1]
    best = tokens.longest_prefix(counter, text, ends, counts, budget)
    assert every[best] <= budget and (best == len(text) or counts[-1] > budget)
    stored = [(0, 0), *zip(ends.tolist(), counts.tolist())]
    assert tokens.within(ends, counts, budget) == max(x for x in stored if x[1] <= budget)
    cut = tokens.windows(ends, counts, budget)
    assert [a for a, _ in cut] == [0, *(b for _, b in cut)][: len(cut)] and (not stored[1:] or cut[-1][1] == ends[-1])
    assert all(encode(text[a:b]) <= budget or len(text[a:b].encode().split()) == 1 for a, b in cut)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"])
def test_tokenizer_files(spark, sf, name):
    import public_tokenizers

    path = public_tokenizers.path(name)
    one = tokens.counter_of(path)
    assert getattr(one, "runs", False) == name.startswith("word")
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()
    texts = [r.text for r in docs] + ["", " ", "  a  b\n\nc ", "naïve café  中文 字<|endoftext|> <s>x</s>", None]
    got = {r.doc_id: r for r in tokens.token_counts(frame(spark, texts), path, tables=True).collect()}
    for i, t in enumerate(texts):
        assert got[i].n_tokens == one.whole(t or "") == (got[i].prefix_tokens or [0])[-1]
        for k in range(0, len(got[i].prefix_ends), 1 + len(got[i].prefix_ends) // 9):
            assert one.whole(t[: got[i].prefix_ends[k]]) == got[i].prefix_tokens[k]
    with pytest.raises(ValueError):
        tokens.counter_of(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def test_token_counts(spark, sf, counter):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in queries.op10_prefix_tokens(spark, sf).collect()}
    for r in docs.collect():
        n = len(counter.tokenizer.encode(r.text, add_special_tokens=False).ids)
        assert (got[r.doc_id].n_tokens, got[r.doc_id].n_bytes, got[r.doc_id].over_limit) == (n, len(r.text.encode()), n > 2048)


def test_token_tables_and_edges(spark):
    import public_tokenizers

    path = public_tokenizers.path(queries.TOKENIZER)
    rows = tokens.token_counts(odd(spark), path, tables=True).collect()
    assert len(rows) == 8 and all((r.prefix_tokens or [0])[-1] == r.n_tokens for r in rows)
    assert {r.n_bytes for r in rows if r.doc_id in (1, 2)} == {0}
    assert tokens.token_counts(odd(spark).limit(0), path).count() == 0


def test_query_stores_prefix_counts(spark, sf, counter, monkeypatch):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op10_prefix_tokens(spark, sf).collect()
    for r in got:
        assert r.prefix_ends == [m.end() for m in re.finditer(r"[^\x20\x09-\x0D]+", texts[r.doc_id])] and (r.prefix_tokens or [0])[-1] == r.n_tokens
    for r in got[:5]:
        i = r.prefix_ends[len(r.prefix_ends) // 2]
        assert r.prefix_tokens[len(r.prefix_ends) // 2] == len(counter.tokenizer.encode(texts[r.doc_id][:i], add_special_tokens=False).ids)
    text = "naïve café  中文 字\n" * 40 + " x"
    whole = tokens.prefix_table(counter, text)
    monkeypatch.setattr(tokens, "PIECE", 20)
    assert all((a == b).all() for a, b in zip(whole, tokens.prefix_table(counter, text))) and len(whole[0]) == 161


def test_memo_is_bounded(monkeypatch, counter):
    import public_tokenizers

    monkeypatch.setattr(tokens, "MEMO", 50)
    small = tokens.counter_of(public_tokenizers.path(queries.TOKENIZER))
    runs = [f"word{i}" .encode() for i in range(200)] + [b"x" * 500]
    for i in range(0, 201, 20):
        assert small.count(runs[i : i + 20]) == counter.count(runs[i : i + 20])
        assert len(small.memo) < 120 and b"x" * 500 not in small.memo


# ---- session --------------------------------------------------------------------------------------------------------


def test_pick_takes_exact_names(spark):
    df = spark.range(1).selectExpr("1 AS TEXT", "'t' AS text", "2 AS text2")
    assert runtime.pick(df, text="string", gone="int").first().asDict() == {"text": "t", "gone": None}


def test_bounded_counts_before_it_broadcasts(spark):
    small, large = runtime.bounded(spark.range(10), 10), runtime.bounded(spark.range(11), 10)
    plan = lambda df: df._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan(small).lower() and "broadcast" not in plan(large).lower()
