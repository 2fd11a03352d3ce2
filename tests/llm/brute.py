"""Plain Python versions of the operators' results."""

import collections
import re
import string

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text, lower=False):
    return WORD.findall((text or "").translate(LOWER) if lower else text or "")


def repeats(texts, span):
    """Words that stay, for each text."""
    every = [words(t) for t in texts]
    seen = collections.Counter(tuple(w[i : i + span]) for w in every for i in range(len(w) - span + 1))
    out = []
    for w in every:
        gone = set()
        for i in range(len(w) - span + 1):
            if seen[tuple(w[i : i + span])] > 1:
                gone |= set(range(i, i + span))
        out.append([x for i, x in enumerate(w) if i not in gone])
    return out


def sets(texts, k):
    out = []
    for t in texts:
        w = words(t, True)
        out.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    return out


def groups(ids, texts, k, percent):
    """Smallest reachable id of each text."""
    s, root = sets(texts, k), list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            both = len(s[i] & s[j])
            if s[i] and s[j] and 100 * both >= percent * (len(s[i]) + len(s[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    return [least[find(i)] for i in range(len(ids))]


def quality(text):
    w = words(text)
    seen = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed


def line_verdicts(rows, max_docs=20, max_share=0.01, min_left=0.5):
    """rows (doc_id, host, text) -> (kept, n_line_words, left) of each."""
    norm = lambda x: " ".join(WORD.findall(x)).lower()
    docs, seen = collections.defaultdict(set), collections.defaultdict(set)
    for d, h, t in rows:
        if t is not None:
            docs[h].add((d, t))
            for x in t.split("\n"):
                if WORD.search(x):
                    seen[h, norm(x)].add((d, t))
    often = {k for k, v in seen.items() if len(v) > max_docs and len(v) > max_share * len(docs[k[0]])}
    out = []
    for d, h, t in rows:
        left = "" if t is None else "\n".join(x for x in t.split("\n") if not WORD.search(x) or (h, norm(x)) not in often)
        n, n_left = len(words(t)), len(words(left))
        out.append((not quality(t)[-1] and n_left >= min_left * n and n_left >= 10, n - n_left, left))
    return out


def segments(scores):
    """Maximal scoring segments by the definition: take the best, then those left and right of it."""
    if not scores or max(scores) <= 0:
        return []
    best, at = 0, None
    for i in range(len(scores)):
        total = 0
        for j in range(i, len(scores)):
            total += scores[j]
            shorter = at is not None and abs(total - best) <= 1e-9 and j + 1 - i < at[1] - at[0]  # no ends that add nothing
            if total > best + 1e-9 or shorter:
                best, at = max(best, total), (i, j + 1)
    i, j = at
    return segments(scores[:i]) + [(i, j)] + [(a + j, b + j) for a, b in segments(scores[j:])]
