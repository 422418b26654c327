"""Plain Python versions of what the operators compute."""

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def near_duplicates(rows):
    """{(doc_id, text): (n_shingles, component)} of rows with ids."""
    sets = []
    for doc_id, text in rows:
        w = words(ascii_lower(text))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * 100 >= 75 * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= 75 * (len(a) + len(b) - both):
                    x, y = find(i), find(j)
                    parent[max(x, y)] = min(x, y)
    least = defaultdict(lambda: 1 << 62)
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least[find(i)], doc_id)
    return [(doc_id, len(sets[i]), least[find(i)] if sets[i] else doc_id) for i, (doc_id, _) in enumerate(rows)]


def without_repeats(rows, window=20):
    """(doc_id, n_words, n_removed, sha256) of rows with ids."""
    first = {}
    split = [(doc_id, words(text)) for doc_id, text in rows]
    for doc_id, w in split:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, (doc_id, i)), (doc_id, i))
    out = []
    for doc_id, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (doc_id, i):
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def base_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    count = defaultdict(int)
    for i in range(len(w) - 7):
        count[tuple(w[i : i + 8])] += 1
    covered = [False] * len(w)
    for i in range(len(w) - 7):
        if count[tuple(w[i : i + 8])] > 1:
            covered[i : i + 8] = [True] * 8
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), sum(covered)
