"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near_copies(docs, n=4, percent=80):
    """key -> (set size, component) of (key, text) pairs with distinct keys."""
    sets = {}
    for key, text in docs:
        w = WORD.findall((text or "").translate(FOLD))
        sets[key] = set(zip(*(w[k:] for k in range(n)))) if len(w) >= n else ({tuple(w)} if w else set())
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {k: (len(s), root(k)) for k, s in sets.items()}


def removals(docs, window=35):
    """(key, words, words removed, SHA-256 of the rest) for each (key, text)."""
    rows = [(key, WORD.findall(text or "")) for key, text in docs]
    counts = Counter(tuple(w[j:j + window]) for _, w in rows for j in range(len(w) - window + 1))
    out = []
    for key, w in rows:
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if counts[tuple(w[j:j + window])] > 1:
                gone[j:j + window] = [True] * window
        rest = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((key, len(w), sum(gone), hashlib.sha256(rest.encode()).hexdigest()))
    return out


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed
