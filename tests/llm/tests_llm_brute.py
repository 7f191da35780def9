"""Brute-force versions of the deduplication stages, over plain sets and tuples of words."""

import re
from collections import Counter

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def near_groups(rows, size, num, den):
    """The smallest id reachable by links, for unique ids."""
    sets = {}
    for i, t in rows:
        w = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    links = [(i, j) for i in sets for j in sets if i < j and sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])]
    changed = True
    while changed:
        changed = False
        for i, j in links:
            low = min(label[i], label[j])
            if label[i] != low or label[j] != low:
                label[i] = label[j] = low
                changed = True
    return label


def repeated_words(rows, window):
    """What is left of the texts that lose words."""
    split = {i: WORDS.findall(t or "") for i, t in rows}
    seen = Counter(tuple(w[k : k + window]) for w in split.values() for k in range(len(w) - window + 1))
    out = {}
    for i, w in split.items():
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        if any(gone):
            out[i] = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
    return out
