"""Plain versions of the operators for small tables."""

import re
from collections import Counter
from itertools import combinations

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return BLANK.findall(text or "")


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def ngrams(text, n=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(zip(*[w[i:] for i in range(n)])) if len(w) >= n else frozenset([tuple(w)])


def near_copies(rows, threshold=0.8):
    """(doc_id, text) rows as {doc_id: (class_id, n_links)}; all pairs."""
    sets = {i: ngrams(t) for i, t in rows}
    root = {i: i for i in sets}
    links = Counter()

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and common >= threshold * (len(sets[a]) + len(sets[b]) - common) - 1e-9:
            links[a] += 1
            links[b] += 1
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (find(i), links[i]) for i in sets}


def leaks(docs, items, stretch=13, substitutions=2, mask=9):
    """Pairs (doc_id, item_id) that agree on a stretch; all alignments. Items shorter than the mask have to be unchanged."""
    found = set()
    for item, item_text in items:
        b = tokens(item_text)
        if not b:
            continue
        size = min(stretch, len(b))
        need = size - size * substitutions // stretch if len(b) >= mask else size
        for doc, text in docs:
            a = tokens(text)
            if not set(a) & set(b):
                continue
            for shift in range(-len(b) + size, len(a) - size + 1):
                i, j = max(shift, 0), max(-shift, 0)
                n = min(len(a) - i, len(b) - j)
                same = [a[i + k] == b[j + k] for k in range(n)]
                if any(sum(same[k:k + size]) >= need for k in range(n - size + 1)):
                    found.add((doc, item))
                    break
    return found
