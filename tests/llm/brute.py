"""Plain versions of the operators, for small inputs."""

import collections
import hashlib
import re
import string

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def words(text):
    return WORD.findall((text or "").translate(LOWER))


class Sets:
    """Disjoint sets, each named by its smallest member."""

    def __init__(self, members):
        self.up = {m: m for m in members}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def near_classes(docs, threshold=0.8):
    """doc_id -> class, for (doc_id, text)."""
    bags = {}
    for doc, text in docs:
        w = words(text)
        if w:
            bags[doc] = collections.Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))
    sets = Sets([d for d, _ in docs])
    ids = sorted(bags)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = (bags[a] & bags[b]).total()
            if common / (bags[a].total() + bags[b].total() - common) >= threshold:
                sets.join(a, b)
    return {d: sets.find(d) for d, _ in docs}


def repeats(docs, depth=100):
    """[(doc_id, removed flags, bytes)] in the order of ids."""
    seen, found = set(), []
    for doc, text in sorted(docs, key=lambda d: (d[0] is not None, d[0], d[1] is not None, d[1])):
        data = (text or "").encode()
        gone = [False] * len(data)
        for p in range(len(data) - depth + 1):
            if data[p : p + depth] in seen:
                gone[p : p + depth] = [True] * depth
            seen.add(data[p : p + depth])
        found.append((doc, gone, data))
    return found


def repeats_report(docs, depth=100):
    rows = []
    for doc, gone, data in repeats(docs, depth):
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        rows.append((doc, len(data), sum(gone), spans, sha(bytes(b for b, g in zip(data, gone) if not g))))
    return rows


def leaks(docs, items, window=10):
    """doc_id -> (words, hit words, items, contaminated)."""
    grams = collections.defaultdict(set)
    for item, text in items:
        w = words(text)
        size = min(window, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            grams[tuple(w[k : k + size])].add(item)
    found = {}
    for doc, text in docs:
        w, hit, named = words(text), set(), set()
        for size in {len(g) for g in grams}:
            for k in range(len(w) - size + 1):
                own = grams.get(tuple(w[k : k + size]))
                if own:
                    named |= own
                    hit.update(range(k, k + size))
        found[doc] = (len(w), len(hit), len(named), sha(",".join(sorted(map(str, named)))), bool(hit)), hit
    return found
