"""Plain Python twins of the operators, quadratic where that is simplest."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text, lower=False):
    text = text or ""
    if lower:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return WORD.findall(text)


def shingles(text, n):
    w = words(text, True)
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def classes(rows, n, percent):
    """{doc_id: (number of shingles, component)} of (doc_id, text) rows."""
    s = {i: shingles(t, n) for i, t in rows}
    root = {i: i for i in s}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(s)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if s[a] and s[b] and 100 * len(s[a] & s[b]) >= percent * len(s[a] | s[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s[i]), find(i)) for i in s}


def kept_words(rows, width):
    """{doc_id: (words, removed, kept text)}."""
    first = {}
    split = {i: words(t) for i, t in rows}
    for i in sorted(split):
        w = split[i]
        for k in range(len(w) - width + 1):
            first.setdefault(tuple(w[k:k + width]), i)
    out = {}
    for i, w in split.items():
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k:k + width])] < i:
                gone.update(range(k, k + width))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def contained(docs, items, percent):
    d = {i: shingles(t, 5) if len(words(t)) >= 5 else set() for i, t in docs}
    q = {i: shingles(t, 5) if len(words(t)) >= 5 else set() for i, t in items}
    return {(a, b, len(q[b]), len(q[b] & d[a])) for a in d for b in q
            if q[b] and 100 * len(q[b] & d[a]) >= percent * len(q[b])}


def base_rules(text):
    t = text or ""
    w = words(t)
    n = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {k for i in range(len(w) - 2) if n[tuple(w[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def without_lines(rows, min_sites):
    """{doc_id: text} of (doc_id, site, text) rows without lines on many sites."""
    sites = collections.defaultdict(set)
    for _, s, t in rows:
        for x in (t or "").split("\n"):
            if s is not None and words(x):
                sites[x].add(s)
    return {i: None if t is None else "\n".join(x for x in t.split("\n") if len(sites[x]) < min_sites)
            for i, s, t in rows}


def sha(data):
    return hashlib.sha256(data).hexdigest()
