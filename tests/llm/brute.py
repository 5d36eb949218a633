"""Plain versions of the operators, row by row."""

from __future__ import annotations

import collections
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None, lower: bool = False) -> list[str]:
    text = text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER) if lower else text)


def shingles(text: str | None, k: int) -> set[tuple]:
    w = words(text, lower=True)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def leaks(docs, items, k=5, percent=80):
    found = []
    for d, text in docs:
        own = shingles(text, k)
        for i, item in items:
            s = shingles(item, k)
            if s and len(s & own) * 100 >= len(s) * percent:
                found.append((d, i, len(s), len(s & own)))
    return found


def similar(texts: list[str | None], k: int, percent: int) -> list[int]:
    """Least position reachable from each."""
    sets = [shingles(t, k) for t in texts]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both * 100 >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [find(x) for x in range(len(sets))]


def without_repeats(texts: list[str | None], window: int) -> list[tuple[int, int, str]]:
    split = [words(t) for t in texts]
    n = collections.Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        keep = [True] * len(w)
        for i in range(len(w) - window + 1):
            if n[tuple(w[i : i + window])] > 1:
                keep[i : i + window] = [False] * window
        kept = [x for x, k in zip(w, keep, strict=True) if k]
        out.append((len(w), len(w) - len(kept), " ".join(kept)))
    return out


def _template_words(line: str) -> list[str]:
    return ["<*>" if re.search("[0-9]", t) else t for t in words(line)]


def cut_lines(docs, depth=3, min_docs=5, percent=60):
    """(id, text, dropped lines) of (id, text) with distinct ids."""
    lines = [(d, i, _template_words(x)) for d, t in docs if t is not None for i, x in enumerate(t.split("\n"))]
    lines = [x for x in lines if x[2]]
    fields = collections.defaultdict(set)
    for d, _, t in lines:
        for p in range(depth, len(t)):
            fields[len(t), tuple(t[:depth]), p, t[p]].add(d)
    templates = collections.defaultdict(list)
    for d, i, t in lines:
        fixed = [p < depth or (t[p] != "<*>" and len(fields[len(t), tuple(t[:depth]), p, t[p]]) >= min_docs) for p in range(len(t))]
        constant = sum(f and x != "<*>" for f, x in zip(fixed, t, strict=True))
        general = [x if f else "<*>" for f, x in zip(fixed, t, strict=True)]
        evident = any(fixed[depth:]) or all(x == "<*>" for x in t[depth:])
        templates[tuple(general if constant * 100 >= len(t) * percent and evident else t)].append((d, i))
    gone = set()
    for at in templates.values():
        if len({d for d, _ in at}) >= min_docs:
            gone |= set(at) - {min(at)}
    out = []
    for d, t in docs:
        keep = None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone)
        out.append((d, keep, sum(g[0] == d for g in gone)))
    return out
