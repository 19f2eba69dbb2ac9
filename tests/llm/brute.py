"""Plain one-process versions of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np

SPACE = " \t\n\x0b\x0c\r"


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def lower(s: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def line_dedup(docs):
    """docs: (doc_id, text) -> doc_id: (n_lines, n_dropped, sha, kept text)"""
    at = defaultdict(set)
    for d, t in docs:
        for line in (t or "").split("\n"):
            k = lower(line.strip(SPACE))
            if len(k) >= 20:
                at[k].add(d)
    drop = {k: max(ds) for k, ds in at.items() if len(ds) >= 3}
    out = {}
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if drop.get(lower(x.strip(SPACE)), d) == d]
        text = "\n".join(kept)
        out[d] = (len(lines), len(lines) - len(kept), sha(text.encode()), text)
    return out


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def decontaminate(docs, bench, n=13):
    windows = defaultdict(set)
    for i, t in bench:
        w = WORD.findall(lower(t or ""))
        if w:
            k = min(n, len(w))
            for s in range(len(w) - k + 1):
                windows[tuple(w[s : s + k])].add(i)
    sizes = {len(x) for x in windows}
    out = {}
    for d, t in docs:
        w = WORD.findall(lower(t or ""))
        hit, items = set(), set()
        for k in sizes:
            for s in range(len(w) - k + 1):
                if (x := tuple(w[s : s + k])) in windows:
                    hit.update(range(s, s + k))
                    items |= windows[x]
        names = ",".join(sorted(map(str, items)))
        out[d] = (len(w), len(hit), len(items), sha(names.encode()), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def long_repeats(docs, n=200):
    """docs: list of (doc_id, text) -> list of (n_bytes, n_removed, n_spans, sha)"""
    raw = [(t or "").encode() for _, t in docs]
    seen = Counter(b[i : i + n] for b in raw for i in range(len(b) - n + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - n + 1):
            if seen[b[i : i + n]] > 1:
                gone[i : i + n] = True
        spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        out.append((len(b), int(gone.sum()), spans, sha(bytes(c for c, g in zip(b, gone, strict=False) if not g))))
    return out


class Groups:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def near_duplicates(docs, percent=85):
    sets = {d: shingles(t) for d, t in docs}
    by = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            by[x].append(d)
    g, shared = Groups(), Counter()
    for ds in by.values():
        for i, a in enumerate(ds):
            for b in ds[i + 1 :]:
                shared[(a, b)] += 1
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            g.join(a, b)
    return {d: (len(s), g.find(d), g.find(d) == d) for d, s in sets.items()}


def cosine_links(rows, least=0.9):
    """rows: (vec_id, list or None) -> vec_id: (n_links, component_id, kept)"""
    good = [(i, np.asarray(v, float)) for i, v in rows if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    g, n = Groups(), Counter()
    for a in range(len(good)):
        for b in range(a + 1, len(good)):
            u, w = good[a][1], good[b][1]
            if len(u) == len(w) and u @ w / np.sqrt((u @ u) * (w @ w)) >= least:
                g.join(good[a][0], good[b][0])
                n[good[a][0]] += 1
                n[good[b][0]] += 1
    return {i: (n[i], g.find(i), g.find(i) == i) for i, _ in rows}
