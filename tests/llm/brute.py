"""Plain Python versions of what the queries return, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import xxhash

PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def decontamination(docs, items, window=10):
    windows = defaultdict(set)
    for item, text in items:
        words = PLAIN.findall(lower(text))
        for i in range(max(1, len(words) - window + 1) if words else 0):
            windows[tuple(words[i : i + window])].add(item)
    sizes = {len(w) for w in windows}
    for doc, text in docs:
        words = PLAIN.findall(lower(text))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if (w := tuple(words[i : i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[w]
        names = sorted(str(x) for x in found if x is not None)
        yield doc, len(words), len(hit), len(names), sha(",".join(names)), len(hit) > 0


def quality_base(docs):
    for doc, text in docs:
        text = text or ""
        words = SPACE.findall(text)
        places = defaultdict(list)
        for i in range(len(words) - 2):
            places[tuple(words[i : i + 3])].append(i)
        repeated = {i + j for p in places.values() if len(p) > 1 for i in p for j in range(3)}
        lines = [x for x in text.split("\n") if SPACE.search(x)]
        n = len(words)
        failed = n < 50 or 100 * len(repeated) > 50 * n
        yield doc, n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated), failed


def simhash(docs):
    prints = []
    for doc, text in docs:
        words = SPACE.findall(lower(text))
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints.append((doc, sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))))
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(prints):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    for i, (doc, fp) in enumerate(prints):
        yield doc, f"{fp:016x}", least.get(find(i))


def secrets(docs):
    assign = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for doc, text in docs:
        text = text or ""
        spans = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
        spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        count = [sum(s[1] == k for s in spans) for k in range(3)]
        yield doc, *count, sha(",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans)))


def targets(sizes):
    """{source: target} by filling up round after round."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, total, full = set(order), sum(sizes.values()), {}
    while left:
        level = (total - sum(full.values())) / sum(weight[s] for s in left)
        over = {s for s in left if 3 * sizes[s] <= level * weight[s]}
        if not over:
            break
        full |= {s: 3.0 * sizes[s] for s in over}
        left -= over
    return full | {s: level * weight[s] for s in left}


def repeats(docs, window=13):
    first = {}
    for doc, text in docs:
        words = SPACE.findall(text or "")
        for i in range(len(words) - window + 1 if doc is not None else 0):
            w = tuple(words[i : i + window])
            first[w] = min(doc, first.get(w, doc))
    for doc, text in docs:
        words = SPACE.findall(text or "")
        gone = set()
        for i in range(len(words) - window + 1 if doc is not None else 0):
            if first[tuple(words[i : i + window])] < doc:
                gone |= set(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        yield doc, len(words), len(gone), sha(kept)
