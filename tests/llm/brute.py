"""Plain Python versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LAST = 1 << 62
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def rows_of(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def by_order(docs):
    """Row numbers by id; rows without an id come last."""
    return sorted(range(len(docs)), key=lambda i: LAST if docs[i][0] is None else docs[i][0])


def _id(doc):
    return LAST if doc is None else doc


def suffix_dedup(docs, width=50):
    raw = [(t or "").encode() for _, t in docs]
    first = {}
    for i in by_order(docs):
        for p in range(len(raw[i]) - width + 1):
            first.setdefault(raw[i][p:p + width], _id(docs[i][0]))
    out = []
    for (doc, _), x in zip(docs, raw):
        gone = bytearray(len(x))
        for p in range(len(x) - width + 1):
            if first[x[p:p + width]] < _id(doc):
                gone[p:p + width] = b"\1" * width
        runs = [r for r in bytes(gone).split(b"\0") if r]
        out.append((doc, len(x), sum(gone), len(runs), hashlib.sha256(bytes(c for c, g in zip(x, gone) if not g)).hexdigest()))
    return out


def substring_dedup(docs, width=20):
    toks = [WORD.findall((t or "").encode()) for _, t in docs]
    first = {}
    for i in by_order(docs):
        for p in range(len(toks[i]) - width + 1):
            first.setdefault(tuple(toks[i][p:p + width]), _id(docs[i][0]))
    out = []
    for (doc, _), w in zip(docs, toks):
        gone, seen = [0] * len(w), set()
        for p in range(len(w) - width + 1):
            x = tuple(w[p:p + width])
            if first[x] < _id(doc) or x in seen:
                gone[p:p + width] = [1] * width
            seen.add(x)
        out.append((doc, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return out


def shingles(text, width):
    w = WORD.findall((text or "").encode().translate(LOWER))
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def near_dup(docs, width=3, per_cent=85):
    sets, holders, parent = {}, defaultdict(list), {}
    for doc, text in docs:
        if doc is not None:
            sets.setdefault(doc, shingles(text, width))
            parent[doc] = doc
    for doc, s in sets.items():
        for x in s:
            holders[x].append(doc)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for doc, s in sets.items():
        common = Counter(e for x in s for e in holders[x] if e < doc)
        for other, n in common.items():
            if 100 * n >= per_cent * (len(s) + len(sets[other]) - n):
                a, b = find(doc), find(other)
                parent[max(a, b)] = min(a, b)
    return [(d, len(shingles(t, width)), None if d is None else find(d), d is None or find(d) == d) for d, t in docs]


def exact_dedup(docs):
    digest = [hashlib.sha256(re.sub("[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest() for _, t in docs]
    groups = defaultdict(list)
    for (doc, _), h in zip(docs, digest):
        groups[h].append(_id(doc))
    least = {h: None if min(g) == LAST else min(g) for h, g in groups.items()}
    return [(doc, least[h], len(groups[h]), doc == least[h], h) for (doc, _), h in zip(docs, digest)]


def top_k(vectors, k=5, every=50, scale=256):
    import math
    ok = [(i, [math.floor(scale * x) for x in v]) for i, v in vectors
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, v in ok:
        if q % every == 0:
            got = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q and len(w) == len(v))[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(got)}
    return sorted(out)


KINDS = {"assign": re.compile(r"((?:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A),
         "access": re.compile(r"AKIA[A-Z0-9]+"), "hex": re.compile(r"[0-9a-f]+")}


def secret_spans(text, classes, allow, allow_whole):
    """(start, kind number, end, kind) of base and added spans."""
    import math
    text, base, more = text or "", [], []
    for no, (kind, pattern) in enumerate(KINDS.items()):
        for m in pattern.finditer(text):
            if len(m[2] if kind == "assign" else m[0]) >= {"assign": 12, "access": 18, "hex": 16}[kind]:
                base.append((m.start(), no, m.end(), kind))
    for no, c in enumerate(classes, 3):
        for m in re.finditer(c.pattern, text):
            if any(re.search(p, m[0]) for p in allow_whole):
                continue
            spans = []
            for i in range(len(m[0]) - c.window + 1):
                counts = Counter(m[0][i:i + c.window]).values()
                if sum(round(n * math.log2(n) * (1 << 20)) for n in counts) <= c.most:
                    a, b = m.start() + i, m.start() + i + c.window
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = b
                    else:
                        spans.append([a, b])
            more += [(a, no, b, c.kind) for a, b in spans if not any(re.search(p, text[a:b]) for p in allow)]
    return sorted(base), sorted(base + more)
