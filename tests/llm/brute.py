"""What the operators should find, in plain Python over small inputs."""

import hashlib
import re
import struct
from collections import Counter, defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def shingles(text, size):
    w = WORDS.findall(low(text))
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def components(docs, size, cent):
    """doc_id -> (set size, component), comparing all pairs that share a shingle."""
    sets = {d: shingles(t, size) for d, t in docs.items()}
    parent = {d: d for d in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    at = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            at[x].append(d)
    seen = set()
    for own in at.values():
        for i, a in enumerate(own):
            for b in own[i + 1 :]:
                if (a, b) in seen:
                    continue
                seen.add((a, b))
                both = len(sets[a] & sets[b])
                if 100 * both >= cent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in docs}


def contamination(docs, items, window=10):
    owners = defaultdict(set)
    for i, text in items:
        w = ITEM_WORDS.findall(low(text))
        size = min(window, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            owners[tuple(w[k : k + size])].add(i)
    sizes = {len(k) for k in owners}
    out = {}
    for d, text in docs.items():
        w = ITEM_WORDS.findall(low(text))
        hit, found = [False] * len(w), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                names = owners.get(tuple(w[k : k + n]))
                if names:
                    found |= names
                    hit[k : k + n] = [True] * n
        names = ",".join(sorted(map(str, found)))
        out[d] = (len(w), sum(hit), len(found), sha(names.encode()), any(hit))
    return out


def repeats(docs, length=200):
    seen = Counter()
    for text in docs.values():
        b = (text or "").encode()
        seen.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = {}
    for d, text in docs.items():
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[d] = (len(b), sum(gone), runs, sha(kept))
    return out


def statistics(text):
    text = text or ""
    w = WORDS.findall(text)
    n = len(w)
    count = Counter(tuple(w[i : i + 3]) for i in range(n - 2))
    covered = set()
    for i in range(n - 2):
        if count[tuple(w[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    failed = n < 50 or 100 * len(covered) > 50 * n
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered), failed)


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)
