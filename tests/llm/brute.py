"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter

LOWER = {i: i + 32 for i in range(65, 91)}
BLANK_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text):
    words = BLANK_WORDS.findall((text or "").translate(LOWER))
    if len(words) >= 5:
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    return {tuple(words)} if words else set()


def near_duplicates(rows, percent):
    """{key: (shingles, component, kept)} for distinct keys."""
    sets = {k: shingles(t) for k, t in rows}
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_shingle = {}
    for k in sorted(sets):
        shared = Counter(o for s in sets[k] for o in by_shingle.get(s, ()))
        for o, both in shared.items():
            if 100 * both >= percent * (len(sets[k]) + len(sets[o]) - both):
                a, b = find(k), find(o)
                parent[max(a, b)] = min(a, b)
        for s in sets[k]:
            by_shingle.setdefault(s, []).append(k)
    return {k: (len(s), find(k), find(k) == k) for k, s in sets.items()}


def contamination(rows, items):
    patterns = {}
    for item, text in items:
        words = ALNUM_WORDS.findall((text or "").translate(LOWER))
        size = min(13, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            patterns.setdefault(tuple(words[i : i + size]), set()).add(str(item))
    sizes = {len(p) for p in patterns}
    out = []
    for key, text in rows:
        words = ALNUM_WORDS.findall((text or "").translate(LOWER))
        hit, found = [0] * len(words), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                own = patterns.get(tuple(words[i : i + size]))
                if own:
                    found |= own
                    hit[i : i + size] = [1] * size
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((key, len(words), sum(hit), len(found), digest, sum(hit) > 0 and 20 * sum(hit) >= len(words)))
    return out


def repeats(rows, length=50):
    """{key: (bytes, removed, spans, kept)} for distinct keys."""
    seen, out = set(), {}
    for key, text in sorted(rows):
        data = (text or "").encode()
        grams = [data[i : i + length] for i in range(len(data) - length + 1)]
        gone = bytearray(len(data))
        for i, gram in enumerate(grams):
            if gram in seen:
                gone[i : i + length] = b"\1" * length
        seen.update(grams)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[key] = (len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), kept, bytes(gone))
    return out


def cut_text(text, gone):
    """The characters of which a byte stays."""
    out, at = [], 0
    for c in text:
        n = len(c.encode())
        if not all(gone[at : at + n]):
            out.append(c)
        at += n
    return "".join(out)
