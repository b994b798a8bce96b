"""Plain statements of what the operators return, for small tables."""

import hashlib
import math
import re
import string
import struct
from collections import Counter, defaultdict

import xxhash

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def xxh(*values):
    """XXH64 of numbers, each ("i" for 32 or "q" for 64 bits, number), seeded by the hash of those before; signed."""
    out = 42
    for kind, x in values:
        out = xxhash.xxh64(struct.pack("<" + kind, x), seed=out).intdigest()
    return out - (1 << 64 if out >> 63 else 0)


def top_k(rows, every=50, k=5):
    vectors = {i: [math.floor(256 * x) for x in v] for i, v in rows
               if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q, a in vectors.items():
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in vectors.items() if c != q and len(a) == len(b))
            out |= {(q, n + 1, c, -s) for n, (s, c) in enumerate(scores[:k])}
    return out


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_duplicates(rows):
    prints = [(i, simhash(t)) for i, t in rows]
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if bin(prints[a][1] ^ prints[b][1]).count("1") <= 3:
                root[find(a)] = find(b)
    least = {}
    for n, (i, _) in enumerate(prints):
        r = find(n)
        least[r] = min(x for x in (least.get(r), i) if x is not None) if (least.get(r), i) != (None, None) else None
    return Counter((i, f"{f:016x}", least[find(n)]) for n, (i, f) in enumerate(prints))


def suffix_dedup(rows, length=400):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(d[s:s + length] for _, d in data for s in range(len(d) - length + 1))
    out = []
    for i, d in data:
        gone = bytearray(len(d))
        for s in range(len(d) - length + 1):
            if seen[d[s:s + length]] > 1:
                gone[s:s + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((i, len(d), sum(gone), len(re.findall(b"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def luhn(number):
    total = 0
    for n, c in enumerate(reversed(number)):
        x = int(c) * (1 + n % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


PATTERNS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def base_spans(text):
    return [(kind, m.start(), m.end()) for kind, (p, ok) in PATTERNS.items() for m in re.finditer(p, text or "", re.A) if ok(m.group())]


def next_texts(rows):
    ordered = sorted(((i is not None, i or 0, t or "", i) for i, t in rows), key=lambda r: r[:3])
    return [(r[3], r[2], ordered[(n + 1) % len(ordered)][2]) for n, r in enumerate(ordered)]


def warc(rows):
    items = [(i, (h or "").encode()) for i, h in rows]
    keep = defaultdict(lambda: None)
    for i, d in items:
        if i is not None:
            keep[d] = i if keep[d] is None else max(keep[d], i)
    count = Counter(d for _, d in items)
    out = []
    for i, d in items:
        again = len(d) >= 1000 and count[d] > 1 and keep[d] is not None and i != keep[d]
        out.append((i, len(d), hashlib.sha1(d).hexdigest(), "revisit" if again else "response", keep[d] if again else None))
    return Counter(out)
