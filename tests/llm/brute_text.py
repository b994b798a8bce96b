"""Plain statements of what operators 11 to 13 return, for small tables."""

import hashlib
import math
import re
import string
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def spelling(rows, every=97, length=5, count=3):
    words = Counter()
    for i, t in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            words[run] += 1
    words = {w: n for w, n in words.items() if len(w) >= length and n >= count}
    form, links = {}, {}
    for w, n in words.items():
        others = [v for v in words if abs(len(v) - len(w)) < 2 and near(v, w)]
        links[w] = len(others)
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, links[w], words.get(form[w])))
    return Counter(out)


def conversation_trie(rows, group=5, kept=9):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    for c in turns:
        turns[c].sort(key=lambda r: (r[:2], hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()[:16]))
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % kept
        base = c - int(math.fmod(c, group))
        built[c] = [r[2:] for r in turns.get(base, [])[:h] + own[h:]]
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    kids, leaves, saved = Counter(), Counter(), Counter()
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += kids[node] == 0
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1].encode()) if node else 0
    return Counter(
        (min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), kids[node], leaves[node], saved[node],
         hashlib.sha256(",".join(str(c) for c in sorted(convs) if len(built[c]) == len(node)).encode()).hexdigest())
        for node, convs in members.items())


def good_turing(counts, most=5):
    n = Counter(counts)
    for k in range(most, 0, -1):
        if any(n[r] == 0 for r in range(1, k + 2)) or (k + 1) * n[k + 1] >= n[1]:
            continue
        a = (k + 1) * n[k + 1] / n[1]
        d = {r: ((r + 1) * n[r + 1] / n[r] / r - a) / (1 - a) for r in range(1, k + 1)}
        if all(0 < x < 1 for x in d.values()):
            return lambda r: r * d.get(r, 1.0)
    return lambda r: r - 0.5


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + ["</s>"]


class Katz:
    def __init__(self, texts):
        self.words, self.pairs, self.contexts = Counter(), Counter(), Counter()
        for t in texts:
            x = tokens(t)
            self.words.update(x)
            for v, w in zip(["<s>"] + x, x):
                self.pairs[v, w] += 1
                self.contexts[v] += 1
        self.n = sum(self.words.values())
        star = good_turing(self.words.values())
        self.p = {w: star(r) / self.n for w, r in self.words.items()}
        self.unknown = 1 - sum(self.p.values()) if self.n else 1.0
        self.star = good_turing(self.pairs.values())
        self.after = defaultdict(list)
        for v, w in self.pairs:
            self.after[v].append(w)
        self.cache = {}

    def context(self, v):
        if v not in self.cache:
            kept = sum(self.star(self.pairs[v, w]) for w in self.after[v])
            whole = self.contexts[v]
            if all(self.star(self.pairs[v, w]) == self.pairs[v, w] for w in self.after[v]):
                whole += 1
            self.cache[v] = whole, (1 - kept / whole) / (1 - sum(self.p[w] for w in self.after[v]))
        return self.cache[v]

    def prob(self, w, v):
        lower = self.p.get(w, self.unknown)
        if not self.contexts[v]:
            return lower
        whole, weight = self.context(v)
        return self.star(self.pairs[v, w]) / whole if (v, w) in self.pairs else weight * lower

    def score(self, text):
        x = tokens(text)
        base = sum(math.log10((self.words[w] + 1) / (self.n + len(self.words) + 1)) for w in x)
        return len(x), sum(w in self.words for w in x), base, sum(math.log10(self.prob(w, v)) for v, w in zip(["<s>"] + x, x))


def katz(rows):
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    model = Katz([t for (_, t), h in zip(rows, held) if not h])
    out = []
    for (i, t), h in zip(rows, held):
        n, known, base, score = model.score(t)
        out.append((i, h, n, known, model.n, base, score))
    return model, out
