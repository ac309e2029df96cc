"""Plain Python versions of operators that SQL cannot express."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(UPPER, UPPER.lower())
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def shingles(text: str | None, n: int = 5) -> frozenset:
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def links(texts: list[str | None], similarity: float = 0.8) -> tuple[list[int], list[int]]:
    """Number of links and first row of its component, for every row."""
    sets = [shingles(t) for t in texts]
    n, root = [0] * len(sets), list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by[x].append(i)
    shared = Counter((a, b) for rows in by.values() for k, a in enumerate(rows) for b in rows[k + 1:])
    for (a, b), c in shared.items():
        if c >= similarity * (len(sets[a]) + len(sets[b]) - c) - 1e-9:
            n[a] += 1
            n[b] += 1
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return n, [find(i) for i in range(len(sets))]


PERSONAL = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def personal(text: str | None) -> list[str]:
    out = []
    for kind, pattern in PERSONAL.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15,
            }[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def held_out(doc_id: int, folds: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % folds == 0


def katz(docs: dict[int, str | None], discounts) -> dict[int, tuple]:
    """By id: tokens, known tokens, training tokens, base score, score; and checks that probabilities sum to one."""
    toks = {d: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)), "\n"] for d, t in docs.items()}
    uni, pair, hist = Counter(), Counter(), Counter()
    for d, t in toks.items():
        if not held_out(d, 10):
            uni.update(t)
            for h, w in zip(["\t", *t], t, strict=False):
                pair[h, w] += 1
                hist[h] += 1
    of = lambda c: [sum(v == r for v in c.values()) for r in range(1, 7)]
    pf, wf = discounts(of(pair)), discounts(of(uni))
    n, v = sum(uni.values()), len(uni)
    cut = lambda c, f: c * f[min(c, 6)]
    unknown = 1 - sum(cut(c, wf) for c in uni.values()) / (n + 1)
    word = lambda w: cut(uni[w], wf) / (n + 1) if uni[w] else unknown
    kept, covered = Counter(), Counter()
    for (h, w), c in pair.items():
        kept[h] += cut(c, pf)
        covered[h] += word(w)

    def p(h, w):
        if not hist[h]:
            return word(w)
        if pair[h, w]:
            return cut(pair[h, w], pf) / (hist[h] + 1)
        return (hist[h] + 1 - kept[h]) / (hist[h] + 1) / (1 - covered[h]) * word(w)

    for h in [*list(hist)[:3], "unknown history"]:
        assert abs(sum(p(h, w) for w in uni) + p(h, "an unknown word") - 1) < 1e-6
    return {
        d: (len(t), sum(uni[w] > 0 for w in t), n, sum(math.log10((uni[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t),
            sum(math.log10(p(h, w)) for h, w in zip(["\t", *t], t, strict=False)))
        for d, t in toks.items()
    }


def periodic_runs(w, repeats=4, shortest=6):
    """All runs (start, length, period), lag by lag over whole texts."""
    n, found = len(w), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(shortest, repeats * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def best_run(runs):
    return max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))


def rule_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    at = defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i:i + 3])].append(i)
    inside = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(3)}
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(inside)]


def isolation_paths(nodes, roots, rows):
    """Mean path length of each row, node by node."""
    out = []
    for x in rows:
        total = 0.0
        for at in roots:
            while nodes[at][0] >= 0:
                at = int(nodes[at][2]) + (x[nodes[at][0]] >= nodes[at][1])
            total += nodes[at][3]
        out.append(total / len(roots))
    return out


def fails(text):
    """The filters that look at one text."""
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
        "D": re.search(r"[#$%&*|]", text) is not None,
    }
