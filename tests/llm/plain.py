"""Plain versions of the text operators' results, for small tables."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def remainder(doc_id, n: int) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(digits[::-1]):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def personal(text: str | None) -> str:
    spans = []
    for rank, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            spans.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans))


def unigram(docs):
    seen = collections.Counter()
    for i, text in docs:
        if remainder(i, 7) != 2:
            seen.update(words(lower(text or "")))
            seen["\0end"] += 1
    n, v = sum(seen.values()), len(seen)
    out = []
    for i, text in docs:
        w = [*words(lower(text or "")), "\0end"]
        out.append((i, remainder(i, 7) == 2, len(w), sum(seen[t] > 0 for t in w), n, round(sum(math.log10((seen[t] + 1) / (n + v + 1)) for t in w), 5)))
    return out


def repeats(docs, size=35):
    seen = collections.Counter()
    for _, text in docs:
        w = words(text)
        seen.update(tuple(w[k : k + size]) for k in range(len(w) - size + 1))
    out = []
    for i, text in docs:
        w = words(text)
        stay = [True] * len(w)
        for k in range(len(w) - size + 1):
            if seen[tuple(w[k : k + size])] > 1:
                stay[k : k + size] = [False] * size
        kept = " ".join(x for x, s in zip(w, stay) if s)
        out.append((i, len(w), len(w) - sum(stay), sha(kept)))
    return out


def test_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def contaminated(docs, items, size=10):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = test_words(text)
        if 0 < len(w) < size:
            windows[tuple(w)].add(item)
        for k in range(len(w) - size + 1):
            windows[tuple(w[k : k + size])].add(item)
    out = []
    for i, text in docs:
        w = test_words(text)
        hit, found = [False] * len(w), set()
        for n in {len(g) for g in windows}:
            for k in range(len(w) - n + 1):
                g = tuple(w[k : k + n])
                if g in windows:
                    found |= windows[g]
                    hit[k : k + n] = [True] * n
        ids = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), sum(hit), len(ids), sha(",".join(ids)), any(hit)))
    return out


def quality_counts(text: str | None):
    text = text or ""
    w = words(text)
    grams = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    again = [False] * len(w)
    for k in range(len(w) - 2):
        if grams[tuple(w[k : k + 3])] > 1:
            again[k : k + 3] = [True] * 3
    lines = [x for x in text.split("\n") if words(x)]
    failed = len(w) < 50 or 100 * sum(again) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), sum(again), failed


def shingles(text: str | None, n=5) -> set:
    w = words(lower(text or ""))
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}


def near(docs, percent=85):
    """Rows of the contract; rows are nodes, so ids may repeat."""
    sets = [shingles(t) for _, t in docs]
    up = list(range(len(docs)))

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    for a in range(len(docs)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                up[max(root(a), root(b))] = min(root(a), root(b))
    least = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            r = root(k)
            least[r] = min(least.get(r, i), i)
    return [(i, len(sets[k]), c := least.get(root(k)) if sets[k] else i, i == c) for k, (i, _) in enumerate(docs)]
