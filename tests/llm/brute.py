"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import xxhash

BLANK = " \t\n\x0b\x0c\r"
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def luhn(digits: str) -> bool:
    values = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


def base_spans(text: str) -> list[tuple]:
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 10 <= len(digits) <= 15,
            }[kind]()
            if good:
                out.append((m.start(), k, kind, m.end()))
    return sorted(out)


def kept_lines(docs: list[tuple]) -> list[tuple]:
    """(id, lines, dropped, text) of (id, text)."""
    key = lambda line: line.strip(BLANK).translate(ASCII)
    first = {}
    for i, text in docs:
        for line in (text or "").split("\n") if i is not None else ():
            if len(key(line)) >= 10:
                first[key(line)] = min(i, first.get(key(line), i))
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        stay = [x for x in lines if i is None or first.get(key(x), i) >= i]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def fingerprint(text) -> int:
    words = [w for w in re.split(f"[{BLANK}]+", (text or "").translate(ASCII)) if w]
    grams = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids: list, links: list[tuple]) -> dict:
    """id -> smallest id reachable."""
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {i: top(i) for i in ids}


def near_components(docs: list[tuple], bits: int = 2) -> dict:
    prints = {i: fingerprint(t) for i, t in docs}
    ids = sorted(prints)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (prints[a] ^ prints[b]).bit_count() <= bits]
    return groups(ids, links)


def contaminated(docs: list[tuple], items: list[tuple], size: int = 13) -> list[tuple]:
    """(id, words, hit words, items, contaminated)."""
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(ASCII))
    owners = defaultdict(set)
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - size + 1) if w and item is not None else 0):
            owners[tuple(w[k : k + size])].add(str(item))
    sizes, out = {len(k) for k in owners}, []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in owners:
                    hit.update(range(k, k + n))
                    found |= owners[tuple(w[k : k + n])]
        out.append((i, len(w), len(hit), ",".join(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)))
    return out
