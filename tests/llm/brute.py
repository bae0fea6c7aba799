"""Plain-Python versions of what the operators compute."""

from collections import Counter, defaultdict
from itertools import combinations


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def lower_words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingles(ws: list[bytes], width: int) -> set[tuple[bytes, ...]]:
    if not ws:
        return set()
    width = min(width, len(ws))
    return {tuple(ws[i : i + width]) for i in range(len(ws) - width + 1)}


def near_duplicates(docs: list[tuple[int, str | None]], width: int) -> dict[int, int]:
    """Component of every document, by comparing all pairs that share a shingle."""
    sets = {i: shingles(lower_words(t), width) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            holders[x].add(i)
    shared = Counter(p for own in holders.values() for p in combinations(sorted(own), 2))
    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in sets}


def contained(docs: list[tuple[int, str | None]], items: list[tuple[int, str | None]], width: int = 5) -> set[tuple[int, int]]:
    """Document and item of every pair where the document holds 80 % of the item's shingles."""
    found = set()
    for item_id, item in items:
        ws = lower_words(item)
        if not ws:
            continue
        w = min(width, len(ws))
        wanted = shingles(ws, w)
        for doc_id, text in docs:
            own = lower_words(text)
            held = {tuple(own[i : i + w]) for i in range(len(own) - w + 1)}
            if 100 * len(wanted & held) >= 80 * len(wanted):
                found.add((doc_id, item_id))
    return found


def repeated_words(ws: list[bytes]) -> int:
    runs = [tuple(ws[i : i + 5]) for i in range(len(ws) - 4)]
    counts = Counter(runs)
    return len({i + k for i, r in enumerate(runs) if counts[r] > 1 for k in range(5)})


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0
