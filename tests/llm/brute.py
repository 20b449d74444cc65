"""Plain versions of the operators, one text at a time."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import xxhash


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(digits[::-1]):
        d = int(c) * (1 + place % 2)
        total += d // 10 + d % 10
    return total % 10 == 0


def pii(text: str | None) -> list[tuple[str, int, int]]:
    def digits(s: str) -> str:
        return re.sub("[^0-9]", "", s)

    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(digits(s)) <= 15),
    ]
    return spans(text, rules)


def secrets(text: str | None) -> list[tuple[str, int, int]]:
    rules = [
        ("assign", r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", None),
        ("access", r"AKIA[A-Z0-9]+", lambda s: len(s) >= 16),
        ("hex", r"[0-9a-f]+", lambda s: len(s) >= 32),
    ]
    return spans(text, rules)


def spans(text, rules) -> list[tuple[str, int, int]]:
    found = []
    for order, (kind, pattern, good) in enumerate(rules):
        for m in re.finditer(pattern, text or ""):
            if good(m.group()) if good else len(m.group(2)) >= 8:
                found.append((m.start(), order, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def lower_ascii(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text or ""))


def contamination(text: str | None, items: list[tuple[int, str | None]], window: int = 10):
    """(n_words, hit word numbers, item ids)"""
    own = words(text)
    hit, found = set(), set()
    for item, body in items:
        seq = words(body)
        size = min(window, len(seq))
        for i in range(len(seq) - size + 1) if seq else ():
            gram = seq[i : i + size]
            for j in range(len(own) - size + 1):
                if own[j : j + size] == gram:
                    hit |= set(range(j, j + size))
                    found.add(str(item))
    return len(own), hit, sorted(found)


def fingerprint(text: str | None) -> int:
    own = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text or ""))
    grams = [own[i : i + 4] for i in range(len(own) - 3)] or ([own] if own else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids: list[int], prints: list[int], bits: int = 4) -> list[int]:
    values = np.array(prints, dtype=np.uint64)
    root = list(range(len(ids)))

    def top(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(values[: i + 1] ^ values[i]) <= bits).tolist():
            a, b = top(i), top(j)
            root[max(a, b)] = min(a, b)
    least: dict[int, int] = {}
    for i, x in enumerate(ids):
        least[top(i)] = min(least.get(top(i), x), x)
    return [least[top(i)] for i in range(len(ids))]


def top_k(rows: list[tuple[int, list | None]], every: int = 50, k: int = 5) -> list[tuple[int, int, int, int]]:
    good = [
        (i, [int(np.floor(256 * float(x))) for x in v])
        for i, v in rows
        if v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for q, qv in good:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(qv, v, strict=True)), i) for i, v in good if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)
