"""Plain versions of the operators, row by row, as the specification reads."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def base_counts(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    covered = set()
    for i, x in enumerate(windows):
        if often[x] > 1:
            covered |= {i, i + 1, i + 2}
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def base_failed(text):
    n, _, _, _, r = base_counts(text)
    return n < 50 or 100 * r > 50 * n


def targets(sizes: dict, weights=(3, 1, 2), share=1.5, most=2):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, out = sum(sizes.values()) * share, {}
    while True:
        free = [s for s in order if s not in out]
        left = total - sum(out.values())
        w = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / w > most * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / w for s in free}
        out |= {s: float(most * sizes[s]) for s in over}


def crc(text):
    return zlib.crc32((text or "").encode())


def fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    ones = np.zeros(64, int)
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        ones += np.array([h >> b & 1 for b in range(64)])
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def groups(nodes, links):
    """node -> smallest node reachable."""
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            up[n] = up[up[n]]
            n = up[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def by_value(rows, key, value):
    out = defaultdict(list)
    for r in rows:
        out[value(r)].append(key(r))
    return out


def line_chunks(text):
    """``(first, end)`` of the chunks of a text, each place looked at by itself."""
    lines = (text or "").encode().split(b"\n")
    n, size = len(lines), [len(x.split()) for x in lines]
    code = [xxhash.xxh64_intdigest(x) for x in lines]
    base, top = 0x9E3779B97F4A7C15, 1 << 64
    out = set()
    for alone in (False, True):
        ends = []
        for i in range(n):
            rolling = ((code[i - 1] if i else 0) * base + code[i]) % top
            long_line = alone and size[i] >= 50
            if (rolling * base % top >> 32) % 3 == 0 or i + 1 == n or long_line or (alone and i + 1 < n and size[i + 1] >= 50):
                ends.append(i + 1)
        for a, b in zip([0, *ends], ends):
            full = sum(x > 0 for x in size[a:b])
            if sum(size[a:b]) >= 8 and (full > 1 or (b - a == 1 and size[a] >= 50)):
                out.add((a, b))
    # Runs that no line can be taken from, at the end for those that begin at a line, at the start for those that end at one.
    for a in range(n):
        for b in range(a + 1, n + 1):
            if not size[a] or not size[b - 1] or sum(size[a:b]) < 50:
                continue
            inner = [i for i in range(a, b) if size[i]]
            if len(inner) == 1:
                out.add((a, b))
                continue
            without_last, without_first = sum(size[a : inner[-1]]), sum(size[inner[1] : b])
            blanks = len(inner) == 2 and b - a > 2 and min(size[a], size[b - 1]) >= 50
            if without_last < 50 or without_first < 50 or blanks:
                out.add((a, b))
            elif without_first >= 50 and len(inner) > 2:
                break
    return out


def repeated_lines(texts):
    """``key -> lines`` that go: occurrences after the first, inside one text only beside it and never what is first itself."""
    places = defaultdict(list)
    for k, t in texts.items():
        lines = (t or "").split("\n")
        for a, b in line_chunks(t):
            places["\n".join(lines[a:b])].append((k, a, b))
    gone, repeat, kept = defaultdict(set), defaultdict(set), defaultdict(set)
    for found in places.values():
        (k0, a0, b0), *late = sorted(found)
        if not late:
            continue
        kept[k0].update(range(a0, b0))
        for k, a, b in late:
            if k != k0:
                gone[k].update(range(a, b))
            elif a >= b0:
                repeat[k].update(range(a, b))
    return {k: gone[k] | (repeat[k] - kept[k]) for k in texts}
