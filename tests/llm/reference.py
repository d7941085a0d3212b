"""Plain, slow versions of what the operators compute, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_measures(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = Counter(windows)
    inside = {i + j for i, w in enumerate(windows) if count[w] > 1 for j in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def conversation(turns):
    """n_turns, turns digest, loss characters, loss digest of (role, text) in order."""
    said, loss = hashlib.sha256(), hashlib.sha256()
    chars = 0
    for role, text in turns:
        said.update(f"{role or ''}\n{text or ''}\n".encode())
        if role == "assistant":
            loss.update((text or "").encode())
            chars += len(text or "")
    return len(turns), said.hexdigest(), chars, loss.hexdigest()


def simhash(text):
    low = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")
    words = WORD.findall(low)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(items, linked):
    """Least item reachable from each, comparing all pairs."""
    root = {i: i for i in items}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    items = sorted(items)
    for n, a in enumerate(items):
        for b in items[n + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in items}


def grouped(rows, key):
    out = defaultdict(list)
    for row in rows:
        out[row[key]].append(row)
    return out
