"""Slow and plain versions of what the operators compute."""

import re

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def near_brute(rows, size=5, percent=75):
    """{row number: (set size, smallest id reachable)} of (doc_id, text) rows, by comparing all pairs."""
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        k = min(size, len(words))
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return {i: (len(sets[i]), least.get(find(i))) for i in range(len(rows))}


def benchmark_brute(docs, items, window=10):
    """(n_words, n_hit, items) of each text."""

    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))

    windows = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    lengths = {len(w) for w in windows}
    out = []
    for text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if of := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= of
        out.append((len(w), len(hit), sorted(found)))
    return out


def varint(n):
    return bytes([n]) if n < 128 else bytes([n & 127 | 128]) + varint(n >> 7)


def message(*fields):
    """A protocol-buffers message of (number, value) fields."""
    return b"".join(varint(n << 3) + varint(v) if isinstance(v, int) else varint(n << 3 | 2) + varint(len(v)) + v for n, v in fields)
