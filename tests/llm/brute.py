"""Plain Python versions of the operators, written from their contracts alone."""

import hashlib
import re
import zlib

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def simhash(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(t)
    if not w:
        return 0
    shingles = [" ".join(w)] if len(w) < 3 else [" ".join(w[i : i + 3]) for i in range(len(w) - 2)]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(ids, fps, bits=3):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        find(i)
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    low = {}
    for i, x in enumerate(ids):
        if x is not None:
            r = find(i)
            low[r] = min(low.get(r, x), x)
    return [low.get(find(i)) for i in range(len(ids))]


def remove_repeats(texts, length=400):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for b in raw:
        for i in range(len(b) - length + 1):
            k = b[i : i + length]
            seen[k] = seen.get(k, 0) + 1
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def token_ids(tok, text, end=2):
    return [*tok.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def tile(doc, item, m):
    """Greedy string tiling by comparing all places."""
    m = max(1, min(m, len(item)))
    in_doc, in_item, tiles = set(), set(), []
    while True:
        best = (0, 0, 0)
        for i in range(len(doc)):
            for j in range(len(item)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n] and i + n not in in_doc and j + n not in in_item:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < m:
            return tiles
        tiles.append((i, j, n))
        in_doc |= set(range(i, i + n))
        in_item |= set(range(j, j + n))
