"""Plain Python versions of what the operators compute."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spaced_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def crc(text):
    return zlib.crc32((text or "").encode())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def fingerprint(text):
    w = spaced_words(text)
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, distance=2):
    """Smallest key reachable over links of at most ``distance`` bits."""
    root = {k: k for k in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(fps)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if bin(fps[a] ^ fps[b]).count("1") <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def contamination(text, items):
    """(words, hit words, sorted ids of occurring items)."""
    w = plain_words(text)
    hit, found = set(), set()
    for item, body in items:
        iw = plain_words(body)
        for i in range(max(1, len(iw) - 12) if iw else 0):
            win = iw[i:i + 13]
            for p in range(len(w) - len(win) + 1):
                if w[p:p + len(win)] == win:
                    hit.update(range(p, p + len(win)))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


def contaminated(text, items):
    n, h, _ = contamination(text, items)
    return h > 0 and 20 * h >= n


def mix(rows, seed="mix"):
    """rows (key, doc_id, text, source) -> {key: (size, source_size, target, taken, copies)}."""
    size = {k: len(spaced_words(t)) for k, _, t, _ in rows}
    by = defaultdict(list)
    for k, d, _, s in rows:
        by[s].append((hashlib.md5((seed + ("" if d is None else str(d))).encode()).hexdigest(), size[k], k))
    names = sorted(by, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total = {s: sum(n for _, n, _ in by[s]) for s in names}
    target, free, left = {}, set(names), sum(total.values())
    while free:  # reshare the excess until none is above
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * total[s]}
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = 3.0 * total[s]
            left -= 3 * total[s]
        free -= over
    out = {}
    for s in names:
        quota, at = int(target[s] + 0.5), 0
        whole, rest = divmod(quota, total[s]) if total[s] else (0, 0)
        for _, n, k in sorted(by[s]):
            part = min(n, max(0, rest - at))
            out[k] = (n, total[s], target[s], whole * n + part, (whole + (2 * part >= n)) if n else 0)
            at += n
    return out


def class_tokens(text):
    return spaced_words(text) + [None]


def base_counts(texts):
    return Counter(t for x in texts for t in class_tokens(x))
