"""The contracts, written out plainly over Python lists."""

import hashlib
import re
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LAST = 2**63 - 1


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower_words(text):
    return words((text or "").translate(LOWER))


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def place(doc_id):
    return LAST if doc_id is None else doc_id


def contamination(docs, items):
    found = {}
    for item_id, text in items:
        w = alnum_words(text)
        if item_id is None or not w:
            continue
        n = min(10, len(w))
        for i in range(len(w) - n + 1):
            found.setdefault(tuple(w[i : i + n]), set()).add(str(item_id))
    sizes = {len(w) for w in found}
    out = []
    for doc_id, text in docs:
        w, hit, ids = alnum_words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (own := found.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    ids |= own
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(ids), digest, bool(hit)))
    return sorted(out, key=repr)


_ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def base_secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    kinds = ("assign", "access", "hex")
    return [f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(found)]


def quality(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if windows[tuple(w[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    n = len(w)
    failed = n < 20 or 100 * len(covered) > 30 * n
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return n, sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def shingles(text):
    w = lower_words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def similar(a, b):
    both = len(a & b)
    return bool(a) and bool(b) and 100 * both >= 80 * (len(a) + len(b) - both)


def components(docs):
    """(doc_id, n_shingles, component) of every row; null ids count as the largest."""
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if similar(sets[i], sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), LAST), place(doc_id))
    out = []
    for i, (doc_id, _) in enumerate(docs):
        c = least[find(i)] if sets[i] else place(doc_id)
        out.append((doc_id, len(sets[i]), None if c == LAST else c))
    return sorted(out, key=repr)


def repeats(docs, length=50):
    seen, out = {}, []
    for doc_id, text in sorted(docs, key=lambda d: place(d[0])):
        data, at = (text or "").encode(), place(doc_id)
        mask = bytearray(len(data))
        for p in range(len(data) - length + 1):
            first = seen.setdefault(data[p : p + length], at)
            if first < at:
                mask[p : p + length] = b"\1" * length
        kept = bytes(c for c, m in zip(data, mask, strict=True) if not m)
        spans = len(re.findall(b"\1+", bytes(mask)))
        out.append((doc_id, len(data), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def kept_lines(docs):
    """Text of each (doc_id, text) without lines that match a line before them."""
    rows = set(docs)
    lines = [
        (place(doc_id), i, frozenset(lower_words(line)))
        for doc_id, text in rows
        for i, line in enumerate((text or "").split("\n"))
        if lower_words(line)
    ]
    out = {}
    for doc_id, text in rows:
        kept = []
        for i, line in enumerate((text or "").split("\n")):
            s, at = frozenset(lower_words(line)), (place(doc_id), i)
            if not s or not any((d, j) < at and similar(s, t) for d, j, t in lines):
                kept.append(line)
        out[doc_id, text] = None if text is None else "\n".join(kept)
    return out
