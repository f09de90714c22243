"""Plain Python versions of the contracts, for small tables."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def secrets(text):
    text = text or ""
    found = [[m for m in ASSIGN.finditer(text) if len(m[2]) >= 6],
             [m for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20],
             [m for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]]
    spans = sorted((m.start(), k, m.end()) for k, ms in enumerate(found) for m in ms)
    base = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in spans)
    return (*map(len, found), sha(base)), base


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    covered = {i + d for i, g in enumerate(grams) if often[g] > 1 for d in range(3)}
    n, repeat = len(words), len(covered)
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), repeat, n < 50 or 100 * repeat > 50 * n


def substring_words(rows, window=20):
    """rows: (doc_id, text), ids may repeat. -> [(doc_id, n_words, n_removed, sha)]"""
    docs = [(d, WORD.findall(t or "")) for d, t in rows]
    key = lambda d, i: ((d is None, d or 0), i)
    first = {}
    for d, w in docs:
        for i in range(len(w) - window + 1):
            g = tuple(w[i:i + window])
            if g not in first or key(d, i) < first[g]:
                first[g] = key(d, i)
    out = []
    for d, w in docs:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < key(d, i):
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def line_key(line):
    key = line.strip(" \t\n\x0b\x0c\r")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in key)


def lines(rows, least=40, docs=5):
    split = [(d, (t or "").split("\n")) for d, t in rows]
    holders = {}
    for d, ls in split:
        for x in ls:
            if len(k := line_key(x)) >= least:
                holders.setdefault(k, set()).add(d)
    order = lambda d: (d is not None, d or 0)
    last = {k: max(v, key=order) for k, v in holders.items() if len(v) >= docs}
    out = []
    for d, ls in split:
        stay = [x for x in ls if (k := line_key(x)) not in last or last[k] == d]
        out.append((d, len(ls), len(ls) - len(stay), sha("\n".join(stay))))
    return out


def simhash(text):
    import xxhash

    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(items, radius=3):
    """items: [(doc_id, fingerprint)] -> the smallest id reachable for each."""
    group = list(range(len(items)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if (items[i][1] ^ items[j][1]).bit_count() <= radius:
                group[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(items):
        if d is not None:
            r = root(i)
            least[r] = min(d, least.get(r, d))
    return [least.get(root(i)) for i in range(len(items))]


def substring_bytes(texts, window=200):
    docs = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + window] for b in docs for i in range(len(b) - window + 1))
    out = []
    for b in docs:
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if seen[b[i:i + window]] > 1:
                gone[i:i + window] = b"\1" * window
        out.append((len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def contamination(docs, items, window=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    windows = {}
    for i, t in items:
        w = split(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[k:k + window]), set()).add(i)
    lengths = {len(g) for g in windows}
    out = []
    for d, t in docs:
        w, hit, found = split(t), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if (g := tuple(w[k:k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[g]
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit)))
    return out
