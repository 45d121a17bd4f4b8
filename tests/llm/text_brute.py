"""Plain Python versions of what the operators must give."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def lower_words(text):
    return words((text or "").translate(LOWER))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def low(key):
    return (0, 0) if key is None else (1, key)


def shingles(text):
    w = lower_words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near_duplicates(docs):
    """Counter of (doc_id, set size, component); rows of one id are linked."""
    sets = [(d, shingles(t)) for d, t in docs]
    parent = {d: d for d, _ in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for g in s:
            holders[g].append(i)
    common = Counter((a, b) for at in holders.values() for k, a in enumerate(at) for b in at[k + 1 :])
    for (a, b), both in common.items():
        if 100 * both >= 80 * (len(sets[a][1]) + len(sets[b][1]) - both):
            x, y = sorted((find(sets[a][0]), find(sets[b][0])), key=low)
            parent[y] = x
    return Counter((d, len(s), find(d)) for d, s in sets)


def quality(text):
    text = text or ""
    w = words(text)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = [0] * len(w)
    for i in range(len(w) - 4):
        if grams[tuple(w[i : i + 5])] > 1:
            covered[i : i + 5] = [1] * 5
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n, repeat = len(w), sum(covered)
    return (
        n,
        sum(map(len, w)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        repeat,
        n < 10 or 100 * repeat > 20 * n,
    )


def remove_repeats(docs, size=13):
    first = {}
    lists = [(d, words(t)) for d, t in docs]
    for d, w in sorted(lists, key=lambda x: low(x[0])):
        for i in range(len(w) - size + 1):
            first.setdefault(tuple(w[i : i + size]), d)
    out = Counter()
    for d, w in lists:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if low(first[tuple(w[i : i + size])]) < low(d):
                gone[i : i + size] = [True] * size
        out[d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)] += 1
    return out


def dedup_lines(docs, min_chars=40, min_docs=5):
    strip = " \t\n\x0b\x0c\r"
    key = lambda x: x.strip(strip).translate(LOWER)
    holders = defaultdict(set)
    for d, t in docs:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars:
                holders[key(x)].add(d)
    last = {k: max(ds, key=low) for k, ds in holders.items() if len(ds) >= min_docs}
    out = Counter()
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if last.get(key(x), d) == d]
        out[d, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


def contaminated(docs, items):
    """{(doc_id, item_id): (start, similarity)} of the best windows."""
    best = {}
    for d, t in docs:
        w = lower_words(t)
        for i, it in items:
            v = lower_words(it)
            n, g = len(v), min(5, len(v))
            if not n:
                continue
            own = Counter(tuple(v[k : k + g]) for k in range(n - g + 1))
            if not set(v) & set(w):
                continue
            for start in range(len(w) - n + 1):
                have = Counter(tuple(w[k : k + g]) for k in range(start, start + n - g + 1))
                both = sum((have & own).values())
                s = both / (2 * (n - g + 1) - both)
                if s >= 0.8 and ((d, i) not in best or s > best[d, i][1]):
                    best[d, i] = (start, s)
    return best


def ids(tokenizer, text, end):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def crc(tokens):
    return zlib.crc32(b"".join(x.to_bytes(4, "little") for x in tokens))
