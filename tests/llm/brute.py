"""Plain Python versions of the operators, and small documents with the cases that matter."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re


def prose(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{int(rng.paretovariate(0.7)) % words}" for _ in range(n))


def documents(seed: int = 3) -> list[tuple]:
    """(doc_id, text): near copies in chains, exact copies, a shared passage, short, odd and null texts."""
    rng = random.Random(seed)
    out, passage = [], prose(rng, 40, 10_000)
    base = [prose(rng, rng.randint(30, 160), 3_000) for _ in range(12)]
    for text in base:
        out.append(text)
        for _ in range(4):  # a chain: each edits the one before
            words = text.split()
            for _ in range(2):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10_000)}"
            text = " ".join(words)
            out.append(text)
    out += [base[0]] * 9 + [f"{prose(rng, 20)} {passage}\n{prose(rng, 25)}" for _ in range(14)]
    out += ["", "   ", None, "one", "one two", "One TWO", "É è x", "a b c", prose(rng, 6_000), "la " * 60, "\n".join(["same line here"] * 8)]
    rng.shuffle(out)
    rows = list(enumerate(out))
    return rows + [rows[0], rows[5], (None, base[1]), (None, None)]


def words(text, lower=False):
    raw = (text or "").encode()
    return (raw.lower() if lower else raw).split()


def kept_words(rows, size=13):
    """Words left of every row when windows of a smaller doc_id are cut."""
    first: dict = {}
    for i, text in sorted(((i, t) for i, t in rows if i is not None), key=lambda r: r[0]):
        w = words(text)
        for k in range(len(w) - size + 1):
            first.setdefault(tuple(w[k:k + size]), i)
    out = []
    for i, text in rows:
        w = words(text)
        gone = [False] * len(w)
        if i is not None:
            for k in range(len(w) - size + 1):
                if first[tuple(w[k:k + size])] < i:
                    gone[k:k + size] = [True] * size
        out.append([x for x, g in zip(w, gone, strict=True) if not g])
    return out


def shingles(text, size):
    w = words(text, lower=True)
    if not w:
        return frozenset()
    return frozenset(tuple(w[k:k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)])


def groups(rows, size, num, den=100):
    """(shingles, smallest id of the group) by id."""
    sets = {i: shingles(t, size) for i, t in rows if i is not None}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if den * common >= num * (len(sets[a]) + len(sets[b]) - common):
                    x, y = find(a), find(b)
                    up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def item_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def contaminated(text, items, size=10):
    """n_words, n_hit, items_sha256 of one text."""
    w, hit, found = item_words(text), set(), set()
    for item, t in items:
        v = item_words(t)
        n = min(size, len(v))
        cut = {tuple(v[k:k + n]) for k in range(len(v) - n + 1)} if n else set()
        for k in range(len(w) - n + 1):
            if n and tuple(w[k:k + n]) in cut:
                hit |= set(range(k, k + n))
                found.add(str(item))
    return len(w), len(hit), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


def quality_base(text):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    cut = collections.defaultdict(list)
    for k in range(len(w) - 7):
        cut[tuple(w[k:k + 8])].append(k)
    repeated = {p for at in cut.values() if len(at) > 1 for k in at for p in range(k, k + 8)}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeated)


def distance(p, q):
    """Jensen-Shannon distance of two histograms (base 2)."""
    def norm(h):
        return {k: v / sum(h.values()) for k, v in h.items()}

    p, q = norm(p), norm(q)
    total = 0.0
    for k in p.keys() | q.keys():
        a, b = p.get(k, 0), q.get(k, 0)
        m = (a + b) / 2
        total += (a * math.log2(a / m) if a else 0) + (b * math.log2(b / m) if b else 0)
    return math.sqrt(max(total / 2, 0))
