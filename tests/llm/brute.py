"""Plain-Python versions of the contracts, for small tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict

LETTER_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def contamination(docs, items):
    """docs: (id, text), items: (id, text) -> {id: (n_words, n_hit, n_items, sha, contaminated)}"""
    windows = defaultdict(set)
    for i, t in items:
        w = LETTER_WORDS.findall((t or "").translate(_LOWER))
        k = min(13, len(w))
        for j in range(len(w) - k + 1 if w else 0):
            windows[tuple(w[j : j + k])].add("null" if i is None else str(i))
    sizes = sorted({len(w) for w in windows})
    out = {}
    for d, t in docs:
        w = LETTER_WORDS.findall((t or "").translate(_LOWER))
        hit, ids = set(), set()
        for k in sizes:
            for j in range(len(w) - k + 1):
                if own := windows.get(tuple(w[j : j + k])):
                    hit.update(range(j, j + k))
                    ids |= own
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out[d] = (len(w), len(hit), len(ids), sha, bool(hit) and 20 * len(hit) >= len(w))
    return out


def base_rules(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)"""
    text = text or ""
    w = SPACE_WORDS.findall(text)
    lines = [x for x in text.split("\n") if SPACE_WORDS.search(x)]
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = {j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), failed


def shingles(text, k=5):
    w = SPACE_WORDS.findall((text or "").translate(_LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


def near_duplicates(docs, percent=85):
    """{id: (n_shingles, component)} by an index of all shingles."""
    sets = {d: shingles(t) for d, t in docs}
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    by = defaultdict(list)
    for d in sorted(sets):
        common = Counter(x for s in sets[d] for x in by[s])
        for x, n in common.items():
            if 100 * n >= percent * (len(sets[d]) + len(sets[x]) - n):
                a, b = find(x), find(d)
                up[max(a, b)] = min(a, b)
        for s in sets[d]:
            by[s].append(d)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def _js(p, q):
    keys = {*p, *q}
    half = lambda a: sum(a.get(k, 0) * math.log2(a.get(k, 0) / ((p.get(k, 0) + q.get(k, 0)) / 2)) for k in keys if a.get(k, 0))
    return math.sqrt(max(0.0, (half(p) + half(q)) / 2))


def _kind(c):
    o = ord(c)
    return "a" if "a" <= c <= "z" else "A" if "A" <= c <= "Z" else "9" if "0" <= c <= "9" else " " if c in " \t\n\v\f\r" else "." if c in ".,;:!?'\"()-" else "high" if o > 127 else "other"


def quality_verdicts(docs, min_reference=2000, lang_share=1 / 1000, common=1 / 200, max_class=0.28, word=0.15, slack=2.0):
    """docs: (id, text, lang) -> {id: (kept, class distance, word distance)}"""
    share = lambda c: {k: n / sum(c.values()) for k, n in c.items()}
    words = lambda t: LETTER_WORDS.findall((t or "").translate(_LOWER))
    classes, counts = defaultdict(Counter), defaultdict(Counter)
    for _, t, lang in docs:
        classes[lang].update(map(_kind, t or ""))
        counts[lang].update(words(t))
    total = sum(sum(c.values()) for c in counts.values())
    refs = {}
    for lang, c in counts.items():
        n = sum(c.values())
        if n >= max(min_reference, lang_share * total):
            own = {w: k / n for w, k in c.items() if k >= common * n}
            refs[lang] = (share(classes[lang]), own, max(0.0, 1 - sum(own.values())))
    out = {}
    for d, t, lang in docs:
        w, failed = words(t), base_rules(t)[5]
        most = word + slack / math.sqrt(max(1, len(w)))
        near = (1.0, 1.0)
        for cls, own, rest in refs.values():
            hist = Counter(x if x in own else None for x in w)
            a = _js(share(Counter(map(_kind, t or ""))), cls) if t else _js({}, cls)
            b = _js({k: n / len(w) for k, n in hist.items()}, {**own, None: rest})
            if a / max_class + b / most < near[0] / max_class + near[1] / most:
                near = (a, b)
        short = len(t or "") < 200 or len(SPACE_WORDS.findall(t or "")) < 40 or lang not in refs
        out[d] = (not failed and (short or (near[0] <= max_class and near[1] <= most)), *near)
    return out
