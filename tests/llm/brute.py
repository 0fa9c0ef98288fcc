"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
MARKED = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def folded(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def spaced(text):
    return SPACED.findall(text or "")


def substrings(rows, window=20):
    """{(doc_id, text)} -> (doc_id, n_words, n_removed, sha); ids are distinct and not null."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        words = spaced(text)
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            gram = tuple(words[i:i + window])
            if gram in seen:
                gone[i:i + window] = [True] * window
            seen.add(gram)
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((doc_id, len(words), sum(gone), sha(kept)))
    return out


def contamination(rows, items, window=13):
    index = defaultdict(set)
    for item_id, text in items:
        words = MARKED.findall(folded(text))
        n = min(len(words), window)
        for i in range(len(words) - n + 1 if n else 0):
            index[tuple(words[i:i + n])].add(None if item_id is None else str(item_id))
    sizes = {len(g) for g in index}
    out = []
    for doc_id, text in rows:
        words = MARKED.findall(folded(text))
        hit, ids = [False] * len(words), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                found = index.get(tuple(words[i:i + n]))
                if found:
                    hit[i:i + n] = [True] * n
                    ids |= found
        ids.discard(None)
        n = sum(hit)
        out.append((doc_id, len(words), n, len(ids), sha(",".join(sorted(ids))),
                    n > 0 and 20 * n >= len(words)))
    return out


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def near_classes(rows, similarity=0.8):
    """(doc_id, class_id) over all pairs; ids are distinct."""
    words = {d: spaced(t) for d, t in rows}
    code = {}
    coded = {d: np.array([code.setdefault(x, len(code)) for x in w], np.int64)
             for d, w in words.items()}
    parent = {d: d for d in words}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(words)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = coded[a], coded[b]
            longer = max(len(x), len(y))
            most = (1 - similarity) * longer
            if abs(len(x) - len(y)) > most + 1e-9 or find(a) == find(b):
                continue
            shared = sum((Counter(x.tolist()) & Counter(y.tolist())).values())
            if longer - shared <= most + 1e-9 and distance(x.tolist(), y.tolist()) <= most + 1e-9:
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return [(d, find(d)) for d in ids]


ASSIGN = re.compile(
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def secret_spans(text):
    """Base spans as (start, rank, kind, end)."""
    text = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    out += [(m.start(), 1, "access", m.end())
            for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end())
            for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n if n < 10 else n - 9
    return total % 10 == 0


def personal_spans(text):
    """Base spans as kind -> [(start, end)]."""
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    return {
        "email": [m.span() for m in re.finditer(
            r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)],
        "ip": [m.span() for m in re.finditer(
            r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))],
        "card": [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
                 if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))],
        "phone": [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                  if 9 <= len(digits(m[0])) <= 15],
    }


def maximal_segments(scores):
    """All maximal segments by their definition: split at the best segment, the shortest such."""
    total = np.concatenate([[0.0], np.cumsum(scores, dtype=np.float64)])
    best = None
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            s = total[j] - total[i]
            if s > 1e-12 and (best is None or s > best[2] + 1e-12 or (
                    abs(s - best[2]) <= 1e-12 and j - i < best[1] - best[0])):
                best = (i, j, s)
    if best is None:
        return []
    i, j, _ = best
    left = maximal_segments(scores[:i])
    right = [(a + j, b + j, s) for a, b, s in maximal_segments(scores[j:])]
    return [*left, best, *right]


def grams(text):
    """Character n-grams of one to three letters with blanks at word ends, counted."""
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    out = Counter()
    run = " " + " ".join(words) + " " if words else ""
    for i, c in enumerate(run):
        if c == " ":
            continue
        out[c] += 1
        out[run[i - 1] + c] += 1
        if run[i + 1] == " ":
            out[c + " "] += 1
        out[run[i - 1:i + 2]] += 1
    return out


def gram_order(gram):
    """The order of n-grams with equal counts: nothing, blank, then letters by code point."""
    return tuple(1 if c == " " else ord(c) + 2 for c in gram) + (0,) * (3 - len(gram))


def ranked(counts, profile=300):
    return sorted(counts, key=lambda g: (-counts[g], gram_order(g)))[:profile]


def predict_language(text, profiles, profile=300):
    own = ranked(grams(text), profile)
    if not own:
        return "und"
    best = {}
    for lang in sorted(profiles):
        rank = {g: i for i, g in enumerate(profiles[lang])}
        best[lang] = sum(abs(rank[g] - i) if g in rank else profile for i, g in enumerate(own))
    return min(sorted(best), key=best.get) if best else "und"


def cosine(words, others, idf, rare):
    a, b = Counter(words), Counter(others)
    x = {w: n * idf.get(w, rare) for w, n in a.items()}
    y = {w: n * idf.get(w, rare) for w, n in b.items()}
    dot = sum(x[w] * y.get(w, 0) for w in x)
    norm = math.sqrt(sum(v * v for v in x.values())) * math.sqrt(sum(v * v for v in y.values()))
    return dot / norm if norm else 0.0
