"""Plain versions of the operators, and awkward rows to try them on."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTER_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

DOC_SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, score string, kept int, "
    "matches string, `KEY` string, rate string, _email string, base string, `odd name` string"
)
EXTRA = ("x", "y", 7, "m", "k", "r", "e", "b", "o")


def docs(spark, texts, lang="en", source="src0"):
    """(doc_id, text) pairs as documents with columns whose names clash with the operators' own."""
    rows = [(i, t, lang, source, len(t) if t is not None else None, *EXTRA) for i, t in texts]
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)


def awkward():
    long = " ".join(f"w{i % 997}x{i % 13}" for i in range(20000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One two THREE"), (6, long), (7, long),
        (None, "text of nobody at all in here"), (8, "Größe 大 \x1f\x85 x y ünder"), (9, "same line\nsame line\n\n\nsame line\n"),
    ]


def base_figures(text):
    text = text or ""
    words = BLANK_WORD.findall(text)
    seen, copies = set(), 0
    for line in text.split("\n"):
        if BLANK_WORD.search(line):
            copies += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), copies, len(hit), failed


def contamination(text, items):
    words = LETTER_WORD.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for name, item in items:
        own = LETTER_WORD.findall((item or "").translate(LOWER))
        n = min(10, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(str(name))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def shingles(text):
    words = BLANK_WORD.findall((text or "").translate(LOWER))
    n = min(5, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def components(pairs):
    """{doc_id: (number of shingles, smallest linked id)} by comparing all pairs."""
    sets = {i: shingles(t) for i, t in pairs}
    first = {i: i for i in sets}

    def root(i):
        while first[i] != i:
            i = first[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for a in ids:
        for b in ids:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                first[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}


KINDS = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
)


def luhn(digits):
    values = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


def personal(text):
    """(counts by kind, base spans as joined text)"""
    spans = []
    for order, (kind, pattern) in enumerate(KINDS):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                spans.append((m.start(), order, m.end(), kind))
    counts = Counter(s[3] for s in spans)
    return [counts[k] for k, _ in KINDS], ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))


def random_corpus(rng, n):
    """Documents with exact copies, near copies of many degrees and a passage that many share."""
    vocabulary = [f"v{i}" for i in range(4000)]
    shared = rng.choices(vocabulary, k=30)
    texts, base = [], None
    for i in range(n):
        kind = rng.random()
        if base and kind < 0.5:
            words = list(base)
            for _ in range(rng.randrange(0, 9)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                words = words[: rng.randrange(min(3, len(words)), len(words) + 1)]
        else:
            words = rng.choices(vocabulary, k=rng.choice([1, 3, 4, 5, 6, 8, 9, 12, 40, 68, 90, 160]))
            if rng.random() < 0.4:
                words = words + shared
            base = words
        texts.append((i, " ".join(words)))
    return texts


def quoted(text, depth):
    mark = ">" * depth
    return "\n".join(f"{mark} {line}" for line in text.split("\n"))


def by_id(rows, *columns):
    found = defaultdict(list)
    for r in rows:
        found[r["doc_id"]].append(tuple(r[c] for c in columns))
    return found
