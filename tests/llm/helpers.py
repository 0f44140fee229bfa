"""Brute-force versions of what the operators return, and shared fixtures."""

import collections
import re

SF = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\x0c\r"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")

#: Texts that every operator on documents must take: null, empty, blank, long runs, astral characters, repeats.
EDGE_TEXTS = [None, "", "   \n\t ", "a", "\U0001f916 é" * 40, "x" * 60_000, "one two three four five six " * 3000, "repeat me\n" * 30, "repeat me\n" * 30]


def documents(spark, texts, first=-1000):
    """Rows with the columns of documents, repeated and null ids among them, and columns whose names clash."""
    rows = [(first + i, t, "en" if i % 2 else None, None, None, i, "x") for i, t in enumerate(texts)]
    rows += [rows[-1], (None, texts[-1], None, "s", 3, 0, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept long, n_words string")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c)
        if i % 2:
            v = 2 * v - 9 if v > 4 else 2 * v
        total += v
    return total % 10 == 0


def pii_spans(text):
    t, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((m.start(), "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(len(x.lstrip("0")) < 4 and int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), "phone", m.end()))
    return out


def secret_spans(text):
    t, out = text or "", []
    pattern = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    for m in re.finditer(pattern, t, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), "assign", m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", t):
        if len(m[0]) >= 20:
            out.append((m.start(), "access", m.end()))
    for m in re.finditer(r"[0-9a-f]+", t):
        if len(m[0]) >= 24:
            out.append((m.start(), "hex", m.end()))
    return out


def listed(spans, kinds):
    return ",".join(f"{k}:{s}:{e}" for s, k, e in sorted(spans, key=lambda x: (x[0], kinds.index(x[1]), x[2])))


def quality_counts(text):
    t = text or ""
    words = WORDS.findall(t)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] >= 2:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in t.split("\n") if WORDS.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def five_word_sets(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(lower)
    if 0 < len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def components(rows):
    """doc_id -> (set size, smallest id reachable) for (doc_id, text) rows with distinct ids."""
    sets = {d: five_word_sets(t) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(d for d in sets if sets[d])
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {d: (len(sets[d]), find(d)) for d in sets}
