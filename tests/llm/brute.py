"""Plain Python versions of the corpus operators, and odd input rows."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingles(text):
    words = WORD.findall(lowered(text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def groups(rows, percent=85):
    """{doc_id: (n_shingles, component)} of (doc_id, text) rows with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    shared = Counter()
    for ids in holders.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1 :]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + j for i, w in enumerate(windows) if w in many for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
    )


def luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    text = text or ""
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def span_digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))

#: doc_id, text, lang, source, n_chars and columns whose names clash with the operators' own.
ODD_SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, kept boolean, row long, "
    "unit string, score string, component_id string, host string, words int"
)


def _odd(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), None, None, None, None, None, None, None)


ODD = [
    _odd(1, None),
    _odd(2, ""),
    _odd(3, "   \n\t "),
    _odd(4, "one two three"),
    _odd(5, "one two three"),
    _odd(6, LONG),
    _odd(7, LONG + " tail"),
    _odd(8, "12 34 ### 5"),
    _odd(9, "same text again and again and again " * 20, None, None),
    _odd(9, "same text again and again and again " * 20, None, None),
    _odd(None, "a row without an id but with some words in it", "de", "b"),
    _odd(11, "Écoute ÉTÉ été   naïve, ΣΑΣ straße 你好 🙂 éa", "fr", None),
    _odd(12, "mail joe@example.com, ip 10.0.0.1 card 4111 1111 1111 1111 phone +49 (30) 1234567", "en", "c"),
    _odd(13, "The the THE tHe the the the", "en", "c"),
]
