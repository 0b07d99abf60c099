"""A small corpus with copies, near copies, repeated lines, nulls, repeated rows and
a long text, and plain Python versions of the operators' definitions."""

from __future__ import annotations

import collections
import itertools
import random
import re

WORDS = [a + b for a in "ba ko li mu ren sta tor vel win zur".split() for b in ["", "da", "ne", "rik", "sol", "ta", "um"]]
DDL = "doc_id long, text string, kept string, node string, tid string, n long"


def sentence(rnd: random.Random, n: int) -> str:
    return " ".join(rnd.choice(WORDS) for _ in range(n)).capitalize() + "."


def corpus() -> list[tuple]:
    rnd = random.Random(7)
    shared = [sentence(rnd, 14) for _ in range(3)]
    texts = []
    for i in range(24):
        lines = [sentence(rnd, rnd.randrange(6, 40)) for _ in range(rnd.randrange(1, 6))]
        if i % 4 == 0:
            lines.insert(0, shared[i % 3])
        texts.append("\n".join(lines))
    texts += texts[:4]  # copies
    for t in texts[4:8]:  # near copies: one word or one case changed
        words = t.split(" ")
        words[len(words) // 2] = "changed"
        texts += [" ".join(words), t.upper()]
    line = sentence(rnd, 30)
    edited = line.replace(line.split(" ")[9], "other", 1)
    texts += [line + "\n" + sentence(rnd, 20), edited + "\n" + sentence(rnd, 25)]
    texts += ["", " \n\t ", "one two", "ONE Two", "a", "\n".join(["same line of text here again"] * 5)]
    texts.append(" ".join(rnd.choice(WORDS) for _ in range(20_000)))  # a long text on one line
    texts.append("é" * 300 + " " + "ü" * 120)
    rows = [(i, t, "x", None, "y", i) for i, t in enumerate(texts)]
    rows += [(900, None, None, None, None, None), (None, texts[9], None, None, None, 0), (None, None, None, None, None, 0)]
    rows += [rows[3], rows[3], rows[30]]  # repeated rows
    return rows


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text: str | None) -> frozenset:
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(sets: list, percent: int) -> list[int]:
    """Smallest index reachable over pairs of non-empty sets with Jaccard >= percent."""
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(sets)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


def multiset(rows) -> collections.Counter:
    return collections.Counter(map(tuple, rows))
