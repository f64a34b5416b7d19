"""Brute-force helpers of the tests in this folder."""

from __future__ import annotations

import re

ODD_TEXTS = [
    None,
    "",
    "   \n\t",
    "One",
    "one  TWO\nthree",
    "Äöü ß ΑΣ İstanbul don't 5's <|endoftext|> </s>[INST] \\ [x] <y>",
    "\x00\x1c odd\x85spaces here\xa0too",
    "漢字 and 🙂 emoji",
    "word " * 30_000,
    "x" * 50_000,
]

UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def word_list(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(UPPER))


def word_set(text, width):
    found = word_list(text)
    if not found:
        return frozenset()
    if len(found) < width:
        return frozenset([tuple(found)])
    return frozenset(tuple(found[k : k + width]) for k in range(len(found) - width + 1))


def brute_components(nodes, edges):
    """Least node of each node's component."""
    name = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            least = min(name[a], name[b])
            if name[a] != least or name[b] != least:
                name[a] = name[b] = least
                changed = True
    return name


def words(rng, n):
    parts = ["al", "be", "ce", "du", "el", "fo", "gi", "ha"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))
