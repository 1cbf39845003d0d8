"""Documents that are awkward, and plain versions of what the operators compute."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})

#: Columns of documents, and more whose names the operators use inside.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, found string, `row` int, "
    "`key` string, x int, label int, place int, kept boolean, maybe int, predicted string"
)


def prose(rng: random.Random, n: int, words: list[str]) -> str:
    return " ".join(rng.choice(words) for _ in range(n)) + "."


def vocabulary(rng: random.Random, syllables: list[str], n: int = 400) -> list[str]:
    return ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n)]


ENGLISH = vocabulary(random.Random(1), ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"])
GERMAN = vocabulary(random.Random(2), ["sch", "ei", "ung", "ge", "ver", "ü", "ich", "keit", "zu", "ö"])


def documents(n: int = 120, seed: int = 3) -> list[tuple]:
    """Prose in two languages; every tenth document is junk, every eighth toxic; then the awkward ones."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang, words = ("en", ENGLISH) if i % 2 else ("de", GERMAN)
        text = prose(rng, rng.randint(30, 200), words)
        if i % 10 == 0:
            text = " ".join(w + rng.choice(["$$$", "%%%", "###"]) for w in text.split())
        if i % 8 == 0:
            own = text.split()
            for _ in range(5):
                own.insert(rng.randrange(len(own)), rng.choice(["idiot", "moron", "scum,"]))
            text = " ".join(own)
        rows.append(row(i, text, lang))
    copy = rows[3]
    rows += [
        row(1000, None, None),
        row(1001, "", "en"),
        row(1002, " \n\t ", None),
        row(1003, "One", "en"),
        row(1004, "Two words", None),
        row(1005, "two WORDS", "en"),
        row(1006, "12345 !!! 678", None),
        row(1007, prose(rng, 20_000, ENGLISH), "en"),
        row(1008, "x" * 50_000, "en"),
        row(None, prose(rng, 50, ENGLISH), "en"),
        row(None, None, None),
        copy,
        row(1009, copy[1], "en"),
        row(1010, copy[1].upper(), "en"),
        row(1011, copy[1] + " one more", "en"),
        row(1012, "İstanbul ǅ idiot \u2028 idiot漢字 かな \U0001f600", "en"),
    ]
    return rows


def row(doc_id, text, lang) -> tuple:
    return (doc_id, text, lang, "src", None, 0.5, "f", 1, "k", 2, 3, 4, True, 5, "p")


def labels(rows: list[tuple]) -> list[tuple]:
    """(doc_id, quality, toxic), with a null, an odd label and a document that isn't there."""
    return [(r[0], int(r[0] % 10 != 0), int(r[0] % 8 == 0)) for r in rows if r[0] is not None and r[0] < 1000] + [
        (None, 1, 0),
        (1003, None, None),
        (1004, 7, 7),
        (99999, 1, 1),
    ]


def shingles(text: str | None) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def linked(a: frozenset, b: frozenset) -> bool:
    both = len(a & b)
    return bool(a) and bool(b) and 100 * both >= 75 * (len(a) + len(b) - both)


def plain_components(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_shingles, component_id) of each row, every pair compared; a row without id takes no part."""
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    use = [i for i, r in enumerate(rows) if r[0] is not None]
    for i in use:
        for j in use:
            if j < i and linked(sets[i], sets[j]):
                parent[root(i)] = root(j)
    least: dict[int, int] = {}
    for i in use:
        least[root(i)] = min(rows[i][0], least.get(root(i), rows[i][0]))
    return [(r[0], len(s), None if r[0] is None else least[root(i)]) for i, (r, s) in enumerate(zip(rows, sets, strict=True))]
