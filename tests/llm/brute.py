"""Plain counterparts of the operators, for small inputs."""

import itertools
import random
import re

ODD_TEXTS = [
    None, "", " ", "a", "  a  b ", "a\tb\nc", "x" * 3000, "word " * 500, "Ünïcode 中文 日本 🙂 é  　 end", "it's we'll I'd 123 4½²",
    "!?" * 300, "\n\n  \n x", "tab\t\tspace  ", "\x1c odd \x85 blanks \x0b", "<|endoftext|> as text",
]


def texts(n: int = 40, seed: int = 5) -> list:
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéü") for _ in range(rng.randint(1, 9))) for _ in range(200)]
    made = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 120))) for _ in range(n)]
    return [*ODD_TEXTS, *made, made[0], made[1] + " more", made[1]]


def rows(n: int = 40) -> list[tuple]:
    """(doc_id, text, source, extra): nulls, repeated rows and repeated ids among them."""
    made = [(i, t, f"s{i % 3}" if i % 7 else None, i) for i, t in enumerate(texts(n))]
    return [*made, made[20], made[20], (None, "no id at all", None, None), (3, "a text of a repeated id", "s1", 0)]


DDL = "doc_id long, text string, source string, score long"


def words(text) -> list[str]:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def shingles(text, n: int = 5) -> frozenset:
    w = words(text)
    if len(w) < n:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1))


def near_copies(pairs: list[tuple], percent: int = 80) -> list[tuple]:
    sets = [shingles(t) for _, t in pairs]
    parent = list(range(len(pairs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(pairs)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
            parent[root(i)] = root(j)
    least: dict = {}
    for i, (k, _) in enumerate(pairs):
        if k is not None:
            least[root(i)] = min(least.get(root(i), k), k)
    return [(k, len(s), least.get(root(i)) if s else k) for i, ((k, _), s) in enumerate(zip(pairs, sets))]


def ordered(found) -> list:
    return sorted((tuple(r) for r in found), key=repr)
