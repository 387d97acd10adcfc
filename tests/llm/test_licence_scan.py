"""Licence scans: the automaton against all substrings, phrases against a plain search, spans of notices."""

import random
import re

import numpy as np
import pytest

import brute
from rowloom.llm import licence_scan as ls

NOTICE = {t.label: t.text for t in ls.TEMPLATES}
PROSE = "the harbour was quiet in the morning and nobody asked for a copy of the map"


def longest(sequences, letters):
    """For each place the longest run ending there that a sequence has."""
    known = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    return [max((n for n in range(1, i + 2) if tuple(letters[i + 1 - n:i + 1]) in known), default=0) for i in range(len(letters))]


def maximal(sequences, letters, least):
    found = []
    for k, s in enumerate(sequences):
        for i in range(len(letters)):
            for j in range(len(s)):
                if letters[i] == s[j] and not (i and j and letters[i - 1] == s[j - 1]):
                    n = 1
                    while i + n < len(letters) and j + n < len(s) and letters[i + n] == s[j + n]:
                        n += 1
                    found += [(i, k, j, n)] * (n >= least)
    return sorted(found)


@pytest.mark.parametrize("seed", range(40))
def test_matching_statistics(seed):
    rng = random.Random(seed)
    size = 2 + seed % 4
    sequences = [[rng.randrange(size) for _ in range(rng.randrange(1, 25))] for _ in range(1 + seed % 4)]
    letters = [rng.randrange(size + 1) for _ in range(80)]
    automaton = ls.Automaton(sequences)
    assert [n for _, n in automaton.statistics(letters)] == longest(sequences, letters)
    for least in (1, 2, 4):
        assert sorted(automaton.matches(letters, least)) == maximal(sequences, letters, least)


def plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places = []
    for phrase, label in ls.PHRASES:
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i:i + len(p)] == p]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places}))


def made():
    yield from brute.texts(20)
    yield "MIT license, Mit-LICENSE; the mit licenses. cc by cc BY-nc\x7fcc-by CC byé"
    yield "gnu general public gnu general public license apache license Apache\n\nLicense"
    yield from NOTICE.values()
    yield (PROSE + ". " + NOTICE["cc-by-nc-4.0"] + " ") * 50
    yield "mit license " * 30_000


def test_base_equals_plain_search(spark):
    rows = [(i, t, "x", 1.5) for i, t in enumerate(made())]
    rows += [rows[-4], rows[-4], (None, "Apache License", None, None), (4, "cc by", "y", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, labels string, score double").repartition(3)
    got = ls.summary(table).collect()
    found = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got]
    assert sorted(found, key=repr) == sorted(((r[0], *plain(r[1])) for r in rows), key=repr)
    for r in got:
        assert 0 <= r.score <= 1 and r.labels.split(",") == sorted(set(r.labels.split(",")))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def spans(text):
    scanner = ls.Scanner(ls.TEMPLATES, ls.PHRASES)
    letters = np.array([scanner.code.get(w, 0) for w in ls.words_of(text.encode())], np.int64)
    found = scanner.spans(letters, scanner.stretches(letters))
    return [(scanner.templates[s.template].label, s.start, s.end, s.covered) for s in found if scanner.whole(s)]


@pytest.mark.parametrize("template", ls.TEMPLATES, ids=lambda t: f"{t.label}-{len(t.text)}")
def test_every_notice_is_found_where_it_stands(template):
    n, k = len(ls.words_of(template.text.encode())), len(ls.words_of(PROSE.encode()))
    got = spans(f"{PROSE}. {template.text.upper()}\n{PROSE} {template.text}")
    assert got == [(template.label, k, k + n, n), (template.label, 2 * k + n, 2 * k + 2 * n, n)]


def test_edited_notice_is_chained():
    words = [w.decode() for w in ls.words_of(NOTICE["mit"].encode())]
    n = len(words)
    changed = " ".join(words[:30] + ["xx", "yy"] + words[32:70] + words[73:])
    (label, start, end, covered), = spans(f"{PROSE} {changed} {PROSE}")
    assert label == "mit" and covered == n - 5
    assert spans(" ".join(words[:40])) == []
    assert spans(PROSE * 20) == []


def test_versions_are_told_apart():
    one = "This work is licensed under the GNU General Public License, version {}."
    assert [s[0] for s in spans(one.format(3))] == ["gpl-3.0"]
    assert [s[0] for s in spans(one.format(2))] == ["gpl-2.0"]
    assert spans(one.format(1)) == []
    assert [s[0] for s in spans("Licensed under CC BY-NC 4.0.")] == ["cc-by-nc-4.0"]
    assert spans("Licensed under CC BY-NC 3.0.") == []


def test_nothing(spark):
    assert ls.summary(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_too_many_template_words(spark, monkeypatch):
    monkeypatch.setattr(ls, "MOST_WORDS", 10)
    with pytest.raises(ValueError, match="words"):
        ls.scan(spark.createDataFrame([], "doc_id long, text string"))
