"""Licence notices in texts, by a suffix automaton of all templates and chains of long matches.

One automaton holds every run of words of every template. Reading a text word by word, its state tells the
longest run that ends here and occurs in a template (matching statistics), and its suffix links all shorter
ones that other templates have. Matches that cannot be lengthened are chained for each template: in order in
the text and in the template, with small gaps. A chain that covers enough of a template is a span of that
licence.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept, pieces

#: Words of a match that is chained, and words that may lie between two matches of a chain.
LEAST_MATCH, GAP = 4, 8

#: Words of all templates together; the automaton travels with every task.
MOST_WORDS = 1 << 20

#: Bytes of text handled at a time, one document at least.
PIECE = 1 << 20


@dataclass(frozen=True)
class Template:
    """A notice, its label, and the share of its words that a text must have."""

    label: str
    text: str
    share: float = 1.0


#: Phrases that name a licence family wherever their words stand in a row. Fixed values.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Notices by which authors put texts and programs under a licence. Fixed values.
TEMPLATES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    Template("apache-2.0", (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES '
        "OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."
    ), 0.75),
    Template("bsd-2-clause", (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
    ), 0.75),
    Template("cc-by-4.0", "Licensed under CC BY 4.0."),
    Template("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    Template("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    Template("cc-by-nc-nd-4.0", "Licensed under CC BY-NC-ND 4.0."),
    Template("cc-by-nc-sa-4.0", "Licensed under CC BY-NC-SA 4.0."),
    Template("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    Template("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    Template("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    Template("gpl-2.0", (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."
    ), 0.9),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    Template("gpl-3.0", (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ), 0.9),
    Template("isc", (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ), 0.75),
    Template("mit", "Released under the MIT License."),
    Template("mit", "Licensed under the MIT License."),
    Template("mit", (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "shall be included in all copies or substantial portions of the Software."
    ), 0.75),
)

#: Letters A-Z become lower case; what cannot be part of a word becomes a blank.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Stretches of digits, ASCII letters (lower-cased) and characters above 127."""
    return (text or b"").translate(_FOLD).split()


class Automaton:
    """The suffix automaton of several sequences of letters."""

    def __init__(self, sequences: Sequence[Sequence[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        #: Where a state's words end: (sequence, words read), of the state itself.
        self.here: list[list[tuple[int, int]]] = [[]]
        for s, letters in enumerate(sequences):
            last = 0
            for i, letter in enumerate(letters):
                last = self._extend(last, letter)
                self.here[last].append((s, i + 1))
        self.below: list[list[int]] = [[] for _ in self.next]
        for state, up in enumerate(self.link):
            if up >= 0:
                self.below[up].append(state)
        self._known: dict[tuple[int, int], list[tuple[int, int, int]]] = {}

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        self.here.append([])
        return len(self.next) - 1

    def _split(self, p: int, letter: int) -> int:
        """The state that p leads to by a letter, alone with words one longer than p's."""
        q = self.next[p][letter]
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(letter) == q:
            self.next[p][letter] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, letter: int) -> int:
        if letter in self.next[last]:  # another sequence has been here
            return self._split(last, letter)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and letter not in self.next[p]:
            self.next[p][letter] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, letter)
        return new

    def ends(self, state: int, without: int = -1) -> list[tuple[int, int]]:
        """All (sequence, words read) at which the state's words end, those of one state below it left out."""
        found, stack = [], [state]
        while stack:
            s = stack.pop()
            if s != without:
                found += self.here[s]
                stack += self.below[s]
        return found

    def statistics(self, letters: Sequence[int]) -> Iterator[tuple[int, int]]:
        """After each letter the state and length of the longest run that ends here and that a sequence has."""
        state = length = 0
        for letter in letters:
            while state and letter not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if letter in self.next[state]:
                state, length = self.next[state][letter], length + 1
            yield state, length

    def _shorter(self, state: int, least: int) -> list[tuple[int, int, int]]:
        """(sequence, words read, length) of what else ends with a part of the state's words."""
        key = state, least
        if key not in self._known:
            found, up = [], self.link[state]
            while up > 0 and self.length[up] >= least:
                found += [(s, stop, self.length[up]) for s, stop in self.ends(up, state)]
                state, up = up, self.link[up]
            self._known[key] = found
        return self._known[key]

    def matches(self, letters: Sequence[int], least: int) -> Iterator[tuple[int, int, int, int]]:
        """(start, sequence, start in the sequence, length) of the common runs that no letter lengthens at either end."""
        going: dict[tuple[int, int], int] = {}
        i = 0
        for i, (state, length) in enumerate(self.statistics(letters), 1):
            if length < least and not going:
                continue
            now = {}
            if length >= least:
                now = {(s, stop - i): length for s, stop in self.ends(state)}
                now |= {(s, stop - i): n for s, stop, n in self._shorter(state, least)}
            for (s, shift), n in going.items():
                if (s, shift) not in now:
                    yield i - 1 - n, s, i - 1 - n + shift, n
            going = now
        for (s, shift), n in going.items():
            yield i - n, s, i - n + shift, n


@dataclass(frozen=True)
class Span:
    template: int
    start: int
    end: int
    covered: int


def chains(fragments: list[tuple[int, int, int]], gap: int) -> list[tuple[int, int, int]]:
    """(start, end, covered) of the best chains of one template's fragments (place, place in the template, length).

    A chain's fragments follow each other in the text and in the template, with at most ``gap`` words in
    between; words that two of them share count once. The chain that covers most is taken first; a chain that
    would go on with fragments of a better one ends there.
    """
    fragments = sorted(set(fragments))
    total, before = [n for _, _, n in fragments], [-1] * len(fragments)
    nearest = 0
    longest = max((n for _, _, n in fragments), default=0)
    for i, (at, t, n) in enumerate(fragments):
        while fragments[nearest][0] + longest + gap < at:
            nearest += 1
        for j in range(nearest, i):
            other, u, m = fragments[j]
            apart, apart_t = at - other - m, t - u - m
            shared = max(0, -apart, -apart_t)
            if apart <= gap and apart_t <= gap and other < at and u < t and shared < n and total[j] + n - shared >= total[i]:
                total[i], before[i] = total[j] + n - shared, j
    used, found = [False] * len(fragments), []
    for i in sorted(range(len(fragments)), key=lambda i: (-total[i], i)):
        first, way = i, i
        while way >= 0 and not used[way]:
            used[way], first, way = True, way, before[way]
        if way != i:
            found.append((fragments[first][0], fragments[i][0] + fragments[i][2], total[i] - (total[way] if way >= 0 else 0)))
    return found


class Scanner:
    """Templates and phrases ready for scanning."""

    def __init__(self, templates: Sequence[Template], phrases: Sequence[tuple[str, str]]):
        texts = [words_of(t.text.encode()) for t in templates]
        names = [words_of(p.encode()) for p, _ in phrases]
        if sum(map(len, texts)) > MOST_WORDS:
            raise ValueError(f"templates of more than {MOST_WORDS} words")
        self.templates, self.sizes, self.labels = list(templates), [len(t) for t in texts], [label for _, label in phrases]
        code: dict[bytes, int] = {}
        for w in (w for ws in texts + names for w in ws):
            code.setdefault(w, len(code) + 1)
        self.code, self.width = code, len(code) + 1
        letters = [[code[w] for w in ws] for ws in texts]
        self.phrases = [[code[w] for w in ws] for ws in names]
        self.automaton = Automaton(letters)
        self.pairs = np.unique([a * self.width + b for ws in letters for a, b in zip(ws, ws[1:])]).astype(np.int64)

    def places(self, letters: np.ndarray) -> list[np.ndarray]:
        """Where each phrase's words stand in a row."""
        found = []
        for phrase in self.phrases:
            n = len(letters) - len(phrase) + 1
            hit = np.ones(max(n, 0), bool)
            for i, letter in enumerate(phrase):
                hit &= letters[i:n + i] == letter if n > 0 else hit
            found.append(np.flatnonzero(hit) if phrase else np.zeros(0, np.int64))
        return found

    def stretches(self, letters: np.ndarray) -> list[tuple[int, int]]:
        """The stretches outside of which no match has LEAST_MATCH words: all pairs in them are a template's."""
        if len(letters) < 2 or not len(self.pairs):
            return []
        keys = letters[:-1] * self.width + letters[1:]
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        known = (self.pairs[at] == keys) & (letters[:-1] > 0) & (letters[1:] > 0)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2] + 1
        long = ends - starts >= LEAST_MATCH
        return list(zip(starts[long].tolist(), ends[long].tolist()))

    def spans(self, letters: np.ndarray, stretches: Sequence[tuple[int, int]]) -> list[Span]:
        """Chains of matches by place; whole ones first; one with over half of its words in better chains is left out."""
        of_template = defaultdict(list)
        for start, end in stretches:
            for at, template, place, n in self.automaton.matches(letters[start:end].tolist(), LEAST_MATCH):
                of_template[template].append((start + at, place, n))
        found = [Span(t, *c) for t, fragments in of_template.items() for c in chains(fragments, GAP)]
        found.sort(key=lambda s: (not self.whole(s), -s.covered, -s.covered / self.sizes[s.template], s.start, s.template))
        held, taken = bytearray(len(letters) if found else 0), []
        for s in found:
            if 2 * held.count(1, s.start, s.end) <= s.end - s.start:
                held[s.start:s.end] = b"\1" * (s.end - s.start)
                taken.append(s)
        return sorted(taken, key=lambda s: (s.start, s.end, s.template))

    def whole(self, span: Span) -> bool:
        """Whether a span covers as much of its template as it must."""
        return span.covered >= math.ceil(self.templates[span.template].share * self.sizes[span.template] - 1e-9)


_PLACES = "array<struct<label:string,start:bigint>>"
_SPANS = "array<struct<label:string,start:bigint,end:bigint,covered:bigint,share:double,whole:boolean>>"


def scan(documents: DataFrame, templates: Sequence[Template] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES) -> DataFrame:
    """doc_id, n_words, places and spans of every row.

    Words are stretches of digits, ASCII letters (lower-cased) and characters above 127, numbered from 0.
    ``places`` are all places where a phrase's words stand in a row. ``spans`` are chains of matches with a
    template: label, start and end in words, words covered, their share of the template, and whether that is
    as much as the template asks for. A null or empty text has neither; equal rows are all kept; an empty
    table gives an empty one; only doc_id and text are read. Texts are read whole, in one pass, where they
    are; the automaton is as large as the templates, which MOST_WORDS bounds.
    """
    templates, phrases = tuple(templates), tuple(phrases)
    Scanner(templates, phrases)  # complains here about templates that are too large

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = kept(f"licences {templates} {phrases}", lambda: Scanner(templates, phrases))
        for piece in pieces(batches, "text", PIECE):
            words = [words_of(t) for t in piece.column(1).to_pylist()]
            sizes = np.array([len(ws) for ws in words], np.int64)
            starts = np.cumsum(sizes + 1) - sizes - 1
            # A letter that no template has stands between texts, so nothing spans two of them.
            letters = np.zeros(int(sizes.sum()) + len(words), np.int64)
            for at, ws in zip(starts.tolist(), words):
                letters[at:at + len(ws)] = np.fromiter(map(scanner.code.get, ws, repeat(0)), np.int64, len(ws))
            places: list[list] = [[] for _ in words]
            for label, found in zip(scanner.labels, scanner.places(letters)):
                for at, text in zip(found.tolist(), (np.searchsorted(starts, found, "right") - 1).tolist()):
                    places[text].append({"label": label, "start": at - int(starts[text])})
            stretches: dict[int, list[tuple[int, int]]] = defaultdict(list)
            for start, end in scanner.stretches(letters):
                text = int(np.searchsorted(starts, start, "right")) - 1
                stretches[text].append((start - int(starts[text]), end - int(starts[text])))
            spans: list[list] = [[] for _ in words]
            for text, parts_ in stretches.items():
                own = letters[starts[text]:starts[text] + sizes[text]]
                spans[text] = [
                    {"label": scanner.templates[s.template].label, "start": s.start, "end": s.end, "covered": s.covered,
                     "share": s.covered / scanner.sizes[s.template], "whole": scanner.whole(s)}
                    for s in scanner.spans(own, parts_)
                ]
            yield pa.RecordBatch.from_arrays([
                piece.column(0), pa.array(sizes),
                pa.array([sorted(p, key=lambda x: (x["start"], x["label"])) for p in places], _places_type()), pa.array(spans, _spans_type()),
            ], ["doc_id", "n_words", "places", "spans"])

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return rows.mapInArrow(read, f"doc_id bigint, n_words bigint, places {_PLACES}, spans {_SPANS}")


def _places_type() -> pa.DataType:
    return pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))


def _spans_type() -> pa.DataType:
    return pa.list_(pa.struct([
        ("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("covered", pa.int64()), ("share", pa.float64()), ("whole", pa.bool_()),
    ]))


def _labels(found: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(found)), ",")


def summary(documents: DataFrame) -> DataFrame:
    """Places of phrases, their labels, the labels of whole templates beside them, and a score.

    The score is the largest share of a template that a span covers, and one half at least with a phrase.
    """
    found = scan(documents)
    base = F.transform("places", lambda p: p["label"])
    whole = F.transform(F.filter("spans", lambda s: s["whole"]), lambda s: s["label"])
    share = F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["start"])).alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["start"])).alias("last_word"),
        _labels(base).alias("base_labels"), _labels(F.concat(base, whole)).alias("labels"),
        F.greatest(share, F.when(F.size("places") > 0, F.lit(0.5)).otherwise(F.lit(0.0))).alias("score"),
    )
