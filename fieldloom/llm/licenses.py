"""Licence texts found by matching statistics over a generalised suffix automaton of words."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import ALNUM_LOWER, by_rows, texts

#: Phrases that name a licence wherever their words stand in a row.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

#: Notices and openings of public licences: (label, text).
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
        " Software, and to permit persons to whom the Software is furnished to do so",
    ),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    (
        "apache-2",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at",
    ),
    (
        "apache-2",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is"
        " distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("gpl-3", "Licensed under the GNU General Public License, version 3."),
    (
        "gpl-3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met",
    ),
    (
        "mpl-2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
)

#: A match is long from so many words on; a chain skips at most so many words of the file or the template.
LONG = 4
GAP = 12
#: A chain that covers this share of its template's words gives the template's label.
COVERED = 0.75

SCHEMA = (
    "doc_id long, n_words long, places array<struct<label:string,word:long>>,"
    " spans array<struct<label:string,template:int,first:long,last:long,covered:double>>"
)


def words(body: bytes) -> list[bytes]:
    return body.translate(ALNUM_LOWER).split()


class SuffixAutomaton:
    """All word sequences of all templates; each state knows a place where its sequences end."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.places: list[set[tuple[int, int]]] = [set()]
        self.ends: list[list[tuple[int, int]]] = []
        for number, sequence in enumerate(sequences):
            last = 0
            for at, symbol in enumerate(sequence):
                last = self._extended(last, symbol)
                self.places[last].add((number, at + 1))
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            self.places[self.link[state]] |= self.places[state]
        self.places[0] = set()

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        self.places.append(set())
        return len(self.link) - 1

    def _split(self, state: int, symbol: int) -> int:
        """The state reached from ``state`` by ``symbol`` whose longest sequence extends that of ``state``."""
        target = self.next[state][symbol]
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(symbol) == target:
            self.next[state][symbol] = copy
            state = self.link[state]
        return copy

    def _extended(self, last: int, symbol: int) -> int:
        if symbol in self.next[last]:
            return self._split(last, symbol)
        new = self._state(self.length[last] + 1, 0, {})
        while last >= 0 and symbol not in self.next[last]:
            self.next[last][symbol] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, symbol)
        return new

    def state_of(self, sequence: list[int]) -> int:
        state = 0
        for symbol in sequence:
            state = self.next[state][symbol]
        return state

    def statistics(self, symbols):
        """(state, length) after each symbol: the longest sequence of a template that ends there."""
        state = length = 0
        for symbol in symbols:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if symbol in self.next[state]:
                state = self.next[state][symbol]
                length += 1
            yield state, length


class LicenceScanner:
    def __init__(self, templates=TEMPLATES, phrases=PHRASES, long=LONG, gap=GAP, covered=COVERED):
        self.long, self.gap, self.least = long, gap, covered
        self.labels = [label for label, _ in templates] + [label for _, label in phrases]
        split = [words(text.encode()) for _, text in templates] + [words(p.encode()) for p, _ in phrases]
        self.ids = {w: i for i, w in enumerate(sorted({w for s in split for w in s}))}
        self.sizes = [len(s) for s in split]
        coded = [[self.ids[w] for w in s] for s in split]
        self.automaton = SuffixAutomaton(coded)
        # the phrases that end in each state, found along its suffix links
        own: dict[int, list[tuple[int, str]]] = {}
        for code, (_, label) in zip(coded[len(templates) :], phrases, strict=True):
            own.setdefault(self.automaton.state_of(code), []).append((len(code), label))
        self.phrases: list[list[tuple[int, str]]] = []
        for state in range(len(self.automaton.link)):
            found, up = [], state
            while up > 0:
                found += own.get(up, [])
                up = self.automaton.link[up]
            self.phrases.append(found)
        self.shortest = min(self.long, *(n for s in own.values() for n, _ in s))

    def scan(self, body: bytes):
        """(number of words, places of phrases, chained spans) of one text."""
        found = words(body)
        get = self.ids.get
        codes = np.array([get(w, -1) for w in found], dtype=np.int32)
        stops = np.concatenate(([-1], np.flatnonzero(codes < 0), [len(codes)]))
        places, matches = [], []
        for gap in np.flatnonzero(np.diff(stops) > self.shortest).tolist():
            first, end = int(stops[gap]) + 1, int(stops[gap + 1])
            before = (0, 0)
            for at, (state, length) in enumerate(self.automaton.statistics(codes[first:end].tolist()), first):
                for n, label in self.phrases[state]:
                    if n <= length:
                        places.append((label, at + 1 - n))
                if before[1] >= self.long and length <= before[1]:
                    matches.append((at, *before))
                before = (state, length)
            if before[1] >= self.long:
                matches.append((end, *before))
        return len(found), sorted(places, key=lambda p: (p[1], p[0])), self._chained(matches)

    def _chained(self, matches):
        """Long matches (end, state, length) of a template in order, joined over short gaps."""
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        for end, state, length in matches:
            for template, stop in self.automaton.places[state]:
                by_template.setdefault(template, []).append((end - length, stop - length, length))
        spans = []
        for template, pieces in sorted(by_template.items()):
            chains: list[list[int]] = []  # file start, file end, template end, words covered
            for start, at, length in sorted(pieces):
                fits = [
                    c for c in chains
                    if 0 <= start + length - c[1] and at + length > c[2] and start - c[1] <= self.gap and abs(at - c[2]) <= self.gap
                    and start + length - max(start, c[1]) > 0
                ]
                if fits:
                    chain = max(fits, key=lambda c: (c[3], -c[0]))
                    new = min(length, start + length - chain[1], at + length - chain[2])
                    chain[1], chain[2], chain[3] = start + length, at + length, chain[3] + new
                else:
                    chains.append([start, start + length, at + length, length])
                # chains that no later match can reach are settled
                settled = [c for c in chains if start - c[1] > self.gap]
                chains = [c for c in chains if start - c[1] <= self.gap]
                spans += [(template, c) for c in settled]
            spans += [(template, c) for c in chains]
        return sorted(
            (self.labels[t], t, c[0], c[1] - 1, min(1.0, c[3] / self.sizes[t])) for t, c in spans
        )


def scan_licences(docs: DataFrame, scanner: LicenceScanner | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, places, spans) of every row.

    ``places``: label and first word (from 0) of each phrase.  ``spans``: the stretches
    of words that chain into a template, with the share of the template covered.  Null
    and empty texts have no word and empty lists; repeated rows are listed each; an empty
    table gives none; other columns are not read.  A text is streamed through the
    automaton whole, in the task that reads it.
    """
    scanner = scanner or LicenceScanner()

    def process(key, body):
        n, places, spans = scanner.scan(body)
        yield (
            key, n, [{"label": a, "word": b} for a, b in places],
            [{"label": a, "template": b, "first": c, "last": d, "covered": e} for a, b, c, d, e in spans],
        )

    return texts(docs, id_col, text_col).mapInArrow(by_rows(process, SCHEMA), SCHEMA)


def licence_digest(docs: DataFrame, covered: float = COVERED) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every text."""
    starts = F.transform("places", lambda p: p["word"])
    base = F.transform("places", lambda p: p["label"])
    wide = F.transform(F.filter("spans", lambda s: s["covered"] >= covered), lambda s: s["label"])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    best = F.coalesce(F.array_max(F.transform("spans", lambda s: s["covered"])), F.lit(0.0))
    return scan_licences(docs).select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, wide)).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )
