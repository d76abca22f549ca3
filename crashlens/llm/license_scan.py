"""License scans by matching statistics over a suffix automaton.

All licence templates (and the base phrases) are cut into word tokens and put
into one generalised suffix automaton. A text is streamed through it word by
word: the automaton's state is the longest suffix read so far that occurs
anywhere in a template. Matches that cannot be extended and are long enough
become anchors (place in the text, place in the template); anchors in line are
chained per template into a span, whose covered share decides the label.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column
from pyspark.sql import functions as F

from crashlens.llm.common import per_text, word_chunks

#: Base phrases and their labels.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

#: (label, template). Notices as the licences ask to be shown, and the customary
#: one-line statements.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this
     software and associated documentation files (the "Software"), to deal in the Software without
     restriction, including without limitation the rights to use, copy, modify, merge, publish,
     distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
     Software is furnished to do so"""),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", """you may not use this file except in compliance with the License. You may obtain a
     copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
     applicable law or agreed to in writing, software distributed under the License is distributed
     on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"""),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the
     terms of the GNU General Public License as published by the Free Software Foundation, either
     version 3 of the License, or (at your option) any later version"""),
    ("lgpl", "GNU Lesser General Public License"),
    ("agpl", "GNU Affero General Public License"),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are
     permitted provided that the following conditions are met"""),
    ("bsd", "Licensed under the BSD 3-Clause License"),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with
     or without fee is hereby granted, provided that the above copyright notice and this permission
     notice appear in all copies"""),
    ("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"""),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights"),
    ("public-domain", """This is free and unencumbered software released into the public domain"""),
]

#: Least words of a match that becomes an anchor, most words between chained
#: anchors, least covered share of a template for its label.
LEAST_MATCH = 3
MOST_GAP = 12
LEAST_COVER = 0.7


def tokens(text: str) -> list[bytes]:
    return [w for part in word_chunks(text) for w in part]


class SuffixAutomaton:
    """Generalised suffix automaton of several token sequences.

    ``ends[state]`` lists (sequence, end place) of every occurrence of the
    state's strings, ``length`` and ``link`` are the usual arrays.
    """

    def __init__(self, sequences: list[list[bytes]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        own: list[list[tuple[int, int]]] = [[]]
        for k, sequence in enumerate(sequences):
            last = 0
            for place, token in enumerate(sequence):
                last = self._extend(last, token, own)
                own[last].append((k, place))
        self.ends: list[list[tuple[int, int]]] = [list(x) for x in own]
        for state in sorted(range(1, len(own)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                self.ends[self.link[state]] += self.ends[state]

    def _state(self, length: int, own: list) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        own.append([])
        return len(self.next) - 1

    def _split(self, state: int, token: bytes, target: int, own: list) -> int:
        """A copy of ``target`` for the strings that end right after ``state``."""
        copy = self._state(self.length[state] + 1, own)
        self.next[copy] = dict(self.next[target])
        self.link[copy] = self.link[target]
        self.link[target] = copy
        while state >= 0 and self.next[state].get(token) == target:
            self.next[state][token] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, token: bytes, own: list) -> int:
        target = self.next[last].get(token)
        if target is not None:  # another sequence already has this string
            return target if self.length[target] == self.length[last] + 1 \
                else self._split(last, token, target, own)
        fresh, state = self._state(self.length[last] + 1, own), last
        while state >= 0 and token not in self.next[state]:
            self.next[state][token] = fresh
            state = self.link[state]
        if state >= 0:
            target = self.next[state][token]
            self.link[fresh] = target if self.length[target] == self.length[state] + 1 \
                else self._split(state, token, target, own)
        return fresh


class Scanner:
    """Automaton of base phrases and templates, and the scan of one text."""

    def __init__(self, templates=TEMPLATES, base=BASE):
        self.base = [(tokens(p), label) for p, label in base]
        self.templates = [(tokens(t), label) for label, t in templates]
        sequences = [p for p, _ in self.base] + [t for t, _ in self.templates]
        self.lengths = [len(s) for s in sequences]
        self.labels = [x[1] for x in self.base + self.templates]
        self.auto = SuffixAutomaton(sequences)
        n = len(self.base)
        # base phrases that end in a state: (phrase, its length)
        self.whole = [[(k, self.lengths[k]) for k in range(n) if self._ends_with(s, k)]
                      for s in range(len(self.auto.next))]

    def _ends_with(self, state: int, k: int) -> bool:
        """Whether the longest string of ``state`` ends with the whole base phrase k."""
        phrase, at = self.base[k][0], 0
        for token in phrase:
            at = self.auto.next[at][token]
        while state > 0:
            if state == at:
                return True
            state = self.auto.link[state]
        return False

    def statistics(self, text: str):
        """Number of words, base places [(phrase, first word)], anchors
        [(sequence, first word in text, first word in template, words)]."""
        nexts, links, lengths = self.auto.next, self.auto.link, self.auto.length
        ends, whole, root = self.auto.ends, self.whole, self.auto.next[0]
        n, state, size, base, anchors = 0, 0, 0, [], []

        def keep(state, size, end):  # a match that goes no further
            for k, place in ends[state]:
                if size >= min(LEAST_MATCH, self.lengths[k]):
                    anchors.append((k, end - size + 1, place - size + 1, size))

        for words in word_chunks(text):
            for i, w in enumerate(words, n):
                if size:
                    to = nexts[state].get(w)
                    if to is None:
                        if size > 1:
                            keep(state, size, i - 1)
                        while state >= 0 and w not in nexts[state]:
                            state = links[state]
                        if state < 0:
                            state = size = 0
                            continue
                        size = lengths[state]
                        to = nexts[state][w]
                    state, size = to, size + 1
                    if whole[state]:
                        base += [(k, i - m + 1) for k, m in whole[state] if size >= m]
                elif w in root:
                    state, size = root[w], 1
            n += len(words)
        if size > 1:
            keep(state, size, n - 1)
        return n, base, anchors

    def spans(self, anchors) -> list[tuple[int, int, int, float]]:
        """Chains of anchors: (sequence, first word, last word, covered share),
        the best chain that ends in each anchor. Predecessors lie before the
        anchor in text and template, at most MOST_GAP words back."""
        by = defaultdict(set)
        for k, *anchor in anchors:
            by[k].add(tuple(anchor))
        out = []
        for k, found in by.items():
            rows, best, low = sorted(found), [], 0
            reach = max(size for _, _, size in rows) + MOST_GAP
            for j, (at, place, size) in enumerate(rows):
                while rows[low][0] + reach < at:
                    low += 1
                cover, first = size, at
                for i in range(low, j):
                    b_at, b_place, b_size = rows[i]
                    if b_at + b_size <= at <= b_at + b_size + MOST_GAP \
                            and b_place + b_size <= place and best[i][0] + size > cover:
                        cover, first = best[i][0] + size, best[i][1]
                best.append((cover, first))
                out.append((k, first, at + size - 1, min(1.0, cover / self.lengths[k])))
        return out

    def scan(self, text: str):
        """(n_words, n_base, first_word, last_word, base_labels, labels, score, spans).

        first_word and last_word are null without a base phrase; spans are
        label:first:last of accepted chains, joined by commas. Score is the
        largest covered share of a template or phrase, 0 without a match.
        """
        n, base, anchors = self.statistics(text)
        chains = self.spans(anchors)
        accepted = sorted({(self.labels[k], a, b) for k, a, b, share in chains
                           if share >= LEAST_COVER and (k >= len(self.base) or share == 1.0)})
        own = {self.labels[k] for k, _ in base}
        starts = [at for _, at in base]
        score = max([0.0, *(share for k, _, _, share in chains if k >= len(self.base)),
                     *(1.0 for _ in base[:1])])
        return (n, len(base), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(own)), ",".join(sorted(own | {x[0] for x in accepted})), score,
                ",".join(f"{x}:{a}:{b}" for x, a, b in accepted))


RESULT = ("n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, spans string")


def license_scan(text: Column) -> Column:
    """Struct of the scan of a text column, see :meth:`Scanner.scan`.

    Null and empty texts have no words, no labels and score 0. Long texts are
    streamed in pieces. Equal rows give equal results.
    """
    return per_text(lambda: Scanner().scan, RESULT)(text)
