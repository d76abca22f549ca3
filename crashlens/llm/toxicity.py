"""Toxicity: misspelled lexicon terms found by Levenshtein automata, weighed by context.

The lexicon is a trie. The Levenshtein automata of all its terms are
intersected with it at once: a state is the set of (trie node, edits so far),
made deterministic as words need it, so most words leave the automaton after a
few letters. Around each hit a window of words tells quotation and report from
abuse. Words and stems that mark labelled toxic texts are learned and join the
trie, words with the same edits as the lexicon's terms; a logistic regression on
the hits gives the score.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crashlens.llm.common import per_text, word_chunks
from crashlens.llm.labelled import fit_logistic

LEXICON = ("idiot idiots moron morons imbecile stupid dumbass loser losers scum trash worthless "
           "pathetic disgusting clown bastard asshole bitch retard scumbag dickhead fuck fucking "
           "shit bullshit").split()
#: Edits allowed by length of a term. An edit of four letters is often another
#: word, so those hits count in a feature of their own.
EDITS = ((8, 2), (5, 1), (4, 1), (0, 0))
SHORT = 4
#: Words on each side of a hit.
WINDOW = 6
REPORTS = frozenset(b"said says say saying quote quoted wrote called word words term terms insult "
                    b"insults tweet comment told dijo dice palabra sagte wort nannte dit mot".split())
SECOND = frozenset(b"you your yours youre u ur are tu eres usted du dich bist ihr vous toi es".split())
QUOTES = re.compile("[\"\u201c\u201d\u201e\u00ab\u00bb]")
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

#: Stems: lengths, least share of toxic sample rows, how much rarer in clean rows.
STEM_LENGTHS = (4, 5, 6, 7)
STEM_SHARE = 0.01
STEM_RATIO = 0.02


class Lexicon:
    """Trie of terms, learned terms and stems with the lazily built automaton."""

    def __init__(self, terms=LEXICON, stems=(), learned=()):
        self.learned = frozenset(learned).difference(terms)
        self.child: list[dict[int, int]] = [{}]
        self.term: list[str | None] = [None]  # whole word
        self.stem: list[str | None] = [None]  # beginning of a word, without edits
        self.most = [0]  # edits that some term below allows
        self.allowed = [0]
        for t in (*terms, *sorted(self.learned)):
            self._add(t, self.term, next(e for n, e in EDITS if len(t) >= n))
        for t in stems:
            self._add(t, self.stem, 0)
        self.clear()

    def _add(self, word: str, kind: list, edits: int) -> None:
        node = 0
        self.most[0] = max(self.most[0], edits)
        for c in word.encode():
            if c not in self.child[node]:
                self.child[node][c] = len(self.child)
                self.child.append({})
                self.term.append(None)
                self.stem.append(None)
                self.most.append(0)
                self.allowed.append(0)
            node = self.child[node][c]
            self.most[node] = max(self.most[node], edits)
        kind[node] = word
        if kind is self.term:
            self.allowed[node] = edits

    def clear(self) -> None:
        self.moves: list[dict[int, int]] = []
        self.sets: list[dict[int, int]] = []
        self.ids: dict[frozenset, int] = {}
        self.found: list[tuple[str, int] | None] = []
        self.begun: list[str | None] = []
        self.held = 0
        self._state(self._closed({0: 0}))

    def _closed(self, nodes: dict[int, int]) -> dict[int, int]:
        """Add the nodes that follow by leaving out letters of a term."""
        todo = list(nodes.items())
        while todo:
            node, e = todo.pop()
            if nodes.get(node, 9) < e:
                continue
            for to in self.child[node].values():
                if e + 1 <= self.most[to] and e + 1 < nodes.get(to, 9):
                    nodes[to] = e + 1
                    todo.append((to, e + 1))
        return nodes

    def _state(self, nodes: dict[int, int]) -> int:
        if not nodes:
            return -1
        key = frozenset(nodes.items())
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(nodes)
            self.held += len(nodes)
            self.moves.append({})
            whole = min(((e, e > 0 and len(self.term[n]) <= SHORT, self.term[n]) for n, e in nodes.items()
                         if self.term[n] is not None and e <= self.allowed[n]), default=None)
            self.found.append((whole[2], whole[0]) if whole else None)
            self.begun.append(next((self.stem[n] for n, e in sorted(nodes.items())
                                    if e == 0 and self.stem[n] is not None), None))
        return self.ids[key]

    def _move(self, state: int, c: int) -> int:
        nodes: dict[int, int] = {}

        def reach(node: int, e: int) -> None:
            if e <= self.most[node] and e < nodes.get(node, 9):
                nodes[node] = e

        for node, e in self.sets[state].items():
            for letter, to in self.child[node].items():
                reach(to, e if letter == c else e + 1)
            reach(node, e + 1)
        to = self.moves[state][c] = self._state(self._closed(nodes))
        return to

    def look(self, word: bytes) -> tuple[str, int] | None:
        """(term, edits) of the nearest term within its edits, (stem, -1) of a
        word that begins with a learned stem, else None."""
        state, begun, moves = 0, None, self.moves
        for c in word:
            to = moves[state].get(c)
            if to is None:
                to = self._move(state, c)
            if to < 0:
                return (begun, -1) if begun else None
            state = to
            begun = begun or self.begun[state]
        found = self.found[state]
        if begun and found and found[1] and len(found[0]) <= SHORT:
            return begun, -1
        return found or ((begun, -1) if begun else None)


#: Trie nodes in the automaton's states that are kept before it is built anew.
MOST_NODES = 1_000_000
FEATURES = 12


def features(lexicon: Lexicon, text: str) -> tuple[float, ...]:
    """Counts of hits by closeness and context; all zero without a hit."""
    if lexicon.held > MOST_NODES:
        lexicon.clear()
    hits, n = {}, 0
    for words in word_chunks(text):
        n += len(words)
        for w in set(words):
            if w not in hits and (hit := lexicon.look(w)):
                hits[w] = hit
    if not hits:
        return (0.0,) * FEATURES
    data = text.encode()
    places = [(m.start(), m.end(), m.group()) for m in WORD.finditer(data.lower())]
    exact = reported = one = two = stems = direct = told = near_learned = short = 0
    for k, (a, b, w) in enumerate(places):
        if (hit := hits.get(w)) is None:
            continue
        term, edits = hit
        if edits > 0 and len(term) <= SHORT:
            short += 1
            continue
        around = places[max(0, k - WINDOW):k + WINDOW + 1]
        before = data[around[0][0]:a].decode(errors="ignore")
        after = data[b:around[-1][1]].decode(errors="ignore")
        near = {x[2] for x in around}
        quoted = bool(QUOTES.search(before) and QUOTES.search(after)) or not near.isdisjoint(REPORTS)
        direct += not quoted and not near.isdisjoint(SECOND)
        if edits == -1 or term in lexicon.learned:
            if edits > 0:
                near_learned += not quoted
            else:
                stems += not quoted
            told += quoted
        elif edits == 0:
            exact, reported = exact + (not quoted), reported + quoted
        else:
            one, two = one + (edits == 1), two + (edits == 2)
    log = lambda v: float(np.log1p(v))
    own = {t for t, e in hits.values() if e == 0 and t not in lexicon.learned}
    marks = {w for w, (t, e) in hits.items() if e == -1 or e == 0 and t in lexicon.learned}
    return (log(exact), log(reported), log(one), log(two), log(stems), log(direct),
            float(min(5, len(own))), float(min(5, len(marks))),
            float(min(10.0, 100.0 * (exact + stems) / n)), log(told), log(near_learned), log(short))


class Stems(list):
    """Learned beginnings, with the learned whole words in ``terms``."""

    terms: tuple[str, ...] = ()


def learned_stems(train: DataFrame) -> Stems:
    """Word beginnings and whole words that occur in toxic rows of the sample and hardly in clean ones.

    Toxic rows that share their smallest word hash (copies, mostly) count once.
    Every beginning and word (marked by a space at its end) is counted in toxic
    and clean rows alike, and each that passes is kept: the sample bounds their
    number.
    """
    def beginnings(text: str):
        words = {w for part in word_chunks(text) for w in part}
        shown = [w.decode() for w in words]
        return (sorted({w[:k] for w in shown for k in STEM_LENGTHS if len(w) >= k}
                       | {w + " " for w in shown if len(w) >= STEM_LENGTHS[0]}),
                min(shown, key=lambda w: hash_of(w), default=""))

    def hash_of(w: str) -> int:
        return int.from_bytes(w.encode()[:16].ljust(16, b"\0"), "big") * 0x9E3779B97F4A7C15F39CC0605CEDC835 % (1 << 127)

    sizes = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Stems()
    rows = train.select("label", per_text(lambda: beginnings, "stems array<string>, sketch string")(
        F.col("text")).alias("_s")).select("label", "_s.*")
    found = rows.select("label", F.when(F.col("label") == 1, F.col("sketch")).alias("sketch"),
                        F.explode("stems").alias("stem")) \
        .groupBy("stem", "label", "sketch").agg(F.count(F.lit(1)).alias("n")) \
        .groupBy("stem").agg(F.count(F.when(F.col("label") == 1, 1)).alias("toxic"),
                             F.coalesce(F.sum(F.when(F.col("label") == 0, F.col("n"))), F.lit(0)).alias("clean")) \
        .where((F.col("toxic") >= max(4, STEM_SHARE * n_toxic))
               & ((F.col("clean") + 0.5) / n_clean <= STEM_RATIO * F.col("toxic") / n_toxic)).collect()
    kept: dict[str, None] = {}
    begun: set[str] = {t[:k] for t in LEXICON for k in range(1, len(t) + 1)}  # beginnings of what is kept
    for r in sorted(found, key=lambda r: (-r["toxic"], -len(r["stem"]), r["stem"])):
        stem = r["stem"]
        if not stem.endswith(" ") and stem not in begun and not any(stem[:k] in kept for k in STEM_LENGTHS):
            kept[stem] = None
            begun.update(stem[:k] for k in range(1, len(stem) + 1))
    learned = Stems(kept)
    learned.terms = tuple(sorted(r["stem"][:-1] for r in found if r["stem"].endswith(" ")))
    return learned


def fit_toxicity(train: DataFrame):
    """(stems, weights, intercept) from rows with text and label, a bounded sample."""
    stems = learned_stems(train)
    rows = train.select("label", score_features(F.col("text"), stems).alias("_f")) \
        .select("label", "_f.x").collect()
    x = np.array([r["x"] for r in rows], float).reshape(len(rows), FEATURES)
    weights, intercept = fit_logistic(x, np.array([r["label"] for r in rows], float))
    return stems, weights, intercept


def score_features(text: Column, stems: list[str]) -> Column:
    words, terms = list(stems), getattr(stems, "terms", ())

    def make():
        lexicon = Lexicon(LEXICON, words, terms)
        return lambda t: (features(lexicon, t),)
    return per_text(make, "x array<double>")(text)


def toxicity_score(text: Column, model) -> Column:
    """Score from 0 to 1 of a text column; null and empty texts have no hit and
    get the intercept's score. Equal texts get equal scores."""
    stems, weights, intercept = model
    words, terms = list(stems), getattr(stems, "terms", ())

    def make():
        lexicon = Lexicon(LEXICON, words, terms)

        def score(t: str):
            z = float(np.dot(features(lexicon, t), weights)) + intercept
            return (float(1 / (1 + np.exp(-np.clip(z, -30, 30)))),)
        return score

    return per_text(make, "score double")(text)["score"]
