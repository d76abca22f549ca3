"""Personal data: fixed recognisers plus bootstrapped contextual extraction.

The recognisers give the base spans (email, ip, card, phone) and seeds of the
kind ``secret``. Seeds induce lexical patterns: the words before an instance,
the word before and after it, and its own shape. Spark counts the edges of the
graph of patterns and instances and scores both sides in turns: a pattern is
as good as the instances it meets, an instance as good as its patterns.
Instances that come out sure induce patterns of their own, which are counted and
scored with the others. The patterns that stay above a confidence then find
identifiers that no recogniser knows.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crashlens.llm.common import BROADCAST_ROWS, per_text
from crashlens.session import stage_table

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Seeds of secrets: named assignments and the public form of access key ids.
SECRET = re.compile(r"(?:\b(?:password|passwd|pwd|token|secret|api[_-]?key)\s?[=:]\s?\"?([^\s\"]{6,})"
                    r"|\b(AKIA[0-9A-Z]{16})\b)")
#: Words one of which every match of SECRET holds.
SECRET_WORDS = ("AKIA", "password", "passwd", "pwd", "token", "secret", "api")
#: What may be an identifier: a run of visible characters. Runs with a digit that
#: single spaces or hyphens join may also be one together.
TOKEN = re.compile(r"[^\s\"'<>(){}\[\],;=:]+")
SHOWN = re.compile(r"[^\s\"]+")
JOINTS = frozenset((" ", "-", " -", "- "))
DIGIT = re.compile("[0-9]")

#: Turns of induction, rounds of scoring in each, prior weight against a pattern,
#: confidence from which a pattern finds new spans and an instance induces
#: patterns, and least instances that must induce a pattern.
TURNS = 2
ROUNDS = 3
PRIOR = 2.0
#: Least share of a pattern's meetings that must be with instances that induced it;
#: patterns below it are part of ordinary text and stay out of the graph.
HOPE = 0.02
#: Parts of the texts (one of so many) that patterns below HOPE are told from first.
SIEVE = (64, 8)
CONFIDENCE = 0.85
LEAST_SEEDS = 3


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by kind and start, in code points, end exclusive."""
    out: list[tuple[str, int, int]] = []
    done, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > done and text[first - 1] in LOCAL_CHARS:
            first -= 1
        found = DOMAIN.match(text, at) if first < at else None
        if found:
            done = found.end()
            out.append(("email", first, done))
        at = text.find("@", max(at + 1, done))
    if not DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


_ASCII_KINDS = str.maketrans({c: "9" if c.isdigit() else "a" if c.islower() else "A"
                              for c in map(chr, range(128)) if c.isalnum()})
REPEATED = re.compile(r"([aA9])\1+")


def shape(token: str) -> str:
    """Case-and-digit shape with repeat counts, such as A4x16 after a fixed start."""
    if token.isascii():
        kinds = token[:64].translate(_ASCII_KINDS)
    else:
        kinds = "".join("9" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else c
                        for c in token[:64])
    return REPEATED.sub(r"\1+", kinds)


#: Marks around a word that its pattern leaves out.
MARKS = ".,;!?\"'()[]{}"
#: Marks that may end a plain word.
ENDS = ".,;:!?"


@lru_cache(1 << 16)
def _word(text: str) -> str:
    return re.sub(r"\d+", "#", text.strip(MARKS).lower())


def patterns(text: str, first: int, last: int) -> list[str]:
    """Lexical patterns of an instance at [first, last): two words before, the
    words on both sides, and the word before with the instance's shape."""
    before = [_word(w) for w in text[max(0, first - 80):first].replace('"', " ").rsplit(None, 2)[-2:]]
    after = next(iter(text[last:last + 60].replace('"', " ").split(None, 1)), "")
    left = before[-1] if before else ""
    made = [f"R|{left}|{_word(after)}", f"S|{left}|{shape(text[first:last])}"]
    if len(before) == 2:
        made.append(f"L|{before[0]} {left}")
    return made


def asked(text: str, first: int, last: int) -> list[str]:
    """Patterns that may find [first, last). Without a digit these are marked ones,
    scored over words too, so that words take nothing from the others' confidence."""
    made = patterns(text, first, last)
    return made if DIGIT.search(text, first, last) else ["~" + p for p in made]


def met_by(text: str, first: int, last: int) -> list[str]:
    """Patterns whose count the instance raises: with a digit, plain and marked."""
    made = asked(text, first, last)
    return made + ["~" + p for p in made] if made[0][0] != "~" else made


_GONE = (MARKS + ":#0123456789").encode()
#: As text without quotation marks and white space other than single spaces.
_GAPLESS = bytes(0x20 if chr(b).isspace() and b < 0x80 or chr(b) == '"' else b for b in range(256))
_GONE_GAPLESS = _GONE.replace(b'"', b"")


def _bare(text: str) -> bytes:
    """The text in small letters without marks and digits, as UTF-8."""
    return text.lower().encode().translate(None, _GONE)


#: Digits that :func:`_bare` leaves.
DIGITS = re.compile(r"[^\D0-9]")
#: Longest word that surely lies whole in the windows of :func:`patterns`.
SHORT = 25
#: White space that may push a word out of a window.
GAP = re.compile(r"[\s\"]{12,}")
#: Kinds of the first code points: between words, letters, ENDS, the rest of words, and
#: digits and white space that :func:`_bare` does not know; later code points count as such.
GAP_POINT, LETTER, END, OTHER, UNUSUAL = range(5)


def _point_kind(c: str) -> int:
    if c == '"' or c.isspace():
        return GAP_POINT if c.isascii() else UNUSUAL
    return LETTER if c.isalpha() else END if c in ENDS else UNUSUAL if DIGITS.match(c) else OTHER


POINT_KINDS = np.array([_point_kind(chr(c)) for c in range(0x3000)], np.uint8)


def _usual_words(text: str):
    """Begins and ends of the words of a text, places of those with anything but letters,
    marks at their end aside, and of long ones; None if it has unusual code points."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    if not len(points) or points.max() >= len(POINT_KINDS):
        return None
    kind = POINT_KINDS[points]
    if kind.max() == UNUSUAL:
        return None
    solid = np.zeros(len(kind) + 2, np.int8)
    solid[1:-1] = kind != GAP_POINT
    turns = np.flatnonzero(solid[1:] != solid[:-1])
    begins, ends = turns[::2], turns[1::2]
    odd = kind == OTHER
    odd[:-1] |= (kind[:-1] == END) & (kind[1:] == LETTER)
    odd[begins[kind[begins] == END]] = True
    places = np.searchsorted(begins, np.flatnonzero(odd), "right") - 1
    return begins, ends, sorted(set(places.tolist())), np.flatnonzero(ends - begins > SHORT).tolist()


class Near:
    """Where in a text any of some patterns may hold, told from neighbouring words.

    A token of letters alone has no digit, sign or mark in its shape; unless a
    pattern has such a shape, it can only meet pairs of words: the two before it,
    or the one before and the one after. Other tokens must follow a known word.
    Unmarked patterns and those of ``also`` are looked for at tokens with a digit
    alone: no other token meets an unmarked one (see :func:`asked`).
    """

    def __init__(self, found, also=()):
        self.lefts, self.before, self.around, self.shapes = set(), set(), set(), set()
        for p in found:
            if p[0] != "~":
                continue
            kind, pairs = self._pairs(p)
            self.lefts.update(self._left(kind, pairs))
            if kind == "L":
                self.before.update(pairs)
            elif kind == "R":
                self.around.update(pairs)
            else:
                self.shapes.update(left for left, shown in pairs if shown.replace("+", "").isalpha())
        self.digit_lefts = self.lefts.union(*(self._left(*self._pairs(p)) for p in chain(found, also)))

        # the same without marks and digits, which may leave nothing of a word
        self.bare_lefts = set(map(_bare, self.lefts))
        self.bare_before = {tuple(map(_bare, p)) for p in self.before}
        self.bare_around = {tuple(map(_bare, p)) for p in self.around}
        self.bare_last = {left for left, after in self.bare_around if not after}
        self.bare_shapes = set(map(_bare, self.shapes))
        self.bare_first = self.bare_lefts.union(first for first, _ in self.bare_before)

    @staticmethod
    def _pairs(p: str):
        p = p.removeprefix("~")
        kind, rest = p[0], p[2:]
        if kind == "L":
            return kind, [tuple(rest.rsplit(" ", 1))]
        parts = rest.split("|")  # a word may hold the mark itself
        return kind, [("|".join(parts[:k]), "|".join(parts[k:])) for k in range(1, len(parts))]

    @staticmethod
    def _left(kind: str, pairs) -> list[str]:
        return [pairs[0][1]] if kind == "L" else [left for left, _ in pairs]

    def runs(self, text: str):
        """Spans of the visible runs that may hold a token to look at."""
        usual = _usual_words(text)
        if usual is None:
            yield from self._runs_by_split(text)
            return
        begins, ends, odd, long = usual
        spare = len(text) - int((ends - begins).sum()) - len(begins)  # white space beyond one between words
        if spare > 8 and GAP.search(text):
            picked = set(range(len(begins)))  # as _by_pairs
        elif len(begins):
            if spare == -1:  # words one apart
                bare = text.lower().encode().translate(_GAPLESS, _GONE_GAPLESS)
            else:
                bare = _bare(" ".join(text.replace('"', " ").split()))
            picked = self._by_bare(bare, odd, lambda i: text[begins[i]:ends[i]])
        else:
            picked = set()
        for i in long:  # windows may cut it
            picked.update(range(i - 1, i + 3))
        for i in sorted(picked):
            if 0 <= i < len(begins):
                yield int(begins[i]), int(ends[i])

    def _runs_by_split(self, text: str):
        """As :meth:`runs`, whatever the code points."""
        words = text.replace('"', " ").split()  # the runs that SHOWN finds
        if not words:
            return
        sizes = [*map(len, words)]
        begins = list(accumulate(sizes, initial=0))
        spare = len(text) - begins[-1] - len(words)
        odd = [i for i, w in enumerate(words) if not w.isalpha() and not w.rstrip(ENDS).isalpha()]
        if spare > 8 and GAP.search(text) or not text.isascii() and DIGITS.search(text):
            picked = self._by_pairs(text, words).union(odd)
        else:
            picked = self._by_bare(_bare(" ".join(words)), odd, words.__getitem__)
        if max(sizes) > SHORT:
            picked.update(j for i, n in enumerate(sizes) if n > SHORT for j in range(i - 1, i + 3))
        if spare == -1:  # places follow from lengths
            yield from ((begins[i] + i, begins[i + 1] + i) for i in sorted(picked) if 0 <= i < len(words))
        elif picked:
            for i, m in enumerate(SHOWN.finditer(text)):
                if i in picked:
                    yield m.span()

    def _by_bare(self, data: bytes, odd: list[int], word) -> set[int]:
        """Places of words by what is left of their neighbours; ``word`` gives the word at a place."""
        bare = data.split(b" ")
        first, end = self.bare_first, len(bare) - 1
        picked = set()
        for i in odd:  # a token that begins with the word, without a digit, must follow a known word
            if (bare[i - 1] if i else b"") in self.bare_lefts or DIGIT.search(w := word(i)) or not TOKEN.fullmatch(w):
                picked.add(i)
        for i in [-1, *[i for i, w in enumerate(bare) if w in first]]:
            left, at = bare[i] if i >= 0 else b"", i + 1
            if at > end:
                break
            after = bare[at + 1] if at < end else b""
            if left in self.bare_shapes or (left, after) in self.bare_around \
                    or left in self.bare_last and (at == end or not word(at).isalpha()):  # or a mark at its end
                picked.add(at)
            if i >= 0 and (left, bare[at]) in self.bare_before:
                picked.add(at + 1)
        return picked

    def _by_pairs(self, text: str, words: list[str]) -> set[int]:
        if GAP.search(text):
            return set(range(len(words)))
        known = [w.strip(MARKS).lower() for w in words]
        known = [k if k.isalpha() else _word(k) for k in known]
        left = ["", *known]
        bare = [w.rstrip(ENDS) for w in words]
        # the mark at the end of a word, or the next word
        after = [n if len(t) == len(w) else _word(w[len(t):])
                 for w, t, n in zip(words, bare, [*known[1:], ""], strict=True)]
        picked = {i + 1 for i, pair in enumerate(zip(left, known, strict=False)) if pair in self.before}
        picked.update(i for i, pair in enumerate(zip(left, after, strict=False)) if pair in self.around)
        if self.shapes:
            picked.update(i for i, w in enumerate(left[:-1]) if w in self.shapes)
        return picked


def _free(spans, first: int, last: int) -> bool:
    return all(last <= a or b <= first for _, a, b in spans)


def seeds(text: str):
    """(kind, first, last) of what the recognisers find."""
    return _with_secrets(text, base_spans(text))


def _with_secrets(text: str, base):
    spans = [*base]
    if any(w in text for w in SECRET_WORDS) and DIGIT.search(text):
        for m in SECRET.finditer(text):
            g = 1 if m[1] else 2
            if DIGIT.search(m[g]) and _free(spans, *m.span(g)):
                spans.append(("secret", *m.span(g)))
    return spans


def _tokens(text: str, near: Near | None):
    """Spans of tokens; with ``near``, without most of those that cannot count."""
    for a, b in [(0, len(text))] if near is None else near.runs(text):
        yield from (m.span() for m in TOKEN.finditer(text, a, b))


def candidates(text: str, taken, near: Near | None = None):
    """(first, last) of what may be an identifier and overlaps no seed: every
    token, and every run of tokens with digits joined by a space or hyphen.
    With ``near``, only those that some of its patterns may meet."""
    taken = sorted((a, b) for _, a, b in taken)
    out, k, begin, end, size = [], 0, 0, 0, 0  # the open run

    def after_left(a: int, digit) -> bool:
        if near is None:
            return True
        words = text[max(0, a - 80):a].replace('"', " ").rsplit(None, 1)
        return (_word(words[-1]) if words else "") in (near.digit_lefts if digit else near.lefts)

    def close():
        if size > 1 and after_left(begin, True):
            out.append((begin, end))

    for a, b in _tokens(text, near):
        shown = text[a:b].rstrip(".!?-")
        b = a + len(shown)
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        free = a < b and (k == len(taken) or b <= taken[k][0])
        digit = DIGIT.search(shown)
        if free and after_left(a, digit):
            out.append((a, b))
        if free and digit:
            if size and text[end:a] in JOINTS:
                size, end = size + 1, b
            else:
                close()
                begin, end, size = a, b, 1
        elif size:
            close()
            size = 0
    close()
    return out


#: An edge: ``seed`` is the kind of an instance that a recogniser knows, ``sought``
#: tells whether the pattern is one of those asked for, ``sure`` whether the instance
#: has a digit, without which it induces nothing.
EDGE = "seed: string, who: binary, pattern: string, sought: boolean, sure: boolean"


def _edges(text: str, sought: frozenset[str] | None, near: Near | None, hopeless: frozenset[str] = frozenset()):
    """Edges of what meets a pattern sought for, with all its patterns but hopeless ones."""
    found = seeds(text)
    made = []
    for kind, a, b in found + [(None, *c) for c in candidates(text, found, near)]:
        met = met_by(text, a, b)
        hits = [sought is None or p in sought for p in met]
        if any(hits):
            sure = kind is None and bool(DIGIT.search(text, a, b))
            # a recogniser's instance has induced its patterns already
            kept = [(p, hit) for p, hit in zip(met, hits, strict=True) if (hit or sure) and p not in hopeless]
            if kept:
                who = hashlib.blake2b(text[a:b].encode(), digest_size=8).digest()
                made += [(kind, who, p, hit, sure) for p, hit in kept]
    return (made,)


def _met_often(text: str, sought: frozenset[str], near: Near):
    """How often a text meets each of some patterns."""
    found = seeds(text)
    spans = [(a, b) for _, a, b in found] + candidates(text, found, near)
    return (list(Counter(p for a, b in spans for p in met_by(text, a, b) if p in sought).items()),)


def _seed_patterns(text: str):
    return ([(kind, p) for kind, a, b in seeds(text) for p in met_by(text, a, b)],)


def _shipped(names: DataFrame) -> frozenset[str] | None:
    """The patterns as a set for the tasks, or None if they are more than may be sent."""
    rows = names.select("pattern").distinct().limit(BROADCAST_ROWS + 1).collect()
    return frozenset(r["pattern"] for r in rows) if len(rows) <= BROADCAST_ROWS else None


def _hopeless(docs: DataFrame, induced: DataFrame, sought: frozenset[str]) -> frozenset[str]:
    """Patterns that HOPE surely rules out: those whose meetings in some of the texts are
    already too many for their support. The others are counted in all texts later.

    Such patterns of ordinary words are few but hold nearly all meetings, and the more
    text, the more of them are induced. Most show in a small part of the texts; the next
    part is larger and is searched for the rest alone.
    """
    support = {r["pattern"]: r["support"] for r in induced.groupBy("pattern").agg(F.max("support").alias("support")).collect()}
    gone: frozenset[str] = frozenset()
    for one_of in SIEVE:
        left = sought - gone
        met = docs.where(F.pmod(F.xxhash64("text"), F.lit(one_of)) == 0).select(F.explode(per_text(
            lambda left=left: (lambda near: lambda t: _met_often(t, left, near))(Near(left)),
            "m array<struct<pattern: string, n: long>>")(F.col("text"))["m"]).alias("m")) \
            .groupBy("m.pattern").agg(F.sum("m.n").alias("n")).collect()  # a row a pattern
        gone |= {r["pattern"] for r in met if support[r["pattern"]] < HOPE * r["n"]}
    return gone


def _graph(docs: DataFrame, induced: DataFrame) -> DataFrame:
    """seed, who, pattern, sought, sure, n of all that meets a pattern of ``induced``,
    without the edges of patterns that are surely hopeless.

    Edges are counted before any shuffle that could meet a hot pattern or a hot
    instance. More patterns than can be sent to the tasks are told apart by a
    join: then every token is an edge first.
    """
    sought = _shipped(induced)
    gone = frozenset() if sought is None else _hopeless(docs, induced, sought)

    def work():  # what meets a hopeless pattern alone is an edge only for its other patterns, if it has a digit
        near = None if sought is None else Near(sought - gone, gone)
        return lambda t: _edges(t, sought, near, gone)
    made = docs.select(F.explode(per_text(work, f"e array<struct<{EDGE}>>")(F.col("text"))["e"]).alias("e")).select("e.*")
    keys = ["seed", "who", "pattern", "sought", "sure"]
    edges = made.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    if sought is None:
        names = induced.select("pattern", F.lit(True).alias("_known")).distinct()
        edges = edges.drop("sought").join(names, "pattern", "left").withColumn("sought", F.col("_known").isNotNull()) \
            .drop("_known").where(F.col("sought") | F.col("sure"))
    return stage_table(edges.select(*keys, "n"), "pii-edges")


def _scored(edges: DataFrame, induced: DataFrame, rounds: int) -> tuple[DataFrame, DataFrame]:
    """Patterns with their confidence, and (kind, who, belief) of open instances.

    An instance that a recogniser knows has confidence 1 for its kind; another
    starts at 0 and becomes 1 - product(1 - confidence of its patterns).
    """
    met = edges.where("sought").groupBy("pattern").agg(F.sum("n").alias("n_all"))
    scored = stage_table(induced.join(met, "pattern").where(F.col("support") >= HOPE * F.col("n_all")).withColumn(
        "confidence", F.col("n_seeds") / (F.col("n_all") + PRIOR)), "pii-hopeful")
    open_edges = stage_table(edges.where("sought and seed is null").select("who", "pattern", "n")
                             .join(scored.select("kind", "pattern"), "pattern"), "pii-open")
    for _ in range(rounds):
        scored = stage_table(scored, "pii-scores")
        known = open_edges.join(scored.select("kind", "pattern", "confidence"), ["kind", "pattern"]) \
            .groupBy("kind", "who").agg(
                (1 - F.exp(F.sum(F.log(1 - F.least(F.col("confidence"), F.lit(0.999)))))).alias("belief"))
        known = stage_table(known, "pii-beliefs")
        gained = open_edges.join(known, ["kind", "who"]).groupBy("kind", "pattern") \
            .agg(F.sum(F.col("n") * F.col("belief")).alias("gained"))
        scored = scored.drop("confidence", "gained").join(gained, ["kind", "pattern"], "left") \
            .withColumn("confidence", (F.col("n_seeds") + F.coalesce(F.col("gained"), F.lit(0.0)))
                        / (F.col("n_all") + PRIOR)).drop("gained")
    return stage_table(scored, "pii-scored"), known


def score_patterns(docs: DataFrame, rounds: int = ROUNDS, turns: int = TURNS) -> DataFrame:
    """kind, pattern, confidence, n_seeds of the patterns that instances induce.

    A first pass counts the patterns of the seeds; those of LEAST_SEEDS instances
    are the first turn's. Each turn is a pass that counts what meets its patterns,
    and rounds of scoring. Instances with a digit and a belief of CONFIDENCE
    then induce their other patterns, if again LEAST_SEEDS of them do, for the
    next turn. ``n_seeds`` counts the instances that induced a
    pattern.
    """
    induced = stage_table(docs.select(F.explode(per_text(
        lambda: _seed_patterns, "e array<struct<kind: string, pattern: string>>")(F.col("text"))["e"]).alias("e"))
        .select("e.*").groupBy("kind", "pattern").agg(F.count(F.lit(1)).alias("n_seeds"))
        .where(F.col("n_seeds") >= LEAST_SEEDS).withColumn("support", F.col("n_seeds")), "pii-induced")
    edges, fresh = None, induced
    for turn in range(turns):
        new = _graph(docs, fresh)  # no pattern is in two turns
        edges = new if edges is None else edges.unionByName(new)
        scored, beliefs = _scored(edges, induced, rounds)
        if turn == turns - 1:
            break
        fresh = edges.where("sure and not sought").join(
            beliefs.where(F.col("belief") >= CONFIDENCE).select("kind", "who"), "who") \
            .groupBy("kind", "pattern").agg(F.sum("n").alias("support")).where(F.col("support") >= LEAST_SEEDS)
        fresh = stage_table(fresh.select("kind", "pattern", F.lit(0).cast("long").alias("n_seeds"), "support"), "pii-fresh")
        if fresh.isEmpty():
            break
        induced = induced.unionByName(fresh)
    return scored.select("kind", "pattern", "confidence", F.col("support").alias("n_seeds"))


def confident_patterns(scored: DataFrame, confidence: float = CONFIDENCE) -> dict[str, tuple[str, float]] | DataFrame:
    """Patterns to extract with: at least ``confidence`` and LEAST_SEEDS seeds,
    whatever else the corpus holds. Up to BROADCAST_ROWS of them are a dict to
    ship to the tasks; more stay a table that texts are joined with."""
    kept = scored.where((F.col("confidence") >= confidence) & (F.col("n_seeds") >= LEAST_SEEDS)) \
        .select("pattern", "kind", "confidence")
    if kept.count() > BROADCAST_ROWS:
        return kept
    return _known(kept.collect())


def _known(rows) -> dict[str, tuple[str, float]]:
    rows = sorted(rows, key=lambda r: (r["confidence"], r["pattern"], r["kind"]))
    return {r["pattern"]: (r["kind"], r["confidence"]) for r in rows}


def fit_pii(docs: DataFrame) -> dict[str, tuple[str, float]] | DataFrame:
    """Bootstrap over all rows of ``docs`` (column text)."""
    return confident_patterns(stage_table(score_patterns(docs.select("text")), "pii-scored"))


def _met(text: str):
    return (sorted({p for a, b in candidates(text, seeds(text)) for p in asked(text, a, b)}),)


def _with_known(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(row, in): each row of ``docs`` as a struct, and its text with those of the
    patterns that it meets. Patterns are met per distinct text, so copies are
    joined once."""
    key = F.sha2(F.col("text"), 256)
    met = docs.where("text is not null").select(key.alias("key"), F.explode(
        per_text(lambda: _met, "p array<string>")(F.col("text"))["p"]).alias("pattern")).distinct()
    found = met.join(known, "pattern").groupBy("key").agg(
        F.collect_list(F.struct("pattern", "kind", "confidence")).alias("known"))
    rows = docs.select(key.alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(found, "key", "left").select(
        "row", F.struct(F.col("row.text").alias("text"), F.col("known")).alias("in"))


def all_spans(text: str, known: dict[str, tuple[str, float]],
              near: Near | None = None, base: list[tuple[str, int, int]] | None = None) -> list[tuple[str, int, int]]:
    """Base spans, then secrets and whatever the confident patterns find; found
    spans never overlap a base span or each other: the surer one counts, then
    the longer one."""
    out = seeds(text) if base is None else _with_secrets(text, base)
    if known:
        found = []
        for a, b in candidates(text, out, Near(known) if near is None else near):
            best = max((known[p][::-1] for p in asked(text, a, b) if p in known), default=None)
            if best:
                found.append((best[0], b - a, -a, best[1]))
        taken: list[tuple[str, int, int]] = []
        for _, size, at, kind in sorted(found, reverse=True):
            if _free(taken, -at, size - at):
                taken.append((kind, -at, size - at))
        out += taken
    return sorted(out, key=lambda s: (KINDS.index(s[0]), s[1]))


def _joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


RESULT = ("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def _scan(t: str, known, near=None):
    base = base_spans(t)
    counts = [sum(k == kind for k, _, _ in base) for kind in BASE_KINDS]
    return (*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(all_spans(t, known, near, base)))


def _masked(t: str, known, near=None):
    out, at = [], 0
    for kind, a, b in sorted(all_spans(t, known, near), key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [t[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return ("".join([*out, t[at:]]),)


def _of_row(work):
    return lambda row: work(row["text"] or "", _known(row["known"] or []))


def pii_spans(text: Column, known: dict[str, tuple[str, float]]) -> Column:
    """Struct of base counts, digest of the base spans and all spans.

    Null and empty texts have no span. Texts are read whole; equal texts give
    equal spans. ``known`` comes from :func:`fit_pii`.
    """
    return per_text(lambda: (lambda near: lambda t: _scan(t, known, near))(Near(known)), RESULT)(text)


def redact(text: Column, known: dict[str, tuple[str, float]]) -> Column:
    """The text with every span replaced by its kind in angle brackets; spans
    that overlap become one. A null text stays null."""
    new = per_text(lambda: (lambda near: lambda t: _masked(t, known, near))(Near(known)), "text string")(text)["text"]
    return F.when(text.isNotNull(), new)


def with_spans(docs: DataFrame, known: dict[str, tuple[str, float]] | DataFrame) -> DataFrame:
    """``docs`` with ``_r``, the struct of :func:`pii_spans`, for few or many patterns."""
    if isinstance(known, dict):
        return docs.withColumn("_r", pii_spans(F.col("text"), known))
    made = per_text(lambda: _of_row(_scan), RESULT)(F.col("in"))
    return _with_known(docs, known).select("row", made.alias("_r")).select("row.*", "_r")


def redacted(docs: DataFrame, known: dict[str, tuple[str, float]] | DataFrame) -> DataFrame:
    """``docs`` with text as :func:`redact` gives it, for few or many patterns.

    Null texts stay null, empty and long ones are read whole, repeated rows stay
    as many; all other columns, whatever their names, are kept as they are. An
    empty table gives an empty one.
    """
    if isinstance(known, dict):
        return docs.withColumn("text", redact(F.col("text"), known))
    new = per_text(lambda: _of_row(_masked), "text string")(F.col("in"))["text"]
    rows = _with_known(docs, known).select("row", F.when(F.col("in.text").isNotNull(), new).alias("new"))
    return rows.select(*[F.col("new").alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c)
                         for c in docs.columns])
