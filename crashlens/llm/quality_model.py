"""Quality classifier: a generalised additive model with pairwise interactions.

Text statistics are cut into bins. Boosting visits the features in turn and
adds a small tree over one feature's bins (three leaves) to that feature's
lookup table; then the pairs that explain most of what is left get tables over
two features. A score is a sum of table entries, looked up for a whole batch.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crashlens.llm.common import per_texts

NAMES = ["words", "word_bytes", "upper", "digits", "blanks", "stops", "exclaims", "symbols",
         "other_marks", "high_bytes", "entropy", "distinct_words", "top_word", "repeated_windows",
         "line_words", "dup_lines", "long_words"]
BINS = 32
PAIR_BINS = 8
ROUNDS = 120
PAIRS = 6
PAIR_ROUNDS = 40
RATE = 0.15
RIDGE = 2.0
#: Bytes of a text that are split into words at once.
PART = 1 << 20


def _share(hist: np.ndarray, marks: bytes, total: float) -> float:
    return float(hist[list(marks)].sum()) / total


def statistics(text: str) -> np.ndarray:
    """Statistics of a whole text (order of NAMES); zeros for an empty one."""
    data = text.encode()
    if not data:
        return np.zeros(len(NAMES))
    hist = np.zeros(256, np.int64)
    hashes, sizes, at = [], [], 0
    while at < len(data):
        end = len(data) if len(data) - at <= PART else data.find(b" ", at + PART)
        end = len(data) if end < 0 else end
        hist += np.bincount(np.frombuffer(data[at:end], np.uint8), minlength=256)
        words = data[at:end].split()
        hashes.append(np.fromiter(map(hash, words), np.int64, len(words)))
        sizes.append(np.fromiter(map(len, words), np.int64, len(words)))
        at = end
    h, size = np.concatenate(hashes).view(np.uint64), np.concatenate(sizes)
    n, total = len(h), float(len(data))
    p = hist[hist > 0] / total
    _, counts = np.unique(h, return_counts=True)
    repeated = 0.0
    if n >= 4:
        w = (h[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ h[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) ^ h[2:]
        _, back, many = np.unique(w, return_inverse=True, return_counts=True)
        twice = np.flatnonzero(many[back] > 1)
        cover = np.zeros(n, bool)
        for k in range(3):
            cover[twice + k] = True
        repeated = float(cover.sum())
    lines = [x for x in data.split(b"\n") if x.strip()]
    marks = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())
    plain = b".,;:!?'\"-#*$%&|<>"
    return np.array([
        np.log1p(n), size.sum() / max(n, 1), hist[65:91].sum() / total, hist[48:58].sum() / total,
        _share(hist, b" \t\n\r\x0b\x0c", total), _share(hist, b".,;:", total), _share(hist, b"!?", total),
        _share(hist, b"#*$%&|<>", total), _share(hist, bytes(set(marks) - set(plain)), total),
        hist[128:].sum() / total, -float((p * np.log(p)).sum()), len(counts) / max(n, 1),
        (counts.max() if n else 0) / max(n, 20), repeated / max(n, 20),
        np.log1p(n / max(len(lines), 1)), (len(lines) - len(set(lines))) / (len(lines) + 3.0),
        float((size > 14).sum()) / max(n, 1)], float)


def _cut(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _leaf(g, h):
    return g / (h + RIDGE)


def _gain(g, h):
    return g * g / (h + RIDGE)


def _small_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values of a tree with three leaves over ordered bins."""
    def split(a: int, b: int):
        if b - a < 2:
            return 0.0, None
        cg, ch = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
        tg, th = g[a:b].sum(), h[a:b].sum()
        gain = _gain(cg, ch) + _gain(tg - cg, th - ch) - _gain(tg, th)
        k = int(gain.argmax())
        return float(gain[k]), a + k + 1

    _, first = split(0, len(g))
    edges = [0, len(g)] if first is None else [0, first, len(g)]
    more = max((split(a, b) for a, b in zip(edges, edges[1:], strict=False)), key=lambda x: x[0])
    if more[1] is not None and more[0] > 0:
        edges = sorted([*edges, more[1]])
    out = np.zeros(len(g))
    for a, b in zip(edges, edges[1:], strict=False):
        out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best cut into four quadrants of a two-way table."""
    G, H = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    parts_g = (G[:-1, :-1], G[:-1, -1:] - G[:-1, :-1], G[-1:, :-1] - G[:-1, :-1],
               G[-1, -1] - G[:-1, -1:] - G[-1:, :-1] + G[:-1, :-1])
    parts_h = (H[:-1, :-1], H[:-1, -1:] - H[:-1, :-1], H[-1:, :-1] - H[:-1, :-1],
               H[-1, -1] - H[:-1, -1:] - H[-1:, :-1] + H[:-1, :-1])
    if not parts_g[0].size:
        return 0.0, np.zeros_like(g)
    gain = sum(_gain(a, b) for a, b in zip(parts_g, parts_h, strict=True))
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    out = np.zeros_like(g)
    for a, b, rows, cols in zip(parts_g, parts_h, (slice(0, i + 1),) * 2 + (slice(i + 1, None),) * 2,
                                (slice(0, j + 1), slice(j + 1, None)) * 2, strict=True):
        out[rows, cols] = _leaf(a[i, j], b[i, j])
    return float(gain[i, j]), out


class AdditiveModel:
    """Cuts, one table a feature, tables of pairs, and the intercept."""

    def fit(self, x: np.ndarray, y: np.ndarray) -> AdditiveModel:
        """Fit on a bounded sample. Without both classes only the intercept is set."""
        f = x.shape[1]
        rate = (y.sum() + 1) / (len(y) + 2)
        self.base = float(np.log(rate / (1 - rate)))
        self.cuts = [_cut(x[:, k], BINS) if len(x) else np.zeros(0) for k in range(f)]
        self.pair_cuts = [_cut(x[:, k], PAIR_BINS) if len(x) else np.zeros(0) for k in range(f)]
        self.tables = [np.zeros(len(c) + 1) for c in self.cuts]
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        if len(y) == 0 or y.min() == y.max():
            return self
        z = np.full(len(y), self.base)
        bins = [np.searchsorted(c, x[:, k], side="right") for k, c in enumerate(self.cuts)]
        small = [np.searchsorted(c, x[:, k], side="right") for k, c in enumerate(self.pair_cuts)]

        def slopes():
            p = 1 / (1 + np.exp(-z))
            return y - p, p * (1 - p)

        for _ in range(ROUNDS):
            for k in range(f):
                g, h = slopes()
                m = len(self.tables[k])
                step = RATE * _small_tree(np.bincount(bins[k], g, m), np.bincount(bins[k], h, m))
                self.tables[k] += step
                z += step[bins[k]]

        def sums(i: int, j: int):
            shape = (len(self.pair_cuts[i]) + 1, len(self.pair_cuts[j]) + 1)
            g, h = slopes()
            flat = small[i] * shape[1] + small[j]
            size = shape[0] * shape[1]
            return np.bincount(flat, g, size).reshape(shape), np.bincount(flat, h, size).reshape(shape), flat

        ranked = sorted(((_pair_tree(*sums(i, j)[:2])[0], i, j) for i in range(f) for j in range(i)),
                        reverse=True)[:PAIRS]
        self.pairs = [(i, j, np.zeros_like(sums(i, j)[0])) for _, i, j in ranked]
        for _ in range(PAIR_ROUNDS):
            for i, j, held in self.pairs:
                g, h, flat = sums(i, j)
                step = RATE * _pair_tree(g, h)[1]
                held += step
                z += step.ravel()[flat]
        return self

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Scores of many rows at once: table entries added up."""
        z = np.full(len(x), self.base)
        for k, (cut, held) in enumerate(zip(self.cuts, self.tables, strict=True)):
            z += held[np.searchsorted(cut, x[:, k], side="right")]
        for i, j, held in self.pairs:
            z += held[np.searchsorted(self.pair_cuts[i], x[:, i], side="right"),
                      np.searchsorted(self.pair_cuts[j], x[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def text_features(text: Column) -> Column:
    return per_texts(lambda: lambda texts: ((statistics(t).tolist(),) for t in texts),
                     "x array<double>")(text)


def fit_quality(train: DataFrame) -> AdditiveModel:
    """Model from rows with text and label (a bounded sample; only its
    statistics come to the driver)."""
    rows = train.select("label", text_features(F.col("text")).alias("_f")).select("label", "_f.x").collect()
    x = np.array([r["x"] for r in rows], float).reshape(len(rows), len(NAMES))
    return AdditiveModel().fit(x, np.array([r["label"] for r in rows], float))


def quality_score(text: Column, model: AdditiveModel) -> Column:
    """Score from 0 to 1 of a text column. Null and empty texts have all
    statistics 0 and are scored from those; equal texts get equal scores."""
    def score(texts: list[str]):
        if texts:
            yield from ((float(s),) for s in model.scores(np.array([statistics(t) for t in texts])))

    return per_texts(lambda: score, "score double")(text)["score"]
