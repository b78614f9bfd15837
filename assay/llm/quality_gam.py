"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting of shallow trees fills one lookup table for each feature and each chosen pair;
a score is the sum of the tables' entries at a text's bins.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.common import crc_mod, identified, map_batches, space_words, text_bytes, values

#: Labelled rows that a model is fitted on at most; chosen by a hash of the id.
SAMPLE_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 8
ROUNDS, PAIR_ROUNDS, RATE, RIDGE = 120, 60, 0.1, 1.0
THRESHOLD = 0.3

FEATURES = (
    "log_words", "word_length", "long_words", "symbols", "marks", "dividers", "upper", "digits",
    "other_bytes", "stops", "commas", "log_lines", "words_a_line", "lines_without_stop", "repeated_lines",
    "distinct_words", "top_word", "same_again", "repeated_threes", "capital_words",
)


def _kinds(characters: bytes) -> bytes:
    return bytes(c for c in range(256) if c not in characters)


_ONLY = {
    "symbols": _kinds(b"#*$%&|<>"),
    "marks": _kinds(b"!?=~^_{}\\"),
    "upper": _kinds(bytes(range(65, 91))),
    "digits": _kinds(b"0123456789"),
    "other": _kinds(bytes(range(0xC0, 256))),
}


def features(text: bytes | None) -> list[float]:
    """The features of one text, in the order of FEATURES; all 0 for a text without words."""
    words = space_words(text)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    size = sum(map(len, words))

    def share(kind: str) -> float:
        return len(text.translate(None, _ONLY[kind])) / size

    lines = [line.rstrip() for line in text.split(b"\n") if line.strip()]
    counts = Counter(words)
    threes = Counter(zip(words, words[1:], words[2:]))
    return [
        float(np.log1p(n)), size / n, sum(len(w) > 14 for w in words) / n, share("symbols"), share("marks"),
        text.count(b" | ") / n, share("upper"), share("digits"), share("other"),
        text.count(b".") / n, text.count(b",") / n, float(np.log1p(len(lines))), n / len(lines),
        sum(not line.endswith((b".", b"!", b"?", b'"', b":")) for line in lines) / len(lines),
        1 - len(set(lines)) / len(lines), len(counts) / n, max(counts.values()) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        1 - len(threes) / max(1, n - 2), sum(w[:1].isupper() for w in words) / n,
    ]


class Model(NamedTuple):
    base: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pair_cuts: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]


def _bins(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(cuts)]) if len(x) else np.zeros((len(cuts), 0), dtype=np.int64)


def score(x: np.ndarray, model: Model) -> np.ndarray:
    """Probabilities: table entries at the bins, added up."""
    total = np.full(len(x), model.base)
    for b, table in zip(_bins(x, model.cuts), model.tables):
        total += table[b]
    coarse = _bins(x, model.pair_cuts)
    for (i, j), table in zip(model.pairs, model.pair_tables):
        total += table[coarse[i], coarse[j]]
    return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(x: np.ndarray, bins: int) -> list[np.ndarray]:
    points = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(column, points)) for column in x.T]


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a histogram; no gain if nothing can be cut."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = gl**2 / (hl + RIDGE) + (g.sum() - gl) ** 2 / (h.sum() - hl + RIDGE) - g.sum() ** 2 / (h.sum() + RIDGE)
    at = int(gain.argmax())
    return float(gain[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf values over the bins of a tree of depth two."""
    out = np.zeros(len(g))
    gain, at = _best_cut(g, h)
    for part in ((slice(0, at), slice(at, len(g))) if gain > 0 else (slice(0, len(g)),)):
        inner, cut = _best_cut(g[part], h[part])
        start, end = part.start, part.stop
        for leaf in ((slice(start, start + cut), slice(start + cut, end)) if inner > 0 else (part,)):
            out[leaf] = g[leaf].sum() / (h[leaf].sum() + RIDGE)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best cut across both axes of a 2-d histogram."""
    gc, hc = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    ga, ha = gc[:-1, :-1], hc[:-1, :-1]
    gb, hb = gc[:-1, -1:] - ga, hc[:-1, -1:] - ha
    gd, hd = gc[-1:, :-1] - ga, hc[-1:, :-1] - ha
    ge, he = gc[-1, -1] - ga - gb - gd, hc[-1, -1] - ha - hb - hd
    if not ga.size:
        return 0.0, np.zeros_like(g)
    parts = [(ga, ha), (gb, hb), (gd, hd), (ge, he)]
    gain = sum(x**2 / (y + RIDGE) for x, y in parts)
    r, c = np.unravel_index(int(gain.argmax()), gain.shape)
    values_ = [x[r, c] / (y[r, c] + RIDGE) for x, y in parts]
    out = np.empty_like(g)
    out[: r + 1, : c + 1], out[: r + 1, c + 1 :], out[r + 1 :, : c + 1], out[r + 1 :, c + 1 :] = values_
    return float(gain[r, c] - gc[-1, -1] ** 2 / (hc[-1, -1] + RIDGE)), out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Boost every feature's table in turn, round after round, then the tables of the pairs
    that promise most."""
    rate = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
    base = float(np.log(rate / (1 - rate)))
    d = len(FEATURES)
    if len(y) < 2 or y.min() == y.max():
        none = [np.zeros(0)] * d
        return Model(base, none, [np.zeros(1)] * d, none, [], [])
    cuts, pair_cuts = _cuts(x, BINS), _cuts(x, PAIR_BINS)
    bins, coarse = _bins(x, cuts), _bins(x, pair_cuts)
    tables = [np.zeros(len(c) + 1) for c in cuts]
    total = np.full(len(y), base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(d):
            g, h = slopes()
            n = len(tables[j])
            step = RATE * _tree(np.bincount(bins[j], g, n), np.bincount(bins[j], h, n))
            tables[j] += step
            total += step[bins[j]]

    def histograms(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        shape = len(pair_cuts[i]) + 1, len(pair_cuts[j]) + 1
        cell = coarse[i] * shape[1] + coarse[j]
        return tuple(np.bincount(cell, s, shape[0] * shape[1]).reshape(shape) for s in slopes())

    gains = sorted(((_quadrants(*histograms(i, j))[0], i, j) for i, j in combinations(range(d), 2)), key=lambda t: (-t[0], t[1:]))
    pairs = [(i, j) for gain, i, j in gains[:PAIRS] if gain > 0]
    pair_tables = [np.zeros((len(pair_cuts[i]) + 1, len(pair_cuts[j]) + 1)) for i, j in pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(pairs, pair_tables):
            step = RATE * _quadrants(*histograms(i, j))[1]
            table += step
            total += step[coarse[i], coarse[j]]
    return Model(base, cuts, tables, pair_cuts, pairs, pair_tables)


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from training."""
    return crc_mod(id_col, 5) == 0


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, label_col: str = "quality") -> Model:
    """Fit a model on at most sample_rows labelled documents that aren't held out.

    Of several labels of an id the larger counts; null ids and labels are left out. Without
    labels, or with one kind only, all scores are that kind's rate.
    """
    known = labels.select(F.col("doc_id").alias("id"), F.col(label_col).cast("double").alias("y")).where("id IS NOT NULL AND y IS NOT NULL")
    known = known.where(~held_out("id")).groupBy("id").agg(F.max("y").alias("y"))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    frame = identified(docs, "doc_id", "text")
    chosen = frame.join(F.broadcast(sample), frame.doc_id == sample.id).select("id", "text", "y")

    def per_batch(batch):
        return {"x": [features(t) for t in text_bytes(batch)], "y": values(batch, "y")}

    # One row an id, so no more than the sample: of several texts of an id the largest counts.
    once = chosen.groupBy("id").agg(F.max("text").alias("text"), F.max("y").alias("y")).select("text", "y")
    rows = map_batches(once, per_batch, "x array<double>, y double").toPandas()
    x = np.array(rows["x"].tolist(), dtype=np.float64).reshape(-1, len(FEATURES))
    order = np.lexsort(x.T) if len(x) else []
    return fit(x[order], rows["y"].to_numpy(dtype=np.float64)[order])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, score, predicted.

    Null and empty texts have all features 0 and are scored like the rest. Texts are read
    whole; rows with a null id and repeated rows each give a row; an empty table gives an empty
    result; other columns are ignored.
    """
    # Broadcasts pickle classes by name, which executors don't have: send plain tuples.
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def per_batch(batch):
        x = np.array([features(t) for t in text_bytes(batch)], dtype=np.float64).reshape(-1, len(FEATURES))
        found = score(x, Model(*sent.value))
        return {"doc_id": values(batch, "doc_id"), "score": found, "predicted": (found >= THRESHOLD).astype(np.int32)}

    frame = identified(docs, id_col, text_col)
    kind = frame.schema["doc_id"].dataType.simpleString()
    return map_batches(frame, per_batch, f"doc_id {kind}, score double, predicted int")
