"""Quality classifier: a sparse ensemble of rules.

Statistics of every whole text are Spark columns. On a bounded sample of labelled rows (about
``TRAIN_ROWS``, chosen by a hash of the id) small boosted trees are grown; every path from a root
is a rule, a conjunction of comparisons of statistics. A logistic regression with an L1
penalty keeps few of them, and the kept rules are compiled into one Spark column expression.

Defined cases: a null text counts as empty, and an empty text has a score like any other; rows without
a label are not learned; without two classes the score is 0.5; a repeated label row counts again; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import SPACES, row_keyed
from tillstar.session import materialize

TRAIN_ROWS, TREES, DEPTH, CUTS, MIN_SUPPORT, PENALTY = 20_000, 30, 3, 32, 0.005, 0.002

#: Characters counted per character of the text.
_SIGNS = {"digits": "[0-9]", "upper": r"\p{Lu}", "symbols": "[#*$%&<>]", "bars": r"\|", "shouts": "[!?]", "stops": r"\.", "commas": ",", "at": "[@=_/]"}


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, th`` and the statistics of every whole text, written."""
    text = F.coalesce("text", F.lit(""))
    rows = row_keyed(docs).select("doc_id", "th", text.alias("t"), F.split(F.btrim(text, F.lit(SPACES)), r"[\x20\x09-\x0D]+").alias("w"))
    rows = rows.withColumn("lines", F.split("t", "\n"))
    chars, words, lines = F.char_length("t"), F.size("w"), F.size("lines")
    per_char = F.greatest(chars, F.lit(1)).cast("double")
    letters = F.char_length(F.array_join("w", ""))
    stats = {
        "chars": chars.cast("double"),
        "words": words.cast("double"),
        "word_length": letters / words,
        "words_apart": F.size(F.array_distinct("w")) / words,
        "line_length": chars / lines,
        "lines_apart": F.size(F.array_distinct("lines")) / lines,
        "lines": lines.cast("double"),
        **{name: F.regexp_count("t", F.lit(pattern)) / per_char for name, pattern in _SIGNS.items()},
    }
    return materialize(rows.select("doc_id", "th", *(c.cast("double").alias(n) for n, c in stats.items())), "statistics")


def names(stats: DataFrame) -> list[str]:
    return [c for c in stats.columns if c not in ("doc_id", "th")]


#: A rule: comparisons (statistic's number, whether above, threshold), all of which must hold.
Rule = tuple[tuple[int, bool, float], ...]


@dataclass
class Ensemble:
    features: list[str]
    rules: list[Rule]
    weights: list[float]
    bias: float

    def column(self) -> Column:
        """The probability of label 1."""
        total = F.lit(self.bias)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            holds = reduce(lambda a, b: a & b, (F.col(self.features[k]) > cut if above else F.col(self.features[k]) <= cut for k, above, cut in rule))
            total = total + F.when(holds, weight).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The same over rows of a matrix."""
        return 1 / (1 + np.exp(-(self.bias + holding(self.rules, x) @ np.array(self.weights).reshape(-1))))


def holding(rules: list[Rule], x: np.ndarray) -> np.ndarray:
    out = np.ones((len(x), len(rules)), bool)
    for j, rule in enumerate(rules):
        for k, above, cut in rule:
            out[:, j] &= (x[:, k] > cut) == above
    return out


def _tree(x: np.ndarray, codes: np.ndarray, cuts: list[np.ndarray], gradient: np.ndarray, weight: np.ndarray, depth: int, least: int):
    """Rules of all nodes of a regression tree, and its value for each row."""
    rules, value = [], np.zeros(len(x))
    todo = [((), np.arange(len(x)))]
    while todo:
        path, rows = todo.pop()
        g, h = gradient[rows], weight[rows]
        value[rows] = g.sum() / (h.sum() + 1.0)
        if path:
            rules.append(path)
        if len(path) == depth or len(rows) < 2 * least:
            continue
        best = (1e-6, -1, 0)
        for k in range(x.shape[1]):
            n = len(cuts[k]) + 1
            gs, hs = np.cumsum(np.bincount(codes[rows, k], g, n))[:-1], np.cumsum(np.bincount(codes[rows, k], h, n))[:-1]
            ns = np.cumsum(np.bincount(codes[rows, k], minlength=n))[:-1]
            gain = gs**2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - g.sum() ** 2 / (h.sum() + 1)
            gain[(ns < least) | (len(rows) - ns < least)] = -1
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), k, int(gain.argmax()))
        _, k, at = best
        if k >= 0:
            below = codes[rows, k] <= at
            cut = float(cuts[k][at])
            todo += [(path + ((k, False, cut),), rows[below]), (path + ((k, True, cut),), rows[~below])]
    return rules, value


def _lasso(z: np.ndarray, y: np.ndarray, penalty: float, steps: int = 600) -> tuple[np.ndarray, float]:
    """Logistic regression with an L1 penalty by accelerated proximal gradient steps."""
    a = np.column_stack([z, np.ones(len(z))])
    size = 4 * len(a) / max(np.linalg.norm(a, 2) ** 2, 1e-9)
    w = v = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(steps):
        g = a.T @ (1 / (1 + np.exp(-(a @ v))) - y) / len(a)
        new = v - size * g
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - size * penalty, 0)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        v, w = new + (before - 1) / t * (new - w), new
    return w[:-1], float(w[-1])


def train(x: np.ndarray, y: np.ndarray, features: list[str], seed: int = 11) -> Ensemble:
    if len(y) < 2 or y.min() == y.max():
        return Ensemble(features, [], [], 0.0)
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, CUTS + 1)[1:-1])) for k in range(x.shape[1])]
    codes = np.column_stack([np.searchsorted(c, x[:, k], "left") for k, c in enumerate(cuts)])
    least = max(2, int(MIN_SUPPORT * len(y)))
    margin, found = np.zeros(len(y)), {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        some = rng.random(len(y)) < 0.5
        used = np.flatnonzero(some) if some.sum() > 4 * least else np.arange(len(y))
        rules, _ = _tree(x[used], codes[used], cuts, (y - p)[used], (p * (1 - p))[used], DEPTH, least)
        leaves = [r for r in rules if not any(q[: len(r)] == r and len(q) > len(r) for q in rules)]
        for rule, mask in zip(leaves, holding(leaves, x).T, strict=True):
            margin[mask] += 0.3 * (y - p)[mask].sum() / ((p * (1 - p))[mask].sum() + 1.0)
        found.update(dict.fromkeys(rules))
    rules = list(found)
    z = holding(rules, x)
    _, first = np.unique(z, axis=1, return_index=True)  # rules that hold for the same rows are one
    rules = [rules[j] for j in sorted(first) if least <= z[:, j].sum() <= len(y) - least]
    if not rules:
        return Ensemble(features, [], [], 0.0)
    weights, bias = _lasso(holding(rules, x).astype(float), y.astype(float), PENALTY)
    kept = np.flatnonzero(np.abs(weights) > 1e-6)
    return Ensemble(features, [rules[j] for j in kept], [float(weights[j]) for j in kept], bias)


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS) -> Ensemble:
    """Train on a bounded sample of ``labels`` (``doc_id`` and a 0/1 column)."""
    known = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("y")).where("y IS NOT NULL AND doc_id IS NOT NULL")
    place = F.pmod(F.xxhash64("doc_id", F.lit("rules")), F.lit(1 << 30)) / float(1 << 30)
    sample = known.where(place < rows / max(known.count(), 1))
    features = names(stats)
    table = sample.join(stats, "doc_id").select("doc_id", "th", "y", *features).toArrow().to_pandas()
    table = table.sort_values(["doc_id", "th", "y"])
    return train(table[features].to_numpy(float), table["y"].to_numpy(), features)


def score(stats: DataFrame, model: Ensemble) -> DataFrame:
    """``doc_id, th, score, predicted`` of every row."""
    scored = stats.select("doc_id", "th", model.column().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
