"""Quality classifier: a sparse rule ensemble compiled into Column expressions.

Boosted trees are fitted to statistics of labelled texts; every path of a tree becomes a
conjunctive rule ("few distinct words and many capitals"). A logistic regression with an
L1 penalty over all rules and the statistics keeps a few of them. The model is then a sum
of ``CASE`` terms over the statistics, so scoring is a projection of the scan: no shuffle,
no Python.

Only the fit is bounded: it takes the ``rows`` labelled documents with the smallest hash
of the id outside the held-out fold (``FitBounds``). Labels, language, source and id never
enter a score.

Defined results: null counts as the empty text; null labels and ids are not learned from;
a document listed twice in the labels counts twice; with labels of one class only, or
none, every score is the smoothed share of label 1; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import learned, prepared, text_of, words_of
from cohortloom.llm.trees import boost

HELD_OUT_FOLD = 0
THRESHOLD = 0.3
FEATURES = [
    "words", "word_length", "distinct_words", "symbols", "capitals", "digits", "exclamations", "bars",
    "stops", "line_words", "distinct_lines", "long_words",
]


@dataclass(frozen=True)
class FitBounds:
    """Size of the fitted sample and of the ensemble."""

    rows: int = 20_000
    trees: int = 24
    depth: int = 3
    bins: int = 32
    penalty: float = 1e-3
    steps: int = 400


def with_features(docs: DataFrame, text: str, carry: Sequence[str]) -> DataFrame:
    """``carry`` and the statistics ``FEATURES`` (doubles) of every whole text."""
    kept = [F.col(f"`{c}`") for c in carry]
    parts = docs.select(*kept, text_of(f"`{text}`").alias("__t")).select(
        *kept, "__t", words_of(F.col("__t")).alias("__w"),
        F.filter(F.split("__t", "\n"), lambda x: F.length(x) > 0).alias("__l"),
    )
    parts = parts.select(
        "*", F.size("__w").alias("__n"), F.length("__t").alias("__c"), F.size("__l").alias("__k"),
    )
    words = F.greatest(F.col("__n"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("__c"), F.lit(1)).cast("double")
    lines = F.greatest(F.col("__k"), F.lit(1)).cast("double")
    outside = lambda kind: F.col("__c") - F.length(F.regexp_replace("__t", kind, ""))
    values = {
        "words": F.log1p("__n"),
        "word_length": F.length(F.array_join("__w", "")) / words,
        "distinct_words": F.size(F.array_distinct("__w")) / words,
        "symbols": outside(r"[#*$%&<>@=_{}\[\]]+") / words,
        "capitals": outside(r"[A-Z]+") / chars,
        "digits": outside(r"[0-9]+") / chars,
        "exclamations": outside(r"[!?]+") / words,
        "bars": outside(r"\|+") / words,
        "stops": outside(r"[.,;:]+") / words,
        "line_words": F.col("__n") / lines,
        "distinct_lines": F.size(F.array_distinct("__l")) / lines,
        "long_words": F.size(F.filter("__w", lambda w: F.length(w) > 25)) / words,
    }
    return parts.select(*kept, *(values[f].cast("double").alias(f) for f in FEATURES))


@dataclass(frozen=True)
class RuleModel:
    """Log odds = bias + weight of every rule that holds + weights of clipped statistics."""

    bias: float
    rules: list[tuple[float, tuple[tuple[int, float, bool], ...]]]
    linear: list[tuple[float, int, float, float]]

    def score(self) -> Column:
        total = F.lit(self.bias)
        for weight, path in self.rules:
            holds = F.lit(True)
            for feature, at, is_low in path:
                column = F.col(FEATURES[feature])
                holds = holds & ((column <= at) if is_low else (column > at))
            total = total + F.when(holds, weight).otherwise(0.0)
        for weight, feature, low, high in self.linear:
            total = total + F.lit(weight) * F.least(F.greatest(F.col(FEATURES[feature]), F.lit(low)), F.lit(high))
        return 1 / (1 + F.exp(-total))


def _holds(values: np.ndarray, path: tuple) -> np.ndarray:
    held = np.ones(len(values), bool)
    for feature, at, is_low in path:
        held &= (values[:, feature] <= at) == is_low
    return held


def fit_rules(values: np.ndarray, labels: np.ndarray, bounds: FitBounds = FitBounds()) -> RuleModel:
    """Rules from boosted trees, weights from lasso logistic regression (accelerated proximal steps)."""
    n = len(labels)
    share = (labels.sum() + 1) / (n + 2)
    if n == 0 or labels.min() == labels.max():
        return RuleModel(float(np.log(share / (1 - share))), [], [])
    edges = [np.unique(np.quantile(values[:, f], np.linspace(0, 1, bounds.bins + 1)[1:-1])) for f in range(values.shape[1])]
    bins = np.stack([np.searchsorted(e, values[:, f], "left") for f, e in enumerate(edges)], 1)
    _, trees, _ = boost(bins, labels, np.ones(n), bounds.trees, bounds.depth, least=max(2.0, n / 2000))
    paths = {}
    for tree in trees:
        for path in tree.paths():
            real = tuple(sorted((f, float(edges[f][at]), low) for f, at, low in path))
            paths.setdefault(_holds(values, real).tobytes(), real)  # equal columns: one rule
    rules = list(paths.values())
    low, high = np.quantile(values, 0.025, 0), np.quantile(values, 0.975, 0)
    usable = np.flatnonzero(high > low)
    clipped = np.clip(values, low, high)[:, usable]
    table = np.column_stack([*(_holds(values, r).astype(float) for r in rules), clipped])
    mean, scale = table.mean(0), np.maximum(table.std(0), 1e-9)
    table = (table - mean) / scale
    weights, bias = np.zeros(table.shape[1]), float(np.log(share / (1 - share)))
    ahead, ahead_bias, momentum = weights.copy(), bias, 1.0
    step = 4.0 / (np.linalg.norm(table, 2) ** 2 / n + 1)
    for _ in range(bounds.steps):
        error = 1 / (1 + np.exp(-(table @ ahead + ahead_bias))) - labels
        moved = ahead - step * (table.T @ error) / n
        moved = np.sign(moved) * np.maximum(np.abs(moved) - step * bounds.penalty, 0)
        moved_bias = ahead_bias - step * error.mean()
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = moved + (momentum - 1) / following * (moved - weights)
        ahead_bias = moved_bias + (momentum - 1) / following * (moved_bias - bias)
        weights, bias, momentum = moved, moved_bias, following
    real = weights / scale
    split = len(rules)
    return RuleModel(
        float(bias - (real * mean).sum()),
        [(float(w), r) for w, r in zip(real[:split], rules) if w],
        [(float(w), int(f), float(low[f]), float(high[f])) for w, f in zip(real[split:], usable) if w],
    )


def train(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality",
    bounds: FitBounds = FitBounds(),
) -> RuleModel:
    """Fit to the labelled documents outside the held-out fold, at most ``bounds.rows``."""
    sample = (
        labels.select(F.col(f"`{doc_id}`").alias("__id"), F.col(f"`{label}`").cast("double").alias("__y"))
        .filter(F.col("__id").isNotNull() & F.col("__y").isin(0.0, 1.0) & learned(F.col("__id"), HELD_OUT_FOLD))
        .withColumn("__h", F.xxhash64("__id")).orderBy("__h", "__id", "__y").limit(bounds.rows)
    )
    texts = docs.select(F.col(f"`{doc_id}`").alias("__id"), F.col(f"`{text}`").alias("__text"))
    joined = texts.join(F.broadcast(sample), "__id")  # at most bounds.rows ids
    table = with_features(joined, "__text", ["__h", "__y"]).orderBy("__h", "__y", *FEATURES).limit(bounds.rows)
    rows = table.select("__y", *FEATURES).toPandas().to_numpy(dtype=float)
    return fit_rules(rows[:, 1:], rows[:, 0], bounds)


def classify(
    docs: DataFrame, model: RuleModel, text: str = "text", carry: Sequence[str] = ("doc_id",),
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``carry``, ``score`` and ``predicted`` for every document."""
    if clash := {c.lower() for c in carry} & {"score", "predicted", *FEATURES}:
        raise ValueError(f"columns {sorted(clash)} are also computed; rename them or leave them out")
    prepared(docs.sparkSession)
    scored = with_features(docs, text, carry).withColumn("score", model.score())
    return scored.select(
        *(F.col(f"`{c}`") for c in carry), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
