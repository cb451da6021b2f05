"""Quality of documents by a sparse ensemble of rules (Friedman and Popescu, Predictive Learning via Rule
Ensembles, 2008).

Statistics of whole texts are Spark columns. Small trees are boosted on the statistics of a bounded sample of
labelled documents; every path from a root is a rule, a conjunction of bounds; a logistic fit with an L1
penalty keeps few of them. The kept rules are compiled into one Spark expression, so scoring is a projection.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import labelled, shares

HELD_OUT = (5, 0)  # crc32 of the id modulo 5 is 0: never learnt from
MAX_LABELLED = 10_000  # labelled documents per label value that a fit looks at
N_TREES, DEPTH, RATE = 60, 3, 0.3
N_CUTS = 32  # candidate bounds per statistic, at quantiles
PENALTY = 1e-3
THRESHOLD = 0.3


def statistics(text: Column) -> dict[str, Column]:
    """Numbers that describe a whole text; all are 0 for a null or empty one."""
    whole = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(F.translate(whole, "\t\n\x0b\x0c\r", "     "), " "), lambda w: w != "")
    lines = F.filter(F.split(whole, "\n"), lambda w: w != "")
    n_chars, n_words, n_lines = F.length(whole), F.size(words), F.size(lines)

    def share(part: Column, of: Column) -> Column:
        return F.when(of > 0, part.cast("double") / of).otherwise(0.0)

    return {
        "n_words": n_words.cast("double"),
        "word_length": share(n_chars, n_words),
        "distinct_words": share(F.size(F.array_distinct(words)), n_words),
        "distinct_lines": share(F.size(F.array_distinct(lines)), n_lines),
        "line_words": share(n_words, n_lines),
        "short_words": share(F.size(F.filter(words, lambda w: F.length(w) <= 3)), n_words),
        "symbols": share(F.regexp_count(whole, F.lit(r"[^\p{L}\p{N}\s.,;:'\"()!?-]")), n_chars),
        "shouts": share(F.regexp_count(whole, F.lit(r"[!?]")), n_chars),
        "upper": share(F.regexp_count(whole, F.lit(r"\p{Lu}")), n_chars),
        "digits": share(F.regexp_count(whole, F.lit(r"\p{N}")), n_chars),
        "stops": share(F.regexp_count(whole, F.lit(r"[.!?]\s")), n_words),
    }


NAMES = [  # the keys of statistics()
    "n_words", "word_length", "distinct_words", "distinct_lines", "line_words", "short_words",
    "symbols", "shouts", "upper", "digits", "stops",
]


@dataclass(frozen=True)
class Rule:
    """All of `low < statistic <= high`."""

    bounds: tuple[tuple[str, float, float], ...]

    def mask(self, x: dict[str, np.ndarray], n: int) -> np.ndarray:
        hit = np.ones(n, bool)
        for name, low, high in self.bounds:
            hit &= (x[name] > low) & (x[name] <= high)
        return hit

    def column(self, stats: dict[str, Column]) -> Column:
        hit = F.lit(True)
        for name, low, high in self.bounds:
            if low > -np.inf:
                hit = hit & (stats[name] > F.lit(float(low)))
            if high < np.inf:
                hit = hit & (stats[name] <= F.lit(float(high)))
        return hit


@dataclass
class RuleModel:
    """An intercept and weighted rules; `score` is the probability of label 1."""

    intercept: float = 0.0
    rules: list[tuple[Rule, float]] = field(default_factory=list)

    def column(self, stats: dict[str, Column]) -> Column:
        logit = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            logit = logit + F.when(rule.column(stats), F.lit(float(weight))).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def _grow(x: np.ndarray, residual: np.ndarray, curvature: np.ndarray, cuts: list[np.ndarray], depth: int):
    """A tree as nested (feature, cut, left, right), leaves as Newton steps."""
    def leaf(rows):
        return residual[rows].sum() / (curvature[rows].sum() + 1.0)

    def split(rows, left_depth):
        if left_depth == 0 or len(rows) < 20:
            return leaf(rows)
        g, h = residual[rows], curvature[rows]
        total_g, total_h = g.sum(), h.sum()
        best = (1e-6, None, None)
        for f in range(x.shape[1]):
            if not len(cuts[f]):
                continue
            place = np.searchsorted(cuts[f], x[rows, f], side="left")  # x <= cuts[i] for place <= i
            sum_g = np.cumsum(np.bincount(place, g, len(cuts[f]) + 1))[:-1]
            sum_h = np.cumsum(np.bincount(place, h, len(cuts[f]) + 1))[:-1]
            count = np.cumsum(np.bincount(place, minlength=len(cuts[f]) + 1))[:-1]
            gain = (
                sum_g**2 / (sum_h + 1) + (total_g - sum_g) ** 2 / (total_h - sum_h + 1) - total_g**2 / (total_h + 1)
            )
            gain[(count < 5) | (len(rows) - count < 5)] = 0
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (gain[at], f, cuts[f][at])
        _, f, cut = best
        if f is None:
            return leaf(rows)
        low = x[rows, f] <= cut
        return f, cut, split(rows[low], left_depth - 1), split(rows[~low], left_depth - 1)

    return split(np.arange(len(x)), depth)


def _paths(tree, names, bounds=()):
    """The rules of all nodes below the root."""
    if not isinstance(tree, tuple):
        return
    f, cut, low, high = tree
    for side, limits in ((low, (-np.inf, cut)), (high, (cut, np.inf))):
        merged = dict((b[0], b) for b in bounds)
        _, a, b = merged.get(names[f], (names[f], -np.inf, np.inf))
        merged[names[f]] = (names[f], max(a, limits[0]), min(b, limits[1]))
        path = tuple(sorted(merged.values()))
        yield Rule(path)
        yield from _paths(side, names, path)


def _apply(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, cut, low, high = tree
    return np.where(x[:, f] <= cut, _apply(low, x), _apply(high, x))


def _lasso_logistic(masks: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float, steps: int = 1500):
    """Accelerated proximal gradient on the weighted logistic loss; the intercept is not penalised."""
    design = masks.astype(np.float64)
    scale = np.sqrt((weight[:, None] * design).sum(0).clip(1e-9) * (1 - (weight[:, None] * design).sum(0)).clip(1e-9))
    design = design / scale
    rate = 4.0 / (np.linalg.norm(design * np.sqrt(weight)[:, None], 2) ** 2 + 1.0)
    base = float((weight * y).sum())
    b, w = np.log(base / (1 - base)), np.zeros(design.shape[1])
    b_at, w_at, t = b, w.copy(), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(b_at + design @ w_at)))
        error = weight * (p - y)
        b_new = b_at - rate * error.sum()
        w_new = w_at - rate * (design.T @ error)
        w_new = np.sign(w_new) * np.maximum(np.abs(w_new) - rate * penalty, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        b_at, w_at = b_new + (t - 1) / t_new * (b_new - b), w_new + (t - 1) / t_new * (w_new - w)
        done = np.abs(w_new - w).max(initial=0) < 1e-7
        b, w, t = b_new, w_new, t_new
        if done:
            break
    return b, w / scale


def fit_rules(x: np.ndarray, y: np.ndarray, weight: np.ndarray, names: list[str]) -> RuleModel:
    """Rules of boosted trees over the columns of `x`, weighted by a lasso; row weights sum to 1."""
    weight = weight / weight.sum()
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, N_CUTS + 2)[1:-1])) for c in x.T]
    base = float((weight * y).sum())
    logit, found = np.full(len(y), np.log(base / (1 - base))), {}
    rng = np.random.default_rng(7)
    for _ in range(N_TREES):
        p = 1 / (1 + np.exp(-logit))
        part = rng.random(len(y)) < 0.6  # each tree sees other rows, which makes the rules differ
        scale = weight * len(y) * part
        tree = _grow(x, scale * (y - p), scale * p * (1 - p), cuts, DEPTH)
        logit += RATE * _apply(tree, x)
        found |= dict.fromkeys(_paths(tree, names))
    columns = dict(zip(names, x.T))
    rules = {}
    for rule in found:
        mask = rule.mask(columns, len(y))
        if 0 < mask.sum() < len(y):
            rules.setdefault(mask.tobytes(), (rule, mask))  # rules that hold for the same rows are one
    if not rules:
        return RuleModel(float(np.log(base / (1 - base))))
    b, w = _lasso_logistic(np.column_stack([m for _, m in rules.values()]), y, weight, PENALTY)
    kept = [(rule, float(v)) for (rule, _), v in zip(rules.values(), w) if abs(v) > 1e-6]
    return RuleModel(float(b), kept)


def fit_quality(
    documents: DataFrame, labels: DataFrame, label: str = "quality", held_out: tuple[int, int] = HELD_OUT,
    max_labelled: int = MAX_LABELLED,
) -> RuleModel:
    """Learn from the statistics of at most `max_labelled` documents per label value.

    Without labels, or with one value only, the model is a constant: 0.5, or that value's share smoothed
    by one row of each kind.
    """
    counts = shares(labels, label, *held_out)
    if not (counts[0] and counts[1]):
        share = (counts[1] + 1) / (counts[0] + counts[1] + 2)
        return RuleModel(float(np.log(share / (1 - share))))
    chosen = labelled(labels, label, *held_out, max_labelled)
    rows = (
        documents.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")  # at most 2 * max_labelled rows
        .select("y", *(c.alias(n) for n, c in statistics(F.col("text")).items()))
        .limit(4 * max_labelled)  # copies of a document id may not make the sample larger than that
        .toPandas()
    )
    x, y = rows[NAMES].to_numpy(np.float64), rows["y"].to_numpy(np.float64)
    if not 0 < y.sum() < len(y):
        share = (y.sum() + 1) / (len(y) + 2)
        return RuleModel(float(np.log(share / (1 - share))))
    each = np.array([counts[0], counts[1]], float) / [np.sum(y == 0), np.sum(y == 1)]
    # Rows in a fixed order: the fit must not depend on the order in which tasks end.
    order = np.lexsort(np.column_stack([x, y]).T)
    x, y = x[order], y[order]
    return fit_rules(x, y, each[y.astype(int)], NAMES)


def score_column(model: RuleModel, text: Column) -> Column:
    """Score of a text, 0 to 1, as one expression over its statistics."""
    return model.column(statistics(text))


def score_quality(documents: DataFrame, model: RuleModel) -> DataFrame:
    """(doc_id, score): one row per row of `documents`; a null text counts as empty."""
    stats = documents.select("doc_id", *(c.alias(n) for n, c in statistics(F.col("text")).items()))
    return stats.select("doc_id", model.column({n: F.col(n) for n in NAMES}).alias("score"))
