"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

Shallow trees are boosted on a bounded labelled sample; every path from a root to a
node becomes a rule, a conjunction of comparisons of statistics.  Lasso logistic
regression keeps few of the rules and weighs them.  The model is compiled into one
Spark column expression, so scoring runs in the JVM over whole texts, without Python.

Statistics are shares of counts that don't depend on a language's words; identifiers,
labels, language and source are no inputs.

Fitting takes at most about ``MAX_TRAINING_ROWS`` labelled rows, chosen by hash of the
key; only their statistics, ``len(FEATURES)`` numbers a row, reach the driver.

Defined cases: null and blank texts have all shares 0 and get a score like other texts;
labelled rows with a null label don't train; several labels for one key train once each;
without training rows, or with one class only, the score is the share of label 1 (0.5
without rows).  Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_TRAINING_ROWS = 20_000
TREES, DEPTH, CUTS, LEAF, SHRINK = 40, 3, 24, 10, 0.3
LASSO, LASSO_STEPS = 0.002, 400

# name: (numerator, denominator) of the counts in ``stats.COUNTS``
SHARES = {
    "word_length": ("word_chars", "n_words"), "symbols": ("n_symbols", "word_chars"),
    "capitals": ("n_upper", "word_chars"), "digits": ("n_digits", "word_chars"),
    "bangs": ("n_bangs", "n_words"), "line_words": ("n_words", "n_lines"),
    "dup_lines": ("n_dup_lines", "n_lines"), "repeats": ("n_repeat_words", "n_words"),
    "doubled": ("n_doubled", "n_words"), "distinct": ("n_distinct", "n_words"),
}
FEATURES = ("n_words", *SHARES)


def features(stats: Column) -> list[Column]:
    out = [stats.n_words.cast("double").alias("n_words")]
    for name, (top, bottom) in SHARES.items():
        out.append((stats[top] / F.greatest(stats[bottom], F.lit(1))).cast("double").alias(name))
    return out


@dataclass(frozen=True)
class Rule:
    """All comparisons hold: (feature, True for > / False for <=, cut)."""

    tests: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for f, above, cut in self.tests:
            out &= (x[:, f] > cut) == above
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for f, above, cut in self.tests:
            c = F.col(FEATURES[f])
            out = out & ((c > cut) if above else (c <= cut))
        return out


@dataclass(frozen=True)
class Model:
    bias: float
    rules: tuple[Rule, ...] = ()
    weights: tuple[float, ...] = ()

    def score(self) -> Column:
        """Over columns named like ``FEATURES``."""
        odds = F.lit(self.bias)
        for rule, w in zip(self.rules, self.weights):
            odds = odds + F.when(rule.column(), w).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def _cuts(x: np.ndarray) -> list[np.ndarray]:
    out = []
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        if len(values) > CUTS:
            values = np.unique(np.quantile(x[:, f], np.linspace(0, 1, CUTS + 2)[1:-1]))
            # Shares are mostly 0: also cut among the others.
            other = x[x[:, f] > values[0], f]
            if len(other):
                values = np.unique(np.concatenate([values, np.quantile(other, np.linspace(0, 1, CUTS + 2)[1:-1])]))
        out.append(values[:-1] if len(values) > 1 else values[:0])
    return out


def _grow(x, bins, cuts, grad, hess, rows, tests, depth, found) -> None:
    """Add the rules of the paths below; ``bins`` holds the cut number of each value."""
    best = (1e-6, None, None)
    total_g, total_h = grad[rows].sum(), hess[rows].sum()
    base = total_g ** 2 / (total_h + 1)
    for f in range(x.shape[1]):
        n = len(cuts[f])
        if not n:
            continue
        b = bins[rows, f]
        g = np.cumsum(np.bincount(b, grad[rows], n + 1))[:-1]
        h = np.cumsum(np.bincount(b, hess[rows], n + 1))[:-1]
        c = np.cumsum(np.bincount(b, minlength=n + 1))[:-1]
        gain = g ** 2 / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - base
        gain[(c < LEAF) | (len(rows) - c < LEAF)] = 0
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (gain[k], f, k)
    if best[1] is None:
        found.append((rows, total_g / (total_h + 1)))
        return
    f, k = best[1], best[2]
    for above in (False, True):
        side = rows[(bins[rows, f] > k) == above]
        path = (*tests, (f, above, float(cuts[f][k])))
        found.append(Rule(path))
        if depth > 1:
            _grow(x, bins, cuts, grad, hess, side, path, depth - 1, found)
        else:
            found.append((side, grad[side].sum() / (hess[side].sum() + 1)))


def tree_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """The paths of boosted trees as rules, each set of rows once."""
    cuts = _cuts(x)
    bins = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    odds = np.full(len(y), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    rules: dict[bytes, Rule] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-odds))
        found: list = []
        _grow(x, bins, cuts, y - p, p * (1 - p), np.arange(len(y)), (), DEPTH, found)
        for item in found:
            if isinstance(item, Rule):
                held = item.holds(x)
                if held.sum() > len(y) / 2:
                    held = ~held  # the same split seen from the other side
                rules.setdefault(np.packbits(held).tobytes(), item)
            else:
                odds[item[0]] += SHRINK * item[1]
    return list(rules.values())


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float = LASSO) -> tuple[float, np.ndarray]:
    """Bias and weights by proximal gradient steps with momentum; the bias isn't penalised."""
    n, k = z.shape
    z1 = np.concatenate([np.ones((n, 1)), z], axis=1)
    w = np.zeros(k + 1)
    w[0] = np.log(y.mean() / (1 - y.mean()))
    v = np.ones(k + 1)
    for _ in range(20):  # largest eigenvalue by power iteration
        v = z1.T @ (z1 @ v)
        top = np.linalg.norm(v)
        v /= top
    step = 4 * n / top
    ahead, t = w.copy(), 1.0
    for _ in range(LASSO_STEPS):
        g = z1.T @ (1 / (1 + np.exp(-z1 @ ahead)) - y) / n
        new = ahead - step * g
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return float(w[0]), w[1:]


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """``x`` in the order of FEATURES, ``y`` of 0 and 1."""
    if not len(y):
        return Model(0.0)
    share = (y.sum() + 0.5) / (len(y) + 1)
    if y.min() == y.max():
        return Model(float(np.log(share / (1 - share))))
    rules = tree_rules(x, y)
    if not rules:
        return Model(float(np.log(share / (1 - share))))
    z = np.stack([r.holds(x) for r in rules], axis=1).astype(np.float64)
    bias, weights = lasso_logistic(z, y)
    used = np.flatnonzero(np.abs(weights) > 1e-6)
    return Model(bias, tuple(rules[i] for i in used), tuple(float(weights[i]) for i in used))


def training_rows(scored: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality",
                  max_rows: int = MAX_TRAINING_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """At most about ``max_rows`` rows of FEATURES and labels; ``scored`` has key and FEATURES.

    Labels other than 0 and 1 are left out, null ones too.
    """
    y = labels.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{label}`").cast("int").alias("_y")).where("_y IN (0, 1)")
    n = y.count()
    if n > max_rows:
        place = F.pmod(F.xxhash64("_key", F.lit("quality")), F.lit(1 << 30)) / float(1 << 30)
        y = y.where(place < max_rows / n)
    rows = scored.join(y, F.col(key) == F.col("_key")).select(*FEATURES, "_y").toPandas().sort_values([*FEATURES, "_y"])
    return rows[list(FEATURES)].to_numpy(np.float64), rows["_y"].to_numpy(np.float64)
