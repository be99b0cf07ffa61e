"""A sparse rule ensemble that scores text quality.

Small boosted trees over statistics of the text are taken apart: every path
from a root to a node is a rule, a conjunction of thresholds. A logistic
regression with an L1 penalty weighs the rules and drops most of them; the
rules left are compiled into one Spark column expression over the statistics.

The model is fitted on at most ``SAMPLE`` labelled rows, those with the smallest
hashes of their ids; every text is scored whole.

Null and empty texts have all statistics zero and are scored like any other.
Labels other than 0 and 1 or null are ignored, several labels of one document
count as the smallest. If the sample holds one class only, the score is that
class's smoothed share everywhere. Repeated rows are scored each for itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayline.llm.common import utf8
from quayline.session import configure, staged

SAMPLE = 20_000
TREES = 60
DEPTH = 3
BINS = 32
LAMBDA = 1.5e-3
THRESHOLD = 0.3

STATISTICS = [
    "log_bytes", "log_words", "word_bytes", "longest_word", "upper", "digit", "blank", "high", "stop_marks",
    "pair_marks", "odd_marks", "pipes", "mark_kinds", "lines", "line_bytes", "repeated_lines", "distinct_words",
    "top_word", "same_next", "upper_words", "marked_words", "stopped_words", "single_words", "word_spread",
    "repeated_triples", "entropy",
]


def _share(table: np.ndarray, chars: bytes) -> float:
    return float(table[list(chars)].sum())


def statistics(text: bytes) -> list[float]:
    """The numbers in ``STATISTICS`` order for one UTF-8 text."""
    if not text:
        return [0.0] * len(STATISTICS)
    n = len(text)
    count = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    words = text.split()
    w = len(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    sizes = np.fromiter(map(len, words), dtype=np.float64, count=w)
    tally: dict[bytes, int] = {}
    for x in words:
        tally[x] = tally.get(x, 0) + 1
    marks = np.r_[33:48, 58:65, 91:97, 123:127]
    odd = _share(count, b"*#$%&@^~=_<>\\+")
    triples = len(set(zip(words, words[1:], words[2:]))) if w > 2 else 0
    p = count[count > 0] / n
    per = 1 / max(1, w)
    ends = [x[-1] for x in words]
    return [
        float(np.log1p(n)),
        float(np.log1p(w)),
        float(sizes.mean()) if w else 0.0,
        float(np.log1p(sizes.max())) if w else 0.0,
        float(count[65:91].sum()) / n,
        float(count[48:58].sum()) / n,
        _share(count, b" \t\n\r") / n,
        float(count[128:].sum()) / n,
        _share(count, b".,;:!?") * per,
        _share(count, b"()[]{}\"'") * per,
        odd * per,
        _share(count, b"|") * per,
        float((count[marks] > 0).sum()),
        float(np.log1p(len(lines))),
        float(np.log1p(n / max(1, len(lines)))),
        1 - len(set(lines)) / max(1, len(lines)),
        len(tally) * per,
        max(tally.values(), default=0) * per,
        sum(map(bytes.__eq__, words, words[1:])) * per,
        sum(map(bytes.isupper, words)) * per,
        sum(1 for c in ends if c in b"*#$%&!") * per,
        sum(1 for c in ends if c in b".?") * per,
        sum(1 for x in words if len(x) == 1) * per,
        float(sizes.std()) if w else 0.0,
        1 - triples / (w - 2) if w > 2 else 0.0,
        float(-(p * np.log2(p)).sum()),
    ]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [statistics(t.as_py()) for t in batch.column("text")]
        table = np.array(rows, dtype=np.float64).reshape(-1, len(STATISTICS))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(np.ascontiguousarray(c)) for c in table.T]], ["doc_id", *STATISTICS]
        )


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and a double column for each statistic."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), utf8(text).alias("text"))
    return rows.mapInArrow(_measure, "doc_id bigint, " + ", ".join(f"{s} double" for s in STATISTICS))


@dataclass
class Rule:
    """Thresholds that all hold: ``(statistic, 1, x)`` for ``<= x`` and ``(statistic, -1, x)`` for ``> x``."""

    terms: tuple[tuple[int, int, float], ...]

    def applies(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), dtype=bool)
        for j, side, cut in self.terms:
            out &= x[:, j] <= cut if side > 0 else x[:, j] > cut
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for j, side, cut in self.terms:
            c = F.col(STATISTICS[j])
            out = out & (c <= cut if side > 0 else c > cut)
        return out


@dataclass
class RuleEnsemble:
    bias: float
    rules: list[Rule] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for rule, weight in zip(self.rules, self.weights):
            z += weight * rule.applies(x)
        return 1 / (1 + np.exp(-z))

    def column(self) -> Column:
        """The score as a built-in expression."""
        z = F.lit(self.bias)
        for rule, weight in zip(self.rules, self.weights):
            z = z + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z))


def _tree_paths(bins: np.ndarray, cuts: list[np.ndarray], grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, features: np.ndarray, depth: int, path: tuple, out: list, value: np.ndarray) -> None:
    """Grow one tree by second-order gain; each node's path goes to ``out``, each leaf's step to ``value``."""
    total_g, total_h = grad[rows].sum(), hess[rows].sum()
    best = (1e-6, None, None)
    if depth and len(rows) >= 40:
        for j in features:
            b = bins[rows, j]
            g = np.cumsum(np.bincount(b, grad[rows], BINS))[:-1]
            h = np.cumsum(np.bincount(b, hess[rows], BINS))[:-1]
            gain = g**2 / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g**2 / (total_h + 1)
            gain[(h < 2) | (total_h - h < 2)] = -1
            gain = gain[: len(cuts[j])]
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), j, int(gain.argmax()))
    if best[1] is None:
        value[rows] = -total_g / (total_h + 1)
        return
    _, j, at = best
    left = bins[rows, j] <= at
    for side, part in ((1, rows[left]), (-1, rows[~left])):
        longer = (*path, (int(j), side, float(cuts[j][at])))
        out.append(longer)
        _tree_paths(bins, cuts, grad, hess, part, features, depth - 1, longer, out, value)


def extract_rules(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 7) -> list[Rule]:
    """Distinct root-to-node paths of boosted trees, each on half of the rows and statistics."""
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS)[1:-1])) for c in x.T]
    bins = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], axis=1)
    z = np.full(len(y), np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    found: list = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        grad, hess = p - y, p * (1 - p)
        rows = np.flatnonzero(rng.random(len(y)) < 0.5)
        features = rng.permutation(x.shape[1])[: max(1, x.shape[1] // 2)]
        step = np.zeros(len(y))
        own: list = []
        _tree_paths(bins, cuts, grad, hess, rows, features, depth, (), own, step)
        # Rows outside of the half get the value of their leaf by way of its path.
        z += 0.2 * _leaf_values(x, own, rows, step)
        found += own
    distinct = dict.fromkeys(tuple(sorted(_tight(p))) for p in found)
    return [Rule(p) for p in distinct]


def _tight(path: tuple) -> list:
    """The closest threshold for each statistic and side."""
    best: dict = {}
    for j, side, cut in path:
        k = (j, side)
        best[k] = cut if k not in best else (min if side > 0 else max)(best[k], cut)
    return [(j, side, cut) for (j, side), cut in best.items()]


def _leaf_values(x: np.ndarray, paths: list, rows: np.ndarray, step: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x))
    inner = {p[:-1] for p in paths}
    for path in paths or [()]:
        if path in inner:
            continue
        here = Rule(tuple(path)).applies(x)
        known = rows[here[rows]]
        if len(known):
            out[here] = step[known].mean()
    return out


def lasso_logistic(x: np.ndarray, y: np.ndarray, penalty: float = LAMBDA, rounds: int = 300) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient; the bias is not penalised."""
    n, d = x.shape
    x = x.astype(np.float32)
    w, v, bias, vb = np.zeros(d, np.float32), np.zeros(d, np.float32), 0.0, 0.0
    probe = np.ones(d, np.float32) / np.sqrt(max(1, d))
    for _ in range(20):
        probe = x.T @ (x @ probe)
        size = float(np.linalg.norm(probe)) or 1.0
        probe /= size
    rate = 1 / (0.25 * (size / n + 1))
    t = 1.0
    for _ in range(rounds):
        r = 1 / (1 + np.exp(-(x @ v + vb))) - y
        new = v - rate * (x.T @ r / n).astype(np.float32)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        new_bias = vb - rate * float(r.mean())
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + np.float32((t - 1) / t_new) * (new - w), new_bias + (t - 1) / t_new * (new_bias - bias)
        w, bias, t = new, new_bias, t_new
    return float(bias), w


def fit(x: np.ndarray, y: np.ndarray) -> RuleEnsemble:
    prior = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(prior / (1 - prior)))
    if len(y) < 40 or y.min() == y.max():
        return RuleEnsemble(base)
    rules = extract_rules(x, y)
    if not rules:
        return RuleEnsemble(base)
    bias, weights = lasso_logistic(np.stack([r.applies(x) for r in rules], axis=1), y)
    kept = [i for i in np.flatnonzero(weights) if abs(weights[i]) > 1e-3]
    return RuleEnsemble(bias, [rules[i] for i in kept], [float(weights[i]) for i in kept])


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE
) -> RuleEnsemble:
    """Fit on a bounded hashed sample of the labelled rows given."""
    spark = configure(docs.sparkSession)
    labelled = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
    labelled = labelled.groupBy(F.col(doc_id).cast("bigint").alias("label_id")).agg(F.min(label).alias("label"))
    chosen = staged(spark, labelled.orderBy(F.xxhash64("label_id"), "label_id").limit(sample), "sample")
    # At most ``sample`` pairs of numbers go to every executor.
    # Other columns of the table, whatever their names, stay out of the join.
    named = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    picked = named.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"), "left_semi")
    rows = measure(picked, "doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
    rows = rows.select("doc_id", "label", *STATISTICS).orderBy(F.xxhash64("doc_id"), *STATISTICS).limit(sample)
    table = rows.toPandas()
    return fit(table[STATISTICS].to_numpy(dtype=np.float64), table["label"].to_numpy(dtype=np.float64))


def score(docs: DataFrame, model: RuleEnsemble, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, score)`` with the rules as column expressions over the statistics."""
    return measure(docs, doc_id, text).select("doc_id", model.column().alias("score"))
