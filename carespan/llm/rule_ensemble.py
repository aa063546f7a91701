"""Quality scores from a sparse rule ensemble over text statistics.

1. Every text becomes a row of statistics (``STATISTICS``), nothing else enters a score.
2. At most ``TRAIN_ROWS`` labelled rows, the first by a hash of their id, are the training sample.
   Small trees are boosted on it; every path from a root to a node is a rule, a conjunction
   of bounds on statistics.
3. Logistic regression with a lasso penalty, fitted by accelerated proximal gradient steps, weighs the rules; most weights
   become exactly zero.
4. The rules left are compiled into one Spark column expression, which scores all rows.

Labels are learnt only from rows with crc32(doc_id as text) mod 3 other than 1. The fit is on
the driver and bounded by TRAIN_ROWS; everything else is distributed. The same rows give the same scores.

Nulls, ties and odd rows: a null or blank text has zero statistics and a score like any other; a
null doc_id is never held out nor labelled; a null label is none; a document labelled twice counts
twice; without labels of both kinds the score is the share of label 1 (0.5 without any); other columns
are ignored; no rows give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.llm import texts
from carespan.llm.quality_rules import CODE_POINT, SYMBOL, repeated_words
from carespan.llm.storage import documents, kept, ship

FOLDS, HELD_OUT = 3, 1
TRAIN_ROWS = 20_000
TREES, DEPTH, RATE, TREE_ROWS, LEAST_ROWS = 60, 3, 0.2, 4_000, 20
CUTS = 24  # thresholds tried for a statistic
PENALTY = 0.0015
STEPS = 400

STATISTICS = (
    "words", "word_length", "symbols", "upper", "digits", "marks", "exclaiming", "other_scripts", "distinct_words",
    "repeated", "words_with_symbols", "single_words", "capitalized", "ends_of_sentences", "lines", "long_words",
)

_UPPER, _DIGIT, _MARK = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_MARK[list(b"!\"'(),-./:;?@[]_")] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[0x80:] = True


def _shares(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Statistics of the rows of a chunk, one row each."""
    n = len(offsets) - 1
    found = texts.words(data, offsets)
    hashes = texts.word_hashes(data, found)
    rows, counts = found.rows, found.counts.astype(float)
    firsts, lasts = data[found.starts], data[found.ends - 1]

    def total(flags):  # bytes of the rows that have the flag
        sums = np.concatenate([[0], np.cumsum(flags)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(float)

    def words_with(flags):
        return np.bincount(rows, weights=flags, minlength=n)

    def inside(flags):  # words that hold a flagged byte
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[found.ends] > sums[found.starts]

    points = np.concatenate([[0], np.cumsum(CODE_POINT[data])])
    length = points[found.ends] - points[found.starts]
    distinct, owners = texts.distinct_within_rows(hashes, rows, n)
    chars, per_word = np.maximum(words_with(length), 1), np.maximum(counts, 1)
    return np.column_stack(
        [
            np.log1p(counts),
            words_with(length) / per_word,
            total(SYMBOL[data]) / chars,
            total(_UPPER[data]) / chars,
            total(_DIGIT[data]) / chars,
            total(_MARK[data]) / chars,
            total(data == 33) / per_word,
            total(data >= 0x80) / chars,
            np.bincount(owners, minlength=n) / per_word,
            words_with(repeated_words(hashes, rows, n)) / per_word,
            words_with(inside(SYMBOL[data])) / per_word,
            words_with(~inside(_LETTER[data])) / per_word,
            words_with(_UPPER[firsts]) / per_word,
            words_with(np.isin(lasts, list(b".!?"))) / per_word,
            total(data == 10) / per_word,
            words_with(length > 20) / per_word,
        ]
    )


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, every statistic) of every row."""
    ship(docs.sparkSession)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in texts.chunks(batch.column("text")):
                values = _shares(data, offsets)
                yield pa.record_batch(
                    [batch.column(c).slice(first, last - first) for c in ("doc_id", "held_out")]
                    + [pa.array(np.ascontiguousarray(values[:, k])) for k in range(len(STATISTICS))],
                    names=["doc_id", "held_out", *STATISTICS],
                )

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", held)
    schema = "doc_id long, held_out boolean, " + ", ".join(f"{s} double" for s in STATISTICS)
    return docs.select("doc_id", "held_out", "text").mapInArrow(measure, schema)


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, above, bound), all of them hold


def _grow(x: np.ndarray, residual: np.ndarray, hessian: np.ndarray, rows: np.ndarray, depth: int, path: Rule, out: list) -> None:
    """Split rows by the best bound; ``out`` gets (path, rows, is a leaf) of every node."""
    best = (1e-6, 0, 0.0)
    if depth and len(rows) >= 2 * LEAST_ROWS:
        total = residual[rows].sum() ** 2 / (hessian[rows].sum() + 1.0)
        for k in range(x.shape[1]):
            own = x[rows, k]
            cuts = np.unique(np.quantile(own, np.linspace(0, 1, CUTS + 2)[1:-1], method="lower"))
            slot = np.searchsorted(cuts, own)  # own > cuts[slot - 1]
            g = np.bincount(slot, weights=residual[rows], minlength=len(cuts) + 1)
            h = np.bincount(slot, weights=hessian[rows], minlength=len(cuts) + 1)
            n = np.bincount(slot, minlength=len(cuts) + 1)
            gl, hl, nl = g.cumsum()[:-1], h.cumsum()[:-1], n.cumsum()[:-1]
            gain = gl**2 / (hl + 1.0) + (g.sum() - gl) ** 2 / (h.sum() - hl + 1.0) - total
            gain[(nl < LEAST_ROWS) | (len(rows) - nl < LEAST_ROWS)] = 0
            if gain.max() > best[0]:
                best = (gain.max(), k, float(cuts[gain.argmax()]))
    split = best[0] > 1e-6
    out.append((path, rows, not split))
    if split:
        _, k, cut = best
        above = x[rows, k] > cut
        for side in (False, True):
            _grow(x, residual, hessian, rows[above == side], depth - 1, (*path, (k, side, cut)), out)


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    ok = np.ones(len(x), bool)
    for k, above, cut in rule:
        ok &= (x[:, k] > cut) == above
    return ok


def tree_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """Paths of boosted trees, each rule once; the second of two sides of a root says nothing new."""
    rng = np.random.default_rng(0)
    margin = np.full(len(y), math.log(y.mean() / (1 - y.mean())))
    rules: dict[Rule, None] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        rows = rng.choice(len(y), min(TREE_ROWS, len(y)), replace=False)
        nodes: list = []
        _grow(x, y - p, p * (1 - p), rows, DEPTH, (), nodes)
        for path, own, leaf in nodes:
            if path and not (len(path) == 1 and path[0][1]):
                rules[tuple(sorted(path))] = None
            if leaf:
                step = (y - p)[own].sum() / ((p * (1 - p))[own].sum() + 1.0)
                margin[holds(path, x)] += RATE * step
    return list(rules)


def lasso(a: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Intercept and weights of logistic regression with an L1 penalty on scaled columns."""
    scale = np.maximum(a.std(axis=0), 0.05)
    z = (a - a.mean(axis=0)) / scale
    w, b, v, c, t = np.zeros(a.shape[1]), 0.0, np.zeros(a.shape[1]), 0.0, 1.0
    bound = 0.25 * (np.linalg.norm(z, 2) ** 2 / len(y) + 1)
    for _ in range(STEPS):
        gap = 1 / (1 + np.exp(-(z @ v + c))) - y
        step = v - z.T @ gap / len(y) / bound
        new_w, new_b = np.sign(step) * np.maximum(np.abs(step) - PENALTY / bound, 0), c - gap.mean() / bound
        new_t = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, c = new_w + (t - 1) / new_t * (new_w - w), new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new_w, new_b, new_t
    w = w / scale
    return float(b - a.mean(axis=0) @ w), w


class Ensemble:
    """Weighted rules; ``column`` is the score as a Spark expression over the statistics."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.rules: list[tuple[Rule, float]] = []
        share = y.mean() if len(y) else 0.5
        self.intercept = math.log(share / (1 - share)) if 0 < share < 1 else (30.0 if share else -30.0)
        if len(y) and 0 < share < 1:
            rules = tree_rules(x, y)
            if rules:
                self.intercept, weights = lasso(np.column_stack([holds(r, x) for r in rules]).astype(float), y)
                self.rules = [(r, float(w)) for r, w in zip(rules, weights) if w != 0]

    def column(self) -> Column:
        margin = F.lit(self.intercept)
        for rule, weight in self.rules:
            bounds = [(F.col(STATISTICS[k]) > cut) if above else (F.col(STATISTICS[k]) <= cut) for k, above, cut in rule]
            condition = bounds[0]
            for other in bounds[1:]:
                condition = condition & other
            margin = margin + F.when(condition, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-margin))

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.intercept + sum(w * holds(r, x) for r, w in self.rules))))


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality") -> Ensemble:
    """An ensemble learnt from the labelled rows outside the held-out fold."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    sample = (
        stats.where("NOT held_out")
        .join(known.where("doc_id IS NOT NULL AND label IS NOT NULL"), "doc_id")
        .select("doc_id", "label", *STATISTICS)
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label", *STATISTICS)
        .limit(TRAIN_ROWS)
        .toPandas()
    )
    return Ensemble(sample[list(STATISTICS)].to_numpy(float), (sample["label"].to_numpy() > 0).astype(float))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    stats = kept(statistics(docs), "statistics")
    model = fit(stats, labels)
    scored = stats.select("doc_id", "held_out", model.column().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op4_rule_ensemble_quality(spark, folder: str) -> DataFrame:
    return quality_scores(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))
