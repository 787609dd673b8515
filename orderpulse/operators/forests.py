"""Forests of shallow trees on one feature each, for all features from one histogram.

A tree on one feature needs no more than how many rows of each class fall into each of the feature's bins, so one scan
counts bins under the bootstrap weights of every tree, for all features together; trees are grown from those counts.  A
row's weights come from a hash of its key, so they depend on neither partitions nor features.  The forest's probability is
then a number per bin, and its rank AUC on other rows needs those rows' counts per bin only.

What is sent are bins times trees numbers per feature and task, whatever the number of rows.

A tree splits where the weighted Gini impurity falls most, the lowest bin of equal ones, down to a depth; a leaf's
probability is the weighted share of class 1, and the forest's is the mean over its trees.  Missing values have a bin of
their own below all others.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderpulse.operators.arrays import SLOTS, add_slots, slot_rows
from orderpulse.operators.quantiles import exact_quantiles

BINS = 32
#: Weights of a bootstrap sample: shares of a Poisson distribution of mean one, summed up.
_UPTO = np.cumsum([np.exp(-1.0) / f for f in (1, 1, 2, 6, 24, 120, 720, 5040)])


def bootstrap_weights(key_hash: np.ndarray, trees: int, seed: int) -> np.ndarray:
    """A count per row and tree: rows drawn with replacement, told by a mix of the key's hash and the tree's number."""
    with np.errstate(over="ignore"):
        step = np.uint64(0x9E3779B97F4A7C15)
        z = key_hash.view(np.uint64)[:, None] + (np.arange(1, trees + 1, dtype=np.uint64) + np.uint64(seed) * np.uint64(1000)) * step
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return np.searchsorted(_UPTO, (z >> np.uint64(11)).astype(float) / float(1 << 53), side="right")


def bin_edges(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Distinct inner quantiles per feature; bin k holds the values in [edge k-1, edge k).  A feature that varies has two bins."""
    found = exact_quantiles(rows, list(features), [k / bins for k in range(bins + 1)])
    out = []
    for f in features:
        low, *inner, high = [q for q in found[f] if q is not None] or [0.0, 0.0]
        edges = np.unique(np.array(inner, float))
        # a lowest value that nearly all rows hold is the only quantile: what lies above it has a bin of its own
        out.append(np.append(edges, np.nextafter(low, np.inf)) if low < high and (edges == low).all() else edges)
    return out


def _binned(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """0 for a missing value, else 1 plus the number of edges at or below it."""
    return np.where(np.isnan(x), 0, 1 + np.searchsorted(edges, x, side="right"))


def _counted(rows: DataFrame, features, label, key, edges, trees: int, seed: int) -> list[np.ndarray]:
    """Counts (tree, bin, class) per feature; without trees every row counts once."""
    sizes = [len(e) + 2 for e in edges]
    columns = rows.select(
        F.col(label).cast("int"), F.xxhash64(F.col(key).cast("string")), *[F.col(f).cast("double") for f in features]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [np.zeros((max(1, trees), 2 * size)) for size in sizes]
        for batch in batches:
            labels = batch.column(0).to_numpy()
            weights = bootstrap_weights(batch.column(1).to_numpy(), trees, seed).astype(float) if trees else np.ones((len(batch), 1))
            for f, size in enumerate(sizes):
                cell = 2 * _binned(batch.column(2 + f).to_numpy(zero_copy_only=False), edges[f]) + labels
                for t in range(weights.shape[1]):
                    own[f][t] += np.bincount(cell, weights[:, t], 2 * size)
        for f, counts in enumerate(own):
            yield slot_rows(counts.reshape(1, -1), [f])

    found = add_slots(columns.mapInArrow(run, SLOTS))
    return [
        found[f].reshape(max(1, trees), size, 2) if f in found else np.zeros((max(1, trees), size, 2)) for f, size in enumerate(sizes)
    ]


def grow(counts: np.ndarray, depth: int) -> np.ndarray:
    """A tree's probability of class 1 per bin, from weighted counts (bin, class)."""
    total = counts.sum(0)
    out = np.full(len(counts), total[1] / total.sum() if total.sum() else 0.5)
    if not depth or len(counts) < 2 or not total.all():
        return out
    left = np.cumsum(counts, 0)[:-1]
    right = total - left
    n_left, n_right = left.sum(1), right.sum(1)
    fits = (n_left > 0) & (n_right > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        kept = np.where(fits, (left**2).sum(1) / n_left + (right**2).sum(1) / n_right, -np.inf)
    gain = kept - (total**2).sum() / total.sum()
    best = int(np.argmax(gain))
    if not gain[best] > 1e-12 * total.sum():
        return out
    return np.concatenate([grow(counts[: best + 1], depth - 1), grow(counts[best + 1 :], depth - 1)])


def bin_auc(counts: np.ndarray, score: np.ndarray) -> float | None:
    """Rank AUC of a score per bin, ties half, from counts (bin, class); None without both classes."""
    values, group = np.unique(score, return_inverse=True)
    negatives, positives = (np.bincount(group, counts[:, c], len(values)) for c in (0, 1))
    if not negatives.sum() or not positives.sum():
        return None
    below = np.cumsum(negatives) - negatives
    return float((positives * (below + negatives / 2)).sum() / (positives.sum() * negatives.sum()))


def single_feature_aucs(
    train: DataFrame, unseen: DataFrame, features: Sequence[str], label: str, key: str, trees: int = 30, depth: int = 3,
    balanced: bool = True, seed: int = 42, bins: int = BINS,
) -> dict[str, float | None]:
    """AUC on ``unseen`` of a forest per feature fitted on ``train``; a feature of one value on ``train`` has none."""
    features = list(features)
    if not features:
        return {}
    edges = bin_edges(train, features, bins)
    fitted = _counted(train, features, label, key, edges, trees, seed)
    held = _counted(unseen, features, label, key, edges, 0, seed)
    plain = train.agg(F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("pos")).first()
    n, pos = plain["n"], plain["pos"] or 0
    weights = np.array([n / (2 * (n - pos)), n / (2 * pos)]) if balanced and 0 < pos < n else np.ones(2)
    out: dict[str, float | None] = {}
    for f, counts, other in zip(features, fitted, held):
        if (counts.sum((0, 2)) > 0).sum() < 2:
            out[f] = None
            continue
        score = np.mean([grow(tree * weights, depth) for tree in counts], axis=0)
        out[f] = bin_auc(other[0], np.round(score, 12))
    return out
