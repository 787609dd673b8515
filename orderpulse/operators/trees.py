"""Random forests over Spark, grown level by level from binned features that are written once.

Rows are written with a byte per feature, the number of its bin, so a scan reads a few dozen bytes a row and nothing is kept
in memory between scans; forests on different features read the same rows.  A scan leads every row down each tree and counts,
for every open node and each of the features drawn for it, rows of both classes per bin under the tree's bootstrap weights.
Counts are whole numbers, so a forest depends on neither partitions nor the order of rows.  The driver picks the splits of a
level.  Trees whose counts do not fit ``SUM_BYTES`` together are taken in turns.

As in MLlib, which keeps every row with a count per tree in memory and which these replace on large tables: rows are drawn with replacement per tree, a node sees
``ceil(sqrt(features))`` features (all of them in a single tree) in at most ``BINS`` bins each, splits where the weighted
Gini impurity falls most, and is a leaf at the depth limit or where no split helps; leaves side by side that
tell the same class become one; a forest's probability is the mean of the leaves' weighted shares of class 1.  A feature of at most ``BINS`` values has a bin for each; a missing value lies below
all others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderpulse.operators.arrays import SLOTS, add_slots, slot_rows
from orderpulse.operators.forests import _UPTO, _binned
from orderpulse.operators.quantiles import exact_quantiles

BINS = 32
#: Numbers of a bin: missing, and one per bin.  Counts lie at twice the bin's number plus the class.
WIDTH = 2 * (BINS + 1)
#: Bytes of counts that one scan may hold in a task.
SUM_BYTES = 64_000_000
#: Times that a row is drawn, by 16 random bits: a Poisson distribution of mean one.
_DRAWN = np.searchsorted(_UPTO, (np.arange(1 << 16) + 0.5) / (1 << 16), side="right").astype(np.uint8)
#: A cut that no bin reaches: all rows of a leaf go left.
_LEAF = 255


def few_values(rows: DataFrame, features: Sequence[str], most: int = BINS) -> dict[str, list[float]]:
    """The distinct values of every feature that has at most so many; missing and NaN values do not count."""
    columns = rows.select(*[F.col(f).cast("double").alias(f"v{i}") for i, f in enumerate(features)])

    def add(found: dict[int, np.ndarray | None], i: int, values: np.ndarray) -> None:
        if (known := found.get(i, values[:0])) is not None:
            values = np.unique(np.concatenate([known, values + 0.0]))
            found[i] = values if len(values) <= most else None

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray | None] = {}
        for batch in batches:
            for i in range(len(features)):
                if found.get(i, ()) is not None:
                    v = batch.column(i).to_numpy(zero_copy_only=False).astype(float)
                    add(found, i, v[~np.isnan(v)])
        for i, v in found.items():
            # too many values are told by one more than the most
            yield slot_rows((np.zeros(most + 1) if v is None else v)[None, :], [i])

    out: dict[int, np.ndarray | None] = {}
    for r in columns.mapInArrow(distinct, SLOTS).distinct().collect():
        if len(r["sums"]) > most:
            out[r["slot"]] = None
        else:
            add(out, r["slot"], np.array(r["sums"], float))
    return {f: out[i].tolist() for i, f in enumerate(features) if out.get(i) is not None}


def forest_edges(rows: DataFrame, features: Sequence[str]) -> dict[str, np.ndarray]:
    """Edges of at most BINS bins per feature; bin k holds the values in [edge k-1, edge k)."""
    few = few_values(rows, features)
    many = [f for f in features if f not in few]
    inner = exact_quantiles(rows, many, [k / BINS for k in range(BINS)])
    out = {f: np.array(v[1:], float) for f, v in few.items()}
    for f in many:
        low = inner[f][0]
        edges = np.unique([q for q in inner[f] if q > low])
        # what lies above a lowest value that nearly all rows hold has a bin of its own
        out[f] = edges if len(edges) else np.array([np.nextafter(low, np.inf)])
    return out


def bins_of(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """A byte per feature: 0 for a missing value, else the number of its bin from 1."""
    bins = np.empty(x.shape, np.uint8)
    for i, cut in enumerate(edges):
        bins[:, i] = _binned(x[:, i].astype(float), cut)
    return bins


def binned_rows(rows: DataFrame, edges: Mapping[str, np.ndarray], label: str, key: str, *keep: str) -> DataFrame:
    """The columns to keep, the label, a hash of the key, and the bins of all features as bytes."""
    cuts = list(edges.values())
    source = rows.select(
        *keep, F.col(label).cast("int").alias("label"), F.xxhash64(F.col(key).cast("string")).alias("h"),
        *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(edges)],
    )
    first = len(keep) + 2
    names = [*source.columns[:first], "bins"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [batch.column(first + i).to_numpy(zero_copy_only=False) for i in range(len(cuts))]
            bins = bins_of(np.column_stack(x), cuts)
            ends = np.arange(len(batch) + 1, dtype=np.int32) * len(cuts)
            told = pa.Array.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer(ends), pa.py_buffer(bins)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:first], told], names)

    kinds = dict(source.dtypes)
    return source.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in names[:-1]) + ", bins binary")


def _bytes(column: pa.Array, width: int) -> np.ndarray:
    """The bins of a batch, a row each."""
    start = np.frombuffer(column.buffers()[1], np.int32)[column.offset] if len(column) else 0
    data = np.frombuffer(column.buffers()[2], np.uint8) if len(column) else np.empty(0, np.uint8)
    return data[start : start + len(column) * width].reshape(len(column), width)


class Draws:
    """How often each row of a batch is drawn for a tree, told by a mix of the key's hash and the tree's number."""

    def __init__(self, key_hash: np.ndarray, seed: int) -> None:
        self.hash, self.seed, self.words = key_hash.view(np.uint64), np.uint64(seed), {}

    def __call__(self, tree: int) -> np.ndarray:
        word, piece = divmod(tree, 4)
        if word not in self.words:
            with np.errstate(over="ignore"):
                z = self.hash + (np.uint64(word + 1) + self.seed * np.uint64(1000)) * np.uint64(0x9E3779B97F4A7C15)
                z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                z ^= z >> np.uint64(31)
            # the pieces of the last word only: trees come in order
            self.words = {word: z.view(np.uint16).reshape(-1, 4)}
        return _DRAWN.take(self.words[word][:, piece])


@dataclass
class Forest:
    """Trees as arrays by tree and node; node 1 is the root, the children of node k are 2k and 2k + 1."""

    features: list[str]
    depth: int
    split: np.ndarray  # place of the feature's bin in a row
    cut: np.ndarray  # lowest number that goes right: twice a bin's number
    share: np.ndarray  # of class 1
    gain: np.ndarray  # fall of impurity times weight
    used: np.ndarray  # which of the features splits, -1 in a leaf

    def scoring(self, held: Sequence[str]) -> "Forest":
        """What scoring needs, for rows that hold the bins of the forest's features only; ``held`` are those it was grown from."""
        at = {held.index(f): i for i, f in enumerate(self.features)}
        place = np.array([at.get(i, 0) for i in range(len(held))], np.intp)
        return replace(self, split=place[self.split], gain=np.empty(0), used=np.empty(0))

    def importances(self) -> dict[str, float]:
        """Falls of impurity by feature, as shares of their tree's, averaged over the trees."""
        by_tree = np.zeros((len(self.split), len(self.features)))
        for t, (used, gain) in enumerate(zip(self.used, self.gain)):
            by_tree[t] = np.bincount(used[used >= 0], gain[used >= 0], len(self.features))
        sums = by_tree.sum(1, keepdims=True)
        mean = np.divide(by_tree, sums, out=np.zeros_like(by_tree), where=sums > 0).sum(0)
        return dict(zip(self.features, (mean / (mean.sum() or 1.0)).tolist()))

    def probability(self, bins: np.ndarray) -> np.ndarray:
        """Of class 1, for rows of bins."""
        flat, base = (2 * bins).ravel(), np.arange(len(bins)) * bins.shape[1]
        total = np.zeros(len(bins))
        for split, cut, share in zip(self.split, self.cut, self.share):
            total += share.take(_leads(flat, base, split, cut, self.depth))
        return total / len(self.split)


def _leads(flat: np.ndarray, base: np.ndarray, split: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """The node in which each row arrives after so many levels; rows of a leaf go on to the left."""
    node = np.ones(len(base), np.intp)
    for _ in range(levels):
        right = flat.take(base + split.take(node)) >= cut.take(node)
        node += node
        node += right
    return node


def fit(
    rows: DataFrame, places: Mapping[str, int], features: Sequence[str], trees: int = 100, depth: int = 6, balanced: bool = False, seed: int = 42
) -> Forest:
    """Grow a forest on some features of ``binned_rows``; ``places`` are the positions of all features in a row's bins."""
    features = list(features)
    at = np.array([places[f] for f in features], np.intp)
    drawn = len(features) if trees == 1 else math.ceil(math.sqrt(len(features)))
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    weights = np.array([(n0 + n1) / (2 * n0), (n0 + n1) / (2 * n1)]) if balanced and n0 and n1 else np.ones(2)
    nodes = 2 << depth
    shape = (trees, nodes)
    forest = Forest(
        features, depth, np.zeros(shape, np.intp), np.full(shape, _LEAF, np.uint8), np.full(shape, 0.5), np.zeros(shape),
        np.full(shape, -1, np.int32),
    )
    open_nodes = [np.array([1])] * trees
    for level in range(depth):
        turn: list[int] = []
        for t in range(trees):
            turn += [t] if len(open_nodes[t]) else []
            size = lambda t: 8 * drawn * WIDTH * len(open_nodes[t])
            if turn and (t == trees - 1 or sum(map(size, turn)) + size(t + 1) > SUM_BYTES):
                subsets = {k: _subsets(len(features), len(open_nodes[k]), drawn, seed, k, level) for k in turn}
                told = add_slots(rows.select("label", "h", "bins").mapInArrow(
                    _counting(forest, open_nodes, {k: at[s] for k, s in subsets.items()}, level, len(places), seed), SLOTS
                ))
                for k in turn:
                    if k in told:
                        cells = told[k].reshape(drawn, len(open_nodes[k]), BINS + 1, 2).transpose(1, 0, 2, 3)
                        open_nodes[k] = _grow(forest, k, open_nodes[k], subsets[k], at, cells, weights)
                    else:
                        open_nodes[k] = open_nodes[k][:0]
                turn = []
    _prune(forest)
    return forest


def _prune(forest: Forest) -> None:
    """Join leaves side by side that tell the same class, as MLlib does, from the lowest level up; then lead rows of leaves down."""
    half = forest.share.shape[1] // 2
    for k in range(half - 1, 0, -1):
        leaves = (forest.used[:, 2 * k] < 0) & (forest.used[:, 2 * k + 1] < 0)
        same = leaves & ((forest.share[:, 2 * k] > 0.5) == (forest.share[:, 2 * k + 1] > 0.5))
        forest.used[same, k], forest.split[same, k], forest.cut[same, k], forest.gain[same, k] = -1, 0, _LEAF, 0.0
    for k in range(1, half):
        leaf = forest.used[:, k] < 0
        forest.share[leaf, 2 * k] = forest.share[leaf, k]


def _subsets(features: int, nodes: int, drawn: int, seed: int, tree: int, level: int) -> np.ndarray:
    """Which features each node sees."""
    rng = np.random.default_rng([seed, tree, level])
    return np.sort(rng.random((nodes, features)).argsort(1)[:, :drawn], axis=1)


def _counting(forest: Forest, open_nodes: Sequence[np.ndarray], seen: Mapping[int, np.ndarray], level: int, width: int, seed: int):
    """Weighted rows per open node, drawn feature, bin and class, for some trees."""
    plans = {}
    for t, places in seen.items():
        slot = np.full(2 << level, -1, np.intp)
        slot[open_nodes[t]] = np.arange(len(open_nodes[t]))
        plans[t] = (forest.split[t, : 1 << level].copy(), forest.cut[t, : 1 << level].copy(), slot, np.ascontiguousarray(places.T))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = {t: np.zeros((places.shape[0], places.shape[1] * WIDTH)) for t, (*_, places) in plans.items()}
        for batch in batches:
            flat = (2 * _bytes(batch.column(2), width) + batch.column(0).to_numpy().astype(np.uint8)[:, None]).ravel()
            every, draws = np.arange(len(batch)) * width, Draws(batch.column(1).to_numpy(), seed)
            for t, (split, cut, slot, places) in plans.items():
                weight = draws(t)
                mine = np.flatnonzero(weight)
                base, weight = every.take(mine), weight.take(mine).astype(float)
                place = slot.take(_leads(flat, base, split, cut, level))
                if level and place.min(initial=0) < 0:
                    kept = np.flatnonzero(place >= 0)
                    base, weight, place = base.take(kept), weight.take(kept), place.take(kept)
                cell = place * WIDTH
                for j, feature in enumerate(places):
                    own[t][j] += np.bincount(cell + flat.take(base + feature.take(place)), weight, own[t].shape[1])
        for t, counts in own.items():
            yield slot_rows(counts.reshape(1, -1), [t])

    return run


def _grow(forest: Forest, tree: int, nodes: np.ndarray, subsets: np.ndarray, at: np.ndarray, cells: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Split a tree's open nodes from counts (node, drawn feature, bin, class); the children to go on with."""
    total = cells[:, 0].sum(1)
    upto = np.cumsum(cells, axis=2)[:, :, :-1]
    left_n, left = upto.sum(3), upto * weights
    whole = total * weights
    right = whole[:, None, None] - left
    n = total.sum(1)
    with np.errstate(divide="ignore", invalid="ignore"):
        kept = (left**2).sum(3) / left.sum(3) + (right**2).sum(3) / right.sum(3)
        pure = (whole**2).sum(1) / whole.sum(1)
        forest.share[tree, nodes] = np.where(n > 0, whole[:, 1] / whole.sum(1), 0.5)
    fall = np.where((left_n > 0) & (left_n < n[:, None, None]), kept - pure[:, None, None], -np.inf).reshape(len(nodes), -1)
    best = fall.argmax(1)
    chosen = np.flatnonzero(fall[np.arange(len(nodes)), best] > 1e-12 * whole.sum(1))
    feature, bin_ = np.divmod(best[chosen], left.shape[2])
    mine = nodes[chosen]
    which = subsets[chosen, feature]
    forest.used[tree, mine], forest.split[tree, mine] = which, at[which]
    forest.cut[tree, mine], forest.gain[tree, mine] = 2 * (bin_ + 1), fall[chosen, best[chosen]]
    children = []
    for side, child in ((left[chosen, feature, bin_], 2 * mine), (right[chosen, feature, bin_], 2 * mine + 1)):
        forest.share[tree, child] = side[:, 1] / side.sum(1)
        children.append(child[(side > 1e-9).all(1)])
    return np.sort(np.concatenate(children))


def scores(rows: DataFrame, forests: Sequence[Forest], width: int, *keep: str) -> DataFrame:
    """The columns to keep and ``proba`` of every forest, numbered by ``candidate``, from one scan of ``binned_rows``."""
    source = rows.select(*keep, "bins")
    kinds = dict(source.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = _bytes(batch.column(len(keep)), width)
            for i, forest in enumerate(forests):
                told = [pa.array(np.full(len(batch), i, np.int32)), *batch.columns[:-1], pa.array(forest.probability(bins))]
                yield pa.RecordBatch.from_arrays(told, ["candidate", *keep, "proba"])

    return source.mapInArrow(run, "candidate int, " + ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", proba double")
