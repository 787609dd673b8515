"""Exact quantiles with linear interpolation, at any number of rows."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from orderpulse.operators.ordering import running_totals

#: Cells of one column that a task tells, and values that brackets may hold together when they are read.
CELLS, READ = 2_048, 100_000
#: Rows that are sorted at once.
BLOCK_ROWS = 65_536
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1

#: Cells of a bracket in one task: values from ``lo`` to ``hi``, and how many; ``below`` lie below the bracket.
TOLD = "c int, b int, below long, lo array<long>, hi array<long>, n array<long>"
#: Where a rank lies: between two values, with so many others; ``total`` values has the bracket.
PLACED = "c int, rank long, low long, high long, inside long, total long"


def ordered(values: np.ndarray) -> np.ndarray:
    """Doubles as whole numbers in the same order; applied to those it gives the doubles' bits back."""
    bits = values.view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


@dataclass
class Bracket:
    """Values of one column between two bounds, as whole numbers; it holds ``inside`` values at most."""

    column: int
    low: int
    high: int
    inside: int
    ranks: list[int]


def exact_quantiles(
    df: DataFrame, columns: Mapping[str, Column] | Sequence[str], probs: Sequence[float]
) -> dict[str, list[float | None]]:
    """Quantiles of several columns by narrowing brackets around all wanted ranks at once.

    In a scan every task sorts its values block by block and tells them as cells, each from its lowest to its highest value
    with a count; cells of many equal values hold nothing else.  The value of a rank lies between the one of that rank
    among all cells' lowest and among their highest values, which is the next bracket, until the brackets hold few values,
    which are read, or a single one each.  So no task's work grows with the rows of a bracket, and a value that a third of
    all rows hold is one cell.  Missing and NaN values are ignored; an empty column gives None.
    """
    exprs = columns if isinstance(columns, Mapping) else {c: F.col(c) for c in columns}
    names = list(exprs)
    if not names:
        return {}
    # plain columns: an expression each for dozens of them makes a function too long for the JVM to compile
    values = df.select(*[c.cast("double").alias(f"v{i}") for i, c in enumerate(exprs.values())])
    brackets, counts, found = [Bracket(i, LOWEST, HIGHEST, 0, []) for i in range(len(names))], [0] * len(names), {}
    first = True
    while brackets:
        told = values.mapInArrow(_cells(brackets), TOLD).repartition("c").mapInArrow(_places(brackets, probs if first else None), PLACED)
        brackets = []
        for r in sorted(told.collect(), key=lambda r: (r["c"], r["low"], r["high"])):
            if first:
                counts[r["c"]] = r["total"]
            if r["low"] == r["high"]:
                found[r["c"], r["rank"]] = r["low"]
            elif brackets and brackets[-1].column == r["c"] and r["low"] <= brackets[-1].high:
                last = brackets[-1]
                last.high, last.ranks = max(last.high, r["high"]), [*last.ranks, r["rank"]]
                last.inside += 0 if r["inside"] <= last.inside and r["high"] == last.high and r["low"] == last.low else r["inside"]
            else:
                brackets.append(Bracket(r["c"], r["low"], r["high"], r["inside"], [r["rank"]]))
        first = False
        if sum(b.inside for b in brackets) <= READ:
            break
    if brackets:
        _read(values, brackets, found)
    told = {key: float(ordered(np.array([v], np.int64)).view(float)[0]) for key, v in found.items()}
    return {name: [_interpolate(told, i, counts[i], p) for p in probs] for i, name in enumerate(names)}


def _ranks(n: int, probs: Sequence[float]) -> list[int]:
    return sorted({k for p in probs for k in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))}) if n else []


def _by_column(brackets: Sequence[Bracket]) -> dict[int, list[int]]:
    """Numbers of the brackets of each column."""
    out: dict[int, list[int]] = {}
    for i, b in enumerate(brackets):
        out.setdefault(b.column, []).append(i)
    return out


def _sorted_values(batches: Iterator[pa.RecordBatch], columns: Sequence[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Values of a block of rows, column by column, as whole numbers from the lowest to the highest."""

    def block(held: list[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        for c in columns:
            v = np.concatenate([batch.column(c).to_numpy(zero_copy_only=False) for batch in held]).astype(float, copy=False)
            # both zeros are one value
            yield c, np.sort(ordered(v[~np.isnan(v)] + 0.0))

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows >= BLOCK_ROWS:
            yield from block(held)
            held, rows = [], 0
    if held:
        yield from block(held)


def _runs(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted list and how often each comes."""
    starts = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]])) if len(v) else np.empty(0, np.intp)
    return v[starts], np.diff(np.append(starts, len(v)))


def _joined(lo: np.ndarray, hi: np.ndarray, n: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells by their lower ends, equal ones put together, and neighbours too if there are too many, up to an even share of the rows."""
    order = np.lexsort((hi, lo))
    lo, hi, n = lo[order], hi[order], n[order]
    new = np.ones(len(lo), bool)
    new[1:] = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    starts = np.flatnonzero(new)
    lo, hi, n = lo[starts], hi[starts], np.add.reduceat(n, starts) if len(starts) else n
    if len(lo) > most:
        share = n.sum() / most
        heavy, group = n >= share, (np.cumsum(n) - n) // share
        new = np.ones(len(lo), bool)
        new[1:] = (group[1:] != group[:-1]) | heavy[1:] | heavy[:-1]
        starts = np.flatnonzero(new)
        lo, hi, n = lo[starts], np.maximum.reduceat(hi, starts), np.add.reduceat(n, starts)
    return lo, hi, n


def _cells(brackets: Sequence[Bracket]):
    columns = _by_column(brackets)
    # a few cells per rank at least, so that every scan leaves at most a part of a bracket
    most = [max(3, 4 * len(b.ranks), CELLS // len(columns[b.column])) for b in brackets]
    low, high = np.array([b.low for b in brackets], np.int64), np.array([b.high for b in brackets], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        below = [0] * len(brackets)
        held: list[list[tuple]] = [[] for _ in brackets]
        for c, v in _sorted_values(batches, list(columns)):
            for i in columns[c]:
                a, z = int(np.searchsorted(v, low[i])), int(np.searchsorted(v, high[i], side="right"))
                below[i] += a
                if a < z:
                    found, n = _runs(v[a:z])
                    held[i].append(_joined(found, found, n, most[i]))
                if sum(len(x[0]) for x in held[i]) > 8 * most[i]:
                    held[i] = [_joined(*map(np.concatenate, zip(*held[i])), most[i])]
        for c, mine in columns.items():
            for i in mine:
                told = _joined(*map(np.concatenate, zip(*held[i])), most[i]) if held[i] else (np.empty(0, np.int64),) * 3
                head = [pa.array([x], kind) for x, kind in ((c, pa.int32()), (i, pa.int32()), (below[i], pa.int64()))]
                lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, pa.int64())) for x in told]
                yield pa.RecordBatch.from_arrays([*head, *lists], ["c", "b", "below", "lo", "hi", "n"])

    return run


def _places(brackets: Sequence[Bracket], probs: Sequence[float] | None):
    """For every wanted rank the values between which it lies; the first scan works ranks out from the shares ``probs``."""
    wanted = [b.ranks for b in brackets]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        below, held, column = Counter(), {}, {}
        for batch in batches:
            for k, (c, i, under) in enumerate(zip(*(batch.column(j).to_pylist() for j in range(3)))):
                below[i] += under
                column[i] = c
                held.setdefault(i, []).append([batch.column(j)[k].values.to_numpy() for j in (3, 4, 5)])
        out = []
        for i, parts in held.items():
            lo, hi, n = map(np.concatenate, zip(*parts))
            total = int(n.sum())
            by_lo, by_hi = np.argsort(lo), np.argsort(hi)
            upto_lo, upto_hi = np.cumsum(n[by_lo]), np.cumsum(n[by_hi])
            for rank in wanted[i] if probs is None else _ranks(total, probs):
                a = int(lo[by_lo[np.searchsorted(upto_lo, rank - below[i], side="right")]])
                z = int(hi[by_hi[np.searchsorted(upto_hi, rank - below[i], side="right")]])
                out.append((column[i], rank, a, z, int(n[(hi >= a) & (lo <= z)].sum()), total))
        names = ["c", "rank", "low", "high", "inside", "total"]
        kinds = [pa.int32(), *[pa.int64()] * 5]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], kind) for j, kind in enumerate(kinds)], names)

    return run


def _read(values: DataFrame, brackets: Sequence[Bracket], found: dict[tuple[int, int], int]) -> None:
    """Look the wanted ranks up among the brackets' values, at most READ of them; a missing value counts those below."""
    columns = _by_column(brackets)
    low, high = np.array([b.low for b in brackets], np.int64), np.array([b.high for b in brackets], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c, v in _sorted_values(batches, list(columns)):
            for i in columns[c]:
                a, z = int(np.searchsorted(v, low[i])), int(np.searchsorted(v, high[i], side="right"))
                told, n = _runs(v[a:z])
                arrays = [np.full(len(told) + 1, i, np.int32), [None, *told.tolist()], [a, *n.tolist()]]
                kinds = [pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(arrays, kinds)], ["b", "v", "n"])

    cells: dict[int, Counter] = {}
    below: Counter = Counter()
    for r in values.mapInArrow(run, "b int, v long, n long").groupBy("b", "v").agg(F.sum("n").alias("n")).collect():
        if r["v"] is None:
            below[r["b"]] += r["n"]
        else:
            cells.setdefault(r["b"], Counter())[r["v"]] += r["n"]
    for i, b in enumerate(brackets):
        inside = sorted(cells[i])
        upto = np.cumsum([cells[i][v] for v in inside]) + below[i]
        found |= {(b.column, k): inside[int(np.searchsorted(upto, k, side="right"))] for k in b.ranks}


def _interpolate(found: Mapping[tuple[int, int], float], column: int, n: int, p: float) -> float | None:
    if not n:
        return None
    rank = p * (n - 1)
    low, high = found[column, math.floor(rank)], found[column, math.ceil(rank)]
    return low + (high - low) * (rank - math.floor(rank))


def quantiles_by_group(
    df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float]
) -> DataFrame:
    """Exact quantiles ``q0..qk`` per group from running counts of distinct values."""
    ranked = running_totals(df, value, {"c": F.lit(1)}, by=by)
    lo, hi = F.col("c_cum") - F.col("c"), F.col("c_cum")
    picks = []
    for p in probs:
        rank = F.lit(float(p)) * (F.col("c_all") - 1)
        for k in (F.floor(rank), F.ceil(rank)):
            picks.append(F.max(F.when((lo <= k) & (k < hi), F.col(value))))
    agg = ranked.groupBy(*by).agg(
        F.max("c_all").alias("_n"), *[c.alias(f"_p{i}") for i, c in enumerate(picks)]
    )
    out = []
    for j, p in enumerate(probs):
        rank = F.lit(float(p)) * (F.col("_n") - 1)
        a, z = F.col(f"_p{2 * j}"), F.col(f"_p{2 * j + 1}")
        out.append((a + (z - a) * (rank - F.floor(rank))).alias(f"q{j}"))
    return agg.select(*by, *out)
