"""Sums of number vectors across tasks, a vector per slot."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, functions as F

SLOTS = "slot int, sums array<double>"


def per_column(df: DataFrame, columns: Sequence[Column], *aggregates: Column) -> dict[int, Row]:
    """Aggregates of the column ``v`` for each of several expressions of one type, by position; an empty frame has none.

    Cells become rows of position and value.  One aggregate per column in a single row would make functions too long for
    the JVM to compile, which then interprets them.
    """
    cells = df.select(F.posexplode(F.array(*columns)).alias("i", "v"))
    return {r["i"]: r for r in cells.groupBy("i").agg(*aggregates).collect()}


def slot_rows(sums: np.ndarray, slots: Iterable[int] | None = None) -> pa.RecordBatch:
    """A task's vectors, the rows of a matrix, as a batch of ``SLOTS``."""
    ends = np.arange(len(sums) + 1, dtype=np.int32) * sums.shape[1]
    names = np.arange(len(sums)) if slots is None else np.array(list(slots))
    flat = pa.ListArray.from_arrays(pa.array(ends), pa.array(sums.ravel().astype(float)))
    return pa.RecordBatch.from_arrays([pa.array(names.astype(np.int32)), flat], ["slot", "sums"])


def add_slots(told: DataFrame) -> dict[int, np.ndarray]:
    """The sum of each slot's vectors; slots are added up where a shuffle brings them, then collected."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, values in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = values.values.to_numpy()
                found[slot] = found[slot] + values if slot in found else values
        for slot, values in found.items():
            yield slot_rows(values[None, :], [slot])

    found = told.repartition("slot").mapInArrow(add, SLOTS).toArrow()
    sums = (values.values.to_numpy() for values in found.column("sums"))
    return dict(zip(found.column("slot").to_pylist(), sums))
