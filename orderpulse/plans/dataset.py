"""From the cleaned table to split, encoded and scaled model features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from orderpulse.operators import preparation as pr, quality as qa
from orderpulse.sources.staging import stage


@dataclass
class Dataset:
    """One row per order: key, split, label and standardised features."""

    table: DataFrame
    features: list[str]
    label: str = "satisfecho"
    key: str = "order_id"

    def part(self, *splits: str) -> DataFrame:
        return self.table.where(F.col("split").isin(list(splits)))


def model_dataset(
    clean: DataFrame,
    cutoffs: Sequence[str] = pr.CUTOFFS,
    encoded: Sequence[str] = pr.ENCODED,
    ts: str = "order_purchase_timestamp",
    label: str = "satisfecho",
    key: str = "order_id",
) -> Dataset:
    """Repair, split by time, encode, scale on the training rows, drop left-over text.

    The result is staged once: selection and training read it many times.
    """
    repaired = qa.repair(clean, ts)
    split = pr.temporal_split(repaired, ts, cutoffs)
    encoded_rows = pr.target_encode(split, encoded, label)
    numbers = pr.numeric_columns(encoded_rows, exclude=(label, key))
    scaled = pr.standardize(encoded_rows, numbers)
    table = pr.drop_text(scaled, keep=("split", key)).drop(ts)
    table = table.select(key, "split", label, *numbers)
    return Dataset(stage(table, "dataset"), numbers, label, key)
