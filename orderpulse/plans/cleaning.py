"""From the master table to a complete, leak-free table, with its logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from orderpulse.operators import quality as qa


@dataclass
class Cleaned:
    table: DataFrame
    dropped: DataFrame
    sparse: dict[str, float]
    imputed: DataFrame
    rare: DataFrame | None


def clean_master(
    master: DataFrame,
    groups: Mapping[str, Sequence[str]] = qa.DROP_GROUPS,
    sparse_threshold: float = 0.15,
    categories: Sequence[str] = qa.CATEGORY_COLUMNS,
    rare_threshold: float = 0.01,
    label: str = "satisfecho",
    check: bool = True,
) -> Cleaned:
    """Drop listed and sparse columns, impute, bucket rare categories, verify.

    Fills and categories are fitted on all rows.  Buckets come after
    imputation, so the fill text can itself be bucketed.
    """
    kept, dropped = qa.drop_listed(master, groups)
    counts = qa.missing_counts(kept)
    sparse = qa.sparse_columns(kept, sparse_threshold, counts)
    dense = kept.drop(*sparse)
    fills = qa.fit_imputation(dense, missing=counts[1])
    filled = qa.apply_imputation(dense, fills)
    present = [c for c in categories if c in filled.columns]
    table = qa.bucket_rare(filled, present, rare_threshold)
    rare = qa.rare_log(filled, present, rare_threshold) if present else None
    if check:
        qa.require_invariants(table, label)
    return Cleaned(table, dropped, sparse, qa.imputation_log(dense, fills), rare)
