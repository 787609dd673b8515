"""All areas in one listing."""

from __future__ import annotations

from orderpulse.registry import (
    Entry, evaluation, exploration, models, orders, preparation, quality, selection, tables,
)


def merged() -> dict[str, Entry]:
    out: dict[str, Entry] = {}
    for area in (tables, exploration, orders, quality, preparation, selection, evaluation, models):
        overlap = out.keys() & area.Q.keys()
        if overlap:
            raise ValueError(f"query names used twice: {sorted(overlap)}")
        out |= area.Q
    return out
