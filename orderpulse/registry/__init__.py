"""Every runnable query with its equivalent SQL, by area."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None = None


class Registry(dict[str, Entry]):
    """Collects the queries of one area."""

    def query(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def keep(fn: Query) -> Query:
            self[name] = Entry(fn, sql)
            return fn

        return keep


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double, so float summation order cannot show in a comparison."""
    return df.select(
        *[
            (F.round(F.col(name), digits) + F.lit(0.0)).alias(name) if kind == "double" else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def r(expr: str, alias: str, digits: int = 4) -> str:
    """The same rounding in SQL."""
    return f"round(({expr})::DOUBLE, {digits}) + 0.0::DOUBLE AS {alias}"


def everything() -> dict[str, Entry]:
    from orderpulse.registry import areas

    return areas.merged()
