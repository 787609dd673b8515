"""Frames that several queries start from.

Nothing is remembered between queries: each pays for its own inputs and sees
the files as they are.  A query that reads its frame several times stages the
columns it needs; the others leave pruning to the optimizer.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from orderpulse.operators import features as ft, quality as qa
from orderpulse.plans import cleaning, dataset, master
from orderpulse.sources import star
from orderpulse.sources.staging import stage

def features(spark: SparkSession, folder: str) -> DataFrame:
    """Order features before winsorising, built anew."""
    tables = star.roles(spark, folder)
    return master.order_features(tables, tables["regions"], star.HIGH_RISK)


def staged_features(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The same, written once for a query that reads it several times."""
    return stage(features(spark, folder).select(*(columns or ["*"])), "features")


def explored(spark: SparkSession, folder: str) -> DataFrame:
    """Every order with the exploration variant of the features, built anew."""
    return ft.add_exploratory_features(master.exploratory_master(star.roles(spark, folder)))


def staged_explored(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The named columns of it, written once for a query that reads them several times."""
    return stage(explored(spark, folder).select(*columns), "explored")


def cleaned(spark: SparkSession, folder: str) -> cleaning.Cleaned:
    """The winsorised features after cleaning; the columns that it drops are dropped before they are written."""
    kept, dropped = qa.drop_listed(features(spark, folder))
    return replace(cleaning.clean_master(ft.winsorize(stage(kept, "features"))), dropped=dropped)


def model_data(spark: SparkSession, folder: str) -> dataset.Dataset:
    """Split, encoded and scaled features, written for the query that asks."""
    return dataset.model_dataset(cleaned(spark, folder).table, star.CUTOFFS)
