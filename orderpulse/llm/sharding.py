"""Weighted rendezvous sharding with DataFrame functions only.

Every record scores each shard with -weight / ln(u), u being a uniform number made of the MD5 of record key and shard
number, and goes to the shard with the highest score.  A further shard only takes the records whose score for it is the
highest, so no record moves between old shards, and a share of weight / total weight moves.

Within a shard, records are numbered without gaps in the order of a digest of the whole record.  Equal records are
counted first; ranges of the digest's leading digits then spread every shard, and a record key of which there are very
many, over the tasks.

Edge cases: a missing text has no bytes (size 1, CRC 0); a missing key is a key of its own; equal records come back one
by one with slots of their own; ties between shards, which need equal 53-bit numbers, go to the lowest number; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from orderpulse.sources.staging import stage

#: Distinct records that one range of a shard holds on average.
RANGE_ROWS = 20_000
#: Leading hexadecimal digits of the digest that make ranges, and of a hash that make a uniform number.
RANGE_DIGITS, HASH_DIGITS = 8, 13


def _uniform(digest: Column) -> Column:
    """A number strictly between 0 and 1 from 13 hexadecimal digits."""
    return (F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("double") + 0.5) / float(16**HASH_DIGITS)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The number of the shard with the highest score."""
    if any(w <= 0 for w in weights):
        raise ValueError("a shard's weight must be above 0")
    text = F.coalesce(key.cast("string"), F.lit("null"))
    scores = [
        F.struct((-float(w) / F.log(_uniform(F.md5(F.concat(text, F.lit(f"/{s}")))))).alias("score"), F.lit(-s).alias("low"))
        for s, w in enumerate(weights)
    ]
    return -F.array_max(F.array(*scores))["low"]


def assign_shards(
    docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Rows ``key, size, text_crc32, shard, slot`` and, with ``grown`` weights, ``grown_shard``."""
    bytes_of = F.coalesce(F.col(text), F.lit("")).cast("binary")
    records = (
        docs.select(
            key, (F.octet_length(bytes_of) + 1).cast("long").alias("size"), F.crc32(bytes_of).alias("text_crc32")
        )
        .groupBy(key, "size", "text_crc32")
        .agg(F.count("*").alias("_copies"))
    )
    placed = records.withColumns(
        {
            "shard": rendezvous(F.col(key), weights),
            "_digest": F.md5(F.concat_ws("/", F.coalesce(F.col(key).cast("string"), F.lit("null")), "text_crc32", "size")),
        }
        | ({"grown_shard": rendezvous(F.col(key), grown)} if grown else {})
    )
    placed = stage(placed, "placed")
    ranges = max(1, math.ceil(placed.count() / (RANGE_ROWS * len(weights))))
    first = F.conv(F.substring("_digest", 1, RANGE_DIGITS), 16, 10).cast("long")
    placed = placed.withColumn("_range", F.floor(first * ranges / 16**RANGE_DIGITS))
    totals = placed.groupBy("shard", "_range").agg(F.sum("_copies").alias("_n"))
    ahead = W.partitionBy("shard").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = stage(totals.select("shard", "_range", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before")), "offsets")
    inside = W.partitionBy("shard", "_range").orderBy("_digest", key).rowsBetween(W.unboundedPreceding, -1)
    started = placed.withColumn("_at", F.coalesce(F.sum("_copies").over(inside), F.lit(0))).join(offsets, ["shard", "_range"])
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1))
    return started.withColumn("_copy", copy).select(
        key,
        "size",
        "text_crc32",
        "shard",
        (F.col("_before") + F.col("_at") + F.col("_copy")).alias("slot"),
        *(["grown_shard"] if grown else []),
    )


def sharding_digest(docs: DataFrame, shards: int = 16) -> DataFrame:
    """All documents over equally weighted shards, and where one shard more would put them."""
    placed = assign_shards(docs, [1.0] * shards, [1.0] * (shards + 1))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
