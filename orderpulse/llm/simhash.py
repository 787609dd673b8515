"""Near-duplicates by SimHash: tiles of fingerprints compared exactly with exclusive-or and bit counts.

Equal fingerprints are folded into one first, so a group of copies of any size is one row from then on.  Distinct
fingerprints are laid into tiles; two tiles are compared in full with numpy, except that blocks of a tile whose
population counts differ by more than the radius are skipped, for then so do the fingerprints.  Only tiles that can hold
a link meet: with a radius of r, fingerprints cut into r + 1 bands agree in one band at least, so tiles are laid within
(band, value).  Nothing is lost, and the work stays far below all pairs.  A value with many fingerprints is cut into
several tiles, whose pairs are dealt over the tasks.  A pair of tiles yields one link per linked fingerprint, not one
per pair.  Components come from alternating star contraction, with every round written to the shared folder.

Edge cases: a missing text has no words and fingerprint zero, linked like any other; a missing document id takes part
but is never the smallest one, and a component without any id has none; repeated rows come back one by one; an empty
table gives no rows; other columns are ignored, and kept by :func:`drop_near_copies` whatever their names and types.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from orderpulse.sources.staging import stage

SHINGLE, SEED, BITS, RADIUS = 4, 42, 64, 4
#: Fingerprints in a tile on average, and rows of a tile that are compared at a time.
TILE, BLOCK = 2048, 256
#: Shingles hashed at a time.
STRIP = 1 << 16


# --- fingerprints ----------------------------------------------------------------------------------------------------


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """Bits that more than half of the shingles' hashes have set; bytes.split() cuts at 0x20 and 0x09-0x0D."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= size:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    whole = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    first = np.concatenate([[0], ends[:-size] + 1]).tolist()
    final = ends[size - 1 :].tolist()
    votes = np.zeros(BITS, np.int64)
    for i in range(0, len(first), STRIP):
        hashes = [
            xxhash.xxh64_intdigest(whole[a:z], SEED) for a, z in zip(first[i : i + STRIP], final[i : i + STRIP], strict=True)
        ]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(first), bitorder="little").view("<u8")[0])


def _printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(t.as_py()) for t in batch.column(2)], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints)], ["doc_id", "text_hash", "fp"])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``(doc_id, text_hash, fp)``, written to the shared folder; ``fp`` is the fingerprint as a signed long."""
    keyed = docs.select(F.col(key).cast("long"), F.xxhash64(text), F.col(text).cast("binary"))
    return stage(keyed.mapInArrow(_printed, "doc_id long, text_hash long, fp long"), "fingerprints")


# --- links -----------------------------------------------------------------------------------------------------------


def _labels(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest member of each one's component."""
    label = np.arange(count)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def tile_links(a: np.ndarray, b: np.ndarray | None, radius: int = RADIUS) -> np.ndarray:
    """Links that span the components of the graph "at most ``radius`` bits apart" between two tiles, or within one."""
    a = a[np.argsort(np.bitwise_count(a), kind="stable")]
    b = a if b is None else b[np.argsort(np.bitwise_count(b), kind="stable")]
    pop_a, pop_b = np.bitwise_count(a).astype(np.int64), np.bitwise_count(b).astype(np.int64)
    left, right = [], []
    for i in range(0, len(a), BLOCK):
        rows, pops = a[i : i + BLOCK], pop_a[i : i + BLOCK]
        # the other tile is in order of population count: what lies beyond the radius is skipped as a whole
        low, high = np.searchsorted(pop_b, pops[0] - radius), np.searchsorted(pop_b, pops[-1] + radius, side="right")
        if b is a:
            low = max(low, i)
        for j in range(low, high, TILE):
            near = np.bitwise_count(rows[:, None] ^ b[None, j : min(high, j + TILE)]) <= radius
            x, y = np.nonzero(near)
            left.append(x + i)
            right.append(y + j)
    if not left:
        return np.empty((0, 2), np.uint64)
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[: len(a)][np.concatenate(left)], place[len(a) :][np.concatenate(right)]
    label = _labels(len(nodes), x[x != y], y[x != y])
    own = np.flatnonzero(label != np.arange(len(nodes)))
    return np.stack([nodes[own], nodes[label[own]]], axis=1)


def _compared(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for one in batch.column(0):
                tiles = [np.array(t["fps"], np.int64).view(np.uint64) for t in one.as_py()]
                found.append(tile_links(tiles[0], tiles[1] if len(tiles) > 1 else None, radius))
            links = np.concatenate(found).view(np.int64) if found else np.empty((0, 2), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], ["a", "b"])

    return run


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Rows ``(a, b)`` over distinct fingerprints ``fp``: a spanning part of all links within the radius."""
    bands = radius + 1
    cut = [round(i * BITS / bands) for i in range(bands + 1)]
    band = F.array(
        *[
            F.struct(
                F.lit(i).alias("band"),
                F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1).cast("long")).alias("value"),
            )
            for i, (lo, hi) in enumerate(itertools.pairwise(cut))
        ]
    )
    dealt = prints.select("fp", F.inline(band))
    large = stage(dealt.groupBy("band", "value").count().where(F.col("count") > TILE), "large")
    sized = dealt.join(large, ["band", "value"], "left").withColumn("tiles", F.ceil(F.coalesce("count", F.lit(1)) / TILE))
    tiles = (
        sized.withColumn("tile", F.pmod(F.xxhash64("fp"), "tiles"))
        .groupBy("band", "value", "tiles", "tile")
        .agg(F.collect_list("fp").alias("fps"))
    )
    # each tile meets itself and every other tile of its value once
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    met = tiles.withColumn("other", other).select(
        "band", "value", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", "fps"
    )
    pairs = met.groupBy("band", "value", "i", "j").agg(F.collect_list(F.struct("tile", "fps")).alias("pair"))
    return pairs.where((F.col("i") != F.col("j")) | (F.size(F.col("pair")[0]["fps"]) > 1)).select("pair").mapInArrow(
        _compared(radius), "a long, b long"
    )


# --- components ------------------------------------------------------------------------------------------------------


def _starred(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation: every neighbour above (large) or below (small) a node is tied to the smallest around it."""
    if large:
        seen = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        seen = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    # written first, so that the join's shuffles read tables and a node with many links can be split
    least = stage(seen.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "least")
    tied = seen.join(least, "a")
    if large:
        out = tied.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        ends = F.array(*[F.struct(F.col(c).alias("a"), F.col("m").alias("b")) for c in ("a", "b")])
        out = tied.select(F.inline(ends))
    return stage(out.where("a != b").distinct(), "stars")


def connected(edges: DataFrame) -> DataFrame:
    """Rows ``(a, b)``: every node but the smallest of its component, and that smallest node."""
    state = lambda df: df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b") % 1_000_003)).first()
    edges = stage(edges.where("a != b").distinct(), "links")
    before = state(edges)
    while before[0]:
        edges = _starred(_starred(edges, large=True), large=False)
        after = state(edges)
        if after == before:
            break
        before = after
    return edges


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per document: ``doc_id, text_hash, fp, root, component_id`` (the smallest id reachable over links).

    ``root`` is the component's smallest fingerprint, which also tells components without any id apart.
    """
    printed = fingerprints(docs, key, text)
    distinct = stage(printed.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct")
    labels = connected(links(distinct, radius))
    # the root of a star stands for itself
    member = labels.select(F.col("a").alias("fp"), F.col("b").alias("root")).union(
        labels.select(F.col("b").alias("fp"), F.col("b").alias("root")).distinct()
    )
    member = stage(member.join(distinct, "fp"), "members")
    roots = stage(member.groupBy("root").agg(F.min("least_id").alias("component_id")), "roots")
    linked = stage(member.join(roots, "root").select("fp", "root", "component_id"), "linked")
    component = stage(
        distinct.join(linked, "fp", "left").select(
            "fp",
            F.coalesce("root", "fp").alias("root"),
            F.when(F.col("root").isNull(), F.col("least_id")).otherwise(F.col("component_id")).alias("component_id"),
        ),
        "components",
    )
    return printed.join(component, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def near_copy_digest(docs: DataFrame) -> DataFrame:
    """Fingerprint and component per document of a table with doc_id and text."""
    return near_copies(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component with all its columns: that with the smallest id, a missing id last.

    Copies of one id are told apart by their texts and then by their other columns, written as JSON.
    """
    found = near_copies(docs, key, text)
    # at most one row per task and component is shuffled
    best = found.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("text_hash"))).alias("k")
    )
    kept = stage(best.select(F.col("k.doc_id").alias("_id"), F.col("k.text_hash").alias("_hash")).distinct(), "kept")
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash"))
    # a row is one struct, so its names can't clash with those used here
    others = [F.col("row")[c].alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in (key, text)]
    told = F.to_json(F.struct(*others)) if others else F.lit("")
    packed = docs.select(F.struct("*").alias("row"), F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("hash"))
    first = W.partitionBy("id", "hash").orderBy(told)
    return packed.join(kept, same, "left_semi").withColumn("n", F.row_number().over(first)).where("n = 1").select("row.*")
