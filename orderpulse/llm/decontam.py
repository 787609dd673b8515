"""Benchmark decontamination with a distributed positional inverted index.

The corpus is dealt into shards of whole documents.  A shard's row holds, for every distinct word, the ascending word
positions at which it occurs (its postings); a gap of one position separates documents, so no phrase runs across them.
The index is written once to the shared folder and knows nothing of the benchmark.  A phrase is found by taking the
postings of its rarest word over the whole corpus, moved back by the word's offset, and intersecting them with the
moved postings of the next rarest word, until all words are used or nothing is left.

Words are known by the 64-bit XXH64 of their bytes.  The benchmark is searched in blocks whose size is checked, so what
the tasks hold of it has a bound however large the benchmark is.

Edge cases: a missing text has no words; a missing document id is kept as it is; a missing item id marks words but is
not listed among the items; equal items count once per id; repeated documents are searched and returned one by one;
empty tables give no rows, an empty benchmark no hits; other columns are ignored, and kept by
:func:`drop_contaminated` whatever their names.
"""

from __future__ import annotations

import itertools
import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Row, functions as F

from orderpulse.sources.staging import stage

#: Words in a shard after which it is closed; the last document stays whole.
SHARD_WORDS = 1 << 20
#: Bytes of benchmark text in a block on average.
BLOCK_BYTES = 8 << 20
WINDOW = 13

# fixed values: A-Z are lowered, other ASCII than 0-9 and a-z separates words
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

_INDEX_SCHEMA = (
    "shard string, doc_id array<long>, text_hash array<long>, n_words array<long>, terms binary, ends binary, positions binary"
)
_INDEX_ARROW = pa.schema(
    [
        ("shard", pa.string()),
        ("doc_id", pa.list_(pa.int64())),
        ("text_hash", pa.list_(pa.int64())),
        ("n_words", pa.list_(pa.int64())),
        ("terms", pa.binary()),
        ("ends", pa.binary()),
        ("positions", pa.binary()),
    ]
)
_HITS_ARROW = pa.schema(
    [
        ("shard", pa.string()),
        ("place", pa.int64()),
        ("starts", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int64())),
        ("items", pa.list_(pa.string())),
    ]
)


def words_of(text: bytes | None) -> np.ndarray:
    """Hashes of the words of a text, in order."""
    words = (text or b"").translate(_FOLD).split()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


# --- the index -------------------------------------------------------------------------------------------------------


def invert(parts: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms, the end of each one's postings, and all postings, for documents laid out with a gap of one."""
    words = np.concatenate([*parts, np.empty(0, np.uint64)])
    sizes = np.array([len(p) for p in parts], np.int64)
    place = np.arange(len(words)) + np.repeat(np.arange(len(parts)), sizes)
    order = np.argsort(words, kind="stable")
    ordered = words[order]
    last = np.flatnonzero(np.append(ordered[1:] != ordered[:-1], True)) if len(words) else np.empty(0, np.int64)
    return ordered[last], (last + 1).astype(np.uint32), place[order].astype(np.uint32)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids: list = []
    hashes: list = []
    parts: list[np.ndarray] = []
    size = 0

    def close() -> pa.RecordBatch:
        terms, ends, positions = invert(parts)
        # a task that runs again names its shards anew; only one run's rows are kept
        row = {
            "shard": [uuid.uuid4().hex],
            "doc_id": [ids],
            "text_hash": [hashes],
            "n_words": [[len(p) for p in parts]],
            "terms": [terms.tobytes()],
            "ends": [ends.tobytes()],
            "positions": [positions.tobytes()],
        }
        return pa.RecordBatch.from_pydict(row, _INDEX_ARROW)

    for batch in batches:
        for key, digest, text in zip(*[batch.column(i) for i in range(3)], strict=True):
            found = words_of(text.as_py())
            ids.append(key.as_py())
            hashes.append(digest.as_py())
            parts.append(found)
            size += len(found)
            if size >= SHARD_WORDS:
                yield close()
                ids, hashes, parts, size = [], [], [], 0
    if ids:
        yield close()


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the positional index of a corpus to the shared folder; one row per shard."""
    keyed = docs.select(F.col(key).cast("long"), F.xxhash64(text), F.col(text).cast("binary"))
    return stage(keyed.mapInArrow(_shards, _INDEX_SCHEMA), "postings")


class Shard:
    """Postings of one row of the index."""

    def __init__(self, row: dict) -> None:
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.ends = np.frombuffer(row["ends"], np.uint32)
        self.positions = np.frombuffer(row["positions"], np.uint32) if "positions" in row else None
        if "n_words" in row:
            self.sizes = np.array(row["n_words"], np.int64)
            self.starts = np.cumsum(self.sizes + 1) - self.sizes - 1

    def slots(self, terms: np.ndarray) -> np.ndarray:
        """The place of each term in the shard's list, -1 if it has none."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def postings(self, slot: int) -> np.ndarray:
        return self.positions[self.ends[slot - 1] if slot else 0 : self.ends[slot]].astype(np.int64)

    def document(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, position, side="right") - 1


def _member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return among[at] == values


def phrase_starts(shard: Shard, slots: np.ndarray, order: Sequence[int]) -> np.ndarray:
    """Positions at which the words with these slots follow one another; ``order`` has the rarest word first."""
    starts = None
    for offset in order:
        postings = shard.postings(slots[offset])
        starts = postings - offset if starts is None else starts[_member(starts + offset, postings)]
        if not len(starts):
            break
    return starts


# --- phrases ---------------------------------------------------------------------------------------------------------


def windows(items: Iterable[Row], size: int = WINDOW) -> dict[tuple[int, ...], set[str | None]]:
    """Every window of item words with the ids of the items that have it; a shorter item is one window."""
    out: dict[tuple[int, ...], set[str | None]] = defaultdict(set)
    for item in items:
        found = words_of(item["text"]).tolist()
        for i in range(max(1, len(found) - size + 1)) if found else ():
            out[tuple(found[i : i + size])].add(item["item"])
    return out


def _document_counts(index: DataFrame, terms: np.ndarray) -> dict[int, int]:
    """Occurrences of each term in the whole corpus, read without the postings."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row)
                slots = shard.slots(terms)
                sizes = np.diff(shard.ends.astype(np.int64), prepend=0)
                total[slots >= 0] += sizes[slots[slots >= 0]]
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total)), pa.array(total[total > 0])], ["t", "n"])

    rows = index.select("terms", "ends").mapInArrow(count, "t long, n long").groupBy("t").agg(F.sum("n").alias("n"))
    return {int(terms[r["t"]]): r["n"] for r in rows.collect()}  # at most the words of one block


def phrase_hits(index: DataFrame, items: Sequence[Row], size: int = WINDOW) -> DataFrame:
    """Per document with a match: ``shard, place, starts, ends`` of matched word ranges (end exclusive) and ``items``."""
    found = windows(items, size)
    terms = np.array(sorted({t for w in found for t in w}), np.uint64)
    counts = _document_counts(index, terms)
    # windows with a word that the corpus lacks can't match; the others list their rarest words first
    plan = [
        (np.searchsorted(terms, np.array(w, np.uint64)), sorted(range(len(w)), key=lambda i: counts[w[i]]), sorted(ids, key=str))
        for w, ids in found.items()
        if all(t in counts for t in w)
    ]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row)
                slots = shard.slots(terms)
                marks = np.zeros(int(shard.sizes.sum()) + len(shard.sizes) + 1, np.int32)
                owners: dict[int, set] = defaultdict(set)
                for window, order, ids in plan:
                    own = slots[window]
                    if (own < 0).any():
                        continue
                    starts = phrase_starts(shard, own, order)
                    if len(starts):
                        np.add.at(marks, starts, 1)
                        np.add.at(marks, starts + len(window), -1)
                        for place in np.unique(shard.document(starts)).tolist():
                            owners[place].update(ids)
                if owners:
                    hit = np.cumsum(marks) > 0
                    edge = np.flatnonzero(np.diff(hit, prepend=False, append=False)).reshape(-1, 2)
                    of = shard.document(edge[:, 0])
                    out: dict[str, list] = {n: [] for n in _HITS_ARROW.names}
                    for place, ids in owners.items():
                        own = edge[of == place] - shard.starts[place]
                        out["shard"].append(row["shard"])
                        out["place"].append(place)
                        out["starts"].append(own[:, 0])
                        out["ends"].append(own[:, 1])
                        out["items"].append([i for i in ids if i is not None])
                    yield pa.RecordBatch.from_pydict(out, _HITS_ARROW)

    return index.select("shard", "n_words", "terms", "ends", "positions").mapInArrow(
        search, "shard string, place long, starts array<long>, ends array<long>, items array<string>"
    )


def item_blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> Iterator[list[Row]]:
    """The benchmark's distinct rows in blocks of about ``BLOCK_BYTES`` of text; every one is in one block."""
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).cast("binary").alias("text")).where("text IS NOT NULL")
    # copies of a row would all fall into one block
    rows = stage(rows.distinct(), "items")
    size = rows.agg(F.sum(F.length("text") + 8)).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    for b in range(blocks):
        yield rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()


def contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, text_hash, n_words, n_hit, items`` (sorted), over all blocks of the benchmark."""
    index = build_index(docs, key, text)
    # written before the next block is collected, so the driver holds one block and its windows
    hits = [stage(phrase_hits(index, block, size), "hits") for block in item_blocks(benchmark)]
    places = index.select("shard", F.posexplode(F.arrays_zip("doc_id", "text_hash", "n_words")).alias("place", "d")).select(
        "shard", F.col("place").cast("long").alias("place"), "d.*"
    )
    if not hits:
        none = F.array().cast("array<string>")
        return places.select("doc_id", "text_hash", "n_words", F.lit(0).cast("long").alias("n_hit"), none.alias("items"))
    every = _union(hits)
    # ranges found in different blocks may overlap: count what each adds beyond those before it
    ranges = F.array_sort(F.flatten(F.collect_list(F.arrays_zip("starts", "ends"))))
    start = F.struct(F.lit(0).cast("long").alias("reach"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(
        "ranges",
        start,
        lambda a, r: F.struct(
            F.greatest(a["reach"], r["ends"]).alias("reach"),
            (a["n"] + F.greatest(F.lit(0).cast("long"), r["ends"] - F.greatest(r["starts"], a["reach"]))).alias("n"),
        ),
        lambda a: a["n"],
    )
    merged = (
        every.groupBy("shard", "place")
        .agg(ranges.alias("ranges"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        .select("shard", "place", covered.alias("n_hit"), "items")
    )
    joined = places.join(merged, ["shard", "place"], "left")
    return joined.select(
        "doc_id",
        "text_hash",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for one in frames[1:]:
        out = out.unionByName(one)
    return out


CONTAMINATED = "n_hit > 0 AND 20 * n_hit >= n_words"


def contamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Counts per document of a table with doc_id and text, against items with item_id and text."""
    return contamination(docs, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        F.expr(CONTAMINATED).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents whose hit words are fewer than one in twenty, with all their columns."""
    bad = contamination(docs, benchmark, key=key, text=text).where(CONTAMINATED)
    bad = stage(bad.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "contaminated")
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash"))
    # a row is one struct, so its names can't clash with those used here
    packed = docs.select(F.struct("*").alias("row"), F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("hash"))
    return packed.join(bad, same, "left_anti").select("row.*")


# --- proximity -------------------------------------------------------------------------------------------------------


def proximity_matches(index: DataFrame, queries: Sequence[tuple[str, str]], within: int) -> DataFrame:
    """Rows ``(query, doc_id, position)``: occurrences of a query's rarest word (ties: the first in the query) near
    which, at most ``within`` words away in the same document, every other word of the query occurs.

    ``queries`` are (name, text) pairs; a query without words matches nothing.
    """
    parsed = [(name, list(dict.fromkeys(words_of(text.encode()).tolist()))) for name, text in queries]
    terms = np.array(sorted({t for _, ws in parsed for t in ws}), np.uint64)
    counts = _document_counts(index, terms)
    plan = [
        (name, np.searchsorted(terms, np.array(sorted(ws, key=lambda t: counts[t]), np.uint64)))
        for name, ws in parsed
        if ws and all(t in counts for t in ws)
    ]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in itertools.chain.from_iterable(b.to_pylist() for b in batches):
            shard = Shard(row)
            slots = shard.slots(terms)
            for name, words in plan:
                own = slots[words]
                if (own < 0).any():
                    continue
                at = shard.postings(own[0])
                for slot in own[1:]:
                    postings = shard.postings(slot)
                    of = shard.document(at)
                    first = np.maximum(at - within, shard.starts[of])
                    final = np.minimum(at + within, shard.starts[of] + shard.sizes[of] - 1)
                    at = at[np.searchsorted(postings, first) < np.searchsorted(postings, final, side="right")]
                of = shard.document(at)
                if len(at):
                    ids = [row["doc_id"][d] for d in of]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(at)), pa.array(ids, pa.int64()), pa.array(at - shard.starts[of])],
                        ["query", "doc_id", "position"],
                    )

    return index.mapInArrow(search, "query string, doc_id long, position long")


DECONTAMINATION_SQL = rf"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
    v AS (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') AS phrase
        FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - {WINDOW} + 2))) AS i FROM b WHERE len(w) > 0)),
    o AS (SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM
        (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM v) WHERE len(w) >= n)),
    m AS (SELECT rid, i, n, item_id FROM o JOIN v USING (n, phrase)),
    h AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM m) GROUP BY rid),
    t AS (SELECT rid, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS names
        FROM (SELECT DISTINCT rid, item_id::VARCHAR AS x FROM m) GROUP BY rid)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
        sha256(coalesce(names, '')) AS items_sha256,
        coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN h USING (rid) LEFT JOIN t USING (rid)"""
