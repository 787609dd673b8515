"""Token ids in wavelet matrices: one compressed file image per shard, with access, counts and occurrences.

A wavelet matrix keeps one bit-plane per bit of an id, the highest first.  Each plane holds that bit of every token in
the order that the planes above leave: all tokens with a zero before all tokens with a one, otherwise unmoved.  Following
one position, or one id's range, down the planes with rank (ones before a position) answers access and counting;
following it up with select answers where an id occurs.  Planes are cut into blocks that are compressed one by one, with
the rank at every block's start, so a lookup opens the blocks it needs only.

Documents are range-partitioned and sorted by id, encoded where they then lie, and dealt into shards of whole documents.
A shard is one row of a Parquet table in the shared folder, for executors reach that folder through Spark's writers
alone; its ``image`` is self-contained.

Ids are those of the library as it is loaded, without ``add_special_tokens``: the text of an added token (``<|endoftext|>``)
becomes that token's id.

Edge cases: a missing text is empty and has only its end id; a missing document id sorts first; documents with one id
are ordered by a hash of their texts; repeated rows are encoded one by one; an empty table gives no shard and no rows;
other columns are ignored.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from orderpulse.sources.staging import stage

BITS = 16
#: Tokens after which a shard is closed; the last document stays whole.
SHARD_TOKENS = 1 << 20
#: Bytes of a plane that are compressed together.
BLOCK = 1 << 16
#: Words whose ids a worker keeps; words joined for one call of the library; texts encoded together.
REMEMBERED, JOINED, BATCH = 500_000, 200, 2_000
END_ID = 2

_MAGIC = b"WMX1"
_HEAD = struct.Struct("<4sIQQQ")


# --- the matrix ------------------------------------------------------------------------------------------------------


def _part(values: pa.Array, bits: np.ndarray) -> pa.Array:
    """Values with a zero bit, then those with a one, otherwise in order."""
    mask = pa.BooleanArray.from_buffers(pa.bool_(), len(values), [None, pa.py_buffer(np.packbits(bits, bitorder="little"))])
    return pa.concat_arrays([pc.filter(values, pc.invert(mask)), pc.filter(values, mask)])


def write_image(ids: np.ndarray, doc_ids: list[int | None], sizes: list[int]) -> bytes:
    """The file image of one shard.

    Layout: magic, bits, tokens, length of the document table, length of the plane table; then the tables (JSON,
    compressed) and the blocks.  The plane table has, per plane, its zeros, and per block the ones before it and its
    place and length among the blocks.
    """
    pack = zstandard.ZstdCompressor(level=1).compress
    planes, blocks, at = [], [], 0
    values = pa.array(ids.astype(np.uint16))
    for level in range(BITS - 1, -1, -1):
        bits = ((values.to_numpy(zero_copy_only=True) >> level) & 1).astype(bool)
        packed = np.packbits(bits, bitorder="little")
        ones = 0
        plane = {"zeros": int(len(bits) - bits.sum()), "blocks": []}
        for i in range(0, len(packed), BLOCK):
            raw = packed[i : i + BLOCK]
            block = pack(raw.tobytes())
            plane["blocks"].append((ones, at, len(block)))
            ones += int(np.bitwise_count(raw).sum())
            at += len(block)
            blocks.append(block)
        planes.append(plane)
        values = _part(values, bits)
    documents = pack(json.dumps([doc_ids, sizes]).encode())
    table = pack(json.dumps(planes).encode())
    return b"".join([_HEAD.pack(_MAGIC, BITS, len(ids), len(documents), len(table)), documents, table, *blocks])


class WaveletMatrix:
    """Answers from one shard's image."""

    def __init__(self, image: bytes) -> None:
        magic, self.bits, self.size, documents, table = _HEAD.unpack_from(image)
        if magic != _MAGIC:
            raise ValueError("not a shard image")
        unpack = zstandard.ZstdDecompressor().decompress
        at = _HEAD.size
        self.doc_ids, self.sizes = json.loads(unpack(image[at : at + documents]))
        self.planes = json.loads(unpack(image[at + documents : at + documents + table]))
        self._image, self._blocks = image, at + documents + table
        self._block = functools.lru_cache(maxsize=64)(self._open)

    def _open(self, level: int, block: int) -> np.ndarray:
        _, at, length = self.planes[level]["blocks"][block]
        raw = zstandard.ZstdDecompressor().decompress(self._image[self._blocks + at : self._blocks + at + length])
        return np.frombuffer(raw, np.uint8)

    def _bit(self, level: int, i: int) -> int:
        block, rest = divmod(i, 8 * BLOCK)
        return int(self._block(level, block)[rest >> 3]) >> (rest & 7) & 1

    def _rank(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        if i == 0:
            return 0
        block, rest = divmod(i - 1, 8 * BLOCK)
        raw = self._block(level, block)
        whole, part = divmod(rest + 1, 8)
        ones = self.planes[level]["blocks"][block][0] + int(np.bitwise_count(raw[:whole]).sum())
        return ones + ((int(raw[whole]) & ((1 << part) - 1)).bit_count() if part else 0)

    def _plane(self, level: int) -> np.ndarray:
        packed = [self._open(level, b) for b in range(len(self.planes[level]["blocks"]))]
        return np.unpackbits(np.concatenate([*packed, np.empty(0, np.uint8)]), count=self.size, bitorder="little").astype(bool)

    def access(self, i: int) -> int:
        """The token at position i."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        out = 0
        for level in range(self.bits):
            bit, ones = self._bit(level, i), self._rank(level, i)
            out = out << 1 | bit
            i = self.planes[level]["zeros"] + ones if bit else i - ones
        return out

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        """Where the last order has the token's occurrences among positions from low to high."""
        if not 0 <= token < 1 << self.bits:
            return 0, 0
        for level in range(self.bits):
            a, z = self._rank(level, low), self._rank(level, high)
            one = token >> (self.bits - 1 - level) & 1
            low, high = (self.planes[level]["zeros"] + a, self.planes[level]["zeros"] + z) if one else (low - a, high - z)
        return low, high

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """Occurrences of a token from position low up to high."""
        high = self.size if high is None else min(high, self.size)
        low, high = self._range(token, min(max(low, 0), high), high)
        return high - low

    def occurrences(self, token: int) -> np.ndarray:
        """All positions of a token, ascending."""
        low, high = self._range(token, 0, self.size)
        at = np.arange(low, high)
        for level in range(self.bits - 1, -1, -1):
            if not len(at):
                break
            bits, zeros = self._plane(level), self.planes[level]["zeros"]
            one = token >> (self.bits - 1 - level) & 1
            at = np.flatnonzero(bits)[at - zeros] if one else np.flatnonzero(~bits)[at]
        return np.sort(at)

    def decode(self) -> np.ndarray:
        """All tokens in order: the planes are undone from the last to the first."""
        values = np.zeros(self.size, np.uint16)
        for level in range(self.bits - 1, -1, -1):
            bits, zeros = self._plane(level), self.planes[level]["zeros"]
            earlier = np.empty_like(values)
            earlier[~bits] = values[:zeros]
            earlier[bits] = values[zeros:] | np.uint16(1 << (self.bits - 1 - level))
            values = earlier
        return values


# --- encoding --------------------------------------------------------------------------------------------------------

#: Texts of these characters only are cut into words here, by the tokenizer's own pattern written out for them.
_L = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(rf"[\t\n\r -~{_L}×÷¿¡]*")
_WORDS = re.compile(rf" ?[{_L}]+| ?[0-9]+|'(?:[stmd]|re|ve|ll)| ?[^\s{_L}0-9]+|\s+(?!\S)|\s+")


class Encoder:
    """Encodes with the library, each distinct word once: words are what the tokenizer merges within."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        # the library cuts these out of a text before words are told apart
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        names = {i: t for t, i in self.library.get_vocab().items()}
        if max(names) >= 1 << BITS:
            raise ValueError(f"ids need more than {BITS} bits")
        # in byte-level vocabularies this letter stands for a space: only a word's first id can start with it
        self.spaced = np.array([names.get(i, "").startswith("Ġ") for i in range(max(names) + 1)])
        self.known: dict[str, bytes] = {}

    def _holds_added(self, text: str) -> bool:
        return any(a in text for a in self.added)

    def _each(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u2").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        joint = [w for w in words if len(w) > 1 and w[0] == " " and w[1].isalpha()]
        rest = [w for w in words if not (len(w) > 1 and w[0] == " " and w[1].isalpha())]
        groups = [joint[i : i + JOINED] for i in range(0, len(joint), JOINED)]
        for group, ids in zip(groups, self._each(["".join(g) for g in groups]), strict=True):
            flat = np.frombuffer(ids, "<u2")
            starts = np.flatnonzero(self.spaced[flat])
            if len(starts) == len(group) and not starts[0] and not self._holds_added("".join(group)):
                ends = 2 * np.append(starts[1:], len(flat))
                self.known.update(zip(group, (ids[a:z] for a, z in zip(2 * starts, ends, strict=True)), strict=True))
            else:
                rest += group
        self.known.update(zip(rest, self._each(rest), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 16-bit bytes."""
        cut = [_WORDS.findall(t) if _PLAIN.fullmatch(t) and not self._holds_added(t) else None for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        self._learn([w for w in set().union(*[c for c in cut if c is not None]) if w not in self.known])
        whole = iter(self._each([t for t, c in zip(texts, cut, strict=True) if c is None]))
        known = self.known
        return [next(whole) if c is None else b"".join([known[w] for w in c]) for c in cut]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# --- shards ----------------------------------------------------------------------------------------------------------


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode documents in ascending id order; rows ``part, seq, n_docs, n_tokens, image``, in order of part and seq."""
    end = np.array([END_ID], "<u2").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = encoder(path), TaskContext.get().partitionId()
        sequence = itertools.count()
        ids: list = []
        parts: list[bytes] = []

        def close() -> pa.RecordBatch:
            sizes = [len(p) // 2 for p in parts]
            row = [part], [next(sequence)], [len(ids)], [sum(sizes)]
            image = write_image(np.frombuffer(b"".join(parts), "<u2"), ids, sizes)
            columns = [pa.array(c, pa.int64()) for c in row] + [pa.array([image], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["part", "seq", "n_docs", "n_tokens", "image"])

        size = 0
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH):
                keys = batch.column(0).slice(i, BATCH).to_pylist()
                texts = [t or "" for t in batch.column(1).slice(i, BATCH).to_pylist()]
                for k, found in zip(keys, own.encode(texts), strict=True):
                    ids.append(k)
                    parts.append(found + end)
                    size += len(found) // 2 + 1
                    if size >= SHARD_TOKENS:
                        yield close()
                        ids, parts, size = [], [], 0
        if ids:
            yield close()

    # the last key parts rows that are equal in everything, so no value fills a partition
    keyed = docs.select(
        F.col(key).cast("long").alias("k"), F.col(text).alias("t"), F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("r")
    )
    ordered = keyed.repartitionByRange("k", "h", "r").sortWithinPartitions("k", "h", "r").select("k", "t")
    return stage(ordered.mapInArrow(run, "part long, seq long, n_docs long, n_tokens long, image binary"), "shards")


def _starts(shards: DataFrame) -> DataFrame:
    """Tokens before each shard: one row per shard, added up over parts and then within each."""
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # as many rows as the table was written in partitions
    parts = totals.select("part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("b"))
    inside = W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    local = shards.select("part", "seq", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("l"))
    return stage(local.join(parts, "part").select("part", "seq", (F.col("b") + F.col("l")).alias("before")), "starts")


def read_documents(shards: DataFrame) -> DataFrame:
    """Rows ``doc_id, start, n_tokens, ids_crc32``, all from the shards' images."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, image in zip(*[batch.column(i) for i in range(3)], strict=True):
                matrix = WaveletMatrix(image.as_py())
                ids = matrix.decode().astype("<u4")
                sizes = np.array(matrix.sizes, np.int64)
                ends = np.cumsum(sizes)
                crcs = [zlib.crc32(ids[a:z].tobytes()) for a, z in zip(ends - sizes, ends, strict=True)]
                n = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, part.as_py())),
                        pa.array(np.full(n, seq.as_py())),
                        pa.array(matrix.doc_ids, pa.int64()),
                        pa.array(ends - sizes),
                        pa.array(sizes),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["part", "seq", "doc_id", "local", "n_tokens", "ids_crc32"],
                )

    rows = shards.select("part", "seq", "image").mapInArrow(
        run, "part long, seq long, doc_id long, local long, n_tokens long, ids_crc32 long"
    )
    return rows.join(_starts(shards), ["part", "seq"]).select(
        "doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def find_token(shards: DataFrame, token: int) -> DataFrame:
    """Rows ``doc_id, position``: every place of a token, counted from the start of the whole sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, image in zip(*[batch.column(i) for i in range(3)], strict=True):
                matrix = WaveletMatrix(image.as_py())
                at = matrix.occurrences(token)
                of = np.searchsorted(np.cumsum(matrix.sizes), at, side="right")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(at), part.as_py())),
                        pa.array(np.full(len(at), seq.as_py())),
                        pa.array([matrix.doc_ids[d] for d in of], pa.int64()),
                        pa.array(at.astype(np.int64)),
                    ],
                    ["part", "seq", "doc_id", "local"],
                )

    rows = shards.select("part", "seq", "image").mapInArrow(run, "part long, seq long, doc_id long, local long")
    return rows.join(_starts(shards), ["part", "seq"]).select("doc_id", (F.col("before") + F.col("local")).alias("position"))


def token_digest(docs: DataFrame, path: str) -> DataFrame:
    """Encode documents, write the shards and tell each document's place, size and CRC as read back."""
    return read_documents(write_shards(docs, path))
