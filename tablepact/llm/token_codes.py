"""Token files with directly addressable codes.

A block holds whole documents in id order. Token ids are cut into chunks of eight bits, one
level a chunk; a bitmap beside each level says which values go on, and a rank directory
(set bits before every 512th) finds a value's place in the next level. So any token is read
by a few array look-ups, without decoding the block.

Block layout, little-endian: ``DAC1``, documents (u4), tokens (u8), levels (u4); per
document its id (i8), 1 if the id is not null (u1), its number of tokens (u4); per level the number of
values (u8), the chunks (u1 each), the bitmap (padded to bytes), the rank directory (u4 each).
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import int64, piece_coder

MAGIC, HEAD, RANK = b"DAC1", struct.Struct("<4sIQI"), 512
BLOCK_SCHEMA = "shard long, block int, first_token long, n_tokens long, payload binary"


def encode_block(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    levels, values = [], ids.astype(np.uint32)
    while True:
        more = values > 255
        bits = np.packbits(more, bitorder="little")
        before = np.concatenate([[0], np.cumsum(more)])[: len(values) + 1 : RANK].astype("<u4")
        levels.append(struct.pack("<Q", len(values)) + (values & 255).astype(np.uint8).tobytes() + bits.tobytes() + before.tobytes())
        if not more.any():
            break
        values = values[more] >> 8
    return b"".join([
        HEAD.pack(MAGIC, len(doc_ids), len(ids), len(levels)), np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is not None for d in doc_ids], "u1").tobytes(), np.array(lengths, "<u4").tobytes(), *levels])


class Block:
    """A block's parts, as views of its bytes."""

    def __init__(self, payload: bytes):
        magic, n, self.n_tokens, n_levels = HEAD.unpack_from(payload)
        if magic != MAGIC:
            raise ValueError("not a token block")
        at = HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(payload, kind, count, at)
            at += got.nbytes
            return got

        ids, known, self.lengths = take("<i8", n), take("u1", n), take("<u4", n)
        self.doc_ids = [int(d) if k else None for d, k in zip(ids, known, strict=True)]
        self.levels = []
        for _ in range(n_levels):
            (count,) = take("<u8", 1)
            count = int(count)
            self.levels.append((take("u1", count), take("u1", -(-count // 8)), take("<u4", count // RANK + 1)))

    def token(self, i: int) -> int:
        """The ``i``-th id, without decoding others."""
        value = 0
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * k)
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            start = i // RANK * RANK
            ones = np.unpackbits(bits[start // 8 : (i >> 3) + 1], bitorder="little")[: i - start]
            i = int(ranks[i // RANK]) + int(ones.sum())
        return value

    def tokens(self) -> np.ndarray:
        values = None
        for chunks, bits, _ in reversed(self.levels):
            here = chunks.astype("<u4")
            if values is not None:
                here[np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)] |= values << np.uint32(8)
            values = here
        return values


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, block_tokens: int = 1 << 20) -> None:
    """Tokenise every text and write blocks under ``path``, documents in ascending ``doc_id`` order.

    Null texts are empty; every document ends with ``end_id``. Null ids come first, rows with
    equal ids follow one another, ordered by text. A shard is what one task wrote, named by its first id (the
    smallest long for null); its blocks number the tokens before them, so a reader
    needs only one total a shard. Blocks hold about ``block_tokens`` tokens and at least one
    document. Other columns are not read; an empty table writes no block.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = piece_coder(tokenizer, "spaces"), np.array([end_id], "<u4").tobytes()
        shard, block, first, size = None, 0, 0, 0
        docs: list[int | None] = []
        parts: list[bytes] = []

        def flush() -> pa.RecordBatch:
            nonlocal block, first, size, docs, parts
            payload = encode_block(docs, [len(p) // 4 for p in parts], np.frombuffer(b"".join(parts), "<u4"))
            row = {"shard": [shard], "block": [block], "first_token": [first], "n_tokens": [size], "payload": [payload]}
            block, first, size, docs, parts = block + 1, first + size, 0, [], []
            types = {"shard": pa.int64(), "block": pa.int32(), "first_token": pa.int64(), "n_tokens": pa.int64(), "payload": pa.binary()}
            return pa.RecordBatch.from_arrays([pa.array(row[k], t) for k, t in types.items()], names=list(types))

        for batch in batches:
            for doc, ids in zip(batch["doc_id"].to_pylist(), coder.ids(batch["text"].to_pylist()), strict=True):
                shard = (-(1 << 63) if doc is None else doc) if shard is None else shard
                docs.append(doc)
                parts.append(ids + end)
                size += len(ids) // 4 + 1
                if size >= block_tokens:
                    yield flush()
        if docs:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(encode, BLOCK_SCHEMA).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every document of a written set; ``ids`` is little-endian u4."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, payload in zip(int64(batch["first_token"]), batch["payload"].to_pylist(), strict=True):
                block = Block(payload)
                raw, ends = block.tokens().tobytes(), np.cumsum(block.lengths, dtype=np.int64)
                starts = ends - block.lengths
                for at in range(0, len(ends), 1024):
                    s, e = starts[at : at + 1024], ends[at : at + 1024]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(block.doc_ids[at : at + 1024], pa.int64()), pa.array(first + s), pa.array(e - s),
                         pa.array([raw[4 * a : 4 * b] for a, b in zip(s, e, strict=True)], pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"])

    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    # One row a shard, so at most as many as the writer had tasks: small enough to broadcast.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    placed = blocks.select("shard", "first_token", "payload").join(F.broadcast(shards), "shard").select(
        (F.col("before") + F.col("first_token")).alias("first_token"), "payload")
    return placed.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")
