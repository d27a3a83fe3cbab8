"""Packing documents into fixed windows, in order, by dynamic programming.

Documents are laid end to end in ``doc_id`` order or by a given column. Cuts cost nothing at a document's end, a
little at a sentence's end, more elsewhere; a window costs its padding. The cheapest series of
cuts follows from ``best(j) = cost(j) + min over i in reach of (best(i) + i) + window - j``, whose
minimum over the sliding reach is kept in a monotone queue: linear time.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import piece_coder

PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
                "copy long, ids binary")


def best_cuts(places: list[int], costs: list[float], window: int) -> list[int]:
    """Cheapest cut places up to the last one. ``places`` ascend from 0, no gap exceeds ``window``."""
    # Of a place: its best cost and itself, which is all that later places compare. ``queue``: places in reach, ascending in it.
    least, back = [0.0] * len(places), [0] * len(places)
    queue = deque([0])
    drop, undo, add = queue.popleft, queue.pop, queue.append
    for j in range(1, len(places)):
        i, reach = queue[0], places[j] - window
        while places[i] < reach:
            drop()
            i = queue[0]
        back[j] = i
        least[j] = key = costs[j] + least[i] + window
        while queue and least[queue[-1]] >= key:
            undo()
        add(j)
    cuts, j = [], len(places) - 1
    while j:
        cuts.append(places[j])
        j = back[j]
    return cuts[::-1]


def powers_of_two(n: int) -> list[int]:
    """``n`` as a falling sum of powers of two."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, window: int = 4096, sentence_cost: float = 4.0, word_cost: float = 16.0,
         hard_every: int = 16, block_windows: int = 64, order: str | None = None) -> DataFrame:
    """Pieces of all documents: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, copy, ids``.

    Each text's ids plus ``end_id`` are cut into pieces; a sequence holds at most ``window`` ids, without
    gaps. Tasks pack ranges of ``doc_id``, or of the column ``order`` if given, on their own; what is left at a range's end goes into sequences whose
    lengths are powers of two, which need no padding. Null texts are empty (one id), null doc_ids come
    first, and repeated ids are told apart by ``copy`` (0, 1, ... in order of text, or of ``order`` and text). The plan is made for
    ``block_windows`` windows at a time, carrying the last window over, so memory is bounded by
    that and one document. An empty table gives no pieces; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = piece_coder(tokenizer, "words"), np.array([end_id], "<u4").tobytes()
        vocabulary = coder.tokenizer.get_vocab()
        stops = np.zeros(max([*vocabulary.values(), end_id]) + 1, dtype=bool)
        stops[[i for t, i in vocabulary.items() if t.removesuffix("</w>")[-1:] in (".", "!", "?")]] = True
        sequence = TaskContext.get().partitionId() << 40
        # Documents not packed yet: id, copy, ids, ids already packed.
        held: deque[tuple[int | None, int, bytes, int]] = deque()
        size, last, copy = 0, object(), 0

        def copies(batch: pa.RecordBatch) -> Iterator[int]:
            nonlocal last, copy
            if order:
                yield from batch["copy"].to_pylist()
                return
            for doc in batch["doc_id"].to_pylist():
                copy = copy + 1 if doc == last else 0
                last = doc
                yield copy

        def places() -> tuple[list[int], list[float]]:
            at, where, cost = 0, [np.zeros(1, np.int64)], [np.zeros(1)]
            for _, _, ids, done in held:
                t = np.frombuffer(ids, "<u4", offset=4 * done)
                n = len(t)
                c = np.full(n, np.inf)
                c[hard_every - 1 :: hard_every] = word_cost
                c[stops[t]] = sentence_cost
                c[-1] = 0.0
                keep = np.flatnonzero(c < np.inf)
                where.append(at + 1 + keep)
                cost.append(c[keep])
                at += n
            return np.concatenate(where).tolist(), np.concatenate(cost).tolist()

        def emit(lengths: list[int]) -> Iterator[pa.RecordBatch]:
            nonlocal sequence, size
            rows: list[tuple] = []
            for length in lengths:
                offset = 0
                while offset < length:
                    doc, c, ids, done = held[0]
                    n = min(length - offset, len(ids) // 4 - done)
                    part = ids[4 * done : 4 * (done + n)]
                    rows.append((doc, done, n, zlib.crc32(part), len(ids) // 4, sequence, offset, c, part))
                    offset += n
                    if 4 * (done + n) == len(ids):
                        held.popleft()
                    else:
                        held[0] = (doc, c, ids, done + n)
                sequence += 1
                size -= length
            if rows:
                names = [f.split(" ")[0] for f in PIECE_SCHEMA.split(", ")]
                types = [pa.int64()] * 8 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        def planned(final: bool) -> list[int]:
            where, cost = places()
            if not final:  # stop where the plan can be cheapest: at any place in the last window
                keep = [i for i, p in enumerate(where) if p <= size - window // 2]
                where, cost = where[: keep[-1] + 1], cost[: keep[-1] + 1]
            cuts = best_cuts(where, cost, window)
            lengths = np.diff([0, *cuts]).tolist()
            if not final:
                return lengths[:-1]
            return lengths[:-1] + powers_of_two(lengths[-1])

        for batch in batches:
            for doc, number, ids in zip(batch["doc_id"].to_pylist(), copies(batch), coder.ids(batch["text"].to_pylist()), strict=True):
                held.append((doc, number, ids + end, 0))
                size += len(ids) // 4 + 1
                if size >= block_windows * window:
                    yield from emit(planned(False))
        if held:
            yield from emit(planned(True))

    text = F.coalesce("text", F.lit("")).alias("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text, *([F.col(order).alias("at")] if order else []))
    if not order:
        return rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(run, PIECE_SCHEMA)
    copy = (F.row_number().over(Window.partitionBy("doc_id").orderBy("at", "text")) - 1).alias("copy")
    rows = rows.select("doc_id", "text", copy, "at").repartitionByRange("at", "doc_id").sortWithinPartitions("at", "doc_id", "copy")
    return rows.mapInArrow(run, PIECE_SCHEMA)
