"""Quality scores from compression.

Two zstandard dictionaries hold text that was labelled good and text that was labelled bad. A text that
resembles the good ones compresses better with the first; the difference of the two
sizes, divided by the text's own size (plus a constant that damps very short texts), goes through a
logistic curve calibrated on labelled texts that are in neither dictionary.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import sliced, written

#: A text is compressed in pieces of this many bytes, all of them, so that the dictionaries matter throughout.
PIECE = 4096
#: Bytes added to the size that normalises the difference.
DAMP = 100


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    offset: float
    level: int = 6

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """A model with its compressors; made once a task."""

    def __init__(self, model: Model):
        self.model, self.by = model, []
        for content in (model.good, model.bad):
            words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(level=model.level)
            self.by.append(zstandard.ZstdCompressor(level=model.level, dict_data=words, write_content_size=False, write_checksum=False, write_dict_id=False))

    def difference(self, text: str | None) -> float:
        """(size with the bad dictionary - size with the good one) / (bytes + DAMP); 0 for empty text."""
        raw = (text or "").encode("utf-8", "replace")
        if not raw:
            return 0.0
        pieces = [raw[i : i + PIECE] for i in range(0, len(raw), PIECE)]
        good, bad = (sum(len(c.compress(p)) for p in pieces) for c in self.by)
        return (bad - good) / (len(raw) + DAMP)

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.model.slope * self.difference(text) + self.model.offset, -60, 60))))


def _logistic(x: np.ndarray, y: np.ndarray, share: float, ridge: float = 1e-6) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps; class 1 weighs ``share`` of the whole."""
    a, b = np.stack([x, np.ones_like(x)], 1), np.zeros(2)
    w = np.where(y == 1, share / (y == 1).sum(), (1 - share) / (y == 0).sum())
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -60, 60)))
        h = (a * (w * p * (1 - p))[:, None]).T @ a + np.eye(2) * ridge
        step = np.linalg.solve(h, a.T @ (w * (y - p)) - ridge * b)
        b = b + np.clip(step, -50, 50)
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0]), float(b[1])


def piece_of(raw: bytes, size: int, parts: int = 3) -> bytes:
    """``size`` bytes of a text: from each of ``parts`` equal stretches of the whole a run whose place the text's hash says."""
    if len(raw) <= size:
        return raw
    each, stretch, mark = size // parts, len(raw) // parts, zlib.crc32(raw)
    starts = [i * stretch + (mark >> 8 * i) % (stretch - each + 1) for i in range(parts)]
    return b"".join(raw[a : a + each] for a in starts)


def held_out(doc_id):
    """Rows that must not be learnt from: crc32 of the id's text leaves 1 on division by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 1000, dictionary: int = 800 * 1024, parts: int = 3) -> Model:
    """Fit on at most ``per_class`` labelled documents of each class, those whose ids hash lowest.

    Every other one gives an equal share of its class's dictionary of at most ``dictionary`` bytes, drawn from ``parts``
    equal stretches of the whole text; the others, scored whole, fit the curve. Both bounds are the only ones. Of several
    rows under one id the smallest text counts. Labels that are null, held out or without a document don't count;
    with one class missing every score is 0.5. Texts stay with the tasks: the driver gets the dictionaries and one number a text.
    """
    known = labels.select(F.col("doc_id").alias("doc_id"), "quality").filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    counts = {r["quality"]: r["count"] for r in known.filter("quality IN (0, 1)").groupBy("quality").count().collect()}
    mark = F.md5(F.col("doc_id").cast("string"))
    ids = [known.filter(F.col("quality") == q).select("doc_id").distinct().orderBy(mark, "doc_id").limit(per_class).select(
        "doc_id", F.lit(q).alias("q")) for q in (0, 1)]
    # At most per_class ids a class.
    found = docs.select("doc_id", "text").filter("text IS NOT NULL").join(F.broadcast(ids[0].unionByName(ids[1])), "doc_id")
    found = found.groupBy("q", "doc_id").agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("q").orderBy("mark", "doc_id"))
    found = written(found.withColumn("mark", mark).withColumn("place", place), "labelled")
    halves = {(r["q"], r["odd"]): r["n"] for r in found.groupBy("q", (F.col("place") % 2).alias("odd")).agg(F.count(F.lit(1)).alias("n")).collect()}
    size = {q: dictionary // max(1, halves.get((q, 1), 0)) for q in (0, 1)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = [piece_of(t.encode("utf-8", "replace"), size[q], parts) for q, t in zip(batch["q"].to_pylist(), batch["text"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["q"], batch["place"], pa.array(pieces, pa.binary())], names=["q", "place", "piece"])

    pieces = found.filter("place % 2 = 1").select("q", "place", "text").mapInArrow(cut, "q int, place int, piece binary").orderBy("place").collect()
    good, bad = (b"".join(bytes(r["piece"]) for r in pieces if r["q"] == q) or b" " * 8 for q in (1, 0))
    model = Model(good, bad, 0.0, 0.0)
    if not all(halves.get((q, 0)) for q in (0, 1)):
        return model

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["q"], batch["place"], pa.array([scorer.difference(t) for t in batch["text"].to_pylist()], pa.float64())],
                                             names=["q", "place", "x"])

    held = found.filter("place % 2 = 0").select("q", "place", "text").mapInArrow(measured, "q int, place int, x double").orderBy("q", "place").collect()
    scale = 100.0
    slope, offset = _logistic(np.array([r["x"] for r in held]) * scale, np.array([r["q"] for r in held]), counts.get(1, 0) / max(1, sum(counts.values())))
    return Model(good, bad, slope * scale, offset)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) appended.

    Null and empty texts get the curve's value at no difference; whole texts are read, nothing but
    the text counts. Columns of ``docs`` named like the new ones are replaced.
    """
    keep = [c for c in docs.columns if c not in ("score", "predicted")]
    docs = docs.select(*keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in sliced(batches):
            s = np.array([scorer.score(t) for t in batch["text"].to_pylist()], dtype=float)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=[*keep, "score", "predicted"])

    from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

    schema = StructType([*docs.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return docs.mapInArrow(run, schema)
