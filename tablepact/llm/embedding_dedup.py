"""Near duplicates among embeddings by an inverted multi-index.

Two codebooks, one for each half of the vectors, form a product grid of cells. Every
vector lies in one cell and visits others by multi-sequence traversal, in ascending order
of the distance it would have to move to reach them, until the target recall is met;
visited vectors are compared exactly, in double precision.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, int64, matrix, runs, tiled, unit, valid_vectors, written


def fit_codebook(points: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """k-means centres of a bounded sample."""
    rng = np.random.default_rng(seed)
    points = np.unique(points, axis=0)
    k = max(1, min(k, len(points)))
    centres = points[rng.choice(len(points), k, replace=False)]
    for _ in range(rounds):
        near = ((centres**2).sum(1) - 2 * points @ centres.T).argmin(1)
        for j in np.unique(near):
            centres[j] = points[near == j].mean(0)
    return np.unique(centres, axis=0)


def multi_sequence(a: np.ndarray, b: np.ndarray, most: float) -> Iterator[tuple[int, int]]:
    """Index pairs of two ascending lists by ascending sum, until the sum exceeds ``most``."""
    heap, seen = [(a[0] + b[0], 0, 0)], {(0, 0)}
    while heap:
        score, i, j = heapq.heappop(heap)
        if score > most:
            return
        yield i, j
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (a[x] + b[y], x, y))


def _margins(half: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The own centre of each row, and the squared distance to each other centre's border with it."""
    d = (half**2).sum(1)[:, None] - 2 * half @ book.T + (book**2).sum(1)
    own = d.argmin(1)
    gap = np.sqrt(((book[:, None] - book[None]) ** 2).sum(2))
    with np.errstate(divide="ignore", invalid="ignore"):
        m = (d - d[np.arange(len(d)), own][:, None]) / (2 * gap[own])
    m[np.arange(len(d)), own] = 0.0
    return own, np.maximum(m, 0) ** 2


def _local_labels(linked: np.ndarray, members: np.ndarray, probers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id within each connected part of a tile's links; both sides' labels."""
    far = np.iinfo(np.int64).max
    lm = members.copy()
    while True:
        lp = np.minimum(probers, np.where(linked, lm, far).min(1))
        new = np.minimum(lm, np.where(linked, lp[:, None], far).min(0))
        if (new == lm).all():
            return lm, lp
        lm = new


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.95,
                 recall: float = 0.99999, sample: int = 16_384, per_cell: int = 512, cells: int = 1024) -> DataFrame:
    """One row per id: ``id``, ``n_links``, ``component_id`` and ``kept`` (``id = component_id``).

    Pairs link at a cosine of at least ``cosine``. ``recall`` is the chance that a link is visited
    if the difference of its vectors points in a random direction; both ends visit, and links of
    a group also hold it together, so components miss less. Codebooks are fitted on the
    ``sample`` ids that hash lowest; their size follows the number of vectors (about
    ``per_cell`` a cell, at most ``cells`` centres a half). Exact copies are compared once and
    counted by weight. Vectors that can't be compared (see ``valid_vectors``) and null
    ids get no link and are their own component; repeated ids get one row. An empty
    table gives an empty result. Columns other than the two named are not read.
    """
    ids = df.select(F.col(id_col).cast("long").alias("id")).distinct()
    v = written(valid_vectors(df, id_col, vector_col).select(
        "id", "v", F.xxhash64("v").alias("f1"), F.hash("v").alias("f2")), "vectors")
    same = written(v.groupBy("f1", "f2", "v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("w")), "classes")
    n = same.count()
    if not n:
        return ids.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    fit = unit(np.array([r["v"] for r in same.orderBy(F.xxhash64("rep"), "rep").limit(sample).select("v").collect()]))
    half, k = (fit.shape[1] + 1) // 2, max(1, min(cells, round(math.sqrt(n / per_cell))))
    books = fit_codebook(fit[:, :half], k), fit_codebook(fit[:, half:], k) if fit.shape[1] > 1 else np.zeros((1, 0))
    radius = math.sqrt(2 - 2 * cosine)
    most = (NormalDist().inv_cdf(recall) * radius / math.sqrt(fit.shape[1])) ** 2

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A vector may visit many cells, so few are taken at a time.
        for batch in (b.slice(at, 128) for b in batches for at in range(0, b.num_rows, 128)):
            u = unit(matrix(batch["v"]))
            (o1, m1), (o2, m2) = _margins(u[:, :half], books[0]), _margins(u[:, half:], books[1])
            r1, r2 = m1.argsort(1, kind="stable"), m2.argsort(1, kind="stable")
            row, c1, c2, own = [], [], [], []
            for x in range(len(u)):
                for i, j in multi_sequence(m1[x, r1[x]], m2[x, r2[x]], most):
                    row.append(x)
                    c1.append(r1[x, i])
                    c2.append(r2[x, j])
                own += [x]
            take = pa.array(np.concatenate([row, own]).astype(np.int64))
            role = np.concatenate([np.ones(len(row)), np.zeros(len(own))]).astype(np.int32)
            out = [pa.array(role), pa.array(np.concatenate([c1, o1]).astype(np.int32)), pa.array(np.concatenate([c2, o2]).astype(np.int32)),
                   batch["id"].take(take), batch["w"].take(take), batch["v"].take(take)]
            yield pa.RecordBatch.from_arrays(out, names=["role", "c1", "c2", "id", "w", "v"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["c1", "c2", "tm", "tp", "role", "id", "w"]
        for *_, role, rid, w, x in runs(batches, 4, lambda b: [*(int64(b[c]) for c in names), matrix(b["v"])]):
            at = int(np.searchsorted(role, 1))
            if at == 0 or at == len(role):
                continue
            x = unit(x)
            linked = x[at:] @ x[:at].T >= cosine
            linked &= rid[at:][:, None] != rid[:at]
            if not linked.any():
                continue
            lm, lp = _local_labels(linked, rid[:at], rid[at:])
            p, m = np.flatnonzero(linked.any(1)), np.flatnonzero(linked.any(0))
            n_links = linked[p] @ w[:at]
            a = np.concatenate([rid[at:][p], rid[at:][p], rid[:at][m]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.zeros(len(p)), np.ones(len(p) + len(m))]).astype(np.int32)), pa.array(a),
                 pa.array(np.concatenate([n_links, lp[p], lm[m]]).astype(np.int64))], names=["kind", "a", "b"])

    cellwise = written(same.select(F.col("rep").alias("id"), "w", "v").mapInArrow(
        visit, "role int, c1 int, c2 int, id long, w long, v array<double>"), "cells")
    found = written(tiled(cellwise.filter("role = 0"), cellwise.filter("role = 1"), ["c1", "c2"], compare,
                          "kind int, a long, b long"), "found")
    links = found.filter("kind = 0").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("n"))
    joined = components(found.filter("kind = 1").select("a", "b"))
    each = same.select("f1", "f2", "v", "rep", "w").join(links, "rep", "left").join(joined.withColumnRenamed("id", "rep"), "rep", "left").select(
        "f1", "f2", F.col("v").alias("v_"), (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    own = v.join(each, ["f1", "f2"]).filter("v = v_").select("id", "n_links", "component_id")
    return ids.join(own, "id", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))
