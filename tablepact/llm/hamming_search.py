"""Nearest neighbours by multi-index hashing.

A rotation learned on a bounded sample turns vectors into binary codes. Codes are split into
substrings, each with its own index. A code within Hamming distance r of the query's agrees
with it up to a known share of r in at least one substring, so probing all substring
values that near retrieves every such code; survivors are ranked on the original floats.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import int64, matrix, runs, tiled, valid_vectors, written


def fit_rotation(x: np.ndarray, rounds: int = 30, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Mean and rotation that bring the sample closest to the corners of a cube (iterative quantisation)."""
    mean = x.mean(0)
    z = x - mean
    scale = np.abs(z).max()
    z = z / scale if scale > 0 else z
    _, _, axes = np.linalg.svd(z, full_matrices=True) if len(z) < z.shape[1] else np.linalg.svd(z.T @ z)
    r = np.linalg.qr(np.random.default_rng(seed).normal(size=(z.shape[1],) * 2))[0]
    y = z @ axes.T
    for _ in range(rounds):
        a, _, b = np.linalg.svd(np.where(y @ r >= 0, 1.0, -1.0).T @ y)
        r = (a @ b).T
    return mean, axes.T @ r


def substring_radii(radius: int, parts: int) -> list[int]:
    """Radius of each substring (-1: not probed); a code within ``radius`` is within one of them."""
    each, rest = divmod(radius, parts)
    return [each if i <= rest else each - 1 for i in range(parts)]


def ball(bits: int, radius: int) -> np.ndarray:
    """XOR masks of up to ``radius`` bits."""
    return np.array([sum(1 << b for b in c) for k in range(min(radius, bits) + 1) for c in itertools.combinations(range(bits), k)], dtype=np.int64)


def _bits(x: np.ndarray, mean: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    return (x - mean) @ rotation >= 0


def _parts(bits: np.ndarray, cuts: list[int]) -> np.ndarray:
    """Value of each substring, one column a part."""
    return np.stack([bits[:, a:b] @ (1 << np.arange(b - a, dtype=np.int64)) for a, b in itertools.pairwise(cuts)], 1)


def _calibrated(x: np.ndarray, bits: np.ndarray, k: int, recall: float, queries: int, seed: int = 11) -> int:
    """Hamming radius that holds ``recall`` of the ``k`` nearest sample rows of sample queries."""
    far = []
    for q in np.random.default_rng(seed).permutation(len(x))[:queries]:
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        near = np.argsort(d, kind="stable")[: min(k, len(x) - 1)]
        far.append((bits[near] != bits[q]).sum(1))
    return int(np.quantile(np.concatenate(far), recall, method="higher")) if far and len(x) > 1 else bits.shape[1]


def nearest(df: DataFrame, is_query: Column | None = None, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
            recall: float = 0.98, substring_bits: int = 8, sample: int = 8192, sample_queries: int = 256) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` nearest other rows of each query, nearest first.

    ``is_query`` is a condition on column ``id`` (default: all rows). Nearness is the Euclidean
    distance of the original vectors in double precision, ties go to the smaller id. The
    rotation and the Hamming radius (that of ``recall`` of the sample's own neighbours) are fitted
    on the ``sample`` ids that hash lowest; every row is indexed. Queries that find
    fewer than ``k`` rows within the radius search once more at the largest radius, which reaches
    all rows. Vectors that can't be compared (see ``valid_vectors``) take no part. An
    empty table gives an empty result; other columns are not read.
    """
    schema = "query_id long, rank int, id long, score double"
    v = written(valid_vectors(df, id_col, vector_col), "vectors")
    picked = v.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").collect()
    if not picked:
        return df.sparkSession.createDataFrame([], schema)
    x = np.array([r["v"] for r in picked])
    mean, rotation = fit_rotation(x)
    d = x.shape[1]
    cuts = [*range(0, d, min(substring_bits, d)), d]
    parts = len(cuts) - 1
    queries = v.filter(is_query) if is_query is not None else v

    def search(queries: DataFrame, radius: int) -> DataFrame:
        radii = substring_radii(radius, parts)
        masks = [ball(b - a, r) if r >= 0 else np.zeros(0, dtype=np.int64) for (a, b), r in zip(itertools.pairwise(cuts), radii, strict=True)]

        def bucketed(probe: bool):
            def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    if not batch.num_rows:
                        continue
                    codes = _parts(_bits(matrix(batch["v"]), mean, rotation), cuts)
                    for p in range(parts):
                        value = codes[:, p : p + 1] ^ masks[p] if probe else codes[:, p : p + 1]
                        if not len(masks[p]):
                            continue
                        for at in range(0, len(codes), 512):  # bounds a batch of probes
                            part = value[at : at + 512]
                            take = pa.array(np.repeat(np.arange(at, at + len(part)), part.shape[1]))
                            n = part.size
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(n, p, dtype=np.int32)), pa.array(part.ravel()), batch["id"].take(take), batch["w"].take(take), batch["v"].take(take)],
                                names=["part", "value", "id", "w", "v"])
            return rows

        def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = ["part", "value", "tm", "tp", "role", "id"]
            for part, _, _, _, role, rid, y in runs(batches, 4, lambda b: [*(int64(b[c]) for c in names), matrix(b["v"])]):
                at, p = int(np.searchsorted(role, 1)), int(part[0])
                if at == 0 or at == len(role):
                    continue
                bits = _bits(y, mean, rotation)
                members, probers = bits[:at], bits[at:]
                # One substring reports a pair: the first whose radius holds it.
                first = np.ones((len(probers), at), dtype=bool)
                whole = np.zeros((len(probers), at), dtype=np.int32)
                for i, (a, b) in enumerate(itertools.pairwise(cuts)):
                    s, t = probers[:, a:b].astype(np.float32), members[:, a:b].astype(np.float32)
                    apart = (s.sum(1)[:, None] + t.sum(1) - 2 * (s @ t.T)).astype(np.int32)
                    whole += apart
                    if i < p:
                        first &= apart > radii[i]
                near = first & (whole <= radius) & (rid[at:][:, None] != rid[:at])
                for q in np.flatnonzero(near.any(1)):
                    m = np.flatnonzero(near[q])
                    score = np.sqrt(((y[m] - y[at + q]) ** 2).sum(1))
                    best = np.lexsort((rid[m], score))[:k]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(best), rid[at + q])), pa.array(rid[m[best]]), pa.array(score[best])], names=["query_id", "id", "score"])

        kind = "part int, value long, id long, w long, v array<double>"
        w = F.lit(0).cast("long").alias("w")
        members = v.select("id", w, "v").mapInArrow(bucketed(False), kind)
        probers = queries.select("id", w, "v").mapInArrow(bucketed(True), kind)
        found = tiled(written(members, "members"), written(probers, "probes"), ["part", "value"], rank, "query_id long, id long, score double")
        order = Window.partitionBy("query_id").orderBy("score", "id")
        return written(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score"), "nearest")

    radius = _calibrated(x, _bits(x, mean, rotation), k, recall, sample_queries)
    got = search(queries, radius)
    short = queries.join(got.filter(F.col("rank") == k), F.col("query_id") == queries["id"], "left_anti")
    short = written(short, "short")
    if radius >= d or short.isEmpty():
        return got
    again = search(short, d)
    return got.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").select(*got.columns).unionByName(again)
