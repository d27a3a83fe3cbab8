"""Which input was in place when an output was written, and whether anything was written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.asof import HOUR_MS, asof_backward
from .runs import CASE


def input_provenance(outputs: DataFrame, uploads: DataFrame, by: Sequence[str] = (), bucket_ms: int = HOUR_MS) -> DataFrame:
    """INP-01 per output ``(by..., run_id, case, sha256, ts_ms)`` against ``uploads``
    ``(by..., uploaded_at_ms, case, sha256, seq)``: adds the matched upload, ``status`` and ``message``.

    An output without a timestamp, or older than every upload, is skipped.
    """
    timed = outputs.where(F.col("ts_ms").isNotNull())
    matched = asof_backward(timed, uploads, by, "ts_ms", "uploaded_at_ms", [CASE, "sha256"], "seq", bucket_ms)
    untimed = outputs.where(F.col("ts_ms").isNull())
    every = matched.unionByName(untimed, allowMissingColumns=True)
    up = F.col("match")
    same = (up[CASE] == F.col(CASE)) & (up["sha256"] == F.col("sha256"))
    return every.withColumns({
        "status": F.when(up.isNull(), "SKIP").when(F.coalesce(same, F.lit(False)), "PASS").otherwise("FAIL"),
        "message": F.when(F.col("ts_ms").isNull(), "no run timestamp")
        .when(up.isNull(), "no upload logged before this output")
        .when(same, F.concat(F.col(CASE), F.lit(" was in place")))
        .otherwise(F.concat(F.lit("'"), up[CASE], F.lit("' was in place when this output was written"))),
    })


def no_output(outputs: DataFrame, uploads: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """NO-OUTPUT detection per feed: ``(by..., case, upload_ms, newest_output_ms, result)``.

    The latest upload is newer than the newest output, so nothing was written after it.
    """
    by = list(by)
    latest = uploads.select(*by, "uploaded_at_ms", F.col(CASE).alias("_case"), "seq",
                            F.lit(None).cast("bigint").alias("_out"))
    newest = outputs.select(*by, F.lit(None).cast("bigint").alias("uploaded_at_ms"),
                            F.lit(None).cast("string").alias("_case"), F.lit(None).cast("bigint").alias("seq"),
                            F.col("ts_ms").alias("_out"))
    up = F.struct("uploaded_at_ms", "seq", "_case")
    folded = latest.unionByName(newest).groupBy(*by).agg(
        F.max(F.when(F.col("uploaded_at_ms").isNotNull(), up)).alias("u"), F.max("_out").alias("newest_output_ms")
    )
    pending = F.coalesce(F.col("u.uploaded_at_ms") > F.col("newest_output_ms"), F.lit(True))
    return folded.where(F.col("u").isNotNull()).select(
        *by, F.col("u._case").alias(CASE), F.col("u.uploaded_at_ms").alias("upload_ms"), "newest_output_ms",
        F.when(pending, F.lit("NO-OUTPUT")).otherwise(F.lit("OUTPUT")).alias("result"),
    )
