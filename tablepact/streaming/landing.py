"""Validate outputs as their files land, with the columns the files have."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..contract import Contract
from ..plans.headers import CASE, RUN, by_run, folder_value
from ..plans.runs import RunSet
from ..plans.validate import validate_runs
from ..sources.csv_scan import placed_lines, scan_lines
from ..sources.tables import write_check_report

_LANDED = "landing"


def _store(df: DataFrame, path: str) -> None:
    """One folder per run and file, so a batch that is repeated replaces what it wrote."""
    keyed = df.withColumn("file_id", F.md5(F.col("file"))).drop("file")
    keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN, "file_id").parquet(path)


def validate_landing(spark: SparkSession, contract: Contract, landing: str, reports: str, state: str, *,
                     expected: DataFrame | None = None, baseline: DataFrame | None = None,
                     on_results: Callable[[DataFrame], None] | None = None) -> StreamingQuery:
    """Read newly landed CSV files (``landing/run_id=.../*.csv``) and keep one report per run under ``reports``.

    Every file's own header counts, so schema drift shows. What has landed of a run is kept under ``state`` and a run is
    validated as a whole whenever more of it lands: its files may come in several batches, and its report replaces
    the one before. Rows, headers and reports are keyed by run and file, so a repeated batch changes nothing. The stream's
    checkpoint (also under ``state``) remembers which files were seen. Processes what is there, then stops.
    """
    stream = placed_lines(spark.readStream.option("lineSep", "\n").text(f"{landing}/run_id=*"))
    rows_at, heads_at = f"{state}/rows", f"{state}/headers"

    def batch(df: DataFrame, _: int) -> None:
        if df.isEmpty():
            return
        scan = scan_lines(df)
        run = folder_value(F.col("file"), RUN).alias(RUN)
        rows = scan.rows(contract.names).withColumnRenamed("_ord", "pos")
        _store(rows.select(folder_value(F.col("pos.file"), RUN).alias(RUN), F.col("pos.file").alias("file"), F.col("pos").alias("_ord"), *contract.names), rows_at)
        heads = scan.headers.select(run, "file", F.col("file").alias("path"), "header")
        _store(heads, heads_at)
        touched = scan.headers.select(run).distinct()
        stored = spark.read.parquet(heads_at).withColumn(RUN, F.col(RUN).cast("string")).join(touched, RUN, "left_semi")
        header_table = by_run(stored.withColumnRenamed("path", "file"), F.col(RUN), F.lit(_LANDED))
        schema = f"_ord struct<file: string, start: bigint, seq: bigint>, {', '.join(f'`{n}` string' for n in contract.names)}, {RUN} string, file_id string"
        # Folder names of runs are cut down to those touched by the join's own pruning.
        outputs = spark.read.schema(schema).parquet(rows_at).join(touched, RUN, "left_semi").withColumn(CASE, F.lit(_LANDED)).drop("file_id")
        rs = RunSet(spark, contract, outputs, header_table=header_table, baseline=baseline,
                    expected=None if expected is None else expected.withColumn(CASE, F.lit(_LANDED)))
        results = validate_runs(rs)
        write_check_report(results, reports, replace=True)
        if on_results is not None:
            on_results(results)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).start()
