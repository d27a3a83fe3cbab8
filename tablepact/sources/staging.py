"""Written intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_roots: dict[str, str] = {}
_tables: dict[tuple[str, str], str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir`` when the session names one.

    Only a local session without that setting falls back to a temporary folder; on a
    cluster, executors could not see one another's.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app not in _roots:
        base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
        if not base:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="tablepact-")
        _roots[app] = f"{base.rstrip('/')}/tablepact-{uuid.uuid4().hex}"
    return _roots[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path that no earlier call has used."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def staged(spark: SparkSession, name: str, build: Callable[[], DataFrame],
           partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``build()`` once per application under ``name`` and read it back.

    Unlike a cache it survives the loss of executors, and readers prune its columns
    and partitions. Rows are spread over the cores first: an input of one small file
    would otherwise leave one file, and every reader with one task.
    """
    key = (spark.sparkContext.applicationId, name)
    if key not in _tables:
        path = new_path(spark, "".join(ch if ch.isalnum() else "_" for ch in name)[-60:])
        writer = build().repartition(spark.sparkContext.defaultParallelism).write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        _tables[key] = path
    return spark.read.parquet(_tables[key])


def materialize(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Write a compact intermediate result and go on from the written table.

    Used where several later steps read one aggregated result: it is computed once,
    the lineage ends there, and the plans that follow stay small. Also returns the
    number of rows, observed while writing.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), int(seen.get["rows"])
