"""Raw string tables, object listings, logs, captures, results: reading and writing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates as D
from ..functions import web as H
from ..functions.sql import array, lit
from ..operators.ordering import ORD
from .csv_scan import csv_headers, scan_raw_strings  # noqa: F401
from .staging import new_path


# ---------------------------------------------------------------- raw tables
def as_raw_strings(df: DataFrame, order: str) -> DataFrame:
    """The same view over a typed table: cells as text, NULL as ``""``, ``order`` as the position."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns if c != order]
    return df.select(F.col(order).alias(ORD), *cells)


def write_clean_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """Cleaned table as CSV with header, empty cells empty. A sorted input keeps its order across part files."""
    out = df.drop(ORD) if ORD in df.columns else df
    out.write.options(
        header=True, emptyValue="", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        compression=compression,
    ).csv(path)


# ---------------------------------------------------------------- objects and logs
#: Files up to this size are hashed whole, as one cell; larger ones as a stream, which needs no array of their size (2 GB at most).
WHOLE_FILE = 32 << 20
#: Their endings make Spark's text reader unpack files, so these can only be read whole.
_PACKED = r"[.](gz|bz2|deflate|lz4|snappy|zst|zstd)$"


def _hasher(names: Mapping[str, str]):
    """Hashes of the files of a task, whose lines come in order, file after file; ``names`` are the files' own.

    A function of its own with the standard library and Arrow only, so workers need not have this package.
    """
    def streamed(batches):
        import hashlib

        at, sums = None, None

        def done():
            # A byte order mark is left out by the reader, and the last line may lack its line feed: the length tells.
            path, length, n, hashes = at, sums[0], sums[1], sums[2]
            which = {(0, 0): 0, (-1, 0): 1, (0, 3): 2, (-1, 3): 3}.get(next(((e, m) for m in (0, 3) for e in (0, -1) if n + e + m == length), None))
            if which is None:
                raise OSError(f"{path}: read {n} bytes of lines, its length is {length}")
            for h in hashes[which // 2]:
                if not which % 2:
                    h.update(b"\n")
            return [names.get(path, path), length, *(h.hexdigest() for h in hashes[which // 2])]

        def rows(found):
            import pyarrow as pa

            return pa.RecordBatch.from_pydict({k: [r[i] for r in found] for i, k in enumerate(("path", "length", "sha256", "md5"))}, pa.schema(
                [("path", pa.string()), ("length", pa.int64()), ("sha256", pa.string()), ("md5", pa.string())]))

        for batch in batches:
            paths, lengths, values = batch.column(0), batch.column(1), batch.column(2)
            start = 0
            while start < batch.num_rows:
                path = paths[start].as_py()
                end = start + 1 if paths[batch.num_rows - 1].as_py() != path else batch.num_rows
                while end < batch.num_rows and paths[end].as_py() == path:
                    end += 1
                lines = b"\n".join(values.slice(start, end - start).to_pylist())
                if path != at:
                    if at is not None:
                        yield rows([done()])
                    mark = b"\xef\xbb\xbf"
                    at, sums = path, [lengths[start].as_py(), 0, ([hashlib.sha256(), hashlib.md5()], [hashlib.sha256(mark), hashlib.md5(mark)])]
                else:
                    lines = b"\n" + lines
                for h in (h for pair in sums[2] for h in pair):
                    h.update(lines)
                sums[1] += len(lines) + (1 if not sums[1] else 0)
                start = end
        if at is not None:
            yield rows([done()])

    return streamed


def file_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """Path, size, SHA-256 and MD5 of every file, hashed where the file is read.

    A large file goes through the hashes line by line, as bytes, in one task; so does one of several GB.
    """
    files = spark.read.format("binaryFile").load(path)
    # Said of the listing, so that files of the other kind are not opened. Readers spell a file's name in two ways.
    place = F.col("_metadata.file_path")
    streamed = (F.col("_metadata.file_size") > WHOLE_FILE) & ~place.rlike(_PACKED)
    whole = files.where(~streamed).select("path", "length", F.sha2("content", 256).alias("sha256"), F.md5("content").alias("md5"))
    # Names and sizes only, no content.
    large = {r.place: (r.path, r.length) for r in files.where(streamed).select(place.alias("place"), "path", "length").collect()}
    if not large:
        return whole
    # A session of its own, so that its settings touch no other query: a split holds one file.
    own, size = spark.newSession(), str(max(n for _, n in large.values()))
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        own.conf.set(key, size)
    text = own.read.option("lineSep", "\n").text(path).where(streamed)
    lines = text.select(place.alias("place"), F.col("_metadata.file_size").alias("length"), F.col("value").cast("binary").alias("value"))
    names = {k: v for k, (v, _) in large.items()}
    found = lines.mapInArrow(_hasher(names), "path string, length long, sha256 string, md5 string")
    target = new_path(spark, "file_hashes")
    found.write.parquet(target)
    return whole.unionByName(spark.read.schema(found.schema).parquet(target))


def list_objects(spark: SparkSession, path: str) -> DataFrame:
    """Objects under a path ``(name, created_ms, size)``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.unix_millis("modificationTime").alias("created_ms"), F.col("length").alias("size"),
    )


def latest_outputs(objects: DataFrame, prefix: str = "", n: int | None = None) -> DataFrame:
    """Objects newest first: by the 13-digit time in the name, else by creation time."""
    found = objects.where(F.col("name").startswith(prefix)) if prefix else objects
    out = found.withColumn("ts_ms", F.expr(f"coalesce({D.epoch_ms_in_name('name')}, created_ms)")).orderBy(F.desc("ts_ms"), F.asc("name"))
    return out.limit(n) if n is not None else out


def object_fingerprint(content: str, etag: str) -> dict[str, str]:
    """Upload-log expressions: SHA-256 of the content, and whether the store's tag is its MD5."""
    return {"sha256": f"sha2({content}, 256)", "etag_matches_md5": f"replace({etag}, '\"', '') = md5({content})"}


UPLOAD_LOG_SCHEMA = T.StructType([
    T.StructField("uploaded_at_local", T.StringType()), T.StructField("uploaded_at_ms", T.LongType()),
    T.StructField("case", T.StringType()), T.StructField("file", T.StringType()),
    T.StructField("sha256", T.StringType()), T.StructField("uri", T.StringType()),
    T.StructField("version_id", T.StringType()), T.StructField("etag_matches_md5", T.BooleanType()),
])


def append_event_log(rows: DataFrame, path: str) -> None:
    """Append rows to the upload log; existing rows are never rewritten."""
    rows.select(*[F.col(f.name).cast(f.dataType) for f in UPLOAD_LOG_SCHEMA]).write.mode("append").parquet(path)


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(UPLOAD_LOG_SCHEMA).parquet(path)


# ---------------------------------------------------------------- results
def write_check_report(results: DataFrame, path: str, header: Mapping[str, str] | None = None, replace: bool = False) -> None:
    """One JSON document per run: header fields, overall result, checks; foldered by case and run.

    ``replace`` puts each run's report in place of an earlier one and leaves other runs' reports alone.
    """
    severity = F.max(F.when(F.col("status") == "FAIL", 2).when(F.col("status") == "WARN", 1).otherwise(0))
    check = F.struct("check_id", "name", "status", "message", "details")
    docs = results.groupBy("case", "run_id").agg(
        *[F.lit(v).alias(k) for k, v in (header or {}).items()],
        F.when(severity == 2, "FAIL").when(severity == 1, "WARN").otherwise("PASS").alias("result"),
        F.sort_array(F.collect_list(check)).alias("checks"),
    )
    write = docs.write.option("partitionOverwriteMode", "dynamic").mode("overwrite") if replace else docs.write.mode("append")
    write.partitionBy("case", "run_id").json(path)


_CHECK = T.StructType([T.StructField(n, T.StringType()) for n in ("check_id", "name", "status", "message", "details")])


def read_check_reports(spark: SparkSession, path: str) -> DataFrame:
    """Saved reports, one row per run; case and run come from the folder names."""
    schema = T.StructType([
        T.StructField("result", T.StringType()), T.StructField("checks", T.ArrayType(_CHECK)),
        T.StructField("case", T.StringType()), T.StructField("run_id", T.StringType()),
    ])
    return spark.read.schema(schema).json(path)


#: Runs that a task writes side by side; with more of them the rest is sorted first.
RUN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def write_run_output(outputs: DataFrame, path: str) -> None:
    """Saved outputs foldered by case and run.

    A task writes its runs side by side in small row groups; sorting them first would spill every row.
    """
    spark = outputs.sparkSession
    before = spark.conf.get(RUN_WRITERS)
    spark.conf.set(RUN_WRITERS, "32")
    try:
        outputs.write.mode("append").option("compression", "zstd").option("parquet.block.size", str(8 << 20)).partitionBy("case", "run_id").parquet(path)
    finally:
        spark.conf.set(RUN_WRITERS, before)


def read_run_results(spark: SparkSession, path: str) -> DataFrame:
    """All saved outputs in one scan; a filter on case or run prunes folders."""
    return spark.read.parquet(path)


def save_profile(profile: DataFrame, path: str) -> None:
    profile.write.mode("errorifexists").parquet(path)


def load_profile(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# ---------------------------------------------------------------- HTTP captures
HAR_SCHEMA = T.StructType([T.StructField("log", T.StructType([T.StructField("entries", T.ArrayType(T.StructType([
    T.StructField("_resourceType", T.StringType()),
    T.StructField("request", T.StructType([
        T.StructField("method", T.StringType()), T.StructField("url", T.StringType()),
        T.StructField("headers", T.ArrayType(T.StructType([
            T.StructField("name", T.StringType()), T.StructField("value", T.StringType())]))),
    ])),
    T.StructField("response", T.StructType([
        T.StructField("status", T.IntegerType()),
        T.StructField("content", T.StructType([
            T.StructField("mimeType", T.StringType()), T.StructField("text", T.StringType())])),
    ])),
])))]))])


def read_http_log(spark: SparkSession, path: str) -> DataFrame:
    """HTTP captures, one row per entry in capture order ``seq``. Header values are dropped here."""
    har = spark.read.schema(HAR_SCHEMA).option("multiLine", True).json(path)
    entries = har.select(F.col("_metadata.file_path").alias("capture"), F.posexplode("log.entries").alias("pos", "e"))
    return entries.select(
        F.struct("capture", "pos").alias("seq"),
        F.col("e.request.method").alias("method"), F.col("e.request.url").alias("url"),
        F.coalesce(F.col("e._resourceType"), F.lit("")).alias("resource_type"),
        F.lower(F.coalesce(F.col("e.response.content.mimeType"), F.lit(""))).alias("mime"),
        F.col("e.response.status").alias("status"), F.col("e.response.content.text").alias("body"),
        F.coalesce(F.transform("e.request.headers", lambda h: F.lower(h["name"])), F.array().cast("array<string>")
                   ).alias("header_names"),
    )


def api_calls(entries: DataFrame) -> DataFrame:
    """Drop noise hosts and everything that is neither XHR/fetch nor JSON."""
    named = entries.withColumn("host", F.expr(H.url_host("url")))
    return named.where(f"NOT {H.is_noise_host('host')} AND (resource_type IN ('xhr', 'fetch') OR contains(mime, 'json'))")


def endpoint_summary(entries: DataFrame) -> DataFrame:
    """Calls per (method, host, path template): count, statuses, auth header names, first JSON shape.

    Two levels: counts per status first, so only one small row per endpoint and status
    is gathered. The shape is parsed once per endpoint, on the first successful body.
    """
    calls = api_calls(entries).withColumn("path", F.expr(H.path_template(H.url_path("url"))))
    key = ["method", "host", "path"]
    sent = [F.expr(f"max(array_contains(header_names, {lit(h)}))").alias(f"_auth{i}")
            for i, h in enumerate(H.AUTH_HEADERS)]
    per_status = calls.groupBy(*key, "status").agg(
        F.count(F.lit(1)).alias("calls"),
        F.expr("min(CASE WHEN status < 400 AND coalesce(body, '') <> '' THEN struct(seq, body) END)").alias("first"),
        *sent,
    )
    total = per_status.groupBy(*key).agg(
        F.sum("calls").alias("calls"),
        F.expr("map_from_entries(sort_array(collect_list(struct(status, calls))))").alias("statuses"),
        F.min("first").alias("first"), *[F.max(f"_auth{i}").alias(f"_auth{i}") for i in range(len(sent))],
    )
    names = "array_compact(" + array(f"CASE WHEN _auth{i} THEN {lit(h)} END" for i, h in enumerate(H.AUTH_HEADERS)) + ")"
    return total.select(
        *key, "calls", "statuses", F.expr(names).alias("auth"),
        F.expr(f"coalesce({H.json_shape('first.body')}, '')").alias("shape"),
    )
