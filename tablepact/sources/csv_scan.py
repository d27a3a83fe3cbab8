"""CSV as it comes, cut at any size: quoted line breaks, ragged rows, a header of its own in every file.

A file is read as lines, in as many splits as its size asks for. Whether a split begins inside quotes follows from
the parity of the quote signs before it: splits are counted in one pass, and a window over the small table
of splits carries the parity and the open record onwards. Only splits in which a quoted cell runs over a line
break are put in order again to join their lines to records; all others become records where they are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ordering import ORD
from .staging import materialize

BOM = "﻿"
#: Stand for a separator inside quotes, and for these two signs themselves, while a record is cut.
_HELD, _MARK = "\x01", "\x02"
_PLACE = ("file", "start", "seq")


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, start, value)``: the lines of all files; ``start`` is the first byte of a line's split."""
    # Both passes must cut the files alike, also if executors come or go between them.
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    return placed_lines(spark.read.option("lineSep", "\n").text(path))


def placed_lines(text: DataFrame) -> DataFrame:
    """Rows of a text source, batch or stream, with their places."""
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _numbered(text: DataFrame) -> DataFrame:
    """``(file, start, seq, line, odd)``: every line with its place and whether its quote signs are odd in number."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return text.select(
        "file", "start", F.monotonically_increasing_id().alias("seq"), F.col("value").alias("line"),
        F.when(F.contains("value", F.lit('"')), quotes % 2).otherwise(0).alias("odd"),
    )


def _splits(lines: DataFrame) -> DataFrame:
    """One row per split: whether it begins ``inside`` quotes, whether lines have to be joined in it (``busy``), the
    split whose last record its first lines belong to (``owner``), and its first line that is not blank."""
    full = ~F.col("line").isin("", "\r")
    counted = lines.groupBy("file", "start").agg(
        F.sum("odd").alias("odd"), F.min(F.when(F.col("odd") == 1, F.col("seq"))).alias("first_odd"), F.max("seq").alias("last"),
        F.min(F.when(full, F.col("seq"))).alias("first_full"))
    counted, _ = materialize(counted, "csv_splits")
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    carried = counted.withColumn("inside", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2 == 1)
    # The first record of a split begins on its first line, or after the line that closes the open quotes.
    begins = ~F.col("inside") | (F.col("first_odd") < F.col("last"))
    owner = F.last(F.when(begins, F.col("start")), ignorenulls=True).over(earlier)
    return materialize(carried.select("file", "start", "inside", (F.col("inside") | (F.col("odd") > 0)).alias("busy"), owner.alias("owner"), "first_full"), "csv_carried")[0]


def _records(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """``(file, start, seq, record)`` in place of lines; blank ones are left out."""
    known = lines.join(splits.select("file", "start", F.col("inside"), "busy", "owner"), ["file", "start"], "left").withColumn(
        "busy", F.coalesce("busy", F.raise_error(F.lit("the files were cut differently between two passes")).cast("boolean")))
    whole = known.where("NOT busy").select(*_PLACE, F.col("line").alias("record"))
    split = Window.partitionBy("file", "start")
    before = split.orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    so_far = split.orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begins = (F.col("inside").cast("long") + F.coalesce(F.sum("odd").over(before), F.lit(0))) % 2 == 0
    numbered = known.where("busy").withColumn("begins", begins.cast("long"))
    numbered = numbered.withColumn("number", F.sum("begins").over(so_far)).withColumn("numbers", F.sum("begins").over(split))
    # A split's last record may go on in the next ones; their first lines (number 0) join it there.
    joined = numbered.select(
        "file", F.when(F.col("number") == 0, F.col("owner")).otherwise(F.col("start")).alias("owner"),
        F.when(F.col("number").isin(0) | (F.col("number") == F.col("numbers")), F.lit(-1)).otherwise(F.col("number")).alias("number"),
        F.struct("start", "seq", "line").alias("part"),
    ).groupBy("file", "owner", "number").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    joined = joined.select("file", F.col("parts")[0]["start"].alias("start"), F.col("parts")[0]["seq"].alias("seq"), F.array_join("parts.line", "\n").alias("record"))
    both = whole.unionByName(joined)
    return both.withColumn("record", F.when(F.endswith("record", F.lit("\r")), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))).where("record <> ''")


def cells(record: Column, sep: str = ",") -> Column:
    """The cells of one record. Every second part between quote signs is quoted; two quote signs there are one sign."""
    def outside(part: Column) -> Column:
        return F.replace(part, F.lit(sep), F.lit(_HELD))

    # Cutting at quote signs, an empty part between two quoted ones is a doubled sign.
    plain = F.when(record.contains(_HELD) | record.contains(_MARK), F.replace(F.replace(record, F.lit(_MARK), F.lit(_MARK + "b")), F.lit(_HELD), F.lit(_MARK + "a"))).otherwise(record)
    parts = F.split(plain, '"')
    last = F.size(parts) - 1
    glued = F.array_join(F.transform(parts, lambda p, i: F.when(i % 2 == 1, p).when((p == "") & (i > 0) & (i < last), F.lit('"')).otherwise(outside(p))), "")
    cut = F.split(F.when(record.contains('"'), glued).otherwise(outside(plain)), _HELD)
    back = lambda c: F.replace(F.replace(c, F.lit(_MARK + "a"), F.lit(_HELD)), F.lit(_MARK + "b"), F.lit(_MARK))
    return F.when(plain.contains(_MARK), F.transform(cut, back)).otherwise(cut)


def _headers(records: DataFrame, splits: DataFrame, sep: str) -> DataFrame:
    """``(file, start, seq, header)``: each file's first record that is not blank, as a list of names."""
    full = splits.where("first_full IS NOT NULL")
    first = full.groupBy("file").agg(F.min("start").alias("start"))
    first = full.join(first, ["file", "start"]).select("file", "start", F.col("first_full").alias("seq"))
    names = cells(F.col("record"), sep)
    names = F.when(names[0].startswith(BOM), F.concat(F.array(F.substring(names[0], 2, 1 << 30)), F.slice(names, 2, 1 << 30))).otherwise(names)
    return materialize(records.join(first, list(_PLACE)).select(*_PLACE, names.alias("header")), "csv_headers")[0]


@dataclass(frozen=True)
class Scan:
    """Records and headers of a set of files."""

    records: DataFrame
    heads: DataFrame
    sep: str

    @property
    def headers(self) -> DataFrame:
        """``(file, header)``: the column names of every file that has text, without a byte order mark."""
        return self.heads.select("file", "header")

    def rows(self, header: Sequence[str] | None = None, corrupt: str | None = None) -> DataFrame:
        """The table of :func:`scan_raw_strings`."""
        if header is None:
            # Distinct headers are metadata: as many rows as there are layouts.
            layouts = self.heads.groupBy("header").agg(F.min("file").alias("file")).orderBy("file").collect()
            header = list(dict.fromkeys(n for r in layouts for n in r["header"]))
        names = list(header)
        place = F.array(*(F.array_position("header", n) for n in names)).cast("array<bigint>")
        of_file = self.heads.select("file", F.struct("start", "seq").alias("head"), F.size("header").alias("width"), place.alias("place"))
        rows = self.records.join(of_file, "file").where(~((F.col("start") == F.col("head.start")) & (F.col("seq") == F.col("head.seq"))))
        cut = rows.withColumn("cells", cells(F.col("record"), self.sep))
        ragged = (F.size("cells") != F.col("width")) | ((F.length("record") - F.length(F.replace("record", F.lit('"'), F.lit("")))) % 2 == 1)

        def cell(i: int) -> Column:
            at = F.col("place")[i].cast("int")
            return F.when(at > 0, F.coalesce(F.try_element_at("cells", at), F.lit("")))

        out = [F.struct(*_PLACE).alias(ORD), *(cell(i).alias(n) for i, n in enumerate(names))]
        return cut.select(*out, *([F.when(ragged, F.col("record")).alias(corrupt)] if corrupt else []))


def scan_lines(text: DataFrame, sep: str = ",") -> Scan:
    """Records and headers of ``(file, start, value)`` lines, as :func:`text_lines` gives them."""
    lines = _numbered(text)
    splits = _splits(lines)
    records = _records(lines, splits)
    return Scan(records, _headers(records, splits, sep), sep)


def csv_headers(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """``(file, header)``: the column names of every CSV file under ``path``, without a byte order mark. Files
    without any text have no row."""
    return scan_lines(text_lines(spark, path), sep).headers


def scan_raw_strings(spark: SparkSession, path: str, header: Sequence[str] | None = None, sep: str = ",", corrupt: str | None = None) -> DataFrame:
    """CSV as an all-text table: nothing is inferred, an empty cell is ``""``.

    Columns are ``header``, else the names of all files' headers in the order in which they are first met. Cells go by
    their own file's header: a column that a file lacks is NULL in its rows. A row with too few cells has ``""`` for the
    rest, cells beyond the header belong to no column; ``corrupt`` names a column that holds the
    text of such rows, and of rows whose quotes never close, and is NULL elsewhere. Blank lines are no rows.
    ``_ord`` is the row's position, ``(file, start, seq)``: ascending along each file.
    """
    return scan_lines(text_lines(spark, path), sep).rows(header, corrupt)
