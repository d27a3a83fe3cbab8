"""Mixing sources to target weights along a curriculum.

Sources share the words of the mix by weight; none goes beyond ``repeats`` times its size, what is
over is shared anew among the rest. A source's documents, in a fixed pseudo-random order, meet a cumulative
demand that may repeat them; each source's weight changes over training time, and inverting the
integral of that schedule at a document's share of the demand gives its training position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, written

#: Documents of a source in one bucket of its order, about.
BUCKET = 1000

#: The sources' weights at the begin and end of training, in turn.
RAMPS = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shares(sizes: DataFrame, weights: Sequence[float], repeats: int) -> DataFrame:
    """Per source of ``sizes(source, size)``: ``source_size``, ``docs``, ``turn`` (0 for the first), ``target`` and ``ramp``,
    the turn among the sources that take words.

    Ordered by the ratio of cap to weight, the capped sources come first, so the level of the rest
    follows from running sums: one row a source, no iteration.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).alias("turn")
    by = by.select("*", turn).withColumn("weight", F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)), (F.col("turn") % len(weights) + 1).cast("int")))
    by = by.withColumn("cap", (F.col("source_size") * repeats).cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "turn")
    before, on = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.orderBy("turn").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by = by.select("*", (F.sum("source_size").over(every).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))).alias("left"),
                   F.sum("weight").over(on).alias("among"))
    by = by.withColumn("capped", F.col("cap") * F.col("among") <= F.col("left") * F.col("weight"))
    level = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), "turn", "left", "among"))).over(every)
    by = by.withColumn("level", level)
    by = by.select("source", "source_size", "docs", "turn", F.when(
        F.col("level").isNull() | F.col("capped"), F.col("cap")).otherwise(
        F.col("weight") * F.col("level.left") / F.col("level.among")).alias("target"))
    earlier = Window.orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    return by.withColumn("ramp", F.coalesce(F.count_if(F.floor("target") >= 1).over(earlier), F.lit(0)))


def _key() -> Column:
    return F.coalesce(F.md5(F.col("doc_id").cast("string")), F.lit("")).alias("key")


def _bucketed(df: DataFrame, by: DataFrame) -> DataFrame:
    """Rows with their source's columns of ``by`` and the ``bucket`` of its order."""
    df = df.join(by.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    place = F.coalesce(F.conv(F.substring("key", 1, 8), 16, 10).cast("long"), F.lit(0))
    return df.withColumn("bucket", F.shiftright(place * F.ceil(F.col("docs") / BUCKET).cast("long"), 32))


def _bases(slim: DataFrame, by: DataFrame) -> DataFrame:
    """Per ``turn`` and ``bucket``: the words of the source's buckets before, ``base``."""
    totals = _bucketed(slim, by).groupBy("turn", "bucket").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("turn").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return written(totals.select("turn", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")), "buckets")


def plan(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), repeats: int = 3, carry: bool = False) -> DataFrame:
    """Each row of ``docs(doc_id, text, source)`` with ``size, source_size, target, before, turn, taken``.

    ``size`` counts words (null text: 0). Sources in code point order, null last, take ``weights`` in turn. ``before``
    are the words of the source's documents before this one, in the order of the hash of their ids (null ids
    first), then id and size. A document meets the demand at ``before``, ``before`` plus the source's size, and so on, so
    ``taken`` adds up to the whole part of ``target``, and is at most ``repeats`` times the size. Empty tables give
    no rows. With ``carry`` the row's own columns come along in a struct ``doc``.
    """
    own = ["doc_id", "source", word_count(F.col("text")).alias("size"), _key()]
    slim = written(docs.select(*own), "sizes")
    by = written(shares(slim, weights, repeats), "shares")
    rows = docs.select(*own, F.struct("*").alias("doc")) if carry else slim
    within = Window.partitionBy("turn", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    out = _bucketed(rows, by).withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0)))
    out = out.join(_bases(slim, by), ["turn", "bucket"]).withColumn("before", F.col("base") + F.col("within"))
    taken = sum((_taken(F.lit(e)) for e in range(repeats)), F.lit(0).cast("long"))
    keep = ["doc_id", "source", "size", "source_size", "target", "turn", "ramp", "before", taken.alias("taken")]
    return out.select(*keep, *(["doc"] if carry else []))


def _taken(copy: Column) -> Column:
    """Words that pass ``copy`` (0, 1, ...) over the source takes from the document."""
    rest = F.floor("target") - (copy * F.col("source_size") + F.col("before"))
    return F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest))


def position(share: Column, begin: Column, end: Column) -> Column:
    """Training time in [0, 1] at which a source whose weight runs from ``begin`` to ``end`` has used ``share`` of its demand.

    With slope k = (end - begin) / (end + begin) the demand up to t is t + k (t^2 - t).
    """
    k = (end - begin) / (end + begin)
    root = (F.sqrt((1 - k) * (1 - k) + 4 * k * share) - (1 - k)) / (2 * k)
    return F.when(F.abs(k) < 1e-9, share).otherwise(root)


def _position(copy: Column, words: Column, ramps: Sequence[tuple[float, float]]) -> Column:
    """Where pass ``copy``, which takes ``words``, stands in training: at its middle word's share of what the source gives."""
    of = lambda i: F.element_at(F.array(*(F.lit(float(r[i])) for r in ramps)), (F.col("ramp") % len(ramps) + 1).cast("int"))
    return position((copy * F.col("source_size") + F.col("before") + words / 2) / F.floor("target"), of(0), of(1))


def schedule(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), repeats: int = 3,
             ramps: Sequence[tuple[float, float]] = RAMPS) -> DataFrame:
    """The rows of :func:`plan` with ``positions``, one for each pass that takes words, range-sorted by the first one.

    Documents that no pass takes have no positions and come last.
    """
    passes = [F.when(_taken(F.lit(e)) > 0, _position(F.lit(e), _taken(F.lit(e)), ramps)) for e in range(repeats)]
    p = written(plan(docs, weights, repeats).withColumn("positions", F.array_compact(F.array(*passes))), "schedule")
    first = F.try_element_at("positions", F.lit(1)).asc_nulls_last()
    return p.repartitionByRange(first, "doc_id").sortWithinPartitions(first, "doc_id")


def placed(mixed: DataFrame, ramps: Sequence[tuple[float, float]] = RAMPS) -> DataFrame:
    """``doc_id, text, position`` of the rows of a mix, the positions being those that :func:`mix` sorted by.

    They follow from the rows alone, whatever their order: a source's first passes add up to its size if any
    document has a second one, all its rows to its demand, and only the last pass can be shorter than the first.
    Rows must not share an id but as passes. Of rows without an id, those of equal text count as passes of one document.
    """
    name = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).alias("name")
    rows = mixed.select("doc_id", "source", word_count(F.col("text")).alias("size"), _key(), name, "text")
    slim = rows.drop("text").groupBy("source", "doc_id", "key", "name").agg(F.sum("size").alias("all"), F.max("size").alias("size"))
    slim = written(slim, "documents")
    by = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum("all").alias("target"), F.count(F.lit(1)).alias("docs"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    by = written(by.withColumn("turn", turn).withColumn("ramp", F.col("turn")), "shares")
    document = Window.partitionBy("turn", "bucket", "key", "doc_id", "name")
    out = _bucketed(rows, by).withColumn("copy", F.row_number().over(document.orderBy(F.desc("size"))) - 1).withColumn(
        "whole", F.max("size").over(document))
    first = F.when(F.col("copy") == 0, F.col("size")).otherwise(0)
    order = Window.partitionBy("turn", "bucket").orderBy("key", "doc_id", "whole", "name", "copy").rowsBetween(Window.unboundedPreceding, -1)
    out = out.withColumn("within", F.coalesce(F.sum(first).over(order), F.lit(0)) - F.when(F.col("copy") > 0, F.col("whole")).otherwise(0))
    out = out.join(_bases(slim, by), ["turn", "bucket"]).withColumn("before", F.col("base") + F.col("within"))
    return out.select("doc_id", "text", _position(F.col("copy"), F.col("size"), ramps).alias("position"))


def mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), repeats: int = 3,
        ramps: Sequence[tuple[float, float]] = RAMPS) -> DataFrame:
    """The mix itself: the columns of ``docs`` in training order, a row for each pass that takes words.

    ``ramps`` are the weights at the begin and end of training of the sources that take words, in turn. The last document that a
    source's demand reaches is cut after the words it takes, with ``n_chars`` following if there
    is such a column. Documents without words are in no mix. Rows are range-sorted by position.
    """
    p = plan(docs, weights, repeats, carry=True)
    p = p.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))).withColumn("words", _taken(F.col("copy"))).filter("words > 0")
    words = F.regexp_extract_all("doc.text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    cut = F.array_join(F.slice(words, F.lit(1), F.col("words").cast("int")), "")
    text = F.when(F.col("words") < F.col("size"), cut).otherwise(F.col("doc.text"))
    p = p.withColumn("position", _position(F.col("copy"), F.col("words"), ramps))
    fields = {c: F.col(f"doc.`{c}`") for c in docs.columns} | {"text": text}
    if "n_chars" in docs.columns:
        fields["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    out = p.select(F.struct(*(v.alias(k) for k, v in fields.items())).alias("doc"), "position", "doc_id", "copy")
    return out.repartitionByRange("position").sortWithinPartitions("position", "doc_id", "copy").select("doc.*")
