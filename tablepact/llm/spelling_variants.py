"""Spelling variants: words one edit apart, found by partition-and-enumerate signatures of their letter multisets.

A word is a binary vector: dimension (letter, k) is set if the letter stands in it at least k times. Words one edit
apart have vectors at Hamming distance at most two: a replaced letter sets one dimension and clears another (distance
two, equal lengths), an inserted one sets one (distance one, lengths that differ by one). For each distance ``d`` the
dimensions are dealt into ``n`` parts; vectors that differ in at most ``d`` dimensions agree on all parts but some
``d`` of them, so the sums of all choices of ``n - d`` parts, with the length, are exact signatures: every near pair
shares one. Words are equi-joined on signatures and pairs are verified on the words themselves.

All of it is built-in functions. Defined results: null texts have no words; a null id is the empty text in the
checksum of the planted typing errors; repeated rows count repeatedly; an empty table gives an empty one. A signature
that many words share is cut into tiles, so no task holds all of its pairs.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import materialize
from .common import written

#: A run of letters, as the pattern's text and inside SQL literals alike (fixed value).
LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Parts of the universe for replaced letters (distance two) and for inserted ones (distance one).
PARTS = {2: 7, 1: 4}
#: Words of a signature in one tile.
TILE = 4096
#: One of so many runs, by checksum, loses a letter.
DAMAGED = 199


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, run)``: every maximal run of letters, A-Z in lower case."""
    # Above 0x7F the built-in lower() would change letters too; most runs have no upper case at all.
    low = F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(F.translate("run", UPPER, LOWER))
    return docs.select(F.col(id_col).cast("string").alias("id"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(LETTERS), F.lit(0))).alias("run")).select("id", low.alias("run"))


def damaged(found: DataFrame) -> DataFrame:
    """``(word)``: runs, of which one in :data:`DAMAGED` has lost a letter, both chosen by the checksum of id and run."""
    rows = found.select("run", F.length("run").alias("size"), F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), F.col("run"))).alias("h"))
    at = (F.col("h") % F.col("size")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("size")))
    return rows.select(F.when(F.col("h") % DAMAGED == 0, cut).otherwise(F.col("run")).alias("word"))


def words(found: DataFrame, shortest: int = 6, fewest: int = 5) -> DataFrame:
    """``(word, n)`` of words with enough letters and occurrences. Equal words are counted before the shuffle."""
    return found.filter(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= fewest)


def _part_sums(word: Column, n: int) -> Column:
    """The sum of the hashes of the set dimensions, for each of ``n`` parts."""
    letters = F.array_sort(F.split(word, ""))
    # In sorted order, a letter's k-th occurrence stands k places after its first.
    dims = F.transform(letters, lambda c, i: F.xxhash64(c, i - F.array_position(letters, c)))
    return F.aggregate(dims, F.array_repeat(F.lit(0).cast("long"), n), lambda sums, h: F.transform(
        sums, lambda s, i: F.when(F.pmod(h, F.lit(n)) == i, s.bitwiseXOR(h)).otherwise(s)))


def signatures(counted: DataFrame, d: int, length: Column) -> DataFrame:
    """``(sig, word, n)``: a row for each choice of ``d`` left-out parts; ``length`` belongs to the signature.

    A word's own dimensions are distinct, so exclusive-or adds and takes away: the signature is the whole word's
    value without that of the parts left out.
    """
    n = PARTS[d]
    parts = counted.select("word", "n", _part_sums(F.col("word"), n).alias("sums"), length.cast("int").alias("length"))
    parts = parts.withColumn("all", F.aggregate("sums", F.lit(0).cast("long"), lambda a, s: a.bitwiseXOR(s)))
    # One expression for all choices, so that the generated code stays small.
    choices = F.array(*(F.array(*map(F.lit, c)) for c in combinations(range(n), d)))
    left = lambda c: F.aggregate(c, F.col("all"), lambda a, i: a.bitwiseXOR(F.element_at("sums", i + 1)))
    sigs = F.transform(choices, lambda c: F.xxhash64(c, left(c), F.col("length")))
    return parts.select(F.explode(sigs).alias("sig"), "word", "n")


def _joined(a: DataFrame, b: DataFrame, large: DataFrame) -> DataFrame:
    """``(a, na, b, nb)`` of verified pairs: one edit apart, equal lengths once. Large signatures are met by tiles."""
    a = a.join(large, "sig", "left").select("sig", F.pmod(F.xxhash64("word"), F.coalesce("tiles", F.lit(1))).cast("int").alias("tile"), F.col("word").alias("a"), F.col("n").alias("na"))
    b = b.join(large, "sig", "left").select("sig", F.explode(F.sequence(F.lit(0), F.coalesce("tiles", F.lit(1)) - 1)).alias("tile"), F.col("word").alias("b"), F.col("n").alias("nb"))
    near = (F.levenshtein("a", "b", 1) == 1) & ((F.length("a") < F.length("b")) | (F.col("a") < F.col("b")))
    # Spark sizes an exploded table like the words it comes from, and would broadcast all of their signatures.
    return a.join(b.hint("merge"), ["sig", "tile"]).filter(near).select("a", "na", "b", "nb")


def _large(keys: DataFrame) -> DataFrame:
    """``(sig, tiles)`` of signatures that more than :data:`TILE` words share."""
    counts = keys.groupBy("sig").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > TILE)
    return written(counts.select("sig", F.ceil(F.col("c") / TILE).cast("int").alias("tiles")), "large")


def near_pairs(counted: DataFrame) -> DataFrame:
    """``(a, na, b, nb)``: every two words exactly one edit apart, in both directions, once or more often."""
    size = F.length("word")
    same = signatures(counted, 2, size)
    short, long = signatures(counted, 1, size), signatures(counted, 1, size - 1)
    pairs = _joined(same, same, _large(same)).unionByName(_joined(short, long, _large(short)))
    both = F.array(F.struct("a", "na", "b", "nb"), F.struct(F.col("b").alias("a"), F.col("nb").alias("na"), F.col("a").alias("b"), F.col("na").alias("nb")))
    return pairs.select(F.inline(both))


def grouped(counted: DataFrame, factor: int = 5) -> DataFrame:
    """Each word of ``counted(word, n)`` with its form, the root of its forms and the number of its near words.

    A word's form is its most frequent near word (the first in code-point order of equals), if that is at least
    ``factor`` times as frequent. Counts grow along a chain of forms, so it ends; roots are found by doubling.
    """
    counted = written(counted, "words")
    # Dealt by one end, a pair's repetitions meet and its word's near words are counted without another shuffle.
    pairs = near_pairs(counted).repartition("a").dropDuplicates(["a", "b"])
    best = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("nb")).alias("o"), "b")).alias("best"))
    best = best.select(F.col("a").alias("word"), "n_near", F.col("best.b").alias("b"), (-F.col("best.o")).alias("nb"))
    stated = counted.join(best, "word", "left").withColumn("has", F.col("nb") >= factor * F.col("n"))
    stated = written(stated.select("word", F.when(F.col("has"), F.col("b")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                   F.when(F.col("has"), F.col("nb")).alias("form_n")), "forms")
    roots = stated.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    moved = True
    while moved:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots, _ = materialize(roots.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        moved = not roots.filter("moved").isEmpty()
        roots = roots.select("word", "root")
    return stated.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 6, fewest: int = 5, factor: int = 5) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of the words of all texts."""
    return grouped(words(damaged(runs(docs, id_col, text_col)), shortest, fewest), factor)
