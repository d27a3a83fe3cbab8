"""What several operators share: written intermediates, sorted runs in a task, components, tiles, word scanning."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import materialize, new_path

#: Bytes that end a word: 0x20 and 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends there."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def int64(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows, so that neither Python's copy of the texts nor a result batch holds more."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def matrix(column: pa.Array) -> np.ndarray:
    """Equally long number lists as one matrix of doubles."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else flat.reshape(0, 0)


def runs(batches: Iterator[pa.RecordBatch], keys: int, columns: Callable[[pa.RecordBatch], list[np.ndarray]]) -> Iterator[list[np.ndarray]]:
    """Groups of consecutive rows with equal values in the first ``keys`` arrays of ``columns(batch)``.

    Holds one group at a time, so callers bound the size of their groups.
    """
    held: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = columns(batch)
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for k in cols[:keys]:
            change |= k[1:] != k[:-1]
        starts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        if held and any(held[-1][i][-1] != cols[i][0] for i in range(keys)):
            yield [np.concatenate(x) for x in zip(*held, strict=True)]
            held = []
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            part = [c[a:b] for c in cols]
            if b < batch.num_rows:
                yield [np.concatenate(x) for x in zip(*held, part, strict=True)] if held else part
                held = []
            else:
                held.append(part)
    if held:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def _scrambled(c: Column) -> Column:
    """A one-to-one scramble of 64-bit ids, so that chains of consecutive ids contract fast."""
    x = c.bitwiseXOR(F.shiftleft(c, 13))
    x = x.bitwiseXOR(F.shiftrightunsigned(x, 7))
    return x.bitwiseXOR(F.shiftleft(x, 17))


def _unscrambled(c: Column) -> Column:
    """The id that :func:`_scrambled` maps to ``c``: each of its steps undone, last first."""
    x = c.bitwiseXOR(F.shiftleft(c, 17)).bitwiseXOR(F.shiftleft(c, 34)).bitwiseXOR(F.shiftleft(c, 51))
    for n in (7, 14, 28, 56):
        x = x.bitwiseXOR(F.shiftrightunsigned(x, n))
    return x.bitwiseXOR(F.shiftleft(x, 13)).bitwiseXOR(F.shiftleft(x, 26)).bitwiseXOR(F.shiftleft(x, 39)).bitwiseXOR(F.shiftleft(x, 52))


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` of every end of ``edges(a, b)``: the smallest id that links reach.

    Each round maps every node to the smallest neighbour (ids are scrambled first, so a
    constant share of nodes vanishes a round even on chains) and relabels the edges. A
    node's edges are never gathered: minima combine before the shuffle, relabelling is a
    join whose large keys are split. The rounds' maps are written and joined once at the end;
    repeated edges only take part in minima, so no round pays a shuffle to drop them.
    """
    ends = edges.filter("a <> b").select(_scrambled(F.col("a").cast("long")).alias("u"), _scrambled(F.col("b").cast("long")).alias("v"))
    both = F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))))
    live, n = materialize(ends.select(both), "live")
    if not n:
        return edges.sparkSession.createDataFrame([], "id long, component long")
    steps: list[DataFrame] = []
    while n:
        step = written(live.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "step")
        steps.append(step)
        to = live.join(step.withColumnRenamed("m", "mu"), "u").select("mu", F.col("v").alias("u"))
        to = to.join(step.withColumnRenamed("m", "mv"), "u").select(F.col("mu").alias("u"), F.col("mv").alias("v"))
        live, n = materialize(to.filter("u <> v"), "live")
    label = steps[0]  # the first round saw every end
    for step in steps[1:]:
        label = label.join(step.select(F.col("u").alias("m"), F.col("m").alias("next")), "m", "left").select("u", F.coalesce("next", "m").alias("m"))
    named = written(label.select(_unscrambled(F.col("u")).alias("id"), "m"), "named")
    return named.join(named.groupBy("m").agg(F.min("id").alias("component")), "m").select("id", "component")


def valid_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, v)``: one row per id whose vector can be compared, as doubles.

    Left out: null ids, vectors that are null, empty, all zero or hold null or non-finite
    components, and those not of the table's most frequent length. Of several vectors
    under one id the smallest in array order stands for it.
    """
    v = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    rows = rows.filter(
        "id IS NOT NULL AND v IS NOT NULL AND size(v) > 0 AND "
        "forall(v, x -> x IS NOT NULL AND x = x AND abs(x) < double('inf')) AND exists(v, x -> x <> 0)")
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.filter(F.size("v") == (sizes[0]["n"] if sizes else 0)).groupBy("id").agg(F.min("v").alias("v"))


def unit(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; the largest component goes first, so squares stay finite."""
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


#: Rows of a side in one tile of a bucket.
TILE = 2048


def tiled(members: DataFrame, probers: DataFrame, key: Sequence[str], fn: Callable, schema: str) -> DataFrame:
    """Every prober meets every member of its bucket ``key``; ``fn`` maps the sorted batches of tiles.

    Both sides have columns ``key``, ``id``, ``w`` (long) and ``v`` (array<double>). A bucket whose
    side has more than :data:`TILE` rows is cut into tiles of about that many, so a hot bucket
    is many tasks' work and a task holds one tile at a time. ``fn`` sees rows
    ``(*key, tm, tp, role, id, w, v)`` ordered by tile, members (role 0) first.
    """
    def counted(df: DataFrame, n: str) -> DataFrame:
        return df.groupBy(*key).agg(F.count(F.lit(1)).alias(n)).filter(F.col(n) > TILE).select(
            *key, F.ceil(F.col(n) / TILE).cast("int").alias(n))

    large = written(counted(members, "nm").join(counted(probers, "np"), list(key), "full").na.fill(1, ["nm", "np"]), "large")
    chunk = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    # Few buckets are large; the join goes by Spark's own size threshold.
    m = members.join(large, list(key), "left").na.fill(1, ["nm", "np"])
    p = probers.join(large, list(key), "left").na.fill(1, ["nm", "np"])
    m = m.select(*key, chunk("nm").alias("tm"), every("np").alias("tp"), F.lit(0).alias("role"), "id", "w", "v")
    p = p.select(*key, every("nm").alias("tm"), chunk("np").alias("tp"), F.lit(1).alias("role"), "id", "w", "v")
    tile = [*key, "tm", "tp"]
    return m.unionByName(p).repartition(*tile).sortWithinPartitions(*tile, "role").mapInArrow(fn, schema)


class _Uncut(Exception):
    """A piece that the cutting rule does not cover: its text is encoded as a whole."""


class PieceCoder(dict):
    """Token ids of whole texts, remembered by piece: a store from pieces to their ids, which learns a missing piece.

    Pieces are cut where the tokenizer's own pre-tokenizer always cuts (see ``pieces``), so joining the
    pieces' ids gives the text's ids; the vocabulary's merges never cross a cut. A new piece of
    Latin-1 is cut into the pre-tokenizer's parts, which recur more often, are pieces themselves, and go straight to the
    library's model; other pieces, and texts that the cutting rule does not cover, are encoded as texts.
    ``limit`` bounds the memory: a full store starts anew.
    """

    #: The pre-tokenizers' patterns, with the letters, numbers and white space of Latin-1.
    _PARTS = {
        "spaces": r" ?[L]+| ?[N]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^WLN]+|[W]+(?![^W])|[W]+",
        "words": r"[L]+|[N]|'s|'t|'re|'ve|'m|'ll|'d|[^WLN]+",
    }
    _CLASSES = {"L": "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "N": "0-9\xb2\xb3\xb9\xbc-\xbe", "W": "\t-\r \x85\xa0"}

    def __init__(self, path: str, cut: str, limit: int = 800_000):
        import os

        from tokenizers import Tokenizer

        super().__init__()
        # One task, one thread: the library must not start a pool in each worker.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.cut, self.limit = Tokenizer.from_file(path), cut, limit
        with open(path, encoding="utf-8") as f:
            special = [t["content"] for t in json.load(f)["added_tokens"]]
        # Python counts these four controls as white space, the tokenizer does not.
        self.uncut = (*special, "\x1c", "\x1d", "\x1e", "\x1f")
        self.split = re.compile("".join(self._CLASSES.get(c, c) for c in self._PARTS[cut])).findall
        # The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(plain)]
        self.alphabet = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
        # Each id's four bytes.
        self.codes = [i.to_bytes(4, "little") for i in range(max([-1, *self.tokenizer.get_vocab().values()]) + 1)]

    def _encode(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _part(self, part: str) -> bytes:
        # ASCII letters and digits stand for themselves.
        if part.isascii() and part[1:].isalnum() and (part[0] == " " or part[0].isalnum()):
            raw = self.alphabet[32] + part[1:] if part[0] == " " else part
        else:
            raw = part.encode().decode("latin-1").translate(self.alphabet)
        codes = self.codes
        return b"".join([codes[t.id] for t in self.tokenizer.model.tokenize(raw)])

    def pieces(self, text: str) -> list[str] | None:
        if any(s in text for s in self.uncut):
            return None
        if self.cut == "words":  # white space is dropped by the tokenizer and always ends a piece
            return text.split()
        # A space before a character that is not white space always starts a piece; others are met in __missing__.
        return text.replace(" ", "\x1c ").split("\x1c")

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        known = self.__getitem__
        for text in texts:
            cut = self.pieces(text)
            try:
                yield self._encode(text) if cut is None else b"".join(map(known, cut))
            except _Uncut:
                yield self._encode(text)

    def __missing__(self, piece: str) -> bytes:
        if not piece:
            return b""
        if len(self) >= self.limit:
            self.clear()
        words = self.cut == "words"
        if not words and piece[0] == " " and (len(piece) == 1 or piece[1].isspace()):
            raise _Uncut
        if not piece.isascii() and max(piece) > "\xff":
            self[piece] = ids = self._encode(piece)
            return ids
        lower = piece.lower() if words else piece
        # Letters, with a space before them or not, are one part: no need to search for its ends.
        parts = (lower,) if (lower[1:] if lower[0] == " " else lower).isalpha() else self.split(lower)
        found = []
        for part in parts:
            ids = self.get(part)
            if ids is None:
                self[part] = ids = self._part(part)
            found.append(ids)
        self[piece] = ids = b"".join(found) if len(found) > 1 else found[0]
        return ids


@lru_cache(maxsize=2)
def piece_coder(path: str, cut: str) -> PieceCoder:
    """One coder a worker process, so that tasks which follow one another share what is known."""
    return PieceCoder(path, cut)
