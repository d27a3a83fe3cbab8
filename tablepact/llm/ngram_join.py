"""Set similarity join of word n-grams by a pigeonhole on a partitioned universe.

Shingles are hashed into segments, more of them for larger sets; a document's subset in a segment is
one signature. Two sets that are similar enough differ in at most ``reach`` shingles, so of
``reach + 1 + spare`` segments they agree in at least ``1 + spare``. Segments are allotted by cost:

* empty segments, and subsets that too many unrelated documents share, are passed over; ``spare`` pays for them;
* of the others, so many must agree exactly as ``spare`` leaves to ask for (``need``, at least one);
* documents that pass over too many for that are joined among themselves on half as many, larger segments,
  matched up to one deletion (a subset meets itself and its one-deletion neighbourhood).

Candidates that meet in a key are sifted by sketches there: the parities of shingles' counts in 512 places bound
from below in how many shingles two sets differ, so nothing similar is lost. What is left is verified on whole sets,
unless links found before hold its documents together already. Nothing is sampled, capped or dropped.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, int64, written

#: Ratio of the sizes in a band.
BAND = 1.4
#: Unrelated groups that share a subset before it counts as costly.
COSTLY = 24
#: Rows of candidates (some 64 MB) or of known components that are broadcast at most; beyond, texts or keys are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Members that one task compares with a copy of their centre.
STAR = 256

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP = np.zeros(256, dtype=bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTES = _mix(np.arange(1, 257, dtype=_U) * _ODD)
_PLACES = _mix(np.arange(1001, 1101, dtype=_U) * _ODD) | _U(1)
_BASE = 0x2545F4914F6CDD1D


_SPOTS = _mix(np.arange(1, (1 << 16) + 1, dtype=_U) * _ODD + _U(77)) | _U(1)
#: Bytes of text that are hashed together.
BATCH = 1 << 18


def shingles_of(texts: Sequence[str | None], n: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its ``n``-word shingles; a shorter text is one shingle, an empty one none."""
    out: list[np.ndarray] = []
    part: list[bytes] = []
    size = 0
    for text in texts:
        part.append((text or "").encode("utf-8", "surrogatepass"))
        size += len(part[-1])
        if size >= BATCH:
            out += _hashed(part, n)
            part, size = [], 0
    return out + _hashed(part, n) if part else out


def _hashed(texts: list[bytes], n: int) -> list[np.ndarray]:
    raw = _LOWER[np.frombuffer(b" ".join(texts), np.uint8)]
    gap = _GAP[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]]).view(np.int8)))
    starts, lengths = edge[::2], edge[1::2] - edge[::2]
    none = np.zeros(0, dtype=_U)
    if not len(starts):
        return [none] * len(texts)
    at = np.cumsum([0] + [len(t) + 1 for t in texts])
    bounds = np.searchsorted(starts, at)  # first word of each text
    with np.errstate(over="ignore"):
        first = np.cumsum(lengths) - lengths
        spot = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        words = np.add.reduceat(_BYTES[raw[~gap]] * _SPOTS[spot & 0xFFFF] + (spot >> 16).astype(_U), first)
        words = _mix(words + lengths.astype(_U) * _ODD)
        placed = [words * _PLACES[i] + _PLACES[i + 50] for i in range(n)]
        placed = [x ^ (x >> _U(29)) for x in placed]

        def windows(a: int, b: int, k: int) -> np.ndarray:
            m = b - a - k + 1
            acc = np.full(m, k, dtype=_U)
            for i in range(k):
                acc += placed[i][a + i : a + i + m]
            return acc

        whole = _mix(windows(0, len(words), n)) if len(words) >= n else none
        return [np.unique(whole[a : b - n + 1]) if b - a >= n else _mix(windows(a, b, b - a)) if b > a else none
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


class Bands:
    """Size bands and their segment counts for a similarity of at least ``percent`` / 100."""

    def __init__(self, percent: int):
        self.percent = percent
        self.low = [1]

    def of(self, size: int) -> int:
        while self.low[-1] <= size:
            self.low.append(int(self.low[-1] * BAND) + 1)
        return int(np.searchsorted(self.low, size, side="right")) - 1

    def slots(self, size: int) -> list[int]:
        """The own band, and the next one if a set of it can be similar."""
        k = self.of(size)
        top = self.low[k + 1]
        return [k, k + 1] if 100 * size >= self.percent * top else [k]

    def reach(self, slot: int) -> int:
        """Most shingles in which two similar sets differ, neither larger than the band's top: (a + b)(1 - s)/(1 + s)."""
        self.of(self.low[min(slot, len(self.low) - 1)])
        while len(self.low) < slot + 2:
            self.low.append(int(self.low[-1] * BAND) + 1)
        return 2 * (self.low[slot + 1] - 1) * (100 - self.percent) // (100 + self.percent)

    def spare(self, slot: int) -> int:
        return (self.reach(slot) + 1) * 12 // 100 + 2


def _segments(sets: list[np.ndarray], slots: np.ndarray, m: np.ndarray, scheme: int):
    """Of sets laid end to end: shingle values, their segment among all, each segment's sum, count and key place."""
    sizes = np.array([len(x) for x in sets])
    base = np.cumsum(m) - m
    with np.errstate(over="ignore"):
        s, seed = np.concatenate(sets), _mix((slots * 2 + scheme + 1).astype(_U) * _ODD)
        seeds, many = np.repeat(seed, sizes), np.repeat(m.astype(_U), sizes)
        seg = ((_mix(s ^ seeds) >> _U(32)) * many >> _U(32)).astype(np.int64) + np.repeat(base, sizes)
        value = _mix(s * _ODD + seeds)
        low = np.bincount(seg, (value & _U(0xFFFFFFFF)).astype(np.float64), int(m.sum()))
        high = np.bincount(seg, (value >> _U(32)).astype(np.float64), int(m.sum()))
        total = low.astype(_U) + (high.astype(_U) << _U(32))
        place = (np.arange(int(m.sum())) - np.repeat(base, m)).astype(_U) * _U(4096) + np.repeat(slots, m).astype(_U)
        return value, seg, total, np.bincount(seg, minlength=int(m.sum())), _mix(place * _U(2) + _U(scheme + 1))


def _slotted(sets: list[np.ndarray], bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Index of the set and slot of every (set, slot) in which sets of that size can differ and be similar."""
    pairs = [(i, k) for i, s in enumerate(sets) if len(s) for k in bands.slots(len(s)) if bands.reach(k)]
    return np.array([i for i, _ in pairs], dtype=np.int64), np.array([k for _, k in pairs], dtype=np.int64)


#: ``meta`` of a key: slot * NEEDS + how many keys of the slot must be shared.
NEEDS = 1 << 20


def exact_keys(sets: list[np.ndarray], bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the subsets that must agree exactly, with the index of their set and ``meta``.

    Empty segments are passed over where ``spare`` pays for them, and are keys like others elsewhere.
    """
    which, slots = _slotted(sets, bands)
    if not len(which):
        return np.zeros(0, np.int64), which, slots
    spare = np.array([bands.spare(k) for k in slots.tolist()])
    m = np.array([bands.reach(k) for k in slots.tolist()]) + 1 + spare
    _, _, total, count, place = _segments([sets[i] for i in which], slots, m, 0)
    empty = np.add.reduceat((count == 0).astype(np.int64), np.cumsum(m) - m)
    need = np.where(empty <= spare, 1 + spare - empty, 1)
    keep = (count > 0) | np.repeat(empty > spare, m)
    return _mix(total ^ place).view(np.int64)[keep], np.repeat(which, m)[keep], np.repeat(slots * NEEDS + need, m)[keep]


def deletion_keys(sets: list[np.ndarray], bands: Bands, slot_of: list[set[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, index of their set, and which are one-deletion neighbours, in the given slots of each set."""
    which, slots = _slotted(sets, bands)
    keep = np.array([k in slot_of[i] for i, k in zip(which.tolist(), slots.tolist(), strict=True)], dtype=bool)
    which, slots = which[keep], slots[keep]
    if not len(which):
        return np.zeros(0, np.int64), which, np.zeros(0, bool)
    m = np.array([bands.reach(k) for k in slots.tolist()]) // 2 + 1
    value, seg, total, _, place = _segments([sets[i] for i in which], slots, m, 1)
    with np.errstate(over="ignore"):
        less = _mix((total[seg] - value) ^ place[seg])
    sizes = np.array([len(sets[i]) for i in which])
    return (np.concatenate([_mix(total ^ place), less]).view(np.int64), np.concatenate([np.repeat(which, m), np.repeat(which, sizes)]),
            np.concatenate([np.zeros(len(total), bool), np.ones(len(less), bool)]))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _prints(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    with np.errstate(over="ignore"):
        return [(int(_mix(s).sum(dtype=_U).view(np.int64)), int(np.bitwise_xor.reduce(s).view(np.int64))) if len(s) else (0, 0) for s in sets]


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose key is not alone, with the first node of the key; rows come sorted by key and node.

    A key, random bits so far, gives way to the task's and its own number: these ascend, so later shuffles and files
    compress better. A key's rows are all in one task.
    """
    held: list[np.ndarray] = []  # the last row, its key's first node, whether a row before has its key, and the key's number
    context = TaskContext.get()
    last = (context.partitionId() if context else 0) << 40
    names = ["key", "node", "meta", "first"]
    for batch in batches:
        if not batch.num_rows:
            continue
        k, n, e = (int64(batch[c]) for c in names[:3])
        if held:
            k, n, e = (np.concatenate([h, x]) for h, x in zip(held, (k, n, e), strict=False))
        same = np.concatenate([[False], k[1:] == k[:-1]])
        start = np.maximum.accumulate(np.where(same, 0, np.arange(len(k))))
        first = n[start]
        if held:
            first[start == 0] = held[3]
            same[0] = held[4][0]
        keep = same.copy()
        keep[:-1] |= k[1:] == k[:-1]
        number = last + np.cumsum(np.concatenate([[False], k[1:] != k[:-1]]))
        last = int(number[-1])
        held = [x[-1:] for x in (k, n, e, first, same, number)]
        keep[-1] = False  # until the next row is known
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (number, n, e, first)], names=names)
    if held and held[4][0]:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (held[5], *held[1:4])], names=names)


#: 64-bit words of a document's sketch.
WORDS = 8
_SKETCH = [f"s{i}" for i in range(WORDS)]
#: Rows of a key that one task compares; larger groups are cut into tiles.
TILE = 4096


def _sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Per set the parities of its shingles' counts in 512 places: two sets differ in at least as many shingles as places."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = np.concatenate([*sets, np.zeros(0, dtype=_U)])
    place = (flat & _U(64 * WORDS - 1)).astype(np.int64)
    odd = np.bincount(owner * 64 * WORDS + place, minlength=64 * WORDS * len(sets)) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64).reshape(len(sets), WORDS)


def _met(batches: Iterator[pa.RecordBatch], percent: int, deletions: bool) -> Iterator[pa.RecordBatch]:
    """Pairs ``(a, b, meta)`` of nodes from different components that meet in a tile of a key and may be similar by their sketches.

    Rows come sorted by ``key, tx, ty``. A tile of two different chunks pairs rows across them only. With ``deletions``, one
    side's subset must be exact (``meta`` 0). Otherwise a pair's ``meta`` is the larger one: the slot is the
    same, so that is the larger need. A node of several texts has no sketch and meets all.
    """
    names = ["key", "tx", "ty", "chunk", "comp", "node", "meta", "size", *_SKETCH]

    def pairs(cols: list[np.ndarray], change: np.ndarray) -> Iterator[pa.RecordBatch]:
        _, tx, ty, chunk, comp, node, meta, size = cols[:8]
        bits = np.stack(cols[8:], axis=1)
        begin = np.concatenate([[0], change, [len(node)]])
        end = np.repeat(begin[1:], np.diff(begin))
        out, held, d, at = [], 0, 1, np.arange(len(node))
        while True:
            at = at[at + d < end[at]]
            if not len(at):
                break
            x, y = at, at + d
            ok = (comp[x] != comp[y]) & ((tx[x] == ty[x]) | (chunk[x] != chunk[y]))
            if deletions:
                ok &= (meta[x] == 0) | (meta[y] == 0)
            free = (size[x] < 0) | (size[y] < 0)
            ok &= free | (100 * np.minimum(size[x], size[y]) >= percent * np.maximum(size[x], size[y]))
            x, y, free = x[ok], y[ok], free[ok]
            differ = np.bitwise_count(bits[x] ^ bits[y]).sum(axis=1, dtype=np.int64)
            ok = free | (differ * (100 + percent) <= (size[x] + size[y]) * (100 - percent))
            x, y = x[ok], y[ok]
            if len(x):
                out.append((np.minimum(node[x], node[y]), np.maximum(node[x], node[y]), np.maximum(meta[x], meta[y])))
                held += len(x)
            if held > 1 << 16:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["a", "b", "meta"])
                out, held = [], 0
            d += 1
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["a", "b", "meta"])

    def changes(cols: list[np.ndarray]) -> np.ndarray:
        return np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1])) + 1

    held: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [int64(batch[c]) for c in names]
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
        change = changes(cols)
        cut = int(change[-1]) if len(change) else 0
        if cut:  # the last tile may go on in the next batch
            yield from pairs([c[:cut] for c in cols], change[:-1])
        held = [c[cut:] for c in cols]
    if held is not None:
        yield from pairs(held, changes(held))


def jaccard_join(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``doc_id, n_shingles, component_id``.

    Two documents link when the Jaccard index of their sets of ``n``-word shingles is at least ``percent`` / 100
    (compared in whole numbers); ``component_id`` is the smallest ``doc_id`` that links reach. Sets hold
    64-bit hashes of whole shingles. Null or empty texts have no shingle and no link. Rows of equal ids are
    one node with several texts; a null id has no node and a null component. Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bands = Bands(percent)

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = shingles_of(part["text"].to_pylist(), n)
                both, bits = _prints(sets), _sketches(sets)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array([len(s) for s in sets], pa.int64()), pa.array([p for p, _ in both], pa.int64()),
                     pa.array([q for _, q in both], pa.int64()), *(pa.array(np.ascontiguousarray(c)) for c in bits.T)],
                    names=["doc_id", "n_shingles", "f1", "f2", *_SKETCH])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()  # combines copies before the shuffle; at most the documents of a split
        for batch in batches:
            ids = int64(batch["doc_id"])
            for at in range(0, len(ids), 256):
                sets = shingles_of(batch["text"].slice(at, 256).to_pylist(), n)
                marks = _prints(sets)
                new = [i for i, m in enumerate(marks) if len(sets[i]) and m not in seen and not seen.add(m)]
                k, which, meta = exact_keys([sets[i] for i in new], bands)
                if len(k):
                    yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(ids[at : at + 256][np.array(new)[which]]), pa.array(meta.astype(np.int32))],
                                                     names=["key", "node", "meta"])

    known = docs.filter("doc_id IS NOT NULL")
    each = written(docs.mapInArrow(prints, "doc_id long, n_shingles long, f1 long, f2 long, " + ", ".join(f"{c} long" for c in _SKETCH)), "prints")
    sets = each.filter("doc_id IS NOT NULL AND n_shingles > 0")
    # Of an id with several texts there is no one sketch.
    one = " AND ".join(f"min({c}) = max({c})" for c in ("n_shingles", "f1", "f2"))
    sketch = written(sets.groupBy(F.col("doc_id").alias("node")).agg(
        F.expr(one).alias("one"), F.max("n_shingles").alias("size"), *(F.max(c).alias(c) for c in _SKETCH)).filter("one").drop("one"), "sketches")
    first = sets.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("a"), F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
    copies = written(sets.join(first, ["f1", "f2", "n_shingles"]).filter("a <> doc_id").select("a", F.col("doc_id").alias("b")), "copies")

    shared = written(known.mapInArrow(keys, "key long, node long, meta int").repartition("key").sortWithinPartitions("key", "node").mapInArrow(
        _shared, "key long, node long, meta long, first long"), "shared")
    need = F.pmod(F.col("meta"), F.lit(NEEDS))
    slot = F.shiftright("meta", 20).alias("slot")

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs ``(a, b)`` that link; every centre ``a`` is split into stars of about ``STAR`` members."""
        stars = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / STAR).cast("int").alias("n"))
        centre = stars.select(F.col("a").alias("node"), "a", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("salt"), F.lit(None).cast("long").alias("b"))
        member = pairs.join(stars, "a").select(F.col("b").alias("node"), "a", F.pmod(F.xxhash64("b"), F.col("n")).cast("int").alias("salt"), "b")
        # Texts meet what is to be done with them at once, so they are shuffled to their star only.
        roles = written(centre.unionByName(member), "roles")
        few = roles.count() <= BROADCAST_IDS
        rows = known.join(F.broadcast(roles) if few else roles, known["doc_id"] == roles["node"]).select("a", "salt", "b", "text")

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, centres = None, []
            for part in (batch.slice(i, 256) for batch in batches for i in range(0, batch.num_rows, 256)):
                found = []
                sets = shingles_of(part["text"].to_pylist(), n)
                for a, salt, b, s in zip(*(part[c].to_pylist() for c in ("a", "salt", "b")), sets, strict=True):
                    if (a, salt) != at:
                        at, centres = (a, salt), []
                    if b is None:
                        centres.append(s)
                    elif any(similar(s, x, percent) for x in centres):
                        found.append((a, b))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

        rows = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
        return written(rows.mapInArrow(compare, "a long, b long"), "links")

    def plausible(pairs: DataFrame) -> DataFrame:
        """The pairs ``(a, b)`` whose sketches do not rule a link out."""
        for side in "ab":
            named = sketch.select(F.col("node").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in ("size", *_SKETCH)))
            pairs = pairs.join(named, side, "left")
        differ = " + ".join(f"bit_count(a_{c} ^ b_{c})" for c in _SKETCH)
        return pairs.filter(f"a_size IS NULL OR b_size IS NULL OR (100 * least(a_size, b_size) >= {percent} * greatest(a_size, b_size) AND "
                            f"({differ}) * {100 + percent} <= (a_size + b_size) * {100 - percent})").select("a", "b")

    key = Window.partitionBy("key")

    def open_keys(df: DataFrame, joined: DataFrame) -> DataFrame:
        """Rows ``(key, node, meta)`` whose key holds several components, with their component, the key's rows and components, and
        the key's first row; ``lead`` marks the first row of a component."""
        named = joined.withColumnRenamed("id", "node")
        df = df.select("key", "node", "meta").join(F.broadcast(named) if joined.count() <= BROADCAST_IDS else named, "node", "left")
        df = df.select("key", F.coalesce("component", "node").alias("comp"), "node", "meta")
        inside = key.orderBy("comp", "node")
        df = df.select("*", F.dense_rank().over(key.orderBy("comp")).alias("rank"), F.lag("comp").over(inside).alias("before"),
                       F.first("node").over(inside).alias("first"), F.first("meta").over(inside).alias("first_meta"))
        df = df.select("key", "comp", "node", "meta", "first", "first_meta", F.expr("before IS NULL OR before <> comp").alias("lead"),
                       F.max("rank").over(key).alias("comps"), F.count(F.lit(1)).over(key).alias("rows"))
        return written(df.filter("comps > 1"), "open")

    def meeting(rows: DataFrame, deletions: bool) -> DataFrame:
        """``(a, b, meta)`` of rows that meet in a key, come from different components and may be similar."""
        n = F.ceil(F.col("rows") / TILE).cast("long")
        df = rows.withColumn("tiles", n).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("tiles")))
        df = df.join(sketch, "node", "left").select("key", "chunk", "comp", "node", "meta", F.coalesce("size", F.lit(-1)).alias("size"), "tiles",
                                                    *(F.coalesce(c, F.lit(0)).alias(c) for c in _SKETCH))
        df = df.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
        df = df.select("key", F.least("chunk", "other").alias("tx"), F.greatest("chunk", "other").alias("ty"), "chunk", "comp", "node", "meta", "size", *_SKETCH)
        tile = ("key", "tx", "ty")
        return df.repartition(*tile).sortWithinPartitions(*tile).mapInArrow(lambda batches: _met(batches, percent, deletions), "a long, b long, meta long")

    def contracted(joined: DataFrame, new: DataFrame) -> DataFrame:
        """``joined`` with the links ``new(a, b)``: only components that a link touches are worked on."""
        for side in "ab":
            named = joined.select(F.col("id").alias(side), F.col("component").alias("c"))
            new = new.join(named, side, "left").withColumn(side, F.coalesce("c", side)).drop("c")
        to = written(components(written(new.select("a", "b"), "between")), "contracted")
        moved = joined.join(to.select(F.col("id").alias("component"), F.col("component").alias("to")), "component", "left")
        fresh = to.join(joined.select("id"), "id", "left_anti").select("id", "component")
        return written(moved.select("id", F.coalesce("to", "component").alias("component")).unionByName(fresh), "joined")

    # The neighbour that a node shares most keys with goes first; then components' first nodes; then what is left.
    most = shared.filter("node <> first").groupBy("first", "node", slot).agg(F.count(F.lit(1)).alias("n"), F.min(need).alias("need")).filter("n >= need")
    most = most.groupBy("node").agg(F.max(F.struct("n", "first")).alias("m")).select(F.col("m.first").alias("a"), F.col("node").alias("b"))
    joined = written(components(copies.unionByName(verified(written(plausible(most), "nearest")))), "joined")

    rows = open_keys(shared, joined)
    star = rows.filter("lead AND node <> first").select(
        F.least("first", "node").alias("a"), F.greatest("first", "node").alias("b"), F.greatest("meta", "first_meta").alias("meta"))
    star = star.groupBy("a", "b", slot).agg(F.count(F.lit(1)).alias("n"), F.min(need).alias("need")).filter("n >= need").select("a", "b").distinct()
    real = written(plausible(star), "real")
    if not real.isEmpty():
        joined = contracted(joined, verified(real))

    rows = open_keys(rows, joined)
    # Keys passed over lower what a pair must share: both sides' needs hold; less the larger number passed over is at most the larger of the two.
    over = written(rows.filter(F.col("comps") > COSTLY).groupBy("node", slot).agg(F.count(F.lit(1)).alias("over"), F.min(need).alias("need")).select(
        "node", "slot", "over", (F.col("need") - F.col("over")).alias("left")), "over")
    x, y = (over.select(F.col("node").alias(c), "slot", F.col("over").alias(f"over_{c}")) for c in "ab")
    pairs = written(meeting(rows.filter(F.col("comps") <= COSTLY), False).groupBy("a", "b", slot).agg(
        F.count(F.lit(1)).alias("n"), F.min(need).alias("need")), "pairs")
    pairs = pairs.join(x, ["a", "slot"], "left").join(y, ["b", "slot"], "left").filter(
        F.col("n") >= F.col("need") - F.greatest(F.coalesce("over_a", F.lit(0)), F.coalesce("over_b", F.lit(0))))
    real = written(pairs.select("a", "b").distinct(), "real")
    if not real.isEmpty():
        joined = contracted(joined, verified(real))

    loaded = written(over.filter("left <= 0").groupBy("node").agg(F.collect_set("slot").alias("slots")), "loaded")
    if not loaded.isEmpty():  # at most two slots a node
        few = loaded.count() <= BROADCAST_IDS

        def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, slots = int64(batch["doc_id"]), [set(x) for x in batch["slots"].to_pylist()]
                for at in range(0, len(ids), 256):
                    k, which, less = deletion_keys(shingles_of(batch["text"].slice(at, 256).to_pylist(), n), bands, slots[at : at + 256])
                    if len(k):
                        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(ids[at : at + 256][which]), pa.array(less.astype(np.int64))], names=["key", "node", "meta"])

        near = known.join(F.broadcast(loaded) if few else loaded, known["doc_id"] == loaded["node"]).select("doc_id", "text", "slots")
        close = open_keys(near.mapInArrow(neighbours, "key long, node long, meta long"), joined)
        real = written(meeting(close, True).select("a", "b").distinct(), "close")
        if not real.isEmpty():
            joined = contracted(joined, verified(real))
    return each.select("doc_id", "n_shingles").join(joined, F.col("doc_id") == F.col("id"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
