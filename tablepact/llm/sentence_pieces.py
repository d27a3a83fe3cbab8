"""SentencePiece encoding by backtracking over longest matches, and decoding.

A merge-type model joins, again and again, the best-scored pair of neighbours whose text is a piece. The
result needs no simulation of the merges: it is the only sequence of pieces in which each piece is what its own
text merges to, and each pair of neighbours stays apart when their joint text is merged again. A left-to-right
search for that sequence takes the longest piece that fits, tries shorter ones, and steps back where none is
compatible with the piece before; a bitfield remembers positions that led nowhere, so each is left once.

Defined results: a null text counts as empty; an empty text has no ids and decodes to an empty text; rows
are kept as they are, repeated or not; an empty table gives an empty one.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Stands for a space inside the library's texts (fixed value).
SPACE = "▁"
#: Characters of one output batch; a single longer text is a batch of its own.
BATCH_CHARS = 1 << 20
#: Chunks up to this many characters are remembered.
REMEMBERED = 64
#: Texts up to this many characters are merged on plain lists.
SHORT = 40
NEVER = float("-inf")


class Pieces:
    """A merge-type SentencePiece model as an exact encoder.

    ``limit`` bounds the number of remembered chunks, pairs and pieces each; a full store starts anew.
    """

    def __init__(self, model: bytes, limit: int = 600_000):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(model)
        if proto.trainer_spec.model_type != pb.TrainerSpec.BPE:
            raise ValueError("only merge-type models (BPE) are encoded here")
        kinds = pb.ModelProto.SentencePiece
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in proto.pieces):
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.library = SentencePieceProcessor(model_proto=model)
        self.limit = limit
        self.id = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        self.score = {p.piece: p.score for p in proto.pieces if p.type == kinds.NORMAL}
        self.text = [p.piece for p in proto.pieces]
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == kinds.UNKNOWN)
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE} if proto.trainer_spec.byte_fallback else {}
        letters = {c for p in self.id for c in p}
        single = {p for p in self.id if len(p) == 1}
        # Pieces that share a score have no fixed order among their merges; a character that is no piece itself may still
        # merge. The uniqueness argument covers neither, so their chunks are merged step by step.
        seen: dict[float, int] = {}
        for p in self.id:
            if len(p) > 1:
                seen[self.score[p]] = seen.get(self.score[p], 0) + 1
        tied = [p for p in self.id if len(p) > 1 and seen[self.score[p]] > 1]
        self.tied_spaces = any(set(p) == {SPACE} for p in tied)
        hard = [re.escape(p) for p in tied if set(p) != {SPACE}] + [re.escape(c) for c in sorted(letters - single)]
        self.hard = re.compile("|".join(sorted(hard, key=len, reverse=True))) if hard else None
        pairs = {p[i : i + 2] for p in self.id for i in range(len(p) - 1)}
        self.chunks = self._cutter(pairs, single)
        known = f"[{''.join(map(re.escape, sorted(single)))}]+" if single else "(?!)"
        self.parts, self.plain = re.compile(f"{known}|(?s:.)"), re.compile(known).fullmatch
        # Only pieces that their own text merges to can stand in a result.
        whole = {p for p in self.id if len(p) == 1 or self.merged(p) == [p]}
        self.automaton = ahocorasick.Automaton()
        for p in whole:
            self.automaton.add_word(p, len(p))
        self.automaton.make_automaton()
        #: The longest such piece that each path of the automaton's trie begins with, the path itself included.
        self.longest: dict[str, str] = {}
        for p in sorted(whole, key=len):
            for k in range(1, len(p) + 1):
                if p[:k] not in self.longest:
                    self.longest[p[:k]] = p[:k] if p[:k] in whole else self.longest[p[: k - 1]]
        self.reach = max(map(len, whole), default=1)
        #: The longest such piece that a piece begins with and is not; empty if there is none.
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in whole), "") for p in whole}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pair: dict[tuple[str, str], bool] = {}

    @staticmethod
    def _cutter(pairs: set[str], single: set[str]) -> Callable[[str], list[str]]:
        """Cuts a text where no piece has the two characters side by side, so that nothing merges across a cut: before
        spaces, between a letter and a mark that follows letters in no piece, and around white space that is no piece."""
        if any(b == SPACE != a for a, b in pairs):
            return lambda text: [text]
        lone = "".join(c for c in "\n\t\r" if c not in single)
        joined = {b for a, b in pairs if a.isalnum()}
        apart = "".join(map(re.escape, sorted(c for c in single if not c.isalnum() and c not in joined and c != SPACE)))
        marks = f"(?:(?![{SPACE}{lone}])[\\W_])*+"
        word = f"{marks}[^\\W_]++(?=[{SPACE}{lone}{apart}]|\\Z)"
        return re.compile(f"{SPACE}*(?:{word}|[^{SPACE}{lone}]+)|{SPACE}+" + (f"|[{lone}]+" if lone else "")).findall

    def merged(self, text: str) -> list[str]:
        """``text`` by the definition: the best-scored pair of neighbours merges, the leftmost of equals first."""
        n = len(text)
        if n <= SHORT:  # a list of scores is faster than a heap
            return self._merged_short(text)
        start, end = list(range(n)), list(range(1, n + 1))  # symbol i covers text[start[i]:end[i]]; merged ones end at 0
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[float, int, int, int]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0:
                score = self.score.get(text[start[a] : end[b]])
                if score is not None:
                    heapq.heappush(heap, (-score, a, b, end[b]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, a, b, stop = heapq.heappop(heap)
            if not end[a] or not end[b] or right[a] != b or end[b] != stop or end[a] != start[b]:
                continue
            end[a], end[b] = stop, 0
            right[a] = right[b]
            if right[b] >= 0:
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        return [text[s:e] for s, e in zip(start, end, strict=True) if e]

    def _merged_short(self, text: str) -> list[str]:
        parts, score = list(text), self.score.get
        scores = [score(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while scores:
            top = max(scores)
            if top == NEVER:
                break
            i = scores.index(top)
            parts[i] += parts.pop(i + 1)
            del scores[i]
            if i < len(scores):
                scores[i] = score(parts[i] + parts[i + 1], NEVER)
            if i:
                scores[i - 1] = score(parts[i - 1] + parts[i], NEVER)
        return parts

    def _apart(self, a: str, b: str) -> bool:
        """Whether ``a`` and ``b`` stay neighbours when their joint text is merged again."""
        if len(self.pair) >= self.limit:
            self.pair.clear()
        got = self.pair[a, b] = self.merged(a + b) == [a, b]
        return got

    def backtracked(self, text: str) -> list[str]:
        """The pieces of ``text``, whose characters are all pieces."""
        shorter, apart = self.shorter, self.pair
        if text in shorter:
            return [text]
        n, reach, longest, match = len(text), self.reach, self.longest, self.automaton.longest_prefix
        dead = bytearray(n // 8 + 1)  # a bit for each position that no compatible sequence goes on from
        found: list[str] = []
        at, before = 0, ""
        piece = longest[text[: match(text[:reach])]]
        while at < n:
            while piece:
                to = at + len(piece)
                if not dead[to >> 3] >> (to & 7) & 1:
                    if not before:
                        break
                    fits = apart.get((before, piece))
                    if self._apart(before, piece) if fits is None else fits:
                        break
                piece = shorter[piece]
            if piece:
                found.append(piece)
                at += len(piece)
                if at < n:
                    ahead = text[at : at + reach]
                    before, piece = piece, longest[ahead[: match(ahead)]]
            elif found:
                dead[at >> 3] |= 1 << (at & 7)
                piece = found.pop()
                at -= len(piece)
                before = found[-1] if found else ""
            else:
                return self.merged(text)
        return found

    def _ids(self, pieces: Iterable[str]) -> list[int]:
        ids: list[int] = []
        for p in pieces:
            if p in self.id:
                ids.append(self.id[p])
            elif self.bytes:
                ids += [self.bytes[b] for b in p.encode()]
            else:
                ids.append(self.unknown)
        return ids

    def _chunk(self, chunk: str) -> list[int]:
        if self.hard is not None and self.hard.search(chunk):
            return self._ids(self.merged(chunk))
        if not self.tied_spaces or SPACE * 2 not in chunk:
            if self.plain(chunk):
                return [self.id[p] for p in self.backtracked(chunk)]
            return self._ids(q for part in self.parts.findall(chunk) for q in (self.backtracked(part) if part[0] in self.id else [part]))
        # Runs of spaces: their merges come after all others, so the last space of a run goes to the word if the word takes it.
        ids: list[int] = []
        for run, word in re.findall(f"({SPACE}*)([^{SPACE}]*)", chunk):
            if not run and not word:
                continue
            rest = self._chunk(SPACE + word if run and word else word) if word else []
            if run and word and rest and self.text[rest[0]] != SPACE:
                run = run[1:]
            elif run and word:
                rest = rest[1:]
            ids += self._ids(self.merged(run)) + rest
        return ids

    def encode(self, text: str) -> np.ndarray:
        """The ids of ``text`` as the library's ``encode`` gives them."""
        text = self.library.normalize(text)
        if not text:
            return np.empty(0, dtype=np.int32)
        chunks = self.chunks(text)
        if len(self.known) > self.limit // 2:  # what the last texts did not use is forgotten
            self.older, self.known = self.known, {}
        known, older, long = self.known, self.older, {}
        for c in set(chunks).difference(known):
            if c in older:
                known[c] = older[c]
            else:
                (known if len(c) <= REMEMBERED else long)[c] = array("i", self._chunk(c)).tobytes()
        got = b"".join([known.get(c) or long[c] for c in chunks] if long else map(known.__getitem__, chunks))
        return np.frombuffer(got, dtype=np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The library's text of ``ids``."""
        return self.library.decode(ids.tolist()) if len(ids) else ""


@lru_cache(maxsize=2)
def _pieces(path: str) -> Pieces:
    """One model a worker process, shared by the tasks that follow one another."""
    with open(path, "rb") as f:
        return Pieces(f.read())


def _batches(batches: Iterator[pa.RecordBatch], rest: list[str], work: object, kind: pa.DataType, name: str) -> Iterator[pa.RecordBatch]:
    """Each row with a new last column ``name``: ``work`` of its first one, in batches of bounded size."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            out, size, start = [], 0, at
            while at < batch.num_rows and (size < BATCH_CHARS or at == start):
                out.append(work(batch.column(0)[at]))
                size += len(out[-1])
                at += 1
            kept = batch.slice(start, at - start)
            yield pa.RecordBatch.from_arrays([*(kept.column(c) for c in rest), pa.array(out, type=kind)], [*rest, name])


def _with(df: DataFrame, source: str, name: str, work: object, kind: pa.DataType, spark_type: str) -> DataFrame:
    """``df`` with a column ``name`` in place of any of that name."""
    rest = [c for c in df.columns if c != name]
    fields = [f for f in df.schema.fields if f.name != name]
    # Rows cross to Python once, under names of our own, so any column names may stand in the table.
    own = [f"c{i}" for i in range(len(rest))]
    sent = df.select(F.col(f"`{source}`").alias("source"), *(F.col(f"`{c}`").alias(o) for c, o in zip(rest, own, strict=True)))
    schema = ", ".join([*(f"{o} {f.dataType.simpleString()}" for o, f in zip(own, fields, strict=True)), f"made {spark_type}"])
    got = sent.mapInArrow(lambda b: _batches(b, own, work, kind, "made"), schema)
    return got.select(*(F.col(o).alias(c) for o, c in zip(own, rest, strict=True)), F.col("made").alias(name))


def encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with ``ids_col`` (array<int>): the ids of the whole ``text_col``, without begin or end ids."""
    def work(text: pa.Scalar) -> np.ndarray:
        return _pieces(path).encode(text.as_py() or "")

    return _with(df, text_col, ids_col, work, pa.list_(pa.int32()), "array<int>")


def decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with ``text_col``: the text that the ids of ``ids_col`` stand for. Null ids give an empty text."""
    def work(ids: pa.Scalar) -> str:
        return _pieces(path).decode(ids.values.to_numpy(zero_copy_only=False)) if ids.is_valid else ""

    return _with(df, ids_col, text_col, work, pa.string(), "string")
