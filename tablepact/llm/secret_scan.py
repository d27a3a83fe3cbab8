"""Secrets in text: fixed shapes, and strings that a primed compressor can't explain.

A candidate of the second sort stands in a sensitive context. Its novelty is the marginal number of
bytes it adds to its surroundings, compressed by zstandard with a dictionary of identifiers;
words, names and repeated text add little, random strings add nearly their entropy.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
# Runs are maximal, so a lower bound in the pattern equals dropping shorter matches.
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "novel")
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
_CONTEXT = re.compile(r"key|secret|token|passw|credential|auth|bearer|private|access|signature|pwd", re.I | re.A)
_NEAR = 48
_AROUND = 256
# Base64 has six bits of a byte: the most that the entropy coder leaves of a random string among others of its kind.
_AMONG = 0.75
# The last, shorter line of a wrapped key.
_TAIL = re.compile(r"[ \t]*\r?\n[ \t]*([A-Za-z0-9+/_=-]{1,15})(?=[ \t]*(?:\r?\n|\Z))")
_TAIL_LOOKS = re.compile(r"[A-Za-z0-9].*[0-9+/=]|[0-9+/=].*[A-Za-z0-9]|[a-z].*[A-Z]")
#: Plain prose, so that words cost in a short text what they cost in a long one.
PROSE = (
    "The committee met again on Thursday evening to discuss how the old library could be opened for visitors during the summer months, "
    "because many of the families living near the river had asked for a quiet place where children might read after school. Although "
    "nobody expected an immediate decision, several members explained that the building requires only small repairs, and that volunteers "
    "would gladly help with painting, cleaning and moving the heavy shelves before the first warm weekend of June. "
)

#: Identifiers that code holds anywhere; the scan's default dictionary.
IDENTIFIERS = (
    "access_token refresh_token client_secret client_id api_key secret_key private_key public_key password username "
    "authorization bearer signature credential certificate session_id request_id user_id account_id connection_string "
    "database_url hostname endpoint configuration environment production development localhost example.com application/json "
    "content-type https://www.example.com/index.html import from return function class public static void const string "
    "integer boolean null undefined true false default value export require module package version license copyright "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0000000000000000 xxxxxxxxxxxxxxxx your_token_here changeme"
)


class Novelty:
    """Marginal compressed bytes of a string beside its surroundings."""

    def __init__(self, dictionary: str = IDENTIFIERS, level: int = 9):
        words = zstandard.ZstdCompressionDict(dictionary.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.coder = zstandard.ZstdCompressor(level=level, dict_data=words, write_content_size=False, write_checksum=False, write_dict_id=False)

    def size(self, text: str) -> int:
        return len(self.coder.compress(text.encode("utf-8", "replace")))

    def of(self, candidate: str, around: str) -> float:
        """Added bytes per byte of the candidate."""
        return (self.size(around + candidate) - self.size(around)) / len(candidate)


def find_secrets(text: str, novelty: Novelty, threshold: float = 0.8) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` in code points, by start, then in the order of ``KINDS``.

    A novel span is 16 or more characters of a key's alphabet, not touched by another kind's span, that adds
    ``threshold`` bytes a character or more. It stands within 48 characters of a sensitive word, on either side, or of a
    span that does so or is carried on from one: the lines of a key, the keys of a list. Among other
    candidates it may add ``threshold`` only without them, if it adds three quarters of it with them. A shorter
    last line of a wrapped key belongs to it.
    """
    spans = []
    low = text.lower()
    if any(w in low for w in ("passw", "secret", "token", "api")):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    if spans or _CONTEXT.search(text):
        spans += [(a, b, "novel") for a, b in _novel(text, spans, novelty, threshold)]
    return sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def _explained(text: str, a: int, b: int, novelty: Novelty, threshold: float) -> bool:
    s, before, after = text[a:b], text[max(0, a - _AROUND) : a], text[b : b + _AROUND]
    # Words without a digit are common, and so are numbers: a short or odd text must not make them look random.
    mixed = any(c.isdigit() for c in s) and any(c.isalpha() for c in s)
    if not mixed and novelty.of(s, PROSE) < threshold:
        return True
    added = novelty.of(s, ("" if mixed else PROSE) + before + after)
    if added >= threshold or added < _AMONG * threshold:
        return added < threshold
    alone = _CANDIDATE.sub("", before) + _CANDIDATE.sub("", after)
    return len(alone) == len(before) + len(after) or novelty.of(s, PROSE + alone) < threshold


def _novel(text: str, base: list[tuple[int, int, str]], novelty: Novelty, threshold: float) -> list[tuple[int, int]]:
    taken: list[list[int]] = []  # the base spans, overlapping ones as one
    for a, b, _ in sorted(base):
        if taken and a < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], b)
        else:
            taken.append([a, b])
    starts = [a for a, _ in taken]

    def touched(a: int, b: int) -> bool:
        i = bisect.bisect_left(starts, b) - 1
        return i >= 0 and taken[i][1] > a

    items = sorted([*base, *((m.start(), m.end(), "") for m in _CANDIDATE.finditer(text) if not touched(m.start(), m.end()))])
    said: list[bool | None] = [True if k in ("assign", "access") else None for _, _, k in items]
    for order in (range(len(items)), range(len(items) - 1, -1, -1)):
        last = None  # the nearest span before, in this direction, that is context
        for i in order:
            a, b, k = items[i]
            if said[i] is None:
                close = last is not None and max(a - items[last][1], items[last][0] - b) <= _NEAR
                if close or _CONTEXT.search(text, max(0, a - _NEAR), a) or _CONTEXT.search(text, b, b + _NEAR):
                    said[i] = k == "hex" or not _explained(text, a, b, novelty, threshold)
            if said[i]:
                last = i
    out = []
    for (a, b, k), yes in zip(items, said, strict=True):
        if not yes or k:
            continue
        out.append((a, b))
        if b - a >= 32 and not text[text.rfind("\n", 0, a) + 1 : a].strip() and (m := _TAIL.match(text, b)) and not touched(m.start(1), m.end(1)):
            if _TAIL_LOOKS.search(m[1]) or text[m.end() : m.end() + 40].lstrip().startswith("-----END"):
                out.append(m.span(1))
    return out


def digest(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scan(docs: DataFrame, dictionary: str = IDENTIFIERS, threshold: float = 0.8) -> DataFrame:
    """Per row of ``docs``: ``doc_id, spans, n_assign, n_access, n_hex, n_novel, base_sha256``.

    ``spans`` lists ``kind:start:end``; the hash covers all but the novel ones. Null texts are empty, empty texts
    have no span, whole texts are read, repeated rows stay. Other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(dictionary)
        for batch in batches:
            found = [find_secrets(t or "", novelty, threshold) for t in batch["text"].to_pylist()]
            count = lambda k: pa.array([sum(s[2] == k for s in f) for f in found], pa.int64())  # noqa: E731, B023
            base = [hashlib.sha256(digest([s for s in f if s[2] != "novel"]).encode()).hexdigest() for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([digest(f) for f in found]), *(count(k) for k in KINDS), pa.array(base)],
                names=["doc_id", "spans", *(f"n_{k}" for k in KINDS), "base_sha256"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, spans string, n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string")


def redact(docs: DataFrame, dictionary: str = IDENTIFIERS, threshold: float = 0.8, mark: str = "<SECRET>") -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mark``, overlapping ones together; ``n_chars`` follows.

    Null texts stay null; rows without a span stay as they are.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(dictionary)
        for batch in sliced(batches):
            texts = batch["text"].to_pylist()
            changed = np.zeros(len(texts), dtype=bool)
            for i, text in enumerate(texts):
                spans = find_secrets(text or "", novelty, threshold)
                if not spans:
                    continue
                parts, at = [], 0
                for a, b, _ in spans:
                    if a >= at:
                        parts += [text[at:a], mark]
                    at = max(at, b)
                texts[i], changed[i] = "".join([*parts, text[at:]]), True
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns["text"] = pa.array(texts, columns["text"].type)
            if "n_chars" in columns:
                old = columns["n_chars"].to_pylist()
                columns["n_chars"] = pa.array([len(t) if c else n for t, c, n in zip(texts, changed, old, strict=True)], columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.mapInArrow(run, docs.schema)
