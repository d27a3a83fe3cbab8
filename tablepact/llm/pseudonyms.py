"""Format-preserving pseudonyms for personal data.

Numbers and dates that pass their own validity rule are permuted, under a key, among the valid values of
the same format by a Feistel network with cycle walking. Equal values get equal pseudonyms in
every document and every run, so documents stay linked; without the key nobody gets back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("card", "number", "phone", "ssn", "iban", "ip", "email", "date")
_ROUNDS = 8
_FIRST, _LAST = date(1900, 1, 1), date(2099, 12, 31)

# Longest shapes first; each match is then validated.
_NUMERIC = re.compile(
    r"(?<![A-Za-z0-9])(?P<iban>[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
    r"|(?<![0-9A-Za-z.])(?P<ip>[0-9]{1,3}(?:\.[0-9]{1,3}){3})(?![0-9A-Za-z]|\.[0-9])"
    r"|(?<![0-9A-Za-z.-])(?P<date>[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})(?![0-9A-Za-z]|[.-][0-9])"
    r"|(?<![0-9A-Za-z-])(?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9A-Za-z]|-[0-9])"
    r"|(?<![0-9A-Za-z])(?P<card>[0-9]{4}(?:[\x20-]?[0-9]{4}){2}[\x20-]?[0-9]{1,7}|[0-9]{13,19})(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z+])(?P<phone>\+[0-9]{1,3}[\x20.-]?\(?[0-9]{1,4}\)?(?:[\x20.-]?[0-9]{2,4}){1,4}|\([0-9]{3}\)\x20?[0-9]{3}[\x20.-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9A-Za-z])")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def _check_digit(payload: str) -> str:
    return next(c for c in "0123456789" if luhn(payload + c))


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


class Feistel:
    """A keyed permutation of ``range(n)`` for any ``n``, told apart by ``format``."""

    def __init__(self, key: bytes):
        self.key = key if len(key) <= 64 else hashlib.blake2b(key).digest()  # the hash takes keys of up to 64 bytes

    def permute(self, x: int, n: int, format: str, back: bool = False) -> int:
        if n < 2:
            return x
        half = ((n - 1).bit_length() + 1) // 2
        while True:  # walk until the value is in range again
            x = self._once(x, half, format, back)
            if x < n:
                return x

    def _once(self, x: int, half: int, format: str, back: bool) -> int:
        mask = (1 << half) - 1
        a, b = x >> half, x & mask
        for r in reversed(range(_ROUNDS)) if back else range(_ROUNDS):
            if back:
                a, b = b ^ self._round(a, r, half, format), a
            else:
                a, b = b, a ^ self._round(b, r, half, format)
        return a << half | b

    def _round(self, value: int, r: int, half: int, format: str) -> int:
        size = -(-half // 8)
        text = f"{format}:{half}:{r}:".encode() + value.to_bytes(size, "big")
        return int.from_bytes(hashlib.blake2b(text, key=self.key, digest_size=min(64, size)).digest(), "big") & ((1 << half) - 1)


class Pseudonyms:
    def __init__(self, key: bytes):
        self.feistel = Feistel(key)

    def digits(self, value: str, format: str) -> str:
        n = len(value)
        return str(self.feistel.permute(int(value), 10**n, f"{format}{n}")).zfill(n) if n else value

    @staticmethod
    def _refill(shape: str, digits: str) -> str:
        """``shape`` with its digits replaced in turn."""
        it = iter(digits)
        return "".join(next(it) if c.isdigit() else c for c in shape)

    def of(self, kind: str, text: str) -> tuple[str, str] | None:
        """``(kind, pseudonym)`` of a match, or None if it is not a valid value."""
        plain = re.sub(r"[^0-9]", "", text)
        if kind == "card":
            if not 13 <= len(plain) <= 19:
                return None
            if luhn(plain):
                payload = self.digits(plain[:-1], "card")
                return "card", self._refill(text, payload + _check_digit(payload))
            return "number", self._refill(text, self._not_luhn(plain))
        if kind == "phone":
            if not 7 <= len(plain) <= 15:
                return None
            country = re.match(r"\+([0-9]{1,3})(?=[\x20.(-])", text)
            keep = len(country[1]) if country else 0
            return "phone", self._refill(text, plain[:keep] + self.digits(plain[keep:], "phone"))
        if kind == "ssn":
            if plain[:3] in ("000", "666") or plain[0] == "9" or plain[3:5] == "00" or plain[5:] == "0000":
                return None
            while True:
                plain = self.digits(plain, "ssn")
                if not (plain[:3] in ("000", "666") or plain[0] == "9" or plain[3:5] == "00" or plain[5:] == "0000"):
                    return "ssn", self._refill(text, plain)
        if kind == "iban":
            raw = text.replace(" ", "")
            if not 15 <= len(raw) <= 34 or _mod97(raw[4:] + raw[:4]) != 1:
                return None
            body = raw[4:]
            body = self._refill(body, self.digits(re.sub(r"[^0-9]", "", body), "iban" + raw[:2]))
            raw = raw[:2] + f"{98 - _mod97(body + raw[:2] + '00'):02d}" + body
            it = iter(raw)
            return "iban", "".join(c if c == " " else next(it) for c in text)
        if kind == "ip":
            parts = [int(p) for p in text.split(".")]
            if max(parts) > 255:
                return None
            x = self.feistel.permute(int.from_bytes(bytes(parts), "big"), 1 << 32, "ip")
            return "ip", ".".join(map(str, x.to_bytes(4, "big")))
        if kind == "date":
            return self._date(text)
        local, _, host = text.partition("@")
        return "email", f"{self.word(local)}@{host}"

    def _not_luhn(self, plain: str) -> str:
        while True:  # the other numbers of this length are closed under the walk too
            plain = self.digits(plain, "number")
            if not luhn(plain):
                return plain

    def _date(self, text: str) -> tuple[str, str] | None:
        a, b, c = re.split(r"[./-]", text)
        order = "ymd" if len(a) == 4 else "dmy" if "." in text else "mdy"
        try:
            day = date(**{{"y": "year", "m": "month", "d": "day"}[k]: int(v) for k, v in zip(order, (a, b, c), strict=True)})
        except ValueError:
            return None
        if not _FIRST <= day <= _LAST:
            return None
        n = (_LAST - _FIRST).days + 1
        new = _FIRST + timedelta(self.feistel.permute((day - _FIRST).days, n, "date"))
        return "date", self._refill(text, "".join({"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}[k] for k in order))

    def word(self, text: str) -> str:
        """Letters among letters of their case, digits among digits, the rest kept."""
        radix = [26 if c.isalpha() else 10 if c.isdigit() else 1 for c in text]
        base = [97 if c.islower() else 65 if c.isupper() else 48 for c in text]
        x, n = 0, 1
        for c, r, b in zip(text, radix, base, strict=True):
            if r > 1:
                x, n = x * r + ord(c) - b, n * r
        shape = "".join("a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c for c in text)
        x = self.feistel.permute(x, n, "word" + shape)
        out = []
        for c, r, b in zip(reversed(text), reversed(radix), reversed(base), strict=True):
            if r > 1:
                x, v = divmod(x, r)
                c = chr(b + v)
            out.append(c)
        return "".join(reversed(out))

    def replace(self, text: str) -> tuple[str, list[tuple[int, int, str]]]:
        """The text with every valid value replaced, and the replaced spans of the original by start."""
        mails: list[tuple[int, int, str]] = []
        at, done = text.find("@"), 0
        while at >= 0:  # addresses are found from their @ sign; no local part reaches beyond the address before
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            m = _EMAIL.match(text, start) if start < at else None
            done = m.end() if m else at + 1
            if m:
                mails.append((start, done, "email"))
            at = text.find("@", done)
        spans, i = list(mails), 0
        for m in _NUMERIC.finditer(text):  # both lists ascend
            while i < len(mails) and mails[i][1] <= m.start():
                i += 1
            if i == len(mails) or mails[i][0] >= m.end():
                spans.append((m.start(), m.end(), m.lastgroup))
        parts, found, at = [], [], 0
        for a, b, kind in sorted(spans):
            got = self.of(kind, text[a:b])
            if got and a >= at:
                parts += [text[at:a], got[1]]
                found.append((a, b, got[0]))
                at = b
        return "".join([*parts, text[at:]]) if found else text, found


def pseudonymise(docs: DataFrame, key: bytes) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``text`` with pseudonyms, ``spans`` (``kind:start:end`` of the original), ``n_pii``.

    Validated: payment cards (Luhn, kept valid), other numbers of 13 to 19 digits, phone numbers, social security
    numbers, IBANs (check digits renewed), IPv4 addresses, calendar dates from 1900 to 2099, and the local part of
    e-mail addresses. What fails its rule stays. Null texts stay null with no span; whole texts are
    read; repeated rows stay. Other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(key)
        for batch in batches:
            done = [(None, []) if t is None else names.replace(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([t for t, _ in done], pa.string()), pa.array([",".join(f"{k}:{a}:{b}" for a, b, k in s) for _, s in done]),
                 pa.array([len(s) for _, s in done], pa.int64())], names=["doc_id", "text", "spans", "n_pii"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, text string, spans string, n_pii long")
