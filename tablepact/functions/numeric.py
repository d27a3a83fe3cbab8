"""Numeric expressions: tolerant parsing and the exact decimal texts of IEEE doubles."""

from __future__ import annotations

import re
from collections.abc import Callable

from .sql import bind, pattern
from .text import is_missing

# Spark's cast also takes '1d' and '1f'; the pattern keeps those out. What it has taken it does not give back, as no
# part could begin differently: a text that is no number is seen as such at once.
_NUMBER = r"^\s*+[+-]?+(?:(?:\d++\.?+\d*+|\.\d++)(?:[eE][+-]?+\d++)?+|(?i:inf|infinity))\s*+$"


def to_num(c: str) -> str:
    """Text to double; anything unparseable (and NaN) becomes NULL.

    Texts that start with a letter other than I cannot be numbers and skip the pattern, as do those that
    start with a digit and have a minus sign but no exponent (dates).
    """
    no_exponent = f"NOT contains({c}, 'e') AND NOT contains({c}, 'E')"
    may = (f"({c} < ':' OR ({c} >= 'I' AND {c} < 'J') OR ({c} >= 'i' AND {c} < 'j')) "
           f"AND NOT ({c} >= '0' AND {c} < ':' AND contains({c}, '-') AND {no_exponent})")
    number = f"try_cast({c} AS DOUBLE)"
    # Digits beyond the range of doubles are no number; only a written infinity is infinite.
    finite = (f"CASE WHEN octet_length({c}) < 100 AND {no_exponent} THEN {number} "
              f"WHEN abs({number}) = double('inf') AND NOT {c} RLIKE '[iI]' THEN NULL ELSE {number} END")
    return f"CASE WHEN {may} AND {c} RLIKE {pattern(_NUMBER)} THEN {finite} END"


def to_key(c: str) -> str:
    """Key text to bigint: whole numbers exactly, others cut toward zero, else NULL."""
    return f"coalesce(try_cast(trim({c}) AS BIGINT), try_cast({to_num(c)} AS BIGINT))"


def is_integral(x: str) -> str:
    return f"coalesce({x} % 1 = 0, false)"


def ratio(a: str, b: str) -> str:
    """a / b, with 0/0, x/0 and infinities as NULL."""
    r = f"try_divide({a}, {b})"
    return f"CASE WHEN abs({r}) < double('inf') THEN {r} END"


def _bound(x: str, body: Callable[[str], str]) -> str:
    """``body`` over a column reference as it is; any other expression is evaluated once first."""
    return body(x) if re.fullmatch(r"[\w.`]+", x) else bind(f"CAST({x} AS DOUBLE)", "x", body("x"))


def _rounded(x: str, places: int, text: Callable[[str, str], str]) -> str:
    """``text(whole, fraction)`` of |x| below 2**53 rounded to ``places`` (up to four), ties of the exact value to even.

    The fraction times 5**places is exact in two limbs of 64-bit integers, of 2**-30 and 2**-82; times 2**places it is only
    shifted. Bits below 2**-82 belong to fractions under 2**-30, which round to zero at any of these places.
    """
    whole = f"CAST(floor(abs({x})) AS BIGINT)"
    high = f"CAST(floor((abs({x}) - floor(abs({x}))) * {float(2**30)!r}D) AS BIGINT)"
    low = f"CAST(((abs({x}) - floor(abs({x}))) * {float(2**30)!r}D - h) * {float(2**52)!r}D AS BIGINT)"
    shift, half = 30 - places, 2 ** (29 - places)
    up = (f"if(a & {2**shift - 1}L > {half}L OR (a & {2**shift - 1}L = {half}L AND (b & {2**52 - 1}L > 0 OR "
          f"{f'shiftright(a, {shift})' if places else whole} % 2 = 1)), 1L, 0L)")
    steps = f"shiftright(a, {shift}) + {up}"
    carried = f"{whole} + if(k = {10**places}L, 1L, 0L)" if places else f"{whole} + k"
    body = bind(steps, "k", text(f"({carried})", f"if(k = {10**places}L, 0L, k)"))
    limbs = bind(f"{5**places}L * l", "b", bind(f"{5**places}L * h + shiftright(b, 52)", "a", body))
    return bind(high, "h", bind(low, "l", limbs))


def _plain(x: str, places: int, text: Callable[[str, str], str]) -> str:
    """The same by plain arithmetic where it is certain, as for nearly all values: the product below 2**46 is wrong by
    less than 0.01, so a fraction not that near to a half rounds as the exact one. Whole numbers need no product."""
    if not places:
        return f"WHEN abs({x}) < {float(2**53)!r}D THEN CAST(CAST(rint(abs({x})) AS BIGINT) AS STRING)"
    unit = 10**places
    product = f"abs({x}) * {float(unit)!r}D"
    sure = f"abs({product} - floor({product}) - 0.5D) > 0.01D"
    steps = f"CAST(rint({product}) AS BIGINT)"
    return f"WHEN {product} < {float(2**46)!r}D AND {sure} THEN {text(f'({steps} DIV {unit}L)', f'({steps} % {unit}L)')}"


def whole_digits(x: str) -> str:
    """All decimal digits of a finite |x| from 2**53 on: its mantissa in limbs of nine digits, doubled 29 times a step (2**29 is less than a limb, so one carries one)."""
    limb = 10**9
    exponent = f"greatest(CAST(floor(log2(abs({x}))) AS INT) - 55, 0)"
    times = (f"aggregate(d, named_struct('a', CAST(array() AS ARRAY<BIGINT>), 'c', 0L), (s, q) -> named_struct('a', "
             f"concat(s.a, array((q * f + s.c) % {limb}L)), 'c', (q * f + s.c) div {limb}L), s -> if(s.c = 0, s.a, concat(s.a, array(s.c))))")
    mantissa = f"transform(sequence(0, 1), i -> CAST(abs({x}) / pow(2D, e) AS BIGINT) div if(i = 0, 1L, {limb}L) % {limb}L)"
    factors = f"transform(sequence(0, e div 29), i -> if(i = 0, shiftleft(1L, e % 29), {2**29}L))"
    limbs = bind(exponent, "e", f"aggregate({factors}, {mantissa}, (d, f) -> {times})")
    return f"ltrim('0', array_join(transform(reverse({limbs}), d -> lpad(CAST(d AS STRING), 9, '0')), ''))"


def fixed_decimal(x: str, places: int = 2) -> str:
    """Text with up to four decimals, rounded on the exact binary value at any size; NULL stays NULL."""

    def body(x: str) -> str:
        decimal = (lambda w, k: f"concat(CAST({w} AS STRING), '.', lpad(CAST({k} AS STRING), {places}, '0'))") if places else (lambda w, k: f"CAST({w} AS STRING)")
        minus = f"if({x} < 0 AND rint({x}) <> 0, '-', '')" if not places else f"if({x} < 0, '-', '')"
        tail = f", '.{'0' * places}'" if places else ""
        far = f"if(abs({x}) = double('inf'), 'inf', concat({whole_digits(x)}{tail}))"
        exact = f" WHEN abs({x}) < {float(2**53)!r}D THEN {_rounded(x, places, decimal)}" if places else ""
        text = f"CASE {_plain(x, places, decimal)}{exact} ELSE {far} END"
        return f"CASE WHEN {x} IS NULL THEN NULL WHEN isnan({x}) THEN 'nan' ELSE concat({minus}, {text}) END"

    return _bound(x, body)


def round_even(x: str, places: int = 0) -> str:
    """Round a double to ``places`` decimals, ties (of the exact value) to even."""
    return f"rint({x})" if places == 0 else f"CAST({fixed_decimal(x, places)} AS DOUBLE)"


def int_text(x: str) -> str:
    """Nearest whole number as text, ties to even."""
    return fixed_decimal(x, 0)


def currency_text(c: str) -> str:
    """``1249.5`` -> ``$1,249.50``; the sign goes first, empty cells stay empty, infinity is ``$inf``."""
    grouped = f"regexp_replace({fixed_decimal('abs(x)')}, {pattern('([0-9])(?=(?:[0-9]{3})+[.])')}, '$1,')"
    return f"CASE WHEN {is_missing(c)} THEN {c} ELSE {bind(to_num(c), 'x', f"concat(if(x < 0, '-$', '$'), {grouped})")} END"


def minor_units(c: str) -> str:
    """Dollars to whole cents as text; empty cells stay empty, infinity is ``inf``."""
    return f"CASE WHEN {is_missing(c)} THEN {c} ELSE {int_text(f'{to_num(c)} * 100')} END"


def log2_term(p: str, m: str) -> str:
    """p * log2(p / m), and 0 where p is 0."""
    return f"CASE WHEN {p} > 0 THEN {p} * log2({p} / ({m})) ELSE 0.0D END"
