"""Representation-insensitive form of a table and a hash of it that ignores row order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import numeric as N
from ..functions import text as X
from ..functions.sql import array, lit, name
from ..sources.staging import materialize


#: What a cell rules out, as bits; a missing cell rules out nothing.
_SOME, _NOT_WHOLE, _NOT_NUMBER, _NOT_DATE = 1, 2, 4, 8


def column_classes(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Class of each column per group, decided from all of its cells in one pass.

    ``<column>`` -> ``int`` (all numbers, all whole), ``decimal`` (all numbers),
    ``date`` (all dates) or ``text``. One row per group.
    """
    keys = [name(b) for b in by]
    first, second, aggs, out = list(keys), list(keys), [], list(keys)
    for i, c in enumerate(columns):
        v, b, s, x, d = name(c), f"b{i}", f"s{i}", f"x{i}", f"d{i}"
        # What starts with a letter other than I is neither a number nor a date, whatever follows.
        letter = f"(({v} >= 'A' AND {v} < 'I') OR ({v} >= 'J' AND {v} < 'i') OR ({v} >= 'j' AND {v} < '{{'))"
        first += [f"CASE WHEN {X.is_missing(v)} THEN 0 WHEN {letter} THEN {_SOME | _NOT_WHOLE | _NOT_NUMBER | _NOT_DATE} ELSE {_SOME} END AS {b}",
                  f"CASE WHEN NOT {letter} THEN {X.strip(v)} END AS {s}"]
        second += [b, f"{N.to_num(s)} AS {x}", f"{D.date_of(s)} IS NOT NULL AS {d}"]
        aggs.append(F.expr(f"bit_or(CASE WHEN {b} = {_SOME} THEN {_SOME} + if({N.is_integral(x)}, 0, {_NOT_WHOLE}) + if({x} IS NOT NULL, 0, {_NOT_NUMBER}) "
                           f"+ if({d}, 0, {_NOT_DATE}) ELSE {b} END)").alias(b))
        out.append(f"CASE WHEN {b} & {_SOME} = 0 THEN 'text' WHEN {b} & {_NOT_WHOLE} = 0 THEN 'int' WHEN {b} & {_NOT_NUMBER} = 0 THEN 'decimal' "
                   f"WHEN {b} & {_NOT_DATE} = 0 THEN 'date' ELSE 'text' END AS {v}")
    seen = df.selectExpr(*first).selectExpr(*second).groupBy(*by).agg(*aggs)
    # Without groups, an empty table has one row and no bits.
    return seen.na.fill(0, [f"b{i}" for i in range(len(columns))]).selectExpr(*out)


#: Classes as numbers, which rows carry more cheaply than texts.
_TEXT, _INT, _DECIMAL, _DATE = 0, 1, 2, 3


def _as_written(v: str, cls: str) -> str:
    """Whether a cell of a column of this class is canonical as it is, beyond doubt.

    A number without sign, exponent and needless zeros, of so few digits that they come back from a double, or a date
    with two dashes at their places. The class says that the stripped cell is a number or a date at all.
    """
    last = f"substring(CAST({v} AS BINARY), octet_length({v}), 1)"
    ended = f"{last} >= X'30' AND {last} < X'3A'"
    number = f"octet_length({v}) <= 15 AND NOT contains({v}, 'e') AND NOT contains({v}, 'E') AND {ended}"
    return (f"CASE {cls} WHEN {_INT} THEN {v} >= '1' AND {v} < ':' AND {number} AND NOT contains({v}, '.') "
            f"WHEN {_DECIMAL} THEN (({v} >= '1' AND {v} < ':') OR startswith({v}, '0.')) AND {number} AND octet_length({v}) > 3 AND instr({v}, '.') = octet_length({v}) - 2 "
            f"WHEN {_DATE} THEN octet_length({v}) = 10 AND instr({v}, '-') = 5 AND substring({v}, 8, 1) = '-' AND {ended} ELSE false END")


def _canonical(s: str, cls: str, x: str, d: str) -> str:
    """``s`` is the stripped text of a present cell of a column that is not text."""
    # Plain digits go through 64-bit integers; a failing cast would cost an exception per cell.
    whole = f"CASE WHEN {s} RLIKE '^[+-]?[0-9]{{1,18}}$' THEN CAST(CAST({s} AS BIGINT) AS STRING) ELSE {N.int_text(x)} END"
    return f"CASE WHEN {cls} = {_INT} THEN {whole} WHEN {cls} = {_DECIMAL} THEN {N.fixed_decimal(x, 2)} ELSE {D.iso_date(d)} END"


def canonicalize(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Cells rewritten by column class: whole numbers, two decimals, ISO dates, stripped text, ``""``.

    NULL (the group's table lacks the column) stays NULL. The class table has one row
    per group and is written, so that the join knows its size and leaves the cells where they are.
    """
    by = list(by)
    codes = [f"CASE {name(c)} WHEN 'int' THEN {_INT} WHEN 'decimal' THEN {_DECIMAL} WHEN 'date' THEN {_DATE} ELSE {_TEXT} END AS {name(f'_cls_{c}')}" for c in columns]
    classes = column_classes(df, by, columns).selectExpr(*map(name, by), *codes)
    if by:
        joined = df.join(materialize(classes, "column_classes")[0], by)
        cls = {c: name(f"_cls_{c}") for c in columns}
    else:
        one = classes.select(F.struct(*[F.col(name(f"_cls_{c}")) for c in columns]).alias("s")).scalar()
        joined = df.withColumn("_cls", one)
        cls = {c: "_cls." + name(f"_cls_{c}") for c in columns}
    keep = [name(c) for c in df.columns if c not in columns]
    first, second, last = [], [], []
    for i, c in enumerate(columns):
        v, k, s, w = name(c), cls[c], f"s{i}", _as_written(name(c), cls[c])
        # ``f`` is the result of the usual cells; the others go on as stripped text and class.
        first += [f"CASE WHEN {v} IS NULL THEN NULL WHEN {w} THEN {v} WHEN {X.is_missing(v)} THEN '' WHEN {k} = {_TEXT} THEN {X.strip(v)} END AS f{i}",
                  f"CASE WHEN {k} <> {_TEXT} AND NOT ({w}) AND NOT {X.is_missing(v)} THEN {X.strip(v)} END AS {s}", f"{k} AS k{i}"]
        second += [f"f{i}", s, f"k{i}", f"CASE WHEN k{i} IN ({_INT}, {_DECIMAL}) THEN {N.to_num(s)} END AS x{i}", f"CASE WHEN k{i} = {_DATE} THEN {D.date_of(s)} END AS d{i}"]
        last.append(f"CASE WHEN {s} IS NULL THEN f{i} WHEN {s} = '' THEN '' ELSE {_canonical(s, f'k{i}', f'x{i}', f'd{i}')} END AS {name(c)}")
    return joined.selectExpr(*keep, *first).selectExpr(*keep, *second).selectExpr(*keep, *last)


def _row_hash(seed: int, columns: Sequence[str]) -> str:
    """Hash of a row's cells. Each cell enters with its own NULL flag, so shifting a value
    between columns changes the hash."""
    cells = ", ".join(f"{name(c)} IS NULL, {name(c)}" for c in columns)
    return f"xxhash64({seed}, {cells})"


def _exact_sum(h: str) -> str:
    """Sum of 64-bit hashes as a decimal, from sums of limbs of 22, 21 and 21 bits: whole numbers that last for 2**41 rows."""
    limbs = (f"shiftright({h}, 42)", f"shiftright({h}, 21) & {2**21 - 1}L", f"{h} & {2**21 - 1}L")
    high, middle, low = (f"CAST(sum({x}) AS DECIMAL(20, 0))" for x in limbs)
    return f"CAST({high} * {2**42} + {middle} * {2**21} + {low} AS DECIMAL(30, 0))"


def _digest(columns: Sequence[str], headers: bool, sums: Sequence[str]) -> str:
    header = "array_join(header, '\x1f')" if headers else lit("\x1f".join(columns))
    return f"sha2(concat_ws('|', rows, {', '.join(sums)}, {header}), 256)"


def fingerprints(canonical: DataFrame, by: Sequence[str], columns: Sequence[str],
                 headers: DataFrame | None = None) -> DataFrame:
    """``(by..., rows, content_hash)``: equal iff the same multiset of rows under the same header.

    Sums of two row hashes: order does not matter, repeated rows count, and they
    combine map-side. ``headers`` is ``(by..., header)``, the ordered column names;
    column order is content.
    """
    hashed = canonical.select(*by, *[F.expr(_row_hash(seed, columns)).alias(f"_h{seed}") for seed in (1, 2)])
    sums = hashed.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *[F.expr(_exact_sum(h)).alias(h) for h in ("_h1", "_h2")])
    if headers is not None:
        sums = sums.join(headers, list(by))
    return sums.select(*by, "rows", F.expr(_digest(columns, headers is not None, ["_h1", "_h2"])).alias("content_hash"))


def shared_fingerprints(canonical: DataFrame, tables: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """``(table, rows, content_hash)`` of tables made of one table's columns, in one pass.

    ``tables`` says for each the column behind every name of its header. The hashes are those of
    :func:`fingerprints` on the table alone.
    """
    hashes = {f"_h{seed}_{i}": _row_hash(seed, list(header.values())) for i, header in enumerate(tables.values()) for seed in (1, 2)}
    sums = [F.expr(_exact_sum(h)).alias(h) for h in hashes]
    items = array(f"named_struct('table', {lit(t)}, 'rows', rows, 'content_hash', {_digest(list(header), False, [f'_h1_{i}', f'_h2_{i}'])})"
                  for i, (t, header) in enumerate(tables.items()))
    hashed = canonical.select(*[F.expr(e).alias(h) for h, e in hashes.items()])
    return hashed.agg(F.count(F.lit(1)).alias("rows"), *sums).selectExpr(f"inline({items})")


def raw_and_content(df: DataFrame, by: Sequence[str], columns: Sequence[str], headers: DataFrame) -> DataFrame:
    """``(by..., rows, raw_hash, content_hash)``, raw and canonical cells hashed in the same pass."""
    tagged = df.select(*by, *columns, *[F.expr(_row_hash(seed, columns)).alias(f"_r{seed}") for seed in (1, 2)])
    canonical = canonicalize(tagged, by, columns)
    hashed = canonical.select(*by, "_r1", "_r2", *[F.expr(_row_hash(seed, columns)).alias(f"_h{seed}") for seed in (1, 2)])
    sums = hashed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), *[F.expr(_exact_sum(h)).alias(h) for h in ("_r1", "_r2", "_h1", "_h2")]
    ).join(headers, list(by))
    return sums.select(
        *by, "rows", F.expr(_digest(columns, True, ["_r1", "_r2"])).alias("raw_hash"),
        F.expr(_digest(columns, True, ["_h1", "_h2"])).alias("content_hash"),
    )
