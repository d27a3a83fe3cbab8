"""Date expressions. Everything is zone-free (TIMESTAMP_NTZ / DATE)."""

from __future__ import annotations

from collections.abc import Sequence

from .sql import bind, lit, pattern
from .text import is_present, strip

# Strptime directives and the Spark pattern letters with the same
# leniency (one- or two-digit month and day, four-digit year).
STRPTIME_TO_SPARK = {"%Y": "yyyy", "%m": "M", "%d": "d", "%H": "H", "%M": "m", "%S": "s"}

# Range of a 64-bit nanosecond timestamp; dates beyond it count as unparseable.
_RANGE = "BETWEEN '1677-09-21' AND '2262-04-11 23:47:16.854775807'"
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def spark_pattern(fmt: str) -> str:
    for k, v in STRPTIME_TO_SPARK.items():
        fmt = fmt.replace(k, v)
    if "%" in fmt:
        raise ValueError(f"unsupported date directive in {fmt!r}")
    return fmt


def to_date_ntz(c: str) -> str:
    """ISO-8601 date with optional time; unparseable and missing become NULL."""
    return f"CASE WHEN {is_present(c)} THEN {date_of(strip(c))} END"


def date_of(s: str) -> str:
    """The same for text that is known to be present and stripped."""
    return (
        f"CASE WHEN NOT {s} {_RANGE} THEN NULL WHEN NOT contains({s}, '-') AND {s} RLIKE '^[0-9]{{8}}$' "
        f"THEN CAST(try_to_date({s}, 'yyyyMMdd') AS TIMESTAMP_NTZ) ELSE try_cast({s} AS TIMESTAMP_NTZ) END"
    )


def day_bound(v) -> str:
    """A contract's date bound as a timestamp literal."""
    return f"TIMESTAMP_NTZ{lit(str(v))}"


def parse_formats(c: str, formats: Sequence[str]) -> str:
    """First format that matches the whole stripped text; NULL when none does."""
    s = strip(c)
    return "coalesce(" + ", ".join(f"try_to_date({s}, {lit(spark_pattern(f))})" for f in formats) + ")"


def iso_date(d: str) -> str:
    """``yyyy-MM-dd`` text, and empty text for no date."""
    return f"coalesce(CAST(CAST({d} AS DATE) AS STRING), '')"


def swap_day_month(c: str) -> str:
    """``MM/DD/YYYY`` rewritten as ``DD/MM/YYYY``; impossible dates and other forms stay."""
    valid = f"{c} RLIKE " + pattern(r"^\d{1,2}/\d{1,2}/\d{4}$")
    return f"coalesce(CASE WHEN {valid} THEN date_format(try_to_date({c}, 'M/d/yyyy'), 'dd/MM/yyyy') END, {c})"


def epoch_ms_in_name(c: str) -> str:
    """First run of 13 digits in an object name, as epoch milliseconds."""
    return f"try_cast(regexp_extract({c}, {pattern('([0-9]{13})')}, 1) AS BIGINT)"


def from_epoch_ms(ms: str) -> str:
    """Epoch milliseconds to a UTC wall-clock timestamp, whatever the session zone."""
    return f"({_EPOCH} + make_dt_interval(0, 0, 0, CAST({ms} AS DECIMAL(20, 0)) / 1000))"


def to_epoch_ms(ts: str) -> str:
    return f"timestampdiff(MILLISECOND, {_EPOCH}, {ts})"


def local_iso(ms: str, zone: str = "Australia/Adelaide") -> str:
    """Epoch milliseconds as local ISO text with offset, to the second."""
    utc = from_epoch_ms(f"({ms} - pmod({ms}, 1000))")
    offset = (
        "concat(if(m < 0, '-', '+'), lpad(CAST(abs(m) DIV 60 AS STRING), 2, '0'), ':', "
        "lpad(CAST(abs(m) % 60 AS STRING), 2, '0'))"
    )
    shown = "concat(date_format(l, \"yyyy-MM-dd'T'HH:mm:ss\"), " + bind(
        "timestampdiff(MINUTE, u, l)", "m", offset) + ")"
    return bind(utc, "u", bind(f"convert_timezone('UTC', {lit(zone)}, u)", "l", shown))
