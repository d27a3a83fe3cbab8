"""Text expressions: missing tokens, whitespace, case, lookups, row rules.

All are built-in functions, so they stay inside whole-stage code generation and no
Python worker is started.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sql import in_list, lit, literal_map, pattern, true

# Texts that tools write for "no value"; "" is the contract's own form.
MISSING_TOKENS = ("", "nan", "NaN", "NAN", "None", "none", "null", "NULL", "NaT", "<NA>")

# Fixed value: Unicode white space as Python's str methods see it.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_RUN = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


def is_missing(c: str) -> str:
    """True for NULL and for the ten missing tokens (exact, untrimmed)."""
    return f"(coalesce({c}, '') IN {in_list(MISSING_TOKENS)})"


def is_present(c: str) -> str:
    return f"(NOT {is_missing(c)})"


def norm_ws(c: str) -> str:
    """Collapse white space runs to one blank and strip both ends."""
    return f"trim(regexp_replace({c}, {pattern(_RUN)}, ' '))"


def strip(c: str) -> str:
    """Strip any Unicode white space; plain ``trim`` only strips blanks.

    A cell with visible ASCII characters at both ends, the usual case, is left alone
    without searching the set of white space characters. Its ends are looked at as bytes: no text is made of them.
    """
    last = f"substring(CAST({c} AS BINARY), octet_length({c}), 1)"
    clean = f"{c} >= '!' AND {c} < {lit(chr(127))} AND {last} >= X'21' AND {last} < X'7F'"
    return f"CASE WHEN {clean} THEN {c} ELSE trim(BOTH {lit(WHITE_SPACE)} FROM {c}) END"


def title_case(c: str) -> str:
    """Capitalise after every non-letter (``o'neil`` -> ``O'Neil``), lower the rest.

    ``initcap`` only restarts after blanks, so it serves plain names directly and
    each run of letters otherwise.
    """
    cased = r"[\p{Lu}\p{Ll}\p{Lt}]"
    runs = pattern(rf"({cased}+|[^\p{{Lu}}\p{{Ll}}\p{{Lt}}]+)")
    by_run = f"array_join(transform(regexp_extract_all({c}, {runs}, 1), t -> initcap(t)), '')"
    return f"CASE WHEN {c} RLIKE '^[A-Za-z ]*$' THEN initcap({c}) ELSE {by_run} END"


def lower(c: str) -> str:
    return f"lower({c})"


def lookup_map(c: str, mapping: Mapping[str, str]) -> str:
    """Case-insensitive canonical value; unmapped and empty values pass through."""
    folded = {k.lower(): v for k, v in mapping.items()}
    return f"coalesce(try_element_at({literal_map(folded)}, lower({c})), {c})"


def lookup_join(df: DataFrame, column: str, table: DataFrame, key: str, value: str) -> DataFrame:
    """Same as :func:`lookup_map` for a mapping kept in a table.

    No broadcast hint: the table may be of any size and AQE sees its real one.
    """
    found = table.select(F.lower(key).alias("_lk"), F.col(value).alias("_lv")).dropDuplicates(["_lk"])
    joined = df.join(found, F.lower(df[column]) == F.col("_lk"), "left")
    return joined.withColumn(column, F.coalesce("_lv", column)).drop("_lk", "_lv")


def contains_at(c: str) -> str:
    return true(f"contains({c}, '@')")


def blank_unless_at(c: str) -> str:
    """Addresses without ``@`` become empty."""
    return f"CASE WHEN {contains_at(c)} THEN {c} ELSE '' END"


def default_if_missing(c: str, value: str) -> str:
    """Replace an empty cell by a constant."""
    return f"CASE WHEN coalesce({c}, '') = '' THEN {lit(value)} ELSE {c} END"


def full_match(c: str, regex: str) -> str:
    return true(f"{c} RLIKE " + pattern(rf"^(?:{regex})\z"))


#: Plain words in title case, which need no rewriting to be seen as such.
_TITLED = r"^(?:[A-Z][a-z]*+(?: ++|\z))*+\z"

RULES: dict[str, Callable[[str], str]] = {
    "trimmed": lambda c: f"{c} = {strip(c)}",
    "single_spaced": lambda c: f"NOT contains({c}, '  ')",
    "title_case": lambda c: f"CASE WHEN {c} RLIKE {pattern(_TITLED)} THEN true ELSE {c} = {title_case(c)} END",
    "lower_case": lambda c: f"{c} = lower({c})",
    "contains_at": contains_at,
}


def register_rule(rule: str, make: Callable[[str], str]) -> None:
    """Add a text rule: from a column expression to a boolean expression.

    The expression may call a function registered with ``spark.udf.register``; a
    pandas UDF is the vectorised choice there.
    """
    RULES[rule] = make


def rule_holds(rule: str, c: str) -> str:
    if rule not in RULES:
        raise KeyError(f"unknown text rule {rule!r}; known: {sorted(RULES)}")
    return true(RULES[rule](c))
