"""Small helpers for writing Spark SQL expression text.

The builders of this package take and return expression text. A contract compiles to
hundreds of expressions, and text reaches the JVM in one call per output column
where chained ``Column`` calls would take dozens each.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping


def lit(v) -> str:
    """SQL literal of a Python value."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return f"double('{v!r}')"
    text = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def pattern(p: str) -> str:
    """Raw string literal for a regular expression."""
    if "'" in p:
        raise ValueError("a pattern must not contain a quote")
    return f"r'{p}'"


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def names(columns: Iterable[str]) -> str:
    return ", ".join(name(c) for c in columns)


def in_list(values: Iterable) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def array(items: Iterable[str]) -> str:
    return "array(" + ", ".join(items) + ")"


def literal_map(mapping: Mapping) -> str:
    return "map(" + ", ".join(f"{lit(k)}, {lit(v)}" for k, v in mapping.items()) + ")"


def true(condition: str) -> str:
    """NULL counts as false."""
    return f"coalesce({condition}, false)"


def bind(value: str, var: str, body: str) -> str:
    """Evaluate ``value`` once and use it as ``var`` in ``body``."""
    return f"get(transform(array({value}), {var} -> {body}), 0)"
