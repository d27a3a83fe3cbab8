"""Declarative contract: columns, cleaning rules, tolerances, drift thresholds.

A contract is driver-side metadata. Operators compile it to ``Column`` expressions.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from pathlib import Path
from typing import Any

DTYPES = ("string", "int", "float", "date")


@dataclass(frozen=True)
class Impute:
    method: str  # "median" | "constant"
    value: str | None = None
    places: int = 0


@dataclass(frozen=True)
class ColumnRule:
    name: str
    dtype: str = "string"
    nullable: bool = False
    unique: bool = False
    rules: tuple[str, ...] = ()
    allowed: tuple[str, ...] | None = None
    min: Any = None
    max: Any = None
    decimals: int | None = None
    lookup: Mapping[str, str] | None = None
    impute: Impute | None = None
    # Row-level rejection: "le" / "lt" with a bound, "unparseable", "not_allowed".
    invalid_le: float | None = None
    invalid_lt: float | None = None
    invalid_unparseable: bool = False
    invalid_not_allowed: bool = False
    drift: str | None = None  # "level" | "distribution" | "date"

    @property
    def numeric(self) -> bool:
        return self.dtype in ("int", "float")


@dataclass(frozen=True)
class Contract:
    key: str
    columns: tuple[ColumnRule, ...]
    input_date_formats: tuple[str, ...] = ("%Y-%m-%d",)
    dedupe: bool = True
    sort_by: str | None = None
    numeric_abs: float = 0.005
    imputed_abs: float = 0.011
    castable_fraction: float = 0.995
    level_ratio_max: float = 3.0
    per_key_ratio_tolerance: float = 0.01
    per_key_changed_max: float = 0.01
    out_of_window_max: float = 0.0
    month_jsd_max: float = 0.10
    categorical_jsd_max: float = 0.10
    _index: dict[str, ColumnRule] = field(default_factory=dict, compare=False, repr=False)

    def __post_init__(self) -> None:
        names = [c.name for c in self.columns]
        if len(set(names)) != len(names):
            raise ValueError("duplicate column names in contract")
        if self.key not in names:
            raise ValueError(f"key {self.key!r} is not a contract column")
        for c in self.columns:
            if c.dtype not in DTYPES:
                raise ValueError(f"{c.name}: unknown dtype {c.dtype!r}")
            if c.dtype == "date" and (c.min is None) != (c.max is None):
                raise ValueError(f"{c.name}: a date range needs both bounds")
            self._index[c.name] = c

    def __getitem__(self, name: str) -> ColumnRule:
        return self._index[name]

    def __contains__(self, name: str) -> bool:
        return name in self._index

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def key_rule(self) -> ColumnRule:
        return self[self.key]

    def of_drift(self, kind: str) -> list[ColumnRule]:
        return [c for c in self.columns if c.drift == kind]

    @property
    def level_column(self) -> str | None:
        return next((c.name for c in self.of_drift("level")), None)

    @property
    def date_column(self) -> str | None:
        return next((c.name for c in self.of_drift("date")), None)

    @property
    def text_columns(self) -> list[str]:
        return [c.name for c in self.columns if c.dtype == "string"]

    @property
    def number_columns(self) -> list[str]:
        return [c.name for c in self.columns if c.numeric and c.name != self.key]

    @property
    def imputed(self) -> list[ColumnRule]:
        return [c for c in self.columns if c.impute is not None]

    def with_column(self, name: str, **changes: Any) -> Contract:
        cols = tuple(replace(c, **changes) if c.name == name else c for c in self.columns)
        return replace(self, columns=cols, _index={})

    @staticmethod
    def from_dict(doc: Mapping[str, Any]) -> Contract:
        """Build from the plain document form (the YAML layout).

        ``<column>_map`` entries are lookups, ``invalid_when`` keys are
        ``<column>_le | _lt | _unparseable | _not_allowed``, and
        ``semantic.<column>_median_ratio_max`` names the level column.
        """
        invalid = dict(doc.get("invalid_when", {}))
        imputation = doc.get("imputation", {})
        semantic = doc.get("semantic", {})
        tolerances = doc.get("tolerances", {})
        level = next((k[: -len("_median_ratio_max")] for k in semantic if k.endswith("_median_ratio_max")), None)
        cols = []
        for spec in doc["columns"]:
            name, dtype = spec["name"], spec.get("dtype", "string")
            imp = imputation.get(name)
            drift = spec.get("drift")
            if drift is None:
                if name == level:
                    drift = "level"
                elif "allowed" in spec:
                    drift = "distribution"
                elif dtype == "date":
                    drift = "date"
            cols.append(
                ColumnRule(
                    name=name, dtype=dtype, nullable=spec.get("nullable", False), unique=spec.get("unique", False),
                    rules=tuple(spec.get("rules", ())),
                    allowed=tuple(spec["allowed"]) if "allowed" in spec else None,
                    min=spec.get("min"), max=spec.get("max"), decimals=spec.get("decimals"),
                    lookup=dict(doc[f"{name}_map"]) if f"{name}_map" in doc else spec.get("lookup"),
                    impute=Impute(imp["method"], imp.get("value"), int(imp.get("round", 0))) if imp else None,
                    invalid_le=invalid.get(f"{name}_le"), invalid_lt=invalid.get(f"{name}_lt"),
                    invalid_unparseable=bool(invalid.get(f"{name}_unparseable", False)),
                    invalid_not_allowed=bool(invalid.get(f"{name}_not_allowed", False)),
                    drift=drift,
                )
            )
        extra = {}
        if level is not None:
            extra["level_ratio_max"] = float(semantic[f"{level}_median_ratio_max"])
        for ours, theirs in (
            ("per_key_ratio_tolerance", "per_order_ratio_tolerance"),
            ("out_of_window_max", "date_out_of_window_max_fraction"),
            ("month_jsd_max", "month_distribution_jsd_max"),
            ("categorical_jsd_max", "categorical_jsd_max"),
        ):
            if theirs in semantic:
                extra[ours] = float(semantic[theirs])
        for name in ("numeric_abs", "imputed_abs", "castable_fraction"):
            if name in tolerances:
                extra[name] = float(tolerances[name])
        return Contract(
            key=doc["key"], columns=tuple(cols),
            input_date_formats=tuple(doc.get("input_date_formats", ("%Y-%m-%d",))),
            dedupe="dedupe" in doc, sort_by=doc.get("sort", {}).get("by"), **extra,
        )

    @staticmethod
    def from_yaml(path: str | Path) -> Contract:
        try:
            import yaml
        except ImportError as e:  # pragma: no cover - optional dependency
            raise RuntimeError("reading YAML contracts needs PyYAML; use Contract.from_dict instead") from e
        return Contract.from_dict(yaml.safe_load(Path(path).read_text(encoding="utf-8")))


# The orders contract (columns, bounds, allowed values, spellings, thresholds).
ORDERS_DOC: dict[str, Any] = {
    "version": 1,
    "key": "order_id",
    "columns": [
        {"name": "order_id", "dtype": "int", "nullable": False, "unique": True},
        {"name": "customer_name", "dtype": "string", "nullable": False,
         "rules": ["trimmed", "single_spaced", "title_case"]},
        {"name": "email", "dtype": "string", "nullable": True, "rules": ["trimmed", "lower_case", "contains_at"]},
        {"name": "country", "dtype": "string", "nullable": False, "rules": ["trimmed"],
         "allowed": ["Australia", "United States", "United Kingdom", "India", "New Zealand", "Unknown"]},
        {"name": "order_date", "dtype": "date", "nullable": False, "min": "2026-01-01", "max": "2026-06-30"},
        {"name": "product", "dtype": "string", "nullable": False, "rules": ["trimmed", "single_spaced"]},
        {"name": "category", "dtype": "string", "nullable": False,
         "allowed": ["Electronics", "Home", "Books", "Sports", "Fashion"]},
        {"name": "quantity", "dtype": "int", "nullable": False, "min": 1, "max": 20},
        {"name": "unit_price", "dtype": "float", "nullable": False, "min": 1.00, "max": 1999.99, "decimals": 2},
        {"name": "status", "dtype": "string", "nullable": False, "rules": ["lower_case"],
         "allowed": ["pending", "shipped", "delivered", "cancelled"]},
    ],
    "country_map": {
        "usa": "United States", "us": "United States", "u.s.": "United States", "united states": "United States",
        "uk": "United Kingdom", "u.k.": "United Kingdom", "united kingdom": "United Kingdom",
        "aus": "Australia", "au": "Australia", "australia": "Australia", "india": "India",
        "nz": "New Zealand", "new zealand": "New Zealand",
    },
    "input_date_formats": ["%m/%d/%Y", "%Y-%m-%d"],
    "invalid_when": {"quantity_le": 0, "unit_price_lt": 0, "order_date_unparseable": True,
                     "status_not_allowed": True},
    "dedupe": {"subset": "all", "keep": "first"},
    "imputation": {
        "quantity": {"method": "median", "round": 0},
        "unit_price": {"method": "median", "round": 2},
        "country": {"method": "constant", "value": "Unknown"},
        "customer_name": {"method": "constant", "value": "Unknown"},
    },
    "sort": {"by": "order_id", "ascending": True},
    "tolerances": {"numeric_abs": 0.005, "imputed_abs": 0.011, "castable_fraction": 0.995},
    "semantic": {
        "unit_price_median_ratio_max": 3.0, "per_order_ratio_tolerance": 0.01,
        "date_out_of_window_max_fraction": 0.0, "month_distribution_jsd_max": 0.10, "categorical_jsd_max": 0.10,
    },
}

ORDERS = Contract.from_dict(ORDERS_DOC)
