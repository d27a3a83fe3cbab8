"""What a validation works on: outputs of runs, their inputs, ground truth and baseline."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import Contract
from ..functions.compare import close_name
from ..functions.sql import array, lit, name
from ..operators.ordering import ORD
from .headers import CASE, RUN, compared, drift


def values_table(spark: SparkSession, columns: Sequence[str], rows: Sequence[Sequence[str]]) -> DataFrame:
    """Driver metadata as an inline table; cells are SQL literals."""
    body = ", ".join("(" + ", ".join(r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(columns)})")


def _texts(items: Sequence[str]) -> str:
    return f"CAST({array(lit(i) for i in items)} AS ARRAY<STRING>)"


_META = [RUN, CASE, "header", "layouts", "missing", "extra", "renames", "input_header", "input_removed", "input_added", "expected_rows"]


@dataclass(frozen=True)
class RunSet:
    """Any number of runs, validated together by one plan.

    ``outputs``   ``(run_id, case, _ord, columns...)``, all text. NULL says that the run's
                  table has no such column; a missing cell is empty text.
    ``inputs``    ``(case, columns...)``, same convention.
    ``expected``  ``(case, columns...)`` ground truth, unique by key; None when unknown.
    ``baseline``  ``(columns...)`` trusted output, the reference of the drift checks.

    Headers are tables, as a scan reports them: ``header_table`` ``(run_id, case, header, layouts)`` and
    ``input_header_table`` ``(case, header)``. Where a caller has them as plain lists instead,
    ``headers``, ``cases`` and ``input_headers`` stand for them.
    """

    spark: SparkSession
    contract: Contract
    outputs: DataFrame
    headers: Mapping[str, list[str]] = field(default_factory=dict)
    cases: Mapping[str, str] = field(default_factory=dict)
    inputs: DataFrame | None = None
    input_headers: Mapping[str, list[str]] = field(default_factory=dict)
    baseline_header: list[str] | None = None
    expected: DataFrame | None = None
    expected_rows: Mapping[str, int] | None = None
    baseline: DataFrame | None = None
    medians: Mapping[str, float] = field(default_factory=dict)
    header_table: DataFrame | None = None
    input_header_table: DataFrame | None = None

    def run_headers(self) -> DataFrame:
        """``(run_id, case, header, layouts)``, one row per run."""
        if self.header_table is not None:
            return self.header_table.select(RUN, CASE, "header", "layouts")
        rows = [(lit(r), lit(self.cases[r]), _texts(h), "1L") for r, h in self.headers.items()]
        return values_table(self.spark, [RUN, CASE, "header", "layouts"], rows)

    def case_inputs(self) -> DataFrame:
        """``(case, input_header, input_removed, input_added)``: input headers and their drift."""
        if self.input_header_table is not None:
            known = self.input_header_table.select(CASE, F.col("header").alias("input_header"))
        else:
            rows = [(lit(c), _texts(h)) for c, h in self.input_headers.items()] or [("CAST(NULL AS STRING)", _texts([]))]
            known = values_table(self.spark, [CASE, "input_header"], rows).where(F.col(CASE).isNotNull())
        drifted = drift(known, self.baseline_header or [], "input_header")
        return drifted.select(CASE, "input_header", F.col("removed").alias("input_removed"), F.col("added").alias("input_added"))

    def meta(self) -> DataFrame:
        """One row per run, with what its header and its input's header say."""
        if self.header_table is None and self.input_header_table is None:
            return self._listed_meta()
        rows = [(lit(c), f"CAST({lit(n)} AS BIGINT)") for c, n in (self.expected_rows or {}).items()]
        counts = values_table(self.spark, [CASE, "expected_rows"], rows or [("CAST(NULL AS STRING)", "CAST(NULL AS BIGINT)")])
        found = compared(self.run_headers(), self.contract.names).join(self.case_inputs(), CASE, "left").join(counts, CASE, "left")
        return found.select(*_META)

    def _listed_meta(self) -> DataFrame:
        """The same of headers that the caller has as lists: an inline table."""
        want, base = self.contract.names, self.baseline_header or []
        rows = []
        for run, header in self.headers.items():
            case = self.cases[run]
            missing, extra = [c for c in want if c not in header], [c for c in header if c not in want]
            renames = [f"{m}→{found}" for m in missing if (found := close_name(m, extra))]
            inp = self.input_headers.get(case)
            none = "CAST(NULL AS ARRAY<STRING>)"
            drifted = (none, none, none) if inp is None else (_texts(inp), _texts([c for c in base if c not in inp]), _texts([c for c in inp if c not in base]))
            count = (self.expected_rows or {}).get(case)
            rows.append((lit(run), lit(case), _texts(header), "1L", _texts(missing), _texts(extra), _texts(renames), *drifted, f"CAST({lit(count)} AS BIGINT)"))
        return values_table(self.spark, _META, rows)

    def run_cases(self) -> DataFrame:
        """``(run_id, case)``, one row per run."""
        return self.run_headers().select(RUN, CASE)

    def per_run(self, df: DataFrame) -> DataFrame:
        """Repeat per-case rows for every run of the case."""
        return df.join(self.run_cases(), CASE)

    @staticmethod
    def column(df: DataFrame, column: str) -> str:
        """Expression of a column, NULL when the table lacks it."""
        return name(column) if column in df.columns else "CAST(NULL AS STRING)"

    @staticmethod
    def single(spark: SparkSession, contract: Contract, output: DataFrame, *, run: str = "run",
               case: str = "baseline", inp: DataFrame | None = None, expected: DataFrame | None = None,
               expected_rows: int | None = None, baseline: DataFrame | None = None,
               baseline_header: list[str] | None = None, medians: Mapping[str, float] | None = None) -> RunSet:
        """One output table (with ``_ord``) as a run set."""
        def tagged(df: DataFrame | None) -> DataFrame | None:
            return None if df is None else df.withColumn(CASE, F.lit(case))

        def header(df: DataFrame) -> list[str]:
            return [c for c in df.columns if c != ORD]

        return RunSet(
            spark, contract, tagged(output).withColumn(RUN, F.lit(run)), {run: header(output)}, {run: case},
            inputs=tagged(inp), input_headers={} if inp is None else {case: header(inp)},
            baseline_header=baseline_header, expected=tagged(expected),
            expected_rows=None if expected_rows is None else {case: expected_rows},
            baseline=baseline, medians=medians or {},
        )
