"""All checks of one or many runs as one plan, one result row per run and check."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import Contract
from ..functions.sql import array, in_list, lit
from ..operators.aggregates import status_counts, status_rollup
from ..operators.clean import clean
from ..operators.ordering import ORD
from ..sources.staging import materialize
from . import metrics as M
from . import profile as P
from .runs import CASE, RUN, RunSet

# Check ids, in report order, and their titles.
CHECKS = {
    "INP-01": "Input at run time = this case",
    "SCH-01": "Output columns match contract",
    "SCH-02": "Values parse as contract types",
    "SCH-03": "Input header vs baseline input",
    "ROW-03": "Output not empty",
    "ROW-01": "Row count matches expectation",
    "ROW-02": "Key accounting vs ground truth",
    "CLN-01": "No duplicate rows / keys",
    "CLN-02": "No nulls in non-nullable columns",
    "CLN-03": "Text normalisation rules applied",
    "CLN-04": "Categorical values allowed",
    "CLN-05": "Values within valid ranges",
    "CLN-06": "Missing values imputed per contract",
    "CLN-07": "Sorted by key",
    "CLN-08": "Cell-level match with ground truth",
    "CLN-09": "Output formatting as specified",
    "SEM-01": "Level vs reference",
    "SEM-02": "Per-key level vs baseline",
    "SEM-03": "Date window & month distribution",
    "SEM-04": "Per-key date vs baseline",
    "SEM-05": "Categorical distributions vs reference",
}
STRUCTURAL = tuple(c for c in CHECKS if c[:3] in ("SCH", "ROW", "CLN"))
SEMANTIC = tuple(c for c in CHECKS if c.startswith("SEM"))
PASS, FAIL, WARN, SKIP = "PASS", "FAIL", "WARN", "SKIP"

RESULT_COLUMNS = [RUN, CASE, "check_id", "name", "status", "message", "details"]


def _zero(c: str) -> str:
    return f"coalesce({c}, 0L)"


def _join(items: str, render: str) -> str:
    """Comma-separated rendering of an array; ``x`` is the item."""
    return f"array_join(transform({items}, x -> concat({render})), ', ')"


def run_metrics(rs: RunSet, checks: Collection[str] = tuple(CHECKS), reference: DataFrame | None = None) -> DataFrame:
    """One wide row per run with every measurement the checks need.

    The wide passes over the data end in compact tables (counted facts by key, counted
    values) that are written once and read by everything after them. The resulting
    sources are one row per run each; they are unioned and folded in a single small
    aggregation rather than joined one after the other.
    """
    c = rs.contract
    out = rs.outputs
    keyed = c.key in out.columns
    cell_checks = [x for x in M.CELL_CHECKS if x in checks]
    # Without checks of cells, only the rows are counted and no cell is read.
    sources = [M.cell_metrics(out, c, [RUN], cell_checks) if cell_checks else out.groupBy(RUN).agg(F.count(F.lit(1)).alias("rows"))]
    if "CLN-01" in checks:
        sources.append(M.duplicate_metrics(rs))
    if "CLN-07" in checks and keyed:
        sources.append(M.order_metrics(rs).select(RUN, "first_break", "first_null"))
    if "ROW-01" in checks and rs.expected_rows is None and rs.expected is not None:
        per_case = rs.expected.groupBy(CASE).agg(F.count(F.lit(1)).alias("truth_rows"))
        sources.append(rs.per_run(per_case).select(RUN, "truth_rows"))
    context = {"CLN-06": rs.inputs, "SEM-02": rs.baseline, "SEM-04": rs.baseline}
    key_checks = [x for x in M.KEY_CHECKS if x in checks and context.get(x, rs.expected) is not None]
    if key_checks and keyed:
        facts = M.key_facts(rs, key_checks)
        if "ROW-02" in key_checks:
            sources.append(M.accounting_metrics(facts))
        if "CLN-08" in key_checks:
            sources.append(M.truth_metrics(facts, c))
        if "CLN-06" in key_checks:
            items = F.struct("column", "imputed_rows", "target", "wrong")
            sources.append(M.imputation_metrics(facts, rs).groupBy(RUN).agg(
                F.sort_array(F.collect_list(items)).alias("imputed")
            ))
        if "SEM-02" in key_checks and c.level_column:
            # Selections have plans of their own: one plan for all would be planned anew after each of their stages.
            r, _ = materialize(M.ratio_metrics(facts, c), "ratio_metrics")
            sources.append(r.select(RUN, F.struct(*[x for x in r.columns if x != RUN]).alias("sem02")))
        if "SEM-04" in key_checks and c.date_column:
            r = M.date_metrics(facts)
            sources.append(r.select(RUN, F.struct(*[x for x in r.columns if x != RUN]).alias("sem04")))
    if any(x in checks for x in ("SEM-01", "SEM-03", "SEM-05")) and (reference is not None or rs.baseline is not None):
        ref = reference if reference is not None else P.profile(rs.baseline, c)
        ref, _ = materialize(ref, "reference_profile")
        values, _ = materialize(P.value_facts(out, c, [RUN]), "value_facts")
        if "SEM-01" in checks and c.level_column:
            r, _ = materialize(P.level_metrics(values, ref, c), "level_metrics")
            sources.append(r.select(RUN, F.struct("median", "reference_median", "ratio").alias("sem01")))
        if "SEM-03" in checks:
            sources.append(P.window_metrics(values))
        if "SEM-03" in checks or "SEM-05" in checks:
            d = P.distribution_metrics(values, rs, ref)
            sources.append(d.groupBy(RUN).agg(
                F.sort_array(F.collect_list(F.struct("column", "js_distance"))).alias("distances")
            ))
    union = rs.meta()
    for s in sources:
        union = union.unionByName(s, allowMissingColumns=True)
    folded = union.groupBy(RUN).agg(*[F.first(x, ignorenulls=True).alias(x) for x in union.columns if x != RUN])
    # A run without rows has no counters: it still is a run.
    return folded.withColumn("rows", F.expr(_zero("rows")))


Verdict = tuple[str, str, str]


def _verdicts(rs: RunSet, df: DataFrame, checks: Collection[str]) -> dict[str, Verdict]:
    """check id -> (status, message, details) expressions over a :func:`run_metrics` row."""
    c = rs.contract
    has = set(df.columns)
    keyed = f"array_contains(header, {lit(c.key)})"
    out: dict[str, Verdict] = {}

    def put(check: str, branches: list[tuple[str | None, str, str]], details: str = "'{}'") -> None:
        """Branches are ``(condition, status, message)``; the last one has no condition."""
        if check not in checks:
            return

        def case(pick) -> str:
            whens = [f"WHEN {b[0]} THEN {pick(b)}" for b in branches[:-1]]
            last = pick(branches[-1])
            return f"CASE {' '.join(whens)} ELSE {last} END" if whens else last

        out[check] = (case(lambda b: lit(b[1])), case(lambda b: b[2]), f"coalesce({details}, '{{}}')")

    def skip(check: str, why: str) -> None:
        put(check, [(None, SKIP, lit(why))])

    def cell_check(check: str, good: str, render: str, severity: str = FAIL, narrow: str = "true") -> None:
        bad = f"filter(cells, x -> x.check_id = {lit(check)} AND x.violations > 0 AND {narrow})"
        put(check, [(f"size({bad}) > 0", severity, _join(bad, render)), (None, PASS, lit(good))], f"to_json({bad})")

    # ---- schema
    in_order = f"header = {array(lit(n) for n in c.names)}"
    same_set = "size(missing) = 0 AND size(extra) = 0"
    found = ("array_join(array_compact(array("
             "CASE WHEN size(missing) > 0 THEN concat('missing ', array_join(missing, ', ')) END, "
             "CASE WHEN size(extra) > 0 THEN concat('unexpected ', array_join(extra, ', ')) END, "
             "CASE WHEN size(renames) > 0 THEN concat('possible renames ', array_join(renames, ', ')) END)), '; ')")
    put("SCH-01", [
        ("layouts > 1", FAIL, "concat('its files have ', layouts, ' different headers')"),
        (f"{same_set} AND {in_order}", PASS, "concat(size(header), ' columns, correct order')"),
        (same_set, WARN, "'same columns, different order'"), (None, FAIL, found),
    ], "to_json(struct(missing, extra, renames))")
    share = "(x.present - x.violations) / x.present"
    cell_check("SCH-02", "all typed columns parse",
               f"x.column, ': ', format_number({share} * 100, 1), '% parse as contract type'",
               narrow=f"x.present > 0 AND {share} < {c.castable_fraction}D")
    if rs.baseline_header is None:
        skip("SCH-03", "no baseline input header")
    else:
        base = f"CAST({array(lit(x) for x in rs.baseline_header)} AS ARRAY<STRING>)"
        put("SCH-03", [
            ("input_header IS NULL", SKIP, "'no input'"),
            (f"input_header = {base}", PASS, "'input header unchanged'"),
            (None, WARN, "concat('drifted input: removed [', array_join(input_removed, ', '), '], added [', array_join(input_added, ', '), ']')"),
        ])

    # ---- rows
    put("ROW-03", [("rows = 0", FAIL, "'output has no data rows'"), (None, PASS, "concat(rows, ' rows')")])
    expected = "coalesce(expected_rows, truth_rows)" if "truth_rows" in has else "expected_rows"
    put("ROW-01", [
        (f"{expected} IS NULL", SKIP, "'no expected count'"),
        (f"rows = {expected}", PASS, "concat(rows, ' rows as expected')"),
        (None, FAIL, f"format_string('%d rows, expected %d (%+d)', rows, {expected}, rows - {expected})"),
    ], f"to_json(struct(rows, {expected} AS expected))")
    if "missing_keys" in has and rs.expected is not None:
        m, u, d = _zero("missing_keys"), _zero("unexpected_keys"), _zero("duplicate_key_rows")
        put("ROW-02", [
            (f"NOT {keyed}", SKIP, "'no key column'"),
            (f"{m} + {u} + {d} = 0", PASS, "'exactly the expected set of keys'"),
            (None, FAIL, f"format_string('%d expected keys missing, %d unexpected, %d duplicated', {m}, {u}, {d})"),
        ], f"to_json(struct({m} AS missing, {u} AS unexpected, {d} AS duplicate))")
    else:
        skip("ROW-02", "no ground truth or key column")

    # ---- cleaning
    if "duplicate_rows" in has:
        r, k = _zero("duplicate_rows"), _zero("duplicate_keys")
        put("CLN-01", [
            (f"{r} + {k} > 0", FAIL, f"format_string('%d fully duplicated rows, %d duplicated key values', {r}, {k})"),
            (None, PASS, "'no duplicates'"),
        ], f"to_json(struct({r} AS duplicate_rows, {k} AS duplicate_keys))")
    times = "x.column, ':', x.rule, ' ×', x.violations"
    cell_check("CLN-02", "no unexpected nulls", "x.column, ': ', x.violations, ' nulls'")
    cell_check("CLN-03", "trim/spacing/case rules hold", times)
    cell_check("CLN-04", "all categorical values allowed", "x.column, ': ', x.violations, ' not allowed'")
    cell_check("CLN-05", "all values in range",
               "x.column, ': ', x.violations, ' outside (seen ', x.min_seen, '…', x.max_seen, ')'")
    if rs.inputs is None or "imputed" not in has:
        skip("CLN-06", "no input" if rs.inputs is None else "key column missing")
    else:
        seen = "coalesce(imputed, array())"
        wrong = f"filter({seen}, x -> x.wrong > 0)"
        idle = f"NOT {keyed} OR NOT coalesce(array_contains(input_header, {lit(c.key)}), false)"
        put("CLN-06", [
            (idle, SKIP, "'key column missing'"), (f"size({seen}) = 0", PASS, "'nothing to impute'"),
            (f"size({wrong}) = 0", PASS, _join(seen, "x.column, '=', x.target, '×', x.imputed_rows")),
            (None, FAIL, _join(wrong, "x.column, ': ', x.wrong, '/', x.imputed_rows, ' imputed cells ≠ ', "
                                      "coalesce(x.target, '?')")),
        ], f"to_json({seen})")
    if "first_break" in has:
        at = "coalesce(first_break, first_null)"
        put("CLN-07", [
            (f"NOT {keyed}", SKIP, "'key column missing'"),
            (f"{at} IS NOT NULL", FAIL, f"concat('not ascending (first break at row ', {at} + 1, ')')"),
            (None, PASS, "'ascending'"),
        ])
    else:
        skip("CLN-07", "key column missing")
    if "mismatches" in has and rs.expected is not None:
        bad = "filter(mismatches, x -> x.mismatches > 0)"
        put("CLN-08", [
            (f"NOT {keyed}", SKIP, "'no key column'"),
            (f"size({bad}) > 0", FAIL, _join(bad, "x.column, ': ', x.mismatches, '/', compared")),
            (None, PASS, f"concat({_zero('compared')}, ' keys identical')"),
        ], f"to_json({bad})")
    else:
        skip("CLN-08", "no ground truth or key column")
    cell_check("CLN-09", "dates ISO, decimals fixed, ints literal", times, severity=WARN)

    # ---- meaning
    level, date = c.level_column, c.date_column
    if "sem01" in has:
        r = "sem01.ratio"
        put("SEM-01", [
            (f"NOT array_contains(header, {lit(level)})", SKIP, "'column missing'"),
            (f"coalesce({r} BETWEEN {1 / c.level_ratio_max!r}D AND {c.level_ratio_max}D, false)", PASS,
             f"format_string('median %.2f (ratio %.2f)', sem01.median, {r})"),
            (f"{r} IS NULL", FAIL, lit(f"no numeric {level} values")),
            (None, FAIL, f"concat(format_string('median %.2f vs reference %.2f = ×%.1f', sem01.median, "
                         f"sem01.reference_median, {r}), "
                         f"if({r} BETWEEN 80 AND 120, ' → looks like a unit change (×100)', ''))"),
        ], "to_json(sem01)")
    else:
        skip("SEM-01", "no reference")
    if "sem02" in has:
        n, mid = _zero("sem02.compared"), "sem02.median_ratio"
        hint = (f"if(abs({mid} - rint({mid})) < 0.02 AND {mid} >= 10, "
                f"format_string('; consistent ×%.0f (unit change)', {mid}), '')")
        put("SEM-02", [
            (f"NOT {keyed} OR NOT array_contains(header, {lit(level)}) OR {n} = 0", SKIP, "'nothing comparable'"),
            (f"sem02.changed_share <= {c.per_key_changed_max}D", PASS, f"concat({n}, ' keys unchanged')"),
            (None, FAIL, f"concat(format_string('%.0f%% of %d keys changed, median ratio %.2f', "
                         f"sem02.changed_share * 100, {n}, {mid}), {hint})"),
        ], "to_json(sem02)")
    else:
        skip("SEM-02", "no baseline")
    if "dates" in has and "distances" in has and date:
        n = _zero("dates")
        share = f"try_divide({_zero('out_of_window')}, {n})"
        jsd = f"get(filter(distances, x -> x.column = {lit(date)}), 0).js_distance"
        put("SEM-03", [
            (f"NOT array_contains(header, {lit(date)})", SKIP, "'column missing'"),
            (f"{n} = 0", FAIL, "'no parseable dates'"),
            (f"coalesce({share} <= {c.out_of_window_max}D AND {jsd} <= {c.month_jsd_max}D, false)", PASS,
             f"format_string('all dates in window, month distance %.3f', {jsd})"),
            (None, FAIL, f"format_string('%.0f%% of dates outside the window, month distance %.2f', {share} * 100, {jsd})"),
        ], f"to_json(struct({n} AS dates, {share} AS out_of_window_share, {jsd} AS month_jsd))")
    else:
        skip("SEM-03", "no reference")
    if "sem04" in has:
        t, o, x, g = (_zero(f"sem04.{k}") for k in ("transposed", "other", "lost", "lost_day_gt_12"))
        put("SEM-04", [
            (f"NOT {keyed} OR NOT array_contains(header, {lit(date)})", SKIP, "'column missing'"),
            (f"{t} + {o} + {x} = 0", PASS, f"concat({_zero('sem04.unchanged')}, ' dates unchanged')"),
            (None, FAIL, "format_string('%d dates day/month-transposed, %d otherwise changed, "
                         f"%d lost/unparseable (%d of them have day > 12)', {t}, {o}, {x}, {g})"),
        ], "to_json(sem04)")
    else:
        skip("SEM-04", "no baseline")
    if "distances" in has:
        cats = in_list([x.name for x in c.of_drift("distribution")] or [""])
        mine = f"filter(distances, x -> x.column IN {cats})"
        bad = f"filter(distances, x -> x.column IN {cats} AND x.js_distance > {c.categorical_jsd_max}D)"
        show = "x.column, ' ', format_string('%.3f', x.js_distance)"
        put("SEM-05", [
            (f"coalesce(size({mine}), 0) <= 0", SKIP, "'no categorical columns'"),
            (f"size({bad}) > 0", FAIL, f"concat('distance ', {_join(bad, show)})"), (None, PASS, _join(mine, show)),
        ], f"to_json({mine})")
    else:
        skip("SEM-05", "no reference")
    return {k: out[k] for k in CHECKS if k in out}


def validate_runs(rs: RunSet, checks: Sequence[str] = (*STRUCTURAL, *SEMANTIC), reference: DataFrame | None = None,
                  provenance: DataFrame | None = None) -> DataFrame:
    """Check results of all runs: :data:`RESULT_COLUMNS`, one row per run and check.

    ``provenance`` (``run_id, status, message``) adds INP-01.
    """
    wide, _ = materialize(run_metrics(rs, checks, reference), "run_metrics")
    verdicts = _verdicts(rs, wide, checks)
    items = array(
        f"named_struct('check_id', {lit(check)}, 'name', {lit(CHECKS[check])}, 'status', {status}, "
        f"'message', {message}, 'details', {details})"
        for check, (status, message, details) in verdicts.items()
    )
    result = wide.selectExpr(RUN, CASE, f"explode({items}) AS v").select(RUN, CASE, "v.*").select(*RESULT_COLUMNS)
    if provenance is not None:
        first = provenance.select(
            RUN, CASE, F.lit("INP-01").alias("check_id"), F.lit(CHECKS["INP-01"]).alias("name"), "status", "message",
            F.lit("{}").alias("details"),
        )
        result = first.unionByName(result)
    return result


def validate_run(spark: SparkSession, contract: Contract, output: DataFrame, **inputs) -> DataFrame:
    """All checks of one output table; keyword arguments as for :meth:`RunSet.single`."""
    return validate_runs(RunSet.single(spark, contract, output, **inputs))


def summarize(results: DataFrame) -> DataFrame:
    """One row per run: overall result, counts per status, failed check ids."""
    keys = [RUN, CASE]
    failed = results.groupBy(*keys).agg(
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("status") == FAIL, F.col("check_id")))), ",").alias("failed")
    )
    return status_rollup(results, keys).join(status_counts(results, keys), keys).join(failed, keys)


def predict_case(spark: SparkSession, contract: Contract, drifted: DataFrame, *, case: str, expected: DataFrame,
                 baseline: DataFrame, baseline_header: list[str], medians=None) -> DataFrame:
    """Clean a (drifted) raw input literally by the contract, then validate the result."""
    return validate_run(
        spark, contract, clean(drifted, contract), run="prediction", case=case, inp=drifted.drop(ORD),
        expected=expected, baseline=baseline, baseline_header=baseline_header, medians=medians,
    )
