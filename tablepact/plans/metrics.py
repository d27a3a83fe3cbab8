"""Measurements behind the checks, one row per run each.

Fusion: every rule that looks at single cells is a counter of one aggregation over
one scan (:func:`cell_metrics`); every comparison by key comes out of one shuffle of
the outputs that meets truth, inputs and baseline, each folded once per key (:func:`key_facts`).
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contract import Contract
from ..functions import dates as D
from ..functions import numeric as N
from ..functions import text as X
from ..functions.compare import tolerant_equal
from ..functions.sql import array, in_list, lit, literal_map, name
from ..operators.aggregates import duplicate_keys, duplicate_rows
from ..operators.ordering import ORD, order_breaks
from ..operators.quantiles import quantiles
from ..sources.staging import materialize
from .runs import CASE, RUN, RunSet

CELL_CHECKS = ("SCH-02", "CLN-02", "CLN-03", "CLN-04", "CLN-05", "CLN-09")
CHUNK = 80  # aggregates per scan: a wider generated method would fall out of code generation


def _cell_rules(contract: Contract, checks: Collection[str], columns: Collection[str]):
    """``(check, column, rule, violation)`` for every single-cell rule.

    ``v_`` (text), ``p_`` (present), ``x_`` (number) and ``d_`` (date) columns are
    prepared by :func:`_prepared`.
    """
    for c in contract.columns:
        if c.name not in columns:
            continue
        v, p, x, d = (name(f"{k}_{c.name}") for k in ("v", "p", "x", "d"))
        if "SCH-02" in checks and c.dtype != "string":
            good = {"float": f"{x} IS NOT NULL", "int": N.is_integral(x), "date": f"{d} IS NOT NULL"}[c.dtype]
            yield "SCH-02", c, "castable", f"{p} AND NOT ({good})"
        if "CLN-02" in checks and not c.nullable:
            yield "CLN-02", c, "not_null", f"{v} IS NOT NULL AND NOT {p}"
        if "CLN-03" in checks:
            for rule in c.rules:
                yield "CLN-03", c, rule, f"{p} AND NOT {X.rule_holds(rule, v)}"
        if "CLN-04" in checks and c.allowed is not None:
            yield "CLN-04", c, "allowed", f"{p} AND {v} NOT IN {in_list(c.allowed)}"
        if "CLN-05" in checks and (c.min is not None or c.max is not None):
            u, bound = (d, D.day_bound) if c.dtype == "date" else (x, lambda b: lit(float(b)))
            sides = [f"{u} < {bound(c.min)}"] * (c.min is not None) + [f"{u} > {bound(c.max)}"] * (c.max is not None)
            yield "CLN-05", c, "range", " OR ".join(sides)
        if "CLN-09" in checks:
            yield "CLN-09", c, "null_token", f"{v} IS NOT NULL AND NOT {p} AND {v} <> ''"
            if c.dtype == "date":
                yield "CLN-09", c, "not_YYYY-MM-DD", f"{p} AND NOT {X.full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}')}"
            elif c.dtype == "float" and c.decimals:
                yield "CLN-09", c, f"not_{c.decimals}dp", (
                    f"{p} AND NOT " + X.full_match(v, rf"-?[0-9]+\.[0-9]{{{c.decimals}}}"))
            elif c.dtype == "int":
                yield "CLN-09", c, "not_integer_literal", f"{p} AND NOT {X.full_match(v, '-?[0-9]+')}"


def _prepared(df: DataFrame, contract: Contract, columns: Collection[str], keep: Collection[str]) -> DataFrame:
    """Text, presence and parsed value of each column; native numbers and dates are not re-parsed."""
    first, out = [name(k) for k in keep], [name(k) for k in keep]
    for c in columns:
        v, dtype, native = name(c), contract[c].dtype, df.schema[c].dataType.typeName() != "string"
        t, p, s = name("v_" + c), name("p_" + c), name("s_" + c)
        present = f"{v} IS NOT NULL" if native else f"({v} IS NOT NULL AND {X.is_present(v)})"
        first += [f"CAST({v} AS STRING) AS {t}", f"{present} AS {p}"]
        out += [t, p]
        if dtype in ("int", "float"):
            first.append(f"CAST({v} AS DOUBLE) AS {s}" if native else f"{v} AS {s}")
            out.append(f"{f'nanvl({s}, NULL)' if native else N.to_num(s)} AS {name('x_' + c)}")
        elif dtype == "date":
            first.append(f"CAST({v} AS TIMESTAMP_NTZ) AS {s}" if native else f"{X.strip(v)} AS {s}")
            out.append(f"{s if native else f'CASE WHEN {p} THEN {D.date_of(s)} END'} AS {name('d_' + c)}")
    return df.selectExpr(*first).selectExpr(*out)


def _seen(c, which: str) -> str:
    """Smallest or largest parsed value of a ranged column, as text."""
    if c.dtype == "date":
        return f"CAST(CAST({which}({name('d_' + c.name)}) AS DATE) AS STRING)"
    x = f"{which}({name('x_' + c.name)})"
    return f"CASE WHEN {N.is_integral(x)} THEN {N.int_text(x)} ELSE CAST({x} AS STRING) END"


def cell_metrics(df: DataFrame, contract: Contract, by: list[str], checks: Collection[str] = CELL_CHECKS) -> DataFrame:
    """``(by..., rows, cells)``; ``cells`` has one struct per rule, violated or not.

    One map-side combined aggregation per group of columns, normally one in all.
    A contract wide enough to leave code generation is split by column, and each part
    scans its own columns only.
    """
    if not by:
        one = cell_metrics(df.withColumn("_all", F.lit(0)), contract, ["_all"], checks)
        return one.drop("_all")
    columns = [c for c in contract.names if c in df.columns]
    parts: list[list[str]] = [[]]
    width = 0
    for column in columns:
        n = sum(1 for _ in _cell_rules(contract, checks, [column])) + 3
        if width and width + n > CHUNK:
            parts.append([])
            width = 0
        parts[-1].append(column)
        width += n
    result = None
    for part in parts:
        rules = list(_cell_rules(contract, checks, part))
        used = sorted({c.name for _, c, _, _ in rules})
        aggs = [F.expr("count(*)").alias("rows")]
        aggs += [F.expr(f"count_if({name('p_' + n)})").alias(f"present_{n}") for n in used]
        cells = []
        for i, (check, c, rule, bad) in enumerate(rules):
            aggs.append(F.expr(f"count_if({bad})").alias(f"n{i}"))
            lo = hi = "CAST(NULL AS STRING)"
            if check == "CLN-05":
                lo, hi = f"lo{i}", f"hi{i}"
                aggs += [F.expr(_seen(c, "min")).alias(lo), F.expr(_seen(c, "max")).alias(hi)]
            cells.append(
                f"named_struct('check_id', {lit(check)}, 'column', {lit(c.name)}, 'rule', {lit(rule)}, "
                f"'present', {name('present_' + c.name)}, 'violations', n{i}, 'min_seen', {lo}, 'max_seen', {hi})"
            )
        agg = _prepared(df, contract, used, by).groupBy(*by).agg(*aggs)
        agg = agg.selectExpr(*[name(b) for b in by], "rows", f"{array(cells)} AS cells")
        if result is None:
            result = agg
        else:
            more = agg.select(*by, F.col("cells").alias("_more"))
            result = result.join(more, by).select(*by, "rows", F.concat("cells", "_more").alias("cells"))
    return result


def offending_values(df: DataFrame, contract: Contract, by: list[str],
                     checks: Collection[str] = CELL_CHECKS) -> DataFrame:
    """Distinct offending values and their counts: ``(by..., check_id, column, rule, value, n)``.

    Second pass for reports; only violating cells leave the scan, counted map-side.
    """
    columns = [c for c in contract.names if c in df.columns]
    hits = array(
        f"CASE WHEN {bad} THEN named_struct('check_id', {lit(check)}, 'column', {lit(c.name)}, "
        f"'rule', {lit(rule)}, 'value', {name('v_' + c.name)}) END"
        for check, c, rule, bad in _cell_rules(contract, checks, columns)
    )
    exploded = _prepared(df, contract, columns, by).selectExpr(*[name(b) for b in by], f"explode({hits}) AS h").where("h IS NOT NULL")
    return exploded.groupBy(*by, "h.check_id", "h.column", "h.rule", "h.value").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- duplicates, order
def duplicate_metrics(rs: RunSet) -> DataFrame:
    """``(run_id, duplicate_rows, duplicate_keys)``: extra copies of rows and of key texts."""
    cols = [c for c in rs.outputs.columns if c not in (RUN, CASE, ORD)]
    out = rs.outputs
    rows = duplicate_rows(out, [RUN], cols)
    key = rs.contract.key
    if key not in out.columns:
        return rows.withColumn("duplicate_keys", F.lit(0).cast("bigint"))
    present = out.where(F.col(key).isNotNull())
    keys = duplicate_keys(present, [RUN], [key]).groupBy(RUN).agg(F.sum(F.col("n") - 1).alias("duplicate_keys"))
    return rows.join(keys, RUN, "full").select(
        RUN, *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("duplicate_rows", "duplicate_keys")]
    )


def order_metrics(rs: RunSet) -> DataFrame:
    """``(run_id, rows, first_break, first_null)`` of the numeric key in file order."""
    key = name(rs.contract.key)
    return order_breaks(rs.outputs.where(f"{key} IS NOT NULL"), [RUN], F.expr(N.to_num(key)))


# ---------------------------------------------------------------- by key
KEY_CHECKS = ("ROW-02", "CLN-06", "CLN-08", "SEM-02", "SEM-04")


#: Repeated keys that a join may broadcast; more go by a shuffle.
FEW_KEYS = 200_000


def _repeated(sides: Mapping[str, DataFrame]) -> dict[str, tuple[DataFrame, int]]:
    """Keys that occur more than once, of several tables: ``(group, _k, n)`` and their number per table.

    A table has columns ``group`` (its run or case, null if it has none) and ``_k``. One job counts 64-bit hashes, so that
    a row is eight bytes to shuffle and combine; keys are compared in full only where a hash is not alone.
    """
    every = reduce(DataFrame.unionByName, (df.select(F.lit(side).alias("side"), F.col("group").cast("string").alias("group"), "_k") for side, df in sides.items()))
    every = every.withColumn("_h", F.xxhash64("side", "group", "_k"))
    suspects, few = materialize(every.groupBy("_h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_h"), "repeated_hashes")
    if not few:
        return {side: (every.where("false").select("group", "_k", F.lit(0).cast("bigint").alias("n")), 0) for side in sides}
    same = every.join(F.broadcast(suspects) if few <= FEW_KEYS else suspects, "_h", "left_semi")
    found, n = materialize(same.groupBy("side", "group", "_k").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated_keys")
    sizes = {r["side"]: r["n"] for r in found.groupBy("side").agg(F.count(F.lit(1)).alias("n")).collect()} if n else {}
    return {side: (found.where(F.col("side") == side).drop("side"), sizes.get(side, 0)) for side in sides}


def _unique(df: DataFrame, by: list[str], columns: Collection[str], repeated: DataFrame, n: int) -> DataFrame:
    """One row per key of a reference table. It should be so; where keys repeat, the smallest row stands for them."""
    if not n:
        return df
    keys = repeated.select("_k").distinct()
    first = df.join(keys, "_k", "left_semi").groupBy(*by).agg(F.min(F.struct(*columns)).alias("_row")).select(*by, "_row.*")
    return df.join(keys, "_k", "left_anti").select(*by, *columns).unionByName(first)


def key_facts(rs: RunSet, checks: Collection[str] = KEY_CHECKS) -> DataFrame:
    """Everything the key comparisons need, as counted facts ``(run_id, kind, name, v, n)``; see :func:`key_patterns`.

    The facts are compact and written, as several checks read them.
    """
    patterns, facts, totals = key_patterns(rs, checks)
    counted = patterns.selectExpr(RUN, f"explode({array(facts)}) AS f").where("f IS NOT NULL").selectExpr(RUN, "f.kind", "f.name", "f.v", "f.w AS n")
    for t in totals:
        counted = counted.unionByName(t)
    summed = counted.groupBy(RUN, "kind", "name", "v").agg(F.sum("n").alias("n"))
    return materialize(summed.where("n <> 0").select(RUN, "kind", "name", F.nanvl("v", F.lit(None).cast("double")).alias("v"), "n"), "key_facts")[0]


def key_patterns(rs: RunSet, checks: Collection[str] = KEY_CHECKS) -> tuple[DataFrame, list[str], list[DataFrame]]:
    """What holds for the output rows, counted; the facts that follow from a pattern; and facts of whole runs.

    Outputs are dealt by (case, key) once and meet truth, input mask and baseline there, each folded once per key and
    never repeated per run. References are unique by key and built as hash tables, so outputs are not sorted (which spills). What holds for a row becomes a number of bits and the few values that matter;
    rows with equal ones are counted before the shuffle. Keys that a run lacks are the reference's count less
    those found, so no run is joined outwards. Keys that repeat within a run are found by counting; the first
    output row (by ``_ord``, unique in a run) stands for them. Missing keys are left out (the cell counters report them).
    """
    c, key = rs.contract, rs.contract.key
    level, date = c.level_column, c.date_column
    imputed = [] if rs.inputs is None else c.imputed
    truth_columns = [n for n in c.names if n != key]
    with_truth = rs.expected is not None and any(x in checks for x in ("ROW-02", "CLN-06", "CLN-08"))
    compare_cells = "CLN-08" in checks and rs.expected is not None
    compare_level = "SEM-02" in checks and level is not None and rs.baseline is not None
    compare_date = "SEM-04" in checks and date is not None and rs.baseline is not None
    wanted = set(truth_columns if compare_cells else ())
    wanted.update(i.name for i in imputed if "CLN-06" in checks)
    wanted.update([level] * compare_level + [date] * compare_date)
    need = [n for n in c.names if n in wanted]
    by_key = [CASE, "_k"]
    k = f"{N.to_key(name(key))} AS _k"

    def cells(df: DataFrame, prefix: str, only: Collection[str]) -> list[str]:
        return [f"{rs.column(df, n)} AS {name(prefix + n)}" for n in only]

    out = rs.outputs.selectExpr(RUN, CASE, k, ORD, *cells(rs.outputs, "o_", need)).where("_k IS NOT NULL")
    sides = {"outputs": out.select(F.col(RUN).alias("group"), "_k")}
    if with_truth:
        sides["truth"] = rs.expected.selectExpr(f"{name(CASE)} AS group", k).where("_k IS NOT NULL")
    if compare_level or compare_date:
        sides["baseline"] = rs.baseline.selectExpr("CAST(NULL AS STRING) AS group", k).where("_k IS NOT NULL")
    twice = _repeated(sides)
    repeated, n_repeated = twice["outputs"]
    repeated = repeated.select(F.col("group").alias(RUN), "_k", F.col("n").alias("n_out"))
    rows = out
    if n_repeated:
        few = F.broadcast(repeated) if n_repeated <= FEW_KEYS else repeated
        first = out.select(RUN, "_k", ORD).join(few, [RUN, "_k"], "left_semi").groupBy(RUN, "_k").agg(F.min(ORD).alias("_first"))
        rows = out.join(F.broadcast(first) if n_repeated <= FEW_KEYS else first, [RUN, "_k"], "left").where(f"_first IS NULL OR _first = {ORD}").drop("_first")
    per_run = rs.run_cases()
    totals: list[DataFrame] = []

    def total(per_case: DataFrame, kind: str, what: str, n: str) -> None:
        """A fact of every run of a case, from a count of its case."""
        totals.append(per_case.selectExpr(CASE, f"{lit(kind)} AS kind", f"{lit(what)} AS name", f"{n} AS n"))

    if with_truth:
        e_cells = cells(rs.expected, "e_", need)
        exp = _unique(rs.expected.selectExpr(CASE, k, *e_cells).where("_k IS NOT NULL"), by_key, ["e_" + n for n in need], *twice["truth"])
        # Whether a cell equals itself (a text in a number column does not) is known once per key; most cells of a run
        # are spelled like the truth's and need no more than that.
        itself = " + ".join(f"CASE WHEN {tolerant_equal(name('e_' + n), name('e_' + n), c[n].dtype, c.numeric_abs)} THEN {2**i}L ELSE 0L END"
                            for i, n in enumerate(truth_columns)) if compare_cells else "0L"
        rows = rows.join(exp.withColumn("_e", F.expr(itself)).hint("shuffle_hash"), by_key, "left")
        if "ROW-02" in checks:
            total(exp.groupBy(CASE).agg(F.count(F.lit(1)).alias("_n")), "ROW-02", "missing", "_n")
    flags = [i.name for i in imputed if i.name in rs.inputs.columns]
    if compare_level and rs.inputs is not None and level in rs.inputs.columns and level not in flags:
        flags.append(level)
    mask = None
    if flags:
        gone = [f"CASE WHEN {name(n)} IS NOT NULL AND {X.is_missing(name(n))} THEN {2**j}L ELSE 0L END" for j, n in enumerate(flags)]
        marked = rs.inputs.selectExpr(CASE, k, f"{' + '.join(gone)} AS _m").where("_m <> 0 AND _k IS NOT NULL")
        mask = marked.groupBy(*by_key).agg(F.expr("bit_or(_m)").alias("mask"))
        rows = rows.join(mask.hint("shuffle_hash"), by_key, "left")
    else:
        rows = rows.withColumn("mask", F.lit(None).cast("bigint"))

    def was_missing(n: str) -> str:
        return f"coalesce(mask, 0L) & {2 ** flags.index(n) if n in flags else 0}L <> 0"

    with_base = compare_level or compare_date
    if with_base:
        only = [level] * compare_level + [date] * compare_date
        base = _unique(rs.baseline.selectExpr(k, *cells(rs.baseline, "b_", only)).where("_k IS NOT NULL"), ["_k"], ["b_" + n for n in only], *twice["baseline"])
        if compare_date:
            base = base.withColumn("_sref", F.expr(X.strip(name("b_" + date)))).withColumn("_ref", F.expr(D.date_of("_sref"))).drop("_sref")
        if compare_level:
            base = base.withColumn("_lb", F.expr(N.to_num(name("b_" + level))))
        # The baseline holds for every case; cases are few, runs are not.
        base = base.withColumn(CASE, F.explode(per_run.agg(F.collect_set(CASE).alias("c")).scalar()))
        rows = rows.join(base.withColumn("_b", F.lit(True)).hint("shuffle_hash"), by_key, "left")
        known = base.join(mask, by_key, "left") if mask is not None else base.withColumn("mask", F.lit(None).cast("bigint"))
        sizes = known.groupBy(CASE).agg(F.count(F.lit(1)).alias("_n"), *(
            [F.expr(f"count_if({was_missing(level)})").alias("_masked")] if compare_level else []), *(
            [F.expr("count_if(day(_ref) > 12)").alias("_late")] if compare_date else []))
        if compare_level:
            total(sizes, "SEM-02", "excluded", "_masked")
        if compare_date:
            total(sizes, "SEM-04", "compared", "_n")
            total(sizes, "SEM-04", "lost", "_n")
            total(sizes, "SEM-04", "lost_day_gt_12", "_late")

    o, e = (lambda n: name("o_" + n)), (lambda n: name("e_" + n))
    bits: list[str] = []
    values: dict[str, str] = {}
    facts: list[str] = []

    def fact(when: str, kind: str, what: str, v: str | None = None, sign: str = "") -> None:
        """Counts rows for which ``when`` holds, apart by the value ``v`` if there is one."""
        if v is None:
            if when not in bits:
                bits.append(when)
            facts.append(f"CASE WHEN bits & {2 ** bits.index(when)}L <> 0 THEN named_struct('kind', {lit(kind)}, 'name', {lit(what)}, 'v', CAST(NULL AS DOUBLE), 'w', {sign}n) END")
        else:
            column = f"v{len(values)}"
            values[column] = f"CASE WHEN {when} THEN {v} END"
            facts.append(f"CASE WHEN {column} IS NOT NULL THEN named_struct('kind', {lit(kind)}, 'name', {lit(what)}, 'v', {column}, 'w', n) END")

    stripped, extra = [], []
    if "ROW-02" in checks and with_truth:
        fact("_e IS NULL", "ROW-02", "unexpected")
        fact("_e IS NOT NULL", "ROW-02", "missing", sign="-")
    if compare_cells:
        fact("_e IS NOT NULL", "CLN-08", "compared")
        for i, n in enumerate(truth_columns):
            if n in rs.expected.columns:
                same = f"CASE WHEN {o(n)} = {e(n)} THEN _e & {2**i}L <> 0 ELSE {tolerant_equal(o(n), e(n), c[n].dtype, c.numeric_abs)} END"
                fact(f"_e IS NOT NULL AND {o(n)} IS NOT NULL AND NOT {same}", "CLN-08", n)
    if "CLN-06" in checks:
        for i in imputed:
            if i.name not in flags:
                continue
            hit = f"{was_missing(i.name)} AND {o(i.name)} IS NOT NULL"
            if i.impute.method == "median":
                # Cells that are no numbers are counted too, as a value that no target equals.
                fact(hit, "CLN-06", i.name, f"coalesce({N.to_num(o(i.name))}, DOUBLE('NaN'))")
                if with_truth:
                    fact(hit, "CLN-06 target", i.name, N.to_num(e(i.name)))
            else:
                fact(hit, "CLN-06", i.name, f"CASE WHEN {o(i.name)} = {lit(i.impute.value)} THEN 1D ELSE 0D END")
    if compare_level:
        extra.append(f"CASE WHEN {o(level)} = {name('b_' + level)} THEN _lb ELSE {N.to_num(o(level))} END AS _lo")
        fact(f"_b IS NOT NULL AND NOT {was_missing(level)}", "SEM-02", "ratio", N.ratio("_lo", "_lb"))
    if compare_date:
        stripped.append(f"CASE WHEN {o(date)} = {name('b_' + date)} THEN NULL ELSE {X.strip(o(date))} END AS _snew")
        extra.append(f"CASE WHEN {o(date)} = {name('b_' + date)} THEN _ref ELSE {D.date_of('_snew')} END AS _new")
        found = "_b IS NOT NULL AND _new IS NOT NULL"
        same = "coalesce(_new = _ref, false)"
        swapped = "coalesce(month(_new) = day(_ref) AND day(_new) = month(_ref), false)"
        fact(f"_b IS NOT NULL AND {same}", "SEM-04", "unchanged")
        fact(f"{found} AND NOT {same} AND {swapped}", "SEM-04", "transposed")
        fact(f"{found} AND NOT {same} AND NOT {swapped}", "SEM-04", "other")
        fact(found, "SEM-04", "lost", sign="-")
        fact(f"{found} AND coalesce(day(_ref) > 12, false)", "SEM-04", "lost_day_gt_12", sign="-")
    # Without truth, inputs or baseline nothing can be compared: no facts.
    facts = facts or ["CAST(NULL AS STRUCT<kind: STRING, name: STRING, v: DOUBLE, w: BIGINT>)"]
    bit = " + ".join(f"CASE WHEN {when} THEN {2**i}L ELSE 0L END" for i, when in enumerate(bits)) or "0L"
    pattern = rows.selectExpr("*", *stripped).selectExpr("*", *extra).selectExpr(RUN, f"{bit} AS bits", *(f"{v} AS {n}" for n, v in values.items()))
    pattern = pattern.groupBy(RUN, "bits", *values).agg(F.count(F.lit(1)).alias("n"))
    whole: list[DataFrame] = []
    if "ROW-02" in checks and with_truth and n_repeated:
        whole.append(repeated.groupBy(RUN).agg(F.sum(F.col("n_out") - 1).alias("n")).selectExpr(
            RUN, "'ROW-02' AS kind", "'duplicate' AS name", "CAST(NULL AS DOUBLE) AS v", "n"))
    if totals:
        # A few rows per case and run.
        whole.append(per_run.join(reduce(DataFrame.unionByName, totals), CASE).selectExpr(RUN, "kind", "name", "CAST(NULL AS DOUBLE) AS v", "n"))
    return pattern, facts, whole


def facts_of(facts: DataFrame, *kinds: str) -> DataFrame:
    """Facts of one kind. Naming ``n`` keeps the predicate above the aggregation, so all
    kinds read the same shuffled facts instead of each running its own plan below."""
    return facts.where(f"CASE WHEN n > 0 THEN kind END IN {in_list(kinds)}")


def _sum_where(condition: str) -> str:
    return f"coalesce(sum(CASE WHEN {condition} THEN n END), 0L)"


def _counts(labels: Mapping[str, str]) -> list:
    return [F.expr(_sum_where(f"name = {lit(k)}")).alias(v) for k, v in labels.items()]


def accounting_metrics(facts: DataFrame) -> DataFrame:
    """ROW-02: missing and unexpected keys, extra copies of keys, per run."""
    return facts_of(facts, "ROW-02").groupBy(RUN).agg(*_counts({
        "missing": "missing_keys", "unexpected": "unexpected_keys", "duplicate": "duplicate_key_rows"}))


def truth_metrics(facts: DataFrame, contract: Contract) -> DataFrame:
    """CLN-08: ``(run_id, compared, mismatches)``, mismatches per column as an array of structs."""
    items = array(
        f"named_struct('column', {lit(n)}, 'mismatches', {_sum_where(f'name = {lit(n)}')})"
        for n in contract.names if n != contract.key
    )
    return facts_of(facts, "CLN-08").groupBy(RUN).agg(
        *_counts({"compared": "compared"}), F.expr(items).alias("mismatches")
    )


def imputation_metrics(facts: DataFrame, rs: RunSet) -> DataFrame:
    """CLN-06: ``(run_id, column, imputed_rows, target, wrong)``.

    The target of a median column is the one value that the ground truth holds for the
    imputed keys; when it holds several (or none), the known median of the input.
    """
    c = rs.contract
    median = [i.name for i in c.imputed if i.impute.method == "median"]
    fixed = {i.name: i.impute.value for i in c.imputed if i.impute.method == "constant"}
    cell = facts_of(facts, "CLN-06", "CLN-06 target").withColumn("is_target", F.expr("kind = 'CLN-06 target'"))
    # One row per run and column: the ground truth's values for the imputed keys.
    known = "CAST(NULL AS DOUBLE)"
    if rs.medians:
        known = "CASE " + " ".join(f"WHEN name = {lit(n)} THEN {lit(float(m))}" for n, m in rs.medians.items()) + " END"
    targets = cell.where("is_target").groupBy(RUN, "name").agg(
        F.expr("CASE WHEN count(*) = 1 THEN max(v) END").alias("_one")
    )
    values = cell.where("NOT is_target").join(targets, [RUN, "name"], "left").withColumn(
        "_target", F.expr(f"CASE WHEN name IN {in_list(median or [''])} THEN coalesce(_one, {known}) END")
    )
    right = f"CASE WHEN name IN {in_list(fixed or [''])} THEN v = 1 ELSE abs(v - _target) <= {c.imputed_abs}D END"
    constant = f"try_element_at({literal_map(fixed)}, name)" if fixed else "CAST(NULL AS STRING)"
    return values.groupBy(RUN, "name").agg(
        F.sum("n").alias("imputed_rows"), F.expr("max(_target)").alias("_t"),
        F.expr(_sum_where(f"NOT coalesce({right}, false)")).alias("wrong"),
    ).selectExpr(RUN, "name AS column", "imputed_rows", f"coalesce({constant}, CAST(_t AS STRING)) AS target", "wrong")


def ratio_metrics(facts: DataFrame, contract: Contract) -> DataFrame:
    """SEM-02: ``(run_id, compared, changed, changed_share, median_ratio, excluded)``."""
    f = facts_of(facts, "SEM-02")
    moved = f"name = 'ratio' AND abs(v - 1) > {contract.per_key_ratio_tolerance}D"
    counts = f.groupBy(RUN).agg(
        *_counts({"ratio": "compared", "excluded": "excluded"}), F.expr(_sum_where(moved)).alias("changed")
    )
    hist = f.where("v IS NOT NULL").select(RUN, "v", "n")
    mid = quantiles(hist, [RUN], [0.5]).select(RUN, F.col("value").alias("median_ratio"))
    return counts.join(mid, RUN, "left").selectExpr(
        RUN, "compared", "changed", "try_divide(changed, compared) AS changed_share", "median_ratio", "excluded"
    )


def date_metrics(facts: DataFrame) -> DataFrame:
    """SEM-04: per-key date comparison counts."""
    labels = ("compared", "unchanged", "transposed", "other", "lost", "lost_day_gt_12")
    return facts_of(facts, "SEM-04").groupBy(RUN).agg(*_counts({n: n for n in labels}))
