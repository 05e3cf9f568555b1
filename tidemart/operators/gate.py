"""Running checks, keeping what fails, stopping on errors."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tidemart.operators.checks import ERROR, HAS_PARENT, N_RECORDS, Check

OK, DEGRADED, FAILED = "ok", "degraded", "failed"
_RULE, _SET = "__rule", "__set"


class CheckFailed(RuntimeError):
    """At least one check of severity ``error`` found violations."""

    def __init__(self, results: list[Row]):
        self.results = results
        names = ", ".join(r["check"] for r in results if r["status"] == FAILED)
        super().__init__(f"checks failed: {names}")


def _status(severity: Column, n: Column) -> Column:
    return F.when(n == 0, OK).when(severity == ERROR, FAILED).otherwise(DEGRADED)


def _listed(checks: Sequence[Check], counts: Sequence[str]) -> Column:
    """One row per check from one row of counts."""
    return F.inline(
        F.array(
            *(
                F.struct(
                    F.lit(c.name).alias("check"),
                    F.lit(c.severity).alias("severity"),
                    F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias("n_violations"),
                )
                for c, n in zip(checks, counts, strict=True)
            )
        )
    )


def _of_rows(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All rules over single rows, in one scan."""
    names = [f"c{i}" for i in range(len(checks))]
    counts = df.agg(*(F.count_if(c.breaks).alias(n) for c, n in zip(checks, names, strict=True)))
    return counts.select(_listed(checks, names))


def _of_groups(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All rules over equal values, in one scan.

    Grouping sets count the rows of each rule's values, map-side first. The values of
    parents join them as groups of no rows; so one more aggregate over what is already
    counted tells for all rules at once which values have a parent.
    """
    columns = list(dict.fromkeys(c for check in checks for c in check.keys))
    # Rules over the same columns share a grouping set.
    sets = list(dict.fromkeys(frozenset(check.keys) for check in checks))
    # As in grouping_id(): a bit for each column that a set leaves out.
    ids = [sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in s) for s in sets]
    rules = F.create_map(
        *(
            F.lit(x)
            for s, number in zip(sets, ids, strict=True)
            for x in (number, [i for i, c in enumerate(checks) if frozenset(c.keys) == s])
        )
    )
    some = df.select(*columns)
    counted = some.groupingSets([[F.col(c) for c in columns if c in s] for s in sets], *columns).agg(
        F.grouping_id().cast("bigint").alias(_SET), F.count(F.lit(1)).alias(N_RECORDS)
    )
    groups = counted.select(
        *columns, F.explode(rules[F.col(_SET).cast("int")]).alias(_RULE), N_RECORDS, F.lit(False).alias(HAS_PARENT)
    )
    parents = [
        c.parent.filter(F.col(c.keys[0]).isNotNull()).select(
            *c.keys, F.lit(i).alias(_RULE), F.lit(0).cast("bigint").alias(N_RECORDS), F.lit(True).alias(HAS_PARENT)
        )
        for i, c in enumerate(checks)
        if c.parent is not None
    ]
    if parents:
        groups = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parents, groups)
        groups = groups.groupBy(_RULE, *columns).agg(
            F.sum(N_RECORDS).alias(N_RECORDS), F.max(HAS_PARENT).alias(HAS_PARENT)
        )
    names, counts = [f"c{i}" for i in range(len(checks))], []
    for i, (c, name) in enumerate(zip(checks, names, strict=True)):
        broken = (F.col(_RULE) == i) & (F.col(N_RECORDS) > 0) & c.breaks
        n = F.sum(F.when(broken, F.col(c.weight))) if c.weight else F.count_if(broken)
        counts.append(n.alias(name))
    return groups.agg(*counts).select(_listed(checks, names))


def _alone(df: DataFrame, check: Check) -> DataFrame:
    total = F.sum(check.weight) if check.weight else F.count(F.lit(1))
    found = check.violations(df).agg(total.alias("n"))
    return found.select(_listed([check], ["n"]))


def check_results(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``(check, severity, n_violations, status)``, one row per check.

    All rules over rows share one scan of ``df``, all rules over equal values another;
    only rules that are queries of their own add theirs.
    """
    if not checks:
        raise ValueError("no checks given")
    of_rows = [c for c in checks if c.find is None and not c.keys]
    of_groups = [c for c in checks if c.find is None and c.keys]
    parts = [_of_rows(df, of_rows)] if of_rows else []
    parts += [_of_groups(df, of_groups)] if of_groups else []
    parts += [_alone(df, c) for c in checks if c.find is not None]
    results = reduce(DataFrame.unionByName, parts)
    return results.withColumn("status", _status(F.col("severity"), F.col("n_violations")))


def overall_status(statuses: Iterable[str]) -> str:
    found = set(statuses)
    return FAILED if FAILED in found else DEGRADED if DEGRADED in found else OK


def with_own_names(checks: Sequence[Check]) -> list[Check]:
    """The checks; those of one name are told apart by a number from the second on."""
    seen: Counter[str] = Counter()
    out = []
    for c in checks:
        seen[c.name] += 1
        out.append(c if seen[c.name] == 1 else replace(c, name=f"{c.name}#{seen[c.name]}"))
    return out


def enforce(
    df: DataFrame,
    checks: Sequence[Check],
    store: Callable[[str, DataFrame], None] | None = None,
) -> list[Row]:
    """Runs the checks and raises `CheckFailed` if one of severity ``error`` fails.

    ``store(name, violations)`` keeps the failing rows of every check that found
    any, whatever its severity, before the error is raised. Counting comes
    first, so a clean table costs two scans for all its rules.
    """
    checks = with_own_names(checks)
    results = check_results(df, checks).collect()  # one row per check
    found = {r["check"] for r in results if r["n_violations"] > 0}
    if store is not None:
        for c in checks:
            if c.name in found:
                store(c.name, c.violations(df))
    if overall_status(r["status"] for r in results) == FAILED:
        raise CheckFailed(results)
    return results
