"""Data-quality expectations with DROP ROW semantics.

A rule is a boolean Column.  A row is kept only if every rule is TRUE; a
rule evaluating to NULL counts as a violation (SQL filter logic) unless
``null_passes=True``.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


_SEQ = itertools.count(1)


def metrics_name(prefix: str) -> str:
    """A unique observation name: Spark requires one definition per name
    in a plan, and one plan may guard several different inputs."""
    return f"{prefix}_{next(_SEQ)}"


def _passes(rule: Column, null_passes: bool) -> Column:
    return F.coalesce(rule, F.lit(bool(null_passes)))


def expect(df: DataFrame, rules: Mapping[str, Column], null_passes: bool = False) -> DataFrame:
    """Keep the rows that satisfy every rule (one filter, pushed by Catalyst)."""
    cond = None
    for r in rules.values():
        p = _passes(r, null_passes)
        cond = p if cond is None else (cond & p)
    return df if cond is None else df.filter(cond)


def expectation_report(df: DataFrame, rules: Mapping[str, Column],
                       null_passes: bool = False, with_kept: bool = True) -> DataFrame:
    """One row per rule: ``rule, violations[, kept]``.

    Computed in a single pass as one global aggregate (partial counts per
    task, one tiny final merge), then unpivoted into rows.
    """
    aggs = []
    names = list(rules)
    for i, n in enumerate(names):
        aggs.append(F.count_if(~_passes(rules[n], null_passes)).alias(f"v{i}"))
    all_pass = None
    for r in rules.values():
        p = _passes(r, null_passes)
        all_pass = p if all_pass is None else (all_pass & p)
    aggs.append(F.count_if(all_pass).alias("kept"))
    wide = df.agg(*aggs)
    stack_args = ", ".join(f"'{n}', v{i}" for i, n in enumerate(names))
    out = wide.selectExpr(f"stack({len(names)}, {stack_args}) AS (rule, violations)", "kept")
    out = out.select("rule", F.col("violations").cast("bigint").alias("violations"),
                     F.col("kept").cast("bigint").alias("kept"))
    return out if with_kept else out.drop("kept")


def guard(df: DataFrame, rules: Mapping[str, Column], name: str,
          null_passes: bool = False) -> DataFrame:
    """Count violations per rule (``DataFrame.observe`` metrics named
    ``name`` plus a unique suffix, as an expectations report) and drop the
    violating rows.

    The observation also fences the plan: Catalyst does not push filters
    through it, so predicates of later layers are evaluated on the columns
    computed below (e.g. a parsed JSON struct) instead of being inlined into
    -- and re-running -- the parse for every predicate.
    """
    return expect(observe_expectations(df, rules, metrics_name(name), null_passes), rules, null_passes)


def observe_expectations(df: DataFrame, rules: Mapping[str, Column], name: str,
                         null_passes: bool = False) -> DataFrame:
    """Attach per-rule violation counters to a (streaming) frame via
    ``DataFrame.observe``; read them from ``query.lastProgress`` /
    ``Observation``.  Rows are not filtered here."""
    return df.observe(name, *expectation_metrics(rules, null_passes))


def expectation_metrics(rules: Mapping[str, Column], null_passes: bool = False) -> list[Column]:
    """``rows``, ``violations_<rule>`` for each rule, and ``kept``."""
    kept = F.lit(True)
    for r in rules.values():
        kept = kept & _passes(r, null_passes)
    return [F.count(F.lit(1)).alias("rows"),
            *[F.count_if(~_passes(r, null_passes)).alias(f"violations_{n}") for n, r in rules.items()],
            F.count_if(kept).alias("kept")]


def observed_guard(df: DataFrame, rules: Mapping[str, Column], name: str,
                   null_passes: bool = False) -> tuple[DataFrame, Observation]:
    """``guard`` for a batch job: the rows kept, and what the pass that reads them counts."""
    seen = Observation(metrics_name(name))
    return expect(df.observe(seen, *expectation_metrics(rules, null_passes)), rules, null_passes), seen
