"""Declared datasets with quality rules (expectations).

A rule is a SQL predicate plus an action:

* ``warn``  – count violations, keep the row;
* ``drop``  – count violations, remove the row;
* ``fail``  – abort the update when any row violates.

A predicate that evaluates to NULL counts as violated.  Rules run on the
dataset's output.  The fail action is a ``raise_error`` inside the plan, so
it works the same for batch and streaming frames and never needs a separate
action on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.functions.columns import round_half_up
from smelter.operators import cleaning


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    action: str = "warn"  # warn | drop | fail

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def enforce(df: DataFrame, rules: list[Expectation]) -> DataFrame:
    """Apply drop and fail rules to ``df``; warn rules leave it unchanged."""
    for rule in rules:
        if rule.action == "fail":
            message = f"expectation '{rule.name}' violated: {rule.predicate}"
            df = df.filter(F.when(~rule.passes(), F.raise_error(F.lit(message)))
                           .otherwise(F.lit(True)))
    for rule in rules:
        if rule.action == "drop":
            df = df.filter(rule.passes())
    return df


def rule_report(df: DataFrame, rules: list[Expectation]) -> DataFrame:
    """One row per rule: rows checked, passed, violated, violated percent.

    All rules are counted in a single aggregation pass over ``df`` (the
    dataset before drop rules), then unpivoted with ``stack``.
    """
    counts = [F.count(F.lit(1)).alias("rows_checked")]
    for i, rule in enumerate(rules):
        counts.append(F.count_if(~rule.passes()).alias(f"v{i}"))
    wide = df.agg(*counts)
    stack_args = ", ".join(
        f"'{rule.name}', '{rule.action}', '{rule.predicate.replace(chr(39), chr(39) * 2)}', v{i}"
        for i, rule in enumerate(rules))
    long = wide.selectExpr(
        "rows_checked",
        f"stack({len(rules)}, {stack_args}) AS (rule, action, predicate, violated)")
    return long.select(
        "rule", "action", "predicate", "rows_checked",
        (F.col("rows_checked") - F.col("violated")).alias("passed"),
        F.col("violated"),
        round_half_up(F.try_divide(F.col("violated") * 100.0, F.col("rows_checked")), 4)
        .alias("violated_pct"),
    )


def observe_rules(df: DataFrame, name: str, rules: list[Expectation]) -> DataFrame:
    """Attach rule counters as observed metrics (reported per micro-batch in
    ``StreamingQuery.lastProgress['observedMetrics']`` or after a batch
    action through ``Observation``)."""
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(~rule.passes()).alias(rule.name) for rule in rules]
    return df.observe(name, *metrics)


# Rules of the declared telemetry silver dataset.
SILVER_RULES = [
    Expectation("plausible_temperature", "temperature_c BETWEEN 800 AND 1100", "drop"),
    Expectation("furnace_identified", "furnace_id IS NOT NULL", "fail"),
    Expectation("vibration_present", "vibration_mm_s IS NOT NULL", "warn"),
]


def declared_silver_unchecked(bronze: DataFrame, order: tuple[str, ...] = ("reading_seq",)) -> DataFrame:
    """Typed (7 columns, no imputation) and deduplicated; rules not yet applied."""
    df = cleaning.typed(bronze, cleaning.PIPELINE_TYPES)
    return cleaning.keep_first(df, ["furnace_id", "ts"], list(order))


def declared_silver(bronze: DataFrame, rules: list[Expectation] = SILVER_RULES,
                    order: tuple[str, ...] = ("reading_seq",)) -> DataFrame:
    return enforce(declared_silver_unchecked(bronze, order), rules)
