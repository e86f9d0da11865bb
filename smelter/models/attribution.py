"""Why one furnace uses more energy than another: the gap in parts.

With a linear model of the target, the difference of two group means is the sum
over the features of coefficient times difference of the feature's means, plus
what the model does not explain.  The parts add up to the gap exactly.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.operators.sizing import broadcast_if_small

UNEXPLAINED = "unexplained"


def group_means(rows: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """One row per group with the mean of every column (partial aggregation)."""
    return rows.groupBy(group).agg(*[F.avg(c).alias(c) for c in columns])


def gap_contributions(means: DataFrame, pairs: DataFrame, group: str, against: str,
                      coefficients: Mapping[str, float], target: str) -> DataFrame:
    """Rows (group, against, term, contribution, gap) for each of ``pairs``
    (columns ``group`` and ``against``): one row per feature and one for what
    the model leaves unexplained.  ``means`` is stored, one row per group; a
    pair with a group that has no means gives no row."""
    columns = [*coefficients, target]
    small = broadcast_if_small(means)
    left = small.select(group, *[F.col(c).alias(f"_a_{c}") for c in columns])
    right = small.select(F.col(group).alias(against), *[F.col(c).alias(f"_b_{c}") for c in columns])
    both = pairs.select(group, against).join(left, group).join(right, against)
    gap = F.col(f"_a_{target}") - F.col(f"_b_{target}")
    parts = {f: F.lit(float(b)) * (F.col(f"_a_{f}") - F.col(f"_b_{f}")) for f, b in coefficients.items()}
    terms = [F.struct(F.lit(f).alias("term"), c.alias("contribution")) for f, c in parts.items()]
    terms.append(F.struct(F.lit(UNEXPLAINED).alias("term"),
                          (gap - sum(parts.values(), F.lit(0.0))).alias("contribution")))
    return (both.select(group, against, gap.alias("gap"), F.explode(F.array(*terms)).alias("t"))
            .select(group, against, "t.term", "t.contribution", "gap"))
