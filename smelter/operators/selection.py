"""Exact quantiles of large groups by repeated narrowing.

``percentile_approx`` gives the values around the wanted rank; a counting pass
then says exactly on which side of them, or on which of them, the rank falls,
and the next round looks only at the values strictly between.  Every round is
an aggregation that combines before the shuffle, so a group of any size, a
third of all rows included, is never sorted or gathered in one task.  The
sketch decides only how fast the range narrows, never the result: if the rank
should lie outside, the range on that side is taken.  Ends of ranges are left
out of them, so repeated values cannot stall it.

Groups with up to ``FEW`` values left are finished by ranking these.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smelter.operators.sizing import broadcast_if_small
from smelter.session import materialize

#: Parts into which a round cuts a range, and the sketch's accuracy.
PARTS, ACCURACY = 100, 10_000
FEW = 2_000
_STATE = ["group", "q", "rank", "lo", "hi", "below", "inside"]


def _narrow(values: DataFrame, state: DataFrame) -> DataFrame:
    """Values strictly inside their group's range, once for each quantile."""
    s = broadcast_if_small(state).alias("s")
    joined = values.alias("v").join(s, F.col("v.group").eqNullSafe(F.col("s.group")))
    inside = F.coalesce(F.col("value") > F.col("lo"), F.lit(True)) & F.coalesce(F.col("value") < F.col("hi"), F.lit(True))
    return joined.where(inside).select("s.*", "value")


def _round(values: DataFrame, state: DataFrame) -> DataFrame:
    """``state`` after one narrowing; ``answer`` is set where it is found."""
    rows = _narrow(values, state)
    grid = F.percentile_approx("value", [i / PARTS for i in range(PARTS + 1)], ACCURACY).alias("grid")
    place = (F.col("rank") - F.col("below")) * PARTS / F.col("inside")
    near = rows.groupBy("group", "q").agg(grid, *(F.first(c).alias(c) for c in _STATE[2:]))
    near = near.select(*_STATE, F.col("grid")[F.greatest(F.ceil(place) - 2, F.lit(0)).cast("int")].alias("a"),
                       F.col("grid")[F.least(F.ceil(place) + 1, F.lit(PARTS)).cast("int")].alias("b"))
    near = materialize(near, "near")
    counted = _narrow(values, near).groupBy("group", "q").agg(
        *(F.first(c).alias(c) for c in [*_STATE[2:], "a", "b"]),
        F.count_if(F.col("value") < F.col("a")).alias("under"), F.count_if(F.col("value") == F.col("a")).alias("at_a"),
        F.count_if((F.col("value") > F.col("a")) & (F.col("value") < F.col("b"))).alias("between"),
        F.count_if((F.col("value") == F.col("b")) & (F.col("b") > F.col("a"))).alias("at_b"),
        F.count_if(F.col("value") > F.col("b")).alias("over"))
    k, a, b = F.col("rank") - F.col("below"), F.col("a"), F.col("b")
    upto_a = F.col("under") + F.col("at_a")
    upto_between = upto_a + F.col("between")
    upto_b = upto_between + F.col("at_b")

    def by(under: Column, at_a: Column, between: Column, at_b: Column, over: Column) -> Column:
        return (F.when(k <= F.col("under"), under).when(k <= upto_a, at_a).when(k <= upto_between, between)
                .when(k <= upto_b, at_b).otherwise(over))

    none, keep = F.lit(None), F.col
    return counted.select(
        "group", "q", "rank", by(keep("lo"), a, a, b, b).alias("lo"), by(a, a, b, b, keep("hi")).alias("hi"),
        (keep("below") + by(F.lit(0), F.lit(0), upto_a, F.lit(0), upto_b)).alias("below"),
        by(keep("under"), F.lit(0), keep("between"), F.lit(0), keep("over")).cast("long").alias("inside"),
        by(none, a, none, b, none).alias("answer"))


def exact_quantiles(df: DataFrame, value: str, group: str | Column, quantiles: Sequence[float] = (0.5,)) -> DataFrame:
    """(group, q, value): the least value of a group with at least the share
    ``q`` of its values at or below it.  Nulls and NaNs are no values; a group
    without values has no row; null is a group of its own."""
    group = F.col(group) if isinstance(group, str) else group
    values = df.select(group.alias("group"), F.col(value).alias("value")).where(F.col("value").isNotNull())
    if dict(values.dtypes)["value"] in ("double", "float"):
        values = values.where(~F.isnan("value"))
    kind = values.schema["value"].dataType
    each = F.explode(F.array(*(F.lit(float(q)) for q in quantiles))).alias("q")
    state = values.groupBy("group").agg(F.count("*").alias("inside")).select("group", each, "inside")
    # in decimals: 0.1 of 70 values are seven
    share = F.col("q").cast("decimal(17,15)") * F.col("inside").cast("decimal(19,0)")
    rank = F.greatest(F.ceil(share).cast("long"), F.lit(1))
    none = F.lit(None).cast(kind)
    state = state.select("group", "q", rank.alias("rank"), none.alias("lo"), none.alias("hi"), F.lit(0).cast("long").alias("below"), "inside")
    state, found = materialize(state, "ranks"), []
    while True:
        few = state.where(F.col("inside") <= FEW)
        order = Window.partitionBy("group", "q").orderBy("value")
        ranked = _narrow(values, few).withColumn("at", F.row_number().over(order) + F.col("below"))
        found.append(materialize(ranked.where(F.col("at") == F.col("rank")).select("group", "q", "value"), "quantiles"))
        state = state.where(F.col("inside") > FEW)
        if state.isEmpty():
            break
        after = materialize(_round(values, state), "ranges")
        found.append(after.where("answer is not null").select("group", "q", F.col("answer").alias("value")))
        state = after.where("answer is null").drop("answer")
        # the next rounds read only what is left of the groups
        values = materialize(_left(values, state), "values")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def _left(values: DataFrame, state: DataFrame) -> DataFrame:
    """Values that some quantile of their group still has in its range."""
    ranges = state.groupBy("group").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))  # one per quantile
    joined = values.alias("v").join(broadcast_if_small(materialize(ranges, "left")).alias("s"), F.col("v.group").eqNullSafe(F.col("s.group")))
    inside = F.exists("ranges", lambda r: F.coalesce(F.col("value") > r["lo"], F.lit(True)) & F.coalesce(F.col("value") < r["hi"], F.lit(True)))
    return joined.where(inside).select("v.group", "value")
