"""Key checks and join helpers: orphans, join counts, key uniqueness,
point-in-time (time-bounded) feature joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smelter.operators.sizing import broadcast_if_small
from smelter.session import materialize


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Keys of ``fact`` with no row in ``dim`` (left anti join), with row counts."""
    return (fact.join(broadcast_if_small(dim.select(key).distinct()), key, "left_anti")
            .groupBy(key).agg(F.count(F.lit(1)).alias("rows")))


def join_counts(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Inner and left join row counts in one pass.

    A left join emits one row for an unmatched fact row and one row per match
    otherwise; counting matched rows of the left join gives the inner count.
    """
    d = dim.select(F.col(key), F.lit(True).alias("_matched"))
    joined = fact.select(key).join(broadcast_if_small(d), key, "left")
    return joined.agg(
        F.count_if(F.col("_matched").isNotNull()).alias("inner_rows"),
        F.count(F.lit(1)).alias("left_rows"),
    ).withColumn("orphan_rows", F.col("left_rows") - F.col("inner_rows"))


def key_profile(df: DataFrame, key: str, table: str) -> DataFrame:
    """Rows, distinct keys and duplicated keys of a dimension (fan-out check)."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.lit(key).alias("key_column"),
        F.sum("n").cast("long").alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("duplicated_keys"),
        F.count_if(F.col(key).isNull()).alias("null_keys"),
    ).withColumn("is_unique", (F.col("duplicated_keys") == 0) & (F.col("null_keys") == 0))


def point_in_time_means(events: DataFrame, readings: DataFrame, key: str, event_ts: str,
                        reading_ts: str, lookback_hours: int, values: list[str],
                        event_id: str) -> DataFrame:
    """Mean of reading ``values`` in ``(t0 - lookback, t0]`` before each event.

    Range join on time within a key, expressed as an equi-join on (key,
    hour bucket): every reading is keyed by its hour, every event is expanded
    to the ``lookback_hours + 1`` hour buckets its window touches, and the
    exact bounds are applied after the equi-join.  Work is proportional to
    events x window length, never to key x key pairs.
    """
    ev = events.select(
        F.col(event_id), F.col(key), F.col(event_ts).cast("timestamp").alias("_t0"))
    ev = ev.withColumn(
        "_bucket",
        F.explode(F.sequence(F.date_trunc("hour", F.col("_t0") - F.expr(f"INTERVAL {lookback_hours} HOURS")),
                             F.date_trunc("hour", F.col("_t0")),
                             F.expr("INTERVAL 1 HOUR"))))
    rd = readings.select(F.col(key), F.col(reading_ts).cast("timestamp").alias("_ts"),
                         F.date_trunc("hour", F.col(reading_ts).cast("timestamp")).alias("_bucket"),
                         *[F.col(v) for v in values])
    joined = ev.join(rd, [key, "_bucket"], "inner").filter(
        (F.col("_ts") > F.col("_t0") - F.expr(f"INTERVAL {lookback_hours} HOURS"))
        & (F.col("_ts") <= F.col("_t0")))
    return joined.groupBy(event_id).agg(
        F.count(F.lit(1)).alias("window_readings"),
        *[F.avg(v).alias(f"recent_{v}") for v in values])


def sliding_means(events: DataFrame, readings: DataFrame, key: str, event_ts: str, reading_ts: str,
                  lookback: str, values: list[str], event_id: str, slice: str = "day") -> DataFrame:
    """Mean of reading ``values`` in ``(t0 - lookback, t0]`` before each event,
    at a cost that does not depend on the window's length.

    The sum over a window is the running sum at its end less that at its start,
    so each event makes two as-of look-ups.  Running sums are taken within
    (key, time slice) and the totals of a key's earlier slices are carried
    over, so a hot key is spread over its slices.  Readings of one key and
    time are one row before that, as are equal look-ups, so that repeated ones
    do not gather either.

    Events without a reading in their window, and those without key or time,
    have no row; nulls take no part in a mean.
    """
    parts = [f"{v}_{what}" for v in values for what in ("sum", "n")]
    sums = [F.sum(F.col(v).cast("double")).alias(f"{v}_sum") for v in values]
    counts = [F.count(v).alias(f"{v}_n") for v in values]
    at = F.col(reading_ts).cast("timestamp").alias("at")
    steps = (readings.select(F.col(key).alias("key"), at, *values).where("key is not null and at is not null")
             .groupBy("key", "at").agg(F.count(F.lit(1)).alias("rows"), *sums, *counts))
    ends = events.select(F.col(event_id).alias("event"), F.col(key).alias("key"), F.col(event_ts).cast("timestamp").alias("until"))
    ends = ends.where("key is not null and until is not null").distinct().withColumn("since", F.col("until") - F.expr(f"INTERVAL {lookback}"))
    looked = ends.select("key", F.col("until").alias("at")).union(ends.select("key", "since")).distinct()

    def summed(columns):
        return {c: F.coalesce(F.col(c), F.lit(0)) for c in columns}

    # a look-up stands behind the reading of its own time
    every = steps.withColumn("look", F.lit(False)).unionByName(looked.withColumn("look", F.lit(True)), allowMissingColumns=True)
    every = every.withColumns({"slice": F.date_trunc(slice, "at"), **summed(["rows", *parts])})
    within = Window.partitionBy("key", "slice").orderBy("at", "look").rowsBetween(Window.unboundedPreceding, 0)
    running = every.withColumns({c: F.sum(c).over(within) for c in ["rows", *parts]})
    # the last row of a slice has its total: one more look-up a slice
    running = materialize(running.withColumn("last", F.lead("at").over(Window.partitionBy("key", "slice").orderBy("at", "look")).isNull())
                          .where("look or last"), "running")
    before = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = running.where("last").select("key", "slice", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}") for c in ["rows", *parts]))
    totals = running.where("look").join(broadcast_if_small(materialize(carried, "carried")), ["key", "slice"])
    totals = materialize(totals.select("key", "at", *((F.col(c) + F.col(f"_{c}")).alias(c) for c in ["rows", *parts])), "totals")

    def side(time, mark):
        return totals.select("key", F.col("at").alias(time), *(F.col(c).alias(f"{mark}{c}") for c in ["rows", *parts]))

    both = ends.join(side("until", "b_"), ["key", "until"]).join(side("since", "a_"), ["key", "since"])
    less = {c: F.col(f"b_{c}") - F.col(f"a_{c}") for c in ["rows", *parts]}
    means = [F.when(less[f"{v}_n"] > 0, less[f"{v}_sum"] / less[f"{v}_n"]).alias(f"recent_{v}") for v in values]
    return both.where(less["rows"] > 0).select(F.col("event").alias(event_id), less["rows"].alias("window_readings"), *means)
