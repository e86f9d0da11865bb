"""States are built from one pass over a fact's joins, which bring no growing table to the driver."""

import datetime as dt

from pyspark.sql import functions as F

from smelter.operators import sizing
from smelter.plans import semantic


class _Tables:
    def __init__(self, spark, fact):
        self.spark, self.fact = spark, fact

    def role(self, name):
        return self.fact


def test_fact_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    days = [dt.date(2024, 1, 1 + i % 20) for i in range(60)]
    rows = [(d, i % 3, "ab"[i % 2], float(i), 2.0 * i, i % 2) for i, d in enumerate(days)] + [(days[0], None, None, None, None, None)]
    schema = "date date, plant_id int, alloy_id string, tons_produced double, energy_kwh double, defects int"
    t = _Tables(spark, spark.createDataFrame(rows, schema).mapInArrow(counted, schema))
    states = semantic.states_of(t, "production")
    assert seen.value == len(rows)
    found = states.read(states.grains[0]).agg(F.sum("rows"), F.sum("tons_produced_sum"), F.countDistinct("period")).first()
    assert tuple(found) == (61, float(sum(range(60))), 20)


def test_growing_side_is_not_broadcast_by_the_planner(spark):
    big, small = spark.range(400_000).withColumnRenamed("id", "k"), spark.range(1000).withColumnRenamed("id", "k")
    plan = lambda side: spark.range(4_000_000).join(side, F.col("id") == F.col("k"))._jdf.queryExecution().sparkPlan().toString()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan(big)
    with sizing.bounded_broadcasts(spark):
        assert "BroadcastHashJoin" not in plan(big) and "BroadcastHashJoin" in plan(small)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == old and "BroadcastHashJoin" in plan(big)
