"""Event-time dedup of a stream with bounded state.

The best row of every key (the first by ``order``, as in the batch dedup) is
kept in Spark's state store until the watermark has passed its event time.
(``dropDuplicatesWithinWatermark`` would keep whichever row came first.)  The
result is two tables:

* ``open``: keys whose event time is within ``delay`` of the latest one.  It
  holds as many rows as the state store and is written anew with every batch.
* ``closed``: all older keys, by day and micro-batch; only ever appended to.

Rows that come later than that are not lost: before the stateful step they are
marked and given an event time that the watermark lets pass, and every one of
them is merged into ``closed``.  A new key is appended; one that loses against
the row there is dropped; one that wins is appended and the files that hold the
beaten row are written again, which is the only time that history is touched.
After each run the operator's own counters are kept, and a row dropped by the
watermark is an error.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.operators.cleaning import keep_first
from smelter.session import materialize
from smelter.streaming.ingest import _exists, _fs, _in_days, _read_text, _write_text, run_batches

PARTS = ["day", "batch_id"]
PROGRESS = "batch_id long, watermark string, state_rows long, state_bytes long, dropped long, input_rows long"


class EventTimeDedup:
    """The tables below ``root`` of one deduplicated stream."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], event: str, order: Sequence[str], delay: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.keys, self.event, self.order, self.delay = list(keys), event, list(order), delay
        self.closed = f"{self.root}/closed"

    # ---- state beside the tables ---------------------------------------------------

    def frontier(self) -> dict:
        """The last finished batch, the event time from which keys are open
        (microseconds; rows before it are late) and the folder of open keys."""
        text = _read_text(self.spark, f"{self.root}/_frontier.json")
        return json.loads(text) if text else {"batch": -1, "from": 1, "open": None}

    def read(self) -> DataFrame:
        """One row per key seen so far."""
        parts = [self.spark.read.option("mergeSchema", True).parquet(self.closed).drop(*PARTS)] if _exists(self.spark, self.closed) else []
        if self.frontier()["open"]:
            parts.append(self.spark.read.parquet(self.frontier()["open"]))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)

    def progress(self) -> DataFrame:
        """State rows and bytes, and rows dropped, of every micro-batch."""
        return self.spark.read.schema(PROGRESS).parquet(f"{self.root}/progress")

    # ---- the stream ------------------------------------------------------------------

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        """All that has arrived, as one micro-batch."""
        start = F.timestamp_micros(F.lit(self.frontier()["from"]))
        late = F.coalesce(F.col(self.event) < start, F.lit(True))
        marked = stream.withColumns({"_late": late, "_event": F.greatest(F.coalesce(F.col(self.event), start), start)})
        rest = [c for c in stream.columns if c not in self.keys]
        best = F.min_by(F.struct(*rest), F.struct(*self.order)).alias("_row")
        state = marked.withWatermark("_event", self.delay).groupBy("_event", "_late", *self.keys).agg(best)
        rows = state.select("_late", *(F.col(c) if c in self.keys else F.col(f"_row.{c}").alias(c) for c in stream.columns))
        query = run_batches(rows, self._merge, checkpoint, f"dedup:{self.root}", mode="update")
        reports = [(p["batchId"], p["eventTime"].get("watermark"), s["numRowsTotal"], s["memoryUsedBytes"],
                    s["numRowsDroppedByWatermark"], p["numInputRows"]) for p in query.recentProgress for s in p["stateOperators"]]
        if reports:
            self.spark.createDataFrame(reports, PROGRESS).coalesce(1).write.mode("append").parquet(f"{self.root}/progress")
        if any(r[4] for r in reports):
            raise RuntimeError(f"the watermark dropped rows: {reports}")

    def _merge(self, batch: DataFrame, epoch_id: int) -> None:
        before = self.frontier()
        if before["batch"] >= epoch_id:  # a retried batch that had been finished
            return
        rows = materialize(batch, "updates")
        fresh = rows.where(~F.col("_late")).drop("_late")
        if before["open"]:
            fresh = self.spark.read.parquet(before["open"]).unionByName(fresh, allowMissingColumns=True)
        # stored: the latest event time and both halves are read from it
        fresh = materialize(keep_first(fresh, self.keys, self.order), "fresh")
        until = fresh.agg(F.unix_micros(F.max(self.event) - F.expr(f"INTERVAL {self.delay}"))).first()[0]
        # the watermark itself counts as late for Spark
        start = max(before["from"], (until or 0) + 1)
        closing = F.col(self.event) < F.timestamp_micros(F.lit(start))
        keep = f"{self.root}/open/batch_id={epoch_id}"
        fresh.where(~closing).write.mode("overwrite").parquet(keep)
        done = fresh.where(closing).withColumn("day", F.to_date(self.event))
        late = rows.where("_late").drop("_late")
        if not late.isEmpty():
            done = done.unionByName(self._late(keep_first(late, self.keys, self.order).withColumn("day", F.to_date(self.event)), epoch_id))
        self._write(done.withColumn("batch_id", F.lit(epoch_id).cast("long")))
        _write_text(self.spark, f"{self.root}/_frontier.json", json.dumps({"batch": epoch_id, "from": start, "open": keep}))

    def _write(self, rows: DataFrame) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS).parquet(self.closed)

    def _late(self, late: DataFrame, epoch_id: int) -> DataFrame:
        """The late rows that are first of their key; rows they beat leave."""
        if not _exists(self.spark, self.closed):
            return late
        late = materialize(late, "late")
        days = [r.day for r in late.select("day").distinct().collect()]
        # what an unfinished try of this batch may have written does not count
        there = _in_days(self.spark.read.option("mergeSchema", True).parquet(self.closed), days).where(F.col("batch_id") != epoch_id)
        same = [F.col(f"l.{k}").eqNullSafe(F.col(f"t.{k}")) for k in [*self.keys, "day"]]
        met = late.alias("l").join(there.alias("t"), same)
        first = F.struct(*(F.col(f"l.{c}") for c in self.order)) < F.struct(*(F.col(f"t.{c}") for c in self.order))
        met = materialize(met.select(*(F.col(f"l.{k}").alias(k) for k in self.keys), *(F.col(f"t.{c}").alias(c) for c in PARTS), first.alias("wins")), "met")
        beaten = met.where("wins")
        if not beaten.isEmpty():
            touched = beaten.select(*PARTS).distinct()
            named = [F.col(f"t.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*PARTS, *self.keys]]
            whole = there.alias("t").join(F.broadcast(touched).alias("p"), [F.col(f"t.{c}").eqNullSafe(F.col(f"p.{c}")) for c in PARTS], "left_semi")
            left = materialize(whole.alias("t").join(beaten.alias("b"), named, "left_anti"), "left")
            self._write(left)
            emptied = touched.alias("p").join(left.alias("t"), [F.col(f"t.{c}").eqNullSafe(F.col(f"p.{c}")) for c in PARTS], "left_anti")
            for r in emptied.collect():  # partitions, few
                day = "__HIVE_DEFAULT_PARTITION__" if r.day is None else r.day
                fs, p = _fs(self.spark, f"{self.closed}/day={day}/batch_id={r.batch_id}")
                fs.delete(p, True)
        losing = met.where("not wins").select(*self.keys)
        return late.alias("l").join(losing.alias("m"), [F.col(f"l.{k}").eqNullSafe(F.col(f"m.{k}")) for k in self.keys], "left_anti")
