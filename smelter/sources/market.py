"""Market series: landed API envelopes -> rows, date-range selection.

The HTTP call itself is outside the job; the job starts at landed JSON
bodies (one document per response), decoded with ``from_json`` and
flattened with ``inline``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def envelope_schema(value_col: str) -> T.StructType:
    item = T.StructType([T.StructField("date", T.StringType()),
                         T.StructField(value_col, T.DoubleType())])
    return T.StructType([
        T.StructField("source", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("pair", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("data", T.ArrayType(item)),
    ])


def landed_bodies(series: DataFrame, value_col: str, source: str, unit: str | None = None,
                  pair: str | None = None) -> DataFrame:
    """Render a daily series as API response bodies, one per calendar month
    (the range a client asks for), so no document grows with the history."""
    items = series.select(F.trunc("date", "MM").alias("_month"),
                          F.struct(F.date_format("date", "yyyy-MM-dd").alias("date"),
                                   F.col(value_col)).alias("_item"))
    grouped = items.groupBy("_month").agg(F.sort_array(F.collect_list("_item")).alias("data"))
    env = F.struct(F.lit(source).alias("source"),
                   *([F.lit(unit).alias("unit")] if unit else []),
                   *([F.lit(pair).alias("pair")] if pair else []),
                   F.size("data").cast("long").alias("count"), F.col("data"))
    return grouped.select(F.date_format("_month", "yyyy-MM").alias("request"),
                          F.to_json(env).alias("body"))


def parse_bodies(bodies: DataFrame, value_col: str) -> DataFrame:
    """JSON envelope -> (date DATE, value DOUBLE) rows; envelopes whose
    ``count`` disagrees with their data length are flagged."""
    env = bodies.select(F.from_json("body", envelope_schema(value_col)).alias("e"))
    checked = env.select(
        F.when(F.col("e.count") == F.size("e.data"), F.col("e.data"))
        .otherwise(F.raise_error(F.lit("envelope count does not match its data"))).alias("data"))
    return checked.select(F.inline("data")).select(
        F.to_date("date").alias("date"), F.col(value_col).cast("double").alias(value_col))


def select_range(series: DataFrame, start: str | None = None, end: str | None = None,
                 date_col: str = "date") -> DataFrame:
    """Both bounds inclusive, each optional; compared as dates (pushed to the scan)."""
    if start:
        series = series.filter(F.col(date_col) >= F.lit(start).cast("date"))
    if end:
        series = series.filter(F.col(date_col) <= F.lit(end).cast("date"))
    return series
