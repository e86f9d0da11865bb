"""Distributed descriptive statistics (one aggregation pass each, long form).

Nothing is sampled to the driver: every statistic is a Spark aggregate over
the full table, unpivoted with ``stack`` so the result has one row per
column (or column pair).
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.functions.columns import hash_bucket, round_half_up, with_scalars


def _stack(wide: DataFrame, rows: list[tuple[list[str], list[str]]], names: list[str]) -> DataFrame:
    """Unpivot ``wide`` (one row) into ``len(rows)`` rows.  Each row is
    (literal labels, column references)."""
    parts = []
    for labels, cols in rows:
        parts += [f"'{x}'" for x in labels] + [f"`{c}`" for c in cols]
    return wide.selectExpr(f"stack({len(rows)}, {', '.join(parts)}) AS ({', '.join(names)})")


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or df.columns
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in columns]
    wide = df.agg(*aggs)
    long = _stack(wide, [([c], ["_rows", f"n_{c}"]) for c in columns], ["column_name", "rows", "nulls"])
    return long.withColumn("null_pct", round_half_up(F.try_divide("nulls", "rows") * 100, 4))


def describe_long(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """count, mean, sample stddev, min, max per column (numeric, long form)."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    long = _stack(wide, [([c], [f"{c}__{s}" for s in ("n", "mean", "std", "min", "max")]) for c in columns],
                  ["column_name", "count", "mean", "stddev", "min", "max"])
    return long.select("column_name", "count",
                       *[round_half_up(k, digits).alias(k) for k in ("mean", "stddev", "min", "max")])


def correlation_long(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every column pair, all pairs in one aggregation."""
    pairs = list(combinations(columns, 2))
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}")
                    for a, b in pairs])
    long = _stack(wide, [([a, b], [f"{a}__{b}"]) for a, b in pairs], ["column_a", "column_b", "corr"])
    return long.withColumn("corr", round_half_up("corr", digits))


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram between the column's min and max (scalar
    subqueries); the maximum falls in the last bin."""
    bounds = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    lo, hi = F.col("_b.lo"), F.col("_b.hi")
    width = (hi - lo) / bins
    # a constant column has no width: everything is in the first bin
    b = F.least(F.coalesce(F.floor(F.try_divide(F.col(column) - lo, width)), F.lit(0)) + 1, F.lit(bins))
    counts = (with_scalars(df.filter(F.col(column).isNotNull()), _b=bounds)
              .groupBy(b.cast("int").alias("bin"), F.col("_b")).agg(F.count(F.lit(1)).alias("n")))
    return counts.select("bin", round_half_up(lo + (F.col("bin") - 1) * width, 4).alias("bin_start"),
                         round_half_up(lo + F.col("bin") * width, 4).alias("bin_end"), "n")


def trend_line(df: DataFrame, y: str, x: str, digits: int = 6) -> DataFrame:
    """Least-squares line y = slope * x + intercept and its R^2."""
    return df.agg(
        F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)).alias("n"),
        round_half_up(F.regr_slope(y, x), digits).alias("slope"),
        round_half_up(F.regr_intercept(y, x), digits).alias("intercept"),
        round_half_up(F.regr_r2(y, x), digits).alias("r2"))


def hash_sample(df: DataFrame, key, percent: int) -> DataFrame:
    """Deterministic sample: rows whose key hashes below ``percent`` of 100
    buckets.  Stable under retries and repartitioning."""
    return df.filter(hash_bucket(key) < percent)
