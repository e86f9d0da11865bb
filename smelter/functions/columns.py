"""Scalar column helpers (all JVM-side expressions, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits beyond the wanted ones that are rounded away first.  Sums of doubles
# differ in their last bits with the order of addition; after this step a mean
# that is mathematically x.xx5 is a tie on every engine and in every run.
GUARD_DIGITS = 7


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, digits: int) -> Column:
    """Round half away from zero; large values keep their size."""
    # "+ 0.0" turns the -0.0 of a tiny negative value into 0.0
    return F.round(F.round(_col(c).cast("double"), digits + GUARD_DIGITS), digits) + 0.0


def round_half_up_sql(expr: str, digits: int) -> str:
    """The same rounding as SQL text (Spark and DuckDB both accept it), in
    decimals, for values under 10^26 at four digits."""
    return f"(CAST(round(CAST({expr} AS DECIMAL(38, {digits + GUARD_DIGITS})), {digits}) AS DOUBLE) + 0.0)"


def safe_ratio(num, den) -> Column:
    """``num / NULLIF(den, 0)``: NULL instead of an ANSI divide-by-zero error."""
    return F.try_divide(_col(num), F.nullif(_col(den), F.lit(0)))


def month_start(c) -> Column:
    """First day of the month as a DATE."""
    return F.trunc(F.to_date(_col(c)), "MM")


def hash_bucket(key, buckets: int = 100) -> Column:
    """Stable bucket 0..buckets-1 from the md5 of a key.

    Unlike ``randomSplit`` the result depends only on the key, not on row
    order or partitioning, so a retried task or another engine gives the
    same split.
    """
    head = F.substring(F.md5(_col(key).cast("string")), 1, 8)
    return (F.conv(head, 16, 10).cast("long") % F.lit(buckets)).cast("int")


def hash_bucket_sql(key_expr: str, buckets: int = 100) -> str:
    return f"CAST(('0x' || substr(md5(CAST({key_expr} AS VARCHAR)), 1, 8))::UBIGINT % {buckets} AS INTEGER)"


def reading_key(furnace_col="furnace_id", ts_col="ts") -> Column:
    """Surrogate key ``<furnace>_<epoch seconds>``."""
    return F.concat_ws("_", _col(furnace_col).cast("string"),
                       F.unix_timestamp(_col(ts_col)).cast("string"))


def nan_to_null(c) -> Column:
    x = _col(c)
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def market_class(c) -> Column:
    """Fixed mapping: 'Exterior' -> 'Externo', anything else -> 'Interno'."""
    return F.when(_col(c) == "Exterior", F.lit("Externo")).otherwise(F.lit("Interno"))


def logistic(x) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(x)))


def with_scalars(df, **scalars: Column):
    """Attach scalar subqueries as columns, each evaluated once.

    A scalar subquery referenced in several expressions is planned once per
    reference, and each copy re-runs its whole subplan.  Projecting it into a
    column first and referring to the column keeps one copy (Catalyst does not
    re-inline a non-cheap expression that is referenced more than once).
    """
    return df.select("*", *[value.alias(name) for name, value in scalars.items()])
