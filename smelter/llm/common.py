"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.session import ensure_checkpoint_dir, scratch_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A word is a run of characters other than these six.
WORD_BREAK = r"[\x20\x09-\x0D]+"


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else (``lower`` would fold other letters)."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Array of words; empty for null, empty or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), lambda w: w != "")


def text_bytes(docs: DataFrame, text: str) -> Column:
    return F.coalesce(docs[text].cast("string"), F.lit("")).cast("binary")


def row_key(docs: DataFrame, id: str, text: str) -> Column:
    """A 64-bit key of id and text: rows with one key are the same document."""
    return F.xxhash64(docs[id], docs[id].isNull(), text_bytes(docs, text))


def keyed_texts(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, key, text) with the text as bytes, null as empty."""
    return docs.select(docs[id].alias("id"), row_key(docs, id, text).alias("key"), text_bytes(docs, text).alias("text"))


#: Rows of a few numbers that may be broadcast: some 32 MB on every executor.
BROADCAST_ROWS = 1_000_000


def small_or_not(narrow: DataFrame) -> DataFrame:
    """A stored table of a few numeric columns, marked for broadcast if its
    counted rows are within ``BROADCAST_ROWS``; beyond that Spark shuffles."""
    return F.broadcast(narrow) if narrow.count() <= BROADCAST_ROWS else narrow


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there,
    so a lost executor costs a re-read."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def one_text_each(rows: DataFrame, *keys: str) -> DataFrame:
    """One row for each value of ``keys``: the text with the least hash."""
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    return rows.groupBy(*keys).agg(least).select(*keys, "least.text")


def unused(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores in front until no frame has such a column."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
