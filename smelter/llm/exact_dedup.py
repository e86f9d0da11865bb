"""Exact deduplication by 128-bit content hash, bytes compared within groups.

The grouping key is (hash, text): rows meet by their 128-bit hash and are put
together only if their bytes are equal, which the hash aggregate compares.
Map-side aggregation leaves one row per distinct text and task before the
shuffle, so a group of copies of any size never meets in one task.  The
documents then look their group up by hash alone; only hashes that hold more
than one text (a collision) are looked up by hash and text.

Defined results: a null text counts as empty; a null id sorts below all ids;
of rows that repeat the same id and text one is kept; other columns, also
ones named like the results, do not take part and are returned untouched by
``drop_copies``.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.common import ascii_lower, stored, unused


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _normalised(docs: DataFrame, text: str, normalise) -> Column:
    return normalise(F.coalesce(docs[text].cast("string"), F.lit("")))


def copy_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: str = "max",
                normalise=ascii_lower, hash=content_hash) -> DataFrame:
    """One row per distinct normalised text: (h, text_sha256, keep_id, group_size).

    The bytes are part of the grouping key, so two texts under one hash stay
    two groups; the text itself goes no further than this aggregate."""
    best = {"max": F.max, "min": F.min}[keep]
    rows = docs.select(docs[id].alias("id"), _normalised(docs, text, normalise).alias("norm"))
    return (rows.select("id", "norm", hash(F.col("norm")).alias("h"))
            .groupBy("h", "norm").agg(best("id").alias("keep_id"), F.count("*").alias("group_size"))
            .select("h", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
                    "keep_id", "group_size"))


def decisions(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: str = "max",
              normalise=ascii_lower, hash=content_hash) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256, text_md5.

    Texts that collide under ``hash`` are told apart here by their SHA-256,
    which the grouping by bytes has attached to each of them."""
    groups = copy_groups(docs, id, text, keep, normalise, hash)
    norm = _normalised(docs, text, normalise)
    # numbered once and stored, so that a row has the same number in both uses
    rows = stored(docs.select(docs[id].alias("id"), norm.alias("norm"))
                  .select("id", hash(F.col("norm")).alias("h"),
                          F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
                          F.monotonically_increasing_id().alias("number")), "exact-rows")
    # of rows that repeat the kept id, the first stays: a minimum, combined
    # before the shuffle, however many rows repeat
    first = (rows.groupBy("h", "text_sha256", "id").agg(F.min("number").alias("first"))
             .select(F.col("h").alias("fh"), F.col("text_sha256").alias("fs"), F.col("id").alias("fid"), "first"))
    best = groups.join(first, (F.col("h") == F.col("fh")) & (F.col("text_sha256") == F.col("fs"))
                       & F.col("keep_id").eqNullSafe(F.col("fid"))).drop("fh", "fs", "fid")
    return (rows.join(best, ["h", "text_sha256"])
            .select(F.col("id").alias(id), "keep_id", "group_size", (F.col("number") == F.col("first")).alias("kept"),
                    "text_sha256", F.lower(F.hex("h")).alias("content_hash")))


def drop_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: str = "max",
                normalise=ascii_lower, hash=content_hash) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    key = unused("row_key", docs)
    parts = lambda i, sha: F.concat_ws("/", sha, F.coalesce(i.cast("string"), F.lit("null")))
    kept = decisions(docs, id, text, keep, normalise, hash).where("kept")
    kept = kept.select(parts(F.col(id), F.col("text_sha256")).alias(key))
    sha = F.sha2(_normalised(docs, text, normalise).cast("binary"), 256)
    return (docs.withColumn(key, parts(docs[id], sha))
            .join(kept, key, "left_semi").dropDuplicates([key]).drop(key))
