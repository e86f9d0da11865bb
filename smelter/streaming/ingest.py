"""Incremental file ingest (bronze) and stream-to-stream silver and gold.

* Bronze: a file stream over a landing directory.  Each line is parsed with
  a schema built from its own file's header, so columns bind by name whatever
  their order.  Declared columns get their declared type; new ones are kept as
  text, so no value is lost to a guessed type.  With ``discover`` their types
  are found in one pass over the batch's columns, per file, merged on a lattice
  (int < bigint < double < string, date < timestamp < string) and applied when
  the table is read; a later file may widen them.
  ``availableNow`` processes every file not yet recorded in the checkpoint and
  stops; a rerun with no new files appends nothing, and a retried micro-batch
  replaces its own output.
* Silver: no watermark and no state store (``streaming/dedup.py`` has both).  The state is the deduplicated
  table itself, partitioned by day: each micro-batch merges its rows into the
  days that it touches, so a row that arrives late by any time is kept, and
  the row that survives does not depend on the order of arrival.
* Gold: recomputed for the touched days only.  Rule counters are stored per
  micro-batch.
"""

from __future__ import annotations

import csv
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from smelter.operators import cleaning, datasets
from smelter.operators.sizing import broadcast_if_small
from smelter.session import materialize


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:  # one small file; Spark's readers skip names that begin with "_"
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def claim_checkpoint(spark: SparkSession, checkpoint: str, owner: str) -> None:
    """One checkpoint per (source, sink): the owner is written beside the
    checkpoint, so that another stream is refused after a restart too."""
    mark = checkpoint.rstrip("/") + "_owner"
    current = _read_text(spark, mark)
    if current is not None and current != owner:
        raise ValueError(f"checkpoint {checkpoint} already used by {current}")
    if current is None:
        _write_text(spark, mark, owner)


def run_batches(stream: DataFrame, batch_fn, checkpoint: str, owner: str, mode: str = "append") -> StreamingQuery:
    """Everything available through ``batch_fn(batch, epoch)``, then stop."""
    claim_checkpoint(stream.sparkSession, checkpoint, owner)
    q = (stream.writeStream.foreachBatch(batch_fn).outputMode(mode).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q


# ---- bronze -----------------------------------------------------------------

def schema_file(checkpoint: str) -> str:
    return checkpoint.rstrip("/") + "_schema.json"


def stored_schema(spark: SparkSession, checkpoint: str) -> T.StructType | None:
    """The schema kept beside a bronze checkpoint, None before the first file."""
    text = _read_text(spark, schema_file(checkpoint))
    return None if text is None else T.StructType.fromJson(json.loads(text))


def file_headers(lines: DataFrame) -> DataFrame:
    """(file, header): one row per file, its first line that is not blank.
    ``lines`` has value, path and block_start; files are known by a hash of
    their path."""
    first = lines.where((F.col("block_start") == 0) & (F.trim("value") != "")).withColumn("at", F.monotonically_increasing_id())
    return first.groupBy(F.xxhash64("path").alias("file")).agg(F.min_by("value", "at").alias("header"))


def column_names(header: str) -> list[str]:
    return [c.strip() for c in next(csv.reader([header.lstrip("\ufeff")]))]


def parsed_lines(lines: DataFrame, known: dict[str, T.DataType]) -> DataFrame:
    """Every line by its own file's header, columns bound by name; a column
    that is not ``known`` is text.  Lines that repeat their file's header are
    headers.  The lines are read once, whatever the number of headers; only
    the distinct headers come to the driver, never a path."""
    spark = lines.sparkSession
    heads = materialize(file_headers(lines), "headers")
    headers = sorted(r.header for r in heads.select("header").distinct().collect() )
    if not headers:
        return None
    groups = spark.createDataFrame(list(enumerate(headers)), "head int, header string")
    of_file = materialize(heads.join(F.broadcast(groups), "header").select("file", "head", "header"), "file-headers")
    rows = lines.withColumn("file", F.xxhash64("path")).join(broadcast_if_small(of_file), "file")
    rows = rows.where((F.col("value") != F.col("header")) & (F.trim("value") != ""))
    schemas = [T.StructType([T.StructField(n, known.get(n, T.StringType())) for n in column_names(h)]) for h in headers]
    rows = rows.withColumns({f"_{i}": F.when(F.col("head") == i, F.from_csv("value", _ddl(s)))
                             for i, s in enumerate(schemas)})
    names = list(dict.fromkeys(n for s in schemas for n in s.fieldNames()))
    columns = [F.coalesce(*(F.col(f"_{i}")[n] for i, s in enumerate(schemas) if n in s.fieldNames())).alias(n) for n in names]
    return rows.select(*columns, "source_file", F.current_timestamp().alias("ingested_at"))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


#: Discovered types, narrowest first; the last one takes everything.  Two
#: chains meet in it: whole numbers < doubles, dates < timestamps.
LATTICE = ("int", "bigint", "double", "date", "timestamp", "string")
#: Forms a value must have for a type.  Numbers with leading zeros are codes.
_FORMS = {
    "int": r"^-?(0|[1-9]\d{0,9})$", "bigint": r"^-?(0|[1-9]\d{0,18})$",
    "double": r"^(-?(0|[1-9]\d*)(\.\d*)?([eE][+-]?\d+)?|NaN|-?Infinity)$",
    "date": r"^\d{4}-\d\d-\d\d$",
    "timestamp": r"^\d{4}-\d\d-\d\d([ T]\d\d:\d\d(:\d\d(\.\d{1,9})?)?(Z|[+-]\d\d:?\d\d)?)?$",
}


def column_types(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(source_file, column, one boolean per type): whether all values of a
    text column in a file have the type; null for no value.  One pass, counts
    of each file combined before the shuffle."""
    def holds(c, kind):
        value = F.col(f"`{c}`")
        return F.bool_and(F.when(value.isNotNull(), value.rlike(_FORMS[kind]) & value.try_cast(kind).isNotNull()))

    kinds = LATTICE[:-1]
    per_file = rows.groupBy("source_file").agg(*(F.struct(*(holds(c, k).alias(k) for k in kinds)).alias(f"_{i}") for i, c in enumerate(columns)))
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("types")) for i, c in enumerate(columns))))
    return per_file.select("source_file", each.alias("of")).select("source_file", "of.column", "of.types.*")


def narrowest(flags: dict[str, bool | None]) -> str | None:
    """The narrowest type that all values have; None if there was no value."""
    if flags["int"] is None:
        return None
    return next((k for k in LATTICE[:-1] if flags[k]), "string")


def wider(a: str | None, b: str | None) -> str | None:
    """The least type that holds both."""
    if a is None or b is None or a == b:
        return a or b
    for chain in (("int", "bigint", "double"), ("date", "timestamp")):
        if a in chain and b in chain:
            return max(a, b, key=chain.index)
    return "string"


def discovered(types: DataFrame) -> dict[str, str | None]:
    """The type of each column over all files of a batch: a value that fits a
    type fits every wider one, so the files' booleans are simply and-ed."""
    merged = types.groupBy("column").agg(*(F.bool_and(k).alias(k) for k in LATTICE[:-1]))
    return {r["column"]: narrowest(r.asDict()) for r in merged.collect()}  # one row per column


#: In a stored field's metadata: its values are kept as text and typed when
#: read, so that a type can widen without writing anything again or losing
#: the form in which a value came.
AS_TEXT = {"stored": "text"}


def _stored_type(field: T.StructField) -> T.DataType:
    return T.StringType() if field.metadata.get("stored") == "text" else field.dataType


def _fields(spark: SparkSession, names: list[str], schema: T.StructType, types: dict[str, str | None], text: set[str]) -> list[T.StructField]:
    """``schema`` with the types found in a batch."""
    out = {f.name: f for f in schema.fields}
    for name in names:
        if name in text:
            old = out[name].dataType.simpleString() if name in out and "empty" not in out[name].metadata else None
            kind = wider(old, types.get(name))
            # a column without any value yet is narrower than all types
            out[name] = T.StructField(name, T._parse_datatype_string(kind or "string"), True, AS_TEXT if kind else AS_TEXT | {"empty": True})
        elif name not in out:
            out[name] = T.StructField(name, T.StringType())
    return list(out.values())


def bronze_batches(target: str, checkpoint: str, declared: T.StructType, discover: bool = False):
    """``foreachBatch`` function that lands a batch of files in ``target``."""

    def land(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        schema = stored_schema(spark, checkpoint) or declared
        out = parsed_lines(batch, {f.name: _stored_type(f) for f in schema.fields})
        if out is None:
            return
        names = [c for c in out.columns if c not in ("source_file", "ingested_at")]
        missing = [F.lit(None).cast(_stored_type(f)).alias(f.name) for f in schema.fields if f.name not in names]
        path = f"{target}/ingest_batch={epoch_id}"
        out.select(*names, *missing, "source_file", "ingested_at").write.mode("overwrite").parquet(path)
        text = {n for n in names if discover and n not in declared.fieldNames()}
        types = {}
        if text:  # from the columns just written, not from the files
            found = materialize(column_types(spark.read.parquet(path), sorted(text)), "column-types")
            types = discovered(found)
            found.write.mode("overwrite").parquet(f"{checkpoint.rstrip('/')}_types/ingest_batch={epoch_id}")
        fields = _fields(spark, names, schema, types, text)
        _write_text(spark, schema_file(checkpoint), json.dumps(T.StructType(fields).jsonValue()))

    return land


def ingest_bronze(spark: SparkSession, landing: str, target: str, checkpoint: str,
                  schema: T.StructType, discover: bool = False) -> StreamingQuery:
    """``schema`` has the declared columns.  With ``discover`` the others get
    the narrowest type that all their values so far have, widened when a later
    file needs it; without, they are text."""
    lines = spark.readStream.text(landing).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block_start"),
        F.col("_metadata.file_name").alias("source_file"))
    return run_batches(lines, bronze_batches(target, checkpoint, schema, discover), checkpoint, f"bronze:{landing}")


def read_bronze(spark: SparkSession, target: str, checkpoint: str) -> DataFrame:
    """The bronze table with all columns seen so far, in their types of now."""
    return _typed_bronze(spark.read, stored_schema(spark, checkpoint), target)


def bronze_stream(spark: SparkSession, target: str, checkpoint: str) -> DataFrame:
    return _typed_bronze(spark.readStream, stored_schema(spark, checkpoint), target)


def _typed_bronze(reader, schema: T.StructType, target: str) -> DataFrame:
    extra = [T.StructField("source_file", T.StringType()), T.StructField("ingested_at", T.TimestampType())]
    kept = T.StructType([T.StructField(f.name, _stored_type(f)) for f in schema.fields] + extra)
    rows = reader.schema(kept).parquet(target)
    typed = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in schema.fields if _stored_type(f) != f.dataType}
    return rows.withColumns(typed) if typed else rows


# ---- silver and gold --------------------------------------------------------

NATURAL_KEY = ["furnace_id", "ts"]


def _replace_days(df: DataFrame, path: str, days: list) -> None:
    """Make ``df`` the content of the given ``day`` partitions of ``path``;
    partitions left without a row are removed."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    spark = df.sparkSession
    for day in set(days) - {r.day for r in df.select("day").distinct().collect()}:
        fs, p = _fs(spark, f"{path}/day={'__HIVE_DEFAULT_PARTITION__' if day is None else day}")
        fs.delete(p, True)


def _in_days(df: DataFrame, days: list) -> DataFrame:
    keep = F.col("day").isin([d for d in days if d is not None])
    return df.where(keep | F.col("day").isNull() if None in days else keep)


def silver_batches(seen_path: str, silver_path: str, gold_path: str, rules_path: str,
                   order: tuple[str, ...] = ("reading_seq",), rules=datasets.SILVER_RULES):
    """``foreachBatch`` function from bronze rows to silver and gold.

    ``seen_path`` holds one row per natural key (the first by ``order``),
    before rules, so that a key whose first row breaks a rule stays out of
    silver whatever arrives later.  Days in a micro-batch are few; their list
    selects partitions, so history is not read.  Retried batches give the
    same tables."""
    from smelter.operators import rollups

    def refresh(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        typed = cleaning.typed(batch, cleaning.PIPELINE_TYPES)
        fresh = materialize(cleaning.keep_first(typed, NATURAL_KEY, list(order)).withColumn("day", F.to_date("ts")), "fresh")
        counts = [F.count(F.lit(1)).alias("rows")] + [F.count_if(~r.passes()).alias(r.name) for r in rules]
        fresh.agg(*counts).write.mode("overwrite").parquet(f"{rules_path}/batch_id={epoch_id}")
        days = [r.day for r in fresh.select("day").distinct().collect()]
        if not days:
            return
        if _exists(spark, seen_path):
            before = _in_days(spark.read.option("mergeSchema", True).parquet(seen_path), days)
            fresh = fresh.unionByName(before, allowMissingColumns=True)
        merged = materialize(cleaning.keep_first(fresh, NATURAL_KEY, list(order)), "merged")
        silver = materialize(datasets.enforce(merged, rules), "silver-days")
        _replace_days(silver, silver_path, days)
        _replace_days(rollups.furnace_day(silver, with_vibration=False), gold_path, days)
        _replace_days(merged, seen_path, days)

    return refresh


def run_silver_gold(bronze: DataFrame, seen_path: str, silver_path: str, gold_path: str, rules_path: str,
                    checkpoint: str) -> StreamingQuery:
    return run_batches(bronze, silver_batches(seen_path, silver_path, gold_path, rules_path), checkpoint,
                       f"silver:{silver_path}")
