"""Typed discovery of columns at ingest: lattice, widening, per-file types."""

import itertools
import os
import tempfile

import pytest
from pyspark.sql import types as T

from smelter.streaming import ingest

DECLARED = T.StructType([T.StructField("id", T.IntegerType())])


def _land(landing, name, header, lines):
    os.makedirs(landing, exist_ok=True)
    with open(os.path.join(landing, name), "w") as fh:
        fh.write("\n".join([header, *lines]) + "\n")


def test_lattice():
    kinds = [None, *ingest.LATTICE]
    for a, b, c in itertools.product(kinds, repeat=3):
        assert ingest.wider(a, b) == ingest.wider(b, a) and ingest.wider(a, a) == a
        assert ingest.wider(ingest.wider(a, b), c) == ingest.wider(a, ingest.wider(b, c))
    assert ingest.wider("int", "double") == "double" and ingest.wider("date", "timestamp") == "timestamp"
    assert ingest.wider("int", "date") == "string" and ingest.wider(None, "int") == "int"


@pytest.mark.parametrize("values,kind", [
    (["1", "-20", ""], "int"), (["1", "3000000000"], "bigint"), (["1", "2.50"], "double"), (["1e5", "NaN"], "double"),
    (["007", "1"], "string"), (["2024-01-31"], "date"), (["2024-01-31", "2024-01-31T10:00:00Z"], "timestamp"),
    (["2024-02-30"], "string"), (["1", "2024-01-31"], "string"), (["99999999999999999999"], "double"), (["abc"], "string"), (["", ""], None)])
def test_types_of_values(spark, values, kind):
    rows = spark.createDataFrame([("f", v or None) for v in values], "source_file string, c string")
    assert ingest.discovered(ingest.column_types(rows, ["c"])) == {"c": kind}


def test_files_widen_the_stored_schema(spark):
    base = tempfile.mkdtemp(prefix="discover-", dir="/tmp")
    landing, target, ckpt = (os.path.join(base, d) for d in ("landing", "bronze", "ckpt"))

    def ingest_now():
        ingest.ingest_bronze(spark, landing, target, ckpt, DECLARED, discover=True)
        types = {f.name: f.dataType.simpleString() for f in ingest.stored_schema(spark, ckpt).fields}
        return types, {r.id: r for r in ingest.read_bronze(spark, target, ckpt).collect()}

    _land(landing, "a.csv", "id,n,when,code,none", ["1,5,2024-01-01,12,", '2,,2024-01-02,"13",'])
    _land(landing, "b.csv", "n,id", ["3000000000,3", "n,id", "", "7,4"])
    types, rows = ingest_now()
    assert types == {"id": "int", "n": "bigint", "when": "date", "code": "int", "none": "string"}
    assert len(rows) == 4 and rows[3].n == 3_000_000_000 and rows[2].n is None and str(rows[1].when) == "2024-01-01" and rows[1].code == 12
    _land(landing, "c.csv", "when,id,n,code,extra,none", ['2024-01-03 04:05:06,5,0.50,"0,14",2.0,9'])
    types, rows = ingest_now()
    assert types == {"id": "int", "n": "double", "when": "timestamp", "code": "string", "none": "int", "extra": "double"}
    # what came before is typed anew, codes in the form in which they came
    assert (rows[1].n, str(rows[1].when), rows[1].code, rows[1].extra) == (5.0, "2024-01-01 00:00:00", "12", None)
    assert (rows[5].n, str(rows[5].when), rows[5].code, rows[5].none) == (0.5, "2024-01-03 04:05:06", "0,14", 9)
    found = spark.read.parquet(ckpt + "_types")
    assert {(r.source_file, ingest.narrowest(r.asDict())) for r in found.where("column = 'n'").collect()} == {
        ("a.csv", "int"), ("b.csv", "bigint"), ("c.csv", "double")}
    stream = ingest.bronze_stream(spark, target, ckpt)
    assert dict(stream.dtypes)["when"] == "timestamp" and dict(stream.dtypes)["n"] == "double"


def test_lines_are_parsed_once(spark):
    """One parse for each header and line, however many columns are taken."""
    base = tempfile.mkdtemp(prefix="discover-", dir="/tmp")
    _land(base, "a.csv", "id,x,y,z", ["1,2,3,4"])
    _land(base, "b.csv", "z,id", ["4,2"])
    lines = spark.read.text(base).selectExpr("value", "_metadata.file_path AS path", "_metadata.file_block_start AS block_start",
                                             "_metadata.file_name AS source_file")
    out = ingest.parsed_lines(lines, {"id": T.IntegerType()})
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv(") <= 2 and "SortMergeJoin" not in plan
    assert sorted((r.id, r.z, r.x) for r in out.collect()) == [(1, "4", "2"), (2, "4", None)]
