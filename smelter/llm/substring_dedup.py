"""Suffix-array deduplication with a run-length index, corpus-wide.

Removes every byte covered by a ``LEAST``-byte string that also starts
anywhere else in the corpus (the same text included); matches never cross
texts.

All starts of equal strings must meet, without shipping the corpus to one
index.  Each ``LEAST``-byte string has an anchor, its ``GRAM``-byte piece with
the least hash (leftmost of equals), which only depends on the string.
Consecutive strings with the same anchor place form a block of at most
``2 * LEAST - GRAM`` bytes; equal strings lie in blocks with equal anchors.

1. ``blocks``: one narrow row per block (anchor, digest, place).
2. An anchor seen once is done.  Where all blocks of an anchor are equal, all
   of them are removed.  Both follow from counts and extreme digests by
   anchor, combined before the shuffle, so a common passage is no large group.
3. Otherwise equal blocks are counted; one of each meets the others of its
   anchor in a run-compressed index (``RunIndex``) that holds whole anchors up
   to ``INDEX_BYTES``, and the matching statistics mark the long matches.
4. An anchor with over ``INDEX_BLOCKS`` different blocks (the rim of a very
   common passage) would not fit one index.  Its blocks are cut on a grid:
   cells equal to another are marked, cells whose common core occurs once are
   dropped, the rest is cut finer, down to single strings.  Exact as well.

Defined results: null counts as empty; texts under ``LEAST`` bytes are kept
whole; rows that repeat id and text are texts of their own, so both lose what
they share; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.llm import spans
from smelter.llm.common import keyed_texts, stored
from smelter.llm.run_index import RunIndex

LEAST, GRAM = 200, 32
INDEX_BYTES, INDEX_BLOCKS = 1 << 20, 6_000
#: Bytes of one text handled at once; longer texts are taken in pieces.
PIECE = 1 << 21
GRID = (64, 16, 4, 1)

_PLACE_BITS = np.uint64(24)
_SECOND = spans.second_table()


def _least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    n = len(values)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, 1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def cut_blocks(data: np.ndarray, offsets: np.ndarray):
    """Blocks of some texts: (row, begin, size, lead, anchor, digest); lead is
    how far into the block the anchor lies."""
    starts = np.zeros(len(data) + 1, bool)
    if len(data) >= LEAST:
        inside = np.flatnonzero(np.diff(offsets) >= LEAST)
        step = np.zeros(len(data) + 2, np.int64)
        np.add.at(step, offsets[inside], 1)
        np.add.at(step, offsets[inside + 1] - LEAST + 1, -1)
        starts = np.cumsum(step[:-1]) > 0
    place = np.flatnonzero(starts)
    if not len(place):
        return (np.zeros(0, np.int64),) * 6
    hashes = spans.RangeHash(data)
    grams = np.arange(len(data) - GRAM + 1)
    gram = spans.mixed(hashes.raw(grams, grams + GRAM))
    packed = (gram >> _PLACE_BITS << _PLACE_BITS) | grams.astype(np.uint64)
    least = _least_in_windows(packed, LEAST - GRAM + 1)[place]
    new = np.ones(len(place), bool)
    new[1:] = (least[1:] != least[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1
    begin, end = place[first], place[last] + LEAST
    anchor = (least[first] & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
    row = spans.owner(begin, offsets)
    digest = spans.RangeHash(data, _SECOND).of(begin, end)
    return row, begin - offsets[row], end - begin, anchor - begin, gram[anchor].view(np.int64), digest.view(np.int64)


def _pieces(batch: pa.RecordBatch):
    """Slices of a batch; a text over ``PIECE`` bytes comes in overlapping
    pieces of its own: (first row, shift, bytes, offsets)."""
    for row, data, offsets in spans.slices(batch, "text"):
        if len(data) <= PIECE:
            yield row, 0, data, offsets
        else:
            for at in range(0, max(len(data) - LEAST + 1, 1), PIECE):
                part = data[at:at + PIECE + LEAST - 1]
                yield row, at, part, np.array([0, len(part)])


def blocks(texts: DataFrame) -> DataFrame:
    """Rows (anchor, digest, key, begin, size, lead), one per block."""

    def run(batches):
        for batch in batches:
            keys = batch.column("key").to_numpy()
            for first, shift, data, offsets in _pieces(batch):
                row, begin, size, lead, anchor, digest = cut_blocks(data, offsets)
                yield pa.RecordBatch.from_arrays([
                    pa.array(anchor), pa.array(digest), pa.array(keys[first + row]), pa.array((begin + shift).astype(np.int32)),
                    pa.array(size.astype(np.int16)), pa.array(lead.astype(np.int16))], names)

    names = ["anchor", "digest", "key", "begin", "size", "lead"]
    return texts.select("key", "text").mapInArrow(run, "anchor long, digest long, key long, begin int, size short, lead short")


def _cut_out(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of wanted blocks (key, begin, size, ...): rows (anchor, key,
    begin, lead, alone, bytes).  ``texts`` has one row of each key; blocks of
    rows that repeat are the same block and are cut once."""
    by_text = wanted.groupBy("key").agg(F.collect_set(F.struct("anchor", "begin", "size", "lead", "alone")).alias("cuts"))

    def run(batches):
        for batch in batches:
            for i, cuts in enumerate(batch.column("cuts")):
                if not cuts.is_valid:
                    continue
                text, key = batch.column("text")[i].as_py(), batch.column("key")[i].as_py()
                got = cuts.as_py()
                yield pa.RecordBatch.from_arrays([
                    pa.array([c["anchor"] for c in got], pa.int64()), pa.array([key] * len(got), pa.int64()),
                    pa.array([c["begin"] for c in got], pa.int32()), pa.array([c["lead"] for c in got], pa.int16()),
                    pa.array([c["alone"] for c in got], pa.bool_()),
                    pa.array([text[c["begin"]:c["begin"] + c["size"]] for c in got], pa.binary())], names)

    names = ["anchor", "key", "begin", "lead", "alone", "bytes"]
    # the same shuffle of the texts serves the last step of ``removed``
    joined = texts.join(by_text, "key", "left").select("key", "id", "text", "cuts")
    return joined.mapInArrow(run, "anchor long, key long, begin int, lead short, alone boolean, bytes binary")


def _indexed_matches(cuts: DataFrame) -> DataFrame:
    """Long matches (key, begin, size) in blocks that occur once, found in
    run-compressed indexes over whole anchors."""

    def run(batches):
        held, size, at = [], 0, None
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("anchor", "key", "begin", "alone", "bytes")), strict=True)
            for anchor, key, begin, alone, data in rows:
                if anchor != at and size >= INDEX_BYTES:
                    yield marks(held)
                    held, size = [], 0
                at = anchor
                held.append((key, begin, alone, data))
                size += len(data)
        if held:
            yield marks(held)

    def marks(held):
        string, begin, end = RunIndex([h[3] for h in held]).long_matches(LEAST)
        alone = np.array([h[2] for h in held])[string]
        string, begin, end = string[alone], begin[alone], end[alone]
        keys, places = np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held], np.int64)
        return pa.RecordBatch.from_arrays([pa.array(keys[string]), pa.array((places[string] + begin).astype(np.int32)),
                                           pa.array((end - begin).astype(np.int32))], ["key", "begin", "size"])

    return (cuts.select("anchor", "key", "begin", "alone", "bytes").repartition("anchor").sortWithinPartitions("anchor")
            .mapInArrow(run, "key long, begin int, size int"))


def _grid_matches(cuts: DataFrame) -> DataFrame:
    """Long matches (key, begin, size) among blocks of crowded anchors."""
    # u and v: first and last string of a piece, counted from the anchor
    active = cuts.select("anchor", "key", F.col("begin").cast("long").alias("begin"), (-F.col("lead")).cast("long").alias("u"),
                         (F.length("bytes") - LEAST - F.col("lead")).cast("long").alias("v"), "bytes")
    found = None
    for g in GRID:
        cell = active.withColumn("q", F.explode(F.sequence(F.floor(F.col("u") / g), F.floor(F.col("v") / g))))
        cell = (cell.withColumn("nu", F.greatest("u", F.col("q") * g)).withColumn("nv", F.least("v", F.col("q") * g + (g - 1)))
                .select("anchor", "key", "q", (F.col("begin") + F.col("nu") - F.col("u")).alias("begin"),
                        F.col("nu").alias("u"), F.col("nv").alias("v"),
                        F.expr(f"substring(bytes, int(nu - u + 1), int(nv - nu + {LEAST}))").alias("bytes")))
        core = F.expr(f"substring(bytes, int(q * {g} + {g} - u), {LEAST + 1 - g})")
        cell = stored(cell.withColumn("core", F.md5(F.concat(F.expr("unhex(hex(anchor))"), F.expr("unhex(hex(q))"), core)))
                      .withColumn("whole", F.md5(F.concat(F.col("core").cast("binary"), F.expr("unhex(hex(u))"), F.col("bytes")))),
                      "grid").withColumn("place", F.xxhash64("key", "begin"))
        cores = stored(cell.groupBy("core").agg(F.count("*").alias("n")).where("n > 1"), "cores")
        wholes = stored(cell.groupBy("whole").agg(F.count("*").alias("m"), F.min("place").alias("one")).where("m > 1"), "wholes")
        cell = cell.join(cores, "core").join(wholes, "whole", "left")
        same = F.col("m").isNotNull() if g > 1 else F.lit(True)
        rows = cell.where(same).select("key", F.col("begin").cast("int").alias("begin"),
                                       (F.col("v") - F.col("u") + LEAST).cast("int").alias("size"))
        found = rows if found is None else found.union(rows)
        # one of equal cells goes on, for cells that only share some of its strings
        active = cell.where(F.col("m").isNull() | (F.col("place") == F.col("one"))).select("anchor", "key", "begin", "u", "v", "bytes")
    return found


def _one_row_each(texts: DataFrame, every: DataFrame) -> DataFrame:
    """``texts`` with one row of each key.  A text with blocks has one that
    begins at 0, so the narrow table of blocks tells which keys repeat."""
    repeated = stored(every.where("begin = 0").groupBy("key").count().where("count > 1").select("key"), "repeated")
    if repeated.isEmpty():
        return texts
    one = texts.join(repeated, "key", "left_semi").groupBy("key").agg(F.first("id").alias("id"), F.first("text").alias("text"))
    return texts.join(repeated, "key", "left_anti").select("key", "id", "text").union(one)


def removed_spans(texts: DataFrame) -> DataFrame:
    """Rows (key, begin, size): bytes to remove, as spans that may overlap."""
    every = stored(blocks(texts), "blocks")
    shared = stored(every.groupBy("anchor").agg(F.count("*").alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high"))
                    .where("n > 1").select("anchor", (F.col("low") != F.col("high")).alias("differ")), "anchors")
    hits = stored(every.join(shared, "anchor").withColumn("place", F.xxhash64("key", "begin")), "hits")
    whole = hits.where("not differ").select("key", "begin", F.col("size").cast("int").alias("size"))
    differ = hits.where("differ").drop("differ")
    bodies = stored(differ.groupBy("anchor", "digest").agg(F.count("*").alias("n"), F.min("place").alias("one")), "bodies")
    crowded = stored(bodies.groupBy("anchor").count().where(F.col("count") > INDEX_BLOCKS).select("anchor"), "crowded")
    differ = stored(differ.join(bodies, ["anchor", "digest"]), "differ")
    equal = differ.where("n > 1").select("key", "begin", F.col("size").cast("int").alias("size"))
    wanted = differ.where("place = one").withColumn("alone", F.col("n") == 1)
    found = whole.union(equal)
    sources = _one_row_each(texts, every)
    if not crowded.isEmpty():
        rim = _cut_out(sources, wanted.join(crowded, "anchor", "left_semi"))
        found = found.union(stored(_grid_matches(rim), "grid-marks"))
        wanted = wanted.join(crowded, "anchor", "left_anti")
    return found.union(_indexed_matches(_cut_out(sources, wanted)))


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256 and,
    on request, the kept bytes."""
    texts = keyed_texts(docs, id, text)
    # a set: rows that repeat id and text share a key and find the same spans
    marks = removed_spans(texts).groupBy("key").agg(F.collect_set(F.struct("begin", "size")).alias("marks"))
    joined = texts.join(marks, "key", "left").select("key", "id", "text", "marks")
    schema = T.StructType([texts.schema["id"], *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")),
                           T.StructField("kept_sha256", T.StringType()),
                           *([T.StructField("kept", T.BinaryType())] * with_text)])

    def run(batches):
        for batch in batches:
            out = []
            marks = batch.column("marks")
            offsets = np.append(marks.offsets.to_numpy()[:batch.num_rows], marks.offsets[batch.num_rows].as_py())
            begins, sizes = (marks.values.field(i).to_numpy().astype(np.int64) for i in range(2))
            valid = np.asarray(marks.is_valid())
            for i, data in enumerate(batch.column("text")):
                data = data.as_py()
                kept, spans_found, gone = data, 0, 0
                if valid[i]:
                    b, s = begins[offsets[i]:offsets[i + 1]], sizes[offsets[i]:offsets[i + 1]]
                    step = np.zeros(len(data) + 1, np.int32)
                    np.add.at(step, b, 1)
                    np.add.at(step, b + s, -1)
                    cover = np.cumsum(step[:-1]) > 0
                    gone = int(cover.sum())
                    spans_found = int(cover[0]) + int((cover[1:] & ~cover[:-1]).sum())
                    kept = np.frombuffer(data, np.uint8)[~cover].tobytes()
                out.append((len(data), gone, spans_found, hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            arrays = [batch.column("id"), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(columns[4], pa.binary())] * with_text, schema.names)

    return joined.mapInArrow(run, schema).withColumnRenamed("id", id)
