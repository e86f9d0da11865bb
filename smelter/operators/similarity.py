"""Vector similarity search over an embeddings column.

Exact search packs corpus and queries into blocks of unit vectors and scores
every corpus block against every query block with one matrix product.  A task
keeps the best ``k`` items of a query over all the blocks it sees, so what
leaves it is ``k`` rows a query; the last ranking runs over those.  There is no
bound on the number of queries.

``cell_top_k`` is the approximate way for large corpora: vectors belong to the
cell of their nearest centroid (``fit_cells``), and a query is scored against
the cells with the nearest centroids only, by the same block products.
``lsh_candidates`` uses ``BucketedRandomProjectionLSH`` on unit vectors.

Null vectors, vectors with null or non-finite components and vectors of length
zero have no direction: they take no part, as corpus or as query.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.functions.columns import GUARD_DIGITS, round_half_up

BLOCK = 1024  # vectors scored at once
HELD_BLOCKS = 16  # query blocks whose best items a task holds at a time


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, v: acc + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def centroids(df: DataFrame, group: str, vec: str, dim: int) -> DataFrame:
    """Mean vector per group (element-wise average, partial aggregation)."""
    return df.groupBy(group).agg(
        F.array(*[F.avg(F.col(vec)[i].cast("double")) for i in range(dim)]).alias(vec))


def _default_salts(df: DataFrame) -> int:
    """One slice per shuffle partition (at least 32): the first ranking stage
    spreads a query's candidates over the whole cluster."""
    try:
        return max(32, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    except (TypeError, ValueError):
        return 32


def top_k(scored: DataFrame, query: str, item: str, score: str, k: int, salts: int | None = None) -> DataFrame:
    """Top-k items per query by score (desc), ties to the smaller item id.

    Stage 1 ranks within (query, salt) slices; stage 2 ranks the at most
    ``k * salts`` survivors per query, so no task sorts a query's whole
    candidate list.
    """
    from pyspark.sql import Window

    salts = salts or _default_salts(scored)
    order = [F.desc(score), F.asc(item)]
    salted = scored.withColumn("_salt", F.pmod(F.xxhash64(item), F.lit(salts)))
    w1 = Window.partitionBy(query, "_salt").orderBy(*order)
    stage1 = salted.withColumn("_r", F.row_number().over(w1)).filter(F.col("_r") <= k).drop("_r", "_salt")
    w2 = Window.partitionBy(query).orderBy(*order)
    return stage1.withColumn("rank", F.row_number().over(w2)).filter(F.col("rank") <= k)


def _directed(df: DataFrame, vec: str) -> DataFrame:
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    return df.where(F.col(vec).isNotNull() & fine & F.exists(vec, lambda x: x != 0))


def _unit_rows(vectors: pa.Array) -> np.ndarray:
    m = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    m = m / np.abs(m).max(axis=1, keepdims=True)  # squares of tiny or huge components stay in range
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _packed(df: DataFrame, id: str, vec: str, by: str | None = None) -> DataFrame:
    """Rows (by, ids, units) of at most ``BLOCK`` vectors; with ``by``, the rows
    of ``df`` come sorted by it within partitions, and blocks do not mix values."""
    cut = F.lit(0) if by is None else F.col(by)
    rows = _directed(df, vec).select(cut.cast("int").alias("by"), F.col(id).alias("id"), F.col(vec).alias("vec"))

    def run(batches):
        for batch in batches:
            groups = batch.column("by").to_numpy()
            edges = np.flatnonzero(np.diff(groups)) + 1
            for lo, hi in zip([0, *edges], [*edges, len(groups)], strict=True):
                for at in range(lo, hi, BLOCK):
                    part = batch.slice(at, min(BLOCK, hi - at))
                    n = part.num_rows
                    if n:
                        yield pa.RecordBatch.from_arrays([
                            part.column("by").slice(0, 1), pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), part.column("id")),
                            pa.array([_unit_rows(part.column("vec")).tobytes()], pa.binary())], ["by", "ids", "units"])

    schema = T.StructType([T.StructField("by", T.IntegerType()), T.StructField("ids", T.ArrayType(df.schema[id].dataType)),
                           T.StructField("units", T.BinaryType())])
    return rows.mapInArrow(run, schema)


def _best(scores: np.ndarray, items: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best of each row by score, ties to the smaller item; ``scores``
    are whole numbers, so score and place of the item make one sort key."""
    distinct, place = np.unique(items, return_inverse=True)
    key = -scores * len(distinct) + place.reshape(items.shape)
    if key.shape[1] > k:
        top = np.argpartition(key, k - 1, axis=1)[:, :k]
        scores, items = np.take_along_axis(scores, top, 1), np.take_along_axis(items, top, 1)
    return scores, items


def _scored_blocks(pairs: DataFrame, item: T.DataType, query: T.DataType, k: int, digits: int) -> DataFrame:
    """Best ``k`` items of each query among the block pairs (ids, units, block,
    qids, qunits) of each task: rows (query, item, score)."""
    schema = T.StructType([T.StructField("query", query), T.StructField("item", item), T.StructField("score", T.DoubleType())])

    def run(batches):
        held = {}

        def rows(block):
            qids, scores, items = held.pop(block)
            each = pa.array(np.repeat(np.arange(len(qids)), scores.shape[1]))
            return pa.RecordBatch.from_arrays([qids.take(each), pa.array(items.ravel().tolist(), item_type),
                                               pa.array(scores.ravel() / 10.0 ** digits + 0.0)], schema.names)

        for batch in batches:
            item_type = batch.column("ids").type.value_type
            for i in range(batch.num_rows):
                ids, qids = batch.column("ids")[i].values, batch.column("qids")[i].values
                a, q = (np.frombuffer(batch.column(c)[i].as_buffer(), np.float64).reshape(n, -1)
                        for c, n in (("units", len(ids)), ("qunits", len(qids))))
                exact = np.round(np.abs(q @ a.T), digits + GUARD_DIGITS) * 10.0 ** digits
                scores = (np.copysign(np.floor(np.round(exact, GUARD_DIGITS) + 0.5), q @ a.T)).astype(np.int64)
                items = np.broadcast_to(ids.to_numpy(zero_copy_only=False), scores.shape)
                block = batch.column("block")[i].as_py()
                if block in held:
                    _, s, n = held[block]
                    scores, items = np.hstack([s, scores]), np.hstack([n, items])
                elif len(held) == HELD_BLOCKS:
                    yield rows(next(iter(held)))
                held[block] = (qids, *_best(scores, items, k))
        while held:
            yield rows(next(iter(held)))

    return pairs.select("ids", "units", "block", "qids", "qunits").mapInArrow(run, schema)


def _query_blocks(blocks: DataFrame) -> DataFrame:
    return blocks.select("by", F.monotonically_increasing_id().alias("block"), F.col("ids").alias("qids"),
                         F.col("units").alias("qunits"))


def _ranked(scored: DataFrame, item: str, query: str, k: int) -> DataFrame:
    named = scored.select(F.col("item").alias(item), F.col("query").alias(query), "score")
    return top_k(named, query, item, "score", k)


def exact_top_k(corpus: DataFrame, queries: DataFrame, item: str, query: str, vec: str, k: int,
                digits: int = 6) -> DataFrame:
    """Cosine top-k of ``corpus`` for every query vector (exact), for any number
    of queries: rows (item, query, score, rank).  Scores are rounded to
    ``digits`` before ranking, ties go to the smaller item.  Query ids are
    unique."""
    # a stated query set against all rows, block by block: no vector is joined with a vector;
    # corpus blocks are dealt to slots, and a shuffle, not the driver, brings all query blocks to each
    slots = _default_salts(corpus)
    blocks = _packed(corpus, item, vec).withColumn("by", F.pmod(F.xxhash64("ids"), F.lit(slots)).cast("int"))
    asked = _query_blocks(_packed(queries, query, vec)).withColumn("by", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    pairs = blocks.join(asked.hint("merge"), "by").drop("by")
    scored = _scored_blocks(pairs, corpus.schema[item].dataType, queries.schema[query].dataType, k, digits)
    return _ranked(scored, item, query, k)


@dataclass(frozen=True)
class Cells:
    """Centroids of the cells (unit vectors), and how many cells a query probes."""

    centroids: np.ndarray
    probes: int


FIT_VECTORS = 20_000  # vectors that centroids and probes are fitted on
MOST_CELLS = 1024
FIT_QUERIES = 256


def fit_cells(corpus: DataFrame, item: str, vec: str, k: int = 10, recall: float = 0.95,
              cells: int | None = None) -> Cells:
    """Centroids by k-means over the ``FIT_VECTORS`` vectors with the least item
    hash, and the least number of probed cells with which the sample's own
    exact top-k is found to the share ``recall``.  (Neighbours in a sample lie
    further apart than in the corpus, so this asks for more cells, not fewer.)"""
    sample = _directed(corpus, vec).select(F.transform(vec, lambda x: x.cast("double")).alias("v"), item)
    sample = sample.orderBy(F.xxhash64(item), item).limit(FIT_VECTORS).select(array_to_vector("v").alias("v"))
    rows = [r.v.toArray() for r in sample.collect()]  # FIT_VECTORS at most
    if not rows:
        return Cells(np.zeros((0, 0)), 1)
    units = np.array(rows) / np.linalg.norm(rows, axis=1, keepdims=True)
    n = min(cells or max(1, int(math.sqrt(len(units)))), MOST_CELLS, len(units))
    centroids = units[:1]
    if n > 1:
        model = KMeans(k=n, seed=42, maxIter=10, initMode="random", distanceMeasure="cosine", featuresCol="v").fit(sample)
        centroids = np.array(model.clusterCenters())
        centroids = centroids / np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-300)
    cell = (units @ centroids.T).argmax(axis=1)
    asked = units[:FIT_QUERIES]
    # the nearest of all is the vector itself, which says nothing about the others
    nearest = np.argsort(-(asked @ units.T), axis=1, kind="stable")[:, 1:k + 1]
    if not nearest.size:
        return Cells(centroids, 1)
    # how many cells lie before the one that holds a neighbour, by the query's order of centroids
    turn = np.argsort(np.argsort(-(asked @ centroids.T), axis=1, kind="stable"), axis=1)
    needed = np.sort(np.take_along_axis(turn, cell[nearest], axis=1).ravel()) + 1
    return Cells(centroids, int(needed[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)]))


def with_cells(df: DataFrame, vec: str, cells: Cells, probes: int = 1) -> DataFrame:
    """Rows of ``df`` with a direction and the column ``cell``: one row for each
    of the ``probes`` nearest centroids.  ``vec`` becomes the unit vector."""
    at = df.columns.index(vec)
    rows = _directed(df, vec).withColumn(vec, F.transform(vec, lambda x: x.cast("double")))
    centroids, probes = cells.centroids, min(probes, len(cells.centroids))

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                part = batch.slice(lo, BLOCK)
                units = _unit_rows(part.column(at))
                near = np.argsort(-(units @ centroids.T), axis=1, kind="stable")[:, :probes].astype(np.int32)
                columns = list(part.columns)
                columns[at] = pa.ListArray.from_arrays(pa.array(np.arange(len(units) + 1) * units.shape[1], pa.int32()),
                                                       pa.array(units.ravel()))
                out = pa.RecordBatch.from_arrays(columns, part.schema.names).take(
                    pa.array(np.repeat(np.arange(len(units)), probes)))
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(near.ravel())], [*part.schema.names, "cell"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType())]))


def cell_top_k(index: DataFrame, queries: DataFrame, item: str, query: str, vec: str, k: int, cells: Cells,
               digits: int = 6, query_vec: str | None = None) -> DataFrame:
    """Cosine top-k among the cells a query probes.  ``index`` is the corpus
    after ``with_cells``; it is dealt by cell and item, so that a crowded cell
    fills many tasks, and blocks of one cell meet the query blocks of that cell."""
    query_vec = query_vec or vec
    asked = with_cells(queries.select(query, query_vec), query_vec, cells, cells.probes)
    asked = _packed(asked.repartition("cell", query).sortWithinPartitions("cell"), query, query_vec, "cell")
    stock = _packed(index.repartition("cell", item).sortWithinPartitions("cell"), item, vec, "cell")
    pairs = stock.join(_query_blocks(asked), "by")
    scored = _scored_blocks(pairs, index.schema[item].dataType, queries.schema[query].dataType, k, digits)
    return _ranked(scored, item, query, k)


def lsh_candidates(corpus: DataFrame, queries: DataFrame, item: str, query: str, vec: str, k: int,
                   max_distance: float = 1.2, bucket_length: float = 1.0, tables: int = 6,
                   digits: int = 6) -> DataFrame:
    """Approximate cosine top-k: LSH similarity join on unit vectors (only
    pairs sharing a hash bucket are compared), then exact cosine on the
    candidates and the salted top-k."""
    def unit(df, key):
        n = norm(F.col(vec))
        return df.select(F.col(key).alias("id"),
                         array_to_vector(F.transform(vec, lambda x: x.cast("double") / n)).alias("v"))

    cu, qu = unit(corpus, item), unit(queries, query)
    lsh = BucketedRandomProjectionLSH(inputCol="v", outputCol="h", bucketLength=bucket_length,
                                      numHashTables=tables, seed=42).fit(cu)
    pairs = lsh.approxSimilarityJoin(qu, cu, max_distance, distCol="dist")
    a, b = vector_to_array(F.col("datasetA.v")), vector_to_array(F.col("datasetB.v"))
    scored = pairs.select(F.col("datasetA.id").alias(query), F.col("datasetB.id").alias(item),
                          round_half_up(dot(a, b), digits).alias("score"))
    return top_k(scored, query, item, "score", k)


class SimilarityIndex:
    """Versioned index of unit vectors, synchronised on trigger.

    Each sync compares the corpus with the current index version on the item
    key and a 64-bit hash of the vector (``snapshots.changes``), recomputes unit
    vectors only for inserted or updated items, drops deleted ones, and
    commits the result as a new version with the change counts in its
    operation text.  With ``cells``, every vector also carries its cell, and
    ``search`` probes the current version.
    """

    def __init__(self, spark, root: str, item: str, vec: str, cells: Cells | None = None):
        from smelter.operators.snapshots import SnapshotTable

        self.table = SnapshotTable(spark, root)
        self.item, self.vec, self.cells = item, vec, cells

    def _prepare(self, corpus: DataFrame) -> DataFrame:
        if self.cells is not None:
            hashed = corpus.select(self.item, F.xxhash64(self.vec).alias("vec_hash"), F.col(self.vec).alias("unit"))
            return with_cells(hashed, "unit", self.cells)
        n = norm(F.col(self.vec))
        return corpus.select(F.col(self.item), F.xxhash64(self.vec).alias("vec_hash"),
                             F.transform(self.vec, lambda x: x.cast("double") / n).alias("unit"))

    def sync(self, corpus: DataFrame) -> int:
        from smelter.operators.snapshots import changes

        if self.table.current_version() is None:
            return self.table.write(self._prepare(corpus), operation="BUILD")
        current = self.table.read()
        keyed = corpus.select(self.item, F.xxhash64(self.vec).alias("vec_hash"))
        delta = changes(current.select(self.item, "vec_hash"), keyed, [self.item]).cache()
        counts = {r.change_type: r.n for r in delta.groupBy("change_type").count()
                  .withColumnRenamed("count", "n").collect()}  # at most three rows
        touched = delta.filter(F.col("change_type") != "delete").select(self.item)
        kept = current.join(delta.select(self.item), self.item, "left_anti")
        fresh = self._prepare(corpus.join(touched, self.item, "left_semi"))
        op = "SYNC +{} ~{} -{}".format(counts.get("insert", 0), counts.get("update", 0), counts.get("delete", 0))
        version = self.table.write(kept.unionByName(fresh), operation=op)
        delta.unpersist()
        return version

    def read(self) -> DataFrame:
        return self.table.read()

    def search(self, queries: DataFrame, query: str, vec: str, k: int) -> DataFrame:
        """Approximate cosine top-k of the indexed items for every query."""
        return cell_top_k(self.read(), queries, self.item, query, "unit", k, self.cells, query_vec=vec)
