"""Tree ensembles over many rows: Spark ML's estimators, fitted on binned features.

A tree sees a feature only through the bins between its candidate splits (32 or
so), so rows with the same bins take the same way through every tree.  Up to
``SPARK_ROWS`` training rows the trees are Spark's own, fitted on the single
rows.  Beyond:

* Boosted trees draw nothing at random: Spark fits them on one weighted row per
  combination of bins (its mean label; per label, for a classifier).  The trees
  are those of the single rows, but for rounding, which may decide between
  splits of equal gain.
* Forests draw rows for every tree.  Spark keeps a count per row and tree in
  memory and passes over it for every level.  Here the counts are drawn anew in
  every pass, each task sums its rows per node, feature and bin, and the sums of
  a tree meet in one reducer, which picks its splits; the driver sees only
  those.  Same splits, depth and bootstrap, other random draws.

Every model returned is an ordinary Spark model over the raw features.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.wrapper import JavaEstimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.session import materialize, scratch_dir

#: Training rows up to which Spark fits the trees itself.
SPARK_ROWS = 200_000
#: Rows summed at a time, and the bytes of sums a task may hold.
CHUNK_ROWS = 1 << 16
SUM_BYTES = 32 << 20

_DRAWS = 1 << 16
_WEIGHT = "rows_of_cell"


# ---- bins -------------------------------------------------------------------

def _thresholds(values: np.ndarray, samples: float, most: int) -> np.ndarray:
    """Spark's candidate splits of one feature: between all its values, or at
    strides of equal counts; zeros are counted as what the samples lack."""
    found, counts = np.unique(values[values != 0], return_counts=True)
    if not len(found):
        return np.empty(0)
    counts = counts.astype(float)
    if samples - counts.sum() > np.finfo(float).eps * counts.sum() * 100:
        at = np.searchsorted(found, 0.0)
        found, counts = np.insert(found, at, 0.0), np.insert(counts, at, samples - counts.sum())
    between = (found[:-1] + found[1:]) / 2
    if len(between) <= most:
        return between
    stride = target = samples / (most + 1)
    splits, total = [], np.cumsum(counts)
    for before, now, split in zip(total[:-1], total[1:], between):
        if abs(before - target) < abs(now - target):
            splits.append(split)
            target += stride
    return np.asarray(splits)


def candidate_splits(df: DataFrame, features: str, rows: int, max_bins: int, seed: int) -> list[np.ndarray]:
    """The splits Spark's trees would consider: the same ten thousand or so
    sampled rows (all, if there are fewer), the same thresholds."""
    spark = df.sparkSession
    fraction = min(1.0, max(max_bins * max_bins, 10_000) / rows)
    vectors = df.select(features)._jdf
    draw = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
    sample = spark._jsparkSession.createDataFrame(vectors.toJavaRDD().sample(False, fraction, draw), vectors.schema())
    values = np.array([row[0].toArray() for row in DataFrame(sample, spark).collect()])
    values = values.reshape(len(values), -1)
    return [_thresholds(column, fraction * rows, min(max_bins, rows) - 1) for column in values.T]


def _bin_names(splits: list[np.ndarray]) -> list[str]:
    return [f"b{i}" for i in range(len(splits))]


def binned(df: DataFrame, label: str, features: str, splits: list[np.ndarray]) -> DataFrame:
    """A bin per feature, as the trees see it (a value on a threshold is below
    it), and the label."""
    names = _bin_names(splits)

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(splits))
            if not np.isfinite(x).all():
                raise ValueError("features must not be NaN or infinite")
            bins = [pa.array(np.searchsorted(s, x[:, i], side="left").astype(np.int16)) for i, s in enumerate(splits)]
            yield pa.RecordBatch.from_arrays([*bins, batch.column(1)], names=[*names, "label"])

    pairs = df.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("label"))
    return pairs.mapInArrow(assign, ", ".join(f"{n} smallint" for n in names) + ", label double")


# ---- Spark models from nodes --------------------------------------------------

_NODES = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, "
          "rawCount: bigint, gain: double, leftChild: int, rightChild: int, "
          "split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>")


def _with_nodes(model, nodes: list | pa.Table, spark, path: str | None = None):
    """The model with other nodes, by way of the form in which Spark stores it."""
    if path is None:
        path = scratch_dir(spark, "trees")
        model.write().save(path)
    spark.createDataFrame(nodes, _NODES).coalesce(1).write.mode("overwrite").parquet(f"{path}/data")
    return type(model).load(path)


def _on_values(model, splits: list[np.ndarray], present: list[list[int]], spark):
    """A model of bins as one of the values that were binned."""
    path = scratch_dir(spark, "trees")
    model.write().save(path)
    nodes = []
    for row in spark.read.schema(_NODES).parquet(f"{path}/data").collect():  # a node per row, some thousands
        node = row.nodeData.asDict(recursive=True)
        feature, threshold = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"]
        if threshold:
            # between two bins that rows are in: the first split that parts them
            lower = present[feature][np.searchsorted(present[feature], threshold[0]) - 1]
            node["split"]["leftCategoriesOrThreshold"] = [float(splits[feature][lower])]
        nodes.append((row.treeID, node))
    return _with_nodes(model, nodes, spark, path)


def _of(est, model, changed: dict):
    """The model with the parameters of its estimator, not those it was fitted with."""
    for param in changed:
        model.clear(model.getParam(param.name))
    return est._copyValues(model)


def _labels(df: DataFrame, label: str):
    """Rows, whether one lacks a label, and the least and largest label."""
    value = F.col(label).cast("double")
    rows, good, least, most = df.agg(F.count(F.lit(1)), F.count_if(value.isNotNull() & ~F.isnan(value)),
                                     F.min(value), F.max(value)).first()
    return rows, good < rows, least, most


# ---- boosted trees ------------------------------------------------------------

def _fit_boosted(est, df: DataFrame, per_label: bool):
    label, features, seed = est.getLabelCol(), est.getFeaturesCol(), est.getSeed()
    rows, lacking, _, _ = _labels(df, label)
    plain = not est.isSet(est.weightCol) and not est.isSet(est.validationIndicatorCol) and est.getSubsamplingRate() == 1.0
    if rows <= SPARK_ROWS or not plain or lacking:
        return JavaEstimator._fit(est, df)
    spark = df.sparkSession
    splits = candidate_splits(df, features, rows, est.getMaxBins(), seed)
    names = _bin_names(splits)
    keys = [*names, "label"] if per_label else names
    cells = binned(df, label, features, splits).groupBy(*keys).agg(
        F.count(F.lit(1)).cast("double").alias("weight"), *([] if per_label else [F.avg("label").alias("label")]))
    cells = materialize(cells.select(array_to_vector(F.array(*[F.col(n).cast("double") for n in names])).alias(features),
                                     *names, F.col("label").alias(label), F.col("weight").alias(_WEIGHT)), "cells")
    count, *present = cells.agg(F.count(F.lit(1)), *[F.sort_array(F.collect_set(n)) for n in names]).first()
    # enough bins that Spark reads every cell for its splits, which then lie between all bins
    on_cells = {est.weightCol: _WEIGHT, est.maxBins: max(est.getMaxBins(), math.isqrt(count) + 1)}
    model = JavaEstimator._fit(est.copy(on_cells), cells.select(features, label, _WEIGHT))
    return _of(est, _on_values(model, splits, present, spark), on_cells)


class BinnedGBTRegressor(GBTRegressor):
    def _fit(self, dataset):
        return _fit_boosted(self, dataset, per_label=False)


class BinnedGBTClassifier(GBTClassifier):
    def _fit(self, dataset):
        return _fit_boosted(self, dataset, per_label=True)


# ---- forests ------------------------------------------------------------------

def _poisson_table() -> np.ndarray:
    """Counts with mean one for 16 even bits."""
    p = np.array([math.exp(-1) / math.factorial(k) for k in range(12)])
    return np.searchsorted(np.cumsum(p), (np.arange(_DRAWS) + 0.5) / _DRAWS).astype(np.float64)


def _draw(seed: int, tree: int, chunk: int, weights: np.ndarray | None, n: int, table: np.ndarray) -> np.ndarray:
    """How often a tree drew every row of a chunk; the same in every pass.  A
    row that stands for several is drawn as often as all of them together."""
    rng = np.random.Generator(np.random.SFC64([seed & 0xFFFFFFFF, tree, chunk]))
    if weights is None:
        return table[rng.integers(0, _DRAWS, n, dtype=np.uint16)]
    return rng.poisson(weights).astype(np.float64)


def _chunked(rows: DataFrame, names: list[str], parts: int) -> DataFrame:
    """Sorted rows in chunks: the bins by feature, the labels, and how many
    rows each stands for (nothing, if one)."""
    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk, held, count = TaskContext.get().partitionId() << 24, [], 0

        def packed():
            t = pa.Table.from_batches(held)
            bins = np.stack([t[n].to_numpy() for n in names]).astype(np.uint16)
            weights = t["weight"].to_numpy().astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([bins.tobytes()], pa.binary()),
                 pa.array([t["label"].to_numpy().astype(np.float64).tobytes()], pa.binary()),
                 pa.array([b"" if (weights == 1).all() else weights.tobytes()], pa.binary())],
                names=["chunk", "bins", "label", "weight"])

        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= CHUNK_ROWS:
                yield packed()
                chunk, held, count = chunk + 1, [], 0
        if count:
            yield packed()

    spark = rows.sparkSession
    chunks = (rows.repartition(parts, *names).sortWithinPartitions(*names, "label")
              .mapInArrow(pack, "chunk bigint, bins binary, label binary, weight binary"))
    path = scratch_dir(spark, "chunks")
    # small row groups: a reader holds one at a time
    chunks.repartition(spark.sparkContext.defaultParallelism).write.option("parquet.block.size", 8 << 20).parquet(path)
    return spark.read.schema(chunks.schema).parquet(path)


class _Tree:
    """Nodes in heap order: the feature asked (-1: none yet, or a leaf), the
    bin up to which rows go left, and the sums over the drawn rows."""

    def __init__(self, depth: int, channels: int):
        size = (1 << (depth + 1)) - 1
        self.feature = np.full(size, -1, np.int64)
        self.bin = np.zeros(size, np.int64)
        self.gain = np.zeros(size)
        self.sums = np.zeros((channels, size))


def _level_sums(chunks, trees, level: int, open_nodes, subsets, width: int, channels: int, features: int, seed: int,
                bootstrap: bool):
    """Sums per (open node, offered feature, bin) of every tree, over the
    chunks of a task."""
    table = _poisson_table()
    sums = {}
    for row in chunks:
        y = np.frombuffer(row.label)
        bins = np.frombuffer(row.bins, np.uint16).reshape(features, len(y))
        weights = np.frombuffer(row.weight, np.int64) if row.weight else None
        every = np.ones(len(y)) if weights is None else weights.astype(np.float64)
        first = np.flatnonzero(np.r_[True, (bins[:, 1:] != bins[:, :-1]).any(axis=0)])
        cells, flat = len(first), bins[:, first].ravel().astype(np.int64)
        for t, nodes in open_nodes.items():
            drawn = _draw(seed, t, row.chunk, weights, len(y), table) if bootstrap else every
            per_cell = [np.add.reduceat(drawn, first)]
            for _ in range(1, channels):
                drawn = drawn * y
                per_cell.append(np.add.reduceat(drawn, first))
            feature, below = trees[t]
            at = np.flatnonzero(per_cell[0])
            node = np.zeros(len(at), np.int64)
            for _ in range(level):
                f = feature[node]
                if (f < 0).any():
                    going = f >= 0
                    at, node, f = at[going], node[going], f[going]
                node = 2 * node + 1 + (flat[f * cells + at] > below[node])
            place = np.searchsorted(nodes, node)
            place[place == len(nodes)] = 0
            going = nodes[place] == node
            if not going.all():
                at, place = at[going], place[going]
            offered = subsets[t]
            m = offered.shape[1]
            if t not in sums:
                sums[t] = np.zeros((channels, len(nodes) * m * width))
            values = [c[at] for c in per_cell]
            for s in range(m):
                key = (place * m + s) * width + flat[offered[place, s] * cells + at]
                for c in range(channels):
                    sums[t][c] += np.bincount(key, values[c], len(nodes) * m * width)
    return list(sums.items())


def _best_splits(sums: np.ndarray, offered: np.ndarray, width: int):
    """For every open node the offered feature and bin of the largest gain in
    variance (of a 0/1 label: half that in Gini), the gain, and the sums of
    the rows that go left and of all."""
    nodes, m = offered.shape
    left = np.cumsum(sums.reshape(-1, nodes, m, width), axis=3)
    whole = left[:, :, :1, -1:]
    n, n_left = whole[0], left[0]
    n_right = n - n_left
    with np.errstate(divide="ignore", invalid="ignore"):
        apart = left[1] / n_left - (whole[1] - left[1]) / n_right
        gain = np.where((n_left > 0) & (n_right > 0), n_left * n_right / (n * n) * apart * apart, 0.0)
        # what is left of equal labels is rounding
        gain[gain <= 1e-20 * (whole[1] / n) ** 2] = 0.0
    best = gain.reshape(nodes, -1).argmax(axis=1)
    i = np.arange(nodes)
    slot, b = best // width, best % width
    return offered[i, slot], b, gain[i, slot, b], left[:, i, slot, b], whole[:, i, 0, 0]


def grow(chunks: DataFrame, trees: int, depth: int, features: int, offer: int, width: int, channels: int, seed: int,
         bootstrap: bool, parts: int) -> list[_Tree]:
    """The trees, a level of all of them at a time (of as many as a task's
    sums have room for)."""
    sc = chunks.sparkSession.sparkContext
    forest = [_Tree(depth, channels) for _ in range(trees)]
    pending = {t: np.array([0]) for t in range(trees)}
    for level in range(depth):
        grown, todo = {}, list(pending)
        while todo:
            group, held = {}, 0
            while todo and (not group or held + 8 * channels * len(pending[todo[0]]) * offer * width <= SUM_BYTES):
                t = todo.pop(0)
                group[t] = pending[t]
                held += 8 * channels * len(pending[t]) * offer * width
            subsets = {t: np.random.default_rng([seed & 0xFFFFFFFF, t, level]).random((1 << level, features))
                       .argsort(axis=1, kind="stable")[nodes - ((1 << level) - 1), :offer] for t, nodes in group.items()}
            known = sc.broadcast(({t: (forest[t].feature, forest[t].bin) for t in group}, group, subsets))

            def summed(rows):
                so_far, nodes, offered = known.value
                return _level_sums(rows, so_far, level, nodes, offered, width, channels, features, seed, bootstrap)

            def decided(item):
                return item[0], _best_splits(item[1], known.value[2][item[0]], width)

            found = chunks.rdd.mapPartitions(summed).reduceByKey(np.add, min(len(group), parts)).map(decided).collect()
            known.destroy()
            for t, (feature, b, gain, left, whole) in found:
                tree, nodes = forest[t], group[t]
                tree.sums[:, nodes] = whole
                split = gain > 0
                at = nodes[split]
                tree.feature[at], tree.bin[at], tree.gain[at] = feature[split], b[split], gain[split]
                tree.sums[:, 2 * at + 1] = left[:, split]
                tree.sums[:, 2 * at + 2] = whole[:, split] - left[:, split]
                children = np.sort(np.r_[2 * at + 1, 2 * at + 2])
                # a single drawn row cannot be parted
                children = children[tree.sums[0, children] > 1]
                if len(children):
                    grown[t] = children
        pending = grown
    return forest


def _nodes(forest: list[_Tree], splits: list[np.ndarray], classes: bool) -> pa.Table:
    """The nodes as Spark stores them, numbered with parents before children."""
    thresholds = np.zeros((len(splits), max(len(s) for s in splits) + 1))
    for i, s in enumerate(splits):
        thresholds[i, :len(s)] = s
    tables = []
    for t, tree in enumerate(forest):
        with np.errstate(invalid="ignore"):  # nodes that were never reached
            every = tree.sums[1] / tree.sums[0]
        predicts = (every > 0.5) if classes else every
        # as Spark does: leaves of one parent that predict the same are one leaf
        for node in np.flatnonzero(tree.feature >= 0)[::-1]:
            left, right = 2 * node + 1, 2 * node + 2
            if tree.feature[left] < 0 and tree.feature[right] < 0 and predicts[left] == predicts[right]:
                tree.feature[node] = -1
        kept = np.zeros(len(tree.feature), bool)
        kept[0] = True
        inner = np.flatnonzero(tree.feature >= 0)
        kept[2 * inner + 1] = kept[2 * inner + 2] = True
        number, at = np.cumsum(kept, dtype=np.int32) - 1, np.flatnonzero(kept)
        feature = tree.feature[at]
        splits_here = feature >= 0
        n, s, *q = tree.sums[:, at]
        mean = every[at]
        stats = np.stack([n - s, s] if classes else [n, s, q[0]], axis=1)
        impurity = 2 * mean * (1 - mean) if classes else np.maximum(q[0] / n - mean * mean, 0.0)
        child = np.where(splits_here, 2 * at + 1, 0)
        ints = {"leftChild": np.where(splits_here, number[child], -1), "rightChild": np.where(splits_here, number[child + splits_here], -1)}
        split = pa.StructArray.from_arrays(
            [pa.array(feature, pa.int32()),
             pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(splits_here)], pa.int32()),
                                      pa.array(thresholds[feature[splits_here], tree.bin[at][splits_here]])),
             pa.array(np.full(len(at), -1), pa.int32())],
            names=["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
        node = pa.StructArray.from_arrays(
            [pa.array(number[at], pa.int32()), pa.array(predicts[at].astype(float)), pa.array(impurity),
             pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * stats.shape[1], pa.int32()), pa.array(stats.ravel())),
             pa.array(n.astype(np.int64)), pa.array(np.where(splits_here, tree.gain[at] * (2 if classes else 1), -1.0)),
             *[pa.array(v, pa.int32()) for v in ints.values()], split],
            names=["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", *ints, "split"])
        tables.append(pa.table({"treeID": pa.array(np.full(len(at), t), pa.int32()), "nodeData": node}))
    return pa.concat_tables(tables)


def _offered(strategy: str, features: int, trees: int, classes: bool) -> int:
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt" if classes else "onethird"
    return {"all": features, "sqrt": math.ceil(math.sqrt(features)), "onethird": math.ceil(features / 3),
            "log2": max(1, math.ceil(math.log2(features)))}.get(strategy, 0)


def _fit_forest(est, df: DataFrame, classes: bool):
    label, features, seed = est.getLabelCol(), est.getFeaturesCol(), est.getSeed()
    rows, lacking, least, most = _labels(df, label)
    plain = (not est.isSet(est.weightCol) and est.getSubsamplingRate() == 1.0
             and est.getMinInfoGain() == 0.0 and est.getMinInstancesPerNode() == 1
             and est.getMinWeightFractionPerNode() == 0.0 and not (classes and est.isSet(est.thresholds)))
    if rows <= SPARK_ROWS or lacking or not plain or (classes and (least, most) != (0.0, 1.0)):
        return JavaEstimator._fit(est, df)
    splits = candidate_splits(df, features, rows, est.getMaxBins(), seed)
    offer = _offered(est.getFeatureSubsetStrategy(), len(splits), est.getNumTrees(), classes)
    if not offer:
        return JavaEstimator._fit(est, df)
    spark = df.sparkSession
    names = _bin_names(splits)
    points = binned(df, label, features, splits)
    # rows with the same bins and class are one row with a weight; labels that are numbers stay single
    points = (points.groupBy(*names, "label").agg(F.count(F.lit(1)).alias("weight")) if classes
              else points.withColumn("weight", F.lit(1).cast("bigint")))
    parallelism = spark.sparkContext.defaultParallelism
    chunks = _chunked(points, names, max(parallelism, rows // 500_000))
    forest = grow(chunks, est.getNumTrees(), est.getMaxDepth(), len(splits), offer, max(len(s) for s in splits) + 1,
                  2 if classes else 3, seed, est.getBootstrap(), parallelism)
    # Spark's own forest of no depth lends the form of the model
    ends = spark.createDataFrame([(v, Vectors.dense([v] * len(splits))) for v in (0.0, 1.0)], [label, features])
    no_depth = {est.maxDepth: 0}
    stub = JavaEstimator._fit(est.copy(no_depth), ends)
    return _of(est, _with_nodes(stub, _nodes(forest, splits, classes), spark), no_depth)


class BinnedForestRegressor(RandomForestRegressor):
    def _fit(self, dataset):
        return _fit_forest(self, dataset, classes=False)


class BinnedForestClassifier(RandomForestClassifier):
    def _fit(self, dataset):
        return _fit_forest(self, dataset, classes=True)
