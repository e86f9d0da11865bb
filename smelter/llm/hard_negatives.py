"""Hard negatives by a multiway hyperplane tree with distance ranges.

A node of the tree has up to ``FANOUT`` split points; a vector belongs to the
child of its nearest one, so children are divided by the hyperplanes between
split points.  For every child the tree knows the least and greatest distance
of its vectors from each split point of the node, the child's own and its
siblings', and the range of their norms.  The tree's shape comes from a bounded
sample (``SAMPLE_ROWS``); the ranges come from all rows, which are all indexed.

A search looks for scores (inner products) in a window.  With the norms of a
child, the window is an annulus of distances around the anchor; a child whose
range from any split point does not meet that annulus, seen from there, holds
no row of the window and is dropped with all below it.  In the leaves that
remain every row is scored, so results are exact.  Windows are narrow from the
start: the sample's own best scores are a lower bound for the best of all.

Rows are dealt by (leaf, slice), slices having about ``BLOCK_ROWS`` rows, and
anchors are sent to the slices of the leaves that they cannot do without.  A
task holds one slice and some anchors at a time.  Of equal vectors with one
label only the ``KEPT`` least ids can be among the first ones of any list, so a
hot vector has no large leaf.

Defined results: rows with a null id, label or vector, or a null, NaN or
infinite component take no part; of rows with one id the least (label, vector)
counts; a shorter vector counts as padded with zeros; ties go to the smaller
id; other columns take no part; scores that do not fit a long raise an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smelter.llm.common import stored

FANOUT, LEAF_ROWS, BLOCK_ROWS = 16, 1000, 1024
#: The sample that shapes the tree: rows with the least hash of the id.
SAMPLE_ROWS, SAMPLE_BYTES = 20_000, 16 << 20
POSITIVES, NEGATIVES, KEPT = 5, 5, 6
#: A negative's score is at least this many hundredths of the positive's.
LEAST_SHARE = 80
SCALE = 256
#: Anchors scored against a slice at a time.
ANCHORS_AT_A_TIME = 256
_FAR = (1 << 63) - 1


# ---- vectors ---------------------------------------------------------------------

def whole_vectors(rows: DataFrame, id: str, vector: str, label: str | Column) -> DataFrame:
    """(id, label, vec): int32 components, one row per id."""
    label = (rows[label] if isinstance(label, str) else label).cast("string")
    v = rows[vector].cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.select(rows[id].cast("long").alias("id"), label.alias("label"), v.alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(fine, F.lit(False)))
    dim = rows.agg(F.max(F.size("v"))).first()[0] or 0

    def pack(batches):
        for batch in batches:
            lists = batch.column("v")
            sizes = np.diff(lists.offsets.to_numpy())
            whole = np.floor(SCALE * lists.flatten().to_numpy(zero_copy_only=False))
            if len(whole) and np.abs(whole).max() >= 1 << 31:
                raise ValueError("a component is too large for whole-number scores")
            out = np.zeros((len(sizes), dim), np.int32)
            row = np.repeat(np.arange(len(sizes)), sizes)
            out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = whole
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"),
                                              pa.array([r.tobytes() for r in out], pa.binary())], ["id", "label", "vec"])

    packed = rows.mapInArrow(pack, "id long, label string, vec binary")
    return packed.groupBy("id").agg(F.min(F.struct("label", "vec")).alias("row")).select("id", "row.label", "row.vec")


def _matrix(column) -> np.ndarray:
    values = column.to_pylist() if not isinstance(column, list) else column
    wide = len(values[0]) // 4 if values else 0
    return np.frombuffer(b"".join(values), np.int32).reshape(len(values), wide).astype(np.float64)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole-number inner products, exact."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if most < 1 << 53:
        return (a @ b.T).astype(np.int64)
    if most >= _FAR:
        raise ValueError("scores do not fit a long")
    return a.astype(np.int64) @ b.astype(np.int64).T


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


# ---- the tree --------------------------------------------------------------------

class Tree:
    """Nodes of split points; a child is a node (its number) or a leaf (its
    number's complement)."""

    def __init__(self, sample: np.ndarray, rows: int, seed: int = 7):
        self.points: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        rng, share = np.random.default_rng(seed), rows / max(len(sample), 1)
        self.root = self._grow(sample, share, rng)

    def _grow(self, rows: np.ndarray, share: float, rng) -> int:
        splits = self._split(rows, rng) if len(rows) > FANOUT and len(rows) * share > LEAF_ROWS else []
        if len(splits) < 2:
            self.leaves += 1
            return ~(self.leaves - 1)
        points, node = rows[splits], len(self.points)
        self.points.append(points)
        self.children.append([])
        near = _distances(rows, points).argmin(1)
        self.children[node] = [self._grow(rows[near == j], share, rng) for j in range(len(points))]
        return node

    def _split(self, rows: np.ndarray, rng) -> list[int]:
        """Rows far from each other, out of three times as many drawn ones."""
        drawn = rng.choice(len(rows), min(3 * FANOUT, len(rows)), replace=False)
        chosen = [int(drawn[0])]
        least = _distances(rows[drawn], rows[chosen])[:, 0]
        while len(chosen) < FANOUT and least.max() > 0:
            chosen.append(int(drawn[least.argmax()]))
            least = np.minimum(least, _distances(rows[drawn], rows[chosen[-1:]])[:, 0])
        return chosen

    def place(self, rows: np.ndarray, visit=None) -> np.ndarray:
        """The leaf of every row; ``visit(node, child, rows' indices, distances)``
        is told of every step down."""
        out, todo = np.zeros(len(rows), np.int64), [(self.root, np.arange(len(rows)))]
        while todo:
            node, at = todo.pop()
            if node < 0:
                out[at] = ~node
                continue
            far = _distances(rows[at], self.points[node])
            near = far.argmin(1)
            for j in np.unique(near).tolist():
                mine = near == j
                if visit:
                    visit(node, j, at[mine], far[mine])
                todo.append((self.children[node][j], at[mine]))
        return out

    def set_ranges(self, found) -> None:
        """From rows (node, child, point, lo, hi, norm_lo, norm_hi)."""
        k = [len(p) for p in self.points]
        self.lo = [np.full((n, n), np.inf) for n in k]
        self.hi = [np.full((n, n), -np.inf) for n in k]
        self.norms = [np.full((n, 2), np.nan) for n in k]
        for r in found:
            self.lo[r["node"]][r["child"], r["point"]] = r["lo"]
            self.hi[r["node"]][r["child"], r["point"]] = r["hi"]
            self.norms[r["node"]][r["child"]] = r["norm_lo"], r["norm_hi"]

    def reach(self, anchors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(anchor, leaf) of all leaves that may hold a row whose score with
        the anchor is from lo to hi."""
        norm = (anchors * anchors).sum(1)
        out, todo = [], [(self.root, np.arange(len(anchors)))]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            if node < 0:
                out.append((at, np.full(len(at), ~node)))
                continue
            n_lo, n_hi = self.norms[node][:, 0], self.norms[node][:, 1]
            slack = 1e-6 * (1 + np.sqrt(norm[at])[:, None] + n_hi)
            # the annulus of the window around the anchor, for each child
            inner = np.sqrt(np.maximum(norm[at][:, None] + n_lo ** 2 - 2 * hi[at][:, None], 0)) - slack
            outer2 = norm[at][:, None] + n_hi ** 2 - 2 * lo[at][:, None]
            outer = np.sqrt(np.maximum(outer2, 0)) + slack
            away = _distances(anchors[at], self.points[node])
            # its distances from split point i, against child j's range from i
            least = np.maximum(away[:, None, :] - outer[:, :, None], inner[:, :, None] - away[:, None, :])
            most = away[:, None, :] + outer[:, :, None]
            ok = ((least <= self.hi[node]) & (most >= self.lo[node])).all(2) & (outer2 >= -slack) & ~np.isnan(n_lo)
            todo += [(child, at[ok[:, j]]) for j, child in enumerate(self.children[node])]
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


class Index:
    """All rows dealt to the leaves of one tree, and the sample's vectors."""

    def __init__(self, rows: DataFrame):
        spark = rows.sparkSession
        per_copy = Window.partitionBy("label", "vec").orderBy("id")
        kept = stored(rows.withColumn("copy", F.row_number().over(per_copy)).where(F.col("copy") <= KEPT).drop("copy"), "vectors")
        total = kept.count()
        one = kept.select("vec").head()
        most = min(SAMPLE_ROWS, SAMPLE_BYTES // max(8 * len(one["vec"]) // 4, 1)) if one else 0
        taken = kept.orderBy(F.xxhash64("id"), "id").limit(most).collect() if one else []
        self.ids = np.array([r["id"] for r in taken], np.int64)
        self.labels = np.array([r["label"] for r in taken], object)
        self.sample = _matrix([bytes(r["vec"]) for r in taken])
        self.tree = Tree(self.sample, total)
        both = stored(self._placed(kept), "leaves")
        ranges = both.where("node is not null").groupBy("node", "child", "point").agg(
            F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("norm_lo").alias("norm_lo"), F.max("norm_hi").alias("norm_hi"))
        self.tree.set_ranges(ranges.toLocalIterator())  # as many rows as the tree has pairs of siblings
        rows = both.where("node is null").select("leaf", "id", "label", "vec")
        # at most as many leaves as rows in the sample
        sizes = rows.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("slices")).collect()
        self.slices = F.broadcast(spark.createDataFrame([(r["leaf"], r["slices"]) for r in sizes], "leaf int, slices int"))
        slice_of = F.pmod(F.xxhash64("id"), F.col("slices")).cast("int")
        self.rows = rows.join(self.slices, "leaf").withColumn("slice", slice_of).drop("slices")

    def _placed(self, rows: DataFrame) -> DataFrame:
        """Rows with their leaf, and each task's share of the ranges."""
        shared = rows.sparkSession.sparkContext.broadcast(self.tree)
        names = ["leaf", "id", "label", "vec", "node", "child", "point", "lo", "hi", "norm_lo", "norm_hi"]
        kinds = [pa.int32(), pa.int64(), pa.string(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), *[pa.float64()] * 4]

        def run(batches):
            tree, seen = shared.value, {}
            for batch in batches:
                vectors = _matrix(batch.column("vec"))
                norms = np.sqrt((vectors * vectors).sum(1))

                def visit(node, child, at, far, norms=norms):
                    now = (far.min(0), far.max(0), norms[at].min(), norms[at].max())
                    was = seen.get((node, child), now)
                    seen[node, child] = tuple(f(a, b) for f, a, b in zip((np.minimum, np.maximum, min, max), was, now, strict=True))

                leaf = tree.place(vectors, visit)
                none = [pa.nulls(len(leaf), k) for k in kinds[4:]]
                yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), *(batch.column(c) for c in names[1:4]), *none], names)
            for (node, child), (lo, hi, norm_lo, norm_hi) in seen.items():
                k = len(lo)
                columns = [[None] * k] * 4 + [[node] * k, [child] * k, list(range(k)), lo.tolist(), hi.tolist(), [float(norm_lo)] * k, [float(norm_hi)] * k]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        return rows.select("id", "label", "vec").mapInArrow(run, (
            "leaf int, id long, label string, vec binary, node int, child int, point int, "
            "lo double, hi double, norm_lo double, norm_hi double"))

    # ---- searches ------------------------------------------------------------------

    def first(self, anchors: DataFrame, many: int, same: bool) -> DataFrame:
        """(id, window, other, score): for each anchor (id, label, vec, los,
        his) and each of its windows at least the first ``many`` other rows of
        the same label (or of different ones) with a score in the window."""
        routed = self._routed(anchors, many, same).join(self.slices, "leaf")
        routed = routed.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices")
        none = F.lit(None).cast("array<bigint>")
        rows = self.rows.select("leaf", "slice", F.lit(0).alias("kind"), "id", "label", "vec", none.alias("los"), none.alias("his"))
        rows = rows.union(routed.select("leaf", "slice", F.lit(1), "id", "label", "vec", "los", "his"))
        dealt = rows.repartition("leaf", "slice").sortWithinPartitions("leaf", "slice", "kind")

        def run(batches):
            at, block, have = None, [], None
            for batch in batches:
                keys = np.stack([batch.column(c).to_numpy() for c in ("leaf", "slice", "kind")], 1)
                edges = np.flatnonzero(np.any(np.diff(keys, axis=0) != 0, axis=1)) + 1
                for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(keys)], strict=True):
                    if a == b:
                        continue
                    leaf, piece, kind = keys[a].tolist()
                    part = batch.slice(a, b - a)
                    if kind == 0:
                        if (leaf, piece) != at:
                            at, block, have = (leaf, piece), [], None
                        block.append(part)
                    elif (leaf, piece) == at:
                        have = have or _Block(block)
                        for begin in range(0, len(part), ANCHORS_AT_A_TIME):
                            yield from have.best(part.slice(begin, ANCHORS_AT_A_TIME), many, same)

        return dealt.mapInArrow(run, "id long, window int, other long, score long")

    def _routed(self, anchors: DataFrame, many: int, same: bool) -> DataFrame:
        """Anchors once for each leaf they need, their windows' lower ends
        raised to what the sample has."""
        shared = anchors.sparkSession.sparkContext.broadcast((self.tree, self.sample, self.ids, self.labels))

        def run(batches):
            tree, sample, ids, labels = shared.value
            for whole in batches:
                for begin in range(0, len(whole), ANCHORS_AT_A_TIME):
                    batch = whole.slice(begin, ANCHORS_AT_A_TIME)
                    vectors, los, his = _matrix(batch.column("vec")), batch.column("los").to_pylist(), batch.column("his").to_pylist()
                    scores = _scores(vectors, sample)
                    for k, (own, label) in enumerate(zip(batch.column("id").to_pylist(), batch.column("label").to_pylist(), strict=True)):
                        fits = scores[k][(labels == label) == same] if not same else scores[k][(labels == label) & (ids != own)]
                        for w, (lo, hi) in enumerate(zip(los[k], his[k], strict=True)):
                            inside = fits[(fits >= lo) & (fits <= hi)]
                            if len(inside) >= many:
                                los[k][w] = int(np.partition(inside, len(inside) - many)[len(inside) - many])
                    lo = np.array([min(x) for x in los], float)
                    hi = np.array([max(x) for x in his], float)
                    anchor, leaf = tree.reach(vectors, lo, hi)
                    order = np.argsort(anchor, kind="stable")
                    rows = pa.array(anchor[order])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(leaf[order], pa.int32()), *(batch.column(c).take(rows) for c in ("id", "label", "vec")),
                        pa.array(los, pa.list_(pa.int64())).take(rows), pa.array(his, pa.list_(pa.int64())).take(rows)],
                        ["leaf", "id", "label", "vec", "los", "his"])

        return anchors.select("id", "label", "vec", "los", "his").mapInArrow(
            run, "leaf int, id long, label string, vec binary, los array<bigint>, his array<bigint>")


class _Block:
    """One slice of a leaf."""

    def __init__(self, parts: list[pa.RecordBatch]):
        self.ids = np.concatenate([p.column("id").to_numpy() for p in parts])
        self.vectors = np.concatenate([_matrix(p.column("vec")) for p in parts])
        self.names: dict[str, int] = {}
        labels = (self.names.setdefault(x, len(self.names)) for p in parts for x in p.column("label").to_pylist())
        self.labels = np.fromiter(labels, np.int64, len(self.ids))

    def best(self, anchors: pa.RecordBatch, many: int, same: bool):
        scores, out = _scores(_matrix(anchors.column("vec")), self.vectors), []
        for k, (own, label, los, his) in enumerate(zip(*(anchors.column(c).to_pylist() for c in ("id", "label", "los", "his")), strict=True)):
            # what is under the lowest window can be of no use
            fits = np.flatnonzero((scores[k] >= min(los)) & ((self.labels == self.names.get(label, -1)) == same))
            for w, (lo, hi) in enumerate(zip(los, his, strict=True)):
                s = scores[k][fits]
                at = fits[(s >= lo) & (s <= hi) & (self.ids[fits] != own)]
                order = np.lexsort((self.ids[at], -scores[k][at]))[:many]
                out += [(own, w, int(self.ids[i]), int(scores[k][i])) for i in at[order]]
        if out:
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                                             ["id", "window", "other", "score"])


def _ranked(found: DataFrame, many: int) -> DataFrame:
    order = Window.partitionBy("id", "window").orderBy(F.desc("score"), "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= many)


def mine(rows: DataFrame, anchors: Column, id: str = "vec_id", vector: str = "embedding", label: str | Column = "label") -> DataFrame:
    """For every anchor (rows whose ``id`` the condition ``anchors`` takes) and
    each of its first ``POSITIVES`` other rows of one label: the first
    ``NEGATIVES`` rows of other labels whose score is from ``LEAST_SHARE``
    hundredths of the positive's up to the positive's."""
    vectors = stored(whole_vectors(rows, id, vector, label), "whole-vectors")
    chosen = rows.where(anchors).select(rows[id].cast("long").alias("id")).distinct()
    asked = stored(vectors.join(chosen, "id", "left_semi"), "anchors")
    index = Index(vectors)
    every = asked.withColumns({"los": F.array(F.lit(-_FAR)), "his": F.array(F.lit(_FAR))})
    positives = stored(_ranked(index.first(every, POSITIVES, True), POSITIVES), "positives")
    # 80 p <= 100 n <= 100 p, in whole numbers
    p = F.col("score")
    least = F.ceil(p.cast("decimal(19,0)") * F.lit(LEAST_SHARE).cast("decimal(3,0)") / F.lit(100).cast("decimal(3,0)")).cast("long")
    lists = positives.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("rank", least.alias("lo"), p.alias("hi"), "other"))).alias("all"))
    wanted = asked.join(lists, "id").select("id", "label", "vec", F.col("all.lo").alias("los"), F.col("all.hi").alias("his"))
    negatives = _ranked(index.first(wanted, NEGATIVES, False), NEGATIVES)
    named = positives.select("id", (F.col("rank") - 1).alias("window"), F.col("other").alias("positive_id"), p.alias("positive_score"))
    return negatives.join(named, ["id", "window"]).select(
        F.col("id").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
