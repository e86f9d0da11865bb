"""Quality classifier: a generalised additive model with pairwise interactions.

Per-feature lookup tables are learnt by cyclic boosting: in each round every
feature in turn gets a shallow tree (up to three leaves) over its bins, fitted
to the current gradients, and a small step of it is added to the table.  The
pairs of features whose four-leaf trees explain most of what is left are then
boosted in the same way into two-way tables.  Scoring adds table entries by
bin, vectorised over documents.

The tables are fitted on the driver from a bounded sample: at most ``SAMPLE``
labelled documents, those with the smallest hash of the id, as numbers, never
texts.  Everything else runs in tasks over all documents.

Defined results: a null text counts as empty and is scored like one; null
labels are ignored, and of several labels of a document the lowest counts;
without labels every score is 0.5; only the text enters a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.llm import spans
from smelter.llm.common import one_text_each

#: Bound on the labelled documents that are learnt from.
SAMPLE = 20_000
BINS, PAIR_BINS, PAIRS, ROUNDS, PAIR_ROUNDS, RATE = 32, 8, 6, 120, 60, 0.15

FEATURES = ("words", "word_bytes", "letters", "upper", "digits", "symbols", "marks", "line_words",
            "repeated_lines", "repeated_words", "repeated_triples", "distinct_words", "echoes",
            "short_words", "lower_words", "stops")

#: The symbols counted as junk marks, and sentence marks.
_SYMBOLS, _MARKS, _STOPS = b"#*$%&|<>", b"!?;:", b".,"


def _member(values: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(values)] = True
    return table


_IS_UPPER, _IS_DIGIT = _member(bytes(range(65, 91))), _member(bytes(range(48, 58)))
_IS_LETTER = _member(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
_IS_SYMBOL, _IS_MARK, _IS_STOP = _member(_SYMBOLS), _member(_MARKS), _member(_STOPS)


def _repeats(keys: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: entries equal to another entry of the row, and distinct ones."""
    if not len(keys):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((keys, rows))
    k, r = keys[order], rows[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (r[1:] != r[:-1])
    size = np.diff(np.append(np.flatnonzero(new), len(k)))
    return (spans.per_row(r[new], n, np.where(size > 1, size, 0).astype(float)), spans.per_row(r[new], n).astype(float))


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows x FEATURES: sizes on a log scale, everything else a share."""
    n = len(offsets) - 1
    begin, end = spans.word_runs(data, offsets)
    rows = spans.owner(begin, offsets)
    words = spans.per_row(rows, n)
    sums = lambda table: np.diff(np.concatenate([[0], np.cumsum(table[data])])[offsets])
    letters, size = sums(_IS_LETTER), np.maximum(np.diff(offsets), 1)
    some = np.maximum(words, 1)
    hashes = spans.RangeHash(data).of(begin, end)
    line_begin, line_end = spans.runs(data != 10, offsets)
    line_rows = spans.owner(line_begin, offsets)
    lines = spans.per_row(line_rows, n)
    repeated_lines, _ = _repeats(spans.RangeHash(data).of(line_begin, line_end), line_rows, n)
    repeated_words, distinct = _repeats(hashes, rows, n)
    near = rows[2:] == rows[:-2] if len(rows) > 2 else np.zeros(0, bool)
    triples = spans.mixed(hashes[:-2] * np.uint64(3) + hashes[1:-1] * np.uint64(5) + hashes[2:] * np.uint64(7))[near] \
        if len(rows) > 2 else np.zeros(0, np.uint64)
    repeated_triples, _ = _repeats(triples, rows[:-2][near] if len(rows) > 2 else rows[:0], n)
    echo = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    first = data[begin] if len(begin) else np.zeros(0, np.uint8)
    last = data[end - 1] if len(end) else np.zeros(0, np.uint8)
    return np.stack([
        np.log1p(words), np.log1p((sums(~spans.BREAK)) / some), letters / size, sums(_IS_UPPER) / np.maximum(letters, 1),
        sums(_IS_DIGIT) / size, sums(_IS_SYMBOL) / size, sums(_IS_MARK) / size, np.log1p(words / np.maximum(lines, 1)),
        repeated_lines / np.maximum(lines, 1), repeated_words / some, repeated_triples / some, distinct / some,
        spans.per_row(rows[1:][echo], n) / some, spans.per_row(rows[end - begin <= 3], n) / some,
        spans.per_row(rows[(first >= 97) & (first <= 122)], n) / some, spans.per_row(rows[_IS_STOP[last]], n) / some], 1)


def _leaf(gradient, hessian):
    return gradient / (hessian + 1.0)


def _gain(gradient, hessian):
    return gradient * gradient / (hessian + 1.0)


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """The best place to cut a run of bins in two, and what it gains."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    best = int(np.argmax(gain))
    return float(gain[best]), best + 1


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values of a tree with up to three leaves over one feature's bins."""
    gain, at = _cut(g, h)
    if gain <= 1e-9:
        return np.full(len(g), _leaf(g.sum(), h.sum()))
    left, right = _cut(g[:at], h[:at]), _cut(g[at:], h[at:])
    edges = sorted({0, at, len(g), left[1] if left[0] >= right[0] and left[0] > 1e-9 else
                    at + right[1] if right[0] > 1e-9 else at})
    out = np.empty(len(g))
    for a, b in zip(edges, edges[1:], strict=False):
        out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return out


def _quad(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best four-leaf tree (one cut on each axis) over a table of bins."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

    def corners(c):
        a = c[:-1, :-1]
        b, d = c[:-1, -1:] - a, c[-1:, :-1] - a
        return a, b, d, c[-1, -1] - a - b - d

    parts = list(zip(corners(cg), corners(ch), strict=True))
    gain = sum(_gain(x, y) for x, y in parts) - _gain(cg[-1, -1], ch[-1, -1])
    i, j = np.unravel_index(np.argmax(gain), gain.shape)
    out = np.empty_like(g)
    for k, (rows, cols) in enumerate(((slice(0, i + 1), slice(0, j + 1)), (slice(0, i + 1), slice(j + 1, None)),
                                      (slice(i + 1, None), slice(0, j + 1)), (slice(i + 1, None), slice(j + 1, None)))):
        out[rows, cols] = _leaf(parts[k][0][i, j], parts[k][1][i, j])
    return float(gain[i, j]), out


class AdditiveModel:
    """Bin edges, one table per feature and one per chosen pair."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        y = y.astype(float)
        self.base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        ranks = np.arange(1, BINS) / BINS
        self.edges = [np.unique(np.quantile(c, ranks)) if len(c) else np.zeros(0) for c in x.T] if len(x) else \
            [np.zeros(0)] * x.shape[1]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: dict[tuple[int, int], np.ndarray] = {}
        self.coarse = [np.minimum((np.arange(len(t)) * PAIR_BINS) // len(t), PAIR_BINS - 1) for t in self.tables]
        if 0 < y.sum() < len(y):
            self._boost(self._bins(x), y)

    def _bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, c, "right") for e, c in zip(self.edges, x.T, strict=True)]

    def _boost(self, bins: list[np.ndarray], y: np.ndarray) -> None:
        score = np.full(len(y), self.base)

        def sums(cell, size):
            p = 1 / (1 + np.exp(-score))
            return np.bincount(cell, y - p, size), np.bincount(cell, p * (1 - p), size)

        for _ in range(ROUNDS):
            for table, cell in zip(self.tables, bins, strict=True):
                step = RATE * _tree(*sums(cell, len(table)))
                table += step
                score += step[cell]
        coarse = [c[b] for c, b in zip(self.coarse, bins, strict=True)]
        shape = (PAIR_BINS, PAIR_BINS)
        cells = {(i, j): coarse[i] * PAIR_BINS + coarse[j] for i in range(len(bins)) for j in range(i)}

        def quad(cell):
            return _quad(*(s.reshape(shape) for s in sums(cell, PAIR_BINS * PAIR_BINS)))

        chosen = sorted(cells, key=lambda k: -quad(cells[k])[0])[:PAIRS]
        self.pairs = {k: np.zeros(shape) for k in chosen}
        for _ in range(PAIR_ROUNDS):
            for k, table in self.pairs.items():
                step = RATE * quad(cells[k])[1]
                table += step
                score += step.ravel()[cells[k]]

    def score(self, x: np.ndarray) -> np.ndarray:
        bins = self._bins(x)
        total = np.full(len(x), self.base)
        for table, cell in zip(self.tables, bins, strict=True):
            total += table[cell]
        for (i, j), table in self.pairs.items():
            total += table[self.coarse[i][bins[i]], self.coarse[j][bins[j]]]
        return 1 / (1 + np.exp(-total))


def _texts(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(docs[id].alias("id"), F.coalesce(docs[text].cast("string"), F.lit("")).cast("binary").alias("text"))


def labelled_sample(labels: DataFrame, id: str = "doc_id", label: str = "quality", most: int = SAMPLE) -> DataFrame:
    """At most ``most`` (id, label) rows, those with the smallest hash of the id."""
    one = labels.where(labels[id].isNotNull() & labels[label].isNotNull())
    one = one.groupBy(one[id].alias("label_id")).agg(F.min(one[label].cast("int")).alias("label"))
    return one.orderBy(F.xxhash64("label_id"), "label_id").limit(most)


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality",
        most: int = SAMPLE) -> AdditiveModel:
    sample = labelled_sample(labels, id, label, most)
    rows = _texts(docs, id, text).join(F.broadcast(sample), F.col("id") == F.col("label_id"))

    def measure(batches):
        for batch in batches:
            for row, data, offsets in spans.slices(batch, "text"):
                found = features(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").slice(row, len(found)), pa.array(found.tolist(), pa.list_(pa.float64()))], ["label", "x"])

    rows = one_text_each(rows, "label_id", "label")  # an id that many rows have counts once
    got = rows.select("text", "label").mapInArrow(measure, "label int, x array<double>").collect()
    got.sort(key=lambda r: (r["x"], r["label"]))  # the order of tasks does not matter
    x = np.array([r["x"] for r in got], float).reshape(-1, len(FEATURES))
    return AdditiveModel(x, np.array([r["label"] > 0 for r in got], bool))


def predict(docs: DataFrame, model: AdditiveModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id and score (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = _texts(docs, id, text)
    schema = T.StructType([rows.schema["id"], T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in batches:
            for row, data, offsets in spans.slices(batch, "text"):
                score = shared.value.score(features(data, offsets))
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(row, len(score)), pa.array(score)], ["id", "score"])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id)


def keep_good(docs: DataFrame, model: AdditiveModel, text: str = "text", least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``least``, columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts = pa.compute.fill_null(batch.column(text), "") if batch.num_rows else batch.column(text)
            good = [shared.value.score(features(data, offsets)) >= least
                    for _, data, offsets in spans.slices(pa.RecordBatch.from_arrays([texts], [text]), text)]
            yield batch.filter(pa.array(np.concatenate(good))) if good else batch

    return docs.mapInArrow(run, docs.schema)
