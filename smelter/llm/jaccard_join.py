"""N-gram Jaccard join with adaptive multi-match prefixes, down to classes.

Documents are sets of distinct 5-word shingles; two link when their Jaccard
similarity reaches ``SIMILARITY``.  Shingles have one global order: by class
of estimated frequency (from a counting table over all documents), then by
hash, so rare ones come first.  A document of n shingles that needs
``a = ceil(0.75 n)`` in common is indexed under the first ``n - a + l`` of
them.  Any partner then shares at least ``l`` of these, and ``l`` is chosen
for each document by estimated cost: postings read plus candidates checked,
the latter falling with ``l``.  A pair is checked only if it shares as many
prefix shingles as the sizes and prefixes of the two demand.

The steps, all Spark jobs over tables in the shared folder:

1. ``set_table``: size and digest of every document's set; equal sets become
   one node.  The same pass fills the counting table (fixed size).
2. ``postings``: prefix shingles, dealt by shingle hash into buckets of about
   ``BUCKET_POSTINGS`` as packed arrays.
3. Pivot links: every node is checked against the ``PIVOTS`` neighbours with
   which it shares most prefix shingles among its buckets' pivots, if they are
   enough; a second round does so across the classes found.  This puts a large
   group of near copies into one class, or few, at a few checks per node.
4. All other pairs: shingles with up to ``CROWD`` nodes list the pairs of
   different classes in their bucket.  The postings of crowded shingles are
   dealt anew by family (the least node that their nodes meet in crowded
   shingles) and two neighbouring bands of set sizes, in squares of two slices
   of these nodes.  There a pair's crowded
   shingles are counted all at once, and it becomes a row only if they and
   what both nodes share with others elsewhere can be enough: a large family below the
   similarity is counted in its squares, never listed.  Counts are then summed
   and pairs with enough are checked.  No link between different classes is
   lost; pairs inside a class, which cannot change it, are never listed.
5. Classes of both kinds of links; every document takes the least doc_id of
   its class.

Shingles and sets are known by 64-bit hashes; a link is decided on
the two texts' full shingle sets.

Defined results: null, empty and blank texts have no shingle and link with
nothing; a text of fewer than five words has one; equal rows are one node, and
each row gets its result; a null id is no name for a class (unless all of a
class are null).
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.llm import spans
from smelter.llm.common import keyed_texts, row_key, small_or_not, stored, unused
from smelter.llm.components import connected_components

WORDS, SIMILARITY = 5, 75
#: Cells of the counting table (two bytes each per task) and how many parts it is summed in.
CELLS, CELL_PARTS = 1 << 21, 64
#: Prefix lengthenings to choose from, and the cost of a check against one posting read.
MATCHES, CHECK_COST = (1, 2, 4, 8, 16), 20.0
#: Pivots tried for each node in a round, and the size from which runs have that many.
PIVOTS, FEW = 4, 8
#: Nodes of a shingle from which its pairs are not listed in its bucket, and
#: the sizes of the slices of a family.
CROWD, LEAST_SLICE, MOST_SLICE, SLICES = 24, 512, 4096, 4
#: Sizes of linked sets are in one band or in neighbouring ones; a little wider
#: than the similarity asks, for rounding.
BAND = 100 / SIMILARITY + 0.01
BUCKET_POSTINGS, LEAST_BUCKETS = 400_000, 128

_PLACES = np.random.default_rng(31).integers(1, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all 5-word shingles, and where each row's begin; a row with
    one to four words has a single shingle of all of them."""
    n = len(offsets) - 1
    data = spans.LOWERED[data]
    begin, end = spans.word_runs(data, offsets)
    rows = spans.owner(begin, offsets)
    words = spans.RangeHash(data).of(begin, end)
    count = spans.per_row(rows, n)
    first = np.concatenate([[0], np.cumsum(count)])
    made = np.maximum(count - WORDS + 1, np.minimum(count, 1))
    at = np.concatenate([[0], np.cumsum(made)])
    total = int(at[-1])
    # shingle k of row r starts at word first[r] + k
    row = np.repeat(np.arange(n), made)
    start = np.arange(total) - at[:-1][row] + first[:-1][row]
    long = np.minimum(count, WORDS)[row]
    out = long.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(WORDS):
        there = long > k
        out[there] += words[start[there] + k] * _PLACES[k]
    return spans.mixed(out), at


def _sets(batch: pa.RecordBatch, column: str = "text"):
    """(row, sorted distinct shingles) of every row of a batch."""
    for row, data, offsets in spans.slices(batch, column):
        found, at = shingles(data, offsets)
        for i in range(len(offsets) - 1):
            yield row + i, np.unique(found[at[i]:at[i + 1]])


def _cell(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)


def _node(tokens: np.ndarray) -> int:
    """The name of a set: equal sets have equal names."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "big", signed=True)


def set_table(texts: DataFrame) -> DataFrame:
    """Rows (id, key, n, node) per document and, with a part, rows (part,
    counts): this task's share of the counting table."""

    def run(batches):
        counts, kind = np.zeros(CELLS, np.uint32), None
        for batch in batches:
            size, node = [], []
            for _, tokens in _sets(batch):
                size.append(len(tokens))
                node.append(_node(tokens))
                np.add.at(counts, _cell(tokens), 1)
            n, kind = len(size), batch.column("id").type
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("key"), pa.array(size, pa.int64()), pa.array(node, pa.int64()),
                pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
        for part, block in enumerate(counts.reshape(CELL_PARTS, -1)):
            if block.any():
                yield pa.RecordBatch.from_arrays([
                    pa.nulls(1, kind), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
                    pa.array([part], pa.int32()), pa.array([_packed(block)], pa.binary())], names)

    names = ["id", "key", "n", "node", "part", "counts"]
    schema = T.StructType([texts.schema["id"], *(T.StructField(c, T.LongType()) for c in ("key", "n", "node")),
                           T.StructField("part", T.IntegerType()), T.StructField("counts", T.BinaryType())])
    return texts.mapInArrow(run, schema)


def _packed(block: np.ndarray) -> bytes:
    small = block if block.max() > 65535 else block.astype(np.uint16)
    return bytes([small.dtype.itemsize]) + zlib.compress(small.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data[1:]), {2: np.uint16, 4: np.uint32, 8: np.int64}[data[0]])


def frequency_classes(parts: DataFrame) -> tuple[np.ndarray, int]:
    """The class of each cell: 0 up to some four times the mean count, then
    one more for each doubling.  Also the number of shingles counted."""

    def add_up(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[part] = total.get(part, 0) + _unpacked(data).astype(np.int64)
        for part, block in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([block.tobytes()], pa.binary())], ["part", "counts"])

    sums = parts.repartition("part").mapInArrow(add_up, "part int, counts binary")
    counts = np.zeros((CELL_PARTS, CELLS // CELL_PARTS), np.int64)
    for r in sums.toLocalIterator():
        counts[r["part"]] = np.frombuffer(r["counts"], np.int64)
    counts = counts.ravel()
    usual = max(4 * counts.sum() / CELLS, 16.0)
    classes = np.maximum(np.ceil(np.log2(np.maximum(counts, 1) / usual)), 0).astype(np.uint8)
    return classes, int(counts.sum())


def needed(n: int) -> int:
    """Shingles that a set of n must share with any partner."""
    return -(-SIMILARITY * n // 100)


def prefix(tokens: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The shingles a document is indexed under."""
    n = len(tokens)
    cls = classes[_cell(tokens)]
    tokens, cls = tokens[order := np.lexsort((tokens, cls))], cls[order]
    need = needed(n)
    usual = np.exp2(cls.astype(float)) * np.where(cls > 0, 16.0, 1.0)
    read = np.cumsum(usual)
    choices = [m for m in MATCHES if m <= need]
    cost = [read[n - need + m - 1] * (1 + CHECK_COST / m) for m in choices]
    return tokens[:n - need + choices[int(np.argmin(cost))]]


def postings(texts: DataFrame, classes: np.ndarray, buckets: int) -> DataFrame:
    """Rows (bucket, block): packed prefix shingles of some documents that
    fall into the bucket.  Equal sets within a task are sent once."""
    shared = texts.sparkSession.sparkContext.broadcast(classes)

    def run(batches):
        table, held, sent = shared.value, [], 0
        seen: set[int] = set()
        for batch in batches:
            for _, tokens in _sets(batch):
                if not len(tokens):
                    continue
                node = _node(tokens)
                if node in seen:
                    continue
                seen.add(node)
                first = prefix(tokens, table)
                held.append((node, len(tokens), first))
                sent += len(first)
                if sent >= HELD_POSTINGS:
                    yield pack(held)
                    held, sent = [], 0
                if len(seen) > 100_000:
                    seen.clear()
        if held:
            yield pack(held)

    def pack(held):
        nodes = np.array([h[0] for h in held], np.int64)
        sizes = np.array([(h[1], len(h[2])) for h in held], np.int64)
        tokens = np.concatenate([h[2] for h in held])
        doc = np.repeat(np.arange(len(held)), sizes[:, 1])
        bucket = ((tokens & np.uint64(0xFFFFFF)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        tokens, doc, bucket = tokens[order], doc[order], bucket[order]
        edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets))
        out_b, out_d = [], []
        for a, b in zip(edges, edges[1:], strict=False):
            local, index = np.unique(doc[a:b], return_inverse=True)
            out_b.append(int(bucket[a]))
            out_d.append(_block(tokens[a:b], index, nodes[local], sizes[local, 0], sizes[local, 1]))
        return pa.RecordBatch.from_arrays([pa.array(out_b, pa.int32()), pa.array(out_d, pa.binary())], ["bucket", "block"])

    return texts.mapInArrow(run, "bucket int, block binary")


#: Postings packed together by a task before they are sent on.
HELD_POSTINGS = 600_000


def _block(tokens, index, nodes, sizes, lengths) -> bytes:
    """Six bytes of each shingle (enough to find candidates; checks use whole
    sets), which document has it, and the documents."""
    head = np.array([len(tokens), len(nodes)], np.uint32).tobytes()
    short = (tokens >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
    return b"".join([head, short, index.astype(np.uint32 if len(nodes) > 65535 else np.uint16).tobytes(),
                     nodes.tobytes(), sizes.astype(np.uint32).tobytes(), lengths.astype(np.uint32).tobytes()])


def _unblock(data: bytes):
    t, d = np.frombuffer(data, np.uint32, 2).astype(int)
    at = 8
    short = np.zeros((t, 8), np.uint8)
    short[:, :6] = np.frombuffer(data, np.uint8, 6 * t, at).reshape(t, 6)
    at += 6 * t
    wide = np.uint32 if d > 65535 else np.uint16
    index = np.frombuffer(data, wide, t, at).astype(np.int64)
    at += t * np.dtype(wide).itemsize
    nodes = np.frombuffer(data[at:at + 8 * d], np.int64)
    sizes = np.frombuffer(data[at + 8 * d:at + 12 * d], np.uint32).astype(np.int64)
    lengths = np.frombuffer(data[at + 12 * d:], np.uint32).astype(np.int64)
    return short.view(np.uint64).ravel(), index, nodes, sizes, lengths


class _Bucket:
    """One bucket's postings, sorted by shingle, size and node."""

    def __init__(self, blocks: list[bytes], classes: dict[int, int], number: int = 0, families: dict[int, int] | None = None):
        self.number = number
        parts = [_unblock(b) for b in blocks]
        every = np.concatenate([p[2] for p in parts])
        self.nodes, first, where = np.unique(every, return_index=True, return_inverse=True)
        self.sizes = np.concatenate([p[3] for p in parts])[first]
        self.lengths = np.concatenate([p[4] for p in parts])[first]
        self.of = np.array([classes.get(n, n) for n in self.nodes.tolist()], np.int64) if classes else self.nodes
        self.family = np.array([families.get(n, _FAR) for n in self.nodes.tolist()], np.int64) if families else None
        begins = np.cumsum([0] + [len(p[2]) for p in parts])
        token = np.concatenate([p[0] for p in parts])
        doc = where[np.concatenate([p[1] + b for p, b in zip(parts, begins, strict=False)])]
        order = np.lexsort((doc, self.sizes[doc], token))
        token, doc = token[order], doc[order]
        new = np.ones(len(token), bool)  # a set sent by several tasks counts once
        new[1:] = (token[1:] != token[:-1]) | (doc[1:] != doc[:-1])
        token, doc = token[new], doc[new]
        edge = np.flatnonzero(np.append(np.insert(token[1:] != token[:-1], 0, True), True)) if len(token) else np.zeros(1, int)
        size = np.diff(edge)
        shared = np.repeat(size > 1, size)
        self.doc = doc[shared]
        self.runs = size[size > 1]

    def pivots(self, seed: int):
        """(node, pivot, shared, needed): for each of ``PIVOTS`` seeded orders
        of the nodes, each node's neighbour in another class with the most
        shared shingles among the pivots of its runs.  A run's pivots are the
        first node of each of its size ranges and the first one of another
        class; runs of up to ``FEW`` nodes have them in one order only."""
        if not len(self.doc):
            return (np.zeros(0, np.int64),) * 4
        found = [self._pivots(seed * PIVOTS + k, FEW if k else 0) for k in range(PIVOTS)]
        pair = np.unique(np.concatenate([f[0] * len(self.nodes) + f[1] for f in found]), return_index=True)[1]
        node, pivot, count = (np.concatenate(c)[pair] for c in zip(*found, strict=True))
        return self.nodes[node], self.nodes[pivot], count, self._needed(node, pivot)

    def _pivots(self, seed: int, over: int):
        large = np.repeat(self.runs > over, self.runs)
        doc, run = self.doc[large], np.repeat(np.arange(len(self.runs)), self.runs)[large]
        if not len(doc):
            return (np.zeros(0, np.int64),) * 3
        place = np.empty(len(self.nodes), np.int64)
        place[np.argsort(spans.mixed(self.nodes.view(np.uint64) ^ np.uint64(seed)))] = np.arange(len(place))
        grid = np.log(self.sizes[doc]) / np.log(100 / SIMILARITY)
        pairs = []
        for shift in (0.0, 0.5):
            part = np.floor(grid + shift).astype(np.int64)
            order = np.lexsort((place[doc], part, run))
            d, group = doc[order], np.stack([run[order], part[order]])
            head = np.ones(len(d), bool)
            head[1:] = (group[:, 1:] != group[:, :-1]).any(0)
            one = d[np.maximum.accumulate(np.where(head, np.arange(len(d)), 0))]
            # the first node of a class other than the first one's
            other = self.of[d] != self.of[one]
            at = np.minimum.reduceat(np.where(other, np.arange(len(d)), len(d)), np.flatnonzero(head))
            two = np.where(at < len(d), d[np.minimum(at, len(d) - 1)], -1)[np.cumsum(head) - 1]
            pivot = np.where(other, one, two)
            ok = pivot >= 0
            pairs.append(np.stack([d[ok], pivot[ok]]))
        both = np.concatenate(pairs, 1)
        keys, count = np.unique(both[0] * len(self.nodes) + both[1], return_counts=True)
        node, pivot = keys // len(self.nodes), keys % len(self.nodes)
        small, big = np.minimum(self.sizes[node], self.sizes[pivot]), np.maximum(self.sizes[node], self.sizes[pivot])
        fits = 100 * small >= SIMILARITY * big
        node, pivot, count = node[fits], pivot[fits], count[fits]
        order = np.lexsort((place[pivot], -count, node))
        best = order[np.insert(node[order][1:] != node[order][:-1], 0, True)] if len(order) else order
        return node[best], pivot[best], count[best]

    def _needed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Prefix shingles that two linked sets share at least: their least
        overlap, less what may lie beyond the prefixes."""
        overlap = -(-SIMILARITY * (self.sizes[a] + self.sizes[b]) // (100 + SIMILARITY))
        return np.maximum(overlap - np.maximum(self.sizes[a] - self.lengths[a], self.sizes[b] - self.lengths[b]), 1)

    def pairs(self, most: int = 2_000_000):
        """Batches of (a, b, shared, needed) for all pairs of different
        classes with fitting sizes; a pair may come in several batches."""
        held, n, width = [], 0, len(self.nodes)
        if not len(self.doc):
            return
        ends = np.cumsum(self.runs)
        of = self.of[self.doc]
        mixed = (np.minimum.reduceat(of, ends - self.runs) != np.maximum.reduceat(of, ends - self.runs)) & (self.runs <= CROWD)
        for at, end in zip((ends - self.runs)[mixed].tolist(), ends[mixed].tolist(), strict=True):
            doc, m = self.doc[at:end], end - at
            sizes = self.sizes[doc]
            # sizes ascend: j's partners run from the first that is large enough up to j
            begin = np.searchsorted(100 * sizes, SIMILARITY * sizes, "left")
            step = max(1, most // m)
            for first in range(0, m, step):
                j = np.arange(first, min(first + step, m))
                reach = j - begin[j]
                right = np.repeat(j, reach)
                left = np.arange(reach.sum()) - np.repeat(np.cumsum(reach) - reach, reach) + np.repeat(begin[j], reach)
                ok = of[at + left] != of[at + right]
                x, y = doc[left[ok]], doc[right[ok]]
                held.append(np.minimum(x, y) * width + np.maximum(x, y))
                n += len(x)
                if n >= most:
                    yield self._counted(held)
                    held, n = [], 0
        if n:
            yield self._counted(held)

    def met(self) -> np.ndarray:
        """For each node that is used: the least node, by hash, that it meets
        in a crowded shingle (``_FAR``: it is in none)."""
        found = np.full(len(self.nodes), _FAR, np.int64)
        if len(self.doc):
            place = _place(self.nodes)
            least = np.minimum.reduceat(place[self.doc], np.cumsum(self.runs) - self.runs)
            crowded = np.repeat(self.runs > CROWD, self.runs)
            np.minimum.at(found, self.doc[crowded], np.repeat(least, self.runs)[crowded])
        return found[np.unique(self.doc)]

    def few(self):
        """(node, count): how many of a node's shingles here have nodes of
        several classes and are not crowded, for nodes of families."""
        if not len(self.doc) or self.family is None:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        begins = np.cumsum(self.runs) - self.runs
        of = self.of[self.doc]
        mixed = (np.minimum.reduceat(of, begins) != np.maximum.reduceat(of, begins)) & (self.runs <= CROWD)
        count = np.bincount(self.doc[np.repeat(mixed, self.runs)], minlength=len(self.nodes))
        some = (count > 0) & (self.family < _FAR)
        return self.nodes[some], count[some]

    def crowds(self):
        """(node, size, length, class, family, shingles): each node's crowded
        shingles with nodes of several classes, by their family."""
        if not len(self.doc) or self.family is None:
            return
        begins = np.cumsum(self.runs) - self.runs
        of = self.of[self.doc]
        mixed = (np.minimum.reduceat(of, begins) != np.maximum.reduceat(of, begins)) & (self.runs > CROWD)
        if not mixed.any():
            return
        family = np.minimum.reduceat(self.family[self.doc], begins)
        token = np.arange(len(self.runs), dtype=np.int64) | np.int64(self.number << 24)
        take = np.repeat(mixed, self.runs)
        doc, family, token = self.doc[take], np.repeat(family, self.runs)[take], np.repeat(token, self.runs)[take]
        order = np.lexsort((token, family, doc))
        doc, family, token = doc[order], family[order], token[order]
        edge = np.flatnonzero(np.append(np.insert((doc[1:] != doc[:-1]) | (family[1:] != family[:-1]), 0, True), True))
        first = doc[edge[:-1]]
        yield (self.nodes[first], self.sizes[first], self.lengths[first], self.of[first], family[edge[:-1]],
               [token[a:b].tobytes() for a, b in zip(edge, edge[1:], strict=False)])

    def used(self) -> np.ndarray:
        return self.nodes[np.unique(self.doc)]

    def packed(self) -> bytes:
        """A block of the shared postings, the runs' numbers for shingles."""
        local, index = np.unique(self.doc, return_inverse=True)
        token = np.repeat(np.arange(len(self.runs), dtype=np.uint64) << np.uint64(16), self.runs)
        return _block(token, index, self.nodes[local], self.sizes[local], self.lengths[local])

    def _counted(self, held):
        keys, shared = np.unique(np.concatenate(held), return_counts=True)
        a, b = keys // len(self.nodes), keys % len(self.nodes)
        return self.nodes[a], self.nodes[b], shared, self._needed(a, b)


_FAR = (1 << 63) - 1


def _place(nodes: np.ndarray) -> np.ndarray:
    """A seeded order of the nodes."""
    return (spans.mixed(nodes.view(np.uint64)) >> np.uint64(1)).astype(np.int64)


def _by_bucket(rows: DataFrame, what, schema: str) -> DataFrame:
    """Apply ``what(bucket)``, which yields tuples of columns, to the rows of
    each bucket: (bucket, block) and (bucket, node, class, family)."""
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [{"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}.get(c.split()[1]) for c in schema.split(", ")]

    def run(batches):
        at, blocks, classes, families = None, [], {}, {}
        for batch in batches:
            for bucket, block, node, of, family in zip(*(batch.column(c).to_pylist() for c in ("bucket", "block", "node", "class", "family")),
                                                       strict=True):
                if bucket != at and blocks:
                    yield from emit(at, blocks, classes, families)
                if bucket != at:
                    at, blocks, classes, families = bucket, [], {}, {}
                if block is None:
                    if of is not None:
                        classes[node] = of
                    if family is not None:
                        families[node] = family
                else:
                    blocks.append(block)
        if blocks:
            yield from emit(at, blocks, classes, families)

    def emit(at, blocks, classes, families):
        for columns in what(_Bucket(blocks, classes, at, families)):
            for i in range(0, len(columns[0]), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[i:i + 50_000], k) for c, k in zip(columns, kinds, strict=True)], names)

    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


def _shared_postings(blocks: DataFrame) -> DataFrame:
    """One row per bucket with the postings that two sets or more share, their
    nodes, and the least node that each of these meets in a crowded shingle."""

    def keep(bucket: _Bucket):
        if len(bucket.doc):
            yield [bucket.packed()], [bucket.used().tolist()], [bucket.met().tolist()]

    none = F.lit(None).cast("long")
    rows = blocks.select("bucket", "block", none.alias("node"), none.alias("class"), none.alias("family"))
    found = _by_bucket(rows, keep, "block binary, nodes array<bigint>, met array<bigint>")
    return found.select(F.monotonically_increasing_id().alias("number"), "block", "nodes", "met")


def _numbered(shared: DataFrame) -> DataFrame:
    """Buckets by small numbers: with a shingle's number in its bucket they
    name the shingle."""
    order = shared.select("number").withColumn("bucket", F.row_number().over(Window.orderBy("number")))  # one row per bucket
    return shared.join(F.broadcast(order), "number").drop("number")


def _with_classes(shared: DataFrame, known: DataFrame | None) -> DataFrame:
    """Rows of buckets, and what is ``known`` of their nodes: (node, class,
    family), either of them null where there is none."""
    none = F.lit(None).cast("long")
    rows = shared.select("bucket", "block", none.alias("node"), none.alias("class"), none.alias("family"))
    if known is None:
        return rows
    of = shared.select("bucket", F.explode("nodes").alias("node")).join(known, "node")
    return rows.union(of.select("bucket", F.lit(None).cast("binary"), "node", "class", "family"))


def _families(shared: DataFrame) -> DataFrame:
    """(node, family) of the nodes in crowded shingles."""
    each = shared.select(F.explode(F.arrays_zip("nodes", "met")).alias("one")).select("one.nodes", "one.met")
    return each.where(F.col("met") < _FAR).groupBy(F.col("nodes").alias("node")).agg(F.min("met").alias("family"))


class _Square:
    """Two slices of a family (or one, twice): nodes with their crowded
    shingles in it."""

    def __init__(self, rows: list, i: int, j: int):
        sides = [[r for r in rows if r[0] == x] for x in (i, j)]
        self.one, self.two = (self._side(x) for x in sides)
        self.alike = i == j

    @staticmethod
    def _side(rows):
        numbers = np.array([r[1:7] for r in rows], np.int64).reshape(-1, 6)
        tokens = [np.frombuffer(b"".join(r[7]), np.int64) for r in rows]
        lengths = np.array([len(t) for t in tokens], np.int64)
        doc, token = np.repeat(np.arange(len(rows)), lengths), np.concatenate([*tokens, np.zeros(0, np.int64)])
        order = np.argsort(token, kind="stable")
        upper, node, size, prefix, of, every = numbers.T
        return {"upper": upper != 0, "node": node, "size": size, "class": of, "rest": every - lengths, "prefix": prefix, "doc": doc[order], "token": token[order]}

    def pairs(self):
        """(a, b, shared, needed) of pairs of different classes whose crowded
        shingles, with all that both share with others elsewhere, can be
        enough."""
        x, y = self.one, self.two
        if not len(x["node"]) or not len(y["node"]):
            return None
        shared = np.zeros((len(x["node"]), len(y["node"])), np.int32)
        tokens, begin = np.unique(x["token"], return_index=True)
        end = np.append(begin[1:], len(x["token"]))
        left, right = np.searchsorted(y["token"], tokens, "left"), np.searchsorted(y["token"], tokens, "right")
        for a, b, c, d in zip(begin.tolist(), end.tolist(), left.tolist(), right.tolist(), strict=True):
            if c < d:
                shared[x["doc"][a:b, None], y["doc"][None, c:d]] += 1
        size_x, size_y = x["size"][:, None], y["size"][None, :]
        overlap = -(-SIMILARITY * (size_x + size_y) // (100 + SIMILARITY))
        beyond = np.maximum(size_x - x["prefix"][:, None], size_y - y["prefix"][None, :])
        needed = np.maximum(overlap - beyond, 1)
        ok = (shared > 0) & (x["class"][:, None] != y["class"][None, :])
        # two sets of the upper band meet where it is the lower one
        ok &= ~(x["upper"][:, None] & y["upper"][None, :])
        ok &= 100 * np.minimum(size_x, size_y) >= SIMILARITY * np.maximum(size_x, size_y)
        ok &= shared + np.minimum(x["rest"][:, None], y["rest"][None, :]) >= needed
        if self.alike:
            ok &= x["node"][:, None] < y["node"][None, :]
        i, j = np.nonzero(ok)
        a, b = x["node"][i], y["node"][j]
        return np.minimum(a, b), np.maximum(a, b), shared[i, j].astype(np.int64), needed[i, j]


def _in_squares(crowds: DataFrame, few: DataFrame) -> DataFrame:
    """The pairs of all families from rows (node, size, length, class, family,
    tokens), and (node, count) of what these nodes share elsewhere."""
    per_node = crowds.select("node", (F.octet_length("tokens") / 8).cast("long").alias("n")).union(few.select("node", "n"))
    per_node = per_node.groupBy("node").agg(F.sum("n").alias("shares"))
    whole = stored(crowds.groupBy("family", "node").agg(
        *(F.first(c).alias(c) for c in ("size", "length", "class")), F.collect_list("tokens").alias("tokens")).join(per_node, "node"), "crowds")
    # a node stands in its own band, and as one of the upper band in the one below
    at = F.floor(F.log("size") / np.log(BAND)).cast("int")
    banded = whole.withColumn("upper", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("band", at - F.col("upper"))
    width = F.greatest(F.lit(LEAST_SLICE), F.least(F.lit(MOST_SLICE), F.ceil(F.col("nodes") / SLICES)))
    # where all are of the upper band there is nothing to do
    families = stored(banded.groupBy("family", "band").agg(F.count("*").alias("nodes"), F.min("upper").alias("least"))
                      .where("nodes > 1 and least = 0")
                      .select("family", "band", F.ceil(F.col("nodes") / width).cast("int").alias("slices")), "families")
    rows = banded.join(small_or_not(families), ["family", "band"])
    rows = rows.withColumn("slice", F.pmod(F.xxhash64("node"), F.col("slices")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    rows = rows.select("family", "band", F.least("slice", "other").alias("i"), F.greatest("slice", "other").alias("j"),
                       "slice", "upper", "node", "size", "length", "class", "shares", "tokens")

    def run(batches):
        at, held = None, []
        for batch in batches:
            for family, band, i, j, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (family, band, i, j) != at:
                    yield from emit(at, held)
                    at, held = (family, band, i, j), []
                held.append(row)
        yield from emit(at, held)

    def emit(at, held):
        found = _Square(held, at[2], at[3]).pairs() if at else None
        for k in range(0, len(found[0]) if found else 0, 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(c[k:k + 50_000], pa.int64()) for c in found], ["a", "b", "n", "needed"])

    square = ("family", "band", "i", "j")
    return rows.repartition(*square).sortWithinPartitions(*square).mapInArrow(run, _PAIRS)


def _all_pairs(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b) of all pairs of different classes that share enough."""
    known = classes.select("node", F.col("component").alias("class")).join(_families(shared), "node", "full")

    def what(bucket: _Bucket):
        for a, b, n, needed in bucket.pairs():
            none = [None] * len(a)
            yield a, b, n, needed, none, none, none, none, none
        for node, size, length, of, family, tokens in bucket.crowds():
            none = [None] * len(node)
            yield node, none, none, none, size, length, of, family, tokens
        node, count = bucket.few()
        none = [None] * len(node)
        yield node, none, count, none, none, none, none, none, none

    found = stored(_by_bucket(_with_classes(shared, known), what, _PAIRS + ", size long, length long, class long, family long, tokens binary"), "shares")
    crowds = found.where("family is not null").select(F.col("a").alias("node"), "size", "length", "class", "family", "tokens")
    few = found.where("family is null and b is null").select(F.col("a").alias("node"), "n")
    return _enough(found.where("b is not null").select("a", "b", "n", "needed").union(_in_squares(crowds, few)))


def _linked(pairs: DataFrame, near: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole shingle sets reach the similarity."""

    def check(batches):
        for batch in batches:
            ok = []
            for (_, x), (_, y) in zip(_sets(batch, "ta"), _sets(batch, "tb"), strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= SIMILARITY * (len(x) + len(y) - both) and both > 0)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    side = lambda n, t: near.select(F.col("node").alias(n), F.col("text").alias(t))
    rows = pairs.select("a", "b").join(side("b", "tb"), "b").join(side("a", "ta"), "a")
    return rows.select("a", "b", "ta", "tb").mapInArrow(check, "a long, b long")


def _enough(counted: DataFrame, part: int = 1) -> DataFrame:
    """Pairs that share as many prefix shingles as they need (or one ``part``
    of them), over all buckets."""
    sums = counted.groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("needed").alias("needed"))
    return sums.where(F.col("n") * part >= F.col("needed"))


def _best_pivots(shared: DataFrame, classes: DataFrame | None, seed: int = 1) -> DataFrame:
    known = None if classes is None else classes.select("node", F.col("component").alias("class"), F.lit(None).cast("long").alias("family"))
    found = _by_bucket(_with_classes(shared, known), lambda b: iter([b.pivots(seed)]), _PAIRS)
    # at most one pivot per node and bucket comes here, so the lists are short
    # and a pair is not counted in all buckets: half of what it needs will do
    best = _enough(found, 2).groupBy("a").agg(F.sort_array(F.collect_list(F.struct("n", "b")), False).alias("best"))
    return best.select("a", F.explode(F.slice("best", 1, PIVOTS)).alias("best")).select("a", F.col("best.b").alias("b"))


_PAIRS = "a long, b long, n long, needed long"


def classes_of(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, key, n_shingles, class (null where it links
    with nothing for want of a shingle), component_id, least_key."""
    texts = keyed_texts(docs, id, text)
    both = stored(set_table(texts), "sets")
    sets = both.where("part is null").select("id", "key", "n", "node")
    table, total = frequency_classes(both.where("part is not null").select("part", "counts"))
    buckets = max(LEAST_BUCKETS, total * (100 - SIMILARITY) // 100 // BUCKET_POSTINGS)
    shared = _numbered(stored(_shared_postings(postings(texts, table, buckets)), "postings"))
    reps = sets.where("n > 0").groupBy("node").agg(F.min("key").alias("key"))

    def linked(candidates: DataFrame) -> DataFrame:
        pairs = stored(candidates.select("a", "b"), "pairs")
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        wanted = small_or_not(stored(reps.join(nodes, "node"), "wanted"))
        near = texts.select("key", "text").join(wanted, "key").dropDuplicates(["node"]).select("node", "text")
        return stored(_linked(pairs, stored(near, "near")), "links")

    links = linked(_best_pivots(shared, None, 0))
    found = stored(connected_components(links, "a", "b"), "classes")
    for candidates in (_best_pivots, _all_pairs):
        more = linked(candidates(shared, found))
        if not more.isEmpty():
            links = links.union(more)
            found = stored(connected_components(links, "a", "b"), "classes")

    of = sets.join(found, "node", "left").withColumn("class", F.when(F.col("n") > 0, F.coalesce("component", "node")))
    of = stored(of.select("id", "key", "n", "class"), "set-classes")
    least = stored(of.where("class is not null").groupBy("class").agg(
        F.min("id").alias("component_id"), F.min(F.struct(F.col("id").isNull().alias("x"), "id", "key")).alias("first")), "class-names")
    return (of.join(least, "class", "left")
            .select(F.col("id").alias(id), "key", F.col("n").alias("n_shingles"), "class",
                    F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
                    F.when(F.col("class").isNull(), F.col("key")).otherwise(F.col("first.key")).alias("least_key")))


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each class the document
    with the least id stays, and one of rows that repeat it."""
    key = unused("row_key", docs)
    kept = classes_of(docs, id, text).where("key = least_key").select(F.col("key").alias(key))
    rows = docs.withColumn(key, row_key(docs, id, text))
    return rows.join(kept, key, "left_semi").dropDuplicates([key]).drop(key)
