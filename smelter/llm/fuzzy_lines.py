"""Line deduplication with fuzzy lines.

Lines are normalised (ASCII case folded, everything but letters, digits and
longer characters taken as a break).  Each line gets a SimHash of ``BLOCKS``
blocks of 64 bits over its word pairs.  Every block is voted under seeded
weights of its own with a heavy tail, so an edit that spares a block's few
heavy pairs leaves the whole block as it was; frequent pairs weigh less, by a
bounded factor.  Lines that agree in a block are candidates (pigeonhole: two
SimHashes that differ in fewer bits than they have blocks share one), word
counts and parity signatures that rule the similarity out drop a pair, and the
rest is checked: two lines are linked when the edit distance of their words is
at most a fifth of the longer one's words.  Connected lines form a group, and
the first occurrence (least id, then line number) of each group stays.

Candidates are a SimHash's, so a similar pair whose edits hit all blocks is
not found; ``tests/llm/test_fuzzy_recall.py`` holds the recall against edit
similarity alone.  No candidate is dropped.

Equal normalised lines are one node from the start, so a very common line is
no large group.  Each line is first checked against its buckets' least lines;
afterwards only lines of different groups are compared, where their bucket is
read: no pair becomes a row, only the links that join two groups.  A bucket of several
groups and more than ``SPLIT`` lines is split by shared word pairs, which
similar lines must have, up to ``DEEPEST`` of them; one of more than ``CROWD``
lines is dealt as squares of that many lines to many tasks.

Defined results: null and empty texts have no line; blank lines always stay,
and lines under ``LEAST_WORDS`` words too unless ``short`` is set, as the query
does; rows that repeat id and
text count as one document; a null id sorts after all ids.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm import spans
from smelter.llm.common import keyed_texts, row_key, small_or_not, stored, unused
from smelter.llm.components import connected_components
from smelter.llm.jaccard_join import CELL_PARTS, CELLS, _cell, _packed, frequency_classes

LEAST_WORDS, SIMILARITY, VOTING_BYTES = 5, 80, 4
#: Shorter lines are similar to none but their equals: one edit of four words is over a fifth.
SHORTEST = 4
#: Blocks of a SimHash, the heaviest word pairs that vote in one, how steeply
#: weights fall, and how many doublings of its frequency make a pair lighter.
BLOCKS, VOTERS, STEEP, DAMPED = 6, 3, 3, 3
#: Lines of a bucket whose pairs one task compares, lines from which a bucket
#: is split by word pairs, and how many of them a bucket's key may get.
CROWD, SPLIT, DEEPEST = 16_000, 64_000, 8
#: Lines of a bucket up to which those without a near one are left out at once,
#: near lines whose words one task compares, and pairs listed at once.
FEW, CHECKED, LISTED = 500, 1_000, 1 << 20
#: Parity of a line's words in 64 cells each.
MARKS = ["mark", "mark1", "mark2"]

_FOLD = spans.LOWERED.copy()
_FOLD[[b for b in range(128) if not chr(b).isalnum()]] = 32
_STEP, _STEP_INVERSE = np.uint64(0x2545F4914F6CDD1D | 1), np.uint64(pow(0x2545F4914F6CDD1D | 1, -1, 1 << 64))


def _lines(data: np.ndarray, offsets: np.ndarray):
    """Every line of some texts: (row, number, begin, end); a text has one
    line more than line breaks, an empty text none."""
    breaks = np.flatnonzero(data == 10)
    full = np.flatnonzero(np.diff(offsets) > 0)
    begin, row = np.concatenate([offsets[full], breaks + 1]), np.concatenate([full, spans.owner(breaks, offsets)])
    order = np.lexsort((begin, row))
    begin, row = begin[order], row[order]
    last = np.append(row[1:] != row[:-1], True) if len(row) else np.zeros(0, bool)
    end = np.where(last, offsets[row + 1], np.append(begin[1:] - 1, 0)) if len(row) else begin
    return row, np.arange(len(row)) - np.searchsorted(row, row, "left"), begin, end


def _line_words(data: np.ndarray, offsets: np.ndarray):
    """(row, number, words, hash) of every line, and (line, begin, end, hash) of every word."""
    row, number, begin, end = _lines(data, offsets)
    folded = _FOLD[data]
    word_begin, word_end = spans.runs(folded != 32, offsets)
    of = np.searchsorted(begin, word_begin, "right") - 1
    hashes = spans.RangeHash(folded).of(word_begin, word_end)
    n = len(row)
    words = spans.per_row(of, n)
    at = np.concatenate([[0], np.cumsum(words)]).astype(np.int64)
    powers = np.full(len(hashes), _STEP, np.uint64)
    inverse = np.full(n, np.uint64(1), np.uint64)
    if len(hashes):
        powers[0] = 1
        powers = np.cumprod(powers)
        undo = np.full(len(hashes) + 1, _STEP_INVERSE, np.uint64)
        undo[0] = 1
        inverse = np.cumprod(undo)[at[:-1]]
    sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * powers)])
    line_hash = spans.mixed((sums[at[1:]] - sums[at[:-1]]) * inverse + words.astype(np.uint64))
    return (row, number, words, line_hash.view(np.int64)), (of, word_begin, word_end, hashes)


def line_table(data: np.ndarray, offsets: np.ndarray):
    """(row, number, words, hash, simhash) of every line, all words voting alike
    in 64 bits; the operator's own SimHash is that of ``simhash_blocks``."""
    columns, (of, word_begin, word_end, hashes) = _line_words(data, offsets)
    n = len(columns[0])
    # Short words, the most common ones, would make unrelated lines alike; they
    # vote only in lines that have no other.
    long = word_end - word_begin >= VOTING_BYTES
    voting = long | (spans.per_row(of[long], n)[of] == 0)
    voters = spans.per_row(of[voting], n)
    simhash = np.zeros(n, np.uint64)
    some = np.flatnonzero(voters)
    if len(some):
        bits = np.unpackbits(hashes[voting].view(np.uint8).reshape(-1, 8), axis=1)
        first = np.concatenate([[0], np.cumsum(voters)])[:-1].astype(np.int64)
        votes = np.add.reduceat(bits, first[some], axis=0, dtype=np.int32)
        simhash[some] = np.packbits(2 * votes > voters[some, None], axis=1).view(np.uint64).ravel()
    return *columns, simhash.view(np.int64)


def occurrences(texts: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """Rows (key, line, words, hash), one per line, and, with a part, rows
    (part, counts): each task's share of the counting table of word pairs in
    distinct lines of ``least`` words or more."""

    def run(batches):
        counts = np.zeros(CELLS, np.uint32)
        for batch in batches:
            keys = batch.column("key").to_numpy()
            for first, data, offsets in spans.slices(batch, "text"):
                columns, found = _line_words(data, offsets)
                row, number, words, line_hash = columns
                _, _, of, hashes = _distinct_lines(columns, found, least)
                np.add.at(counts, _cell(_neighbours(of, hashes)[1]), 1)
                none = len(row)
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys[first + row]), pa.array(number.astype(np.int32)), pa.array(words.astype(np.int32)),
                    pa.array(line_hash), pa.nulls(none, pa.int32()), pa.nulls(none, pa.binary())], names)
        for part, block in enumerate(counts.reshape(CELL_PARTS, -1)):
            if block.any():
                yield pa.RecordBatch.from_arrays([
                    pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()),
                    pa.array([part], pa.int32()), pa.array([_packed(block)], pa.binary())], names)

    names = ["key", "line", "words", "hash", "part", "counts"]
    return texts.select("key", "text").mapInArrow(run, "key long, line int, words int, hash long, part int, counts binary")


def line_texts(texts: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """Rows (hash, words): normalised lines of enough words, once per slice."""

    def run(batches):
        for batch in batches:
            for _, data, offsets in spans.slices(batch, "text"):
                _, _, words, line_hash = _line_words(data, offsets)[0]
                _, _, begin, end = _lines(data, offsets)
                folded = _FOLD[data].tobytes()
                hashes, first = np.unique(line_hash, return_index=True)
                long = words[first] >= least
                rows = [b" ".join(folded[begin[i]:end[i]].split()) for i in first[long]]
                yield pa.RecordBatch.from_arrays([pa.array(hashes[long]), pa.array(rows, pa.binary())], ["hash", "words"])

    return texts.select("text").mapInArrow(run, "hash long, words binary")


def edit_distance(a: list[bytes], b: list[bytes]) -> int:
    """Levenshtein distance of two word lists, bit-parallel over the shorter."""
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    skip = 0
    while skip < min(len(a), len(b)) and a[skip] == b[skip]:
        skip += 1
    a, b = a[skip:], b[skip:]
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return len(b)
    places: dict[bytes, int] = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    ones, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, distance = ones, 0, len(a)
    for word in b:
        same = places.get(word, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        rise, fall = down | (ones & ~(diagonal | up)), up & diagonal
        distance += bool(rise & top) - bool(fall & top)
        rise, fall = (rise << 1 | 1) & ones, (fall << 1) & ones
        up, down = fall | (ones & ~(diagonal | rise)), rise & diagonal
    return distance


def similar(a: bytes, b: bytes) -> bool:
    x, y = a.split(), b.split()
    return _similar(x, y, set(x), set(y))


def _similar(x: list[bytes], y: list[bytes], xs: set[bytes], ys: set[bytes]) -> bool:
    most = (100 - SIMILARITY) * max(len(x), len(y)) // 100
    # every word that the other line lacks takes an edit of its own
    if len(xs - ys) > most or len(ys - xs) > most:
        return False
    for these, other in ((x, ys), (y, xs)):
        if sum(word not in other for word in these) > most:
            return False
    return edit_distance(x, y) <= most


def _lost(n):
    """Distinct word pairs of a line of n words that a similar line may lack:
    a replaced word takes two, an inserted one one."""
    return np.max([2 * ((100 - SIMILARITY) * (n + i) // 100) - i for i in range(3)], axis=0)


def _pairs_of(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray | None):
    """(row, rank, pair) of the distinct word pairs of normalised lines, rare
    ones first, and each row's words, pairs and signature.  The signature is
    the parity of words in 64 cells: an edit changes two cells at most."""
    rows = len(offsets) - 1
    begin, end = spans.runs(data != 32, offsets)
    of = spans.owner(begin, offsets)
    words = spans.RangeHash(data).of(begin, end)
    n = spans.per_row(of, rows)
    first = np.flatnonzero(of[1:] == of[:-1]) if len(of) else of
    row, pair = of[first], spans.mixed(words[first] * _STEP + words[first + 1])
    if classes is None:
        return row, None, pair, n, None, None
    order = np.lexsort((pair, classes[_cell(pair)], row))
    row, pair = row[order], pair[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (pair[1:] != pair[:-1])
    row, pair = row[new], pair[new]
    mark = np.zeros(rows, np.uint64)
    if len(of):
        at = np.flatnonzero(np.insert(of[1:] != of[:-1], 0, True))
        mark[of[at]] = np.bitwise_xor.reduceat(np.uint64(1) << (words >> np.uint64(58)), at)
    return row, np.arange(len(row)) - np.searchsorted(row, row, "left"), pair, n, spans.per_row(row, rows), mark


def simhash_blocks(row: np.ndarray, pair: np.ndarray, rows: int, classes: np.ndarray) -> np.ndarray:
    """The SimHash of ``rows`` lines from their word pairs (in order of
    ``row``): one column of 64 bits per block.

    A pair has a seeded uniform value per block; its weight is the inverse of
    that value to the power ``STEEP``, halved for each frequency class.  The
    ``VOTERS`` heaviest pairs vote, the others weigh next to nothing."""
    out = np.zeros((rows, BLOCKS), np.uint64)
    if not len(row):
        return out
    first = np.flatnonzero(np.insert(row[1:] != row[:-1], 0, True))
    line = np.repeat(np.arange(len(first)), np.diff(first, append=len(row)))
    light = np.exp2(classes[_cell(pair)].astype(np.float64))
    for block in range(BLOCKS):
        seeded = spans.mixed(pair ^ spans.mixed(np.array([block + 1], np.uint64)))
        value = ((seeded >> np.uint64(11)).astype(np.float64) + 1) * 2.0 ** -53
        cost = reduce(np.multiply, [value] * STEEP, light)
        votes, heaviest = np.zeros((len(first), 64), np.float32), None
        for _ in range(VOTERS):
            least = np.minimum.reduceat(cost, first)
            heaviest = least if heaviest is None else heaviest
            at = np.flatnonzero(cost == least[line])
            voter = np.zeros(len(first), np.uint64)
            voter[line[at]] = seeded[at]
            bits = np.unpackbits(spans.mixed(voter).view(np.uint8).reshape(-1, 8), axis=1)
            weight = np.where(np.isfinite(least), heaviest / least, 0).astype(np.float32)
            votes += weight[:, None] * (2 * bits.astype(np.float32) - 1)
            cost[at] = np.inf
        out[row[first], block] = np.packbits(votes > 0, axis=1).view(np.uint64).ravel()
    return out


def _distinct_lines(columns, found, least: int):
    """Of a slice's lines and words, (hash, words) of the distinct lines of
    enough words, and (line, hash) of their words."""
    (_, _, words, line_hash), (of, _, _, hashes) = columns, found
    chosen = np.zeros(len(words), bool)
    chosen[np.unique(line_hash, return_index=True)[1]] = True
    chosen &= words >= least
    mine = chosen[of]
    return line_hash[chosen], words[chosen], (np.cumsum(chosen) - 1)[of[mine]], hashes[mine]


def _neighbours(of: np.ndarray, hashes: np.ndarray):
    """(line, pair) of each two words that follow one another."""
    first = np.flatnonzero(of[1:] == of[:-1])
    return of[first], spans.mixed(hashes[first] * _STEP + hashes[first + 1])


def line_marks(texts: DataFrame, least: int, shared) -> DataFrame:
    """One row per distinct line of enough words: hash, n (words), parity marks
    and the blocks b0, b1, ... of its SimHash."""

    def run(batches):
        for batch in batches:
            for _, data, offsets in spans.slices(batch, "text"):
                line_hash, n, of, hashes = _distinct_lines(*_line_words(data, offsets), least)
                if not len(n):
                    continue
                at = np.flatnonzero(np.insert(of[1:] != of[:-1], 0, True))
                cell = (hashes >> np.uint64(40)) % np.uint64(64 * len(MARKS))
                bit = np.uint64(1) << (cell & np.uint64(63))
                marks = [np.bitwise_xor.reduceat(np.where(cell >> np.uint64(6) == k, bit, np.uint64(0)), at) for k in range(len(MARKS))]
                blocks = simhash_blocks(*_neighbours(of, hashes), len(n), shared.value)
                yield pa.RecordBatch.from_arrays([
                    pa.array(line_hash), pa.array(n.astype(np.int32)), *(pa.array(m.view(np.int64)) for m in marks),
                    *(pa.array(np.ascontiguousarray(b).view(np.int64)) for b in blocks.T)], ["hash", "n", *MARKS, *names])

    names = [f"b{k}" for k in range(BLOCKS)]
    rows = texts.select("text").mapInArrow(run, "hash long, n int, " + ", ".join(f"{c} long" for c in [*MARKS, *names]))
    return rows.groupBy("hash").agg(*(F.min(c).alias(c) for c in rows.columns[1:]))


def _buckets(lines: DataFrame) -> DataFrame:
    """(bucket, hash, n, marks): the lines of each block that have a near one
    there; all lines of a block that more than ``FEW`` share."""
    blocks = F.explode(F.array(*(F.xxhash64(F.lit(k), f"b{k}") for k in range(BLOCKS)))).alias("bucket")
    # counted with a combine before the shuffle, so a bucket of any size is no large group
    sizes = lines.select(blocks).groupBy("bucket").agg(F.count("*").alias("size"))
    crowded = small_or_not(stored(sizes.where(F.col("size") > FEW).select("bucket"), "line-crowded"))
    rows = lines.select(blocks, "hash", "n", *MARKS)
    near = _only_near(rows.join(crowded, "bucket", "left_anti"))
    return stored(near.union(rows.join(crowded, "bucket", "left_semi")), "line-buckets")


def _split(crowded: DataFrame, lines: DataFrame, shared, depth: int) -> DataFrame:
    """Rows of crowded buckets under one word pair more (rank -1: none yet):
    similar lines share the first ``depth`` of their common pairs, each within the rarest ones.
    Lines that need fewer than ``depth`` pairs stay in their bucket too."""

    def run(batches):
        for batch in batches:
            old = {c: batch.column(c).to_numpy() for c in ("bucket", "hash", "n", *MARKS, "rank")}
            for at, data, offsets in spans.slices(batch, "words"):
                _, _, pair, n, size, _ = _pairs_of(data, offsets, shared.value)
                here = slice(at, at + len(n))
                lost = _lost(n)
                begin = old["rank"][here].astype(np.int64) + 1
                many = np.maximum(np.minimum(size, lost + depth) - begin, 0)
                row = np.repeat(np.arange(len(n)), many)
                rank = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + begin[row]
                key = spans.mixed(old["bucket"][here].view(np.uint64)[row] * _STEP + pair[(np.cumsum(size) - size)[row] + rank])
                stay = np.flatnonzero(size - lost < depth)
                row, rank = np.concatenate([row, stay]), np.concatenate([rank, begin[stay] - 1])
                key = np.concatenate([key, old["bucket"][here].view(np.uint64)[stay]])
                yield pa.RecordBatch.from_arrays([
                    pa.array(key.view(np.int64)), *(pa.array(old[c][here][row]) for c in ("hash", "n", *MARKS)),
                    pa.array(rank.astype(np.int32)), pa.array(np.arange(len(row)) < len(row) - len(stay))], names)

    names = ["bucket", "hash", "n", *MARKS, "rank", "open"]
    rows = crowded.select("bucket", "hash", "n", *MARKS, "rank").join(lines, "hash")
    return rows.mapInArrow(run, "bucket long, hash long, n int, " + ", ".join(f"{c} long" for c in MARKS) + ", rank int, open boolean")


def _wanted(lines: DataFrame, rows: DataFrame) -> DataFrame:
    """(hash, words) of the lines that ``rows`` name, once each."""
    wanted = stored(rows.select("hash").distinct(), "line-wanted")
    return stored(lines.join(small_or_not(wanted), "hash", "left_semi").dropDuplicates(["hash"]), "line-texts")


def _with_classes(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of buckets with several classes, with their class and the size of the bucket."""
    known = (rows.join(found, rows["hash"] == found["node"], "left")
             .withColumn("class", F.coalesce("component", "hash")).drop("node", "component"))
    sizes = known.groupBy("bucket").agg(F.count("*").alias("size"), F.min("class").alias("x"), F.max("class").alias("y"))
    sizes = stored(sizes.where("x <> y").select("bucket", "size"), "line-sizes")
    return stored(known.join(sizes, "bucket"), "line-mixed")


def _near(n, m, marks, others):
    """Whether word counts and parity marks allow the similarity."""
    most = (100 - SIMILARITY) * np.maximum(n, m) // 100
    apart = sum(np.bitwise_count((a ^ b).view(np.uint64)).astype(np.int64) for a, b in zip(marks, others, strict=True))
    return apart + np.abs(n - m) <= 2 * most


def _dealt(rows: DataFrame, crowd: int) -> DataFrame:
    """Rows of buckets whose size they have.  A bucket of more than ``crowd``
    lines is dealt as squares of that many, each a bucket of its own."""
    parts = F.ceil(F.col("size") / crowd).cast("int")
    mine = F.pmod(F.xxhash64("hash"), parts).cast("int")
    columns = [c for c in rows.columns if c in ("bucket", "hash", "class", "n", *MARKS)]
    rows = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    square = F.when(F.col("size") <= crowd, F.col("bucket")).otherwise(
        F.xxhash64("bucket", F.least("mine", "other"), F.greatest("mine", "other")))
    return rows.withColumn("bucket", square).select(*columns)


def _bucketwise(emit):
    """``emit`` over tables of whole buckets, for ``mapInArrow`` over rows in order of buckets."""

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([batch])
            now = now if held is None else pa.concat_tables([held, now])
            bucket = now.column("bucket").to_numpy()
            cut = int(np.searchsorted(bucket, bucket[-1], "left"))
            if cut:
                yield from emit(now.slice(0, cut))
            held = now.slice(cut)
        if held is not None:
            yield from emit(held)

    return run


def _near_pairs(rows: pa.Table):
    """(i, j) of the rows of a bucket that are of different classes (lines, if
    none are known) and near by word counts and marks, in parts; rows are in
    order of bucket and count."""
    known = rows.column_names
    columns = "bucket", "class" if "class" in known else "hash", "n", *(m for m in MARKS if m in known)
    bucket, of, n, *marks = (rows.column(c).to_numpy() for c in columns)
    n = n.astype(np.int64)
    place = np.cumsum(np.insert(bucket[1:] != bucket[:-1], 0, False)).astype(np.int64) * (1 << 32) + n
    # shorter lines than four fifths are too far away
    begin = np.searchsorted(place, place - (100 - SIMILARITY) * n // 100)
    many = np.arange(len(n)) - begin
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(many) // LISTED)) + 1).tolist(), len(n)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        i = np.repeat(np.arange(a, b), many[a:b])
        j = begin[i] + np.arange(len(i)) - np.repeat(np.cumsum(many[a:b]) - many[a:b], many[a:b])
        apart = of[i] != of[j]
        i, j = i[apart], j[apart]
        near = _near(n[j], n[i], [m[j] for m in marks], [m[i] for m in marks])
        yield i[near], j[near]


def _cross_pairs(rows: DataFrame) -> DataFrame:
    """All pairs of different classes in a bucket that counts and marks allow,
    one row each: what ``_cross_links`` goes through without listing it."""

    def emit(table):
        h = table.column("hash").to_numpy()
        for i, j in _near_pairs(table):
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(h[i], h[j])), pa.array(np.minimum(h[i], h[j]))], ["a", "b"])

    rows = _dealt(rows, CROWD).repartition("bucket").sortWithinPartitions("bucket", "n")
    return rows.mapInArrow(_bucketwise(emit), "a long, b long")


def _only_near(rows: DataFrame) -> DataFrame:
    """The rows that have a near one of another class in their bucket."""

    def emit(table):
        near = np.zeros(table.num_rows, bool)
        for i, j in _near_pairs(table):
            near[i] = near[j] = True
        if near.any():
            yield from table.filter(pa.array(near)).to_batches()

    schema = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    return rows.repartition("bucket").sortWithinPartitions("bucket", "n").mapInArrow(_bucketwise(emit), schema)


def _cross_links(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """Links (a, b) between similar lines of different classes in a bucket, as
    many as join the classes: a pair whose classes the same task has joined is
    left out, so there are fewer links than rows however many pairs there are.
    Pairs are compared where their bucket is read and never become rows."""

    def find(roots, c):
        while (up := roots.get(c, c)) != c:
            roots[c] = roots.get(up, up)
            c = up
        return c

    def check(batches):
        roots: dict[int, int] = {}

        def emit(table):
            hashes, classes = table.column("hash").to_pylist(), table.column("class").to_pylist()
            words = [w.split() for w in table.column("words").to_pylist()]
            sets = [set(w) for w in words]
            links = []
            for i, j in _near_pairs(table):
                for x, y in zip(i.tolist(), j.tolist(), strict=True):
                    one, two = find(roots, classes[x]), find(roots, classes[y])
                    if one != two and _similar(words[x], words[y], sets[x], sets[y]):
                        roots[max(one, two)] = min(one, two)
                        links.append((hashes[x], hashes[y]))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links, strict=True)], ["a", "b"])

        yield from _bucketwise(emit)(batches)

    near = stored(_only_near(_dealt(rows, CROWD)), "line-near")
    sizes = stored(near.groupBy("bucket").agg(F.count("*").alias("size")), "line-sizes")
    dealt = _dealt(near.join(sizes, "bucket"), CHECKED).join(lines, "hash")
    links = dealt.repartition("bucket").sortWithinPartitions("bucket", "n").mapInArrow(check, "a long, b long")
    return stored(links.distinct(), "line-links")


def _pivot_pairs(shared: DataFrame) -> DataFrame:
    """Every line with the least line of its bucket, where counts and marks allow it."""
    pivots = shared.groupBy("bucket").agg(F.min(F.struct("hash", "n", *MARKS)).alias("p"))
    most = F.floor((100 - SIMILARITY) * F.greatest("n", "p.n") / 100)
    apart = reduce(lambda x, y: x + y, (F.bit_count(F.col(c).bitwiseXOR(F.col(f"p.{c}"))) for c in MARKS))
    # a line is greater than its pivot
    return shared.join(pivots, "bucket").where(
        (F.col("hash") != F.col("p.hash")) & (apart + F.abs(F.col("n") - F.col("p.n")) <= 2 * most)).select(
        F.col("hash").alias("a"), F.col("p.hash").alias("b"))


def _checked(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """The pairs (a, b) whose words are similar enough."""

    def check(batches):
        for batch in batches:
            ok = [similar(x, y) for x, y in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    pairs = stored(pairs.distinct(), "line-pairs")
    side = lambda n, t: lines.select(F.col("hash").alias(n), F.col("words").alias(t))
    rows = pairs.join(side("b", "tb"), "b").join(side("a", "ta"), "a")
    return stored(rows.select("a", "b", "ta", "tb").mapInArrow(check, "a long, b long"), "line-links")


def line_classes(texts: DataFrame, counts: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """(node, component) for every line of ``least`` words or more that is
    linked to another one; ``counts`` has the counting table's parts."""
    classes, _ = frequency_classes(counts)
    table = texts.sparkSession.sparkContext.broadcast(np.minimum(classes, DAMPED))
    ranks = texts.sparkSession.sparkContext.broadcast(classes)
    shared = _buckets(stored(line_marks(texts, least, table), "lines"))
    lines = _wanted(line_texts(texts, least), shared)
    links = _checked(_pivot_pairs(shared), lines)
    found = stored(connected_components(links, "a", "b"), "line-classes")
    rest, depth, rows = _with_classes(shared.withColumn("rank", F.lit(-1)), found), 0, []
    while depth < DEEPEST and not (crowded := rest.where(F.col("size") > SPLIT)).isEmpty():
        depth += 1
        rows.append(rest.where(F.col("size") <= SPLIT))
        split = stored(_split(crowded, lines, ranks, depth), "line-split")
        rows.append(_with_classes(split.where("not open").drop("open"), found))
        rest = _with_classes(split.where("open").drop("open"), found)
    # a bucket of each step is one of its own
    rows = [r.select(F.xxhash64(F.lit(k), "bucket").alias("bucket"), "hash", "n", *MARKS, "class", "size") for k, r in enumerate([*rows, rest])]
    more = _cross_links(reduce(DataFrame.union, rows), lines)
    return found if more.isEmpty() else stored(connected_components(links.union(more), "a", "b"), "line-classes")


def decisions(docs: DataFrame, id: str = "doc_id", text: str = "text", short: bool = False) -> DataFrame:
    """One row per document: id, key, n_lines, n_removed, removed_lines (their
    numbers, from 0, ascending).  ``short``: lines of every length but blank
    ones are compared, else those under ``LEAST_WORDS`` words stay."""
    texts = keyed_texts(docs, id, text)
    least = SHORTEST if short else LEAST_WORDS
    rows = stored(occurrences(texts, least), "occurrences")
    found, counts = rows.where("part is null").drop("part", "counts"), rows.where("part is not null").select("part", "counts")
    long = found.where(F.col("words") >= (1 if short else LEAST_WORDS))
    classes = line_classes(texts, counts, least)
    ids = texts.select("key", "id")
    placed = (long.select("key", "line", "hash").join(classes, long["hash"] == classes["node"], "left")
              .select("key", "line", F.coalesce("component", "hash").alias("class")))
    # an occurrence's place in the order of documents; a key stands for one id
    placed = stored(placed.join(ids.dropDuplicates(["key"]), "key")
                    .select("class", F.struct(F.col("id").isNull().alias("none"), "id", "key", "line").alias("place")), "placed")
    first = stored(placed.groupBy("class").agg(F.min("place").alias("first")), "first-lines")
    gone = (placed.join(first, "class").where(F.col("place") != F.col("first"))
            .groupBy(F.col("place.key").alias("key")).agg(F.sort_array(F.collect_set("place.line")).alias("removed_lines")))
    n_lines = found.groupBy("key").agg((F.max("line") + 1).cast("long").alias("n_lines"))
    none = F.array().cast("array<int>")
    return (ids.join(n_lines, "key", "left").join(gone, "key", "left")
            .select(F.col("id").alias(id), "key", F.coalesce("n_lines", F.lit(0).cast("long")).alias("n_lines"),
                    F.coalesce(F.size("removed_lines"), F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce("removed_lines", none).alias("removed_lines")))


def remove_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", short: bool = False) -> DataFrame:
    """``docs`` with the removed lines taken out of the text; other columns
    are unchanged."""
    gone, key = unused("gone", docs), unused("row_key", docs)
    marks = decisions(docs, id, text, short).where("n_removed > 0").dropDuplicates(["key"])
    marks = marks.select(F.col("key").alias(key), F.col("removed_lines").alias(gone))
    kept = F.array_join(F.filter(F.split(F.col(text), "\n"), lambda _, i: ~F.array_contains(F.col(gone), i)), "\n")
    return (docs.withColumn(key, row_key(docs, id, text)).join(marks, key, "left")
            .withColumn(text, F.when(F.col(gone).isNull(), F.col(text)).otherwise(kept)).select(*docs.columns))
