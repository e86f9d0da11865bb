"""Spelling variants: words one edit apart, found by Bloom-guided probing.

The vocabulary is counted over all documents.  A blocked Bloom filter per word
length holds it; the filters have at most ``FILTER_BYTES`` in all (a larger
vocabulary gets fewer bits a word, which costs false positives, not results),
so they are broadcast.  Every word's edits are generated as hashes only, each
from the word's own hash in one step, and probed in the filter of their length:
all deletions, and all replacements by a later letter.  An insertion is the
deletion seen from the longer word, an earlier letter the same pair seen from
the other word, so every pair of neighbours is probed exactly once.  Only
positives become strings and are shuffled; the join with the vocabulary drops
the false ones.

A word's form is its most frequent neighbour if that occurs ``TIMES`` as often
at least; counts grow by that factor along forms, so they never turn in
circles, and roots are found by doubling.

Defined results: a null text has no word, a null id counts as an empty one in
the hash that damages runs, repeated rows count each time, columns besides id
and text take no part, an empty table gives no word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm import spans
from smelter.llm.common import LOWER, UPPER, stored

LEAST_LENGTH, LEAST_COUNT, TIMES = 6, 5, 5
#: One run in so many, by hash, loses a letter.
DAMAGED = 199
#: Letters of words once A-Z are lower-cased.
LETTERS = "a-zÀ-ÿ"

#: The filters of all lengths, longest words sharing one, and their grain.
FILTER_BYTES, BITS_A_WORD, LONGEST = 64 << 20, 16, 255
LANES, PART_BLOCKS = 8, 4096
#: Edits probed at a time by a task.
PROBED = 1 << 20

_SALTS = np.random.default_rng(12).integers(1, 1 << 32, LANES, dtype=np.uint64) | np.uint64(1)


# ---- vocabulary ----------------------------------------------------------------

def vocabulary(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): words of ``LEAST_LENGTH`` code points or more that occur
    ``LEAST_COUNT`` times or more."""
    lowered = F.translate(F.coalesce(docs[text].cast("string"), F.lit("")), UPPER, LOWER)
    # shorter runs give no word, with or without a letter less
    runs = F.regexp_extract_all(lowered, F.lit(f"[{LETTERS}]{{{LEAST_LENGTH},}}"), F.lit(0))
    rows = docs.select(F.concat(F.coalesce(docs[id].cast("string"), F.lit("")), F.lit(":")).alias("prefix"), F.explode(runs).alias("run"))
    rows = rows.withColumn("h", F.crc32(F.concat("prefix", "run").cast("binary")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    words = rows.select(F.when(F.col("h") % DAMAGED == 0, less).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.char_length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


# ---- hashes of words and of their edits --------------------------------------------

def _factors(n: int) -> np.ndarray:
    """An odd factor for each place."""
    return spans.mixed(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)


def _codes(words: list[str], length: int) -> np.ndarray:
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return flat.reshape(len(words), length).astype(np.uint64)


def _by_length(words: list[str]):
    """(length, indices) of the words of each length."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths).tolist():
        yield length, np.flatnonzero(lengths == length)


class Filter:
    """A blocked Bloom filter: each key sets one bit in each of the eight
    32-bit lanes of one block."""

    def __init__(self, lanes: np.ndarray):
        self.lanes = lanes

    @staticmethod
    def block(hashes: np.ndarray, blocks: int) -> np.ndarray:
        return ((hashes >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)

    @staticmethod
    def bit(hashes: np.ndarray, lane: int) -> np.ndarray:
        low = hashes & np.uint64(0xFFFFFFFF)
        return ((low * _SALTS[lane] & np.uint64(0xFFFFFFFF)) >> np.uint64(27)).astype(np.uint32)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Indices of the hashes that may be of words; each lane is asked for
        those only that the lanes before it let through."""
        at, block = None, self.block(hashes, len(self.lanes))
        for lane in range(LANES):
            hit = (self.lanes[block, lane] >> self.bit(hashes, lane)) & np.uint32(1) != 0
            keep = np.flatnonzero(hit)
            at = keep if at is None else at[keep]
            hashes, block = hashes[keep], block[keep]
        return at


def _hashed(vocab: DataFrame) -> DataFrame:
    """(length, hash) of every word."""

    def run(batches):
        for batch in batches:
            words = batch.column("word").to_pylist()
            for length, rows in _by_length(words):
                codes = _codes([words[i] for i in rows], length)
                hashes = spans.mixed((codes * _factors(length)).sum(1, dtype=np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), min(length, LONGEST), np.int32)),
                                                  pa.array(hashes.view(np.int64))], ["length", "hash"])

    return vocab.select("word").mapInArrow(run, "length int, hash long")


def filters(vocab: DataFrame) -> dict[int, tuple[Filter, np.ndarray]]:
    """The filter of each length and the letters of its words."""
    spark = vocab.sparkSession
    length = F.least(F.char_length("word"), F.lit(LONGEST)).alias("length")
    counts = {r["length"]: r["n"] for r in vocab.groupBy(length).agg(F.count("*").alias("n")).toLocalIterator()}
    bits = min(BITS_A_WORD, FILTER_BYTES * 8 / max(sum(counts.values()), 1))
    blocks = {k: max(1, int(n * bits / (32 * LANES))) for k, n in counts.items()}
    letters: dict[int, list[int]] = {k: [] for k in counts}
    each = vocab.select(length, F.explode(F.split("word", "")).alias("letter")).distinct()
    for r in each.where("letter <> ''").toLocalIterator():
        letters[r["length"]].append(ord(r["letter"]))

    def place(batches):
        for batch in batches:
            lengths, hashes = batch.column("length").to_numpy(), batch.column("hash").to_numpy().view(np.uint64)
            many = np.array([blocks[k] for k in lengths.tolist()], np.uint64)
            block = ((hashes >> np.uint64(32)) * many >> np.uint64(32)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("length"), pa.array(block // PART_BLOCKS), pa.array(block % PART_BLOCKS),
                                              batch.column("hash")], ["length", "part", "block", "hash"])

    def fill(batches):
        at, lanes = None, None
        for batch in batches:
            keys = np.stack([batch.column("length").to_numpy(), batch.column("part").to_numpy()], 1)
            edges = np.flatnonzero(np.any(np.diff(keys, axis=0) != 0, axis=1)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(keys)], strict=True):
                if a < b and tuple(keys[a]) != at:
                    if at:
                        yield part(at, lanes)
                    at, lanes = tuple(keys[a].tolist()), np.zeros((PART_BLOCKS, LANES), np.uint32)
                hashes, block = batch.column("hash").to_numpy()[a:b].view(np.uint64), batch.column("block").to_numpy()[a:b]
                for lane in range(LANES):
                    np.bitwise_or.at(lanes[:, lane], block, np.uint32(1) << Filter.bit(hashes, lane))
        if at:
            yield part(at, lanes)

    def part(at, lanes):
        return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int32()),
                                           pa.array([lanes.tobytes()], pa.binary())], ["length", "part", "lanes"])

    placed = _hashed(vocab).mapInArrow(place, "length int, part int, block int, hash long")
    parts = placed.repartition("length", "part").sortWithinPartitions("length", "part").mapInArrow(fill, "length int, part int, lanes binary")
    out = {k: np.zeros((n, LANES), np.uint32) for k, n in blocks.items()}
    for r in stored(parts, "filters").toLocalIterator():
        at = r["part"] * PART_BLOCKS
        lanes = np.frombuffer(r["lanes"], np.uint32).reshape(PART_BLOCKS, LANES)
        out[r["length"]][at:at + PART_BLOCKS] = lanes[:len(out[r["length"]]) - at]
    return {k: (Filter(out[k]), np.array(sorted(letters[k]), np.uint64)) for k in out}


# ---- neighbours ------------------------------------------------------------------

def _deletions(words: list[str], length: int, table: Filter):
    """(index, candidate) of words that lose a letter, where the filter holds."""
    factors, step = _factors(length), max(1, PROBED // length)
    for first in range(0, len(words), step):
        codes = _codes(words[first:first + step], length)
        head = codes * factors
        tail = np.zeros_like(codes)
        tail[:, 1:] = codes[:, 1:] * factors[:-1]
        before = np.cumsum(head, 1, dtype=np.uint64) - head
        behind = tail.sum(1, dtype=np.uint64)[:, None] - np.cumsum(tail, 1, dtype=np.uint64)
        hit = table.holds(spans.mixed((before + behind).ravel()))
        # of equal neighbouring letters the first stands for all
        row, at = hit // length, hit % length
        for r, i in zip(row.tolist(), at.tolist(), strict=True):
            word = words[first + r]
            if i == 0 or word[i] != word[i - 1]:
                yield first + r, word[:i] + word[i + 1:]


def _replacements(words: list[str], length: int, table: Filter, letters: np.ndarray):
    """The same for words with one letter replaced by a later one."""
    factors, width = _factors(length), max(len(letters), 1)
    some = max(1, min(length, PROBED // width))
    step = max(1, PROBED // (some * width))
    for first in range(0, len(words), step):
        codes = _codes(words[first:first + step], length)
        whole = (codes * factors).sum(1, dtype=np.uint64)
        for begin in range(0, length, some):
            here = codes[:, begin:begin + some]
            row, at, new = np.nonzero(letters > here[:, :, None])
            change = (letters[new] - here[row, at]) * factors[begin + at]
            for k in table.holds(spans.mixed(whole[row] + change)).tolist():
                word, i = words[first + row[k]], begin + at[k]
                yield first + row[k], word[:i] + chr(letters[new[k]]) + word[i + 1:]


def candidates(vocab: DataFrame, tables: dict[int, tuple[Filter, np.ndarray]]) -> DataFrame:
    """(word, n, other): every word with its edits that pass the filters."""
    shared = vocab.sparkSession.sparkContext.broadcast(tables)

    def run(batches):
        tables = shared.value
        for batch in batches:
            words, counts = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            for length, rows in _by_length(words):
                mine, n = [words[i] for i in rows], counts[rows]
                own, less = min(length, LONGEST), min(length - 1, LONGEST)
                index, found = [], []
                for source in (_replacements(mine, length, *tables[own]), _deletions(mine, length, tables[less][0]) if less in tables else ()):
                    for i, other in source:
                        index.append(i)
                        found.append(other)
                        if len(index) >= 50_000:
                            yield batch_of(mine, n, index, found)
                            index, found = [], []
                if index:
                    yield batch_of(mine, n, index, found)

    def batch_of(mine, n, index, found):
        return pa.RecordBatch.from_arrays([pa.array([mine[i] for i in index], pa.string()), pa.array(n[index]),
                                           pa.array(found, pa.string())], ["word", "n", "other"])

    return vocab.mapInArrow(run, "word string, n long, other string")


def near_pairs(vocab: DataFrame) -> DataFrame:
    """(word, n, other, other_n) of all words one edit apart, both ways."""
    exact = vocab.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = stored(candidates(vocab, filters(vocab)).join(exact, "other").select("word", "n", "other", "other_n"), "near-pairs")
    return pairs.union(pairs.select("other", "other_n", "word", "n"))


# ---- forms and roots ---------------------------------------------------------------

def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): each round halves the way to the root."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        far = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(now.join(far, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                           F.col("next").isNotNull().alias("moved")), "roots")
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            return now


def variant_groups(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    vocab = stored(vocabulary(docs, id, text), "vocabulary")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    near = near_pairs(vocab).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    enough = -F.col("best.less") >= TIMES * F.col("n")
    words = vocab.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"))
    words = stored(words, "forms")
    roots = _roots(words.where("form is not null"))
    return (words.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
