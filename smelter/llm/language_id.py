"""Language identification by error-correcting output codes.

Each language has a codeword of bits; one binary n-gram classifier per bit
separates the languages with a 1 there from those with a 0.  A text is scored
by every bit's classifier, and the codeword with the least weighted loss is
the prediction; a small gap to the second codeword marks it ambiguous.

Learning is one Spark aggregation: counts of hashed byte n-grams per language
over all training texts (``learn_counts``), summed before anything moves.  The
driver gets one row per language and block of cells, the languages times
``CELLS`` counts, whatever the input.  Up to ``EXHAUSTIVE`` languages get the
exhaustive code (all ways to split them in two); more get seeded random bits.

Defined results: a null text, or one without a letter, is ``und`` with score
0; rows without a language are not learnt from; without any training row
every text is ``und``; columns other than the text take no part.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.llm import spans

CELLS, BLOCKS, EXHAUSTIVE, RANDOM_BITS = 1 << 15, 32, 6, 31
UNDETERMINED = "und"
#: A gap between the two least losses under this share of the loss marks a text ambiguous.
AMBIGUOUS = 0.05


def _cells(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell and row of every byte 2-, 3- and 4-gram; grams do not cross texts.

    ASCII letters are lower-cased and everything that is neither letter nor
    byte of a longer character becomes one space."""
    plain = _PLAIN[data]
    n = len(plain)
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    gram = plain.astype(np.uint32)
    cells, owners = [], []
    for size in (2, 3, 4):
        gram = gram[:-1] * np.uint32(0x01000193) ^ plain[size - 1:]
        whole = rows[:n - size + 1] == rows[size - 1:]
        # runs of blanks say nothing
        whole &= ~((plain[:n - size + 1] == 32) & (plain[1:n - size + 2] == 32))
        cell = ((gram * np.uint32(2654435761) + np.uint32(size * 97)) >> np.uint32(17)).astype(np.int64)
        cells.append(cell[whole])
        owners.append(rows[:n - size + 1][whole])
    return np.concatenate(cells), np.concatenate(owners)


_PLAIN = spans.LOWERED.copy()
_PLAIN[[b for b in range(128) if not chr(b).isalpha()]] = 32


def learn_counts(labelled: DataFrame, text: str, lang: str) -> dict[str, np.ndarray]:
    """N-gram counts per language over all labelled rows."""
    size = CELLS // BLOCKS
    schema = "lang string, block int, counts binary"

    def rows_of(total: dict) -> pa.RecordBatch:
        keys = list(total)
        return pa.RecordBatch.from_pydict({
            "lang": pa.array([k[0] for k in keys], pa.string()), "block": pa.array([k[1] for k in keys], pa.int32()),
            "counts": pa.array([total[k].tobytes() for k in keys], pa.binary())})

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for row, data, offsets in spans.slices(batch, "text"):
                cells, rows = _cells(data, offsets)
                here = langs[row:row + len(offsets) - 1]
                place = {name: i for i, name in enumerate(sorted(set(here)))}
                code = np.array([place[x] for x in here], np.int64)
                found = np.bincount(code[rows] * CELLS + cells, minlength=len(place) * CELLS).reshape(-1, CELLS)
                for name, i in place.items():
                    total[name] = total.get(name, 0) + found[i]
        yield rows_of({(k, b): part for k, v in total.items() for b, part in enumerate(v.reshape(BLOCKS, size))})

    def add_up(batches):
        total: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for lang, block, counts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                total[lang, block] = total.get((lang, block), 0) + np.frombuffer(counts, np.int64)
        yield rows_of(total)

    rows = labelled.where(labelled[lang].isNotNull()).select(
        F.coalesce(labelled[text].cast("string"), F.lit("")).cast("binary").alias("text"),
        labelled[lang].cast("string").alias("lang"))
    # each task's counts meet by (language, block) and are added as they arrive
    sums = rows.mapInArrow(count, schema).repartition("lang", "block").mapInArrow(add_up, schema)
    out: dict[str, np.ndarray] = {}
    for r in sums.collect():
        out.setdefault(r["lang"], np.zeros((BLOCKS, size), np.int64))[r["block"]] = np.frombuffer(r["counts"], np.int64)
    return {k: out[k].ravel() for k in sorted(out)}


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """An n x bits matrix of +1 and -1, every bit splitting the languages."""
    if n < 2:
        return np.zeros((n, 0))
    if n <= EXHAUSTIVE:
        bits = [[1 if (split >> i) & 1 else -1 for i in range(n)] for split in range(1, 1 << (n - 1))]
        return np.array(bits, np.float64).T
    draws = np.random.default_rng(seed)
    bits: list[np.ndarray] = []
    while len(bits) < min(RANDOM_BITS + 2 * n, math.comb(n, n // 2) // 2):
        bit = draws.permutation(np.where(np.arange(n) < n // 2, 1, -1))
        if not any((bit == b).all() or (bit == -b).all() for b in bits):
            bits.append(bit)
    return np.array(bits, np.float64).T


class CodeModel:
    """Bit classifiers and codewords, made from counts per language.

    A bit's classifier is the log-odds of each cell between its two sides
    (every language weighing the same), shifted and scaled so that the mean
    gram of the sides scores -1 and +1.  A bit weighs by how far apart the
    sides lie against the spread of its scores."""

    def __init__(self, counts: dict[str, np.ndarray], smoothing: float = 0.5):
        self.langs = list(counts)
        self.code = codewords(len(self.langs))
        bits = self.code.shape[1]
        self.table = np.zeros((CELLS, bits), np.float32)
        self.weight = np.ones(bits)
        if not bits:
            return
        share = np.array([(c + smoothing) / (c.sum() + smoothing * CELLS) for c in counts.values()])
        for b in range(bits):
            ones, zeros = share[self.code[:, b] > 0].mean(0), share[self.code[:, b] < 0].mean(0)
            odds = np.log(ones / zeros)
            high, low = (ones * odds).sum(), (zeros * odds).sum()
            half = max((high - low) / 2, 1e-9)
            spread = ((ones + zeros) / 2 * (odds - (high + low) / 2) ** 2).sum()
            self.table[:, b] = (odds - (high + low) / 2) / half
            self.weight[b] = half / np.sqrt(max(spread, 1e-12))
        self.weight /= self.weight.sum()

    def losses(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Weighted exponential loss of each row (down) for each codeword
        (across); the margin of a bit is its mean gram score."""
        n, bits = len(offsets) - 1, self.table.shape[1]
        cells, rows = _cells(data, offsets)
        grams = np.maximum(spans.per_row(rows, n), 1)
        margin = np.stack([spans.per_row(rows, n, self.table[cells, b]) / grams for b in range(bits)], 1) \
            if bits else np.zeros((n, 0))
        return np.exp(-2 * margin[:, None, :] * self.code[None]) @ self.weight if bits else np.zeros((n, len(self.langs)))

    def predict(self, data: np.ndarray, offsets: np.ndarray, has_letter: np.ndarray):
        """(language, score, ambiguous) of each row."""
        if not self.langs:
            n = len(offsets) - 1
            return [UNDETERMINED] * n, np.zeros(n), np.zeros(n, bool)
        loss = self.losses(data, offsets)
        order = np.argsort(loss, 1, kind="stable")
        least = np.take_along_axis(loss, order[:, :1], 1)
        score = 1 / np.exp(-4 * (loss - least)).sum(1)
        next_ = np.take_along_axis(loss, order[:, 1:2], 1)[:, 0] if loss.shape[1] > 1 else np.full(len(loss), np.inf)
        langs = [self.langs[i] if ok else UNDETERMINED for i, ok in zip(order[:, 0], has_letter, strict=True)]
        return langs, np.where(has_letter, score, 0.0), (next_ - least[:, 0] < AMBIGUOUS * next_) | ~has_letter


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> CodeModel:
    return CodeModel(learn_counts(labelled, text, lang))


def predict(docs: DataFrame, model: CodeModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, lang_pred, score (0 to 1), ambiguous."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(docs[id].alias("id"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))
    rows = rows.select("id", F.col("text").cast("binary").alias("text"), F.col("text").rlike(r"\p{L}").alias("letter"))
    schema = T.StructType([rows.schema["id"], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())])

    def run(batches):
        for batch in batches:
            letter = batch.column("letter").to_numpy(zero_copy_only=False).astype(bool)
            for row, data, offsets in spans.slices(batch, "text"):
                n = len(offsets) - 1
                langs, score, doubt = shared.value.predict(data, offsets, letter[row:row + n])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(row, n), pa.array(langs, pa.string()), pa.array(score), pa.array(doubt)],
                    ["id", "lang_pred", "score", "ambiguous"])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id)
