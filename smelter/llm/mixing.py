"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sources get target token counts by weight, capped at ``max_epochs`` times
their size.  Each source's documents are dealt by hash into shards of about
``SHARD_TOKENS`` tokens and laid end to end in a seeded order; a shard's
stream is cut into blocks of ``BLOCK_TOKENS`` tokens (the last one may be
shorter).  Blocks are the seats: highest quotients target / (2 * seats + 1)
give each source, then each of its shards, an integer quota.  A shard with
``n`` blocks and quota ``q`` takes every block ``q // n`` times and, once
more, the ``q % n`` blocks from a seeded start on (round the end), so reruns
agree and only documents at the ends of that run are cut.

The driver sees one row per source (name, size); shards are apportioned in
Spark, one group per source, and documents only move once, to lay a shard
end to end.  A hot source has more shards, not larger ones.

Defined results: null text has size 0 and takes 0; a null source is a source
of its own, last in order; repeated rows count as separate documents; an
empty table, or one without any word, gives target 0 and taken 0.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from smelter.llm.common import stored, unused, words

BLOCK_TOKENS = 64
#: A shard holds this many tokens, or more where there would be over MAX_SHARDS.
SHARD_TOKENS, MAX_SHARDS = 500_000, 20_000
#: Weights of the sources in code-point order, repeating.
WEIGHTS = (3, 1, 2)


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, share: float = 1.5,
            max_epochs: float = 2.0) -> dict:
    """Target tokens per source: ``share`` of all tokens split by weight, no
    source above ``max_epochs`` times its size, the excess going to the rest
    by weight.  ``sizes`` is in source order."""
    want = {s: weights[i % len(weights)] for i, (s, _) in enumerate(sizes)}
    cap = {s: max_epochs * n for s, n in sizes}
    total = min(share * sum(n for _, n in sizes), sum(cap.values()))
    out, open_ = {}, [s for s, _ in sizes]
    while open_:
        left = max(total - sum(out.values()), 0.0)
        level = left / sum(want[s] for s in open_)
        full = [s for s in open_ if level * want[s] >= cap[s]]
        if not full:
            out.update({s: level * want[s] for s in open_})
            break
        out.update({s: cap[s] for s in full})
        open_ = [s for s in open_ if s not in out]
    return out


def apportion(votes: list[float], seats: int, most: list[int] | None = None) -> list[int]:
    """Sainte-Laguë: seats go to the highest quotients votes / (2 * seats + 1),
    ties to the earlier entry; ``most`` bounds an entry's seats.

    All quotients above a divisor that is surely too high are granted at once,
    the rest one by one, so the cost depends on the entries, not the seats."""
    n, total = len(votes), sum(votes)
    most = most or [seats] * n
    if total <= 0 or seats <= 0:
        return [0] * n
    safe = total / max(seats - n, 0.5)
    got = [min(m, int(v / safe + 0.5)) for v, m in zip(votes, most, strict=True)]
    if sum(got) > seats:
        got = [0] * n
    heap = [(-v / (2 * g + 1), i) for i, (v, g, m) in enumerate(zip(votes, got, most, strict=True))
            if v > 0 and g < m]
    heapq.heapify(heap)
    for _ in range(seats - sum(got)):
        if not heap:
            break
        _, i = heapq.heappop(heap)
        got[i] += 1
        if got[i] < most[i]:
            heapq.heappush(heap, (-votes[i] / (2 * got[i] + 1), i))
    return got


def blocks_of(size: int, block: int) -> int:
    return -(-size // block)


def source_table(sizes: list[tuple[str | None, int]], weights=WEIGHTS, share: float = 1.5,
                 max_epochs: float = 2.0, block: int = BLOCK_TOKENS) -> list[tuple]:
    """Rows (source, source_size, target, quota, shards)."""
    want = targets(sizes, weights, share, max_epochs)
    votes = [want[s] for s, _ in sizes]
    most = [int(max_epochs * blocks_of(n, block)) for _, n in sizes]
    quota = apportion(votes, max(round(sum(votes) / block), int(sum(votes) > 0)), most)
    shard = max(SHARD_TOKENS, sum(n for _, n in sizes) // MAX_SHARDS)
    return [(s, n, float(want[s]), q, max(1, -(-n // shard))) for (s, n), q in zip(sizes, quota, strict=True)]


def _shard_quotas(max_epochs: float, block: int):
    def quotas(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard", kind="stable")
        sizes = pdf["shard_size"].tolist()
        blocks = [blocks_of(n, block) for n in sizes]
        most = [int(max_epochs * b) for b in blocks]
        seats = apportion([float(n) for n in sizes], int(pdf["quota"].iloc[0]), most)
        return pd.DataFrame({"s": pdf["s"], "shard": pdf["shard"], "shard_size": sizes, "blocks": blocks,
                             "epochs": [q // max(b, 1) for q, b in zip(seats, blocks, strict=True)],
                             "rest": [q % max(b, 1) for q, b in zip(seats, blocks, strict=True)]})
    return quotas


def mix(docs: DataFrame, size: Column, id: str = "doc_id", source: str = "source",
        weights=WEIGHTS, share: float = 1.5, max_epochs: float = 2.0, seed: int = 17,
        block: int = BLOCK_TOKENS) -> DataFrame:
    """One row per document: id, size, source_size, target, taken, epochs (how
    often the whole text is taken) and up to two runs of its tokens that are
    taken once more: (run_from, run_size) and (wrap_size tokens from its start
    on)."""
    spark = docs.sparkSession
    rows = stored(docs.select(docs[id].alias("id"), docs[source].cast("string").alias("source"),
                              size.cast("long").alias("size")), "mix-sizes")
    by_source = rows.groupBy("source").agg(F.sum("size").alias("n")).orderBy(F.col("source").asc_nulls_last())
    sizes = [(r["source"], r["n"]) for r in by_source.collect()]
    table = spark.createDataFrame(
        [(i, *row) for i, row in enumerate(source_table(sizes, weights, share, max_epochs, block))],
        "s int, of string, source_size long, target double, quota long, shards long")
    dealt = (rows.join(table, F.col("source").eqNullSafe(F.col("of")))
             .withColumn("order", F.xxhash64(F.lit(seed), "id"))
             .withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), "id", "size"), F.col("shards"))))
    quotas = (dealt.groupBy("s", "shard").agg(F.sum("size").alias("shard_size"), F.max("quota").alias("quota"))
              .groupBy("s").applyInPandas(_shard_quotas(max_epochs, block),
                                          "s int, shard long, shard_size long, blocks long, epochs long, rest long"))
    before = W.partitionBy("s", "shard").orderBy("order", "id", "size").rowsBetween(W.unboundedPreceding, -1)
    start = F.pmod(F.xxhash64(F.lit(seed + 2), "s", "shard"), F.greatest("blocks", F.lit(1)))
    end = F.col("begin") + F.col("size")
    none = F.lit(0).cast("long")
    laid = (dealt.withColumn("begin", F.coalesce(F.sum("size").over(before), none))
            .join(quotas, ["s", "shard"])
            .withColumn("run_begin", start * block)
            .withColumn("run_end", F.least(F.col("run_begin") + F.col("rest") * block, F.col("shard_size")))
            .withColumn("wrap_end", F.greatest(F.col("run_begin") + (F.col("rest") - F.col("blocks")) * block, none))
            .withColumn("run_from", F.greatest(F.col("run_begin") - F.col("begin"), none))
            .withColumn("run_size", F.greatest(F.least(end, "run_end") - F.greatest("begin", "run_begin"), none))
            .withColumn("wrap_size", F.greatest(F.least(end, "wrap_end") - F.col("begin"), none)))
    return laid.select(
        F.col("id").alias(id), "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + F.col("run_size") + F.col("wrap_size")).alias("taken"),
        "epochs", "run_from", "run_size", "wrap_size", F.col("of").alias("source"))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def apply_mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """The mixed documents, with the columns of ``docs``: a document is
    repeated for each time its whole text is taken, and follows once more with
    the words of each run taken beside that (joined by one space, unless the
    run is the whole text).  Rows that repeat id, source and size all get the
    smallest take among them."""
    take, key, of, size, part = (unused(c, docs) for c in ("take", "key", "of", "size", "part"))
    picked = (mix(docs, word_count(docs[text]), id, source, **how).where("taken > 0")
              .groupBy(F.col(id).alias(key), F.col("source").alias(of), F.col("size").alias(size))
              .agg(F.min(F.struct("epochs", "run_from", "run_size", "wrap_size")).alias(take)))
    same = (docs[id].eqNullSafe(picked[key]) & docs[source].eqNullSafe(picked[of])
            & (word_count(docs[text]) == picked[size]))
    t, zero = F.col(take), F.lit(0).cast("long")
    run = lambda begin, n: F.struct(begin.alias("b"), n.alias("n"))
    whole = run(zero, F.col(size))
    runs = F.array(run(t["run_from"], t["run_size"]), run(zero, t["wrap_size"]))
    parts = F.concat(F.array_repeat(whole, t["epochs"].cast("int")), F.filter(runs, lambda p: p["n"] > 0))
    cut = F.array_join(F.slice(words(F.col(text)), (F.col(part)["b"] + 1).cast("int"), F.col(part)["n"].cast("int")), " ")
    out = (docs.join(picked, same).withColumn(part, F.explode(parts))
           .withColumn(text, F.when(F.col(part)["n"] == F.col(size), F.col(text)).otherwise(cut)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
