"""Large families of texts below and around the similarity."""

import random

import pytest
from pyspark.sql import functions as F

from smelter.llm import jaccard_join


def family(rng, n, words, edits, start):
    """Copies of one text, each with its own words replaced, and some of those
    with one word more replaced, which are near copies."""
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for i in range(n):
        own = list(base)
        for _ in range(edits):
            own[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append((start + i, " ".join(own)))
        if i % 10 == 0:
            own[rng.randrange(words)] = f"y{i}"
            out.append((start + 1000 + i, " ".join(own)))
    return out


def plain(rows):
    sets = {}
    for i, t in rows:
        w = t.split(" ")
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
    least = {i: i for i in sets}

    def top(i):
        while least[i] != i:
            i = least[i]
        return i

    ids = sorted(sets)
    near = links = 0
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            union = len(sets[a]) + len(sets[b]) - both
            near += 60 * union <= 100 * both < 75 * union
            if 100 * both >= 75 * union:
                links += 1
                x, y = sorted((top(a), top(b)))
                least[y] = x
    return {i: top(i) for i in ids}, near, links


@pytest.mark.parametrize("slice_size", [16, 512])
def test_family_below_the_similarity(make, monkeypatch, slice_size):
    monkeypatch.setattr(jaccard_join, "LEAST_SLICE", slice_size)
    monkeypatch.setattr(jaccard_join, "MOST_SLICE", slice_size)
    rng = random.Random(5)
    rows = family(rng, 250, 160, 5, 0) + family(rng, 60, 90, 4, 5000)
    want, near, links = plain(rows)
    assert near > 3000 and links > 20
    listed = []
    real = jaccard_join._enough

    def counting(counted, part=1):
        if part == 1:
            listed.append(counted.cache().count())
        return real(counted, part)

    monkeypatch.setattr(jaccard_join, "_enough", counting)
    found = jaccard_join.classes_of(make([(i, t, "en", "a") for i, t in rows]).repartition(3))
    assert {r.doc_id: r.component_id for r in found.collect()} == want
    # all pairs of one family share shingles in dozens of buckets; few become rows
    assert listed and sum(listed) < 0.5 * len(rows) ** 2 / 2


def test_repeated_rows_of_a_family(make):
    rng = random.Random(9)
    rows = family(rng, 60, 120, 4, 0)
    want, _, _ = plain(rows)
    docs = make([(i, t, "en", "a") for i, t in rows * 3])
    got = jaccard_join.classes_of(docs).groupBy("doc_id").agg(F.collect_set("component_id").alias("c"), F.count("*").alias("n")).collect()
    assert {r.doc_id: r.c for r in got} == {i: [c] for i, c in want.items()} and {r.n for r in got} == {3}
