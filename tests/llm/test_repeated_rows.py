"""op1 and op2 on rows that repeat id and text: work stays linear."""

import random

import pytest
from pyspark.sql import functions as F

from smelter.llm import exact_dedup, substring_dedup
from smelter.llm.common import keyed_texts, stored


def _words(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """One text in 2,000 equal rows; two others that share a part with it in
    other surroundings, and one of their own."""
    rng = random.Random(11)
    text = _words(rng, 300)
    near = text[:900] + _words(rng, 40) + text[1200:]
    lone = _words(rng, 200)
    return text, near, lone


def _plain(texts):
    """Removed bytes of each text by looking every 200-byte string up."""
    places = {}
    for t, data in enumerate(texts):
        for i in range(len(data) - 199):
            places.setdefault(data[i:i + 200], []).append((t, i))
    gone = [set() for _ in texts]
    for found in places.values():
        if len(found) > 1:
            for t, i in found:
                gone[t].update(range(i, i + 200))
    return gone


def test_repeated_rows_equal_plain(spark, make, corpus):
    text, near, lone = corpus
    rows = [(1, text)] * 3 + [(2, near), (3, lone), (4, lone[:150]), (4, lone[:150]), (5, None), (6, near[:1000])]
    docs = make([(i, t, "en", "a") for i, t in rows])
    want = sorted((i, len(g)) for (i, _), g in zip(rows, _plain([(t or "").encode() for _, t in rows]), strict=True))
    got = sorted((r.doc_id, r.n_removed) for r in substring_dedup.remove_repeats(docs).collect())
    assert got == want


def test_marks_follow_rows_not_their_squares(spark, make, corpus, monkeypatch):
    text, near, lone = corpus
    docs = make([(1, text, "en", "a"), (2, near, "en", "a"), (3, lone, "en", "a")])
    many = docs.where("doc_id = 1").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(2000)))).drop("n")
    docs = docs.where("doc_id > 1").union(many)
    cut = []
    whole = substring_dedup._cut_out
    monkeypatch.setattr(substring_dedup, "_cut_out", lambda *a: cut.append(stored(whole(*a), "cuts")) or cut[-1])
    spans = stored(substring_dedup.removed_spans(keyed_texts(docs, "doc_id", "text")), "spans")
    # a block of some 80 bytes step each: one span a block and row, and one cut a block
    assert spans.count() <= 2000 * len(text) / 40
    assert sum(c.count() for c in cut) <= 3 * len(text) / 20
    out = substring_dedup.remove_repeats(docs).groupBy("doc_id").agg(F.min("n_removed").alias("low"), F.max("n_removed").alias("high"))
    found = {r.doc_id: (r.low, r.high) for r in out.collect()}
    assert found[1] == (len(text), len(text)) and found[3] == (0, 0) and 0 < found[2][0] < len(near)


def test_one_of_many_repeated_rows_is_kept_without_a_window(spark, make):
    many = make([(9, "Same Text", "en", "a")]).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(5000)))).drop("n")
    docs = many.union(make([(3, "same text", "en", "b"), (9, "other", "en", "b"), (None, None, "en", "b"), (None, "", "en", "b")])).repartition(7)
    found = exact_dedup.decisions(docs)
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()
    rows = found.groupBy("doc_id", "keep_id", "group_size").agg(F.count("*").alias("n"), F.count_if("kept").alias("kept")).collect()
    assert {tuple(r) for r in rows} == {(9, 9, 5001, 5000, 1), (3, 9, 5001, 1, 0), (9, 9, 1, 1, 1), (None, None, 2, 2, 1)}
    assert sorted((r.doc_id or 0, r.text or "") for r in exact_dedup.drop_copies(docs).collect()) == [(0, ""), (9, "Same Text"), (9, "other")]
