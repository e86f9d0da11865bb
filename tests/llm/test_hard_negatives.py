import math
import random

import duckdb
import numpy as np
import pytest

from smelter.llm import hard_negatives
from smelter.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, id long, vec string, leaf int, slice int, score long"


def plain(rows):
    """Sorted result rows by definition; rows are (vec_id, vector, label)."""
    best = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in v]
        key = (str(label), np.array(q, np.int32).tobytes())
        if i not in best or key < best[i][0]:
            best[i] = (key, q, label)
    score = lambda a, b: sum(x * y for x, y in zip(best[a][1], best[b][1]))
    out = []
    for a in best:
        if a % 100 == 0:
            same = [(-score(a, b), b) for b in best if b != a and best[b][2] == best[a][2]]
            other = [(-score(a, b), b) for b in best if best[b][2] != best[a][2]]
            for p, b in sorted(same)[:5]:
                fits = sorted((s, c) for s, c in other if 80 * -p <= 100 * -s <= 100 * -p)[:5]
                out += [(a, b, r, c, -p, -s) for r, (s, c) in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows, parts=4):
    frame = spark.createDataFrame([(i, v, y, 1, "v", 2, 3, 4) for i, v, y in rows], SCHEMA).repartition(parts)
    return sorted(tuple(r) for r in hard_negatives.mine(frame, frame["vec_id"] % 100 == 0).collect())


def clustered(n, dim=12, clusters=30, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    rows = []
    for i in range(n):
        v = centres[i % clusters] + rng.normal(size=dim) * 0.08
        rows.append((i, (v / np.linalg.norm(v)).astype(np.float32).tolist(), int(rng.integers(0, 3))))
    return rows


@pytest.fixture
def small(monkeypatch):
    for name, value in (("LEAF_ROWS", 30), ("BLOCK_ROWS", 16), ("FANOUT", 5), ("SAMPLE_ROWS", 400)):
        monkeypatch.setattr(hard_negatives, name, value)


def test_against_definition(spark, small):
    rows = clustered(900)
    assert mined(spark, rows) == plain(rows) != []


def test_odd_rows(spark, small):
    rows = clustered(420, 4)
    rng = random.Random(2)
    rows += [(500, None, 1), (600, [0.1, 0.2], 1), (700, [0.1, None, 0.3, 0.1], 2), (None, [0.1] * 4, 1), (800, [float("nan")] * 4, 1),
             (900, [float("inf"), 0.0, 0.0, 0.0], 0), (1000, [0.1] * 4, None), (1100, [], 1), (1200, [0.3] * 6, 2), (1300, [-0.3] * 4, 7)]
    # a hot vector under two labels, ties everywhere, and rows that repeat or share an id
    rows += [(2000 + i, [0.5, 0.5, -0.5, 0.5], i % 2) for i in range(150)] + [(2000, [0.5, 0.5, -0.5, 0.5], 0)] * 40
    rows += [(3000, [rng.random() for _ in range(4)], y) for y in (2, 0, 1)]
    got = mined(spark, rows)
    assert got == plain(rows) and {2000, 2100, 3000} <= {r[0] for r in got}


def test_nothing_to_mine(spark):
    assert mined(spark, [], 1) == [] and mined(spark, [(0, [0.1], 1)], 1) == [] and mined(spark, [(0, None, None)], 1) == []
    assert mined(spark, [(0, [0.5], 1), (1, [0.5], 1)], 1) == []


def test_large_components_stay_exact(spark, small):
    rng = np.random.default_rng(3)
    rows = [(50 * i, (rng.normal(size=3) * 4000).astype(np.float32).tolist(), i % 3) for i in range(60)]
    rows += [(50 * i + 7, (rng.normal(size=3) * 1_000_000).astype(np.float32).tolist(), i % 3) for i in range(60)]
    assert mined(spark, rows) == plain(rows) != []


def test_siblings_are_eliminated(spark, small):
    """On clustered vectors an anchor is sent to a few leaves only, and a
    search of those finds all that brute force finds."""
    rows = clustered(3000, 16, 60, 9)
    frame = spark.createDataFrame([(i, v, y, 1, "v", 2, 3, 4) for i, v, y in rows], SCHEMA)
    vectors = hard_negatives.whole_vectors(frame, "vec_id", "embedding", "label")
    index = hard_negatives.Index(vectors)
    q = np.floor(256 * np.array([v for _, v, _ in rows], np.float32).astype(float))
    scores = q[::100] @ q.T
    lo = np.sort(scores, 1)[:, -20]
    anchor, leaf = index.tree.reach(q[::100], lo, np.full(len(lo), 1e18))
    assert index.tree.leaves > 60 and len(anchor) < 0.35 * index.tree.leaves * len(lo)
    home, reached = index.tree.place(q), set(zip(anchor.tolist(), leaf.tolist()))
    assert all((a, home[b]) in reached for a, b in zip(*np.nonzero(scores >= lo[:, None])))


def test_query_against_sql(spark, sf_small):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf_small}/embeddings.parquet'")
    want = sorted(con.execute(ORACLES["op13_hard_negatives"]).fetchall())
    got = QUERIES["op13_hard_negatives"](spark, sf_small)
    assert sorted(tuple(r) for r in got.collect()) == want != []
