"""Exact cosine top-k against brute force; LSH recall."""

import numpy as np

from smelter.operators import similarity


def test_exact_top_k_equals_brute_force(spark, sf_small):
    emb = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    queries = emb.filter("vec_id < 5").select((emb.vec_id + 1000).alias("qid"), "embedding")
    got = {(r.qid, r.vec_id) for r in similarity.exact_top_k(emb, queries, "vec_id", "qid", "embedding", 3).collect()}
    pdf = emb.toPandas()
    mat = np.stack(pdf.embedding.map(lambda v: np.asarray(v, dtype="float64")).to_list())
    mat_n = mat / np.linalg.norm(mat, axis=1, keepdims=True)
    want = set()
    for q in range(5):
        qi = pdf.index[pdf.vec_id == q][0]
        scores = np.round(mat_n @ mat_n[qi], 6)
        order = sorted(range(len(pdf)), key=lambda i: (-scores[i], pdf.vec_id[i]))[:3]
        want |= {(q + 1000, int(pdf.vec_id[i])) for i in order}
    assert got == want


def test_lsh_recall(spark, sf_small):
    emb = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    cents = similarity.centroids(emb, "label", "embedding", 64)
    exact = {(r.label, r.vec_id) for r in similarity.exact_top_k(emb, cents, "vec_id", "label", "embedding", 2).collect()}
    approx = {(r.label, r.vec_id) for r in similarity.lsh_candidates(emb, cents, "vec_id", "label", "embedding", 2).collect()}
    assert len(exact & approx) >= 0.8 * len(exact)


def test_index_sync_applies_only_changes(spark):
    import tempfile

    v1 = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, [3.0, 4.0])], "id int, v array<float>")
    v2 = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.0]), (4, [0.0, 1.0])], "id int, v array<float>")
    idx = similarity.SimilarityIndex(spark, tempfile.mkdtemp(prefix="idx-", dir="/tmp"), "id", "v")
    idx.sync(v1)
    idx.sync(v2)
    ops = [r.operation for r in idx.table.history().orderBy("version").collect()]
    assert ops == ["BUILD", "SYNC +1 ~1 -1"]
    rows = {r.id: [round(x, 6) for x in r.unit] for r in idx.read().collect()}
    assert rows == {1: [1.0, 0.0], 2: [1.0, 0.0], 4: [0.0, 1.0]}


def _brute(ids, mat, queries, k, digits=6):
    units = mat / np.linalg.norm(mat, axis=1, keepdims=True)
    want = set()
    for q in queries:
        scores = np.round(units @ units[q], digits)
        order = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k]
        want |= {(ids[q], ids[i], r + 1) for r, i in enumerate(order)}
    return want


def test_exact_top_k_over_many_blocks_and_ties(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK", 16)
    monkeypatch.setattr(similarity, "HELD_BLOCKS", 2)
    rng = np.random.default_rng(3)
    mat = rng.normal(size=(300, 8))
    mat[100:200] = mat[7]  # a third of the rows are one vector
    ids = [f"v{i:03d}" for i in range(300)]
    rows = [(i, v.tolist()) for i, v in zip(ids, mat, strict=True)]
    odd = [("null", None), ("zero", [0.0] * 8), ("nan", [float("nan")] * 8), ("hole", [None] + [1.0] * 7), ("empty", [])]
    emb = spark.createDataFrame(rows + odd, "id string, v array<double>").repartition(5)
    got = similarity.exact_top_k(emb, emb.withColumnRenamed("id", "q"), "id", "q", "v", 12)
    assert {(r.q, r.id, r["rank"]) for r in got.collect()} == _brute(ids, mat, range(300), 12)
    none = similarity.exact_top_k(emb.limit(0), emb.withColumnRenamed("id", "q"), "id", "q", "v", 2)
    assert none.count() == 0


def test_cells_kept_in_step_and_recall(spark):
    import tempfile

    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 24))
    mat = centres[rng.integers(0, 30, 2400)] + 0.4 * rng.normal(size=(2400, 24))
    mat[:800] = centres[0] + 0.4 * rng.normal(size=(800, 24))  # a crowded cell
    emb = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(mat)], "id int, v array<double>")
    cells = similarity.fit_cells(emb.filter("id < 1500"), "id", "v")
    assert cells.probes < len(cells.centroids) / 2
    index = similarity.SimilarityIndex(spark, tempfile.mkdtemp(prefix="idx-", dir="/tmp"), "id", "v", cells)
    index.sync(emb.filter("id < 1500"))
    index.sync(emb)
    queries = emb.filter("id % 20 = 0").withColumnRenamed("id", "q")
    got = {(r.q, r.id) for r in index.search(queries, "q", "v", 10).collect()}
    want = {(q, i) for q, i, _ in _brute(list(range(2400)), mat, range(0, 2400, 20), 10)}
    assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)


def test_cells_of_an_empty_table(spark):
    emb = spark.createDataFrame([], "id int, v array<double>")
    cells = similarity.fit_cells(emb, "id", "v")
    stock = similarity.with_cells(emb, "v", cells)
    assert similarity.cell_top_k(stock, emb.withColumnRenamed("id", "q"), "id", "q", "v", 3, cells).count() == 0
