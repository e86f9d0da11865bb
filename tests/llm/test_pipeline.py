"""The pipeline at a small size, stage by stage against plain versions."""

import re
import string

import duckdb
import public_tokenizers
import pytest
import sentencepiece

import __spark_entry__ as entry
import corpus_pipeline
from smelter.llm.common import documents, stored
from smelter.llm.queries import QUERIES

FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


@pytest.fixture(scope="module")
def kept(spark, sf_small):
    docs, out = documents(spark, sf_small), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_small), "t")
        out.append(docs)
    return out


def test_stages(spark, sf_small, kept):
    columns = documents(spark, sf_small).columns
    assert all(k.columns == columns for k in kept[:-1])
    good, exact, near, mixed = ({(r.doc_id, r.text) for r in k.collect()} for k in kept[:-1])
    every = {(r.doc_id, r.text) for r in documents(spark, sf_small).collect()}
    assert good < every and exact <= good and near <= exact
    best = {}
    for i, t in good:
        best[t.translate(FOLD)] = max(best.get(t.translate(FOLD), i), i)
    assert {i for i, _ in exact} == set(best.values())
    sets = {i: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} for i, t in exact
            for w in [re.findall(r"[^\x20\x09-\x0D]+", t.translate(FOLD))]}
    left = {i for i, _ in near}
    for a in left:
        assert not any(b in left and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) for b in left if b < a)
    for a in set(sets) - left:
        assert any(b != a and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) for b in sets)
    assert {i for i, _ in mixed} <= left


def test_encoded(kept):
    table = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = sorted((r.doc_id, table.encode(r.text, add_eos=True)) for r in kept[3].collect())
    assert sorted((r.doc_id, list(r.ids)) for r in kept[4].collect()) == texts


def test_registered(spark, sf_small):
    queries = entry.queries()
    assert "pipeline" in queries and all(any(q.startswith(f"op{n}_") for q in queries) for n in range(1, 11))
    assert set(QUERIES) < set(queries)


#: Queries with other rows than one per input row: turns, words, triples.
OTHER_ROWS = {"op10_chat_format", "op12_spelling_variants", "op13_hard_negatives"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - OTHER_ROWS))
def test_one_row_per_input_row(spark, sf_small, name):
    table, id = ("pages", "page_id") if name == "op11_warc" else ("documents", "doc_id")
    got = [r[id] for r in QUERIES[name](spark, sf_small).collect()]
    (want,) = zip(*duckdb.sql(f"select {id} from '{sf_small}/{table}.parquet'").fetchall())
    assert sorted(got) == sorted(want)
