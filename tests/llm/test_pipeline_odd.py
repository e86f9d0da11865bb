"""The pipeline's stages one after the other over nulls, empty and long texts,
copies, repeated rows, clashing columns, and over empty tables."""

import re
import string
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from smelter.llm.common import stored

FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _words(text):
    return WORD.findall(text or "")


def _chain(spark, docs, labels, folder):
    labels.write.parquet(f"{folder}/labels.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], str(folder)), "odd"))
    return out


@pytest.fixture(scope="module")
def chain(spark, odd, tmp_path_factory):
    labels = [(i, 1) for i in [*range(1, 17), *range(100, 120)]] + [(i, 0) for i in range(120, 130)]
    labels += [(3, 1), (None, 1), (5, None), (999, 0)]
    return _chain(spark, odd, spark.createDataFrame(labels, "doc_id long, quality int"), tmp_path_factory.mktemp("labels"))


def _rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_columns_come_back_untouched(chain):
    columns = chain[0].columns
    assert all(df.columns == columns for df in chain[:-1])
    for df in chain[1:-1]:
        kept = {tuple(r) for r in df.select("id", "key", "h", "norm", "size", "class", "take", "row_key", "of").collect()}
        assert kept == {("x", 1, 2, "n", 3, "c", "t", "r", 4)}


def test_quality_keeps_or_drops_whole_rows(chain):
    before, after = Counter(_rows(chain[0])), Counter(_rows(chain[1]))
    assert after and all(n == before[row] for row, n in after.items())


def test_exact_copies_leave_the_largest_id(chain):
    best = defaultdict(list)
    for i, text in _rows(chain[1]):
        best[(text or "").translate(FOLD)].append(i)
    want = Counter((max((i for i in ids if i is not None), default=None), t) for t, ids in best.items())
    assert Counter((i, (t or "").translate(FOLD)) for i, t in _rows(chain[2])) == want


def test_one_of_each_class_of_near_copies_stays(chain):
    rows = _rows(chain[2])
    sets = []
    for _, text in rows:
        w = _words((text or "").translate(FOLD))
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and group[a] != group[b]:
                group = [group[b] if g == group[a] else g for g in group]
    members = defaultdict(list)
    for row, g in zip(rows, group, strict=True):
        members[g].append(row)
    want = Counter(min(m, key=lambda r: (r[0] is not None, r[0] or 0)) for m in members.values())
    left = Counter(_rows(chain[3]))
    assert sum(left.values()) == len(members) and all(left[r] == n for r, n in want.items() if r[0] is not None)


def test_mix_takes_whole_texts_or_runs_of_words(chain):
    sources = defaultdict(list)
    for i, text in _rows(chain[3]):
        sources[i].append(text)
    taken = Counter()
    for i, text in _rows(chain[4]):
        words = _words(text)
        assert any(text == t or f" {' '.join(words)} " in f" {' '.join(_words(t))} " for t in sources[i])
        taken[i] += len(words)
    assert taken and all(n <= 2 * sum(len(_words(t)) for t in sources[i]) for i, n in taken.items())


def test_encoded(chain):
    table = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = Counter((i, tuple(table.encode(t or "", add_eos=True))) for i, t in _rows(chain[4]))
    assert Counter((r.doc_id, tuple(r.ids)) for r in chain[5].collect()) == want


def test_empty_tables(spark, none, tmp_path):
    out = _chain(spark, none, spark.createDataFrame([], "doc_id long, quality int"), tmp_path)
    assert all(df.count() == 0 for df in out) and all(df.columns == none.columns for df in out[:-1])
