import random
import re
import zlib
from collections import Counter

import numpy as np

from smelter.llm import spelling
from smelter.llm.common import documents
from smelter.llm.queries import QUERIES


def plain(rows):
    """{word: (form, root, n, n_near, form_n)} by definition."""
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    alphabet = sorted({c for w in n for c in w})
    near = {}
    for w in n:
        edits = {w[:i] + w[i + 1:] for i in range(len(w))}
        edits |= {w[:i] + c + w[i + k:] for i in range(len(w) + 1) for c in alphabet for k in (0, 1)}
        near[w] = [x for x in edits if x in n and x != w]
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def found(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def spelled(rng, rows):
    """Texts of words at many frequencies with all kinds of edits."""
    letters = "abcdeéÀ×"
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(6, 12))) for _ in range(40)]
    def edit(w):
        i, c = rng.randrange(len(w)), rng.choice(letters)
        return rng.choice([w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:]])
    words = []
    for k, w in enumerate(base):
        chain, count = w, 5 * 5 ** (k % 4)
        while count >= 5:
            words += [chain] * count
            words += [edit(chain) for _ in range(8) for _ in range(rng.randrange(1, 7))]
            chain, count = edit(chain), count // 5
    words = [w.upper() if rng.random() < 0.2 else w for w in words]
    rng.shuffle(words)
    return [(i, " ".join(words[i::rows])) for i in range(rows)]


def test_against_definition(make):
    rng = random.Random(8)
    rows = spelled(rng, 60) + [(None, "chateau " * 7), (900, None), (901, ""), (902, "aaaaaaaa-aaaaaaa " * 30),
                               (903, "ÀÉÎ÷×àé Straße STRASSE naïveté " * 9), (904, "x" * 3000 + " " + ("y" * 700 + " ") * 6 + ("y" * 699 + " ") * 31)]
    rows += [(905, "repeat repeats repeated ")] * 12
    docs = make([(i, t, "en", "a") for i, t in rows])
    got, want = found(spelling.variant_groups(docs.repartition(5))), plain(rows)
    assert got == want
    assert any(v[1] != v[0] and v[0] for v in want.values()) and sum(v[0] is not None for v in want.values()) > 20


def test_no_words(make, none):
    assert found(spelling.variant_groups(none)) == {}
    assert found(spelling.variant_groups(make([(1, "one two", "en", "a"), (2, None, None, None)]))) == {}


def test_small_filters_lose_nothing(make, monkeypatch):
    """With a few bits a word nearly all probes pass; the join drops them."""
    monkeypatch.setattr(spelling, "FILTER_BYTES", 64)
    rows = spelled(random.Random(3), 12)
    assert found(spelling.variant_groups(make([(i, t, "en", "a") for i, t in rows]))) == plain(rows)


def test_filter_has_no_false_negatives_and_few_false_positives():
    rng = np.random.default_rng(1)
    keys, others = (rng.integers(0, 1 << 63, 20_000, dtype=np.uint64) * np.uint64(3) for _ in range(2))
    lanes = np.zeros((20_000 * spelling.BITS_A_WORD // 256, spelling.LANES), np.uint32)
    block = spelling.Filter.block(keys, len(lanes))
    for lane in range(spelling.LANES):
        np.bitwise_or.at(lanes[:, lane], block, np.uint32(1) << spelling.Filter.bit(keys, lane))
    table = spelling.Filter(lanes)
    assert len(table.holds(keys)) == len(keys) and len(table.holds(others)) < 0.01 * len(others)


def test_query_on_documents(spark, sf_small):
    rows = [(r.doc_id, r.text) for r in documents(spark, sf_small).collect()]
    assert found(QUERIES["op12_spelling_variants"](spark, sf_small)) == plain(rows)
