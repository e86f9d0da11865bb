"""Operators over documents against plain versions, on hand-made rows."""

import hashlib
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from smelter.llm import (components, exact_dedup, fuzzy_lines, jaccard_join, language_id, mixing, quality_gam,
                         quality_rules, sentencepiece_bpe, substring_dedup)
from smelter.llm.run_index import RunIndex

FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def test_exact_dedup(odd, odd_rows, none):
    groups = defaultdict(list)
    for i, t, _, _ in odd_rows:
        groups[(t or "").translate(FOLD)].append(i)
    want, best = [], {}
    for i, t, _, _ in odd_rows:
        n = (t or "").translate(FOLD)
        keep = max((x for x in groups[n] if x is not None), default=None)
        kept = i == keep and n not in best
        if kept:
            best[n] = i
        want.append((i, keep, len(groups[n]), kept, sha(n)))
    columns = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert tuples(exact_dedup.decisions(odd), *columns) == sorted(want, key=repr)
    # a hash under which most texts collide changes nothing
    assert tuples(exact_dedup.decisions(odd, hash=lambda t: F.length(t) % 3), *columns) == sorted(want, key=repr)
    left = exact_dedup.drop_copies(odd)
    assert left.columns == odd.columns
    assert sorted((r.text or "").translate(FOLD) for r in left.collect()) == sorted(groups)
    assert exact_dedup.decisions(none).count() == 0 and exact_dedup.drop_copies(none).count() == 0


def plain_sets(rows):
    out = {}
    for k, (_, t, _, _) in enumerate(rows):
        w = WORD.findall((t or "").translate(FOLD))
        out[k] = frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])
    return out


def plain_classes(sets):
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {k: find(k) for k in sets}


def jaccard_want(rows):
    sets = plain_sets(rows)
    root = plain_classes(sets)
    ids = defaultdict(list)
    for k, (i, _, _, _) in enumerate(rows):
        ids[root[k]].append(i)
    # texts without a shingle link with nothing
    return [(i, len(sets[k]), min((x for x in ids[root[k]] if x is not None), default=None) if sets[k] else i)
            for k, (i, _, _, _) in enumerate(rows)]


def test_jaccard_join(odd, odd_rows, none):
    got = jaccard_join.classes_of(odd)
    assert tuples(got, "doc_id", "n_shingles", "component_id") == sorted(jaccard_want(odd_rows), key=repr)
    kept = jaccard_join.keep_one(odd)
    assert kept.columns == odd.columns
    sets = plain_sets(odd_rows)
    assert kept.count() == len({r for k, r in plain_classes(sets).items() if sets[k]}) + len(
        {(r[0], r[1] or "") for k, r in enumerate(odd_rows) if not sets[k]})
    assert jaccard_join.classes_of(none).count() == 0


def test_jaccard_join_of_chains_and_large_groups(make):
    """Classes held together only by chains, and many near copies of one text."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[3 * i:3 * i + 100]), "en", "a") for i in range(60)]
    for i in range(150):
        w = [f"v{k}" for k in range(130)]
        w[i % 130], w[(i * 7) % 130] = f"q{i}", "z"
        rows.append((1000 + i, " ".join(w), "en", "a"))
    assert tuples(jaccard_join.classes_of(make(rows)), "doc_id", "n_shingles", "component_id") == sorted(jaccard_want(rows), key=repr)


def test_prefix_needs_fewer_matches_than_any_partner_shares():
    rng = np.random.default_rng(0)
    classes = rng.integers(0, 3, jaccard_join.CELLS).astype(np.uint8)
    for _ in range(300):
        common = rng.integers(0, 1 << 63, rng.integers(1, 200), dtype=np.uint64)
        x = np.unique(np.concatenate([common, rng.integers(0, 1 << 63, rng.integers(0, 40), dtype=np.uint64)]))
        y = np.unique(np.concatenate([common, rng.integers(0, 1 << 63, rng.integers(0, 40), dtype=np.uint64)]))
        both = len(np.intersect1d(x, y))
        if 100 * both < 75 * (len(x) + len(y) - both):
            continue
        px, py = jaccard_join.prefix(x, classes), jaccard_join.prefix(y, classes)
        need = -(-75 * (len(x) + len(y)) // 175) - max(len(x) - len(px), len(y) - len(py))
        assert len(np.intersect1d(px, py)) >= max(need, 1)


def plain_repeats(texts, least=200):
    count = Counter(t[k:k + least] for t in texts for k in range(len(t) - least + 1))
    out = []
    for t in texts:
        cover = bytearray(len(t))
        for k in range(len(t) - least + 1):
            if count[t[k:k + least]] > 1:
                cover[k:k + least] = b"\1" * least
        runs = sum(1 for k, c in enumerate(cover) if c and (not k or not cover[k - 1]))
        out.append((len(t), sum(cover), runs, sha(bytes(x for x, c in zip(t, cover) if not c))))
    return out


@pytest.mark.parametrize("crowd", [6000, 1])
def test_substring_dedup(odd, odd_rows, none, monkeypatch, crowd):
    monkeypatch.setattr(substring_dedup, "INDEX_BLOCKS", crowd)  # 1: all differing blocks take the grid
    want = [(r[0], *p) for r, p in zip(odd_rows, plain_repeats([(r[1] or "").encode() for r in odd_rows]))]
    assert tuples(substring_dedup.remove_repeats(odd), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(want, key=repr)
    assert substring_dedup.remove_repeats(none).count() == 0


@pytest.mark.parametrize("crowd", [6000, 2])
def test_substring_dedup_of_shared_passages(make, monkeypatch, crowd):
    monkeypatch.setattr(substring_dedup, "INDEX_BLOCKS", crowd)
    rng = np.random.default_rng(4)
    letters = lambda n: "".join(rng.choice(list("abcdefgh é"), n))
    passages = [letters(n) for n in (199, 200, 201, 260, 700)]
    rows = [(i, letters(rng.integers(0, 300)) + passages[i % 5] + letters(rng.integers(0, 300)) + passages[(i * 3) % 5][:230], "en", "a")
            for i in range(60)]
    rows += [(100, passages[4] * 3, "en", "a"), (101, "ab" * 400, "en", "a"), (102, "c" * 250, "en", "a")]
    want = [(r[0], *p) for r, p in zip(rows, plain_repeats([r[1].encode() for r in rows]))]
    assert tuples(substring_dedup.remove_repeats(make(rows)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(want, key=repr)


def test_long_texts_are_cut_into_pieces(make, monkeypatch):
    monkeypatch.setattr(substring_dedup, "PIECE", 1000)
    rng = np.random.default_rng(5)
    text = "".join(rng.choice(list("abcdefghij "), 7000))
    rows = [(1, text, "en", "a"), (2, "x" + text[300:5000], "en", "a")]
    want = [(r[0], *p) for r, p in zip(rows, plain_repeats([r[1].encode() for r in rows]))]
    assert tuples(substring_dedup.remove_repeats(make(rows)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_run_index_matching_statistics():
    rng = np.random.default_rng(1)
    for k in range(30):
        strings = [bytes(rng.choice(list(b"ab" if k % 2 else b"abcd"), rng.integers(0, 40))) for _ in range(rng.integers(1, 8))]
        got = RunIndex(strings).matching_statistics()
        places = [(s, i) for s, text in enumerate(strings) for i in range(len(text) + 1)]
        for at, (s, i) in enumerate(places):
            best = 0
            for t, j in places:
                if (s, i) != (t, j):
                    a, b = strings[s][i:], strings[t][j:]
                    n = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
                    best = max(best, n)
            assert got[at] == best


def test_language_id(make, odd, none):
    en, fr = "the light over the hill and the old road ", "les rues de la ville sont belles et la nuit "
    rows = [(i, (en if i % 2 else fr) * (1 + i % 4), "en" if i % 2 else "fr", "a") for i in range(60)]
    rows += [(900, None, "en", "a"), (901, "123 !!", "fr", "a"), (902, "", None, "a"), (903, "漢字", None, "a"), (904, en, None, "a")]
    docs = make(rows)
    model = language_id.fit(docs.where("doc_id % 4 <> 2"))
    got = {r["doc_id"]: r for r in language_id.predict(docs, model).collect()}
    assert all(got[i]["lang_pred"] == ("en" if i % 2 else "fr") and 0.5 < got[i]["score"] <= 1 for i in range(60))
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (900, 901, 902))
    assert got[903]["lang_pred"] in ("en", "fr") and got[904]["lang_pred"] == "en"
    assert {r["lang_pred"] for r in language_id.predict(odd, language_id.fit(none)).collect()} == {"und"}
    assert language_id.predict(none, model).count() == 0
    for n in (1, 2, 5, 6, 7, 40):
        code = language_id.codewords(n)
        apart = [(a != b).sum() for i, a in enumerate(code) for b in code[:i]]
        assert code.shape[0] == n and (n < 2 or min(apart) >= max(1, 2 ** (n - 2) if n <= 6 else 4))


def test_sentencepiece(odd, odd_rows, none):
    table = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = []
    for i, t, _, _ in odd_rows:
        ids = table.encode(t or "", add_eos=True)
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(table.decode(ids)), ids))
    got = sentencepiece_bpe.encode_documents(odd, MODEL, with_ids=True)
    assert tuples(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids") == sorted(want, key=repr)
    assert sentencepiece_bpe.encode_documents(none, MODEL).count() == 0


def test_sentencepiece_on_joined_pieces_and_any_ids():
    rng = np.random.default_rng(2)
    ours = sentencepiece_bpe.PieceTable(open(MODEL, "rb").read())
    table = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for _ in range(3000):
        text = "".join(ours.pieces[i].replace("▁", " ") for i in rng.integers(259, 32000, rng.integers(1, 9)))
        ids = table.encode(text, add_eos=True)
        assert ours.encode(text) == ids and ours.decode(ids) == table.decode(ids)
        ids = rng.integers(3, 400, 12).tolist()
        assert ours.decode(ids) == table.decode(ids)


def plain_statistics(t):
    t = t or ""
    w = WORD.findall(t)
    grams = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    count, cover = Counter(grams), set()
    for k, g in enumerate(grams):
        if count[g] > 1:
            cover |= {k, k + 1, k + 2}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover)


def test_quality_rules(spark, odd, odd_rows, none, make):
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    want = [(r[0], *plain_statistics(r[1])) for r in odd_rows]
    assert tuples(quality_rules.statistics(odd), *columns) == sorted(want, key=repr)
    # a filter on the counts neither changes them nor multiplies the work
    assert quality_rules.statistics(odd).where("n_repeat_words > 0").count() == sum(w[5] > 0 for w in want)
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(f"w{x}" + ("#" if i % 3 == 0 else "") for x in rng.integers(0, 10**6, 80)), "en", "a") for i in range(90)]
    labels = spark.createDataFrame([(i, 0 if i % 3 == 0 else 1, 0) for i in range(90)] + [(5, None, 0), (None, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    docs = make(rows)
    rules = quality_rules.learn_list(quality_rules.labelled_rates(docs, labels))
    got = quality_rules.decide(docs, rules)
    assert {r["doc_id"] for r in got.where("kept").collect()} == {i for i in range(90) if i % 3}
    empty = quality_rules.learn_list(quality_rules.labelled_rates(none, labels))
    assert empty.rules == []
    assert tuples(quality_rules.decide(odd, empty), "doc_id", "kept") == sorted(
        ((w[0], not (w[1] < 50 or 100 * w[5] > 50 * w[1])) for w in want), key=repr)
    assert quality_rules.decide(none, rules).count() == 0


def test_quality_classifier(spark, odd, odd_rows, none, make):
    rng = np.random.default_rng(0)
    text = lambda bad: " ".join(f"w{x}" + ("!!" if bad else "") for x in rng.integers(0, 10**6, 60))
    rows = [(i, text(i % 4 == 0), "en", "a") for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(200)] + [(3, None, 0), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    docs = make(rows)
    model = quality_gam.fit(docs, labels.where("doc_id % 5 <> 0"))
    got = {r["doc_id"]: r["score"] for r in quality_gam.predict(docs, model).collect()}
    assert all((got[i] >= 0.3) == (i % 4 != 0) for i in range(200))
    assert model.pairs and all(len(t) == len(e) + 1 for t, e in zip(model.tables, model.edges))
    kept = quality_gam.keep_good(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i in range(200) if i % 4}
    odd_scores = quality_gam.predict(odd, model).collect()
    assert len(odd_scores) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in odd_scores)
    assert quality_gam.keep_good(odd, quality_gam.fit(none, labels)).count() == len(odd_rows)
    assert {r["score"] for r in quality_gam.predict(odd, quality_gam.fit(none, labels)).collect()} == {0.5}
    assert quality_gam.predict(none, model).count() == 0 and quality_gam.keep_good(none, model).count() == 0


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(1000 + i, 1001 + i) for i in range(120)]
    links += [(5000, 4000 + i) for i in range(200)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = components.connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b")
    assert tuples(got, "node", "component") == sorted(((x, find(x)) for x in parent), key=repr)
    assert components.connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def plain_fuzzy(rows):
    """Removed line numbers of each distinct (id, text), by all pairs."""
    fold = lambda line: tuple(bytes(fuzzy_lines._FOLD[np.frombuffer(line.encode(), np.uint8)]).split())
    seen, occ = [], []
    for i, t, _, _ in rows:
        if (i, t or "") not in seen and t:
            occ += [(i is None, i or 0, t, n, fold(line)) for n, line in enumerate(t.split("\n")) if len(fold(line)) >= 5]
        seen.append((i, t or ""))
    keys = sorted({o[4] for o in occ})
    data = np.frombuffer(b"\n".join(b" ".join(k) for k in keys), np.uint8)
    marks = fuzzy_lines.line_table(data, np.array([0, len(data)]))[4].view(np.uint64)
    parent = list(range(len(keys)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(keys)):
        for b in range(a):
            if int(marks[a] ^ marks[b]).bit_count() <= 3:
                x, y = keys[a], keys[b]
                row = list(range(len(y) + 1))
                for i, p in enumerate(x):
                    row = [last := i + 1] + [last := min(row[j] + (p != q), row[j + 1] + 1, last + 1) for j, q in enumerate(y)]
                assert row[-1] == fuzzy_lines.edit_distance(list(x), list(y))
                if 100 * row[-1] <= 20 * max(len(x), len(y)):
                    parent[max(find(a), find(b))] = min(find(a), find(b))
    first, gone = set(), defaultdict(list)
    for none, i, t, n, words in sorted(occ, key=lambda o: (o[0], o[1], o[3])):
        root = find(keys.index(words))
        if root in first:
            gone[(None if none else i, t)].append(n)
        first.add(root)
    return gone


def test_fuzzy_lines(odd, odd_rows, none, make):
    def check(rows, docs):
        gone = plain_fuzzy(rows)
        want = [(i, len(t.split("\n")) if t else 0, gone.get((i, t), [])) for i, t, _, _ in rows]
        assert tuples(fuzzy_lines.decisions(docs), "doc_id", "n_lines", "removed_lines") == sorted(want, key=repr)

    rows = [r for r in odd_rows if r[0] is not None]
    check(rows, make(rows))
    words = [f"word{i}" for i in range(60)]
    rows = []
    for i in range(80):
        lines = ["A common line that all of them share.", f"short {i}"]
        for k in range(4):
            w = words[k * 5:k * 5 + 40]
            w[(i * 3) % 40] = f"w{i % 7}"
            lines.append(" ".join(w))
        rows.append((i, "\n".join(lines), "en", "a"))
    docs = make(rows)
    check(rows, docs)
    out = {r["doc_id"]: r["text"] for r in fuzzy_lines.remove_lines(docs).collect()}
    gone = plain_fuzzy(rows)
    assert out == {i: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone.get((i, t), [])) for i, t, _, _ in rows}
    assert fuzzy_lines.decisions(none).count() == 0 and fuzzy_lines.remove_lines(odd).count() == len(odd_rows)


def plain_targets(sizes):
    weight = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    total, cap = 1.5 * sum(sizes), [2.0 * s for s in sizes]
    out, free = [0.0] * len(sizes), set(range(len(sizes)))
    while free:
        level = (total - sum(cap[i] for i in range(len(sizes)) if i not in free)) / sum(weight[i] for i in free)
        over = {i for i in free if level * weight[i] > cap[i]}
        for i in free:
            out[i] = min(level * weight[i], cap[i])
        if not over:
            return out
        free -= over
    return out


def test_mixing(odd, odd_rows, none, make):
    rng = np.random.default_rng(1)
    rows = odd_rows + [(2000 + i, " ".join(f"w{x}" for x in range(rng.integers(1, 400))), "en", str(rng.choice(["a", "b", "c", "q"])))
                       for i in range(300)]
    docs = make(rows)
    mixed = mixing.mix(docs, mixing.word_count(F.col("text"))).collect()
    sources = sorted({r[3] for r in rows if r[3] is not None}) + [None]
    sizes = [sum(len(WORD.findall(r[1] or "")) for r in rows if r[3] == s) for s in sources]
    want = dict(zip(sources, plain_targets(sizes)))
    taken = Counter()
    for r in mixed:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 2 * mixing.BLOCK_TOKENS for s in sources)
    again = mixing.mix(make(rows[::-1]).repartition(3), mixing.word_count(F.col("text")))
    assert tuples(again, "doc_id", "size", "taken") == sorted(((r["doc_id"], r["size"], r["taken"]) for r in mixed), key=repr)
    out = mixing.apply_mix(docs)
    assert out.columns == docs.columns
    words = Counter()
    for r in out.collect():
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
    single = [i for i, n in Counter(r[0] for r in rows).items() if n == 1 and i is not None]
    assert {i: words[i] for i in single} == {r["doc_id"]: r["taken"] for r in mixed if r["doc_id"] in single}
    assert mixing.mix(none, mixing.word_count(F.col("text"))).count() == 0 and mixing.apply_mix(none).count() == 0


def test_apportion_is_highest_quotients():
    rng = np.random.default_rng(0)
    for _ in range(200):
        votes = rng.integers(0, 1000, rng.integers(1, 9)).astype(float).tolist()
        seats = int(rng.integers(0, 60))
        most = rng.integers(0, 30, len(votes)).tolist() if rng.random() < 0.5 else [seats] * len(votes)
        got = [0] * len(votes)
        for _ in range(seats):
            best = max(((v / (2 * g + 1), -i) for i, (v, g, m) in enumerate(zip(votes, got, most)) if v > 0 and g < m), default=None)
            if best is None:
                break
            got[-best[1]] += 1
        assert mixing.apportion(votes, seats, most) == got


def test_folds_follow_crc32(spark):
    from smelter.llm.queries import _fold
    df = spark.range(50).withColumnRenamed("id", "doc_id")
    assert [r[0] for r in df.select(_fold(df, 4)).collect()] == [zlib.crc32(str(i).encode()) % 4 for i in range(50)]
