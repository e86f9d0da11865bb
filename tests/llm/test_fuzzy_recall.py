"""op8 against edit similarity alone, without any step that finds candidates."""

import random

import numpy as np
import pytest

from smelter.llm import fuzzy_lines


def removed(lines, least=5):
    """Removed lines of documents 0, 1, ... of one line each, by all pairs."""
    words = [tuple(bytes(fuzzy_lines._FOLD[np.frombuffer(x.encode(), np.uint8)]).split()) for x in lines]
    root = list(range(len(lines)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(lines)):
        for b in range(a):
            x, y = words[a], words[b]
            if min(len(x), len(y)) < least or 5 * abs(len(x) - len(y)) > max(len(x), len(y)) or find(a) == find(b):
                continue
            if 5 * fuzzy_lines.edit_distance(list(x), list(y)) <= max(len(x), len(y)):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {i for i in range(len(lines)) if find(i) != i}


def decided(make, lines, **how):
    docs = make([(i, x, "en", "a") for i, x in enumerate(lines)])
    return {r["doc_id"] for r in fuzzy_lines.decisions(docs, **how).where("n_removed > 0").collect()}


def test_edited_lines_are_found(make):
    """One word replaced, or up to a fifth edited, in lines of 8 to 30 words."""
    rng, lines = random.Random(5), []
    for k in range(120):
        words = [f"{rng.choice('abcdefgh')}{rng.randrange(400)}" for _ in range(8 + k % 23)]
        lines.append(" ".join(words))
        for _ in range(1 if k % 2 else len(words) // 5):
            at = rng.randrange(len(words))
            words[at:at + 1] = rng.choice([["new"], ["new"], [], [words[at], "more"]]) if not k % 2 else [f"new{k}"]
        lines.append(" ".join(words))
    want = removed(lines)
    assert len(want) >= 110 and decided(make, lines) == want


@pytest.mark.parametrize("crowd", [500, 4])
def test_log_lines_stay_apart(make, monkeypatch, crowd):
    """Lines with one long word and numbers are different unless most words are
    the same; crowded buckets are split without losing a pair."""
    monkeypatch.setattr(fuzzy_lines, "CROWD", crowd, raising=False)
    monkeypatch.setattr(fuzzy_lines, "SPLIT", crowd, raising=False)
    rng = random.Random(6)
    lines = [f"error {rng.randrange(3)}:{rng.randrange(4)}:{rng.randrange(60)} {rng.randrange(60)} {rng.randrange(60)}" for _ in range(150)]
    want = removed(lines)
    assert 0 < len(want) < 149 and decided(make, lines) == want


def test_crowded_bucket_lists_few_pairs(spark):
    """Lines that share one word pair only are no candidates of each other."""
    names = "bucket long, hash long, n int, mark long, rank int, class long, size long"
    rng = np.random.default_rng(7)
    marks = rng.integers(-(1 << 62), 1 << 62, 2000).tolist()
    rows = spark.createDataFrame([(1, i, 6, m, 0, i, 2000) for i, m in enumerate(marks)], names)
    dealt = fuzzy_lines._cross_pairs(rows)
    assert dealt.count() == 0
    same = spark.createDataFrame([(1, i, 6, 5, 0, i % 2, 1200) for i in range(1200)], names)
    assert fuzzy_lines._cross_pairs(same).distinct().count() == 600 * 600


@pytest.mark.parametrize("crowd", [1000, 7])
def test_near_lines_become_few_links(spark, monkeypatch, crowd):
    """Lines of one bucket that counts and marks call near, some similar, most
    in another order: fewer links than lines, which join what all pairs join."""
    monkeypatch.setattr(fuzzy_lines, "CHECKED", crowd)
    rng, words = random.Random(8), [f"w{i}" for i in range(10)]
    lines = [" ".join(rng.sample(words, 10)) for _ in range(20)]
    lines += [" ".join(line.split()[:9] + [f"x{k}"]) for line in lines for k in range(6)]
    names = "bucket long, hash long, n int, mark long, class long, size long"
    rows = spark.createDataFrame([(1, i, 10, 0, i, len(lines)) for i in range(len(lines))], names)
    texts = spark.createDataFrame([(i, x.encode()) for i, x in enumerate(lines)], "hash long, words binary")
    links = [tuple(r) for r in fuzzy_lines._cross_links(rows, texts).collect()]
    near = [(r.a, r.b) for r in fuzzy_lines._cross_pairs(rows).collect()]
    assert len(near) == len(lines) * (len(lines) - 1) // 2
    assert len(links) < (len(lines) if crowd > len(lines) else len(near) // 10)

    def groups(pairs):
        root = list(range(len(lines)))
        for a, b in pairs:
            old, new = max(root[a], root[b]), min(root[a], root[b])
            root = [new if r == old else r for r in root]
        return root

    want = [(a, b) for a, b in near if fuzzy_lines.similar(lines[a].encode(), lines[b].encode())]
    assert set(map(frozenset, links)) <= set(map(frozenset, want)) and groups(links) == groups(want)


@pytest.mark.parametrize("few", [2, 500])
def test_lines_without_a_near_one_are_left_out(make, monkeypatch, few):
    """Buckets above and below the bound for it give what all pairs give."""
    monkeypatch.setattr(fuzzy_lines, "FEW", few)
    rng, lines = random.Random(9), []
    for k in range(12):
        words = [f"w{rng.randrange(60)}" for _ in range(10)]
        lines += [" ".join(words[:at] + [f"x{k}"] + words[at + 1:]) for at in range(4)] + [" ".join(words + ["and", "so", f"on{k}", "then"])]
    want = removed(lines)
    assert 0 < len(want) < len(lines) - 12 and decided(make, lines) == want


def test_short_lines_are_compared_whole(make):
    """Exact repeats of lines of one to four words go, blank lines stay."""
    lines = ["Home", "", "home!", "Share this", "share  this", "Accept all cookies", "accept all, cookies", "share that",
             "-- --", "a b c d", "a b c d e", "a b c x", "", "Accept all cookies now please", "accept all cookies now"]
    want = removed([x or "-" for x in lines], 1) - {i for i, x in enumerate(lines) if not any(c.isalnum() for c in x)}
    assert want == {2, 4, 6, 10, 14} and decided(make, lines, short=True) == want


@pytest.mark.parametrize("busy", [0, 6])
def test_block_recall(busy):
    """Share of edited lines that keep a block of the SimHash: one word
    replaced, and a fifth of the words; ``busy``: the frequency class of the
    pairs that were not edited, as in a large family of variants."""
    rng = random.Random(11)
    shares = {}
    for n in (8, 12, 20, 30):
        for edits in {1, n // 5}:
            lines = []
            for _ in range(1500):
                words = [f"w{rng.randrange(10**9)}" for _ in range(n)]
                changed = list(words)
                for at in rng.sample(range(n), edits):
                    changed[at] = f"x{rng.randrange(10**9)}"
                lines += [words, changed]
            data = np.frombuffer("\n".join(" ".join(x) for x in lines).encode(), np.uint8)
            _, (of, _, _, hashes) = fuzzy_lines._line_words(data, np.array([0, len(data)]))
            row, pair = fuzzy_lines._neighbours(of, hashes)
            old = np.isin(pair, pair[row % 2 == 0])
            classes = np.zeros(fuzzy_lines.CELLS, np.uint8)
            classes[fuzzy_lines._cell(pair[old])] = min(busy, fuzzy_lines.DAMPED)
            blocks = fuzzy_lines.simhash_blocks(row, pair, len(lines), classes)
            shares[n, edits] = (blocks[::2] == blocks[1::2]).any(axis=1).mean()
    floor = 0.95 if not busy else 0.88
    assert all(v >= floor for v in shares.values()), shares
    assert all(v >= (0.98 if not busy else 0.96) for (n, edits), v in shares.items() if edits == 1), shares
