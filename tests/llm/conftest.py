import random

import pytest

#: Columns named like the operators' own take part in nothing and come back untouched.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "id string, key long, h int, norm string, size long, class string, take string, row_key string, of int")
EXTRA = ("x", 1, 2, "n", 3, "c", "t", "r", 4)


def _words(rng, n):
    return " ".join(rng.choice("the of and stone river light under over green old new road hill wind".split())
                    + rng.choice(["", "", ",", str(rng.randrange(99))]) for _ in range(n))


@pytest.fixture(scope="session")
def make(spark):
    def frame(rows):
        """rows: (doc_id, text, lang, source)"""
        return spark.createDataFrame([(i, t, lang, src, None if t is None else len(t), *EXTRA) for i, t, lang, src in rows], SCHEMA)
    return frame


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, copies, near copies, ties, repeated rows,
    a long text, white space of all kinds and letters outside ASCII."""
    rng = random.Random(3)
    base = _words(rng, 120)
    near = base.split(" ")
    near[60] = "CHANGED"
    passage = _words(rng, 70)
    rows = [(1, base, "en", "a"), (2, base.upper(), "en", "a"), (3, " ".join(near), "en", "b"), (3, " ".join(near), "en", "b"),
            (4, None, "en", "a"), (5, "", None, None), (None, base, "en", None), (None, None, None, None),
            (6, " \t\n ", "fr", "b"), (7, "one two three", "en", "c"), (8, "One two  three", "en", "c"),
            (9, "ÉCOLE été\nécole ÉTÉ ß ﬁ 漢字 🙂", "fr", "c"), (10, _words(rng, 40) + "\n" + passage, "en", "a"),
            (11, passage + "\n" + _words(rng, 50), "en", "b"), (12, "x" * 5000, None, "z"), (13, "ab " * 300, "en", "z"),
            (14, _words(rng, 9000), "en", "z"), (15, "line one is here today\nline one is here today\n\n", "en", "a"),
            (16, "a\x0bb\x0cc\rd e ▁f  g", "en", "a")]
    rows += [(100 + i, _words(rng, rng.randrange(1, 90)), rng.choice(["en", "fr", None]), rng.choice("abc")) for i in range(30)]
    return rows


@pytest.fixture(scope="session")
def odd(make, odd_rows):
    return make(odd_rows).cache()


@pytest.fixture(scope="session")
def none(make):
    return make([])
