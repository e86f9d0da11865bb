"""Quality rules: learned decision lists over text statistics.

Statistics of every text are Spark expressions.  Rules are conjunctions of
thresholds on them, learnt by sequential covering from labelled rows: a rule
that predicts rejection grows by the condition of highest information gain
until it covers no kept row of the growing part, is pruned backwards on the
pruning part, and is accepted while it is right more often than ``PRECISION``
there; its rows leave, and the next rule grows.  The list becomes one ordered
conditional expression (``as_column``), first match wins, default keep.

The learner sees numbers of at most ``SAMPLE`` labelled rows (those with the
smallest hash of the id); thresholds come from their quantiles.  All of it is
DataFrame functions and plain Python on that sample; no Python runs in tasks.

Defined results: a null text has no word and fails the base rule; null labels
are ignored, of several labels of a document the lowest counts; without
labelled rows there is no rule and the base rule decides alone; columns of the
input other than id and text take no part.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.common import one_text_each, words

#: Bound on the labelled documents that are learnt from.
SAMPLE = 20_000
THRESHOLDS, MOST_CONDITIONS, MOST_RULES, PRECISION, LEAST_COVER = 32, 4, 16, 0.8, 5
#: The characters counted as symbols, and the base rule.
SYMBOLS = "#*$%&|<>"
BASE = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"

#: Rates the rules are made of, as SQL over the statistics.
RATES = {
    "symbol_rate": "n_symbols / greatest(word_chars, 1)",
    "dup_line_rate": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_rate": "n_repeat_words / greatest(n_words, 1)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "upper_rate": "n_upper / greatest(word_chars, 1)",
    "digit_rate": "n_digits / greatest(word_chars, 1)",
    "mark_rate": "n_marks / greatest(word_chars, 1)",
    "line_words": "n_words / greatest(n_lines, 1)",
    "words": "n_words / 1",
}


def statistics(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines, n_upper, n_digits, n_marks.

    Words in repeated 3-word windows: windows are compared by 64-bit hash
    within their text.  Texts without a repeated window (the common case) are
    told by their distinct hashes alone; the others sort (hash, place) pairs,
    so the cost stays n log n for texts of any length."""
    t = F.coalesce(docs[text].cast("string"), F.lit(""))
    count = lambda chars: (F.length("t") - F.length(F.translate(F.col("t"), chars, ""))).cast("long")
    rows = docs.select(docs[id].alias("id"), t.alias("t")).select(
        "id", words(F.col("t")).alias("w"),
        F.length(F.translate(F.col("t"), " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        count(SYMBOLS).alias("n_symbols"), count("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_upper"),
        count("0123456789").alias("n_digits"), count("!?;:").alias("n_marks"),
        F.filter(F.split("t", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    rows = rows.select(
        "id", "word_chars", "n_symbols", "n_upper", "n_digits", "n_marks",
        F.size("w").cast("long").alias("n_words"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("w") >= 3, F.zip_with(
            F.zip_with(F.slice("w", 1, F.size("w") - 2), F.slice("w", 2, F.size("w") - 2), lambda a, b: F.xxhash64(a, b)),
            F.slice("w", 3, F.size("w") - 2), lambda ab, c: F.xxhash64(ab, c))).alias("windows"))
    rows = rows.withColumn("again", F.size("windows") > F.size(F.array_distinct("windows")))
    pairs = F.when(F.col("again"), F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    # one row in, one row out: a generated column is computed once, while a
    # filter on the counts would be moved below a plain one with a copy of it
    # in every place that names it
    rows = rows.withColumn("pairs", F.explode(F.array(pairs)))
    n = F.size("pairs")
    places = F.filter("pairs", lambda p, i: (
        (i > 0) & (F.col("pairs")[F.greatest(i - 1, F.lit(0))]["h"] == p["h"])) | (
        (i < n - 1) & (F.col("pairs")[F.least(i + 1, n - 1)]["h"] == p["h"])))
    covered = F.array_distinct(F.flatten(F.transform(places, lambda p: F.array(p["i"], p["i"] + 1, p["i"] + 2))))
    return rows.select("id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       F.when(F.col("again"), F.size(covered)).otherwise(0).cast("long").alias("n_repeat_words"),
                       "n_lines", "n_upper", "n_digits", "n_marks").withColumnRenamed("id", id)


@dataclass(frozen=True)
class Condition:
    rate: str
    above: bool
    threshold: float

    def sql(self) -> str:
        return f"{RATES[self.rate]} {'>' if self.above else '<='} {self.threshold!r}D"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def sql(self) -> str:
        return " AND ".join(f"({c.sql()})" for c in self.conditions)


class DecisionList:
    """Ordered rules; the first that covers a row rejects it, else it is kept."""

    def __init__(self, rules: list[Rule]):
        self.rules = rules

    def sql(self) -> str:
        """Number of the first rule that rejects a row, 0 if none does."""
        whens = " ".join(f"WHEN {r.sql()} THEN {i}" for i, r in enumerate(self.rules, 1))
        return f"CASE {whens} ELSE 0 END" if whens else "0"

    def as_column(self) -> Column:
        return F.expr(self.sql())


class _Rows:
    """Labelled rows as columns, and what rules cover of them."""

    def __init__(self, rates: dict[str, np.ndarray], bad: np.ndarray):
        self.rates, self.bad = rates, bad

    def where(self, keep: np.ndarray) -> _Rows:
        return _Rows({k: v[keep] for k, v in self.rates.items()}, self.bad[keep])

    def holds(self, c: Condition) -> np.ndarray:
        return self.rates[c.rate] > c.threshold if c.above else self.rates[c.rate] <= c.threshold

    def covered(self, rule: Rule) -> np.ndarray:
        return np.logical_and.reduce([self.holds(c) for c in rule.conditions])

    def candidates(self) -> list[Condition]:
        out = []
        for name, values in self.rates.items():
            cuts = np.unique(np.quantile(values, np.arange(THRESHOLDS) / THRESHOLDS, method="lower"))
            out += [Condition(name, above, float(c)) for c in cuts for above in (True, False)]
        return out


def _grow(rows: _Rows) -> Rule | None:
    """Add conditions by gain: bad rows kept times the rise in log precision."""
    conditions: tuple[Condition, ...] = ()
    while len(conditions) < MOST_CONDITIONS:
        bad = int(rows.bad.sum())
        if not bad or bad == len(rows.bad):
            break
        best, gain = None, 1e-9
        for c in rows.candidates():
            inside = rows.holds(c)
            p, n = int(rows.bad[inside].sum()), int(inside.sum())
            if p and p * (math.log2(p / n) - math.log2(bad / len(rows.bad))) > gain:
                best, gain = c, p * (math.log2(p / n) - math.log2(bad / len(rows.bad)))
        if best is None:
            break
        conditions += (best,)
        rows = rows.where(rows.holds(best))
    return Rule(conditions) if conditions else None


def _worth(rule: Rule, rows: _Rows) -> float:
    inside = rows.bad[rows.covered(rule)]
    return (2 * inside.sum() - len(inside)) / len(inside) if len(inside) else -1.0


def _prune(rule: Rule, rows: _Rows) -> Rule:
    """Drop last conditions as long as the rule does not get worse."""
    best = rule
    for k in range(len(rule.conditions) - 1, 0, -1):
        shorter = Rule(rule.conditions[:k])
        if _worth(shorter, rows) >= _worth(best, rows):
            best = shorter
    return best


def learn_list(labelled: list[dict]) -> DecisionList:
    """Sequential covering over rows of rates and ``bad`` (0 or 1).  Every
    third row prunes, the others grow."""
    every = _Rows({k: np.array([r[k] for r in labelled], float) for k in RATES}, np.array([r["bad"] for r in labelled], int))
    third = np.arange(len(labelled)) % 3 == 2
    grow, prune = every.where(~third), every.where(third)
    rules: list[Rule] = []
    while len(rules) < MOST_RULES and grow.bad.any():
        rule = _grow(grow)
        if rule is None:
            break
        rule = _prune(rule, prune)
        covered = np.concatenate([part.bad[part.covered(rule)] for part in (grow, prune)])
        if len(covered) < LEAST_COVER or covered.mean() < PRECISION:
            break
        rules.append(rule)
        grow, prune = (part.where(~part.covered(rule)) for part in (grow, prune))
    return DecisionList(rules)


def labelled_rates(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
                   label: str = "quality", most: int = SAMPLE) -> list[dict]:
    one = labels.where(labels[id].isNotNull() & labels[label].isNotNull())
    one = one.groupBy(one[id].alias("label_id")).agg(F.min(one[label].cast("int")).alias("label"))
    one = one.orderBy(F.xxhash64("label_id"), "label_id").limit(most)
    picked = docs.select(docs[id].alias("id"), docs[text].alias("text")).join(F.broadcast(one), F.col("id") == F.col("label_id"))
    picked = one_text_each(picked, "label_id", "label")  # an id that many rows have counts once
    found = statistics(picked.select("label_id", "text", "label"), "label_id").join(F.broadcast(one), "label_id")
    found = found.select(F.expr(BASE).alias("failed"), (F.col("label") <= 0).cast("int").alias("bad"),
                         *(F.expr(sql).cast("double").alias(name) for name, sql in RATES.items()))
    return sorted((r.asDict() for r in found.collect() if not r["failed"]), key=lambda r: tuple(r.values()))


def decide(docs: DataFrame, rules: DecisionList, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the statistics, base_failed, rule (the number of
    the rule that rejects it, 0 for none) and kept."""
    found = statistics(docs, id, text).withColumn("base_failed", F.expr(BASE)).withColumn("rule", rules.as_column())
    return found.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
