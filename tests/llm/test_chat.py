"""Role repair against exhaustive search and against a single-pass render."""

import itertools
from collections import defaultdict

import pytest

from smelter.llm import chat_format as c

KNOWN = {"system": 1, "user": 2, "assistant": 3}


def cost_of(roles, labels):
    state, total = c.START, 0
    for role, label in zip(roles, labels):
        total += c.step(state, role, label)[0]
        state = label
    return total + c.INSERT * len(c.ending(state))


def test_least_cost_by_trying_all_labels():
    for n in range(6):
        for roles in itertools.product(range(4), repeat=n):
            tables = [c.stretch_costs(list(roles[a:a + 2])) for a in range(0, n, 2)]
            labels = []
            for (entry, exit), a in zip(c.exits(tables), range(0, n, 2)):
                labels += c.best_labels(list(roles[a:a + 2]), entry, exit)
            best = min(cost_of(roles, x) for x in itertools.product(range(1, 4), repeat=n))
            assert cost_of(roles, labels) == best


def plain(turns):
    roles = [KNOWN.get(r, 0) for r, _ in turns]
    (entry, exit), = c.exits([c.stretch_costs(roles)])
    return "".join(p[4] for p in c.pieces(roles, [t for _, t in turns], entry, exit, 0, True))


@pytest.mark.parametrize("stretch", [4096, 3])
def test_repair(spark, monkeypatch, stretch):
    monkeypatch.setattr(c, "STRETCH", stretch)
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes <|im_end|>"), (2, 0, "assistant", "first"), (2, 1, "assistant", "second"),
            (3, 0, "user", "a"), (3, 1, "user", "b"), (3, 2, "system", "late"), (3, 3, "assistant", None), (4, 0, None, "who"),
            (4, None, "tool", "last"), (None, 0, "user", "no conversation"), (5, 0, "user", ""), (5, 0, "user", ""), (5, 0, "assistant", "x")]
    rows += [(9, i, ("user", "assistant", "system")[(i * i) % 3], f"t{i}") for i in range(200)]
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, stretch string, at int")
    got = c.repair(turns)
    rendered = {r["conv_id"]: r["rendered"] for r in c.whole(got).collect()}
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn is None, turn or 0, role is None, role or "", text is None, text or "", role, text))
    assert rendered == {k: plain([(x[6], x[7]) for x in sorted(v, key=lambda x: x[:6])]) for k, v in convs.items()}
    assert rendered[1] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyes < |im_end| ><|im_end|>\n"
    assert got.where("action <> 'insert' and action <> 'end'").count() == len(rows)
    for text in rendered.values():
        roles = [x.split("\n")[0] for x in text.split("<|im_start|>")[1:]]
        body = roles[1:] if roles[0] == "system" else roles
        assert body == ["user", "assistant"] * (len(body) // 2)
    assert c.repair(turns.limit(0)).count() == 0
