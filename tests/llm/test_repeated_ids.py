"""op5 and op6: an id that many rows have is one labelled row in the fit."""

from smelter.llm import quality_gam, quality_rules


def test_repeated_ids_count_once(spark, make, monkeypatch):
    text = "a plain line of words that is long enough to be kept by the base rules of the operator "
    docs = make([(i, f"{text * 8}{i}", "en", "a") for i in range(10)] + [(0, f"{text * 8}copy {k}", "en", "a") for k in range(40)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality_gam, "AdditiveModel", lambda x, good: seen.append((len(x), int(good.sum()))))
    quality_gam.fit(docs, labels)
    assert seen == [(10, 5)]
    monkeypatch.setattr(quality_rules, "BASE", "false")
    rates = quality_rules.labelled_rates(docs, labels)
    assert len(rates) == 10 and sum(r["bad"] for r in rates) == 5
