"""Samples that learnt operators take: which rows, and how many."""

import random

from candela.llm import quality_rules, toxicity


def labelled(spark, n=120):
    r, words = random.Random(3), [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(r.choice(words) for _ in range(40)) + (" nasty vile" if i % 3 == 0 else " calm kind")) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame([(i, int(i % 3 == 0), int(i % 3 != 0)) for i in range(n)], "doc_id long, toxic int, quality int")


def test_labels_without_a_document_use_up_no_place(spark, monkeypatch):
    docs, labels = labelled(spark)
    more = spark.range(10**6, 10**6 + 30000).selectExpr("id as doc_id", "cast(id % 3 = 0 as int) as toxic", "cast(id % 3 <> 0 as int) as quality")
    weights = toxicity.fit(docs, labels.unionByName(more), max_toxic=20, max_clean=40)
    assert "constant" not in weights
    alone = toxicity.fit(docs, labels, max_toxic=20, max_clean=40)
    assert toxicity.score(docs, weights).collect() == toxicity.score(docs, alone).collect()
    seen = []
    monkeypatch.setattr(quality_rules, "learn", lambda x, bad, h: seen.append((len(bad), int(bad.sum()))) or [])
    quality_rules.fit(quality_rules.statistics(docs), labels.unionByName(more), max_labelled=200)
    assert seen == [(120, 40)]


def test_rows_of_a_hot_id_are_bounded(spark, monkeypatch):
    docs, labels = labelled(spark)
    hot = spark.range(3000).selectExpr("cast(id % 2 as long) as doc_id", "concat(repeat('word ', cast(id as int) % 97 + 1), 'text ', id) as text")
    docs, labels = docs.where("doc_id > 1").unionByName(hot), labels.selectExpr("doc_id", "toxic", "quality", "doc_id as id", "toxic as y")
    rows, share = toxicity.sample(docs.toDF("id", "text"), labels.select("id", "y"), 50, 70)
    assert sorted(r["y"] for r in rows.select("y").collect()) == [0] * 70 + [1] * 50
    assert abs(share - (1500 + 39) / 3118) < 1e-12
    seen = []
    monkeypatch.setattr(quality_rules, "learn", lambda x, bad, h: seen.append(len(bad)) or [])
    quality_rules.fit(quality_rules.statistics(docs), labels, max_labelled=200)
    assert seen == [200]
