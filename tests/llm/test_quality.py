"""Quality classifier: held-out accuracy, clean texts kept, odd rows."""

import numpy as np

from patronscope.llm import quality, queries


def test_held_out_accuracy(spark, sf):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/../sf0.01/labels.parquet").collect()}
    rows = queries.op4_quality(spark, f"{sf}/../sf0.01").collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    own = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    good, bad = (np.array([s for s, y in own if y == label]) for label in (1, 0))
    assert (good >= 0.3).mean() >= 0.97
    assert (good[:, None] > bad[None, :]).mean() >= 0.9


def corpus():
    rows = [(i, "plain prose about rivers, towns and people number " + "abcdefghij"[i % 10] * 3, 1) for i in range(60)]
    return rows + [(100 + i, "$$$ BUY!!! *** NOW!!! %%% " * (i % 5 + 1), 0) for i in range(60)]


def test_scores_and_odd_rows(spark):
    rows = [*corpus(), (300, None, 1), (301, "  ", 0), (302, "x", None), (None, "y", 1)]
    known = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality.train(known.drop("quality"), known.drop("text"))
    texts = ["prose about people and towns", "$$$ BUY!!! *** %%% NOW!!! $$$ ***", None, "", "word " * 60_000, "é"]
    docs = spark.createDataFrame([(i, t, 7.0) for i, t in enumerate([*texts, texts[0]])], "doc_id long, text string, n double")
    found = [r.score for r in quality.score(docs, model).orderBy("doc_id").collect()]
    assert found[0] > 0.7 > 0.3 > found[1] and found[0] == found[-1]
    assert found[2] == found[3] == 0.5 and all(0 <= s <= 1 for s in found)


def test_one_class_or_none(spark):
    ddl = "doc_id long, text string, quality int"
    one_class = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], ddl)
    only_good = quality.train(one_class, one_class)
    none = spark.createDataFrame([], ddl)
    nothing = quality.train(none, none)
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    assert quality.score(docs, only_good).first().score > 0.7
    assert quality.score(docs, nothing).first().score == 0.5
    assert quality.score(docs.limit(0), nothing).collect() == []
