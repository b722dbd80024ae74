"""Repeated passages against windows kept as tuples."""

import random

from brute import repeats
from patronscope.llm import substring


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=repr)


def corpus():
    pick = random.Random(4)
    passage = [f"p{i}" for i in range(45)]
    docs = []
    for i in range(120):
        words = [f"w{pick.randrange(50)}" for _ in range(pick.randrange(0, 150))]
        if i % 3 == 0:
            at = pick.randrange(len(words) + 1)
            words[at:at] = passage[pick.randrange(10) :]
        docs.append((3 * i, " ".join(words)))
    docs += [(1000, "To " * 500), (1001, "To\n" * 30), (1, None), (2, ""), (5, " \t"), (None, " ".join(passage))]
    docs += [(6, docs[0][1]), (0, docs[0][1]), (4, " ".join(passage[:19])), (7, "é漢 " * 25)]
    return docs


def test_planted_passages(spark, monkeypatch):
    docs = corpus()
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, group int")
    for size in (substring.GROUP_BYTES, 700):  # few and many groups
        monkeypatch.setattr(substring, "GROUP_BYTES", size)
        for width in (20, 3):
            assert got(substring.remove_repeats(df, width)) == repeats(docs, width)


def test_intervals_and_text(spark):
    passage = " ".join(f"p{i}" for i in range(25))
    df = spark.createDataFrame([(1, f"a {passage} b"), (2, f"c d {passage}")], "doc_id long, text string")
    rows = {r.doc_id: r for r in substring.remove_repeats(df).collect()}
    assert rows[1].removed == [] and rows[1].text == f"a {passage} b"
    assert [tuple(s) for s in rows[2].removed] == [(2, 27)] and rows[2].text == "c d"


def test_no_rows(spark):
    assert got(substring.remove_repeats(spark.createDataFrame([], "doc_id long, text string"))) == []


def test_plan_and_rows_do_not_grow_with_groups(spark, monkeypatch):
    text = " ".join(f"t{i % 977}x{i % 31}" for i in range(60_000))  # one very long text
    df = spark.createDataFrame([(1, text), (None, text), (2, "a b")], "doc_id long, text string")
    plans = []
    for size in (substring.GROUP_BYTES, 40):  # 4 MB, and thousands of groups
        monkeypatch.setattr(substring, "GROUP_BYTES", size)
        found = substring.remove_repeats(df, with_text=False)
        plans.append(len(found._jdf.queryExecution().optimizedPlan().toString()))
    assert plans[1] < plans[0] + 100
    assert got(found) == repeats([(1, text), (None, text), (2, "a b")], 20)
    docs, buckets = substring.grouped(df)
    sent = docs.groupBy("group").applyInArrow(substring._send(20, 10**6), substring.SENT_DDL)
    assert buckets == 8 and sent.count() <= 2 * 60_000
