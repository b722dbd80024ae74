"""Near duplicates against comparing every pair that shares a shingle."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brute import near_duplicates
from patronscope.llm import linking, neardup, sketch_join
from patronscope.llm.common import BATCH_BYTES, READ_ROWS, small_batches


def got(df):
    rows = df.select("doc_id", "n_shingles", "component_id", "kept").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def changed(words, n, pick):
    words = list(words)
    for _ in range(n):
        words[pick.randrange(len(words))] = f"new{pick.randrange(10**6)}"
    return " ".join(words)


def corpus():
    pick = random.Random(3)
    texts = []
    for size, copies in ((200, 60), (80, 25), (300, 3), (30, 4)):  # nodes over the limit, and small ones
        base = [f"w{pick.randrange(4000)}" for _ in range(size)]
        texts += [changed(base, pick.choice([0, 1, 2, size // 25]), pick) for _ in range(copies)]
    texts += [" ".join(f"v{pick.randrange(300)}" for _ in range(pick.randrange(1, 80))) for _ in range(150)]
    texts += ["", None, " \n", "one", "ONE", "a b", "a  B\t", "İ i", "x " * 3000, "X " * 2000]
    pick.shuffle(texts)
    return [(7 * i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("width", [2, 5])
def test_planted_copies(spark, width):
    docs = corpus()
    df = spark.createDataFrame([(*d, "n", 1) for d in docs], "doc_id long, text string, id string, n int")
    assert got(neardup.near_duplicates(df, width)) == sorted(near_duplicates(docs, width), key=repr)


def test_repeated_and_missing_ids(spark):
    ddl = "doc_id long, text string"
    docs = spark.createDataFrame(
        [(5, "a b c"), (5, "a b c"), (2, "x y z"), (5, "x y z"), (None, "a b c"), (None, None), (9, "q")], ddl
    )
    rows = got(neardup.near_duplicates(docs, 2))
    assert rows == sorted(
        [(5, 2, 2, False)] * 3 + [(2, 2, 2, True), (None, 2, None, True), (None, 0, None, True), (9, 1, 9, True)],
        key=repr,
    )


def test_no_rows(spark):
    assert got(neardup.near_duplicates(spark.createDataFrame([], "doc_id long, text string"))) == []


def test_components_of_a_chain_and_a_star(spark):
    pick = random.Random(5)
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, 100 + i) for i in range(1, 200)]
    edges = chain + star + [(350, 349), (350, 350)]
    pick.shuffle(edges)
    roots = {r.id: r.root for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(1, 61)} | {100 + i: 100 for i in range(1, 200)} | {350: 349}
    assert {k: v for k, v in roots.items() if k != v} == want


def template(seed):
    """Documents that share 850 of 1,000 words (no links), and 100 pairs at a similarity of 0.81."""
    pick = random.Random(seed)
    base = [f"t{i}" for i in range(850)]
    own = [[f"u{seed}_{i}_{j}" for j in range(150)] for i in range(400)]
    for i in range(0, 200, 2):
        own[i + 1] = own[i][:46] + own[i + 1][:104]
    docs = [" ".join(base + x) for x in own]
    pick.shuffle(docs)
    return list(enumerate(docs))


def test_links_within_a_shared_template(spark):
    found = wanted = 0
    for seed in range(5):
        docs = template(seed)
        df = spark.createDataFrame(docs, "doc_id long, text string")
        rows, want = got(neardup.near_duplicates(df, 1)), near_duplicates(docs, 1)
        links = sum(not r[3] for r in want)
        assert links == 100 and all(r in want or r[3] for r in rows)
        found, wanted = found + sum(not r[3] for r in rows), wanted + links
    assert found >= 0.99 * wanted


def test_long_texts_come_in_small_batches(spark, monkeypatch):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    seen, plain = [], linking.stored
    for module in (neardup, linking):
        monkeypatch.setattr(module, "stored", lambda df, name: seen.append(spark.conf.get(key)) or plain(df, name))
    docs = spark.createDataFrame([(i, f"w{i} " * 10) for i in range(20)], "doc_id long, text string")
    assert neardup.near_duplicates(docs).count() == 20
    assert {x.rstrip("b") for x in seen[:6]} == {str(BATCH_BYTES)} and key not in spark.conf.getAll

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["doc_id"])

    long = docs.select("doc_id", F.repeat(F.lit("x"), 400_000).alias("text")).coalesce(1)
    with small_batches(spark):
        found = [r.doc_id for r in long.mapInArrow(sizes, "doc_id long").collect()]
    assert len(found) > 3 and max(found) < BATCH_BYTES + 1_000_000
    spark.conf.set(key, "1m")
    try:
        with small_batches(spark):
            assert spark.conf.get(key) == "1m"
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.unset(key)


@pytest.mark.parametrize("join", [neardup.near_duplicates, sketch_join.similar])
def test_whole_texts_are_read_by_few_rows(spark, monkeypatch, join):
    key = "spark.sql.parquet.columnarReaderBatchSize"
    own, seen, plain = spark.conf.getAll.get(key), [], linking.stored
    for module in (neardup, sketch_join, linking):
        monkeypatch.setattr(module, "stored", lambda df, name: seen.append((name, spark.conf.get(key))) or plain(df, name))
    docs = spark.createDataFrame([(i, f"w{i} " * 10) for i in range(20)], "doc_id long, text string")
    assert join(docs).count() == 20
    # the last component step reads ids only
    whole = [rows for name, rows in seen if name != "edges"]
    assert len(whole) > 5 and set(whole) == {str(READ_ROWS)} and spark.conf.getAll.get(key) == own
