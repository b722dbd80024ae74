"""The stages of the pipeline, each against a plain version of what it keeps."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from brute import near_duplicates
from patronscope.llm import quality
from patronscope.llm.common import _BOUNDS, bound_batches, stored
from test_decontam import brute as contaminated
from test_packing import check
from test_secret_scan import base


@pytest.fixture(autouse=True)
def default_batches(spark):
    yield
    for name in _BOUNDS:
        spark.conf.unset(name)


def pairs(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_stages_in_turn(spark, sf):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_dedup", "decontamination", "secret_removal", "packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")

    def step(name, docs):
        out = stored(stages[name](spark, docs, sf), "test-stage")
        assert name == "packing" or out.columns == docs.columns
        return out

    first = step("quality", docs)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scores = quality.score(docs, quality.train(docs, quality.learnable(labels)))
    assert pairs(first) == pairs(scores.where("score >= 0.3")) and first.count() > 0.8 * docs.count()

    second = step("near_dedup", first)
    kept = {d for d, _, _, stays in near_duplicates(pairs(first), 5) if stays}
    assert pairs(second) == [x for x in pairs(first) if x[0] in kept]

    third = step("decontamination", second)
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    hits = {r[0]: r for r in contaminated(pairs(second), items, 10)}
    assert {d for d, _ in pairs(third)} == {d for d, r in hits.items() if r[2] <= 0.5 * r[1]}
    before = dict(pairs(second))
    assert all(t == before[d] for d, t in pairs(third) if not hits[d][2])
    assert not any(r[2] for r in contaminated([x for x in pairs(third) if hits[x[0]][2]], items, 10))

    fourth = step("secret_removal", third)
    before = dict(pairs(third))
    assert {d for d, _ in pairs(fourth)} == set(before)
    for d, t in pairs(fourth):
        assert (t == before[d] or "[SECRET]" in t) and not base(t)
        assert len(base(before[d])) == 0 or t != before[d]

    last = step("packing", fourth)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert check(last.collect(), pairs(fourth), tokenizer, 2048) == 0


def test_repeated_rows_and_rows_without_id(spark, sf):
    ddl = "doc_id long, text string, lang string, source string, n_chars long, row_no int"
    rows = [(1, "a b c d e f", "en", "s", 11, 1)] * 2 + [(2, "A B c d e f", None, None, None, 2)]
    rows += [(None, "a b c d e f", "en", "s", 11, 3), (None, None, None, None, None, None)]
    kept = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, ddl), sf)
    assert sorted((r.doc_id or 0, r.row_no or 0) for r in kept.collect()) == [(0, 0), (0, 3), (1, 1)]
    empty = spark.createDataFrame([], ddl)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).collect() == [], name


def test_different_texts_of_one_id_stay(spark, sf):
    one, two, three = ("one two three four five six", "seven eight nine ten eleven twelve", "a b c d e f g h")
    rows = [(5, one), (5, two), (5, two), (2, one.upper()), (7, two), (7, three), (7, None), (7, ""), (1, "x")]
    docs = spark.createDataFrame([(d, t, "k") for d, t in rows], "doc_id long, text string, own_id string")
    kept = corpus_pipeline.near_dedup(spark, docs, sf)
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    # each text stays once: of equal ones that of a first text, then that of the smallest own id
    texts = [t and t.lower() for _, t in found]
    assert sorted(texts, key=repr) == sorted([one, two, three, None, "", "x"], key=repr)
    assert set(found) <= set(rows) and (2, one.upper()) in found


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0


@pytest.mark.parametrize("name", list(dict(corpus_pipeline.STAGES)))
def test_batches_are_bounded_where_the_caller_writes_a_stage(spark, sf, name):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(300)
    assert not set(_BOUNDS) & set(spark.conf.getAll)
    dict(corpus_pipeline.STAGES)[name](spark, docs, sf)
    assert {k: spark.conf.get(k).rstrip("b") for k in _BOUNDS} == _BOUNDS


def test_own_batch_sizes_stay(spark):
    key = "spark.sql.parquet.columnarReaderBatchSize"
    spark.conf.set(key, "100")
    assert key not in bound_batches(spark) and spark.conf.get(key) == "100"


def test_run_lifts_the_bounds(spark, sf):
    corpus_pipeline.run(spark, sf)
    assert not set(_BOUNDS) & set(spark.conf.getAll)
