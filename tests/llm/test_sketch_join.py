"""Parity-sketch join against comparing every pair that shares a shingle."""

import random

import numpy as np
import pytest

from brute import near_duplicates
from patronscope.llm import hashing, linking, queries, sketch_join
from test_neardup import changed, corpus, got


@pytest.mark.parametrize("width, percent", [(4, 85), (2, 80), (3, 60)])
def test_equals_comparing_all(spark, width, percent):
    docs = corpus()
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, id int, key string")
    found = got(sketch_join.similar(df, width, percent / 100))
    assert found == sorted(near_duplicates(docs, width, percent), key=repr)


def edges(seed, n=120):
    """Pairs of sets at and next to the least similarity, of all sizes."""
    pick = random.Random(seed)
    docs = []
    for i in range(n):
        size = int(1.09**i) + 3 if i < 90 else pick.randrange(5, 60)
        base = [f"w{seed}_{i}_{j}" for j in range(size)]
        docs.append(" ".join(base))
        # as many new words at the end as the similarity just allows, and one more
        allowed = size - -(-85 * size // 100)
        docs.append(" ".join(base[: size - pick.randrange(allowed, allowed + 2)]))
    return list(enumerate(docs))


@pytest.mark.parametrize("seed", [1, 2])
def test_pairs_at_the_bound(spark, seed):
    docs = edges(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(sketch_join.similar(df, 1, 0.85)) == sorted(near_duplicates(docs, 1, 85), key=repr)


def test_large_keys_go_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(linking, "BLOCK", 16)
    monkeypatch.setattr(linking, "FREQUENT", 2)
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(sketch_join.similar(df, 4, 0.85)) == sorted(near_duplicates(docs, 4, 85), key=repr)


def template(seed):
    """Texts that share most of their words, none alike enough but for some planted pairs."""
    pick = random.Random(seed)
    base = [f"t{i}" for i in range(850)]
    own = [[f"u{seed}_{i}_{j}" for j in range(150)] for i in range(300)]
    for i in range(0, 100, 2):
        own[i + 1] = own[i][:110] + own[i + 1][:40]
    docs = [" ".join(base + x) for x in own]
    pick.shuffle(docs)
    return list(enumerate(docs))


def test_links_within_a_shared_template(spark):
    docs = template(1)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = sorted(near_duplicates(docs, 4, 85), key=repr)
    assert got(sketch_join.similar(df, 4, 0.85)) == want and sum(not r[3] for r in want) == 50


def test_words_bound_the_difference():
    random = np.random.default_rng(3)
    for n in (1, 5, 40):
        for _ in range(50):
            values = np.unique(random.integers(0, 1 << 64, 60, dtype=np.uint64))
            other = np.unique(np.concatenate([values[: random.integers(1, 60)], random.integers(0, 1 << 64, 9, dtype=np.uint64)]))
            difference = len(np.setxor1d(values, other))
            assert (sketch_join.words(values, n) != sketch_join.words(other, n)).sum() <= difference
            a, b = (np.array(linking.sketch(x)[:8]).view(np.uint64) for x in (values, other))
            assert np.bitwise_count(a ^ b).sum() <= difference


def test_wide_sketches_bound_the_difference_and_fold():
    random = np.random.default_rng(4)
    for n, m in ((600, 650), (1000, 1100), (5000, 4300), (513, 8000)):
        values = np.unique(random.integers(0, 1 << 64, n, dtype=np.uint64))
        other = np.unique(np.concatenate([values[: n // 2], random.integers(0, 1 << 64, m - n // 2, dtype=np.uint64)]))
        x, y = linking.sketch(values), linking.sketch(other)
        found = linking.wide_difference(x[8], y[8])
        assert found == linking.wide_difference(y[8], x[8]) <= len(np.setxor1d(values, other))
        assert x[:8] == linking.parities(values, 512).tolist() and found > 0.1 * min(n, m)


@pytest.mark.parametrize("percent", [60, 85, 99, 100])
def test_bands_bring_partners_together(percent):
    bands = sketch_join.Bands(percent)
    for n in range(1, 600):
        own = bands.of(n)
        for m in range(n, 100 * n // percent + 1):
            band = bands.band(m)
            assert band in own and band in bands.of(m)
            assert (100 - percent) * (n + m) // (100 + percent) <= bands.differences(band)
            sizes, least = bands.needed()
            assert least[np.searchsorted(sizes, m, "right") - 1] == bands.least(band) <= bands.spare(band) + 1


@pytest.mark.parametrize("percent", [70, 85, 95])
def test_links_share_as_many_keys_as_asked(percent):
    random = np.random.default_rng(percent)
    bands = sketch_join.Bands(percent)
    for _ in range(150):
        n = int(random.integers(8, 900))
        values = np.unique(random.integers(0, 1 << 64, n, dtype=np.uint64))
        new = np.unique(random.integers(0, 1 << 64, 400, dtype=np.uint64))
        gone, more = random.integers(0, n // 4 + 1), random.integers(0, n // 4 + 1)
        other = np.unique(np.concatenate([random.permutation(values)[gone:], new[:more]]))
        both = len(np.intersect1d(values, other))
        if 100 * both < percent * (len(values) + len(other) - both) or len(np.setxor1d(values, other)) == 0:
            continue
        a, b = (
            set(sketch_join.keys(x, bands, x % np.uint64(3) > 0)) for x in (values, other)
        )
        assert len(a & b) >= bands.least(bands.band(max(len(values), len(other))))


def test_odd_rows(spark):
    ddl = "doc_id long, text string"
    docs = spark.createDataFrame(
        [(5, "a b c"), (5, "a b c"), (2, "x y z"), (5, "x y z"), (None, "a b c"), (None, None), (9, ""), (8, "long word " * 40_000), (7, "long word " * 30_000)],
        ddl,
    )
    rows = got(sketch_join.similar(docs, 4, 0.85))
    assert rows == sorted(
        [(5, 1, 2, False)] * 3 + [(2, 1, 2, True), (None, 1, None, True), (None, 0, None, True), (9, 0, 9, True), (7, 2, 7, True), (8, 2, 7, False)],
        key=repr,
    )
    assert got(sketch_join.similar(docs.limit(0))) == []


def test_changed_copies_of_the_table(spark, sf):
    pick = random.Random(9)
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if r.text]
    docs = list(enumerate([*texts, *(changed(t.split() or ["x"], 2, pick) for t in texts)]))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(sketch_join.similar(df, 4, 0.85)) == sorted(near_duplicates(docs, 4, 85), key=repr)
    assert queries.op13_parity_sketch_join(spark, sf).columns == ["doc_id", "n_shingles", "component_id"]


@pytest.mark.parametrize("percent", [60, 85, 99])
def test_partners_differ_no_more_than_either_keeps(percent):
    bands = sketch_join.Bands(percent)
    for n in range(1, 400):
        for m in range(n, 100 * n // percent + 1):
            band, differ = bands.band(m), (100 - percent) * (n + m) // (100 + percent)
            assert differ <= min(bands.own_differences(band, x) for x in (n, m)) <= bands.differences(band)


def test_word_hashes_follow_words(monkeypatch):
    text = b" \tone two\x0bTwo  \x1cthree\x00 three\x0cone\xc2\xa0x\r\n" + b"long" * 50 + b" two"
    for size in (1 << 20, 1, 7):
        monkeypatch.setattr(hashing, "PIECE", size)
        words, values = text.split(), hashing.word_hashes(text).tolist()
        assert len(words) == len(values) and len(set(zip(words, values))) == len(set(words)) == len(set(values))
    assert [len(hashing.word_hashes(x)) for x in (b"", b" \n", b"a")] == [0, 0, 1]
