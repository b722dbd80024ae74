"""Nearest neighbours against the inner products of all pairs."""

import math

import numpy as np
from pyspark.sql import functions as F

from patronscope.llm import ann, queries

DDL = "vec_id long, embedding array<float>, label int, score string"


def brute(rows, k, is_query):
    ids = np.array([r[0] for r in rows])
    vectors = np.array([r[1] for r in rows], np.float32).astype(float)
    out = {}
    for q in sorted(set(ids[[is_query(i) for i in ids]].tolist())):
        scores = np.einsum("ij,j->i", vectors, vectors[np.flatnonzero(ids == q)[0]])
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(scores[i])) for i in order]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_on_the_table(spark, sf):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want, found = brute(rows, 20, lambda i: i % 20 == 0), got(queries.op3_nearest_neighbours(spark, sf))
    assert set(want) == set(found)
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in found[q]}) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))
    scores = {(q, i): s for q in want for i, s in want[q]}
    assert all(scores[q, i] == s for q in found for i, s in found[q] if (q, i) in scores)


def test_the_stopping_test_saves_work_in_few_dimensions():
    random = np.random.default_rng(1)
    vectors = random.standard_normal((8000, 6))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    block = ann.Block(np.arange(8000), vectors, 1.0, 20)
    bound, hits, looked = ann.chi_square_bound(1 - ann.MISS, ann.PROJECTED), 0, 0
    for q in range(0, 8000, 200):
        best, verified = block.search(q, vectors[q], bound)
        order = [i for i in np.argsort(-(vectors @ vectors[q]), kind="stable") if i != q][:20]
        hits += len({i for _, i in best} & set(order))
        looked += verified
    assert hits >= 0.95 * 40 * 20 and looked < 0.2 * 40 * 8000


def test_ties_repeats_and_bad_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "LEAST_ROWS", 50)
    random = np.random.default_rng(2)
    same = random.standard_normal(5).tolist()
    good = [(i, same if i % 3 == 0 else random.standard_normal(5).tolist()) for i in range(400)]
    bad = [
        (1000, None), (1020, [0.0] * 5), (1040, [1.0, None, 1.0, 1.0, 1.0]), (1060, [math.nan] * 5),
        (1080, [math.inf, 0.0, 0.0, 0.0, 0.0]), (1100, [1.0, 2.0]), (1120, []), (None, same),
    ]
    df = spark.createDataFrame([(*r, 1, "x") for r in good + bad], DDL)
    assert got(ann.nearest(df, F.col("vec_id") % 20 == 0, miss=1e-9)) == brute(good, 20, lambda i: i % 20 == 0)


def test_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])], DDL.rsplit(", ", 2)[0])
    assert got(ann.nearest(df, F.col("vec_id") == 0)) == {0: [(1, 0.5), (2, 0.0)]}
    assert ann.nearest(df.limit(0), F.col("vec_id") == 0).collect() == []
    assert got(ann.nearest(df.where("vec_id = 0"), F.col("vec_id") == 0)) == {}


def test_chi_square():
    # known quantiles of the distribution with 8 degrees of freedom
    assert abs(ann.chi_square_bound(0.95, 8) - 15.5073) < 1e-3
    assert abs(ann.chi_square_cdf(7.3441, 8) - 0.5) < 1e-4
