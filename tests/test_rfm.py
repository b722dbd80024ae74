"""RFM features, clusters, ranking and segments."""

import os
import random

import pytest
from pyspark.sql import functions as F

from patronscope.functions import purchase_day
from patronscope.operators import clusters, rfm, segments
from patronscope.operators.durable import checkpointed
from patronscope.operators.purchases import purchase_records
from patronscope.operators.ranking import top_per_group
from patronscope.sources import star_tables

# Five known RFM rows.
LITERALS = [
    (1, "2023-10-05", 5, 1500.0),
    (2, "2023-12-20", 3, 900.0),
    (3, "2023-08-15", 8, 2200.0),
    (4, "2023-11-30", 2, 600.0),
    (5, "2023-09-22", 4, 1200.0),
]
RECORDS = "user_id bigint, purchase_time string, frequency bigint, monetary double"
FEATURES = "user_id bigint, recency double, frequency bigint, monetary double"


def as_of(text="2024-01-01 00:00:00"):
    return F.lit(text).cast("timestamp")


def test_recency_of_known_rows(spark):
    merged = rfm.rfm_merge_users(spark.createDataFrame(LITERALS, RECORDS))
    got = {r.user_id: r.recency for r in rfm.rfm_features(merged, as_of()).collect()}
    days = {1: 88, 2: 12, 3: 139, 4: 32, 5: 101}
    assert got == pytest.approx({u: d / 30.44 for u, d in days.items()})


def test_only_whole_days_are_days(spark):
    texts = {
        "2023-10-05": "2023-10-05", "2023-1-5": "2023-01-05", "2024-02-29": "2024-02-29",
        "2023-02-29": None, "2023": None, "2023-10": None, "2023-10-05T01:00:00": None,
        " 2023-10-05": None, "2023-10-05\n": None, "05-10-2023": None, "": None, None: None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", purchase_day(F.col("t")).cast("string").alias("day")).collect()
    assert {r.t: r.day for r in rows} == texts


def test_merge_skips_nulls(spark):
    rows = [
        (1, "2023-01-02", 1, 10.0),
        (1, "2023-9-30", 2, None),
        (1, None, 3, 5.0),
        (2, "soon", 4, None),
        (2, "2023-02-30", 0, None),
        (3, "2023-10-05 12:00:00", 1, 1.0),
    ]
    merged = rfm.rfm_merge_users(spark.createDataFrame(rows, RECORDS))
    got = {r.user_id: (str(r.last_purchase), r.frequency, r.monetary) for r in merged.collect()}
    assert got == {1: ("2023-09-30", 6, 15.0), 2: ("None", 4, 0.0), 3: ("None", 1, 1.0)}
    assert [r.user_id for r in rfm.rfm_features(merged, as_of()).collect()] == [1]
    assert rfm.rfm_user_count(merged).first().rfm_users == 3


def test_standardize_and_constant_column(spark):
    rows = [(1, 1.0, 4, 7.0), (2, 3.0, 4, 9.0)]
    got = rfm.standardize(spark.createDataFrame(rows, FEATURES)).orderBy("user_id").collect()
    assert [tuple(r)[1:] for r in got] == [(-1.0, 0.0, -1.0), (1.0, 0.0, 1.0)]
    extent = rfm.rfm_extent(spark.createDataFrame(rows, FEATURES)).first()
    assert (extent.min_recency, extent.max_monetary) == (1.0, 9.0)


def blobs(spark, per_blob=60):
    dice = random.Random(7)
    middles = [(2.0, 40, 9000.0), (12.0, 20, 3000.0), (40.0, 3, 200.0)]
    rows = [
        (b * per_blob + i, m[0] + dice.random(), m[1] + dice.randrange(3), m[2] + dice.random())
        for b, m in enumerate(middles)
        for i in range(per_blob)
    ]
    return spark.createDataFrame(rows, FEATURES)


def test_kmeans_recovers_blobs_in_stable_order(spark):
    features = blobs(spark)
    model = clusters.fit_clusters(features)
    labelled = clusters.rfm_clusters(features, model=model)
    rows = labelled.collect()
    assert all(r.cluster == r.user_id // 60 for r in rows)
    assert {r.cluster: r.members for r in clusters.cluster_sizes(labelled).collect()} == {
        0: 60, 1: 60, 2: 60,
    }
    centers = {r.cluster: tuple(r)[1:] for r in clusters.cluster_centers(features, model).collect()}
    means = {r.cluster: tuple(r)[1:] for r in clusters.cluster_means(labelled).collect()}
    for cluster, center in centers.items():
        assert center == pytest.approx(means[cluster])
    assert clusters.silhouette(features, model).first().silhouette > 0.9


def test_fitted_centres_are_a_fixed_point(spark):
    root = os.environ.get("PATRONSCOPE_TESTDATA", "/root/testdata")
    records = purchase_records(star_tables.purchases(spark, f"{root}/sf0.01"))
    features = checkpointed(rfm.rfm_features(rfm.rfm_merge_users(records), as_of()))
    model = clusters.fit_clusters(features)
    moved = clusters.kmeans_step(model.standardize(features), model.centers).collect()
    assert sum(r.members for r in moved) == 1500
    for row in moved:
        assert tuple(row)[2:] == pytest.approx(model.centers[row.cluster], abs=0.01)
    assert list(model.centers) == sorted(model.centers)
    assert 0.4 < clusters.silhouette(features, model).first().silhouette < 1


def test_empty_features_cluster_to_nothing(spark):
    empty = spark.createDataFrame([], FEATURES)
    assert clusters.fit_clusters(empty) is None
    assert clusters.rfm_clusters(empty).columns[-1] == "cluster"
    assert clusters.rfm_clusters(empty).count() == 0
    assert clusters.cluster_centers(empty, None).count() == 0


def test_kmeans_step_lowers_cost_and_keeps_empty_centres(spark):
    scaled = rfm.standardize(blobs(spark))
    centers = [(0.0, 0.0, 0.0), (0.5, 0.5, 0.5), (99.0, 99.0, 99.0)]
    costs = []
    for _ in range(4):
        assigned = clusters.kmeans_assign(scaled, centers)
        costs.append(assigned.agg(F.sum(F.col("distance") ** 2)).first()[0])
        moved = {r.cluster: r for r in clusters.kmeans_step(scaled, centers).collect()}
        assert sorted(moved) == [0, 1, 2]
        assert moved[2].members == 0 and tuple(moved[2])[2:] == (99.0, 99.0, 99.0)
        centers = [tuple(moved[i])[2:] for i in range(3)]
    assert all(later <= earlier + 1e-9 for earlier, later in zip(costs, costs[1:]))


def test_assignment_ties_take_the_lower_number(spark):
    df = spark.createDataFrame([(1, 0.0, 0, 0.0)], FEATURES)
    row = clusters.kmeans_assign(df, [(1.0, 0.0, 0.0), (-1.0, 0.0, 0.0)]).first()
    assert (row.cluster, row.distance) == (0, 1.0)


def test_nearest_to_center_against_brute_force(spark):
    labelled = blobs(spark).withColumn("cluster", (F.col("user_id") % 3).cast("int"))
    rows = labelled.collect()
    expected = set()
    for c in range(3):
        mine = [r for r in rows if r.cluster == c]
        mean = [sum(r[i] for r in mine) / len(mine) for i in (1, 2, 3)]
        mine.sort(key=lambda r: (sum((r[i + 1] - mean[i]) ** 2 for i in range(3)) ** 0.5, r.user_id))
        expected |= {(c, place, r.user_id) for place, r in enumerate(mine[:7], 1)}
    got = clusters.nearest_to_center(labelled, k=3, n=7).collect()
    assert {(r.cluster, r["rank"], r.user_id) for r in got} == expected
    assert clusters.cluster_scatter(labelled, k=3, n=7).count() == 21


def test_labels_outside_k_keep_their_rows_without_a_distance(spark):
    label = F.when(F.col("user_id") % 5 != 4, F.col("user_id") % 5).cast("int")
    labelled = blobs(spark).withColumn("cluster", label)
    rows = clusters.distance_to_center(labelled, k=3).collect()
    assert len(rows) == labelled.count()
    assert all((r.distance is None) == (r.cluster not in (0, 1, 2)) for r in rows)


def test_top_per_group_with_one_hot_group(spark):
    df = spark.range(0, 5000, 1, 16).select(
        "id",
        F.when(F.col("id") % 3 == 0, "rare").otherwise("hot").alias("g"),
        (F.col("id") * 7919 % 101).alias("v"),
    )
    got = top_per_group(df, "g", [F.asc("v"), F.asc("id")], 50, merge_tasks=4).collect()
    rows = [(("rare" if i % 3 == 0 else "hot"), i * 7919 % 101, i) for i in range(5000)]
    expected = set()
    for g in ("hot", "rare"):
        best = sorted(r[1:] for r in rows if r[0] == g)[:50]
        expected |= {(g, place, i) for place, (_, i) in enumerate(best, 1)}
    assert {(r.g, r["rank"], r.id) for r in got} == expected


def test_segments(spark):
    def record(user, day, price):
        return (user, day, 1, price)

    rows = (
        [record(1, f"2023-{m:02d}-10", 9000.0) for m in range(1, 13)]
        + [record(2, "2023-12-01", 9000.0)]
        + [record(3, "2021-12-01", 50000.0)]
        + [record(4, f"2023-{m:02d}-10", 100.0) for m in range(1, 13)]
        + [record(5, None, 1.0)]
        + [record(1, "2023-05-05", None)]
    )
    totals = rfm.user_totals(spark.createDataFrame(rows, RECORDS), as_of())
    features = segments.segment_features(totals, as_of())
    got = segments.segment_actions(segments.rfm_segments(features)).collect()
    assert {r.user_id: (r.segment, r.action) for r in got} == {
        1: ("high-value", "exclusive discount"),
        2: ("potential", "promotion"),
        3: ("at-risk", "time-limited offer"),
        4: ("potential", "promotion"),
    }
    assert {r.user_id: r.yearly_purchases for r in got}[1] == 12


def test_merged_equals_totals(spark):
    form = '{{"avg_price": {0}.25, "items": [{{"id": {0}}}], "purchase_date": "2023-01-{1:02d}"}}'
    docs = [(i % 9, form.format(i, i % 28 + 1)) for i in range(90)]
    records = purchase_records(spark.createDataFrame(docs, "id bigint, purchase_history string"))
    merged = rfm.rfm_merge_users(records)
    totals = rfm.user_totals(records, as_of()).select(merged.columns)
    assert sorted(merged.collect()) == sorted(totals.collect())


def test_all_starts_step_together(spark):
    features = blobs(spark)
    scaled = rfm.standardize(features).select(*rfm.RFM_COLUMNS)
    good = clusters.start_centers(scaled, 3, 1, 1)[0]
    # a start that ends in a worse optimum, and one with a centre that no row is near
    worse = [good[0], tuple(x + 0.001 for x in good[0]), good[2]]
    alone = [*good[:2], (1e6, 1e6, 1e6)]
    found = clusters.lloyd(scaled, [worse, good, alone], 50, 0.0)
    for center, same in zip(sorted(found), sorted(clusters.lloyd(scaled, [good], 50, 0.0))):
        assert center == pytest.approx(same)
    assert len({c for c in found}) == 3


def test_fewer_points_than_clusters(spark):
    features = spark.createDataFrame([(i, float(i % 2), 1, 5.0) for i in range(9)], FEATURES)
    model = clusters.fit_clusters(features, k=3, starts=3)
    assert len(model.centers) == 2
    assert {r.user_id % 2: r.cluster for r in model.predict(features).collect()} == {0: 0, 1: 1}


def test_a_round_multiplies_no_row_and_agrees_with_single_steps(spark):
    scaled = rfm.standardize(blobs(spark)).select(*rfm.RFM_COLUMNS)
    starts = {
        0: [(0.0, 0.0, 0.0), (0.5, 0.5, 0.5), (99.0, 99.0, 99.0)],
        4: [(-1.0, 1.0, 1.0), (-1.0, 1.0, 1.0), (1.0, -1.0, -1.0)],
    }
    sums = clusters._cluster_sums(scaled, starts)
    assert "Generate" not in sums._jdf.queryExecution().toString()
    row = sums.first()
    for i, centers in starts.items():
        assigned = clusters.kmeans_assign(scaled, centers)
        assert row[f"__cost{i}"] == pytest.approx(assigned.agg(F.sum(F.col("distance") ** 2)).first()[0])
        for step in clusters.kmeans_step(scaled, centers).collect():
            own = [row[f"__mean{i}_{step.cluster}_{j}"] for j in range(3)]
            assert own == (pytest.approx(tuple(step)[2:]) if step.members else [None] * 3)


def test_a_start_with_the_centres_of_another_leaves(spark, monkeypatch):
    scaled = rfm.standardize(blobs(spark)).select(*rfm.RFM_COLUMNS)
    good = clusters.start_centers(scaled, 3, 1, 1)[0]
    worse = [good[0], tuple(x + 0.001 for x in good[0]), good[2]]
    seen, sums = [], clusters._cluster_sums
    monkeypatch.setattr(clusters, "_cluster_sums", lambda df, moving: seen.append(sorted(moving)) or sums(df, moving))
    found = clusters.lloyd(scaled, [good, worse, list(good), good[::-1], worse], 50, 0.0)
    assert seen[0] == [0, 1, 3]  # in another order, a row between two centres may go elsewhere
    assert sorted(found) == [pytest.approx(c) for c in sorted(clusters.lloyd(scaled, [good], 50, 0.0))]
