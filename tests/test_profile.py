"""Edge cases of bins, documents, logins and key figures."""

from pyspark.sql import functions as F

import pytest

from patronscope.functions import age_group, has_document, login_period, purchase_document
from patronscope.operators import logins, profile, purchases, quality
from patronscope.operators.binned import count_bins
from patronscope.plans import jobs

USER_SCHEMA = (
    "id bigint, gender string, age int, country string, is_active boolean, "
    "login_history string, purchase_history string"
)


def users_frame(spark, rows):
    return spark.createDataFrame(rows, USER_SCHEMA)


def login(*times):
    stamps = ", ".join(f'"{t}"' for t in times)
    return f'{{"timestamps": [{stamps}], "login_count": {len(times)}}}'


def test_age_bins(spark):
    expected = {
        17: "<18", 18: "18-25", 24: "18-25", 25: "25-35", 34: "25-35",
        35: "35-50", 49: "35-50", 50: ">50", None: ">50",
    }
    df = spark.createDataFrame([(a,) for a in expected], "age int")
    rows = df.select("age", age_group(F.col("age")).alias("bin")).collect()
    assert {r.age: r.bin for r in rows} == expected
    labelled = df.select("age", age_group(F.col("age"), null_label="unknown").alias("bin"))
    assert {r.age: r.bin for r in labelled.collect()} == {**expected, None: "unknown"}


def test_login_periods(spark):
    hours = {0: 0, 5: 0, 6: 1, 11: 1, 12: 2, 17: 2, 18: 3, 23: 3}
    labels = ["0-6clock", "6-12clock", "12-18clock", "18-24clock"]
    df = spark.createDataFrame([(h,) for h in hours], "h int")
    ts = F.make_timestamp(F.lit(2024), F.lit(1), F.lit(1), F.col("h"), F.lit(59), F.lit(59))
    rows = df.select("h", login_period(ts).alias("p")).collect()
    assert {r.h: r.p for r in rows} == {h: labels[i] for h, i in hours.items()}


def test_has_document_is_where_parsing_gives_a_struct(spark):
    texts = [
        None, "", "  ", "\t\n\r ", "garbage", "[]", "{}", "null", "1", '"x"', " {} ", "\x0b",
        "\xa0", '{"avg_price": 1', '{"avg_price": "x"}', '[{"avg_price": 1}]',
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(
        "t",
        F.coalesce(has_document(F.col("t")), F.lit(False)).alias("has"),
        purchase_document(F.col("t")).isNotNull().alias("parsed"),
    ).collect()
    assert [r.has for r in rows] == [r.parsed for r in rows]
    assert sum(r.has for r in rows) == 12


def test_purchase_records_keep_malformed_documents(spark):
    rows = [
        (1, '{"avg_price": 2.5, "items": [{"id": 1}, {"id": 2}], "purchase_date": "2023-10-05"}'),
        (2, "garbage"),
        (3, "[]"),
        (4, ""),
        (5, None),
        (6, '{"avg_price": "dear", "items": [], "purchase_date": "2023-1-5"}'),
    ]
    df = spark.createDataFrame(rows, "id bigint, purchase_history string")
    got = {r.user_id: tuple(r)[1:] for r in purchases.purchase_records(df).collect()}
    assert got == {
        1: ("2023-10-05", 2, 2.5),
        2: (None, 0, None),
        3: (None, 0, None),
        6: ("2023-1-5", 0, None),
    }
    assert profile.total_spent(df).first().total_spent == 2.5
    assert purchases.expand_purchase(df).count() == 6


def test_login_times_follow_explode(spark):
    rows = [
        (1, None, 20, None, True, login("2024-01-01T01:00:00", "2024-01-01T13:00:00"), None),
        (2, None, None, None, True, login("2024-01-01T07:00:00"), None),
        (3, None, 60, None, True, login(), None),
        (4, None, 60, None, True, None, None),
        (5, None, 60, None, True, "{}", None),
        (6, None, 60, None, True, login("2024-01-01T07:00:00", "bad"), None),
        (7, None, 60, None, True, '{"timestamps": [null, "2024-01-01T23:00:00"]}', None),
    ]
    df = users_frame(spark, rows)
    times = logins.login_times(df)
    plain = logins.parse_login(df).select("id", F.explode("login_data.timestamps"))
    assert sorted(map(repr, map(tuple, times.collect()))) == sorted(
        map(repr, map(tuple, plain.collect()))
    )
    by_period = {r.period: r.cnt for r in logins.login_period_dist(df).collect()}
    assert by_period == {"0-6clock": 1, "6-12clock": 1, "12-18clock": 1, "18-24clock": 1}
    cells = {(r.age_group, r.period): r.cnt for r in logins.login_by_age_period(df).collect()}
    assert len(cells) == 20 and sum(cells.values()) == 3
    assert cells["18-25", "0-6clock"] == cells["18-25", "12-18clock"] == 1
    assert cells[">50", "18-24clock"] == 1


def test_empty_table(spark):
    df = users_frame(spark, [])
    assert profile.total_users(df).first().total_users == 0
    assert [r.cnt for r in profile.age_dist(df).collect()] == [0] * 5
    assert profile.age_share(df).count() == 0
    assert profile.country_share(df).count() == 0
    assert {r.missing_percent for r in quality.quality_report(df).collect()} == {None}
    summary = profile.profile_summary(df).first()
    assert summary.total_spent == 0 and summary.spent_per_user is None
    assert len(logins.login_heatmap(df).collect()) == 5
    assert quality.unique_id_check(df).first().is_unique


def test_count_bins_and_labels_without_a_bin(spark):
    df = spark.createDataFrame([("a", 2), ("a", 3), ("z", 9), (None, 1)], "k string, w int")
    bins = {"k": ["a", "b"]}
    with pytest.raises(Exception, match="no bin of k"):
        count_bins(df, bins).collect()
    left = count_bins(df, bins, ignore_others=True)
    assert {r.k: r.cnt for r in left.collect()} == {"a": 2, "b": 0}
    weighted = count_bins(df, bins, weight="w", others="rest")
    assert {r.k: r.cnt for r in weighted.collect()} == {"a": 5, "b": 0, "rest": 10}
    known = df.where("k = 'a'")
    assert {r.k: r.cnt for r in count_bins(known, bins).collect()} == {"a": 2, "b": 0}


def test_country_top_breaks_ties_by_name(spark):
    names = [f"c{i:02d}" for i in range(12)] + ["c11"]
    df = spark.createDataFrame([(n,) for n in names], "country string")
    top = [(r.country, r.cnt) for r in profile.country_top(df).collect()]
    assert top == [("c11", 2)] + [(f"c{i:02d}", 1) for i in range(9)]
    shares = profile.country_share(df).collect()
    assert abs(sum(r.percent for r in shares) - 100) < 0.6


def test_quality(spark):
    df = spark.createDataFrame([(1, None), (2, None), (2, "x")], "id bigint, `a.b` string")
    report = {r.column_name: tuple(r)[1:] for r in quality.quality_report(df).collect()}
    assert report == {"id": (0, 0.0), "a.b": (2, 66.67)}
    assert quality.drop_sparse_columns(df).columns == ["id"]
    assert quality.drop_sparse_columns(df, threshold=70).columns == ["id", "a.b"]
    assert tuple(quality.unique_id_check(df).first()) == (3, 2, False)
    assert [tuple(r) for r in quality.duplicate_ids(df).collect()] == [(2, 2)]


def test_profile_summary_counts_distinct_active_users(spark):
    doc = '{"avg_price": 10.0}'
    rows = [
        (1, "f", 20, "A", True, None, doc),
        (1, "f", 20, "A", True, None, doc),
        (2, "m", 30, "B", True, None, None),
        (3, None, 70, "B", False, None, "garbage"),
        (4, "m", 70, "B", True, None, "garbage"),
        (5, "m", 70, "B", None, None, doc),
    ]
    df = users_frame(spark, rows)
    s = profile.profile_summary(df).first()
    assert (s.total_users, s.total_active_users, s.total_spent) == (6, 2, 30.0)
    assert (s.spent_per_user, s.spent_per_active_user) == (5.0, 15.0)
    assert sorted(r.id for r in profile.active_users(df).collect()) == [1, 4]
    assert {r.gender: r.cnt for r in profile.gender_dist(df).collect()} == {
        "f": 2, "m": 3, None: 1,
    }


def test_profile_tables_agree_with_the_single_operators(spark):
    rows = [
        (i, "fmx"[i % 3], None if i % 7 == 0 else 10 + i, f"c{i % 11}", i % 2 == 0,
         login(f"2024-01-01T{i % 24:02d}:00:00", "2024-01-02T08:30:00"),
         f'{{"avg_price": {i}.5}}')
        for i in range(60)
    ]
    df = users_frame(spark, rows)
    tables = jobs.profile_tables(df)

    def same(table, direct):
        names = table.columns
        assert sorted(map(repr, table.collect())) == sorted(map(repr, direct.select(names).collect()))

    same(tables["total_users"], profile.total_users(df))
    same(tables["gender_dist"], profile.gender_dist(df))
    same(tables["age_share"], profile.age_share(df))
    same(tables["country_share"], profile.country_share(df))
    same(tables["login_by_age_period"], logins.login_by_age_period(df))
    same(tables["login_heatmap"], logins.login_heatmap(df))
    same(tables["login_period_dist"], logins.login_period_dist(df))
