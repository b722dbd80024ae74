"""Properties of physical plans that the results alone do not show."""

import os

import pytest

from patronscope.operators import conversations, logins, profile, purchases, quality, rfm
from patronscope.plans import catalog, catalog_sql
from patronscope.sources import USER_SCHEMA, scan_users, star_tables

SF = os.environ.get("PATRONSCOPE_TESTDATA", "/root/testdata") + "/sf0.001"
QUERIES = catalog.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "users")
    star_tables.users(spark, SF).write.parquet(path)
    return scan_users(spark, path, USER_SCHEMA)


@pytest.mark.parametrize("name", sorted(catalog_sql.oracle_sql()))
def test_no_pair_joins_and_no_python_in_any_query(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert operator not in text


def read_schema(df):
    (line,) = [part for part in plan(df).splitlines() if "ReadSchema" in part]
    return line.split("ReadSchema: struct<")[1].rstrip(">")


def test_scans_read_only_what_is_used(stored):
    assert read_schema(profile.gender_dist(stored)) == "gender:string"
    assert read_schema(logins.login_heatmap(stored)) == "age:int,login_history:string"
    assert read_schema(profile.total_spent(stored)) == "purchase_history:string"
    assert read_schema(quality.unique_id_check(stored)) == "id:bigint"
    assert read_schema(rfm.rfm_merge_users(purchases.purchase_records(stored))) == (
        "id:bigint,purchase_history:string"
    )


def test_filters_reach_the_scan(stored):
    records = plan(purchases.purchase_records(stored))
    assert "PushedFilters: [IsNotNull(purchase_history)]" in records
    active = plan(profile.active_users(stored))
    assert "EqualTo(is_active,true)" in active and "IsNotNull(purchase_history)" in active
    assert "PushedFilters: [IsNotNull(age)]" in plan(logins.login_by_age_period(stored))


@pytest.mark.parametrize(
    "build",
    [
        lambda users: logins.login_by_age_period(users),
        lambda users: logins.login_times(users),
        lambda users: purchases.purchase_records(users),
        lambda users: rfm.rfm_merge_users(purchases.purchase_records(users)),
    ],
)
def test_documents_are_parsed_once(stored, build):
    assert plan(build(stored)).count("from_json(") == 1


@pytest.mark.parametrize(
    ("build", "exchanges"),
    [
        (profile.gender_dist, 1),
        (profile.age_dist, 1),
        (profile.country_top, 1),
        (logins.login_times, 0),
        (logins.login_by_age_period, 1),
        (quality.missing_counts, 1),
        (quality.duplicate_ids, 1),
        (lambda users: rfm.rfm_merge_users(purchases.purchase_records(users)), 1),
    ],
)
def test_number_of_shuffles(stored, build, exchanges):
    assert plan(build(stored)).count("Exchange ") == exchanges


def test_top_rows_are_cut_before_the_shuffle(spark, stored):
    assert "TakeOrderedAndProject" in plan(profile.country_top(stored))
    ranked = plan(QUERIES["nearest_to_center"](spark, SF))
    assert ranked.count("WindowGroupLimit") == 4


def test_no_window_over_a_whole_conversation(spark):
    turns = star_tables.table(spark, SF, "conversations")
    windows = [x for x in plan(conversations.conversation_prompts(turns)).splitlines() if "Window [" in x]
    # over the turns of one block, and over the one row of each block
    assert len(windows) == 2 and sum("turn#" in x for x in windows) == 1
    assert all("__block#" in x for x in windows)


@pytest.mark.parametrize("name", ["nearest_to_center", "distance_to_center", "cluster_scatter"])
def test_labels_are_read_twice_and_built_once(spark, name):
    text = plan(QUERIES[name](spark, SF))
    # the statistics and the means, each one subquery in one column
    assert 2 <= text.count("Subquery subquery#") <= 6
    scans = [x for x in text.splitlines() if "FileScan" in x]
    held = [x for x in text.splitlines() if "InMemoryTableScan" in x]
    # the four scans of the records are printed below every read of the held features, and nowhere else
    assert 0 < len(held) <= 4 and len(scans) == 4 * len(held)


@pytest.mark.parametrize("name", ["missing_counts", "missing_percent", "quality_report"])
def test_quality_builds_no_documents(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "to_json" not in text and "array_join" not in text and "collect_list" not in text


@pytest.mark.parametrize("name", ["total_spent", "active_users", "profile_summary"])
def test_prices_need_no_items(spark, name):
    assert "lineitem" not in plan(QUERIES[name](spark, SF)) and "l_orderkey" not in plan(QUERIES[name](spark, SF))


def test_footers_give_the_missing_counts(spark, stored, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, None if i % 3 else "x", None) for i in range(100)]
    spark.createDataFrame(rows, "id long, `a.b` string, n int").repartition(3).write.parquet(path)
    read = spark.read.parquet(path)
    assert sorted(map(tuple, quality.stored_missing_counts(spark, path).collect())) == sorted(
        map(tuple, quality.missing_counts(read).collect())
    )
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_a_table_without_sparse_columns_is_built_once(spark):
    from pyspark.sql import functions as F

    calls = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            calls.add(len(b))
            yield b

    df = spark.range(100).select("id", F.when(F.col("id") < 10, F.col("id")).alias("few"), F.lit("x").alias("x"))
    result = quality.drop_sparse_columns(df.mapInPandas(counted, df.schema))
    assert result.columns == ["id", "x"] and result.count() == 100 and result.agg(F.sum("id")).first()[0] == 4950
    assert calls.value == 100
    empty = quality.drop_sparse_columns(df.limit(0))
    assert empty.columns == df.columns and empty.count() == 0


def test_held_tables_are_released(spark):
    from patronscope.operators.held import held, release

    release()
    kept = held(spark.range(10))
    kept.count()
    assert kept.storageLevel.useMemory and release() == 1
    assert not kept.storageLevel.useMemory and release() == 0 and kept.count() == 10


def test_preview_builds_documents_of_the_shown_keys_only(spark):
    text = plan(QUERIES["preview_columns"](spark, SF))
    for key in ("user_id", "o_custkey", "c_custkey"):
        assert f"LessThanOrEqual({key},ScalarSubquery" in text
    assert "lineitem" not in plan(QUERIES["total_spent"](spark, SF))
