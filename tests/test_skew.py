"""The queries on tables where one key holds a third of the rows, without broadcasts."""

import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from oracle import TABLES, compare, connect
from patronscope.functions import login_document as logins_of
from patronscope.functions import purchase_document
from patronscope.operators.conversations import conversation_prompts, with_next_turn
from patronscope.plans import jobs
from patronscope.sources import star_tables

SOURCE = os.environ.get("PATRONSCOPE_TESTDATA", "/root/testdata") + "/sf0.001"

# Small enough that the hot key of the fixture counts as skewed.
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _hot(column, value, third):
    return F.when(third, F.lit(value)).otherwise(F.col(column)).cast("bigint")


def _one_long_conversation(turns):
    """Every third conversation becomes part of number 0, renumbered with gaps."""
    merged = turns.withColumn("long", _hot("conv_id", 0, F.col("conv_id") % 3 == 0))
    place = F.row_number().over(Window.partitionBy("long").orderBy("conv_id", "turn")) * 700
    return merged.select(
        F.col("long").alias("conv_id"), place.cast("bigint").alias("turn"), "role", "text"
    )


@pytest.fixture(scope="module")
def hot_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("hot"))
    tables = {name: spark.read.parquet(f"{SOURCE}/{name}.parquet") for name in TABLES}
    tables["events"] = tables["events"].withColumn(
        "user_id", _hot("user_id", 3, F.col("event_id") % 3 == 0)
    )
    tables["orders"] = tables["orders"].withColumn(
        "o_custkey", _hot("o_custkey", 5, F.col("o_orderkey") % 3 == 0)
    )
    tables["lineitem"] = tables["lineitem"].withColumn(
        "l_orderkey", _hot("l_orderkey", 7, F.col("l_partkey") % 3 == 0)
    )
    tables["conversations"] = _one_long_conversation(tables["conversations"])
    for name, table in tables.items():
        table.repartition(4).write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.fixture
def skew_settings(spark):
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def connect_parts(path):
    con = connect(SOURCE)
    for name in TABLES:
        con.execute(
            f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{path}/{name}.parquet/*.parquet'"
        )
    return con


@pytest.mark.parametrize(
    "name",
    [
        "login_by_age_period", "login_times", "preview_columns", "drop_sparse_columns",
        "duplicate_ids", "profile_summary", "purchase_records", "rfm_merge_users",
        "rfm_features", "kmeans_assign", "nearest_to_center", "segment_actions",
        "conversation_prompts", "prompt_format", "missing_counts", "total_spent",
    ],
)
def test_hot_keys(spark, hot_dir, skew_settings, name):
    result = spark_entry.queries()[name](spark, hot_dir)
    difference = compare(result, connect_parts(hot_dir), spark_entry.oracle_sql()[name])
    assert difference is None, difference


@pytest.mark.parametrize("view", ["purchases", "logins"])
def test_joins_split_hot_keys(spark, hot_dir, skew_settings, view):
    df = getattr(star_tables, view)(spark, hot_dir)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan, plan


def test_login_records_stay_small(spark, hot_dir, monkeypatch):
    monkeypatch.setattr(star_tables, "EVENTS_PER_RECORD", 50)
    count = F.get_json_object("login_history", "$.login_count").cast("int")
    sizes = star_tables.login_records(spark, hot_dir).agg(F.max(count), F.sum(count)).first()
    assert 1 < sizes[0] <= 50
    assert sizes[1] == star_tables.table(spark, hot_dir, "events").count()


def test_long_orders_are_dealt_to_parts(spark, hot_dir, monkeypatch):
    monkeypatch.setattr(star_tables, "ITEMS_PER_RECORD", 50)
    records = star_tables.purchases(spark, hot_dir).select(
        purchase_document(F.col("purchase_history"), "avg_price", "items").alias("d")
    )
    sizes = records.agg(
        F.max(F.size("d.items")), F.sum(F.size("d.items")), F.count("d.avg_price")
    ).first()
    assert 4 < sizes[0] <= 150
    lines, orders = (star_tables.table(spark, hot_dir, t) for t in ("lineitem", "orders"))
    assert sizes[1] == lines.count() and sizes[2] == orders.count()


@pytest.mark.parametrize("events", [7, 10_000])
def test_every_login_and_order_reaches_the_figures(spark, monkeypatch, events):
    monkeypatch.setattr(star_tables, "EVENTS_PER_RECORD", events)
    tables = jobs.profile_tables(
        star_tables.people_by_country(spark, SOURCE),
        star_tables.logins(spark, SOURCE),
        star_tables.buyers(spark, SOURCE),
    )
    base = {t: star_tables.table(spark, SOURCE, t) for t in ("events", "orders", "customer")}
    logins = tables["login_period_dist"].agg(F.sum("cnt")).first()[0]
    assert logins == base["events"].count()
    summary = tables["profile_summary"].first()
    money = base["orders"].agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)"))).first()[0]
    assert summary.total_spent == float(money) and summary.total_users == base["customer"].count()
    users = star_tables.users(spark, SOURCE)
    counted = users.select(logins_of(F.col("login_history"), "timestamps").alias("d"))
    assert counted.agg(F.sum(F.size("d.timestamps"))).first()[0] == base["events"].count()


def test_next_turns_with_gaps_and_late_system_turns(spark):
    rows = [(1, 10 * i, r, f"{r}{i}") for i, r in enumerate(["user", "assistant", "system", "user", "assistant"])]
    rows += [(2, 5, "user", "q"), (2, 9, "user", "r"), (2, 4000, "assistant", "a"), (3, 1, "user", "alone")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(tuple(r) for r in conversation_prompts(turns).collect())
    assert got == [
        (1, 0, "user0", "system2", "assistant1"), (1, 30, "user3", "system2", "assistant4"), (2, 9, "r", "", "a"),
    ]
    for block in (1, 3, 20, 10**6):
        following = with_next_turn(turns, block).collect()
        assert {(r.conv_id, r.turn): r.next_text for r in following}[2, 9] == "a" and len(following) == len(rows)
