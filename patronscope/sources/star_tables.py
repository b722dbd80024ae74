"""User records built from a star schema of customers, orders, line items and events.

Each view builds only what its caller asks for, so a query that counts genders does
not pay for login documents. Every event, order and line item is in some record, and no
record gathers an unbounded group: a login record holds the events of one user within one
run of ``EVENTS_PER_RECORD`` event numbers (``event_id`` is unique), and an order of more than
``ITEMS_PER_RECORD`` items is dealt to several purchase records, the first of which
has its price. ``id`` therefore repeats in :func:`logins`, :func:`purchases` and
:func:`users`, as it may in a user table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronscope.operators.conversations import conversation_prompts

EVENTS_PER_RECORD = 10_000
ITEMS_PER_RECORD = 100
# Declared, so that no job has to read file footers before the query itself runs.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
        "c_mktsegment string"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
        "value double, props string"
    ),
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def person_columns(key: Column, segment: Column, balance: Column) -> list[Column]:
    """The columns of a user record that come from the customer row alone."""
    return [
        key.alias("id"),
        F.when(key % 11 != 0, segment).alias("gender"),
        F.when(key % 17 != 0, (F.lit(10) + key % 70).cast("int")).alias("age"),
        F.when(key % 5 >= 3, balance).alias("income"),
        (balance >= 0).alias("is_active"),
    ]


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: id, gender, age, income, is_active."""
    customer = table(spark, sf_dir, "customer")
    return customer.select(
        *person_columns(F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_acctbal"))
    )


def people_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`people` with ``country``."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        *person_columns(F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_acctbal")),
        F.col("n_name").alias("country"),
    )


def login_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Login documents of bounded size: ``(user_id, record_no, last_ts, login_history)``."""
    record_no = F.expr(f"event_id div {EVENTS_PER_RECORD}")
    first = F.date_format(F.col("timestamps")[0], "yyyy-MM-dd HH:mm:ss")
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id", record_no.alias("record_no"))
        .agg(
            F.array_sort(F.collect_list(F.col("ts").cast("timestamp"))).alias("timestamps"),
            F.array_sort(F.collect_set("event_type")).alias("devices"),
            F.max("ts").alias("last_ts"),
        )
        .select(
            "user_id",
            "record_no",
            "last_ts",
            F.to_json(
                F.struct(
                    "devices",
                    first.alias("first_login"),
                    F.size("timestamps").cast("bigint").alias("login_count"),
                    "timestamps",
                )
            ).alias("login_history"),
        )
    )


def logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per login record, with the age of its user."""
    return (
        login_records(spark, sf_dir)
        .join(people(spark, sf_dir), F.col("user_id") == F.col("id"))
        .select("id", "age", "login_history")
    )


def purchases(
    spark: SparkSession, sf_dir: str, items: bool = True, documents: bool = True
) -> DataFrame:
    """Purchase records: each order with its price and items, very long ones in parts.

    Without ``items``, one record per order with its price only, and no line item is read.
    Without ``documents``, the same records with a short text wherever there is a document.

    The part of an item follows from its own numbers, so it is the same on every run;
    an order that holds a third of all items is counted, joined and gathered in parts.
    """
    if not items:
        return _priced_orders(spark, sf_dir)
    lines = table(spark, sf_dir, "lineitem")
    sizes = lines.groupBy("l_orderkey").agg(
        F.ceil(F.count("*") / ITEMS_PER_RECORD).cast("bigint").alias("n_parts")
    )
    order_columns = ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"]
    orders = table(spark, sf_dir, "orders")
    parts = orders.select(*order_columns).join(sizes, F.col("o_orderkey") == F.col("l_orderkey"))
    item_part = (F.col("l_partkey") + F.col("l_suppkey") + F.col("l_linenumber")) % F.col("n_parts")
    item_text = F.concat(F.lit('{"id":'), F.col("l_partkey").cast("string"), F.lit("}"))
    # joined by the complement of the key: a key of its own brings a shuffle of its own, and
    # then Spark can split an order with very many lines
    same_order = F.bitwise_not("l_orderkey") == F.col("order")
    parts = parts.drop("l_orderkey").withColumn("order", F.bitwise_not("o_orderkey"))
    items = lines.join(parts, same_order).select(
        *order_columns,
        item_part.alias("part"),
        F.lit(None).cast("double").alias("avg_price"),
        F.struct(F.col("l_partkey").alias("id"), item_text.alias("text")).alias("item"),
    )
    priced = orders.select(
        *order_columns,
        F.lit(0).cast("bigint").alias("part"),
        F.col("o_totalprice").alias("avg_price"),
        F.lit(None).cast("struct<id:bigint,text:string>").alias("item"),
    )
    records = priced.unionByName(items).groupBy(*order_columns, "part").agg(
        F.max("avg_price").alias("avg_price"),
        F.sort_array(F.collect_list("item")).alias("items"),
    )
    document = _order_document() if documents else _has_document()
    return records.select(F.col("o_custkey").alias("id"), document.alias("purchase_history"))


def _priced_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("avg_price", F.col("o_totalprice"))
    no_items = orders.withColumn("items", F.lit(None).cast("array<struct<id:bigint,text:string>>"))
    return no_items.select(F.col("o_custkey").alias("id"), _order_document().alias("purchase_history"))


def _has_document() -> Column:
    """A text where :func:`_order_document` gives one: it is NULL where one of these is."""
    parts = ("o_orderpriority", "o_orderstatus", "o_orderdate")
    return F.when(F.coalesce(*[F.when(F.col(p).isNull(), False) for p in parts], F.lit(True)), F.lit("{}"))


def _order_document() -> Column:
    """An order's JSON text, put together as text: plans that share it can share its shuffle."""

    def quoted(name: str) -> Column:
        return F.replace(F.replace(name, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))

    price = F.concat(F.lit('"avg_price":'), F.col("avg_price").cast("string"), F.lit(","))
    return F.concat(
        F.lit("{"),
        F.coalesce(price, F.lit("")),
        F.lit('"items":['),
        F.coalesce(F.array_join("items.text", ","), F.lit("")),
        F.lit('],"payment_method":"'),
        quoted("o_orderpriority"),
        F.lit('","payment_status":"'),
        quoted("o_orderstatus"),
        F.lit('","purchase_date":"'),
        F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.lit('"}'),
    )


def buyers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per priced order of a customer, with the customer's own columns.

    What reads it needs prices and who bought, so the items are left out.
    """
    return people(spark, sf_dir).join(purchases(spark, sf_dir, items=False), "id")


def users(spark: SparkSession, sf_dir: str, documents: bool = True) -> DataFrame:
    """The whole user table: one row per login or purchase record, at least one per user.

    Without ``documents``, both histories are a short text wherever there is a document.
    """
    base = people_by_country(spark, sf_dir)
    nothing = F.lit(None).cast("string")
    records = (
        login_records(spark, sf_dir)
        .select(
            F.col("user_id").alias("id"),
            F.date_format("last_ts", "yyyy-MM-dd HH:mm:ss").alias("last_login"),
            ("login_history" if documents else F.lit("{}").alias("login_history")),
            nothing.alias("purchase_history"),
        )
        .unionByName(
            purchases(spark, sf_dir, documents=documents).select(
                "id", nothing.alias("last_login"), nothing.alias("login_history"), "purchase_history"
            )
        )
    )
    # an inner join, whose larger side can be split, and the users it leaves out
    seen = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"))
    seen = seen.unionByName(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id")))
    rest = base.join(seen.distinct(), "id", "left_anti")
    return base.join(records, "id").unionByName(rest, allowMissingColumns=True)


def instruction_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conv_id, turn, instruction, input, output`` of the conversations."""
    return conversation_prompts(table(spark, sf_dir, "conversations"))
