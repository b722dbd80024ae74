"""Every operator as a query over the star tables.

Views that a query needs come from :mod:`patronscope.sources.star_tables`; parameters
that the SQL check must repeat are constants here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronscope import functions, sources, streaming
from patronscope.operators import (
    binned,
    clusters,
    logins,
    profile,
    prompts,
    purchases,
    quality,
    rfm,
    segments,
)
from patronscope.operators.held import held, release
from patronscope.sources import star_tables

AS_OF = "2001-08-02 00:00:00"
END_TOKEN = "<EOS>"
# Start centres in standardised units: recency, frequency, monetary.
CENTROIDS = ((-0.34, 0.98, 0.97), (1.83, -0.84, -0.81), (-0.32, -0.53, -0.53))
# Fewer than the members of each cluster, so that the checks see the cut.
NEAREST = 100
SEGMENT_RULE = segments.SegmentRule(yearly_purchases=3)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _query(build: Query) -> Query:
    """Registers a query under its function's name, run in UTC.

    What an earlier query still holds is released first.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        release()
        return build(spark, sf_dir)

    _QUERIES[build.__name__] = run
    return run


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


def _as_of():
    return F.lit(AS_OF).cast("timestamp")


# Scans --------------------------------------------------------------------------


# A pattern that this one name alone fits; a sibling such as customer.parquet.old is not read.
_CUSTOMER_NAME = "customer.parque[t]"


def _customer_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers, kept as one file or as a folder of part files."""
    path = f"{sf_dir}/{_CUSTOMER_NAME}"
    return sources.scan_part_files(spark, path, star_tables.SCHEMAS["customer"], glob=None)


@_query
def scan_users(spark, sf_dir):
    scanned = sources.scan_users(spark, f"{sf_dir}/customer.parquet", star_tables.SCHEMAS["customer"])
    return scanned.select(
        *star_tables.person_columns(
            F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_acctbal")
        )
    )


@_query
def scan_part_glob(spark, sf_dir):
    return _customer_files(spark, sf_dir).select("c_custkey", "c_name", "c_nationkey")


@_query
def rows_per_file(spark, sf_dir):
    return sources.rows_per_file(_customer_files(spark, sf_dir), sources.input_name())


@_query
def preview_columns(spark, sf_dir):
    document = functions.purchase_document(
        F.col("purchase_history"), "avg_price", "payment_method", "purchase_date"
    )
    users = star_tables.users(spark, sf_dir).withColumn("purchase_data", document)
    users = users.select("*", "purchase_data.*")
    shown = ["last_login", "income", "login_history", "avg_price", "payment_method", "purchase_date"]
    return sources.preview_columns(users, shown, rows=40)


# Quality ------------------------------------------------------------------------


@_query
def missing_counts(spark, sf_dir):
    return quality.missing_counts(star_tables.users(spark, sf_dir, documents=False))


@_query
def missing_percent(spark, sf_dir):
    report = quality.missing_percent(star_tables.users(spark, sf_dir, documents=False))
    return _rounded(report, 4, "missing_percent")


@_query
def quality_report(spark, sf_dir):
    return quality.quality_report(star_tables.users(spark, sf_dir, documents=False))


@_query
def drop_sparse_columns(spark, sf_dir):
    return quality.drop_sparse_columns(star_tables.users(spark, sf_dir))


@_query
def unique_id_check(spark, sf_dir):
    return quality.unique_id_check(star_tables.people(spark, sf_dir))


@_query
def duplicate_ids(spark, sf_dir):
    return quality.duplicate_ids(star_tables.purchases(spark, sf_dir))


# Profile ------------------------------------------------------------------------


@_query
def total_users(spark, sf_dir):
    return profile.total_users(star_tables.people(spark, sf_dir))


@_query
def gender_dist(spark, sf_dir):
    return profile.gender_dist(star_tables.people(spark, sf_dir))


@_query
def age_group(spark, sf_dir):
    users = profile.with_age_group(star_tables.people(spark, sf_dir))
    return users.select("id", "age", "age_group")


@_query
def age_dist(spark, sf_dir):
    return profile.age_dist(star_tables.people(spark, sf_dir))


@_query
def age_share(spark, sf_dir):
    return profile.age_share(star_tables.people(spark, sf_dir))


@_query
def country_top10(spark, sf_dir):
    return profile.country_top(star_tables.people_by_country(spark, sf_dir))


@_query
def country_share(spark, sf_dir):
    return profile.country_share(star_tables.people_by_country(spark, sf_dir))


@_query
def per_file_country_topk(spark, sf_dir):
    scanned = _customer_files(spark, sf_dir).select(
        "c_nationkey", sources.input_name().alias("file_name")
    )
    nation = star_tables.table(spark, sf_dir, "nation")
    by_country = scanned.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "file_name", F.col("n_name").alias("country")
    )
    return profile.country_top_per_file(by_country, "file_name")


@_query
def active_users(spark, sf_dir):
    return profile.active_users(star_tables.buyers(spark, sf_dir))


@_query
def total_spent(spark, sf_dir):
    return _rounded(profile.total_spent(star_tables.buyers(spark, sf_dir)), 2, "total_spent")


@_query
def profile_summary(spark, sf_dir):
    summary = profile.profile_summary(
        star_tables.people(spark, sf_dir), star_tables.buyers(spark, sf_dir)
    )
    ratios = ("active_fraction", "spent_per_user", "spent_per_active_user")
    return _rounded(_rounded(summary, 2, "total_spent"), 4, *ratios)


# Logins -------------------------------------------------------------------------


@_query
def parse_login(spark, sf_dir):
    parsed = logins.parse_login(star_tables.logins(spark, sf_dir))
    return parsed.select(
        "id",
        "login_data.login_count",
        F.size("login_data.timestamps").cast("bigint").alias("timestamp_count"),
        F.date_format(F.array_min("login_data.timestamps"), "yyyy-MM-dd HH:mm:ss").alias(
            "first_timestamp"
        ),
        "login_data.first_login",
    )


@_query
def login_times(spark, sf_dir):
    times = logins.login_times(star_tables.logins(spark, sf_dir))
    return times.select(
        "user_id", F.date_format("login_time", "yyyy-MM-dd HH:mm:ss").alias("login_time")
    )


@_query
def login_period(spark, sf_dir):
    times = logins.login_times(star_tables.logins(spark, sf_dir))
    return times.select(
        "user_id",
        F.date_format("login_time", "yyyy-MM-dd HH:mm:ss").alias("login_time"),
        functions.login_period(F.col("login_time")).alias("period"),
    )


@_query
def login_period_dist(spark, sf_dir):
    return logins.login_period_dist(star_tables.logins(spark, sf_dir))


@_query
def login_by_age_period(spark, sf_dir):
    return logins.login_by_age_period(star_tables.logins(spark, sf_dir))


@_query
def zero_filled_bins(spark, sf_dir):
    """Order priorities by status, with labels that no order has and one for all the rest."""
    orders = star_tables.table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")
    )
    bins = {"status": ["F", "O", "P", "X"], "priority": ["1-URGENT", "2-HIGH", "9-NONE"]}
    return binned.count_bins(orders, bins, others="other")


@_query
def login_heatmap(spark, sf_dir):
    return logins.login_heatmap(star_tables.logins(spark, sf_dir))


# Purchases and RFM --------------------------------------------------------------


@_query
def parse_purchase(spark, sf_dir):
    parsed = purchases.parse_purchase(star_tables.purchases(spark, sf_dir))
    return parsed.select(
        "id",
        "purchase_data.avg_price",
        F.size("purchase_data.items").cast("bigint").alias("item_count"),
        "purchase_data.purchase_date",
        "purchase_data.payment_method",
    )


@_query
def expand_purchase(spark, sf_dir):
    expanded = purchases.expand_purchase(star_tables.purchases(spark, sf_dir))
    item = F.try_element_at("items", F.lit(1))["id"]
    return expanded.withColumn("first_item", item).drop("items")


def _records(spark, sf_dir):
    return purchases.purchase_records(star_tables.purchases(spark, sf_dir))


@_query
def purchase_records(spark, sf_dir):
    return _records(spark, sf_dir)


def _features(spark, sf_dir):
    return rfm.rfm_features(rfm.rfm_merge_users(_records(spark, sf_dir)), _as_of())


@_query
def rfm_merge_users(spark, sf_dir):
    merged = rfm.rfm_merge_users(_records(spark, sf_dir))
    return _rounded(merged, 2, "monetary").withColumn(
        "last_purchase", F.date_format("last_purchase", "yyyy-MM-dd")
    )


@_query
def recency_months(spark, sf_dir):
    """The recency of every order, from its date as text."""
    texts = star_tables.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("user_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("purchase_time"),
    )
    dated = purchases.dated_records(texts).withColumnRenamed("purchase_day", "last_purchase")
    return _rounded(rfm.with_recency(dated, _as_of()), 4, "recency").select(
        F.col("user_id").alias("order_id"), F.col("purchase_time").alias("order_day"), "recency"
    )


@_query
def rfm_features(spark, sf_dir):
    return _rounded(_rounded(_features(spark, sf_dir), 4, "recency"), 2, "monetary")


@_query
def rfm_user_count(spark, sf_dir):
    return rfm.rfm_user_count(_records(spark, sf_dir))


@_query
def rfm_extent(spark, sf_dir):
    extent = rfm.rfm_extent(_features(spark, sf_dir))
    extent = _rounded(extent, 4, "min_recency", "max_recency")
    return _rounded(extent, 2, "min_monetary", "max_monetary")


@_query
def rfm_scaled(spark, sf_dir):
    return _rounded(rfm.standardize(held(_features(spark, sf_dir))), 4, *rfm.RFM_COLUMNS)


@_query
def rfm_summary(spark, sf_dir):
    report = quality.quality_report(star_tables.purchases(spark, sf_dir))
    summary = rfm.rfm_summary(report, rfm.rfm_merge_users(_records(spark, sf_dir)))
    return _rounded(summary, 2, "monetary")


# Clusters -----------------------------------------------------------------------


def _assigned(spark, sf_dir):
    return clusters.kmeans_assign(rfm.standardize(held(_features(spark, sf_dir))), CENTROIDS)


def _labelled(spark, sf_dir):
    """Features in their own units with the label of the fixed start centres."""
    features = held(_features(spark, sf_dir))
    units = {f"__{name}": F.col(name) for name in rfm.RFM_COLUMNS}
    scaled = rfm.standardize(features.withColumns(units), list(units))
    return clusters.kmeans_assign(scaled, CENTROIDS, list(units)).select(
        "user_id", *rfm.RFM_COLUMNS, "cluster"
    )


@_query
def kmeans_assign(spark, sf_dir):
    return _rounded(_assigned(spark, sf_dir), 4, "distance").select(
        "user_id", "cluster", "distance"
    )


@_query
def kmeans_step(spark, sf_dir):
    moved = clusters.kmeans_step(rfm.standardize(held(_features(spark, sf_dir))), CENTROIDS)
    return _rounded(moved, 4, *rfm.RFM_COLUMNS)


@_query
def cluster_means(spark, sf_dir):
    means = clusters.cluster_means(_labelled(spark, sf_dir))
    return _rounded(_rounded(means, 4, "recency", "frequency"), 2, "monetary")


@_query
def cluster_sizes(spark, sf_dir):
    return clusters.cluster_sizes(_labelled(spark, sf_dir))


@_query
def distance_to_center(spark, sf_dir):
    distances = clusters.distance_to_center(_labelled(spark, sf_dir), k=len(CENTROIDS))
    return _rounded(distances, 2, "distance").select("user_id", "cluster", "distance")


@_query
def nearest_to_center(spark, sf_dir):
    nearest = clusters.nearest_to_center(_labelled(spark, sf_dir), len(CENTROIDS), NEAREST)
    return _rounded(nearest, 2, "distance").select("cluster", "rank", "user_id", "distance")


@_query
def cluster_scatter(spark, sf_dir):
    points = clusters.cluster_scatter(_labelled(spark, sf_dir), len(CENTROIDS), NEAREST)
    return _rounded(_rounded(points, 4, "recency"), 2, "monetary")


def _fitted(spark, sf_dir):
    """The features, held for the many passes, and the fitted centres."""
    features = held(_features(spark, sf_dir))
    return features, clusters.fit_clusters(features, tolerance=1e-12, starts=6)


@_query
def rfm_clusters(spark, sf_dir):
    features, model = _fitted(spark, sf_dir)
    labelled = clusters.rfm_clusters(features, model=model)
    return _rounded(_rounded(labelled, 4, "recency"), 2, "monetary")


@_query
def cluster_centers(spark, sf_dir):
    centers = clusters.cluster_centers(*_fitted(spark, sf_dir))
    return _rounded(_rounded(centers, 4, "recency", "frequency"), 2, "monetary")


@_query
def cluster_results(spark, sf_dir):
    features, model = _fitted(spark, sf_dir)
    return clusters.user_clusters(clusters.rfm_clusters(features, model=model))


@_query
def rfm_silhouette(spark, sf_dir):
    return _rounded(clusters.silhouette(*_fitted(spark, sf_dir)), 6, "silhouette")


# Segments -----------------------------------------------------------------------


def _segmented(spark, sf_dir):
    totals = rfm.user_totals(_records(spark, sf_dir), _as_of())
    return segments.rfm_segments(segments.segment_features(totals, _as_of()), SEGMENT_RULE)


@_query
def rfm_segments(spark, sf_dir):
    # Means of whole cents often end in exactly half a cent: drop the noise of the
    # double sum first, then round the half.
    steady = _rounded(_segmented(spark, sf_dir), 6, "mean_spend")
    return _rounded(_rounded(steady, 4, "recency"), 2, "mean_spend")


@_query
def segment_actions(spark, sf_dir):
    acted = segments.segment_actions(_segmented(spark, sf_dir))
    return acted.select("user_id", "segment", "action")


# Prompts ------------------------------------------------------------------------


@_query
def instructions_scan(spark, sf_dir):
    examples = star_tables.instruction_examples(spark, sf_dir)
    return examples.select("instruction", "input", "output")


@_query
def conversation_prompts(spark, sf_dir):
    return star_tables.instruction_examples(spark, sf_dir)


@_query
def prompt_format(spark, sf_dir):
    examples = star_tables.instruction_examples(spark, sf_dir)
    return prompts.prompt_format(examples, END_TOKEN).select("conv_id", "turn", "text")


@_query
def prompt_format_inference(spark, sf_dir):
    examples = star_tables.instruction_examples(spark, sf_dir)
    return prompts.prompt_format_inference(examples).select("conv_id", "turn", "text")


# Streaming ----------------------------------------------------------------------


@_query
def incremental_profile(spark, sf_dir):
    """Running totals over customers that arrive, with their logins and purchases."""

    def arriving() -> DataFrame:
        path = f"{sf_dir}/{_CUSTOMER_NAME}"
        return streaming.stream_files(spark, path, star_tables.SCHEMAS["customer"], glob=None)

    person = star_tables.person_columns(F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_acctbal"))
    nation = star_tables.table(spark, sf_dir, "nation")
    users = arriving().join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    users = users.select(*person, F.col("n_name").alias("country"))
    people = arriving().select(*person)
    logins_of = star_tables.login_records(spark, sf_dir).withColumnRenamed("user_id", "id")
    purchases_of = star_tables.purchases(spark, sf_dir, items=False)
    entries = (
        streaming.user_entries(users)
        .unionByName(streaming.login_entries(people.join(logins_of, "id")))
        .unionByName(streaming.purchase_entries(people.join(purchases_of, "id")))
    )
    totals = streaming.incremental_profile(entries)
    return _rounded(totals.withColumn("amount", F.col("amount").cast("double")), 2, "amount")
