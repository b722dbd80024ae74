"""Scans, sinks, whole jobs, prompts and the file stream."""

import json
import os

import pytest
from pyspark.sql import functions as F

from patronscope import __main__ as cli
from patronscope import sources
from patronscope.operators import durable, profile, prompts
from patronscope.plans import jobs
from patronscope.sources import star_tables
from patronscope.streaming import (
    batch_totals,
    incremental_profile,
    latest_totals,
    profile_entries,
    stream_files,
)

SF = os.environ.get("PATRONSCOPE_TESTDATA", "/root/testdata") + "/sf0.001"


@pytest.fixture(scope="module")
def user_dir(spark, tmp_path_factory):
    """The user table as three part files beside a file that is not one."""
    path = str(tmp_path_factory.mktemp("users") / "table")
    # one row per user, as in the common user table
    attributes = ["id", "gender", "age", "country", "income", "is_active"]
    documents = ["last_login", "login_history", "purchase_history"]
    users = star_tables.users(spark, SF).groupBy(*attributes).agg(*[F.max(n).alias(n) for n in documents])
    users.repartition(3, "id").write.parquet(path)
    stray = next(name for name in os.listdir(path) if name.startswith("part-"))
    with open(f"{path}/{stray}", "rb") as source, open(f"{path}/copy.parquet", "wb") as target:
        target.write(source.read())
    return path


def test_preview_orders_nulls_ties_and_few_rows(spark):
    frame = spark.createDataFrame([(None, "b"), (None, "a"), (1, "d"), (1, "c"), (2, "e")], "id long, text string")
    for rows in range(7):
        found = [tuple(r) for r in sources.preview_columns(frame, ["text"], rows=rows).collect()]
        assert found == [(None, "a"), (None, "b"), (1, "c"), (1, "d"), (2, "e")][:rows]


def test_part_glob_ignores_other_files(spark, user_dir):
    assert sources.scan_users(spark, user_dir).count() > 150
    users = sources.scan_part_files(spark, user_dir)
    assert users.count() == 150
    per_file = sources.rows_per_file(users).collect()
    assert len(per_file) == 3 and sum(r.row_count for r in per_file) == 150
    declared = sources.scan_part_files(spark, user_dir, sources.USER_SCHEMA)
    assert declared.where(F.col("age").isNotNull()).count() > 0
    one = sources.scan_users(spark, f"{user_dir}/{per_file[0].file_name}")
    assert one.count() == per_file[0].row_count


def test_top_countries_per_file(spark, user_dir):
    users = sources.scan_part_files(spark, user_dir).select("country", "_metadata.file_name")
    top = profile.country_top_per_file(users, "file_name", n=2).collect()
    assert len(top) == 6 and {r["rank"] for r in top} == {1, 2}


def test_describe_preview_require(spark, user_dir):
    users = sources.scan_part_files(spark, user_dir)
    described = {r.column_name: r.column_type for r in sources.describe_schema(users).collect()}
    assert described["age"] == "int" and described["purchase_history"] == "string"
    assert [r.id for r in sources.preview_columns(users, ["income"]).collect()] == [0, 1, 2, 3, 4]
    assert sources.require_rows(users) is users
    with pytest.raises(ValueError, match="no rows"):
        sources.require_rows(users.where("false"))


def read_json(path):
    names = [n for n in os.listdir(path) if n.startswith("part-")]
    return [json.loads(line) for n in names for line in open(f"{path}/{n}", encoding="utf-8")]


def test_profile_job(spark, user_dir, tmp_path):
    cli.main(
        ["profile", "--input", user_dir, "--glob", "part-*", "--output", str(tmp_path)], spark
    )
    (summary,) = read_json(tmp_path / "profile_summary")
    assert summary["total_users"] == 150 and summary["processing_seconds"] > 0
    ages = read_json(tmp_path / "age_share")
    assert sum(r["cnt"] for r in ages) == 150
    assert len(read_json(tmp_path / "login_by_age_period")) == 20
    missing = {r["column_name"]: r["missing_percent"] for r in read_json(tmp_path / "quality_report")}
    assert missing["login_history"] == 90.0


def test_rfm_job(spark, user_dir, tmp_path):
    cli.main(
        ["rfm", "--input", user_dir, "--glob", "part-*", "--output", str(tmp_path),
         "--as-of", "2001-08-02 00:00:00"],
        spark,
    )
    centers = read_json(tmp_path / "cluster_centers")
    assert [c["cluster"] for c in sorted(centers, key=lambda c: c["recency"])] == [0, 1, 2]
    members = read_json(tmp_path / "user_clusters")
    users = [r for r in read_json(tmp_path / "rfm_summary") if r["section"] == "rfm"]
    assert {str(m["user_id"]) for m in members} == {u["name"] for u in users}
    assert len(read_json(tmp_path / "nearest_to_center")) == len(members)
    assert len(read_json(tmp_path / "rfm_summary")) == len(users) + 9
    assert not os.path.exists(tmp_path / "rfm_merge_users")
    assert read_json(tmp_path / "run")[0]["processing_seconds"] > 0


def test_rfm_job_without_purchase_dates(spark):
    users = spark.createDataFrame([(1, "garbage")], "id bigint, purchase_history string")
    tables = jobs.rfm_tables(users, F.lit("2024-01-01").cast("timestamp"))
    assert tables["user_clusters"].count() == 0
    assert tables["rfm_summary"].where("section = 'rfm'").count() == 1


def test_check_ids_and_preview(spark, user_dir, capsys):
    cli.main(["check-ids", "--input", user_dir, "--glob", "part-*"], spark)
    assert "true" in capsys.readouterr().out
    cli.main(["check-ids", "--input", user_dir], spark)
    assert "false" in capsys.readouterr().out
    cli.main(["preview", "--input", user_dir, "--glob", "part-*"], spark)
    shown = capsys.readouterr().out
    assert "purchase_history" in shown and "payment_status" in shown


def test_check_ids_writes_all_repeats(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(30).unionByName(spark.range(30)).write.parquet(source)
    cli.main(["check-ids", "--input", source, "--output", target], spark)
    assert len(read_json(tmp_path / "out" / "duplicate_ids")) == 30


def test_profile_job_without_sparse_columns(spark, user_dir, tmp_path):
    options = ["--input", user_dir, "--glob", "part-*", "--output", str(tmp_path), "--drop-sparse"]
    cli.main(["profile", *options], spark)
    assert sorted(os.listdir(tmp_path)) == sorted(
        ["age_share", "country_share", "gender_dist", "profile_summary", "quality_report", "total_users"]
    )


EXAMPLES = [("Say 100% {x}", "", "done"), ("Add", "1, 2", None)]


@pytest.mark.parametrize("file_format", ["json", "parquet"])
def test_prompts(spark, tmp_path, file_format):
    path = str(tmp_path / "examples")
    frame = spark.createDataFrame(EXAMPLES, "instruction string, input string, output string")
    frame.write.format(file_format).save(path)
    examples = sources.scan_instructions(spark, path, file_format)
    texts = {r.instruction: r.text for r in prompts.prompt_format(examples, "<EOS>").collect()}
    assert texts["Say 100% {x}"].endswith(
        "\n\n### Instruction:\nSay 100% {x}\n\n### Input:\n\n\n### Response:\ndone<EOS>"
    )
    assert texts["Add"].endswith("### Input:\n1, 2\n\n### Response:\n<EOS>")
    opened = prompts.prompt_format_inference(examples).collect()
    assert all(r.text.endswith("### Response:\n") for r in opened)


def test_prompts_job(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    frame = spark.createDataFrame(EXAMPLES, "instruction string, input string, output string")
    frame.write.json(source)
    cli.main(["prompts", "--input", source, "--output", target, "--end-token", "</s>"], spark)
    assert all(r["text"].endswith("</s>") for r in read_json(target))


def test_stream_totals_equal_batch_totals_and_continue(spark, user_dir, tmp_path):
    landing = str(tmp_path / "landing")
    users = sources.scan_part_files(spark, user_dir)
    out, state = str(tmp_path / "totals"), str(tmp_path / "state")

    def run():
        stream = stream_files(spark, landing, users.schema)
        return incremental_profile(profile_entries(stream), out, state)

    os.makedirs(landing)
    assert run().count() == 0
    for piece in (users.where("id % 2 = 0"), users.where("id % 2 = 1"), users.where("id < 9")):
        piece.repartition(2).write.mode("append").parquet(landing)
        expected = batch_totals(profile_entries(spark.read.parquet(landing)))
        totals = run()
        assert sorted(map(repr, map(tuple, totals.collect()))) == sorted(
            map(repr, map(tuple, expected.collect()))
        )
    assert {r.dimension for r in totals.collect()} == {
        "all", "gender", "age_group", "country", "login", "spent", "active_user",
    }


def test_a_step_writes_labels_and_no_ids(spark, user_dir, tmp_path):
    landing, out = str(tmp_path / "landing"), str(tmp_path / "totals")
    users = sources.scan_part_files(spark, user_dir).where("is_active and purchase_history is not null")
    assert users.count() > 50
    # the same ids in two files, so that the second step sees none for the first time
    for _ in range(2):
        users.coalesce(1).write.mode("append").parquet(landing)
    stream = stream_files(spark, landing, users.schema, files_per_trigger=1)
    totals = incremental_profile(profile_entries(stream), out, str(tmp_path / "state"))
    (active,) = totals.where("dimension = 'active_user'").collect()
    assert (active.label, active.cnt) == ("all", users.select("id").distinct().count())
    steps = spark.read.parquet(out).groupBy("step").count().collect()
    assert len(steps) == 2 and max(r["count"] for r in steps) <= totals.count()


def test_totals_job(spark, user_dir, tmp_path):
    out = str(tmp_path / "totals")
    options = ["--input", user_dir, "--glob", "part-*", "--output", out]
    cli.main(["totals", *options, "--state", str(tmp_path / "state")], spark)
    totals = latest_totals(spark, out).where("dimension = 'all'").collect()
    assert [r.cnt for r in totals] == [150]


def test_shared_folder_comes_from_the_session(spark):
    assert durable.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    stored = durable.checkpointed(spark.range(5))
    assert stored.count() == 5


def test_unset_shared_folder_is_in_the_warehouse():
    class Session:
        """Just enough of a session without ``spark.checkpoint.dir``."""

        def get(self, name, default=None):
            return "hdfs://x/warehouse/" if name == "spark.sql.warehouse.dir" else default

        def getCheckpointDir(self):
            return None

    session = Session()
    session.conf = session.sparkContext = session
    assert durable.fresh_path(session, "x").startswith("hdfs://x/warehouse/patronscope-work/")
