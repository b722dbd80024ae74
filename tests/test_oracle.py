"""Every query against its SQL, at two scales; the rest must give rows."""

import os

import pytest

import __spark_entry__ as spark_entry
from oracle import TABLES, compare, connect

ROOT = os.environ.get("PATRONSCOPE_TESTDATA", "/root/testdata")
QUERIES = spark_entry.queries()
SQL = spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def parts_dir(spark, tmp_path_factory):
    """The smallest tables, each as a folder of part files."""
    path = str(tmp_path_factory.mktemp("parts"))
    for name in TABLES:
        spark.read.parquet(f"{ROOT}/sf0.001/{name}.parquet").repartition(3).write.parquet(
            f"{path}/{name}.parquet"
        )
    return path


@pytest.mark.parametrize("name", sorted(SQL))
@pytest.mark.parametrize("layout", ["files", "folders"])
def test_matches_sql(spark, parts_dir, layout, name):
    given = f"{ROOT}/sf0.01" if layout == "files" else f"{ROOT}/sf0.001"
    read = given if layout == "files" else parts_dir
    difference = compare(QUERIES[name](spark, read), connect(given), SQL[name])
    spark.catalog.clearCache()
    assert difference is None, difference


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    result = QUERIES[name](spark, f"{ROOT}/sf0.001")
    assert result.count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    rows = spark_entry.entry(spark).collect()
    assert {row.age_group for row in rows} == {"<18", "18-25", "25-35", "35-50", ">50"}
    assert sum(sum(row[1:]) for row in rows) > 0
