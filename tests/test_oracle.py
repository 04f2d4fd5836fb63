"""Every registered query against its SQL in DuckDB."""

import sys
from pathlib import Path

import pytest
from comparing import connect, duckdb_rows, spark_rows

sys.path.insert(0, str(Path(__file__).parent.parent))

import __spark_entry__ as entry_points  # noqa: E402

FOLDER = Path("/root/testdata/sf0.001")
LARGER = Path("/root/testdata/sf0.01")
QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no sample tables")


@pytest.fixture(scope="module")
def duck():
    return connect(str(FOLDER))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    columns, rows = spark_rows(QUERIES[name](spark, str(FOLDER)))
    expected_columns, expected = duckdb_rows(duck, SQL[name])
    assert columns == expected_columns
    assert rows == expected
    assert rows


@pytest.mark.skipif(not LARGER.exists(), reason="no larger sample")
@pytest.mark.parametrize("name", ["a16_congestion_status", "j7_weather_asof", "w7_champion_runs", "w8_sampled_moments"])
def test_query_equals_sql_on_the_larger_sample(spark, name):
    _, rows = spark_rows(QUERIES[name](spark, str(LARGER)))
    assert rows == duckdb_rows(connect(str(LARGER)), SQL[name])[1]


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - SQL.keys()))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, str(FOLDER)).count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_partitioning_does_not_change_results(spark):
    names = ["q3_feature_table", "q7_route_maps", "w7_champion_runs", "w8_sampled_moments"]
    before = [spark_rows(QUERIES[name](spark, str(FOLDER))) for name in names]
    settings = {"spark.sql.shuffle.partitions": "13", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        assert before == [spark_rows(QUERIES[name](spark, str(FOLDER))) for name in names]
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
