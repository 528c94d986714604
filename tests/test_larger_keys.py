"""Queries on keys beyond those of the small tables, held against their SQL."""

import duckdb
import pytest

import __spark_entry__


def same_as_sql(spark, d, name):
    """The query's rows and its SQL's, both sorted."""
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet/*.parquet')")
    got = sorted(map(str, (tuple(r) for r in __spark_entry__.queries()[name](spark, d).collect())))
    return got, sorted(map(str, c.execute(__spark_entry__.oracle_sql()[name]).fetchall()))


TABLES = ("supplier", "part")


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    """Keys of one to six digits."""
    d = str(tmp_path_factory.mktemp("wide"))
    keys = [*range(1, 30), 334, 554, 854, 2487, 2167, 2481, 5481, 5487, 8001, 8002, 8012, 9000, 12345, 12346, 99999, 100000, 123456, 123457]
    spark.createDataFrame([(k, f"Supplier#{k}") for k in keys], "s_suppkey long, s_name string").write.parquet(f"{d}/supplier.parquet")
    spark.createDataFrame([(k, "red ring") for k in keys], "p_partkey long, p_name string").write.parquet(f"{d}/part.parquet")
    return d


def test_candidate_numbers_reads_up_to_three_digits_as_its_sql(spark, wide):
    got, want = same_as_sql(spark, wide, "candidate_numbers")
    assert got == want and "(334, 554)" in got


def test_index_entry_parse_takes_numbers_of_six_digits(spark, wide):
    got, want = same_as_sql(spark, wide, "index_entry_parse")
    assert got == want


def test_second_reading_of_numbers_that_begin_with_nine(spark, wide):
    got, want = same_as_sql(spark, wide, "second_reading")
    assert got == want and "(8002, '9?02')" in got
