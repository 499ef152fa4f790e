"""Registered queries beside their SQL, on the smallest benchmark tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from tillspark.plans.oracle import ORACLE
from tillspark.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# One query per family; the whole registry is compared outside the unit tests.
CHOSEN = (
    "extract_typed", "dq_results", "dim_product", "co_purchase_rules", "adoption_by_team",
    "sem_dim_customer", "rev_yoy", "rls_sales", "input_fingerprint",
)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the benchmark tables")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def comparable(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        if isinstance(value, float):
            return "null" if math.isnan(value) else repr(round(value, 9))
        return "null" if value is None else repr(value)

    return sorted(columns), sorted([plain(row[i]) for i in order] for row in data)


def test_registries_name_the_same_queries():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", CHOSEN)
def test_query_matches_its_sql(spark, sql, name):
    found = entry_points.queries()[name](spark, SF_DIR)
    result = sql.execute(entry_points.oracle_sql()[name])
    expected = comparable([d[0] for d in result.description], result.fetchall())
    assert comparable(found.columns, [tuple(r) for r in found.collect()]) == expected
