"""Every query with SQL must give the rows of that SQL, whatever the number of partitions."""

import glob
import os

import duckdb
import pytest

from pricebench.catalog.oracles import ORACLES
from pricebench.catalog.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for file in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(file)[:-8]} AS SELECT * FROM '{file}'")
    return con


def rows(table):
    names = sorted(table.column_names)
    return names, sorted(repr([row[n] for n in names]) for row in table.to_pylist())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, sf_dir, name):
    found = QUERIES[name](spark, sf_dir)
    assert rows(found.toArrow()) == rows(duck.sql(ORACLES[name]).to_arrow_table())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


@pytest.mark.parametrize("parts", [1, 16])
@pytest.mark.parametrize("name", ["curate", "balanced_sample", "deduplicate", "sequential_ids", "metrics"])
def test_partitions_do_not_matter(spark, duck, sf_dir, name, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        test_query(spark, duck, sf_dir, name)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
