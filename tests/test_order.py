"""Ranks, top-k and medians: against brute force, and the same in every partitioning."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from pricebench.functions import order as O


def hashed(spark, n, parts):
    return spark.range(n).repartition(parts).withColumn("h", O.seeded_hash("42:test", F.col("id")))


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_position(spark, parts):
    df = hashed(spark, 500, parts)
    rows = O.with_position(df, ["h", "id"], O.hash_bucket(F.col("h")), "position").collect()
    ordered = sorted(rows, key=lambda r: (r["h"], r["id"]))
    assert [r["position"] for r in ordered] == list(range(500))


@pytest.mark.parametrize("k", [0, 1, 37, 500, 900])
def test_take_smallest(spark, k):
    df = hashed(spark, 500, 5).withColumn("x", O.uniform(F.col("h")) * 50)
    rows = df.collect()
    best = sorted((r["x"], r["id"]) for r in rows)[:k]
    found = O.take_smallest(df, k, ["x", "id"], O.log_bucket(F.col("x"))).collect()
    assert sorted((r["x"], r["id"]) for r in found) == best


def test_take_smallest_of_equal_values(spark):
    df = spark.range(1000).withColumn("x", F.lit(2.5))
    found = O.take_smallest(df, 10, ["x", "id"], O.log_bucket(F.col("x")))
    assert sorted(r["id"] for r in found.collect()) == list(range(10))


@pytest.mark.parametrize("k", [0, 1, 40, 700, 2500, 2999, 3000, 9000])
def test_take_smallest_of_crowded_buckets(spark, k):
    """Three values share all rows; the next part of the order divides the one that k cuts through."""
    draw = random.Random(2)
    rows = [(draw.choice([1, 2, 2, 2, 3]), "".join(draw.choice("abcé") for _ in range(6)) + str(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "n int, term string").repartition(5)
    start = F.hex(F.substring(F.col("term").cast("binary"), 1, 2))
    found = O.take_smallest(df, k, [F.desc("n"), "term"], -O.magnitude_bucket(F.col("n")), start)
    assert found.columns == ["n", "term"]
    assert sorted(map(tuple, found.collect())) == sorted(sorted(rows, key=lambda r: (-r[0], r[1]))[:k])


def test_equal_counts_are_spread_over_tasks(spark):
    df = spark.range(40_000).selectExpr("2 AS n", "concat(char(97 + id % 26), char(97 + id % 25), id) AS term").repartition(4)
    start = F.substring("term", 1, 2)
    found = O.take_smallest(df, 30_000, [F.desc("n"), "term"], -O.magnitude_bucket(F.col("n")), start)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 30_000 and max(sizes) < 0.4 * 30_000  # four shuffle partitions


def test_median(spark):
    rng = random.Random(3)
    groups = {
        "odd": [rng.uniform(-5, 900) for _ in range(301)],
        "even": [round(rng.uniform(0, 20), 1) for _ in range(400)],
        "hot": [9.99] * 500 + [rng.uniform(0, 1e-6) for _ in range(501)],
        "tiny": [3.5],
        "pair": [-2.0, 7.0],
        "zero": [0.0, 0.0, 1e-300, 1e300],
        "close": [1 + i * 1e-13 for i in range(50)],
    }
    rows = [(g, x) for g, values in groups.items() for x in values] + [("odd", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    found = {r["g"]: r["m"] for r in O.exact_median(df, F.col("x"), ["g"], "m").collect()}
    assert found == {g: statistics.median(values) for g, values in groups.items()}
    overall = O.exact_median(df, F.col("x"), [], "m").collect()
    assert overall[0]["m"] == statistics.median(x for _, x in rows if x is not None)


def test_bits_follow_the_order(spark):
    """The bits of every kind of double, as the machine has them."""
    import struct

    rng = random.Random(8)
    values = [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(3000)]
    values += [0.0, -0.0, 1.0, 2.0, 4.0, 0.1, 999.49, 5e-324, 2.0**-1022, 2.0**-1022 - 5e-324, 1.7976931348623157e308]
    values += [float("inf"), float("-inf")] + [2.0**k for k in range(-1074, 1024, 13)] + [2.0**k * (1 - 2**-53) for k in range(-1000, 1024, 17)]
    values = [v for v in values if v == v]
    expected = [(-1 if v < 0 else 1) * struct.unpack("<q", struct.pack("<d", abs(v)))[0] for v in values]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(len(values), float("nan"))], "n int, v double")
    found = [r["b"] for r in df.select("n", O.ordered_bits(F.col("v")).alias("b")).orderBy("n").collect()]
    assert found[:-1] == expected and found[-1] > max(expected)


def test_median_of_many_values_that_share_their_upper_digits(spark):
    """A third of a million distinct values between 1 and 1 + 2^-20, next to a small group."""
    df = spark.range(333_333).selectExpr("'close' AS g", "1 + (id * 7919 % 333333) * pow(2D, -40) AS x")
    df = df.union(spark.createDataFrame([("few", 1.0), ("few", 3.0), (None, 9.0)], "g string, x double"))
    median = O.exact_median(df, F.col("x"), ["g"], "m")
    assert {r["g"]: r["m"] for r in median.collect()} == {"close": 1 + 166_666 * 2.0**-40, "few": 2.0}
    plan = median._jdf.queryExecution().executedPlan().toString()
    assert "RangePartitioning" not in plan and "rangepartitioning" not in plan
    assert O.exact_median(df.filter("g = 'none'"), F.col("x"), ["g"], "m").collect() == []


def test_buckets_follow_the_order(spark):
    rng = random.Random(5)
    values = sorted([rng.uniform(-1, 1) * 10.0 ** rng.randint(-300, 300) for _ in range(2000)] + [0.0, 1.0, -1.0])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, v double")
    buckets = [r["b"] for r in df.select("n", O.magnitude_bucket(F.col("v")).alias("b")).orderBy("n").collect()]
    assert buckets == sorted(buckets)
