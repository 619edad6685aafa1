"""Dedup, sampling and splits: edge cases, invariants, hot values, partitionings."""

import math
import random

import pytest
from pyspark.sql import functions as F

from pricebench.catalog import views as V
from pricebench.operators import dedup, describe, sample, split
from pricebench.plans.curate import curate

ITEM = "id bigint, category string, title string, full string, price double"


def random_items(spark, n=600, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # A third of the rows share one title, a third of the rest one body.
        title = "hot" if rng.random() < 0.33 else f"t{rng.randint(0, n // 2)}"
        body = None if rng.random() < 0.33 else f"b{rng.randint(0, n // 2)}"
        rows.append((i, rng.choice(["view", "error", "buy"]), title, body, round(rng.uniform(0.5, 900), 2)))
    return rows, spark.createDataFrame(rows, ITEM)


def brute_dedup(rows, hashes, columns):
    rows = sorted(rows, key=lambda r: (hashes[r[0]], r[0]))
    for column in columns:
        seen, kept = set(), []
        for row in rows:
            if row[column] not in seen:
                seen.add(row[column])
                kept.append(row)
        rows = kept
    return {r[0] for r in rows}


@pytest.mark.parametrize("parts", [1, 7])
def test_dedup(spark, parts):
    rows, df = random_items(spark)
    df = df.repartition(parts)
    hashes = {r["id"]: r["h"] for r in df.select("id", dedup.seeded_hash("42:dedup", F.col("id")).alias("h")).collect()}
    found = lambda passes: {r["id"] for r in dedup.deduplicate(df, passes=passes).collect()}
    assert found(("_title", "_body")) == brute_dedup(rows, hashes, [2, 3])
    assert found(("_title",)) == brute_dedup(rows, hashes, [2])
    assert found(("_body",)) == brute_dedup(rows, hashes, [3])


def test_dedup_sends_one_row_per_hot_value(spark):
    _, df = random_items(spark)
    plan = dedup.deduplicate(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 4 and "Partial" in plan


def test_dedup_removed_by_title_does_not_suppress_by_body(spark):
    # Whichever of the two titles "a" goes, its body no longer counts.
    rows = [(1, "c", "a", "x", 1.0), (2, "c", "a", "y", 1.0), (3, "c", "b", "x", 1.0), (4, "c", "d", "y", 1.0)]
    found = {r["id"] for r in dedup.deduplicate(spark.createDataFrame(rows, ITEM)).collect()}
    assert len(found) == 2 or len(found) == 3
    bodies = [r[3] for r in rows if r[0] in found]
    assert len(set(bodies)) == len(bodies)


def draws(spark, prices, size, categories=None):
    rows = [(i, (categories or ["view"] * len(prices))[i], p) for i, p in enumerate(prices)]
    df = spark.createDataFrame(rows, "id bigint, category string, price double")
    return df, sample.balanced_sample(df, size, damping=V.DAMPING)


def test_sample_is_the_weighted_order(spark):
    rng = random.Random(2)
    prices = [round(rng.lognormvariate(3, 1), 2) for _ in range(400)]
    categories = [rng.choice(["view", "error", "buy"]) for _ in prices]
    df, drawn = draws(spark, prices, 60, categories)
    hashes = {r["id"]: r["h"] for r in df.select("id", sample.seeded_hash("42:sample", F.col("id")).alias("h")).collect()}
    low, high = min(prices), max(prices)
    keys = {}
    for i, (p, c) in enumerate(zip(prices, categories)):
        w = ((p - low) / (high - low + 1e-9)) ** 2 * V.DAMPING.get(c, 1.0)
        if w > 0:
            keys[i] = -math.log((hashes[i] + 0.5) / 2**52) / w
    expected = set(sorted(keys, key=keys.get)[:60])
    assert {r["id"] for r in drawn.collect()} == expected
    assert drawn.agg(F.avg("price")).first()[0] > sum(prices) / len(prices)


def test_sample_larger_than_the_table_leaves_out_weight_zero(spark):
    _, drawn = draws(spark, [1.0, 2.0, 3.0, 1.0], 10)
    assert sorted(r["id"] for r in drawn.collect()) == [1, 2]


def test_sample_of_equal_prices_uses_damping_only(spark):
    _, drawn = draws(spark, [5.0] * 20, 8)
    assert drawn.count() == 8


def test_weights_sum_to_one(spark):
    _, df = random_items(spark)
    weighed = sample.sample_weights(df, V.DAMPING)
    assert weighed.agg(F.sum("sample_weight")).first()[0] == pytest.approx(1.0)
    assert weighed.agg(F.min("sample_weight")).first()[0] == 0.0


@pytest.mark.parametrize(
    "n,sizes", [(9, (9, 0, 0)), (100, (80, 10, 10)), (50_000, (43_000, 5_000, 2_000)), (200_000, (188_000, 10_000, 2_000))]
)
def test_split_sizes(spark, n, sizes):
    rows = split.train_val_test_split(spark.range(n).withColumnRenamed("id", "key"), "key")
    found = {r["split"]: (r["n"], r["low"], r["high"]) for r in rows.groupBy("split").agg(
        F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high")).collect()}
    start = 0
    for name, size in zip(("train", "validation", "test"), sizes):
        if size:
            assert found[name] == (size, start, start + size - 1)
        start += size
    assert rows.select("id").distinct().count() == n


def test_describe(spark):
    _, df = random_items(spark)
    prices = sorted(r["price"] for r in df.collect())
    row = describe.describe_prices(df).first()
    assert (row["n"], row["min_price"], row["max_price"]) == (600, prices[0], prices[-1])
    assert row["median_price"] == (prices[299] + prices[300]) / 2
    counts = [r["n"] for r in describe.category_histogram(df).collect()]
    assert counts == sorted(counts, reverse=True) and sum(counts) == 600


def test_curate_invariants(spark, sf_dir):
    raw = V.listings(spark, sf_dir).drop("src_id")
    # Exact copies of the whole table: the copies must not survive.
    copies = raw.unionByName(raw).unionByName(raw)
    once = {(r["title"], r["id"], r["split"]) for r in curate(raw, 80, damping=V.DAMPING).collect()}
    rows = curate(copies.repartition(5), 80, damping=V.DAMPING).collect()
    assert {(r["title"], r["id"], r["split"]) for r in rows} == once
    keyed = curate(V.listings(spark, sf_dir), 80, key="src_id", damping=V.DAMPING).collect()
    for rows in (rows, keyed):
        check_curated(rows)


def check_curated(rows):
    assert sorted(r["id"] for r in rows) == list(range(80))
    assert len({r["title"] for r in rows}) == 80 and len({r["full"] for r in rows}) == 80
    assert [sum(r["split"] == s for r in rows) for s in ("train", "validation", "test")] == [64, 8, 8]
