"""Metrics against worked arithmetic, and reports on disk."""

import math

import pytest
from pyspark.sql import functions as F

from pricebench.operators import evaluate as E
from pricebench.operators.describe import sample_statistics
from pricebench.sources.reports import write_report

FOUR = [(100.0, 110.0), (50.0, 95.0), (800.0, 750.0), (60.0, 700.0)]


def predictions(spark, pairs, model="m"):
    rows = [(model, i, f"title {i}", t, g) for i, (t, g) in enumerate(pairs)]
    return spark.createDataFrame(rows, "model string, id bigint, title string, truth double, guess double")


def test_four_rows(spark):
    df = predictions(spark, FOUR)
    errors = [r["error"] for r in E.prediction_errors(df).orderBy("id").collect()]
    assert errors == [10.0, 45.0, 50.0, 640.0]
    assert [r["band"] for r in E.error_bands(df).orderBy("id").collect()] == ["green", "amber", "green", "red"]
    row = E.metrics(df).first()
    assert (row["n"], row["avg_error"], row["median_error"], row["hit_rate"]) == (4, 186.25, 47.5, 0.5)
    assert row["rmsle"] == pytest.approx(1.2624, abs=1e-4)
    assert row["r2"] == pytest.approx(-0.0328, abs=1e-4)


def test_band_edges(spark):
    pairs = [(100.0, 140.0), (300.0, 340.0), (200.0, 240.0), (100.0, 180.0), (150.0, 210.0), (0.0, 39.0), (0.0, 50.0), (0.0, 80.0)]
    bands = [r["band"] for r in E.error_bands(predictions(spark, pairs)).orderBy("id").collect()]
    assert bands == ["amber", "green", "amber", "red", "amber", "green", "amber", "red"]


def test_mean_guess_has_no_r2(spark):
    truths = [1.0, 5.0, 9.0, 200.0]
    row = E.metrics(predictions(spark, [(t, sum(truths) / 4) for t in truths])).first()
    assert row["r2"] == pytest.approx(0.0)


def test_constant_truth(spark):
    assert E.metrics(predictions(spark, [(5.0, 5.0), (5.0, 5.0)])).first()["r2"] == 1.0
    assert E.metrics(predictions(spark, [(5.0, 5.0), (5.0, 6.0)])).first()["r2"] == 0.0


def test_negative_guess_in_log_error(spark):
    row = E.prediction_errors(predictions(spark, [(3.0, -2.0)])).first()
    assert row["squared_log_error"] == pytest.approx(math.log(4) ** 2)


def test_worst_bands_and_leaderboard(spark):
    df = predictions(spark, FOUR, "bad").unionByName(predictions(spark, [(t, t) for t, _ in FOUR], "good"))
    worst = E.worst_misses(df, 2).filter("model = 'bad'").orderBy("place").collect()
    assert [r["id"] for r in worst] == [3, 2]
    ties = E.worst_misses(df, 2).filter("model = 'good'").orderBy("place").collect()
    assert [r["id"] for r in ties] == [0, 1]
    counts = {r["model"]: tuple(r)[1:] for r in E.band_counts(df).collect()}
    assert counts == {"bad": (2, 1, 1, 4), "good": (4, 0, 0, 4)}
    assert [r["model"] for r in E.leaderboard(df).collect()] == ["good", "bad"]


def test_display(spark):
    values = [(1234.565, 0.125, 1.0625, -0.0335, 0.6), (0.005, 2.675, 0.0004, -18.6137, 0.3174)]
    board = spark.createDataFrame(
        [("m", i, *v) for i, v in enumerate(values)],
        "model string, n int, avg_error double, median_error double, rmsle double, r2 double, hit_rate double",
    )
    for row, (a, m, s, r, h) in zip(E.display(board).orderBy("n").collect(), values):
        assert tuple(row)[2:] == (f"{a:,.2f}", f"{m:,.2f}", f"{s:.3f}", f"{r:.3f}", f"{h:.1%}")


def test_scatter(spark):
    points = E.scatter_points(predictions(spark, FOUR)).collect()
    assert {r["top"] for r in points} == {800.0} and len(points) == 4


def test_scatter_of_two_models(spark):
    df = predictions(spark, FOUR, "a").unionByName(predictions(spark, FOUR, "b"))
    assert E.scatter_points(df).count() == 8


def test_slice_and_statistics(spark):
    test = spark.range(100, 160).select("id", F.lit("x" * 50).alias("title"), (F.col("id") * 1.0).alias("price"))
    part = E.evaluation_slice(test.repartition(7), 25)
    assert sorted(r["id"] for r in part.collect()) == list(range(100, 125))
    assert part.first()["title"] == "x" * 40
    assert tuple(sample_statistics(part).first()) == (25, 112.0, 112.0)


def test_report(spark, tmp_path):
    df = predictions(spark, FOUR, "a").unionByName(predictions(spark, FOUR, "b"))
    path = write_report(df, str(tmp_path), "fixture")
    summary = spark.read.json(f"{path}/summary")
    assert summary.count() == 2 and {r["dataset"] for r in summary.collect()} == {"fixture"}
    rows = spark.read.json(f"{path}/predictions")
    assert rows.count() == 8 and {"generated", "title", "truth", "guess", "model"} <= set(rows.columns)
