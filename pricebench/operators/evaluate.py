"""Scores of models, from long predictions (model, id, title, truth, guess)."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricebench.functions.order import exact_median
from pricebench.operators.split import first_rows
from pricebench.session import write_through

SLICE_ROWS = 250
TITLE_CHARS = 40
WORST = 5
# Dollars and share of the price within which a guess is green or amber.
GREEN = (40, 0.2)
AMBER = (80, 0.4)
# Colours of the chart's points.
COLOURS = {"green": "#1b7f5c", "amber": "#c98500", "red": "#b3261e"}



def absolute_error() -> Column:
    return F.abs(F.col("guess") - F.col("truth"))


def squared_log_error() -> Column:
    return F.pow(F.log1p(F.greatest("guess", F.lit(0.0))) - F.log1p("truth"), F.lit(2.0))


def band() -> Column:
    """green, amber or red. A true price of 0 has no ratio and is judged by dollars alone."""
    error = absolute_error()
    share = F.try_divide(error, F.col("truth"))
    return (
        F.when((error < GREEN[0]) | (share < GREEN[1]), "green")
        .when((error < AMBER[0]) | (share < AMBER[1]), "amber")
        .otherwise("red")
    )


def prediction_errors(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("error", absolute_error()).withColumn("squared_log_error", squared_log_error())


def error_bands(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("band", band())


def metrics(predictions: DataFrame) -> DataFrame:
    """One row per model: n, average and median error, RMSLE, R² and hit rate.

    R² is 1 - residual / total sum of squares, which may be negative; ``regr_r2`` is the
    squared correlation and never is.
    """
    residual = F.sum(F.pow(F.col("truth") - F.col("guess"), F.lit(2.0)))
    total = F.var_pop("truth") * F.count(F.lit(1))
    sums = predictions.groupBy("model").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(absolute_error()).alias("avg_error"),
        F.sqrt(F.avg(squared_log_error())).alias("rmsle"),
        F.when(total != 0, F.lit(1.0) - residual / total)
        .otherwise(F.when(residual == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
        .alias("r2"),
        F.avg((band() == "green").cast("double")).alias("hit_rate"),
    )
    medians = exact_median(predictions, absolute_error(), ["model"], "median_error")
    return sums.join(medians, "model", "left").select(
        "model", "n", "avg_error", "median_error", "rmsle", "r2", "hit_rate"
    )


def worst_misses(predictions: DataFrame, n: int = WORST) -> DataFrame:
    """The n largest errors of each model, ties in input order."""
    ranked = predictions.withColumn("error", absolute_error())
    place = F.row_number().over(Window.partitionBy("model").orderBy(F.desc("error"), "id"))
    return ranked.withColumn("place", place).filter(F.col("place") <= n)


def band_counts(predictions: DataFrame) -> DataFrame:
    counts = [F.count_if(F.col("band") == name).alias(name) for name in ("green", "amber", "red")]
    return error_bands(predictions).groupBy("model").agg(*counts, F.count(F.lit(1)).alias("total"))


def leaderboard(predictions: DataFrame, decimals: int = 6) -> DataFrame:
    """Metrics of all models, best average error first."""
    rounded = [F.round(c, decimals).alias(c) for c in ("avg_error", "median_error", "rmsle", "r2", "hit_rate")]
    return metrics(predictions).select("model", "n", *rounded).orderBy("avg_error", "model")


def display(board: DataFrame) -> DataFrame:
    """Metrics as shown to people: dollars to cents, scores to three decimals, hits in percent.

    Java rounds some values whose shortest form ends in a 5, such as 0.0005, to the even
    neighbour where Python looks at the stored binary value.
    """
    text = lambda name, decimals: F.format_number(name, decimals).alias(name)
    hits = F.concat(F.format_number(F.col("hit_rate") * 100, 1), F.lit("%")).alias("hit_rate")
    return board.select(
        "model", "n", text("avg_error", 2), text("median_error", 2), text("rmsle", 3), text("r2", 3), hits
    )


def evaluation_slice(test: DataFrame, size: int = SLICE_ROWS) -> DataFrame:
    """The first test rows, the same for every model, with titles cut for display."""
    return first_rows(test, size).withColumn("title", F.substring("title", 1, TITLE_CHARS))


def as_predictions(scored: DataFrame, model: str) -> DataFrame:
    """Scored items in long form; guesses below zero count as zero."""
    return scored.select(
        F.lit(model).alias("model"),
        "id",
        F.substring("title", 1, TITLE_CHARS).alias("title"),
        F.col("price").alias("truth"),
        F.greatest(F.col("guess").cast("double"), F.lit(0.0)).alias("guess"),
    )


def scatter_points(predictions: DataFrame) -> DataFrame:
    """Predicted against actual: points with their colour, and the end of each model's y = x line."""
    tops = predictions.groupBy("model").agg(F.max(F.greatest("truth", "guess")).alias("top"))
    colours = F.create_map(*[F.lit(x) for pair in COLOURS.items() for x in pair])
    points = error_bands(predictions).withColumn("colour", F.element_at(colours, F.col("band")))
    # Written, the tops have a size that Spark sees: a few models are broadcast, more are shuffled.
    return points.join(write_through(tops, "tops"), "model")


def validation_mae(scored: DataFrame, size: int | None = None) -> DataFrame:
    """Mean absolute dollar error over the validation rows, or the first ``size`` of them."""
    part = scored if size is None else first_rows(scored, size)
    return part.agg(F.avg(F.abs(F.col("guess") - F.col("price"))).alias("mae"))
