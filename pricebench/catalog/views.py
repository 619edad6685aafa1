"""Stand-ins for listings, predictions and replies, derived from the given tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricebench.operators.split import train_val_test_split

DAMPING = {"view": 0.5, "error": 0.05}
CATEGORIES = ("view", "click", "error")  # the folders that read_listings is asked for
EVENT_TYPES = ("view", "click", "purchase", "error", "signup")
WITHHELD = "click"
STOP_WORDS = ["the", "and", "of", "to", "in", "a", "is", "it", "un", "la", "de", "que", "der", "die", "el", "en"]
BOW_TERMS = 20_000
TFIDF_TERMS = 40_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _title() -> Column:
    """A column of its own: what the part with the document's number is called, and its brand."""
    return F.concat(F.col("p_name"), F.lit(" "), F.col("p_brand"))


def _cents(value: Column) -> Column:
    return value.cast("decimal(10,2)").cast("string")


def _described(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, events, part = (table(spark, sf_dir, name) for name in ("documents", "events", "part"))
    priced = documents.join(events, F.col("doc_id") == F.col("event_id"))
    return priced.join(part, F.col("doc_id") == F.col("p_partkey"), "left")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third document is summed up by the opening turn of a conversation, where there is one."""
    third = F.col("doc_id") % 3
    opening = table(spark, sf_dir, "conversations").filter("turn = 0").groupBy("conv_id").agg(F.min("text").alias("said"))
    return (
        _described(spark, sf_dir)
        .filter(F.col("value").between(0.5, 999.49))
        .join(opening.select((F.col("conv_id") * 3).alias("summed_id"), "said"), F.col("doc_id") == F.col("summed_id"), "left")
        .select(
            F.col("doc_id").alias("id"),
            F.col("event_type").alias("category"),
            F.coalesce(_title(), F.lit("untitled")).alias("title"),
            F.col("value").alias("price"),
            F.col("text").alias("full"),
            F.when(F.col("doc_id") % 4 != 0, (F.col("user_id") % 40).cast("double") / 8).alias("weight"),
            F.when(third == 0, F.col("said")).when(third == 1, "").alias("summary"),
        )
    )


def split_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items in their three parts, ids drawn anew; the given id stays as ``source_id``."""
    given = items(spark, sf_dir).withColumnRenamed("id", "source_id")
    return train_val_test_split(given, "source_id")


def part(spark: SparkSession, sf_dir: str, split: str) -> DataFrame:
    return split_items(spark, sf_dir).filter(F.col("split") == split)


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("doc_id")
    price = (
        F.when(key % 17 == 0, None)
        .when(key % 19 == 0, "")
        .when(key % 23 == 0, F.concat(F.lit("$"), _cents(F.col("value"))))
        .otherwise(_cents(F.col("value")))
    )
    units = ["Pounds", "ounces", "grams", "kilograms", "milligrams", "hundredths pounds"]
    unit = F.lit("stone")
    for i, name in enumerate(units):
        unit = F.when(F.col("p_partkey") % 8 == i, name).otherwise(unit)
    weight = F.when(F.col("p_partkey") % 8 == 7, "").otherwise(
        F.concat(F.lit(', "Item Weight": "'), F.col("p_size").cast("string"), F.lit(" "), unit, F.lit('"'))
    )
    details = F.when(key % 29 == 0, "{bad").otherwise(
        F.concat(
            F.lit('{"Part Number": "'), "p_brand", F.lit('", "Color": "'), "p_type", F.lit('"'), weight, F.lit("}")
        )
    )
    return (
        _described(spark, sf_dir)
        .filter(F.col("p_partkey").isNotNull())
        .select(
            key.alias("src_id"),
            F.col("event_type").alias("category"),
            _title().alias("title"),
            price.alias("price"),
            F.col("text").alias("description"),
            F.split("text", "\n").alias("features"),
            details.alias("details"),
        )
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three made-up models over all events: each event is exploded to three guesses."""
    k = F.col("k")
    turn = F.col("event_id") + k
    guess = (
        F.col("value") * (5 + turn % 11).cast("double") / F.lit(10.0)
        + F.when(turn % 13 == 0, F.lit(150.0)).when(turn % 13 == 1, F.lit(60.0)).otherwise(F.lit(0.0))
    )
    return (
        table(spark, sf_dir, "events")
        .select("event_id", "event_type", "value", F.explode(F.array(F.lit(0), F.lit(3), F.lit(7))).alias("k"))
        .select(
            F.concat(F.lit("m"), k.cast("string")).alias("model"),
            F.col("event_id").alias("id"),
            F.concat("event_type", F.lit(" "), F.col("event_id").cast("string")).alias("title"),
            F.col("value").alias("truth"),
            guess.alias("guess"),
        )
    )


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies by event, some of them blank, some followed by another one."""
    key = F.col("event_id")
    amount = _cents(F.col("value"))
    said = [F.concat(F.lit("$"), amount), "about $1,249.99 or so", "I cannot say", "-5", ".99", " 12 or 13 "]
    reply = amount
    for i, text in enumerate(said):
        reply = F.when(key % 7 == i, text).otherwise(reply)
    blank = F.when(key % 22 == 0, F.lit(" \n")).when(key % 22 == 11, F.lit(None)).otherwise(reply)
    again = F.when(key % 13 == 0, F.array(blank, F.lit("again 7"))).otherwise(F.array(blank))
    return table(spark, sf_dir, "events").select(
        key.alias("id"),
        F.posexplode(again).alias("replied_at", "reply"),
        (100 + key % 50).cast("bigint").alias("prompt_tokens"),
        (key % 12).cast("bigint").alias("completion_tokens"),
        F.when(key % 5 != 0, (key % 9).cast("double") / F.lit(10000.0)).alias("cost"),
    )
