"""Language-model work as tables: requests out, replies in.

The calls themselves happen elsewhere; batch services take and return rows by id.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricebench.functions.text import or_null, strip, to_price
from pricebench.operators.items import item_text
from pricebench.session import write_through

# The prompts that replies depend on.
SUMMARY_SYSTEM = """Create a concise description of a product. Respond only in this format. Do not include part numbers.
Title: Rewritten short precise title
Category: eg Electronics
Brand: Brand name
Description: 1 sentence description
Details: 1 sentence on features"""
PRICE_SYSTEM = (
    "You estimate what a product sells for online in US dollars. "
    "Reply with a number only, no currency symbol and no explanation."
)
PRICE_QUESTION = "How much does this cost, to the nearest dollar?"
PRICE_TEMPERATURE = 0.0
PRICE_MAX_TOKENS = 12
ORDER = "replied_at"


def _messages(system: str, user: Column) -> Column:
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(message("system", F.lit(system)), message("user", user))


def one_reply_each(replies: DataFrame, order: str = ORDER) -> DataFrame:
    """At most one reply per id, (id, reply): retries give several.

    The newest by the column ``order`` stays, of equal ones the largest; without such a column the least
    one does. Blank replies do not count, but an id with no others has the empty reply; null ones never
    count. The choice is an aggregate, so repeats are dropped before anything is shuffled.
    """
    reply = F.col("reply")
    numeric = isinstance(replies.schema["reply"].dataType, T.NumericType)
    said = reply if numeric else F.when(strip(reply) != "", reply)
    newest = F.min(said)
    if order in replies.columns:
        newest = F.max_by(said, F.when(said.isNotNull(), F.struct(order, "reply")))
    if not numeric:
        newest = F.coalesce(newest, F.min(F.when(reply.isNotNull(), F.lit(""))))
    return replies.groupBy("id").agg(newest.alias("reply")).filter(F.col("reply").isNotNull())


def answered(replies: DataFrame) -> DataFrame:
    """The ids that need no further request: those with a reply that says something.

    A table without replies lists such ids.
    """
    if "reply" not in replies.columns:
        return replies.select("id").distinct()
    held = one_reply_each(replies)
    blank = F.lit(False) if isinstance(held.schema["reply"].dataType, T.NumericType) else F.col("reply") == ""
    return held.filter(~blank).select("id")


def _first_of_splits(items: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` rows of every split, whose starts come from one pass.

    The starts are written: Spark sees how few they are and sends them to the tasks, so that the items of a
    split, which may be nearly all, are not dealt out by it.
    """
    starts = write_through(items.groupBy("split").agg(F.min("id").alias("_start")), "starts")
    return items.join(starts, "split").filter(F.col("id") < F.col("_start") + limit).drop("_start")


def summary_requests(items: DataFrame, replies: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """One request per item that has neither a summary nor a reply with text already held.

    An item whose replies are all blank is asked again. With ``limit`` only the first rows of
    each split are considered.
    """
    if limit is not None:
        items = _first_of_splits(items, limit)
    pending = items.filter(F.coalesce("summary", F.lit("")) == "")
    if replies is not None:
        pending = pending.join(answered(replies), "id", "left_anti")
    user = F.coalesce(or_null(F.col("full")), F.col("title"))
    return pending.select("id", _messages(SUMMARY_SYSTEM, user).alias("messages"))


def apply_summaries(items: DataFrame, replies: DataFrame) -> DataFrame:
    """Fill empty summaries from stripped replies; a summary already there stays.

    An item whose replies are all blank gets the empty summary.
    """
    given = one_reply_each(replies).select("id", strip(F.col("reply")).alias("_reply"))
    filled = F.coalesce(or_null(F.col("summary")), F.col("_reply"), F.col("summary"))
    return items.join(given, "id", "left").withColumn("summary", filled).drop("_reply")


def summary_usage(replies: DataFrame) -> DataFrame:
    return replies.agg(
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"),
        F.sum(F.coalesce("cost", F.lit(0.0))).alias("cost"),
    )


def zero_shot_requests(items: DataFrame) -> DataFrame:
    """One pricing request per item, with its sampling settings."""
    user = F.concat(F.lit(f"{PRICE_QUESTION}\n\n"), item_text())
    return items.select(
        "id",
        _messages(PRICE_SYSTEM, user).alias("messages"),
        F.lit(PRICE_TEMPERATURE).alias("temperature"),
        F.lit(PRICE_MAX_TOKENS).alias("max_tokens"),
    )


def price_replies(items: DataFrame, replies: DataFrame) -> DataFrame:
    """Add ``guess`` read out of each reply; no reply counts as no number, 0.0.

    Replies may be text or already numbers; items stay single however many replies they have.
    """
    numeric = isinstance(replies.schema["reply"].dataType, T.NumericType)
    price = F.col("reply").cast("double") if numeric else to_price(F.col("reply"))
    given = one_reply_each(replies).select("id", F.greatest(price, F.lit(0.0)).alias("guess"))
    return items.join(given, "id", "left").withColumn("guess", F.coalesce("guess", F.lit(0.0)))
