"""Raw listings to curated splits."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebench.functions.order import seeded_hash
from pricebench.operators.dedup import content_key, digest, surviving
from pricebench.operators.parse import parse_listings
from pricebench.operators.sample import sample_keys
from pricebench.operators.split import MAX_TEST, MAX_VALIDATION, train_val_test_split
from pricebench.schemas import CATEGORY_DAMPING, SEED
from pricebench.session import write_through

SAMPLE_SIZE = 400_000


def curate(
    raw: DataFrame,
    size: int = SAMPLE_SIZE,
    key: str | None = None,
    damping: dict[str, float] = CATEGORY_DAMPING,
    validation: int = MAX_VALIDATION,
    test: int = MAX_TEST,
    seed: int = SEED,
) -> DataFrame:
    """Parse, drop repeats, draw the weighted sample, split; items with ``id`` and ``split``.

    Dedup, sampling and ids run on hashes, digests and prices only. With ``key``, a unique
    listing column, the listings are read a second time for the chosen keys and nothing else
    is parsed again, so no wide table is written. Without one the parsed text is written
    next to those columns under a key of its own, and the order is drawn from the content.
    The chosen keys are written, so that Spark picks the last join from their size.
    """
    parsed = parse_listings(raw)
    content = F.col(key) if key else content_key(["title", "full"], ["category", "price", "weight"])
    narrow = {
        "_order": seeded_hash(f"{seed}:dedup", content),
        "_draw_hash": seeded_hash(f"{seed}:sample", content),
        "_split_hash": seeded_hash(f"{seed}:split", content),
        "_title": digest("title"),
        "_body": digest("full"),
    }
    # A made-up key is fixed once it is written; the draws do not depend on it.
    given = F.col(key) if key else F.monotonically_increasing_id()
    table = parsed.withColumns({"_key": given, **narrow})
    if not key:
        table = write_through(table, "parsed")
    kept = surviving(table.select("_key", *narrow, "category", "price")).drop("_order", "_body")
    kept = write_through(kept, "survivors")
    # From here on titles are unique, so their digests order rows that share a hash.
    chosen = sample_keys(kept, size, "_title", damping, seed, F.col("_draw_hash"))
    chosen = write_through(chosen.select("_key", "_split_hash", "_title"), "sample")
    placed = train_val_test_split(chosen, "_title", validation, test, seed, hashed=F.col("_split_hash"))
    placed = write_through(placed.select(F.col("_key").alias(key or "_key"), "id", "split"), "placed")
    if key:
        return parse_listings(raw.join(placed, key))
    return table.select(*parsed.columns, "_key").join(placed, "_key").drop("_key")
