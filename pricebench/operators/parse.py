"""Raw listings to usable items: cheap rejects first, text work on what is left."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricebench.functions import text as X
from pricebench.schemas import MAX_BODY_CHARS, MAX_PRICE, MIN_CHARS, MIN_PRICE, RAW

# Pounds per unit.
POUNDS = {
    "pounds": 1.0,
    "ounces": 1 / 16,
    "grams": 1 / 453.592,
    "milligrams": 1 / 453592,
    "kilograms": 1 / 0.453592,
}


def parse_price(price: Column) -> Column:
    return X.python_float(price.cast("string"))


def in_price_range(price: Column, low: float = MIN_PRICE, high: float = MAX_PRICE) -> Column:
    return price.between(low, high)


def as_text(df: DataFrame, name: str) -> Column:
    """A field as text; null when it is empty and so left out of the body."""
    if isinstance(df.schema[name].dataType, T.ArrayType):
        return F.when(F.size(name) > 0, X.list_text(F.col(name)))
    return X.or_null(F.col(name))


def assemble_body(title: Column, description: Column, features: Column, details: Column) -> Column:
    """Parts joined by newlines; null parts are skipped."""
    return F.concat_ws("\n", title, description, features, details)


def finish_body(body: Column, limit: int = MAX_BODY_CHARS) -> Column:
    """Strip part numbers, trim, then cut; in this order, so a cut may end in a space."""
    return F.substring(X.strip(X.strip_part_numbers(body)), 1, limit)


def weight_in_pounds(weight: Column) -> Column:
    """'8 ounces' as 0.5; 0.0 for anything missing, malformed or in an unknown unit."""
    parts = F.split(weight, " ")
    amount = X.python_float(F.get(parts, F.lit(0)))
    unit = F.lower(F.get(parts, F.lit(1)))
    hundredths = (unit == "hundredths") & (F.lower(F.get(parts, F.lit(2))) == "pounds")
    factors = F.create_map(*[F.lit(x) for pair in POUNDS.items() for x in pair])
    pounds = F.when(hundredths, amount / 100).when(
        unit.isNotNull(), amount * F.coalesce(F.try_element_at(factors, unit), F.lit(0.0))
    )
    return F.coalesce(pounds, F.lit(0.0))


def _with_body(priced: DataFrame) -> DataFrame:
    """Body and weight of each listing; columns beyond the raw schema are carried along."""
    extra = [name for name in priced.columns if name not in RAW.fieldNames()]
    body = assemble_body(
        F.col("title"),
        X.flatten(as_text(priced, "description")),
        X.flatten(as_text(priced, "features")),
        F.col("details_text"),
    )
    made = F.struct(
        finish_body(body).alias("full"),
        weight_in_pounds(F.try_element_at("details_map", F.lit("Item Weight"))).alias("weight"),
    )
    # Unpacked from an array, the body is made once: a filter on its length cannot be pushed
    # below the generator, where it would make the body a second time.
    return X.with_details(priced).select(*extra, "title", "category", "price", F.inline(F.array(made)))


def _priced(raw: DataFrame) -> DataFrame:
    """Prices as doubles. A numeric column is left bare, so that its range reaches the scan."""
    if isinstance(raw.schema["price"].dataType, T.NumericType):
        return raw.withColumn("price", F.col("price").cast("double"))
    return raw.withColumn("price", parse_price(F.col("price")))


def _priceable() -> Column:
    return in_price_range(F.col("price")) & F.col("title").isNotNull()


def parse_listings(raw: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Usable items from raw listings. Rows without a fair price never reach the text work."""
    items = _with_body(_priced(raw).filter(_priceable()))
    return items.filter(F.length("full") >= min_chars)


def parse_yield(raw: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Listings and usable items per category, in one pass: a falling share is a parser alarm."""
    priced = _priced(raw).withColumn("_priceable", _priceable())
    # Rows without a fair price count as listings; their text is taken away before any work on it.
    texts = [name for name in RAW.fieldNames() if name in priced.columns and name not in ("category", "price")]
    bare = priced.withColumns({name: F.when(F.col("_priceable"), F.col(name)) for name in texts})
    usable = F.col("_priceable") & (F.length("full") >= min_chars)
    return (
        _with_body(bare)
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("listings"), F.count_if(usable).alias("usable"))
    )
