"""Table schemas and fixed values shared by the jobs."""

from pyspark.sql import types as T

RAW = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("description", T.ArrayType(T.StringType())),
        T.StructField("features", T.ArrayType(T.StringType())),
        T.StructField("details", T.StringType()),
        T.StructField("category", T.StringType()),
    ]
)

ITEM = T.StructType(
    [
        T.StructField("title", T.StringType(), False),
        T.StructField("category", T.StringType(), False),
        T.StructField("price", T.DoubleType(), False),
        T.StructField("full", T.StringType()),
        T.StructField("weight", T.DoubleType()),
        T.StructField("summary", T.StringType()),
        T.StructField("prompt", T.StringType()),
        T.StructField("id", T.LongType()),
    ]
)

PREDICTION = T.StructType(
    [
        T.StructField("model", T.StringType(), False),
        T.StructField("id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("truth", T.DoubleType()),
        T.StructField("guess", T.DoubleType()),
    ]
)

REPLY = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("reply", T.StringType()),
        T.StructField("prompt_tokens", T.LongType()),
        T.StructField("completion_tokens", T.LongType()),
        T.StructField("cost", T.DoubleType()),
    ]
)

SPLITS = ("train", "validation", "test")

# Results only match when these stay as they are.
CATEGORIES = (
    "Automotive",
    "Electronics",
    "Office_Products",
    "Tools_and_Home_Improvement",
    "Cell_Phones_and_Accessories",
    "Toys_and_Games",
    "Appliances",
    "Musical_Instruments",
)
CATEGORY_DAMPING = {"Tools_and_Home_Improvement": 0.5, "Automotive": 0.05}
NOISE_DETAILS = (
    "Part Number",
    "Best Sellers Rank",
    "Batteries Included?",
    "Batteries Required?",
    "Item model number",
)
MIN_PRICE = 0.5
MAX_PRICE = 999.49
MIN_CHARS = 600
MAX_FIELD_CHARS = 3000
MAX_BODY_CHARS = 4000
SEED = 42
