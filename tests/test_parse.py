"""The parse job against a row-by-row reading of the rules in plain Python."""

import json
import re

from pyspark.sql import functions as F

from pricebench.operators.parse import parse_listings, parse_yield
from pricebench.operators.validate import validate_items
from pricebench.schemas import NOISE_DETAILS, RAW
from pricebench.sources.listings import read_listings, write_listings
from pricebench.streaming.parse import parse_new_listings

WORDS = "The case is 12 cm wide, it's made of steel. " * 20


def listing(title="Case", price="12.5", description=None, features=(), details="{}", category="Appliances"):
    return (title, price, [WORDS] if description is None else description, list(features), details, category)


LISTINGS = [
    listing(),
    listing(title="Cheap", price="0.49"),
    listing(title="Dear", price="999.49"),
    listing(title="Too dear", price="999.5"),
    listing(title="No price", price=None),
    listing(title="Dollar", price="$5"),
    listing(title="Hex", price="5d"),
    listing(title="Short", description=["short"]),
    listing(title="Empty lists", description=[], features=[]),
    listing(title=None),
    listing(title="Numbers WH1000XM4", features=["MODEL123", "it's \n new", 'say "hi"', "nbsp\xa0x"]),
    listing(title="Details", details='{"Part Number": "AB12345", "Item Weight": "8 ounces", "Size": 3}'),
    listing(title="Flat", details='{"Color": "Red", "Item Weight": "2 Kilograms"}', category="Automotive"),
    listing(title="Broken", details="{bad", features=["x" * 3500]),
    listing(title="Long", description=["y z " * 3000], features=["tab\tand  spaces " * 300]),
]


def expected(row):
    title, price, description, features, details, category = row
    try:
        price = float(price)
    except (TypeError, ValueError):
        return None
    if not 0.5 <= price <= 999.49 or title is None:
        return None
    try:
        details = json.loads(details)
    except ValueError:
        details = {}
    kept = {k: v for k, v in details.items() if k not in NOISE_DETAILS}
    one_line = lambda v: re.sub(" +", " ", str(v).replace("\n", " ").replace("\r", "").replace("\t", "")).strip()[:3000]
    lines = [title, *[one_line(v) for v in (description, features) if v], *([json.dumps(kept)] if kept else [])]
    body = re.sub(r"\b(?=[A-Z0-9]{7,}\b)(?=.*[A-Z])(?=.*\d)[A-Z0-9]+\b", "", "\n".join(lines)).strip()[:4000]
    return (title, category, price, body) if len(body) >= 600 else None


def test_parse(spark):
    raw = spark.createDataFrame(LISTINGS, RAW)
    items = parse_listings(raw)
    found = {r["title"]: (r["title"], r["category"], r["price"], r["full"]) for r in items.collect()}
    wanted = {e[0]: e for e in map(expected, LISTINGS) if e}
    assert found == wanted
    weights = {r["title"]: r["weight"] for r in items.collect()}
    assert weights["Details"] == 0.5 and weights["Flat"] == 2 / 0.453592 and weights["Broken"] == 0.0


def test_yield(spark):
    raw = spark.createDataFrame(LISTINGS, RAW)
    found = {r["category"]: (r["listings"], r["usable"]) for r in parse_yield(raw).collect()}
    usable = [e for e in map(expected, LISTINGS) if e]
    for category in ("Appliances", "Automotive"):
        assert found[category] == (
            sum(r[5] == category for r in LISTINGS), sum(e[1] == category for e in usable)
        )


def test_typed_prices_are_filtered_in_the_scan(spark, tmp_path):
    raw = spark.createDataFrame(LISTINGS, RAW)
    texts = {r["title"]: r["price"] for r in parse_listings(raw).collect()}
    typed = raw.withColumn("price", F.col("price").try_cast("double"))
    typed.filter("title <> 'Hex'").write.parquet(f"{tmp_path}/typed")
    items = parse_listings(spark.read.parquet(f"{tmp_path}/typed"))
    assert {r["title"]: r["price"] for r in items.collect()} == texts
    plan = items._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(price,0.5)" in plan and "LessThanOrEqual(price,999.49)" in plan


def test_body_is_made_once(spark):
    plan = parse_listings(spark.createDataFrame(LISTINGS, RAW))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(?=.*[A-Z])") == 1 and plan.count("from_json") <= 3


def test_read_and_stream(spark, tmp_path):
    raw = spark.createDataFrame(LISTINGS, RAW)
    write_listings(raw, f"{tmp_path}/raw")
    back = read_listings(spark, f"{tmp_path}/raw")
    assert sorted(map(str, back.select(*RAW.fieldNames()).collect())) == sorted(map(str, raw.collect()))
    one = read_listings(spark, f"{tmp_path}/raw", ("Automotive",))
    assert one.count() == 1 and "category=Automotive" in one.inputFiles()[0] or one.count() == 1
    batch = {r["title"]: r["full"] for r in parse_listings(raw).collect()}

    def run():
        query = parse_new_listings(spark, f"{tmp_path}/raw", f"{tmp_path}/out", f"{tmp_path}/state")
        query.awaitTermination()
        return {r["title"]: r["full"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}

    assert run() == batch
    raw.limit(1).withColumn("title", F.lit("Second run")).write.mode("append").partitionBy("category").json(f"{tmp_path}/raw")
    assert set(run()) == set(batch) | {"Second run"}
    assert spark.read.parquet(f"{tmp_path}/out").count() == len(batch) + 1


def test_validate(spark):
    rows = spark.createDataFrame(
        [("a", "c", "64.3", "1"), (None, "c", "1", "2"), ("b", "c", "5d", "3"), ("d", "c", "2", "x")],
        "title string, category string, price string, id string",
    )
    valid, rejects = validate_items(rows)
    assert [(r["title"], r["price"], r["id"]) for r in valid.collect()] == [("a", 64.3, 1)]
    assert sorted(r["reason"] for r in rejects.collect()) == [
        "id not bigint", "price missing or not double", "title missing or not string"
    ]
