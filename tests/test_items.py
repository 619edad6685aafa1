"""Item text, prompts, request and reply tables, splits on disk."""

import json

import pytest
from pricebench.operators import items as I
from pricebench.operators import requests as R
from pricebench.plans.summarise import merge_summaries, pending_requests
from pricebench.sources.splits import read_split_files, read_splits, write_splits

ITEMS = "id bigint, title string, category string, price double, full string, weight double, summary string, split string"
ROWS = [
    (0, "Case", "a", 2.5, "long text", 1.0, "short", "train"),
    (1, "Lamp", "a", 3.5, "lamp text", None, "", "train"),
    (2, "Desk", "b", 0.5, "", 0.0, None, "validation"),
    (3, "Seat", "b", 999.49, None, 2.0, None, "test"),
]


@pytest.fixture()
def items(spark):
    return spark.createDataFrame(ROWS, ITEMS)


def test_text_and_prompts(items):
    rows = I.with_prompts(items.withColumn("text", I.item_text())).orderBy("id").collect()
    assert [r["text"] for r in rows] == ["short", "lamp text", "Desk", "Seat"]
    assert [r["prompt"].rsplit("$", 1)[1] for r in rows] == ["2.00", "4.00", "0.00", "999.00"]
    asked = items.orderBy("id").select(I.inference_prompt().alias("p")).first()["p"]
    assert asked == "What does this cost to the nearest dollar?\n\nshort\n\nPrice is $"


def test_texts_as_items(spark):
    texts = spark.createDataFrame([(7, "y" * 100)], "key int, text string")
    row = I.text_to_items(texts).first()
    assert (row["key"], row["title"], row["category"], row["price"], row["full"]) == (7, "y" * 60, "unknown", 0.0, "y" * 100)


def test_requests(spark, items):
    asked = {r["id"]: r["messages"] for r in R.summary_requests(items).collect()}
    assert {k: v[1]["content"] for k, v in asked.items()} == {1: "lamp text", 2: "Desk", 3: "Seat"}
    assert asked[1][0]["role"] == "system" and asked[1][0]["content"] == R.SUMMARY_SYSTEM
    held = spark.createDataFrame([(2,)], "id bigint")
    assert {r["id"] for r in R.summary_requests(items, held).collect()} == {1, 3}
    assert {r["id"] for r in R.summary_requests(items, limit=1).collect()} == {2, 3}


def test_apply_summaries_and_usage(spark, items):
    replies = spark.createDataFrame(
        [(0, "new", 5, 1, 0.5), (1, " \xa0given\n", 7, 2, None), (3, "", 1, 1, 0.25)],
        "id bigint, reply string, prompt_tokens bigint, completion_tokens bigint, cost double",
    )
    rows = {r["id"]: r["summary"] for r in R.apply_summaries(items, replies).collect()}
    assert rows == {0: "short", 1: "given", 2: None, 3: ""}
    assert tuple(R.summary_usage(replies).first()) == (13, 4, 0.75)


def test_the_newest_reply_counts(spark, items):
    schema = "id bigint, reply string, replied_at int"
    given = [(1, "first", 1), (1, "second", 3), (1, "late", 2), (1, " ", 9), (1, None, 10), (2, "b", 1), (2, "c", 1), (3, " ", 1), (0, None, 1)]
    replies = spark.createDataFrame(given, schema).repartition(4)
    assert {r["id"]: r["reply"] for r in R.one_reply_each(replies).collect()} == {1: "second", 2: "c", 3: ""}
    assert {r["id"]: r["reply"] for r in R.one_reply_each(replies.drop("replied_at")).collect()} == {1: "first", 2: "b", 3: ""}
    asked = {r["id"] for r in R.summary_requests(items, replies).collect()}
    assert asked == {3}  # only blank replies: asked again
    numbers = spark.createDataFrame([(1, 2.0, 5), (1, 3.0, 6), (2, None, 1)], "id bigint, reply double, replied_at int")
    assert {r["id"]: r["reply"] for r in R.one_reply_each(numbers).collect()} == {1: 3.0}
    assert {r["id"]: r["guess"] for r in R.price_replies(items, replies).collect()} == {0: 0.0, 1: 0.0, 2: 0.0, 3: 0.0}


def test_zero_shot(spark, items):
    row = R.zero_shot_requests(items).orderBy("id").first()
    assert row["messages"][1]["content"] == "How much does this cost, to the nearest dollar?\n\nshort"
    assert (row["temperature"], row["max_tokens"]) == (0.0, 12)
    replies = spark.createDataFrame([(0, "$1,249.99"), (1, "-5.5"), (2, None)], "id bigint, reply string")
    found = {r["id"]: r["guess"] for r in R.price_replies(items, replies).collect()}
    assert found == {0: 1249.99, 1: 0.0, 2: 0.0, 3: 0.0}
    numbers = spark.createDataFrame([(0, 1e-5), (1, -3.0)], "id bigint, reply double")
    found = {r["id"]: r["guess"] for r in R.price_replies(items, numbers).collect()}
    assert found == {0: 1e-5, 1: 0.0, 2: 0.0, 3: 0.0}


def test_splits_round_trip(spark, items, tmp_path):
    path = f"{tmp_path}/curated"
    write_splits(items, path)
    back = read_splits(spark, path)
    assert sorted(map(str, back.select(*items.columns).collect())) == sorted(map(str, items.collect()))
    lines = [json.loads(r["value"]) for r in spark.read.text(f"{path}/split=test").collect()]
    assert lines == [
        {"title": "Seat", "category": "b", "price": 999.49, "full": None, "weight": 2.0, "summary": None, "prompt": None, "id": 3}
    ]
    replies = spark.createDataFrame([(2, "desk summary"), (3, "seat summary")], "id bigint, reply string")
    assert {r["id"] for r in pending_requests(spark, path, replies).collect()} == {1}
    merge_summaries(spark, path, replies, f"{tmp_path}/merged")
    merged = {r["id"]: r["summary"] for r in read_splits(spark, f"{tmp_path}/merged").collect()}
    assert merged == {0: "short", 1: "", 2: "desk summary", 3: "seat summary"}


def test_split_files(spark, tmp_path):
    for name in ("train", "validation", "test"):
        (tmp_path / f"{name}.jsonl").write_text(
            json.dumps({"title": name, "category": "c", "price": 1.5, "full": None, "id": 1}) + "\n\n"
        )
    rows = read_split_files(spark, str(tmp_path)).collect()
    assert {(r["title"], r["split"], r["price"]) for r in rows} == {(n, n, 1.5) for n in ("train", "validation", "test")}
