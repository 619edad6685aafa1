"""Column functions against plain Python on edge cases and on the given documents."""

import json
import re

import pytest
from conftest import column
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricebench.functions import text as X
from pricebench.operators.parse import weight_in_pounds
from pricebench.schemas import NOISE_DETAILS


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"n int, x {kind}")
    return column(df.select("n", function(F.col("x")).alias("y")), "y")


def flat(value):
    text = re.sub(" +", " ", value.replace("\n", " ").replace("\r", "").replace("\t", ""))
    return text.strip()[:3000]


ODD = ["", " ", "a\tb\rc\nd", "\x1c a\xa0　", "  x   y  ", " z​", "é" * 3100, "\x00a\x00"]


def test_strip(spark):
    assert apply(spark, X.strip, ODD) == [x.strip() for x in ODD]


def test_flatten(spark, sf_dir):
    assert apply(spark, X.flatten, ODD) == [flat(x) for x in ODD]
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", X.flatten(F.col("text")).alias("y"))
    assert all(r["y"] == flat(r["text"]) for r in rows.collect())


@pytest.mark.parametrize(
    "text,result",
    [
        ("BLUETOOTH headset", "BLUETOOTH headset"),
        ("BLUETOOTH headset 5", " headset 5"),
        ("1234567 Case", " Case"),
        ("1234567 case", "1234567 case"),
        ("WH1000XM4 x", " x"),
        ("éABCDEF1 z", "éABCDEF1 z"),
        ("ABCDEF1é z", "ABCDEF1é z"),
        ("ABC_1234567 A", "ABC_1234567 A"),
        ("BLUETOOTH a\n5", "BLUETOOTH a\n5"),
        ("BLUETOOTH a\r 5", " a\r 5"),
        ("BLUETOOTH a  5", " a  5"),
        ("ABCDEF1 ABCDEF2", " "),
    ],
)
def test_part_numbers(spark, text, result):
    assert apply(spark, X.strip_part_numbers, [text]) == [result]


def test_python_float(spark):
    given_texts = ["0.5", "999.49", " 5 ", "1e2", "$5", "", "5d", "5f", "1_0", "1__0", "_1", "1_", "+.5", "5.", ".", "inf", "-Infinity", "1e", "0x10", "٣x"]

    def expected(x):
        try:
            return float(x)
        except ValueError:
            return None

    assert apply(spark, X.python_float, given_texts) == [expected(x) for x in given_texts]
    assert apply(spark, X.python_float, [None]) == [None]


def test_to_price(spark):
    replies = ["$1,249.99", "-5", "-5.5", ".99", "no", "1.2.3", "12 or 13", "", "  $3", None]
    assert apply(spark, X.to_price, replies) == [1249.99, 5.0, -5.5, 0.99, 0.0, 1.2, 12.0, 0.0, 3.0, 0.0]


def test_weights(spark):
    texts = ["5 pounds", "8 Ounces", "453.592 grams", "50 hundredths pounds", "50 hundredths", "3 stone", "heavy", "5", "5  pounds", None, "2 Kilograms", ""]
    found = apply(spark, weight_in_pounds, texts)
    assert found == pytest.approx([5, 0.5, 1, 0.5, 0, 0, 0, 0, 0, 0, 2 / 0.453592, 0])


LISTS = [
    [],
    ["plain", "two words"],
    ["it's", 'say "x"', "it's \"both\"", "back\\slash", "new\nline\tand\rreturn"],
    ["é ü ß 漢字 😀 €", "nbsp\xa0here", "zero​width", "\x07bell", "퟿"],
    ["", None, "x"],
]


def test_list_text(spark):
    assert apply(spark, X.list_text, LISTS, "array<string>") == [str(x) for x in LISTS]
    assert apply(spark, X.list_text, [None], "array<string>") == [None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.text(st.characters(exclude_categories=["Cs"])), max_size=4), min_size=50, max_size=80))
def test_list_text_any(spark, lists):
    assert apply(spark, X.list_text, lists, "array<string>") == [str(x) for x in lists]


DETAILS = [
    '{"Color": "Red", "Part Number": "X1"}',
    '{"Part Number": "X1"}',
    '{"Color":"Red"}',
    '{"a": 1, "b": 1.50, "c": [1, {"d": null}], "Item Weight": "3 pounds"}',
    '{"Color": "Rouge é"}',
    '{"quote": "a \\"b\\" \\u00e9"}',
    '{"a": "1", "a": "2"}',
    "{bad",
    "[1, 2]",
    "null",
    "",
    "{}",
    None,
    '{"a": "b"} trailing',
    "{'a': 'b'}",
]


def test_details(spark):
    df = spark.createDataFrame(list(enumerate(DETAILS)), "n int, details string")
    rows = X.with_details(df).orderBy("n").collect()
    for row, text in zip(rows, DETAILS):
        try:
            value = json.loads(text) if text is not None else {}
        except ValueError:
            value = {}
        value = value if isinstance(value, dict) else {}
        kept = {k: v for k, v in value.items() if k not in NOISE_DETAILS}
        assert row["details_text"] == (json.dumps(kept) if kept else None), text
        assert set(row["details_map"]) == set(value), text
