"""Personal data written in ways that no strict pattern takes, planted into given documents."""

import random

import pytest
from pyspark.sql import functions as F

from pricebench.llm import pii

SF_DIR = "/root/testdata/sf0.01"


def luhn_number(draw, length=16):
    body = [draw.randrange(10) for _ in range(length - 1)]
    total = sum(d if i % 2 else (2 * d - 9 if 2 * d > 9 else 2 * d) for i, d in enumerate(reversed(body)))
    return "".join(map(str, body)) + str(-total % 10)


def planted(draw):
    """(form, text) of spans that should be found."""
    name, host = f"{draw.choice(['ana', 'jo.berg', 'm-lee'])}{draw.randrange(99)}", draw.choice(["mail", "corp-x", "uni"])
    card = luhn_number(draw)
    groups = [card[i : i + 4] for i in range(0, 16, 4)]
    a, b, c = draw.randrange(200, 999), draw.randrange(200, 999), draw.randrange(1000, 9999)
    return [
        ("email", f"{name} [at] {host} [dot] org"),
        ("email", f"{name}(at){host}.com"),
        ("email", f"{name} @ {host}.example.net"),
        ("card", ".".join(groups)),
        ("phone", f"({a}) {b}-{c}"),
        ("phone", f"{a}-{b}-{c}"),
    ]


@pytest.fixture(scope="module")
def found(spark):
    draw = random.Random(17)
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    rows, expected = [], []
    for i in range(60):
        for j, (kind, span) in enumerate(planted(draw)):
            before = draw.choice(["Please write to", "You can reach us at", "As noted before,", "The number was"])
            text = f"{before} {span} and we will answer within a week or so."
            rows.append((10_000_000 + 10 * i + j, text))
            expected.append((rows[-1][0], kind, text.index(span), text.index(span) + len(span)))
    docs = given.union(spark.createDataFrame(rows, "doc_id long, text string"))
    spans = pii.found_spans(docs).select("doc_id", pii.named("base").alias("base"), pii.named("spans").alias("spans"))
    return expected, {r["doc_id"]: r for r in spans.collect()}


@pytest.mark.parametrize("kind", ["email", "card", "phone"])
def test_distorted_spans_are_found(found, kind):
    expected, rows = found
    wanted = [e for e in expected if e[1] == kind]
    hits = [f"{k}:{a}:{b}" in rows[i]["spans"].split(",") for i, k, a, b in wanted]
    assert sum(hits) >= 0.9 * len(hits)


def test_given_documents_gain_little(found):
    """Documents without planted spans keep their base spans, and few others come on top."""
    _, rows = found
    given = [r for i, r in rows.items() if i < 10_000_000]
    assert all(set(filter(None, r["base"].split(","))) <= set(r["spans"].split(",")) for r in given)
    more = [len(r["spans"].split(",")) - len(r["base"].split(",")) for r in given]
    assert sum(m > 0 for m in more) <= 0.02 * len(given)


def test_copies_are_not_what_strict_patterns_take(spark):
    rows = [(1, 2, 0, 0, 15, "ann.lee@mail.org", 1.0), (1, 2, 2, 0, 19, "4111 1111 1111 1111", 1.0), (1, 2, 3, 0, 17, "+1 (555) 555-0100", 1.0), (1, 2, 1, 0, 7, "1.2.3.4", 1.0)]
    rows = [(k, h, kind, i, i + 9, match, label) for i in range(12) for k, h, kind, _, _, match, label in rows]
    df = spark.createDataFrame(rows, "k long, h long, kind int, start int, `end` int, match string, label double")
    made = pii._distorted(df).select("kind", "match", F.size(pii.base_spans(F.col("match"))).alias("n")).collect()
    emails = {r["match"] for r in made if r["kind"] == 0}
    assert len(emails) > 2 and all("@" not in m or " @ " in m for m in emails)
    assert {pii_digits(r["match"]) for r in made if r["kind"] == 2} == {"4111111111111111"}
    assert all("+" not in r["match"] and pii_digits(r["match"]) == "5555550100" for r in made if r["kind"] == 3)
    assert all(r["n"] == 0 for r in made if r["kind"] in (0, 1, 3))


def pii_digits(text):
    return "".join(c for c in text if c.isdigit())
