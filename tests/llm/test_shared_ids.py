"""Rows that share an id or have none, in every operator that orders or joins by it."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pricebench.llm import classifier, packing, pii, repeats, rules, simhash
from pricebench.llm.catalog import token_files
from pricebench.llm.tables import ranked_in
from cases import ESSAY, ODD_TEXTS, documents, sentence


def masks_of(texts):
    """For texts in order, a mark for each byte that a 100-byte string covers which also starts earlier."""
    first, out = {}, []
    for number, text in enumerate(texts):
        raw = text.encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            if first.setdefault(raw[i : i + 100], (number, i)) != (number, i):
                gone[i : i + 100] = b"\1" * 100
        out.append(bytes(gone))
    return out


def left_of(texts):
    return [bytes(b for b, g in zip(t.encode(), gone) if not g) for t, gone in zip(texts, masks_of(texts))]


def kept_texts(spark, rows, parts):
    docs = documents(spark, rows).repartition(parts)
    found = repeats.without_repeats(docs).select("row.doc_id", "row.text", "cut.kept").collect()
    return sorted((str(r["doc_id"]), r["text"] or "", bytes(r["kept"])) for r in found)


@pytest.mark.parametrize("shared", [7, 2**62 + 5, -(2**62), None])
def test_texts_of_one_id_that_occur_once_stay_whole(spark, shared):
    rows = [(shared, sentence(i, 12)) for i in range(1500)] + [(9, sentence(5000, 40)), (2**61, sentence(6000, 40))]
    assert kept_texts(spark, rows, 5) == sorted((str(k), t, t.encode()) for k, t in rows)


@pytest.mark.parametrize("group_limit", [2, 4096])
def test_repeats_between_texts_of_one_id(spark, monkeypatch, group_limit):
    """Texts of one id are in the order of their hashes; a repeated row is cut like the first."""
    monkeypatch.setattr(repeats, "HOT_GROUP", group_limit)
    passage = sentence(77, 30)
    texts = [f"{sentence(i, 15)} {passage[i % 5 :]} {sentence(i + 900, 5)}" for i in range(30)]
    ids = [2**62 if i % 3 else None if i % 2 else 2**62 - i for i in range(30)]
    rows = list(zip(ids, texts))
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", F.xxhash64("text").alias("h"))
    hashes = {r["i"]: r["h"] for r in frame.collect()}
    order = sorted(range(30), key=lambda i: (-(2**63) if ids[i] is None else ids[i], hashes[i]))
    left = dict(zip(order, left_of([texts[i] for i in order])))
    expected = [(str(ids[i]), texts[i], left[i]) for i in range(30)]
    again = rows + rows[:4]
    assert kept_texts(spark, rows, 4) == sorted(expected)
    assert kept_texts(spark, again, 4) == sorted(expected + expected[:4])


def test_sample_holds_its_bound(spark):
    docs = documents(spark, [(1, sentence(i)) for i in range(500)] + [(i, sentence(i)) for i in range(2, 12)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 12)] * 3, "doc_id long, quality int")
    for bound in (1, 4, 100):
        found = classifier.labelled_sample(docs, labels, bound).collect()
        assert len(found) == len({r["doc_id"] for r in found}) <= bound


@pytest.mark.parametrize("qualities", [[], [1], [0]])
def test_classifier_without_both_classes(spark, qualities):
    """Without labels every text scores a half; with one class that class is likelier."""
    docs = documents(spark, [(i, sentence(i)) for i in range(10)] + [(50, None)])
    labels = spark.createDataFrame([(i, q) for q in qualities for i in range(10)], "doc_id long, quality int")
    scores = [r["score"] for r in classifier.scored(docs, classifier.fit(docs, labels)).collect()]
    assert len(scores) == 11
    wanted = {(): lambda s: s == 0.5, (1,): lambda s: s > 0.5, (0,): lambda s: s < 0.5}[tuple(qualities)]
    assert all(map(wanted, scores))


def test_classifier_on_empty_tables(spark):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert classifier.scored(documents(spark, []), classifier.fit(documents(spark, []), labels)).collect() == []


def test_rows_without_an_id_are_ranked_by_many_tasks(spark):
    df = spark.range(6000).selectExpr("IF(id % 3 = 0, null, id) AS doc_id", "id AS size", "0 AS shard")
    ranked = ranked_in(df, "shard", F.col("doc_id"), "slot", 64).collect()
    assert sorted(r["slot"] for r in ranked) == list(range(6000))
    part = F.pmod(F.xxhash64("doc_id", "doc_id", "size", "shard"), F.lit(64))
    sizes = [r["count"] for r in df.groupBy(part).count().collect()]
    assert max(sizes) < 0.03 * 6000


def plain_leaders(rows, hashes):
    """Of each class of prints within 3 bits, the row that leads it."""
    prints = [simhash.fingerprint(t) for _, t in rows]  # itself held against a version bit by bit elsewhere
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if ((prints[i] ^ prints[j]) & (2**64 - 1)).bit_count() <= 3:
                root[find(i)] = find(j)
    leaders = {}
    for i, (k, _) in enumerate(rows):
        key = (k is None, k or 0, hashes[i])
        leaders[find(i)] = min(leaders.get(find(i), (key, i)), (key, i))
    return Counter((rows[i][0], rows[i][1]) for _, i in leaders.values())


def test_one_of_each_near_duplicate_stays(spark):
    rows = [*ODD_TEXTS, ODD_TEXTS[6]]
    rows += [(5, sentence(i, 60)) for i in range(10)] + [(60 + i, sentence(i, 60).upper()) for i in range(3)]
    rows += [(None, sentence(2, 60)), (None, sentence(400, 60)), (80, ESSAY + " ."), (81, ESSAY + " !")]
    docs = documents(spark, rows).repartition(5)
    columns = docs.columns
    hashed = {(r["doc_id"], r["text"]): r["h"] for r in docs.select("*", F.xxhash64(*columns).alias("h")).collect()}
    found = simhash.keep_one_of_each(docs)
    assert found.columns == columns
    assert Counter((r["doc_id"], r["text"]) for r in found.collect()) == plain_leaders(rows, [hashed[r] for r in rows])


def test_the_pipeline_is_its_stages_by_hand(spark, sf_dir):
    """run() against a chain in which the near duplicates, repeats, redaction and pieces are made in plain Python."""
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    verdicts = {r["doc_id"]: r["kept"] for r in rules.quality_verdicts(given).collect()}
    rows = [(r["doc_id"], r["text"]) for r in sorted(given.collect(), key=lambda r: r["doc_id"]) if verdicts[r["doc_id"]]]
    assert 0 < len(rows) < given.count()
    alone = Counter(plain_leaders(rows, [0] * len(rows)))
    assert len(alone) < len(rows)
    rows = [r for r in rows if alone[r]]
    cut = [(k, whole_characters(t, gone)) for (k, t), gone in zip(rows, masks_of([t for _, t in rows]))]
    cut = [(k, t) for k, t in cut if t]
    docs = documents(spark, cut)
    spans = {r["doc_id"]: r["spans"] for r in pii.found_spans(docs).select("doc_id", pii.named("spans").alias("spans")).collect()}
    texts = {k: redact(t, spans[k]) for k, t in cut}
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_files()[0])
    expected = {k: [*tokenizer.encode(t, add_special_tokens=False).ids, packing.END_ID] for k, t in texts.items()}
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    ids, sequences = {}, {}
    for r in sorted(packed, key=lambda r: (r["doc_id"], r["piece"])):
        ids.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert ids == expected
    for parts in sequences.values():
        ends = [a + n for a, n in sorted(parts)]
        assert [a for a, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048


def whole_characters(text, gone):
    """The characters of which some byte stays."""
    out, at = [], 0
    for c in text:
        size = len(c.encode())
        if not all(gone[at : at + size]):
            out.append(c)
        at += size
    return "".join(out)


def redact(text, spans):
    """Spans as kind:start:end, from left to right; what overlaps an earlier one goes with it."""
    found = [s.split(":") for s in spans.split(",") if s]
    out, at = [], 0
    for start, end, kind in sorted((int(a), int(b), pii.KINDS.index(k)) for k, a, b in found):
        if start >= at:
            out.append(text[at:start] + f"[{pii.KINDS[kind].upper()}]")
        at = max(at, end)
    return "".join(out) + text[at:]
