"""Operators against brute force in plain Python, over the whole smallest tables and small made-up ones."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from pricebench.llm import html_text, minhash, packing, pii, repeats, rules, sharding, simhash
from pricebench.llm.catalog import QUERIES, token_files
from cases import ESSAY, PROSE, documents, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def collected(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir).collect()


def test_op1_equals_the_library(spark, sf_dir, texts):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = collected(spark, sf_dir, "op1_sentencepiece")
    assert {r["doc_id"]: list(r["ids"]) for r in rows} == {k: model.encode(t) for k, t in texts.items()}
    assert all(r["round_trip"] and r["n_ids"] == len(r["ids"]) for r in rows)


def test_op2_is_a_packing(spark, sf_dir, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_files()[0])
    by_doc, by_sequence, total = {}, {}, 0
    for r in collected(spark, sf_dir, "op2_packing"):
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(by_doc) == set(texts)
    for k, text in texts.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        total, at = total + len(ids), 0
        rows = sorted(by_doc[k], key=lambda r: r["piece"])
        for i, r in enumerate(rows):
            assert (r["piece"], r["start"]) == (i, at) and (i == 0 or r["length"] == 2048)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : at].tobytes())
        assert at == len(ids) and (len(ids) > 2048 or len(rows) == 1)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by_sequence) <= 1.01 * -(-total // 2048) + 1


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    draw = np.random.default_rng(seed)
    lengths = draw.choice(np.arange(1, 65), draw.integers(1, 60), replace=False)
    counts = {int(n): int(draw.integers(1, 40)) for n in lengths}
    made = packing.plan(counts, 64)
    fill, seen = Counter(), Counter()
    for length, first, last, sequence, offset in sorted(made.rows, key=lambda r: r[4]):
        for i in range(last - first):
            assert fill[sequence + i] == offset
            fill[sequence + i] += length
        assert seen[length] <= first or first < seen[length]
        seen[length] += last - first
    assert seen == Counter(counts) and max(fill.values()) <= 64
    large = [r for r in made.rows if r[0] > 64 / 3]
    assert max(Counter(s + i for _, a, b, s, _ in large for i in range(b - a)).values(), default=0) <= 2


def test_sequences_hold_the_ids(spark):
    docs = documents(spark, [(i, sentence(i, 300 + 40 * i)) for i in range(12)])
    packed = packing.packed_documents(docs, *token_files(), capacity=512)
    found = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        part = found[r["sequence_id"]][4 * r["offset"] : 4 * (r["offset"] + r["length"])]
        assert part == bytes(r["ids"])


def luhn(number):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(number))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def base_spans(text):
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        number = re.sub("[^0-9]", "", m[0])
        if 16 <= len(number) <= 19 and luhn(number):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


TRICKY = [
    "x@y x@y.z a@b@c.d .@-.- a@b.c_d@e.f %@a.b.c- é@ü.de",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.0255 1.2.3 1..2.3.4 9.9.9.9.",
    "4111111111111111 4111-1111-1111-1111 4111  1111 1111 1111 1 41111111111111111 4111 1111 1111 1111 12",
    "+1 (555) 555-0100 +1555 ++12345678 +1 () 2 +123456789012345678 +44 20 7946 0958.",
    "+1 (017) 555-7713 4111111111111111 e", "7" * 3000, "1 " * 3000, "1." * 3000, "a." * 3000 + "@" + "b." * 3000, "+" * 3000, "@" * 3000,
    "é" * 50 + " +1 (555) 555-0100 日本 a@b.co",
]


def test_op3_base_spans(spark):
    rng = np.random.default_rng(5)
    alphabet = list("0123456789.@+-() ab%é") + ["555", "1.2.3.4", "4111111111111111", "a@b.c"]
    made = ["".join(rng.choice(alphabet, 60)) for _ in range(300)]
    docs = documents(spark, list(enumerate(TRICKY + made)))
    rows = {r["doc_id"]: r for r in pii.found_spans(docs).selectExpr("doc_id", "base", "spans").collect()}
    for i, text in enumerate(TRICKY + made):
        assert [(pii.KINDS[k], a, b) for k, a, b in rows[i]["base"]] == base_spans(text), text
        assert set(rows[i]["base"]) <= set(rows[i]["spans"])


def test_op3_query(spark, sf_dir, texts):
    for r in collected(spark, sf_dir, "op3_pii"):
        expected = base_spans(texts[r["doc_id"]])
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in expected)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [
            sum(k == kind for k, _, _ in expected) for kind in pii.KINDS
        ]


def test_trees_add_what_a_strict_run_swallowed(spark):
    rows = []
    for i in range(240):
        name = sentence(i, 5)
        card = next(f"4{i:08d}{c:07d}" for c in range(1000) if luhn(f"4{i:08d}{c:07d}"))
        bad = next(f"5{i:08d}{c:07d}" for c in range(1000) if not luhn(f"5{i:08d}{c:07d}"))
        rows.append((i, f"{name} +1 ({i:03d}) 555-{i:04d} {name} {card} and {bad} or 10.0.0.{i} v 300.{i}.1.1 x{i}@mail.org"))
    rows.append((1000, f"{sentence(7, 5)} +1 (123) 555-7713 4111111111111111 {sentence(8, 5)}"))
    rows.append((1001, sentence(9, 40)))
    spans = {r["doc_id"]: r["spans"] for r in pii.found_spans(documents(spark, rows)).collect()}
    text = dict(rows)[1000]
    found = {(pii.KINDS[k], text[a:b]) for k, a, b in spans[1000]}
    assert ("phone", "+1 (123) 555-7713") in found
    assert spans[1001] == []


def test_a_flood_of_numbers_does_not_crowd_out_other_kinds(spark):
    rows = []
    for i in range(240):
        rows.append((i, f"{sentence(i, 5)} +1 ({i:03d}) 555-{i:04d} {sentence(i, 5)} and +{i:03d} 12 or 10.0.0.{i} v 300.{i}.1.1"))
    flood = [(2000 + i, " or ".join(f"{i * 977 + j * 1_000_003:09d}" for j in range(80))) for i in range(200)]
    rows.append((1000, f"{sentence(7, 5)} +1 (123) 555-7713 4111111111111111 {sentence(8, 5)}"))
    text = dict(rows)[1000]
    spans = {r["doc_id"]: r["spans"] for r in pii.found_spans(documents(spark, rows + flood), most=160).collect()}
    assert ("phone", "+1 (123) 555-7713") in {(pii.KINDS[k], text[a:b]) for k, a, b in spans[1000]}
    assert not any(spans[k] for k, _ in flood)


def test_op4_articles(spark, sf_dir):
    import html

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in collected(spark, sf_dir, "op4_html_text"):
        body = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        blocks = re.split(r"</?(?:p|h1|br)\s*>", body)
        expected = " ".join(" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks)
        assert r["text"] == " ".join(expected.split()) and r["n_chars"] == len(r["text"])


PAGE = """<html><head><title>No</title></head><body><header class="top"><h1>Site</h1><nav><a href="/">Home</a></nav></header>
<div id="cookieNotice">We use cookies on this site to make it better for you.</div>
<div class="wrap has-sidebar"><div class="content">{article}</div>
<aside><p>Read more of our stories every day.</p></aside><div class="sidebar-left"><p>Most read this week in town.</p></div></div>
<section id="comments"><p>I liked this story very much indeed, thank you for it.</p></section>
<form><p>Sign up for our letter.</p></form><script>if (1 < 2) {{ document.write("<p>x</p>") }}</script>
<div class="ad-box">Buy now</div><footer>All rights reserved</footer></body></html>"""


@pytest.mark.parametrize(
    "article,expected",
    [
        ("<h2>Title</h2><p>A first paragraph with <a href='#'>a link</a> in it, long enough.</p><p>No.</p><p>And one more to end it.",
         "Title A first paragraph with a link in it, long enough. No. And one more to end it."),
        ("<article><header><h1>Big &amp; small</h1></header><p>One<br>two&nbsp;three<ul><li>a<li>b</ul><div class='share'>Tweet</div></article>",
         "Big & small One two three a b"),
        ("<main><h1>T</h1><p>x <b>y</b>z</main>", "T x yz"),
        ("<p>Text  with\n\t white space</p><table><tr><td>1<td>2</table>", "Text with white space 1 2"),
    ],
)
def test_op4_leaves_the_rest_out(article, expected):
    assert html_text.main_text(PAGE.format(article=article)) == expected


LONG = [" ".join(f"{w}{i}" for w in ESSAY.split()) for i in range(3)]


@pytest.mark.parametrize(
    "article,expected",
    [
        (f"<div class='post'><p>{LONG[0]}</p><p>{LONG[1]}</p></div><div class='list'><article><a href='/b'>A teaser of a thing</a></article></div>", LONG[:2]),
        (f"<main><article><h2>One</h2><p>{LONG[0]}</p></article><article><h2>Two</h2><p>{LONG[1]}</p></article></main>", ["One", LONG[0], "Two", LONG[1]]),
        (f"<article><p>{LONG[2]}</p><article><p>{LONG[0]}</p></article><article><p>{LONG[1]}</p></article></article>", [LONG[2], *LONG[:2]]),
        (f"<div><div class='lead'><p>{LONG[0]}</p></div><div class='rest'><p>{LONG[1]}</p><p>{LONG[2]}</p></div></div>", LONG),
    ],
)
def test_op4_density_decides(article, expected):
    assert html_text.main_text(PAGE.format(article=article)) == " ".join(expected)


def removed(docs):
    """All bytes that strings of 100 bytes cover which also start earlier."""
    first, covered = {}, {}
    for k, raw in sorted(docs.items()):
        mask = bytearray(len(raw))
        for i in range(len(raw) - 99):
            if first.setdefault(raw[i : i + 100], (k, i)) != (k, i):
                mask[i : i + 100] = b"\1" * 100
        covered[k] = mask
    return covered


def check_repeats(docs, found):
    masks = removed(docs)
    for k, raw in docs.items():
        runs = [(m.start(), m.end()) for m in re.finditer(rb"\x01+", bytes(masks[k]))]
        assert [(s["start"], s["end"]) for s in found[k]["removed"]] == runs, k
        assert bytes(found[k]["kept"]) == bytes(b for b, m in zip(raw, masks[k]) if not m)


def test_op6_query(spark, sf_dir, texts):
    docs = {k: t.encode() for k, t in texts.items()}
    masks = removed(docs)
    for r in collected(spark, sf_dir, "op6_repeats"):
        mask, raw = masks[r["doc_id"]], docs[r["doc_id"]]
        kept = bytes(b for b, m in zip(raw, mask) if not m)
        spans = len(re.findall(rb"\x01+", bytes(mask)))
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(raw), sum(mask), spans)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("group_limit", [2, 4096])
def test_op6_passages_periods_and_hot_anchors(spark, monkeypatch, group_limit):
    """Shared passages with ends of their own; with a small limit every end goes string by string."""
    monkeypatch.setattr(repeats, "HOT_GROUP", group_limit)
    passage = sentence(99, 40)
    rows = {i: f"{sentence(i, 20)} {passage[i % 7 :]} {sentence(i + 500, 9)}" for i in range(40)}
    rows |= {50: "é" * 400, 51: "éà" * 300, 52: "ab" * 300, 53: "a" * 99, 54: "a" * 100, 55: "a" * 101, 56: "b" + "a" * 150}
    rows |= {60: passage, 61: passage[:100], 62: passage[5:104], 63: passage * 3, 64: "à" * 400, 65: ""}
    for parts in (1, 7):
        docs = documents(spark, list(rows.items())).repartition(parts)
        found = {r["doc_id"]: r for r in repeats.without_repeats(docs).select("row.doc_id", "cut.*").collect()}
        check_repeats({k: t.encode() for k, t in rows.items()}, found)
    for r in found.values():
        r["kept_text"].encode()


@pytest.mark.parametrize("seed", range(4))
def test_suffix_order_and_factors(seed):
    from pricebench.llm.suffixes import previous_factors, suffix_order

    draw = np.random.default_rng(seed)
    text = draw.integers(97, 99, 220, dtype=np.uint8)
    starts = np.arange(len(text) - 16)
    order, shared = suffix_order(text, starts, starts, 16)
    raw = text.tobytes()
    assert order.tolist() == sorted(range(len(starts)), key=lambda i: (raw[i : i + 16], i))
    factors = previous_factors(order, shared, starts)
    for i in starts:
        lengths = [next((n for n in range(16) if raw[i + n] != raw[j + n]), 16) for j in range(i)]
        assert factors[i] == max(lengths, default=0)


def test_op7(spark, sf_dir, texts):
    rows = collected(spark, sf_dir, "op7_sharding")
    assert {r["doc_id"] for r in rows} == set(texts) and {r["law"] for r in rows} == {"key"}
    slots = {}
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        assert r["grown_shard"] in (r["shard"], 8) and 0 <= r["shard"] < 8
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def one_jump(key, shards):
    """The published loop, for one key."""
    at, ahead = -1, 0
    while ahead < shards:
        at = ahead
        key = (key * 2862933555777941757 + 1) % 2**64
        ahead = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


def test_jump_is_even_and_moves_least():
    keys = np.random.default_rng(3).integers(0, 2**63, 20_000).astype(np.uint64)
    for shards in (1, 2, 8, 9, 100):
        found = sharding.jump(keys, shards)
        assert found[:500].tolist() == [one_jump(int(k), shards) for k in keys[:500]]
        assert np.bincount(found, minlength=shards).min() > 0.7 * len(keys) / shards
    before, after = sharding.jump(keys, 8), sharding.jump(keys, 9)
    assert set(after[before != after]) == {8} and abs((before != after).mean() - 1 / 9) < 0.02


def simple_print(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashed = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def classes_by_hand(prints):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= 3 and find(i) != find(j):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def test_op8_query(spark, sf_dir, texts):
    rows = collected(spark, sf_dir, "op8_simhash")
    prints = {k: simple_print(t) for k, t in texts.items()}
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {k: f"{p:016x}" for k, p in prints.items()}
    assert {r["doc_id"]: r["component_id"] for r in rows} == classes_by_hand(prints)


@pytest.mark.parametrize("most", [4, 2048])
def test_links_of_long_lists(spark, most):
    """Chains and clusters of prints; with a small limit lists are indexed again and cut into blocks."""
    draw = np.random.default_rng(8)
    prints = {}
    for start in draw.integers(0, 2**63, 8):
        print_ = int(start)
        for _ in range(25):
            for bit in draw.integers(0, 64, draw.integers(1, 5)):
                print_ ^= 1 << int(bit)
            prints[len(prints)] = print_
    prints[900], prints[901] = 0, 1 << 63
    signed = [(p - (1 << 64) if p >> 63 else p, k) for k, p in prints.items()]
    nodes = spark.createDataFrame(signed, "print long, node long")
    nodes = nodes.groupBy("print").agg({"node": "min"}).toDF("print", "node")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.similar_nodes(nodes, most, 64)).collect()}
    kept = {r["node"]: r["print"] % (1 << 64) for r in nodes.collect()}
    assert {k: roots.get(k, k) for k in kept} == classes_by_hand(kept)


def rule_counts(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    again = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, repeated, len(again)


def test_op9_query(spark, sf_dir, texts):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    for r in collected(spark, sf_dir, "op9_quality_rules"):
        n, chars, symbols, lines, again = rule_counts(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, lines, again)
        assert r["base_failed"] == (n < 50 or 100 * again > 50 * n)
        if r["doc_id"] in labels and not r["base_failed"]:
            assert r["kept"] == bool(labels[r["doc_id"]]), r["doc_id"]


def test_em_finds_accuracies():
    draw = np.random.default_rng(1)
    truth = draw.random(30_000) < 0.8
    counts = Counter()
    for good in truth:
        code = 0
        for accuracy in (0.95, 0.9, 0.8, 0.7):
            vote = 0 if draw.random() < 0.2 else (1 if (draw.random() < accuracy) == good else -1)
            code = code * 3 + vote + 1
        counts[code] += 1
    model = rules.fit_rules(counts, 4)
    assert np.abs(model.accuracy - [0.95, 0.9, 0.8, 0.7]).max() < 0.03 and abs(model.prior - 0.8) < 0.03
    assert rules.fit_rules({}, 4).posterior[-1] > 0.9


def test_op10_query(spark, sf_dir, texts):
    rows = {r["doc_id"]: r for r in collected(spark, sf_dir, "op10_minhash")}
    ids = sorted(texts)
    prints = {k: np.frombuffer(bytes.fromhex(r["fingerprint"]), "<u2") for k, r in rows.items()}
    for k, after in zip(ids, [*ids[1:], ids[0]]):
        r, text = rows[k], texts[k]
        half = len(text) // 2
        changed = text[: len(text) - half] + texts[after][:half]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        other = np.frombuffer(bytes.fromhex(r["edited_fingerprint"]), "<u2")
        assert r["near_edited"] == (prints[k] == other).mean()
        assert r["near_next"] == (prints[k] == prints[after]).mean()


def test_edits_do_not_depend_on_ranges(spark):
    docs = documents(spark, [(i * i, sentence(i, 5 + i % 40)) for i in range(200)]).repartition(5)
    whole = sorted(map(str, minhash.fingerprints_with_edits(docs, 10_000).collect()))
    assert sorted(map(str, minhash.fingerprints_with_edits(docs, 7).collect())) == whole


def grams(text):
    words = WORD.findall(text)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_signature_estimates_jaccard():
    words = sentence(3, 500).split()
    for cut in (50, 150, 300):
        a, b = " ".join(words), " ".join(words[cut:] + sentence(77, cut).split())
        near = minhash.likeness(minhash.signature_of(a), minhash.signature_of(b))
        assert abs(near - jaccard(grams(a), grams(b))) < 0.15


@pytest.mark.parametrize("most", [2, 256])
def test_minhash_classes(spark, most):
    rows, draw = [], np.random.default_rng(4)
    for group in range(12):
        words = sentence(group, 120).split()
        for copy in range(6):
            changed = list(words)
            for at in draw.integers(0, 120, int(draw.integers(0, 5))):
                changed[at] = f"new{group}{copy}{at}"
            rows.append((len(rows), " ".join(changed)))
    sets = {k: grams(t) for k, t in rows}
    root = {k: k for k in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= 0.8 and find(i) != find(j):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    found = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(documents(spark, rows), most=most).collect()}
    assert found == {k: find(k) for k in sets}


def test_edited_copies_go(spark):
    """Copies at a similarity of 0.8 and more, whose prints differ in more than 3 bits; what is below 0.8 stays."""
    rows, gone = [], set()
    for group in range(30):
        words = sentence(group, 150).split()
        rows.append((10 * group, " ".join(words)))
        for copy, edits in ((1, 1), (2, 2), (3, 3), (4, 5), (5, 8)):
            changed = list(words)
            for i in range(edits):
                changed[10 + 14 * i] = f"new{group}x{copy}x{i}"
            rows.append((10 * group + copy, " ".join(changed).upper() if copy == 2 else " ".join(changed)))
            if jaccard(grams(rows[-1][1].lower()), grams(" ".join(words))) >= 0.8:
                gone.add(rows[-1][0])
    prints = {k: simple_print(t) for k, t in rows}
    assert sum((prints[k] ^ prints[k // 10 * 10]).bit_count() > 3 for k in gone) > 20
    found = minhash.keep_one_of_each(documents(spark, rows)).collect()
    assert sorted(r["doc_id"] for r in found) == sorted({k for k, _ in rows} - gone)


def test_texts_that_share_an_id_stay(spark):
    """Half of the rows have one id and texts of their own; a copy under that id goes, whichever row leads."""
    rows = [(5, sentence(i, 60)) for i in range(12)] + [(20 + i, sentence(50 + i, 60)) for i in range(8)]
    extra = [(5, sentence(0, 60)), (5, sentence(50, 60)), (30, sentence(3, 60)), (None, sentence(4, 60)), (None, sentence(70, 60))]
    found = minhash.keep_one_of_each(documents(spark, rows + extra).repartition(5)).collect()
    expected = rows[:12] + [(5, sentence(50, 60))] + rows[13:] + [(None, sentence(70, 60))]
    assert Counter((r["doc_id"], r["text"]) for r in found) == Counter(expected)


def test_minhash_classes_of_rows_without_an_id(spark):
    rows = [(None, sentence(1, 60)), (4, sentence(1, 60)), (None, sentence(2, 60)), (None, sentence(2, 60))]
    found = minhash.near_duplicates(documents(spark, rows)).collect()
    assert Counter((r["doc_id"], r["class_id"]) for r in found) == Counter([(None, 4), (4, 4), (None, None), (None, None)])


def test_op5_held_out_accuracy(spark):
    rows = QUERIES["op5_quality"](spark, "/root/testdata/sf0.01").collect()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    quality = {r["doc_id"]: r["quality"] for r in labels}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    judged = [r["predicted"] == quality[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in quality]
    assert len(judged) > 40 and np.mean(judged) > 0.9


def test_training_reads_no_held_out_row(spark, sf_dir):
    from pyspark.sql import functions as F

    from pricebench.llm import classifier

    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    spoiled = labels.withColumn("quality", F.when(classifier.fold() == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = classifier.fit(docs, labels), classifier.fit(docs, spoiled)
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias
    assert classifier.labelled_sample(docs, labels, 10).count() == 10


def test_the_rule_on_common_words_abstains_on_other_letters(spark):
    texts = [PROSE * 3, "ко времени он шёл домой по улице и думал о хлебе " * 8, "日本語の文章を書いています " * 30, "xqz vbn wrt plk " * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    measured = df.select("doc_id", rules.features("text").alias("f"))
    found = measured.select("doc_id", rules.votes("f")[7].alias("v")).orderBy("doc_id").collect()
    assert [r["v"] for r in found] == [1, 0, 0, -1]
    assert rules.measure("éÀß abc 9_")[11] == 0 and rules.measure("он 日本 a")[11] == 4


def test_rules_are_not_upside_down():
    good, bad = PROSE * 4, "### " * 80
    assert rules.measure(good)[2] == 0 and rules.measure(bad)[2] == 240


@pytest.mark.parametrize("model", ["piece_bpe_32k.model"])
def test_streaming_search_equals_merging(model):
    import public_tokenizers
    import sentencepiece

    from pricebench.llm.pieces import Vocabulary

    path = public_tokenizers.path(model)
    words, library = Vocabulary(path), sentencepiece.SentencePieceProcessor(model_file=path)
    draw = np.random.default_rng(2)
    parts = ["the", "ing", " ", "   ", "a", "e", "n", "\n", "é", "日本", "😀", "=" * 5, "...", "____", "\t", "12", "tion", "\x00", "▁"]
    texts = ["".join(draw.choice(parts, draw.integers(0, 60))) for _ in range(800)]
    texts += ["aeiou" * 2000 + " " * 3000 + "b" * 4000, "x" * 10_000, "▁" * 500]
    for text in texts:
        ids = words.encode(text)
        assert ids.tolist() == library.encode(text)
        assert words.decode(ids) == library.decode(library.encode(text))
