"""Byte-level BPE, spelling variants and whitening against libraries and brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from pricebench.llm import byte_pairs, packing, spelling, whitening
from pricebench.llm.catalog import QUERIES, token_files
from cases import CLASHING, ODD_TEXTS, documents

RANKS = byte_pairs.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def model():
    return byte_pairs.library_model(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


# ---- byte-level BPE


def test_op11_equals_the_library(spark, sf_dir, texts):
    rows = QUERIES["op11_byte_bpe"](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        ids = LIBRARY.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == sha(" ".join(map(str, ids)).encode())
        assert r["decoded_sha256"] == sha(texts[r["doc_id"]].encode())


def odd_strings():
    draw = random.Random(5)
    kinds = [" ", "\n\t\r\x0b\x1c\x85\xa0 　", "abcXYZ'sll'", "0123456789٣", "éßñÀ", "日本語한국", "🎉👩‍👧🏽́", "!?.,#$\x00\x7f"]
    for _ in range(300):
        yield "".join(draw.choice(draw.choice(kinds)) for _ in range(draw.randint(0, 60)))
    for cp in range(0, 0x20000, 37):
        if not 0xD800 <= cp < 0xE000:
            yield f"a{chr(cp)}1{chr(cp)}{chr(cp)} {chr(cp)}  {chr(cp)}! "


def test_ids_and_offsets_of_odd_strings(model):
    codec = byte_pairs.Codec(model)
    strings = list(odd_strings()) + ["a" * 3000, "<|endoftext|> x"]
    for text, ids in zip(strings, codec.encode(strings)):
        assert ids.tolist() == LIBRARY.encode_ordinary(text)
        raw = text.encode()
        assert codec.bytes_of(ids) == raw
        starts, ends = codec.offsets(ids, raw)
        at, split = 0, 0
        for number, first, end in zip(ids.tolist(), starts, ends):
            token = codec.table[number]
            whole = text[first:end].encode()
            assert token in whole and len(text[first + 1 : end - 1].encode()) <= len(token)
            assert at >= len(text[:first].encode()) and at + len(token) <= len(text[:end].encode())
            split += at > len(text[:first].encode())
            at += len(token)
        assert split == codec.inside[ids].sum()


def test_packing_encodes_as_the_tokenizer_file_says():
    """Random strings over all kinds of characters, with special strings among them."""
    from tokenizers import Tokenizer

    files = token_files()
    library, encode = Tokenizer.from_file(files[0]), packing.encoder(*files, packing.special_strings(files[0]))
    draw = random.Random(12)
    strings = [*odd_strings(), "x <|endoftext|> y", "<|endoftext|>" * 3, "<|endoftext", "a" * 5000]
    for _ in range(300):
        points = (draw.choice([draw.randrange(0x20, 0x250), draw.randrange(0x250, 0xD800), draw.randrange(0xE000, 0x110000)]) for _ in range(40))
        strings.append("".join(chr(p) + draw.choice(["", "", " ", "\n"]) for p in points))
    for text in strings:
        assert list(encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_long_texts_are_cut_where_nothing_changes(model):
    codec = byte_pairs.Codec(model)
    draw = random.Random(7)
    words = ["the", "  ", "\n", "don't", "x1y2", "é日", "...", "a" * 40]
    text = " ".join(draw.choice(words) for _ in range(700_000))  # about 4 MB
    texts = ["", text, "short", "y" * 300_000, text[:99_999]]
    assert len(byte_pairs.segments(text)) > 100_000
    assert "".join(byte_pairs.segments(text)) == text
    assert [f.tolist() for f in codec.encode(texts)] == [LIBRARY.encode_ordinary(t) for t in texts]
    assert codec.encode([]) == []


def test_split_characters_are_joined(model):
    codec = byte_pairs.Codec(model)
    text = "né 日本 🎉🎉 done"
    ids = codec.encode([text])[0].tolist()
    assert any(len(codec.table[i]) and codec.table[i][0] & 0xC0 == 0x80 for i in ids)  # some token starts inside one
    for width in (1, 2, 3):
        pieces = [ids[a : a + width] for a in range(0, len(ids), width)]
        assert "".join(codec.texts_of(pieces)) == text
    assert "".join(codec.texts_of([[RANKS[b"\xe6"]]])) == "�"
    assert codec.bytes_of([None, -1, 10**6]) == "�".encode() * 3
    lists = [[ids[0]], None, [], ids]
    assert list(codec.bytes_of_lists(pa.array(lists, pa.list_(pa.int32())))) == [codec.table[ids[0]], b"", b"", text.encode()]
    lists[2] = [None, 10**6]
    assert list(codec.bytes_of_lists(pa.array(lists, pa.list_(pa.int32()))))[2] == "�".encode() * 2


def test_a_vocabulary_without_all_bytes_is_refused():
    with pytest.raises(ValueError):
        byte_pairs.library_model({b"a": 0}, public_tokenizers.PATTERN)


def test_a_worker_forgets_what_it_cannot_hold(model, monkeypatch):
    monkeypatch.setattr(byte_pairs, "REMEMBERED", 50)
    monkeypatch.setattr(byte_pairs, "AT_ONCE", 100)
    codec = byte_pairs.Codec(model)
    for i in range(20):
        texts = [f"word{i + j} again {'long' * 30}{j} " * 3 for j in range(20)]
        assert [f.tolist() for f in codec.encode(texts)] == [LIBRARY.encode_ordinary(t) for t in texts]
        assert len(codec.known) <= 60 and all(len(s) <= byte_pairs.LONGEST for s in codec.known)


def test_bpe_edges(spark, model):
    docs = documents(spark, extra=(*CLASHING, "bpe", "starts", "n_split"))
    rows = byte_pairs.encoded(docs, model).collect()
    expected = [(k, LIBRARY.encode_ordinary(t or "")) for k, t in [*ODD_TEXTS, ODD_TEXTS[6]]]
    assert sorted(map(str, ((r["doc_id"], r["ids"]) for r in rows))) == sorted(map(str, expected))
    assert all(len(r["ids"]) == len(r["starts"]) == len(r["ends"]) for r in rows)
    bare = byte_pairs.encoded(docs, model, offsets=False)
    assert bare.columns == ["doc_id", "ids", "n_split"] and bare.count() == len(rows)
    assert byte_pairs.encoded(documents(spark, []), model).collect() == []
    none = spark.createDataFrame([(1, None)], "k int, ids array<int>")
    assert none.select(byte_pairs.decoded(none, F.col("ids"), model).alias("b")).first()["b"] == b""


# ---- spelling variants


def plain_counts(rows, noise=97):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


def plain_variants(counts):
    near = {w: [v for v in counts if abs(len(v) - len(w)) < 2 and one_apart(w, v)] for w in counts}
    best = {w: min(vs, key=lambda v: (-counts[v], v)) for w, vs in near.items() if vs}
    forms = {w: v for w, v in best.items() if counts[v] >= 2 * counts[w]}
    rows = set()
    for w, n in counts.items():
        root = w
        while root in forms:
            root = forms[root]
        rows.add((w, forms.get(w), root, n, len(near[w]), counts.get(forms.get(w))))
    return rows


def as_rows(df):
    return [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()]


def test_op12_equals_brute_force(spark, sf_dir, texts):
    found = as_rows(QUERIES["op12_spelling"](spark, sf_dir))
    expected = plain_variants(plain_counts(texts.items()))
    assert len(found) == len(set(found)) and set(found) == expected
    assert any(f[2] != f[0] for f in found)


def random_vocabulary(letters, number, shortest, longest, seed):
    draw = random.Random(seed)
    words = {"".join(draw.choice(letters) for _ in range(draw.randint(shortest, longest))) for _ in range(number)}
    return {w: draw.choice([3, 3, 4, 7, 7, 15, 40, 90]) for w in words}


@pytest.mark.parametrize(
    "letters, number, shortest, longest, together",
    [("ab", 400, 5, 9, 1 << 16), ("abé", 500, 5, 7, 64), ("abc", 600, 1, 6, 1 << 16), ("xyz÷", 500, 1, 5, 16)],
)
def test_variants_of_crowded_vocabularies(spark, letters, number, shortest, longest, together):
    """Few letters make groups that must be split into blocks, chains of forms and ties."""
    counts = random_vocabulary(letters, number, shortest, longest, together)
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    found = as_rows(spelling.variants(df, letters=1, together=together))
    assert len(found) == len(counts) and set(found) == plain_variants(counts)
    assert any(f[2] not in (f[0], f[1]) for f in found)  # a form of a form


def test_very_long_words(spark):
    long = "ab" * 3000
    counts = {long: 9, long[:-1]: 4, long[:2000] + "z" + long[2001:]: 4, "x" + long: 3, "short": 3}
    found = as_rows(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert set(found) == plain_variants(counts)


def test_bits_beyond_one_block_of_queries():
    counts = random_vocabulary("abcde", 2500, 5, 6, 1)
    words = sorted(counts)
    codes = spelling.word_codes(words, 7)
    chosen = [i for i, w in enumerate(words) if len(w) == 5]
    level, behind, ahead = spelling.PositionIndex(codes).one_error(codes[chosen], 5)
    q, other = spelling._ones(level | ahead | behind)
    assert {(words[chosen[a]], words[b]) for a, b in zip(q, other)} == {
        (words[i], w) for i in chosen for w in words if one_apart(words[i], w)
    }


def test_word_count_edges(spark):
    rows = [*ODD_TEXTS, ODD_TEXTS[6], (20, "Éclair éclair ÉCLAIR ÷÷÷÷÷ ×××××" * 4), (None, "Straße Straße STRASSE " * 3)]
    docs = documents(spark, rows, extra=(*CLASHING, "word", "n", "form"))
    assert {r["word"]: r["n"] for r in spelling.word_counts(docs).collect()} == plain_counts(rows)
    plain = spelling.word_counts(docs, noise=None, letters=1, times=1)
    assert {r["word"]: r["n"] for r in plain.collect()} == Counter(
        "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
        for _, t in rows
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or "")
    )
    assert as_rows(spelling.variants(spelling.word_counts(documents(spark, [])))) == []


# ---- whitening


def plain_whitening(vectors, k=8):
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    n, total = len(x), x.sum(axis=0)
    d = x - total / n
    covariance = d.T @ d / n
    values, basis = np.linalg.eigh(covariance)
    values, basis = values[::-1][:k], basis[:, ::-1][:, :k]
    return n, ((n * x - total) ** 2).sum(axis=1), d @ basis / np.sqrt(values), values / np.trace(covariance)


def check_whitening(rows, kept, k=8):
    n, deviation, white, share = plain_whitening([v for _, v in kept], k)
    found = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(found) == len(rows) == len(kept) * k
    for c in range(k):
        column = np.array([found[i, c + 1]["whitened"] for i, _ in kept])
        sign = np.sign(column @ white[:, c])
        assert np.abs(column - sign * white[:, c]).max() < 1e-8
        assert all(abs(found[i, c + 1]["explained"] / share[c] - 1) < 1e-9 for i, _ in kept)
    assert [found[i, 1]["deviation"] for i, _ in kept] == deviation.tolist()
    assert {r["n"] for r in rows} == {n} and len({r["identity_error"] for r in rows}) == 1
    assert rows[0]["identity_error"] < 1e-9


def test_op13_equals_numpy(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    kept = [
        (r["vec_id"], r["embedding"])
        for r in given
        if r["embedding"] is not None and all(c is not None and np.isfinite(c) for c in r["embedding"])
    ]
    check_whitening(QUERIES["op13_whitening"](spark, sf_dir).collect(), kept)


@pytest.mark.parametrize("parts", [1, 7])
def test_whitening_leaves_out_broken_vectors(spark, parts):
    draw = np.random.default_rng(3)
    kept = [(i, (draw.standard_normal(10) * np.arange(1, 11)).astype("f4").tolist()) for i in range(300)]
    broken = [None, [], [None] * 10, [*kept[0][1][:-1], float("nan")], [float("inf")] * 10, [1e30] * 10, [1.0] * 9]
    rows = kept + [(1000 + i, v) for i, v in enumerate(broken)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(parts)
    df = df.selectExpr("*", "'kept' AS whitened", "1 AS component", "2 AS n", "3 AS deviation", "4 AS _place")
    check_whitening(whitening.whitened_components(df).collect(), kept)


def test_whitening_edges(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whitened_components(spark.createDataFrame([], schema)).collect() == []
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], schema)
    assert whitening.whitened_components(same).collect() == []  # no variance
    line = spark.createDataFrame([(i // 2 if i else None, [float(i), 2.0 * i, 5.0]) for i in range(6)], schema)
    rows = whitening.whitened_components(line).collect()
    assert len(rows) == 6 and {r["component"] for r in rows} == {1}  # one direction; repeated and null ids stay
    assert abs(rows[0]["explained"] - 1) < 1e-9 and rows[0]["identity_error"] < 1e-9
    one = spark.createDataFrame([(1, [float(i)]) for i in range(4)], schema)
    assert sorted(round(r["whitened"], 6) for r in whitening.whitened_components(one).collect()) == [
        -1.341641, -0.447214, 0.447214, 1.341641
    ]


def test_deviations_beyond_64_bits():
    x = np.array([[3, -4], [1 << 40, 5]])
    rest = np.array([1, 2])
    assert whitening._deviations(10, x, rest).to_pylist() == [29**2 + 42**2, None]
    assert whitening._deviations(1, x, rest).to_pylist()[0] == 2**2 + 6**2


def matrices():
    draw = np.random.default_rng(11)
    orthogonal = np.linalg.qr(draw.standard_normal((40, 40)))[0]
    spectra = {
        "spread": np.geomspace(1, 1e-9, 40),
        "cluster": np.r_[[5.0] * 6, [5.0 + 1e-12] * 2, np.linspace(4, 0, 32)],
        "equal": np.ones(40),
        "low rank": np.r_[np.arange(12.0, 0, -1), np.zeros(28)],
        "large": np.geomspace(1e18, 1e-9, 40),
    }
    for name, values in spectra.items():
        yield name, (orthogonal * values) @ orthogonal.T
    yield "diagonal", np.diag(np.arange(40.0))
    yield "blocks", np.kron(np.eye(10), np.array([[2.0, 1, 0, 0], [1, 2, 0, 0], [0, 0, 7, 3], [0, 0, 3, 7]]))
    yield "one", np.array([[3.0]])
    yield "two", np.array([[2.0, 1.0], [1.0, 2.0]])


@pytest.mark.parametrize("name, matrix", list(matrices()), ids=[n for n, _ in matrices()])
def test_leading_components(name, matrix):
    matrix = (matrix + matrix.T) / 2
    k = min(8, len(matrix))
    values, vectors = whitening.leading_components(matrix, k)
    norm = np.abs(matrix).max() * len(matrix)
    assert np.abs(values - np.linalg.eigvalsh(matrix)[::-1][:k]).max() <= 1e-14 * norm
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-13 * norm
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12


def test_tridiagonal_form_keeps_the_spectrum():
    for _, matrix in matrices():
        diagonal, off, _ = whitening.tridiagonal((matrix + matrix.T) / 2)
        rebuilt = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
        expected = np.linalg.eigvalsh((matrix + matrix.T) / 2)
        assert np.allclose(np.linalg.eigvalsh(rebuilt), expected, atol=1e-13 * max(1, np.abs(matrix).max()) * len(matrix))
        middle = expected.mean() + 1e-6 * np.abs(expected).max()
        assert whitening.count_below(diagonal, off, np.array([middle]))[0] == (expected < middle).sum()
