"""Removal of repeated passages by longest previous factors, over the whole corpus.

A byte goes if a string of 100 bytes that covers it also starts earlier. Suffixes that agree for 100 bytes
must be brought together from all documents first. Every such string has an anchor: of its 85 grams of 16
bytes the one with the least hash, the first of equal ones. The string alone decides, so equal strings have
equal anchors at equal places. Strings that follow each other mostly share their anchor; the text that they
cover together is the anchor's surroundings. Anchors are sent to buckets by their hash.

1. An anchor whose whole surroundings occur earlier is settled: all of it repeats. One row per task and
   surroundings is sent, however often they occur.
2. Anchors that occur in different surroundings, the ends of shared passages, are sent with them. Per
   bucket a suffix order is made of it, and previous and next smaller positions give the longest previous
   factors: those of 100 bytes or more start a repeat.
3. Anchors with very many different surroundings are not sent to one bucket: each of their 100-byte strings
   is, under its own hash, and the earliest place of each string stays.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebench.llm.bytewords import BASE, mix
from pricebench.llm.suffixes import previous_factors, suffix_order
from pricebench.session import write_through

LENGTH = 100
GRAM = 16
WINDOW = LENGTH - GRAM + 1  # grams in a string of LENGTH bytes
CHUNK = 1 << 17
BUCKET_BYTES = 8 << 20
BUCKET_ANCHORS = 4096
SAMPLE_BYTES, SAMPLE_SHARE = 64 << 20, 1 / 256
HOT_IN_SAMPLE, HOT_HASHES, HOT_GROUP = 64, 100_000, 4096
FIRST = -(2**63)


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """The least or largest of each ``width`` values in a row, by doubling."""
    size = 1
    while 2 * size <= width:
        values = pick(values[:-size], values[size:])
        size *= 2
    return pick(values[: len(values) - (width - size)], values[width - size :]) if size < width else values


def anchors(octets: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of texts that stand one after the other, cut at ``bounds``: the runs of strings with one anchor.

    Gives the place and hash of each anchor, and the first and last start of the strings that it stands for.
    """
    n = len(octets)
    if n < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashed, size = octets.astype(np.uint64) + np.uint64(1), 1
    while size < GRAM:
        hashed = hashed[:-size] * np.uint64(pow(int(BASE), size, 1 << 64)) + hashed[size:]
        size *= 2
    hashed = mix(hashed) | np.uint64(1)
    least = _sliding(hashed, WINDOW, np.minimum)
    ends = np.repeat(bounds[1:], np.diff(bounds))[: len(least)]
    valid = np.arange(LENGTH, len(least) + LENGTH) <= ends  # no string runs over the end of a text
    # A new run starts when a lesser gram comes in, when the anchor drops out, and after an invalid string.
    new = valid.copy()
    new[1:] &= (least[1:] != least[:-1]) | (hashed[: len(least) - 1] == least[:-1]) | ~valid[:-1]
    first = np.flatnonzero(new)
    last_of_run = valid.copy()
    last_of_run[:-1] &= new[1:] | ~valid[1:]
    last = np.flatnonzero(last_of_run)
    place = first.copy()
    open_ = np.arange(len(first))
    entering = first + WINDOW - 1
    came_in = np.zeros(len(first), bool)
    inner = first > 0
    came_in[inner] = least[first[inner]] < least[first[inner] - 1]
    came_in &= np.where(inner, valid[np.maximum(first - 1, 0)], False)
    place[came_in] = entering[came_in]
    open_ = open_[~came_in]
    while len(open_):  # the first place from the start of the run on that holds the least hash
        open_ = open_[hashed[place[open_]] != least[first[open_]]]
        place[open_] += 1
    return place, hashed[place], first, last


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Texts in runs of about CHUNK bytes: index of the first, the bytes, the bounds between texts."""
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) <= CHUNK):
            size += len(texts[last])
            last += 1
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts[first:last]])]).astype(np.int64)
        yield first, np.frombuffer(b"".join(texts[first:last]), np.uint8), bounds
        first = last


def _surroundings(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Of every anchor: index of its text, start and size of its surroundings, hash, and a digest of them."""
    found = []
    for begin, octets, bounds in _chunks(texts):
        place, hashed, first, last = anchors(octets, bounds)
        owner = np.searchsorted(bounds, first, side="right") - 1
        whole, digest = octets.tobytes(), xxhash.xxh3_64_intdigest
        cuts = zip(first.tolist(), (last + LENGTH).tolist(), (place - first).tolist())
        digests = np.array([digest(whole[a:b], s) for a, b, s in cuts], np.uint64)
        found.append((owner + begin, first - bounds[owner], last - first + LENGTH, hashed, digests))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(c) for c in zip(*found))


def _earliest(keys: tuple[np.ndarray, ...], doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by keys, document and place; in that order, True for the first row of each key.

    Of rows that are equal in all of these, as repeated rows of a table make them, one is left in the order.
    """
    order = np.lexsort((place, doc, *reversed(keys)))
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order[1:]] != k[order[:-1]] for k in keys])
        other = new.copy()
        other[1:] |= (doc[order[1:]] != doc[order[:-1]]) | (place[order[1:]] != place[order[:-1]])
        order, new = order[other], new[other]
    return order, new


def _packed(values: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(values).astype(kind).tobytes()


def _texts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Ids, tags and texts of a batch with the columns k, tag and text."""
    ids, tags = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
    return ids, tags, [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]


def _ranks(doc: np.ndarray, tag: np.ndarray) -> np.ndarray:
    """Numbers in the order of ids, then tags; equal ones for one text. Without tags the ids are such numbers."""
    if not tag.any():
        return doc
    order = np.lexsort((tag, doc))
    new = np.zeros(len(doc), np.int64)
    new[1:] = (doc[order[1:]] != doc[order[:-1]]) | (tag[order[1:]] != tag[order[:-1]])
    ranks = np.empty(len(doc), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def _packed_tags(tag: np.ndarray) -> bytes:
    """Nothing where all tags are 0, as they are in a table whose ids are unique."""
    return _packed(tag, "<i8") if tag.any() else b""


def _unpacked_tags(packed: bytes, number: int) -> np.ndarray:
    return np.frombuffer(packed, "<i8") if packed else np.zeros(number, np.int64)


ANCHORS = "bucket int, base long, hash binary, digest binary, doc binary, tag binary, place binary, size binary"


def _anchor_batches(hot: np.ndarray, buckets: int):
    """Anchors by bucket, one row per bucket and batch. Rows without hashes are settled within the batch."""

    def sent(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        ids, tags, texts = _texts(batch)
        owner, place, size, hashed, digest = _surroundings(texts)
        del texts
        if not len(owner):
            return None
        order, new = _earliest((hashed, digest), _ranks(ids, tags)[owner], place)
        doc, tag = ids[owner], tags[owner]
        doc, tag, place, size, hashed, digest = (c[order] for c in (doc, tag, place, size, hashed, digest))
        spread = np.where(np.isin(hashed, hot), digest, hashed) if len(hot) else hashed
        bucket = (spread >> np.uint64(20)).astype(np.int64) % buckets
        bucket[~new] = buckets + doc[~new] % buckets
        by = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[by], prepend=-1))
        out = []
        for a, b in zip(cuts, [*cuts[1:], len(by)]):
            here = by[a:b]
            at, base = int(bucket[here[0]]), int(doc[here].min())
            open_ = at < buckets
            out.append(
                (
                    at,
                    base,
                    _packed(hashed[here], "<u8") if open_ else b"",
                    _packed(digest[here], "<u8") if open_ else b"",
                    _packed(doc[here] - base, "<u4" if int(doc[here].max()) - base < 1 << 32 else "<u8"),
                    _packed_tags(tag[here]),
                    _packed(place[here], "<u4"),
                    _packed(size[here], "u1"),
                )
            )
        types = [pa.int32(), pa.int64(), *[pa.binary()] * 6]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], _names(ANCHORS))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # what one batch needed is let go before the next one
            if (made := sent(batch)) is not None:
                yield made

    return rows


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _unpacked(rows: pd.DataFrame) -> tuple[np.ndarray, ...]:
    place = [np.frombuffer(p, "<u4") for p in rows["place"]]
    doc = [
        np.frombuffer(d, "<u4" if len(d) == 4 * len(p) else "<u8").astype(np.int64) + base
        for d, p, base in zip(rows["doc"], place, rows["base"])
    ]
    tag = np.concatenate([_unpacked_tags(t, len(p)) for t, p in zip(rows["tag"], place)])
    hashed, digest = (np.frombuffer(b"".join(rows[c]), "<u8") for c in ("hash", "digest"))
    size = np.frombuffer(b"".join(rows["size"]), "u1").astype(np.int64)
    return np.concatenate(doc), tag, np.concatenate(place).astype(np.int64), size, hashed, digest


VERDICTS = "k long, tag long, start long, end long, hash long, state int"
SETTLED, ASKED, ASKED_HOT = 0, 1, 2


def _settle(hot: np.ndarray, group_limit: int):
    """Per bucket: which anchors repeat with all their surroundings, and which need their text compared."""

    def verdicts(rows: pd.DataFrame) -> pd.DataFrame:
        passed = rows["hash"].map(len) == 0
        parts = []
        if passed.any():
            doc, tag, place, size, _, _ = _unpacked(rows[passed])
            parts.append((doc, tag, place, place + size, np.zeros(len(doc), np.int64), np.full(len(doc), SETTLED)))
        if not passed.all():
            doc, tag, place, size, hashed, digest = _unpacked(rows[~passed])
            order, new = _earliest((hashed, digest), _ranks(doc, tag), place)
            again, first = order[~new], order[new]
            _, which, count = np.unique(hashed[first], return_inverse=True, return_counts=True)
            very = np.isin(hashed[first], hot) | (count[which] > group_limit)
            asked = very | (count[which] > 1)
            state = np.where(very, ASKED_HOT, ASKED)[asked]
            for at, code in ((again, np.full(len(again), SETTLED)), (first[asked], state)):
                kept = np.where(code == SETTLED, 0, hashed[at].view(np.int64))
                parts.append((doc[at], tag[at], place[at], place[at] + size[at], kept, code))
        return pd.DataFrame(dict(zip(_names(VERDICTS), (np.concatenate(c) for c in zip(*parts)))))

    return verdicts


CONTEXTS = "bucket int, hot boolean, doc binary, tag binary, place binary, size binary, texts binary"


def _context_batches(buckets: int):
    """For the asked anchors of each text: their surroundings by bucket, or the strings of very common ones."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[tuple[int, bool], list] = {}
            ids, tags, texts = _texts(batch)
            strings: dict[bytes, tuple[int, int, int]] = {}
            repeated: list[tuple[int, int, int]] = []
            for k, tag, text, asks in zip(ids.tolist(), tags.tolist(), texts, batch.column(3).to_pylist()):
                for ask in asks:
                    low, high = ask["start"], ask["end"]
                    if ask["state"] == ASKED:
                        key = ((ask["hash"] >> 20) % buckets, False)
                        held.setdefault(key, []).append((k, tag, low, high - low, text[low:high]))
                        continue
                    for start in range(low, high - LENGTH + 1):
                        digest = xxhash.xxh3_128_digest(text[start : start + LENGTH])
                        here = k, tag, start
                        before = strings.setdefault(digest, here)
                        if before != here:
                            strings[digest] = min(before, here)
                            repeated.append(max(before, here))
            for digest, here in strings.items():
                held.setdefault((int.from_bytes(digest[:4], "little") % buckets, True), []).append((*here, 0, digest))
            for here in repeated:  # settled here: sent on without a string
                held.setdefault(((here[0] + here[1]) % buckets, True), []).append((*here, 1, b"\0" * 16))
            out = []
            for (at, hot), found in held.items():
                doc, tag, place, size, pieces = zip(*found)
                packed = _packed(np.array(doc), "<i8"), _packed_tags(np.array(tag))
                packed += _packed(np.array(place), "<u4"), _packed(np.array(size), "<u4")
                out.append((at, hot, *packed, b"".join(pieces)))
            if out:
                types = [pa.int32(), pa.bool_(), *[pa.binary()] * 5]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], _names(CONTEXTS))

    return rows


SPANS = "k long, tag long, start long, end long"


def _keys(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids and tags of context rows."""
    docs = [np.frombuffer(d, "<i8") for d in rows["doc"]]
    return np.concatenate(docs), np.concatenate([_unpacked_tags(t, len(d)) for t, d in zip(rows["tag"], docs)])


def _repeat_starts(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, tags and places of the strings in a bucket of surroundings that start earlier elsewhere."""
    doc, tag = _keys(rows)
    place = np.frombuffer(b"".join(rows["place"]), "<u4").astype(np.int64)
    size = np.frombuffer(b"".join(rows["size"]), "<u4").astype(np.int64)
    text = np.frombuffer(b"".join(rows["texts"]), np.uint8)
    begin = np.cumsum(size) - size
    each = np.maximum(size - LENGTH + 1, 0)
    inside = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    starts = np.repeat(begin, each) + inside
    which = np.repeat(np.arange(len(doc)), each)
    owner, at = _ranks(doc, tag)[which], place[which] + inside
    # In the order of documents and places; of strings that a repeated row brings again, one is left.
    where = np.lexsort((at, owner))
    new = np.ones(len(where), bool)
    new[1:] = (owner[where[1:]] != owner[where[:-1]]) | (at[where[1:]] != at[where[:-1]])
    which, at, starts = (v[where[new]] for v in (which, at, starts))
    position = np.arange(len(at))
    order, shared = suffix_order(text, starts, position, LENGTH)
    again = previous_factors(order, shared, position) >= LENGTH
    return doc[which[again]], tag[which[again]], at[again]


def _find_repeats(rows: pd.DataFrame) -> pd.DataFrame:
    parts = []
    hot = rows["hot"].to_numpy(bool)
    if (~hot).any():
        parts.append(_repeat_starts(rows[~hot]))
    if hot.any():
        here = rows[hot]
        k, tag = _keys(here)
        start = np.frombuffer(b"".join(here["place"]), "<u4").astype(np.int64)
        passed = np.frombuffer(b"".join(here["size"]), "<u4") == 1
        digest = np.frombuffer(b"".join(here["texts"]), "<u8").reshape(-1, 2)
        parts.append((k[passed], tag[passed], start[passed]))
        k, tag, start, digest = k[~passed], tag[~passed], start[~passed], digest[~passed]
        order, new = _earliest((digest[:, 0], digest[:, 1]), _ranks(k, tag), start)
        again = order[~new]
        parts.append((k[again], tag[again], start[again]))
    return _joined(*(np.concatenate(c) for c in zip(*parts)))


def _joined(doc: np.ndarray, tag: np.ndarray, place: np.ndarray) -> pd.DataFrame:
    """Strings that overlap or touch as one span."""
    order = np.lexsort((place, tag, doc))
    doc, tag, place = doc[order], tag[order], place[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (place[1:] > place[:-1] + LENGTH)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1 if len(doc) else first
    return pd.DataFrame({"k": doc[first], "tag": tag[first], "start": place[first], "end": place[last] + LENGTH})


def _hashed(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _key(tagged: bool, text: str = "text") -> list[Column]:
    """k and tag: the order of texts is that of ids, then of tags. Texts without an id come first.

    A tag is the 64-bit hash of the text, or 0 throughout where no id has two texts.
    """
    tag = _hashed(text) if tagged else F.lit(0).cast("long")
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST)).alias("k"), tag.alias("tag")]


def _shares_ids(docs: DataFrame) -> bool:
    """Whether some id has more than one text."""
    hashes = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST)).alias("k"), _hashed("text").alias("h"))
    per_id = hashes.groupBy("k").agg(F.min("h").alias("low"), F.max("h").alias("high"))
    return not per_id.filter(F.col("low") != F.col("high")).isEmpty()


def very_common(keyed: DataFrame, total: int) -> np.ndarray:
    """Hashes of anchors that a sample of documents shows in very many different surroundings.

    They only decide how anchors are spread over tasks, never what is found. The list is bounded.
    """
    share = min(1.0, max(SAMPLE_BYTES / max(total, 1), SAMPLE_SHARE))
    of = round(1 / share)
    sample = keyed.filter(F.pmod(F.xxhash64(F.lit("sample"), "k", "tag"), F.lit(of)) == 0)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, _, hashed, digest = _surroundings(_texts(batch)[2])
            order, new = _earliest((hashed, digest), hashed, hashed)
            found, count = np.unique(hashed[order[new]], return_counts=True)
            many = count > 1
            yield pa.record_batch([pa.array(found[many].view(np.int64)), pa.array(count[many])], ["hash", "n"])

    counts = sample.mapInArrow(local, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    top = counts.filter(F.col("n") >= HOT_IN_SAMPLE).orderBy(F.desc("n"), "hash").limit(HOT_HASHES).toArrow()
    return np.sort(top.column("hash").to_numpy().view(np.uint64))


def repeated_spans(keyed: DataFrame, total: int) -> DataFrame:
    """Spans (k, tag, start, end) of bytes that earlier strings cover; they may overlap."""
    hot, buckets = very_common(keyed, total), max(1, -(-total // BUCKET_BYTES))
    sent = keyed.mapInArrow(_anchor_batches(hot, buckets), ANCHORS)
    verdicts = write_through(sent.groupBy("bucket").applyInPandas(_settle(hot, HOT_GROUP), VERDICTS), "verdicts")
    asks = verdicts.filter(F.col("state") != SETTLED)
    bundles = max(1, -(-asks.count() // BUCKET_ANCHORS))
    per_text = asks.groupBy("k", "tag").agg(F.collect_list(F.struct("start", "end", "hash", "state")).alias("asks"))
    asked = keyed.join(per_text.hint("shuffle_hash"), ["k", "tag"]).select("k", "tag", "text", "asks")
    contexts = asked.mapInArrow(_context_batches(bundles), CONTEXTS)
    compared = contexts.groupBy("bucket").applyInPandas(_find_repeats, SPANS)
    settled = verdicts.filter(F.col("state") == SETTLED).select("k", "tag", "start", "end")
    return settled.union(compared)


def _union(spans: list, size: int) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans."""
    found: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        end = min(end, size)
        if found and start <= found[-1][1]:
            found[-1] = found[-1][0], max(end, found[-1][1])
        elif start < end:
            found.append((start, end))
    return found


def _character_cuts(raw: bytes, removed: list[tuple[int, int]]) -> str:
    """The text without the removed bytes; a character that is cut through stays whole."""
    kept, at = [], 0
    for start, end in removed:
        while start < len(raw) and raw[start] & 0xC0 == 0x80:
            start += 1  # the rest of a character whose first byte stays
        while end < len(raw) and end > start and raw[end] & 0xC0 == 0x80:
            end -= 1  # a character whose last bytes stay
        if start < end:
            kept.append(raw[at:start])
            at = end
    return b"".join([*kept, raw[at:]]).decode()


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, and any other columns) with what is left of each text.

    Adds n_bytes, removed (maximal runs of bytes), kept (the bytes left) and kept_text (the same, but a
    character of which only some bytes go stays). Order is by doc_id, then place: the first of equal
    strings stays. Null texts are empty. Texts without an id come first; texts that share an id follow
    each other; a row that repeats both id and text is cut like the first. An empty table gives no rows.
    """
    total = docs.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    tagged = _shares_ids(docs)
    keyed = docs.select(*_key(tagged), F.coalesce("text", F.lit("")).alias("text"))
    found = F.collect_list(F.struct("start", "end")).alias("spans")
    spans = repeated_spans(keyed, total).groupBy("k", "tag").agg(found)

    @F.pandas_udf("n_bytes long, removed array<struct<start: long, end: long>>, kept binary, kept_text string")
    def cut(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        out = []
        for text, spans_here in zip(texts, found):
            raw = (text or "").encode()
            runs = _union([(s["start"], s["end"]) for s in spans_here], len(raw)) if spans_here is not None else []
            ends = [0, *[p for run in runs for p in run], len(raw)]
            kept = b"".join(raw[a:b] for a, b in zip(ends[::2], ends[1::2]))
            out.append((len(raw), [{"start": a, "end": b} for a, b in runs], kept, _character_cuts(raw, runs)))
        return pd.DataFrame(out, columns=["n_bytes", "removed", "kept", "kept_text"])

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    joined = docs.select(*_key(tagged), row).join(spans.hint("shuffle_hash"), ["k", "tag"], "left")
    return joined.select("row", cut(F.col("row.text"), F.col("spans")).alias("cut"))
