"""Byte-level BPE: encoding by the tokenizers library over Arrow batches, offsets, and decoding.

The vocabulary is a table of byte strings and their ranks. The library works on characters, so each byte
is shown to it as a character of its own; decoding turns that table round. Tokens may end inside a
character: offsets then name the whole character, and decoding joins bytes before it reads characters.
"""

import base64
import codecs
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

AT_ONCE = 1 << 18  # characters given to the library in one call
TOKENS = 1 << 20  # ids of the rows that go back to Spark together
REMEMBERED, LONGEST = 1 << 18, 64  # segments whose ids a worker keeps, and their longest
UNKNOWN = "�".encode()
LAST = itemgetter(-1)
SAFE_CUT = re.compile(r"(?= )(?<=\S)")


def byte_characters() -> list[str]:
    """A visible character for each byte: printable Latin-1 stands for itself, the others follow from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b if b in shown else 256 + hidden.index(b)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """The lines of a rank file: base64 of a token's bytes, a blank, its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def library_model(ranks: dict[bytes, int], pattern: str) -> str:
    """The ranks as a model of the tokenizers library, in its own JSON.

    Two neighbours may join if their bytes together are a token; the least rank joins first. So every
    split of a token into two tokens is a merge, in the order of the ranks. A match of the pattern that
    is a token itself is that token, whether merges lead to it or not.
    """
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"the vocabulary lacks single bytes: {missing[:5]}")
    characters = byte_characters()
    shown = {token: "".join([characters[b] for b in token]) for token in ranks}
    merges = [
        (shown[token[:cut]], shown[token[cut:]])
        for token in sorted(ranks, key=ranks.get)
        for cut in range(1, len(token))
        if token[:cut] in ranks and token[cut:] in ranks
    ]
    vocabulary = {shown[token]: rank for token, rank in ranks.items()}
    tokenizer = Tokenizer(models.BPE(vocabulary, merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return tokenizer.to_str()


def segments(text: str) -> list[str]:
    """A text cut before each blank that follows a visible character.

    No match of the pattern goes on with white space after a visible character, and none looks back, so the
    segments match as the whole does.
    """
    parts = text.split(" ")
    if "" in parts or any(map(str.isspace, set(map(LAST, parts)))):
        return SAFE_CUT.split(text)  # some blank follows another one, or other white space
    return [parts[0], *map(" ".__add__, parts[1:])]


class Codec:
    """The library's tokenizer and the table back from ids to bytes."""

    def __init__(self, model: str):
        self.tokenizer = Tokenizer.from_str(model)
        octet = {c: b for b, c in enumerate(byte_characters())}
        vocabulary = self.tokenizer.get_vocab()
        self.table = [UNKNOWN] * (max(vocabulary.values()) + 1)
        for shown, number in vocabulary.items():
            self.table[number] = bytes(map(octet.__getitem__, shown))
        self.sizes = np.array([len(token) for token in self.table], np.int64)
        self.inside = np.array([token[0] & 0xC0 == 0x80 for token in self.table])  # starts inside a character
        self.known: dict[str, bytes] = {}

    def learn(self, wanted: list[str]) -> dict[str, bytes]:
        """The ids of segments, as 32-bit numbers, from the library.

        Segments between two cuts are put together again to strings of a bounded size: they would be cut there.
        How many bytes each token has says where the ids of a segment end.
        """
        inner = [s for s in wanted if s[:1] == " " and not s[-1].isspace()]
        sizes = np.cumsum([0, *map(len, inner)])
        cuts = [*np.unique(np.searchsorted(sizes, np.arange(0, sizes[-1], AT_ONCE))).tolist(), len(inner)]
        together = [inner[first:last] for first, last in zip(cuts, cuts[1:])]
        found = {}
        for parts in [*together, *([s] for s in wanted if s[:1] != " " or s[-1].isspace())]:
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(parts)], add_special_tokens=False)[0].ids, "<i4")
            ends = np.cumsum(self.sizes[ids])
            cuts = np.searchsorted(ends, np.cumsum([len(s.encode()) for s in parts])) + 1
            raw, at = ids.tobytes(), 0
            for segment, cut in zip(parts, (4 * cuts).tolist()):
                found[segment] = raw[at:cut]
                at = cut
        return found

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. A segment that the worker remembers is not encoded again."""
        cut = [segments(text) for text in texts]
        met = set().union(*cut)
        self.known.update(self.learn(list(met - self.known.keys())))
        found = [np.frombuffer(b"".join(map(self.known.__getitem__, parts)), "<i4") for parts in cut]
        if len(self.known) > REMEMBERED:  # the latest texts hold the frequent ones
            self.known = {s: self.known[s] for s in met if len(s) <= LONGEST}
        return found

    def offsets(self, ids: np.ndarray, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First character and end of each token in its text."""
        if not len(ids):
            return np.zeros(0, np.int32), np.zeros(0, np.int32)
        character = np.cumsum(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80, dtype=np.int32) - 1
        ends = np.cumsum(self.sizes[ids])
        return character[ends - self.sizes[ids]], character[ends - 1] + 1

    def bytes_of(self, ids: Iterable[int | None]) -> bytes:
        """The bytes of the tokens; null and ids outside the vocabulary give the replacement character."""
        top = len(self.table)
        return b"".join([self.table[i] if i is not None and 0 <= i < top else UNKNOWN for i in ids])

    def bytes_of_lists(self, lists: pa.ListArray) -> Iterator[bytes]:
        """The bytes of each list of ids, none for a null list."""
        flat = lists.flatten()
        if flat.null_count or (len(flat) and not 0 <= pc.min(flat).as_py() <= pc.max(flat).as_py() < len(self.table)):
            yield from (self.bytes_of(ids.as_py() or ()) for ids in lists)
            return
        ids, at = flat.to_numpy(), 0
        for n in pc.list_value_length(lists).fill_null(0).to_pylist():
            yield b"".join(map(self.table.__getitem__, ids[at : at + n].tolist()))
            at += n

    def texts_of(self, pieces: Iterable[Iterable[int]]) -> Iterator[str]:
        """The text of consecutive pieces of one document; a character cut between two is part of the later one.

        What is no character, such as half of one at the very end, becomes the replacement character.
        """
        reader = codecs.getincrementaldecoder("utf-8")("replace")
        piece = None
        for following in pieces:
            if piece is not None:
                yield reader.decode(self.bytes_of(piece))
            piece = following
        if piece is not None:
            yield reader.decode(self.bytes_of(piece), final=True)


@lru_cache(maxsize=2)
def codec(model: str) -> Codec:
    """One codec per Python worker; its threads are left to Spark."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Codec(model)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(parts), pa.int32()))


def _slices(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of rows with about ``size`` bytes of text."""
    lengths = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(lengths), 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield start, stop
        start = stop


def encoded(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", offsets: bool = True) -> DataFrame:
    """(key, ids, n_split, and with ``offsets`` starts and ends) of each row of ``docs``.

    ``model`` comes from ``library_model`` and is sent once to each executor; its size is the vocabulary's.
    Texts are encoded whole. Null and empty texts have no ids. Offsets count characters, ends exclusive; a token
    with part of a character names the whole of it, and ``n_split`` counts the tokens that start inside one.
    Repeated rows and null keys give rows of their own, an empty table gives none, other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [key, "ids", "n_split", *(("starts", "ends") if offsets else ())]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value)
        for batch in batches:
            for start, stop in _slices(batch.column(1), 2 * TOKENS):
                texts = [value or "" for value in batch.column(1).slice(start, stop - start).to_pylist()]
                ids = own.encode(texts)
                split = [int(own.inside[found].sum()) for found in ids]
                columns = [batch.column(0).slice(start, stop - start), _lists(ids), pa.array(split, pa.int32())]
                if offsets:
                    columns += map(_lists, zip(*(own.offsets(found, t.encode()) for found, t in zip(ids, texts))))
                yield pa.record_batch(columns, names)

    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, ids array<int>, n_split int"
    schema += ", starts array<int>, ends array<int>" if offsets else ""
    return docs.select(key, text).mapInArrow(rows, schema)


def decoded(df: DataFrame, ids: Column, model: str) -> Column:
    """The bytes that a column of ids stands for; null ids give no bytes."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("binary")
    def decode(lists: pa.Array) -> pa.Array:
        own = codec(shared.value)
        return pa.array(list(own.bytes_of_lists(lists)), pa.binary())

    return decode(ids)
