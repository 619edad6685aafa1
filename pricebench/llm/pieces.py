"""SentencePiece encoding and decoding by a streaming Viterbi search.

The model file is a merge (BPE) vocabulary. A sequence of pieces is its encoding exactly when each pair of
neighbours is stable, that is when merging the two alone never crosses the boundary between them. So the
lattice of all pieces, with steps between stable neighbours only, has one path to every position, and the
search finds merge results without merging. It keeps back pointers for a window as long as the longest
piece, and gives out ids as soon as the paths of all positions in the window run through one boundary.
"""

import math
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
CACHED_RUNS, CACHED_PAIRS = 1_000_000, 1_000_000
STEADY = 64  # positions between two looks for a common boundary


class Vocabulary:
    """Pieces with their merge ranks, and which neighbours are stable."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.text = {i: model.id_to_piece(i) for i in plain if not model.is_unused(i)}
        self.ids = {t: i for i, t in self.text.items()}
        self.rank = {t: -model.get_score(i) for t, i in self.ids.items()}  # the lowest merges first
        self.byte_ids = {int(model.id_to_piece(i)[1:-1], 16): i for i in range(size) if model.is_byte(i)}
        self.octets = {i: t.replace(SPACE, " ").encode() for i, t in self.text.items()}
        self.octets |= {i: bytes([b]) for b, i in self.byte_ids.items()}
        self.unknown_id = model.unk_id()
        self.longest = max(map(len, self.ids), default=1)
        merging = {c for t in self.ids if len(t) > 1 for c in t}
        lone = "".join(c for c in "\n\t\r" if c not in merging)
        # A run ends before a space mark unless some piece goes on across it, and at characters that never merge.
        if any(re.search(f"[^{SPACE}]{SPACE}", t) for t in self.ids):
            self.runs = re.compile(r"(?s).+")
        else:
            self.runs = re.compile(f"[{lone}]|{SPACE}*[^{SPACE}{lone}]+|{SPACE}+" if lone else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self._index_merges()
        self.verdicts: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}

    def _index_merges(self) -> None:
        """How each piece comes about, and the symbols at its ends while it does."""
        self.right: dict[str, list] = {}
        self.left: dict[str, list] = {}
        self.odd: set[str] = set()
        whole = {}
        for t in self.ids:
            steps = self.merge(t)
            if len(steps[0]) == 1:
                whole[t] = steps[1]
        self.whole = whole
        for t in whole:
            self.right[t], self.left[t] = self._spine(t, 1), self._spine(t, 0)
        self.names = ["", *whole]
        self.numbers = {t: n for n, t in enumerate(self.names) if n}
        self.sizes = [len(t) for t in self.names]
        # Every ending of a piece, with the piece's number where it is one itself and 0 where it is not.
        self.tails = {t[i:]: 0 for t in whole for i in range(len(t))} | self.numbers
        self.number_ids = [self.unknown_id, *map(self.ids.__getitem__, whole)]

    def merge(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """Plain merging of a short text: its symbols, and the last pair that was merged."""
        symbols, last = list(text), None
        while True:
            best = min(
                ((self.rank[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in self.rank),
                default=None,
            )
            if best is None:
                return symbols, last
            i = best[1]
            last = symbols[i], symbols[i + 1]
            symbols[i : i + 2] = [last[0] + last[1]]

    def _spine(self, piece: str, side: int) -> list[tuple[str, float, float]]:
        """Symbols at one end of a piece, youngest first: (symbol, when it came, when it was merged away)."""
        found, gone, at = [], math.inf, piece
        while True:
            split = self.whole.get(at) if len(at) > 1 else None
            came = self.rank[at] if split else -math.inf
            if came >= gone:
                self.odd.add(piece)
            found.append((at, came, gone))
            if not split:
                return found
            if any(len(s) > 1 and self.rank[s] >= came for s in split):
                self.odd.add(piece)
            gone, at = came, split[side]

    def stays(self, a: str, b: str) -> bool:
        """Do the pieces stay apart when they stand side by side?"""
        if a in self.odd or b in self.odd:
            return self.merge(a + b)[0] == [a, b]
        ends, starts = self.right[a], self.left[b]
        i = j = 0
        while True:
            x, x_came, x_gone = ends[i]
            y, y_came, y_gone = starts[j]
            met = self.rank.get(x + y)
            if met is not None and met < x_gone and met <= y_gone:
                return False
            if x_came == y_came == -math.inf:
                return True
            if x_came > y_came:
                i += 1
            else:
                j += 1

    def search(self, run: str) -> list[int]:
        """The pieces of a run as numbers; unknown characters are their inverted code points.

        ``ends[i]`` is the piece that ends ``i`` characters after the last boundary given out. Only the
        window of the longest piece and what is not yet certain before it are kept.
        """
        tail, verdict, sizes = self.tails.get, self.verdicts.get, self.sizes
        given: list[int] = []
        base, ends = 0, [0]
        for end in range(1, len(run) + 1):
            start = end
            found = 0
            while start > base:
                start -= 1
                number = tail(run[start:end])
                if number is None:
                    break
                if number:
                    before = ends[start - base] if start > base else (given[-1] if given else 0)
                    if before <= 0:  # the start of the run, or a character that is in no piece
                        stays = True
                    else:
                        stays = verdict(before << 32 | number)
                        if stays is None:
                            stays = self.judge(before, number)
                    if stays:
                        found = number
                        break
            ends.append(found or ~ord(run[end - 1]))
            if end % STEADY == 0:
                certain = self.certain(ends)
                given += certain
                gone = sum(sizes[n] if n > 0 else 1 for n in certain)
                base, ends = base + gone, [0, *ends[gone + 1 :]]
        return given + self.path(ends, len(ends) - 1)

    def judge(self, before: int, number: int) -> bool:
        if len(self.verdicts) >= CACHED_PAIRS:
            self.verdicts.clear()
        stays = self.stays(self.names[before], self.names[number])
        self.verdicts[before << 32 | number] = stays
        return stays

    def certain(self, ends: list[int]) -> list[int]:
        """Pieces up to the last boundary that the paths of all positions in the window share."""
        heads = set(range(max(0, len(ends) - self.longest), len(ends)))
        while len(heads) > 1:
            p = max(heads)
            heads.discard(p)
            heads.add(p - (self.sizes[ends[p]] if ends[p] > 0 else 1))
        return self.path(ends, heads.pop())

    def path(self, ends: list[int], end: int) -> list[int]:
        back = []
        while end > 0:
            back.append(ends[end])
            end -= self.sizes[ends[end]] if ends[end] > 0 else 1
        return back[::-1]

    def encode_run(self, run: str) -> bytes:
        numbers, named = self.search(run), self.number_ids
        if min(numbers) > 0:
            return array("i", [named[n] for n in numbers]).tobytes()
        ids: list[int] = []
        for number in numbers:
            if number > 0:
                ids.append(named[number])
            elif self.byte_ids:
                ids += [self.byte_ids[b] for b in chr(~number).encode()]
            else:
                ids.append(self.unknown_id)
        return array("i", ids).tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text: a mark for the start and one per space; nothing for an empty text."""
        if not text:
            return np.zeros(0, "<i4")
        runs = self.runs.findall(SPACE + text.replace(" ", SPACE))
        known = self.known
        if len(known) > CACHED_RUNS:
            known.clear()
        for run in set(runs):
            if run not in known:
                known[run] = self.encode_run(run)
        return np.frombuffer(b"".join(map(known.__getitem__, runs)), "<i4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: bytes that are no UTF-8 become replacement marks, the mark of the start goes."""
        table = self.octets
        raw = b"".join([table.get(i, b"") for i in ids.tolist()])
        return raw.decode(errors="replace").removeprefix(" ")


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """One per worker process, since reading it takes a second."""
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def encoded(docs: DataFrame, model_path: str, ids_each: int = 1 << 20) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its ids, and whether decoding them gives the text back.

    Null and empty texts have no ids. A text with a literal space mark (U+2581) is encoded like one with a
    space, as the model has it, and so does not come back. Texts are whole whatever their length. Repeated
    rows are encoded each for themselves; an empty table gives no rows; other columns are not read.
    """
    name = docs.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model_path)
        for batch in batches:
            held: list[tuple] = []
            size = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                ids = words.encode(text)
                held.append((doc_id, ids, words.decode(ids) == text))
                size += len(ids)
                if size > ids_each:
                    yield as_batch(held, batch.schema.field(0).type)
                    held, size = [], 0
            if held:
                yield as_batch(held, batch.schema.field(0).type)

    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {name}, ids array<int>, round_trip boolean")


def as_batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    doc_ids, ids, back = zip(*rows)
    ends = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32)))
    return pa.record_batch([pa.array(doc_ids, id_type), lists, pa.array(back)], ["doc_id", "ids", "round_trip"])


def decoded(encodings: DataFrame, model_path: str) -> DataFrame:
    """Texts from a table of (doc_id, ids); null ids give a null text."""

    @F.pandas_udf("string")
    def text(ids):
        words = vocabulary(model_path)
        return ids.map(lambda i: None if i is None else words.decode(np.asarray(i)))

    return encodings.select("doc_id", text("ids").alias("text"))
