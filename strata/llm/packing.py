"""Packing (1): sum-of-squares online packing of tokenised documents into fixed windows.

Every task packs the rows of its input partition on its own, so the plan is one scan without a
shuffle. A document of n ids gives n // capacity full windows; the rest is one item. An item goes
to the fill level that leaves the smallest sum of squared counts of partially filled windows;
the counts per level are one array, and the choice is one pass over it. At the end of a
partition the open windows are emptied into each other (cutting documents), and the last one is
cut into lengths that are powers of two, which need no padding.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long")
_BATCH_BYTES = 8 << 20
_CACHE_BYTES = 160 << 20  # of the pieces that a worker keeps, with some 200 bytes of overhead each
# texts whose split is known: ASCII and the letters of Latin-1, which lower-casing keeps apart
_PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
_PIECE = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
_tokenizers: dict[str, WordIds] = {}


class WordIds(dict):
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    The tokenizer lower-cases, drops white space and splits into pieces (letters, digits, other
    signs, contractions) that it encodes apart. Pieces recur: a text of ASCII and Latin-1
    letters is split here in the same way, and each piece is encoded once while it is held (those
    of up to 64 characters, ``_CACHE_BYTES`` at most). In other texts the chunks between blanks are
    handled so where they can be, and given to the tokenizer whole where not.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.held = 0

    def ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, piece: str) -> bytes:
        out = self.ids(piece)
        if len(piece) <= 64:
            self.held += 200 + len(piece) + len(out)
            if self.held > _CACHE_BYTES:
                self.clear()
                self.held = 0
            self[piece] = out
        return out

    def plain(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, _PIECE.findall(text.lower())))

    def of_text(self, text: str) -> bytes:
        if "<|" not in text and _PLAIN.fullmatch(text):
            return self.plain(text)
        return b"".join(self.plain(c) if "<|" not in c and _PLAIN.fullmatch(c) else self.ids(c) for c in re.split("[ \n\t\r]+", text))


def word_ids(path: str) -> WordIds:
    if path not in _tokenizers:
        _tokenizers[path] = WordIds(path)
    return _tokenizers[path]


class Packer:
    """Sum-of-squares packing of pieces (doc_id, start, ids, doc_tokens) into windows."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity = capacity
        self.next_id = first_id
        self.count = np.zeros(capacity + 1, np.int64)  # open windows per fill level; level 0 stands for a new one
        self.open: dict[int, list[list[tuple]]] = {}

    def close(self, window: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc, start, ids, total in window:
            yield doc, start, len(ids) // 4, ids, total, self.next_id, offset
            offset += len(ids) // 4
        self.next_id += 1

    def add(self, doc, ids: bytes) -> Iterator[tuple]:
        total, whole = len(ids) // 4, self.capacity * 4
        at = 0
        while len(ids) - at >= whole:
            yield from self.close([(doc, at // 4, ids[at: at + whole], total)])
            at += whole
        if at < len(ids):
            yield from self.place((doc, at // 4, ids[at:], total))

    def place(self, piece: tuple) -> Iterator[tuple]:
        size, cap = len(piece[2]) // 4, self.capacity
        # growth of the sum of squares for each level h = 0 .. cap - size
        count = self.count
        grow = np.where(count[: cap - size + 1] > 0, 2 - 2 * count[: cap - size + 1], np.iinfo(np.int64).max // 4)
        grow[0] = 1
        grow += 2 * count[size:]
        grow[-1] = grow[-1] - 1 if cap > size else 0  # a window that becomes full counts no longer
        level = len(grow) - 1 - int(np.argmin(grow[::-1]))  # ties: the fullest
        if level:
            window = self.open[level].pop()
            count[level] -= 1
        else:
            window = []
        window.append(piece)
        if level + size == cap:
            yield from self.close(window)
        else:
            count[level + size] += 1
            self.open.setdefault(level + size, []).append(window)

    def flush(self) -> Iterator[tuple]:
        """Empty the least filled windows into the fullest, then cut the last at powers of two."""
        rest = [w for level in sorted(self.open) for w in self.open[level]]
        left = [sum(len(p[2]) for p in w) // 4 for w in rest]
        low, high = 0, len(rest) - 1
        while low < high:
            gap = self.capacity - left[high]
            while gap and rest[low]:
                doc, start, ids, total = rest[low].pop()
                size = len(ids) // 4
                take = min(gap, size)
                rest[high].append((doc, start + size - take, ids[(size - take) * 4:], total))
                if take < size:
                    rest[low].append((doc, start, ids[: (size - take) * 4], total))
                gap -= take
                left[low] -= take
            if gap:
                left[high] = self.capacity - gap
                low += 1
            else:
                yield from self.close(rest[high])
                high -= 1
        if rest and low == high:
            pieces = rest[low]
            size = sum(len(p[2]) for p in pieces) // 4
            while size:
                want = 1 << (size.bit_length() - 1)
                size -= want
                window = []
                while want:
                    doc, start, ids, total = pieces.pop(0)
                    take = min(want, len(ids) // 4)
                    window.append((doc, start, ids[: take * 4], total))
                    if take * 4 < len(ids):
                        pieces.insert(0, (doc, start + take, ids[take * 4:], total))
                    want -= take
                yield from self.close(window)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = 4096, end_id: int = 2) -> DataFrame:
    """Pieces of documents in windows: one row a piece with its ids (little-endian uint32).

    ``sequence_id`` is unique over the table (input partition x 2^33 + window of the task), and
    ``offset`` is gapless from 0 in it. Each id of a document (its tokens, then ``end_id``) is in
    exactly one piece. A null or empty text is the single id ``end_id``. Rows are taken as they
    come: repeated rows and null ids are packed like any other; columns other than the two named
    are ignored. An empty table gives no rows. A retried task reads the same rows in the same
    order if the input is a table (as the queries do), and then gives the same windows.

    Memory of a task: the open windows and one document. Padding: none; every sequence holds
    ``capacity`` ids or a power of two.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer_path)
        end = np.asarray([end_id], "<u4").tobytes()
        packer = Packer(capacity, TaskContext.get().partitionId() << 33)
        names = [c.split(" ")[0] for c in SCHEMA.split(", ")]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

        def rows() -> Iterator[tuple]:
            for b in batches:
                for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    yield from packer.add(doc, words.of_text(text.as_py() or "") + end)
            yield from packer.flush()

        held, size = [], 0
        for row in rows():
            held.append(row)
            size += len(row[3]) + 64
            if size >= _BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types, strict=True)], names)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types, strict=True)], names)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, SCHEMA)
