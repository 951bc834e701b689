"""Packing into sequences by Karmarkar-Karp multiway differencing.

Each document becomes ids and an end id. Whole windows are cut off first; what is left over is cut into pieces of
at most PIECE ids, which a task gathers, in the order it reads them, into blocks that fill WINDOWS sequences but
for SLACK ids each; the end of a block is cut finely. Differencing merges the partial partitions with the largest spreads, the large sums of one on
the small sums of the other, until one partition of near-equal windows is left. If a window is over capacity, the
block is dealt again into one window more. A task holds one block; nothing is shuffled.

Edge cases: a null or empty text is the end id alone; texts of any length are cut, and each id lies in exactly one
piece; null ids and repeated rows are packed like others; an empty table gives an empty result. Sequence ids are
unique and the same on each run over the same files, not consecutive.
"""

from __future__ import annotations

import functools
import heapq
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY, PIECE, WINDOWS, SLACK, END_ID = 2048, 512, 64, 8, 1
#: Pieces of the last fiftieth of a block: small sums that level what the large ones leave.
FINE = 16
#: Tokens whose ids a worker remembers at most.
REMEMBERED = 800_000
SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

_RANGE = [*map(chr, range(0x21, 0x7F)), *map(chr, range(0xA1, 0x130)), *map(chr, range(0x131, 0x1C0))]
_LETTERS = "".join(c for c in _RANGE if unicodedata.category(c)[0] == "L")
_NUMBERS = "".join(c for c in _RANGE if unicodedata.category(c)[0] == "N")
#: Texts of these characters only need no Unicode normalisation, and lower-case letter by letter.
_PLAIN = re.compile("[\t\n\r " + re.escape("".join(_RANGE)) + "]*")
#: The tokenizer file's own pattern for splitting text into words, over those characters.
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+")


#: Byte-level alphabet: a printable byte stands for itself, the others for the characters from U+0100 on.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTES = {b: chr(b) for b in _SHOWN} | {b: chr(0x100 + i) for i, b in enumerate(b for b in range(0x100) if b not in _SHOWN)}


class WordTokenizer:
    """The ids of a lower-casing word-level BPE file, as little-endian 32-bit bytes.

    No word of such a file spans white space, so the ids of a token between blanks are looked up once and remembered.
    Texts with characters outside _PLAIN, or with an added token's string, go through the tokenizer whole. Equal to
    it on any text: an added token's string has that token's id, as the file says.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _word(self, word: str) -> bytes:
        return b"".join([x.id.to_bytes(4, "little") for x in self.model.tokenize(word.encode().decode("latin-1").translate(_BYTES))])

    def _learn(self, tokens: list[str]) -> None:
        known = self.known
        for t in tokens:
            if t not in known:
                words = _SPLIT.findall(t)
                if words != [t]:
                    for w in words:
                        if w not in known:
                            known[w] = self._word(w)
                known[t] = self._word(t) if words == [t] else b"".join([known[w] for w in words])

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not _PLAIN.fullmatch(text) or any(x in text for x in self.special):
            return self._whole(text)
        tokens = text.lower().split()
        try:
            return b"".join([self.known[t] for t in tokens])
        except KeyError:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            self._learn(tokens)
            return b"".join([self.known[t] for t in tokens])


@functools.cache
def tokenizer_of(path: str) -> WordTokenizer:
    """One for each file and Python worker, which serves many tasks."""
    return WordTokenizer(path)


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Indices of sizes, dealt into k windows of near-equal sums.

    A partial partition is a list of (sum, indices), largest first, above a smallest sum of 0; windows that are
    still empty are left out.
    """
    heap = [(-s, i, [(s, [i])]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    turn = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        if len(a) + len(b) <= k:
            merged = sorted(a + b, key=lambda x: -x[0])
        else:
            a = a + [(0, [])] * (k - len(a))
            b = b + [(0, [])] * (k - len(b))
            merged = sorted(((x + y, p + q) for (x, p), (y, q) in zip(a, reversed(b), strict=True)), key=lambda x: -x[0])
            least = merged[-1][0]
            merged = [(s - least, p) for s, p in merged]
        spread = merged[0][0] - (merged[-1][0] if len(merged) == k else 0)
        turn += 1
        heapq.heappush(heap, (-spread, turn, merged))
    return [p for _, p in heap[0][2]] if heap else []


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """As few windows as differencing finds room in; one more whenever one is over capacity."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        out = [w for w in difference(sizes, k) if w]
        if all(sum(sizes[i] for i in w) <= capacity for w in out):
            return out
        k += 1


def packed(docs: Iterator[tuple[object, bytes]], first: int, capacity: int = CAPACITY, piece: int = PIECE, per_block: int = WINDOWS, slack: int = SLACK) -> Iterator[tuple]:
    """(id, start, length, crc, doc_tokens, sequence_id, offset, ids) of each piece of (id, ids) pairs."""
    sequence = first
    block: list[tuple] = []
    held, full = 0, per_block * (capacity - slack)
    fine = full // 50

    def deal() -> Iterator[tuple]:
        nonlocal sequence, block, held
        for w in windows([len(x[2]) // 4 for x in block], capacity):
            offset = 0
            for i in sorted(w):
                key, start, ids, total = block[i]
                yield key, start, len(ids) // 4, zlib.crc32(ids), total, sequence, offset, ids
                offset += len(ids) // 4
            sequence += 1
        block, held = [], 0

    for key, ids in docs:
        total = len(ids) // 4
        at = 0
        for at in range(0, total - capacity + 1, capacity):
            part = ids[4 * at : 4 * (at + capacity)]
            yield key, at, capacity, zlib.crc32(part), total, sequence, 0, part
            sequence += 1
        at = total - total % capacity
        while at < total:
            n = min(piece if held < full - fine else FINE, total - at, full - held)
            block.append((key, at, ids[4 * at : 4 * (at + n)], total))
            at += n
            held += n
            if held == full:
                yield from deal()
    yield from deal()


def pack(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """key, SCHEMA and on request the ids of each piece (binary, little-endian 32-bit)."""
    rows = docs.select(F.col(key), F.col(text).alias("__text"))
    kind = rows.schema.fields[0].dataType.simpleString()
    names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(tokenizer_path)
        end = np.array([END_ID], dtype="<u4").tobytes()
        key_type = None

        def documents() -> Iterator[tuple[object, bytes]]:
            nonlocal key_type
            for b in batches:
                key_type = b.schema.field(0).type
                for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    yield k, tokenizer.encode(t) + end

        def batch(gathered: list[tuple]) -> pa.RecordBatch:
            kinds = [key_type, *[pa.int64()] * 6, *[pa.binary()] * with_ids]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*gathered, strict=True), kinds, strict=True)], names=names)

        gathered: list[tuple] = []
        for row in packed(documents(), TaskContext.get().partitionId() << 32):
            gathered.append(row if with_ids else row[:7])
            if len(gathered) >= (1_000 if with_ids else 20_000):
                yield batch(gathered)
                gathered = []
        if gathered:
            yield batch(gathered)

    return rows.mapInArrow(run, f"`{key}` {kind}, {SCHEMA}" + ", ids binary" * with_ids)
