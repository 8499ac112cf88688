"""Harmonic packing of tokenised documents into fixed-length training sequences.

Lengths fall into reciprocal-capacity classes: class ``k`` takes pieces of more than
``capacity/(k+1)`` and at most ``capacity/k`` ids, and each of its bins takes exactly
``k`` of them.  Every task fills the bins of its own rows, so nothing is shuffled and no
task waits for another.  A document is first cut into whole bins (class 1); its rest stays
in one piece if a bin of ``k`` such pieces has little padding, and is cut at the next
reciprocal ``capacity//(k+1)`` otherwise.  What the open bins of a task hold at its end is
laid end to end, cut into whole sequences and a last run of powers of two, none padded.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import Store
from .common import buffers, small_batches, steps

CAPACITY = 2048
END_ID = 1
#: A bin of class k is left with this share of padding at most, else the piece is cut.
PAD_SHARE = 1 / 64
#: Words whose ids a task keeps at hand; the store is emptied beyond that, between steps.
CACHE_WORDS = 500_000
#: New chunks that are encoded at once.
PART_WORDS = 50_000
#: Sequences that one task can number.
SEQUENCE_BITS = 33

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, sequence_length long"

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MARK, _ASCII = np.zeros(256, bool), np.zeros(256, bool)
_MARK[[ord("."), ord(",")]] = True
_ASCII[[*range(65, 91), *range(97, 123)]] = True
_LETTERS = re.compile("[a-zÀ-ÖØ-öø-ÿ]+")


class WordIds:
    """Ids of texts by one tokenizer file, kept by chunk between blanks.

    A blank always parts the tokenizer's words, so a text's ids are its chunks' ids in
    turn.  Plain words (Latin letters) skip the tokenizer's own normalising and splitting.
    """

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_file(file)
        self.model = Tokenizer.from_file(file)
        self.model.normalizer = normalizers.Sequence([])
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.whole.get_vocab(with_added_tokens=False)
        ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            ends[i] = token.endswith("</w>")
        self.ends = ends
        # The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for 256 and on.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in printable]
        sign = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(other)}
        self.signs = {c: "".join(sign[b] for b in chr(c).encode()) for c in range(0x80, 0x180)}
        self.plain: dict[str, bytes] = {}
        self.chunks = Store(self._flat)

    def _add_plain(self, words: list[str]) -> dict[str, bytes]:
        """Ids of the plain words, also kept in the store as far as it has room."""
        out: dict[str, bytes] = {}
        for i in range(0, len(words), 256):
            part = words[i:i + 256]
            ids = np.array(self.model.encode_batch_fast([" ".join(part).translate(self.signs)], add_special_tokens=False)[0].ids, np.uint32)
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) == len(part):
                at, raw = 0, ids.tobytes()
                for word, to in zip(part, (cut * 4).tolist()):
                    out[word] = raw[at:to]
                    at = to
            else:
                for word in part:
                    out[word] = self._whole(word)
        if len(self.plain) + len(out) > CACHE_WORDS:
            self.plain.clear()
        if len(out) <= CACHE_WORDS:
            self.plain.update(out)
        return out

    def _whole(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def _encode(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of each chunk."""
        out: dict[str, bytes] = {}
        low, rest = {}, []
        for chunk in chunks:
            if _LETTERS.fullmatch(lower := chunk.lower()):
                low[chunk] = lower
            else:
                rest.append(chunk)
        words = set(low.values())
        plain = {w: self.plain[w] for w in words if w in self.plain}
        if new := sorted(words - plain.keys()):
            plain |= self._add_plain(new)
        out.update((chunk, plain[w]) for chunk, w in low.items())
        if rest:
            for chunk, encoded in zip(rest, self.whole.encode_batch_fast(rest, add_special_tokens=False)):
                out[chunk] = np.array(encoded.ids, np.uint32).tobytes()
        return out

    def _flat(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the chunks end to end, how many each has)."""
        ids: list[bytes] = []
        for i in range(0, len(chunks), PART_WORDS):
            part = chunks[i:i + PART_WORDS]
            found = self._encode(part)
            ids += [found[c] for c in part]
        return np.frombuffer(b"".join(ids), np.uint32), np.array([len(x) for x in ids], np.int64) // 4

    def flat(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets by row) of the rows' texts in ``raw``."""
        self.chunks.most = CACHE_WORDS
        if not ((raw[:-1] == ord("<")) & (raw[1:] == ord("|"))).any():  # special tokens are told by case, nothing else is
            raw = _LOWER[raw]
        inside = ~_BLANK[raw]
        begin, end = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        some = offsets[:-1] < offsets[1:]
        first, last = offsets[:-1][some], offsets[1:][some] - 1
        begin[first], end[last] = inside[first], inside[last]
        # A mark that ends a chunk after a plain letter is a word of its own.
        mark = end & _MARK[raw] & ~begin
        mark[1:] &= _ASCII[raw[:-1]]
        begin |= mark
        end[:-1] |= mark[1:]
        starts = np.flatnonzero(begin)
        ids, many = self.chunks(raw, starts, np.flatnonzero(end) + 1)
        return ids, np.concatenate([[0], np.cumsum(many)])[np.searchsorted(starts, offsets)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        ids, at = self.flat(*buffers(pa.array(texts, pa.string())))
        data = ids.tobytes()
        return [data[4 * a:4 * b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


_by_file: dict[str, WordIds] = {}


def word_ids(file: str) -> WordIds:
    if file not in _by_file:
        _by_file[file] = WordIds(file)
    return _by_file[file]


def cut(length: int, capacity: int, pad_share: float = PAD_SHARE) -> list[tuple[int, int]]:
    """(length, class) of the pieces of ``length`` ids, whole bins first."""
    pieces = [(capacity, 1)] * (length // capacity)
    rest = length % capacity
    while rest:
        k = capacity // rest
        if capacity - k * rest <= pad_share * capacity:
            return [*pieces, (rest, k)]
        take = capacity // (k + 1)
        pieces.append((take, k + 1))
        rest -= take
    return pieces


class Bins:
    """The open bins of one task."""

    def __init__(self, capacity: int, first_id: int, pad_share: float):
        self.capacity, self.next_id, self.pad_share = capacity, first_id, pad_share
        self.open: dict[int, list] = {}
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: bytes) -> None:
        total, at = len(ids) // 4, 0
        for length, k in cut(total, self.capacity, self.pad_share):
            piece = (doc_id, at, ids[4 * at:4 * (at + length)], total)
            at += length
            held = self.open.setdefault(k, [])
            held.append(piece)
            if len(held) == k:
                self._close(held)
                del self.open[k]

    def _close(self, pieces: list[tuple]) -> None:
        used, offset = sum(len(p[2]) for p in pieces) // 4, 0
        for doc_id, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc_id, start, n, ids, total, self.next_id, offset, used))
            offset += n
        self.next_id += 1

    def end(self) -> None:
        """Lay the pieces of all open bins end to end; cut at the capacity, at last at powers of two."""
        left = [p for k in sorted(self.open) for p in self.open[k]]
        self.open = {}
        total = sum(len(p[2]) for p in left) // 4
        room, held = 0, []
        for doc_id, start, ids, n in left:
            while ids:
                if not room:
                    room = self.capacity if total >= self.capacity else 1 << (total.bit_length() - 1)
                    total -= room
                take = min(room, len(ids) // 4)
                held.append((doc_id, start, ids[:4 * take], n))
                start, ids, room = start + take, ids[4 * take:], room - take
                if not room:
                    self._close(held)
                    held = []

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [()] * 8
        types = [pa.binary() if i == 3 else pa.int64() for i in range(8)]
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        self.rows = []
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def pack(docs: DataFrame, tokenizer_file: str, *, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID, pad_share: float = PAD_SHARE) -> DataFrame:
    """Pack every row of ``docs``; one row per piece, columns as in :data:`SCHEMA`.

    ``ids``: the piece's ids, little-endian unsigned 32-bit.  ``sequence_length``: ids in
    its sequence.  Sequences belong to one task each; their ids hold its number.

    A null or empty text is the end id alone; a null document id stays null; equal rows are
    packed one by one; an empty table gives no rows.  Other columns of ``docs``, whatever
    their names, play no part.  Memory of a task: the ids of one document, one step of text,
    the open bins (at most ``capacity`` ids for each class met) and the word store.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(tokenizer_file)
        bins = Bins(capacity, TaskContext.get().partitionId() << SEQUENCE_BITS, pad_share)
        end = np.array([end_id], np.uint32).tobytes()
        for batch in batches:
            raw, offsets = buffers(batch.column(1))
            doc_ids = batch.column(0).to_pylist()
            for i, j in steps(offsets):
                ids, at = encode.flat(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                data = ids.tobytes()
                for doc_id, a, b in zip(doc_ids[i:j], at[:-1].tolist(), at[1:].tolist()):
                    bins.add(doc_id, data[4 * a:4 * b] + end)
                if bins.rows:
                    yield bins.batch()
        bins.end()
        if bins.rows:
            yield bins.batch()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, SCHEMA)
