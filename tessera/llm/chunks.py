"""Token ids of texts by chunk: a text is cut where the tokenizer always starts anew, each distinct
chunk is encoded once, and the ids of all chunks are gathered from one flat array."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np

from .common import spans

#: Chunks whose ids a task keeps; the store starts anew beyond that.
STORE_CHUNKS = 500_000

_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_GRAPHIC = np.zeros(256, bool)
_GRAPHIC[0x21:0x7F] = True


def byte_level_cuts(raw: np.ndarray) -> np.ndarray:
    """Places before which a byte-level tokenizer always starts a new word: a single space that
    stands before a printable ASCII character, or after one."""
    cut = raw == 32
    cut[:-1] &= _GRAPHIC[raw[1:]] | np.concatenate([[False], _GRAPHIC[raw[:-2]]]) if len(raw) > 1 else False
    cut[:1] = False
    cut[-1:] = False
    return cut


def ranges(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (many[0] numbers), first[1], ..."""
    return np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many - first, many)


class Store:
    """Ids of byte ranges.  ``encode``: distinct texts -> (flat ids, how many each has)."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int | None = None):
        self.encode, self.most = encode, most
        self.clear()

    def __len__(self) -> int:
        return len(self.hashes)

    def clear(self) -> None:
        self.hashes, self.checks = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.first, self.many, self.flat = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32)

    def __call__(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all ranges end to end, how many each has).  Two different ranges would have to agree in 128 bits of hash to be taken for one."""
        if not len(starts):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        h = spans(raw, starts, ends)
        check = spans(_OTHER[raw], starts, ends)
        distinct, index, inverse = np.unique(h, return_index=True, return_inverse=True)
        if (check != check[index][inverse]).any():
            both = np.stack([h, check], axis=1)
            _, index, inverse = np.unique(both, axis=0, return_index=True, return_inverse=True)
            return self._gather(*self._encoded(raw, starts[index], ends[index]), inverse.ravel())
        told = check[index]
        at = np.searchsorted(self.hashes, distinct)
        near = np.minimum(at, max(0, len(self.hashes) - 1))
        known = (self.hashes[near] == distinct) & (self.checks[near] == told) if len(self.hashes) else np.zeros(len(distinct), bool)
        first, many = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        first[known], many[known] = self.first[near[known]], self.many[near[known]]
        new = np.flatnonzero(~known)
        flat = self.flat
        if len(new):
            ids, counts = self._encoded(raw, starts[index[new]], ends[index[new]])[::2]
            first[new], many[new] = len(flat) + np.cumsum(counts) - counts, counts
            flat = np.concatenate([flat, ids])
            self._keep(distinct, told, first, many, known, flat)
        return self._gather(flat, first, many, inverse)

    def _encoded(self, raw, starts, ends) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data = raw.tobytes()
        ids, many = self.encode([data[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist())])
        return ids, np.cumsum(many) - many, many

    @staticmethod
    def _gather(flat, first, many, inverse) -> tuple[np.ndarray, np.ndarray]:
        many = many[inverse]
        return flat[ranges(first[inverse], many)], many

    def _keep(self, hashes, checks, first, many, known, flat) -> None:
        most = STORE_CHUNKS if self.most is None else self.most
        if len(self.hashes) + int((~known).sum()) > most:
            if len(hashes) > most:
                return self.clear()
            # The step's own chunks alone.
            self.hashes, self.checks, self.many = hashes, checks, many
            self.flat, self.first = flat[ranges(first, many)], np.cumsum(many) - many
            return None
        new = ~known
        hashes = np.concatenate([self.hashes, hashes[new]])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.checks = hashes[order], np.concatenate([self.checks, checks[new]])[order]
        self.first, self.many = np.concatenate([self.first, first[new]])[order], np.concatenate([self.many, many[new]])[order]
        self.flat = flat
        return None


#: Bytes in another order, for a second hash.
_OTHER = ((np.arange(256) * 167 + 91) % 256).astype(np.uint8)


#: Fixed value: how a byte-level BPE of this kind splits words.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Chunks of Latin text that do not touch each other when they are put end to end.
_LATIN = re.compile("(?!.*<\\|) [!-~¡-ɏ](?:[\\n!-~¡-ɏ]*[!-~¡-ɏ])?", re.S)


class ByteLevel:
    """Ids of whole texts by a byte-level BPE file whose words begin with at most one space.

    Latin chunks are merged by tiktoken from the file's own merges, many at a time, which is
    several times faster and gives the same ids; all others by the file's tokenizer.
    """

    #: Chunks that one call gets.
    CALL_CHUNKS = 2_000

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(file)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in printable)}
        model = json.loads(self.whole.to_str())["model"]
        vocabulary = {t: i for t, i in self.whole.get_vocab(with_added_tokens=False).items() if set(t) <= set(byte)}
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes[i] = len(token)
        merged = [vocabulary.get("".join(m if isinstance(m, list) else m.split(" ")), -1) for m in model["merges"]]
        self.merge = None
        if all(a < b for a, b in zip(merged[:-1], merged[1:])) and merged[0] >= 256:  # a lower id is an earlier merge
            ranks = {bytes(byte[c] for c in t): i for t, i in vocabulary.items() if len(t) == 1 or i >= merged[0]}
            self.merge = tiktoken.Encoding("file", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})
        self.store = Store(self.encode)

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [np.array(e.ids, np.uint32) for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate(ids) if ids else np.empty(0, np.uint32), np.array([len(x) for x in ids], np.int64)

    def _latin(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for i in range(0, len(texts), self.CALL_CHUNKS):
            part = texts[i:i + self.CALL_CHUNKS]
            ids = np.array(self.merge.encode_ordinary("".join(part)), np.uint32)
            to = np.cumsum([len(t.encode()) for t in part])
            ends = np.cumsum(self.bytes[ids])
            cut = np.searchsorted(ends, to)
            if len(ids) and ends[-1] == to[-1] and (ends[np.minimum(cut, len(ends) - 1)] == to).all():
                yield ids, np.diff(cut + 1, prepend=0)
            else:
                yield self._each(part)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        plain = np.array([self.merge is not None and _LATIN.fullmatch(t) is not None for t in texts], bool)
        first, many = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        flat, size = [], 0
        for which, runs in ((np.flatnonzero(plain), self._latin), (np.flatnonzero(~plain), lambda x: iter([self._each(x)] if x else []))):
            done = 0
            for ids, counts in runs([texts[i] for i in which.tolist()]):
                own = which[done:done + len(counts)]
                first[own], many[own] = size + np.cumsum(counts) - counts, counts
                flat.append(ids)
                size, done = size + len(ids), done + len(counts)
        flat = np.concatenate(flat) if flat else np.empty(0, np.uint32)
        return flat[ranges(first, many)], many

    def __call__(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets by row) of the rows' texts in ``raw``."""
        cut = byte_level_cuts(raw)
        cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(raw)) if len(starts) else starts
        ids, many = self.store(raw, starts, ends)
        upto = np.concatenate([[0], np.cumsum(many)])
        return ids, upto[np.searchsorted(starts, offsets)]


_by_file: dict[str, ByteLevel] = {}


def byte_level(file: str) -> ByteLevel:
    if file not in _by_file:
        _by_file[file] = ByteLevel(file)
    return _by_file[file]
