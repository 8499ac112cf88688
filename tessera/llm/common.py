"""Helpers shared by the training-data operators: the shared folder, Arrow text
buffers, word and shingle hashes in numpy."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one step inside a task handles at once (a longer text is one step).
STEP_BYTES = 500_000

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a private one only on a local master that names none."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tessera-llm-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` as a table in the shared folder: later steps read files, no lineage is left."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python 1,000 rows at a time: a task then holds a few MB of them, not 10,000 rows' worth."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_crc(col: str = "doc_id"):
    """crc32 of the id as decimal text: the folds of the language and scoring queries."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


# --- Arrow text ---------------------------------------------------------------


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text has no bytes.  No copy."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    if len(column) == 0 or off is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def steps(offsets: np.ndarray, most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` bytes together, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


# --- words --------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = x ^ (x >> np.uint64(30))
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _powers or len(_powers["p"]) < n:
        size = max(n, STEP_BYTES + 65_536)
        p, q = np.empty(size, np.uint64), np.empty(size, np.uint64)
        with np.errstate(over="ignore"):
            p[0] = q[0] = 1
            p[1:], q[1:] = np.uint64(_P), np.uint64(_P_INV)
            np.multiply.accumulate(p, out=p)
            np.multiply.accumulate(q, out=q)
        if size > 4 * STEP_BYTES:  # one very long text: do not keep its tables
            return p, q
        _powers["p"], _powers["q"] = p, q
    return _powers["p"], _powers["q"]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word, offsets of the words by row).

    A word is a longest run of bytes other than space and \\x09-\\x0D, A-Z lower-cased;
    none crosses from one row into the next.
    """
    return words_at(raw, offsets)[:2]


def words_at(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """:func:`word_hashes`, and the first byte of each word and the one after its last (from the first row's start)."""
    base = offsets[0]
    raw, offsets = raw[base:offsets[-1]], offsets - base
    n = len(raw)
    if n == 0:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    inside = ~_SPACE[raw]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    begin[first] = inside[first]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    end[last] = inside[last]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return spans(_LOWER[raw], starts, ends), np.searchsorted(starts, offsets).astype(np.int64), starts, ends


def spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range."""
    n = len(raw)
    p, q = _power(n + 1)
    with np.errstate(over="ignore"):
        total = np.empty(n + 1, np.uint64)
        total[0] = 0
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * p[:n], out=total[1:])
        return mix((total[ends] - total[starts]) * q[starts] + (ends - starts).astype(np.uint64))


_STEP = [np.uint64(x) for x in (1, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165)]


def shingles(words: np.ndarray, offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each run of ``size`` words, offsets by row); a row with fewer words,
    but at least one, has one shingle of all its words."""
    counts = np.diff(offsets)
    out = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    new = np.zeros(len(offsets), np.int64)
    np.cumsum(out, out=new[1:])
    if new[-1] == 0:
        return np.empty(0, np.uint64), new
    row = np.repeat(np.arange(len(counts)), out)
    at = np.arange(new[-1]) - new[row] + offsets[row]
    with np.errstate(over="ignore"):
        padded = np.concatenate([words, np.zeros(size, np.uint64)])
        h = padded[at].copy()
        for j in range(1, size):
            inside = at + j < offsets[row + 1]
            h += np.where(inside, padded[at + j], np.uint64(j)) * _STEP[j]
        return mix(h), new
