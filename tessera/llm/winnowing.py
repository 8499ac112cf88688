"""Document fingerprints by winnowing.

Rolling hashes of all runs of ``K`` code points; from each window of ``W`` successive ones
the smallest is kept, the rightmost of equal ones, with its position.  Any run of
``K + W - 1`` code points that two texts share therefore gives both a common fingerprint
hash at corresponding positions, and no run under ``K`` gives one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, small_batches

K, W = 8, 16
_BASE = 0x5851F42D4C957F2D
_BASE_K = [np.uint64(pow(_BASE, 1 << i, 1 << 64)) for i in range(16)]
FINGERPRINTS = "doc_id long, n_chars long, hashes array<long>, positions array<int>"
PAIRS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
#: Output characters after which a batch is handed on.
BATCH_CHARS = 8_000_000


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(points: np.ndarray, k: int = K) -> np.ndarray:
    """32-bit hash of each run of ``k`` code points; of the whole text if it is shorter."""
    n = len(points)
    if n == 0:
        return np.empty(0, np.uint64)
    k = min(k, n)
    with np.errstate(over="ignore"):
        # Runs of 1, 2, 4, ... code points by doubling; a run of k joins those of its binary digits.
        power = points.astype(np.uint64) + np.uint64(1)
        run, length, bit = None, 0, 0
        while True:
            if k >> bit & 1:
                if run is None:
                    run, length = power, 1 << bit
                else:  # the longer run on the left, shifted by this one's length
                    m = n - length - (1 << bit) + 1
                    run = power[:m] * np.uint64(pow(_BASE, length, 1 << 64)) + run[(1 << bit):(1 << bit) + m]
                    length += 1 << bit
            bit += 1
            if 1 << bit > k:
                break
            half = 1 << (bit - 1)
            power = power[:-half] * _BASE_K[bit - 1] + power[half:]
        return mix(run + np.uint64(k)) >> np.uint64(32)


def winnow(points: np.ndarray, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) kept from a text, positions ascending."""
    h = gram_hashes(points, k)
    n = len(h)
    if n == 0:
        return np.empty(0, np.uint32), np.empty(0, np.uint32)
    # The hash above, the position below and turned about: the least is the rightmost of equal hashes.
    key = (h << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - np.arange(n, dtype=np.uint64))
    span, size = 1, min(w, n)
    while span * 2 <= size:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    if span < size:
        key = np.minimum(key[:len(key) - (size - span)], key[size - span:])
    kept = key[np.r_[True, key[1:] != key[:-1]]] if len(key) else key
    return (kept >> np.uint64(32)).astype(np.uint32), (np.uint64(0xFFFFFFFF) - (kept & np.uint64(0xFFFFFFFF))).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of hashes; 1 for two empty ones."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def as_text(hashes: np.ndarray, positions: np.ndarray) -> str:
    """Sixteen hex digits for each kept hash: eight of the hash, eight of its position."""
    return np.stack([hashes, positions], 1).astype(">u4").tobytes().hex()


def fingerprint(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = K, w: int = W) -> DataFrame:
    """Kept hashes and their positions (code points) of every row's whole text; no shuffle.

    A null or empty text keeps none; a text under ``k`` code points keeps the hash of itself.
    Null ids stay, equal rows give equal rows, an empty table none; other columns play no part.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = [code_points(t or "") for t in batch.column(1).to_pylist()]
            kept = [winnow(p, k, w) for p in points]
            yield pa.record_batch([batch.column(0), pa.array([len(p) for p in points], pa.int64()),
                                   pa.array([h.astype(np.int64) for h, _ in kept], pa.list_(pa.int64())),
                                   pa.array([p.astype(np.int32) for _, p in kept], pa.list_(pa.int32()))],
                                  names=["doc_id", "n_chars", "hashes", "positions"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, FINGERPRINTS)


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text) rows in ranges of the id, sorted, each range followed by the first row
    of the next one (``guest``), the last range by the very first row.

    Spark's range partitioning of the ids alone gives the bounds: the first id of each range,
    which a task finds by binary search.  Every text is shuffled once, and no task sees more
    than its ranges.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select("doc_id").filter("doc_id is not null").repartitionByRange(4 * parts, "doc_id")
    firsts = sorted(r["head"] for r in ids.groupBy(F.spark_partition_id().alias("range")).agg(F.min("doc_id").alias("head")).collect())  # one row for each range
    bounds = np.array(firsts, np.int64)

    @F.pandas_udf("int")
    def after(doc_id: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, doc_id.to_numpy(np.int64), "right").astype(np.int32))

    placed = docs.withColumn("range", F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(after(F.coalesce("doc_id", F.lit(0)))))
    ranges = list(enumerate(firsts, 1))
    if docs.filter("doc_id is null").limit(1).count():
        ranges.insert(0, (0, None))
    if not ranges:
        return placed.withColumn("guest", F.lit(False))
    before = [ranges[-1][0], *[r for r, _ in ranges[:-1]]]
    heads = spark.createDataFrame([(r, head, b) for (r, head), b in zip(ranges, before)], "range int, head long, host int")
    heads = placed.join(F.broadcast(heads), "range").filter(F.col("doc_id").eqNullSafe(F.col("head")))
    # Rows of one id: the smallest text comes first.
    heads = heads.groupBy("host").agg(F.min(F.struct("doc_id", "text")).alias("row"))
    rows = placed.withColumn("guest", F.lit(False)).select("doc_id", "text", "range", "guest").unionAll(
        heads.select("row.doc_id", "row.text", F.col("host").alias("range"), F.lit(True).alias("guest")))
    return rows.repartition(parts, "range").sortWithinPartitions("range", "guest", "doc_id", "text")


def edits(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = K, w: int = W) -> DataFrame:
    """Each text's fingerprint beside that of its edited text and of the next document.

    The next document: in ascending id, after the last the first; null ids come first, rows
    of one id go by text.  Edited: the last quarter (rounded down) of the code points gives
    way to as many first ones of the next document, or all of them.  ``near_*``: Jaccard
    similarity of the kept hashes.  A null text is empty; two empty fingerprints are alike;
    a lone document is its own next; an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, chars, held = [], 0, None

        def take() -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[f.split()[0] for f in PAIRS.split(", ")])

        for batch in batches:
            for i in range(batch.num_rows):
                doc_id, text, place, guest = (batch.column(c)[i].as_py() for c in range(4))
                text = text or ""
                points = code_points(text)
                kept = winnow(points, k, w)
                if held is not None and held[0] == place:
                    _, own_id, own_text, own_points, own_kept = held
                    cut = len(own_points) // 4
                    edited = own_text[:len(own_points) - cut] + text[:cut]
                    changed = winnow(np.concatenate([own_points[:len(own_points) - cut], points[:cut]]), k, w)
                    rows.append((own_id, len(own_points), hashlib.sha256(edited.encode()).hexdigest(), as_text(*own_kept), as_text(*changed),
                                 likeness(own_kept[0], changed[0]), likeness(own_kept[0], kept[0])))
                    chars += 32 * len(own_kept[0]) + 200
                held = None if guest else (place, doc_id, text, points, kept)
                if chars > BATCH_CHARS:
                    yield take()
                    rows, chars = [], 0
        if rows:
            yield take()

    small_batches(docs.sparkSession)
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return with_next(chosen).select("doc_id", "text", "range", "guest").mapInArrow(run, PAIRS)
