"""Embedding near-duplicates by binary codes under randomised rotations.

A vector is normalised and rotated by a random orthogonal matrix.  What is stored of it is its
code, the packed signs, with its correction factor ``<x, signs/sqrt(D)>``, and the rotated
vector in four bits a component.  For the four-bit form of another vector ``q``,
``<q, signs/sqrt(D)> / factor`` estimates ``<q, x>`` without bias (rounding is dithered), by
counting the common bits of the code and of the four bit planes.  Its error is about
``sqrt((1 - factor^2)/factor^2/(D - 1))``, and half a rounding step over the factor beside it.  A pair
is out when the upper confidence bound of either direction stays below the threshold, or that of the
product of both four-bit forms, whose rounding alone errs; only the others need their vectors, for
the cosine in double precision.

Candidates share a band of sign bits under one of several rotations.  At cosine 0.95 two
vectors differ in a sign with probability 0.101, so a band of ``b`` bits is shared with
probability 0.899^b; the number of bands follows from ``b`` and the wanted recall.  Buckets get
the codes alone.  The vectors follow in a second step, and only those of members with an
undecided pair in the bucket.  A pair that meets in several bands is counted in the first one
alone: under the first rotation the codes tell, under later ones the vectors.  So no list of
pairs is made, and every task returns sums and spanning links per vector.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components

THRESHOLD = 0.95
#: Missed share of pairs right at the threshold.
MISS = 1e-3
#: Standard errors of the confidence bound.
BOUND = 6.0
#: Members of a bucket that one task compares with as many others; larger buckets are dealt out in such blocks.
BLOCK = 2048
SEED = 11
#: Bits of a component of the rotated vector, and dithers that the rounding chooses from.
LEVELS, DITHERS = 4, 256
#: Members of a bucket on average, for vectors spread evenly: comparing codes is cheap, bands are not.
BUCKET = 128
_TASK = "vec_id long, mark long, n_links long, root long"
_MEMBER = "vec_id long, mark long, bucket long, side int, code binary"
#: Buckets up to this size are compared many at once; rows that a task takes together; pairs estimated at once.
SMALL, TASK_ROWS, PAIRS = 32, 20_000, 65_536
#: Buckets over BLOCK members are told to all tasks up to this many of them (24 bytes each), joined by shuffle beyond.
BROADCAST_BUCKETS = 200_000


def rotations(dimension: int, count: int, seed: int = SEED) -> list[np.ndarray]:
    """Random orthogonal matrices (QR of normal matrices)."""
    rng = np.random.default_rng(seed)
    return [np.linalg.qr(rng.standard_normal((dimension, dimension)))[0] for _ in range(count)]


def plan(rows: int, dimension: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int, int]:
    """(bits of a band, bands of a rotation, rotations): bits grow with the logarithm of the rows."""
    bits = int(min(max(6, round(math.log2(max(rows, 2) / BUCKET))), 48, dimension))
    share = (1 - math.acos(threshold) / math.pi) ** bits
    bands = math.ceil(math.log(miss) / math.log1p(-share))
    each = max(1, dimension // bits)
    return bits, each, math.ceil(bands / each)


def _keys(rotated: np.ndarray, bits: int, each: int) -> np.ndarray:
    """(n, each) band keys of one rotation's vectors."""
    weights = (np.int64(1) << np.arange(bits, dtype=np.int64))
    signs = (rotated[:, :bits * each] >= 0).reshape(len(rotated), each, bits)
    return (signs * weights).sum(axis=2)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each member's component, for links a-b between 0..n-1."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _unit(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = [np.array(v, np.float64).tobytes() for v in batch.column("x").to_pylist()]
        yield pa.record_batch([batch.column(c) for c in ("digest", "vec_id", "weight", "mark")] + [pa.array(x, pa.binary())], names=["digest", "vec_id", "weight", "mark", "x"])


def record(dimension: int) -> np.dtype:
    """What is stored of a vector: the sign words, the bit planes of the rotated vector, and the numbers of both."""
    words = -(-dimension // 64)
    return np.dtype([("code", "<u8", (words,)), ("planes", "<u8", (LEVELS, words)), ("factor", "<f4"), ("low", "<f4"), ("step", "<f4"), ("total", "<f4")])


def _packed(bits: np.ndarray) -> np.ndarray:
    """(n, words) of (n, D) booleans, bit i of the whole standing for component i."""
    n, d = bits.shape
    full = np.zeros((n, -(-d // 64) * 64), bool)
    full[:, :d] = bits
    return np.packbits(full, axis=1, bitorder="little").view("<u8")


def encode(x: np.ndarray, turn: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """The stored records of unit vectors; a vector's mark alone chooses its dither, so a rerun gives the same."""
    d = x.shape[1]
    rotated = x @ turn
    signs = rotated >= 0
    out = np.zeros(len(x), record(d))
    out["code"] = _packed(signs)
    out["factor"] = np.minimum(np.where(signs, rotated, -rotated).sum(axis=1) / math.sqrt(d), 1.0)
    low = rotated.min(axis=1)
    step = np.maximum((rotated.max(axis=1) - low) / (2**LEVELS - 1), 1e-12)
    dither = np.random.default_rng(SEED).random((DITHERS, d))[mark % DITHERS]
    level = np.clip(np.floor((rotated - low[:, None]) / step[:, None] + dither), 0, 2**LEVELS - 1).astype(np.uint8)
    for k in range(LEVELS):
        out["planes"][:, k] = _packed((level >> k) & 1 == 1)
    out["low"], out["step"], out["total"] = low, step, level.sum(axis=1)
    return out


def estimates(q: np.ndarray, o: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
    """(estimated cosine, confidence bound) of paired records: the four-bit form of ``q`` against the code of ``o``."""
    common = np.zeros(len(q), np.int64)
    for k in range(LEVELS):
        common += np.bitwise_count(q["planes"][:, k] & o["code"]).sum(axis=1, dtype=np.int64) << k
    ones = np.bitwise_count(o["code"]).sum(axis=1, dtype=np.int64)
    factor = o["factor"].astype(np.float64)
    step, low = q["step"].astype(np.float64), q["low"].astype(np.float64)
    # A sign is 2 bit - 1, a component low + step * level.
    product = low * (2 * ones - d) + step * (2 * common - q["total"])
    own = (1 - factor**2) / factor**2 / max(d - 1, 1)
    return product / math.sqrt(d) / factor, BOUND * np.sqrt(np.maximum(own, 0) + (step / 2 / factor) ** 2) + 1e-5


def finer_estimates(q: np.ndarray, o: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
    """(estimated cosine, confidence bound) of paired records from the four-bit forms of both."""
    common = np.zeros(len(q), np.int64)
    for k in range(LEVELS):
        for m in range(LEVELS):
            common += np.bitwise_count(q["planes"][:, k] & o["planes"][:, m]).sum(axis=1, dtype=np.int64) << (k + m)
    (low, step, total), (low2, step2, total2) = [[r[c].astype(np.float64) for c in ("low", "step", "total")] for r in (q, o)]
    value = d * low * low2 + low * step2 * total2 + low2 * step * total + step * step2 * common
    # Rounding errors of half a step on either side, and their product, which one dither for both makes one-sided.
    return value, BOUND / 2 * np.sqrt(step**2 + step2**2) + d / 4 * step * step2 + 1e-5


class Pairs:
    """The pairs of buckets that the stored records leave open."""

    def __init__(self, dimension: int, bits: int, each: int, threshold: float):
        self.dimension, self.bits, self.each, self.threshold = dimension, bits, each, threshold
        places = np.zeros((each, dimension), bool)
        for k in range(each):
            places[k, k * bits:(k + 1) * bits] = True
        self.masks = _packed(places)

    def open(self, records: np.ndarray, band: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of the pairs i-j that are not ruled out and share no earlier band of the first rotation."""
        kept = []
        for k in range(0, len(i), PAIRS):
            a, b = i[k:k + PAIRS], j[k:k + PAIRS]
            for left, right in ((0, 1), (1, 0)):
                p = (a, b)
                value, bound = estimates(records[p[left]], records[p[right]], self.dimension)
                near = value + bound >= self.threshold
                a, b = a[near], b[near]
            value, bound = finer_estimates(records[a], records[b], self.dimension)
            near = value + bound >= self.threshold
            a, b = a[near], b[near]
            differ = records["code"][a] ^ records["code"][b]
            fresh = np.ones(len(a), bool)
            for m in range(self.each):  # bands are numbered from the first rotation's on
                fresh &= (band[a] <= m) | ((differ & self.masks[m]) != 0).any(axis=1)
            kept.append((a[fresh], b[fresh]))
        return tuple(np.concatenate([p[k] for p in kept]) if kept else np.empty(0, np.int64) for k in (0, 1))

    def within(self, records: np.ndarray, bucket: np.ndarray, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Open pairs inside each bucket (rows sorted by it, side 0), or between its sides -1 and 1, in bounded parts."""
        band = bucket & 0xFFF
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        sizes = np.diff(np.r_[starts, len(bucket)])
        few = np.repeat(sizes <= SMALL, sizes)
        for gap in range(1, int(min(sizes.max(), SMALL))):
            i = np.flatnonzero(few[:-gap] & (bucket[:-gap] == bucket[gap:]) & ((side[:-gap] == 0) | (side[:-gap] != side[gap:])))
            yield self.open(records, band, i, i + gap)
        for at, size in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
            rows = np.arange(at, at + size)
            two = side[at] != 0
            left, right = (rows[side[rows] < 0], rows[side[rows] > 0]) if two else (rows, rows)
            for k in range(0, len(left), 256):
                i, j = np.repeat(left[k:k + 256], len(right)), np.tile(right, len(left[k:k + 256]))
                if not two:
                    i, j = i[i < j], j[i < j]
                yield self.open(records, band, i, j)


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole buckets of rows that come sorted by ``bucket``, about TASK_ROWS rows at a time."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < TASK_ROWS:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        bucket = table.column("bucket").to_numpy()
        other = np.flatnonzero(bucket != bucket[-1])
        cut = int(other[-1]) + 1 if len(other) else 0  # the last bucket may go on
        if cut:
            yield table.slice(0, cut)
        held, size = table.slice(cut).to_batches(), len(bucket) - cut
    if size:
        yield pa.Table.from_batches(held).combine_chunks()


def link_classes(vectors: DataFrame, dimension: int, rows: int, *, threshold: float = THRESHOLD, miss: float = MISS) -> DataFrame:
    """(vec_id, mark, n_links, root) parts: links between different vectors, counted once each,
    and spanning links; ``vectors``: vec_id, mark (tells vectors of one id apart), x (binary,
    doubles), weight (copies)."""
    bits, each, count = plan(rows, dimension, threshold, miss)
    turns = rotations(dimension, count)
    kind = record(dimension)

    def records(column: pa.ChunkedArray) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), kind)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                x, mark = _unit(part.column(2).to_pylist()), part.column(1).to_numpy()
                keys = np.concatenate([_keys(x @ t, bits, each) for t in turns], 1)
                stored = [r.tobytes() for r in encode(x, turns[0], mark)]
                yield pa.record_batch([part.column(0), part.column(1), pa.array(list(keys), pa.list_(pa.int64())), pa.array(stored, pa.binary())],
                                      names=["vec_id", "mark", "keys", "code"])

    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = Pairs(dimension, bits, each, threshold)
        for table in _by_bucket(batches):
            need = np.zeros(len(table), bool)
            for i, j in pairs.within(records(table.column("code")), table.column("bucket").to_numpy(), table.column("side").to_numpy()):
                need[i] = need[j] = True
            if need.any():
                yield from table.filter(pa.array(need)).to_batches()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = Pairs(dimension, bits, each, threshold)
        for table in _by_bucket(batches):
            ids, mark, weight, bucket, side = (table.column(c).to_numpy() for c in ("vec_id", "mark", "weight", "bucket", "side"))
            x = _unit(table.column("x").to_pylist())
            band = bucket & 0xFFF
            links = np.zeros(len(ids), np.int64)
            root = np.arange(len(ids))
            for i, j in pairs.within(records(table.column("code")), bucket, side):
                near = np.concatenate([np.einsum("ij,ij->i", x[i[k:k + PAIRS]], x[j[k:k + PAIRS]]) >= threshold for k in range(0, len(i), PAIRS)] or [np.empty(0, bool)])
                i, j = i[near], j[near]
                late = np.flatnonzero(band[i] >= each)
                if len(late):  # met under an earlier rotation?
                    told, at = np.unique(np.concatenate([i[late], j[late]]), return_inverse=True)
                    keys = np.concatenate([_keys(x[told] @ t, bits, each) for t in turns[:int(band[i[late]].max()) // each + 1]], 1)
                    a, b = at[:len(late)], at[len(late):]
                    met = np.zeros(len(late), bool)
                    for k in range(keys.shape[1]):
                        met |= (band[i[late]] > k) & (keys[a, k] == keys[b, k])
                    first = np.ones(len(i), bool)
                    first[late] = ~met
                    i, j = i[first], j[first]
                np.add.at(links, i, weight[j])
                np.add.at(links, j, weight[i])
                root = root[_roots(len(ids), np.concatenate([i, np.arange(len(ids))]), np.concatenate([j, root]))]
            hit = links > 0
            yield pa.record_batch([pa.array(ids[hit]), pa.array(mark[hit]), pa.array(links[hit]), pa.array(ids[root[hit]])], names=["vec_id", "mark", "n_links", "root"])

    stored = written(vectors.select("vec_id", "mark", "x").mapInArrow(code, "vec_id long, mark long, keys array<long>, code binary"), "rabitq-codes")
    sizes = stored.select(F.posexplode("keys").alias("band", "key")).groupBy("band", "key").agg(F.count(F.lit(1)).alias("size"))
    large = written(sizes.filter(F.col("size") > BLOCK).select("band", "key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "rabitq-large")
    members = stored.select("vec_id", "mark", "code", F.posexplode("keys").alias("band", "key"))
    members = members.join(F.broadcast(large) if large.count() <= BROADCAST_BUCKETS else large, ["band", "key"], "left")
    members = members.withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    members = members.withColumn("block", F.pmod(F.xxhash64("vec_id", "mark"), F.col("blocks")).cast("int"))
    # Block a meets block b in the task (a, b), a <= b; with one block there is one task.
    members = members.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    a, b = F.least("block", "with"), F.greatest("block", "with")
    # `bucket` names (band, key, a, b): the band in the low bits keeps those of two bands apart.
    bucket = F.shiftleft(F.xxhash64("key", a, b), 12).bitwiseOR(F.col("band").cast("long"))
    members = members.select("vec_id", "mark", bucket.alias("bucket"), F.signum(F.col("with") - F.col("block")).cast("int").alias("side"), "code")
    dealt = members.repartition("bucket").sortWithinPartitions("bucket")
    undecided = written(dealt.mapInArrow(leave, _MEMBER), "rabitq-open")
    full = undecided.join(vectors.select("vec_id", "mark", "x", "weight"), ["vec_id", "mark"])
    return full.repartition("bucket").sortWithinPartitions("bucket").select(
        "vec_id", "mark", "weight", "x", "bucket", "side", "code").mapInArrow(compare, _TASK)


def near_duplicates(table: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, miss: float = MISS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    Links join different rows whose vectors have cosine >= ``threshold``, equal vectors
    included; links below it never occur, and of those right at it a share ``miss`` may be
    missed.  A null, empty or zero vector and one with a null or non-finite component link
    with nothing; vectors of different lengths have no cosine and never link, and each length
    (few in a table) is compared by its own rotations.  Equal vectors are compared as
    one, with their number as weight.  A row with a null id counts by itself and is its own
    component (null); rows of one id are one vector each but share the id's component.  An
    empty table gives no rows.  Other columns play no part.
    """
    spark = table.sparkSession
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    good = F.expr("vec_id is not null and x is not null and size(x) > 0 and forall(x, e -> e is not null and not isnan(e) and abs(e) < double('infinity')) and exists(x, e -> e <> 0)")
    usable = rows.filter(F.coalesce(good, F.lit(False)))
    # Equal vectors by the digest of their components (-0.0 is 0.0).
    same = usable.withColumn("x", F.transform("x", lambda e: e + F.lit(0.0)))
    same = same.withColumn("digest", F.sha2(F.array_join(F.transform("x", lambda e: e.cast("string")), ","), 256))
    members = written(same.select("vec_id", "digest"), "rabitq-members")
    classes = same.groupBy("digest").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("weight"), F.first("x").alias("x"))
    classes = classes.withColumn("mark", F.conv(F.substring("digest", 1, 15), 16, 10).cast("long"))
    classes = written(classes.mapInArrow(_as_bytes, "digest string, vec_id long, weight long, mark long, x binary"), "rabitq-classes")
    lengths = classes.groupBy((F.length("x") / 8).cast("int").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy("n").collect()
    linked_parts = spark.createDataFrame([], _TASK)
    for r in lengths:
        own = classes if len(lengths) == 1 else classes.filter(F.length("x") == 8 * r["n"])
        linked_parts = linked_parts.unionAll(link_classes(own, r["n"], r["rows"], threshold=threshold, miss=miss))
    parts = written(linked_parts, "rabitq-parts")
    linked = parts.groupBy("vec_id", "mark").agg(F.sum("n_links").alias("others"))
    of_class = components(parts.select(F.col("vec_id").alias("u"), F.col("root").alias("v"))).withColumnRenamed("node", "vec_id")
    told = classes.select("digest", "vec_id", "mark", "weight").join(linked, ["vec_id", "mark"], "left").join(of_class, "vec_id", "left")
    told = told.select("digest", (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    found = members.join(told, "digest").select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    rest = rows.filter(~F.coalesce(good, F.lit(False)))
    return found.unionAll(rest.select("vec_id", F.lit(0).cast("long"), F.col("vec_id"), F.lit(True)))
