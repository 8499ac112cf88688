"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

A shingle is five words; its weight in a document is its count there times its inverse
document frequency.  Each of ``SAMPLES`` weighted samples picks the same (shingle, level) in
two documents with a probability equal to their weighted Jaccard similarity.  Samples are
banded; documents that share a band and agree in enough samples are joined to clusters,
and inside a cluster the similarity itself is computed on whole texts until every pair
that can reach the threshold is either linked, already in one class, or refused.
A group of copies must not hide its own members: what many copies of one text hold is rare but for
them.  So the rows of one class of a cluster then count once for the frequency, and the pairs left are
compared again, until no link is new.  Every link of the plain frequencies stays.  Shingles in at
least ``COMMON`` of all rows are common text, whoever holds them: their frequency stays too.

The frequency is that of every shingle: ``idf = 1 + ln((1 + N)/(1 + df))``, N rows, df of which
hold it (the smoothed form: what many rows hold still counts).
Shingles are dealt by hash in slices; each slice counts its own and hands back, by text, those
that another text holds too.  What a text holds alone meets nothing in any other text, so for
the similarity only its weight counts: it stays in the vector as one entry of the text's own.
A text that shares less than the threshold's part of its shingles is near to none and ends here.
Shingles in at least ``COMMON`` of all rows, too many entries for one slice, are counted
beforehand, exactly: what reaches a share of all documents reaches it in some block of them;
the blocks' candidates are counted over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buffers, mix, shingles, small_batches, steps, word_hashes, written
from .components import components

SIMILARITY, WORDS = 0.8, 5
#: 12 bands of 3: a pair at 0.8 shares none with probability (1 - 0.8^3)^12 = 0.0002.
BANDS, ROWS = 12, 3
SAMPLES = BANDS * ROWS
#: Samples (of 36) in which a pair must agree; at 0.8 fewer agree with probability 0.0002.
AGREE = 19
#: Share of all documents from which a shingle is counted before the others; its entries then need not meet in a task.
COMMON = 0.02
#: Bytes of text whose shingles (about one for six bytes) one slice counts; shingles that a task deals out together.
SLICE_BYTES, DEAL = 12_000_000, 500_000
#: Parts, by hash, in which a task counts a slice's shingles one after the other: it holds the sorted copies of one part.
PARTS = 8
#: Documents whose frequent shingles are looked for together (a task's last block: up to twice as many); candidates that one counting pass holds.
DF_BLOCK, DF_CANDIDATES = 512, 1_000_000
#: Members that one task compares with as many others, by samples and by text; entries of these texts; rows taken together.
BUCKET_BLOCK, TEXT_BLOCK, TEXT_ENTRIES, TASK_ROWS, TEXT_ROWS = 2048, 1024, 500_000, 16_384, 256
#: A text of at least one in this many rows is a hot group of copies.
HOT = 1000
SEED = 29


# --- weights ------------------------------------------------------------------


def document_shingles(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, distinct shingles, their counts) of each row's text."""
    raw, offsets = buffers(batch.column(column))
    for i, j in steps(offsets):
        words, word_at = word_hashes(raw, offsets[i:j + 1])
        found, at = shingles(words, word_at, WORDS)
        for k in range(i, j):
            yield k, *np.unique(found[at[k - i]:at[k - i + 1]], return_counts=True)


def frequent_shingles(texts: DataFrame, rows: int, common: float = 0) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, document frequencies) of the shingles in at least ``common`` of all rows, and in two.

    The driver gets them all: without a share, a helper for small tables.
    """
    least = max(2, common * rows)

    def often(block: list[np.ndarray]) -> pa.RecordBatch:
        value, n = np.unique(np.concatenate(block), return_counts=True)
        return pa.record_batch([pa.array(value[n >= common * len(block)].view(np.int64))], names=["shingle"])

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Blocks run on over batches and the last takes up the rest: in a block of a few
        # documents every shingle would be a candidate.
        held: list[np.ndarray] = []
        for batch in batches:
            for _, found, _ in document_shingles(batch, 0):
                held.append(found)
                if len(held) == 2 * DF_BLOCK:
                    yield often(held[:DF_BLOCK])
                    held = held[DF_BLOCK:]
        if held:
            yield often(held)

    found = written(texts.mapInArrow(candidates, "shingle long").distinct(), "shingle-candidates")
    slices = -(-found.count() // DF_CANDIDATES)
    kept: list[tuple[int, int]] = []
    for part in range(slices):
        chosen = found.filter(F.pmod("shingle", F.lit(slices)) == part)
        wanted = np.sort(np.array([r[0] for r in chosen.collect()], np.int64).view(np.uint64))

        def count(batches: Iterator[pa.RecordBatch], wanted: np.ndarray = wanted) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(wanted), np.int64)
            for batch in batches:
                for _, one, _ in document_shingles(batch, 0):
                    at = np.searchsorted(wanted, one)
                    at[at == len(wanted)] = 0
                    total[at[wanted[at] == one]] += 1
            hit = total > 0
            yield pa.record_batch([pa.array(wanted[hit].view(np.int64)), pa.array(total[hit])], names=["shingle", "df"])

        counted = texts.mapInArrow(count, "shingle long, df long").groupBy("shingle").agg(F.sum("df").alias("df")).filter(F.col("df") >= least)
        kept += [(r["shingle"], r["df"]) for r in counted.collect()]  # at most (mean shingles)/common of them
    hashes = np.array([k for k, _ in kept], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.array([n for _, n in kept], np.int64)[order]


class Weights:
    """TF-IDF weights of a document's distinct shingles; those without a frequency are in one row alone."""

    def __init__(self, frequent: np.ndarray, df: np.ndarray, rows: int):
        self.frequent, self.rare = frequent, idf(1, rows)
        self.idf = idf(df, rows)

    def __call__(self, found: np.ndarray, count: np.ndarray) -> np.ndarray:
        weight = count * self.rare
        at, hit = self.find(found)
        weight[hit] = count[hit] * self.idf[at]
        return weight

    def find(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places among the frequent of those that are, which are)."""
        if not len(self.frequent):
            return np.empty(0, np.int64), np.zeros(len(found), bool)
        at = np.searchsorted(self.frequent, found)
        at[at == len(self.frequent)] = 0
        hit = self.frequent[at] == found
        return at[hit], hit


def idf(df, rows: int):
    return 1 + np.log((1 + rows) / (1 + df))


_PARTS = ["keys", "sizes", "totals", "copies", "hashes", "counts"]
_TYPES = [np.int64, np.uint32, np.uint32, np.uint32, np.uint8, np.uint32]
#: Of a hash, the bits that name it within its slice; the bits above choose the slice.
LOW = 48
#: Bits of a document frequency where it stands below a count in one number.
DF_BITS = 36


def deal(weights: Weights, slices: int):
    """Rows (key, text) to rows (slice, ...): of each text, the shingles that fall in the slice.

    A slice's row holds the texts' keys, their numbers of shingles there and altogether, how often
    the text is among those dealt together, then the shingles (six bytes each) and their counts.
    Slices from ``slices`` on hold frequent shingles, by text, as places among the frequent.
    """
    def rows_of(texts: dict[int, list]) -> pa.RecordBatch:
        keys = np.fromiter(texts, np.int64, len(texts))
        found, count, copies = zip(*texts.values())
        sizes = np.array([len(f) for f in found])
        totals, doc = np.array([c.sum() for c in count]), np.repeat(np.arange(len(keys)), sizes)
        found, count, copies = np.concatenate(found), np.concatenate(count), np.array(copies)
        part = ((found >> np.uint64(LOW)) % np.uint64(slices)).astype(np.int32)
        at, hit = weights.find(found)
        part[hit] = slices + keys[doc[hit]] % slices
        found[hit] = at
        order = np.argsort(part, kind="stable")
        part, doc, found, count = part[order], doc[order], found[order], count[order]
        new = np.r_[True, part[1:] != part[:-1]]
        run = np.flatnonzero(new | np.r_[True, doc[1:] != doc[:-1]])
        at, run_at = np.flatnonzero(new), np.flatnonzero(new[run])
        of = doc[run]
        runs = [keys[of], np.diff(np.r_[run, len(doc)]), totals[of], copies[of]]
        cuts = [np.r_[run_at, len(run)]] * 4 + [np.r_[at, len(part)]] * 2
        bytes_ = found.view(np.uint8).reshape(-1, 8)[:, :LOW // 8]
        columns = [pa.array([v[i:j].tobytes() for i, j in zip(cut, cut[1:])], pa.binary())
                   for cut, v in zip(cuts, (v.astype(t) for v, t in zip([*runs, bytes_, count], _TYPES)))]
        return pa.record_batch([pa.array(part[at], pa.int64()), *columns], names=["slice", *_PARTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        size = 0
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for k, found, count in document_shingles(batch, 1):
                key = int(keys[k])
                if key in held:
                    held[key][2] += 1
                elif len(found):
                    held[key] = [found, count, 1]
                    size += len(found)
                if size >= DEAL:
                    yield rows_of(held)
                    held, size = {}, 0
        if held:
            yield rows_of(held)

    return run


def counted(weights: Weights, slices: int, rows: int):
    """Rows (key, total, count, hash, weight) of a slice: of each text, the shingles there that another text holds too."""
    def shared(found: np.ndarray, count: np.ndarray, doc: np.ndarray, copies: np.ndarray, part: int) -> tuple[np.ndarray, ...]:
        """(text, count, hash, weight) of the shared ones among all entries of some hashes."""
        frequent = part >= slices
        order = np.argsort(found)
        found, count, doc, copies = found[order], count[order], doc[order], copies[order]
        start = np.flatnonzero(np.r_[True, found[1:] != found[:-1]])
        each = np.diff(np.r_[start, len(found)])
        several = np.repeat(each > 1, each) | frequent
        df = np.add.reduceat(copies, start, dtype=np.int64)[(each > 1) | frequent]
        found, count, doc = found[several], count[several], doc[several]
        value = weights.idf[found] if frequent else np.repeat(idf(df, rows), each[each > 1])
        found = weights.frequent[found] if frequent else found | np.uint64((part << LOW) % (1 << 64))
        order = np.lexsort((doc, found))
        found, count, doc, value = found[order], count[order], doc[order], value[order]
        other = np.r_[True, found[1:] != found[:-1]][:len(found)]
        first = other | np.r_[True, doc[1:] != doc[:-1]][:len(found)]
        found, count, doc, value, other = found[first], count[first], doc[first], value[first], other[first]
        start = np.flatnonzero(other)
        each = np.diff(np.r_[start, len(found)])
        keep = np.repeat(each > 1, each) | frequent
        return doc[keep], count[keep].astype(np.int64), found[keep].view(np.int64), count[keep] * value[keep]

    def run(table: pa.Table) -> pa.Table:
        part = table.column("slice")[0].as_py()
        keys, sizes, totals, copies, low, count = (np.concatenate([np.frombuffer(b.as_buffer(), t) for b in table.column(c)]) for c, t in zip(_PARTS, _TYPES))
        found = np.zeros(len(count), np.uint64)
        found.view(np.uint8).reshape(-1, 8)[:, :LOW // 8] = low.reshape(-1, LOW // 8)
        # One row per text and slice, whatever number of tasks dealt it.
        name, text = np.unique(keys, return_inverse=True)
        total = np.zeros(len(name), np.int64)
        total[text] = totals
        doc, copies = np.repeat(text.astype(np.int32), sizes), np.repeat(copies, sizes)
        del keys, text, totals, low
        which = (found % np.uint64(PARTS)).astype(np.uint8)
        told = []
        for k in range(PARTS):
            at = which == k
            if at.any():
                told.append(shared(found[at], count[at], doc[at], copies[at], part))
        doc, count, found, weight = map(np.concatenate, zip(*told))
        order = np.argsort(doc, kind="stable")
        columns = [name[doc], total[doc], count, found, weight]
        return pa.table([pa.array(c[order]) for c in columns], names=["key", "total", "count", "hash", "weight"])

    return run


def vectors(rows: DataFrame, reps: DataFrame, n: int, size: int, similarity: float) -> DataFrame:
    """(doc_id, copies, hashes, weights, counts) of each text in ``reps`` (doc_id, key, copies) that may be near to another.

    ``rows``: key, text, a 64-bit hash of the text and the text of all ``n`` rows, ``size`` bytes together.
    """
    weights = Weights(*frequent_shingles(rows.select("text"), n, COMMON), n)
    slices = 1 + size // SLICE_BYTES
    parts = rows.select("key", "text").mapInArrow(deal(weights, slices), "slice long, " + ", ".join(f"{c} binary" for c in _PARTS))
    parts = parts.repartition(2 * slices, "slice").groupBy("slice").applyInArrow(counted(weights, slices, n), "key long, total long, count long, hash long, weight double")
    # A shingle's count and frequency travel as one number, which packs better than its weight.
    df = F.rint((1.0 + n) / F.exp(F.col("weight") / F.col("count") - 1) - 1).cast("long")
    part = F.collect_list(F.struct("hash", F.shiftleft("count", DF_BITS).bitwiseOR(df).alias("held")))
    whole = parts.groupBy("key").agg(F.max("total").alias("total"), F.sum("count").alias("shared"), part.alias("part"))
    # A shared shingle weighs no more than one of the text's own, whatever rows count once.
    whole = whole.filter(F.col("shared") >= (similarity - 1e-9) * F.col("total")).withColumn("alone", (F.col("total") - F.col("shared")).cast("int"))
    told = whole.join(reps.hint("merge"), "key")
    held = F.shiftleft(F.col("alone").cast("long"), DF_BITS).bitwiseOR(F.col("copies"))
    told = told.select("doc_id", "copies", *[F.when(F.col("alone") > 0, F.concat(f"part.{c}", F.array(v))).otherwise(F.col(f"part.{c}")).alias(name)
                                             for name, c, v in (("hashes", "hash", F.col("key")), ("held", "held", held))])
    weights = F.transform("held", lambda h: F.shiftright(h, DF_BITS) * (1 + F.log((1.0 + n) / (1 + h.bitwiseAND(F.lit((1 << DF_BITS) - 1))))))
    return told.select("doc_id", "copies", "hashes", weights.alias("weights"), F.transform("held", lambda h: F.shiftright(h, DF_BITS).cast("int")).alias("counts"))


# --- samples ------------------------------------------------------------------


def _constants():
    rng = np.random.default_rng(SEED)
    odd = rng.integers(1 << 62, 1 << 63, SAMPLES, dtype=np.uint64) | np.uint64(1)
    # Quantiles of Gamma(2, 1): solve 1 - (1 + x) e^-x = q by bisection.
    q = (np.arange(4096) + 0.5) / 4096
    low, high = np.zeros(4096), np.full(4096, 40.0)
    for _ in range(60):
        mid = (low + high) / 2
        under = 1 - (1 + mid) * np.exp(-mid) < q
        low, high = np.where(under, mid, low), np.where(under, high, mid)
    return odd, low.astype(np.float32), (1 / low).astype(np.float32)


_ODD, _GAMMA, _GAMMA_INV = _constants()
_CHUNK = 1024


def samples(found: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """``SAMPLES`` 64-bit values, each standing for one sampled (shingle, level).

    For a shingle and a sample, r and c are Gamma(2, 1) and b uniform, all from the hash:
    t = floor(ln w / r + b), ln y = r (t - b), a = c / (y e^r); the least a is sampled.
    """
    best = np.full(SAMPLES, np.inf, np.float32)
    value = np.zeros(SAMPLES, np.uint64)
    log_w = np.log(weight).astype(np.float32)
    columns = np.arange(SAMPLES)
    with np.errstate(over="ignore"):
        for i in range(0, len(found), _CHUNK):
            z = found[i:i + _CHUNK, None] * _ODD
            z ^= z >> np.uint64(31)
            z *= np.uint64(0x94D049BB133111EB)
            z ^= z >> np.uint64(29)
            low = z.astype(np.uint32)
            high = (z >> np.uint64(32)).astype(np.uint32)
            which = (low & np.uint32(4095)).astype(np.intp)
            r = _GAMMA.take(which)
            b = (low >> np.uint32(12)).astype(np.float32) * np.float32(2**-20)
            u = ((high & np.uint32(65535)).astype(np.float32) + np.float32(0.5)) * ((high >> np.uint32(16)).astype(np.float32) + np.float32(0.5))
            t = np.floor(log_w[i:i + _CHUNK, None] * _GAMMA_INV.take(which) + b)
            a = np.log(-np.log(u * np.float32(2**-32))) - r * (t - b + np.float32(1))
            at = a.argmin(axis=0)
            least = a[at, columns]
            better = least < best
            best[better] = least[better]
            level = t[at, columns].astype(np.int64).view(np.uint64)
            value[better] = mix(found[i + at] + level * np.uint64(0x9E3779B97F4A7C15) + columns.astype(np.uint64))[better]
    return value


_MIXED = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def _lists(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes, weights) of each row."""
    hashes, weights = (batch.column(c).combine_chunks() if isinstance(batch, pa.Table) else batch.column(c) for c in ("hashes", "weights"))
    at = hashes.offsets.to_numpy() - hashes.offsets[0].as_py()
    found, weight = hashes.flatten().to_numpy().view(np.uint64), weights.flatten().to_numpy()
    for i, j in zip(at, at[1:]):
        yield found[i:j], weight[i:j]


def signatures(texts: DataFrame) -> DataFrame:
    """The rows (doc_id, copies, hashes, weights, counts) of ``texts``, with keys and agree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, marks = [], []
            for found, weight in _lists(batch):
                value = samples(found, weight)
                with np.errstate(over="ignore"):
                    band = mix((value.reshape(BANDS, ROWS) * _MIXED[:ROWS]).sum(axis=1) + np.arange(BANDS, dtype=np.uint64))
                keys.append(band.view(np.int64))
                marks.append((value >> np.uint64(40)).astype(np.uint8).tobytes())
            yield pa.record_batch([*batch.columns, pa.array(keys, pa.list_(pa.int64())), pa.array(marks, pa.binary())],
                                  names=[*batch.schema.names, "keys", "agree"])

    return texts.mapInArrow(run, "doc_id long, copies long, hashes array<long>, weights array<double>, counts array<int>, keys array<long>, agree binary")


# --- clusters and classes -----------------------------------------------------


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
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


def _whole_groups(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.Table]:
    """Tables of whole groups (rows sorted by ``column``), of about ``most`` rows."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for i in range(0, batch.num_rows, most):
            held.append(batch.slice(i, most))
            size += held[-1].num_rows
            if size < most:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            group = table.column(column).to_numpy()
            other = np.flatnonzero(group != group[-1])
            cut = int(other[-1]) + 1 if len(other) else 0  # the last group may go on
            if cut:
                yield table.slice(0, cut)
            held, size = table.slice(cut).to_batches(), len(group) - cut
    if size:
        yield pa.Table.from_batches(held).combine_chunks()


def _blocks(members: DataFrame, group: str, block: int) -> DataFrame:
    """(group, blocks) of the groups of two members or more; their ``entries``, if any, are bounded as well."""
    blocks = F.ceil(F.count(F.lit(1)) / block)
    if "entries" in members.columns:
        blocks = F.least(F.count(F.lit(1)), F.greatest(blocks, F.ceil(F.sum("entries") / TEXT_ENTRIES)))
    return members.groupBy(group).agg(F.count(F.lit(1)).alias("size"), blocks.cast("int").alias("blocks")).filter("size > 1").select(group, "blocks")


def _dealt(members: DataFrame, group: str, block: int, *carry: str) -> DataFrame:
    """``members`` in tasks (group, a, b) of at most ``2 * block`` rows or so: ``task`` names it, ``side`` is 0 or 1 for blocks a < b."""
    rows = members.join(_blocks(members, group, block), group)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.col("blocks")).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    task = F.xxhash64(group, F.least("block", "with"), F.greatest("block", "with"))
    return rows.select("doc_id", task.alias("task"), (F.col("block") > F.col("with")).cast("int").alias("side"), (F.col("blocks") == 1).alias("whole"), *carry)


def _agreeing(marks: np.ndarray, group: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one group (rows sorted by it), of the two sides if it has both, that agree in enough samples."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    found = []
    few = np.repeat(sizes <= 24, sizes)
    for gap in range(1, int(min(sizes.max(), 24))):
        i = np.flatnonzero(few[:-gap] & (group[:-gap] == group[gap:]))
        if not len(i):
            break
        i = i[(marks[i] == marks[i + gap]).sum(axis=1) >= AGREE]
        i = i[side[i] == 0] if not side.any() else i[(side[i] != side[i + gap]) | ~_two_sided(side, starts, sizes)[i]]
        found.append((i, i + gap))
    for at, size in zip(starts[sizes > 24], sizes[sizes > 24]):
        rows = np.arange(at, at + size)
        left, right = (rows[side[rows] == 0], rows[side[rows] == 1]) if side[rows].any() else (rows, rows)
        for k in range(0, len(left), 64):
            part = left[k:k + 64]
            same = np.zeros((len(part), len(right)), np.uint8)
            for s in range(marks.shape[1]):
                same += marks[part, s][:, None] == marks[right, s][None, :]
            i, j = np.nonzero(same >= AGREE)
            i, j = part[i], right[j]
            keep = i < j if right is left else i != j
            found.append((i[keep], j[keep]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _two_sided(side: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.repeat(np.add.reduceat(side, starts) > 0, sizes)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SAMPLES)


def cluster_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning links of the agreeing pairs of each bucket."""
    for table in _whole_groups(batches, "task", TASK_ROWS):
        ids, marks = table.column("doc_id").to_numpy(), _matrix(table.column("agree"))
        i, j = _agreeing(marks, table.column("task").to_numpy(), table.column("side").to_numpy())
        root = roots(len(ids), i, j)
        hit = root != np.arange(len(ids))
        yield pa.record_batch([pa.array(ids[hit]), pa.array(ids[root[hit]])], names=["u", "v"])


class _Texts:
    """Weighted Jaccard similarity among the documents of one task."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]]):
        self.at = np.cumsum([0] + [len(v[0]) for v in vectors])
        _, index = np.unique(np.concatenate([v[0] for v in vectors]), return_inverse=True)
        self.index = index
        self.dense = np.zeros(int(index.max()) + 1 if len(index) else 0)
        self.weigh(np.concatenate([v[1] for v in vectors]))

    def weigh(self, weight: np.ndarray) -> None:
        self.weight, self.total = weight, np.add.reduceat(weight, self.at[:-1])

    def surplus(self, group: np.ndarray, label: np.ndarray, copies: np.ndarray) -> np.ndarray:
        """For each entry, the rows by which it would be in fewer if those of one class (``label``) of the document's group counted once."""
        doc = np.repeat(np.arange(len(label)), np.diff(self.at))
        order = np.lexsort((label[doc], self.index, group[doc]))
        doc, index = doc[order], self.index[order]
        other = np.r_[True, (index[1:] != index[:-1]) | (group[doc[1:]] != group[doc[:-1]])]
        start = np.flatnonzero(other | np.r_[True, label[doc[1:]] != label[doc[:-1]]])
        which = np.cumsum(other) - 1
        less = np.bincount(which[start], weights=np.add.reduceat(copies[doc], start) - 1)
        out = np.empty(len(order))
        out[order] = less[which]
        return out

    def similarity(self, i: int, others: np.ndarray) -> np.ndarray:
        own = slice(self.at[i], self.at[i + 1])
        self.dense[self.index[own]] = self.weight[own]
        size = self.at[others + 1] - self.at[others]
        first = np.cumsum(size) - size
        rows = np.arange(size.sum()) + np.repeat(self.at[others] - first, size)
        both = np.add.reduceat(np.minimum(self.dense[self.index[rows]], self.weight[rows]), first)
        self.dense[self.index[own]] = 0
        return both / (self.total[i] + self.total[others] - both)


def _linked(texts: _Texts, label: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Each member's root, ``label`` before, once every pair a-b is linked, in one class already, or refused."""
    label = label.copy()
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    starts = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else []
    for s, e in zip(starts, [*starts[1:], len(a)]):
        i, others = int(a[s]), b[s:e]
        others = others[label[others] != label[i]]
        # Pairs far apart in total weight cannot reach the threshold.
        ratio = texts.total[others] / texts.total[i]
        others = others[(ratio >= threshold * 0.999) & (ratio <= 1.001 / threshold)]
        if len(others):
            hit = others[texts.similarity(i, others) >= threshold - 1e-12]
            old = np.unique(np.append(label[hit], label[i]))
            if len(old) > 1:
                label[np.isin(label, old)] = old[0]
    return label


def frequency(weight, count, rows: int):
    """The document frequency that ``weight`` = ``count`` * :func:`idf` comes from."""
    return np.rint((1 + rows) / np.exp(weight / count - 1) - 1)


def class_links(threshold: float, rows: int, common: float):
    """Spanning links between texts of at least ``threshold`` similarity, task by task, those of a ``class`` aside.

    A cluster that is one task's whole is compared again, the rows of one class counted once in a
    frequency below ``common``, until no link is new.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, "task", min(TEXT_BLOCK, TEXT_ROWS)):
            ids, side, group = (table.column(c).to_numpy() for c in ("doc_id", "side", "task"))
            i, j = _agreeing(_matrix(table.column("agree")), group, side)
            used, at = np.unique(np.concatenate([i, j]), return_inverse=True)
            if not len(used):
                continue
            some = table.take(pa.array(used))
            a, b = at[:len(i)], at[len(i):]
            texts = _Texts(list(_lists(some)))
            _, first, class_ = np.unique(np.stack([group[used], some.column("class").to_numpy()]), axis=1, return_index=True, return_inverse=True)
            before = first[class_.reshape(-1)]
            label = _linked(texts, before, a, b, threshold)
            weight, count = texts.weight, some.column("counts").combine_chunks().flatten().to_numpy()
            df, copies, whole = frequency(weight, count, rows), some.column("copies").to_numpy(), some.column("whole").to_numpy()
            while True:
                left = whole[a] & (label[a] != label[b])
                a, b = a[left], b[left]
                if not len(a):
                    break
                texts.weigh(count * idf(df - np.where(df < common, texts.surplus(group[used], label, copies), 0), rows))
                new = _linked(texts, label, a, b, threshold)
                if (new == label).all():
                    break
                label = new
            hit = (label != before) & (before == np.arange(len(used)))
            yield pa.record_batch([pa.array(ids[used][hit]), pa.array(ids[used[label[hit]]])], names=["u", "v"])

    return run


def compared(clusters: DataFrame, texts: DataFrame, threshold: float, rows: int) -> DataFrame:
    """(u, v) of :func:`class_links`; ``clusters``: doc_id, cluster, entries, class, ``texts``: doc_id, copies, hashes, weights, counts, agree."""
    # The members grow with the corpus: the same shuffle join at any size.
    dealt = _dealt(clusters, "cluster", TEXT_BLOCK, "class").join(texts.hint("merge"), "doc_id").repartition("task").sortWithinPartitions("task")
    return written(dealt.mapInArrow(class_links(threshold, rows, COMMON * rows), "u long, v long"), "minhash-links")


def spread_links(clusters: DataFrame, texts: DataFrame, links: DataFrame, threshold: float, rows: int) -> list[DataFrame]:
    """The links that the clusters of several tasks get when the rows of one class count once, until none is new."""
    several = _blocks(clusters, "cluster", TEXT_BLOCK).filter("blocks > 1")
    large = written(clusters.join(several.select("cluster"), "cluster"), "minhash-large")
    if large.isEmpty():
        return []
    found, new = [links.join(large.select(F.col("doc_id").alias("u")), "u", "left_semi")], []
    while True:
        classes = components(found[0] if not new else found[0].unionAll(_union(new))).withColumnRenamed("node", "doc_id")
        named = written(large.join(classes, "doc_id", "left").select("doc_id", "cluster", "entries", F.coalesce("component", "doc_id").alias("class")), "minhash-named")
        entry = F.explode(F.arrays_zip("hashes", "weights", "counts")).alias("e")
        entries = named.join(texts, "doc_id").select("doc_id", "cluster", "class", "copies", entry)
        entries = entries.select("doc_id", "cluster", "class", "copies", F.col("e.hashes").alias("hash"), F.col("e.weights").alias("weight"), F.col("e.counts").alias("count"))
        held = entries.groupBy("cluster", "class", "hash").agg(F.sum("copies").alias("n")).filter("n > 1")
        less = held.groupBy("cluster", "hash").agg(F.sum(F.col("n") - 1).alias("less"))
        df = F.rint((1.0 + rows) / F.exp(F.col("weight") / F.col("count") - 1) - 1)
        df -= F.when(df < COMMON * rows, F.coalesce("less", F.lit(0))).otherwise(0)
        weight = F.col("count") * (1 + F.log((1.0 + rows) / (1 + df)))
        again = entries.join(less, ["cluster", "hash"], "left").select("doc_id", F.struct("hash", weight.alias("weight"), "count").alias("e"))
        again = again.groupBy("doc_id").agg(F.collect_list("e").alias("e")).select("doc_id", F.col("e.hash").alias("hashes"), F.col("e.weight").alias("weights"), F.col("e.count").alias("counts"))
        more = compared(named, again.join(texts.select("doc_id", "copies", "agree"), "doc_id"), threshold, rows)
        if more.isEmpty():
            return new
        new.append(more)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)


def copy_links(ids: DataFrame, rows: int) -> DataFrame:
    """(u, v): each id and the least id of its text; ``ids``: doc_id, digest, ``rows`` of them at most.

    A text that a 1/``HOT`` share of all rows has is broadcast, and there are ``HOT`` of them at
    most; so no task of the shuffle join gets a large group of copies.
    """
    copies = ids.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = written(copies, "minhash-copies")
    hot = F.col("n") * HOT >= rows
    most = F.broadcast(copies.filter(hot).select("digest", "rep"))
    rest = ids.join(most.select("digest"), "digest", "left_anti").join(copies.filter(~hot).select("digest", "rep").hint("merge"), "digest")
    both = ids.join(most, "digest").select("doc_id", "rep").unionAll(rest.select("doc_id", "rep"))
    return both.filter("doc_id <> rep").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id, kept) for every row; ``class_id``: the least id of the row's class.

    Equal texts, and texts of at least ``similarity``, are linked; classes are connected by
    links.  Pairs of a cluster are compared again while classes grow, their rows counted once.  A text of fewer than five words is one shingle of all its words (A-Z
    lower-cased); one without a word, null (which is empty) included, is linked to equal
    texts only.  Rows of one id share a class; a row without an id is a class of its own
    (null); an empty table gives no rows.  Other columns play no part.

    Each text's shingles are shuffled once, to be counted; those it shares with another text come
    back as its vector, of which signatures and similarities are made; the texts themselves are
    not shuffled.  Buckets and clusters of any size are dealt out in pairs of blocks, so a
    task holds two blocks at most, and returns one link per row at most.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    n = size["n"]
    every = written(rows.select("doc_id", "key", F.md5("text").alias("digest")), "minhash-ids")
    ids = every.filter("doc_id is not null").select("doc_id", "digest")
    reps = every.groupBy("digest", "key").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")).filter("doc_id is not null")
    reps = written(signatures(vectors(rows, reps.drop("digest"), n, size["bytes"], similarity)), "minhash-signatures")
    banded = reps.select("doc_id", "agree", F.posexplode("keys").alias("band", "key")).select("doc_id", "agree", F.xxhash64("band", "key").alias("bucket"))
    tasks = _dealt(banded, "bucket", BUCKET_BLOCK, "agree").repartition("task").sortWithinPartitions("task")
    near = written(tasks.mapInArrow(cluster_links, "u long, v long").distinct(), "minhash-near")
    found = components(near)
    clusters = found.unionAll(found.select("component", "component").distinct()).toDF("doc_id", "cluster")
    clusters = written(clusters.join(reps.select("doc_id", F.size("hashes").alias("entries")), "doc_id"), "minhash-clusters")
    links = compared(clusters.withColumn("class", F.col("doc_id")), reps.drop("keys"), similarity, n)
    # Rows of one id with different texts meet in their id; equal texts in the least id of them.
    links = _union([links, *spread_links(clusters, reps.drop("keys"), links, similarity, n), copy_links(ids, n)])
    classes = components(links).withColumnRenamed("node", "doc_id")
    told = ids.select("doc_id").join(classes, "doc_id", "left").select("doc_id", F.coalesce("component", "doc_id").alias("class_id"))
    told = told.withColumn("kept", F.col("doc_id") == F.col("class_id"))
    return told.unionAll(rows.filter("doc_id is null").select("doc_id", F.lit(None).cast("long"), F.lit(True)))
