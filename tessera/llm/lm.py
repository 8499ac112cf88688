"""Scoring texts with a bigram model by deleted interpolation.

    P(w | v) = l2(b) c(v w)/c(v) + l1(b) c(w)/N + l0(b) / (V + 1),   b: the bucket of c(v)

A token is a word (A-Z lower-cased) or the end of a text, which is also the context of the
first word.  The mixture weights of each context-frequency bucket come from expectation-
maximisation on held-out counts: every training document in turn is deleted from the counts
that predict it.  The counts of all training documents are exact.

Texts become blocks of token numbers.  A block sends the distinct words and word pairs it
holds, with its own training counts, to the owners of their hash ranges, and gets the total
counts back in the order it asked; so one shuffled entry stands for all occurrences in the
block, a frequent word is one entry, and nothing of the vocabulary's size is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import buffers, mix, small_batches, steps, word_hashes, written

#: Bytes of text in a block, one text at least.
BLOCK_BYTES = 7_000_000
#: Entries that one owner of a hash range counts together, about.
OWNER_ENTRIES = 1_500_000
#: Buckets of context frequency: 0, then one for each power of two; the last is open.
BUCKETS = 24
#: Grid of the probabilities that the mixture weights are learned from: steps of half a power of two, 0 apart.
LEVELS = 96
#: Weight of the additive base model.
ADD = 0.1
ROUNDS = 200

END = np.uint64(0xA5A5F00DCAFE1234)
_PAIR = np.uint64(0xD1342543DE82EF95)


def _zip(a: np.ndarray) -> bytes:
    """A number array by byte planes, compressed."""
    import zstandard

    a = np.ascontiguousarray(a)
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())


def _unzip(raw: bytes, kind) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, len(planes) // size).T).view(kind).ravel()


def _zip_sorted(a: np.ndarray) -> bytes:
    return _zip(np.diff(a, prepend=np.uint64(0)))


def _unzip_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(_unzip(raw, np.uint64), dtype=np.uint64)


# --- blocks -------------------------------------------------------------------

_BLOCKS = "block long, doc_ids array<long>, train array<boolean>, sizes array<long>, words binary, tokens binary, n_train long, entries long"


def tokenised(docs: DataFrame) -> DataFrame:
    """Blocks of (doc_id, train, text) rows: sorted hashes of their words, and each text's
    tokens, its end last, as places in that list."""
    def block(number: int, parts: list) -> pa.RecordBatch:
        ids, train, sizes, hashes = (sum((p[k] for p in parts), []) for k in range(4))
        words, tokens = np.unique(np.concatenate(hashes), return_inverse=True)
        n_train = int(sum(s for s, t in zip(sizes, train) if t))
        row = [(number, ids, train, sizes, _zip_sorted(words), _zip(tokens.astype(np.uint32)), n_train, len(words) + len(tokens))]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*row), kinds)], names=[f.split()[0] for f in _BLOCKS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 30, [], 0
        for batch in batches:
            raw, offsets = buffers(batch.column(2))
            for i, j in steps(offsets):
                words, at = word_hashes(raw, offsets[i:j + 1])
                own = words >> np.uint64(8)  # 56 bits
                with_end = np.insert(own, at[1:], END >> np.uint64(8))
                part = batch.slice(i, j - i)
                held.append((part.column(0).to_pylist(), part.column(1).to_pylist(), (np.diff(at) + 1).tolist(), [with_end]))
                size += int(offsets[j] - offsets[i])
                if size >= BLOCK_BYTES:
                    yield block(number, held)
                    number, held, size = number + 1, [], 0
        if held:
            yield block(number, held)

    return docs.select("doc_id", "train", "text").mapInArrow(run, _BLOCKS)


def _contexts(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The token before each; the end before a text's first."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]  # a text's last token is the end, which the next one begins with
    before[0] = tokens[int(sizes[0]) - 1]
    return before


def _pairs(words: np.ndarray, tokens: np.ndarray, before: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(words[before] * _PAIR + words[tokens]) >> np.uint64(8)


# --- counts -------------------------------------------------------------------


def requests(blocks: DataFrame, owners: int) -> DataFrame:
    """(kind, owner, block, hashes, counts): a block's distinct words (kind 0) and pairs (1), by hash range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                number, train, sizes, words, tokens = (batch.column(c)[k].as_py() for c in range(5))
                sizes, words, tokens = np.array(sizes), _unzip_sorted(words), _unzip(tokens, np.uint32)
                use = np.repeat(np.array(train, bool), sizes)
                pairs = _pairs(words, tokens, _contexts(tokens, sizes))
                own = np.bincount(tokens[use], minlength=len(words))
                rows = []
                for kind, (value, count) in enumerate(((words, own), _counted(pairs, use))):
                    for owner, s, e in _ranges(value, owners):
                        rows.append((kind, owner, number, _zip_sorted(value[s:e]), _zip(count[s:e].astype(np.uint32))))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                                      names=["kind", "owner", "block", "hashes", "counts"])

    return blocks.select("block", "train", "sizes", "words", "tokens").mapInArrow(run, "kind int, owner int, block long, hashes binary, counts binary")


def _ranges(value: np.ndarray, owners: int) -> Iterator[tuple[int, int, int]]:
    """(owner, first place, the place after the last) of the hash ranges that sorted 56-bit hashes reach."""
    owner = (value >> np.uint64(24)) * np.uint64(owners) >> np.uint64(32)
    cut = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1], True])
    return zip(owner[cut[:-1]].tolist(), cut[:-1].tolist(), cut[1:].tolist())


def _counted(pairs: np.ndarray, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    value = np.unique(pairs)
    known, n = np.unique(pairs[use], return_counts=True)
    count = np.zeros(len(value), np.int64)
    count[np.searchsorted(value, known)] = n
    return value, count


def _answer(key, table):
    """Total counts of one hash range, in each block's order; ``known``: its entries with a training count."""
    hashes = [_unzip_sorted(b) for b in table.column("hashes").to_pylist()]
    counts = [_unzip(b, np.uint32) for b in table.column("counts").to_pylist()]
    value, place = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(place, np.concatenate(counts), len(value)).astype(np.uint64)
    ends = np.cumsum([0] + [len(h) for h in hashes])
    n = len(hashes)
    known = [int((total > 0).sum())] + [0] * (n - 1)
    return pa.table({"kind": pa.array([key[0].as_py()] * n, pa.int32()), "owner": pa.array([key[1].as_py()] * n, pa.int32()), "block": table.column("block"),
                     "counts": pa.array([_zip(total[place[s:e]]) for s, e in zip(ends, ends[1:])], pa.binary()), "known": pa.array(known, pa.int64())})


# --- held-out counts ----------------------------------------------------------


def bucket(context: np.ndarray) -> np.ndarray:
    return np.where(context > 0, np.minimum(np.floor(np.log2(np.maximum(context, 1))).astype(np.int64) + 1, BUCKETS - 1), 0)


def _level(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, np.clip(np.floor(-2 * np.log2(np.maximum(p, 1e-300))).astype(np.int64) + 1, 1, LEVELS - 1), 0)


def _cells(doc: np.ndarray, tokens: np.ndarray, before: np.ndarray, pair: np.ndarray, total: np.ndarray, c_pair: np.ndarray, use: np.ndarray,
           sizes: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """(cell, tokens, sum of p2, sum of p1) of training texts, each deleted from the counts that predict it."""
    def own(key: np.ndarray, most: int) -> np.ndarray:
        _, place, count = np.unique(doc * np.int64(most) + key, return_inverse=True, return_counts=True)
        return count[place]

    doc, tokens, before, pair = doc[use], tokens[use].astype(np.int64), before[use].astype(np.int64), pair[use].astype(np.int64)
    in_doc = own(tokens, len(total))
    # The context's own count: that of the token at the place before; the end stands once in each text.
    as_context = np.empty_like(in_doc)
    as_context[1:] = in_doc[:-1]
    as_context[np.r_[True, doc[1:] != doc[:-1]]] = 1
    c_v = total[before] - as_context
    p2 = np.where(c_v > 0, (c_pair[use] - own(pair, int(pair.max()) + 1)) / np.maximum(c_v, 1), 0.0)
    p1 = np.maximum(total[tokens] - in_doc, 0) / np.maximum(n - sizes[doc], 1)
    cell = (bucket(c_v) * LEVELS + _level(p2)) * LEVELS + _level(p1)
    value, place = np.unique(cell, return_inverse=True)
    return value, np.bincount(place), np.bincount(place, p2), np.bincount(place, p1)


_JOINED = "block long, doc_ids array<long>, train array<boolean>, sizes array<long>, counts binary, pairs binary, cell array<int>, n array<long>, p2 array<double>, p1 array<double>"


def counted(blocks: DataFrame, answers: DataFrame, n: int) -> DataFrame:
    """Each block's tokens as total counts of token and pair, and the cells of its training texts' held-out probabilities."""
    def run(left, right):
        row = {c: left.column(c)[0].as_py() for c in left.column_names}
        order = sorted(range(right.num_rows), key=lambda i: (right.column("kind")[i].as_py(), right.column("owner")[i].as_py()))
        kinds = right.column("kind").to_pylist()
        told = right.column("counts").to_pylist()
        total, of_pair = (np.concatenate([_unzip(told[i], np.uint64).astype(np.int64) for i in order if kinds[i] == k]) for k in (0, 1))
        sizes, words, tokens = np.array(row["sizes"]), _unzip_sorted(row["words"]), _unzip(row["tokens"], np.uint32)
        before = _contexts(tokens, sizes)
        _, pair = np.unique(_pairs(words, tokens, before), return_inverse=True)
        c_pair = of_pair[pair]
        doc = np.repeat(np.arange(len(sizes)), sizes)
        use = np.repeat(np.array(row["train"], bool), sizes)
        cells = _cells(doc, tokens, before, pair, total, c_pair, use, sizes, n) if use.any() else (np.empty(0, int),) * 4
        out = [row["block"], row["doc_ids"], row["train"], row["sizes"], _zip(total[tokens]), _zip(c_pair)]
        kinds_out = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.float64())]
        values = [*out, cells[0].astype(np.int32), cells[1].astype(np.int64), cells[2].astype(float), cells[3].astype(float)]
        return pa.table({f.split()[0]: pa.array([v], k) for f, v, k in zip(_JOINED.split(", "), values, kinds_out)})

    return blocks.select("block", "doc_ids", "train", "sizes", "words", "tokens").groupBy("block").cogroup(answers.select("block", "kind", "owner", "counts").groupBy("block")).applyInArrow(run, _JOINED)


def mixture(cells: list[tuple], distinct: int) -> np.ndarray:
    """(BUCKETS, 3) weights of pair, word and uniform probability, by expectation-maximisation."""
    weights = np.tile([0.0, 0.5, 0.5], (BUCKETS, 1))
    weights[1:] = [0.4, 0.4, 0.2]
    if not cells:
        return np.tile([0.0, 0.0, 1.0], (BUCKETS, 1))
    code, n, p2, p1 = (np.array(c, float) for c in zip(*cells))
    of = (code // (LEVELS * LEVELS)).astype(int)
    p = np.stack([p2 / n, p1 / n, np.full(len(n), 1 / (distinct + 1))], 1)
    for _ in range(ROUNDS):
        share = weights[of] * p
        share *= (n / share.sum(axis=1))[:, None]
        new = np.stack([np.bincount(of, share[:, k], BUCKETS) for k in range(3)], 1)
        seen = new.sum(axis=1) > 0
        new[seen] /= new[seen].sum(axis=1, keepdims=True)
        new[~seen] = weights[~seen]
        done = np.abs(new - weights).max() < 1e-7
        weights = new
        if done:
            break
    # A bucket that no held-out token met goes by the nearest one below (the first ones by the one above).
    seen = np.flatnonzero(np.bincount(of, n, BUCKETS) > 0)
    for b in range(BUCKETS):
        if b not in seen:
            weights[b] = weights[seen[seen < b][-1]] if (seen < b).any() else weights[seen[0]]
    weights[0] = [0.0, *(weights[0, 1:] / weights[0, 1:].sum())] if weights[0, 1:].sum() > 0 else [0.0, 0.0, 1.0]
    return np.maximum(weights, [0.0, 0.0, 1e-9]) / np.maximum(weights, [0.0, 0.0, 1e-9]).sum(axis=1, keepdims=True)


_SCORES = "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double"


def score(docs: DataFrame, train: Column, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, train, n_tokens, n_known, train_tokens, base_score, score) for every row.

    ``train``: true for the rows to learn from (null: false).  Scores are log10 of the text's
    probability, its end included: by the model, and by add-0.1 single tokens (``base_score``).
    A null text is empty: its end alone.  Null ids stay; equal rows are scored alike, each
    counted; without any training row both models are uniform over one token, so scores are
    0; an empty table gives no rows.  Other columns play no part.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    blocks = written(tokenised(rows), "lm-blocks")
    size = blocks.agg(F.sum("n_train").alias("n"), F.sum("entries").alias("entries")).first()
    n, entries = size["n"] or 0, size["entries"] or 0
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    owners = max(parts, -(-entries // OWNER_ENTRIES))
    asked = requests(blocks, owners)
    answers = written(asked.groupBy("kind", "owner").applyInArrow(_answer, "kind int, owner int, block long, counts binary, known long"), "lm-answers")
    distinct = answers.filter("kind = 0").agg(F.sum("known").alias("v")).first()["v"] or 0
    joined = written(counted(blocks, answers, n), "lm-counted")
    cells = joined.select(F.explode(F.arrays_zip("cell", "n", "p2", "p1")).alias("c")).groupBy("c.cell").agg(F.sum("c.n"), F.sum("c.p2"), F.sum("c.p1"))
    weights = mixture([tuple(r) for r in cells.orderBy("cell").collect()], distinct)  # at most BUCKETS * LEVELS^2 rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                sizes, counts, pairs = (batch.column(c)[k].as_py() for c in (2, 3, 4))
                sizes, c, c_pair = np.array(sizes), _unzip(counts, np.int64), _unzip(pairs, np.int64)
                c_v = _contexts(c, sizes)
                b = bucket(c_v)
                p = weights[b, 0] * c_pair / np.maximum(c_v, 1) + weights[b, 1] * c / max(n, 1) + weights[b, 2] / (distinct + 1)
                base = np.log10((c + ADD) / (n + ADD * (distinct + 1)))
                first = np.cumsum(sizes) - sizes
                values = [sizes, np.add.reduceat((c > 0).astype(np.int64), first), np.add.reduceat(base, first), np.add.reduceat(np.log10(p), first)]
                yield pa.record_batch([batch.column(0)[k].values, batch.column(1)[k].values, *map(pa.array, values)], names=[f.split()[0] for f in _SCORES.split(", ")])

    scored = joined.select("doc_ids", "train", "sizes", "counts", "pairs").mapInArrow(run, _SCORES)
    return scored.withColumn("train_tokens", F.lit(n).cast("long"))
