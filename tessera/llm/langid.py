"""Language identification with a byte convolutional network, in numpy.

Filters of several widths slide over the bytes of a window; each keeps its maximum; a
rectified linear layer and a softmax follow.  As a byte's contribution to a filter depends
on nothing but the byte and its place, a filter is a table of 256 numbers per place; for
prediction the places are joined in pairs (65,536 rows), so a position costs a few table
reads.  A text is cut into windows of fixed length, all of them are scored in batches,
and the text's probabilities are the mean over its windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import buffers, small_batches, steps

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
#: Labelled documents per language that the network is trained on at most, and windows of each.
DOCS_PER_LANGUAGE, WINDOWS_PER_DOC = 600, 4
STEPS, BATCH, RATE, SEED = 700, 64, 0.02, 5
UNKNOWN = "und"
#: Windows scored at once: their filter outputs stay in a core's cache.
SCORE_BATCH = 64

RESULT = "doc_id long, held_out boolean, lang_pred string, score double"


@dataclass
class Network:
    """``tables[i]``: (width, 256, FILTERS) for ``WIDTHS[i]``; byte 0 pads and adds nothing."""

    languages: list[str]
    tables: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def __post_init__(self):
        self._pairs = None

    def _joined(self):
        """First two places of all filters by byte pair; then each filter's further places."""
        if self._pairs is None:
            first = np.concatenate([(t[0][:, None, :] + t[1][None, :, :]).reshape(65536, -1) for t in self.tables], 1)
            more = []
            for i, t in enumerate(self.tables):
                for at in range(2, len(t), 2):
                    table = t[at] if at + 1 == len(t) else (t[at][:, None, :] + t[at + 1][None, :, :]).reshape(65536, -1)
                    more.append((i, at, np.ascontiguousarray(table)))
            self._pairs = np.ascontiguousarray(first), more
        return self._pairs

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        """(n, filters) maxima of the filters over (n, WINDOW) bytes."""
        first, more = self._joined()
        n, length = windows.shape
        f, reach = self.tables[0].shape[2], max(WIDTHS)
        b = np.zeros((n, length + reach), np.intp)
        b[:, :length] = windows
        pair = b[:, :-1] * 256 + b[:, 1:]
        x = first.take(pair[:, :length].ravel(), axis=0)
        for i, at, table in more:
            index = b[:, at:at + length] if len(table) == 256 else pair[:, at:at + length]
            x[:, i * f:(i + 1) * f] += table.take(index.ravel(), axis=0)
        return x.reshape(n, length, -1).max(axis=1)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        z = np.maximum(self.pooled(windows) + self.bias, 0) @ self.out + self.out_bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def train(texts: list[bytes], labels: list[str], *, steps: int = STEPS, seed: int = SEED) -> Network:
    """Fit by Adam on random crops (half of them whole windows, half shorter) with equal weight per language."""
    languages = sorted(set(labels))
    rng = np.random.default_rng(seed)
    tables = [(rng.standard_normal((w, 256, FILTERS)) * 0.1).astype(np.float32) for w in WIDTHS]
    n = FILTERS * len(WIDTHS)
    net = Network(languages, tables, np.zeros(n, np.float32), (rng.standard_normal((n, len(languages))) * 0.2).astype(np.float32), np.zeros(len(languages), np.float32))
    data = np.zeros((len(texts), WINDOW + max(WIDTHS)), np.intp)
    sizes = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        sizes[i] = min(len(t), WINDOW)
        data[i, :sizes[i]] = np.frombuffer(t[:WINDOW], np.uint8)
    y = np.array([languages.index(x) for x in labels])
    by_language = [np.flatnonzero(y == k) for k in range(len(languages))]
    params = [*tables, net.bias, net.out, net.out_bias]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        kind = rng.integers(len(languages), size=BATCH)
        rows = np.array([by_language[k][rng.integers(len(by_language[k]))] for k in kind])
        x = data[rows].copy()
        size = np.where(rng.random(BATCH) < 0.5, sizes[rows], np.minimum(sizes[rows], np.exp(rng.uniform(np.log(4), np.log(WINDOW), BATCH)).astype(np.int64)))
        x[np.arange(x.shape[1])[None, :] >= size[:, None]] = 0
        tops, ats = [], []
        for t in tables:
            z = t[0][x[:, :WINDOW]]
            for j in range(1, len(t)):
                z = z + t[j][x[:, j:j + WINDOW]]
            at = z.argmax(axis=1)
            ats.append(at)
            tops.append(np.take_along_axis(z, at[:, None, :], 1)[:, 0])
        h = np.concatenate(tops, 1) + net.bias
        a = np.maximum(h, 0)
        z = a @ net.out + net.out_bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(BATCH), kind] -= 1
        p /= BATCH
        dh = (p @ net.out.T) * (h > 0)
        grads = []
        for i, t in enumerate(tables):
            g, d = np.zeros_like(t), dh[:, i * FILTERS:(i + 1) * FILTERS]
            f = np.broadcast_to(np.arange(FILTERS), d.shape)
            for j in range(len(t)):
                np.add.at(g[j], (x[np.arange(BATCH)[:, None], ats[i] + j], f), d)
            g[:, 0] = 0
            grads.append(g)
        grads += [dh.sum(0), a.T @ p + 1e-4 * net.out, p.sum(0)]
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for q, g, mm, vv in zip(params, grads, m, v):
            mm += 0.1 * (g - mm)
            vv += 0.001 * (g * g - vv)
            q -= rate * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.999**step)) + 1e-8)
        for t in tables:
            t[:, 0] = 0
    return net


def windows_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """((n, WINDOW) bytes, the row of each).  Together they cover each text; the last window of
    a text ends with it; a text shorter than a window is filled with zeros; an empty one has none."""
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    row = np.repeat(np.arange(len(size)), count)
    first = np.repeat(np.cumsum(count) - count, count)
    at = (np.arange(len(row)) - first) * WINDOW
    at = np.minimum(at, np.maximum(size[row] - WINDOW, 0))
    index = (offsets[row] + at)[:, None] + np.arange(WINDOW)
    inside = index < offsets[row + 1][:, None]
    padded = np.append(raw, np.uint8(0))
    return np.where(inside, padded[np.minimum(index, len(raw))], 0).astype(np.uint8), row


def fit(labelled: DataFrame, *, docs_per_language: int = DOCS_PER_LANGUAGE) -> Network | None:
    """Train on windows at seeded places of at most ``docs_per_language`` documents of each
    language (``doc_id``, ``text``, ``lang``); None without any labelled text."""
    rows = labelled.filter("lang is not null and text is not null and length(text) > 0")
    seen = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not seen:
        return None
    draw = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1_000_000))
    rate = F.element_at(F.create_map(*[x for k, n in seen.items() for x in (F.lit(k), F.lit(min(1_000_000, 1_200_000 * docs_per_language // n + 1)))]), F.col("lang"))
    picked = rows.filter(draw < rate).orderBy(draw, "doc_id").limit(docs_per_language * len(seen) * 2)
    places = [F.substring("text", F.pmod(F.xxhash64("doc_id", F.lit(i)), F.greatest(F.length("text") - WINDOW, F.lit(1))).cast("int") + 1, WINDOW) for i in range(WINDOWS_PER_DOC)]
    found = [(r["lang"], t.encode()) for r in picked.select("lang", F.array(*places).alias("texts")).collect() for t in r["texts"] if t]
    return train([t for _, t in found], [k for k, _ in found]) if found else None


def predict(docs: DataFrame, net: Network | None, carry: list[Column] | None = None) -> DataFrame:
    """``carry`` columns and (lang_pred, score) for every row's whole text.

    The prediction reads nothing but ``text``.  A null text or one without a letter is `und`
    with score 0, and so is every text if nothing could be learned.
    """
    small_batches(docs.sparkSession)
    carry = [F.col("doc_id")] if carry is None else carry
    schema = docs.select(*carry).schema
    from pyspark.sql.types import DoubleType, StringType

    out_schema = schema.add("lang_pred", StringType()).add("score", DoubleType())
    text = F.col("text").cast("string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = batch.num_columns - 2
            raw, offsets = buffers(batch.column(width))
            n = batch.num_rows
            total, count = np.zeros((n, len(net.languages)) if net else (n, 1)), np.zeros(n)
            for i, j in steps(offsets) if net else ():
                windows, row = windows_of(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                for k in range(0, len(windows), SCORE_BATCH):
                    np.add.at(total, row[k:k + SCORE_BATCH] + i, net.probabilities(windows[k:k + SCORE_BATCH]))
                count[i:j] = np.bincount(row, minlength=j - i)
            known = (count > 0) & np.array(batch.column(width + 1).fill_null(False).to_pylist(), bool)
            mean = total / np.maximum(count, 1)[:, None]
            best = mean.argmax(axis=1)
            told = [net.languages[b] if ok else UNKNOWN for b, ok in zip(best, known)]
            score = np.where(known, mean[np.arange(n), best], 0.0)
            yield pa.record_batch([*batch.columns[:width], pa.array(told, pa.string()), pa.array(np.minimum(score, 1.0))], names=[f.name for f in out_schema])

    return docs.select(*carry, text.alias("__text"), text.rlike(r"\p{L}").alias("__letter")).mapInArrow(run, out_schema)
