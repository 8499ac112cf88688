"""Spelling variants: a frequency-vector trie, searched with a budget of one surplus and one deficit.

A word's vector counts its letters by group.  One inserted letter adds one to one group,
a deleted one takes one from one group, a replaced one does both.  So words one edit apart
lie in the trie of vectors on paths that part by at most one surplus and one deficit; the
words of the leaves reached are verified letter by letter.

The trie's first levels (length and coarse letter groups) deal the words out: every word is
sent to the few subtrees that its budget reaches, equally long and one longer ones.  Each
subtree's task builds the levels of the finer groups and searches them depth first, with a
block of words at a time.  Subtrees of any size are dealt in blocks of bounded size.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import buffers, spans, written

LEAST_POINTS, LEAST_COUNT = 5, 3
#: Bytes of text that a task handles at once.
STEP_BYTES = 4_000_000
#: A form occurs at least this many times as often as its variant.
FORM_RATIO = 2
#: Coarse groups of the first levels: as few as give subtrees of a mean size (seen from a word) below this.
SUBTREE_WORDS = 20_000
FEWEST_PARTS, MOST_PARTS = 4, 10
#: Code points of a subtree's words that one task holds; more are dealt out in blocks.
BLOCK_POINTS = 1_000_000
#: Code points of the words searched at once, and of the pairs verified at once.
QUERY_POINTS, VERIFY_POINTS = 200_000, 2_000_000
#: Pairs of a trie node's words and the words that search it which are verified without another level.
LEAF_PAIRS = 2000
#: Finer groups in each coarse one.
FINER = 4
#: Commonest letters that are dealt to groups by their frequency; others go by code point.
LETTERS = 4096

_NEAR = "word string, n_near long, best_n long, best_word string"


# --- words of texts ---------------------------------------------------------------

_LATIN = np.zeros(256, bool)
_LATIN[[*range(65, 91), *range(97, 123), 0xC3]] = True
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32


def _inside(raw: np.ndarray) -> np.ndarray:
    """The bytes of letters A-Z, a-z and U+00C0 to U+00FF (0xC3 and the byte after it)."""
    inside = _LATIN[raw]
    inside[1:] |= raw[:-1] == 0xC3
    return inside


def _parts(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row numbers, first bytes, ends) of steps of about :data:`STEP_BYTES`; a long text is cut where no run is."""
    rows, starts, ends, size = [], [], [], 0
    for row, (at, to) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        while at < to:
            cut = min(to, at + STEP_BYTES - size)
            while cut < to and not (gaps := np.flatnonzero(~_inside(raw[cut - 1:min(cut + 4096, to)])[1:])[:1]).size:
                cut = min(to, cut + 4096)
            cut = to if cut >= to else cut + int(gaps[0])
            rows.append(row)
            starts.append(at)
            ends.append(cut)
            size, at = size + cut - at, cut
            if size >= STEP_BYTES:
                yield np.array(rows), np.array(starts), np.array(ends)
                rows, starts, ends, size = [], [], [], 0
    if rows:
        yield np.array(rows), np.array(starts), np.array(ends)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


def _crc(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each byte range, each going on from the crc32 ``before`` it."""
    table = _crc_table()
    order = np.argsort(-lengths, kind="stable")
    at, state = starts[order], ~before[order]
    many = np.searchsorted(-lengths[order], -np.arange(int(lengths.max(initial=0))), "left")  # ranges longer than k
    for k, m in enumerate(many.tolist()):
        state[:m] = table[(state[:m] ^ raw[at[:m] + k]) & 255] ^ (state[:m] >> 8)
    out = np.empty_like(state)
    out[order] = ~state
    return out


def _loads(raw: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The first eight bytes at each place as one number, fewer for shorter ranges."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(raw) + 1,), "<u8", padded, 0, (1,))[at]
    short = np.minimum(lengths, 8).astype(np.uint64)
    return eight & np.where(short == 8, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (short * np.uint64(8) % np.uint64(64))) - np.uint64(1))


def _distinct(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The distinct byte ranges as strings, and how often each is there."""
    lengths = ends - starts
    first, last = _loads(raw, starts, lengths), _loads(raw, np.maximum(ends - 8, starts), lengths)
    h = spans(raw, starts, ends)
    _, index, inverse, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
    if any((x != x[index][inverse]).any() for x in (first, last, lengths)):  # two ranges of one hash
        words = Counter(raw[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist()))
        return pa.array([w.decode() for w in words], pa.string()), np.array(list(words.values()), np.int64)
    lengths, starts = lengths[index], starts[index]
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    chosen = raw[np.arange(offsets[-1]) - np.repeat(offsets[:-1] - starts, lengths)]
    return pa.StringArray.from_buffers(len(index), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(chosen))), n


def _words(raw: np.ndarray, rows: np.ndarray, starts: np.ndarray, ends: np.ndarray, ids: list, every: int | None, least: int) -> tuple[pa.Array, np.ndarray]:
    """(words, n) of one step."""
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    raw = np.concatenate([raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())])
    inside = _inside(raw)
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    # Neighbouring texts may touch: a text's first byte begins a run, its last one ends one.
    begin[offsets[:-1]], end[offsets[1:] - 1] = inside[offsets[:-1]], inside[offsets[1:] - 1]
    at, to = np.flatnonzero(begin), np.flatnonzero(end) + 1
    twos = np.concatenate([[0], np.cumsum(raw == 0xC3, dtype=np.int32)])
    points = (to - at) - (twos[to] - twos[at])
    at, to, points = at[points >= least], to[points >= least], points[points >= least]
    raw = _LOWERED[raw]
    if every is None:
        return _distinct(raw, at, to)
    before = np.array([zlib.crc32(b"" if i is None else f"{i}:".encode()) for i in ids], np.uint32)
    h = _crc(raw, at, to - at, before[rows[np.searchsorted(offsets, at, "right") - 1]])
    cut = (h % every == 0) & np.array([i is not None for i in ids])[rows[np.searchsorted(offsets, at, "right") - 1]]
    typos: Counter = Counter()
    for a, b, k in zip(at[cut].tolist(), to[cut].tolist(), (h[cut] % points[cut]).tolist()):
        word = raw[a:b].tobytes().decode()
        typos[word[:k] + word[k + 1:]] += 1
    words, n = _distinct(raw, at[~cut], to[~cut])
    return pa.concat_arrays([words, pa.array(list(typos), pa.string())]), np.concatenate([n, np.array(list(typos.values()), np.int64)])


def vocabulary(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", delete_every: int | None = None,
               least_points: int = LEAST_POINTS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the distinct words of at least ``least_points`` code points and ``least_count`` occurrences.

    Words are the maximal runs of Latin letters (A-Z, a-z, U+00C0 to U+00FF) of every whole
    text, only A-Z lower-cased.  ``delete_every``: planted typing errors; where it divides h,
    the crc32 of ``<id>:<word>``, the word's code point h % length is left out.  A row
    without an id has none of these.

    A null text has no words; equal rows count each; an empty table gives none.  A task
    holds one step of text (:data:`STEP_BYTES`, or one longer run); long texts are cut
    between runs.  Counts are added up before they are shuffled.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = buffers(batch.column(1))
            ids = batch.column(0).to_pylist()
            for rows, starts, ends in _parts(raw, offsets):
                words, n = _words(raw, rows, starts, ends, ids, delete_every, least_points)
                yield pa.record_batch([words, pa.array(n, pa.int64())], names=["word", "n"])

    found = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "word string, n long")
    found = found.groupBy("word").agg(F.sum("n").alias("n"))
    return found.filter((F.col("n") >= least_count) & (F.length("word") >= least_points))


# --- first levels -----------------------------------------------------------------


class Letters:
    """Letters by coarse group, and the finer groups of each, all of about equal frequency."""

    def __init__(self, counts: list[tuple[str, int]], parts: int):
        weight = [0] * parts
        inside = [[0] * FINER for _ in range(parts)]
        self.parts, self.fine = parts, {}
        for letter, n in sorted(counts, key=lambda c: (-c[1], c[0]))[:LETTERS]:
            p = weight.index(min(weight))
            f = inside[p].index(min(inside[p]))
            weight[p] += n
            inside[p][f] += n
            self.fine[ord(letter)] = p * FINER + f

    def coarse(self) -> list[str]:
        """The listed letters of each coarse group; the first one also takes all others."""
        out = [""] * self.parts
        for letter, f in self.fine.items():
            out[f // FINER] += chr(letter)
        return out

    def table(self, most: int) -> np.ndarray:
        table = np.arange(most + 1) % FINER
        for letter, f in self.fine.items():
            if letter <= most:
                table[letter] = f
        return table


def _levels(letters: Letters) -> list[Column]:
    """A word's letters in each coarse group but the first, which has the rest."""
    return [F.length("word") - F.length(F.translate("word", part, "")) if part else F.lit(0) for part in letters.coarse()[1:]]


def _key(levels: list[Column]) -> Column:
    """Six bits of each count.  Two subtrees that one word reaches never share a key; others of
    one length may (counts apart by 64) and are searched as one."""
    key = F.lit(0).cast("long")
    for count in levels:
        key = F.shiftleft(key, 6).bitwiseOR(count.bitwiseAND(63).cast("long"))
    return key


def _reach(parts: int) -> Column:
    """The subtrees that a word (its levels in l1, l2, ...) searches, as (length, key, kind): 1 its own;
    2 those of equally long words with one letter more in a group and one less in a later one (these
    words need not search back); 3 those of words longer by one, whose deficit is spent from the start."""
    def moved(longer: int, up: int, down: int, kind: int) -> Column:
        key = _key([F.col(f"l{i}") + ((up == i) - (down == i)) for i in range(1, parts)])
        return F.struct((F.col("length") + longer).alias("length"), key.alias("key"), F.lit(kind).alias("kind"))

    return F.array(moved(0, 0, 0, 1), *[moved(0, i, j, 2) for i in range(parts) for j in range(i + 1, parts)], *[moved(1, i, -1, 3) for i in range(parts)])


# --- one subtree ------------------------------------------------------------------


def _matrix(words: list[str], length: int) -> np.ndarray:
    """Code points, a row for each word."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length)
    return points.astype(np.uint8) if points.max(initial=0) < 256 else points


#: What a step costs by the difference of counts: 0 nothing, 1 the surplus, 2 the deficit, 4 more than there is.
_COST = np.full(256, 4, np.int8)
_COST[[0, 1, -1]] = 0, 1, 2


class Trie:
    """The words of one block: of one length, sorted by the counts of their letters in the finer groups."""

    def __init__(self, words: list[str], n: np.ndarray, letters: Letters):
        self.length, self.letters = len(words[0]), letters
        points = _matrix(words, self.length)
        vectors = self.vectors(points)
        order = np.lexsort(vectors.T[::-1])
        self.points, self.counts = points[order], vectors[order]
        self.words, self.n = np.array(words, object)[order], n[order]

    def vectors(self, points: np.ndarray) -> np.ndarray:
        groups = self.letters.parts * FINER
        table = self.letters.table(int(points.max(initial=0)))
        rows = len(points)
        at = table[points] + np.arange(rows)[:, None] * groups
        # Beyond 100 letters of one group counts are kept as differences modulo 256: more pairs are verified, none is lost.
        return np.bincount(at.ravel(), minlength=rows * groups).reshape(rows, groups).astype(np.uint8)

    def search(self, points: np.ndarray, deficit_spent: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query row, trie row) of all pairs one edit apart.  ``deficit_spent``: the queries are shorter by one."""
        vectors = self.vectors(points)
        wide = vectors.shape[1]
        held: list[tuple[np.ndarray, np.ndarray]] = []
        pairs, at_once = 0, max(1, VERIFY_POINTS // self.length)
        stack = [(0, len(self.words), 0, np.arange(len(points)), np.full(len(points), 2 * deficit_spent, np.int8))]
        while stack:
            lo, hi, level, rows, state = stack.pop()
            if level == wide or (hi - lo) * len(rows) <= LEAF_PAIRS:
                for i in range(0, len(rows), most := max(1, at_once // (hi - lo))):
                    part = rows[i:i + most]
                    held.append((np.repeat(part, hi - lo), np.tile(np.arange(lo, hi), len(part))))
                    pairs += len(part) * (hi - lo)
                    if pairs >= at_once:
                        yield self.verify(points, held, deficit_spent)
                        held, pairs = [], 0
                continue
            here = self.counts[lo:hi, level]
            cuts = [0, *(np.flatnonzero(here[1:] != here[:-1]) + 1).tolist(), hi - lo]
            want = vectors[rows, level]
            for a, b in zip(cuts[:-1], cuts[1:]):
                cost = _COST[here[a] - want]  # what the trie's words have more than the query
                on = np.flatnonzero((cost & (state | 4)) == 0)
                if len(on):
                    stack.append((lo + a, lo + b, level + 1, rows[on], state[on] | cost[on]))
        if pairs:
            yield self.verify(points, held, deficit_spent)

    def verify(self, points: np.ndarray, held: list, longer: bool) -> tuple[np.ndarray, np.ndarray]:
        q, w = (np.concatenate(x) for x in zip(*held))
        a, b = points[q], self.points[w]
        if not longer:  # equally long: one place differs
            differ = np.zeros((len(q), -(-self.length // 8) * 8), bool)
            np.not_equal(a, b, out=differ[:, :self.length])
            by_eight = differ.view(np.uint64)  # bytes 0 or 1: the product's top byte is their sum
            ok = ((by_eight * np.uint64(0x0101010101010101)) >> np.uint64(56)).sum(axis=1) == 1
        else:  # one longer: what agrees from the front and from the back covers the shorter word
            width = self.length - 1
            differ = np.ones((len(q), self.length), bool)
            np.not_equal(a, b[:, :-1], out=differ[:, :width])
            front = differ.argmax(axis=1)
            np.not_equal(a[:, ::-1], b[:, :0:-1], out=differ[:, :width])
            ok = front + differ.argmax(axis=1) >= width
        return q[ok], w[ok]


class _Best:
    """Near words of a block's rows: how many, and the commonest (ties: the first by code points)."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.near = np.zeros(len(words), np.int64)
        self.n = np.zeros(len(words), np.int64)
        self.best = np.full(len(words), None, object)

    def add(self, rows: np.ndarray, n: np.ndarray, words: np.ndarray) -> None:
        if not len(rows):
            return
        np.add.at(self.near, rows, 1)
        order = np.lexsort((-n, rows))
        rows, n, words = rows[order], n[order], words[order]
        first = np.concatenate([[0], np.flatnonzero(rows[1:] != rows[:-1]) + 1, [len(rows)]])
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            r, top = rows[a], n[a]
            ties = b if n[b - 1] == top else a + int(np.searchsorted(-n[a:b], -top, "right"))
            word = min(words[a:ties])
            if top > self.n[r] or top == self.n[r] and word < self.best[r]:
                self.n[r], self.best[r] = top, word

    def batch(self) -> pa.RecordBatch:
        has = np.flatnonzero(self.near)
        return pa.record_batch([pa.array(self.words[has], pa.string()), self.near[has], self.n[has], pa.array(self.best[has], pa.string())],
                               names=["word", "n_near", "best_n", "best_word"])


def _search(letters: Letters):
    """Rows of one subtree block follow each other: its words (kind 0), then the words sent to it by kind."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, trie, best = None, None, None
        words: list = []
        counts: list = []
        for batch in batches:
            marks = np.stack([np.array(batch.column(i), np.int64) for i in range(4)])
            n = np.array(batch.column(5))
            cuts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1).tolist(), len(n)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                *key, kind = marks[:, a].tolist()
                if key != now:
                    if best is not None:
                        yield best.batch()
                    now, trie, best, words, counts = key, None, None, [], []
                if kind and not words:
                    continue
                told = batch.column(4).slice(a, b - a).to_pylist()
                if kind == 0:
                    words.extend(told)
                    counts.append(n[a:b])
                    continue
                if trie is None:
                    trie = Trie(words, np.concatenate(counts), letters)
                    best = _Best(trie.words)
                step = max(1, QUERY_POINTS // trie.length)
                for i in range(0, b - a, step):
                    part, m = np.array(told[i:i + step], object), n[a + i:min(b, a + i + step)]
                    own = _Best(part)
                    for q, w in trie.search(_matrix(told[i:i + step], trie.length - (kind == 3)), kind == 3):
                        own.add(q, trie.n[w], trie.words[w])
                        if kind != 1:  # words of one subtree search each other
                            best.add(w, m[q], part[q])
                    yield own.batch()
        if best is not None:
            yield best.batch()

    return run


# --- whole vocabulary -------------------------------------------------------------


def _letter_counts(words: DataFrame) -> list[tuple[str, int]]:
    """Frequencies of the commonest :data:`LETTERS` letters."""
    one = words.select(F.explode(F.split("word", "")).alias("letter")).filter("letter <> ''").groupBy("letter").count()
    top = one.orderBy(F.desc("count"), "letter").limit(LETTERS).collect()
    return [(r["letter"], r["count"]) for r in top if len(r["letter"]) == 1]


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best_word) for each word of ``words`` (word, n; distinct words) that has near ones.

    Near: exactly one code point inserted, deleted or replaced.  ``best_word``: the near
    word of largest n, ties the first in code-point order.
    """
    counts = _letter_counts(words)
    for parts in range(FEWEST_PARTS, MOST_PARTS + 1):
        letters = Letters(counts, parts)
        keyed = words.select("word", "n", F.length("word").alias("length"), *[c.alias(f"l{i}") for i, c in enumerate(_levels(letters), 1)])
        keyed = keyed.withColumn("key", _key([F.col(f"l{i}") for i in range(1, parts)]))
        sizes = keyed.groupBy("length", "key").count()
        mean = sizes.agg(F.sum(F.col("count") * F.col("count")) / F.sum("count")).first()[0] or 0
        if mean <= SUBTREE_WORDS:
            break
    sizes = written(sizes.select("length", "key", F.ceil(F.col("count") * F.col("length") / BLOCK_POINTS).cast("int").alias("blocks")), "spelling-subtrees")
    home = keyed.join(sizes, ["length", "key"]).select("length", "key", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("kind"), "word", "n")
    sent = keyed.select("word", "n", F.explode(_reach(parts)).alias("to")).select("to.length", "to.key", "to.kind", "word", "n")
    sent = sent.join(sizes, ["length", "key"]).select("length", "key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "kind", "word", "n")
    order = ["length", "key", "block"]
    dealt = home.unionAll(sent).repartition(*order).sortWithinPartitions(*order, "kind").select(*order, "kind", "word", "n")
    found = dealt.mapInArrow(_search(letters), _NEAR)
    best = F.min_by(F.struct("best_n", "best_word"), F.struct(-F.col("best_n"), F.col("best_word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", "b.best_n", "b.best_word")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word with a form: each round doubles the steps taken along the forms.

    A form is at least twice as common as its variant, so there are no rings and at most
    as many steps as n has binary digits.
    """
    now = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = written(now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if not new.filter("moved").limit(1).count():
            return new.select("word", "root")
        now = new.select("word", "root")


def variants(counts: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of ``counts`` (word string, n long).

    ``form``: the commonest near word (ties: the first in code-point order) if it occurs at
    least :data:`FORM_RATIO` times as often, else null.  ``root``: the last word on the way
    along the forms, the word itself if it has none.  ``n_near``: how many words are near.

    Null and empty words are left out; repeated words count with the sum of their n; an
    empty table gives no rows; other columns play no part.  Words and links stay on the
    executors: a task holds one block of a subtree's words and a batch of those sent to it.
    """
    words = counts.filter("word <> ''").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    words = written(words, "spelling-words")
    if not words.limit(1).count():
        return words.select("word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("form_n"))
    told = words.join(near_words(words), "word", "left")
    has = F.col("best_n") >= FORM_RATIO * F.col("n")
    told = written(told.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best_word")).alias("form"),
                               F.when(has, F.col("best_n")).alias("form_n")), "spelling-forms")
    roots = _roots(told.filter("form is not null"))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

