"""Conversation prefix trie: union-find over sorted-neighbour LCP edges in descending depth.

A conversation is the path of its turns' digests (16 bytes a turn), so sorting paths puts
conversations with a common beginning side by side.  Distinct paths are range-partitioned.
Every task joins its neighbours by the length of their longest common prefix (LCP), deepest
first: a merge of two components makes the branching node at that depth (or joins the one
that is there).  What lies on the paths of a partition's first and last row may go on in
the next partition: these two spines, with what hangs off them added up, are the contracted
forest.  The spines of all partitions are merged across the boundaries in path order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: A word: bytes other than space and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of a turn's digest.
DIGEST = 16
#: Conversation ids (by their higher bits) that are put together before a digest of ids reads them.
ID_BITS = 12
#: Bytes of paths that one range partition is planned for.
PART_BYTES = 32_000_000
#: Merged spine rows up to which they are broadcast (about 40 bytes each); a shuffle join beyond.
BROADCAST_SPINES = 200_000
#: Rows of an output batch.
BATCH_ROWS = 50_000

EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_DISTINCT = "path binary, words array<int>, n long, least long, ends string"
_FOREST = ("part long, side int, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved long, ends string, "
           "open boolean, digest binary, words long, parent long, parent_side int, parent_depth long")
_SPINES = "part long, side int, depth long, conv_id long, first boolean, n_convs long, n_children long, n_leaves long, saved long, ends string, parent_side int, parent_depth long"
_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}


def _arrow(schema: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (f.split(" ") for f in schema.split(", "))])


def sequences(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, path, words) for each conversation: its turns' digests end to end, and their word counts.

    Turns go by number, null first; equal numbers by role, then by digest.  A null role or
    text is empty.  Rows without a conversation id belong to no conversation.  Only digests
    are shuffled; one task holds one conversation's (about 60 bytes a turn).
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    narrow = turns.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.struct(F.col(turn_col).cast("long").alias("turn"), role.alias("role"), digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).alias("words")).alias("t"),
    )
    ordered = narrow.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return ordered.select("conv_id", F.unhex(F.array_join("t.digest", "")).alias("path"), F.col("t.words").alias("words"))


def borrow_heads(seqs: DataFrame, lender: Column, turns: Column, most: int) -> DataFrame:
    """Each conversation with its first ``turns`` (at most ``most``) turns replaced by those of conversation ``lender``.

    A lender with fewer turns lends all it has, an absent one none.  Only the lenders' first
    ``most`` digests are joined.
    """
    heads = seqs.select(F.col("conv_id").alias("lender"), F.substring("path", 1, DIGEST * most).alias("head"), F.slice("words", 1, most).alias("head_words"))
    own = seqs.withColumn("lender", lender).withColumn("h", turns.cast("int")).join(heads, "lender", "left")
    none = F.array().cast("array<int>")
    # binary: substring counts bytes
    path = F.concat(F.coalesce(F.expr(f"substring(head, 1, {DIGEST} * h)"), F.lit(b"")), F.expr(f"substring(path, {DIGEST} * h + 1)"))
    words = F.concat(F.coalesce(F.expr("slice(head_words, 1, h)"), none), F.expr("slice(words, h + 1, size(words))"))
    return own.select("conv_id", path.alias("path"), words.alias("words"))


# --- distinct paths ---------------------------------------------------------------


def _distinct(seqs: DataFrame) -> DataFrame:
    """(path, words, n, least, ends) for each distinct path; ``ends``: the digest of its conversations' ids.

    A digest of ids reads them in order, so one task streams a path's; up to 4,096 ids are
    put together first, and nothing of a path is held but the digest's state.
    """
    blocks = seqs.groupBy("path", "words", F.shiftright("conv_id", ID_BITS).alias("block")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    blocks = blocks.select("path", "words", "block", F.size("ids").cast("long").alias("n"), F.col("ids")[0].alias("least"), F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, now, rows = _arrow(_DISTINCT), None, []

        def row() -> tuple:
            return now[0], now[1], now[2], now[3], now[4].hexdigest()

        for batch in batches:
            for path, words, n, least, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now[0] != path:
                    if now is not None:
                        rows.append(row())
                    now = [path, words, n, least, hashlib.sha256(ids.encode())]
                else:
                    now[2] += n
                    now[4].update(b"," + ids.encode())
            if len(rows) >= 1000:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows = []
        if now is not None:
            rows.append(row())
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return blocks.repartition("path").sortWithinPartitions("path", "block").select("path", "words", "n", "least", "ids").mapInArrow(run, _DISTINCT)


# --- one partition's forest -------------------------------------------------------


def _common_turns(digests: np.ndarray, at: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """LCP in turns of each path with the one before it (the first: 0)."""
    lcp = np.zeros(len(lens), np.int64)
    pair, k = np.arange(1, len(lens)), 0
    while len(pair):
        pair = pair[(lens[pair] > k) & (lens[pair - 1] > k)]
        pair = pair[(digests[at[pair] + k] == digests[at[pair - 1] + k]).all(axis=1)]
        k += 1
        lcp[pair] = k
    return lcp


def join_neighbours(lens: list[int], lcp: np.ndarray) -> tuple[list[int], list[int]]:
    """(depth, parent) of each node: rows first, then the branching nodes; the top's parent is -1.

    Edges in descending depth, equal ones from left to right: so the right component's top
    is always deeper than the edge, and the left one's is the branching node if it is not.
    """
    n = len(lens)
    depth, parent = list(lens), [-1] * n
    root, top = list(range(n)), list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    edges = np.arange(1, n)
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    for i, d in zip(edges.tolist(), lcp[edges].tolist()):
        a, b = find(i - 1), find(i)
        node = top[a]
        if depth[node] != d:
            depth.append(d)
            parent.append(-1)
            parent[node] = node = len(depth) - 1
        parent[top[b]] = node
        root[b], top[a] = a, node
    return depth, parent


def _forest(part: int, paths: list[bytes], words: list[list[int]], n: list[int], least: list[int], ends: list[str]) -> Iterator[pa.RecordBatch]:
    """Closed nodes in full, and the two spines of one partition's sorted paths."""
    rows = len(paths)
    lens = np.array([len(p) // DIGEST for p in paths], np.int64)
    at = np.concatenate([[0], np.cumsum(lens)])
    digests = np.frombuffer(b"".join(paths), np.uint64).reshape(-1, 2)
    flat = np.array([w for ws in words for w in ws], np.int64)
    upto = np.concatenate([[0], np.cumsum(flat)])
    depth, parent = join_neighbours(lens.tolist(), _common_turns(digests, at, lens))
    nodes = len(depth)
    n, least = [*n, *[0] * (nodes - rows)], [*least, *[1 << 62] * (nodes - rows)]
    row_of = [*range(rows), *[-1] * (nodes - rows)]
    spine = [0] * nodes  # 1: the first row's, 2: the last row's, 3: both
    for start, bit in ((0, 1), (rows - 1, 2)):
        v = start
        while v >= 0:
            spine[v] |= bit
            v = parent[v]
    kids, leaves, saved = [0] * nodes, [0] * nodes, [0] * nodes
    hung_kids, hung_leaves, hung_saved = [0] * nodes, [0] * nodes, [0] * nodes

    def words_to(v: int, d: int) -> int:
        return int(upto[at[row_of[v]] + d] - upto[at[row_of[v]]]) if d > 0 else 0

    for v in np.argsort(-np.array(depth), kind="stable").tolist():  # children before parents
        d, u = depth[v], parent[v]
        if not kids[v]:
            leaves[v] = 1
        saved[v] += (n[v] - 1) * (words_to(v, d) - words_to(v, d - 1))
        if u < 0:
            continue
        if row_of[u] < 0:
            row_of[u] = row_of[v]
        n[u], least[u], kids[u], leaves[u] = n[u] + n[v], min(least[u], least[v]), kids[u] + 1, leaves[u] + leaves[v]
        all_saved = saved[v] + (n[v] - 1) * (words_to(v, d - 1) - words_to(v, depth[u]))
        saved[u] += all_saved
        if not spine[v]:
            hung_kids[u], hung_leaves[u], hung_saved[u] = hung_kids[u] + 1, hung_leaves[u] + leaves[v], hung_saved[u] + all_saved

    schema = _arrow(_FOREST)
    # Closed nodes: each stands for its chain of depths below its parent's.
    dep, par, row_at = np.array(depth), np.array(parent), np.array(row_of)
    sides = np.array([1 if s == 2 else 0 for s in spine])
    closed = np.flatnonzero(np.array(spine) == 0)
    length = dep[closed] - dep[par[closed]]
    cuts = np.searchsorted(np.cumsum(length), np.arange(BATCH_ROWS, int(length.sum()) + BATCH_ROWS, BATCH_ROWS)) + 1 if len(closed) else []
    n_, least_, kids_, leaves_, saved_ = (np.array(x, np.int64) for x in (n, least, kids, leaves, saved))
    is_open = np.array(spine) != 0
    done = 0
    for to in cuts:
        chosen = closed[done:to]
        done = max(done, to)
        if not len(chosen):
            continue
        many = dep[chosen] - dep[par[chosen]]
        v = np.repeat(chosen, many)
        k = np.arange(len(v)) - np.repeat(np.cumsum(many) - many, many) + 1 + dep[par[v]]
        base = at[row_at[v]]
        end, first = k == dep[v], k == dep[par[v]] + 1
        more = np.where(end, 0, (n_[v] - 1) * (upto[base + dep[v] - 1] - upto[base + k - 1]))
        ref = first & is_open[par[v]]
        above = np.where(first, least_[par[v]], least_[v])
        own = [ends[x] if e and x < rows else EMPTY_SHA for x, e in zip(v.tolist(), end.tolist())]
        yield pa.record_batch([
            np.full(len(v), part), np.full(len(v), -1, np.int32), k, least_[v], n_[v], np.where(end, kids_[v], 1), leaves_[v], saved_[v] + more,
            pa.array(own), np.zeros(len(v), bool), pa.nulls(len(v), pa.binary()), pa.nulls(len(v), pa.int64()),
            pa.array(above, mask=ref), pa.array(sides[par[v]].astype(np.int32), mask=~ref), pa.array(dep[par[v]], mask=~ref),
        ], schema=schema)
    # The spines, a row for each depth.
    shared = depth[parent.index(-1)]
    out = []
    for start, bit, side, lowest in ((0, 1, 0, 0), (rows - 1, 2, 1, shared + 1)):
        way, v = [], start
        while v >= 0:
            way.append(v)
            v = parent[v]
        for v in reversed(way):
            above = depth[parent[v]] if parent[v] >= 0 else -1
            for d in range(max(above + 1, lowest), depth[v] + 1):
                end, row = d == depth[v], row_of[v]
                digest = paths[row][DIGEST * (d - 1):DIGEST * d] if d else b""
                out.append((part, side, d, least[v], n[v], hung_kids[v] if end else 0, hung_leaves[v] if end else 0, hung_saved[v] if end else 0,
                            ends[v] if end and v < rows else None, True, digest, int(flat[at[row] + d - 1]) if d else 0, None,
                            None if d == 0 else 0 if side == 0 or d == shared + 1 else 1, d - 1 if d else None))
                if len(out) >= BATCH_ROWS:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out = []
    if out:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    columns = [[], [], [], [], []]
    for batch in batches:
        for held, column in zip(columns, batch.columns):
            held.extend(column.to_pylist())
    if columns[0]:
        yield from _forest(TaskContext.get().partitionId(), *columns)


# --- merging across boundaries ----------------------------------------------------


class _Node:
    __slots__ = ("digest", "words", "n", "least", "kids", "leaves", "saved", "ends", "keys", "up")

    def __init__(self, digest, words, up):
        self.digest, self.words, self.up = digest, words, up
        self.n, self.least, self.kids, self.leaves, self.saved, self.ends, self.keys = 0, 1 << 62, 0, 0, 0, None, []


def _merge_spines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spine rows by partition, side and depth -> one row per spine row with its merged node's values.

    Only the path at hand is held: a node is done when the next path parts from it.
    """
    schema, stack, out = _arrow(_SPINES), [], []

    def close(to: int) -> None:
        while len(stack) > to:
            node = stack.pop()
            if not node.kids:
                node.leaves = 1
            node.saved += (node.n - 1) * node.words
            if stack:
                up = stack[-1]
                up.kids, up.leaves, up.saved = up.kids + 1, up.leaves + node.leaves, up.saved + node.saved
            for i, key in enumerate(node.keys):
                out.append((*key, node.least, i == 0, node.n, node.kids, node.leaves, node.saved, node.ends or EMPTY_SHA, *node.up))

    def batch() -> pa.RecordBatch:
        rows = list(zip(*out))
        out.clear()
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)

    part, on = None, False
    for got in batches:
        for p, side, d, least, n, kids, leaves, saved, ends, digest, words, up_side, up_depth in zip(*(c.to_pylist() for c in got.columns)):
            if p != part:
                part, on = p, True  # on: the path so far is the one at hand
            on = on and side == 0 and d < len(stack) and stack[d].digest == digest
            if not on:
                close(d)
                stack.append(_Node(digest, words, (up_side, up_depth)))
            node = stack[d]
            node.n, node.least, node.kids, node.leaves, node.saved = node.n + n, min(node.least, least), node.kids + kids, node.leaves + leaves, node.saved + saved
            node.ends = node.ends or ends
            node.keys.append((p, side, d))
        if len(out) >= BATCH_ROWS:
            yield batch()
    close(0)
    if out:
        yield batch()


def prefix_trie(seqs: DataFrame) -> DataFrame:
    """Every node of the trie of ``seqs`` (conv_id, path, words as in :func:`sequences`; one row per conversation).

    Returns conv_id (smallest member), depth, parent_conv_id (its parent's smallest member;
    root: null), n_convs (members), n_children, n_leaves (childless nodes in its subtree),
    saved_tokens (over its subtree, (n_convs - 1) times the words of the node's last turn),
    ends_sha256 (of the ascending, comma-joined ids of the members that end here).

    Equal conversations are members of one path; one without turns ends at the root; an
    empty table has no nodes.  Two turns are one if their 128-bit digests are.  A task holds
    one range partition's distinct paths (:data:`PART_BYTES` planned); one task reads the
    spines, two paths for each partition, and holds one path.
    """
    spark = seqs.sparkSession
    distinct = written(_distinct(seqs), "trie-paths")
    size = distinct.agg(F.sum(F.length("path") + 100)).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    ranged = distinct.repartitionByRange(parts, "path").sortWithinPartitions("path")
    nodes = written(ranged.mapInArrow(_forests, _FOREST), "trie-nodes")
    spines = nodes.filter("open").repartition(1).sortWithinPartitions("part", "side", "depth")
    spines = spines.select("part", "side", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends", "digest", "words", "parent_side", "parent_depth")
    merged = written(spines.mapInArrow(_merge_spines, _SPINES), "trie-spines")
    up = merged.select("part", F.col("side").alias("parent_side"), F.col("depth").alias("parent_depth"), F.col("conv_id").alias("above"))
    up = F.broadcast(up) if up.count() <= BROADCAST_SPINES else up
    columns = ["part", "conv_id", "depth", "parent", "n_convs", "n_children", "n_leaves", "saved", "ends", "parent_side", "parent_depth"]
    every = nodes.filter("not open").select(columns).unionAll(merged.filter("first").withColumn("parent", F.lit(None).cast("long")).select(columns))
    return every.join(up, ["part", "parent_side", "parent_depth"], "left").select(
        "conv_id", "depth", F.coalesce("parent", "above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))
