"""Prefix trie, best-two-fit packing and spelling variants against brute force, on plain and odd tables."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import best_two_fit, chunks, queries, spelling, trie
from tessera.llm.common import buffers

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- prefix trie ---


def _md5(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def _paths(rows):
    by = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            by[conv].append((turn is not None, turn or 0, role or "", _md5(role or "", text or ""), text or ""))
    return {c: [(r, t) for _, _, r, _, t in sorted(v)] for c, v in by.items()}


def _borrowed(own):
    out = {}
    for c, path in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + path[h:]
    return out


def _nodes(paths):
    members = collections.defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    kids = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * (len(WORD.findall(k[-1][1])) if k else 0)
            leaves[k[:d]] += not kids[k]
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), kids[k], leaves[k], saved[k],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(paths[c]) == len(k)).encode()).hexdigest()) for k, m in members.items())


def _got(nodes):
    return sorted((r["conv_id"], r["depth"], -1 if r["parent_conv_id"] is None else r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"],
                   r["saved_tokens"], r["ends_sha256"]) for r in nodes.collect())


ODD = [(0, 0, "user", "a b c"), (0, 1, "assistant", "d"), (1, None, None, None), (1, 1, "user", "a b c"), (2, 0, "user", "a b c"), (2, 0, "user", "a b c"), (2, 0, "assistant", "a b c"),
       (3, 5, "user", ""), (20, 1, "user", "x " * 50_000), (21, 1, "user", "x " * 50_000), (None, 1, "user", "lost"), (-3, 1, "us", "er:q"), (-4, 1, "user", "q"), (45, 1, "user", "alone")]


@pytest.mark.parametrize("partitions", [1, 5, 40])
def test_trie(spark, partitions):
    rng = random.Random(partitions)
    rows = list(ODD)
    for c in range(100, 400):  # common beginnings, copies, conversations that begin others
        rows += [(c, t, "user", f"t{rng.randint(0, 2)} {'w ' * (t % 3)}") for t in range(rng.randint(1, 6))]
    rows += [(c, t, "user", "hot") for c in range(1000, 1300) for t in range(3)]
    rows += [(c, t, "user", "hot" if t < 40 else f"{c}") for c in (2001, 2002, 2003) for t in range(45)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = turns.withColumns({c: F.lit("x") for c in ("path", "words", "t", "h", "lender", "part", "side", "depth", "n", "ends")}).repartition(4)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        seqs = trie.written(trie.sequences(turns), "t")
        assert _got(trie.prefix_trie(seqs)) == _nodes(_paths(rows))
        borrowed = trie.borrow_heads(seqs, F.expr("conv_id - pmod(conv_id, 20)"), F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4, 3)
        assert _got(trie.prefix_trie(borrowed)) == _nodes(_borrowed(_paths(rows)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_trie_of_nothing(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert trie.prefix_trie(trie.sequences(turns)).count() == 0


def test_spines_wider_than_the_broadcast(spark, monkeypatch, sf_small):
    want = _got(queries.op11_prefix_trie(spark, sf_small))
    monkeypatch.setattr(trie, "BROADCAST_SPINES", 0)
    assert _got(queries.op11_prefix_trie(spark, sf_small)) == want
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert want == _nodes(_borrowed(_paths(rows)))


# --- best-two-fit ---


def _one_at_a_time(lengths, capacity):
    left, bins = sorted(lengths), []
    while left:
        bin_, gap = [], capacity
        while fit := [x for x in left if x <= gap]:
            bin_.append(fit[-1])
            left.remove(fit[-1])
            gap -= fit[-1]
        best, pair = bin_[-1], None
        for i, a in enumerate(left):
            for b in left[:i]:
                if best < a + b <= gap + bin_[-1] and (pair is None or a + b > best or a > pair[0]):
                    best, pair = a + b, (a, b)
        if pair and gap:
            left = sorted([*left, bin_.pop()])
            for x in pair:
                left.remove(x)
                bin_.append(x)
        bins.append(tuple(sorted(bin_, reverse=True)))
    return bins


def test_plan_against_one_bin_at_a_time():
    rng = random.Random(3)
    for i in range(200):
        capacity = rng.choice([4, 9, 30, 64])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 50))]
        if i % 3 == 0:
            lengths = [rng.choice([capacity // 3 or 1, capacity // 2 + 1, 2, capacity]) for _ in range(40)]
        counts = [lengths.count(x) for x in range(capacity + 1)]
        runs = best_two_fit.plan(counts, capacity)
        got = [tuple(x for x, many, _ in r.pattern for _ in range(many)) for r in runs for _ in range(r.times)]
        want = _one_at_a_time(lengths, capacity)
        assert sorted(map(sum, got)) == sorted(map(sum, want)) and sorted(got) == sorted(want)
        assert [r.first for r in runs] == np.cumsum([0, *[r.times for r in runs[:-1]]]).tolist()[:len(runs)]


def test_cut_documents():
    assert best_two_fit.cut(10, 10) == [(0, 10)] and best_two_fit.cut(11, 10) == [(0, 1), (1, 10)] and best_two_fit.cut(30, 10) == [(0, 10), (10, 10), (20, 10)]


TEXTS = [(1, None), (2, ""), (3, "Hello, world of words."), (3, "Hello, world of words."), (None, "one two three"), (4, "wort " * 60_000),
         (5, "\x00   é́ <|endoftext|> 日本   x  y  z\n\n  w it's"), (6, "12 34"), (7, "long" * 5000)]


def _check_pieces(packed, texts):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(queries.bytes_tokenizer_file())
    rows = packed.collect()
    want = collections.Counter()
    for doc_id, text in texts:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 2]
        at = 0
        for k in range(-(-len(ids) // 1024)):
            to = at + (len(ids) % 1024 or 1024 if k == 0 else 1024)
            want[doc_id, k, at, tuple(ids[at:to])] += 1
            at = to
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], tuple(np.frombuffer(r["ids"], np.uint32).tolist())) for r in rows) == want
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert sorted(sum(x for _, x in b) for b in bins.values()) == sorted(map(sum, _one_at_a_time([r["length"] for r in rows], 1024)))


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_packing(spark, sf_small, monkeypatch, broadcast):
    monkeypatch.setattr(best_two_fit, "BROADCAST_STARTS", broadcast)
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    _check_pieces(best_two_fit.pack(docs, queries.bytes_tokenizer_file()), [(r["doc_id"], r["text"]) for r in docs.collect()])
    odd = spark.createDataFrame(TEXTS, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("task", "rank", "piece", "length", "first", "n", "at", "ids")}).repartition(3)
    _check_pieces(best_two_fit.pack(odd, queries.bytes_tokenizer_file()), TEXTS)
    assert best_two_fit.pack(odd.filter("false"), queries.bytes_tokenizer_file()).count() == 0


def test_ids_by_chunk(monkeypatch):
    encode = chunks.ByteLevel(queries.bytes_tokenizer_file())
    rng = random.Random(5)
    signs = "aZÿß½²·×ŋƀ.,'s\n\t\r\x0b\x1c   　\u0085é日🙂0129<|>end!   "
    words = [" the", " <|endoftext|>", "<|endoftext|>", " it's", "   x", "\n  y", " don't", " naïve", " ½"]
    for i in range(60):
        monkeypatch.setattr(chunks, "STORE_CHUNKS", 40 if i % 2 else 500_000)
        texts = ["".join(rng.choice(signs) if rng.random() < 0.8 else rng.choice(words) for _ in range(rng.randint(0, 30))) for _ in range(80)]
        ids, at = encode(*buffers(pa.array(texts)))
        for a, b, text in zip(at[:-1], at[1:], texts):
            assert ids[a:b].tolist() == encode.whole.encode(text, add_special_tokens=False).ids
        assert len(encode.store.hashes) <= chunks.STORE_CHUNKS


def test_ranges_of_one_hash(monkeypatch):
    """Ranges that share the first hash are told apart by the second one."""
    calls = iter([lambda x: x[0], sum])

    def spans(raw, starts, ends):
        f = next(calls)
        return np.array([f(raw[a:b].tolist()) for a, b in zip(starts, ends)], np.uint64)

    monkeypatch.setattr(chunks, "spans", spans)
    store = chunks.Store(lambda texts: (np.array([ord(t[-1]) for t in texts], np.uint32), np.ones(len(texts), np.int64)))
    ids, many = store(np.frombuffer(b"abacab", np.uint8), np.array([0, 2, 4]), np.array([2, 4, 6]))
    assert ids.tolist() == [ord("b"), ord("c"), ord("b")] and many.tolist() == [1, 1, 1]


# --- spelling ---


def _vocabulary(rows, every):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if every and doc_id is not None and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def _variants(words):
    near, holes = collections.defaultdict(set), collections.defaultdict(list)
    for w in words:
        for k in range(len(w)):
            rest = w[:k] + w[k + 1:]
            holes[k, rest].append(w)
            if rest in words:
                near[w].add(rest)
                near[rest].add(w)
    for group in holes.values():
        for w in group:
            near[w].update(x for x in group if x != w)
    form = {}
    for w, n in words.items():
        if near[w]:
            f = min(near[w], key=lambda x: (-words[x], x))
            if words[f] >= 2 * n:
                form[w] = f
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return sorted(out, key=str)


def _told(df):
    return sorted((tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()), key=str)


SPELT = [(1, None), (2, ""), (None, "alphabet alphabet alphabet"), (3, "Étés alphabets, ALPHABETS; alphabets×alphabets÷ ÀÉÎÕÜÿ àéîõüÿ àéîõüÿ ÀÉÎÕÜÿ 日本 été" * 3), (3, "alphabets " * 9),
         (4, "x" * 300 + " " + "x" * 299 + "y " + "x" * 299 + " "), (4, ("x" * 300 + " " + "x" * 299 + "y " + "x" * 299 + " ") * 3), (5, "abcdefgh " * 5000), (6, "abcdefg abcdfgh abcdefgg bcdefgh " * 4)]


def test_vocabulary(spark, monkeypatch):
    odd = spark.createDataFrame(SPELT, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("word", "n", "id", "length", "key", "form", "root")}).repartition(2)
    for every in (None, 97, 3):
        assert {r["word"]: r["n"] for r in spelling.vocabulary(odd, delete_every=every).collect()} == _vocabulary(SPELT, every)
    assert spelling.vocabulary(odd.filter("false")).count() == 0
    got = spelling.variants(spelling.vocabulary(odd, delete_every=97))
    assert _told(got) == _variants(_vocabulary(SPELT, 97))
    assert spelling.variants(spelling.vocabulary(odd.filter("false"))).count() == 0


def test_long_texts_are_cut_between_runs(monkeypatch):
    monkeypatch.setattr(spelling, "STEP_BYTES", 7)
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcÉè  ,日") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    raw, offsets = buffers(pa.array(texts))
    got = collections.Counter()
    for rows, starts, ends in spelling._parts(raw, offsets):
        words, n = spelling._words(raw, rows, starts, ends, list(range(len(texts))), 5, 2)
        for w, k in zip(words.to_pylist(), n.tolist()):
            got[w] += k
    want = collections.Counter()
    for i, text in enumerate(texts):
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            h = zlib.crc32(f"{i}:{run}".encode())
            if len(run) >= 2:
                want[run[:h % len(run)] + run[h % len(run) + 1:] if h % 5 == 0 else run] += 1
    assert got == want


@pytest.mark.parametrize("small", [False, True])
def test_variants(spark, monkeypatch, small):
    if small:  # many blocks, batches and levels
        for name, value in (("SUBTREE_WORDS", 2), ("BLOCK_POINTS", 60), ("QUERY_POINTS", 100), ("VERIFY_POINTS", 50), ("MOST_PARTS", 6)):
            monkeypatch.setattr(spelling, name, value)
        monkeypatch.setattr(spelling, "LEAF_PAIRS", 3)
    rng = random.Random(11)
    words = {"".join(rng.choice("abéz") for _ in range(rng.randint(1, 7))): rng.randint(1, 40) for _ in range(900)}
    words |= {"ɓ日abc": 5, "ɓ本abc": 50, "a" * 200: 3, "a" * 201: 9, "ab" * 100: 4}
    counts = spark.createDataFrame([*words.items(), (None, 3), ("", 4)], "word string, n long")
    assert _told(spelling.variants(counts)) == _variants(words)


def test_queries_against_brute_force(spark, sf_small):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    assert _told(queries.op13_spelling(spark, sf_small)) == _variants(_vocabulary(rows, 97))
