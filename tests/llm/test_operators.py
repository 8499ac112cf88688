"""The ten operators against brute force, round trips and held-out accuracy, and on odd tables."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import chat, langid, license, lm, minhash, mixing, packing, queries, rabitq, urls, winnowing
from tessera.llm.common import written

LONG = "wort " * 60_000
ODD = [(1, None, "en", "s"), (2, "", None, None), (3, "Hello, world of words.", "en", "s"), (3, "Hello, world of words.", "en", "s"),
       (None, "one two three four five six", "de", "t"), (4, LONG, "de", "t"), (5, "\x00 \u2028 é́ <|endoftext|> 日本", "fr", "u"), (6, "12 34", None, "s")]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, very long and repeated texts, and columns named like the operators' own."""
    df = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string")
    return df.withColumns({c: F.lit("x") for c in ("start", "length", "ids", "score", "lang_pred", "digest", "cluster", "row", "mix_epoch", "found", "range", "train", "block")})


@pytest.fixture(scope="module")
def none(odd):
    return odd.filter("false")


@pytest.fixture(scope="module")
def docs(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")


# --- packing ---


def _check_packing(packed, rows):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(queries.tokenizer_file())
    got = packed.collect()
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at and len(r["ids"]) == 4 * r["length"]
            at += r["length"]
        assert at == s[0]["sequence_length"] <= 2048
    want = collections.defaultdict(list)
    for doc_id, text in rows:
        want[doc_id].append([*whole.encode(text or "", add_special_tokens=False).ids, 1])
    for doc_id, lists in want.items():
        found = by_doc.pop(doc_id)
        assert sum(r["length"] for r in found) == sum(map(len, lists))
        if len(lists) == 1:
            pieces = sorted(found, key=lambda r: r["start"])
            assert np.frombuffer(b"".join(r["ids"] for r in pieces), np.uint32).tolist() == lists[0]
            assert {r["doc_tokens"] for r in found} == {len(lists[0])}
    assert not by_doc
    used = [s[0]["sequence_length"] for s in by_seq.values()]
    return sum(0 if n & (n - 1) == 0 else 2048 - n for n in used) / max(1, sum(used))


def test_packing(spark, docs, odd, none):
    assert _check_packing(packing.pack(docs, queries.tokenizer_file()), [(r["doc_id"], r["text"]) for r in docs.collect()]) < 0.02
    _check_packing(packing.pack(odd, queries.tokenizer_file()), [(r[0], r[1]) for r in ODD])
    assert packing.pack(none, queries.tokenizer_file()).count() == 0


def test_more_words_than_the_store_holds(monkeypatch):
    from tokenizers import Tokenizer

    file = queries.tokenizer_file()
    whole = Tokenizer.from_file(file)
    monkeypatch.setattr(packing, "CACHE_WORDS", 4)
    monkeypatch.setattr(packing, "PART_WORDS", 3, raising=False)
    encode = packing.WordIds(file)
    steps = [["the of"], ["the of and in to a is, it. 12 x=7 été the\nof"], [""], ["the", "of 99 the of and"], ["a b c d e f g h", "h g f e d c b a the 日本 the"]]
    for texts in steps:
        got = [np.frombuffer(x, np.uint32).tolist() for x in encode(texts)]
        assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(encode.chunks) <= 4 and len(encode.plain) <= 4


def test_cut_lengths():
    for n in [1, 2, 3, 100, 1024, 1025, 1500, 2047, 2048, 2049, 50_000]:
        pieces = packing.cut(n, 2048)
        assert sum(p for p, _ in pieces) == n
        assert all(2048 / (k + 1) < p * 1.002 and p * k <= 2048 and 2048 - p * k <= 2048 / 64 + k for p, k in pieces)


# --- licences ---


def test_license(spark, docs, odd, none):
    model = license.train(license.sample_lines(docs))
    texts = [(1, "Prose first.\nReleased under the MIT License.\nMore prose."), (2, "the license plate of the public car, version 3"),
             (3, "filler words " * 50 + "This work is licensed under the GNU General Public License, version 3."), (4, None), (5, "")]
    got = {r["doc_id"]: r["found"] for r in license.scan(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()}
    assert [f["family"] for f in got[1]] == ["mit"] and texts[0][1][got[1][0]["start"]:got[1][0]["end"]].startswith("Released under the MIT")
    assert got[2] == [] and {f["family"] for f in got[3]} == {"gpl"} and got[4] == got[5] == []
    lines = {"apache": "Licensed under the Apache License, Version 2.0.", "mit": "Released under the MIT License.", "cc-by-nc": "Licensed under CC BY-NC 4.0.",
             "gpl": "This work is licensed under the GNU General Public License, version 3.", "proprietary": "All rights reserved."}
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in license.scan(docs, model).collect():
        assert {f["family"] for f in r["found"]} == {k for k, v in lines.items() if v in text[r["doc_id"]]}
    assert license.scan(odd, model).count() == len(ODD) and license.scan(none, model).count() == 0


def test_license_short_notice(spark, docs):
    assert not any("rights reserved" in line.lower() for line in license.sample_lines(docs))
    model = license.train(license.sample_lines(docs))
    texts = [(1, "All rights reserved."), (2, "Prose first.\nAll rights reserved."), (3, "They reserved all the rights."), (4, "All rights reserved.\r\nProse.")]
    got = {r["doc_id"]: r["found"] for r in license.scan(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1), model).collect()}
    assert [[f["family"] for f in got[i]] for i in (1, 2, 3, 4)] == [["proprietary"], ["proprietary"], [], ["proprietary"]]
    found = {r["doc_id"]: {f["family"] for f in r["found"]} for r in license.scan(docs, model).collect()}
    noted = {r["doc_id"] for r in docs.collect() if "All rights reserved." in r["text"]}
    assert noted and {i for i, f in found.items() if "proprietary" in f} == noted


WRAPPED = {
    "apache": "Licensed under the Apache\nLicense, Version 2.0 (the \"License\"); you may\nnot use this file except in compliance\nwith the License.",
    "bsd": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:",
    "cc-by": "This work is licensed under a Creative\nCommons Attribution 4.0\nInternational License.",
    "cc-by-nc": "This work is licensed under a Creative\nCommons Attribution-NonCommercial 4.0\nInternational License.",
    "gpl": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights",
    "mpl": "This Source Code Form is subject\nto the terms of the Mozilla\nPublic License, v. 2.0.",
    "proprietary": "Confidential and proprietary. Unauthorized\ncopying of this file, via any\nmedium, is strictly prohibited.",
}


def test_license_hard_wrapped(spark, docs):
    model = license.train(license.sample_lines(docs))
    texts = [t for notice in WRAPPED.values() for t in (notice, "Prose.\n\n" + notice.replace("\n", "\r\n") + "\n\nProse.", "# " + notice.replace("\n", "\n# "))]
    texts.append(WRAPPED["cc-by"].replace("\n", "\n\n"))  # blank lines part
    got = {r["doc_id"]: [f["family"] for f in r["found"]] for r in license.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    assert [set(got[i]) for i in range(len(texts))] == [*({family} for family in WRAPPED for _ in range(3)), set()]


def test_license_several_families(spark, docs):
    model = license.train(license.sample_lines(docs))
    notices = {"mit": "Released under the MIT License.", "apache": "Licensed under the Apache License, Version 2.0.", "gpl": "This work is licensed under the GNU General Public License, version 3.",
               "cc-by": "Licensed under CC BY 4.0.", "cc-by-nc": "Licensed under CC BY-NC 4.0.", "bsd": "Released under the BSD 3-Clause License.", "mpl": "Licensed under the Mozilla Public License 2.0.", "proprietary": "All rights reserved."}
    prose = "They went to the old mill by the river and sat in the shade until the sun was low. " * 2
    rows = [((a, b), f"{notices[a]} {notices[b]}") for a in notices for b in notices if a != b]
    rows += [((a,), prose + notices[a].replace(" ", "\n", 1) + " " + prose) for a in notices]
    rows += [(("mit", "cc-by", "proprietary"), " ".join(notices[a] for a in ("mit", "cc-by", "proprietary"))), ((), prose)]
    found = {r["doc_id"]: r["found"] for r in license.scan(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string"), model).collect()}
    for i, (families, text) in enumerate(rows):
        assert {f["family"] for f in found[i]} == set(families), text
        assert all(0 <= f["start"] < f["end"] <= len(text) and f["probability"] >= license.LEAST_PROBABILITY for f in found[i])


# --- language ---


def test_language(spark, docs, odd, none):
    net = langid.fit(docs.filter("doc_id % 5 <> 0"))
    got = {r["doc_id"]: r for r in langid.predict(docs, net).collect()}
    held = [r for r in docs.collect() if r["doc_id"] % 5 == 0]
    assert np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held]) >= 0.95
    rows = langid.predict(odd, net).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 6)} == {"und"}
    assert langid.predict(none, net).count() == 0 and langid.fit(none) is None
    assert {r["lang_pred"] for r in langid.predict(odd, None).collect()} == {"und"}


def test_language_windows_match_direct_convolution():
    rng = np.random.default_rng(0)
    net = langid.Network(["a", "b"], [rng.standard_normal((w, 256, langid.FILTERS)).astype(np.float32) for w in langid.WIDTHS], np.zeros(24, np.float32), np.ones((24, 2), np.float32), np.zeros(2, np.float32))
    for t in net.tables:
        t[:, 0] = 0
    raw = rng.integers(1, 256, 700).astype(np.uint8)
    windows, row = langid.windows_of(raw, np.array([0, 40, 40, 700]))
    assert row.tolist() == [0, 2, 2, 2] and bytes(windows[3]) == bytes(raw[-256:])
    for w, pooled in zip(windows, net.pooled(windows)):
        padded = np.append(w, np.zeros(4, np.uint8))
        want = np.concatenate([np.max([sum(t[j, padded[i + j]] for j in range(len(t))) for i in range(256)], axis=0) for t in net.tables])
        np.testing.assert_allclose(pooled, want, rtol=1e-4, atol=1e-4)


# --- near-duplicates ---


def _classes(rows, weights):
    """Least id by connected pairs of at least 0.8 (less rounding), all pairs compared."""
    import pyarrow as pa

    texts = sorted({t or "" for _, t in rows})
    vectors = [dict(zip(f.tolist(), weights(f, c).tolist())) for _, f, c in minhash.document_shingles(pa.record_batch([pa.array(texts)], names=["t"]), 0)]
    parent = list(range(len(texts)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(texts)):
        for j in range(i):
            both = sum(min(w, vectors[j][s]) for s, w in vectors[i].items() if s in vectors[j])
            if both and both >= (0.8 - 1e-12) * (sum(vectors[i].values()) + sum(vectors[j].values()) - both):
                parent[find(i)] = find(j)
    place = {t: find(i) for i, t in enumerate(texts)}
    least = {}
    for doc_id, t in rows:
        least[place[t or ""]] = min(doc_id, least.get(place[t or ""], doc_id))
    return {doc_id: least[place[t or ""]] for doc_id, t in rows}


def test_near_duplicates(spark, monkeypatch):
    monkeypatch.setattr(minhash, "TEXT_BLOCK", 8)  # groups in several blocks
    monkeypatch.setattr(minhash, "BUCKET_BLOCK", 16)
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 5))
    rows, passage = [], " ".join(word() for _ in range(60))
    for g in range(40):
        base = [word() for _ in range(rng.integers(20, 300))]
        for c in range(30 if g == 0 else int(rng.integers(1, 5))):
            words = list(base)
            for _ in range(int(len(words) * rng.choice([0, 0.005, 0.01, 0.03]))):
                words[rng.integers(len(words))] = word()
            rows.append((len(rows), " ".join(words) + ("\n" + passage if g % 3 == 0 else "")))
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, "short text"), (len(rows) + 3, "Short  TEXT"), (len(rows) + 4, "...")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    n = len(rows)
    weights = minhash.Weights(*minhash.frequent_shingles(df.select("text"), n), n)
    assert len(weights.frequent)  # the passage
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(df).collect()}
    assert got == _classes(rows, weights)


@pytest.mark.parametrize("common, slice_bytes, most", [(0.5, 24_000_000, 1_000_000), (0.02, 2000, 300)])
def test_near_duplicates_weigh_every_frequency(spark, monkeypatch, common, slice_bytes, most):
    """Shingles in two and in nine rows of a hundred weigh less than those of one row; weights from words, not from the operator."""
    monkeypatch.setattr(minhash, "COMMON", common)  # all by shuffle, and most counted beforehand
    monkeypatch.setattr(minhash, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(minhash, "DEAL", most)
    rng = np.random.default_rng(8)
    text = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), 7)) for _ in range(n))
    nine, two, twice = text(100), text(100), text(80)
    rows = [f"{nine} {text(10)}" for _ in range(9)] + [f"{two} {text(10)}" for _ in range(2)] + [twice] * 3 + [f"{twice} {text(4)}"]
    rows += [text(60) for _ in range(100 - len(rows))]
    words = [t.split() for t in rows]
    counts = [collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) for w in words]
    df = collections.Counter(s for c in counts for s in c)
    idf = {s: 1 + math.log((1 + len(rows)) / (1 + n)) for s, n in df.items()}

    def likeness(a, b):
        both, any_ = (sum(idf[s] * pick(a[s], b[s]) for s in a.keys() | b.keys()) for pick in (min, max))
        return both / any_

    want = [min(j for j in range(len(rows)) if likeness(counts[i], counts[j]) >= 0.8) for i in range(len(rows))]
    assert want[:12] == [*range(9), 9, 9, 11] and want[11:15] == [11] * 4
    got = minhash.near_duplicates(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()
    assert [r["class_id"] for r in sorted(got)] == want


@pytest.mark.parametrize("block, common", [(256, 0.05), (4, 0.5)])
def test_near_duplicates_count_a_class_once(spark, monkeypatch, block, common):
    """A large group's own frequency keeps none of its near copies out; in one task, and in pairs of blocks.  With 0.05 the hot text is common."""
    monkeypatch.setattr(minhash, "TEXT_ENTRIES", 120 * block)
    monkeypatch.setattr(minhash, "COMMON", common)
    rng = np.random.default_rng(21)
    text = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), 7)) for _ in range(n))
    base, hot, pair = text(100), text(120), text(100)
    rows = [base] * 6 + [f"{base} {text(n)}" for n in (2, 3, 4, 5, 6, 16, 18, 20, 22, 60)] + [hot] * 30 + [f"{hot} {text(24)}"]
    rows += [f"{pair} {text(12)}" for _ in range(8)]  # none near enough to begin with
    rows += [text(60) for _ in range(400 - len(rows))]
    n = len(rows)
    counts = [collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) for w in map(str.split, rows)]
    df = collections.Counter(s for c in counts for s in c)

    def classes(held, label):
        idf = {s: 1 + math.log((1 + n) / (1 + k)) for s, k in held.items()}
        label = list(label)
        for i in range(60):
            for j in range(i):
                both, any_ = (sum(idf[s] * pick(counts[i][s], counts[j][s]) for s in counts[i].keys() | counts[j].keys()) for pick in (min, max))
                if both >= 0.8 * any_:
                    new, old = sorted((label[i], label[j]))
                    label = [new if k == old else k for k in label]
        return label

    plain = classes(df, range(n))
    want, before = plain, None
    while want != before:
        before = want
        once = collections.Counter(s for k in set(want) for s in {s for c, own in zip(counts, want) if own == k for s in c})
        want = classes({s: k if k >= common * n else once[s] for s, k in df.items()}, want)
    joined = {i for i in range(n) if plain[i] != want[i]}
    assert joined == ({11, 12, 13, 46} if common == 0.5 else {11, 12, 13}) and want[14:16] == [14, 15] and want[47:55] == [*range(47, 55)]
    got = minhash.near_duplicates(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()
    assert [r["class_id"] for r in sorted(got)] == want


def test_copy_links(spark, monkeypatch):
    monkeypatch.setattr(minhash, "HOT", 4)  # text a is hot, b and c go through the shuffle join
    rows = [(i, "a") for i in range(30, 0, -1)] + [(40, "b"), (41, "b"), (42, "c"), (43, "c"), (44, "c"), (50, "d")]
    got = sorted(tuple(r) for r in minhash.copy_links(spark.createDataFrame(rows, "doc_id long, digest string"), len(rows)).collect())
    assert got == [(i, 1) for i in range(2, 31)] + [(41, 40), (43, 42), (44, 42)]


def test_near_duplicates_odd(odd, none):
    rows = minhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    assert {r["doc_id"]: r["class_id"] for r in rows} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, None: None}
    assert minhash.near_duplicates(none).count() == 0


def test_samples_collide_as_often_as_the_similarity():
    rng = np.random.default_rng(1)
    shared, hits, trials = 0, 0, 0
    for _ in range(60):
        keys = np.sort(rng.integers(0, 1 << 63, 150).astype(np.uint64))
        a, b = rng.integers(1, 4, 150).astype(float), rng.integers(1, 4, 150).astype(float)
        a[:20] = b[-20:] = 0
        hits += (minhash.samples(keys[a > 0], a[a > 0]) == minhash.samples(keys[b > 0], b[b > 0])).sum()
        trials += minhash.SAMPLES
        shared += np.minimum(a, b).sum() / np.maximum(a, b).sum() * minhash.SAMPLES
    assert abs(hits - shared) / trials < 0.04


# --- winnowing ---


def _winnow(text, k, w):
    h = winnowing.gram_hashes(winnowing.code_points(text), k).tolist()
    out = []
    for i in range(max(1, len(h) - w + 1) if h else 0):
        part = h[i:i + w]
        at = i + max(j for j, x in enumerate(part) if x == min(part))
        if not out or out[-1] != (h[at], at):
            out.append((h[at], at))
    return out


def test_winnowing(spark, docs, odd, none):
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    got = {r["doc_id"]: r for r in winnowing.edits(docs).collect()}
    as_text = lambda kept: "".join(f"{h:08x}{p:08x}" for h, p in kept)
    for n, (doc_id, text) in enumerate(rows):
        other = rows[(n + 1) % len(rows)][1]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + other[:cut]
        r = got[doc_id]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        if n % 8 == 0:
            a, b, c = (_winnow(t, winnowing.K, winnowing.W) for t in (text, edited, other))
            assert r["fingerprint"] == as_text(a) and r["edited_fingerprint"] == as_text(b)
            x, y, z = ({h for h, _ in s} for s in (a, b, c))
            assert r["near_edited"] == pytest.approx(len(x & y) / len(x | y)) and r["near_next"] == pytest.approx(len(x & z) / len(x | z))
    assert winnowing.edits(odd).count() == winnowing.fingerprint(odd).count() == len(ODD)
    assert winnowing.edits(none).count() == 0


def test_winnowing_short_texts(spark):
    rng = np.random.default_rng(3)
    texts = [(i, "".join(map(chr, rng.integers(97, 123, n)))) for i, n in enumerate(range(31, 120))]
    got = winnowing.edits(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    # Three quarters stay, 23 code points at least.
    assert len(got) == len(texts) and all(r["near_edited"] > 0 for r in got)


def test_winnowing_guarantee():
    rng = np.random.default_rng(2)
    for k, w in [(5, 7), (16, 64)]:
        shared = rng.integers(97, 123, k + w - 1)
        a, b = (np.concatenate([rng.integers(97, 123, n), shared, rng.integers(97, 123, 50)]).astype(np.uint32) for n in (13, 40))
        assert set(winnowing.winnow(a, k, w)[0].tolist()) & set(winnowing.winnow(b, k, w)[0].tolist())
    h = winnowing.gram_hashes(winnowing.code_points("abcdefghijk" * 5), 11)
    assert (h[:11] == h[11:22]).all() and len(set(h.tolist())) == 11


# --- scoring ---


def test_lm_scores(spark, docs):
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    train = {i: zlib.crc32(str(i).encode()) % 10 != 0 for i, _ in rows}
    tokens = {i: [*re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)), "\n"] for i, t in rows}
    one, two = collections.Counter(), collections.Counter()
    for i, t in tokens.items():
        if train[i]:
            one.update(t)
            two.update(zip(["\n", *t[:-1]], t))
    n, v = sum(one.values()), len(one)
    # The cells and weights by plain loops.
    cells = collections.defaultdict(lambda: [0, 0.0, 0.0])
    for i, t in tokens.items():
        if not train[i]:
            continue
        own1, own2 = collections.Counter(t), collections.Counter(zip(["\n", *t[:-1]], t))
        for a, b in zip(["\n", *t[:-1]], t):
            c_v = one[a] - own1[a]
            p2, p1 = ((two[a, b] - own2[a, b]) / c_v if c_v else 0.0), (one[b] - own1[b]) / (n - len(t))
            code = (int(lm.bucket(np.array([c_v]))[0]) * lm.LEVELS + int(lm._level(np.array([p2]))[0])) * lm.LEVELS + int(lm._level(np.array([p1]))[0])
            cell = cells[code]
            cell[0], cell[1], cell[2] = cell[0] + 1, cell[1] + p2, cell[2] + p1
    weights = lm.mixture(sorted((k, *c) for k, c in cells.items()), v)
    np.testing.assert_allclose(weights.sum(axis=1), 1)
    got = {r["doc_id"]: r for r in queries.op6_lm_scores(spark, "/root/testdata/sf0.001").collect()}
    for i, t in tokens.items():
        r = got[i]
        base = sum(math.log10((one[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(t), sum(one[w] > 0 for w in t), n, not train[i])
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        score = 0.0
        for a, b in zip(["\n", *t[:-1]], t):
            l2, l1, l0 = weights[int(lm.bucket(np.array([one[a]]))[0])]
            score += math.log10((l2 * two[a, b] / one[a] if one[a] else 0) + l1 * one[b] / n + l0 / (v + 1))
        assert r["score"] == pytest.approx(score, rel=1e-6)
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_lm_odd(odd, none):
    rows = lm.score(odd, F.lit(True)).collect()
    assert len(rows) == len(ODD) and all(math.isfinite(r["score"]) and r["score"] <= 0 for r in rows)
    untrained = lm.score(odd, F.lit(None).cast("boolean")).collect()
    assert {r["score"] for r in untrained} == {r["base_score"] for r in untrained} == {0.0}
    assert lm.score(none, F.lit(True)).count() == 0


# --- chat ---


def test_chat_round_trip(spark):
    rows = [(1, 0, None, None), (1, 0, "tool: </turn>\n", "### x"), (1, 1, "=", "\\"), (1, 2, "user", "\\\\\n</chat></turn>"), (None, None, "assistant", " </turn>\n"),
            (2, 1, "user", ""), (2, 1, "user", ""), (3, 0, "User", ": <"), (3, 1, "assistant", LONG), (4, 0, "system", "s"), (4, 1, "user", "u"), (4, 2, "assistant", "### User: ")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segment", F.lit("x"))
    segments = chat.format_chats(df)
    for got in (chat.read_back(segments, ordered=True).collect(), chat.read_back(segments).collect()):
        assert len(got) == 5
        for r in got:
            mine = sorted((x for x in rows if x[0] == r["conv_id"]), key=lambda x: (x[1] or -1, x[2] or "", x[3] or ""))
            said = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in mine)
            loss = "".join(x[3] or "" for x in mine if x[2] == "assistant")
            assert (r["n_turns"], r["turns_sha256"]) == (len(mine), hashlib.sha256(said.encode()).hexdigest())
            assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert {r["conv_id"]: r["valid"] for r in got} == {None: False, 1: False, 2: False, 3: False, 4: True}
    assert chat.read_back(chat.format_chats(df.filter("false"))).count() == 0


# --- mixing ---


def test_budgets_go_to_siblings_before_ancestors(spark):
    recipe = mixing.Recipe(domains={"a": (1, ("s1", "s2")), "b": (1, ("s3",))}, languages={"x": 1, "y": 1}, budget=(1, 2), max_epochs=1)
    leaves = spark.createDataFrame([("a", "x", "s1", 10), ("a", "x", "s2", 1000), ("a", "y", "s1", 20), ("b", "x", "s3", 970), ("b", "x", "s4", 0)], "mix_domain string, mix_lang string, mix_source string, tokens long")
    got = {(r["mix_domain"], r["mix_lang"], r["mix_source"]): r["tokens"] * r["epochs"] + r["rest"] for r in mixing.budgets(leaves, recipe).collect()}
    # 1000 in all, 500 a domain; in a: y holds 20, x takes 480, of which s1 holds 10.
    assert got == {("a", "x", "s1"): 10, ("a", "x", "s2"): 470, ("a", "y", "s1"): 20, ("b", "x", "s3"): 500}


def test_mixing_many_passes_equal_one(spark, docs, monkeypatch):
    cols = ("row.doc_id", "mix_epoch", "mix_tokens", "mix_taken")
    one = sorted(map(tuple, mixing.mix(docs, queries.RECIPE).select(*cols).collect()))
    monkeypatch.setattr(mixing, "LAST_ROWS", 1)
    monkeypatch.setattr(mixing, "PASS_DIGITS", 1)
    assert sorted(map(tuple, mixing.mix(docs, queries.RECIPE).select(*cols).collect())) == one


def test_mixing_odd(odd, none):
    rows = mixing.mix(odd, queries.RECIPE).collect()
    assert all(r["row"]["mix_epoch"] == "x" and 0 <= r["mix_taken"] <= r["mix_tokens"] for r in rows)
    assert mixing.mix(none, queries.RECIPE).count() == 0


# --- urls ---

URLS = [None, "", "no scheme", "http://", "https://A.Example.ORG/es/1?x=1", "https://example.org/en/12", "https://notexample.org/es/", "http://x.com/fr/?a=b&c=d#e",
        "http://com/de/", "http://x.com?/fr/", "ftp://user@X.com:80/de/x://y/", "http://é.ORG/", "http://a.net/" + "p/" * 20_000, "http://x.com/fr", "a://b://c.org/"]


def _rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in queries.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best and best.verdict


def test_urls(spark, sf_small):
    real = [r["url"] for r in spark.read.parquet(f"{sf_small}/pages.parquet").collect()]
    rows = [(i, u, "x", "y") for i, u in enumerate([*URLS, *real])]
    got = {r["page_id"]: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string, host string, verdict string"), queries.URL_RULES, trees=3).collect()}
    for i, u, *_ in rows:
        host, path, name, verdict = _rule(u)
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, name) and r["verdict"] in ("allow", "block")
        assert verdict is None or r["verdict"] == verdict


def test_suffix_statistics_leave_the_own_fold_out(spark):
    # Every host is one of its kind: nothing but its own label could tell a url's side.
    rows = [(f"http://{hashlib.md5(str(i).encode()).hexdigest()}.{'aa' if i % 2 else 'bb'}/", i % 2) for i in range(300)]
    labelled = written(spark.createDataFrame([(u, u[7:-1], "/", float(y), 1.0) for u, y in rows], "url string, host string, path string, label double, weight double"), "test-labelled")
    learned = urls.learn(labelled, trees=2)
    stats = {r["suffix"]: (r["seen"], r["rate"]) for r in learned.suffixes.collect()}
    assert stats["aa"] == (pytest.approx(math.log1p(150)), pytest.approx(155 / 160)) and len(stats) == 302
    unseen = [n for n, c in zip([*urls.features(F.lit(""), F.lit(""), F.lit("")), "last_seen", "last_rate", "two_seen", "two_rate"], learned.model.featureImportances.toArray()) if c > 0]
    assert "last_rate" in unseen and not {"two_seen", "two_rate"} & set(unseen)  # the two-label suffix is the url's own


def test_urls_held_out(spark):
    # The rules go by path directories, which no lexical feature sees: the floors are just under what was measured.
    got = urls.evaluate(spark.read.parquet("/root/testdata/sf0.1/pages.parquet"), queries.URL_RULES)
    assert got.n_urls > 150 and got.accuracy > got.base_accuracy and got.auc > 0.65, got
    assert urls.evaluate(spark.read.parquet("/root/testdata/sf0.001/pages.parquet").filter("false"), queries.URL_RULES) is None


def test_urls_without_labels(spark):
    df = spark.createDataFrame([(1, "http://a.net/"), (None, None)], "page_id long, url string")
    assert [(r["verdict"], r["rule"]) for r in urls.judge(df, queries.URL_RULES).collect()] == [("allow", None)] * 2
    assert urls.judge(df.filter("false"), queries.URL_RULES).count() == 0


def test_url_features(spark):
    u = "http://ab.com/a1/b?x=1&y=2#f"
    host, path = urls.host_and_path(F.lit(u))
    r = spark.range(1).select(*[c.alias(n) for n, c in urls.features(F.lit(u), host, path).items()]).first()
    counts = collections.Counter(u)
    assert r["url_entropy"] == pytest.approx(-sum(n / len(u) * math.log2(n / len(u)) for n in counts.values()))
    assert (r["url_length"], r["host_depth"], r["path_depth"], r["parameters"], r["fragment"]) == (len(u), 2, 2, 2, 1)
    assert r["digit_ratio"] == pytest.approx(3 / len(u))


# --- embeddings ---


def _links(ids, vectors):
    good = [i for i, v in enumerate(vectors) if v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    x = np.array([vectors[i] for i in good])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    pairs = [(good[a], good[b]) for a, b in zip(*np.nonzero(x @ x.T >= 0.95)) if a < b]
    root, n = list(range(len(ids))), [0] * len(ids)

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in pairs:
        n[a] += 1
        n[b] += 1
        a, b = sorted((find(a), find(b)), key=lambda k: ids[k])
        root[b] = a
    return {ids[i]: (n[i], ids[find(i)]) for i in range(len(ids))}


def test_embedding_links(spark, monkeypatch):
    monkeypatch.setattr(rabitq, "BLOCK", 50)  # large buckets in several blocks
    rng = np.random.default_rng(0)
    base = rng.standard_normal((20, 16))
    vectors = [(base[0 if i < 300 else i % 20] + rng.standard_normal(16) * 0.15).tolist() for i in range(900)]
    vectors[3], vectors[5], vectors[9], vectors[16] = None, [0.0] * 16, vectors[7], []
    vectors[11] = [2 * c for c in vectors[7]]
    vectors[13][2], vectors[14][2], vectors[15][1] = math.nan, None, math.inf
    vectors[17] = [c * 1e300 for c in vectors[17]]
    ids = list(range(900))
    df = spark.createDataFrame([(i, v, "x") for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>, band string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rabitq.near_duplicates(df).collect()}
    vectors[17] = [c / 1e300 for c in vectors[17]]
    want = _links(ids, vectors)
    found, all_ = sum(g[0] for g in got.values()), sum(w[0] for w in want.values())
    assert all(got[i][0] <= want[i][0] for i in ids) and found >= 0.99 * all_ > 1000
    assert sum(got[i][1] == want[i][1] for i in ids) >= 890
    assert [got[i] for i in (3, 5, 13, 14, 15, 16)] == [(0, i) for i in (3, 5, 13, 14, 15, 16)]
    assert rabitq.near_duplicates(df.filter("false")).count() == 0
    same = rabitq.near_duplicates(spark.createDataFrame([(None, [1.0, 2.0]), (2, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0])], "vec_id long, embedding array<double>")).collect()
    assert sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0) for r in same) == [(0, 0, 0), (1, 2, 1), (1, 2, 1), (2, 2, 1)]


def test_embedding_lengths_never_meet(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0, 0.0]), (3, [1.0, 2.01]), (4, [2.0, 4.0, 0.0]), (5, [3.0]), (6, [0.5]), (7, [-1.0]), (8, [0.0, 0.0, 1.0, 0.0])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in rabitq.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (1, 1, True), 2: (1, 2, True), 3: (1, 1, False), 4: (1, 2, False), 5: (1, 5, True), 6: (1, 5, False), 7: (0, 7, True), 8: (0, 8, True)}


def test_estimates_are_unbiased():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((2, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    errors = []
    for n, turn in enumerate(rabitq.rotations(64, 400, seed=9)):
        stored = rabitq.encode(x, turn, np.array([n, n + 7]))
        value, bound = rabitq.estimates(stored[:1], stored[1:], 64)
        errors.append(value[0] - x[0] @ x[1])
        assert abs(errors[-1]) <= bound[0]
    assert abs(np.mean(errors)) < 4 * np.std(errors) / math.sqrt(len(errors))


@pytest.mark.parametrize("d", [3, 64, 100])
def test_stored_records_give_the_products_of_their_forms(d):
    rng = np.random.default_rng(d)
    x = rng.standard_normal((50, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turn = rabitq.rotations(d, 1)[0]
    stored = rabitq.encode(x, turn, np.arange(50))
    assert (stored.tobytes() == rabitq.encode(x, turn, np.arange(50)).tobytes()) and stored.itemsize == 40 * -(-d // 64) + 16
    rotated = x @ turn
    signs = np.where(rotated >= 0, 1, -1) / math.sqrt(d)
    level = sum(((stored["planes"][:, k, :, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).reshape(50, -1)[:, :d].astype(int) << k for k in range(4))
    form = stored["low"][:, None] + stored["step"][:, None] * level
    assert np.abs(form - rotated).max() <= stored["step"].max() * 1.001
    value, _ = rabitq.estimates(stored[:-1], stored[1:], d)
    assert np.allclose(value, (form[:-1] * signs[1:]).sum(axis=1) / (rotated * signs)[1:].sum(axis=1), atol=1e-4)
    value, bound = rabitq.finer_estimates(stored[:-1], stored[1:], d)
    assert np.allclose(value, (form[:-1] * form[1:]).sum(axis=1), atol=1e-4)
    assert (np.abs(value - (x[:-1] * x[1:]).sum(axis=1)) <= bound).all()


def test_two_sided_buckets_pair_across_only():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((1, 16)) + rng.standard_normal((120, 16)) * 0.01
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    pairs = rabitq.Pairs(16, 6, 2, 0.95)
    stored = rabitq.encode(x, rabitq.rotations(16, 1)[0], np.arange(120))
    for size in (10, 120):  # below and above the size that is compared many at once
        bucket = np.zeros(size, np.int64)
        for side, want in ((np.zeros(size), size * (size - 1) // 2), (np.where(np.arange(size) % 5, 1, -1), size // 5 * (size - size // 5)), (np.full(size, -1), 0)):
            assert sum(len(i) for i, _ in pairs.within(stored[:size], bucket, side.astype(int))) == want


def test_codes_rule_out_far_pairs_and_keep_near_ones():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((2000, 64))
    x[1::2] = x[::2] + rng.standard_normal((1000, 64)) * 0.2  # pairs of neighbours at about 0.98
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    pairs = rabitq.Pairs(64, 8, 8, 0.95)
    stored = rabitq.encode(x, rabitq.rotations(64, 1)[0], np.arange(2000))
    none = np.zeros(2000, np.int64)
    i, j = (np.concatenate(p) for p in zip(*pairs.within(stored, none, none)))
    left, near = set(zip(i.tolist(), j.tolist())), np.argwhere(np.triu(x @ x.T, 1) >= 0.95)
    assert len(near) > 900 and {tuple(p) for p in near.tolist()} <= left
    assert len(left) < 0.001 * 2000 * 1999 / 2  # the rest never asks for a vector
