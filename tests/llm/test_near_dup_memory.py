"""A task of the near-duplicate search holds little beside its input."""

import tracemalloc

import numpy as np
import pyarrow as pa

from tessera.llm import common, minhash


def _peak(run):
    tracemalloc.start()
    out = run()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return out, peak


def test_a_slice_is_counted_in_parts():
    rng = np.random.default_rng(7)
    texts, each = 2_000, 300
    low = rng.integers(0, 1 << minhash.LOW, texts * each, dtype=np.uint64)
    low[::50] = rng.choice(low[:40], len(low[::50]))  # one of fifty is shared
    count = rng.integers(1, 4, len(low))
    sizes, keys = np.full(texts, each), np.arange(texts) * 7
    values = [keys, sizes, sizes * 2, np.ones(texts), low.view(np.uint8).reshape(-1, 8)[:, :minhash.LOW // 8], count]
    cells = [pa.array([v.astype(t).tobytes()], pa.binary()) for v, t in zip(values, minhash._TYPES)]
    table = pa.table([pa.array([0]), *cells], names=["slice", *minhash._PARTS])
    weights = minhash.Weights(np.empty(0, np.uint64), np.empty(0, np.int64), texts)
    got, peak = _peak(lambda: minhash.counted(weights, 1, texts)(table))
    held = {}
    for i, (h, c) in enumerate(zip(low.tolist(), count.tolist())):
        held.setdefault(h, {}).setdefault(i // each, []).append(c)
    df = {h: sum(map(len, d.values())) for h, d in held.items() if len(d) > 1}
    told = got.to_pandas()
    assert {(k, h) for k, h in zip(told["key"] // 7, told["hash"])} == {(d, h) for h in df for d in held[h]} and len(told) > 5_000
    assert np.allclose(told["weight"], told["count"] * [1 + np.log((1 + texts) / (1 + df[h])) for h in told["hash"]])
    assert (np.diff(told["key"]) >= 0).all() and (told["total"] == 2 * each).all()
    assert peak < 50 * len(low)


def test_shingles_of_a_large_batch_are_made_in_small_steps():
    text = " ".join(f"w{i % 5_000}" for i in range(9_000))
    batch = pa.record_batch([pa.array([text] * 40)], names=["text"])
    common._powers.clear()
    rows, peak = _peak(lambda: sum(1 for _ in minhash.document_shingles(batch, 0)))
    assert rows == 40 and peak < 60_000_000
