"""What a chunk's counts take in a Python process."""

import tracemalloc

import numpy as np
import pandas as pd

from quire.llm import interpolation


def _chunk(tokens: int):
    rng = np.random.default_rng(1)
    words = np.sort(np.append(rng.integers(1, 1 << 62, 5000).astype(np.uint64), interpolation.END))
    seq = rng.integers(0, len(words), tokens)
    sizes = np.full(tokens // 500, 500)
    first = np.cumsum(sizes) - sizes
    n_pairs = len(np.unique(interpolation.pairs_of(words, seq, first)[0]))
    row = {"words": interpolation.pack_sorted(words), "seq": interpolation.pack(seq.astype(np.uint32)),
           "sizes": interpolation.pack(sizes.astype(np.int32)),
           "train": interpolation.pack(np.ones(len(sizes), np.uint8))}
    replies = pd.DataFrame({"kind": ["word", "pair"], "bucket": [0, 0], "total": [
        interpolation.pack(np.arange(len(words)).astype(np.uint64)),
        interpolation.pack(np.arange(n_pairs).astype(np.uint64))]})
    return words, seq, sizes, first, row, replies


def test_counts_of_a_chunk_take_bounded_memory():
    tokens = 500_000
    words, seq, sizes, first, row, replies = _chunk(tokens)
    tracemalloc.start()
    c2, cv, cw, got, _ = interpolation._token_counts(row, replies, "total")
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 * tokens       # it was 81 bytes a token
    pair, context = interpolation.pairs_of(words, seq, first)
    assert (c2 == np.unique(pair, return_inverse=True)[1]).all() and (cw == seq).all() and (got == sizes).all()
    starts = int(np.searchsorted(words, interpolation.END))
    assert (cv == np.where(context < 0, starts, context)).all()


def test_places_of_distinct_hashes():
    for h in (np.zeros(0, np.uint64), np.array([5, 1, 5, 2 ** 63, 1], np.uint64)):
        found, at = interpolation.distinct(h)
        same, where = np.unique(h, return_inverse=True)
        assert (found == same).all() and (at == where).all() and at.dtype == np.int32
