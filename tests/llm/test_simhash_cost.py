"""SimHash votes without a number per term and bit."""

import tracemalloc

import numpy as np

from pricetide.llm import simhash
from pricetide.llm.hashing import mix


def test_votes_are_counted_in_packed_counters():
    rng = np.random.default_rng(4)
    owner = np.sort(np.concatenate((np.full(1000, 1), np.full(255, 3), np.full(256, 4), rng.integers(5, 40, 60_000))))
    hashes = rng.integers(0, 2**63, len(owner), dtype=np.uint64)
    hashes[:600] = 2**64 - 1  # one set of bits in more terms than a counter of a byte can hold
    weight = rng.choice([64, 64, 64, 128, 165], len(owner)).astype(np.int32)
    tracemalloc.start()
    found = simhash._votes(hashes, owner, weight, 41)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    two = np.stack((hashes, mix(hashes ^ np.uint64(0x6A09E667F3BCC909))), axis=1).astype("<u8")
    signs = np.unpackbits(two.view(np.uint8), axis=1).astype(np.int64) * 2 - 1
    wanted = np.zeros((41, simhash.BITS), np.int64)
    np.add.at(wanted, owner, signs * weight[:, None])
    assert (found == wanted).all()
    assert peak < len(owner) * simhash.BITS
    assert not simhash._votes(hashes[:0], owner[:0], weight[:0], 2).any()
