"""Vectorised 64-bit hashes of words and windows in a block of texts, and packed hash lists.

All functions work on numpy arrays inside a task. A hash of a range is a difference of
prefix sums (Rabin-Karp), so any window of any length costs one subtraction and one product.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

U = np.uint64
_C = ctypes.CDLL(None)
_BYTE = np.random.default_rng(20240229).integers(0, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_BASE, _WORD_BASE = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    h = h ^ (h >> U(30))
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n; kept while small."""
    known = _powers.get(base)
    if known is None or len(known[0]) <= n:
        size = max(n + 1, 1 << 16)
        up, down = np.full(size, base, U), np.full(size, pow(base, -1, 2**64), U)
        up[0] = down[0] = 1
        known = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if size <= 1 << 22:
            _powers[base] = known
    return known


#: Sums are taken modulo two primes below 2**31: modulo a power of two, long regular strings
#: (such as the Thue-Morse word and its complement) are equal for every base.
_PRIMES = (2147483647, 2147483629)
_random = np.random.default_rng(20261201)
_BASES = [int(_random.integers(1 << 20, p - 1)) for p in _PRIMES]
_BYTES = [_random.integers(1, p, 256, dtype=np.uint64) for p in _PRIMES]
_tables: list[tuple[np.ndarray, np.ndarray]] = [(np.ones(1, np.uint32), np.ones(1, np.uint32))] * 2


def _table(k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo its prime, n at least; kept while small."""
    known = _tables[k]
    if len(known[0]) < n:
        size = max(n + n // 8, 1 << 16)
        known = tuple(_powers_of(base, _PRIMES[k], size) for base in (_BASES[k], pow(_BASES[k], -1, _PRIMES[k])))
        if size <= 1 << 22:
            _tables[k] = known
    return known


def _powers_of(base: int, prime: int, size: int) -> np.ndarray:
    out = np.ones(size, np.uint32)
    done = 1
    while done < size:
        more = min(done, size - done)
        out[done : done + more] = out[:more] * U(pow(base, done, prime)) % U(prime)
        done += more
    return out


class Sums:
    """Running sums of a sequence of numbers times powers, so that any range has a hash.

    Ranges of n values that differ get equal hashes with odds of about 2**-62, and of at most
    (n / 2**31)**2 whatever the values are.
    """

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.sums = []
        for k, values in enumerate((first, second)):
            out = np.zeros(len(values) + 1, U)
            terms = out[1:]
            np.multiply(values, _table(k, len(values) + 1)[0][: len(values)], out=terms)
            terms %= U(_PRIMES[k])
            np.cumsum(terms, out=terms)
            self.sums.append(out)

    def range(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        found = []
        for k, sums in enumerate(self.sums):
            p = U(_PRIMES[k])
            found.append((sums[end] - sums[start]) % p * _table(k, len(sums))[1][start] % p)
        return found[0] << U(31) | found[1]


def byte_sums(data: np.ndarray) -> Sums:
    return Sums(_BYTES[0][data], _BYTES[1][data])


def hash_sums(hashes: np.ndarray) -> Sums:
    return Sums(hashes % U(_PRIMES[0]), mix(hashes ^ U(_WORD_BASE)) % U(_PRIMES[1]))


def byte_range_hash(sums: Sums, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix(sums.range(start, end))


def give_back() -> None:
    """Return freed memory to the system: workers are used again by later stages."""
    pa.default_memory_pool().release_unused()
    if hasattr(_C, "malloc_trim"):
        _C.malloc_trim(0)


def text_buffer(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts joined by line feeds, and where each begins (one more entry at the end)."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return np.frombuffer(b"\n".join(texts) + b"\n", np.uint8), starts


class Words:
    """Words of a block of texts: where they are, whose they are, and a hash of each."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.data, self.text_starts = text_buffer(texts)
        if lower:
            self.data = _LOWER[self.data]
        inside = ~_SEPARATOR[self.data]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
        self.start, self.end = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.start, self.text_starts)  # first word of each text
        self.count = np.diff(self.first)
        self.text = np.repeat(np.arange(len(texts)), self.count)
        sums = byte_sums(self.data)
        self.hash = byte_range_hash(sums, self.start, self.end)
        self._sums = None

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every run of ``size`` words within one text."""
        if self._sums is None:
            self._sums = hash_sums(self.hash)
        at = np.arange(max(0, len(self.start) - size + 1))
        if len(at):
            at = at[self.text[at] == self.text[at + size - 1]]
        return at, mix(self._sums.range(at, at + size) + U(size))

    def whole(self) -> np.ndarray:
        """A hash of each text's whole word sequence."""
        if self._sums is None:
            self._sums = hash_sums(self.hash)
        return mix(self._sums.range(self.first[:-1], self.first[1:]) + self.count.astype(U))


def covered(starts: np.ndarray, size: int | np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in a range that begins at one of ``starts``."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, starts + size, -1)
    return np.cumsum(depth)[:n] > 0


def squeeze(data: bytes | np.ndarray) -> bytes:
    """zstd frame with its length in front."""
    data = data if isinstance(data, bytes) else np.ascontiguousarray(data).tobytes()
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unsqueeze(blob: bytes) -> bytes:
    size = int.from_bytes(blob[:8], "little")
    return pa.decompress(blob[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def pack(values: np.ndarray) -> bytes:
    """Ascending unsigned numbers: their gaps, byte plane by byte plane, under zstd."""
    gaps = np.diff(values.astype("<u8"), prepend=U(0)).view(np.uint8).reshape(-1, 8)
    return squeeze(gaps.T)


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(unsqueeze(blob), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=U)
