"""SimHash fingerprints against votes in plain Python, and neighbour counts against all pairs."""

import math
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from pricetide.llm import hashing, simhash
from tests.llm import brute
from tests.llm.test_operators import FOLDER, corpus, frame

M = 2**64 - 1


def mix(h):
    h ^= h >> 30
    h = h * 0xBF58476D1CE4E5B9 & M
    h ^= h >> 27
    h = h * 0x94D049BB133111EB & M
    return h ^ h >> 31


def sequence_hash(first, second):
    """Polynomials of two sequences of numbers modulo two primes."""
    sums = []
    for values, base, prime in zip((first, second), hashing._BASES, hashing._PRIMES):
        sums.append(sum(v % prime * pow(base, i, prime) for i, v in enumerate(values)) % prime)
    return sums[0] << 31 | sums[1]


def word_hash(word):
    data = word.encode()
    return mix(sequence_hash(*([int(table[b]) for b in data] for table in hashing._BYTES)))


def term_hash(words):
    hashes = [word_hash(w) for w in words]
    return mix(sequence_hash(hashes, [mix(h ^ hashing._WORD_BASE) for h in hashes]) + len(words) & M)


def fingerprint(text):
    words = brute.words(text)
    terms = Counter(tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))) if words else {}
    votes = [0] * 128
    for term, count in terms.items():
        h = term_hash(term)
        data = h.to_bytes(8, "little") + mix(h ^ 0x6A09E667F3BCC909).to_bytes(8, "little")
        weight = round(64 * (1 + math.log2(count)))
        for bit in range(128):
            votes[bit] += weight if data[bit // 8] >> (7 - bit % 8) & 1 else -weight
    return "".join(str(int(v > 0)) for v in votes)


def bits(prints):
    return ["".join(f"{b:08b}" for b in p) for p in prints.tolist()]


def test_fingerprints_against_plain_votes():
    texts = [t or "" for _, t, _, _ in corpus() if len(t or "") < 5000] + ["", " \n", "one", "one two", "a b c " * 40, "é 中 \U0001f600 x"]
    assert bits(simhash.fingerprints([t.encode() for t in texts])) == [fingerprint(t) for t in texts]


@pytest.mark.parametrize("bucket", [256, 2])
def test_query_counts_neighbours(spark, bucket):
    rows = simhash.compare_with_next(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    found = {r.doc_id: (r.n_near, r.fingerprint) for r in simhash.with_neighbours(rows, bucket=bucket).collect()}
    texts = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{FOLDER}/documents.parquet'").fetchall()
    prints = simhash.fingerprints([t.encode() for _, t in texts])
    apart = np.bitwise_count(prints[:, None, :] ^ prints[None, :, :]).sum(axis=2)
    near = (apart <= 3).sum(axis=1) - 1
    assert found == {d: (int(n), p.tobytes().hex()) for (d, _), n, p in zip(texts, near, prints)} and near.sum() > 0


def test_neighbours_of_awkward_tables(spark):
    made = [(1, "0" * 32), (1, "0" * 32), (2, "0" * 31 + "1"), (3, None), (None, "f" * 32)]
    rows = spark.createDataFrame(made, "doc_id bigint, fingerprint string").withColumn("held", F.lit(7)).withColumn("key", F.lit("x"))
    found = sorted((str(r.doc_id), str(r.fingerprint)[-1], r.n_near) for r in simhash.with_neighbours(rows).collect())
    assert found == [("1", "0", 2), ("1", "0", 2), ("2", "1", 2), ("3", "e", None), ("None", "f", 0)]
    assert simhash.with_neighbours(rows.limit(0)).count() == 0
    assert simhash.with_neighbours(simhash.compare_with_next(frame(spark, corpus()))).count() == len(corpus())
