"""Words that polynomials modulo a power of two take for equal must not collide."""

import numpy as np
import pytest

from pricetide.llm import hashing, ngram_join, quality_rules, simhash, substring_dedup

from . import brute


def thue_morse(n, letters="ab"):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


PAIRS = [(thue_morse(n), thue_morse(n, "ba")) for n in (1024, 2048, 8192)]


@pytest.mark.parametrize("one, two", PAIRS)
def test_long_regular_words_differ(one, two):
    words = hashing.Words([one.encode(), two.encode(), one.encode()])
    assert words.hash[0] != words.hash[1] and words.hash[0] == words.hash[2]
    assert len(np.unique(simhash.fingerprints([one.encode(), two.encode()]), axis=0)) == 2


def test_ranges_of_equal_bytes_have_equal_hashes_wherever_they_are():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 99, 5000, dtype=np.uint8)
    sums = hashing.byte_sums(data)
    for width in (1, 2, 7, 12):
        at = np.arange(len(data) - width)
        hashes = hashing.byte_range_hash(sums, at, at + width)
        pieces = [bytes(data[i : i + width]) for i in at]
        number = {p: i for i, p in enumerate(sorted(set(pieces)))}
        assert len(np.unique(np.stack([hashes, [number[p] for p in pieces]]), axis=1).T) == len(number) == len(np.unique(hashes))


@pytest.mark.parametrize("one, two", PAIRS)
def test_operators_keep_such_words_apart(spark, one, two):
    rest = [f"w{i}" for i in range(20)]
    texts = [" ".join([one, *rest[:12]]), " ".join([two, *rest[:12]]), "\n".join([one, two, one])]
    rows = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    removed = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeated_windows(rows).collect()}
    assert removed == {0: 0, 1: 0, 2: 0}
    found = quality_rules.statistics([texts[2].encode()])
    assert found["n_dup_lines"].tolist() == [1]
    lonely = spark.createDataFrame([(0, " ".join([one] * 5)), (1, " ".join([two] * 5))], "doc_id long, text string")
    linked = {r.doc_id: r.component_id for r in ngram_join.join(lonely).collect()}
    assert linked == {0: 0, 1: 1}
    assert brute.sha(one) != brute.sha(two)
