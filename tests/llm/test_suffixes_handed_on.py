"""Sparse suffixes are searched for once and handed on from pass to pass."""

import random

import numpy as np
import pyarrow as pa
import pytest

from pricetide.llm import suffix_dedup
from tests.llm.brute import repeated_strings
from tests.llm.test_operators import frame, got, prose


@pytest.mark.parametrize("block", [1 << 18, 700])
def test_packed_suffixes(monkeypatch, block):
    monkeypatch.setattr(suffix_dedup, "_BLOCK", block)
    rng = random.Random(8)
    one = prose(rng, 600).encode()
    for texts in ([one, b"", b"x" * 500, one[:199], one], [b"", b"short"], []):
        found = suffix_dedup.Suffixes(texts, 200, 32)
        monkeypatch.setattr(suffix_dedup.Suffixes, "_sparse", None)
        again = suffix_dedup.Suffixes(texts, 200, 32, found.packed())
        monkeypatch.undo()
        monkeypatch.setattr(suffix_dedup, "_BLOCK", block)
        for name in ("block", "place", "first", "last", "seed"):
            assert (getattr(again, name) == getattr(found, name)).all(), name
        assert len(found.packed()) < 16 * len(found.place) + 4 * len(found.blocks) + 1


def test_later_passes_do_not_search(spark, tmp_path, monkeypatch):
    rng = random.Random(9)
    shared = prose(rng, 50)
    rows = [(i, prose(rng, 20) + shared + prose(rng, 20), "en", "web") for i in range(8)]
    marks = tmp_path / "searched"
    marks.mkdir()
    sparse = suffix_dedup.Suffixes._sparse

    class Counted(suffix_dedup.Suffixes):
        def _sparse(self, block, seed):
            (marks / str(len(list(marks.iterdir())))).touch()
            return sparse(self, block, seed)

    monkeypatch.setattr(suffix_dedup, "Suffixes", Counted)
    chunk = pa.table({"chunk": [0] * len(rows), "text": [r[1] for r in rows]})
    first = suffix_dedup.Sorting(chunk, None, 0, 200, 32)
    searched = len(list(marks.iterdir()))
    known = first.known[suffix_dedup._FOUND]
    handed = pa.table(
        {"chunk": [0, 0], "bucket": [-5, 0], "values": [suffix_dedup.squeeze(known), suffix_dedup.squeeze(np.ones(len(first.seeds().digit), np.uint8))]},
        schema=suffix_dedup.rounds.ANSWER_TYPE,
    )
    second = suffix_dedup.Sorting(chunk, handed, 1, 200, 32)
    assert searched and len(list(marks.iterdir())) == searched
    assert (second.suffixes.place == first.suffixes.place).all() and len(second.going) == len(first.suffixes.place)
    monkeypatch.undo()
    found = suffix_dedup.remove_repeated_strings(frame(spark, rows))
    expected = sorted(str(r[:5]) for r in repeated_strings([r[:2] for r in rows], 200))
    assert got(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected
