"""Substring dedup: Rabin-Karp hashes of every window of words, counted across the corpus.

Every window of ``size`` consecutive words of every text is hashed. A word is removed when a
window that covers it also starts in a document with a smaller id; so the first document that
holds a passage keeps it. Windows are judged on the input. Repeated windows merge into maximal
removal intervals.

Windows are equal when their 64-bit hashes are; with n windows, the expected number of unequal
pairs taken for equal is n * n / 2**65 (0.0005 for the 140 million windows of 0.9 GB of text).

Defined cases: null or empty text and texts with fewer words than a window lose nothing; rows
that repeat an id are judged each for itself and never remove each other's words; a null id
counts as larger than every id. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pricetide.llm import rounds
from pricetide.llm.hashing import Words, covered, squeeze, unsqueeze
from pricetide.llm.shared import table

WINDOW = 13
OUT = "doc_id bigint, n_words bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string"
OUT_TYPE = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())]
)
_NO_ID = 2**63 - 1


def _ids(chunk: pa.Table) -> np.ndarray:
    return np.array([_NO_ID if i is None else i for i in chunk["doc_id"].to_pylist()], np.int64)


def _hashed(chunk: pa.Table, size: int):
    """Words, window starts, distinct window hashes, and the smallest id that holds each."""
    words = Words(rounds.texts_of(chunk))
    at, hashes = words.windows(size)
    ids = _ids(chunk)[words.text[at]]
    distinct, which = np.unique(hashes, return_inverse=True)
    least = np.full(len(distinct), _NO_ID, np.int64)
    np.minimum.at(least, which, ids)
    return words, at, distinct, which, ids, least


def _sender(size: int, buckets: int):
    def send(chunk: pa.Table) -> pa.Table:
        _, _, distinct, _, _, least = _hashed(chunk, size)
        known = np.unique(least)
        rank = np.searchsorted(known, least).astype("<u4")
        head = squeeze(known.astype("<i8"))

        def extra(lo: int, hi: int) -> bytes:
            planes = squeeze(rank[lo:hi].view(np.uint8).reshape(-1, 4).T)
            return len(head).to_bytes(4, "little") + head + planes

        number = chunk["chunk"][0].as_py()
        return pa.table(rounds.send(number, distinct, buckets, extra), schema=rounds.SENT_TYPE)

    return send


def _smaller_elsewhere(first, group, order, extras, sizes) -> np.ndarray:
    """1 where another chunk holds the window in a document with a smaller id."""
    ids = []
    for blob in extras:
        n = int.from_bytes(blob[:4], "little")
        known = np.frombuffer(unsqueeze(blob[4 : 4 + n]), "<i8")
        rank = np.frombuffer(unsqueeze(blob[4 + n :]), np.uint8).reshape(4, -1)
        ids.append(known[np.ascontiguousarray(rank.T).view("<u4").ravel()])
    ids = np.concatenate(ids)[order]
    return np.minimum.reduceat(ids, first)[group] < ids


def _cutter(size: int, with_text: bool):
    def cut(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        if not chunk.num_rows:
            return OUT_TYPE.empty_table()
        words, at, distinct, which, ids, least = _hashed(chunk, size)
        elsewhere = rounds.answered(answers).astype(bool) if len(distinct) else np.zeros(0, bool)
        repeated = elsewhere[which] | (least[which] < ids)
        gone = covered(at[repeated], size, len(words.start))
        opens = gone & ~np.concatenate(([False], gone[:-1] & (words.text[1:] == words.text[:-1])))
        data, out = words.data.tobytes(), {name: [] for name in OUT_TYPE.names}
        for i, doc in enumerate(chunk["doc_id"].to_pylist()):
            lo, hi = words.first[i], words.first[i + 1]
            kept = np.flatnonzero(~gone[lo:hi]) + lo
            text = b" ".join(data[a:b] for a, b in zip(words.start[kept].tolist(), words.end[kept].tolist()))
            row = (doc, hi - lo, hi - lo - len(kept), int(opens[lo:hi].sum()), hashlib.sha256(text).hexdigest(), text.decode("utf-8") if with_text else None)
            for name, value in zip(out, row):
                out[name].append(value)
        return pa.table(out, schema=OUT_TYPE)

    return cut


def remove_repeated_windows(docs: DataFrame, size: int = WINDOW, with_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, n_spans, kept_sha256, kept_text) for each row of docs."""
    plan = rounds.deal(docs)
    texts = rounds.dealt(docs, plan)
    sent = texts.groupBy("chunk").applyInArrow(_sender(size, plan.buckets), rounds.SENT)
    answers = rounds.answer(sent, _smaller_elsewhere)
    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_cutter(size, with_text), OUT)


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeated_windows(table(spark, folder, "documents"), with_text=False).drop("kept_text", "n_spans")


SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS words
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words WHERE len(w) >= 13)
), firsts AS (
  SELECT words, min(doc_id) AS first_id FROM windows GROUP BY words
), gone AS (
  SELECT doc_id, list(DISTINCT p) AS places
  FROM (SELECT w.doc_id, unnest(range(i, i + 13)) AS p
        FROM windows w JOIN firsts f ON w.words = f.words AND f.first_id < w.doc_id)
  GROUP BY doc_id
), kept AS (
  SELECT d.doc_id, w, coalesce(len(places), 0) AS n_removed,
         [w[i] FOR i IN range(1, len(w) + 1) IF NOT list_contains(coalesce(places, []), i)] AS left_words
  FROM words d LEFT JOIN gone g ON d.doc_id = g.doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, n_removed::BIGINT AS n_removed,
       sha256(array_to_string(left_words, ' ')) AS kept_sha256
FROM kept
"""
