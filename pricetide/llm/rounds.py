"""Counting hashes of whole corpora in rounds between chunks of texts and buckets of hashes.

Texts are dealt out once by chunk. A chunk sends the distinct hashes it holds, in sorted and
packed lists, one list per bucket of the hash space; a bucket sees every chunk's list, and
answers with one small value for each hash it was sent, in the same order. Chunks then join
the answers with their texts, so no row per hash or per pair ever travels. As a chunk sends a
hash once however often it occurs, a hash that a third of all rows hold costs a bucket no more
than one entry per chunk: hot hashes need no salt, and nothing is capped.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetide.llm.hashing import U, give_back, pack, squeeze, unpack, unsqueeze
from pricetide.llm.shared import ship, text_bytes

SENT = "bucket int, chunk int, hashes binary, extra binary"
ANSWER = "chunk int, bucket int, values binary"


@dataclass(frozen=True)
class Deal:
    chunks: int
    buckets: int
    size: int


def deal(docs: DataFrame, text: str = "text", least: int = 1 << 20, most: int = 1 << 25) -> Deal:
    """Numbers of chunks and buckets for the size of the texts.

    Chunks grow with the square root of the corpus (from 2 MB at 1 GB up to 32 MB), so that
    the lists that chunks send to buckets do not become ever shorter and more numerous.
    """
    size = max(1, text_bytes(docs, text))
    chunk = min(most, max(least, int(math.sqrt(size * 4000))))
    return Deal(-(-size // chunk), -(-size // (chunk * 4)), size)


def dealt(docs: DataFrame, plan: Deal, *others: Column) -> DataFrame:
    """(chunk, doc_id, text, others); null texts stay null. Every round must use this same frame:
    equal plans let Spark shuffle the texts once and use the same files in each round."""
    ship(docs.sparkSession)
    chunk = F.pmod(F.xxhash64("doc_id"), F.lit(plan.chunks)).cast("int").alias("chunk")
    return docs.select(chunk, "doc_id", "text", *others)


def texts_of(chunk: pa.Table) -> list[bytes]:
    return [(t or b"") for t in chunk["text"].cast(pa.binary()).to_pylist()]


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """By the leading bits, so that ascending hashes have ascending buckets."""
    return ((hashes >> U(40)) * U(buckets) >> U(24)).astype(np.int64)


def send(chunk: int, hashes: np.ndarray, buckets: int, extra: Callable, drop: int = 0) -> dict:
    """Lists for the buckets of ascending distinct hashes; ``extra(lo, hi)`` adds bytes for
    a slice; the last ``drop`` bits of a hash are not sent."""
    cut = np.searchsorted(bucket_of(hashes, buckets), np.arange(buckets + 1))
    rows = [b for b in range(buckets) if cut[b + 1] > cut[b]]
    return {
        "bucket": rows,
        "chunk": [chunk] * len(rows),
        "hashes": [pack(hashes[cut[b] : cut[b + 1]] >> U(drop)) for b in rows],
        "extra": [extra(cut[b], cut[b + 1]) for b in rows],
    }


SENT_TYPE = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("hashes", pa.binary()), ("extra", pa.binary())])
ANSWER_TYPE = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("values", pa.binary())])


def answer(
    sent: DataFrame, judge: Callable[[np.ndarray, np.ndarray, np.ndarray, list, list], np.ndarray]
) -> DataFrame:
    """Each bucket's verdict on the entries sent to it.

    ``judge(first, group, order, extras, sizes)`` sees the entries sorted by hash: ``first`` are the
    places where a new hash begins, ``group`` the number of the hash of each entry, ``order`` where
    each entry stood as sent, ``extras`` what the chunks added, ``sizes`` the lengths of their lists. It returns one byte per entry.
    Rows of buckets below 0 are not judged: their extra comes back as it is.
    """

    def bucket(rows: pa.Table) -> pa.Table:
        if rows["bucket"][0].as_py() < 0:
            return rows.select(["chunk", "bucket", "extra"]).rename_columns(["chunk", "bucket", "values"]).cast(ANSWER_TYPE)
        rows = rows.sort_by("chunk")  # lists arrive in any order; verdicts must not depend on it
        chunks = rows["chunk"].to_pylist()
        lists = [unpack(b) for b in rows["hashes"].to_pylist()]
        hashes = np.concatenate(lists)
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(hashes))))
        values = np.empty(len(order), np.uint8)
        values[order] = judge(first, group, order, rows["extra"].to_pylist(), [len(x) for x in lists])
        ends = np.cumsum([len(x) for x in lists])
        give_back()
        return pa.table(
            {
                "chunk": chunks,
                "bucket": [rows["bucket"][0].as_py()] * len(chunks),
                "values": [squeeze(v) for v in np.split(values, ends[:-1])],
            },
            schema=ANSWER_TYPE,
        )

    return sent.groupBy("bucket").applyInArrow(bucket, ANSWER)


def answered(rows: pa.Table) -> np.ndarray:
    """All answers to a chunk, in the order of its ascending hashes."""
    at = np.argsort(np.array(rows["bucket"].to_pylist(), np.int64))
    values = rows["values"].to_pylist()
    return np.frombuffer(b"".join(unsqueeze(values[i]) for i in at), np.uint8)


def blocks(items: list, sizes: list[int], most: int) -> Iterator[list]:
    """Consecutive items whose sizes add up to ``most``; a larger item comes alone."""
    block, held = [], 0
    for item, size in zip(items, sizes):
        if block and held + size > most:
            yield block
            block, held = [], 0
        block.append(item)
        held += size
    if block:
        yield block
