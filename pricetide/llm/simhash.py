"""SimHash fingerprints, and all pairs of them within a Hamming radius.

Terms of a text are its overlapping three-word shingles (the whole sequence if it has fewer
words). Each term's hash votes on every bit of the fingerprint, plus or minus its weight; the
sign of the sum is the bit. A term that occurs often weighs the more, but ever less for each
time (one plus the binary logarithm of its count), so repeated lines do not drown the rest.

``likeness`` turns the share of equal bits into the cosine that it estimates, and ends at 0.

``near`` finds all pairs of fingerprints within a radius by permuted block tables: with the bits
cut into radius + 1 blocks, two fingerprints within the radius agree in one block at least. Each
table holds the fingerprints under one block; equal fingerprints are one entry. A block value
that very many share is cut into slices, every two of which are compared in a task of their own,
so nothing is left out; only pairs within the radius leave a task. ``with_neighbours`` counts from
these pairs how many other rows each row has within the radius, copies included.

Defined cases: null text counts as empty; a text without words has the fingerprint 0 like any
other such text; rows that repeat an id follow each other in the order of a hash of their text;
null ids come last in descending order; a single document is its own next.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricetide.llm import rounds
from pricetide.llm.hashing import U, Words, mix
from pricetide.llm.shared import ship, stage, table, text_bytes

BITS, SHINGLE = 128, 3
#: Of each byte its bits, first to last, as eight counters of a byte each.
_COUNTERS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(U).ravel()


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """(texts, BITS / 8) bytes."""
    words = Words(texts)
    at, hashes = words.windows(SHINGLE)
    short = np.flatnonzero((words.count > 0) & (words.count < SHINGLE))
    owner = np.concatenate((words.text[at], short))
    own = mix(np.concatenate((hashes, words.whole()[short])) + owner.astype(U) * U(0x9E3779B97F4A7C15))
    _, first, count = np.unique(own, return_index=True, return_counts=True)
    hashes = np.concatenate((hashes, words.whole()[short]))[first]
    owner = owner[first]
    order = np.argsort(owner, kind="stable")
    hashes, owner, weight = hashes[order], owner[order], np.rint(64 * (1 + np.log2(count[order]))).astype(np.int32)
    votes = _votes(hashes, owner, weight, len(texts))
    return np.packbits(votes > 0, axis=1)


def _votes(hashes: np.ndarray, owner: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """(n, BITS) sums of weights, plus where a term's bit is set and minus where it is not.

    ``owner`` ascends. Terms of a common weight are counted: a byte of their hashes stands for eight
    counters of a byte each in one number, so one sum over up to 255 terms counts eight bits.
    """
    votes = np.zeros((n, BITS), np.int64)  # whole numbers: sums do not depend on blocks
    for common in np.unique(weight).tolist():
        some = weight == common
        h, o = hashes[some], owner[some]
        opens = np.flatnonzero(np.concatenate(([True], o[1:] != o[:-1])))
        size = np.diff(np.append(opens, len(o)))
        runs = -(-size // 255)
        first = np.repeat(opens - 255 * (np.cumsum(runs) - runs), runs) + 255 * np.arange(runs.sum())
        counts = np.empty((len(first), BITS // 8), U)
        for half, digits in enumerate((h, mix(h ^ U(0x6A09E667F3BCC909)))):
            digits = digits.astype("<u8").view(np.uint8).reshape(-1, 8)
            for byte in range(8):
                counts[:, 8 * half + byte] = np.add.reduceat(_COUNTERS[digits[:, byte]], first)
        counts = np.add.reduceat(counts.view(np.uint8).astype(np.int64), np.cumsum(runs) - runs, axis=0)
        votes[o[opens]] += (2 * counts - size[:, None]) * common
    return votes


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated cosine of the texts of fingerprints, from 0 to 1."""
    differ = np.bitwise_count(a ^ b).sum(axis=1)
    return np.where(differ == 0, 1.0, np.maximum(0.0, np.cos(np.pi * differ / BITS)))


OUT = (
    "kind int, part int, doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, text string"
)
OUT_TYPE = pa.schema(
    [("kind", pa.int32()), ("part", pa.int32()), ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string())]
    + [("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("text", pa.string())]
)
_WHOLE, _FIRST, _LAST = 0, 1, 2


def edit(text: str, after: str) -> str:
    """The last third of a text replaced by the beginning of the next one."""
    cut = len(text) // 3
    return text[: len(text) - cut] + after[:cut]


def _rows(part: int, ids: list, texts: list[str]) -> pa.RecordBatch:
    """Finished rows for all but the last of consecutive documents."""
    n = len(ids) - 1
    edited = [edit(a, b) for a, b in zip(texts[:-1], texts[1:])]
    prints = fingerprints([t.encode() for t in texts])
    changed = fingerprints([t.encode() for t in edited])
    columns = [
        [_WHOLE] * n,
        [part] * n,
        ids[:-1],
        [len(t) for t in texts[:-1]],
        [hashlib.sha256(t.encode()).hexdigest() for t in edited],
        [p.tobytes().hex() for p in prints[:-1]],
        [p.tobytes().hex() for p in changed],
        likeness(prints[:-1], changed),
        likeness(prints[:-1], prints[1:]),
        [None] * n,
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, OUT_TYPE.types)], schema=OUT_TYPE)


def _edge(kind: int, part: int, doc_id, text: str) -> dict:
    return dict(zip(OUT_TYPE.names, (kind, part, doc_id, *[None] * 6, text)))


def _in_order(batches):
    """Rows of a part in order; its first and last text go on to meet the neighbouring parts."""
    part, last = TaskContext.get().partitionId(), None
    for batch in batches:
        ids, texts, at = batch["doc_id"].to_pylist(), [t or "" for t in batch["text"].to_pylist()], 0
        for block in rounds.blocks(texts, [len(t) for t in texts], 1 << 20):
            own = ids[at : at + len(block)]
            at += len(block)
            if last is None:
                yield pa.RecordBatch.from_pylist([_edge(_FIRST, part, own[0], block[0])], OUT_TYPE)
            else:
                own, block = [last[0], *own], [last[1], *block]
            if len(own) > 1:
                yield _rows(part, own, block)
            last = own[-1], block[-1]
    if last is not None:
        yield pa.RecordBatch.from_pylist([_edge(_LAST, part, *last)], OUT_TYPE)


def _meet(rows: pa.Table) -> pa.Table:
    """The last text of a part and the first of the next one with texts."""
    last, first = (rows.filter(pa.array([k == kind for k in rows["kind"].to_pylist()])).to_pylist()[0] for kind in (_LAST, _FIRST))
    return pa.Table.from_batches([_rows(last["part"], [last["doc_id"], first["doc_id"]], [last["text"], first["text"]])])


def compare_with_next(docs: DataFrame, part_bytes: int = 1 << 24) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next):
    each text against its edited form and the next text in descending order of ids."""
    ship(docs.sparkSession)
    parts = max(1, -(-text_bytes(docs) // part_bytes))
    order = [F.col("doc_id").desc_nulls_last()]
    ordered = docs.select("doc_id", "text").repartitionByRange(parts, *order)
    ordered = ordered.sortWithinPartitions(*order, F.xxhash64("text"))
    rows = stage(ordered.mapInArrow(_in_order, OUT), "fingerprints")
    # a ring of the parts that have texts: one row of numbers each
    by_part = Window.orderBy("part")
    ring = rows.where(f"kind = {_FIRST}").select("part")
    ring = ring.select("part", F.coalesce(F.lead("part").over(by_part), F.first("part").over(by_part)).alias("next"))
    last = rows.where(f"kind = {_LAST}").join(ring, "part").withColumn("pair", F.col("part"))
    first = rows.where(f"kind = {_FIRST}").join(ring.select(F.col("part").alias("pair"), F.col("next").alias("part")), "part")
    ends = last.drop("next").unionByName(first).groupBy("pair").applyInArrow(_meet, OUT)
    rows = rows.where(f"kind = {_WHOLE}").unionByName(ends)
    return rows.drop("kind", "part", "text")


def near(prints: DataFrame, radius: int = 3, bucket: int = 256) -> DataFrame:
    """(a, b, distance): pairs of different fingerprints of column ``fingerprint`` within the radius.

    Rows that share a fingerprint are joined to it by the caller: copies are not expanded here.
    """
    distinct = prints.select("fingerprint").where("fingerprint is not null").distinct()
    return _pairs(stage(distinct, "prints"), radius, bucket)


def _pairs(distinct: DataFrame, radius: int, bucket: int) -> DataFrame:
    ship(distinct.sparkSession)
    blocks = radius + 1
    cuts = [round(i * (BITS // 4) / blocks) for i in range(blocks + 1)]  # in hexadecimal digits
    # a table's rows meet by a hash of its number and block: equal hashes of other blocks cost a comparison
    keyed = F.array(*(F.xxhash64(F.lit(i), F.substring("fingerprint", cuts[i] + 1, cuts[i + 1] - cuts[i])) for i in range(blocks)))
    entries = distinct.select(F.unhex("fingerprint").alias("print"), F.explode(keyed).alias("key"))
    sizes = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    entries = entries.join(sizes, "key").withColumn("k", F.ceil(F.col("n") / bucket).cast("int"))
    entries = entries.withColumn("mine", F.pmod(F.xxhash64("print"), F.col("k")).cast("int"))
    entries = entries.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    entries = entries.withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other"))

    def compare(rows: pa.Table) -> pa.Table:
        names = sorted(set(zip(rows["print"].to_pylist(), rows["mine"].to_pylist())))
        raw = np.frombuffer(b"".join(f for f, _ in names), np.uint8).reshape(len(names), -1)
        words = np.ascontiguousarray(raw).view("<u8")
        side = np.array([m for _, m in names])
        two = len(set(side.tolist())) > 1 or rows["i"][0].as_py() != rows["j"][0].as_py()
        a, b, d = [], [], []
        for x in range(len(names) - 1):
            differ = np.bitwise_count(words[x + 1 :] ^ words[x]).sum(axis=1)
            fits = differ <= radius
            if two:
                fits &= side[x + 1 :] != side[x]
            for y in np.flatnonzero(fits).tolist():
                a.append(names[x][0].hex())
                b.append(names[x + 1 + y][0].hex())
                d.append(int(differ[y]))
        return pa.table({"a": a, "b": b, "distance": d}, schema=pa.schema([("a", pa.string()), ("b", pa.string()), ("distance", pa.int64())]))

    return entries.groupBy("key", "i", "j").applyInArrow(compare, "a string, b string, distance bigint").distinct()


def with_neighbours(rows: DataFrame, radius: int = 3, bucket: int = 256) -> DataFrame:
    """rows with ``n_near``: how many other rows have a fingerprint within the radius (null
    without a fingerprint). Copies are counted per fingerprint, never expanded.

    Rows of one fingerprint are dealt over as many slices as the root of the number of rows; a
    slice asks once for each fingerprint it holds, so a fingerprint of a third of all rows sends
    neither its rows nor its questions to one task.
    """
    held = rows.where("fingerprint is not null").groupBy("fingerprint").agg(F.count("*").alias("held"))
    held = stage(held, "prints")
    ways = [F.struct(F.col(x).alias("at"), F.col(y).alias("fingerprint")) for x, y in ("ab", "ba")]
    both = _pairs(held, radius, bucket).select(F.explode(F.array(*ways)).alias("p"))
    close = both.select("p.*").join(held, "fingerprint").groupBy(F.col("at").alias("fingerprint")).agg(F.sum("held").alias("n_near"))
    own = held.where("held > 1").select("fingerprint", (F.col("held") - 1).alias("n_near"))
    total = own.unionByName(close).groupBy("fingerprint").agg(F.sum("n_near").alias("n_near"))  # fingerprints with company
    slices = max(1, math.isqrt(held.agg(F.sum("held")).first()[0] or 0))
    sliced = rows.select(F.struct("*").alias("row"), "fingerprint", F.pmod(F.xxhash64(*rows.columns), F.lit(slices)).alias("slice"))
    answers = sliced.select("fingerprint", "slice").distinct().join(total, "fingerprint")
    counted = F.when(F.col("fingerprint").isNotNull(), F.coalesce("n_near", F.lit(0).cast("bigint")))
    return sliced.join(answers, ["fingerprint", "slice"], "left").select("row.*", counted.alias("n_near"))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Each text against its edited form and the next text, and how many others are within 3 bits."""
    return with_neighbours(compare_with_next(table(spark, folder, "documents")))
