r"""How a row of filters interact: what each removes in every order they can be applied in.

Word counts come from a sparse document-term matrix. Texts are taken in shards of a few MB. A
shard splits its texts with numpy, codes its words against the list of its own distinct words,
and stores its part of the matrix in compressed rows (row ends, columns, counts). Distinct words
then go to buckets, each shard sending a word once; a bucket codes the words it gets against one
list, and answers with a number per word that is the same for all shards and differs from that
of any other word. Shards replace their own columns by those numbers. No row per word of a text
travels, and a word of every text costs its bucket one entry per shard.

Row sums are the words of a document, nonzero entries its distinct words; they decide filters A
and B. The other filters look at characters (C, D) and at equal texts of smaller ids (E, compared
by SHA-256 of the whole text). Each document becomes a set of failed filters, and documents are
only counted per part and set: at most 32 rows a part, from which every order follows. With P
the filters before and f the one applied, 80 pairs (P, f) cover all 600 steps of the 120 orders.

Defined cases: null texts are empty; null sources are the part ''; null ids have no labels and
are equal to nothing; rows that repeat count each, and rows of equal text and id are not copies
of one another; of several labels of an id one that says so is enough; an empty table gives no
rows; other columns are ignored. The matrix keeps one row per input row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.llm import rounds
from pricetide.llm.hashing import byte_range_hash, byte_sums, squeeze, text_buffer, unsqueeze
from pricetide.llm.shared import ship, stage, table, text_bytes

FILTERS = "ABCDE"
SHARD, BUCKET = 1 << 21, 1 << 25
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"#$%&*|")] = True

MATRIX = """shard long, doc_id array<long>, part array<string>, n_chars array<long>, n_upper array<long>,
marked array<boolean>, digest array<string>, row_ends binary, columns binary, counts binary"""
SENT = "array<struct<bucket:int,sizes:binary,words:binary>>"
ROWS = "doc_id long, part string, n_words long, n_distinct long, n_chars long, n_upper long, marked boolean, digest string"


def word_array(ends: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(
        pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    )


def word_bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each word ends (after a 0) and the bytes of all words."""
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    return ends - ends[0], data[ends[0] : ends[-1]]


class Coded:
    """The words of a block of texts, coded against the list of its distinct words."""

    def __init__(self, texts: list[bytes], buckets: int):
        data, starts = text_buffer(texts)
        inside = ~_SEPARATOR[data]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
        begin, end = edge[0::2], edge[1::2]
        text = np.searchsorted(starts, begin, side="right") - 1
        words = word_array(np.concatenate(([0], np.cumsum(end - begin))), data[inside]).dictionary_encode()
        distinct = words.dictionary
        # Distinct words in order of buckets; the hash only deals them out.
        ends, raw = word_bytes(distinct)
        bucket = (byte_range_hash(byte_sums(raw), ends[:-1], ends[1:]) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.distinct, self.bucket = distinct.take(pa.array(order)), bucket[order]
        column = place[words.indices.to_numpy()] if len(begin) else np.empty(0, np.int64)
        cell, self.counts = np.unique(text * max(1, len(order)) + column, return_counts=True)
        self.columns = cell % max(1, len(order))
        self.row_ends = np.searchsorted(cell // max(1, len(order)), np.arange(len(texts)), side="right")

        def total(flags: np.ndarray) -> np.ndarray:
            return np.add.reduceat(flags.view(np.uint8), starts[:-1], dtype=np.int64)

        self.n_chars = total((data & 0xC0) != 0x80) - 1  # without the line feed that joins texts
        self.n_upper = total((data >= 65) & (data <= 90))
        self.marked = total(_MARK[data]) > 0

    def sent(self) -> list[dict]:
        """The distinct words for each bucket that gets some."""
        cut = np.concatenate(([0], np.flatnonzero(np.diff(self.bucket)) + 1, [len(self.bucket)])) if len(self.bucket) else []
        out = []
        for lo, hi in zip(cut[:-1], cut[1:]):
            ends, data = word_bytes(self.distinct.slice(lo, hi - lo))
            out.append({"bucket": int(self.bucket[lo]), "sizes": squeeze(np.diff(ends).astype("<u4")), "words": squeeze(data)})
        return out


def _coded(buckets: int):
    names = [f.strip().split()[0] for f in MATRIX.replace("\n", " ").split(",")] + ["sent"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = [t or b"" for t in batch["text"].cast(pa.binary()).to_pylist()]
            ids, parts, row = batch["doc_id"].to_pylist(), batch["part"].to_pylist(), 0
            for block in rounds.blocks(texts, [len(t) for t in texts], SHARD):
                c, to = Coded(block, buckets), row + len(block)
                lists = [ids[row:to], parts[row:to], c.n_chars.tolist(), c.n_upper.tolist(), c.marked.tolist()]
                lists.append([hashlib.sha256(t).hexdigest() for t in block])
                packed = [squeeze(x.astype("<i4")) for x in (c.row_ends, c.columns, c.counts)]
                values = [shard, *lists, *packed, c.sent()]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _ARROW)], names=names)
                shard, row = shard + 1, to

    return run


_ARROW = [
    pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int64()),
    pa.list_(pa.bool_()), pa.list_(pa.string()), pa.binary(), pa.binary(), pa.binary(),
    pa.list_(pa.struct([("bucket", pa.int32()), ("sizes", pa.binary()), ("words", pa.binary())])),
]
_NUMBERED = pa.schema([("shard", pa.int64()), ("bucket", pa.int32()), ("numbers", pa.binary())])


def _numbered(buckets: int):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("shard")  # lists arrive in any order; numbers must not depend on it
        sizes = [np.frombuffer(unsqueeze(b), "<u4").astype(np.int64) for b in rows["sizes"].to_pylist()]
        data = np.frombuffer(b"".join(unsqueeze(b) for b in rows["words"].to_pylist()), np.uint8)
        words = word_array(np.concatenate(([0], np.cumsum(np.concatenate(sizes)))), data)
        bucket = rows["bucket"][0].as_py()
        # In this bucket, so the words of all buckets together have numbers of their own.
        numbers = words.dictionary_encode().indices.to_numpy().astype(np.int64) * buckets + bucket
        parts = np.split(numbers, np.cumsum([len(s) for s in sizes])[:-1])
        columns = [rows["shard"].to_pylist(), [bucket] * len(parts), [squeeze(x.astype("<i8")) for x in parts]]
        return pa.table(columns, schema=_NUMBERED)

    return run


def _renumber(shards: pa.Table, answers: pa.Table) -> pa.Table:
    at = np.argsort(np.array(answers["bucket"].to_pylist(), np.int64))
    numbers = answers["numbers"].to_pylist()
    own = np.frombuffer(b"".join(unsqueeze(numbers[i]) for i in at), "<i8")
    columns = np.frombuffer(unsqueeze(shards["columns"][0].as_py()), "<i4")
    place = shards.schema.get_field_index("columns")
    return shards.set_column(place, "columns", pa.array([squeeze(own[columns].astype("<i8"))], pa.binary()))


def _row_sums(shard: pa.Table) -> pa.Table:
    """Row sums and nonzero entries of one shard, with what else is known of its documents."""
    ends, counts = (np.frombuffer(unsqueeze(shard[name][0].as_py()), "<i4") for name in ("row_ends", "counts"))
    sums = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
    columns = [shard["doc_id"][0].values, shard["part"][0].values]
    columns += [pa.array(np.diff(sums[ends], prepend=0)), pa.array(np.diff(ends, prepend=0).astype(np.int64))]
    columns += [shard[name][0].values for name in ("n_chars", "n_upper", "marked", "digest")]
    return pa.table(columns, names=[f.split()[0] for f in ROWS.split(", ")])


def _shards(docs: DataFrame, use: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """What ``use`` makes of each shard of the matrix, in the task that completes it."""
    ship(docs.sparkSession)
    buckets = max(1, -(-text_bytes(docs) // BUCKET))
    coded = docs.select("doc_id", "part", "text").mapInArrow(_coded(buckets), f"{MATRIX}, sent {SENT}")
    coded = stage(coded, "coded")  # names the shards once and for all
    sent = coded.select("shard", F.inline("sent"))
    answers = sent.groupBy("bucket").applyInArrow(_numbered(buckets), "shard long, bucket int, numbers binary")
    shards = coded.drop("sent").groupBy("shard").cogroup(answers.groupBy("shard"))
    return shards.applyInArrow(lambda rows, numbers: use(_renumber(rows, numbers)), schema)


def term_matrix(docs: DataFrame) -> DataFrame:
    """The document-term matrix of ``docs`` (doc_id, part, text) in shards of compressed rows.

    ``row_ends``, ``columns`` and ``counts`` are zstd-packed numbers of 4, 8 and 4 bytes; a
    column's number stands for the same word in every shard. ``doc_id`` and what else is known of
    the documents are lists, one entry per row of the shard.
    """
    return _shards(docs, lambda shard: shard, MATRIX)


def flagged(docs: DataFrame) -> DataFrame:
    """(doc_id, part, failed) of every document: the sum of 1, 2, 4, 8, 16 for the filters it fails."""
    part = F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), part, F.col("text").cast("string").alias("text"))
    rows = stage(_shards(rows, _row_sums, ROWS), "row_sums")
    # Texts that occur more than once, with the least id of each; copies meet in partial sums.
    copies = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    rows = rows.join(copies.where("n > 1").select("digest", "first_id"), "digest", "left")
    tests = ["n_words < 200", "100 * n_distinct < 50 * n_words", "100 * n_upper > 2 * n_chars", "marked", "doc_id > first_id"]
    failed = sum((F.when(F.expr(t), 1 << i).otherwise(0) for i, t in enumerate(tests)), F.lit(0))
    return rows.select("doc_id", "part", failed.alias("failed"))


def interactions(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from counts of documents.

    ``counts``: (part, failed, n, good, toxic), one row per part and set of failed filters.
    """
    spark = counts.sparkSession
    rows = counts.withColumn("f", F.explode(F.sequence(F.lit(0), F.lit(len(FILTERS) - 1))))
    rows = rows.withColumn("before", F.explode(F.sequence(F.lit(0), F.lit((1 << len(FILTERS)) - 1))))
    rows = rows.where("(before & shiftleft(1, f)) = 0")
    fails, gone = F.expr("(failed & shiftleft(1, f)) != 0"), F.expr("(failed & before) != 0")
    sums = {
        "kept": (~fails & ~gone, "n"),
        "removed": (fails & ~gone, "n"),
        "redundant": (fails & gone, "n"),
        "unique_fails": (F.expr("failed = shiftleft(1, f)"), "n"),
        "good_lost": (fails & ~gone, "good"),
        "toxic_lost": (fails & ~gone, "toxic"),
    }
    states = rows.groupBy("part", "f", "before").agg(
        *(F.sum(F.when(on, F.col(n)).otherwise(F.lit(0))).cast("long").alias(name) for name, (on, n) in sums.items())
    )
    # A state comes at its step in as many orders as there are of the filters before and after it.
    ways = [factorial(k) * factorial(len(FILTERS) - 1 - k) for k in range(len(FILTERS))]
    weight = F.element_at(F.array(*map(F.lit, ways)), F.bit_count("before") + 1)
    shapley = states.groupBy("part", "f").agg(F.sum(F.col("removed") * weight).cast("long").alias("shapley"))
    steps = [
        ("".join(order), k + 1, FILTERS.index(x), sum(1 << FILTERS.index(y) for y in order[:k]))
        for order in permutations(FILTERS)
        for k, x in enumerate(order)
    ]
    orders = spark.createDataFrame(steps, "filter_order string, step int, f int, before int")
    return (
        states.join(shapley, ["part", "f"])
        .join(orders, ["f", "before"])
        .select("part", "filter_order", "step", *sums, "shapley")
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The interactions of the five filters over ``docs`` in each source."""
    rows = stage(flagged(docs), "flagged")
    group = ["part", "failed"]
    counts = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    known = labels.groupBy("doc_id").agg(F.max(F.expr("quality = 1")).alias("good"), F.max(F.expr("toxic = 1")).alias("toxic"))
    # Only labelled documents meet the labels, and null ids nobody.
    marked = rows.join(known.where("good or toxic"), "doc_id").groupBy(*group)
    marked = marked.agg(F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    whole = counts.join(marked, group, "left").fillna(0, ["good", "toxic"])
    return interactions(stage(whole, "counts"))


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), flags AS (
  SELECT doc_id, part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
         100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * len(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM words
), marks AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), sets AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS failed, count(*) AS n,
         count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM flags LEFT JOIN marks USING (doc_id) GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x), orders AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
), steps AS (
  SELECT filter_order, step, (1 << (strpos('ABCDE', filter_order[step]) - 1))::INT AS f,
         list_sum(list_transform(range(1, step), lambda i: 1 << (strpos('ABCDE', filter_order[i]) - 1)))::INT AS earlier
  FROM orders, range(1, 6) s(step)
), every AS (
  SELECT part, filter_order, step, f, sum(CASE WHEN failed & (f | coalesce(earlier, 0)) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN failed & f <> 0 AND failed & coalesce(earlier, 0) = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN failed & f <> 0 AND failed & coalesce(earlier, 0) <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN failed = f THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN failed & f <> 0 AND failed & coalesce(earlier, 0) = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN failed & f <> 0 AND failed & coalesce(earlier, 0) = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM sets, steps GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM every
"""
