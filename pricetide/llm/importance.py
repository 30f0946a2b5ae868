r"""Resampling documents towards a target: hashed n-gram counts, gains per bucket, Gumbel top-k.

Texts are counted in batches: those of a batch are joined with a separator no word contains,
one regular expression finds all words of the batch, and ``searchsorted`` over the beginnings of
the texts tells whose each word is. A run of n words is a feature where its first and last word
have the same text, so runs across two texts are masked out; what is left is counted with
``bincount``. A feature's bucket is the crc32 of its UTF-8 bytes modulo ``buckets``.

The buckets of each document's features are written once, as packed 16- or 32-bit numbers. Their
counts in the corpus and in the target give each bucket a gain; the model is that list of
``buckets`` numbers, which is all that the driver holds. A document weighs the floored mean of
its gains; a score adds Gumbel noise seeded by its id, so the highest scores are a sample
without replacement in proportion to the exponential of the weights.

Ranks come from a histogram of scores: weights and noise are thousandths of logarithms of
bounded numbers, so there are at most some 120,000 different scores however many documents
there are. The histogram gives the rank where each score begins and the lowest score that is
drawn; documents are put in order only among those of equal score.

Defined cases: null and empty texts have no features and weigh 0; null ids are hashed as the
empty string and come last among equal scores; rows that repeat an id are drawn each for itself,
in order of feature count where everything else is equal; an empty table gives no rows; without
a target or a corpus the counts are 0 and the formula holds; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricetide.llm import rounds
from pricetide.llm.hashing import squeeze, unsqueeze
from pricetide.llm.shared import stage, table

#: Words are runs of ASCII digits, small letters and everything beyond ASCII, on lower-cased text.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
BATCH, REMEMBERED = 1 << 21, 1 << 18


@dataclass(frozen=True)
class Resampling:
    """``grams``: longest run of words; ``percent`` of documents of ``least`` words are drawn."""

    grams: int = 1
    buckets: int = 10000
    percent: int = 10
    least: int = 20
    seed: int = 2024


class Features(dict):
    """Buckets of words, each computed once and forgotten when there are too many."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        found = self[feature] = zlib.crc32(feature) % self.buckets
        return found


def batch_features(texts: list[bytes], grams: int, known: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch: the text and the bucket of every feature, in order of texts, and words per text."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    joined = b"\n".join(texts).translate(LOWER)
    words, at = [], []
    for m in WORD.finditer(joined):
        words.append(m.group())
        at.append(m.start())
    owner = np.searchsorted(starts, np.array(at, np.int64), side="right") - 1
    owners, buckets = [owner], [np.fromiter(map(known.__getitem__, words), np.int64, len(words))]
    runs = words
    for n in range(2, grams + 1):
        runs = [a + b" " + b for a, b in zip(runs, words[n - 1 :])]
        inside = owner[: len(runs)] == owner[n - 1 :]
        whole = [r for r, ok in zip(runs, inside.tolist()) if ok]
        owners.append(owner[: len(runs)][inside])
        buckets.append(np.fromiter(map(known.__getitem__, whole), np.int64, len(whole)))
    text, bucket = np.concatenate(owners), np.concatenate(buckets)
    order = np.argsort(text, kind="stable")
    return text[order], bucket[order], np.bincount(owner, minlength=len(texts))


def _described(plan: Resampling):
    kind = np.uint16 if plan.buckets <= 1 << 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Features(plan.buckets)
        for batch in batches:
            texts = [t or b"" for t in batch["text"].cast(pa.binary()).to_pylist()]
            row = 0
            for block in rounds.blocks(texts, [len(t) for t in texts], BATCH):
                text, bucket, words = batch_features(block, plan.grams, known)
                cut = np.searchsorted(text, np.arange(len(block) + 1))
                packed = bucket.astype(kind)
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.slice(row, len(block)).drop_columns(["text"]).columns,
                        pa.array(words),
                        pa.array(np.diff(cut)),
                        pa.array([packed[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
                    ],
                    names=["doc_id", "n_words", "n_features", "packed"],
                )
                row += len(block)

    return run


def described(docs: DataFrame, plan: Resampling, key: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, n_features, packed): the buckets of all features of each text."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_described(plan), f"doc_id {kind}, n_words long, n_features long, packed binary")


def counted(rows: DataFrame, plan: Resampling) -> np.ndarray:
    """Features in each bucket: a ``bincount`` per task, then sums of at most ``buckets`` rows."""
    kind = np.uint16 if plan.buckets <= 1 << 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(plan.buckets, np.int64)
        for batch in batches:
            for packed in batch["packed"]:
                total += np.bincount(np.frombuffer(packed.as_py(), kind), minlength=plan.buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    sums = rows.select("packed").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(plan.buckets, np.int64)
    for row in sums.collect():  # bounded by the number of buckets
        out[row.bucket] = row.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of target over corpus frequency, each bucket smoothed by one."""
    n, whole_s, whole_t = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log(((t + 1.0) * (whole_s + n)) / ((s + 1.0) * (whole_t + n))))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        np.int64,
    )


def _weighed(packed_gains: bytes, plan: Resampling):
    kind = np.uint16 if plan.buckets <= 1 << 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = np.frombuffer(unsqueeze(packed_gains), np.int64)
        for batch in batches:
            sizes = batch["n_features"].to_numpy()
            data = np.frombuffer(b"".join(batch["packed"].to_pylist()), kind)
            sums = np.concatenate(([0], np.cumsum(gain[data])))
            ends = np.cumsum(sizes)
            weight = (sums[ends] - sums[ends - sizes]) // np.maximum(sizes, 1)  # floors go down
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["n_words"], batch["n_features"], pa.array(weight)],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return run


def scored(rows: DataFrame, gain: np.ndarray, plan: Resampling) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of the rows of ``described``."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(
        _weighed(squeeze(gain.tobytes()), plan), f"doc_id {kind}, n_words long, n_features long, weight long"
    )
    seeded = F.concat(F.lit(f"{plan.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.left(F.sha2(seeded, 256), F.lit(8)), 16, 10).cast("double")
    noise = F.floor(-1000 * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))
    return out.withColumn("score", F.col("weight") + noise)


def ranked(rows: DataFrame, plan: Resampling) -> DataFrame:
    """rows of ``scored``, stored, with the rank of those that are drawn, null for the others."""
    levels = rows.where(F.col("n_words") >= plan.least).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    # One row per score, of which the definition allows only so many: see the module's text.
    above = F.sum("n").over(Window.orderBy(F.desc("score"))) - F.col("n")
    levels = stage(levels.withColumn("above", above), "levels")
    drawn = (levels.agg(F.sum("n")).first()[0] or 0) * plan.percent // 100
    lowest = levels.where(F.col("above") < drawn).agg(F.min("score")).first()[0]
    able = F.lit(False) if lowest is None else (F.col("n_words") >= plan.least) & (F.col("score") >= lowest)
    tie = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "n_features", "weight")
    top = rows.where(able).join(levels.select("score", "above"), "score").withColumn("_place", F.row_number().over(tie))
    rank = (F.col("above") + F.col("_place")).cast("long")
    top = top.select(*rows.columns, F.when(rank <= drawn, rank).alias("rank"))
    return rows.where(~able).withColumn("rank", F.lit(None).cast("long")).unionByName(top)


def resample(docs: DataFrame, target: DataFrame, plan: Resampling = Resampling(), target_key: str = "item_id") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document."""
    rows = stage(described(docs, plan), "features")
    wanted = counted(described(target, plan, target_key), plan)
    return ranked(stage(scored(rows, gains(counted(rows, plan), wanted), plan), "scores"), plan)


def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    found = resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def _sql(plan: Resampling = Resampling()) -> str:
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    step = "CASE WHEN {0} & 1 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END"
    shifts = ", ".join(f"c{i + 1} AS (SELECT i, {step.format('c')} AS c FROM c{i})" for i in range(8))
    return rf"""
WITH c0 AS (SELECT i, i AS c FROM range(256) r(i)), {shifts},
crc AS (SELECT list(c ORDER BY i) AS steps FROM c8),
docs AS (SELECT row_number() OVER () AS id, doc_id, {words} AS words FROM documents),
seen AS (SELECT 's' AS side, id, unnest(words) AS word FROM docs
         UNION ALL SELECT 't', 0, unnest({words}) FROM benchmark),
bytes AS (SELECT word, list_transform(range(len(hex(encode(word))) // 2), lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT) AS b
          FROM (SELECT DISTINCT word FROM seen)),
bucket AS (SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c >> 8, steps[xor(c & 255, x) + 1])), 4294967295) % {plan.buckets} AS bucket
           FROM bytes, crc),
counts AS (SELECT bucket, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t
           FROM seen JOIN bucket USING (word) GROUP BY bucket),
totals AS (SELECT sum(s)::DOUBLE AS ss, sum(t)::DOUBLE AS tt FROM counts),
gain AS (SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (ss + {plan.buckets})) / ((s + 1)::DOUBLE * (tt + {plan.buckets}))))::BIGINT AS gain FROM counts, totals),
weight AS (SELECT id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
           FROM seen JOIN bucket USING (word) JOIN gain USING (bucket) WHERE side = 's' GROUP BY id),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(words) AS n_words,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('{plan.seed}:' || coalesce(doc_id::VARCHAR, '')), 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM docs LEFT JOIN weight USING (id)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= {plan.least} ORDER BY score DESC, doc_id, n_features, weight) AS place,
         count(*) OVER (PARTITION BY n_words >= {plan.least}) AS able FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= {plan.least} AND place <= {plan.percent} * able // 100 THEN place END AS rank FROM placed
"""


SQL = _sql()
